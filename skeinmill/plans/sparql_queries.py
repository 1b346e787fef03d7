"""SPARQL over the record tables, with the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skeinmill.operators.graph import NAMESPACES, RecordGraph, quad_counts
from skeinmill.session import table
from skeinmill.sparql import Dataset, select


def graph(spark: SparkSession, d: str) -> Dataset:
    return RecordGraph([table(spark, d, t) for t in ("entities", "concepts", "scopes")], table(spark, d, "relations"), table(spark, d, "aliases"))


#: name -> (query, types of variables, SQL).
_CASES: dict[str, tuple[str, dict[str, str], str]] = {}


def _case(name: str, query: str, sql: str, **types: str) -> None:
    _CASES[name] = (query, types, sql)


_R = NAMESPACES["resource"]
_NAMES = "names AS (SELECT DISTINCT id, name FROM entities WHERE name <> '' UNION SELECT id, name FROM concepts WHERE name <> '' UNION SELECT id, name FROM scopes WHERE name <> '')"
_EDGES = "edges AS (SELECT DISTINCT subject, predicate, object FROM relations WHERE trim(subject) <> '' AND trim(predicate) <> '' AND trim(object) <> '')"
_TYPES = "types AS (SELECT DISTINCT id, rdf_type FROM entities WHERE rdf_type <> '' UNION SELECT id, rdf_type FROM concepts WHERE rdf_type <> '' UNION SELECT id, rdf_type FROM scopes WHERE rdf_type <> '')"
_CITED = "cited AS (SELECT DISTINCT id, properties.citation_count AS n FROM entities WHERE properties.citation_count IS NOT NULL)"
_W = f"WITH {_NAMES}, {_EDGES}, {_TYPES}, {_CITED}"

_case(
    "bgp_star_topk",
    """SELECT ?citations ?paperName ?canonicalId (GROUP_CONCAT(DISTINCT ?coauthorName; separator=", ") AS ?coauthors)
WHERE { ?paper a bibo:AcademicArticle ; schema:name ?paperName ; pkg:canonical_id ?canonicalId ; pkg:citation_count ?citations ;
        pkg:corporate_authored_by ?org . ?org a schema:Organization .
  OPTIONAL { ?paper pkg:authored_by ?coauthor . ?coauthor schema:name ?coauthorName . FILTER(?coauthorName != "Wei") } }
GROUP BY ?citations ?paperName ?canonicalId ORDER BY DESC(?citations) ?canonicalId ?paperName LIMIT 20""",
    f"""{_W} SELECT c.n AS citations, n.name AS "paperName", t.id AS "canonicalId", coalesce(string_agg(DISTINCT k.name, ', ' ORDER BY k.name), '') AS coauthors
FROM types t JOIN names n USING (id) JOIN cited c USING (id)
JOIN edges e ON e.subject = t.id AND e.predicate = 'corporate_authored_by' JOIN types o ON o.id = e.object AND o.rdf_type = 'schema:Organization'
LEFT JOIN (SELECT a.subject, m.name FROM edges a JOIN names m ON m.id = a.object WHERE a.predicate = 'authored_by' AND m.name <> 'Wei') k ON k.subject = t.id
WHERE t.rdf_type = 'bibo:AcademicArticle' GROUP BY 1, 2, 3 ORDER BY 1 DESC, 3, 2 LIMIT 20""",
    citations="bigint",
)
_case(
    "bgp_chain_join",
    "SELECT DISTINCT ?p ?i WHERE { ?talk pkg:presented_by ?p . ?p pkg:affiliated_with ?i . ?i a schema:Organization }",
    f"""{_W} SELECT DISTINCT '{_R}' || url_encode(a.object) AS p, '{_R}' || url_encode(b.object) AS i FROM edges a JOIN edges b ON b.subject = a.object
JOIN types t ON t.id = b.object AND t.rdf_type = 'schema:Organization' WHERE a.predicate = 'presented_by' AND b.predicate = 'affiliated_with'""",
)
_case(
    "optional_filtered_left_join",
    "SELECT ?id ?n WHERE { ?s a schema:Event ; pkg:canonical_id ?id . OPTIONAL { ?s pkg:about ?c . ?c schema:name ?n FILTER(?n > \"M\") } }",
    f"""{_W} SELECT t.id, k.name AS n FROM types t LEFT JOIN (SELECT e.subject, n.name FROM edges e JOIN names n ON n.id = e.object
  WHERE e.predicate = 'about' AND n.name > 'M') k ON k.subject = t.id WHERE t.rdf_type = 'schema:Event'""",
)
_case(
    "filter_numeric_lt",
    "SELECT ?id ?n WHERE { ?s pkg:canonical_id ?id ; pkg:author_count ?n FILTER(?n >= 0 && ?n < 10) }",
    "SELECT DISTINCT id, properties.author_count AS n FROM entities WHERE properties.author_count BETWEEN 0 AND 9",
    n="bigint",
)
_case("count_subjects", "SELECT (COUNT(?s) AS ?n) WHERE { ?s pkg:authored_by ?o }", f"{_W} SELECT count(*) AS n FROM edges WHERE predicate = 'authored_by'", n="bigint")
_case("count_distinct_subjects", "SELECT ?t (COUNT(DISTINCT ?s) AS ?n) WHERE { ?s a ?t } GROUP BY ?t", f"""{_W} SELECT CASE split_part(rdf_type, ':', 1)
{' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in NAMESPACES.items())} END || split_part(rdf_type, ':', 2) AS t, count(DISTINCT id) AS n FROM types GROUP BY 1""", n="bigint")
_case(
    "group_concat_distinct",
    """SELECT ?id (GROUP_CONCAT(DISTINCT ?a; separator=" | ") AS ?names) WHERE { ?s a foaf:Person ; pkg:canonical_id ?id ; schema:alternateName ?a } GROUP BY ?id""",
    f"""{_W} SELECT t.id, string_agg(DISTINCT alias, ' | ' ORDER BY alias) AS names FROM types t JOIN aliases a ON a.entity_id = t.id AND alias <> '' WHERE rdf_type = 'foaf:Person' GROUP BY 1""",
)
_case(
    "union_patterns",
    "SELECT ?id ?how WHERE { { ?s pkg:authored_by ?o BIND(\"written\" AS ?how) } UNION { ?s pkg:presented_by ?o BIND(\"told\" AS ?how) } ?o pkg:canonical_id ?id }",
    f"""{_W} SELECT object AS id, CASE predicate WHEN 'authored_by' THEN 'written' ELSE 'told' END AS how FROM edges JOIN (SELECT DISTINCT id FROM entities UNION SELECT id FROM concepts UNION SELECT id FROM scopes) e ON e.id = object
WHERE predicate IN ('authored_by', 'presented_by')""",
)
_case(
    "minus_patterns",
    "SELECT ?id WHERE { ?s a foaf:Person ; pkg:canonical_id ?id MINUS { ?s pkg:affiliated_with ?i } }",
    f"{_W} SELECT id FROM types WHERE rdf_type = 'foaf:Person' AND id NOT IN (SELECT subject FROM edges WHERE predicate = 'affiliated_with')",
)
_case(
    "exists_semi",
    "SELECT ?id WHERE { ?s a foaf:Person ; pkg:canonical_id ?id FILTER EXISTS { ?t pkg:presented_by ?s } }",
    f"{_W} SELECT id FROM types WHERE rdf_type = 'foaf:Person' AND id IN (SELECT object FROM edges WHERE predicate = 'presented_by')",
)
_case(
    "not_exists_anti",
    "SELECT ?id WHERE { ?s a bibo:AcademicArticle ; pkg:canonical_id ?id FILTER NOT EXISTS { ?s pkg:about ?c . ?c a skos:Concept } }",
    f"""{_W} SELECT id FROM types WHERE rdf_type = 'bibo:AcademicArticle' AND id NOT IN
  (SELECT subject FROM edges JOIN types c ON c.id = object AND c.rdf_type = 'skos:Concept' WHERE predicate = 'about')""",
)
_case(
    "exists_or_filter",
    "SELECT ?id WHERE { ?s a bibo:AcademicArticle ; pkg:canonical_id ?id ; pkg:citation_count ?n FILTER(?n > 200 || EXISTS { ?s pkg:corporate_authored_by ?o }) }",
    f"""{_W} SELECT id FROM types JOIN cited USING (id) WHERE rdf_type = 'bibo:AcademicArticle' AND (n > 200 OR id IN (SELECT subject FROM edges WHERE predicate = 'corporate_authored_by'))""",
)
_case(
    "values_inline",
    "SELECT ?p (COUNT(*) AS ?n) WHERE { VALUES ?p { pkg:about pkg:broader pkg:member_of } ?s ?p ?o } GROUP BY ?p",
    f"{_W} SELECT '{NAMESPACES['pkg']}' || predicate AS p, count(*) AS n FROM edges WHERE predicate IN ('about', 'broader', 'member_of') GROUP BY 1",
    n="bigint",
)
_case(
    "bind_expr",
    "SELECT ?id ?decade ?label WHERE { ?s pkg:publication_year ?y ; pkg:canonical_id ?id BIND(FLOOR(?y / 10) * 10 AS ?decade) BIND(IF(?y < 2010, UCASE(\"old\"), CONCAT(\"n\", \"ew\")) AS ?label) FILTER(?y > 0) }",
    "SELECT DISTINCT id, (floor(y / 10) * 10)::DOUBLE AS decade, CASE WHEN y < 2010 THEN 'OLD' ELSE 'new' END AS label FROM (SELECT id, properties.publication_year AS y FROM entities) WHERE y > 0",
    decade="double",
)
# Two years of one record in a decade are two solutions; the SQL above counts (id, year) once each.
_CASES["bind_expr"] = (_CASES["bind_expr"][0].replace("SELECT ?id", "SELECT DISTINCT ?id"), *_CASES["bind_expr"][1:])
_case(
    "having_avg",
    "SELECT ?y (AVG(?n) AS ?mean) (MAX(?n) AS ?most) (SUM(?n) AS ?sum) WHERE { ?s pkg:publication_year ?y ; pkg:citation_count ?n FILTER(?n >= 0 && ?y > 0) } GROUP BY ?y HAVING(AVG(?n) > 2)",
    f"""{_W} SELECT y, avg(n) AS mean, max(n) AS most, sum(n)::BIGINT AS sum FROM cited JOIN (SELECT DISTINCT id, properties.publication_year AS y FROM entities) p USING (id)
WHERE n >= 0 AND y > 0 GROUP BY 1 HAVING avg(n) > 2""",
    y="bigint", mean="double", most="bigint", sum="bigint",
)
_case(
    "literal_object",
    'SELECT ?id WHERE { ?s schema:name "National Laboratory" ; pkg:canonical_id ?id }',
    f"{_W} SELECT id FROM names WHERE name = 'National Laboratory'",
)
_case("select_all", "SELECT * WHERE { ?paper pkg:corporate_authored_by ?org }", f"""{_W} SELECT '{_R}' || url_encode(subject) AS paper, '{_R}' || url_encode(object) AS org FROM edges WHERE predicate = 'corporate_authored_by'""")
_case(
    "numeric_functions",
    "SELECT DISTINCT ?id ?a ?c ?r WHERE { ?s pkg:citation_count ?n ; pkg:canonical_id ?id BIND(ABS(?n - 100) AS ?a) BIND(CEIL(?n / 7) AS ?c) BIND(ROUND(?n / 4) AS ?r) FILTER(?n >= 0) }",
    f"{_W} SELECT DISTINCT id, abs(n - 100)::DOUBLE AS a, ceil(n / 7)::DOUBLE AS c, floor(n / 4 + 0.5)::DOUBLE AS r FROM cited WHERE n >= 0",
    a="double", c="double", r="double",
)
_case(
    "hash_functions",
    "SELECT DISTINCT ?id ?m ?h ?k WHERE { ?s a skos:Concept ; pkg:canonical_id ?id ; schema:name ?n BIND(MD5(?n) AS ?m) BIND(SHA256(?n) AS ?h) BIND(SHA1(?n) AS ?k) }",
    f"{_W} SELECT DISTINCT t.id, md5(n.name) AS m, sha256(n.name) AS h, sha1(n.name) AS k FROM types t JOIN names n USING (id) WHERE rdf_type = 'skos:Concept'",
)
_case(
    "term_tests",
    "SELECT ?id (COUNT(?x) AS ?n) (MIN(?l) AS ?least) WHERE { ?s a schema:Event ; pkg:canonical_id ?id ; ?p ?x BIND(STR(?x) AS ?l) FILTER(isIRI(?x) && ?p IN (pkg:about, pkg:presented_by, rdf:type) || isLITERAL(?x) && sameTerm(?p, schema:name)) } GROUP BY ?id",
    f"""{_W} SELECT t.id, count(*) AS n, min(l) AS least FROM (SELECT DISTINCT id FROM types WHERE rdf_type = 'schema:Event') t JOIN (
  SELECT id, name AS l FROM names UNION ALL SELECT subject, '{_R}' || url_encode(object) FROM edges WHERE predicate IN ('about', 'presented_by')
  UNION ALL SELECT id, CASE split_part(rdf_type, ':', 1) {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in NAMESPACES.items())} END || split_part(rdf_type, ':', 2) FROM types) x ON x.id = t.id GROUP BY 1""",
    n="bigint",
)
_case(
    "path_optional",
    "SELECT ?id ?o WHERE { ?s a schema:Event ; pkg:canonical_id ?id ; pkg:about? ?o }",
    f"""{_W}, ev AS (SELECT DISTINCT id FROM types WHERE rdf_type = 'schema:Event') SELECT id, '{_R}' || url_encode(id) AS o FROM ev UNION SELECT id, '{_R}' || url_encode(object) FROM ev JOIN edges ON subject = id AND predicate = 'about'""",
)
_case(
    "path_any_length",
    "SELECT DISTINCT ?id ?top WHERE { ?s a skos:Concept ; pkg:canonical_id ?id ; pkg:broader* ?t . ?t pkg:canonical_id ?top }",
    f"""WITH RECURSIVE {_NAMES}, {_EDGES}, {_TYPES}, up AS (SELECT DISTINCT id AS s, id AS o FROM types WHERE rdf_type = 'skos:Concept' UNION SELECT u.s, e.object FROM up u JOIN edges e ON e.subject = u.o AND e.predicate = 'broader')
SELECT DISTINCT s AS id, o AS top FROM up WHERE o IN (SELECT id FROM entities UNION SELECT id FROM concepts UNION SELECT id FROM scopes)""",
)
_case(
    "path_negated",
    "SELECT ?o (COUNT(?s) AS ?n) WHERE { ?s !(pkg:about|pkg:canonical_id|schema:name|schema:alternateName|rdf:type|pkg:authored_by) ?o . ?o a schema:Event } GROUP BY ?o",
    f"""{_W} SELECT '{_R}' || url_encode(object) AS o, count(*) AS n FROM (SELECT DISTINCT subject, object FROM edges WHERE predicate NOT IN ('about', 'authored_by')) JOIN (SELECT DISTINCT id FROM types WHERE rdf_type = 'schema:Event') ON id = object GROUP BY 1""",
    n="bigint",
)
_case(
    "optional_then_join",
    "SELECT ?n ?t WHERE { ?s a schema:Event OPTIONAL { ?s pkg:canonical_id ?id } ?t pkg:canonical_id ?id . OPTIONAL { ?t schema:name ?n } }",
    f"""{_W} SELECT n.name AS n, '{_R}' || url_encode(t.id) AS t FROM (SELECT DISTINCT id FROM types WHERE rdf_type = 'schema:Event') t LEFT JOIN names n ON n.id = t.id""",
)
_case(
    "order_limit_offset",
    "SELECT ?n ?id WHERE { ?s a schema:Organization ; schema:name ?n ; pkg:canonical_id ?id } ORDER BY DESC(STRLEN(?n)) ?n ?id LIMIT 25 OFFSET 5",
    f"{_W} SELECT name AS n, id FROM types JOIN names USING (id) WHERE rdf_type = 'schema:Organization' ORDER BY length(name) DESC, name, id LIMIT 25 OFFSET 5",
)
_case(
    "named_graph_counts",
    "SELECT ?g (COUNT(?s) AS ?n) WHERE { GRAPH ?g { ?s pkg:about ?o } } GROUP BY ?g",
    f"""SELECT '{NAMESPACES['source']}' || url_encode(g) AS g, count(*) AS n FROM (SELECT DISTINCT subject, object, g FROM (
  SELECT subject, object, unnest([x.source_id for x in source_refs]) AS g FROM relations WHERE predicate = 'about' AND trim(subject) <> '' AND trim(object) <> '') WHERE g <> '') GROUP BY 1""",
    n="bigint",
)
_case(
    "path_sequence",
    "SELECT DISTINCT ?a ?n WHERE { ?t pkg:presented_by/pkg:affiliated_with ?i . ?t pkg:canonical_id ?a . ?i schema:name ?n }",
    f"""{_W} SELECT DISTINCT a.subject AS a, n.name AS n FROM edges a JOIN edges b ON b.subject = a.object JOIN names n ON n.id = b.object
JOIN (SELECT DISTINCT id FROM entities) e ON e.id = a.subject WHERE a.predicate = 'presented_by' AND b.predicate = 'affiliated_with'""",
)
_case(
    "path_inverse",
    "SELECT ?id (COUNT(?w) AS ?n) WHERE { ?p a foaf:Person ; pkg:canonical_id ?id ; ^pkg:authored_by ?w } GROUP BY ?id",
    f"{_W} SELECT id, count(*) AS n FROM types JOIN edges ON object = id WHERE predicate = 'authored_by' AND rdf_type = 'foaf:Person' GROUP BY 1",
    n="bigint",
)
_case(
    "path_alternative",
    "SELECT DISTINCT ?a ?b WHERE { ?x (pkg:presented_by|pkg:presented_at) ?y . ?x pkg:canonical_id ?a . ?y pkg:canonical_id ?b }",
    f"""{_W} SELECT DISTINCT subject AS a, object AS b FROM edges JOIN (SELECT DISTINCT id FROM entities) x ON x.id = subject JOIN (SELECT DISTINCT id FROM entities) y ON y.id = object
WHERE predicate IN ('presented_by', 'presented_at')""",
)
_case(
    "path_closure",
    "SELECT ?a ?b WHERE { ?x pkg:broader+ ?y . ?x pkg:canonical_id ?a . ?y pkg:canonical_id ?b }",
    f"""WITH RECURSIVE {_EDGES}, reach AS (SELECT subject AS x, object AS y FROM edges WHERE predicate = 'broader'
  UNION SELECT r.x, e.object FROM reach r JOIN edges e ON e.subject = r.y AND e.predicate = 'broader'),
ids AS (SELECT id FROM entities UNION SELECT id FROM concepts UNION SELECT id FROM scopes)
SELECT x AS a, y AS b FROM reach WHERE x IN (SELECT id FROM ids) AND y IN (SELECT id FROM ids)""",
)
_case(
    "subselect_join",
    "SELECT ?id ?n WHERE { { SELECT ?o (COUNT(*) AS ?n) WHERE { ?s pkg:authored_by ?o } GROUP BY ?o HAVING(COUNT(*) > 20) } ?o pkg:canonical_id ?id }",
    f"{_W} SELECT object AS id, count(*) AS n FROM edges WHERE predicate = 'authored_by' AND object IN (SELECT id FROM entities) GROUP BY 1 HAVING count(*) > 20",
    n="bigint",
)
_case(
    "string_functions",
    """SELECT DISTINCT ?id ?up ?cut ?before ?after ?len ?has ?swap WHERE { ?s a schema:Organization ; pkg:canonical_id ?id ; schema:name ?n
  BIND(UCASE(?n) AS ?up) BIND(SUBSTR(?n, 2, 5) AS ?cut) BIND(STRBEFORE(?n, " ") AS ?before) BIND(STRAFTER(?n, " ") AS ?after)
  BIND(STRLEN(?n) AS ?len) BIND(CONTAINS(LCASE(?n), "obs") AS ?has) BIND(REPLACE(?n, "[aeiou]", "_") AS ?swap) FILTER(REGEX(?n, "^[a-m]", "i")) }""",
    f"""{_W} SELECT DISTINCT id, upper(name) AS up, substr(name, 2, 5) AS "cut", CASE WHEN contains(name, ' ') THEN split_part(name, ' ', 1) ELSE '' END AS "before",
  CASE WHEN contains(name, ' ') THEN substr(name, instr(name, ' ') + 1) ELSE '' END AS "after", length(name) AS len, contains(lower(name), 'obs')::VARCHAR AS has,
  regexp_replace(name, '[aeiou]', '_', 'g') AS swap FROM types JOIN names USING (id) WHERE rdf_type = 'schema:Organization' AND regexp_matches(name, '^[a-m]', 'i')""",
    len="bigint",
)


def _run(name: str):
    query, types, _ = _CASES[name]

    def run(spark: SparkSession, d: str) -> DataFrame:
        return select(graph(spark, d), query, NAMESPACES, types)

    run.__name__ = name
    return run


def quads_vs_triples_count(spark: SparkSession, d: str) -> DataFrame:
    return quad_counts(graph(spark, d).quads)


QUERIES = {name: _run(name) for name in _CASES} | {"quads_vs_triples_count": quads_vs_triples_count}

_MEMBERS = {
    "entities": ["citation_key", "entry_type", "author_list", "journal", "source_url", "description", "institution_kind", "start_date", "end_date", "location", "publication_year", "citation_count", "author_count"],
    "concepts": ["notation", "scheme", "description"],
    "scopes": ["scope_kind", "source_url"],
}
_FACTS = " UNION ALL ".join(
    f"SELECT source_refs AS r, id AS s, '{p}' AS p, {v} AS o FROM {t} WHERE {v} <> ''"
    for t, members in _MEMBERS.items()
    for p, v in [("canonical_id", "id"), ("type", "rdf_type"), ("name", "name"), *[(m, f"properties.{m}::VARCHAR") for m in members]]
)
SQL = {name: sql for name, (_, _, sql) in _CASES.items()} | {
    "quads_vs_triples_count": f"""WITH facts AS ({_FACTS} UNION ALL SELECT source_refs, subject, 'e:' || predicate, object FROM relations WHERE trim(subject) <> '' AND trim(predicate) <> '' AND trim(object) <> ''
  UNION ALL SELECT source_refs, entity_id, 'alternateName', alias FROM aliases WHERE alias <> '' AND entity_id <> '')
SELECT (SELECT count(*) FROM (SELECT DISTINCT s, p, o FROM facts)) AS triples,
  (SELECT count(DISTINCT g) FROM (SELECT unnest([x.source_id for x in r]) AS g FROM facts) WHERE g <> '') AS named_graphs"""
}
