"""Queries of the record operators over the record and star-schema tables, with the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinmill.functions import text as X
from skeinmill.operators import census as C
from skeinmill.operators import merge as M
from skeinmill.operators import project as P
from skeinmill.operators import resolve as R
from skeinmill.operators import topics as T
from skeinmill.operators.graph import NAMESPACES, resource
from skeinmill.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


_ALL = """records AS (SELECT id, type, rdf_type, name FROM entities UNION ALL SELECT id, type, rdf_type, name FROM concepts UNION ALL SELECT id, type, rdf_type, name FROM scopes)"""


def _records(spark: SparkSession, d: str) -> DataFrame:
    cols = ("id", "type", "rdf_type", "name")
    a, b, c = (table(spark, d, t).select(*cols) for t in ("entities", "concepts", "scopes"))
    return a.unionByName(b).unionByName(c)


# Merging.


@_query("""SELECT id, arg_min(name, (epoch_us(ingested_at), record_id)) FILTER (name IS NOT NULL) AS first_name, arg_max(properties.journal, (epoch_us(ingested_at), record_id)) FILTER (properties.journal IS NOT NULL) AS journal,
  arg_max(properties.citation_count, (epoch_us(ingested_at), record_id)) FILTER (properties.citation_count IS NOT NULL) AS citation_count,
  coalesce((SELECT count(DISTINCT r) FROM (SELECT unnest(e2.source_refs) AS r FROM entities e2 WHERE e2.id = e.id)), 0) AS n_refs
FROM entities e GROUP BY id""")
def merge_upsert_first_wins(spark, d):
    rows = table(spark, d, "entities")
    out = M.merged(rows.withColumn("name", F.col("name")))
    first = rows.where(F.col("name").isNotNull()).groupBy("id").agg(F.min_by("name", F.struct("ingested_at", "record_id")).alias("first_name"))
    return out.join(first, "id", "left").select("id", "first_name", "properties.journal", "properties.citation_count", F.size("source_refs").cast("bigint").alias("n_refs"))


@_query("""SELECT id, record_id, len(list_filter(source_refs, lambda r: NOT coalesce(starts_with(r.source_id, 'ads:'), false))) AS n_left FROM entities
WHERE len(list_filter(source_refs, lambda r: NOT coalesce(starts_with(r.source_id, 'ads:'), false))) > 0""")
def retract_source(spark, d):
    return M.retracted(table(spark, d, "entities"), ["ads:"], prefix=True).select("id", "record_id", F.size("source_refs").cast("bigint").alias("n_left"))


_MOST = "most AS (SELECT s FROM (SELECT unnest(source_refs).source_id AS s FROM aliases) WHERE s IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, s LIMIT 1)"


def _most_cited(rows):
    """The source that most records refer to."""
    refs = rows.select(F.explode("source_refs").alias("r")).select("r.source_id").where(F.col("source_id").isNotNull())
    return refs.groupBy("source_id").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "source_id").first()["source_id"]


@_query(f"""WITH {_MOST}, refs AS (SELECT record_id, unnest(source_refs).source_id AS r FROM aliases),
kept AS (SELECT record_id FROM refs WHERE r IS NULL OR r <> (SELECT s FROM most)), again AS (SELECT record_id FROM refs WHERE r = (SELECT s FROM most) AND record_id % 2 = 0)
SELECT (SELECT count(*) FROM aliases) AS rows_before, (SELECT count(*) FROM (SELECT record_id FROM kept UNION SELECT record_id FROM again)) AS rows_after, true AS changed""")
def merge_source_report(spark, d):
    """The commonest source is ingested again, with every second of its records."""
    rows = table(spark, d, "aliases").withColumn("source_refs", F.coalesce("source_refs", F.array().cast(table(spark, d, "aliases").schema["source_refs"].dataType)))
    most = _most_cited(rows)
    own = F.filter("source_refs", lambda r: F.coalesce(r["source_id"] == most, F.lit(False)))
    again = rows.where((F.size(own) > 0) & (F.col("record_id") % 2 == 0)).withColumn("source_refs", own)
    _, report = M.merge_source(rows, again, [most], key="record_id")
    return report.select(F.col("before").alias("rows_before"), F.col("after").alias("rows_after"), "changed")


@_query("""WITH e AS (SELECT id, ingested_at, record_id, unnest(map_entries(identifiers)) AS x FROM entities)
SELECT id, x.key AS kind, arg_max(x.value, (epoch_us(ingested_at), record_id)) AS value FROM e WHERE x.value IS NOT NULL GROUP BY 1, 2""")
def merge_map_properties(spark, d):
    """Of each id the last value of each identifier, merged as a map."""
    rows = table(spark, d, "entities").select("id", "record_id", "ingested_at", "identifiers", "source_refs")
    return M.merged(rows, properties="identifiers").select("id", F.explode("identifiers").alias("kind", "value"))


@_query(r"""WITH one AS (SELECT record_id, 'k' || regexp_replace(lower(properties.citation_key), '[^a-z0-9]', '', 'g') AS key, properties.publication_year AS y, nullif(trim(regexp_replace(properties.journal, '[^A-Za-z0-9 .]', '', 'g')), '') AS j
  FROM entities WHERE type = 'Paper' AND regexp_replace(lower(properties.citation_key), '[^a-z0-9]', '', 'g') <> '')
SELECT 'paper:bibtex:' || key AS id, arg_max(y, record_id) FILTER (y > 0)::VARCHAR AS year, arg_max(regexp_replace(j, '\s+', ' ', 'g'), record_id) FILTER (j IS NOT NULL) AS journal FROM one GROUP BY 1""")
def bibtex_batch_merge(spark, d):
    """One BibTeX document of all papers, in which keys recur: the last value of each field stands."""
    from skeinmill.sources.builders import from_bibtex
    from skeinmill.sources.documents import bibtex

    p = lambda k: F.col("properties")[k]
    key = F.regexp_replace(F.lower(p("citation_key")), "[^a-z0-9]", "")
    journal = F.nullif(F.trim(F.regexp_replace(p("journal"), "[^A-Za-z0-9 .]", "")), F.lit(""))
    year = F.when(p("publication_year") > 0, F.concat(F.lit(", year = {"), p("publication_year").cast("string"), F.lit("}")))
    rows = table(spark, d, "entities").where((F.col("type") == "Paper") & (key != ""))
    text = F.concat(F.lit("@article{k"), key, F.coalesce(year, F.lit("")), F.coalesce(F.concat(F.lit(", journal = {"), journal, F.lit("}")), F.lit("")), F.lit("}"))
    entries = bibtex(rows.select(F.col("record_id").alias("_doc"), text.alias("text")), "_doc")
    found = from_bibtex(entries, "bib:all")["entities"]
    return found.select("id", F.try_element_at("properties", F.lit("publication_year")).alias("year"), F.try_element_at("properties", F.lit("journal")).alias("journal"))


@_query("SELECT DISTINCT id FROM concepts WHERE id IN (SELECT object FROM relations)")
def append_conflicts(spark, d):
    return M.conflicts(table(spark, d, "relations").select(F.col("object").alias("id")), table(spark, d, "concepts")).select("id").distinct()


# Resolution.

#: Titles without markup and entities, and their words in lower case.
_TITLE = r"""trim(regexp_replace(regexp_replace(replace(replace(replace(replace(replace(name, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&amp;', '&'),
  '(?i)</?(sub|sup|i|b|em|strong)\b[^>]*>', '', 'g'), '[\s\p{Z}]+', ' ', 'g'))"""
_TITLE_KEY = rf"trim(regexp_replace(replace(lower({_TITLE}), 'ß', 'ss'), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"


_FILLED = "lower(trim(v)) NOT IN ('', '-', '--', '?', 'n/a', 'n.a.', 'n/s', 'nil', 'none', 'not available', 'not given', 'not known', 'not stated', 'null', 'tbd', 'unknown', 'unspecified')"
_NORM = r"""CASE k WHEN 'doi' THEN lower(regexp_replace(trim(v), '^(https?://(dx\.)?doi\.org/|doi:\s*)', '', 'i')) WHEN 'arxiv' THEN lower(regexp_replace(regexp_replace(trim(v), '^arxiv:\s*', '', 'i'), 'v\d+$', '', 'i')) ELSE trim(v) END"""
_IDS = f"ids AS (SELECT id, record_id, k, {_NORM} AS v FROM (SELECT id, record_id, e.key AS k, e.value AS v FROM (SELECT id, record_id, unnest(map_entries(identifiers)) AS e FROM entities)) WHERE {_FILLED})"


@_query(f"""WITH {_IDS}, idx AS (SELECT k, v, max(id) AS id FROM ids GROUP BY 1, 2),
hits AS (SELECT i.record_id, arg_min(x.id, (CASE i.k WHEN 'doi' THEN 0 WHEN 'arxiv' THEN 1 ELSE 2 END)) AS id FROM ids i JOIN idx x USING (k, v) WHERE i.k IN ('doi', 'arxiv', 'ads') GROUP BY 1)
SELECT e.record_id, h.id FROM entities e LEFT JOIN hits h USING (record_id) WHERE e.type = 'Paper'""")
def identifier_resolution(spark, d):
    rows = table(spark, d, "entities")
    return R.resolved(rows.where(F.col("type") == "Paper"), "record_id", "identifiers", R.identifier_index(rows))


@_query(f"WITH {_IDS} SELECT k AS kind, v AS value, count(DISTINCT id) AS n FROM ids GROUP BY 1, 2 HAVING count(DISTINCT id) > 1")
def ambiguous_identifiers(spark, d):
    return R.ambiguous_identifiers(table(spark, d, "entities"))


@_query(f"""WITH t AS (SELECT DISTINCT id, {_TITLE_KEY} AS k FROM entities WHERE type = 'Paper' AND name IS NOT NULL AND id IS NOT NULL),
one AS (SELECT k, min(id) AS right_id FROM t WHERE k <> '' GROUP BY 1 HAVING count(*) = 1)
SELECT DISTINCT id AS left_id, right_id FROM t JOIN one USING (k)""")
def unique_title_match(spark, d):
    rows = table(spark, d, "entities")
    return R.unique_title_matches(rows.where(F.col("type") == "Paper"), rows.where(F.col("type") == "Paper"))


@_query(r"""WITH lists AS (SELECT id, properties.author_count AS n, string_split(properties.author_list, ';') AS l FROM entities WHERE type = 'Paper' AND properties.author_list IS NOT NULL),
clean AS (SELECT id, n, pos, trim(a) AS a FROM (SELECT id, n, unnest(l) AS a, generate_subscripts(l, 1) AS pos FROM lists) WHERE trim(a) <> '' AND NOT regexp_matches(trim(a), '(?i)\scollaboration$')),
one AS (SELECT id, author, min(pos) AS pos, max(n) AS n FROM (SELECT *, CASE WHEN contains(a, ',') THEN trim(concat_ws(' ', trim(substr(a, instr(a, ',') + 1)), trim(split_part(a, ',', 1)))) ELSE a END AS author FROM clean) GROUP BY 1, 2)
SELECT id, count(*) FILTER (k <= CASE WHEN n BETWEEN 0 AND 20 THEN 2000000000 ELSE 5 END) AS n_people FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY pos) AS k FROM one) GROUP BY 1""")
def author_reconciliation(spark, d):
    """How many bounded authors each paper gets, as reconciled edges are counted before names become ids."""
    papers = table(spark, d, "entities").where((F.col("type") == "Paper") & F.col("properties.author_list").isNotNull())
    return R.bounded_authors(papers, "properties.author_list", "id", "properties.author_count").groupBy("id").agg(F.count(F.lit(1)).alias("n_people"))


@_query(r"""SELECT record_id, coalesce(lower(CASE WHEN contains(name_as_cited, ',') THEN trim(concat_ws(' ', trim(substr(name_as_cited, instr(name_as_cited, ',') + 1)), trim(split_part(name_as_cited, ',', 1)))) ELSE trim(name_as_cited) END) IN ('wei gayuvadruk', 'w. gayuvadruk'), false) AS own FROM entities""")
def researcher_predicate(spark, d):
    return table(spark, d, "entities").select("record_id", R.is_researcher(F.col("name_as_cited"), "Gayuvadruk", ["Wei", "W."]).alias("own"))


@_query(f"""WITH {_IDS}, score AS (SELECT id, record_id, coalesce(cardinality(identifiers), 0) AS s FROM entities WHERE type = 'Paper'),
key AS (SELECT s.*, coalesce('doi:' || (SELECT min(v) FROM ids i WHERE i.record_id = s.record_id AND k = 'doi'), 'arxiv:' || (SELECT min(v) FROM ids i WHERE i.record_id = s.record_id AND k = 'arxiv'), id) AS identity FROM score s)
SELECT identity, arg_max(id, (s, id)) AS id, count(*) AS n FROM key GROUP BY 1""")
def best_record_dedupe(spark, d):
    papers = table(spark, d, "entities").where(F.col("type") == "Paper")
    return R.best_records(papers, F.coalesce(F.size("identifiers"), F.lit(0)), R.paper_identity())


@_query(r"""WITH lists AS (SELECT record_id AS id, properties.author_count AS n, string_split(properties.author_list, ';') AS l FROM entities WHERE properties.author_list IS NOT NULL),
items AS (SELECT id, n, unnest(l) AS a, generate_subscripts(l, 1) AS pos FROM lists),
clean AS (SELECT id, n, pos, trim(a) AS a FROM items WHERE trim(a) <> '' AND NOT regexp_matches(trim(a), '(?i)\scollaboration$')),
turned AS (SELECT id, n, pos, CASE WHEN contains(a, ',') THEN trim(concat_ws(' ', trim(substr(a, instr(a, ',') + 1)), trim(split_part(a, ',', 1)))) ELSE a END AS author FROM clean),
one AS (SELECT id, author, min(pos) AS pos, max(n) AS n FROM turned GROUP BY 1, 2)
SELECT id, position::INT AS position, author FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY pos) AS position FROM one) WHERE position <= CASE WHEN n BETWEEN 0 AND 20 THEN 2000000000 ELSE 5 END""")
def bounded_coauthors(spark, d):
    return R.bounded_authors(table(spark, d, "entities").where(F.col("properties.author_list").isNotNull()), "properties.author_list", "record_id", "properties.author_count")


@_query(r"""SELECT 'relation:' || substr(sha256(id || chr(0) || 'corporate_authored_by' || chr(0) || 'institution:name:survey'), 1, 20) AS id, id AS subject, 'corporate_authored_by' AS predicate, 'institution:name:survey' AS object, 'derived:corporate' AS source_id
FROM (SELECT DISTINCT id FROM entities WHERE type = 'Paper' AND regexp_matches(name, '(?i)^late\b'))""")
def corporate_reconciliation(spark, d):
    papers = table(spark, d, "entities").where(F.col("type") == "Paper")
    flag = R.is_corporate(F.col("name"), F.col("properties.author_list"), ["Survey Collaboration"], "late")
    return R.corporate_edges(papers, flag, "institution:name:survey", "derived:corporate")


@_query("""WITH w AS (SELECT o_orderkey, o_orderstatus, o_orderpriority || '; ' || o_orderstatus || ';Second Name' AS l FROM orders)
SELECT o_orderkey, CASE WHEN l LIKE '1-URGENT%' THEN 1 WHEN l LIKE '%; F;%' THEN 2 END::INT AS position,
  CASE WHEN o_orderstatus = 'O' THEN 'personal' WHEN l LIKE '1-URGENT%' OR l LIKE '%; F;%' THEN 'core' ELSE 'collab' END AS class FROM w""")
def researcher_position(spark, d):
    names = F.concat("o_orderpriority", F.lit("; "), "o_orderstatus", F.lit(";Second Name"))
    at = R.author_position(names, ["f", "1-urgent"])
    rows = table(spark, d, "orders")
    return rows.select("o_orderkey", at.cast("int").alias("position"), R.researcher_class(F.col("o_orderstatus") != "O", at).alias("class"))


# Census.


@_query(f"WITH {_ALL} SELECT class, count(*) AS n FROM (SELECT id, max(coalesce(rdf_type, 'unknown')) AS class FROM records WHERE id IS NOT NULL GROUP BY 1) GROUP BY 1")
def class_census(spark, d):
    return C.class_census(_records(spark, d))


_PROPS = ("citation_key", "entry_type", "author_list", "journal", "source_url", "description", "institution_kind", "start_date", "end_date", "location", "publication_year", "citation_count", "author_count")


@_query("SELECT class, property, count(*) AS n FROM (" + " UNION ALL ".join(f"SELECT coalesce(rdf_type, 'unknown') AS class, '{p}' AS property FROM entities WHERE properties.{p}::VARCHAR <> ''" for p in _PROPS) + ") GROUP BY 1, 2")
def property_census(spark, d):
    return C.property_census(table(spark, d, "entities"))


@_query("""SELECT class, rank::INT AS rank, name FROM (SELECT coalesce(rdf_type, 'unknown') AS class, name, row_number() OVER (PARTITION BY coalesce(rdf_type, 'unknown') ORDER BY record_id) AS rank FROM entities WHERE name <> '') WHERE rank <= 3""")
def example_names_top3(spark, d):
    return C.example_names(table(spark, d, "entities"))


@_query(f"""WITH {_ALL}, t AS (SELECT id, max(type) AS t FROM records WHERE id IS NOT NULL GROUP BY 1)
SELECT predicate, coalesce(a.t, 'unknown') AS domain, coalesce(b.t, 'unknown') AS range, count(*) AS n FROM relations LEFT JOIN t a ON a.id = subject LEFT JOIN t b ON b.id = object WHERE trim(predicate) <> '' GROUP BY 1, 2, 3""")
def predicate_domain_range(spark, d):
    return C.predicate_census(table(spark, d, "relations"), _records(spark, d))


@_query("SELECT DISTINCT event_type AS term FROM events WHERE event_type NOT IN (SELECT DISTINCT predicate FROM relations WHERE predicate IS NOT NULL) AND event_type IS NOT NULL")
def unknown_vocabulary(spark, d):
    return C.unknown_terms(table(spark, d, "events").select(F.col("event_type").alias("term")), C.vocabulary(table(spark, d, "entities"), table(spark, d, "relations")))


# Projection.

_KEYS = "CASE type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in P.TYPE_KEYS.items()) + " END"
_RELS = "CASE predicate " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in P.RELATION_PROPERTIES.items()) + " END"


@_query("SELECT canonical_id, type_key, name, property, value FROM (" + " UNION ALL ".join(
    [f"SELECT id AS canonical_id, {_KEYS} AS type_key, name, 'canonical_id' AS property, id AS value FROM entities"]
    + [f"SELECT id, {_KEYS}, name, '{p}', properties.{p}::VARCHAR FROM entities WHERE properties.{p}::VARCHAR <> ''" for p in _PROPS if p in P.ALLOWED]
) + ") WHERE canonical_id IS NOT NULL AND type_key IS NOT NULL")
def projection_objects(spark, d):
    return P.objects(table(spark, d, "entities"))


@_query("SELECT id AS canonical_id, value FROM (SELECT id, coalesce(nullif(properties.description, ''), properties.scheme || ' concept') AS value FROM concepts) WHERE value <> ''")
def concept_descriptions(spark, d):
    return P.objects(table(spark, d, "concepts")).where(F.col("property") == "description").select("canonical_id", "value")


@_query(f"SELECT DISTINCT subject, {_RELS} AS property, object FROM relations WHERE {_RELS} IS NOT NULL")
def projected_relations(spark, d):
    return P.relation_targets(table(spark, d, "relations"))


@_query(r"""WITH l AS (SELECT record_id, properties.author_list AS names, properties.author_count AS n, list_filter(list_transform(string_split(properties.author_list, ';'), lambda x: trim(x)), lambda x: x <> '') AS items FROM entities)
SELECT record_id, CASE WHEN n > 20 AND len(items) > 0 THEN array_to_string(items[1:5], '; ') || ' and ' || (n - len(items[1:5]))::VARCHAR || ' additional authors' ELSE names END AS preview FROM l""")
def author_list_cap(spark, d):
    return table(spark, d, "entities").select("record_id", P.author_preview(F.col("properties.author_list"), F.col("properties.author_count")).alias("preview"))


@_query(f"""WITH {_ALL} SELECT 'duplicate id' AS rule, id, count(*) AS n FROM records WHERE id IS NOT NULL GROUP BY 2 HAVING count(*) > 1
UNION ALL SELECT 'unknown type', id, count(*) FROM records WHERE {_KEYS} IS NULL GROUP BY 2
UNION ALL SELECT 'blank name', id, count(*) FROM records WHERE coalesce(trim(name), '') = '' GROUP BY 2
UNION ALL SELECT 'dangling subject', subject, count(*) FROM relations WHERE subject <> '' AND subject NOT IN (SELECT id FROM records WHERE id IS NOT NULL) GROUP BY 2
UNION ALL SELECT 'dangling object', object, count(*) FROM relations WHERE object <> '' AND object NOT IN (SELECT id FROM records WHERE id IS NOT NULL) GROUP BY 2""")
def referential_violations(spark, d):
    return P.violations(_records(spark, d), table(spark, d, "relations"))


@_query("""SELECT s.s_name AS subject, 'in_scope' AS predicate, r.r_name AS object FROM supplier s CROSS JOIN region r UNION ALL SELECT r.r_name, 'contains', s.s_name FROM supplier s CROSS JOIN region r""")
def scope_bidirectional_edges(spark, d):
    return P.scope_edges(table(spark, d, "supplier").select(F.col("s_name").alias("id")), table(spark, d, "region").select(F.col("r_name").alias("id")))


@_query("SELECT subject AS scope, count(DISTINCT object) AS n, min(object) AS first, max(object) AS last FROM relations WHERE predicate = 'contains' AND subject <> '' AND object <> '' GROUP BY 1")
def scope_members(spark, d):
    return P.scope_members(table(spark, d, "relations"))


# Plans. The live side is the desired one with some rows changed or missing.


def _live_customers(spark, d):
    rows = table(spark, d, "customer").where(F.col("c_custkey") % 11 != 0)
    return rows.select(F.col("c_name").alias("key"), F.when(F.col("c_custkey") % 7 == 0, "changed").otherwise(F.col("c_mktsegment")).alias("segment"), (F.col("c_acctbal") + F.when(F.col("c_custkey") % 5 == 0, 1).otherwise(0)).alias("balance"))


_PLAN = """plan AS (SELECT c_name AS key, CASE WHEN c_custkey % 11 = 0 THEN 'create' WHEN c_custkey % 7 = 0 OR c_custkey % 5 = 0 THEN 'update' ELSE 'unchanged' END AS action,
  CASE WHEN c_custkey % 11 = 0 THEN 'new' ELSE concat_ws(',', CASE WHEN c_custkey % 7 = 0 THEN 'segment' END, CASE WHEN c_custkey % 5 = 0 THEN 'balance' END) END AS reasons FROM customer)"""


def _plan(spark, d):
    want = table(spark, d, "customer").select(F.col("c_name").alias("key"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"))
    return P.upsert_plan(want, _live_customers(spark, d), "key", ["segment", "balance"])


@_query(f"WITH {_PLAN} SELECT * FROM plan")
def sync_plan_actions(spark, d):
    return _plan(spark, d)


@_query(f"WITH {_PLAN} SELECT unnest(string_split(reasons, ',')) AS reason, count(*) AS n FROM plan WHERE action = 'update' GROUP BY 1")
def change_reason_histogram(spark, d):
    return P.reason_histogram(_plan(spark, d))


_EDGES = "a AS (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem WHERE l_partkey % 7 <> 0), b AS (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem WHERE l_partkey % 11 <> 0)"


@_query(f"WITH {_EDGES} SELECT *, 'add' AS action FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT *, 'remove' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)")
def relation_set_diff(spark, d):
    rows = table(spark, d, "lineitem")
    return P.edge_plan(rows.where(F.col("l_partkey") % 7 != 0), rows.where(F.col("l_partkey") % 11 != 0), ["l_orderkey", "l_suppkey"])


@_query("""SELECT object, 'add' AS action FROM (SELECT object FROM relations WHERE subject = 'scope:survey-papers' AND object <> '' EXCEPT SELECT object FROM relations WHERE subject = 'scope:whole-library')
UNION ALL SELECT object, 'remove' FROM (SELECT object FROM relations WHERE subject = 'scope:whole-library' AND object <> '' EXCEPT SELECT object FROM relations WHERE subject = 'scope:survey-papers')""")
def collection_add_remove(spark, d):
    rows = table(spark, d, "relations").where(F.col("object") != "")
    return P.edge_plan(rows.where(F.col("subject") == "scope:survey-papers"), rows.where(F.col("subject") == "scope:whole-library"), ["object"])


@_query("SELECT count(*) FILTER (c_custkey % 11 <> 0) AS found, count(*) FILTER (c_custkey % 11 = 0) AS missing FROM customer")
def verify_found_missing(spark, d):
    return P.found_missing(table(spark, d, "customer").select(F.col("c_name").alias("key")), _live_customers(spark, d), "key")


@_query("SELECT record_id, id FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ingested_at, record_id) AS k FROM relations WHERE id <> '') WHERE k > 1")
def url_duplicates(spark, d):
    return P.later_duplicates(table(spark, d, "relations"), F.col("id"), ["ingested_at", "record_id"]).select("record_id", "id")


@_query("SELECT trim(name) AS name, count(*) AS n FROM entities WHERE trim(name) <> '' GROUP BY 1 HAVING count(*) > 1")
def duplicate_names(spark, d):
    return P.duplicate_names(table(spark, d, "entities"))


@_query(f"WITH e AS (SELECT DISTINCT subject, {_RELS} AS property, object FROM relations WHERE {_RELS} IS NOT NULL), p AS (SELECT property, subject, count(*) AS n FROM e GROUP BY 1, 2) SELECT property, count(*) AS subjects, sum(n)::BIGINT AS edges, max(n) AS widest FROM p GROUP BY 1")
def fanout_audit(spark, d):
    return P.fan_out(table(spark, d, "relations"))


@_query("""SELECT p_type AS type_key, p_brand AS property_key, CASE WHEN min(p_size) > 20 THEN 'create' WHEN max(p_size) > 45 THEN 'rename' ELSE 'unchanged' END AS action FROM part GROUP BY 1, 2""")
def schema_diff(spark, d):
    want = table(spark, d, "part").groupBy(F.col("p_type").alias("type_key"), F.col("p_brand").alias("property_key")).agg(F.max("p_size").alias("m"), F.min("p_size").alias("least"))
    live = want.where(F.col("least") <= 20).select("type_key", "property_key", F.when(F.col("m") > 45, "text").otherwise("number").alias("format"))
    return P.schema_plan(want.withColumn("format", F.lit("number")), live)


_LIVE = f"live AS (SELECT DISTINCT subject, predicate, object FROM relations WHERE subject <> '' AND object <> '' AND {_RELS} IS NOT NULL)"


def _pull(spark, d):
    """The store holds all projected edges under ids of its own; the graph lacks a fifth of them."""
    rel = table(spark, d, "relations").where((F.col("subject") != "") & (F.col("object") != "") & P.mapped(F.col("predicate"), P.RELATION_PROPERTIES).isNotNull())
    live = rel.select(F.sha1("subject").alias("object_id"), P.mapped(F.col("predicate"), P.RELATION_PROPERTIES).alias("property"), F.sha1("object").alias("target"))
    ids = _records(spark, d).select(F.sha1("id").alias("object_id"), "id").where(F.col("id").isNotNull()).distinct()
    return P.pull_edges(live, ids, rel.where(F.length("object") % 5 != 0))


@_query(f"WITH {_ALL}, {_LIVE} SELECT subject, predicate, object FROM live WHERE subject IN (SELECT id FROM records WHERE id IS NOT NULL) AND object IN (SELECT id FROM records WHERE id IS NOT NULL) AND length(object) % 5 = 0")
def pull_new_edges(spark, d):
    return _pull(spark, d).where(F.col("action") == "add").select("subject", "predicate", "object")


@_query(f"WITH {_ALL}, {_LIVE} SELECT subject, predicate, sha1(object) AS target FROM live WHERE subject IN (SELECT id FROM records WHERE id IS NOT NULL) AND object NOT IN (SELECT id FROM records WHERE id IS NOT NULL)")
def pull_unresolved(spark, d):
    return _pull(spark, d).where(F.col("action") == "unresolved").select("subject", "predicate", "target")


@_query(r"""WITH ids AS (SELECT p_partkey AS object_id, 'concept:store:' || coalesce(nullif(trim(regexp_replace(lower(trim(p_name)), '[^a-z0-9]+', '-', 'g'), '-'), ''), 'misc') AS id FROM part)
SELECT object_id, id, CASE WHEN object_id <> min(object_id) OVER (PARTITION BY id) OR id IN (SELECT id FROM concepts) THEN 'conflict' ELSE 'adopt' END AS action FROM ids""")
def concept_adoption(spark, d):
    live = table(spark, d, "part").select(F.col("p_partkey").alias("object_id"), F.lit("concept").alias("type_key"), F.col("p_name").alias("name"), F.lit("").alias("canonical_id"))
    return P.adopted_concepts(live, table(spark, d, "concepts"))


@_query(f"""WITH e AS (SELECT DISTINCT subject, {_RELS} AS property, object FROM relations WHERE {_RELS} IS NOT NULL),
live AS (SELECT DISTINCT id FROM entities WHERE length(id) % 7 <> 0 UNION SELECT id FROM concepts WHERE length(id) % 7 <> 0),
have AS (SELECT DISTINCT subject, {_RELS} AS property, object FROM relations WHERE {_RELS} IS NOT NULL AND record_id % 3 <> 0 UNION SELECT DISTINCT object, 'scopes', object FROM relations WHERE predicate = 'about' AND object IS NOT NULL),
rules AS (SELECT DISTINCT subject, property FROM e UNION SELECT id, 'scopes' FROM concepts WHERE id IS NOT NULL),
known AS (SELECT * FROM have WHERE subject IN (SELECT id FROM live)),
sound AS (SELECT * FROM e WHERE subject IN (SELECT id FROM live) AND object IN (SELECT id FROM live))
SELECT subject, property, sha1(object) AS target, 'add' AS action FROM (SELECT * FROM sound EXCEPT SELECT * FROM known)
UNION ALL SELECT subject, property, sha1(object), 'remove' FROM (SELECT known.* FROM known SEMI JOIN rules USING (subject, property) EXCEPT SELECT * FROM sound)
UNION ALL SELECT subject, property, object, 'unresolved' FROM e WHERE subject IN (SELECT id FROM live) AND (object IS NULL OR object NOT IN (SELECT id FROM live WHERE id IS NOT NULL))
UNION ALL SELECT subject, property, object, 'no subject' FROM e WHERE subject IS NULL OR subject NOT IN (SELECT id FROM live WHERE id IS NOT NULL)""")
def relation_plan(spark, d):
    """The store holds two thirds of the edges, stale scopes of concepts, and lacks some objects."""
    rel = table(spark, d, "relations")
    want = P.relation_targets(rel)
    ids = table(spark, d, "entities").select("id").union(table(spark, d, "concepts").select("id")).where(F.length("id") % 7 != 0).distinct()
    index = ids.select(F.col("id").alias("canonical_id"), F.sha1("id").alias("object_id"))
    have = P.relation_targets(rel.where(F.col("record_id") % 3 != 0)).unionByName(rel.where((F.col("predicate") == "about") & F.col("object").isNotNull()).select(F.col("object").alias("subject"), F.lit("scopes").alias("property"), "object").distinct())
    current = have.select(F.sha1("subject").alias("object_id"), "property", F.sha1("object").alias("target"))
    managed = table(spark, d, "concepts").where(F.col("id").isNotNull()).select(F.col("id").alias("subject"), F.lit("scopes").alias("property"))
    return P.relation_plan(want, managed, index, current)


@_query("""WITH marks AS (SELECT trim(id) AS url, min(record_id) AS bookmark_id FROM entities WHERE retracted_at IS NULL AND trim(id) <> '' GROUP BY 1)
SELECT DISTINCT doc_kind AS guide, trim(entity_id) AS url, bookmark_id FROM documents LEFT JOIN marks ON url = trim(entity_id) WHERE trim(entity_id) <> ''""")
def guide_bookmarks(spark, d):
    items = table(spark, d, "documents").select(F.col("doc_kind").alias("guide"), F.col("entity_id").alias("url"))
    marks = table(spark, d, "entities").select(F.col("id").alias("url"), F.col("record_id").alias("id"), F.col("retracted_at").isNotNull().alias("archived"))
    return P.guide_bookmarks(items, marks)


@_query("""WITH want AS (SELECT n_name AS name, n_nationkey AS k, (SELECT list(DISTINCT c_mktsegment) FROM customer WHERE c_nationkey = n_nationkey) AS tags, (SELECT list(DISTINCT s_name) FROM supplier WHERE s_nationkey = n_nationkey) AS related FROM nation),
live AS (SELECT name, k, (SELECT list(DISTINCT c_mktsegment) FROM customer WHERE c_nationkey = k AND (k % 2 = 0 OR c_mktsegment <> 'BUILDING')) AS tags, (SELECT list(DISTINCT s_name) FROM supplier WHERE s_nationkey = k AND (k % 3 > 0 OR s_suppkey % 2 = 0)) AS related FROM want WHERE k % 5 <> 0)
SELECT w.name, l.k AS page_id, CASE WHEN l.k IS NULL THEN 'new' ELSE concat_ws(',', CASE WHEN w.k % 4 = 1 THEN 'markdown' END, CASE WHEN list_sort(coalesce(w.tags, [])) <> list_sort(coalesce(l.tags, [])) THEN 'tags' END,
  CASE WHEN list_sort(coalesce(w.related, [])) <> list_sort(coalesce(l.related, [])) THEN 'related_bookmarks' END) END AS reasons FROM want w LEFT JOIN live l ON l.name = w.name""")
def guide_page_plan(spark, d):
    def pages(segments, suppliers, markdown):
        tags = segments.groupBy(F.col("c_nationkey").alias("id")).agg(F.collect_set("c_mktsegment").alias("tags"))
        related = suppliers.groupBy(F.col("s_nationkey").alias("id")).agg(F.collect_set("s_name").alias("related"))
        rows = table(spark, d, "nation").select(F.col("n_nationkey").alias("id"), "n_name", markdown.alias("markdown"))
        return rows.join(tags, "id", "left").join(related, "id", "left").withColumnRenamed("n_name", "name")

    customers, suppliers = table(spark, d, "customer"), table(spark, d, "supplier")
    want = pages(customers, suppliers, F.concat(F.lit("# "), "n_name"))
    live = pages(
        customers.where((F.col("c_nationkey") % 2 == 0) | (F.col("c_mktsegment") != "BUILDING")), suppliers.where((F.col("s_nationkey") % 3 > 0) | (F.col("s_suppkey") % 2 == 0)),
        F.when(F.col("n_nationkey") % 4 == 1, "old").otherwise(F.concat(F.lit("# "), "n_name", F.lit(" "))),
    ).where(F.col("id") % 5 != 0)
    return P.page_plan(want.drop("id"), live)


@_query("SELECT record_id AS id, name, 'archive' AS action FROM entities WHERE (name LIKE 'On %' OR name LIKE 'Late%') AND retracted_at IS NULL")
def archive_plan(spark, d):
    rows = table(spark, d, "entities").select(F.col("record_id").alias("id"), "name", F.col("retracted_at").isNotNull().alias("archived"))
    return P.archive_plan(rows, ["On ", "Late"])


@_query("SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 50")
def first_rows(spark, d):
    return P.first_rows(table(spark, d, "documents"), ["doc_id"], 50).select("doc_id", "lang")


@_query("SELECT scope, row_number() OVER (PARTITION BY scope ORDER BY member) AS position, member FROM (SELECT DISTINCT subject AS scope, object AS member FROM relations WHERE predicate = 'contains' AND subject <> '' AND object <> '')")
def scope_member_positions(spark, d):
    return P.member_positions(table(spark, d, "relations"))


@_query(f"""WITH e AS (SELECT DISTINCT subject, {_RELS} AS property, object FROM relations WHERE {_RELS} IS NOT NULL)
SELECT 'relations' AS part, count(*) AS n FROM e UNION ALL SELECT 'list_views', count(*) FROM (SELECT DISTINCT subject, object FROM relations WHERE predicate = 'contains' AND subject <> '' AND object <> '')
UNION ALL SELECT 'collections', count(*) FROM (SELECT DISTINCT subject, object FROM relations WHERE predicate = 'contains' AND subject <> '' AND object <> '')
UNION ALL SELECT 'objects', count(DISTINCT id) FROM entities WHERE id IS NOT NULL AND {_KEYS} IS NOT NULL""")
def manifest_sizes(spark, d):
    parts = P.manifest(table(spark, d, "entities"), table(spark, d, "relations"))
    counted = [(parts[p] if p != "objects" else parts[p].select("canonical_id").distinct()).agg(F.count(F.lit(1)).alias("n")).select(F.lit(p).alias("part"), "n") for p in ("relations", "list_views", "collections", "objects")]
    return counted[0].unionByName(counted[1]).unionByName(counted[2]).unionByName(counted[3])


@_query("SELECT count(DISTINCT properties.journal) AS kinds, sum(len(list_filter(string_split(properties.author_list, ';'), lambda x: trim(x) <> '')))::BIGINT AS items FROM entities")
def occurrence_counts(spark, d):
    return C.occurrence_counts(table(spark, d, "entities"), "properties.journal", X.split_list(F.col("properties.author_list")))


# Topics.


def _topic_sql(text: str) -> str:
    return "CASE " + " ".join(f"WHEN {' OR '.join(f'contains({text}, $${n}$$)' for n in needles)} THEN '{name}'" for name, needles in T.TOPICS) + f" ELSE '{T.GENERAL}' END"


_TOPIC = f"topics AS (SELECT doc_id, source, doc_kind, {_topic_sql('lower(text)')} AS topic FROM documents WHERE text IS NOT NULL)"


def _topics(spark, d):
    docs = table(spark, d, "documents").where(F.col("text").isNotNull())
    return docs.select("doc_id", "source", "doc_kind", T.topic(F.col("text")).alias("topic"))


@_query(f"WITH {_TOPIC} SELECT doc_id, topic FROM topics")
def topic_classify(spark, d):
    return _topics(spark, d).select("doc_id", "topic")


@_query(f"WITH {_TOPIC} SELECT topic, trim(regexp_replace(lower(topic), '[^a-z0-9]+', '-', 'g'), '-') AS slug, count(*) AS n FROM topics GROUP BY 1 HAVING count(*) >= 2")
def topic_clusters_min_items(spark, d):
    return T.clusters(_topics(spark, d), "topic")


@_query(f"""WITH {_TOPIC} SELECT topic, rank::INT AS rank, subtopic, n FROM (SELECT topic, subtopic, n, row_number() OVER (PARTITION BY topic ORDER BY n DESC, f) AS rank FROM (
  SELECT topic, source AS subtopic, count(*) AS n, min(doc_id) AS f FROM topics GROUP BY 1, 2)) WHERE rank <= 12""")
def subtopic_top12(spark, d):
    return T.subtopics(_topics(spark, d), "topic", "source", "doc_id")


@_query("""WITH t AS (SELECT p_brand, p_partkey, w, pos FROM (SELECT p_brand, p_partkey, unnest(string_split(p_name, ' ')) AS w, generate_subscripts(string_split(p_name, ' '), 1) AS pos FROM part) WHERE trim(w) <> ''),
f AS (SELECT p_brand, lower(w) AS k, arg_min(w, (p_partkey, pos)) AS tag, min((p_partkey, pos)) AS o FROM t GROUP BY 1, 2)
SELECT p_brand AS topic, rank::INT AS rank, tag FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY o) AS rank FROM f) WHERE rank <= 12""")
def guide_tags_first_seen(spark, d):
    rows = table(spark, d, "part").select("p_brand", "p_partkey", F.split("p_name", " ").alias("tags"))
    return T.guide_tags(rows, "p_brand", "tags", "p_partkey")


@_query("""SELECT doc_id, coalesce(nullif(trim(doc_kind), ''), nullif(trim(string_split(source, '-')[1]), ''), 'misc') AS topic FROM documents""")
def specific_topic(spark, d):
    rows = table(spark, d, "documents")
    return rows.select("doc_id", T.specific_topic(F.col("doc_kind"), F.split("source", "-"), F.col("source")).alias("topic"))


@_query("""WITH w AS (SELECT p_partkey, list_transform(string_split(p_name || ' ' || p_type, ' '), lambda x: trim(regexp_replace(lower(x), '[^a-z0-9]+', '_', 'g'), '_')) AS l FROM part),
u AS (SELECT p_partkey, x, min(pos) AS pos FROM (SELECT p_partkey, unnest(l) AS x, generate_subscripts(l, 1) AS pos FROM w) WHERE x <> '' GROUP BY 1, 2)
SELECT p_partkey, string_agg(x, ',' ORDER BY pos) AS keywords FROM (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY pos) AS k FROM u) WHERE k <= 7 GROUP BY 1""")
def keyword_normalize(spark, d):
    rows = table(spark, d, "part")
    return rows.select("p_partkey", F.array_join(T.keywords(F.split(F.concat_ws(" ", "p_name", "p_type"), " ")), ",").alias("keywords"))


@_query("SELECT coalesce(source, '') AS folder, count(*) AS n FROM documents GROUP BY 1")
def folder_histogram(spark, d):
    return T.histogram(table(spark, d, "documents"), F.col("source"), "folder")


@_query("SELECT CASE WHEN doc_kind IN ('knowledge_resource', 'tool', 'login_page', 'admin_page', 'other') THEN doc_kind ELSE 'other' END AS triage, count(*) AS n FROM documents GROUP BY 1")
def triage_histogram(spark, d):
    return T.histogram(table(spark, d, "documents"), T.triage(F.col("doc_kind")), "triage")


@_query("SELECT unnest(string_split(p_name, ' ')) AS tag, count(*) AS n FROM part GROUP BY 1")
def tag_histogram(spark, d):
    return T.histogram(table(spark, d, "part").select(F.explode(F.split("p_name", " ")).alias("t")), F.col("t"), "tag")


@_query("""SELECT doc_id, 'todo' AS state FROM documents WHERE entity_id IS NULL OR entity_id NOT IN (SELECT id FROM entities) UNION ALL SELECT doc_id, 'kept' FROM documents WHERE entity_id IN (SELECT id FROM entities)""")
def resume_anti_join(spark, d):
    docs, done = table(spark, d, "documents"), table(spark, d, "entities").select(F.col("id").alias("entity_id")).distinct()
    todo, kept = T.resumed(docs, docs.join(done, "entity_id", "left_semi"), "entity_id")
    return todo.select("doc_id", F.lit("todo").alias("state")).unionByName(kept.select("doc_id", F.lit("kept").alias("state")))


@_query("""WITH v AS (SELECT 't' || n_nationkey AS key, n_name AS name FROM nation), t AS (SELECT DISTINCT c_custkey, unnest([c_mktsegment, n_name, 't' || (c_nationkey + 20)]) AS tag FROM customer JOIN nation ON n_nationkey = c_nationkey)
SELECT c_custkey, tag, coalesce((SELECT min(key) FROM v WHERE lower(trim(name)) = lower(trim(tag))), (SELECT min(key) FROM v WHERE key = trim(tag)), '__missing__:' || trim(tag)) AS tag_key FROM t""")
def tag_vocabulary_lookup(spark, d):
    nation = table(spark, d, "nation")
    vocabulary = nation.select(F.concat(F.lit("t"), "n_nationkey").alias("key"), F.col("n_name").alias("name"))
    rows = table(spark, d, "customer").join(nation, F.col("n_nationkey") == F.col("c_nationkey"))
    tags = rows.select("c_custkey", F.array("c_mktsegment", "n_name", F.concat(F.lit("t"), (F.col("c_nationkey") + 20).cast("string"))).alias("tags"))
    return T.tag_keys(tags, "c_custkey", "tags", vocabulary)


@_query(f"""WITH topics AS (SELECT {_topic_sql('lower(text)')} AS topic, coalesce(source, 'misc') AS sub, doc_id::VARCHAR AS title, coalesce(entity_id, '-') AS url, doc_kind AS summary FROM documents WHERE text IS NOT NULL),
big AS (SELECT topic, trim(regexp_replace(lower(topic), '[^a-z0-9]+', '-', 'g'), '-') AS slug, count(*) AS n FROM topics GROUP BY 1 HAVING count(*) >= 2),
sizes AS (SELECT topic, sub, '1|' || lpad((1000000000 - count(*))::VARCHAR, 10, '0') || '|' || lower(sub) AS part FROM topics GROUP BY 1, 2)
SELECT topic, slug, '0' AS part, '# ' || topic || ' (' || n || ')' AS line FROM big
UNION ALL SELECT topic, slug, part, '## ' || sub FROM sizes JOIN big USING (topic)
UNION ALL SELECT t.topic, slug, part || '|' || lower(title), '- [' || title || '](' || url || ')' || coalesce(': ' || nullif(trim(summary), ''), '')
  FROM topics t JOIN sizes s ON s.topic = t.topic AND s.sub = t.sub JOIN big b ON b.topic = t.topic""")
def guide_sections(spark, d):
    docs = table(spark, d, "documents").where(F.col("text").isNotNull())
    rows = docs.select(T.topic(F.col("text")).alias("topic"), F.coalesce("source", F.lit("misc")).alias("sub"), F.col("doc_id").cast("string").alias("title"), F.coalesce("entity_id", F.lit("-")).alias("url"), F.col("doc_kind").alias("summary"))
    return T.guides(rows, "topic", "sub", "title", "url", "summary")


@_query("SELECT event_id, event_type, upper(event_type) AS label, NULL::VARCHAR AS ask_error FROM events")
def batch_positional_join(spark, d):
    return T.in_batches(table(spark, d, "events").select("event_id", "event_type"), lambda rows: [{"label": r["event_type"].upper()} for r in rows], "label string")


# Scalar functions.


@_query(f"SELECT id, '{NAMESPACES['resource']}' || url_encode(id) AS iri FROM entities WHERE id IS NOT NULL")
def resource_iri(spark, d):
    return table(spark, d, "entities").where(F.col("id").isNotNull()).select("id", F.substring(resource(F.col("id"), NAMESPACES["resource"]), 2, 100000).alias("iri"))


@_query("SELECT DISTINCT subject, object, 'relation:' || substr(sha256(subject || chr(0) || predicate || chr(0) || object), 1, 20) AS edge FROM relations WHERE subject IS NOT NULL AND predicate IS NOT NULL AND object IS NOT NULL")
def relation_digest_ids(spark, d):
    rows = table(spark, d, "relations").where(F.col("subject").isNotNull() & F.col("predicate").isNotNull() & F.col("object").isNotNull())
    return rows.select("subject", "object", X.digest_id("relation:", F.col("subject"), F.col("predicate"), F.col("object")).alias("edge")).distinct()


@_query("SELECT DISTINCT properties.source_url AS url, substr(sha1(properties.source_url), 1, 16) AS key FROM entities WHERE properties.source_url IS NOT NULL")
def cache_keys(spark, d):
    rows = table(spark, d, "entities").select(F.col("properties.source_url").alias("url")).where(F.col("url").isNotNull()).distinct()
    return rows.select("url", X.cache_key(F.col("url")).alias("key"))


# Where the two differ outside ASCII (the Kelvin sign and dotted I in lower case) no alias has such letters.
@_query(r"""SELECT record_id, coalesce(nullif(trim(regexp_replace(lower(trim(alias)), '[^a-z0-9]+', '-', 'g'), '-'), ''), 'misc') AS slug FROM aliases WHERE alias IS NOT NULL""")
def slug_text(spark, d):
    rows = table(spark, d, "aliases").where(F.col("alias").isNotNull())
    return rows.select("record_id", X.plain_slug(F.col("alias")).alias("slug"))


@_query(r"""SELECT record_id, coalesce(nullif(trim(regexp_replace(lower(regexp_replace(strip_accents(alias), '[^\x00-\x7f]', '', 'g')), '[^a-z0-9]+', '-', 'g'), '-'), ''), substr(sha256(alias), 1, 16)) AS slug FROM aliases WHERE alias IS NOT NULL""")
def slug_unicode(spark, d):
    return table(spark, d, "aliases").where(F.col("alias").isNotNull()).select("record_id", X.slug(F.col("alias")).alias("slug"))


@_query(r"""SELECT record_id, lower(regexp_replace(trim(identifiers['doi']), '^(https?://(dx\.)?doi\.org/|doi:\s*)', '', 'i')) AS doi, lower(regexp_replace(regexp_replace(trim(identifiers['arxiv']), '^arxiv:\s*', '', 'i'), 'v\d+$', '', 'i')) AS arxiv FROM entities""")
def identifier_normalize(spark, d):
    rows = table(spark, d, "entities")
    return rows.select("record_id", X.doi(F.try_element_at("identifiers", F.lit("doi"))).alias("doi"), X.arxiv_id(F.try_element_at("identifiers", F.lit("arxiv"))).alias("arxiv"))


@_query(r"""SELECT record_id, CASE WHEN contains(name_as_cited, ',') THEN trim(concat_ws(' ', trim(substr(name_as_cited, instr(name_as_cited, ',') + 1)), trim(split_part(name_as_cited, ',', 1)))) ELSE trim(name_as_cited) END AS name FROM entities WHERE name_as_cited IS NOT NULL""")
def author_name_flip(spark, d):
    return table(spark, d, "entities").where(F.col("name_as_cited").isNotNull()).select("record_id", X.given_first(F.col("name_as_cited")).alias("name"))


@_query("SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.k') IS NOT NULL AS has FROM events")
def json_props_extract(spark, d):
    v = F.try_variant_get(X.tolerant_json(F.col("props")), "$.k", "bigint")
    return table(spark, d, "events").select("event_id", v.alias("k"), v.isNotNull().alias("has"))


@_query("SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def tolerant_json(spark, d):
    said = F.concat(F.lit("Sure, here it is: "), "props", F.lit(" - done"))
    return table(spark, d, "events").select("event_id", F.try_variant_get(X.tolerant_json(said), "$.k", "bigint").alias("k"))


@_query("SELECT event_id, strftime(make_timestamp((epoch_us(ts) // 1000000) * 1000000), '%Y-%m-%d') AS day FROM events")
def epoch_to_date(spark, d):
    return table(spark, d, "events").select("event_id", X.epoch_date(F.unix_seconds(F.col("ts").cast("timestamp")).cast("string")).alias("day"))


@_query(r"SELECT record_id, CASE WHEN regexp_full_match(trim(alias), '\d+') THEN TRY_CAST(trim(alias) AS BIGINT) END AS n FROM aliases WHERE alias IS NOT NULL")
def guarded_int_cast(spark, d):
    rows = table(spark, d, "aliases").where(F.col("alias").isNotNull())
    return rows.select("record_id", X.guarded_int(F.col("alias")).alias("n"))


@_query("SELECT doc_id, substr(text, 1, 12000) AS snippet FROM documents")
def snippet_truncate(spark, d):
    return table(spark, d, "documents").select("doc_id", X.truncated(F.col("text")).alias("snippet"))


@_query(r"""SELECT record_id, array_to_string(list_filter(list_transform(regexp_split_to_array(properties.author_list, '(?i)\s+and\s+'), lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))), lambda x: x <> '' AND lower(x) <> 'others'), '|') AS names FROM entities WHERE properties.author_list IS NOT NULL""")
def author_split(spark, d):
    return table(spark, d, "entities").where(F.col("properties.author_list").isNotNull()).select("record_id", F.array_join(X.split_authors(F.col("properties.author_list")), "|").alias("names"))


@_query(f"SELECT record_id, {_TITLE} AS title, {_TITLE_KEY} AS key FROM entities WHERE name IS NOT NULL")
def title_clean(spark, d):
    return table(spark, d, "entities").where(F.col("name").isNotNull()).select("record_id", X.clean_title(F.col("name")).alias("title"), X.title_key(F.col("name")).alias("key"))


# Sinks.


@_query()
def bibtex_render(spark, d):
    from skeinmill.sinks.files import bibtex_entries

    papers = table(spark, d, "entities").where(F.col("type") == "Paper")
    return bibtex_entries(papers, ["Survey Collaboration"], "late", ["Wei"], "Survey")


def _quads_sql() -> str:
    """Every quad with its graph, as TriG writes it: names and properties of records, edges, aliases."""
    quote = lambda c: f"""'"' || replace(replace(replace(replace({c}, '\\', '\\\\'), '"', '\\"'), chr(10), '\\n'), chr(13), '\\r') || '"'"""
    iri = lambda base, c: f"'<{NAMESPACES[base]}' || url_encode({c}) || '>'"
    p = lambda base, name: f"'<{NAMESPACES[base]}{name}>'"
    expanded = f"""'<' || CASE split_part(rdf_type, ':', 1) {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in NAMESPACES.items())} END || substr(rdf_type, instr(rdf_type, ':') + 1) || '>'"""
    me, facts = iri("resource", "id"), []
    members = {"entities": _PROPS, "concepts": ("notation", "scheme", "description"), "scopes": ("scope_kind", "source_url")}
    for t, names in members.items():
        facts.append(f"SELECT source_refs, {me} AS s, {p('pkg', 'canonical_id')} AS p, {quote('id')} AS o FROM {t} WHERE id IS NOT NULL")
        facts.append(f"SELECT source_refs, {me}, {p('rdf', 'type')}, {expanded} FROM {t} WHERE id IS NOT NULL AND rdf_type <> ''")
        facts.append(f"SELECT source_refs, {me}, {p('schema', 'name')}, {quote('name')} FROM {t} WHERE id IS NOT NULL AND name <> ''")
        for m in names:
            whole = m in ("publication_year", "citation_count", "author_count")
            value = f"""'"' || properties.{m} || '"^^<http://www.w3.org/2001/XMLSchema#integer>'""" if whole else quote(f"properties.{m}")
            facts.append(f"SELECT source_refs, {me}, {p('pkg', m)}, {value} FROM {t} WHERE id IS NOT NULL AND properties.{m}::VARCHAR <> ''")
    facts.append(f"SELECT source_refs, {iri('resource', 'subject')}, '<{NAMESPACES['pkg']}' || predicate || '>', {iri('resource', 'object')} FROM relations WHERE trim(subject) <> '' AND trim(predicate) <> '' AND trim(object) <> ''")
    facts.append(f"SELECT source_refs, {iri('resource', 'entity_id')}, {p('schema', 'alternateName')}, {quote('alias')} FROM aliases WHERE alias <> '' AND entity_id <> ''")
    ids = "list_filter(list_transform(coalesce(source_refs, []), lambda r: r.source_id), lambda x: x IS NOT NULL AND x <> '')"
    return f"""WITH facts AS ({' UNION ALL '.join(facts)}),
quads AS (SELECT DISTINCT g, s, p, o FROM (SELECT unnest(CASE WHEN len({ids}) = 0 THEN [NULL] ELSE {ids} END) AS g, s, p, o FROM facts))
SELECT '{"u" + NAMESPACES["source"]}' || url_encode(g) AS g, CASE WHEN g IS NULL THEN s || ' ' || p || ' ' || o || ' .' ELSE {iri('source', 'g')} || ' {{ ' || s || ' ' || p || ' ' || o || ' . }}' END AS line FROM quads"""


@_query(_quads_sql())
def trig_render(spark, d):
    from skeinmill.operators.graph import trig_lines
    from skeinmill.plans.sparql_queries import graph

    return trig_lines(graph(spark, d).quads)


@_query(r"""SELECT doc_id, 0::INT AS pos, '# Page' || coalesce(chr(10) || chr(10) || nullif(trim(regexp_replace(text, '[\s\v\p{Z}\x1c-\x1f\x{85}]+', ' ', 'g')), ''), '') AS markdown FROM documents""")
def html_text_extract(spark, d):
    from skeinmill.sources.documents import parsed, html_to_markdown

    docs = table(spark, d, "documents").select("doc_id", F.concat(F.lit("<html><body><h1>Page</h1><p>"), F.coalesce("text", F.lit("")), F.lit("</p></body></html>")).alias("text"))
    return parsed(docs, lambda t: [{"markdown": html_to_markdown(t)}], "markdown string", "doc_id")
