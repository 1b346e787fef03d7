import pytest

from skeinmill.operators.graph import NAMESPACES, quad_counts, quads, trig_lines
from skeinmill.plans.ask import AskError, ask, clean_query, problems
from skeinmill.sparql import Dataset, SparqlError, parse, select
from skeinmill.sparql.compiler import rows, solutions

REF = "array<struct<source_id:string>>"


@pytest.fixture(scope="module")
def tables(spark):
    src = [("s1",)]
    e = spark.createDataFrame(
        [
            ("paper:1", "Paper", "bibo:AcademicArticle", "A", (12, "x"), src),
            ("paper:2", "Paper", "bibo:AcademicArticle", "B", (3, ""), src + [("s2",)]),
            ("paper:3", "Paper", "bibo:AcademicArticle", "C", (None, None), []),
            ("inst:1", "Institution", "schema:Organization", "Big Collaboration", (None, None), src),
            ("person:1", "Person", "foaf:Person", "Ada", (None, None), src),
            ("person:2", "Person", "foaf:Person", "Bob", (None, None), src),
        ],
        f"id string, type string, rdf_type string, name string, properties struct<citation_count:bigint,note:string>, source_refs {REF}",
    )
    r = spark.createDataFrame(
        [
            ("r1", "paper:1", "corporate_authored_by", "inst:1", src), ("r2", "paper:1", "authored_by", "person:1", src), ("r3", "paper:1", "authored_by", "person:2", src),
            ("r4", "paper:2", "authored_by", "person:1", src), ("r5", "paper:2", "cites", "paper:1", src), ("r6", "paper:3", "cites", "paper:2", src), ("r7", "paper:1", "cites", "paper:3", src),
            ("r8", "paper:1", None, "paper:3", src), ("r9", "paper:1", "cites", " ", src),
        ],
        f"id string, subject string, predicate string, object string, source_refs {REF}",
    )
    a = spark.createDataFrame([("a1", "person:1", "Ada L.", src), ("a2", "person:1", None, src), ("a3", None, "x", src)], f"id string, entity_id string, alias string, source_refs {REF}")
    return e, r, a


@pytest.fixture(scope="module")
def data(tables):
    e, r, a = tables
    return Dataset(quads([e], r, a).cache())


def run(data, query):
    return sorted(rows(solutions(data, query, NAMESPACES)), key=str)


def test_four_patterns_keep_the_integer(data):
    got = run(data, 'SELECT ?n ?c WHERE { ?p a bibo:AcademicArticle ; schema:name ?n ; pkg:citation_count ?c ; pkg:corporate_authored_by ?o . ?o schema:name "Big Collaboration" }')
    assert got == [{"n": "A", "c": 12}]


def test_unbound_is_left_out(data):
    got = run(data, "SELECT ?n ?c WHERE { ?p a bibo:AcademicArticle ; schema:name ?n OPTIONAL { ?p pkg:citation_count ?c FILTER(?c > 5) } }")
    assert got == [{"n": "A", "c": 12}, {"n": "B"}, {"n": "C"}]


def test_join_on_unbound_is_compatible(data):
    got = run(data, "SELECT ?n ?c WHERE { ?p schema:name ?n ; a bibo:AcademicArticle OPTIONAL { ?p pkg:citation_count ?c } VALUES ?c { 3 } }")
    assert got == [{"n": "B", "c": 3}, {"n": "C", "c": 3}]


def test_closure_ends_on_cycles(data):
    got = run(data, "SELECT ?a ?b WHERE { ?x pkg:cites+ ?y . ?x schema:name ?a . ?y schema:name ?b }")
    assert len(got) == 9
    assert run(data, 'SELECT ?b WHERE { ?x schema:name "B" . ?x pkg:cites* ?y . ?y schema:name ?b }') == [{"b": "A"}, {"b": "B"}, {"b": "C"}]


def test_negated_property_set_and_optional_step(data):
    assert len(run(data, "SELECT ?o WHERE { ?s a foaf:Person . ?s !(schema:name|rdf:type|pkg:canonical_id) ?o }")) == 1
    assert len(run(data, 'SELECT ?y WHERE { ?x schema:name "A" . ?x pkg:cites? ?y }')) == 2


def test_graphs(data):
    got = run(data, "SELECT ?g WHERE { GRAPH ?g { ?p schema:name \"B\" } }")
    assert [x["g"].rsplit("/", 1)[1] for x in got] == ["s1", "s2"]
    assert run(data, 'SELECT ?g WHERE { GRAPH ?g { ?p schema:name "C" } }') == []
    assert run(data, 'SELECT (COUNT(*) AS ?n) WHERE { ?p schema:name "B" }') == [{"n": 1}]


def test_aggregates(data):
    got = run(data, "SELECT (COUNT(*) AS ?n) (SUM(?c) AS ?s) (AVG(?c) AS ?a) (MIN(?c) AS ?lo) (MAX(?c) AS ?hi) WHERE { ?p pkg:citation_count ?c }")
    assert got == [{"n": 2, "s": 15, "a": 7.5, "lo": 3, "hi": 12}]
    assert run(data, "SELECT (COUNT(?p) AS ?n) WHERE { ?p pkg:nothing ?c }") == [{"n": 0}]


def test_expressions(data):
    one = lambda e: run(data, f"SELECT ({e} AS ?x) WHERE {{ ?p schema:name \"A\" }}")[0].get("x")
    assert one("1 + 2 * 3") == 7 and one("7 / 2") == 3.5 and one("1 / 0") is None and one("-(3)") == -3
    assert one('STRLEN("häß")') == 3 and one('SUBSTR("hello", 2, 3)') == "ell" and one('STRAFTER("a-b-c", "-")') == "b-c" and one('STRBEFORE("abc", "x")') == ""
    assert one('REPLACE("abc", "B", "_", "i")') == "a_c" and one('REGEX("abc", "^B", "i")') is False and one('ENCODE_FOR_URI("a b*~")') == "a%20b%2A~"
    assert one('LANG("a"@en)') == "en" and one('LANGMATCHES(LANG("a"@en-gb), "en")') is True and one("ISIRI(schema:name)") is True and one("ISNUMERIC(\"1\")") is False
    assert one("1 = 1.0") is True and one("sameTerm(1, 1.0)") is False and one('"a" IN ("b", "a")') is True and one("3 NOT IN (1, 2)") is True
    assert one('YEAR(STRDT("2024-05-06", schema:Date))') == 2024 and one("ROUND(2.5)") == 3 and one("ABS(-2)") == 2
    assert one('MD5("a")') == "0cc175b9c0f1b6a831c399e269772661" and one('IF(false, 1, "no")') == "no" and one("COALESCE(?nope, 5)") == 5 and one("BOUND(?nope)") is False


def test_minus_without_shared_variables_removes_nothing(data):
    assert len(run(data, "SELECT ?p WHERE { ?p a foaf:Person MINUS { ?x a bibo:AcademicArticle } }")) == 2


def test_refused(data):
    for q in ("ASK { ?s ?p ?o }", "SELECT ?x WHERE { ?x nope:y ?z }", "SELECT ?x { SERVICE <http://x/> { ?x ?y ?z } }", "SELECT ?x WHERE { ?x ", "CONSTRUCT { ?s ?p ?o } WHERE { ?s ?p ?o }"):
        with pytest.raises(SparqlError):
            parse(q, NAMESPACES)


def test_types_are_cast(data):
    df = select(data, "SELECT ?c WHERE { ?p pkg:citation_count ?c }", NAMESPACES, {"c": "bigint"})
    assert df.dtypes == [("c", "bigint")]


def test_counts_and_trig(data):
    n = quad_counts(data.quads).first()
    assert n["named_graphs"] == 2 and n["triples"] == data.quads.select("s", "p", "o").distinct().count()
    lines = [r["line"] for r in trig_lines(data.quads).collect()]
    assert len(lines) == data.quads.distinct().count() and any('"12"^^<http://www.w3.org/2001/XMLSchema#integer>' in x for x in lines)


def test_predicate_reaches_the_scan(spark, data, tmp_path):
    from skeinmill.operators.graph import write_quads

    write_quads(data.quads, str(tmp_path / "q"))
    df = select(Dataset(spark.read.parquet(str(tmp_path / "q")).select("g", "s", "p", "o")), "SELECT ?n WHERE { ?s schema:name ?n }", NAMESPACES)
    assert "PartitionFilters: [isnotnull(p" in df._jdf.queryExecution().toString()
    assert df.count() == 6


def test_ask(tables, data):
    e, r, _ = tables
    said = []

    def llm(answers):
        it = iter(answers)
        return lambda messages: said.append(len(messages)) or next(it)

    good = "```sparql\nPREFIX x: <y>\nSELECT ?n WHERE { ?p schema:name ?n ; pkg:citation_count ?c }\n```"
    report = ask("Which?", data, e, r, llm([good]))
    assert report["row_count"] == 2 and report["attempts"] == 1
    assert ask("Which?", data, e, r, llm(["SELECT ?n { ?p pkg:nope ?n }", good]))["attempts"] == 2
    assert ask("Which?", data, e, r, llm(['SELECT ?n { ?p schema:name "zz" ; pkg:canonical_id ?n }'] * 2))["row_count"] == 0
    with pytest.raises(AskError):
        ask("Which?", data, e, r, llm(["SELECT ?n { ?p pkg:nope ?n }"] * 3), max_repairs=2)
    with pytest.raises(AskError):
        clean_query("UNANSWERABLE")
    assert problems("SELECT ?x { ?x pkg:known ?y }", {"known"}) == []


def test_no_nested_loop_where_all_is_bound(spark):
    rows = [(None, f"us{k}", f"up{j}", f"uo{k % 3}") for k in range(9) for j in range(3)]
    data = Dataset(spark.createDataFrame(rows, "g string, s string, p string, o string"))
    q = "SELECT * WHERE { ?s <p0> ?a OPTIONAL { ?s <p1> ?b } ?t <p2> ?b OPTIONAL { ?t <p0> ?c } ?u <p1> ?c }"
    df = solutions(data, q)
    assert df.count() == 9 * 3 * 3
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_unbound_variables_meet_everything(spark):
    rows = [(None, "us1", "up", "ua"), (None, "us2", "up", "ub"), (None, "us1", "uq", "uc"), (None, "uc", "un", "sx"), (None, "ud", "un", "sy")]
    data = Dataset(spark.createDataFrame(rows, "g string, s string, p string, o string"))
    got = sorted(tuple(r) for r in solutions(data, "SELECT ?s ?v ?n WHERE { ?s <p> ?o OPTIONAL { ?s <q> ?v } ?v <n> ?n }").collect())
    assert got == [("us1", "uc", "sx"), ("us2", "uc", "sx"), ("us2", "ud", "sy")]
    left = sorted(tuple(r) for r in solutions(data, "SELECT ?s ?n WHERE { ?s <p> ?o OPTIONAL { ?s <q> ?v } OPTIONAL { ?v <n> ?n } }").collect())
    assert left == [("us1", "sx"), ("us2", "sx"), ("us2", "sy")]
    kept = sorted(r[0] for r in solutions(data, "SELECT ?s WHERE { ?s <p> ?o OPTIONAL { ?s <q> ?v } MINUS { ?v <n> ?n } }").collect())
    assert kept == ["us2"]
