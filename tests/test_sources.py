"""Sources, builders, sinks, merging and streaming on small inputs."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from skeinmill.functions import text as X
from skeinmill.operators import merge as M
from skeinmill.operators import project as P
from skeinmill.operators import resolve as R
from skeinmill.operators import topics as T
from skeinmill.plans import commands as C
from skeinmill.sinks import files
from skeinmill.sources import builders as B
from skeinmill.sources import documents as D
from skeinmill.sources import profile, records, rest
from skeinmill.streaming import ingest

BIB = """Some prose first.
@article{Smith:2020ab,
  author = "Smith, Ann and Jones, Bob and others",
  collaboration = {Survey},
  title = {{The {CMB} anisotropy}},
  eprint = "2001.00001v2", archivePrefix = {arXiv}, primaryClass = "astro-ph.CO", year = 2020, doi = "10.1/AbC"
}
@misc(k2, title = {A, B "and" C}, author = {Jones, Bob})
"""
TALKS = """# Programme

## Table of Contents
1. x

## Dark things

### First talk
**Authors:** Ann Smith (Uni A); Bob Jones (not stated)

An abstract
of two lines.

---

### Second talk
**Authors:** Ann Smith (Uni A)

Another.

## Waves
### Third talk
**Authors:** Eve (Uni B)

More.

---
*A closing note.*
"""
MARKS = """<!DOCTYPE NETSCAPE-Bookmark-file-1>
<DL><p>
    <DT><H3>Science</H3>
    <DL><p>
        <DT><A HREF="https://a.example/x?y=1&amp;z=2" ADD_DATE="86400">A &amp; B</A>
        <DD>About A
        <DT><H3>Deep</H3>
        <DL><p>
            <DT><A HREF="http://b.example/" ADD_DATE="soon">B</A>
            <DT><A HREF="javascript:x()">no</A>
        </DL><p>
    </DL><p>
    <DT><A HREF="https://c.example/">C</A>
</DL><p>
"""


def docs(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc int, text string")


def test_bibtex(spark):
    got = D.bibtex(docs(spark, BIB, None, ""), "doc").orderBy("pos").collect()
    assert [(r["entry_type"], r["citation_key"]) for r in got] == [("article", "Smith:2020ab"), ("misc", "k2")]
    assert got[0]["fields"]["title"] == "The {CMB} anisotropy" and got[1]["fields"]["title"] == 'A, B "and" C'
    for bad in ("nothing", "@article{x, title = {never closed", "@article{x, title}", "@article{ , title = {t}}", "@misc{, a = 1}"):
        with pytest.raises(D.SourceError):
            D.parse_bibtex(bad)


def test_bibtex_records_and_idempotence(spark):
    got = B.from_bibtex(D.bibtex(docs(spark, BIB), "doc"), "bib:1")
    ids = {r["id"] for r in got["entities"].collect()}
    assert {"paper:doi:10.1/abc", "paper:bibtex:k2", "person:name:ann-smith", "person:name:bob-jones", "institution:name:survey-collaboration"} == ids
    assert got["relations"].count() == 3 + 1 + 1 and got["concepts"].count() == 1
    old = got["relations"]
    merged, report = M.merge_source(old, got["relations"], ["bib:1"])
    assert report.first()["changed"] is False and merged.count() == old.count()
    gone, _ = M.merge_source(old, old.limit(0), ["bib:1"])
    assert gone.count() == 0


def test_talks(spark):
    got = D.parse_talks(TALKS)
    assert [(t["track"], t["title"]) for t in got] == [("Dark things", "First talk"), ("Dark things", "Second talk"), ("Waves", "Third talk")]
    assert got[0]["authors"] == [{"name": "Ann Smith", "affiliation": "Uni A"}, {"name": "Bob Jones", "affiliation": None}]
    r = B.from_talks(D.talks(docs(spark, TALKS), "doc"), "prog", "event:conference:x", "Conference X", "x", location="L")
    assert r["entities"].groupBy("type").count().rdd.collectAsMap() == {"Event": 1, "Talk": 3, "Person": 3, "Institution": 2}
    assert r["relations"].groupBy("predicate").count().rdd.collectAsMap() == {"presented_at": 3, "about": 3, "presented_by": 4, "affiliated_with": 2}
    ends = P.violations(r["entities"].select("id", "type", "name").unionByName(r["concepts"].select("id", "type", "name")), r["relations"])
    assert ends.count() == 0


def test_bookmarks():
    got = D.parse_bookmarks(MARKS)
    assert [(b["title"], b["url"], b["folder_path"], b["date_added"], b["description"]) for b in got] == [
        ("A & B", "https://a.example/x?y=1&z=2", "Science", "1970-01-02", "About A"),
        ("B", "http://b.example/", "Science > Deep", "", ""),
        ("C", "https://c.example/", "Uncategorized", "", ""),
    ]


def test_descriptions_of_folders_are_not_those_of_links():
    got = D.parse_bookmarks('<DL><p>\n<DT><A HREF="https://a.example/">A</A>\n<DT><H3>Deep</H3>\n<DD>about the folder\n<DL><p>\n<DT><A HREF="https://b.example/">B</A>\n<DD>about B,\nin two lines\n</DL><p>\n<DD>of nothing\n<DT><A HREF="ftp://c">C</A><DD>no link\n</DL>')
    assert [(b["title"], b["folder_path"], b["description"]) for b in got] == [("A", "Uncategorized", ""), ("B", "Deep", "about B, in two lines")]


def test_last_value_of_each_field_in_a_batch(spark):
    text = "@article{k, year = {2001}, journal = {One}}\n@article{k, year = {2002}, volume = {7}}"
    found = {r["id"]: r["properties"] for r in B.from_bibtex(D.bibtex(docs(spark, text), "doc").withColumnRenamed("doc", "_doc"), "bib:1")["entities"].collect()}
    got = found["paper:bibtex:k"]
    assert (got["publication_year"], got["journal"], got["volume"]) == ("2002", "One", "7")


def test_map_properties_on_any_session(spark):
    before = spark.conf.get("spark.sql.mapKeyDedupPolicy")
    spark.conf.set("spark.sql.mapKeyDedupPolicy", "EXCEPTION")
    try:
        rows = spark.createDataFrame([("a", 1, {"x": "1", "y": "1"}), ("a", 2, {"x": "2", "z": None}), ("b", 1, None), ("c", 1, {})], "id string, record_id int, properties map<string,string>")
        got = {r["id"]: r["properties"] for r in M.merged(rows, order=["record_id"]).collect()}
        assert got == {"a": {"x": "2", "y": "1"}, "b": {}, "c": {}}
    finally:
        spark.conf.set("spark.sql.mapKeyDedupPolicy", before)


def empty_tables(spark):
    refs = "source_refs array<struct<source_id:string,citation_key:string,source_url:string>>"
    entity = f"id string, type string, rdf_type string, name string, identifiers map<string,string>, properties map<string,string>, {refs}"
    shapes = {"entities": entity, "concepts": entity, "relations": f"id string, subject string, predicate string, object string, {refs}", "aliases": f"id string, alias string, kind string, entity_id string, {refs}"}
    return {k: spark.createDataFrame([], v) for k, v in shapes.items()}


def test_a_program_in_one_call(spark):
    talk = "### Talk {n} of {t}\n**Authors:** Ann Smith (Uni A); Person {n} (not stated)\nAbstract {n}.\n---\n"
    text = "# P\n## Table of Contents\n- x\n" + "".join(f"## Track {t}\n" + "".join(talk.format(n=n, t=t) for n in range(7)) for t in range(3))
    tables, report = C.ingest_talks(empty_tables(spark), docs(spark, text), "prog:1", "event:x", "X", "x")
    counts = {r["table_name"]: (r["before"], r["after"], r["changed"]) for r in report.collect()}
    # 21 talks, 8 people, one place, one event; 3 tracks; 21 + 21 + 42 edges of talks and one affiliation.
    assert counts == {"entities": (0, 31, True), "concepts": (0, 3, True), "relations": (0, 85, True), "aliases": (0, 8, True)}
    assert P.violations(tables["entities"].select("id", "type", "name").unionByName(tables["concepts"].select("id", "type", "name")), tables["relations"]).count() == 0
    again, report = C.ingest_talks(tables, docs(spark, text), "prog:1", "event:x", "X", "x")
    assert all(not r["changed"] for r in report.collect())
    gone, _ = C.ingest(again, {}, ["prog:1"])
    assert all(t.count() == 0 for t in gone.values())


def test_works_with_scope_and_bounded_coauthors(spark):
    works = spark.createDataFrame([("w1", "Title", "article", "2001", {"doi": "10.1/a"}), ("w2", "Other", "article", "2002", {"arxiv": "2001.00001"})], "put_code string, title string, entry_type string, year string, identifiers map<string,string>")
    people = spark.createDataFrame([("paper:doi:10.1/a", "Smith, Ann; Own, Me; The X Collaboration; " + "; ".join(f"N{k}, F" for k in range(30)), 33)], "id string, author_list string, author_count long")
    own = R.is_researcher(F.col("author"), "Own", ["Me", "M."])
    tables, report = C.ingest_works(empty_tables(spark), works, "orcid:1", "mine=collection:My papers", people, own)
    names = {r["name"] for r in tables["entities"].where("type = 'Person'").collect()}
    assert names == {"Ann Smith", "F N0", "F N1", "F N2", "F N3"}
    kinds = {r["predicate"]: r["n"] for r in tables["relations"].groupBy("predicate").agg(F.count("*").alias("n")).collect()}
    assert kinds == {"authored_by": 5, "in_scope": 2, "contains": 2} and tables["entities"].where("id = 'scope:mine' AND name = 'My papers'").count() == 1


def test_runs_over_the_tables(spark):
    from skeinmill.session import table

    tables = {t: table(spark, "/root/testdata/sf0.001", t) for t in C.TABLES}
    corporate = R.is_corporate(F.col("name"), F.col("properties.author_list"), ["Survey Collaboration"], "late")
    small = {"relations": tables["relations"].select("id", "subject", "predicate", "object", "source_refs"), "entities": tables["entities"]}
    out, report = C.reconcile(small, corporate, "institution:name:s")
    assert report.first()["changed"]
    sources = {r["s"]: r["n"] for r in out["relations"].select(F.explode("source_refs.source_id").alias("s")).groupBy("s").agg(F.count("*").alias("n")).collect()}
    people = R.bounded_authors(tables["entities"].where("type = 'Paper' AND properties.author_list IS NOT NULL"), "properties.author_list", "id", "properties.author_count")
    assert sources["derived:bounded-authors"] == R.author_edges(people, "x").count() > 0
    again, report = C.reconcile({**small, **out}, corporate, "institution:name:s")
    assert not report.first()["changed"] and again["relations"].count() == out["relations"].count()
    made = C.materialize(tables)
    assert made["list_views"].count() == made["collections"].count() and made["relations"].count() > 0 and made["violations"].count() > 0
    papers = C.export_bibtex(tables, ["Survey Collaboration"], "late", ["Wei"], "Survey", "institution:name:s")
    assert papers.count() > 0
    live = spark.createDataFrame([("o1", "concept", "New Idea", None), ("o2", "concept", "new idea", "")], "object_id string, type_key string, name string, canonical_id string")
    edges = spark.createDataFrame([("o1", "broader", "o3"), ("o1", "broader", "o9")], "object_id string, property string, target string")
    got = C.pull(tables, live, edges, spark.createDataFrame([("o3", "concept:x:y")], "object_id string, id string"))
    assert sorted((r["object_id"], r["action"]) for r in got["concepts"].collect()) == [("o1", "adopt"), ("o2", "conflict")]
    assert {(r["subject"], r["object"], r["target"], r["action"]) for r in got["edges"].collect()} == {("concept:store:new-idea", None, "o9", "unresolved"), ("concept:store:new-idea", "concept:x:y", "o3", "add")}


def test_tables_survive_a_broken_write(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(3).select(F.col("id").cast("string"))
    assert files.write_if_changed(rows, path) and not files.write_if_changed(rows, path)
    (tmp_path / "t").rename(tmp_path / "t.old")
    assert not files.write_if_changed(rows, path) and (tmp_path / "t").exists()
    assert C.stored({"t": rows.limit(1)}, str(tmp_path), dry_run=True) == {"t": True} and spark.read.parquet(path).count() == 3


def test_html_to_markdown():
    got = D.html_to_markdown("<html><head><title>x</title></head><body><h2>Head</h2><p>a &amp; <a href='/u'>b</a><script>var p='</p>'</script><ul><li>one<li>two</ul></body>")
    assert got == "## Head\n\na & [b](/u)\n\n- one\n- two"


def test_strict_and_lenient_json_lines(spark, tmp_path):
    p = tmp_path / "e.jsonl"
    p.write_text('{"id": "a", "name": "x y"}\n\n{"id": "b"}\n')
    schema = "id string, name string"
    assert records.jsonl(spark, str(p), schema).count() == 2
    p.write_text('{"id": "a"}\n{"name": "no id"}\n')
    with pytest.raises(Exception, match="not a record with an id"):
        records.jsonl(spark, str(p), schema).collect()
    assert records.jsonl(spark, str(p), schema, strict=False).count() == 2
    assert records.jsonl(spark, str(tmp_path / "none"), schema, missing="empty").count() == 0


def test_json_lines_are_canonical(spark, tmp_path):
    df = spark.createDataFrame([("b", {"z": "é", "a": "1"}, None), ("a", {}, "n")], "id string, properties map<string,string>, name string")
    files.write_json_lines(df, str(tmp_path / "out"))
    lines = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*"))).splitlines()
    assert lines == ['{"id": "a", "name": "n", "properties": {}}', '{"id": "b", "properties": {"a": "1", "z": "é"}}']


def test_write_if_changed(spark, tmp_path):
    df, path = spark.range(5), str(tmp_path / "t")
    assert files.write_if_changed(df, path, dry_run=True) and not Path(path).exists()
    assert files.write_if_changed(df, path) and not files.write_if_changed(df.orderBy(F.desc("id")), path)
    assert files.write_if_changed(df.limit(4), path) and spark.read.parquet(path).count() == 4


def test_merge_and_retract(spark):
    schema = "id string, name string, properties struct<a:string,b:bigint>, source_refs array<struct<source_id:string>>, ingested_at int"
    rows = spark.createDataFrame([("x", "first", ("1", None), [("s1",)], 1), ("x", "second", ("2", 5), [("s2",)], 2), ("x", "third", (None, None), None, 3), (None, "n", None, [], 1)], schema)
    got = M.merged(rows, order=["ingested_at"]).collect()
    assert len(got) == 1 and (got[0]["name"], tuple(got[0]["properties"]), [r[0] for r in got[0]["source_refs"]]) == ("first", ("2", 5), ["s1", "s2"])
    assert M.retracted(rows, ["s1"]).count() == 1 and M.merged(rows.limit(0), order=["ingested_at"]).count() == 0


def test_scopes_and_titles():
    assert B.parse_scope("my-papers=library:My Papers") == ("my-papers", "library", "My Papers") and B.parse_scope("cosmo_26") == ("cosmo_26", "collection", "Cosmo 26")
    with pytest.raises(ValueError):
        B.parse_scope("=x")


def test_scalars(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first()["x"]
    assert one(X.slug(F.lit("Ésta señal ﬁ²"))) == "esta-senal-fi2" and len(one(X.slug(F.lit("Ω")))) == 16
    assert one(X.doi(F.lit(" https://dx.doi.org/10.1/AB"))) == "10.1/ab" and one(X.arxiv_id(F.lit("arXiv:2001.00001V3"))) == "2001.00001"
    assert one(X.given_first(F.lit("de la Cruz, Ana"))) == "Ana de la Cruz" and one(X.title_key(F.lit("A <i>b</i> &amp; C – d"))) == "a b c d"
    assert one(X.clean_title(F.lit("H<sub>0</sub>  &lt; 70"))) == "H0 < 70" and one(X.guarded_int(F.lit("12a"))) is None and one(X.epoch_date(F.lit("x"))) == ""
    assert one(X.author_value(F.lit("A, B; Big Collaboration"), ["Big Collaboration"])) == "A, B and {Big Collaboration}"
    assert len(one(X.short_slug(F.lit("what is " * 20)))) <= 50


def recorded():
    """A callable with recorded answers, local so that it travels to the workers by value."""

    def rest_get(path, params):
        if path.endswith("/works"):
            ids = lambda *x: {"external-id": [{"external-id-type": t, "external-id-value": v, "external-id-relationship": r} for t, v, r in x]}
            return {"group": [{"work-summary": [
                {"put-code": 1, "display-index": "1", "title": {"title": {"value": "Old"}}, "external-ids": ids(("doi", "10.1/x", "self"))},
                {"put-code": 2, "display-index": "2", "title": {"title": {"value": "New"}}, "type": "journal-article", "publication-date": {"year": {"value": "2020"}}, "external-ids": ids(("arxiv", "2001.00001", "self"), ("doi", "10.9/no", "part-of"))},
            ]}]}
        if path == "literature":
            hits = [{"id": str(i), "metadata": {"titles": [{"title": f"T{i}"}], "texkeys": [f"K:{i}"], "authors": [{"full_name": f"Author, {c}"} for c in "ABCDEFGH"], "citation_count": i}} for i in range(5)]
            n, page = params["size"], params["page"]
            return {"hits": {"total": 5, "hits": hits[(page - 1) * n : page * n]}}
        docs = {'identifier:"10.1/x"': [{"bibcode": "b1", "title": ["H<sub>0</sub>"], "author": ["A", "B", "C"], "citation_count": 7, "year": "2021"}], "title:(found by words)": [{"bibcode": "b2", "title": ["Found: by words"]}], 'identifier:"dup"': [{}, {}]}
        return {"response": {"docs": docs.get(params["q"], [])}}

    return rest_get


def test_rest_sources(spark):
    works = rest.researcher_works(spark, recorded(), "0000")
    assert [(r["put_code"], r["title"], r["identifiers"]) for r in works.collect()] == [("2", "New", {"arxiv": "2001.00001"})]
    known = spark.createDataFrame([("paper:doi:10.1/z", {"arxiv": "arXiv:2001.00001v1"})], "id string, identifiers map<string,string>")
    assert [r["id"] for r in B.from_works(works, known, "orcid:1")["entities"].collect()] == ["paper:doi:10.1/z"]
    hits = rest.literature_hits(spark, recorded(), "x", size=2)
    assert hits.count() == 5 and hits.select("page").distinct().count() == 3
    built = B.from_hits(hits, "inspire:x", researcher="H Author")
    assert built["entities"].where("type = 'Person'").count() == 6 and built["relations"].count() == 30


def test_lookup_and_enrichment(spark):
    rows = spark.createDataFrame([("p1", {"doi": "10.1/x"}, "t"), ("p2", {}, "found by WORDS"), ("p3", None, None)], "id string, identifiers map<string,string>, name string")
    got = rest.looked_up(rows, "id", "identifiers", "name", recorded())
    assert {r["id"]: (r["bibcode"], r["citation_count"]) for r in got.collect()} == {"p1": ("b1", 7), "p2": ("b2", None)}
    props = {(r["id"], r["property"]): r["value"] for r in rest.enriched(rows, got).collect()}
    assert props[("p1", "name")] == "H0" and props[("p1", "author_list")] == "A; B; C" and ("p1", "doi") not in props
    with pytest.raises(Exception, match="ambiguous"):
        rest.looked_up(spark.createDataFrame([("p", {"doi": "dup"}, "t")], rows.schema), "id", "identifiers", "name", recorded()).collect()


def test_all_hits_of_a_title_are_compared(spark):
    def get(path, params):
        other = [{"bibcode": f"o{i}", "title": [f"Dark matter {i}"]} for i in range(4)]
        docs = {'title:"Dark matter"': [*other, {"bibcode": "b5", "title": ["Dark Matter"]}], 'title:"Two"': [{"bibcode": "t1", "title": ["Two"]}, *other, {"bibcode": "t2", "title": ["Two."]}], "title:(two)": [{"bibcode": "t1", "title": ["Two"]}]}.get(params["q"], [])
        start = params.get("start", 0)
        return {"response": {"numFound": len(docs), "docs": docs[start : start + params["rows"]]}}

    rows = spark.createDataFrame([("p1", {}, "Dark matter"), ("p2", {}, "Two")], "id string, identifiers map<string,string>, name string")
    for more in ({}, {"rows_per_page": 2}):
        assert [(r["id"], r["bibcode"]) for r in rest.looked_up(rows, "id", "identifiers", "name", get, **more).collect()] == [("p1", "b5")]


def test_bounded_authors(spark):
    rows = spark.createDataFrame([("a", "X, A; Big Collaboration; Y; X, A; Z", 3), ("b", "; ".join(f"N{i}" for i in range(30)), 30), ("c", "A;B;C;D;E;F;G", None), ("d", None, 1)], "id string, names string, n int")
    got = {}
    for r in R.bounded_authors(rows, "names", "id", "n").orderBy("position").collect():
        got.setdefault(r["id"], []).append(r["author"])
    assert got == {"a": ["A X", "Y", "Z"], "b": [f"N{i}" for i in range(5)], "c": list("ABCDE")}


def test_bibtex_sink(spark, tmp_path):
    schema = "id string, type string, name string, identifiers map<string,string>, properties struct<author_list:string,citation_key:string,publication_year:bigint>, source_refs array<struct<source_id:string,citation_key:string>>"
    rows = [
        ("p1", "Paper", "One", {"doi": "10.1/a"}, ("Me, A; You", "k1", 2020), []), ("p2", "Paper", "One again", {"doi": "https://doi.org/10.1/A"}, ("Me, A", None, None), []),
        ("p3", "Paper", 'Survey. Say "x"', {}, ("; ".join([*map(str, range(10)), "Me, A"]), None, None), [("s", "k3")]), ("p4", "Paper", "Surveys", {"arxiv": "1"}, (None, None, None), None),
    ]
    e = files.bibtex_entries(spark.createDataFrame(rows, schema), ["Survey Collaboration"], "survey", ["me, a"], "Survey")
    got = {r["citation_key"]: (r["category"], r["entry"]) for r in e.collect()}
    assert {k: v[0] for k, v in got.items()} == {"k1": "personal", "k3": "collab", "paper_1": "personal"}
    assert "doi = \"10.1/a\"" in got["k1"][1] and "collaboration" in got["k3"][1] and '{Survey. Say \\"x\\"}' in got["k3"][1]
    assert files.write_bibtex(e, str(tmp_path / "b")) == {"personal": 2, "collab": 1}


def test_corporate_papers_by_edge_and_collaboration(spark):
    schema = "id string, name string, identifiers map<string,string>, properties struct<author_list:string,collaboration:string>, source_refs array<struct<source_id:string,citation_key:string>>"
    rows = [("p1", "A", {"doi": "10.1/(x)_"}, ("Me, A", None), None), ("p2", "B", {}, ("X; Me, A", " SURVEY collaboration "), None), ("p3", "Survey C", None, ("Survey Collaboration", None), None)]
    edges = spark.createDataFrame([("p1", "corporate_authored_by", "i:s"), ("p1", "corporate_authored_by", "i:s"), ("p3", "corporate_authored_by", "i:other")], "subject string, predicate string, object string")
    got = files.bibtex_entries(spark.createDataFrame(rows, schema), ["Survey Collaboration"], "survey", ["me, a"], "Survey", edges, "i:s")
    assert {r["citation_key"]: r["category"] for r in got.collect()} == {"paper_10_1_x": "core", "paper_p2": "core", "paper_p3": "personal"}


def test_small_functions(spark):
    df = spark.createDataFrame([(["", "b"], '{"a": 1}', "x [1, 2] y"), ([" a "], "no", "none"), ([], None, None)], "l array<string>, o string, t string")
    got = df.select(X.first_text(F.col("l")).alias("f"), X.json_items(F.col("t")).cast("string").alias("j")).collect()
    assert [tuple(r) for r in got] == [(None, "[1,2]"), ("a", None), (None, None)]
    assert [X.bool_arg(v) for v in ("Yes", " 1 ", "no", None)] == [True, True, False, False] and X.int_arg(" 7 ", 1) == 7 and X.int_arg("x", 1) == 1


def test_store_snapshots(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"key": "k1", "name": "One", "type_key": "tag"}, {"key": "k2", "name": "Two", "type_key": "tag", "archived": true}, {"key": "k3", "name": "P", "type_key": "page"}]')
    store = records.json_array(spark, str(tmp_path / "a.json"), "key string, name string, type_key string, archived boolean")
    assert [tuple(r) for r in records.tag_vocabulary(store).collect()] == [("k1", "One")]
    assert [r["key"] for r in records.live_objects(store, ["page", "task"]).collect()] == ["k3"]


def test_stream_windows_and_first_deliveries(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines = [("a", "2024-01-01T00:10:00"), ("a", "2024-01-01T00:20:00"), ("b", "2024-01-01T00:30:00"), ("c", "2024-01-09T01:00:00")]
    (tmp_path / "in" / "1.json").write_text("\n".join(json.dumps({"id": k, "at": t}) for k, t in lines))
    for name, build in (("once", lambda df: ingest.once_per_key(df, ["id"], "at")), ("win", lambda df: ingest.counts_per_window(df, "at", ["id"]))):
        rows = build(ingest.contributions(spark, str(tmp_path / "in"), "id string, at timestamp"))
        rows.writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start().awaitTermination(120)
    assert sorted(r["id"] for r in spark.table("once").collect()) == ["a", "b", "c"]
    assert {(r["id"], r["n"]) for r in spark.table("win").collect()} == {("a", 2), ("b", 1)}


def test_retries_and_backends():
    class Refused(Exception):
        def __init__(self, status):
            self.status = status

    def failing(*statuses):
        left = list(statuses)

        def call(x):
            if left:
                raise Refused(left.pop(0))
            return x

        return call

    waits = []
    assert rest.retrying(failing(429, 503, None), sleep=waits.append, wait=4)("a") == "a" and waits == [4, 8, 10]
    for statuses, retries in (((404,), 4), ((429, 429), 1)):
        with pytest.raises(Refused):
            rest.retrying(failing(*statuses), retries, sleep=waits.append)("a")
    assert rest.first_of(failing(404), lambda x: x + "!")("a") == "a!"
    with pytest.raises(Refused):
        rest.first_of(failing(500), failing(404))("a")


def test_profile():
    good = {"version": 1, "key": "k", "name": "K", "namespaces": {"s": "http://s/"}, "types": [{"key": "person", "layout": "basic", "rdf_class": "s:P", "properties": [{"key": "a", "format": "text"}]}]}
    assert profile.checked(good) is good
    for path, value in (("version", 2), ("key", "No"), ("types", []), ("namespaces", None)):
        with pytest.raises(profile.ProfileError):
            profile.checked({**good, path: value})
    for change in ({"layout": "odd"}, {"rdf_class": "x:P"}, {"key": "Bad"}, {"properties": [{"key": "a", "format": "text"}] * 2}, {"properties": [{"key": "a", "format": "odd"}]}):
        with pytest.raises(profile.ProfileError):
            profile.checked({**good, "types": [{**good["types"][0], **change}]})


def test_batches_and_fetching(spark):
    df = spark.createDataFrame([(i, f"u{i}") for i in range(5)], "i int, url string").coalesce(1)
    got = {r["i"]: (r["label"], r["ask_error"]) for r in T.in_batches(df, lambda b: [{"label": r["url"]} for r in b][:1], "label string", size=2).collect()}
    assert got == {0: ("u0", None), 1: (None, "no answer"), 2: ("u2", None), 3: (None, "no answer"), 4: ("u4", None)}

    def fetch(u):
        if u == "u1":
            raise RuntimeError("down")
        return u.upper()

    got = {r["i"]: (r["markdown"], r["fetch_ok"], r["fetch_error"]) for r in T.fetched(df, fetch, retries=1).collect()}
    assert got[0] == ("U0", True, None) and got[1] == (None, False, "down")


def test_guides(spark, tmp_path):
    rows = spark.createDataFrame([("T", "small", "z", "u1", None), ("T", "Big", "b", "u2", "s"), ("T", "Big", "a", "u3", ""), ("Lone", "x", "q", "u4", "")], "topic string, sub string, title string, url string, summary string")
    lines = T.guides(rows, "topic", "sub", "title", "url", "summary")
    assert [r["line"] for r in lines.orderBy("part").collect()] == ["# T (3)", "## Big", "- [a](u3)", "- [b](u2): s", "## small", "- [z](u1)"]
    files.write_guides(lines, str(tmp_path / "g"))
    assert (tmp_path / "g" / "slug=t").exists()


def test_saved_queries(tmp_path):
    a = files.save_query("SELECT 1", "What is it?", str(tmp_path))
    assert files.save_query("SELECT 1", "What is it?", str(tmp_path)) == a == "what-is-it.rq"
    assert files.save_query("SELECT 2", "What is it?", str(tmp_path)) == "what-is-it-2.rq"
    assert records.query_files(str(tmp_path))[0] == ("what-is-it-2.rq", "Question: What is it?", "SELECT 2")


def test_stream_merges_into_a_table(spark, tmp_path):
    schema = "id string, name string, properties struct<a:string>, source_refs array<struct<source_id:string>>"
    inbox, store = tmp_path / "in", {"t": spark.createDataFrame([("x", "old", ("1",), [("s0",)])], schema)}
    inbox.mkdir()
    (inbox / "1.json").write_text(json.dumps({"id": "x", "name": "new", "properties": {"a": "2"}, "source_refs": [{"source_id": "s1"}]}) + "\n" + json.dumps({"id": "y", "name": "n"}))

    def write(rows, _):
        rows = spark.createDataFrame(rows.collect(), rows.schema)
        store["t"] = store["t"].join(rows.select("id"), "id", "left_anti").unionByName(rows)

    q = ingest.start(ingest.contributions(spark, str(inbox), schema), ingest.upserting(lambda s: store["t"], write), str(tmp_path / "cp"))
    assert q.awaitTermination(90)
    got = {r["id"]: (r["name"], r["properties"]["a"] if r["properties"] else None, sorted(x[0] for x in r["source_refs"] or [])) for r in store["t"].collect()}
    assert got == {"x": ("old", "2", ["s0", "s1"]), "y": ("n", None, [])}
