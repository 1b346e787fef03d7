"""Whole runs in one call: read a source, take back its earlier contribution, merge the new one, report.

``tables`` holds the canonical tables (entities, relations, aliases, concepts) as
DataFrames; a run returns the tables after it and a report with a row per table.
Nothing is written: ``stored`` does that, for the tables that changed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skeinmill.operators import merge as M
from skeinmill.operators import project as P
from skeinmill.operators import resolve as R
from skeinmill.sinks.files import bibtex_entries, write_if_changed
from skeinmill.sources import builders as B
from skeinmill.sources import documents as D
from skeinmill.sources import rest

TABLES = ("entities", "relations", "aliases", "concepts")


def ingest(tables: dict[str, DataFrame], records: dict[str, DataFrame], source_ids: list[str]) -> tuple[dict[str, DataFrame], DataFrame]:
    """(tables, report) after one source's records were merged; a table it says nothing of only loses what the source said before."""
    out, reports = dict(tables), []
    for name in TABLES:
        if name not in tables:
            continue
        new = records.get(name, tables[name].limit(0))
        out[name], report = M.merge_source(tables[name], _shaped(new, tables[name]), source_ids)
        reports.append(report.select(F.lit(name).alias("table_name"), "*"))
    return out, reduce(DataFrame.unionByName, reports)


def _shaped(new: DataFrame, like: DataFrame) -> DataFrame:
    """``new`` with the columns of ``like``; what it has no value for is null."""
    have = dict(new.dtypes)
    return new.select(*[(F.col(c).cast(kind) if c in have else F.lit(None).cast(kind)).alias(c) for c, kind in like.dtypes])


def ingest_bibtex(tables: dict[str, DataFrame], docs: DataFrame, source_id: str, key: str = "doc", source_url: str | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    entries = D.bibtex(docs, key).withColumnRenamed(key, "_doc")
    return ingest(tables, B.from_bibtex(entries, source_id, source_url), [source_id])


def ingest_talks(tables: dict[str, DataFrame], docs: DataFrame, source_id: str, event_id: str, event_name: str, prefix: str, key: str = "doc", **event: str) -> tuple[dict[str, DataFrame], DataFrame]:
    talks = D.talks(docs, key).withColumnRenamed(key, "_doc")
    return ingest(tables, B.from_talks(talks, source_id, event_id, event_name, prefix, **event), [source_id])


def ingest_hits(tables: dict[str, DataFrame], hits: DataFrame, source_id: str, researcher: str | None = None, scope: str | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    return ingest(tables, _scoped(B.from_hits(hits, source_id, researcher), scope, source_id), [source_id])


def ingest_works(tables: dict[str, DataFrame], works: DataFrame, source_id: str, scope: str | None = None, docs: DataFrame | None = None, without: Column | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """A researcher's works (G3): resolved against the graph, with bounded coauthors where ``docs`` (id, author_list, author_count) tells of them."""
    records = B.from_works(works, tables["entities"], source_id)
    if docs is not None:
        people = R.bounded_authors(docs.join(records["entities"].select("id"), "id", "left_semi"), "author_list", "id", "author_count", without=without)
        ref, none = B.refs(source_id), F.create_map().cast("map<string,string>")
        person = B.person_id(F.col("author"))
        records["entities"] = records["entities"].unionByName(B.entity(people, person, "Person", F.col("author"), none, B.props(name_as_cited=F.col("author")), ref))
        records["relations"] = B.edge(people, F.col("id"), "authored_by", person, ref)
    return ingest(tables, _scoped(records, scope, source_id), [source_id])


def _scoped(records: dict[str, DataFrame], scope: str | None, source_id: str) -> dict[str, DataFrame]:
    """Records with edges in both directions between their papers and a scope given as KEY[=KIND:NAME]."""
    if scope is None:
        return records
    key, kind, name = B.parse_scope(scope)
    papers = records["entities"].where(F.col("type") == "Paper")
    asked = papers.sparkSession.createDataFrame([(key, kind, name)], "key string, kind string, name string")
    rows, edges = B.scope_records(papers, asked, source_id)
    out = dict(records)
    out["entities"] = records["entities"].unionByName(rows.select(*records["entities"].columns))
    out["relations"] = records["relations"].unionByName(edges.select(*records["relations"].columns)) if "relations" in records else edges
    return out


def reconcile(tables: dict[str, DataFrame], corporate: Column, institution: str, source_ids: tuple[str, str] = ("derived:bounded-authors", "derived:corporate-authors"), without: Column | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """Derived edges over all papers (G4, G5): bounded authors and the institution of corporate papers, each as a source of its own."""
    papers = tables["entities"].where(F.col("type") == "Paper")
    people = R.bounded_authors(papers.where(F.col("properties.author_list").isNotNull()), "properties.author_list", "id", "properties.author_count", without=without)
    derived = R.author_edges(people, source_ids[0]).unionByName(R.corporate_edges(papers, corporate, institution, source_ids[1]))
    none = F.lit(None).cast("string")
    ref = F.array(F.struct("source_id", none.alias("citation_key"), none.alias("source_url")))
    edges = derived.select("id", "subject", "predicate", "object", ref.alias("source_refs"))
    return ingest({"relations": tables["relations"]}, {"relations": edges}, list(source_ids))


def enrich(tables: dict[str, DataFrame], answers: DataFrame) -> DataFrame:
    """(id, property, value) that a bibliographic service's answers set in the entities."""
    return rest.enriched(tables["entities"], answers)


def export_bibtex(tables: dict[str, DataFrame], markers: list[str], prefix: str, aliases: list[str], series: str, institution: str) -> DataFrame:
    papers = tables["entities"].where(F.col("type") == "Paper")
    return bibtex_entries(papers, markers, prefix, aliases, series, tables["relations"], institution)


def materialize(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The projection, after a check that it is sound: the rows of ``violations`` come out beside it."""
    return {**P.manifest(tables["entities"], tables["relations"]), "violations": P.violations(tables["entities"], tables["relations"])}


def pull(tables: dict[str, DataFrame], live_objects: DataFrame, live_edges: DataFrame, id_map: DataFrame) -> dict[str, DataFrame]:
    """What the live store has and the graph lacks: concepts to adopt, edges to add, ends it can't name."""
    adopted = P.adopted_concepts(live_objects, tables["concepts"])
    ids = id_map.unionByName(adopted.where(F.col("action") == "adopt").select("object_id", "id"))
    return {"concepts": adopted, "edges": P.pull_edges(live_edges, ids, tables["relations"])}


def stored(tables: dict[str, DataFrame], folder: str, dry_run: bool = False) -> dict[str, bool]:
    """Writes the tables whose rows changed, each to its own place; tells which."""
    return {name: write_if_changed(df, f"{folder}/{name}", dry_run) for name, df in tables.items()}
