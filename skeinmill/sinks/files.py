"""JSON lines, TriG, BibTeX, guides and saved queries."""

from __future__ import annotations

import json
import re
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skeinmill.functions import text as X
from skeinmill.operators import resolve as R
from skeinmill.operators.graph import quad_counts, trig_lines
from skeinmill.operators.merge import fingerprint


def _canonical(s: pd.Series) -> pd.Series:
    return s.map(lambda v: json.dumps(json.loads(v), sort_keys=True, ensure_ascii=False))


def json_lines(rows: DataFrame) -> DataFrame:
    """(id, value): each record as JSON with sorted keys and raw characters, without nulls (K1)."""
    return rows.select("id", F.pandas_udf(_canonical, T.StringType())(F.to_json(F.struct(*rows.columns))).alias("value"))


def write_json_lines(rows: DataFrame, path: str) -> None:
    """Records as JSON lines, sorted by id over all part files."""
    json_lines(rows).orderBy("id").select("value").write.mode("overwrite").text(path)


def write_if_changed(rows: DataFrame, path: str, dry_run: bool = False) -> bool:
    """Replaces a Parquet table if its rows differ (K2); tells whether they did.

    The new table is written beside the old one, which is renamed aside before and
    deleted after the new one has its place: at any moment one of both is whole,
    and a table that was left aside is put back by the next call.
    """
    spark = rows.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs
    here, side, aside = (hadoop.Path(path.rstrip("/") + end) for end in ("", ".new", ".old"))
    fs = here.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(aside) and not fs.exists(here):
        fs.rename(aside, here)
    if fs.exists(here):
        old, new = fingerprint(spark.read.parquet(path)).first(), fingerprint(rows).first()
        if old == new:
            return False
    if not dry_run:
        rows.write.mode("overwrite").parquet(side.toString())
        fs.delete(aside, True)
        if fs.exists(here):
            fs.rename(here, aside)
        fs.rename(side, here)
        fs.delete(aside, True)
    return True


def write_trig(quads: DataFrame, path: str) -> dict:
    """TriG files and how many triples and named graphs they hold (K3)."""
    trig_lines(quads).select("line").write.mode("overwrite").text(path)
    return quad_counts(quads).first().asDict()


def bibtex_entries(papers: DataFrame, markers: list[str], prefix: str, aliases: list[str], series: str, relations: DataFrame | None = None, institution: str | None = None) -> DataFrame:
    """(citation_key, category, entry) of papers (K4): deduplicated by identity, classed, rendered.

    With ``relations`` a paper is corporate by its edge to ``institution`` or by its collaboration,
    without them by its authors or title.

    The best record of an identity fills most properties and identifiers, of
    equals the one with the greater id. A repeated citation key is an error.
    """
    p = lambda k: F.nullif(F.col("properties")[k].cast("string"), F.lit(""))
    members = [f.name for f in papers.schema["properties"].dataType.fields] if isinstance(papers.schema["properties"].dataType, T.StructType) else None
    have = (lambda k: p(k)) if members is None else (lambda k: p(k) if k in members else F.lit(None).cast("string"))
    filled = F.size(F.filter(F.array(*[p(m) for m in members]), lambda x: x.isNotNull())) if members else F.size("properties")
    score = filled + F.size(F.coalesce("identifiers", F.create_map().cast("map<string,string>")))
    # One record stands for an identity, of several contributions about its id the fullest; what is left of ties is settled by content.
    rank = F.struct(score, F.col("id"), F.to_json(F.struct(*papers.columns)))
    rows = papers.groupBy(R.paper_identity().alias("_identity")).agg(F.max_by(F.struct(*papers.columns), rank).alias("r")).select("r.*")
    if relations is None:
        corporate = R.is_corporate(F.col("name"), have("author_list"), markers, prefix)
    else:
        edges = relations.where((F.col("predicate") == "corporate_authored_by") & (F.col("object") == institution)).select(F.col("subject").alias("id")).distinct()
        rows = rows.join(edges.withColumn("_edge", F.lit(True)), "id", "left").withColumn("_edge", F.coalesce("_edge", F.lit(False)))
        corporate = F.col("_edge") | F.coalesce(F.lower(F.trim(have("collaboration"))).isin(*[m.lower() for m in markers]), F.lit(False))
    category = R.researcher_class(corporate, R.author_position(have("author_list"), aliases))
    ref_key = F.get(F.filter(F.transform("source_refs", lambda r: r["citation_key"]), lambda x: x.isNotNull() & (x != "")), F.lit(0))
    get = lambda k: F.nullif(F.try_element_at("identifiers", F.lit(k)), F.lit(""))
    raw = F.regexp_replace(F.coalesce(get("arxiv"), get("doi"), F.col("id")), "[^A-Za-z0-9]+", "_")
    given = lambda c: F.nullif(F.trim(c), F.lit(""))
    key = F.coalesce(given(have("citation_key")), given(ref_key), F.concat(F.lit("paper_"), F.regexp_replace(raw, "^_+|_+$", "")))
    field = lambda name, value: F.when(value.isNotNull(), F.concat(F.lit(f'  {name} = "'), X.bibtex_escaped(value), F.lit('"')))
    rows = rows.select("*", key.alias("citation_key"), category.alias("category"))
    fields = [
        field("author", X.author_value(have("author_list"), markers)), field("collaboration", F.when(F.col("category") != "personal", F.lit(series))),
        field("title", F.concat(F.lit("{"), F.col("name"), F.lit("}"))), field("eprint", get("arxiv")), field("archivePrefix", F.when(get("arxiv").isNotNull(), F.lit("arXiv"))),
        field("primaryClass", have("primary_class")), field("journal", have("journal")), field("volume", have("volume")), field("pages", have("pages")),
        field("year", have("publication_year")), field("doi", get("doi")), field("keywords", F.col("category")),
    ]
    body = F.array_join(F.filter(F.array(*fields), lambda x: x.isNotNull()), ",\n")
    return rows.select("citation_key", "category", F.concat(F.lit("@"), F.coalesce(F.when(have("entry_type").rlike("^[A-Za-z]+$"), have("entry_type")), F.lit("article")), F.lit("{"), F.col("citation_key"), F.lit(",\n"), body, F.lit("\n}\n")).alias("entry"))


def repeated_keys(entries: DataFrame) -> DataFrame:
    """(citation_key, n) that would clash in one file."""
    return entries.groupBy("citation_key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def write_bibtex(entries: DataFrame, path: str) -> dict:
    """BibTeX files sorted by key over all part files, and the number of entries per category."""
    clash = repeated_keys(entries).first()
    if clash:
        raise ValueError(f"repeated citation key {clash['citation_key']}")
    entries.orderBy(F.lower("citation_key"), "citation_key").select("entry").write.mode("overwrite").text(path)
    return {r["category"]: r["n"] for r in entries.groupBy("category").agg(F.count(F.lit(1)).alias("n")).collect()}


def write_guides(lines: DataFrame, path: str) -> None:
    """One folder of Markdown per topic, its lines in order (K6)."""
    lines.repartitionByRange("slug", "part").sortWithinPartitions("slug", "part").select("slug", "line").write.mode("overwrite").partitionBy("slug").text(path)


def save_query(query: str, question: str, folder: str, model: str = "") -> str:
    """Saves a query under its question's slug and returns the file's name (K11); the same query keeps its file."""
    head = f"# Question: {question}\n" + (f"# Model: {model}\n" if model else "") + "\n"
    base = re.sub(r"[^a-z0-9]+", "-", question.lower()).strip("-")[:50].rstrip("-") or "query"
    n = 1
    while True:
        p = Path(folder) / (f"{base}.rq" if n == 1 else f"{base}-{n}.rq")
        if not p.exists():
            p.parent.mkdir(parents=True, exist_ok=True)
            p.write_text(head + query.strip() + "\n")
            return p.name
        if p.read_text() == head + query.strip() + "\n":
            return p.name
        n += 1
