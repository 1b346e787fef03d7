"""The bookmark track: tagging, triage, topics and guides."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skeinmill.functions import text as X

#: Topic families in order, each with the texts of which any one decides.
TOPICS = (
    ("Helmholtz and HMC", ("helmholtz", " hmc", "hifis", "gfz", "hereon", "fz-juelich", "dlr", "ufz", "kit.edu", "desy", "hzb", "dkfz", "geomar", "awip")),
    ("AI, LLMs, and Scientific Agents", ("artificial intelligence", " ai ", " llm", "large language", "agent", "multi-agent", "machine learning", "deep learning", "neural", "chatgpt", "openai", "scientific ai", "blablador")),
    ("Knowledge Graphs and Ontologies", ("knowledge graph", "ontology", "semantic web", "rdf", "linked data", "sparql", "owl", "schema.org", "wikidata")),
    ("Metadata Standards, PIDs, and Scholarly Metadata", ("metadata standard", "datacite", "dublin core", "oai-pmh", "schema", "pid", "persistent identifier", "doi", "orcid", "purl", "metadata extraction")),
    ("Research Data Management and FAIR Practice", ("fair", "research data management", " rdm", "data management plan", "data stewardship", "open science", "data quality")),
    ("Research Data Infrastructure and Repositories", ("repository", "archive", "zenodo", "infrastructure", "nfdi", "dataset", "data portal", "catalog", "commons", "research data infrastructure")),
    ("Training and Learning Resources", ("training", "course", "workshop", "tutorial", "learning", "education", "onboarding", "lecture")),
    ("Research Software and Open Tools", ("software", "github", "tool", "cli", "workflow", "reproducible", "open source", "package", "library")),
    ("Cloud and Collaboration Services", ("cloud", "service", "collaboration", "platform")),
    ("Events and Communities", ("conference", "event", "workshop", "community", "forum")),
)
#: The family of everything else, the folder mark of the second family, triage values.
GENERAL, FOLDER_MARK, TRIAGE = "General Research Resources", "/ai", ("knowledge_resource", "tool", "login_page", "admin_page", "other")


def topic(text: Column, folder: Column | None = None) -> Column:
    """The first family any of whose texts stands in ``text``."""
    low, out = F.lower(F.coalesce(text, F.lit(""))), None
    for k, (name, needles) in enumerate(TOPICS):
        hit = reduce(lambda a, b: a | b, [F.contains(low, F.lit(n)) for n in needles])
        if k == 1 and folder is not None:
            hit = hit | F.contains(F.lower(F.coalesce(folder, F.lit(""))), F.lit(FOLDER_MARK))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise(GENERAL)


def specific_topic(label: Column, keywords: Column, folder: Column) -> Column:
    """The label, else the first keyword in words, else the last folder, else ``misc`` (P25)."""
    filled = lambda c: F.nullif(F.trim(c), F.lit(""))
    return F.coalesce(filled(label), filled(F.replace(F.get(keywords, F.lit(0)), F.lit("_"), F.lit(" "))), filled(X.last_folder(folder)), F.lit("misc"))


def triage(value: Column) -> Column:
    """A triage value, ``other`` for anything else."""
    v = F.lower(F.trim(value))
    return F.when(v.isin(*TRIAGE), v).otherwise("other")


def keywords(items: Column, limit: int = 7) -> Column:
    """The first ``limit`` different keywords in snake case."""
    return F.slice(F.array_distinct(F.filter(F.transform(items, X.snake_keyword), lambda x: x != "")), 1, limit)


def histogram(rows: DataFrame, value: Column, name: str) -> DataFrame:
    """(name, n) of a value; null counts as "" (A7-A9)."""
    return rows.groupBy(F.coalesce(value, F.lit("")).alias(name)).agg(F.count(F.lit(1)).alias("n"))


def clusters(rows: DataFrame, topic_col: str, least: int = 2) -> DataFrame:
    """(topic, slug, n) of topics with at least ``least`` rows (A10)."""
    return rows.groupBy(F.col(topic_col).alias("topic")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least).select("topic", X.plain_slug(F.col("topic")).alias("slug"), "n")


def subtopics(rows: DataFrame, topic_col: str, sub_col: str, order: str, first: int = 12) -> DataFrame:
    """(topic, rank, subtopic, n): the most frequent subtopics of each topic, of equals the first seen (A11). A top-k report."""
    counted = rows.groupBy(F.col(topic_col).alias("topic"), F.col(sub_col).alias("subtopic")).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("_first"))
    w = Window.partitionBy("topic").orderBy(F.desc("n"), "_first")
    return counted.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= first).select("topic", "rank", "subtopic", "n")


def guide_tags(rows: DataFrame, topic_col: str, tags: str, order: str, first: int = 12) -> DataFrame:
    """(topic, rank, tag): the first different tags of each topic whatever their case, as first seen."""
    seen = rows.select(F.col(topic_col).alias("topic"), F.col(order).alias("_o"), F.posexplode(tags).alias("_p", "tag")).where(F.trim("tag") != "")
    one = seen.groupBy("topic", F.lower(F.trim("tag")).alias("_k")).agg(F.min(F.struct("_o", "_p", F.trim("tag").alias("tag"))).alias("f"))
    w = Window.partitionBy("topic").orderBy("f._o", "f._p")
    return one.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= first).select("topic", "rank", F.col("f.tag").alias("tag"))


def guides(rows: DataFrame, topic_col: str, sub_col: str, title: str, url: str, summary: str, least: int = 2) -> DataFrame:
    """(topic, slug, part, line): the lines of each topic's guide, to be written in order of part.

    A guide is rows, not one string, so that a topic with a third of all rows is
    written by many tasks; part orders sections by size, then name, then items.
    """
    rows = rows.select(F.col(topic_col).alias("topic"), F.col(sub_col).alias("sub"), F.col(title).alias("title"), F.col(url).alias("url"), F.col(summary).alias("summary"))
    big = clusters(rows, "topic", least)
    sizes = rows.groupBy("topic", "sub").agg(F.count(F.lit(1)).alias("m"))
    pad = lambda c: F.lpad((F.lit(10**9) - c).cast("string"), 10, "0")
    at = F.concat_ws("|", pad(F.col("m")), F.lower("sub"))
    heads = big.select("topic", "slug", F.lit("0").alias("part"), F.concat(F.lit("# "), "topic", F.lit(" ("), F.col("n").cast("string"), F.lit(")")).alias("line"))
    sections = sizes.join(big, "topic").select("topic", "slug", F.concat(F.lit("1|"), at).alias("part"), F.concat(F.lit("## "), "sub").alias("line"))
    items = rows.join(sizes, ["topic", "sub"]).join(big.select("topic", "slug"), "topic").select(
        "topic", "slug", F.concat(F.lit("1|"), at, F.lit("|"), F.lower(F.coalesce("title", F.lit("")))).alias("part"),
        F.concat(F.lit("- ["), F.coalesce("title", "url"), F.lit("]("), "url", F.lit(")"), F.coalesce(F.concat(F.lit(": "), F.nullif(F.trim("summary"), F.lit(""))), F.lit(""))).alias("line"),
    )
    return heads.unionByName(sections).unionByName(items)


def resumed(rows: DataFrame, done: DataFrame, key: str, only_ok: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows still to do, rows kept from the last run): an anti-join and a semi-join by key.

    ``only_ok`` names a flag that a kept row must have, so that failures are tried again.
    """
    kept = done.where(F.col(only_ok)) if only_ok else done
    return rows.join(kept.select(key).distinct(), key, "left_anti"), kept.join(rows.select(key).distinct(), key, "left_semi")


def tag_keys(rows: DataFrame, key: str, tags: str, vocabulary: DataFrame) -> DataFrame:
    """(key, tag, tag_key): each tag's key in the vocabulary, by normalised name, else by key, else ``__missing__:`` and the tag."""
    asked = rows.select(key, F.explode(tags).alias("tag")).where(F.trim("tag") != "").distinct()
    by_name = vocabulary.groupBy(X.name_key(F.col("name")).alias("_n")).agg(F.min("key").alias("_by_name"))
    by_key = vocabulary.select(F.col("key").alias("_by_key")).distinct()
    found = asked.join(by_name, X.name_key(F.col("tag")) == F.col("_n"), "left").join(by_key, F.trim("tag") == F.col("_by_key"), "left")
    return found.select(key, "tag", F.coalesce("_by_name", "_by_key", F.concat(F.lit("__missing__:"), F.trim("tag"))).alias("tag_key"))


def in_batches(rows: DataFrame, ask: Callable[[list[dict]], list[dict]], schema: str, size: int = 10) -> DataFrame:
    """``rows`` with what ``ask`` returns for each batch, by position.

    ``ask`` gets the rows of a batch as dicts and returns dicts; a short or failed
    answer leaves nulls in the remaining rows, with the reason in ``ask_error``.
    ``schema`` lists the added columns. Batches never span partitions.
    """
    added = [c.split()[0] for c in schema.split(",")]
    out = ", ".join([f"`{n}` {t}" for n, t in rows.dtypes] + [schema, "ask_error string"])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for i in range(0, len(pdf), size):
                batch = pdf.iloc[i : i + size].copy()
                try:
                    got, error = ask(batch.to_dict("records")), None
                except Exception as x:  # noqa: BLE001 - a failed batch is a recorded result
                    got, error = [], str(x)
                got = [*got[: len(batch)], *[{}] * (len(batch) - len(got))]
                for c in added:
                    batch[c] = [g.get(c) for g in got]
                batch["ask_error"] = [error if error else None if g else "no answer" for g in got]
                yield batch

    return rows.mapInPandas(run, out)


def fetched(rows: DataFrame, fetch: Callable[[str], str], url: str = "url", retries: int = 2, parallel: int | None = None) -> DataFrame:
    """``rows`` with url_key, markdown, fetch_ok and fetch_error.

    ``fetch`` returns the text of a URL; it is tried again ``retries`` times unless
    the error says the request itself was wrong (its ``status`` is 4xx).
    """
    import time

    out = ", ".join([f"`{n}` {t}" for n, t in rows.dtypes] + ["markdown string, fetch_ok boolean, fetch_error string"])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            got = []
            for u in pdf[url]:
                error = None
                for k in range(retries + 1):
                    try:
                        got.append((fetch(u), True, None))
                        break
                    except Exception as x:  # noqa: BLE001 - a failed fetch is a recorded result
                        error = str(x)
                        if 400 <= getattr(x, "status", 0) < 500:
                            got.append((None, False, error))
                            break
                        time.sleep(min(0.05 * k, 5))
                else:
                    got.append((None, False, error))
            yield pdf.assign(markdown=[g[0] for g in got], fetch_ok=[g[1] for g in got], fetch_error=[g[2] for g in got])

    src = rows.repartition(parallel) if parallel else rows
    return src.mapInPandas(run, out).withColumn("url_key", X.cache_key(F.col(url)))
