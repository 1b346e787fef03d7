"""Merging contributions of sources into canonical tables, and taking them back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skeinmill.session import cut


def _order(order: list[str]) -> Column:
    return F.struct(*[F.col(c) for c in order])


def merged(rows: DataFrame, key: str = "id", order: list[str] = ("ingested_at", "record_id"), properties: str = "properties", refs: str = "source_refs") -> DataFrame:
    """One row per key (J1): the first contribution wins every scalar, the last one each property it has, references are united.

    Everything but the list of references is a maximum or minimum by ``order``, so
    partial aggregation takes the load off hot keys. Rows without a key drop out.
    """
    at, split = _order(list(order)), False
    aggs = []
    for f in rows.schema.fields:
        if f.name in (key, properties, refs):
            continue
        aggs.append(F.min_by(F.col(f.name), at).alias(f.name))
    if properties in rows.columns:  # A struct has a fixed number of members, a map any.
        kind = rows.schema[properties].dataType
        if isinstance(kind, T.StructType):
            last = lambda c: F.max_by(c, F.when(c.isNotNull(), at))
            aggs.append(F.struct(*[last(F.col(properties)[m.name]).alias(m.name) for m in kind.fields]).alias(properties))
        else:
            split = True
    if refs in rows.columns:
        aggs.append(F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.coalesce(refs, F.array()))))).alias(refs))
    out = rows.where(F.col(key).isNotNull()).groupBy(key).agg(*aggs)
    if split:
        out = out.join(_last_entries(rows, key, at, properties), key, "left").withColumn(properties, F.coalesce(properties, F.create_map().cast(rows.schema[properties].dataType)))
    return out.select(*rows.columns)


def _last_entries(rows: DataFrame, key: str, at: Column, properties: str) -> DataFrame:
    """Per key a map of the last value of each property; entries are grouped by key and property first, so a hot key spreads."""
    entries = rows.where(F.col(key).isNotNull()).select(key, at.alias("_at"), F.explode(properties).alias("_k", "_v")).where(F.col("_v").isNotNull())
    last = entries.groupBy(key, "_k").agg(F.max_by("_v", "_at").alias("_v"))
    return last.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("_k", "_v")))).alias(properties))


def retracted(rows: DataFrame, source_ids: list[str], refs: str = "source_refs", prefix: bool = False) -> DataFrame:
    """The table without one or more sources (A31): their references go, and records left without any.

    Records that never had a reference go too. ``prefix`` matches the beginning of
    the source's id.
    """
    hit = (lambda r: F.array_contains(F.lit(list(source_ids)), r["source_id"])) if not prefix else (lambda r: F.exists(F.array(*[F.lit(s) for s in source_ids]), lambda s: r["source_id"].startswith(s)))
    left = F.filter(F.coalesce(F.col(refs), F.array()), lambda r: ~F.coalesce(hit(r), F.lit(False)))
    return rows.withColumn(refs, left).where(F.size(refs) > 0)


def fingerprint(rows: DataFrame) -> DataFrame:
    """(n, digest) of a table whatever the order of its rows (K2)."""
    cols = [F.to_json(F.struct(c)) for c in sorted(rows.columns)]
    return rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.bit_xor(F.xxhash64(*cols)), F.lit(0)).alias("digest"))


def merge_source(old: DataFrame, new: DataFrame, source_ids: list[str], key: str = "id", **names: str) -> tuple[DataFrame, DataFrame]:
    """The table after a source is ingested again, and a one-row report (before, after, changed).

    The source's earlier contribution is retracted, then its new one merged behind
    what is left. Ingesting the same rows twice changes nothing.
    """
    kept = retracted(old, source_ids)
    both = kept.withColumn("_ord", F.lit(0)).unionByName(new.withColumn("_ord", F.lit(1)), allowMissingColumns=True)
    tie = [c for c in ("ingested_at", "record_id") if c in both.columns]
    out = cut(merged(both, key, ["_ord", *tie], **names).drop("_ord"))
    a, b = fingerprint(old).select(F.col("n").alias("before"), F.col("digest").alias("_a")), fingerprint(out).select(F.col("n").alias("after"), F.col("digest").alias("_b"))
    report = a.crossJoin(F.broadcast(b)).select("before", "after", ((F.col("before") != F.col("after")) | (F.col("_a") != F.col("_b"))).alias("changed"))
    return out, report


def conflicts(known: DataFrame, added: DataFrame, key: str = "id") -> DataFrame:
    """Added rows whose key exists already."""
    return added.join(known.select(key).distinct(), key, "left_semi")
