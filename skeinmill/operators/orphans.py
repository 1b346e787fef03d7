"""References to records that are not, not yet or no longer there."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skeinmill.session import cut

#: A key with more than one in so many references is hot; there are fewer of them.
HOT_PARTS = 1000


def references(df: DataFrame, row_id: str, ends: list[str], at: str) -> DataFrame:
    """(record_id, side, ref, at): every reference of ``df``; null and empty ends are none."""
    sides = F.array(*[F.struct(F.lit(e).alias("side"), F.col(e).alias("ref")) for e in ends])
    return (
        df.select(F.col(row_id).alias("record_id"), F.col(at).alias("at"), F.explode(sides).alias("x"))
        .select("record_id", "x.side", "x.ref", "at")
        .where(F.col("ref").isNotNull() & (F.col("ref") != ""))
    )


def lifetimes(tables: list[DataFrame]) -> DataFrame:
    """(id, born, died) of all rows of the parent tables.

    A table without ``retracted_at`` never retracts. A row without ``ingested_at``
    has never arrived and one retracted no later than it came was never live:
    both drop out.
    """
    parts = []
    for t in tables:
        died = F.col("retracted_at") if "retracted_at" in t.columns else F.lit(None)
        parts.append(t.select("id", F.col("ingested_at").alias("born"), died.cast("timestamp_ntz" if dict(t.dtypes)["ingested_at"] == "timestamp_ntz" else "timestamp").alias("died")))
    rows = reduce(DataFrame.unionByName, parts)
    return rows.where(F.col("id").isNotNull() & F.col("born").isNotNull() & (F.col("died").isNull() | (F.col("died") > F.col("born"))))


def orphan_references(refs: DataFrame, lives: DataFrame) -> DataFrame:
    """The rows of ``references`` for which no parent row was live at ``at``, plus ``reason``.

    ``reason`` is ``missing`` (no parent row with this id at any time),
    ``early`` (the first one came later), or ``gone`` (all had been retracted).
    A row lives from ``born`` (included) to ``died`` (excluded). A reference
    without ``at`` is an orphan only if its id is missing.

    Distinct keys are settled first: references are pre-aggregated per key, so a
    hot key is one row here, and anti-joined against the parents' keys; keys that
    were live all the time drop out with all their references. Only doubtful
    keys are joined back to the references; of them the hot ones, fewer than
    HOT_PARTS by their definition, are broadcast and the rest are shuffled.
    """
    keys = cut(refs.groupBy("ref").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"), F.max("at").alias("last")))
    total = keys.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    hot = [r["ref"] for r in keys.where(F.col("n") * HOT_PARTS > total).select("ref").collect()]
    open_from = F.min(F.when(F.col("died").isNull(), F.col("born")))
    parents = lives.groupBy("id").agg(F.min("born").alias("born"), open_from.alias("open_from"), F.max("died").alias("end"))
    missing = keys.join(parents, keys["ref"] == parents["id"], "left_anti").select(
        "ref", *[F.lit(None).cast(t).alias(c) for c, t in parents.dtypes if c != "id"], F.lit(True).alias("missing")
    )
    partly = (
        keys.join(parents, keys["ref"] == parents["id"])
        .where((F.col("first") < F.col("born")) | (F.col("open_from").isNull() & (F.col("last") >= F.col("born"))) | (F.col("first") < F.col("open_from")))
        .select("ref", "born", "open_from", "end", F.lit(False).alias("missing"))
    )
    doubtful = cut(missing.unionByName(partly))
    # A hot key's references never reach the shuffled join, so that it stays even.
    at_cold = refs.where(~F.col("ref").isin(hot)).join(doubtful.where(~F.col("ref").isin(hot)), "ref")
    at_hot = refs.where(F.col("ref").isin(hot)).join(F.broadcast(doubtful.where(F.col("ref").isin(hot))), "ref")
    open_ = F.col("missing") | F.col("at").isNotNull() & (F.col("open_from").isNull() | (F.col("at") < F.col("open_from")))
    settled = F.col("missing") | (F.col("at") < F.col("born")) | (F.col("open_from").isNull() & (F.col("at") >= F.col("end")))
    doubts = cut((at_hot.unionByName(at_cold) if hot else at_cold).where(open_).withColumn("settled", settled))
    reason = F.when(F.col("missing"), "missing").when(F.col("at") < F.col("born"), "early").otherwise("gone")
    columns = ["record_id", "side", "ref", "at"]
    sure = doubts.where("settled").select(*columns, reason.alias("reason"))
    rest = doubts.where(~F.col("settled")).select(*columns)
    spans = closed_spans(lives, parents)
    uncovered = rest.join(spans, (rest["ref"] == spans["id"]) & (rest["at"] >= spans["born"]) & (rest["at"] < spans["died"]), "left_anti")
    return sure.unionByName(uncovered.select(*columns, F.lit("gone").alias("reason")))


def closed_spans(lives: DataFrame, parents: DataFrame) -> DataFrame:
    """(id, born, died): disjoint spans in which rows that were retracted later cover the id.

    Only spans that begin before a row that was never retracted; repeated
    deliveries merge before the window.
    """
    closed = (
        lives.where(F.col("died").isNotNull())
        .groupBy("id", "born")
        .agg(F.max("died").alias("died"))
        .join(parents.select("id", "open_from"), "id")
        .where(F.col("open_from").isNull() | (F.col("born") < F.col("open_from")))
    )
    by_id = Window.partitionBy("id").orderBy("born")
    reach = F.max("died").over(by_id.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(reach.isNull() | (F.col("born") > reach), 1).otherwise(0)
    return (
        closed.withColumn("_begins", begins)
        .withColumn("_span", F.sum("_begins").over(by_id))
        .groupBy("id", "_span")
        .agg(F.min("born").alias("born"), F.max("died").alias("died"))
        .drop("_span")
    )


def orphan_report(orphans: DataFrame, table: str) -> DataFrame:
    """(table_name, side, month, reason, n_references, n_keys): orphans per end and month of ``at``.

    Keys are counted from (period, key) pairs, so that a period that holds most
    orphans is spread over its keys.
    """
    month = F.date_format("at", "yyyy-MM").alias("month")
    pairs = orphans.groupBy("side", month, "reason", "ref").agg(F.count(F.lit(1)).alias("n"))
    return (
        pairs.groupBy("side", "month", "reason")
        .agg(F.sum("n").alias("n_references"), F.count(F.lit(1)).alias("n_keys"))
        .select(F.lit(table).alias("table_name"), "side", "month", "reason", "n_references", "n_keys")
    )
