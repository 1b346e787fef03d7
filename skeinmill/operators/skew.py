"""Per-key figures that stay even when a few keys hold most rows.

Everything goes through a value-frequency table: rows are grouped by key *and*
value first, so a key's rows spread over as many tasks as it has values and
repeated values shrink to one weighted row before they move. The second
grouping, by key alone, sees at most one partial row per key and task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skeinmill.functions.cells import is_blank
from skeinmill.session import cut


def value_frequencies(df: DataFrame, key: str, value: str, key_is_value: Column | None = None) -> DataFrame:
    """(key_value, item, n): how often each key holds each value.

    Null and blank keys are no keys and drop out; a null value stays as an item
    that is null. ``key_is_value`` replaces the test on keys. An empty table
    gives an empty result; further columns of ``df`` are never read.
    """
    src = df.select(F.col(key).alias("key_value"), F.col(value).alias("item"))
    if key_is_value is None:
        text = dict(src.dtypes)["key_value"] == "string"
        key_is_value = ~is_blank(F.col("key_value")) if text else F.col("key_value").isNotNull()
    return src.where(key_is_value).groupBy("key_value", "item").agg(F.count(F.lit(1)).alias("n"))


def key_profiles(df: DataFrame, key: str, value: str) -> DataFrame:
    """One row per key: n_rows, n_filled, n_distinct, mode, mode_rows.

    n_rows counts all rows of the key, n_filled those whose value is not null,
    n_distinct its different non-null values; mode is the most frequent
    non-null value, of several the smallest (null if there is none).
    """
    freq = value_frequencies(df, key, value)
    filled = F.col("item").isNotNull()
    best = F.min(F.when(filled, F.struct((-F.col("n")).alias("minus"), F.col("item").alias("item"))))
    return (
        freq.groupBy("key_value")
        .agg(
            F.sum("n").alias("n_rows"),
            F.coalesce(F.sum(F.when(filled, F.col("n"))), F.lit(0)).alias("n_filled"),
            F.count("item").alias("n_distinct"),
            best.alias("best"),
        )
        .select(
            "key_value", "n_rows", "n_filled", "n_distinct",
            F.col("best.item").alias("mode"), (-F.col("best.minus")).alias("mode_rows"),
        )
    )


def heavy_keys(df: DataFrame, keys: list[str], value: str, share: float) -> DataFrame:
    """(field_name, key_value, n_rows, n_distinct, mode) of every key with at least ``share`` of all rows.

    All rows count towards the total, those with a null or blank key too. The
    total is joined as a one-row aggregate. Ties and repeated rows count as rows.
    """
    total = df.agg(F.count(F.lit(1)).alias("total"))
    parts = [key_profiles(df, k, value).select(F.lit(k).alias("field_name"), "*") for k in keys]
    profiles = parts[0]
    for part in parts[1:]:
        profiles = profiles.unionByName(part)
    return (
        profiles.join(F.broadcast(total), F.col("n_rows") >= F.lit(share) * F.col("total"))
        .select("field_name", F.col("key_value"), "n_rows", "n_distinct", "mode")
    )


def running_totals(df: DataFrame, keys: list[str], order: list[str], weight: str, parts: int | None = None) -> DataFrame:
    """``df`` plus ``before`` and ``total``: the weight of the key's earlier rows, and of all its rows.

    Rows are range-partitioned by key and order, summed within each slice, and
    slices are offset by the totals of the slices before them: a hot key is cut
    into many slices instead of being sorted in one task. ``order`` has to make
    a key's rows distinct for the result to be unique; a null weight counts 0.
    Only slice totals (at most one row per key and slice) are windowed by key.
    """
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sliced = cut(df.repartitionByRange(parts, *keys, *order).withColumn("_slice", F.spark_partition_id()))
    w = F.coalesce(F.col(weight), F.lit(0))
    inside = Window.partitionBy("_slice", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    sums = sliced.groupBy("_slice", *keys).agg(F.sum(w).alias("_sum"))
    by_key = Window.partitionBy(*keys)
    offsets = sums.select(
        "_slice", *keys,
        F.coalesce(F.sum("_sum").over(by_key.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset"),
        F.sum("_sum").over(by_key).alias("total"),
    )
    return (
        sliced.withColumn("_in", F.coalesce(F.sum(w).over(inside), F.lit(0)))
        .join(offsets, ["_slice", *keys])
        .withColumn("before", F.col("_in") + F.col("_offset"))
        .drop("_slice", "_in", "_offset")
    )


def key_percentiles(df: DataFrame, key: str, value: str, quantiles: list[float]) -> DataFrame:
    """(key_value, quantile, value): exact discrete percentiles per key, from weighted values.

    The value at quantile q is the smallest whose rows, with those of all smaller
    values, make up at least q of the key's non-null rows (``percentile_disc``).
    Keys without a non-null value do not come out.
    """
    freq = value_frequencies(df, key, value).where(F.col("item").isNotNull())
    ranked = running_totals(freq, ["key_value"], ["item"], "n")
    wanted = F.array(*[F.lit(float(q)) for q in quantiles])
    need = F.greatest(F.ceil(F.col("quantile") * F.col("total")), F.lit(1))
    return (
        ranked.withColumn("quantile", F.explode(wanted))
        .where((F.col("before") < need) & (need <= F.col("before") + F.col("n")))
        .select("key_value", "quantile", F.col("item").alias("value"))
    )


#: A key is hot if it holds more than one in HOT_PARTS rows and more than HOT_ROWS of them.
HOT_PARTS = 1_000
HOT_ROWS = 10_000


def hot_keys(df: DataFrame, key: str) -> list:
    """The hot keys of a table: by their definition fewer than HOT_PARTS, so they may come to the driver."""
    total = df.agg(F.count(F.lit(1)).alias("_total"))
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > HOT_ROWS)
    return [r[0] for r in counts.join(F.broadcast(total), F.col("_n") * HOT_PARTS > F.col("_total")).select(key).collect()]


#: Bytes of a lookup up to which it is broadcast; of what was cut before, the size is measured.
BROADCAST = 8 << 20


def estimated_size(df: DataFrame) -> int:
    """Bytes of a frame as planned: the size of files read and of frames cut, and for joins a product that is never too small."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def even_join(big: DataFrame, lookup: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``big`` joined with ``lookup``, which has at most one row per key, however uneven the keys of ``big``.

    A lookup of at most BROADCAST bytes is broadcast whole. Of a larger one the rows of hot
    keys, fewer than HOT_PARTS, are broadcast and all other rows are shuffled by
    key; ``big`` is read once more to count its keys. ``how`` is ``inner`` or ``left``;
    null keys match nothing.
    """
    if estimated_size(lookup) <= BROADCAST:
        return big.join(F.broadcast(lookup), key, how)
    hot = hot_keys(big, key)
    if not hot:
        return big.join(lookup, key, how)
    at = F.coalesce(F.col(key).isin(*hot), F.lit(False))
    return big.where(at).join(F.broadcast(lookup.where(F.col(key).isin(*hot))), key, how).unionByName(big.where(~at).join(lookup, key, how))
