"""Best representative of each duplicate group, chosen field by field by currency.

Rows are taken apart into filled cells (group, field, value). Precedence between
values is learned from all timestamped cells: wherever a group's next version of
a field differs from the one before, that is one vote for "old value before new
value", and for the trend "greater" or "longer". Votes that hold against their
reverse make a partial order per field, whose topological levels rank values
that carry no timestamp. A hot group is spread over its fields, values and
days; only per-day ends of a group are ever ordered together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skeinmill.functions.cells import is_filler, strip_blanks
from skeinmill.session import cut

#: Numeric members in which 0 is no value.
ZERO_IS_EMPTY = ("publication_year", "author_count")


def _filled(col: Column, kind: T.DataType, name: str) -> Column:
    if isinstance(kind, T.StringType):
        return ~is_filler(col)
    least = 1 if name in ZERO_IS_EMPTY else 0
    return F.coalesce(col >= least, F.lit(False))


def _entry_cell(name: str):
    return lambda e: F.struct(F.concat(F.lit(f"{name}."), e["key"]).alias("field_name"), e["value"].cast("string").alias("value"))


def cells(df: DataFrame, group: str = "id", row_id: str = "record_id", at: str = "ingested_at", maps: tuple[str, ...] = ("identifiers",), structs: tuple[str, ...] = ("properties",)) -> DataFrame:
    """(entity_id, record_id, at, field_name, value) of every filled cell, values as text.

    A text that is null, blank or filler fills nothing, nor does a negative number,
    nor a 0 in ZERO_IS_EMPTY. Rows without a group are left out. field_name is
    the column, a dot, and the map key or struct member.
    """
    found = []
    for name in structs:
        for f in df.schema[name].dataType.fields:
            col = F.col(name)[f.name]
            found.append(F.when(_filled(col, f.dataType, f.name), F.struct(F.lit(f"{name}.{f.name}").alias("field_name"), col.cast("string").alias("value"))))
    arrays = [F.filter(F.array(*found), lambda x: x.isNotNull())] if found else []
    for name in maps:
        entries = F.filter(F.coalesce(F.map_entries(name), F.array()), lambda e: ~is_filler(e["value"]))
        arrays.append(F.transform(entries, _entry_cell(name)))
    return (
        df.where(F.col(group).isNotNull())
        .select(F.col(group).alias("entity_id"), F.col(row_id).alias("record_id"), F.col(at).alias("at"), F.explode(F.concat(*arrays)).alias("cell"))
        .select("entity_id", "record_id", "at", "cell.*")
    )


def _values(filled: DataFrame) -> DataFrame:
    """One row per group, field and value: n rows, last time, whether all rows have one, and the row that stands for it."""
    newest = F.max(F.struct(F.col("at"), (-F.col("record_id")).alias("minus")))
    return (
        filled.groupBy("entity_id", "field_name", strip_blanks(F.col("value")).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"), newest.alias("newest"), F.count("at").alias("n_timed"))
        .select("entity_id", "field_name", "value", "n", "n_timed", F.col("newest.at").alias("at"), (-F.col("newest.minus")).alias("record_id"))
    )


def changes(filled: DataFrame) -> DataFrame:
    """(field_name, old, new, n): how often a group's next timestamped version replaced ``old`` by ``new``.

    Versions are followed within each day first and from one day's last to the
    next day's first after that, so that a hot group is not sorted in one task.
    Of versions with equal times the smaller value counts as earlier.
    """
    timed = filled.where(F.col("at").isNotNull()).select("entity_id", "field_name", strip_blanks(F.col("value")).alias("value"), "at").withColumn("day", F.to_date("at"))
    order = F.struct("at", "value")
    inside = timed.select("field_name", F.lag("value").over(Window.partitionBy("entity_id", "field_name", "day").orderBy("at", "value")).alias("old"), F.col("value").alias("new"))
    ends = timed.groupBy("entity_id", "field_name", "day").agg(F.min(order).alias("first"), F.max(order).alias("last"))
    between = ends.select("field_name", F.lag("last.value").over(Window.partitionBy("entity_id", "field_name").orderBy("day")).alias("old"), F.col("first.value").alias("new"))
    both = inside.unionByName(between).where(F.col("old").isNotNull() & (F.col("old") != F.col("new")))
    return both.groupBy("field_name", "old", "new").agg(F.count(F.lit(1)).alias("n"))


def precedence(votes: DataFrame, support: int = 3, odds: float = 3.0) -> DataFrame:
    """(field_name, old, new): changes seen ``support`` times and ``odds`` times as often as their reverse."""
    back = votes.select("field_name", F.col("new").alias("old"), F.col("old").alias("new"), F.col("n").alias("against"))
    return (
        votes.where(F.col("n") >= support)
        .join(back, ["field_name", "old", "new"], "left")
        .where(F.col("n") >= odds * F.coalesce("against", F.lit(0)))
        .select("field_name", "old", "new")
    )


def trends(votes: DataFrame) -> DataFrame:
    """(field_name, greater, longer): shares of changes towards a greater number and towards a longer text."""
    old, new = F.expr("try_cast(old AS DOUBLE)"), F.expr("try_cast(new AS DOUBLE)")
    share = lambda up, down: F.coalesce(F.sum(F.when(up, F.col("n"))), F.lit(0)) / F.sum(F.when(up | down, F.col("n")))
    return votes.groupBy("field_name").agg(
        share(new > old, new < old).alias("greater"),
        share(F.length("new") > F.length("old"), F.length("new") < F.length("old")).alias("longer"),
    )


def levels(order: DataFrame) -> DataFrame:
    """(field_name, value, level): topological level of every value of a precedence relation.

    Values nothing precedes have level 0, others one more than the highest value
    before them. Values on or behind a cycle are not ordered and do not come out.
    """
    order = cut(order)
    ends = order.select("field_name", F.col("old").alias("value")).union(order.select("field_name", F.col("new").alias("value"))).distinct()
    left, level, out = cut(ends), 0, None
    while True:
        held = order.join(left.withColumnRenamed("value", "old"), ["field_name", "old"], "left_semi").select("field_name", F.col("new").alias("value")).distinct()
        free = cut(left.join(held, ["field_name", "value"], "left_anti").withColumn("level", F.lit(level)))
        out = free if out is None else out.unionByName(free)
        if free.isEmpty():
            return out
        left = cut(left.join(free, ["field_name", "value"], "left_anti"))
        level += 1


def survivors(df: DataFrame, support: int = 3, odds: float = 3.0, **columns) -> DataFrame:
    """(entity_id, field_name, value, record_id, n_filled, n_values, basis): the surviving value of each field of each group.

    ``record_id`` is the row the value comes from (the newest with it, of several
    the least), n_filled the number of the group's rows that fill the field. If all
    filled cells have timestamps, the newest value wins (``time``). Otherwise the
    newest timestamped value competes with those without: the highest learned
    level wins (``order``), at equal levels or without one the field's trend
    decides (``trend``, where at least ``odds`` to one), then the more frequent, the
    longer and the smaller value (``completeness``). Fields nobody fills do not
    come out; repeated rows count as rows.
    """
    filled = cut(cells(df, **columns))
    values = _values(filled)
    untimed = cut(values.where(F.col("n_timed") < F.col("n")).select("entity_id", "field_name").distinct())
    timed = values.join(untimed, ["entity_id", "field_name"], "left_anti")
    chosen = ("value", "record_id")
    key = F.struct("at", "n", F.length("value").alias("long"))
    best = timed.groupBy("entity_id", "field_name").agg(
        F.sum("n").alias("n_filled"), F.count(F.lit(1)).alias("n_values"), F.max(key).alias("top")
    )
    # The newest value is found as a maximum; of equals the smallest value by a second, equally spread pass.
    newest = (
        timed.join(best, ["entity_id", "field_name"])
        .where(key == F.col("top"))
        .groupBy("entity_id", "field_name")
        .agg(F.min(F.struct(*chosen)).alias("pick"), F.first("n_filled").alias("n_filled"), F.first("n_values").alias("n_values"))
        .select("entity_id", "field_name", "pick.value", "pick.record_id", "n_filled", "n_values", F.lit("time").alias("basis"))
    )
    if untimed.isEmpty():
        return newest
    return newest.unionByName(_by_order(values, untimed, changes(filled), support, odds))


def _by_order(values: DataFrame, untimed: DataFrame, votes: DataFrame, support: int, odds: float) -> DataFrame:
    votes = cut(votes)
    ranks = levels(precedence(votes, support, odds))
    lean = odds / (odds + 1)
    rows = values.join(untimed, ["entity_id", "field_name"], "left_semi")
    last = rows.groupBy("entity_id", "field_name").agg(F.max("at").alias("last"), F.sum("n").alias("n_filled"), F.count(F.lit(1)).alias("n_values"))
    number = F.expr("try_cast(value AS DOUBLE)")
    size = F.length("value")
    sign = lambda share, by: F.when(F.col(share) >= lean, by).when(F.col(share) <= 1 - lean, -by)
    running = (
        rows.join(last, ["entity_id", "field_name"])
        .where((F.col("n_timed") < F.col("n")) | (F.col("at") == F.col("last")))
        .join(ranks, ["field_name", "value"], "left")
        .join(trends(votes), "field_name", "left")
        .withColumn("_trend", F.coalesce(sign("greater", number), sign("longer", size.cast("double")), F.lit(0.0)))
        .withColumn("_key", F.struct(F.coalesce("level", F.lit(-1)).alias("level"), F.col("_trend").alias("trend"), F.col("n"), size.alias("size")))
    )
    top = running.groupBy("entity_id", "field_name").agg(
        F.max("_key").alias("_top"), F.min("_key.level").alias("_low"), F.min("_key.trend").alias("_flat")
    )
    basis = F.when(F.col("_top.level") > F.col("_low"), "order").when(F.col("_top.trend") > F.col("_flat"), "trend").otherwise("completeness")
    return (
        running.join(top, ["entity_id", "field_name"])
        .where(F.col("_key") == F.col("_top"))
        .groupBy("entity_id", "field_name")
        .agg(F.min(F.struct("value", "record_id")).alias("pick"), F.first("n_filled").alias("n_filled"), F.first("n_values").alias("n_values"), F.first(basis).alias("basis"))
        .select("entity_id", "field_name", "pick.value", "pick.record_id", "n_filled", "n_values", "basis")
    )


def merged(chosen: DataFrame) -> DataFrame:
    """(entity_id, fields MAP, sources MAP): one built record per group, bounded by the number of field names."""
    entry = lambda c: F.struct("field_name", c)
    return chosen.groupBy("entity_id").agg(
        F.map_from_entries(F.array_sort(F.collect_list(entry("value")))).alias("fields"),
        F.map_from_entries(F.array_sort(F.collect_list(entry("record_id")))).alias("sources"),
    )


def sole_fillers(df: DataFrame, **columns) -> DataFrame:
    """(entity_id, field_name, record_id) of fields that exactly one row of a group of two or more fills."""
    group = columns.get("group", "id")
    several = df.where(F.col(group).isNotNull()).groupBy(F.col(group).alias("entity_id")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return survivors(df, **columns).where(F.col("n_filled") == 1).join(several, "entity_id", "left_semi").select("entity_id", "field_name", "record_id")
