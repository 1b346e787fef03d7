"""What the graph holds: classes, properties, predicates and their vocabulary."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skeinmill.operators.skew import even_join
from skeinmill.session import cut


def class_census(entities: DataFrame, kind: str = "rdf_type") -> DataFrame:
    """(class, n): distinct ids per class; an id with several counts for the greatest (A1)."""
    one = entities.where(F.col("id").isNotNull()).groupBy("id").agg(F.max(F.coalesce(kind, F.lit("unknown"))).alias("class"))
    return one.groupBy("class").agg(F.count(F.lit(1)).alias("n"))


def property_census(entities: DataFrame, kind: str = "rdf_type") -> DataFrame:
    """(class, property, n): rows of a class that fill a property; null and "" fill none (A2)."""
    members = entities.schema["properties"].dataType.fields
    filled = lambda f: (F.col("properties")[f.name] != "") if isinstance(f.dataType, T.StringType) else F.col("properties")[f.name].isNotNull()
    names = F.filter(F.array(*[F.when(filled(f), F.lit(f.name)) for f in members]), lambda x: x.isNotNull())
    return (
        entities.select(F.coalesce(kind, F.lit("unknown")).alias("class"), F.explode(names).alias("property"))
        .groupBy("class", "property")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def example_names(entities: DataFrame, order: str | None = None, kind: str = "rdf_type", first: int = 3) -> DataFrame:
    """(class, rank, name): the first names of each class in order of ``order``, by default record_id or, without one, id (A3).

    Each task keeps its own first rows per class before the classes meet, so that
    a class with most rows is not sorted as a whole.
    """
    order = order or ("record_id" if "record_id" in entities.columns else "id")
    rows = entities.where(F.col("name") != "").select(F.coalesce(kind, F.lit("unknown")).alias("class"), F.col(order).alias("_o"), "name")
    part = Window.partitionBy("class", F.col("_slice")).orderBy("_o")
    near = rows.withColumn("_slice", F.pmod(F.xxhash64("_o"), F.lit(64))).withColumn("_k", F.row_number().over(part)).where(F.col("_k") <= first)
    return near.withColumn("rank", F.row_number().over(Window.partitionBy("class").orderBy("_o"))).where(F.col("rank") <= first).select("class", "rank", "name")


def predicate_census(relations: DataFrame, entities: DataFrame, kind: str = "type") -> DataFrame:
    """(predicate, domain, range, n): edges by the types of their ends, unknown where an end has none.

    Edges are counted per (predicate, subject, object) ends first where that
    shrinks them; types are one row per id.
    """
    types = entities.where(F.col("id").isNotNull()).groupBy("id").agg(F.max(kind).alias("t"))
    ends = relations.where(F.trim("predicate") != "").groupBy("predicate", "subject", "object").agg(F.count(F.lit(1)).alias("n"))
    a, b = types.select(F.col("id").alias("subject"), F.col("t").alias("domain")), types.select(F.col("id").alias("object"), F.col("t").alias("range"))
    half = even_join(cut(ends), cut(a), "subject", "left").groupBy("predicate", F.coalesce("domain", F.lit("unknown")).alias("domain"), "object").agg(F.sum("n").alias("n"))
    return even_join(cut(half), cut(b), "object", "left").groupBy("predicate", "domain", F.coalesce("range", F.lit("unknown")).alias("range")).agg(F.sum("n").alias("n"))


def vocabulary(entities: DataFrame, relations: DataFrame) -> DataFrame:
    """(term): property and predicate names in use, with the fixed canonical_id (A5)."""
    props = property_census(entities).select(F.col("property").alias("term"))
    preds = relations.where(F.trim("predicate") != "").select(F.col("predicate").alias("term"))
    fixed = entities.sparkSession.createDataFrame([("canonical_id",)], "term string")
    return props.union(preds).union(fixed).distinct()


def unknown_terms(asked: DataFrame, known: DataFrame) -> DataFrame:
    """Asked terms that the vocabulary lacks (Q-20)."""
    return asked.where(F.col("term").isNotNull()).distinct().join(known, "term", "left_anti")


def occurrence_counts(rows: DataFrame, kind: str, items) -> DataFrame:
    """(kinds, items): how many different values of ``kind`` there are, and how many list items in all."""
    return rows.agg(F.count_distinct(kind).alias("kinds"), F.coalesce(F.sum(F.size(F.coalesce(items, F.array().cast("array<string>")))), F.lit(0)).alias("items"))


def schema_card(entities: DataFrame, relations: DataFrame, top: int = 20, most: int = 200) -> str:
    """The census as text for a prompt: classes and their ``top`` properties by frequency, the ``most`` frequent predicates by domain and range."""
    props: dict[str, list] = {}
    ranked = property_census(entities).withColumn("k", F.row_number().over(Window.partitionBy("class").orderBy(F.desc("n"), "property"))).where(F.col("k") <= top)
    for r in ranked.orderBy("class", "k").collect():
        props.setdefault(r["class"], []).append(f"{r['property']} ({r['n']})")
    names: dict[str, list] = {}
    for r in example_names(entities).orderBy("class", "rank").collect():
        names.setdefault(r["class"], []).append(r["name"])
    lines = ["Classes:"]
    for r in class_census(entities).orderBy(F.desc("n"), "class").collect():
        lines.append(f"- {r['class']}: {r['n']}; properties: {', '.join(props.get(r['class'], []))}; e.g. {'; '.join(names.get(r['class'], []))}")
    lines.append("Predicates:")
    for r in predicate_census(relations, entities).orderBy(F.desc("n"), "predicate", "domain", "range").limit(most).collect():
        lines.append(f"- {r['predicate']}: {r['domain']} -> {r['range']} ({r['n']})")
    return "\n".join(lines)
