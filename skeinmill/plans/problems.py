"""The queries of the core problems over the record tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinmill.functions.cells import local_name
from skeinmill.operators import hierarchy as H
from skeinmill.operators import orphans as O
from skeinmill.operators import skew as S
from skeinmill.session import table


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    rel = table(spark, d, "relations")
    return S.heavy_keys(rel, ["subject", "predicate"], "object", 0.02).select("field_name", "key_value")


def p2_profiles(spark: SparkSession, d: str) -> DataFrame:
    """Edge counts, distinct objects and the most frequent object of every subject and predicate."""
    rel = table(spark, d, "relations")
    parts = [S.key_profiles(rel, k, "object").select(F.lit(k).alias("field_name"), "*") for k in ("subject", "predicate")]
    return parts[0].unionByName(parts[1])


def p2_percentiles(spark: SparkSession, d: str) -> DataFrame:
    """Median and 90th percentile of the hours between statement and arrival, per predicate."""
    rel = table(spark, d, "relations")
    hours = F.floor((F.unix_micros(F.col("ingested_at").cast("timestamp")) - F.unix_micros(F.col("asserted_at").cast("timestamp"))) / F.lit(3_600_000_000))
    return S.key_percentiles(rel.select("predicate", hours.alias("hours")), "predicate", "hours", [0.5, 0.9])


def _broader(spark: SparkSession, d: str) -> DataFrame:
    """(subject, object) of the `broader` rows of relations with both ends in concepts."""
    ids = table(spark, d, "concepts").where(F.col("id").isNotNull()).select("id").distinct()
    rows = table(spark, d, "relations").where(local_name(F.col("predicate")) == "broader").select("subject", "object").distinct()
    return rows.join(ids.withColumnRenamed("id", "subject"), "subject", "left_semi").join(ids.withColumnRenamed("id", "object"), "object", "left_semi")


def broader_links(spark: SparkSession, d: str) -> DataFrame:
    return H.parent_links(_broader(spark, d), "subject", "object")


def p4_conflicts(spark: SparkSession, d: str) -> DataFrame:
    """Concepts with several parents: which of them the hierarchy follows."""
    return H.parent_conflicts(_broader(spark, d), "subject", "object").select(F.col("node").alias("concept_id"), F.col("parent").alias("parent_id"), "kept")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return H.tops(broader_links(spark, d)).select(F.col("node").alias("concept_id"), F.col("top").alias("top_id"))


def p4_hierarchy(spark: SparkSession, d: str) -> DataFrame:
    tree = H.hierarchy(table(spark, d, "concepts"), "id", broader_links(spark, d))
    return tree.select(F.col("node").alias("concept_id"), F.col("top").alias("top_id"), "depth", F.array_join("path", " > ").alias("path"), "endless")


def p4_descendants(spark: SparkSession, d: str) -> DataFrame:
    tree = H.hierarchy(table(spark, d, "concepts"), "id", broader_links(spark, d))
    return H.descendants(tree).select(F.col("ancestor").alias("concept_id"), F.col("node").alias("descendant_id"), "distance")


def _orphans(spark: SparkSession, d: str) -> DataFrame:
    refs = O.references(table(spark, d, "relations"), "record_id", ["subject", "object"], "ingested_at")
    return O.orphan_references(refs, O.lifetimes([table(spark, d, t) for t in ("entities", "concepts", "scopes")]))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return _orphans(spark, d).select("record_id", "side")


def p5_report(spark: SparkSession, d: str) -> DataFrame:
    return O.orphan_report(_orphans(spark, d), "relations")


QUERIES = {f.__name__: f for f in (p2_found, p2_profiles, p2_percentiles, p4_found, p4_hierarchy, p4_descendants, p4_conflicts, p5_found, p5_report)}

_PAIRS = """pairs AS (
  SELECT 'subject' AS field_name, subject AS key_value, object FROM relations
  UNION ALL SELECT 'predicate', predicate, object FROM relations)"""
_LINKS = r"""broader AS (
  SELECT DISTINCT subject AS node, object AS parent FROM relations
  WHERE lower(regexp_replace(trim(predicate), '^.*[:/#]\s*', '')) = 'broader'
    AND subject IN (SELECT id FROM concepts) AND object IN (SELECT id FROM concepts)),
links AS (SELECT node, min(parent) AS parent FROM broader GROUP BY node)"""
_TOPS = _LINKS + """,
reach AS (SELECT node, parent AS up FROM links UNION SELECT r.node, l.parent FROM reach r JOIN links l ON l.node = r.up),
ring AS (SELECT node FROM reach WHERE node = up),
tops AS (SELECT r.node, coalesce(min(r.up) FILTER (r.up NOT IN (SELECT node FROM links)), min(r.up) FILTER (r.up IN (SELECT node FROM ring))) AS top,
  bool_and(r.up IN (SELECT node FROM links)) AS endless FROM reach r GROUP BY r.node)"""
_TREE = _TOPS + """,
ids AS (SELECT id AS node FROM concepts WHERE id IS NOT NULL UNION SELECT node FROM links UNION SELECT parent FROM links),
forest AS (SELECT * FROM links WHERE node NOT IN (SELECT node FROM tops WHERE endless AND node = top)),
paths AS (SELECT node, node AS here, 0 AS steps, [node] AS path FROM ids
  UNION ALL SELECT p.node, f.parent, p.steps + 1, list_prepend(f.parent, p.path) FROM paths p JOIN forest f ON f.node = p.here)"""
_LIVES = """lives AS (
  SELECT id, ingested_at AS born, retracted_at AS died FROM entities
  UNION ALL SELECT id, ingested_at, NULL FROM concepts UNION ALL SELECT id, ingested_at, NULL FROM scopes),
refs AS (
  SELECT record_id, 'subject' AS side, subject AS ref, ingested_at AS seen FROM relations
  UNION ALL SELECT record_id, 'object', object, ingested_at FROM relations),
orphans AS (
  SELECT * FROM refs r WHERE ref <> '' AND NOT EXISTS (
    SELECT 1 FROM lives l WHERE l.id = r.ref AND l.born <= r.seen AND (l.died IS NULL OR r.seen < l.died)))"""

SQL = {
    "p2_found": f"""WITH {_PAIRS}
SELECT field_name, key_value FROM pairs WHERE trim(key_value) <> '' GROUP BY 1, 2
HAVING count(*) >= 0.02 * (SELECT count(*) FROM relations)""",
    "p2_profiles": f"""WITH {_PAIRS}, freq AS (
  SELECT field_name, key_value, object AS item, count(*) AS n FROM pairs WHERE trim(key_value) <> '' GROUP BY 1, 2, 3)
SELECT field_name, key_value, sum(n)::BIGINT AS n_rows, coalesce(sum(n) FILTER (item IS NOT NULL), 0)::BIGINT AS n_filled,
  count(item) AS n_distinct,
  first(item ORDER BY n DESC, item) FILTER (item IS NOT NULL) AS mode, max(n) FILTER (item IS NOT NULL) AS mode_rows
FROM freq GROUP BY 1, 2""",
    "p2_percentiles": """SELECT predicate AS key_value, q AS quantile,
  CASE q WHEN 0.5 THEN quantile_disc(h, 0.5) ELSE quantile_disc(h, 0.9) END AS value
FROM (SELECT predicate, floor((epoch_us(ingested_at) - epoch_us(asserted_at)) / 3600000000.0)::BIGINT AS h FROM relations
  WHERE trim(predicate) <> ''), (SELECT unnest([0.5::DOUBLE, 0.9::DOUBLE]) AS q) GROUP BY predicate, q""",
    "p4_found": f"WITH RECURSIVE {_TOPS} SELECT node AS concept_id, top AS top_id FROM tops",
    "p4_hierarchy": f"""WITH RECURSIVE {_TREE}
SELECT p.node AS concept_id, p.here AS top_id, p.steps::BIGINT AS depth, array_to_string(p.path, ' > ') AS path,
  coalesce(t.endless, false) AS endless
FROM paths p LEFT JOIN tops t ON t.node = p.node WHERE p.here NOT IN (SELECT node FROM forest)""",
    "p4_descendants": f"""WITH RECURSIVE {_TREE}
SELECT here AS concept_id, node AS descendant_id, steps::BIGINT AS distance FROM paths WHERE steps > 0""",
    "p4_conflicts": f"""WITH {_LINKS}
SELECT b.node AS concept_id, b.parent AS parent_id, b.parent = l.parent AS kept FROM broader b JOIN links l USING (node)
WHERE b.node IN (SELECT node FROM broader GROUP BY node HAVING count(*) > 1)""",
    "p5_found": f"WITH {_LIVES} SELECT record_id, side FROM orphans",
    "p5_report": f"""WITH {_LIVES}
SELECT 'relations' AS table_name, side, strftime(seen, '%Y-%m') AS month,
  CASE WHEN ref NOT IN (SELECT id FROM lives) THEN 'missing'
    WHEN seen < (SELECT min(born) FROM lives l WHERE l.id = ref) THEN 'early' ELSE 'gone' END AS reason,
  count(*) AS n_references, count(DISTINCT ref) AS n_keys
FROM orphans GROUP BY 1, 2, 3, 4""",
}
