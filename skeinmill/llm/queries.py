"""The queries of the training-data problems, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinmill.llm import components as C
from skeinmill.llm import glyphs as G
from skeinmill.llm import leakage as L
from skeinmill.llm import mixing as M
from skeinmill.llm import names as N
from skeinmill.llm import survivor as V
from skeinmill.session import cut, table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return N.same_name_pairs(table(spark, d, "entities"), table(spark, d, "aliases"))


def p1_groups(spark: SparkSession, d: str) -> DataFrame:
    """Every person and institution with its group."""
    return N.name_groups(table(spark, d, "entities"), table(spark, d, "aliases"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    groups = cut(C.alias_groups(table(spark, d, "aliases")))
    several = groups.groupBy("group_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select("group_id")
    return groups.join(several, "group_id", "left_semi").select("entity_id", "group_id")


def p3_groups(spark: SparkSession, d: str) -> DataFrame:
    """Every entity_id with its group, also those alone in it."""
    return C.alias_groups(table(spark, d, "aliases"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return V.sole_fillers(table(spark, d, "entities"))


def p6_survivors(spark: SparkSession, d: str) -> DataFrame:
    """The surviving value of every field of every id, with the row it comes from and why."""
    return V.survivors(table(spark, d, "entities"))


def p6_undated(spark: SparkSession, d: str) -> DataFrame:
    """The surviving values if every third row had lost its timestamp: there the learned order of values decides."""
    rows = table(spark, d, "entities")
    return V.survivors(rows.withColumn("ingested_at", F.when(F.col("record_id") % 3 != 0, F.col("ingested_at"))))


def p6_order(spark: SparkSession, d: str) -> DataFrame:
    """The learned precedence of values: the level of each value of each field."""
    return V.levels(V.precedence(V.changes(V.cells(table(spark, d, "entities")))))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return L.leaks(table(spark, d, "documents"), table(spark, d, "eval_items")).select("doc_id", "item_id")


def p7_items(spark: SparkSession, d: str) -> DataFrame:
    """The items that leaked, with the number of documents they stand in."""
    return L.leaked_items(L.leaks(table(spark, d, "documents"), table(spark, d, "eval_items")))


def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    """The selection: which tokens of which document fill each slot, and in which repeat of their source."""
    return M.mix(table(spark, d, "documents"), table(spark, d, "mix_targets"))


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    """Target and reached share, tokens, and repeats of every source with a target."""
    docs, targets = table(spark, d, "documents"), table(spark, d, "mix_targets")
    return M.shares(cut(M.mix(docs, targets)), M.token_counts(docs), targets)


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return G.look_alike_pairs(table(spark, d, "documents"))


def p9_canonical(spark: SparkSession, d: str) -> DataFrame:
    """Every document's text in one form."""
    return G.canonical_texts(table(spark, d, "documents")).select("doc_id", "canonical")


QUERIES = {f.__name__: f for f in (p1_found, p1_groups, p3_found, p3_groups, p6_found, p6_survivors, p6_undated, p6_order, p7_found, p7_items, p8_mix, p8_shares, p9_found, p9_canonical)}

_FILLERS = "('', '-', '--', '?', 'n/a', 'n.a.', 'n/s', 'nil', 'none', 'not available', 'not given', 'not known', 'not stated', 'null', 'tbd', 'unknown', 'unspecified')"
_GROUPS = f"""rows AS (
  SELECT DISTINCT entity_id, lower(trim(alias)) AS key FROM aliases
  WHERE entity_id IS NOT NULL AND lower(trim(alias)) NOT IN {_FILLERS}),
pairs AS (SELECT a.entity_id AS x, b.entity_id AS y FROM rows a JOIN (SELECT key, min(entity_id) AS entity_id FROM rows GROUP BY key) b USING (key)),
links AS (SELECT x, y FROM pairs UNION SELECT y, x FROM pairs),
ids AS (SELECT DISTINCT entity_id FROM aliases WHERE entity_id IS NOT NULL),
reach AS (SELECT entity_id AS x, entity_id AS y FROM ids UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y),
groups AS (SELECT x AS entity_id, min(y) AS group_id FROM reach GROUP BY x)"""
_TEXTS = ("citation_key", "entry_type", "author_list", "journal", "source_url", "description", "institution_kind", "start_date", "end_date", "location")
_CELLS = "cells AS (\n" + "\n  UNION ALL ".join(
    [f"SELECT id, record_id, ingested_at, 'properties.{m}' AS field_name, properties.{m} AS value FROM entities WHERE lower(trim(properties.{m})) NOT IN {_FILLERS}" for m in _TEXTS]
    + [f"SELECT id, record_id, ingested_at, 'properties.{m}', properties.{m}::VARCHAR FROM entities WHERE properties.{m} >= {least}" for m, least in (("publication_year", 1), ("citation_count", 0), ("author_count", 1))]
    + [f"SELECT id, record_id, ingested_at, 'identifiers.' || e.key, e.value FROM (SELECT id, record_id, ingested_at, unnest(map_entries(identifiers)) AS e FROM entities) WHERE lower(trim(e.value)) NOT IN {_FILLERS}"]
) + ")"
_VALUES = f"""WITH {_CELLS}, vals AS (
  SELECT id, field_name, trim(value) AS value, count(*) AS n, max(ingested_at) AS newest, arg_min(record_id, (-epoch_us(ingested_at), record_id)) AS record_id
  FROM cells WHERE id IS NOT NULL GROUP BY 1, 2, 3)"""

_UNDATED = _CELLS.replace("FROM entities", "FROM dated")
_ORDER = """steps AS (
  SELECT field_name, trim(value) AS new, lag(trim(value)) OVER (PARTITION BY id, field_name ORDER BY ingested_at, trim(value)) AS old
  FROM cells WHERE id IS NOT NULL AND ingested_at IS NOT NULL),
votes AS (SELECT field_name, old, new, count(*) AS n FROM steps WHERE old <> new GROUP BY 1, 2, 3),
ahead AS (
  SELECT a.field_name, a.old, a.new FROM votes a LEFT JOIN votes b ON a.field_name = b.field_name AND a.old = b.new AND a.new = b.old
  WHERE a.n >= 3 AND a.n >= 3 * coalesce(b.n, 0)),
reach AS (SELECT * FROM ahead UNION SELECT r.field_name, r.old, a.new FROM reach r JOIN ahead a ON a.field_name = r.field_name AND a.old = r.new),
behind AS (SELECT DISTINCT r.field_name, r.new AS value FROM reach r JOIN reach c ON c.field_name = r.field_name AND c.old = r.old AND c.new = c.old),
ends AS (SELECT field_name, old AS value FROM ahead UNION SELECT field_name, new FROM ahead),
walk AS (
  SELECT field_name, value, 0 AS level FROM (SELECT * FROM ends EXCEPT SELECT * FROM behind)
  UNION SELECT a.field_name, a.new, w.level + 1 FROM walk w JOIN ahead a ON a.field_name = w.field_name AND a.old = w.value
  WHERE (a.field_name, a.new) NOT IN (SELECT (field_name, value) FROM behind)),
levels AS (SELECT field_name, value, max(level) AS level FROM walk GROUP BY 1, 2)"""
_CHOICE = """vals AS (
  SELECT id, field_name, trim(value) AS value, count(*) AS n, count(ingested_at) AS n_timed, max(ingested_at) AS seen,
    first(record_id ORDER BY ingested_at DESC NULLS LAST, record_id) AS record_id
  FROM cells WHERE id IS NOT NULL GROUP BY 1, 2, 3),
trends AS (
  SELECT field_name,
    sum(n) FILTER (try_cast(new AS DOUBLE) > try_cast(old AS DOUBLE)) AS up, sum(n) FILTER (try_cast(new AS DOUBLE) <> try_cast(old AS DOUBLE)) AS moved,
    sum(n) FILTER (length(new) > length(old)) AS grown, sum(n) FILTER (length(new) <> length(old)) AS resized
  FROM votes GROUP BY 1),
leans AS (SELECT field_name, coalesce(up, 0) / moved AS greater, coalesce(grown, 0) / resized AS grows FROM trends),
grouped AS (
  SELECT *, bool_or(n_timed < n) OVER g AS is_open, max(seen) OVER g AS latest, (sum(n) OVER g)::BIGINT AS n_filled, count(*) OVER g AS n_values
  FROM vals WINDOW g AS (PARTITION BY id, field_name)),
running AS (
  SELECT g.*, coalesce(l.level, -1) AS level, coalesce(
    CASE WHEN t.greater >= 0.75 THEN try_cast(g.value AS DOUBLE) WHEN t.greater <= 0.25 THEN -try_cast(g.value AS DOUBLE) END,
    CASE WHEN t.grows >= 0.75 THEN length(g.value)::DOUBLE WHEN t.grows <= 0.25 THEN -length(g.value)::DOUBLE END, 0.0) AS trend
  FROM grouped g LEFT JOIN levels l ON l.field_name = g.field_name AND l.value = g.value LEFT JOIN leans t ON t.field_name = g.field_name
  WHERE is_open AND (n_timed < n OR seen = latest)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY id, field_name ORDER BY level DESC, trend DESC, n DESC, length(value) DESC, value, record_id) AS k,
    min(level) OVER (PARTITION BY id, field_name) AS low, min(trend) OVER (PARTITION BY id, field_name) AS flat FROM running),
newest AS (
  SELECT *, row_number() OVER (PARTITION BY id, field_name ORDER BY seen DESC, n DESC, length(value) DESC, value, record_id) AS k FROM grouped WHERE NOT is_open)"""

SQL = {
    "p3_found": f"WITH RECURSIVE {_GROUPS} SELECT entity_id, group_id FROM groups WHERE group_id IN (SELECT group_id FROM groups GROUP BY 1 HAVING count(*) > 1)",
    "p3_groups": f"WITH RECURSIVE {_GROUPS} SELECT entity_id, group_id FROM groups",
    "p6_found": f"""WITH {_CELLS}
SELECT id AS entity_id, field_name, min(record_id) AS record_id FROM cells
WHERE id IN (SELECT id FROM entities GROUP BY id HAVING count(*) > 1) GROUP BY 1, 2 HAVING count(*) = 1""",
    "p6_order": f"WITH RECURSIVE {_CELLS}, {_ORDER} SELECT field_name, value, level FROM levels",
    "p6_undated": f"""WITH RECURSIVE dated AS (SELECT * REPLACE (CASE WHEN record_id % 3 <> 0 THEN ingested_at END AS ingested_at) FROM entities),
{_UNDATED}, {_ORDER}, {_CHOICE}
SELECT id AS entity_id, field_name, value, record_id, n_filled, n_values, 'time' AS basis FROM newest WHERE k = 1
UNION ALL SELECT id, field_name, value, record_id, n_filled, n_values,
  CASE WHEN level > low THEN 'order' WHEN trend > flat THEN 'trend' ELSE 'completeness' END FROM ranked WHERE k = 1""",
    "p6_survivors": f"""{_VALUES}
SELECT id AS entity_id, field_name, value, record_id, n_filled::BIGINT AS n_filled, n_values, 'time' AS basis FROM (
  SELECT *, sum(n) OVER (PARTITION BY id, field_name) AS n_filled, count(*) OVER (PARTITION BY id, field_name) AS n_values,
    row_number() OVER (PARTITION BY id, field_name ORDER BY newest DESC, n DESC, length(value) DESC, value) AS k FROM vals) WHERE k = 1""",
}
