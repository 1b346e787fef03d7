"""Consolidating pairwise matches into groups: connected components of links.

Rake and compress: each round takes vertices of degree one, and of each run of
degree-two vertices an independent set (a vertex goes if its hash is below that
of every neighbour of degree two or less), out of the graph. A leaf hangs on
its neighbour; a bypassed chain vertex hangs on one neighbour and leaves a link
between both, the list-ranking step that halves chains however long. What is
left has few vertices below degree three; this core is contracted by hooking
every vertex on its least neighbour until no link remains. All hooks together
form a forest, and one walk up the forest restores the group of every vertex.
No step gathers a group, and edges are only ever keyed by both ends, so neither
a hub nor a huge component lands in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinmill.functions.cells import folded, is_filler
from skeinmill.operators.hierarchy import tops
from skeinmill.operators.skew import even_join
from skeinmill.session import cut

#: Core links that one task solves in memory (two ids each).
CHUNK = 100_000
#: Rounds of raking that any graph gets, and links few enough to be left to the core after them.
ROUNDS, FEW = 3, 1_000


def _undirected(links: DataFrame) -> DataFrame:
    return (
        links.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )


def _rank(col):
    return F.struct(F.xxhash64(col).alias("h"), col.alias("v"))


def _rake(edges: DataFrame) -> DataFrame:
    """(v, n1, n2, degree) of an independent set of vertices of degree one or two."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("v"), F.col("b").alias("u")), F.struct(F.col("b").alias("v"), F.col("a").alias("u")))).alias("x")).select("x.*")
    low = ends.groupBy("v").agg(F.count(F.lit(1)).alias("degree"), F.min("u").alias("n1"), F.max("u").alias("n2")).where(F.col("degree") <= 2)
    near = (
        low.select(F.explode(F.array_distinct(F.array("n1", "n2"))).alias("v"), _rank(F.col("v")).alias("r"))
        .groupBy("v")
        .agg(F.min("r").alias("least"))
    )
    won = F.col("least").isNull() | (_rank(F.col("v")) < F.col("least"))
    return low.join(near, "v", "left").where(won).select("v", "n1", "n2", "degree")


def _union_find(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    root: dict[str, str] = {}

    def find(x: str) -> str:
        top = x
        while root.get(top, top) != top:
            top = root[top]
        while root.get(x, x) != top:
            root[x], x = top, root[x]
        return top

    for pdf in frames:
        for a, b in zip(pdf["a"], pdf["b"]):
            a, b = find(a), find(b)
            root.setdefault(a, a)
            root.setdefault(b, b)
            if a != b:
                root[max(a, b)] = min(a, b)
    hooks = [(x, find(x)) for x in root]
    hooks = [h for h in hooks if h[0] != h[1]]
    for i in range(0, len(hooks), 10_000):
        yield pd.DataFrame(hooks[i : i + 10_000], columns=["node", "parent"])


def _core(edges: DataFrame, chunk: int) -> DataFrame:
    """Hooks (node, parent) that join up every component of ``edges``."""
    hooks = []
    while True:
        n = edges.count()
        if n <= chunk:
            last = edges.coalesce(1).mapInPandas(_union_find, "node string, parent string")
            for h in hooks:
                last = last.unionByName(h)
            return cut(last)
        # b is always the greater end: every vertex but the local minima hooks on its least neighbour.
        hook = cut(edges.groupBy("b").agg(F.min("a").alias("a")).select(F.col("b").alias("node"), F.col("a").alias("parent")))
        hooks.append(hook)
        up = cut(tops(hook).select("node", "top"))
        one = even_join(edges.withColumnRenamed("a", "node"), up, "node", "left").select(F.coalesce("top", "node").alias("a"), F.col("b").alias("node"))
        both = even_join(one, up, "node", "left").select("a", F.coalesce("top", "node").alias("b"))
        edges = cut(_undirected(both))


def components(links: DataFrame, chunk: int = CHUNK, least_gain: float = 0.05) -> DataFrame:
    """(node, group_id) for every vertex of ``links`` (a, b STRING): group_id is the group's least vertex.

    Null ends and links of a vertex with itself link nothing; repeated and
    reversed links count once. Raking ends when no link is left, when after ROUNDS
    the rest is FEW or fewer links, or when a round takes less than ``least_gain`` of
    them, which changes the work but not the result.
    """
    edges = cut(_undirected(links))
    hooks, n = [], edges.count()
    while n and (len(hooks) < ROUNDS or n > FEW):
        raked = cut(_rake(edges))
        hooks.append(raked.select(F.col("v").alias("node"), F.col("n1").alias("parent")))
        both = F.array(F.struct(F.least("v", "n1").alias("a"), F.greatest("v", "n1").alias("b")), F.struct(F.least("v", "n2").alias("a"), F.greatest("v", "n2").alias("b")))
        taken = raked.select(F.explode(both).alias("x")).select("x.a", "x.b").distinct()
        bypass = raked.where(F.col("degree") == 2).select(F.col("n1").alias("a"), F.col("n2").alias("b"))
        edges = cut(_undirected(edges.join(taken, ["a", "b"], "left_anti").unionByName(bypass)))
        before, n = n, edges.count()
        if before - n < least_gain * before:
            break
    forest = _core(edges, chunk)
    for h in hooks:
        forest = forest.unionByName(h)
    up = cut(tops(forest).select("node", "top"))
    everyone = up.unionByName(up.select(F.col("top").alias("node"), "top").distinct())
    least = everyone.groupBy("top").agg(F.min("node").alias("group_id"))
    return even_join(everyone, least, "top").select("node", "group_id")


def alias_links(aliases: DataFrame) -> DataFrame:
    """(a, b): every entity_id linked with the least one under the same alias.

    Aliases are equal but for letter case and blanks around them, whatever their
    kind. Null, blank and filler aliases and null entity ids link nothing. An
    alias with k entity ids gives k - 1 links, never all pairs.
    """
    rows = cut(
        aliases.where(F.col("entity_id").isNotNull() & ~is_filler(F.col("alias")))
        .select("entity_id", folded(F.col("alias")).alias("key"))
        .distinct()
    )
    hubs = rows.groupBy("key").agg(F.min("entity_id").alias("hub"), F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select("key", "hub")
    return even_join(rows, hubs, "key").select(F.col("hub").alias("a"), F.col("entity_id").alias("b"))


def alias_groups(aliases: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(entity_id, group_id) of every non-null entity_id of ``aliases``; one without links is its own group.

    An empty table gives no rows; extra columns are not read.
    """
    found = components(alias_links(aliases), chunk)
    ids = aliases.where(F.col("entity_id").isNotNull()).select("entity_id").distinct()
    return ids.join(found, ids["entity_id"] == found["node"], "left").select("entity_id", F.coalesce("group_id", "entity_id").alias("group_id"))
