"""Parent-child links of unknown depth: tops, depths, paths, descendants and cycles.

Links are hashed to at least as many partitions as the session has cores, each of a
bounded size. Each partition contracts its own parent chains: every node gets its fragment's exit, the first node on the
way up that lives elsewhere. Nodes that other partitions exit to, with their
own exits, form a smaller quotient forest, which is solved by the same steps
until it fits one partition; then fragment paths are expanded again. Should
hashing hardly shrink a level (long chains over many partitions), every node
of a random independent set is first bypassed, which removes a quarter.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinmill.session import cut

#: Links that one task solves in memory (about 100 bytes each).
CHUNK = 50_000
_LINK = "node string, parent string, steps long, low string, way array<string>"
_SOLVED = "node string, top string, steps long, low string, way array<string>, endless boolean"


def _contract(with_way: bool):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [f for f in frames if len(f)]
        if not parts:
            return
        pdf = pd.concat(parts, ignore_index=True)
        link = {n: (p, s, low, w) for n, p, s, low, w in zip(pdf["node"], pdf["parent"], pdf["steps"], pdf["low"], pdf["way"])}
        # node -> (exit or top, steps to it, least id on the way, way, endless)
        done: dict[str, tuple] = {}
        for start in link:
            trail, seen, node = [], {}, start
            while node in link and node not in done and node not in seen:
                seen[node] = len(trail)
                trail.append(node)
                node = link[node][0]
            if node in seen and node not in done:
                ring = trail[seen[node]:]
                least = min(link[x][2] for x in ring)
                for x in ring:
                    done[x] = (least, 0, least, None, True)
                trail = trail[: seen[node]]
            for x in reversed(trail):
                p, s, low, w = link[x]
                if p in done:
                    top, steps, low2, way, endless = done[p]
                    done[x] = (top, s + steps, min(low, low2), None if way is None or not with_way else [*w, *way], endless)
                else:
                    done[x] = (p, s, low, list(w) if with_way else None, False)
        names = list(done)
        for i in range(0, len(names), 10_000):
            part = names[i : i + 10_000]
            cols = list(zip(*(done[n] for n in part)))
            yield pd.DataFrame({"node": part, "top": cols[0], "steps": cols[1], "low": cols[2], "way": pd.Series(cols[3], dtype=object), "endless": cols[4]})

    return run


def _solve(links: DataFrame, with_way: bool, chunk: int, level: int) -> DataFrame:
    """Solved rows for unique ``links``: top is the last node on the way up or the least id of the cycle."""
    n = links.count()
    cores = links.sparkSession.sparkContext.defaultParallelism if level == 0 else 1
    parts = max(1, -(-n // chunk), min(cores, n))
    local = links.repartition(parts, F.xxhash64(F.col("node"), F.lit(level)) if level else F.col("node"))
    pieces = cut(local.mapInPandas(_contract(with_way), _SOLVED))
    if parts == 1:
        return pieces
    exits = pieces.where(~F.col("endless")).select(F.col("top").alias("node")).distinct()
    quotient = pieces.where(~F.col("endless")).join(exits, "node", "left_semi").select("node", F.col("top").alias("parent"), "steps", "low", "way")
    # Exits that run into a cycle inside their own fragment are solved already.
    rings = cut(pieces.where("endless").join(exits, "node", "left_semi"))
    above = _extend(_shrunk(cut(quotient), n, with_way, chunk, level), rings, with_way).unionByName(rings)
    return cut(_extend(pieces, above, with_way))


def _extend(pieces: DataFrame, above: DataFrame, with_way: bool) -> DataFrame:
    """Fragment rows prolonged by the solved rows of their exits."""
    up = above.select(*[F.col(c).alias(f"_{c}") for c in above.columns])
    on = (pieces["top"] == up["_node"]) & ~pieces["endless"]
    open_ = F.col("_node").isNotNull()
    way = F.when(open_, F.concat("way", "_way")).otherwise(F.col("way")) if with_way else F.col("way")
    return pieces.join(up, on, "left").select(
        "node",
        F.coalesce("_top", "top").alias("top"),
        (F.col("steps") + F.coalesce("_steps", F.lit(0))).alias("steps"),
        F.least("low", "_low").alias("low"),
        way.alias("way"),
        F.coalesce("_endless", "endless").alias("endless"),
    )


def _shrunk(links: DataFrame, before: int, with_way: bool, chunk: int, level: int) -> DataFrame:
    n = links.count()
    if n <= chunk or n < 0.8 * before:
        return _solve(links, with_way, chunk, level + 1)
    coin = lambda c: F.pmod(F.xxhash64(F.col(c), F.lit(level), F.lit("coin")), F.lit(2)) == 1
    leaves = coin("node") & ~coin("parent")
    gone, kept = links.where(leaves), links.where(~leaves)
    up = gone.select(*[F.col(c).alias(f"_{c}") for c in gone.columns])
    over = F.col("_node").isNotNull()
    bypassed = kept.join(up, kept["parent"] == up["_node"], "left").select(
        "node",
        F.coalesce("_parent", "parent").alias("parent"),
        (F.col("steps") + F.coalesce("_steps", F.lit(0))).alias("steps"),
        F.least("low", "_low").alias("low"),
        (F.when(over, F.concat("way", "_way")).otherwise(F.col("way")) if with_way else F.col("way")).alias("way"),
    )
    solved = _shrunk(cut(bypassed), n, with_way, chunk, level + 1)
    back = _extend(gone.select("node", F.col("parent").alias("top"), "steps", "low", "way", F.lit(False).alias("endless")), solved, with_way)
    return solved.unionByName(cut(back))


def parent_links(edges: DataFrame, child: str, parent: str) -> DataFrame:
    """(node, parent) with one row per node, of repeated or contradicting links the least parent.

    Rows with a null end are no links.
    """
    return (
        edges.select(F.col(child).alias("node"), F.col(parent).alias("parent"))
        .where(F.col("node").isNotNull() & F.col("parent").isNotNull())
        .groupBy("node")
        .agg(F.min("parent").alias("parent"))
    )


def parent_conflicts(edges: DataFrame, child: str, parent: str) -> DataFrame:
    """(node, parent, kept): every parent of the nodes that have more than one, and whether ``parent_links`` keeps it."""
    pairs = edges.select(F.col(child).alias("node"), F.col(parent).alias("parent")).where(F.col("node").isNotNull() & F.col("parent").isNotNull()).distinct()
    several = pairs.groupBy("node").agg(F.min("parent").alias("least"), F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return pairs.join(several, "node").select("node", "parent", (F.col("parent") == F.col("least")).alias("kept"))


def tops(links: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(node, top, endless) of every node that has a parent.

    ``top`` is the last node on the way up; where the way never ends it is the
    least id on the cycle it runs into, and ``endless`` is true. A node that is
    its own parent is a cycle of one.
    """
    start = links.select("node", "parent", F.lit(1).cast("long").alias("steps"), F.col("node").alias("low"), F.array().cast("array<string>").alias("way"))
    return _solve(cut(start), False, chunk, 0).select("node", "top", "endless")


def hierarchy(nodes: DataFrame, node_id: str, links: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(node, top, depth, path, endless) of every distinct non-null id of ``nodes`` or ``links``.

    ``path`` leads from the top to the node, both included, and depth is its
    length less one. A cycle is cut above its least id, which counts as its
    top, so that nodes on or below a cycle have a path too; ``endless`` marks
    them. Nodes without links are their own top. An empty input gives no rows.
    """
    links = cut(links)
    start = lambda df: cut(df.select("node", "parent", F.lit(1).cast("long").alias("steps"), F.col("node").alias("low"), F.array("node").alias("way")))
    found = _solve(start(links), True, chunk, 0)
    solved = found.where(~F.col("endless")).select("node", "top", "steps", "way")
    # Only what runs into a cycle is solved again, with each cycle cut above its least id.
    endless = cut(found.where("endless").select("node", "top"))
    if not endless.isEmpty():
        below = links.join(endless.where(F.col("node") != F.col("top")).select("node"), "node", "left_semi")
        solved = solved.unionByName(_solve(start(below), True, chunk, 0).select("node", "top", "steps", "way"))
    ids = nodes.select(F.col(node_id).alias("node")).union(links.select("node")).union(links.select("parent")).where(F.col("node").isNotNull()).distinct()
    marks = endless.select("node", F.lit(True).alias("endless"))
    return (
        ids.join(solved, "node", "left")
        .join(marks, "node", "left")
        .select(
            "node",
            F.coalesce("top", "node").alias("top"),
            F.coalesce("steps", F.lit(0)).alias("depth"),
            F.coalesce(F.concat(F.array("top"), F.reverse("way")), F.array("node")).alias("path"),
            F.coalesce("endless", F.lit(False)).alias("endless"),
        )
    )


def descendants(tree: DataFrame) -> DataFrame:
    """(ancestor, node, distance): every node under each of its ancestors, from ``hierarchy``."""
    return (
        tree.select("node", "depth", F.posexplode("path").alias("pos", "ancestor"))
        .where(F.col("pos") < F.col("depth"))
        .select("ancestor", "node", (F.col("depth") - F.col("pos")).cast("long").alias("distance"))
    )
