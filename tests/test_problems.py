"""The core problems' operators on small and awkward tables, against brute force."""

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skeinmill.operators import hierarchy as H
from skeinmill.operators import orphans as O
from skeinmill.operators import skew as S

T0 = datetime(2024, 1, 1)
CLASH = {"n": 1, "key_value": "x", "item": 2, "total": 3, "ref": "r", "top": "t", "node": "q", "parent": "z", "hot": 1, "_slice": 5, "side": "s"}


def clashing(df, *used):
    for name, value in CLASH.items():
        if name not in used and name not in df.columns:
            df = df.withColumn(name, F.lit(value))
    return df


# Per-key figures.


def test_profiles_with_nulls_blanks_and_ties(spark):
    rows = [("a", "x"), ("a", "x"), ("a", "y"), ("a", "y"), ("a", None), ("b", None), (None, "x"), (" ", "x"), ("", "y")]
    got = {r["key_value"]: tuple(r)[1:] for r in S.key_profiles(clashing(spark.createDataFrame(rows, "k string, v string")), "k", "v").collect()}
    assert got == {"a": (5, 4, 2, "x", 2), "b": (1, 0, 0, None, None)}


def test_heavy_keys_count_all_rows_in_the_total(spark):
    rows = [("a", "p", 1)] * 3 + [(None, "q", 1)] * 7
    df = spark.createDataFrame(rows, "s string, p string, o int")
    got = {(r["field_name"], r["key_value"]) for r in S.heavy_keys(df, ["s", "p"], "o", 0.3).collect()}
    assert got == {("s", "a"), ("p", "p"), ("p", "q")}
    assert S.heavy_keys(df.limit(0), ["s", "p"], "o", 0.02).count() == 0


def test_percentiles_against_sorting(spark):
    random.seed(1)
    rows = [(random.choice("aaaaab"), random.choice([None, *range(20)])) for _ in range(500)]
    got = {(r[0], r[1]): r[2] for r in S.key_percentiles(spark.createDataFrame(rows, "k string, v int"), "k", "v", [0.0, 0.5, 0.9, 1.0]).collect()}
    for k in "ab":
        vs = sorted(v for x, v in rows if x == k and v is not None)
        for q in (0.0, 0.5, 0.9, 1.0):
            need = max(1, -(-int(q * 10) * len(vs) // 10))
            assert got[(k, q)] == vs[need - 1]


def test_running_totals_over_slices(spark):
    rows = [("a" if i % 3 else "b", i, i % 5) for i in range(300)]
    got = S.running_totals(spark.createDataFrame(rows, "k string, i int, w int"), ["k"], ["i"], "w", parts=7).collect()
    sums = Counter()
    for k, i, w in rows:
        r = next(x for x in got if x["i"] == i)
        assert (r["before"], r["total"]) == (sums[k], sum(y for x, _, y in rows if x == k))
        sums[k] += w


def test_even_join_with_a_hot_key(spark, monkeypatch):
    monkeypatch.setattr(S, "HOT_ROWS", 10)
    monkeypatch.setattr(S, "HOT_PARTS", 4)
    big = spark.createDataFrame([("hot", i) for i in range(100)] + [(None, 1), ("c", 2), ("d", 3)], "k string, i int")
    look = spark.createDataFrame([("hot", 7), ("c", 8)], "k string, v int")
    assert S.hot_keys(big, "k") == ["hot"]
    assert Counter((r["k"], r["v"]) for r in S.even_join(big, look, "k").collect()) == {("hot", 7): 100, ("c", 8): 1}
    assert Counter((r["k"], r["v"]) for r in S.even_join(big, look, "k", "left").collect()) == {("hot", 7): 100, ("c", 8): 1, ("d", None): 1, (None, None): 1}


# Hierarchies.


def climb(parent):
    out = {}
    for x in parent:
        seen, y = [], x
        while y in parent and y not in seen:
            seen.append(y)
            y = parent[y]
        out[x] = (min(seen[seen.index(y):]), True) if y in seen else (y, False)
    return out


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.dictionaries(st.integers(0, 40), st.integers(0, 40), max_size=40))
def test_tops_of_random_links(spark, links):
    parent = {f"c{a:02}": f"c{b:02}" for a, b in links.items()}
    df = spark.createDataFrame(list(parent.items()), "node string, parent string")
    for chunk in (1000, 7):
        got = {r["node"]: (r["top"], r["endless"]) for r in H.tops(df, chunk).collect()}
        assert got == climb(parent)


def test_long_chain_over_many_partitions(spark):
    df = spark.createDataFrame([(f"{i:04}", f"{i + 1:04}") for i in range(600)], "node string, parent string")
    tree = {r["node"]: r for r in H.hierarchy(df.select("node"), "node", df, chunk=90).collect()}
    assert all(tree[f"{i:04}"]["depth"] == 600 - i and tree[f"{i:04}"]["top"] == "0600" for i in range(601))
    assert tree["0598"]["path"] == ["0600", "0599", "0598"]


def test_paths_depths_and_descendants(spark):
    links = spark.createDataFrame([("b", "a"), ("c", "b"), ("d", "b"), ("x", "y"), ("y", "z"), ("z", "x"), ("w", "x"), ("s", "s")], "node string, parent string")
    nodes = spark.createDataFrame([("a",), ("lone",), (None,), ("a",)], "id string")
    tree = H.hierarchy(clashing(nodes, "id"), "id", links)
    got = {r["node"]: (r["top"], r["depth"], "".join(r["path"]), r["endless"]) for r in tree.collect()}
    assert got == {
        "a": ("a", 0, "a", False), "b": ("a", 1, "ab", False), "c": ("a", 2, "abc", False), "d": ("a", 2, "abd", False), "lone": ("lone", 0, "lone", False),
        "x": ("x", 0, "x", True), "z": ("x", 1, "xz", True), "y": ("x", 2, "xzy", True), "w": ("x", 1, "xw", True), "s": ("s", 0, "s", True),
    }
    below = defaultdict(set)
    for r in H.descendants(tree).collect():
        below[r["ancestor"]].add((r["node"], r["distance"]))
    assert below["a"] == {("b", 1), ("c", 2), ("d", 2)} and below["x"] == {("z", 1), ("y", 2), ("w", 1)}


def test_empty_and_contradicting_links(spark):
    edges = spark.createDataFrame([("a", "c"), ("a", "b"), ("a", "b"), (None, "b"), ("b", None)], "s string, o string")
    assert [tuple(r) for r in H.parent_links(edges, "s", "o").collect()] == [("a", "b")]
    none = spark.createDataFrame([], "node string, parent string")
    assert H.tops(none).count() == 0 and H.hierarchy(none.select("node"), "node", none).count() == 0


# Orphans.


def brute_orphans(refs, lives):
    out = set()
    for rid, side, ref, at in refs:
        rows = [x for x in lives if x[0] == ref]
        if ref and not any(b is not None and at is not None and b <= at and (e is None or at < e) for _, b, e in rows) and (rows or True):
            if at is None and rows:
                continue
            out.add((rid, side))
    return out


def test_orphans_at_their_time(spark):
    random.seed(5)
    hour = lambda h: T0 + timedelta(hours=h)
    lives = [("late", hour(10), None), ("gone", hour(1), hour(5)), ("back", hour(1), hour(3)), ("back", hour(6), None), ("twice", hour(0), hour(2)), ("twice", hour(2), hour(4)), ("never", hour(5), hour(5)), ("ok", hour(0), None), (None, hour(0), None), ("nul", None, None)]
    for k in range(15):
        b = random.randrange(10)
        lives.append((f"r{k % 4}", hour(b), random.choice([None, hour(b + random.randrange(1, 4))]) if k > 8 else hour(b + random.randrange(0, 4))))
    names = ["late", "gone", "back", "twice", "never", "ok", "nul", "nowhere", "r0", "r1", "r2", "r3", "", None]
    rels = [(i, random.choice(names), random.choice(names), hour(random.randrange(14))) for i in range(300)] + [(900, "ok", "nowhere", None)]
    entities = clashing(spark.createDataFrame(lives, "id string, ingested_at timestamp, retracted_at timestamp"))
    relations = clashing(spark.createDataFrame(rels, "record_id int, subject string, object string, ingested_at timestamp"))
    refs = O.references(relations, "record_id", ["subject", "object"], "ingested_at")
    got = O.orphan_references(refs, O.lifetimes([entities]))
    found = [(r["record_id"], r["side"]) for r in got.collect()]
    sides = [(i, "subject", s, t) for i, s, _, t in rels] + [(i, "object", o, t) for i, _, o, t in rels]
    live = [x for x in lives if x[0] is not None and x[1] is not None and (x[2] is None or x[2] > x[1])]
    assert len(found) == len(set(found)) and set(found) == brute_orphans(sides, live)
    report = O.orphan_report(got, "relations").collect()
    assert sum(r["n_references"] for r in report) == len(found)


def test_orphans_of_empty_tables(spark):
    refs = spark.createDataFrame([(1, "subject", "a", T0)], "record_id int, side string, ref string, at timestamp")
    lives = spark.createDataFrame([], "id string, born timestamp, died timestamp")
    assert [r["reason"] for r in O.orphan_references(refs, lives).collect()] == ["missing"]
    assert O.orphan_references(refs.limit(0), lives).count() == 0


def test_hot_doubtful_key(spark, monkeypatch):
    monkeypatch.setattr(O, "HOT_PARTS", 3)
    refs = spark.createDataFrame([(i, "subject", "hot" if i % 2 else f"k{i}", T0) for i in range(200)], "record_id int, side string, ref string, at timestamp")
    lives = spark.createDataFrame([(f"k{i}", T0, None) for i in range(0, 100, 2)], "id string, born timestamp, died timestamp")
    got = {r["record_id"] for r in O.orphan_references(refs, lives).collect()}
    assert got == {i for i in range(200) if i % 2 or i >= 100}


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_lifetimes_without_retraction(spark, kind):
    t = spark.createDataFrame([("a", T0)], f"id string, ingested_at {kind}")
    assert [tuple(r) for r in O.lifetimes([t]).collect()] == [("a", T0, None)]
