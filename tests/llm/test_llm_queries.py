"""The training-data queries on the smallest tables: beside their SQL, or against brute force where SQL can't say them."""

from collections import Counter, defaultdict

import duckdb
import pytest

from oracle import compare
from skeinmill.llm import glyphs as G
from skeinmill.llm import leakage as L
from skeinmill.llm import mixing as M
from skeinmill.llm import queries as Q

DATA = "/root/testdata/sf0.001"


def rows(spark, name):
    return [tuple(r) for r in Q.QUERIES[name](spark, DATA).collect()]


def stored(sql):
    return duckdb.sql(sql.replace("@", DATA + "/")).fetchall()


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_query(spark, name):
    compare(spark, DATA, Q.QUERIES[name], Q.SQL[name])


def test_names_are_grouped_and_paired_alike(spark):
    groups = defaultdict(set)
    for entity, kind, group in rows(spark, "p1_groups"):
        groups[kind, group].add(entity)
    ids = dict(stored("SELECT id, any_value(type) FROM '@entities.parquet' WHERE type IN ('Person', 'Institution') GROUP BY id"))
    assert all(ids[e] == kind for (kind, _), es in groups.items() for e in es)
    pairs = rows(spark, "p1_found")
    assert len(pairs) == len(set(pairs)) and set(pairs) == {(a, b) for es in groups.values() for a in es for b in es if a < b}
    assert len(pairs) > 10


def test_leaks_of_the_tables(spark):
    runs = defaultdict(set)
    for i, text in stored("SELECT item_id, text FROM '@eval_items.parquet'"):
        w = L.words(text or "")
        for k in range(len(w) - L.SPAN + 1):
            runs[tuple(w[k : k + L.SPAN])].add(i)
    want = set()
    for i, text in stored("SELECT doc_id, text FROM '@documents.parquet'"):
        w = L.words(text or "")
        want |= {(i, j) for k in range(len(w) - L.SPAN + 1) for j in runs.get(tuple(w[k : k + L.SPAN]), ())}
    assert sorted(rows(spark, "p7_found")) == sorted(want)
    assert dict(rows(spark, "p7_items")) == Counter(j for _, j in want)


def test_mix_of_the_tables(spark):
    with open(M.TOKENIZER, "rb") as f:
        enc = M._encoding(f.read())
    sizes = {i: (source, len(enc.encode_ordinary(text or ""))) for i, source, text in stored("SELECT doc_id, source, text FROM '@documents.parquet'")}
    targets = {s: (share, cap) for s, share, cap in stored("SELECT source, target_share, max_repeats FROM '@mix_targets.parquet'")}
    tokens, used = Counter(), Counter()
    for _, source, doc, repeat, a, b in rows(spark, "p8_mix"):
        assert sizes[doc][0] == source and 0 <= a < b <= sizes[doc][1] and 1 <= repeat <= targets[source][1]
        tokens[source] += b - a
        used[doc] += b - a
    assert all(used[doc] <= sizes[doc][1] * targets[sizes[doc][0]][1] for doc in used)
    have = Counter()
    for source, n in sizes.values():
        have[source] += n
    total = sum(tokens.values())
    for source, share, reached, n, available, cap, _ in rows(spark, "p8_shares"):
        assert (share, cap) == targets[source] and n == tokens[source] and available == have[source] and abs(reached - n / total) < 1e-9


def test_look_alikes_of_the_tables(spark):
    texts = dict(stored("SELECT doc_id, text FROM '@documents.parquet'"))
    canonical = dict(rows(spark, "p9_canonical"))
    assert set(canonical) == set(texts)
    same = defaultdict(set)
    for i, text in texts.items():
        if text:
            same[G.skeleton(text)].add(i)
        else:
            assert canonical[i] == text
    assert all(len({canonical[i] for i in ids}) == 1 for ids in same.values()) and len({canonical[min(ids)] for ids in same.values()}) == len(same)
    want = {(a, b) for ids in same.values() for a in ids for b in ids if a < b and texts[a] != texts[b]}
    assert set(rows(spark, "p9_found")) == want
