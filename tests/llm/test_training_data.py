"""The training-data operators on small and awkward tables, against brute force."""

import math
import random
import unicodedata
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from skeinmill.llm import components as C
from skeinmill.llm import glyphs as G
from skeinmill.llm import leakage as L
from skeinmill.llm import mixing as M
from skeinmill.llm import names as N
from skeinmill.llm import spelled as S
from skeinmill.llm import survivor as V

T0 = datetime(2024, 1, 1)
CLASH = ("n", "key", "hub", "node", "group_id", "stored", "form", "token", "hits", "id_a", "block", "slot", "total", "value", "field_name", "cluster")


def clashing(df):
    for name in CLASH:
        if name not in df.columns:
            df = df.withColumn(name, F.lit("clash"))
    return df


# Groups of linked records.


def brute_groups(links):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


@pytest.mark.parametrize("few", [0, 100, 1_000])
def test_components_of_mixed_shapes(spark, monkeypatch, few):
    monkeypatch.setattr(C, "FEW", few)
    random.seed(few)
    p = [f"{i:04}" for i in range(900)]
    random.shuffle(p)
    links = [(p[i], p[i + 1]) for i in range(150)] + [(p[200], p[i]) for i in range(201, 300)] + [(p[300 + i], p[300 + (i + 1) % 60]) for i in range(60)]
    links += [(p[random.randrange(400, 600)], p[random.randrange(400, 600)]) for _ in range(400)] + [(p[random.randrange(600, 900)], p[random.randrange(600, 900)]) for _ in range(120)]
    links = [(a, b) for a, b in links if a != b]
    rows = links + [(b, a) for a, b in links[:50]] + [(None, "x"), ("y", "y"), ("z", None)]
    got = {r["node"]: r["group_id"] for r in C.components(spark.createDataFrame(rows, "a string, b string"), chunk=40).collect()}
    assert got == brute_groups(links)


def test_alias_groups(spark):
    rows = [("e1", " Ann "), ("e2", "ANN"), ("e2", "ann"), ("e3", "Bob"), ("e4", "bob "), ("e4", "ann"), ("e5", "n/a"), ("e6", "N/A"), ("e7", None), ("e8", ""), (None, "ann"), ("e9", "x" * 100_000)]
    got = {r["entity_id"]: r["group_id"] for r in C.alias_groups(clashing(spark.createDataFrame(rows, "entity_id string, alias string"))).collect()}
    assert got == {"e1": "e1", "e2": "e1", "e3": "e1", "e4": "e1", "e5": "e5", "e6": "e6", "e7": "e7", "e8": "e8", "e9": "e9"}
    assert C.alias_groups(spark.createDataFrame([], "entity_id string, alias string")).count() == 0


# Survivors.

ROWS = "id string, record_id bigint, identifiers map<string,string>, properties struct<kind:string,publication_year:bigint,citation_count:bigint>, ingested_at timestamp"


def day(n):
    return None if n is None else T0 + timedelta(days=n)


def test_cells_and_sole_fillers(spark):
    rows = [
        ("a", 1, {"doi": "1", "ads": "-"}, ("x", 0, 0), day(1)), ("a", 2, {"doi": "2"}, (" ", 2001, -1), day(2)), ("a", 3, None, None, day(3)),
        ("b", 4, {"doi": "9"}, ("x", 1, 1), day(1)), (None, 5, {"doi": "9"}, ("x", 1, 1), day(1)), (None, 6, {"doi": "9"}, ("x", 1, 1), day(1)),
        ("c", 7, {"doi": "7"}, (None, None, None), day(1)), ("c", 8, {"doi": "7"}, (None, None, None), day(1)),
    ]
    df = clashing(spark.createDataFrame(rows, ROWS))
    got = {tuple(r) for r in V.sole_fillers(df).collect()}
    assert got == {("a", "properties.kind", 1), ("a", "properties.publication_year", 2), ("a", "properties.citation_count", 1)}
    assert V.sole_fillers(df.limit(0)).count() == 0


def test_newest_value_survives_and_ties_are_settled(spark):
    rows = [("a", 1, {}, ("old", None, None), day(1)), ("a", 2, {}, ("new", None, None), day(2)), ("b", 3, {}, ("bb", None, None), day(1)), ("b", 4, {}, ("aa", None, None), day(1)), ("b", 5, {}, ("aa", None, None), day(1)), ("b", 6, {}, ("bb", None, None), day(1))]
    got = {r["entity_id"]: tuple(r)[2:] for r in V.survivors(spark.createDataFrame(rows, ROWS)).collect()}
    assert got == {"a": ("new", 2, 2, 2, "time"), "b": ("aa", 4, 4, 2, "time")}


def test_learned_order_decides_without_timestamps(spark):
    rows, k = [], 0
    for i in range(12):
        for n, v in enumerate(("draft", "preprint", "article")):
            k += 1
            rows.append((f"g{i}", k, {}, (v, None, 10 * n + i), day(n + i)))
    rows += [("q", 900, {}, ("article", None, 3), None), ("q", 901, {}, ("draft", None, 99), None), ("q", 902, {}, ("preprint", None, 50), day(40)), ("r", 903, {}, ("preprint", None, None), None), ("r", 904, {}, ("draft", None, None), day(100))]
    got = {(r["entity_id"], r["field_name"]): (r["value"], r["record_id"], r["basis"]) for r in V.survivors(spark.createDataFrame(rows, ROWS)).collect()}
    assert got[("q", "properties.kind")] == ("article", 900, "order") and got[("r", "properties.kind")] == ("preprint", 903, "order")
    # No citation count recurs, but all grow: the greatest is the latest.
    assert got[("q", "properties.citation_count")] == ("99", 901, "trend")


def test_levels_leave_cycles_out(spark):
    order = spark.createDataFrame([("f", "a", "b"), ("f", "b", "c"), ("f", "a", "c"), ("f", "x", "y"), ("f", "y", "x"), ("f", "y", "z")], "field_name string, old string, new string")
    assert {r["value"]: r["level"] for r in V.levels(order).collect()} == {"a": 0, "b": 1, "c": 2}


def test_built_records(spark):
    rows = [("a", 1, {"doi": "1"}, ("old", 2001, None), day(1)), ("a", 2, {"ads": "x"}, ("new", None, None), day(2))]
    got = V.merged(V.survivors(spark.createDataFrame(rows, ROWS))).collect()
    assert len(got) == 1 and got[0]["fields"] == {"identifiers.doi": "1", "identifiers.ads": "x", "properties.kind": "new", "properties.publication_year": "2001"}


# Leaks.


def brute_leaks(docs, items, span):
    runs = defaultdict(set)
    for i, t in items:
        w = L.words(t) if t else []
        for k in range(len(w) - span + 1):
            runs[tuple(w[k : k + span])].add(i)
    out = set()
    for i, t in docs:
        w = L.words(t) if t else []
        for k in range(len(w) - span + 1):
            out |= {(i, j) for j in runs.get(tuple(w[k : k + span]), ())}
    return out


def test_words_as_a_reader_sees_them():
    want = ["the", "quick", "brown", "fox", "wellknown", "5476", "café"]
    for text in ("The quick brown fox, well-known 54.76 café", "*The* “quick”​ brοwn fox —\n> well-\n> known 54.76 café", "ＴＨＥ QUICK bro-\nwn fox; (well‑known) 54.76 CAFÉ"):
        assert L.words(text) == want, text


def test_leaks_against_brute_force(spark):
    random.seed(3)
    vocab = [f"w{i}" for i in range(40)]
    some = lambda n: [random.choice(vocab) for _ in range(n)]
    items = [(i, " ".join(some(random.choice([5, 12, 30])))) for i in range(30)] + [(100, None), (101, ""), (102, "only three words")]
    docs = [(0, None), (1, ""), (2, " ".join(some(20_000)))]
    for k in range(3, 120):
        body = some(random.randrange(30))
        if k % 2:
            w = random.choice(items[:30])[1].split()
            n = random.randrange(9, 15)
            at = random.randrange(max(1, len(w) - n + 1))
            body[3:3] = w[at : at + n]
        docs.append((k, " ".join(body)))
    docs += [(500, docs[4][1]), (501, items[1][1] + " " + items[2][1])]
    a, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for span, gram in ((12, 5), (9, 4), (12, 12)):
        got = {(r["doc_id"], r["item_id"]) for r in L.leaks(clashing(a), clashing(b), span=span, gram=gram).collect()}
        assert got == brute_leaks(docs, items, span)
    assert L.leaks(a.limit(0), b).count() == 0 and L.leaks(a, b.limit(0)).count() == 0


def test_leaks_with_a_full_bitmap(spark, monkeypatch):
    monkeypatch.setattr(L, "MOST_BITS", 1 << 6)
    text = " ".join(f"w{i}" for i in range(15))
    other = " ".join(f"v{i}" for i in range(300))
    df = spark.createDataFrame([(1, text), (2, text), (3, other)], "doc_id long, text string")
    items = spark.createDataFrame([(7, text), (8, other[:700] + " end")], "item_id long, text string")
    want = {(a, b, n) for (a, b), n in {(1, 7): 4, (2, 7): 4, (3, 8): len(L.words(other[:700])) - 12}.items()}
    assert {tuple(r) for r in L.leaks(df, items).collect()} >= {w for w in want if w[1] == 7}
    assert {(r[0], r[1]) for r in L.leaks(df, items).collect()} == {(a, b) for a, b, _ in want}


def test_words_in_capitals_of_other_scripts():
    assert L.words("НОВЫЙ МИР") == L.words("новый мир") and L.words("ΝΕΟΣ Κοσμος") == L.words("νεος ΚΟΣΜΟΣ") and L.words("Нello") == ["hello"]


# Mixing.


def test_mix_keeps_shares_caps_and_tokens(spark):
    random.seed(2)
    docs = [(i, random.choice(["big", "big", "big", "mid"]), " ".join(random.choice(["alpha", "beta", "gamma"]) for _ in range(random.randrange(1, 60)))) for i in range(400)]
    docs += [(1000, "tiny", "one two three"), (1001, None, "lost"), (1002, "mid", None), (1003, "mid", ""), (1004, "unlisted", "x y"), (1005, "big", "word " * 30_000)]
    targets = spark.createDataFrame([("big", 0.5, 1), ("mid", 0.3, 3), ("tiny", 0.1, 2), ("none", 0.1, 5), ("zero", 0.0, 1), (None, 0.2, 1)], "source string, target_share double, max_repeats int")
    df = clashing(spark.createDataFrame(docs, "doc_id long, source string, text string"))
    total, block = 20_000, 64
    mixed = M.mix(df, targets, total=total, block=block).collect()
    size = Counter()
    spans = defaultdict(list)
    filled = Counter()
    for r in mixed:
        size[r["source"]] += r["token_to"] - r["token_from"]
        filled[r["slot"]] += r["token_to"] - r["token_from"]
        spans[(r["doc_id"], r["repeat"])].append((r["token_from"], r["token_to"]))
    assert set(size) == {"big", "mid", "tiny"} and max(filled.values()) <= block
    assert abs(size["big"] / total - 0.5) < 0.02 and abs(size["mid"] / total - 0.3) < 0.02
    counts = {r["doc_id"]: r["n_tokens"] for r in M.token_counts(df).collect()}
    assert size["tiny"] == 2 * counts[1000] and counts[1002] == counts[1003] == 0
    assert max(r["repeat"] for r in mixed if r["source"] == "mid") <= 3
    for (i, _), parts in spans.items():
        parts.sort()
        assert all(a[1] <= b[0] for a, b in zip(parts, parts[1:])) and parts[-1][1] <= counts[i]
    again = M.mix(df, targets, total=total, block=block).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, mixed))
    report = {r["source"]: r for r in M.shares(spark.createDataFrame(mixed), M.token_counts(df), targets).collect()}
    assert report["none"]["n_tokens"] == 0 and report["zero"]["share"] == 0.0 and abs(sum(r["share"] for r in report.values()) - 1) < 1e-9


def test_all_blocks_are_used_once_before_any_repeats(spark):
    df = spark.createDataFrame([(i, "s", "a b c d e f g h") for i in range(50)], "doc_id long, source string, text string")
    targets = spark.createDataFrame([("s", 1.0, 2)], "source string, target_share double, max_repeats int")
    n = M.token_counts(df).agg(F.sum("n_tokens")).first()[0]
    once = M.mix(df, targets, block=10).collect()
    assert sum(r["token_to"] - r["token_from"] for r in once) == n and {r["repeat"] for r in once} == {1}
    many = M.mix(df, targets, total=10 * n, block=10).collect()
    assert sum(r["token_to"] - r["token_from"] for r in many) == 2 * n


def test_pieces_hold_the_tokens_of_the_whole(monkeypatch):
    random.seed(6)
    with open(M.TOKENIZER, "rb") as f:
        enc = M._encoding(f.read())
    for _ in range(100):
        text = "".join(random.choice(["ab", " ", "  ", "\n", "'s", "é", "1", "\t", "—", "x" * 30]) for _ in range(300))
        monkeypatch.setattr(M, "_PIECE", random.choice([1, 5, 50]))
        parts = list(M._pieces(text))
        assert "".join(parts) == text and sum(len(enc.encode_ordinary(p)) for p in parts) == len(enc.encode_ordinary(text))


def test_mix_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, source string, text string")
    targets = spark.createDataFrame([], "source string, target_share double, max_repeats int")
    assert M.mix(df, targets).count() == 0


def test_schedule_is_even_in_every_stretch(spark):
    targets = spark.createDataFrame([("a", 0.5), ("b", 0.3), ("c", 0.2)], "source string, target_share double")
    rows = sorted((r["slot"], r["source"], r["rank"]) for r in M.schedule(targets, 1000, rows_per_slice=37).collect())
    assert [r[0] for r in rows] == list(range(1000))
    seen = Counter()
    for _, s, rank in rows:
        assert rank == seen[s]
        seen[s] += 1
    for at in range(0, 900, 50):
        part = Counter(r[1] for r in rows[at : at + 100])
        assert abs(part["a"] - 50) <= 6 and abs(part["b"] - 30) <= 6 and abs(part["c"] - 20) <= 6


# Look-alikes.

SAME = [("café", "café"), ("office", "oﬃce"), ("sky map", "ｓｋｙ map"), ("one two", "one two"), ("invisible", "in​vis­ible"), ("re-use", "re‑use"), ("5 Å", "5 Å"), ("3 Ω", "3 Ω"), ("Cosmos", "Соѕmоѕ"), ("µm", "μm"), ("Ёж", "Ё‍ж")]
OTHER = [("cafe", "café"), ("10²", "102"), ("Map", "map"), ("a  b", "a b"), ("a\nb", "a b"), ("a.", "a"), ("3", "8"), ("ß", "ss")]


def test_skeletons():
    for a, b in SAME:
        assert G.skeleton(a) == G.skeleton(b), (a, b)
    for a, b in OTHER:
        assert G.skeleton(a) != G.skeleton(b), (a, b)


def test_look_alike_pairs(spark):
    texts = [t for pair in SAME + OTHER for t in pair] + [None, "", "", "café", "x" * 50_000, "x" * 50_000 + "​"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    want = {(i, j) for i, a in enumerate(texts) for j, b in enumerate(texts) if i < j and a and b and a != b and G.skeleton(a) == G.skeleton(b)}
    got = [(r["doc_id_a"], r["doc_id_b"]) for r in G.look_alike_pairs(clashing(df)).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert G.look_alike_pairs(df.limit(0)).count() == 0


def test_slices_of_a_big_class(spark, monkeypatch):
    monkeypatch.setattr(G, "SLICE", 3)
    df = spark.createDataFrame([(i, "ab" if i % 2 else "a​b") for i in range(20)], "doc_id int, text string")
    assert G.look_alike_pairs(df).count() == 100


def test_canonical_spellings_come_from_the_vocabulary(spark):
    rows = [(1, "космос и сон"), (2, "kocмoc и coн"), (3, "космос"), (4, "café café"), (5, "café"), (6, "plain"), (7, None), (8, "ас plain")]
    got = {r["doc_id"]: r["canonical"] for r in G.canonical_texts(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert got[1] == "космос и сон" and got[3] == "космос" and got[5] == "café" and got[7] is None and got[6] == "plain"
    # One letter is Latin k, which is no look-alike of the Cyrillic one: another word.
    assert got[2] == "kocмoc и сон" and G.skeleton(got[2]) == G.skeleton(rows[1][1])


def test_the_vocabulary_decides_what_no_table_can(spark, monkeypatch):
    rows = [(1, "сор is here"), (2, "cop is here"), (3, "мир и сон"), (4, "mαss of α"), (5, "mass of α"), (6, "а cat"), (7, "a cat"), (8, "ѕіх"), (9, "sіx")]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    got = {r["doc_id"]: r["canonical"] for r in G.canonical_texts(docs).collect()}
    assert got == {1: "cop is here", 2: "cop is here", 3: "мир и сон", 4: "mass of α", 5: "mass of α", 6: "a cat", 7: "a cat", 8: "ѕіх", 9: "ѕіх"}
    pairs = lambda: {tuple(r) for r in G.look_alike_pairs(docs).collect()}
    assert pairs() == {(1, 2), (4, 5), (6, 7), (8, 9)}
    monkeypatch.setattr(G, "BROADCAST", -1)
    assert pairs() == {(1, 2), (4, 5), (6, 7), (8, 9)}
    monkeypatch.setattr(G, "spellings", lambda d, text: d.sparkSession.createDataFrame([], "token string, canonical string"))
    assert pairs() == set()


def test_wider_look_alikes(spark):
    wide = G.confusables(spark)
    assert len(wide) > 150 and wide["ո"] == "n" and wide["Ꭺ"] == "A" and all(c.isupper() == to.isupper() for c, to in wide.items())


def test_trie_with_costs():
    t = G.Trie()
    for w, n in (("космос", 5), ("сон", 2), ("coн", 1)):
        t.add(w, n)
    assert t.reach("кocмoc") == "космос" and t.reach("con") is None and t.reach("coн") == "сон"
    assert t.reach("космс", budget=1) == "космос" and t.reach("козмос", budget=1) == "космос" and t.reach("космс") is None


def test_table_is_idempotent():
    t = G.table()
    assert all(G.skeleton(G.skeleton(chr(c))) == G.skeleton(chr(c)) for c in t)
    assert all(unicodedata.category(chr(c)) != "Cf" or t[c] == "" for c in t)


# Names.


def person(given=("edward", "ann", "robert", "rajesh", "margaret", "jean-luc")):
    return S.PersonReader(S.Words({g: 50 for g in given} | {"edwrad": 1}))


@pytest.mark.parametrize(
    ("text", "place", "full", "hint", "middle"),
    [
        ("Edward Rihazhoker", "rihazhoker", "edward", "", ""), ("Rîhazhoker, Edward", "rihazhoker", "edward", "", ""), ("RIHAZHOKER Edward", "rihazhoker", "edward", "", ""),
        ("Rihazhoker Edward", "rihazhoker", "edward", "", ""), ("Dr. Edwrad M. Rihazhoker, PhD", "rihazhoker", "edward", "", "m"), ("E. Rihazhoker", "rihazhoker", "", "e", ""),
        ("EM Rihazhoker", "rihazhoker", "", "e", "m"), ("Rihazhoker E", "rihazhoker", "", "e", ""), ("Ned Rihazhoker", "rihazhoker", "ned", "", ""), ("Иванов, Edward", "иванов", "edward", "", ""),
        ("Margaret van der Berg", "van der berg", "margaret", "", ""), ("Edward", "edward", "= edward", "", ""), ("van der Berg, M.", "van der berg", "", "m", ""), ("J.-L. Pogro-Vlista", "pogro vlista", "", "j", "l"), ("Jean-Luc Pogro-Vlista", "pogro vlista", "jean-luc", "", ""),
    ],
)
def test_reading_people(text, place, full, hint, middle):
    assert person().read(text) == S.Reading(place, full, hint, middle)


def test_unreadable_people():
    assert all(person().read(x) is None for x in ("", "   ", "PhD", ","))


def test_family_names_without_particles():
    assert S.core("van der berg", True) == S.core("berg", True) == "berg" and S.core("de la", True) == "dela" and S.core("de la", False) == "dela"


@pytest.mark.parametrize(
    ("text", "place", "full", "hint"),
    [
        ("Centre for Cosmic Structure, Pokez", "pokez", "centre | cosmic structure", ""), ("Ctr. of Cosmic Struct. (Pokez)", "pokez", "centre | cosmic structure", ""), ("Pokez Center for Cosmic Structure", "pokez", "centre | cosmic structure", ""),
        ("Cente for Cosmic Structure, Pokez", "pokez", "centre | cosmic structure", ""), ("CCS, Pokez", "pokez", "", "ccs"), ("Pokez (NL)", "pokez", "", "nl"), ("National Lab of Pokez", "pokez", "laboratory national |", ""), ("Pokez Natl. Laboratory", "pokez", "laboratory national |", ""),
        ("The Pokez Collab.", "pokez", "collaboration |", ""), ("university of pokez", "pokez", "university |", ""), ("Pokez U.", "pokez", "university |", ""),
    ],
)
def test_reading_institutions(text, place, full, hint):
    reader = S.InstituteReader(S.Words({"cosmic": 20, "structure": 20, "struct": 2}), frozenset({"ccs"}))
    assert reader.read(text) == S.Reading(place, full, hint)


def test_one_edit_against_definition():
    letters = "abc"
    words = [""] + [a + b + c for a in letters for b in letters for c in ["", *letters]]

    def near(w):
        cuts = [(w[:i], w[i:]) for i in range(len(w) + 1)]
        return {w} | {a + b[1:] for a, b in cuts if b} | {a + c + b[1:] for a, b in cuts if b for c in letters} | {a + c + b for a, b in cuts for c in letters} | {a + b[1] + b[0] + b[2:] for a, b in cuts if len(b) > 1}

    assert all(S.one_edit(a, b) == (b in near(a)) for a in words for b in words)


def names_tables(spark):
    e = lambda i, name, cited=None, kind="Person": (i, kind, name, cited)
    rows = [
        e("p1", "Edward Rihazhoker"), e("p1", "Edward Rihazhoker"), e("p2", "Ned Rihazhoker"), e("p3", "E. Rihazhoker", "Rihazhoker, Edward"), e("p4", "Elizabeth Rihazhoker"), e("p5", "E. Rihazhoker"), e("p6", "Rihazhokr, Edward"),
        e("q1", "Ann Solo"), e("q2", "A. Solo"), e("q3", "SOLO, Ann"), e("r1", "X. Unknown"), e("r2", "Unknown X"), e("n1", None), e("n2", "n/a", " "), e(None, "Ann Solo"), e("l1", "y" * 5000 + " Ann"),
        e("i1", "Pokez Observatory", kind="Institution"), e("i2", "Obs. of Pokez", kind="Institution"), e("i3", "University of Pokez", kind="Institution"), e("i4", "Institute for Dark Matter, Pokez", kind="Institution"),
        e("i5", "IDM, Pokez", kind="Institution"), e("i6", "Centre for Dark Matter, Pokez", kind="Institution"), e("i7", "Pokez Observatry", kind="Institution"), e("t1", "Ann Solo", kind="Talk"),
    ]
    rows += [e("m1", "Ned Fridolaru", "Edward Fridolaru"), e("m2", "Ned Wostabil", "Edward Wostabil"), e("o1", "Plato"), e("o2", "PLATO"), e("d1", "Ann van der Kolibri"), e("d2", "Kolibri, Ann"), e("d3", "Ann Vanderkolibri")]
    rows += [e("v1", "Ann Verylongname"), e("v2", "A. Verylngname"), e("v3", "A. Verylongname", "A. Veryloongname"), e("w1", "Q. Elsewhere"), e("w2", "Q. Elsewhere", "Q. Elsewere")]
    rows += [e(f"f{k}{g}", f"Family{chr(97 + k)}xyz, {g}") for k in range(9) for g in ("Edward", "Ann", "Elizabeth")]
    a = spark.createDataFrame([("q1", "Ann Solo"), ("p5", None), ("zz", "Ann Solo"), (None, "Ann Solo"), ("i4", "Institute of Dark Matter (Pokez)"), ("i4", "IDM Pokez"), ("i6", "Centre for Dark Matter, Pokez")], "entity_id string, alias string")
    return clashing(spark.createDataFrame(rows, "id string, type string, name string, name_as_cited string")), a


def test_same_names(spark):
    entities, aliases = names_tables(spark)
    got = {tuple(r) for r in N.same_name_pairs(entities, aliases).collect() if not r[0].startswith("f")}
    groups = [("p1", "p2", "p3", "p6"), ("q1", "q2", "q3"), ("r1", "r2"), ("i1", "i2", "i7"), ("i4", "i5"), ("v1", "v2", "v3"), ("w1", "w2"), ("o1", "o2"), ("d1", "d2", "d3")]
    assert got == {(a, b) for g in groups for a in g for b in g if a < b}


def test_no_names(spark):
    entities, aliases = names_tables(spark)
    assert N.same_name_pairs(entities.limit(0), aliases.limit(0)).count() == 0


def cosines(places):
    """All cosines by the definition of N.vectors."""
    grams = {p: {("^^" + p + "$$")[i : i + 3] for i in range(len(p) + 2)} for p in places}
    df = Counter(g for gs in grams.values() for g in gs)
    w = {g: 1 + math.log(len(places) / n) / max(math.log(len(places)), 1.0) for g, n in df.items()}
    norm = {p: math.sqrt(sum(w[g] for g in gs)) for p, gs in grams.items()}
    return {(a, b): sum(w[g] for g in grams[a] & grams[b]) / norm[a] / norm[b] for a in places for b in places if a < b}, {p: max((len(g) - 4) / (len(g) + 4), 0.1) for p, g in grams.items()}


def test_cosine_pairs_against_all_pairs(spark):
    random.seed(7)
    places = sorted({"".join(random.choice(["ka", "ri", "mo", "te"]) for _ in range(4)) for _ in range(60)})
    want, bound = cosines(places)
    keys = spark.createDataFrame([(p, "x", p) for p in places] + [(places[0] + "2", "x", places[0]), (places[1], "y", places[1])], "key string, block string, place string")
    some = {(r["a"], r["b"]): r["cosine"] for r in N.cosine_pairs(keys, 0.5).collect()}
    assert some.pop((places[0], places[0] + "2")) == 1
    assert set(some) == {k for k, v in want.items() if v >= 0.5} and all(abs(want[k] - v) < 1e-6 for k, v in some.items())
    bounded = {(r["a"], r["b"]) for r in N.cosine_pairs(keys).where("cosine < 1").collect()}
    assert bounded == {(a, b) for (a, b), v in want.items() if v >= max(bound[a], bound[b]) - 1e-9}
    edits = {(r["a"], r["b"]) for r in N.cosine_pairs(keys, reach=1).where("cosine < 1").collect()}
    assert edits == {k for k in want if S.one_edit(*k)} and edits <= bounded


def test_every_place_one_edit_away_meets(spark):
    random.seed(3)
    base = ["brown", "towomelo", "aaaaaa", "abababab", "xy" * 40] + ["".join(random.choice("abcdefgh") for _ in range(random.randrange(5, 13))) for _ in range(200)]
    near = []
    for w in base:
        i = random.randrange(len(w) - 1)
        near += [w[:i] + w[i + 1 :], w[:i] + "q" + w[i:], w[:i] + "z" + w[i + 1 :], w[:i] + w[i + 1] + w[i] + w[i + 2 :]]
    places = sorted({w for w in base + near if len(w) > 4})
    got = {(r["a"], r["b"]) for r in N.cosine_pairs(spark.createDataFrame([(p, "x", p) for p in places], "key string, block string, place string"), reach=1).collect()}
    assert got == {(a, b) for a in places for b in places if a < b and S.one_edit(a, b)}


def average(pairs, least):
    sim = {tuple(sorted(p[:2])): p[2] for p in pairs}
    groups = [{x} for x in sorted({x for p in pairs for x in p[:2]})]
    while True:
        best = max(((sum(sim.get(tuple(sorted((x, y))), 0) for x in a for y in b) / len(a) / len(b), i, j) for i, a in enumerate(groups) for j, b in enumerate(groups) if i < j), default=(0, 0, 0))
        if best[0] < least:
            return {frozenset(g) for g in groups}
        groups[best[1]] |= groups.pop(best[2])


def test_average_linkage_against_one_by_one_merging(spark):
    random.seed(11)
    pairs = [(f"n{a}", f"n{b}", random.random()) for a in range(14) for b in range(a + 1, 14) if random.random() < 0.5]
    got = defaultdict(set)
    for r in N.average_linkage(spark.createDataFrame(pairs, "a string, b string, sim double"), 0.3).collect():
        got[r["cluster"]].add(r["node"])
    assert {frozenset(g) for g in got.values()} == average(pairs, 0.3)


def test_weighted_linkage_takes_leaves_in_at_once(spark):
    pairs = [("hub", f"e{k}", 0.5) for k in range(30)] + [("hub", "other", 0.3), ("other", "f", 0.9)]
    weights = spark.createDataFrame([("hub", 900.0), ("other", 900.0), ("f", 1.0)] + [(f"e{k}", 1.0) for k in range(30)], "node string, w double")
    for least, groups in ((0.2, 1), (0.35, 2), (0.6, 32)):
        got = N.average_linkage(spark.createDataFrame(pairs, "a string, b string, sim double"), least, weights)
        assert got.select("cluster").distinct().count() == groups


def typed(spark, rows):
    entities = spark.createDataFrame([(i, "Person", name, None) for i, name in rows], "id string, type string, name string, name_as_cited string")
    return entities, spark.createDataFrame([], "entity_id string, alias string")


def together(spark, rows):
    groups = defaultdict(set)
    for r in N.name_groups(*typed(spark, rows)).collect():
        groups[r["group_id"]].add(r["entity_id"])
    return {frozenset(g) for g in groups.values()}


def test_a_name_takes_in_any_number_of_errors(spark):
    name = "towomelopraske"
    wrong = [name[:i] + "q" + name[i + 1 :] for i in range(len(name))] + [name[:i] + "x" + name[i:] for i in range(6)]
    for n_right in (1, 9):
        rows = [(f"r{k}", f"{name.title()}, Edward") for k in range(n_right)] + [(f"e{k}", f"{w.title()}, Edward") for k, w in enumerate(wrong)]
        assert together(spark, rows) == {frozenset(i for i, _ in rows)}


def test_an_error_between_two_names_joins_only_one(spark):
    rows = [("a1", "Hansenok, Edward"), ("a2", "Edward Hansenok"), ("b1", "Hanzanok, Edward"), ("b2", "Edward Hanzanok"), ("x1", "Hanzenok, Edward"), ("a4", "HANSENOK, Edward")]
    got = together(spark, rows)
    assert got in [{frozenset(("a1", "a2", "a4", *x)), frozenset(("b1", "b2", *y))} for x, y in ((("x1",), ()), ((), ("x1",)))]


def test_all_pairs_one_edit_apart_meet(spark):
    rows = [("a1", "Brown, Edward"), ("a2", "Edward Brown"), ("a3", "Borwn, Edward"), ("b1", "E. Smitha"), ("c1", "Smithaz, Edward"), ("d1", "Smith, Ann"), ("d2", "Ann Smith"), ("d3", "A. Smtih")]
    rows += [(f"z{k}", f"{x}{y}uvkel, Edward") for k, (x, y) in enumerate((x, y) for x in "BCDFGKLMNP" for y in "aeiou")]
    got = together(spark, rows)
    assert {frozenset(("a1", "a2", "a3")), frozenset(("d1", "d2", "d3"))} <= got
    words = [""] + [a + b + c for a in "abc" for b in "abc" for c in ["", *"abc"]]
    assert all(not S.one_edit(a, b) or set(S.left_out(a)) & set(S.left_out(b)) for a in words for b in words)


def test_a_recurring_error_is_rare_beside_its_name(spark):
    rows = [(f"r{k}", ("Pagrokluvi, Ann", "Ann Pagrokluvi")[k % 2]) for k in range(12)] + [("e1", "Pagrokkluvi, Ann"), ("e2", "Ann Pagrokkluvi")]
    rows += [(f"s{k}", ("Hansenok, Ann", "Ann Hansenok")[k % 2]) for k in range(4)] + [(f"t{k}", ("Hanzenok, Ann", "Ann Hanzenok")[k % 2]) for k in range(3)]
    assert together(spark, rows) == {frozenset(i for i, _ in rows if i[0] in kinds) for kinds in ("re", "s", "t")}


def test_words_looked_up_by_joins(spark):
    random.seed(5)
    tokens = sorted({"".join(random.choice("abc'" if k % 9 == 0 else "abc") for _ in range(random.randrange(1, 7))) for k in range(700)} - {""})
    tokens = [t for t in tokens if not t.startswith("'")]
    counts = {w: random.choice((1, 2, 9, 60)) for w in tokens if "'" not in w and random.random() < 0.3}
    sure = frozenset(("abcab", "ccca"))
    want = S.Words(counts, sure)
    learned = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    found = [r.asDict() for r in N.resolved(spark.createDataFrame([(t,) for t in tokens], "token string"), learned, sure, True).collect()]
    got = S.Looked(found)
    assert got.known == want.known
    assert all(got.correct(t) == want.correct(t) and (len(t) < 3 or got.longer(t) == want.longer(t)) for t in tokens)


def test_rare_given_names_are_learned_at_any_size(spark):
    rows = spark.range(61_000).select(F.concat(F.lit("m"), "id").alias("entity_id"), F.lit("Person").alias("type"), F.concat(F.lit("Fam"), "id", F.lit(", Edward")).alias("spelling"))
    rare = [(f"x{k}", "Person", f"{f}, Zyxabel") for k, f in enumerate(("Pogru", "Vlista", "Kamo"))] + [("x9", "Person", "pogru zyxabel")]
    got = N.readings(rows.unionByName(spark.createDataFrame(rare, rows.schema))).where("entity_id = 'x9'").collect()
    assert [(r["place"], r["full"]) for r in got] == [("pogru", "zyxabel")]
