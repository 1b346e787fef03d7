"""Linking the spellings of names typed by people.

1. Every spelling is read into a place (family name without particles, or town of
   an institution) and what stands there (given name, or kind and subject), in one
   form. Given names, short forms and subjects are learned from the corpus and stay
   in tables, which the words of the spellings are joined to.
2. A normalised name is a vector: one feature for what stands at the place, and the
   weighted character 3-grams of the place. Spellings that share the first and an
   indexed n-gram meet in a sparse cosine join; the bound on the cosine follows from
   the vector's size so that names one edit apart always reach it, however short they
   are or large the corpus. An exact check on single edits follows.
3. Weighted average linkage groups what is linked. A form weighs by its bearers and
   by the lesser forms around it, so that a name takes in any number of errors and
   an error between two names joins only one.
4. Records with a spelling in a group belong together; those known only by an
   initial or abbreviation meet bearers by the same cosine join and follow the one
   that fits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skeinmill.functions.cells import is_filler, strip_blanks
from skeinmill.llm import spelled
from skeinmill.llm.components import components
from skeinmill.operators.skew import even_join
from skeinmill.session import cut

#: A form is an error of one that so many times as many ids bear.
ODDS = 5
#: Average similarity at which groups still merge under average linkage.
LINKAGE = 0.2


def spellings(entities: DataFrame, aliases: DataFrame, types: tuple[str, ...] = ("Person", "Institution")) -> DataFrame:
    """(entity_id, type, spelling): every distinct spelling of every person and institution; null, blank and filler are none."""
    who = entities.where(F.col("type").isin(*types) & F.col("id").isNotNull())
    own = who.select(F.col("id").alias("entity_id"), "type", F.explode(F.array("name", "name_as_cited")).alias("spelling"))
    ids = who.select(F.col("id").alias("entity_id"), "type").distinct()
    other = aliases.select("entity_id", F.col("alias").alias("spelling")).join(ids, "entity_id").select("entity_id", "type", "spelling")
    return own.unionByName(other).where(~is_filler(F.col("spelling"))).select("entity_id", "type", strip_blanks(F.col("spelling")).alias("spelling")).distinct()


def _words(kind: str):
    reader = spelled.InstituteReader(spelled.Words({}))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out = []
            for s in pdf["spelling"]:
                if kind == "given":
                    out.append(spelled.comma_given(s))
                elif kind == "subject":
                    out.extend(spelled.comma_subject(s))
                else:
                    out.append(reader.acronym(s))
            yield pd.DataFrame({"word": [w for w in out if w]}, dtype=object)

    return run


def _learned(rows: DataFrame, kind: str, least: int) -> DataFrame:
    """(word, n) of all words of one kind that occur ``least`` times or more."""
    return cut(rows.mapInPandas(_words(kind), "word string").groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least))


def _tokens(kind: str):
    split = spelled.person_tokens if kind == "Person" else spelled.institute_tokens

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            yield pd.DataFrame([(s, t) for s in pdf["spelling"] for t in split(s)], columns=["spelling", "token"])

    return run


def _reader(kind: str):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        nothing = spelled.Words({})
        reader = spelled.PersonReader(nothing) if kind == "Person" else spelled.InstituteReader(nothing)
        for pdf in frames:
            out = []
            for s, found in zip(pdf["spelling"], pdf["words"]):
                found = [] if found is None else found
                looked = spelled.Looked(found)
                if kind == "Person":
                    reader.given = looked
                else:
                    reader.subjects, reader.acronyms = looked, frozenset({"nl", *(x["token"] for x in found if x["acronym"])})
                r = reader.read(s)
                if r is not None:
                    out.append((s, spelled.core(r.place, kind == "Person"), r.full, r.hint, r.middle))
            yield pd.DataFrame(out, columns=["spelling", "place", "full", "hint", "middle"])

    return run


def resolved(asked: DataFrame, learned: DataFrame, sure: frozenset[str] = frozenset(), prefixes: bool = False, odds: int = 5) -> DataFrame:
    """(token, known, stands, longer) of the words ``asked`` (token): what Words of all ``learned`` (word, n) says of each.

    The same rules as in spelled.Words, by joins: a word stands for itself or for the
    commonest one an edit away; ``longer`` is the commonest that it begins, or that
    it shortens by an apostrophe. Words that nothing is known of are left out.
    """
    fixed = asked.sparkSession.createDataFrame([(w, True) for w in sorted(sure)], "word string, sure boolean")
    words = cut(learned.join(fixed, "word", "full").select("word", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("sure", F.lit(False)).alias("sure")))
    own = cut(asked.select("token").union(words.select("word")).distinct().join(words.withColumnRenamed("word", "token"), "token", "left"))
    unsure = own.where(~F.coalesce("sure", F.lit(False)) & (F.length("token") > 3)).select("token", F.col("token").alias("wa"))
    met = edit_met(unsure, words.where(F.length("word") > 3).select("word", F.col("word").alias("wb")), "token", "word", [])
    near = met.join(own.select("token", F.col("n").alias("m")), "token").join(words, "word")
    enough = (F.col("n") >= F.greatest(F.lit(1), F.coalesce("m", F.lit(0)) * odds)) | (F.col("sure") & F.col("m").isNull())
    best = near.where(enough).groupBy("token").agg(F.max(F.struct("n", "word")).alias("r")).select("token", F.col("r.word").alias("best"))
    known = F.col("n").isNotNull()
    stands = F.when(F.col("sure"), F.col("token")).when(known, F.coalesce("best", "token")).otherwise(F.col("best"))
    out = cut(own.join(best, "token", "left").select("token", known.alias("known"), stands.alias("stands")))
    if not prefixes:
        return out.withColumn("longer", F.lit(None).cast("string")).where(F.col("stands").isNotNull())
    counts = words.select(F.col("word").alias("stands"), F.col("n").alias("m"))
    full = out.where("known").select(F.col("token").alias("word"), "stands").join(counts, "stands")
    begun = full.select("word", "stands", "m", F.explode(_starts("word")).alias("print"))
    head = F.substring_index("token", "'", 1)
    probe = out.where(F.length("token") > 2).select("token", head.alias("head"), F.try_element_at(_starts(head), F.lit(-1)).alias("print"))
    tail = F.expr("substring(token, length(head) + 2)")
    clipped = F.col("token").contains("'")
    fits = F.when(clipped, F.col("word").endswith(tail) & (F.col("word") == F.col("stands"))).otherwise(F.length("word") > F.length("token"))
    longer = probe.join(begun, "print").where(F.col("word").startswith(F.col("head")) & fits).groupBy("token").agg(F.max(F.struct("m", "stands")).alias("r"))
    out = out.join(longer.select("token", F.col("r.stands").alias("longer")), "token", "left")
    return out.where(F.col("stands").isNotNull() | F.col("longer").isNotNull())


def _read(rows: DataFrame, kind: str, learned: DataFrame, acronyms: DataFrame | None = None) -> DataFrame:
    """``rows`` with the reading of each spelling that could be read; words are looked up per spelling."""
    spellings_ = cut(rows.select("spelling").distinct())
    tokens = cut(spellings_.mapInPandas(_tokens(kind), "spelling string, token string"))
    asked = tokens.select("token").distinct()
    found = resolved(asked, learned, prefixes=kind != "Person")
    if acronyms is None:
        found = found.withColumn("acronym", F.lit(False))
    else:
        short = acronyms.select(F.col("word").alias("token"), F.lit(True).alias("acronym"))
        found = found.join(short, "token", "full").select("token", F.coalesce("known", F.lit(False)).alias("known"), "stands", "longer", F.coalesce("acronym", F.lit(False)).alias("acronym"))
    words = even_join(tokens, cut(found), "token").groupBy("spelling").agg(F.collect_list(F.struct("token", "known", "stands", "longer", "acronym")).alias("words"))
    read = spellings_.join(words, "spelling", "left").mapInPandas(_reader(kind), "spelling string, place string, full string, hint string, middle string")
    return even_join(rows, cut(read), "spelling").select("entity_id", "type", "spelling", "place", "full", "hint", "middle")


@F.pandas_udf(T.ArrayType(T.LongType()))
def _starts(words: pd.Series) -> pd.Series:
    return words.map(spelled.starts)


@F.pandas_udf(T.ArrayType(T.LongType()))
def _left_out(words: pd.Series) -> pd.Series:
    return words.map(spelled.left_out)


@F.pandas_udf(T.BooleanType())
def _one_edit(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([spelled.one_edit(x, y) for x, y in zip(a, b)])


def edit_met(a: DataFrame, b: DataFrame, ka: str, kb: str, at: list[str]) -> DataFrame:
    """(ka, kb): all rows of ``a`` (ka, wa, at) and ``b`` (kb, wb, at) of one ``at`` whose words wa and wb are one edit apart or equal."""
    one = a.select(ka, "wa", *at, F.explode(_left_out("wa")).alias("print"))
    other = b.select(kb, "wb", *at, F.explode(_left_out("wb")).alias("print"))
    met = one.join(other, [*at, "print"]).where((F.col(ka) != F.col(kb)) & (F.abs(F.length("wa") - F.length("wb")) <= 1))
    return met.select(ka, kb, "wa", "wb").distinct().where(_one_edit("wa", "wb")).select(ka, kb)


def _short_forms(read: DataFrame, given: DataFrame) -> DataFrame:
    """(short, long, n_longs): short forms that ids use beside a full name, not one edit from it.

    A form counts as short for a name that stands beside it in two or more ids
    and in a quarter of the ids where it stands beside any; n_longs says for how many.
    """
    fulls = read.where(F.col("full") != "").select("entity_id", "full").distinct()
    # An id has more than one given name only by way of a short form or an error; ids are what is grouped.
    several = fulls.groupBy("entity_id").agg(F.min("full").alias("a"), F.max("full").alias("b")).where(F.col("a") != F.col("b"))
    pairs = several.groupBy("a", "b").agg(F.count(F.lit(1)).alias("votes")).where(F.col("votes") > 1)
    side = lambda c: given.select(F.col("word").alias(c), F.col("n").alias(f"n{c}"))
    pairs = pairs.join(side("a"), "a", "left").join(side("b"), "b", "left").fillna(0, ["na", "nb"])
    ends = F.array_sort(F.array(F.struct(F.col("na").alias("n"), F.col("a").alias("w")), F.struct(F.col("nb").alias("n"), F.col("b").alias("w"))))
    ranked = pairs.select(ends[0].alias("low"), ends[1].alias("high"), "votes").where(F.col("high.n") >= ODDS * F.col("low.n"))
    ranked = cut(ranked.select(F.col("low.w").alias("short"), F.col("high.w").alias("long"), "votes").where(~_one_edit("short", "long")))
    kept = ranked.join(ranked.groupBy("short").agg(F.sum("votes").alias("total")), "short").where(4 * F.col("votes") >= F.col("total"))
    return cut(kept.join(kept.groupBy("short").agg(F.count(F.lit(1)).alias("n_longs")), "short").select("short", "long", "n_longs"))


def _unglued(people: DataFrame) -> DataFrame:
    """``people`` with family names like ``vanderberg`` read as ``berg``, where one of the same initial is called so."""
    initial = F.substring(F.concat("full", "hint"), 1, 1)
    names = cut(people.select(initial.alias("initial"), "place").distinct())
    rest = F.array(*[F.when(F.col("place").startswith(p), F.expr(f"substring(place, {len(p) + 1})")) for p in spelled.GLUED])
    glued = names.select("initial", F.col("place").alias("glued"), F.explode(F.filter(rest, lambda x: x.isNotNull() & (F.length(x) > 4))).alias("place"))
    found = glued.join(names, ["initial", "place"], "left_semi").groupBy("initial", "glued").agg(F.min(F.struct(F.length("place").alias("n"), "place")).alias("r"))
    found = cut(found.select("initial", F.col("glued").alias("place"), F.col("r.place").alias("short")))
    named = people.withColumn("initial", initial).join(found, ["initial", "place"], "left")
    return named.select("entity_id", "type", "spelling", F.coalesce("short", "place").alias("place"), "full", "hint", "middle")


def _readings(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The readings, and the short forms that several names have."""
    people, places = rows.where(F.col("type") == "Person"), rows.where(F.col("type") == "Institution")
    given = _learned(people, "given", 3)
    first = cut(_read(people, "Person", given))
    shorts = _short_forms(first, given)
    one = shorts.groupBy(F.col("short").alias("full")).agg(F.min("long").alias("long"), F.max("n_longs").alias("n_longs"))
    named = even_join(first, one, "full", "left")
    unclear = F.coalesce(F.col("n_longs"), F.lit(1)) > 1
    named = named.select("entity_id", "type", "spelling", "place", F.when(unclear, "").otherwise(F.coalesce("long", "full")).alias("full"), F.when(unclear, F.col("full")).otherwise(F.col("hint")).alias("hint"), "middle")
    named = _unglued(cut(named))
    both = cut(named.unionByName(_read(places, "Institution", _learned(places, "subject", 1), _learned(places, "acronym", 2))))
    return both, shorts.where(F.col("n_longs") > 1).select("short", "long")


def readings(rows: DataFrame) -> DataFrame:
    """(entity_id, type, spelling, place, full, hint, middle) of every spelling that could be read."""
    return _readings(rows)[0]


#: Distinct n-grams up to which their weights are broadcast (about 30 bytes each); above, both sides are shuffled.
BROADCAST = 500_000


def _grams(place):
    """3-grams of a place with its edges marked."""
    s = F.concat(F.lit("^^"), place, F.lit("$$"))
    return F.transform(F.sequence(F.lit(1), F.length(s) - 2), lambda i: F.substring(s, i, F.lit(3)))


@F.pandas_udf(T.LongType())
def _indexed(weights: pd.Series, bound: pd.Series) -> pd.Series:
    """How many n-grams, heaviest first, have to be indexed: what is left weighs less than ``bound``."""

    def first(w, b) -> int:
        w = np.asarray(w, dtype=float)
        left = np.cumsum((w * w)[::-1])[::-1]
        return int((left >= b * b).sum())

    return pd.Series([first(w, b) for w, b in zip(weights, bound)])


def vectors(places: DataFrame, least: float | None = None) -> DataFrame:
    """(place, size, bound, k, v) of all distinct ``places`` (place): weighted 3-grams of length 1 together, heaviest first.

    The square of a weight is 1 for an n-gram that all places have and rises with
    its rarity to 2 at most. One edit changes at most four of the m different
    n-grams of a place, so two places one edit apart have a cosine of at least
    (m - 4) / (m + 4) for either m; that is a place's ``bound``, unless ``least`` sets one. The first
    k n-grams are to be indexed: vectors that share none before their cuts stay under the greater bound.
    """
    places = cut(places.distinct())
    n = places.count()
    grams = places.select("place", F.posexplode(_grams(F.col("place"))).alias("at", "gram")).groupBy("place", "gram").agg(F.array_sort(F.collect_list("at")).alias("ats"))
    weight = cut(grams.groupBy("gram").agg(F.count(F.lit(1)).alias("df")).select("gram", F.sqrt(1 + F.log(F.lit(float(n)) / F.col("df")) / F.lit(max(math.log(n), 1.0) if n else 1.0)).alias("w")))
    met = grams.join(F.broadcast(weight), "gram") if weight.count() <= BROADCAST else even_join(grams, weight, "gram")
    made = met.groupBy("place").agg(F.sort_array(F.collect_list(F.struct("w", "gram", "ats")), asc=False).alias("v"), F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    made = made.select("place", F.length("place").alias("size"), F.transform("v", lambda x: F.struct((x["w"] / F.col("norm")).alias("w"), x["gram"].alias("gram"), x["ats"].alias("ats"))).alias("v"))
    m = F.size("v")
    bound = F.greatest((m - 4) / (m + 4), F.lit(0.1)) if least is None else F.lit(least)
    made = made.withColumn("bound", bound.cast("double"))
    return cut(made.select("place", "size", "bound", _indexed(F.transform("v", lambda x: x["w"]), "bound").cast("int").alias("k"), "v"))


def _index(names: DataFrame, vec: DataFrame, end: str) -> DataFrame:
    """One row for each indexed n-gram of ``names`` (n, block, place) and each of its places in the name."""
    found = names.join(vec.select("place", "size", F.slice("v", F.lit(1), F.col("k")).alias("v")), "place")
    found = found.select("n", "block", "place", "size", F.explode("v").alias("g")).select("n", "block", "place", "size", "g.gram", F.explode("g.ats").alias("at"))
    return found.select(F.xxhash64("block", "gram").alias("print"), F.col("n").alias(f"n{end}"), F.col("place").alias(f"p{end}"), F.col("size").alias(f"s{end}"), F.col("at").alias(f"at{end}"))


def _scored(one: DataFrame, other: DataFrame, vec: DataFrame, reach: int | None, both_ways: bool) -> DataFrame:
    """(na, nb, cosine) of the rows of ``one`` and ``other`` (n, block, place) of one block that reach their bounds."""
    near = F.lit(True) if reach is None else (F.abs(F.col("sa") - F.col("sb")) <= reach) & (F.abs(F.col("ata") - F.col("atb")) <= reach)
    order = F.col("na") < F.col("nb") if both_ways else F.lit(True)
    met = _index(one, vec, "a").join(_index(other, vec, "b"), "print").where(order & near & (F.col("pa") != F.col("pb"))).select("na", "nb", "pa", "pb").distinct()
    # What shares an n-gram within one character is checked to be a single edit before it is scored; blocks are compared as hashes.
    met = cut(met.where(_one_edit("pa", "pb")) if reach == 1 else met)
    va = vec.select(F.col("place").alias("pa"), F.map_from_entries(F.transform("v", lambda x: F.struct(x["gram"], x["w"]))).alias("va"), F.col("bound").alias("ba"))
    vb = vec.select(F.col("place").alias("pb"), F.col("v").alias("vb"), F.col("bound").alias("bb"))
    dot = F.aggregate("vb", F.lit(0.0), lambda acc, x: acc + x["w"] * F.coalesce(F.try_element_at("va", x["gram"]), F.lit(0.0)))
    scored = met.join(va, "pa").join(vb, "pb").select("na", "nb", F.least(dot, F.lit(1 - 1e-9)).alias("cosine"), F.greatest("ba", "bb").alias("bound"))
    return scored.where(F.col("cosine") >= F.col("bound") - 1e-9).select("na", "nb", "cosine")


def cosine_pairs(keys: DataFrame, least: float | None = None, reach: int | None = None, vec: DataFrame | None = None) -> DataFrame:
    """(a, b, cosine) of the keys (key, block, place) of one block whose vectors are alike.

    Keys with equal places have equal vectors: the least of them, a, stands for
    every other, b, with cosine 1. Pairs of such least keys come out if their
    cosine reaches ``least``, or without it both places' own bounds (see vectors), so that no
    pair one edit apart is lost. With ``reach`` only pairs count whose lengths, and the
    places of a shared indexed n-gram, differ by so many characters at most; with a
    reach of 1 they have to be a single edit apart as well. Blocks are joined by block
    and n-gram together, so one with a third of all keys spreads over its n-grams.
    ``vec`` are the ``vectors`` of all places, where they are known already.
    """
    kept = cut(keys.select("key", "block", "place"))
    reps = cut(kept.groupBy("block", "place").agg(F.min("key").alias("key")).withColumn("n", F.monotonically_increasing_id()))
    equal = kept.join(reps.select("block", "place", F.col("key").alias("a")), ["block", "place"]).where(F.col("a") != F.col("key")).select("a", F.col("key").alias("b"), F.lit(1.0).alias("cosine"))
    names = reps if reach is None else reps.where(F.length("place") > 4)
    found = _scored(names.drop("key"), names.drop("key"), vectors(names.select("place"), least) if vec is None else vec, reach, True)
    side = lambda n, k: reps.select(F.col("n").alias(n), F.col("key").alias(k))
    near = found.join(side("na", "x"), "na").join(side("nb", "y"), "nb").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "cosine")
    return equal.unionByName(near)


def cosine_matches(asked: DataFrame, others: DataFrame, vec: DataFrame) -> DataFrame:
    """(block, place, other, cosine): for each ``asked`` (block, place) the equal place of ``others`` in its block, else all one edit apart."""
    asked, others = asked.distinct(), cut(others.select("block", "place").distinct())
    met = cut(asked.join(others.select("block", "place", F.lit(1.0).alias("cosine")), ["block", "place"], "left"))
    lost = cut(met.where(F.col("cosine").isNull() & (F.length("place") > 4)).select("block", "place").withColumn("n", F.monotonically_increasing_id()))
    there = others.where(F.length("place") > 4).join(lost.select("block").distinct(), "block", "left_semi")
    there = cut(there.withColumn("n", F.monotonically_increasing_id()))
    found = _scored(lost, there, vec, 1, False)
    near = found.join(lost.withColumnRenamed("n", "na"), "na").join(there.select(F.col("n").alias("nb"), F.col("place").alias("other")), "nb").select("block", "place", "other", "cosine")
    return met.where(F.col("cosine").isNotNull()).select("block", "place", F.col("place").alias("other"), "cosine").unionByName(near)


def average_linkage(pairs: DataFrame, least: float = LINKAGE, weights: DataFrame | None = None) -> DataFrame:
    """(node, cluster) of every node of ``pairs`` (a, b, sim): clusters of average similarity ``least`` or more.

    Pairs that are not given have similarity 0; ``weights`` (node, w) makes the averages
    weighted. In each round every cluster points at its most similar neighbour
    (ties by a fixed order of pairs), and two that point at each other merge.
    Average linkage is reducible: such merges never change what the best
    remaining merge is, so the groups are those of the one-by-one method. A cluster's
    neighbours that have no other one merge with it all at once where even the last of them would
    be similar enough, and more similar than anything else around it; so a
    name with many errors takes no more rounds than one with few. The most
    similar pair of all is always mutual, so rounds end.
    """
    given = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "sim")
    members = given.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    members = members.withColumn("w", F.lit(1.0)) if weights is None else members.join(weights.select("node", F.col("w").cast("double").alias("w")), "node")
    members = cut(members.withColumn("cluster", F.col("node")))
    own = lambda c, w: members.select(F.col("node").alias(c), F.col("w").alias(w))
    links = cut(given.join(own("a", "wa"), "a").join(own("b", "wb"), "b").select("a", "b", (F.col("sim") * F.col("wa") * F.col("wb")).alias("total")))
    while True:
        sizes = members.groupBy("cluster").agg(F.sum("w").alias("w"))
        size = lambda c, w: sizes.select(F.col("cluster").alias(c), F.col("w").alias(w))
        mean = links.join(size("a", "wa"), "a").join(size("b", "wb"), "b").withColumn("mean", F.col("total") / (F.col("wa") * F.col("wb")))
        rank = F.struct("mean", F.xxhash64("a", "b").alias("h"), "a", "b")
        way = lambda c, o, wc, wo: F.struct(F.col(c).alias("c"), F.col(o).alias("o"), F.col(wc).alias("wc"), F.col(wo).alias("wo"))
        ends = cut(mean.select("mean", rank.alias("r"), F.explode(F.array(way("a", "b", "wa", "wb"), way("b", "a", "wb", "wa"))).alias("x")).select("mean", "r", "x.*"))
        degree = ends.groupBy("c").agg(F.count(F.lit(1)).alias("d"))
        around = ends.join(degree, "c").join(degree.select(F.col("c").alias("o"), F.col("d").alias("do")), "o")
        # Seen from hub c: its leaves o, with the lesser end of a lone pair as the leaf.
        leaf = (F.col("do") == 1) & ((F.col("d") > 1) | (F.struct("wo", "o") < F.struct("wc", "c")))
        stars = around.groupBy("c").agg(F.sum(F.when(leaf & (F.col("mean") >= least), F.col("wo"))).alias("more"), F.max(F.when(~leaf, F.col("mean"))).alias("rival"))
        diluted = F.col("mean") * F.col("wc") / (F.col("wc") + F.col("more"))
        joined = cut(around.where(leaf & (F.col("mean") >= least)).join(stars, "c").where(diluted >= F.greatest(F.lit(least), F.coalesce("rival", F.lit(0.0)))).select(F.col("c").alias("keep"), F.col("o").alias("old")))
        busy = joined.select("keep").union(joined.select("old")).distinct()
        best = ends.where(F.col("mean") >= least).groupBy("c").agg(F.max("r").alias("r"))
        mutual = best.groupBy("r").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == 2).select(F.col("r.a").alias("keep"), F.col("r.b").alias("old"))
        free = mutual.join(busy, "keep", "left_anti").join(busy.select(F.col("keep").alias("old")), "old", "left_anti")
        merged = cut(joined.unionByName(free.select("keep", "old")))
        if merged.isEmpty():
            return members.select("node", "cluster")
        renamed = lambda df, c: df.join(merged.select(F.col("old").alias(c), "keep"), c, "left").withColumn(c, F.coalesce("keep", c)).drop("keep")
        members = cut(renamed(members, "cluster"))
        moved = renamed(renamed(links, "a"), "b").where(F.col("a") != F.col("b"))
        links = cut(moved.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.sum("total").alias("total")))


def spelling_groups(read: DataFrame, vec: DataFrame) -> DataFrame:
    """(key, cluster): spellings (type and spelling) that say in full what stands at a place, grouped.

    Spellings with equal vectors are one form. Two forms are linked if the cosine
    join finds them, a single edit lies between their places, of more than four letters, and one
    of them is rare: typed one way only, or borne by at most one id for every ODDS
    of the other. A name that was independently written twice in the same letters
    is an error only beside one so much commoner. A form weighs the square of its
    ids times one more than the number of lesser forms it is linked with.
    """
    full = read.where(F.col("full") != "").select("entity_id", _form().alias("key"), F.concat_ws("\u0001", "type", "full").alias("block"), "place", F.lower("spelling").alias("typed"))
    pairs = cut(cosine_pairs(full.select("key", "block", "place").distinct(), reach=1, vec=vec))
    equal = pairs.where(F.col("cosine") == 1).select(F.col("b").alias("key"), F.col("a").alias("form"))
    forms = cut(full.join(equal, "key", "left").withColumn("form", F.coalesce("form", "key")).select("entity_id", "key", "form", "typed"))
    counts = forms.groupBy("form").agg(F.count_distinct("typed").alias("ways"), F.count_distinct("entity_id").alias("ids"))
    near = pairs.where(F.col("cosine") < 1)
    counts = cut(counts.join(near.select(F.explode(F.array("a", "b")).alias("form")).distinct(), "form", "left_semi"))
    side = lambda c: counts.select(F.col("form").alias(c), F.col("ways").alias(f"w{c}"), F.col("ids").alias(f"i{c}"))
    rare = (F.least("wa", "wb") == 1) | (F.least("ia", "ib") * ODDS <= F.greatest("ia", "ib"))
    near = cut(near.join(side("a"), "a").join(side("b"), "b").where(rare).select("a", "b", F.col("cosine").alias("sim"), "ia", "ib"))
    ends = near.select(F.explode(F.array(F.struct(F.col("a").alias("c"), F.col("b").alias("o"), F.col("ia").alias("i"), F.col("ib").alias("io")), F.struct(F.col("b").alias("c"), F.col("a").alias("o"), F.col("ib").alias("i"), F.col("ia").alias("io")))).alias("x")).select("x.*")
    degree = ends.groupBy("c").agg(F.count(F.lit(1)).alias("d"))
    ends = ends.join(degree, "c").join(degree.select(F.col("c").alias("o"), F.col("d").alias("do")), "o")
    lesser = F.struct("io", "do", "o") < F.struct("i", "d", "c")
    mass = F.max("i") * (1 + F.sum(F.when(lesser, 1).otherwise(0)))
    clusters = average_linkage(near, weights=ends.groupBy(F.col("c").alias("node")).agg((mass * mass).alias("w")))
    named = forms.select("key", "form").distinct().join(clusters.withColumnRenamed("node", "form"), "form", "left")
    return cut(named.select("key", F.coalesce("cluster", "form").alias("cluster")))


def _form():
    return F.concat_ws("\u0001", "type", "spelling")


def _hinted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in frames:
        out = []
        for kind, place, full, middle, group in zip(pdf["type"], pdf["place"], pdf["full"], pdf["middle"], pdf["group_id"]):
            if kind == "Person":
                out += [(kind, place, h, m or middle, group) for h, m in spelled.initials(full)]
            else:
                head, _, tail = full.partition(" | ")
                out.append((kind, place, "".join(sorted(w[0] for w in [*head.replace("|", "").split(), *tail.split()])), "", group))
        yield pd.DataFrame(out, columns=["type", "place", "hint", "middle", "group_id"])


def name_groups(entities: DataFrame, aliases: DataFrame) -> DataFrame:
    """(entity_id, type, group_id): every id of a person or institution with a readable spelling.

    Ids with a spelling in one group belong together. An id known only by an
    initial, unclear short form or abbreviation joins the one group of its family
    name or place that fits (a place that equals none of a bearer may be one edit from one
    that does), its middle initial where both have one; where none fits, ids with the
    same hint join each other, and where several fit it stays alone unless
    another of its spellings, such as name_as_cited, tells. A spelling of one word,
    or of nothing but a kind, belongs with equal ones only. Ids of
    different types never meet. Empty tables give no rows; rows delivered again
    and extra columns change nothing.
    """
    read, shorts = _readings(cut(spellings(entities, aliases)))
    full = read.where(F.col("full") != "").select("entity_id", _form().alias("key"), "type", "full", "place", "middle")
    vec = vectors(read.where(F.length("place") > 4).select("place"))
    tied = cut(full.join(spelling_groups(read, vec), "key"))
    # An id holds all its clusters together; one with a single cluster links nothing.
    least = tied.groupBy("entity_id").agg(F.min("cluster").alias("least"))
    tied = cut(tied.join(least, "entity_id"))
    found = cut(components(tied.where(F.col("cluster") != F.col("least")).select(F.col("least").alias("a"), F.col("cluster").alias("b")).distinct()))
    grouped = even_join(tied, found.select(F.col("node").alias("least"), "group_id"), "least", "left")
    known = cut(grouped.select("entity_id", "type", "full", "place", "middle", F.coalesce("group_id", "least").alias("group_id")).distinct())
    settled = known.select("entity_id", "type", "group_id").distinct()
    shape = "type string, place string, hint string, middle string, group_id string"
    bearers = known.select("type", "place", "full", "middle", "group_id").distinct()
    short = bearers.where(F.col("type") == "Person").join(F.broadcast(shorts) if shorts.count() <= BROADCAST else shorts, F.col("full") == F.col("long")).select("type", "place", F.col("short").alias("hint"), "middle", "group_id")
    bearers = bearers.mapInPandas(_hinted, shape).unionByName(short).distinct()
    # Per group the middle initial it has, if any; then how many groups a hint fits.
    of_group = cut(bearers.groupBy("type", "place", "hint", "group_id").agg(F.max("middle").alias("middle")))
    at = ["type", "place", "hint"]
    fits = of_group.groupBy(*at, "middle").agg(F.count(F.lit(1)).alias("n"), F.min("group_id").alias("group_id"))
    exact = fits.where((F.col("middle") != "") & (F.col("n") == 1)).select(*at, "middle", F.col("group_id").alias("g_exact"))
    taken = fits.where(F.col("middle") != "").select(*at, "middle", F.lit(True).alias("is_taken"))
    bare = fits.where((F.col("middle") == "") & (F.col("n") == 1)).select(*at, F.col("group_id").alias("g_bare"))
    any_ = of_group.groupBy(*at).agg(F.count(F.lit(1)).alias("n_any"), F.min("group_id").alias("g_any"))
    hint = F.when(F.col("type") == "Person", F.col("hint")).otherwise(_sorted_letters(F.col("hint")))
    vague = cut(
        read.where((F.col("full") == "") & (F.col("hint") != ""))
        .select("entity_id", "type", F.col("place").alias("written"), hint.alias("hint"), "middle")
        .distinct()
        .join(settled.select("entity_id"), "entity_id", "left_anti")
    )
    block = F.concat_ws("\u0001", "type", "hint")
    met = cosine_matches(vague.select(block.alias("block"), F.col("written").alias("place")), of_group.select(block.alias("block"), "place"), vec)
    met = met.select("block", F.col("place").alias("written"), F.col("other").alias("place"))
    vague = cut(vague.withColumn("block", block).join(met, ["block", "written"], "left").drop("block"))
    chosen = cut(
        vague.join(any_, at, "left").join(exact, [*at, "middle"], "left").join(taken, [*at, "middle"], "left").join(bare, at, "left")
        .withColumn(
            "group_id",
            F.when(F.col("g_exact").isNotNull(), F.col("g_exact"))
            .when((F.col("middle") == "") & (F.col("n_any") == 1), F.col("g_any"))
            .when((F.col("middle") != "") & F.col("is_taken").isNull(), F.col("g_bare")),
        )
    )
    # An id whose hints lead to different groups, or to several bearers, stays alone.
    alone = F.concat(F.lit("i"), "entity_id")
    placed = chosen.where(F.col("n_any").isNotNull()).groupBy("entity_id", "type").agg(F.min("group_id").alias("low"), F.max("group_id").alias("high"))
    placed = placed.select("entity_id", "type", F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(alone).alias("group_id"))
    # Ids whose hints fit nobody meet each other under the hint that most of them share.
    lost = chosen.where(F.col("n_any").isNull()).join(placed.select("entity_id"), "entity_id", "left_anti")
    lost = lost.select("entity_id", "type", F.concat_ws("\u0001", F.lit("h"), "type", "written", "hint").alias("group_id")).distinct()
    sizes = lost.groupBy("group_id").agg(F.count(F.lit(1)).alias("n"))
    rank = F.struct((-F.col("n")).alias("minus"), "group_id")
    rest = even_join(lost, sizes, "group_id").groupBy("entity_id", "type").agg(F.min(rank).alias("r")).select("entity_id", "type", F.col("r.group_id").alias("group_id"))
    return settled.unionByName(placed).unionByName(rest)


def _sorted_letters(col):
    return F.array_join(F.array_sort(F.split(col, "")), "")


#: Ids of one group that one task pairs up with all others of the group.
SLICE = 1_000


def same_name_pairs(entities: DataFrame, aliases: DataFrame) -> DataFrame:
    """(id_a, id_b): ids of one type that name the same person or organisation, id_a < id_b. Big groups are paired in slices."""
    groups = cut(name_groups(entities, aliases).select("type", "group_id", "entity_id").distinct())
    several = groups.groupBy("type", "group_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select("type", "group_id", F.ceil(F.col("n") / SLICE).cast("int").alias("slices"))
    members = cut(groups.join(several, ["type", "group_id"]))
    at = ["type", "group_id", "slice"]
    a = members.select("type", "group_id", F.pmod(F.xxhash64("entity_id"), F.col("slices")).cast("int").alias("slice"), F.col("entity_id").alias("id_a"))
    b = members.select("type", "group_id", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), F.col("entity_id").alias("id_b"))
    return a.join(b, at).where(F.col("id_a") < F.col("id_b")).select("id_a", "id_b")
