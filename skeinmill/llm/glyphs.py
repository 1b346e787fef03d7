"""One consistent form for text that looks the same but is stored with other characters.

The vocabulary of the whole corpus decides. Clean spellings (composed, of one
script) stand in tries; every token that is not plain is led through them by a
weighted edit automaton in which look-alikes, joined letters, composition and
ignorables cost nothing and every other edit costs one, which no budget here
allows. Of the clean spellings reached, one in ASCII becomes canonical, else the
most frequent. So a Cyrillic word that could be read as a Latin one is
rewritten exactly where the corpus has the Latin one, and no table could tell.
A token of mixed scripts that reaches nothing is tried once more with the wider
look-alikes of Unicode's confusables, which are believed only there. What is
left is normalised by table, character by character, if it is of mixed scripts or
holds forms, and left alone if it is clean. Tokens and spellings meet by hash
of their widest folding, so tries stay as small as one bucket, however
large the vocabulary grows.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinmill.operators.skew import even_join
from skeinmill.session import cut

#: Letters of other scripts drawn like a Latin letter, and that letter.
LOOK_ALIKES = dict(
    zip(
        "АВЕЅІЈКМНОРСТХҮУ" "аеіјорсухѕһԁԛԝӏ" "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧ" "ο",
        "ABESIJKMHOPCTXYY" "aeijopcyxshdqwl" "ABEZHIKMNOPTYX" "o",
        strict=True,
    )
)
#: Hyphens and minus drawn like the ASCII hyphen; signs that repeat a letter.
SIGNS = {"‐": "-", "‑": "-", "﹣": "-", "－": "-", "µ": "μ"}
#: Characters of category Cf that are drawn.
DRAWN_FORMATS = "؀؁؂؃؄؅۝܏࣢𑂽𑃍"
#: Invisible characters of other categories (joiners, fillers, variation selectors).
OTHER_INVISIBLE = "͏᠋᠌᠍᠏ᅟᅠㅤﾠ" + "".join(map(chr, range(0xFE00, 0xFE10)))


def _table() -> dict[int, str]:
    out: dict[int, str] = {}
    for cp in range(0x80, 0x30000):
        ch = chr(cp)
        kind, parts = unicodedata.category(ch), unicodedata.decomposition(ch)
        if kind == "Cn":
            continue
        if (kind == "Cf" and ch not in DRAWN_FORMATS) or ch in OTHER_INVISIBLE:
            out[cp] = ""
        elif kind == "Zs":
            out[cp] = " "
        elif parts.startswith(("<wide>", "<narrow>")) or "LIGATURE" in unicodedata.name(ch, "") and parts.startswith("<compat>") and unicodedata.name(ch).startswith("LATIN"):
            out[cp] = unicodedata.normalize("NFKC", ch)
        elif parts and not parts.startswith("<"):
            out[cp] = unicodedata.normalize("NFD", ch)
    for ch, to in (LOOK_ALIKES | SIGNS).items():
        out[ord(ch)] = to
    # Folded parts are folded again: a wide hyphen, an accented look-alike.
    return {cp: "".join(out.get(ord(c), c) for c in to) for cp, to in out.items()}


_TABLE: dict[int, str] | None = None


def table() -> dict[int, str]:
    """Character code to its folded spelling, built once per process from the Unicode data."""
    global _TABLE
    if _TABLE is None:
        _TABLE = _table()
    return _TABLE


def skeleton(text: str) -> str:
    """The text with every character folded; texts look the same exactly if their skeletons are equal."""
    return text if text.isascii() else unicodedata.normalize("NFC", text.translate(table()))


@lru_cache(maxsize=100_000)
def _script(c: str) -> str:
    return unicodedata.name(c, "?").split(" ")[0]


def _scripts(token: str) -> set[str]:
    return {_script(c) for c in token if c.isalpha()}


def is_clean(token: str) -> bool:
    """Whether a token may be a canonical spelling: composed, letters of one script, nothing that is only a form of another character."""
    if token.isascii():
        return True
    if unicodedata.normalize("NFC", token) != token or len(_scripts(token)) > 1:
        return False
    t = table()
    return all(ord(c) not in t or c in LOOK_ALIKES or unicodedata.decomposition(c)[:1] not in ("", "<") for c in token)


def plain_form(token: str) -> str:
    """What becomes of a token that reaches no other spelling: itself if it is clean, else its table form."""
    return token if is_clean(token) else skeleton(token)


#: Capital and small letters of other scripts are compared with these.
_LATIN = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def confusables(spark: SparkSession) -> dict[str, str]:
    """Letters that Unicode's confusables (from ICU, which comes with Spark) give the shape of an ASCII letter of the same case.

    Letters with a decomposition are left to the table. Of two ASCII letters of one shape none is taken.
    """
    checker = spark._jvm.com.ibm.icu.text.SpoofChecker.Builder().build()
    mark = "\u2603"
    shapes = lambda cs: checker.getSkeleton(mark.join(cs)).split(mark)
    latin: dict[tuple[str, bool], str] = {}
    for shape, c in zip(shapes(_LATIN), _LATIN):
        latin[shape, c.isupper()] = "" if (shape, c.isupper()) in latin else c
    others = [c for c in map(chr, range(0x80, 0x10000)) if unicodedata.category(c) in ("Lu", "Ll") and not unicodedata.decomposition(c)]
    found = {c: latin.get((shape, c.isupper())) for shape, c in zip(shapes(others), others)}
    return {c: to for c, to in found.items() if to} | LOOK_ALIKES


def wide_skeleton(token: str, wide: dict[int, str]) -> str:
    """The skeleton with the wider look-alikes folded too."""
    folded = skeleton(token)
    return folded if folded.isascii() else unicodedata.normalize("NFC", unicodedata.normalize("NFD", folded).translate(wide))


class Trie:
    """Clean spellings by their characters; ``fold`` says what a character looks like."""

    def __init__(self, fold=lambda c: table().get(ord(c), c)) -> None:
        self.fold = fold
        # Per node: the first character that a child looks like -> (child, the rest of what it looks like).
        self.next: list[dict[str, list[tuple[int, str]]]] = [{}]
        self.known: list[dict[str, int]] = [{}]
        self.ends: list[tuple[bool, int, str] | None] = [None]

    def add(self, spelling: str, n: int) -> None:
        at = 0
        for c in spelling:
            to = self.known[at].get(c)
            if to is None:
                to = self.known[at][c] = len(self.next)
                self.next.append({})
                self.known.append({})
                self.ends.append(None)
                looks = self.fold(c)
                self.next[at].setdefault(looks[0], []).append((to, looks[1:]))
            at = to
        self.ends[at] = (not spelling.isascii(), -n, spelling)

    def reach(self, token: str, budget: int = 0) -> str | None:
        """The canonical spelling at least cost up to ``budget``.

        States are (node, what is left of its last character) with their cost. A
        look-alike, the letters a character joins and nothing for an ignorable cost 0;
        any substitution, insertion or deletion of a drawn character costs 1.
        """
        states = self._inserted({(0, ""): 0}, budget)
        for c in token:
            for d in self.fold(c):
                step: dict[tuple[int, str], int] = {}
                for (at, rest), cost in states.items():
                    moves = [((at, rest[1:]), cost + (rest[0] != d))] if rest else [(to, cost) for to in self.next[at].get(d, ())]
                    if cost < budget:
                        moves.append(((at, rest), cost + 1))
                        if not rest:
                            moves += [(to, cost + 1) for tos in self.next[at].values() for to in tos]
                    for to, total in moves:
                        if total <= budget and total < step.get(to, budget + 1):
                            step[to] = total
                states = self._inserted(step, budget)
                if not states:
                    return None
        ends = [(cost, self.ends[at]) for (at, rest), cost in states.items() if not rest and self.ends[at]]
        return min(ends)[1][2] if ends else None

    def _inserted(self, states: dict[tuple[int, str], int], budget: int) -> dict[tuple[int, str], int]:
        queue = [x for x in states.items() if x[1] < budget]
        while queue:
            (at, rest), cost = queue.pop()
            for to in [(at, rest[1:])] if rest else [to for tos in self.next[at].values() for to in tos]:
                if cost + 1 < states.get(to, budget + 1):
                    states[to] = cost + 1
                    if cost + 1 < budget:
                        queue.append((to, cost + 1))
        return states


def _tokens(wide: dict[int, str]):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Tokens with a letter, with their widest folding and count in this batch."""
        for pdf in frames:
            counts: Counter[str] = Counter()
            for text in pdf["text"]:
                if text:
                    counts.update(text.split())
            names = [x for x in counts if not x.isascii() or any(map(str.isalpha, x))]
            yield pd.DataFrame({"token": names, "folded": [x if x.isascii() else wide_skeleton(x, wide) for x in names], "n": [counts[x] for x in names], "clean": [is_clean(x) for x in names]})

    return run


def _match(wide: dict[int, str]):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        """Spellings of one bucket: the tries of its clean tokens, traversed by all tokens."""
        near, far = Trie(), Trie(lambda c: "".join(wide.get(ord(d), d) for d in table().get(ord(c), c)))
        for spelling, n in zip(pdf["token"][pdf["clean"]], pdf["n"][pdf["clean"]]):
            near.add(spelling, int(n))
            far.add(spelling, int(n))
        rows = []
        for token, clean in zip(pdf["token"], pdf["clean"]):
            found = near.reach(token)
            if found is None and not clean and len(_scripts(token)) > 1:
                found = far.reach(token)
                found = found and near.reach(found)
            if found is not None and found != plain_form(token):
                rows.append((token, found))
        return pd.DataFrame(rows, columns=["token", "canonical"])

    return run


#: Distinct tokens of one bucket, about.
BUCKET = 20_000


def spellings(docs: DataFrame, text: str = "text") -> DataFrame:
    """(token, canonical): every token of the corpus whose canonical spelling isn't its plain form.

    Of the clean spellings a token reaches, one in ASCII wins, then the most
    frequent, then the smallest; so no spelling in ASCII is ever rewritten.
    Counts cover all texts. Null and empty texts hold no tokens.
    """
    wide = {ord(c): to for c, to in confusables(docs.sparkSession).items()}
    found = cut(
        docs.select(F.col(text).alias("text"))
        .mapInPandas(_tokens(wide), "token string, folded string, n long, clean boolean")
        .groupBy("token", "folded", "clean")
        .agg(F.sum("n").alias("n"))
    )
    # What folds as only ASCII tokens do is its own canonical spelling.
    open_ = found.where(F.col("token").rlike(r"[^\x00-\x7f]")).select("folded").distinct()
    found = cut(found.join(open_, "folded", "left_semi"))
    bucket = F.pmod(F.xxhash64("folded"), F.lit(max(1, -(-found.count() // BUCKET))))
    return found.groupBy(bucket.alias("bucket")).applyInPandas(_match(wide), "token string, canonical string")


def _dirty(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in frames:
        ids, names = [], []
        for i, text in zip(pdf["doc_id"], pdf["text"]):
            if text and not text.isascii():
                for m in {x for x in text.split() if not x.isascii()}:
                    ids.append(i)
                    names.append(m)
        yield pd.DataFrame({"doc_id": ids, "token": names})


def _rewrite(text: str, own: dict[str, str]) -> str:
    return "".join(x if x.isascii() else own.get(x) or plain_form(x) for x in _PARTS.split(text))


_PARTS = re.compile(r"(\S+)")


def _apply(spelled=None):
    """Texts rewritten with all spellings (a broadcast), or with each document's own in ``olds`` and ``news``."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            if spelled is not None:
                owns = [spelled.value] * len(pdf)
            else:
                owns = [{} if a is None else dict(zip(a, b)) for a, b in zip(pdf["olds"], pdf["news"])]
            out = [text if text is None or text.isascii() else _rewrite(text, own) for text, own in zip(pdf["text"], owns)]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "text": pdf["text"], "canonical": out})

    return run


#: Spellings up to which they are broadcast (about 100 bytes each); above, documents are joined with their own.
BROADCAST = 200_000


def canonical_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, canonical): every row of ``docs`` with its text in one form.

    Null stays null and empty stays empty. Tokens that look the same, character by
    character, come out equal: either they reach a clean spelling, then the same, or
    none of them does and the table gives them one form. A document's own
    list of rewritten tokens is bounded by its length.
    """
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = dict(own.dtypes)["doc_id"]
    shape = f"doc_id {kind}, text string, canonical string"
    known = cut(spellings(docs, text))
    if known.count() <= BROADCAST:
        found = docs.sparkSession.sparkContext.broadcast(dict(known.toPandas().itertuples(index=False, name=None)))
        return own.mapInPandas(_apply(found), shape)
    pairs = cut(own.mapInPandas(_dirty, f"doc_id {kind}, token string"))
    listed = even_join(pairs, known, "token").groupBy("doc_id").agg(F.collect_list("token").alias("olds"), F.collect_list("canonical").alias("news"))
    return own.join(listed, "doc_id", "left").select("doc_id", "text", "olds", "news").mapInPandas(_apply(), shape)


#: Documents of one look-alike class that one task pairs up with all others of the class.
SLICE = 1_000


def look_alike_pairs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id_a, doc_id_b): documents stored differently whose non-empty texts look the same, a < b.

    Classes are found from (form, stored text) pairs, so copies shrink before they
    meet; only classes with two or more stored texts are joined, in slices.
    """
    forms = cut(
        canonical_texts(docs, doc_id, text)
        .where(F.col("text").isNotNull() & (F.col("text") != ""))
        .select("doc_id", F.sha2("canonical", 256).alias("form"), F.sha2("text", 256).alias("stored"))
    )
    classes = (
        forms.groupBy("form", "stored").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("form").agg(F.count(F.lit(1)).alias("texts"), F.sum("n").alias("n"))
        .where(F.col("texts") > 1)
        .select("form", F.ceil(F.col("n") / SLICE).cast("int").alias("slices"))
    )
    members = cut(even_join(forms, classes, "form"))
    left = members.select("form", F.pmod(F.xxhash64("doc_id"), F.col("slices")).cast("int").alias("slice"), F.col("doc_id").alias("doc_id_a"), F.col("stored").alias("stored_a"))
    right = members.select("form", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), F.col("doc_id").alias("doc_id_b"), F.col("stored").alias("stored_b"))
    return left.join(right, ["form", "slice"]).where((F.col("doc_id_a") < F.col("doc_id_b")) & (F.col("stored_a") != F.col("stored_b"))).select("doc_id_a", "doc_id_b")
