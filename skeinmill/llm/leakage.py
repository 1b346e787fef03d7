"""Evaluation texts leaking into training text, found by winnowing.

Texts become words as a reader sees them. Of every window of WINDOW consecutive
GRAM-word hashes the least is a fingerprint; two texts that share a run of
WINDOW + GRAM - 1 words share a whole window and so its fingerprint, which
guarantees every run of SPAN words. A bitmap of the items' fingerprints goes to
where the texts are read; there the fingerprints of each text are met with it, and
only around those that meet, runs of SPAN words are extended and leave as 128-bit
hashes. They are joined with the items' runs: the join gives true pairs only, so
neither a common phrase nor an item quoted by a third of all documents
multiplies candidates, and no text is ever shuffled or read twice.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinmill.llm.glyphs import LOOK_ALIKES, skeleton
from skeinmill.session import cut

#: Words of a run that counts as a leak, and of one hashed gram; the window follows.
SPAN = 12
GRAM = 5
#: Bits of the bitmap for each fingerprint of the items, and its greatest size (32 MB). A fuller
#: bitmap lets more runs pass, which the join on whole runs then drops; the result is the same.
BITS, MOST_BITS = 64, 1 << 28

_BROKEN = re.compile(r"(?<=\w)-[^\S\n]*\n[\s>|*#]*(?=\w)")
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _small_forms() -> dict[int, str]:
    """Capitals drawn like Latin ones are folded to them, so for comparison without case their small letters have to follow."""
    small = {c.casefold(): to.casefold() for c, to in LOOK_ALIKES.items()}
    return {ord(c): to for c, to in small.items() if len(c) == 1}


_SMALL = _small_forms()


def _word(token: str) -> str:
    w = "".join(c for c in token if c.isalnum())
    return w if w.isascii() else unicodedata.normalize("NFC", unicodedata.normalize("NFKC", w).casefold().translate(_SMALL))


def _pieces(text: str) -> list[str]:
    text = skeleton(text)
    if "\n" in text and "-" in text:
        text = _BROKEN.sub("", text)
    return text.casefold().split()


def words(text: str) -> list[str]:
    """Words as a reader sees them: without case, punctuation, quoting, emphasis, layout, invisible and look-alike characters.

    A word broken by a hyphen at a line end is one word, as is one with a hyphen
    or an apostrophe inside. Marks between blanks are no words.
    """
    return [w for w in map(_word, _pieces(text)) if w]


class _Codes(dict):
    """Hash of each piece of text; 0 for one that is no word. Emptied when it grows too large."""

    MOST = 500_000

    def __missing__(self, piece: str) -> int:
        if len(self) >= self.MOST:
            self.clear()
        w = _word(piece)
        self[piece] = code = (xxhash.xxh64_intdigest(w) or 1) if w else 0
        return code


_codes = _Codes()


def _batch(texts: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """The words of all texts as codes, and the position of the text of each."""
    found, at = [], []
    for k, text in enumerate(texts):
        if text:
            codes = np.array([_codes[p] for p in _pieces(text)], dtype=np.uint64)
            codes = codes[codes != 0]
            found.append(codes)
            at.append(np.full(len(codes), k, dtype=np.int64))
    return (np.concatenate(found), np.concatenate(at)) if found else (np.empty(0, np.uint64), np.empty(0, np.int64))


def _hashed(codes: np.ndarray, starts: np.ndarray | None, k: int, base: np.uint64) -> np.ndarray:
    """Hashes of the runs of ``k`` codes from ``starts``, or of all."""
    n = len(codes) - k + 1
    h = np.zeros(n if starts is None else len(starts), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            h = h * base + (codes[j : j + n] if starts is None else codes[starts + j])
        h ^= h >> np.uint64(31)
        h = h * _M2
        h ^= h >> np.uint64(29)
    return h


#: Windows that are compared at once (8 bytes for each gram of one).
_ROWS = 500_000


def _whole(codes: np.ndarray, at: np.ndarray, span: int) -> np.ndarray:
    """Starts of the runs of ``span`` words that lie in one text."""
    n = len(codes) - span + 1
    return np.flatnonzero(at[:n] == at[span - 1 :]) if n > 0 else np.empty(0, dtype=np.int64)


def _picked(codes: np.ndarray, starts: np.ndarray, span: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the fingerprints of the windows at ``starts``."""
    if not len(starts):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    h = _hashed(codes, None, gram, _M1)
    windows = np.lib.stride_tricks.sliding_window_view(h, span - gram + 1)
    least = [windows[part].argmin(axis=1) + part for part in (starts[i : i + _ROWS] for i in range(0, len(starts), _ROWS))]
    at = np.unique(np.concatenate(least))
    return at, h[at]


def _prints(span: int, gram: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            codes, at = _batch(pdf["text"])
            yield pd.DataFrame({"print": np.unique(_picked(codes, _whole(codes, at, span), span, gram)[1]).view(np.int64)})

    return run


def _runs(span: int, gram: int, bitmap=None):
    """Hashes of the runs of ``span`` words: those around a fingerprint in ``bitmap`` (a broadcast), or all."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            codes, at = _batch(pdf["text"])
            starts = _whole(codes, at, span)
            if bitmap is not None and len(starts):
                positions, prints = _picked(codes, starts, span, gram)
                bits = bitmap.value
                spot = prints & np.uint64(len(bits) * 64 - 1)
                hit = positions[(bits[spot >> np.uint64(6)] >> (spot & np.uint64(63))) & np.uint64(1) == 1]
                around = np.unique((hit[:, None] - np.arange(span - gram + 1)[None, :]).ravel())
                around = around[(around >= 0) & (around + span <= len(codes))]
                starts = around[at[around] == at[around + span - 1]]
            if len(starts):
                ids = pdf["id"].to_numpy()[at[starts]]
                out = pd.DataFrame({"id": ids, "h1": _hashed(codes, starts, span, _M1).view(np.int64), "h2": _hashed(codes, starts, span, _M2).view(np.int64)})
                yield out.drop_duplicates()

    return run


def _bitmap(prints: DataFrame) -> np.ndarray:
    """Words of a bitmap with the last bits of every print set; of a size that follows the count up to MOST_BITS."""
    n = prints.count()
    bits = min(MOST_BITS, 1 << max(10, (BITS * max(n, 1) - 1).bit_length()))
    spot = F.col("print").bitwiseAND(F.lit(bits - 1))
    word = F.shiftright(spot, 6).cast("int")
    rows = prints.groupBy(word.alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast((print & {bits - 1}L) & 63 AS INT))")).alias("bits")).toPandas()
    out = np.zeros(bits // 64, dtype=np.int64)
    out[rows["word"].to_numpy(dtype=np.int64)] = rows["bits"].to_numpy(dtype=np.int64)
    return out.view(np.uint64)


def leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """(doc_id, item_id, n_runs): every document and item that share ``span`` consecutive words, and how many such runs.

    n_runs counts the different runs of exactly ``span`` words they share. Null,
    empty and shorter texts share nothing; documents and items that are exact
    copies are reported each. Ids have to be BIGINT. Whole texts are read, once.
    """
    d = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    t = items.select(F.col(item_id).alias("id"), F.col(text).alias("text"))
    wanted = cut(t.mapInPandas(_prints(span, gram), "print long").distinct())
    bitmap = docs.sparkSession.sparkContext.broadcast(_bitmap(wanted))
    runs = "id long, h1 long, h2 long"
    here = d.mapInPandas(_runs(span, gram, bitmap), runs)
    there = t.mapInPandas(_runs(span, gram), runs).select(F.col("id").alias("item"), "h1", "h2").distinct()
    return (
        here.join(there, ["h1", "h2"])
        .select("id", "item", "h1", "h2")
        .distinct()
        .groupBy(F.col("id").alias(doc_id), F.col("item").alias(item_id))
        .agg(F.count(F.lit(1)).alias("n_runs"))
    )


def leaked_items(found: DataFrame, item_id: str = "item_id") -> DataFrame:
    """(item_id, n_docs): in how many documents each leaked item stands."""
    return found.groupBy(item_id).agg(F.count(F.lit(1)).alias("n_docs"))
