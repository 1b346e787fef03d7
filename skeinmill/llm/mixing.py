"""Mixing sources to target weights on a low-discrepancy schedule.

The mix has total / BLOCK slots. Slot i gets the i-th van der Corput point, which
falls into one source's stretch of the cumulated weights, so that any run of
slots is close to the target shares. Slots are ranked per source, each source's
documents are shuffled and cut into blocks of BLOCK tokens, and slot rank meets
block number; past its last block a source starts over, up to its cap. Ranks
and block borders are running totals over slices, so a source that holds a third
of everything is spread over many tasks.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skeinmill.session import cut

#: Tokens of a block; slots are filled with whole blocks.
BLOCK = 512
#: Place of a public tokenizer's ranks (base64 token and rank a line).
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the split pattern of that tokenizer.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Bits of the van der Corput points: no more slots than two to this.
BITS = 40


@lru_cache(maxsize=2)
def _encoding(ranks: bytes):
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})


#: Characters from which a text is encoded in pieces.
_PIECE = 20_000
#: The tokenizer's pattern never matches across the border between a drawn character and a blank.
_BORDER = re.compile(r"(?<=\S)\s")


def _pieces(text: str) -> Iterator[str]:
    """Pieces of a text that are encoded alone as they are within it."""
    at = 0
    while at < len(text):
        border = _BORDER.search(text, at + _PIECE)
        end = border.start() if border else len(text)
        yield text[at:end]
        at = end


def token_counts(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", tokenizer: str | None = None) -> DataFrame:
    """(doc_id, source, n_tokens) of every document; null and empty texts have 0 tokens.

    The tokenizer's file (under 2 MB) is read once by the driver and broadcast, so
    executors need no file; ``spark.skeinmill.tokenizer`` names another for the session. Very
    long texts are encoded in pieces, cut where the tokenizer splits them itself.
    """
    with open(tokenizer or docs.sparkSession.conf.get("spark.skeinmill.tokenizer", TOKENIZER), "rb") as f:
        ranks = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = _encoding(ranks.value)
        for pdf in frames:
            n = [sum(len(enc.encode_ordinary(p)) for p in _pieces(t)) if t else 0 for t in pdf["text"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "source": pdf["source"], "n_tokens": n})

    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.col(text).alias("text"))
    kinds = dict(own.dtypes)
    return own.mapInPandas(run, f"doc_id {kinds['doc_id']}, source {kinds['source']}, n_tokens long")


def _sliced_totals(df: DataFrame, keys: list[str], slice_: str, order: list[str], weight: str) -> DataFrame:
    """``before`` and ``total`` of each row among its key's rows in order of slice and then ``order``; slices are even by construction."""
    sums = df.groupBy(*keys, slice_).agg(F.sum(weight).alias("_sum"))
    by_key = Window.partitionBy(*keys)
    up_to = lambda w: F.coalesce(F.sum("_sum").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sums.select(*keys, slice_, up_to(by_key.orderBy(slice_)).alias("_offset"), F.sum("_sum").over(by_key).alias("total"))
    inside = Window.partitionBy(*keys, slice_).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.withColumn("_in", F.coalesce(F.sum(weight).over(inside), F.lit(0)))
        .join(offsets, [*keys, slice_])
        .withColumn("before", F.col("_in") + F.col("_offset"))
        .drop("_in", "_offset")
    )


def pieces(counts: DataFrame, block: int = BLOCK, seed: int = 1, rows_per_slice: int = 20_000) -> DataFrame:
    """(source, block, doc_id, token_from, token_to): the documents of each source, shuffled and cut into blocks of ``block`` tokens.

    The order is by a seeded hash of the document's id. A document that crosses a
    border gives a piece to each of its blocks; only a source's last block is
    shorter. Repeated ids are told apart by their length only, and equal rows
    stand beside each other. Documents without tokens give no pieces.
    """
    rows = counts.where(F.col("n_tokens") > 0).withColumn("_h", F.xxhash64("doc_id", F.lit(seed)))
    slices = max(1, -(-rows.count() // rows_per_slice))
    sliced = cut(rows.withColumn("_slice", F.pmod(F.shiftrightunsigned("_h", 20), F.lit(slices))))
    placed = _sliced_totals(sliced, ["source"], "_slice", ["_h", "doc_id", "n_tokens"], "n_tokens")
    begin, end = F.col("before"), F.col("before") + F.col("n_tokens")
    first, last = F.floor(begin / block), F.floor((end - 1) / block)
    return (
        placed.withColumn("block", F.explode(F.sequence(first, last)))
        .select(
            "source", "block", "doc_id",
            (F.greatest(begin, F.col("block") * block) - begin).alias("token_from"),
            (F.least(end, (F.col("block") + 1) * block) - begin).alias("token_to"),
        )
    )


def schedule(targets: DataFrame, n_slots: int, rows_per_slice: int = 20_000) -> DataFrame:
    """(slot, source, rank): which source fills each slot, and the how-manieth of its slots it is (from 0).

    Shares are taken relative to their sum; sources without a positive share get
    no slot. Slots meet sources by cell of the unit interval, not by comparing all.
    """
    spark = targets.sparkSession
    cells = 1024
    # Targets name at most MAX_SOURCES sources, so one window may hold them.
    by_source = Window.orderBy("source")
    part = targets.where(F.col("target_share") > 0).groupBy("source").agg(F.sum("target_share").alias("share"))
    total = part.agg(F.sum("share").alias("whole"))
    upper = F.when(F.lead("source").over(by_source).isNull(), 1.0).otherwise(F.sum("share").over(by_source) / F.col("whole"))
    spans = part.join(F.broadcast(total), how="cross").select("source", upper.alias("high")).withColumn("low", F.lag("high", 1, 0.0).over(by_source))
    spans = spans.withColumn("cell", F.explode(F.sequence(F.floor(F.col("low") * cells), F.floor(F.col("high") * cells))))
    bits = F.lpad(F.conv(F.col("slot").cast("string"), 10, 2), BITS, "0")
    point = F.conv(F.reverse(bits), 2, 10).cast("double") / float(2**BITS)
    slots = spark.range(n_slots).select(F.col("id").alias("slot"), point.alias("point")).withColumn("cell", F.floor(F.col("point") * cells))
    met = slots.join(spans, "cell").where((F.col("point") >= F.col("low")) & (F.col("point") < F.col("high")))
    sliced = cut(met.select("slot", "source", F.floor(F.col("slot") / rows_per_slice).alias("_slice"), F.lit(1).alias("one")))
    return _sliced_totals(sliced, ["source"], "_slice", ["slot"], "one").select("slot", "source", F.col("before").alias("rank"))


#: Sources that targets may name: shares are cumulated in one window. A mix of more is no schedule but a sample.
MAX_SOURCES = 10_000


def checked_targets(targets: DataFrame) -> DataFrame:
    """Targets without null sources and negative shares; an error if they name more than MAX_SOURCES."""
    good = targets.where(F.col("source").isNotNull() & (F.col("target_share") >= 0)).select("source", "target_share", F.coalesce("max_repeats", F.lit(1)).alias("max_repeats"))
    good = good.groupBy("source").agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    n = good.count()
    if n > MAX_SOURCES:
        raise ValueError(f"{n} sources have targets; at most {MAX_SOURCES} may")
    return cut(good)


def mix(docs: DataFrame, targets: DataFrame, total: int | None = None, block: int = BLOCK, seed: int = 1, tokenizer: str | None = None) -> DataFrame:
    """(slot, source, doc_id, repeat, token_from, token_to): the mix, in order of slot.

    ``total`` is the size aimed at, in tokens; without one, the tokens of all
    sources with a target. Tokens token_from (included) to token_to (excluded)
    of a document fill its part of the slot; ``repeat`` is 1 where the source is used
    for the first time, and never above max_repeats. A slot of a source that is
    used up or has no documents stays empty, so the source falls short of its
    share and the others keep theirs of ``total``. Sources without a target and
    null sources are not used. Documents need unique ids; ties in the shuffle
    are broken by id. Empty tables give no rows.
    """
    goal = checked_targets(targets)
    counts = cut(token_counts(docs, tokenizer=tokenizer).join(F.broadcast(goal.select("source")), "source", "left_semi"))
    if total is None:
        total = counts.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("t")).first()["t"]
    parts = cut(pieces(counts, block, seed))
    blocks = parts.groupBy("source").agg((F.max("block") + 1).alias("n_blocks"))
    room = cut(goal.join(blocks, "source").select("source", "n_blocks", "max_repeats"))
    plan = schedule(goal, -(-total // block)).join(F.broadcast(room), "source").where(F.col("rank") < F.col("n_blocks") * F.col("max_repeats"))
    placed = plan.select("slot", "source", (F.col("rank") % F.col("n_blocks")).alias("block"), (F.floor(F.col("rank") / F.col("n_blocks")) + 1).alias("repeat"))
    return placed.join(parts, ["source", "block"]).select("slot", "source", "doc_id", "repeat", "token_from", "token_to")


def shares(mixed: DataFrame, docs_tokens: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_share, share, n_tokens, available, max_repeats, repeats) of every source with a target.

    share is of the tokens in the mix (0 if it is empty); repeats is how often the
    source's most used block is in it.
    """
    got = mixed.groupBy("source").agg(F.sum(F.col("token_to") - F.col("token_from")).alias("n_tokens"), F.max("repeat").alias("repeats"))
    have = docs_tokens.groupBy("source").agg(F.sum("n_tokens").alias("available"))
    total = got.agg(F.sum("n_tokens").alias("total"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return (
        checked_targets(targets).join(got, "source", "left").join(have, "source", "left").join(F.broadcast(total), how="cross")
        .select("source", "target_share", F.coalesce(F.col("n_tokens") / F.col("total"), F.lit(0.0)).alias("share"), zero("n_tokens"), zero("available"), "max_repeats", zero("repeats"))
    )
