"""Bloom filters over keys, as rows: which documents are certainly in no ledger.

A filter is cut into blocks of ``BITS`` bits. A key falls into one block and sets ``PROBES`` bits there, so that one
broadcast join on the block number and some bit tests decide, all inside Spark's own expressions. Rows
``block, word, bits`` of any number of filters of one size are or-ed into one: each version of a ledger keeps only
its own.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from docledger.schemas import KEYS

#: 64 words of 64 bits; five slices of 12 bits of a hash name the bits of a key.
BITS, WORDS, PROBES, SLICE = 4_096, 64, 5, 12
BITS_PER_KEY = 10
#: Blocks of the largest filter that is broadcast: 512 bytes each, and what a row takes besides.
MOST_BLOCKS = 56_000

ROWS = "block int, word int, bits bigint"


def blocks_for(keys: int) -> int:
    """Blocks for a number of keys; beyond what may be broadcast the filter gets less sharp, never wrong."""
    return min(MOST_BLOCKS, max(1, -(-keys * BITS_PER_KEY // BITS)))


def _block(keys: Sequence[str], blocks: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(blocks)).cast("int")


def _probes(keys: Sequence[str]) -> list[Column]:
    """Positions of a key's bits inside its block."""
    h = F.xxhash64(F.lit(7), *keys)
    return [F.shiftrightunsigned(h, i * SLICE).bitwiseAND(BITS - 1).cast("int") for i in range(PROBES)]


def filter_rows(known: DataFrame, blocks: int, keys: Sequence[str] = KEYS) -> DataFrame:
    """The filter of the keys; setting bits is a partial aggregate, so that little is shuffled."""
    bit = known.select(_block(keys, blocks).alias("block"), F.explode(F.array(*_probes(keys))).alias("bit"))
    return bit.groupBy("block", F.shiftright("bit", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, bit & 63)")).alias("bits"))


def dense(rows: DataFrame) -> DataFrame:
    """``block, words``: filters of one size or-ed into one that ``maybe_known`` can read."""
    words = rows.groupBy("block", "word").agg(F.bit_or("bits").alias("bits"))
    held = F.map_from_entries(F.collect_list(F.struct("word", "bits")))
    return words.groupBy("block").agg(held.alias("held")).select(
        "block", F.transform(F.sequence(F.lit(0), F.lit(WORDS - 1)),
                             lambda w: F.coalesce(F.try_element_at("held", w), F.lit(0).cast("bigint"))).alias("words"))


def maybe_known(df: DataFrame, seen: DataFrame, blocks: int, keys: Sequence[str] = KEYS) -> DataFrame:
    """Add ``_maybe``: false where the key is certainly not in the filter."""
    tests = [F.getbit(F.element_at("_words", F.shiftright(p, 6) + 1), p.bitwiseAND(63)) == 1 for p in _probes(keys)]
    named = F.broadcast(seen.select(F.col("block").alias("_block"), F.col("words").alias("_words")))
    joined = df.withColumn("_at", _block(keys, blocks)).join(named, F.col("_at") == F.col("_block"), "left")
    maybe = F.col("_words").isNotNull() & reduce(lambda a, b: a & b, tests)
    return joined.withColumn("_maybe", maybe).select(*df.columns, "_maybe")
