"""A blocked Bloom filter as a small table, with built-in functions only.

A key sets one bit in each of the eight 64-bit words of one block.  A filter
has at most ``MAX_BLOCKS`` blocks (2 MiB of bits), however many keys it holds:
that is the proven bound under which it is broadcast.  More keys only let more
strangers pass, so it is always followed by an exact join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BLOCKS = 1 << 15
WORDS_PER_BLOCK = 8
BITS_PER_KEY = 16


def _columns(key: Column, blocks: int) -> list[Column]:
    """Block number and one 64-bit mask per word of the block."""
    out = [F.pmod(F.xxhash64(key), F.lit(blocks)).alias("_block")]
    for i in range(WORDS_PER_BLOCK):
        bit = F.xxhash64(key, F.lit(i)).bitwiseAND(F.lit(63)).cast("int")
        out.append(F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias(f"_m{i}"))
    return out


def build(members: DataFrame, key: str, n_keys: int) -> tuple[DataFrame, int]:
    """One row per non-empty block, and the number of blocks."""
    need = -(-max(1, n_keys) * BITS_PER_KEY // (64 * WORDS_PER_BLOCK))
    blocks = min(MAX_BLOCKS, need)
    words = [F.bit_or(f"_m{i}").alias(f"_f{i}") for i in range(WORDS_PER_BLOCK)]
    bits = members.select(*_columns(F.col(key), blocks)).groupBy("_block").agg(*words)
    return bits.withColumnRenamed("_block", "_fblock"), blocks


def possible(df: DataFrame, key: str, bits: DataFrame, blocks: int) -> DataFrame:
    """Rows of ``df`` whose ``key`` may be a member; no member is lost."""
    probe = df.select("*", *_columns(F.col(key), blocks))
    passed = F.col("_block") == F.col("_fblock")
    for i in range(WORDS_PER_BLOCK):
        passed = passed & (F.col(f"_f{i}").bitwiseAND(F.col(f"_m{i}")) == F.col(f"_m{i}"))
    return probe.join(F.broadcast(bits), passed).select(*df.columns)
