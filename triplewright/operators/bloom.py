"""Bloom filters as plain rows: a fixed-size broadcast that spares most rows of a join their shuffle.

A filter is a table of blocks of 512 bits, one row each. A key belongs to one block and sets one
bit in each of its eight words, so blocks are built by ``bit_or`` with partial aggregation
and are looked up by one broadcast hash join. A key that is not in the filter is certainly
not in the list; the others still need the real join.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_WORDS = [f"__w{i}" for i in range(8)]
_BLOCK = "__block"
_BLOCK_BITS = 512
# Bits a key at which about one in two hundred other keys passes.
BITS_PER_KEY = 12
# Largest filter: 32 MB of bits, 28 million keys at full strength.
MAX_BLOCKS = 1 << 19
# With fewer bits a key nearly all keys pass.
MIN_BITS_PER_KEY = 3


def n_blocks(n_keys: int) -> int | None:
    """Blocks for so many keys, a power of two; None where the largest filter is too small to help."""
    if n_keys * MIN_BITS_PER_KEY > MAX_BLOCKS * _BLOCK_BITS:
        return None
    wanted = max(1, math.ceil(n_keys * BITS_PER_KEY / _BLOCK_BITS))
    return min(MAX_BLOCKS, 1 << (wanted - 1).bit_length())


def _block(on: list[str], blocks: int) -> Column:
    return F.pmod(F.xxhash64(*on, F.lit(1)), F.lit(blocks)).cast("int")


def _bits(on: list[str]) -> list[Column]:
    """The bit of a key in each word, from six bits of its hash each."""
    h = F.xxhash64(*on)
    places = [F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63).cast("long")).cast("int") for i in range(len(_WORDS))]
    return [F.call_function("shiftleft", F.lit(1).cast("long"), place) for place in places]


def bloom_filter(keys: DataFrame, on: list[str], blocks: int) -> DataFrame:
    """The non-empty blocks of a filter for the keys."""
    words = [F.bit_or(bit).alias(word) for bit, word in zip(_bits(on), _WORDS)]
    return keys.groupBy(_block(on, blocks).alias(_BLOCK)).agg(*words)


def split_by_filter(df: DataFrame, on: list[str], filter_rows: DataFrame, blocks: int) -> tuple[DataFrame, DataFrame]:
    """Rows whose key may be in the list, and rows whose key certainly isn't."""
    looked_up = df.withColumn(_BLOCK, _block(on, blocks)).join(F.broadcast(filter_rows), _BLOCK, "left")
    passes = reduce(Column.__and__, [F.coalesce(F.col(word).bitwiseAND(bit) != 0, F.lit(False)) for bit, word in zip(_bits(on), _WORDS)])
    return looked_up.filter(passes).select(*df.columns), looked_up.filter(~passes).select(*df.columns)
