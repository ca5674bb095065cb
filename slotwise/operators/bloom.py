"""Filtering a lookup too large to broadcast by the keys that will ask for it.

A Bloom filter over the audience's keys is built as a bitmap aggregate: a key
has one block of 32,768 bits (its first hash) and sets ``HASHES`` bits in it, so
every task aggregates its keys into blocks, the blocks are OR-ed, and testing a
lookup row is one join with a block. The filter is broadcast only if its size,
known before it is built, is within the bound; rows that cannot match are then
dropped before the lookup is deduplicated and shuffled. False positives only
cost a shuffled row: the join that follows compares the keys themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BITS = 32_768  # of Spark's bitmap functions
BLOCK_BYTES = BLOCK_BITS // 8
HASHES = 5
BITS_A_KEY = 10  # with 5 hashes about 1 % of other keys pass


def _text(keys: list[str]) -> list[Column]:
    return [F.col(k).cast("string") for k in keys]


def _block(keys: list[str], blocks: int) -> Column:
    return F.pmod(F.xxhash64(*_text(keys)), F.lit(blocks)).cast("int")


def _bits(keys: list[str]) -> list[Column]:
    """Bit positions within the block, by two hashes."""
    h = F.xxhash64(F.lit(1), *_text(keys))
    low, high = h.bitwiseAND(F.lit(0x7FFF)), F.shiftright(h, 20).bitwiseAND(F.lit(0x7FFF)).bitwiseOR(F.lit(1))
    return [F.pmod(low + i * high, F.lit(BLOCK_BITS)) for i in range(HASHES)]


def blocks_for(n_keys: int, max_bytes: int) -> int | None:
    """Blocks of a filter for so many keys; None if it would be above the byte bound."""
    blocks = max(1, -(-n_keys * BITS_A_KEY // BLOCK_BITS))
    return blocks if blocks * BLOCK_BYTES <= max_bytes else None


def key_filter(rows: DataFrame, keys: list[str], blocks: int) -> DataFrame:
    """``block, bits``: the filter over the rows' keys (rows with a null key left out)."""
    some = rows.select(*keys).dropna().select(_block(keys, blocks).alias("block"), F.explode(F.array(*_bits(keys))).alias("bit"))
    return some.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits"))


def may_match(lookup: DataFrame, keys: list[str], key_blocks: DataFrame, blocks: int) -> DataFrame:
    """The lookup's rows whose keys may be in the filter (``blocks`` rows of 4 KB, broadcast)."""
    joined = lookup.withColumn("_block", _block(keys, blocks)).join(F.broadcast(key_blocks.withColumnRenamed("block", "_block")), "_block")

    def is_set(bit: Column) -> Column:
        byte = F.conv(F.hex(F.substring(F.col("bits"), (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        return F.call_function("shiftright", byte, (bit % 8).cast("int")).bitwiseAND(F.lit(1)) == 1

    test = is_set(_bits(keys)[0])
    for b in _bits(keys)[1:]:
        test = test & is_set(b)
    return joined.filter(test).drop("_block", "bits")
