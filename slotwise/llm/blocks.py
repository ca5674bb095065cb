"""Comparing the rows of a bucket inside tasks, in blocks of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS = 20_000  # rows a task works on at once, about


def tiled(df: DataFrame, key: list[str], size: str, by: str, tile: int) -> DataFrame:
    """Rows with a ``block`` id.

    A bucket of up to ``tile`` rows is one block. A larger one is cut into k
    tiles by the hash of ``by``, and every pair of tiles is a block of its own:
    ``left`` tells the two sides apart, ``own`` marks a tile's block with itself.
    """
    df = df.withColumn("_k", F.ceil(F.col(size) / tile).cast("int")).withColumn("_i", F.pmod(F.xxhash64(by), F.col("_k")).cast("int"))
    other = F.transform(F.sequence(F.lit(0), F.col("_k") - 1), lambda j: F.struct(F.least(j, F.col("_i")).alias("i"), F.greatest(j, F.col("_i")).alias("j")))
    df = df.withColumn("_t", F.explode(other)).withColumns(
        {"block": F.xxhash64(*key, "_t"), "left": F.col("_i") == F.col("_t.i"), "own": F.col("_t.i") == F.col("_t.j")}
    )
    return df.drop("_k", "_i", "_t")


def dealt(df: DataFrame, key: list[str], size: str, by: str, tile: int) -> DataFrame:
    """``tiled`` rows, block by block within partitions."""
    return by_block(tiled(df, key, size, by, tile))


def by_block(df: DataFrame) -> DataFrame:
    return df.repartition("block").sortWithinPartitions("block")


def neighbours(block: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of positions with the same value of a sorted array, by distance."""
    lag, at = 1, np.arange(len(block))
    while True:
        at = at[at + lag < len(block)]
        at = at[block[at] == block[at + lag]]
        if not len(at):
            return
        yield at, at + lag
        lag += 1


def in_blocks(work: Callable[[pa.Table], pa.RecordBatch], rows: int = ROWS) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``work`` on runs of whole blocks of a task's rows sorted by ``block``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0
        for b in batches:
            held.append(b)
            n += len(b)
            if n < rows:
                continue
            t = pa.Table.from_batches(held)
            block = t["block"].to_numpy()
            other = np.flatnonzero(block != block[-1])
            if len(other):
                cut = int(other[-1]) + 1
                yield work(t.slice(0, cut))
                held = t.slice(cut).to_batches()
                n = len(t) - cut
        if held:
            yield work(pa.Table.from_batches(held))

    return run
