"""Packed token rows: best-fit-decreasing with a segment tree.

Documents are encoded, documents longer than a row are split losslessly, and
the pieces of one shard are packed, longest first, each into the row with the
least room that still fits. A segment tree over the capacities finds that row in
logarithmic time. Every packed row carries its id matrix row, the cumulative
lengths of its segments and positions that restart at every segment.

Shards are runs of rows inside a partition, closed at ``SHARD_TOKENS`` tokens,
so packing needs no shuffle and no task holds more than one shard.

Defined cases: null and empty texts have no tokens and no segment; repeated rows
and null ids are packed like others; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotwise.llm.common import map_arrow, table, vocabulary

RANKS = "byte_bpe_50k.tiktoken"
LENGTH = 2048
PAD = 50256  # free in the rank file
SHARD_TOKENS = 2_000_000


class CapacityTree:
    """Counts of open rows by free room; the smallest room >= need in O(log length)."""

    def __init__(self, length: int):
        self.size = 1 << (length + 1).bit_length()
        self.tree = [0] * (2 * self.size)

    def add(self, room: int, change: int) -> None:
        i = room + self.size
        while i:
            self.tree[i] += change
            i >>= 1

    def best(self, need: int) -> int:
        """Smallest room >= need of an open row, or -1."""
        i, tree = need + self.size, self.tree
        if tree[i]:
            return need
        while i > 1:  # climb until a right sibling holds a row
            if not i & 1 and tree[i + 1]:
                i += 1
                break
            i >>= 1
        else:
            return -1
        while i < self.size:
            i = 2 * i if tree[2 * i] else 2 * i + 1
        return i - self.size


def pack(lengths: list[int], length: int = LENGTH) -> list[list[int]]:
    """Rows as lists of piece numbers; pieces of 1..length tokens, best fit decreasing."""
    tree, rows, open_ = CapacityTree(length), [], [[] for _ in range(length + 1)]
    for k in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        n = lengths[k]
        room = tree.best(n)
        if room < 0:
            row, room = len(rows), length
            rows.append([])
        else:
            row = open_[room].pop()
            tree.add(room, -1)
        rows[row].append(k)
        if room > n:
            open_[room - n].append(row)
            tree.add(room - n, 1)
    return rows


@lru_cache(maxsize=2)
def _encoder(path: str):
    import base64

    import tiktoken
    from public_tokenizers import PATTERN

    with open(vocabulary(path), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, pad: int = PAD, path: str = RANKS) -> DataFrame:
    """One row per packed row: ``shard, row, input_ids, n_tokens, cu_seqlens,
    position_ids, doc_ids, doc_starts``.

    ``input_ids`` and ``position_ids`` have ``length`` entries (padding: ``pad``
    and 0); ``cu_seqlens`` runs from 0 to ``n_tokens``; ``doc_ids`` and
    ``doc_starts`` name each segment's document and its first token there, from
    which :func:`unpacked` restores every document.
    """
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.spark_partition_id().alias("part"))
    kind = d.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(path).encode_ordinary
        ids, starts, parts, tokens, number = [], [], [], 0, 0

        def flush(part: int) -> Iterator[pa.RecordBatch]:
            nonlocal ids, starts, parts, tokens, number
            rows = pack([len(p) for p in parts], length)
            for s in range(0, len(rows), 256):
                some = rows[s : s + 256]
                x = np.full((len(some), length), pad, np.int32)
                pos = np.zeros((len(some), length), np.int16 if length <= 32768 else np.int32)
                cu = []
                for r, row in enumerate(some):
                    ends = np.cumsum([0, *(len(parts[k]) for k in row)])
                    for a, k in zip(ends, row):
                        x[r, a : a + len(parts[k])] = parts[k]
                        pos[r, a : a + len(parts[k])] = np.arange(len(parts[k]))
                    cu.append(ends.tolist())
                offsets = pa.array(np.arange(len(some) + 1, dtype=np.int32) * length)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([f"{part}-{number}"] * len(some)),
                        pa.array(np.arange(s, s + len(some), dtype=np.int32)),
                        pa.ListArray.from_arrays(offsets, pa.array(x.ravel())),
                        pa.array([c[-1] for c in cu], pa.int32()),
                        pa.array(cu, pa.list_(pa.int32())),
                        pa.ListArray.from_arrays(offsets, pa.array(pos.ravel())),
                        pa.array([[ids[k] for k in row] for row in some], pa.list_(id_type)),
                        pa.array([[starts[k] for k in row] for row in some], pa.list_(pa.int64())),
                    ],
                    names=["shard", "row", "input_ids", "n_tokens", "cu_seqlens", "position_ids", "doc_ids", "doc_starts"],
                )
            ids, starts, parts, tokens, number = [], [], [], 0, number + 1

        part, id_type = 0, None
        for batch in batches:
            id_type = batch.schema.field(0).type
            part = batch.column(2)[0].as_py() if len(batch) else part
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                t = np.array(encode(text or ""), np.int32)
                for s in range(0, len(t), length):
                    ids.append(i)
                    starts.append(s)
                    parts.append(t[s : s + length])
                tokens += len(t)
                if tokens >= SHARD_TOKENS:
                    yield from flush(part)
        if parts:
            yield from flush(part)

    many = T.ArrayType
    position = T.ShortType() if length <= 32768 else T.IntegerType()
    schema = T.StructType(
        [
            T.StructField("shard", T.StringType()),
            T.StructField("row", T.IntegerType()),
            T.StructField("input_ids", many(T.IntegerType())),
            T.StructField("n_tokens", T.IntegerType()),
            T.StructField("cu_seqlens", many(T.IntegerType())),
            T.StructField("position_ids", many(position)),
            T.StructField("doc_ids", many(kind)),
            T.StructField("doc_starts", many(T.LongType())),
        ]
    )
    return map_arrow(d, run, schema)


def unpacked(packed: DataFrame) -> DataFrame:
    """``doc_id, tokens`` restored from packed rows (ids must be unique)."""
    seg = packed.select("input_ids", "cu_seqlens", F.posexplode(F.arrays_zip("doc_ids", "doc_starts")).alias("k", "s"))
    a, b = F.get("cu_seqlens", F.col("k")), F.get("cu_seqlens", F.col("k") + 1)
    seg = seg.select(F.col("s.doc_ids").alias("doc_id"), F.col("s.doc_starts").alias("at"), F.slice("input_ids", a + 1, b - a).alias("t"))
    parts = seg.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("at", "t"))).alias("p"))
    return parts.select("doc_id", F.flatten(F.transform("p", lambda x: x["t"])).alias("tokens"))


def op8_pack_token_rows(spark, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
