"""Byte-level BPE encoding and decoding by recursive queries inside the tasks.

A text is cut by the tokenizer's pattern; each task encodes the distinct
pre-tokens it meets with an in-process DuckDB: token-position rows join the
merge table, a word's leftmost pair of the smallest rank is contracted, and the
query recurses on the changed words until no pair of any word merges. Decoding
joins ids with the token table and aggregates the bytes in the order of their
positions. Documents are spread and kept apart by Spark; a worker's database
holds the vocabulary and one bounded group of words or ids.

Words of more than ``SHORT`` bytes contract all occurrences of their smallest
pair at once (leftmost first among overlapping ones), which gives the same
result wherever no pair formed by that token ranks below it; the merge table
says so pair by pair, and other pairs contract one occurrence at a time. A
query recurses over ``ROWS`` rows at most; what is unfinished then goes into
the next one, so memory is bounded for a word of any length.

Defined cases: a null or empty text has no ids and decodes to no bytes; a
pre-token that is a token is that token, as in the library; special tokens'
strings are plain text; ids outside the vocabulary raise ValueError when
decoded; rows are independent, so repeated rows and null ids give a row each;
other columns are kept by the general operators, whose new columns replace
columns of the same name.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotwise.llm.common import map_arrow, table, vocabulary
from slotwise.llm.prefix_coder import Memo
from slotwise.llm.prefix_tokens import COMMON_PATTERN, grouped, split_common

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
SHORT = 48  # bytes of a word that contracts one pair a round
KEEP = 64  # longer pre-tokens are computed each time
CACHE = 400_000  # distinct pre-tokens per generation of a worker's memo
WORDS = 10_000  # words encoded by one query
ROWS = 4_000_000  # rows a recursion may pile up
GROUP_CHARS = 1_500_000  # characters of text handled at once

# A word's last round is its result; words that still merge at the last allowed round go on in the next query.
_END = """))
SELECT w, p, id, step >= $rounds AS unfinished FROM t JOIN (SELECT w, max(step) AS step FROM t GROUP BY w) USING (w, step) ORDER BY w, p"""
# A row knows where its right neighbour is (q). merged << 32 | p: the smallest rank first, then the leftmost.
ONE_A_ROUND = (
    """WITH RECURSIVE t(w, p, q, id, step) AS (SELECT w, p, p + 1, id, 0 FROM base UNION ALL (
WITH best AS (SELECT a.w, min(merged::BIGINT << 32 | a.p) AS k,
  arg_min(b.p, merged::BIGINT << 32 | a.p) AS gone, arg_min(b.q, merged::BIGINT << 32 | a.p) AS beyond
  FROM t a JOIN t b ON b.w = a.w AND b.p = a.q JOIN merges m ON m.pair = (a.id::BIGINT << 32 | b.id) WHERE a.step < $rounds GROUP BY a.w)
SELECT t.w, t.p, CASE WHEN t.p = k & 4294967295 THEN beyond ELSE t.q END,
  CASE WHEN t.p = k & 4294967295 THEN (k >> 32)::INTEGER ELSE t.id END, t.step + 1
FROM t JOIN best USING (w) WHERE t.p <> gone"""
    + _END
)
# Overlapping occurrences follow each other without a gap: every second one of such a run contracts, from its first.
ALL_A_ROUND = (
    """WITH RECURSIVE t(w, p, id, step) AS (SELECT w, p, id, 0 FROM base UNION ALL (
WITH x AS (SELECT *, lead(id) OVER o AS right_id, lead(p) OVER o AS next_p FROM t WHERE step < $rounds WINDOW o AS (PARTITION BY w ORDER BY p)),
hit AS (SELECT w, p, next_p, merged, many FROM x JOIN merges m ON m.pair = (x.id::BIGINT << 32 | x.right_id)),
best AS (SELECT w, min(merged) AS merged, min(merged::BIGINT << 32 | p) & 4294967295 AS first_p FROM hit GROUP BY w),
same AS (SELECT h.w, h.p, h.next_p, h.merged, lag(h.next_p) OVER (PARTITION BY h.w ORDER BY h.p) IS DISTINCT FROM h.p AS starts
         FROM hit h JOIN best b ON h.w = b.w AND h.merged = b.merged WHERE h.many OR h.p = b.first_p),
run AS (SELECT *, sum(starts::INTEGER) OVER (PARTITION BY w ORDER BY p) AS r FROM same),
cut AS (SELECT w, p, next_p, merged FROM (SELECT *, row_number() OVER (PARTITION BY w, r ORDER BY p) AS k FROM run) WHERE k % 2 = 1)
SELECT t.w, t.p, coalesce(c.merged, t.id), t.step + 1
FROM t SEMI JOIN best USING (w) LEFT JOIN cut c ON c.w = t.w AND c.p = t.p ANTI JOIN cut g ON g.w = t.w AND g.next_p = t.p"""
    + _END
)
DECODE = "SELECT d, string_agg(token, '' ORDER BY p) AS bytes FROM ids JOIN tokens USING (id) GROUP BY d"


class ByteCodec:
    def __init__(self, path: str = VOCABULARY, pattern: str | None = None):
        import duckdb
        import regex

        if pattern is None:
            from public_tokenizers import PATTERN as pattern  # noqa: N811
        self.pattern = regex.compile(pattern).findall
        # the pattern that prefix_tokens has a faster form of, for texts of common characters
        self.common = pattern == COMMON_PATTERN
        with open(vocabulary(path), "rb") as f:
            self.rank = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
        self.single = np.array([self.rank[bytes([b])] for b in range(256)], np.int32)
        self.whole = {t: np.int32(r).tobytes() for t, r in self.rank.items()}
        self.words = Memo(CACHE)
        # No file of its own: what a query may hold is bounded by WORDS, ROWS and GROUP_CHARS.
        self.db = duckdb.connect(config={"threads": 1, "temp_directory": "", "memory_limit": "1GB"})
        self._fill()

    def split(self, text: str) -> list[str]:
        found = split_common(text) if self.common else None
        return self.pattern(text) if found is None else found

    def _fill(self) -> None:
        left, right, merged = [], [], []
        for t, r in self.rank.items():
            for k in range(1, len(t)):
                a, b = self.rank.get(t[:k]), self.rank.get(t[k:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(r)
        pairs = pa.table({"left_id": pa.array(left, pa.int32()), "right_id": pa.array(right, pa.int32()), "merged": pa.array(merged, pa.int32())})
        tokens = pa.table({"id": pa.array(list(self.rank.values()), pa.int32()), "token": [t.hex() for t in self.rank]})
        self.db.register("_pairs", pairs)
        self.db.execute("""
            CREATE TABLE merges AS
            WITH low AS (SELECT id, min(merged) AS low FROM (SELECT left_id AS id, merged FROM _pairs UNION ALL SELECT right_id, merged FROM _pairs) GROUP BY id)
            SELECT left_id::BIGINT << 32 | right_id AS pair, merged, coalesce(low > merged, true) AS many FROM _pairs p LEFT JOIN low ON low.id = p.merged""")
        self.db.unregister("_pairs")
        self.db.register("_tokens", tokens)
        self.db.execute("CREATE TABLE tokens AS SELECT * FROM _tokens")
        self.db.unregister("_tokens")

    def _query(self, sql: str, **values) -> dict[str, np.ndarray]:
        return self.db.execute(sql, values or None).fetchnumpy()

    def contract(self, words: list[bytes], sql: str = ONE_A_ROUND) -> list[bytes]:
        """Ids (int32, native order) of each word."""
        w = np.repeat(np.arange(len(words), dtype=np.int32), np.fromiter(map(len, words), np.int64, len(words)))
        ids = self.single[np.frombuffer(b"".join(words), np.uint8)]
        out: list[bytes] = [b""] * len(words)
        while len(w):
            starts = np.flatnonzero(np.append(True, w[1:] != w[:-1]))
            p = np.arange(len(w)) - np.repeat(starts, np.diff(np.append(starts, len(w))))
            self.db.register("base", pa.table({"w": w, "p": p, "id": ids}))
            r = self._query(sql, rounds=max(1, ROWS // len(w)))
            self.db.unregister("base")
            w, ids, open_ = r["w"], r["id"].astype(np.int32), r["unfinished"].astype(bool)
            cuts = np.flatnonzero(np.diff(w)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(w)]):
                if not open_[a]:
                    out[w[a]] = ids[a:b].tobytes()
            w, ids = w[open_].astype(np.int32), ids[open_]
        return out

    def learn(self, words: set[str]) -> list[str]:
        """Remember the ids of the words; returns the long ones, to be forgotten after use."""
        new = self.words.missing(words)
        todo: list[tuple[str, bytes]] = []
        for w in new:
            b = w.encode("utf-8")
            if (known := self.whole.get(b)) is not None:
                self.words.now[w] = known
            else:
                todo.append((w, b))
        todo.sort(key=lambda x: len(x[1]))
        short = next((k for k, x in enumerate(todo) if len(x[1]) > SHORT), len(todo))
        for part, sql in ((todo[:short], ONE_A_ROUND), (todo[short:], ALL_A_ROUND)):
            for s in range(0, len(part), WORDS):
                some = part[s : s + WORDS]
                self.words.now.update(zip((w for w, _ in some), self.contract([b for _, b in some], sql)))
        return [w for w in new if len(w) > KEEP]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        split = [self.split(t) for t in texts]
        long = self.learn(set().union(*split))
        get = self.words.now.__getitem__
        out = [np.frombuffer(b"".join(map(get, s)), np.int32) for s in split]
        for w in long:
            del self.words.now[w]
        return out

    def decode(self, ids: list[np.ndarray]) -> list[bytes]:
        """The bytes of each id sequence, by one ordered aggregation."""
        length = np.fromiter(map(len, ids), np.int64, len(ids))
        n = int(length.sum())
        out = [b""] * len(ids)
        if not n:
            return out
        flat = np.concatenate(ids).astype(np.int32)
        rows = pa.table({"d": np.repeat(np.arange(len(ids), dtype=np.int32), length), "p": np.arange(n, dtype=np.int64), "id": flat})
        self.db.register("ids", rows)
        unknown = self.db.execute("SELECT count(*) FROM ids ANTI JOIN tokens USING (id)").fetchall()[0][0]
        if unknown:
            self.db.unregister("ids")
            raise ValueError(f"{unknown} ids are not in the vocabulary")
        found = self.db.execute(DECODE).fetchall()
        self.db.unregister("ids")
        for d, text in found:
            out[d] = bytes.fromhex(text)
        return out


@lru_cache(maxsize=2)
def _codec(path: str) -> ByteCodec:
    return ByteCodec(path)


def _coded(texts: Iterator[str], path: str) -> Iterator[tuple[list[np.ndarray], list[bytes]]]:
    """Ids and decoded bytes of bounded groups of the texts, in order."""
    codec = _codec(path)
    for group in grouped(texts, GROUP_CHARS):
        ids = codec.encode(group)
        yield ids, codec.decode(ids)


def _lists(ids: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))


def _others(df: DataFrame, new: list[str]) -> tuple[DataFrame, list[str]]:
    cols = [c for c in df.columns if c not in new]
    return df.select(*[F.col(f"`{c}`") for c in cols]), cols


def encode_bytes(df: DataFrame, text_col: str = "text", ids_col: str = "token_ids", path: str = VOCABULARY) -> DataFrame:
    """``df`` with the ids of ``text_col`` added (or replaced) as ``array<int>``; a map without shuffle."""
    out, cols = _others(df, [ids_col])
    at = cols.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path)
        for batch in batches:
            done = 0
            for group in grouped((t.as_py() or "" for t in batch.column(at)), GROUP_CHARS):
                yield pa.RecordBatch.from_arrays([*batch.slice(done, len(group)).columns, _lists(codec.encode(group))], names=[*cols, ids_col])
                done += len(group)

    return map_arrow(out, run, T.StructType([*out.schema.fields, T.StructField(ids_col, T.ArrayType(T.IntegerType()))]))


def decode_bytes(df: DataFrame, ids_col: str = "token_ids", decoded_col: str = "decoded", path: str = VOCABULARY) -> DataFrame:
    """``df`` with the bytes of ``ids_col`` added (or replaced) as ``binary``; a null list decodes to no bytes."""
    out, cols = _others(df, [decoded_col])
    at = cols.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path)
        for batch in batches:
            for s in range(0, len(batch), 500):
                part = batch.slice(s, 500)
                found = codec.decode([np.array(x.as_py() or [], np.int32) for x in part.column(at)])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.binary())], names=[*cols, decoded_col])

    return map_arrow(out, run, T.StructType([*out.schema.fields, T.StructField(decoded_col, T.BinaryType())]))


def round_trip_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = VOCABULARY) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` per input row: ids and decoded bytes in one pass, as digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for ids, decoded in _coded((t.as_py() or "" for t in batch.column(1)), path):
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(done, len(ids)),
                        pa.array([len(x) for x in ids], pa.int64()),
                        pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids]),
                        pa.array([hashlib.sha256(x).hexdigest() for x in decoded]),
                    ],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )
                done += len(ids)

    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_arrow(d, run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def op11_byte_bpe(spark, sf_dir: str) -> DataFrame:
    return round_trip_digests(table(spark, sf_dir, "documents"))
