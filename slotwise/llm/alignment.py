"""Alignment of two tokenizers by inverted pair bitmaps.

Both tokenizers cut the same bytes. Where tokens of both end, a group ends; a
link is a pair of token occurrences (one of either tokenizer) whose byte ranges
overlap. For every pair of ids the index keeps which documents link it: a
compressed bitmap per bucket of documents, and bitmaps of the documents by the
bits of their further links (multiplicity planes). Merged and counted, they give
a pair's documents and links; weighted with the pair's counts, the same postings
give every document's scores. Pairs travel with their bitmaps, never as single
links, and a pair found everywhere has one row a bucket.

A bucket is a run of documents of one task, ``BUCKET_CHARS`` characters or
65,536 documents at most. A bitmap of few documents is a list of their numbers
(two bytes each), else one bit a document; see :func:`containers`.

Defined cases: a null or empty text, and one whose tokens' bytes differ from its
own (with the leading space), has no tokens: zeros and an empty group text.
Special tokens' strings are plain text. Rows are independent: repeated rows and
null ids each get a row; both count in the corpus. An empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import map_arrow, table, vocabulary, written
from slotwise.llm.prefix_coder import Memo
from slotwise.llm.prefix_tokens import grouped, split_common

LEFT, RIGHT = "byte_bpe_50k.json", "piece_bpe_32k.model"
GROUP_CHARS = 1_000_000  # characters tokenized at once
BUCKET_CHARS = 12_000_000  # characters of a bucket, about
BUCKET_DOCS = 65_536  # document numbers are two bytes
SHIFT = 24  # pair = left id << SHIFT | right id; below 2^47, so that a pair and a document number fit 63 bits
BROADCAST = 1_000_000  # pairs that may be broadcast
CACHE = 400_000  # distinct pre-tokens per generation of a worker's memo
KEEP = 64  # longer pre-tokens are encoded each time
MARK = "▁"


def _byte_level() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Pair:
    """The two tokenizers, with each id's bytes and the texts that groups are written with."""

    def __init__(self, left: str, right: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        path = vocabulary(left)
        self.a = Tokenizer.from_file(path)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = SentencePieceProcessor(model_file=vocabulary(right))
        self.words = Memo(CACHE)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        # plain byte-level pre-tokens, with no pattern, prefix or normal form of their own
        plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        self.common = spec["normalizer"] is None and plain.items() <= ({"use_regex": True} | spec["pre_tokenizer"]).items()
        back, size = _byte_level(), self.a.get_vocab_size(with_added_tokens=True)
        self.a_bytes = [b""] * size
        for token, i in spec["model"]["vocab"].items():
            self.a_bytes[i] = bytes(back[c] for c in token)
        for token in spec["added_tokens"]:
            self.a_bytes[token["id"]] = token["content"].encode("utf-8")
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.a_length, self.b_length = (np.array(list(map(len, x)), np.int64) for x in (self.a_bytes, self.b_bytes))
        # a token inside and at the end of a group's side
        self.a_text = [f"{i}," for i in range(size)] + [f"{i}|" for i in range(size)]
        self.b_text = [f"{i}," for i in range(len(self.b_bytes))] + [f"{i};" for i in range(len(self.b_bytes))]
        self.texts = self.a_text + self.b_text

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if self.b.is_byte(i) else piece.replace(MARK, " ").encode("utf-8")

    def _left(self, texts: list[str]) -> list[np.ndarray]:
        """Ids by the left tokenizer; it encodes each distinct pre-token once, as merges stay inside one."""
        split = [self._split(t) for t in texts]
        new = self.words.missing(set().union(*split))
        now = self.words.now
        for s in range(0, len(new), 20_000):
            some = new[s : s + 20_000]
            for w, x in zip(some, self.a.encode_batch_fast(some, add_special_tokens=False)):
                now[w] = np.array(x.ids, np.int32).tobytes()
        out = [np.frombuffer(b"".join(map(now.__getitem__, s)), np.int32).astype(np.int64) for s in split]
        for w in new:
            if len(w) > KEEP:
                del now[w]
        return out

    def _split(self, text: str) -> list[str]:
        found = split_common(text) if self.common else None
        return [text[a:b] for _, (a, b) in self.a.pre_tokenizer.pre_tokenize_str(text)] if found is None else found

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids by both; texts without tokens (see the module's cases) have none."""
        none = np.zeros(0, np.int64)
        a = self._left([" " + t for t in texts])
        b = [np.array(x, np.int64) for x in self.b.encode(texts, num_threads=1)]
        for k, t in enumerate(texts):
            whole = (" " + t).encode("utf-8")
            if not t or b"".join([self.a_bytes[i] for i in a[k].tolist()]) != whole or b"".join([self.b_bytes[i] for i in b[k].tolist()]) != whole:
                a[k] = b[k] = none
        return a, b


class Aligned:
    """Groups and links of a list of texts, from both encodings laid end to end."""

    def __init__(self, pair: Pair, a: list[np.ndarray], b: list[np.ndarray]):
        n = len(a)
        self.a, self.b = np.concatenate([*a, np.zeros(0, np.int64)]), np.concatenate([*b, np.zeros(0, np.int64)])
        self.n_a, self.n_b = (np.fromiter(map(len, x), np.int64, n) for x in (a, b))
        end_a, end_b = np.cumsum(pair.a_length[self.a]), np.cumsum(pair.b_length[self.b])  # of equal totals, text by text
        j = np.searchsorted(end_b, end_a)
        cut_a, cut_b = end_b[j] == end_a if len(j) else np.zeros(0, bool), np.zeros(len(end_b), bool)
        i = np.flatnonzero(cut_a)
        j = j[i]
        cut_b[j] = True
        # between two neighbouring ends lies the overlap of exactly one token of each
        ends = np.sort(np.concatenate([end_a, end_b]), kind="stable")  # a merge of two runs
        ends = ends[np.append(True, ends[1:] != ends[:-1])] if len(ends) else ends
        self.link_a, self.link_b = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
        doc_a = np.repeat(np.arange(n), self.n_a)
        self.doc = doc_a[self.link_a]
        self.n_links = np.bincount(self.doc, minlength=n)
        self.n_groups = np.bincount(doc_a[i], minlength=n)
        # written order: a group's left tokens, then its right ones
        group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
        until_a, until_b = np.append(0, i + 1), np.append(0, j + 1)
        size_a, size_b = len(pair.a_length), len(pair.b_length)
        text = np.empty(len(self.a) + len(self.b), np.int64)
        text[np.arange(len(self.a)) + until_b[group_a]] = self.a + size_a * cut_a
        text[np.arange(len(self.b)) + until_a[group_b + 1]] = 2 * size_a + self.b + size_b * cut_b
        pieces, at = list(map(pair.texts.__getitem__, text.tolist())), np.cumsum(np.append(0, self.n_a + self.n_b)).tolist()
        self.groups = ["".join(pieces[x:y])[:-1] for x, y in zip(at, at[1:])]

    def entries(self, first: int) -> np.ndarray:
        """pair << 16 | document number, once a link; numbers from ``first`` on."""
        return (self.a[self.link_a] << SHIFT | self.b[self.link_b]) << 16 | (self.doc + first)


@lru_cache(maxsize=1)
def _pair(left: str, right: str) -> Pair:
    return Pair(left, right)


def containers(numbers: np.ndarray, lengths: np.ndarray, docs: int) -> pa.Array:
    """Bitmaps of the documents ``numbers`` (sorted runs of ``lengths``) of a bucket of ``docs``.

    Few documents: their numbers, two bytes each (an even length). More: one bit
    each, and a byte more if needed to make the length odd.
    """
    wide = docs // 8 + 1
    wide += 1 - wide % 2
    flat, ends = numbers.astype("<u2").view(np.uint8), 2 * np.cumsum(lengths)
    dense = np.flatnonzero(2 * lengths > wide)
    if not len(dense):
        return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(np.append(0, ends).astype(np.int32)), pa.py_buffer(flat)])
    parts, before = [], 0
    for k in dense.tolist():
        lo, hi = ends[k] - 2 * lengths[k], ends[k]
        bits = np.zeros(8 * wide, np.uint8)
        bits[numbers[lo // 2 : hi // 2]] = 1
        parts += [flat[before:lo], np.packbits(bits, bitorder="little")]
        before = hi
    size = 2 * lengths
    size[dense] = wide
    return pa.Array.from_buffers(
        pa.binary(), len(lengths), [None, pa.py_buffer(np.append(0, np.cumsum(size)).astype(np.int32)), pa.py_buffer(np.concatenate([*parts, flat[before:]]))]
    )


def numbers_of(bitmaps: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and document number of every document in the bitmaps (none null)."""
    n = len(bitmaps)
    ends = np.frombuffer(bitmaps.buffers()[1], np.int32)[bitmaps.offset : bitmaps.offset + n + 1].astype(np.int64)
    size, data = np.diff(ends), np.frombuffer(bitmaps.buffers()[2] or b"", np.uint8)
    dense = size % 2 == 1
    inside = np.repeat(~dense, size)
    rows = np.repeat(np.flatnonzero(~dense), size[~dense] // 2)
    found = [np.ascontiguousarray(data[ends[0] : ends[-1]][inside]).view("<u2").astype(np.int64)]
    rows = [rows]
    for k in np.flatnonzero(dense).tolist():
        at = np.flatnonzero(np.unpackbits(data[ends[k] : ends[k + 1]], bitorder="little"))
        rows.append(np.full(len(at), k))
        found.append(at)
    return np.concatenate(rows), np.concatenate(found)


def postings(entries: np.ndarray, docs: int) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """Pairs of a bucket, their document bitmaps and their multiplicity planes.

    ``entries``: pair << 16 | document number of each link. Plane k holds the
    documents of which bit k of (links - 1) is set.
    """
    x = np.sort(entries)
    at = np.flatnonzero(np.append(True, x[1:] != x[:-1])) if len(x) else np.zeros(0, np.int64)
    more = np.diff(np.append(at, len(x))) - 1
    x = x[at]
    key, number = x >> 16, x & 0xFFFF
    new = np.append(True, key[1:] != key[:-1]) if len(x) else np.zeros(0, bool)
    names, row = key[new], np.cumsum(new) - 1
    bitmaps = containers(number, np.bincount(row, minlength=len(names)), docs)
    planes, of, bit = [], [], int(more.max(initial=0)).bit_length()
    for k in range(bit):
        hit = (more >> k & 1).astype(bool)
        count = np.bincount(row[hit], minlength=len(names))
        planes.append(containers(number[hit], count, docs))
        of.append(more >> k)
    # a pair has planes up to the highest bit any of its documents needs
    high = np.zeros(len(names), np.int64)
    for k in range(bit):
        high[row[of[k] > 0]] = k + 1
    ends = np.append(0, np.cumsum(high)).astype(np.int32)
    if bit:
        order = np.concatenate([np.full((high > k).sum(), k * len(names)) + np.flatnonzero(high > k) for k in range(bit)])
        order = order[np.argsort(order % len(names), kind="stable")]
        values = pa.concat_arrays(planes).take(pa.array(order))
    else:
        values = pa.array([], pa.binary())
    return names, bitmaps, pa.ListArray.from_arrays(pa.array(ends), values)


def aligned_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", left: str = LEFT, right: str = RIGHT, digest: bool = False
) -> DataFrame:
    """One pass over the texts: rows of documents (``pair`` is null) and rows of postings (``number`` is null).

    ``doc_id, bucket, number, n_a, n_b, n_groups, n_links, groups`` and ``pair, bucket, docs, planes``.
    With ``digest`` the texts of ``groups``, several times as long as the documents, are replaced
    by their SHA-256 before they leave the task.
    """
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = d.schema["doc_id"].dataType.simpleString()
    ddl = f"doc_id {kind}, number int, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, pair bigint, docs binary, planes array<binary>, bucket bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, part, bucket, number, chars, held = _pair(left, right), TaskContext.get().partitionId(), 0, 0, 0, []
        nothing = {"groups": pa.string(), "docs": pa.binary(), "planes": pa.list_(pa.binary()), "number": pa.int32()}
        names = ["doc_id", "number", "n_a", "n_b", "n_groups", "n_links", "groups", "pair", "docs", "planes", "bucket"]

        def rows(n: int, **have) -> pa.RecordBatch:
            have["bucket"] = pa.array(np.full(n, part << 32 | bucket))
            return pa.RecordBatch.from_arrays([have[c] if c in have else pa.nulls(n, nothing.get(c, pa.int64())) for c in names], names=names)

        def index() -> Iterator[pa.RecordBatch]:
            keys, bitmaps, planes = postings(np.concatenate([np.zeros(0, np.int64), *held]), number)
            for s in range(0, len(keys), 100_000):
                some = slice(s, s + 100_000)
                n = len(keys[some])
                yield rows(n, doc_id=pa.nulls(n, ids.type), pair=pa.array(keys[some]), docs=bitmaps[some], planes=planes[some])

        ids = None
        for batch in batches:
            ids, done = batch.column(0), 0
            for texts in grouped((t.as_py() or "" for t in batch.column(1)), GROUP_CHARS):
                for s in range(0, len(texts), BUCKET_DOCS):
                    some = texts[s : s + BUCKET_DOCS]
                    if number and (chars + sum(map(len, some)) > BUCKET_CHARS or number + len(some) > BUCKET_DOCS):
                        yield from index()
                        bucket, number, chars, held = bucket + 1, 0, 0, []
                    x, n = Aligned(pair, *pair.encode(some)), len(some)
                    counts = {c: pa.array(getattr(x, c).astype(np.int64)) for c in ("n_a", "n_b", "n_groups", "n_links")}
                    yield rows(n, doc_id=ids.slice(done, n), number=pa.array(np.arange(number, number + n, dtype=np.int32)), groups=pa.array(list(map(_digest, x.groups)) if digest else x.groups, pa.string()), **counts)
                    held.append(x.entries(number))
                    number, chars, done = number + n, chars + sum(map(len, some)), done + n
        if ids is not None:
            yield from index()

    return map_arrow(d, run, ddl)


def _digest(groups: str) -> str:
    return hashlib.sha256(groups.encode()).hexdigest() if groups else ""


def _count(bitmap: Column) -> Column:
    """Documents of a bitmap; see :func:`containers`."""
    return F.when(F.length(bitmap) % 2 == 0, (F.length(bitmap) / 2).cast("bigint")).otherwise(F.bitmap_count(bitmap))


def pair_counts(index: DataFrame) -> DataFrame:
    """``pair, n_docs, n_links`` from postings: bitmaps counted bucket by bucket, planes by their weight."""
    weighted = F.transform("planes", lambda p, k: F.call_function("shiftleft", F.lit(1).cast("bigint"), k) * _count(p))
    links = _count(F.col("docs")) + F.aggregate(weighted, F.lit(0).cast("bigint"), lambda x, y: x + y)
    return index.groupBy("pair").agg(F.sum(_count(F.col("docs"))).alias("n_docs"), F.sum(links).alias("n_links"))


def document_scores(index: DataFrame, counts: DataFrame, most: int = BROADCAST) -> DataFrame:
    """``bucket, number, count_sum, n_best`` from the postings of ``index`` and ``pair, n_links, best``.

    Up to ``most`` pairs (some 30 bytes each) are broadcast, and a bucket's
    postings are weighted where they lie, one after the other as they were
    written. Above that, postings and pairs are joined by pair and the weighted
    postings go back to their buckets. A task adds up one bucket at a time, in
    two arrays of its documents; what different tasks found is added after that.
    """
    columns = ["bucket", "docs", "planes", "n_links", F.col("best").cast("bigint").alias("best")]
    index = index.select("pair", "bucket", "docs", "planes")
    if counts.limit(most + 1).count() <= most:
        both = index.join(F.broadcast(counts), "pair").select(*columns)
    else:
        both = index.join(counts, "pair").select(*columns).repartition("bucket").sortWithinPartitions("bucket")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, sums = None, np.zeros((2, BUCKET_DOCS), np.int64)

        def out() -> pa.RecordBatch:
            number = np.flatnonzero(sums[0])  # a document of a posting has at least one link
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(number), open_)), *(pa.array(x) for x in (number, *sums[:, number]))], names=names)

        names = ["bucket", "number", "count_sum", "n_best"]
        for batch in batches:
            buckets = batch.column(0).to_numpy()
            starts = np.flatnonzero(np.append(True, buckets[1:] != buckets[:-1])) if len(buckets) else []
            for lo, hi in zip(starts, [*starts[1:], len(buckets)]):
                if buckets[lo] != open_:
                    if open_ is not None:
                        yield out()
                    open_ = int(buckets[lo])
                    sums[:] = 0
                part = batch.slice(lo, hi - lo)
                weights = np.stack([part.column(3).to_numpy(), part.column(4).to_numpy()])
                row, number = numbers_of(part.column(1))
                for total, w in zip(sums, weights):
                    np.add.at(total, number, w[row])
                each = part.column(2).value_lengths().to_numpy()
                if each.any():
                    at = np.repeat(np.arange(len(each)), each)
                    bit = np.int64(1) << (np.arange(len(at)) - np.repeat(np.cumsum(each) - each, each))
                    row, number = numbers_of(part.column(2).flatten())
                    for total, w in zip(sums, weights):
                        np.add.at(total, number, (w[at] * bit)[row])
        if open_ is not None:
            yield out()

    sums = map_arrow(both, run, "bucket bigint, number bigint, count_sum bigint, n_best bigint")
    return sums.groupBy("bucket", F.col("number").cast("int").alias("number")).agg(F.sum("count_sum").alias("count_sum"), F.sum("n_best").alias("n_best"))


def align(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", left: str = LEFT, right: str = RIGHT, digest: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Documents with their groups and scores, and the pairs of the corpus.

    ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups`` per input
    row (``digest``: as above); ``a, b, n_docs, n_links, best`` per linked pair of ids.
    """
    both = written(aligned_documents(docs, id_col, text_col, left, right, digest), "alignment")
    index = both.filter("pair is not null")
    counts = written(pair_counts(index), "pairs").withColumn("b", F.expr(f"cast(pair & {(1 << SHIFT) - 1} as int)"))
    # one row per id of the right vocabulary at most
    top = counts.groupBy("b").agg(F.max("n_links").alias("top"))
    counts = counts.join(F.broadcast(top), "b").withColumn("best", F.col("n_links") == F.col("top")).drop("top")
    scores = document_scores(index, counts.select("pair", "n_links", "best"))
    rows = both.filter("number is not null").drop("pair", "docs", "planes").join(scores, ["bucket", "number"], "left")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
    documents = rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups")
    pairs = counts.select(F.shiftright("pair", SHIFT).cast("int").alias("a"), "b", "n_docs", "n_links", "best")
    return documents, pairs


def op12_token_alignment(spark, sf_dir: str) -> DataFrame:
    rows, _ = align(table(spark, sf_dir, "documents"), digest=True)
    return rows.withColumnRenamed("groups", "groups_sha256")
