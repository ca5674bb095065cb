"""Near-duplicate documents by order MinHash and banded alignment.

A document's five-word shingles are labelled with their occurrence number. Each
sketch keeps the ``KEPT`` shingles with the smallest hashes and hashes them in
their order in the text, so two documents share a sketch about as often as they
share shingles in the same order. Documents that share a sketch are candidates.
A candidate pair is verified by aligning the labelled shingle sequences inside
the band that the similarity allows: similarity is the length of the longest
common subsequence over the number of shingles in either, at least ``LIMIT``.

Texts of fewer than ``FEW`` shingles have too small a sketch to meet reliably;
they, and those that may be similar to one, are also listed under the shingles of
their prefix (in hash order, as long as a common part of ``LIMIT`` needs), which
no similar pair can miss.

Candidates without all pairs: equal texts are collapsed first; in every bucket
each member is compared with two centres (the smallest and the greatest id) if
it meets them in ``SHARED`` buckets or more. Buckets whose members then still lie
in different components are resolved exactly: inside blocks of bounded size the
tasks compare their cross-component members, first by length and signature (a
bitmap of all shingles for texts of up to ``SHORT`` shingles, else
one-permutation minima, ``SLACK`` standard deviations below the limit), then by
alignment, and unite what they find, so a block hands on at most one link per
member. Pairs inside a component need no test, as a link between them changes
nothing. A bucket of more than ``TILE`` members is dealt out in pairs of tiles; no
pair of it is dropped.

Defined cases: null texts and texts without a word are equal (empty); texts of
fewer than five words are one shingle; rows with a null id stay alone and are
kept; each row of an id with several texts belongs to its own text's component
and may be the one that stays for it; repeated rows get a row each; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm.blocks import by_block, in_blocks, neighbours, tiled
from slotwise.llm.common import WORD, checkpointed, components, join_null_safe, map_arrow, table
from slotwise.llm.prefix_tokens import grouped

SHINGLE = 5
LIMIT = 0.8
KEPT = 5  # shingles per sketch: about 0.8^5 of the sketches agree at the limit
SKETCHES = 24  # one agrees with chance 0.9999
NEAR = 24  # shingles expected below the first cut of a sketch's hashes
BYTES = 256  # of a signature
SHORT = 512  # shingles: up to here a bitmap tells all
SLACK = 4.0
FEW = 20  # shingles: below, sketches alone would miss similar texts
SHARED = 2  # of the sketches, for a comparison with a centre
TILE = 1024
BROADCAST = 1_000_000  # ids (16 bytes each) that may be broadcast
CACHE = 100_000

_words = re.compile(WORD).findall
_known: dict[str, int] = {}
_M1, _M2, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_MAX = np.uint64(2**64 - 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (wraps around on purpose)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[str]) -> list[np.ndarray]:
    split = [_words(t) for t in texts]
    if len(_known) > CACHE:
        _known.clear()
    for w in set().union(*split) - _known.keys():
        _known[w] = int.from_bytes(hashlib.blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
    get = _known.__getitem__
    return [np.fromiter(map(get, ws), np.uint64, len(ws)) for ws in split]


def shingles(hashes: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hashes of the shingles of a word sequence, in order."""
    if not len(hashes):
        return hashes
    n = max(1, len(hashes) - size + 1)
    out = np.zeros(n, np.uint64)
    for k in range(min(size, len(hashes))):
        out = out * _STEP + hashes[k : k + n]
    return _mixed(out + np.uint64(min(size, len(hashes))))


def labelled(sh: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Shingle hashes that include the occurrence number within the document."""
    key = sh + doc * _STEP
    order = np.argsort(key, kind="stable")
    s = key[order]
    new = np.concatenate(([True], s[1:] != s[:-1]))
    at = np.flatnonzero(new)
    occurrence = np.empty(len(sh), np.uint64)
    occurrence[order] = np.arange(len(sh)) - np.repeat(at, np.diff(np.append(at, len(sh))))
    return _mixed(sh ^ (occurrence * _M1))


def sketches(lab: np.ndarray, starts: np.ndarray, counts: np.ndarray, n: int = SKETCHES, kept: int = KEPT) -> np.ndarray:
    """(documents, n) order MinHash values of non-empty documents."""
    docs = len(starts)
    out = np.empty((docs, n), np.int64)
    doc_of = np.repeat(np.arange(docs), counts)
    # Hashes below the cut hold the smallest ones, except in rare documents that are taken whole.
    cut = np.where(counts > NEAR, np.minimum(float(NEAR) / counts, 1.0) * 2.0**63, 2.0**63).astype(np.uint64)
    cut_of = np.repeat(cut, counts)
    for j in range(n):
        add, times = (np.uint64(x % 2**64) for x in ((2 * j + 1) * int(_STEP), int(_M1) + 2 * j * int(_M2) | 1))
        p = ((lab ^ add) * times) >> np.uint64(1)
        hit = np.flatnonzero(p < cut_of)
        few = np.bincount(doc_of[hit], minlength=docs) < np.minimum(kept, counts)
        if few.any():
            hit = np.union1d(hit, np.flatnonzero(few[doc_of]))
        d = doc_of[hit]
        order = np.lexsort((hit, p[hit], d))
        hit, d = hit[order], d[order]
        first = np.searchsorted(d, np.arange(docs))
        rank = np.arange(len(d)) - first[d]
        top = rank < kept
        where = np.full((docs, kept), -1, np.int64)
        where[d[top], rank[top]] = hit[top]
        where.sort(axis=1)  # text order; -1 where the document has fewer shingles
        h = np.full(docs, np.uint64(j + 1))
        for k in range(kept):
            h = _mixed(h * _STEP + np.where(where[:, k] >= 0, lab[where[:, k]], np.uint64(0)))
        out[:, j] = h.view(np.int64)
    return out


def signatures(lab: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """(documents, 2 * BYTES): bitmap of the shingles, then smallest hashes by bin.

    The bitmap is left out (zero) above ``SHORT`` shingles. The minima, a byte
    for each of ``BYTES`` bins and 0 for an empty one, are left out where no
    text of a similar length can be above ``SHORT``.
    """
    x = _mixed(lab + _STEP)
    doc = np.repeat(np.arange(len(counts)), counts)
    out = np.zeros((len(counts), 2 * BYTES), np.uint8)
    short = np.repeat(counts <= SHORT, counts)
    bits = np.zeros((len(counts), 8 * BYTES), bool)
    bits[doc[short], (x[short] % np.uint64(8 * BYTES)).astype(np.int64)] = True
    out[:, :BYTES] = np.packbits(bits, axis=1)
    long = np.repeat(counts > LIMIT * SHORT, counts)
    low = np.full(len(counts) * BYTES, _MAX, np.uint64)
    np.minimum.at(low, doc[long] * BYTES + (x[long] % np.uint64(BYTES)).astype(np.int64), x[long])
    out[:, BYTES:] = np.where(low == _MAX, 0, 1 + (low >> np.uint64(20)) % np.uint64(255)).reshape(-1, BYTES)
    return out


def may_reach(a: np.ndarray, b: np.ndarray, n: np.ndarray, limit: float = LIMIT, slack: float = SLACK) -> np.ndarray:
    """Rows of signatures whose similarity may be the limit or more; ``n``: shingles of the longer text."""
    out = np.zeros(len(a), bool)
    short = n <= SHORT
    x, y = a[short, :BYTES], b[short, :BYTES]
    both, either = np.bitwise_count(x & y).sum(1, dtype=np.int64), np.bitwise_count(x | y).sum(1, dtype=np.int64)
    out[short] = both >= (limit - 0.02) * either - 1  # room for two shingles on one bit
    x, y = a[~short, BYTES:], b[~short, BYTES:]
    used = ((x | y) != 0).sum(1)
    out[~short] = ((x == y) & (x != 0)).sum(1) >= limit * used - slack * np.sqrt(limit * (1 - limit) * used)
    return out


def similar(a: np.ndarray, b: np.ndarray, limit: float = LIMIT) -> bool:
    """Banded alignment of two labelled shingle sequences.

    A label occurs at most once per document, so the longest common subsequence
    is the longest increasing run of the matches' positions.
    """
    na, nb = len(a), len(b)
    need = limit * (na + nb) / (1 + limit)  # common / (na + nb - common) >= limit
    band = na + nb - 2 * need
    if min(na, nb) < need - 1e-9:
        return False
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    near = np.abs(i - j) <= band + 1e-9
    i, j = i[near], j[near]
    if len(i) < need - 1e-9:
        return False
    run = j[np.argsort(i)]
    if (np.diff(run) > 0).all():
        return True
    tails: list[int] = []
    for x in run.tolist():
        k = bisect_left(tails, x)
        tails[k : k + 1] = [x]
    return len(tails) >= need - 1e-9


def prefixes(lab: np.ndarray, starts: np.ndarray, counts: np.ndarray, limit: float = LIMIT) -> list[np.ndarray]:
    """Per document of few shingles (or similar in length to such) the hashes of its prefix.

    Two sets that share ``limit`` of the larger share one of the smallest
    ``n - ceil(limit n) + 1`` hashes of each.
    """
    out = []
    for s, n in zip(starts.tolist(), counts.tolist()):
        if n * limit > FEW:
            out.append(np.zeros(0, np.int64))
            continue
        most = n - math.ceil(limit * n - 1e-9) + 1
        out.append(_mixed(np.sort(_mixed(lab[s : s + n] ^ _M2))[:most]).view(np.int64))
    return out


def sketch_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, t, k1, k2, n, sketches, bits, low``: text hash, word-sequence key, shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in grouped((t.as_py() or "" for t in batch.column(2)), 1_000_000):
                hs = word_hashes(texts)
                keys = np.frombuffer(b"".join(hashlib.blake2b(h.tobytes(), digest_size=16).digest() for h in hs), np.int64).reshape(-1, 2)
                sh = [shingles(h) for h in hs]
                counts = np.array([len(s) for s in sh])
                some = np.flatnonzero(counts)
                values: list[np.ndarray] = [np.zeros(0, np.int64)] * len(texts)
                sig = np.zeros((len(texts), 2 * BYTES), np.uint8)
                if len(some):
                    c = counts[some]
                    lab = labelled(np.concatenate(sh), np.repeat(np.arange(len(c), dtype=np.uint64), c))
                    starts = np.concatenate(([0], np.cumsum(c)[:-1]))
                    for k, x, y in zip(some.tolist(), sketches(lab, starts, c), prefixes(lab, starts, c)):
                        values[k] = np.concatenate([x, y])
                    sig[some] = signatures(lab, c)
                ends = np.cumsum([0, *map(len, values)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(texts)),
                        batch.column(1).slice(at, len(texts)),
                        pa.array(keys[:, 0]),
                        pa.array(keys[:, 1]),
                        pa.array(counts.astype(np.int64)),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(values))),
                        pa.array([x[:BYTES].tobytes() if n <= SHORT else b"" for x, n in zip(sig, counts)], pa.binary()),
                        pa.array([x[BYTES:].tobytes() if n > LIMIT * SHORT else b"" for x, n in zip(sig, counts)], pa.binary()),
                    ],
                    names=["doc_id", "t", "k1", "k2", "n", "sketches", "bits", "low"],
                )
                at += len(texts)
        _known.clear()  # the worker goes on to other stages

    text = F.col(text_col).cast("string")
    d = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("t"), text.alias("text"))
    kind = d.schema["doc_id"].dataType.simpleString()
    return map_arrow(d, run, f"doc_id {kind}, t bigint, k1 bigint, k2 bigint, n bigint, sketches array<bigint>, bits binary, low binary")


def _matrix(bits, low) -> np.ndarray:
    """Signatures of the rows of two binary columns; what is left out is zero."""
    none = bytes(BYTES)
    return np.frombuffer(b"".join(x or none for pair in zip(bits.to_pylist(), low.to_pylist()) for x in pair), np.uint8).reshape(-1, 2 * BYTES)


def promising(pairs: DataFrame, reps: DataFrame, limit: float = LIMIT) -> DataFrame:
    """The pairs ``a, ta, b, tb`` whose signatures may reach the limit."""
    side = lambda k: reps.select(F.col("rep").alias(k), F.col("t").alias(f"t{k}"), *[F.col(c).alias(f"{c}_{k}") for c in ("bits", "low", "n")])
    both = pairs.join(side("a"), ["a", "ta"]).join(side("b"), ["b", "tb"]).select("a", "ta", "b", "tb", "bits_a", "low_a", "bits_b", "low_b", F.greatest("n_a", "n_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, len(batch), 20_000):
                x = batch.slice(s, 20_000)
                near = may_reach(_matrix(x.column(4), x.column(5)), _matrix(x.column(6), x.column(7)), x.column(8).to_numpy(), limit)
                yield x.select(["a", "ta", "b", "tb"]).filter(pa.array(near))

    return map_arrow(both, run, pairs.select("a", "ta", "b", "tb").schema)


def verified(pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str, limit: float = LIMIT) -> DataFrame:
    """The pairs ``a, ta, b, tb`` whose texts align."""
    need = pairs.select(F.col("a").alias("i"), F.col("ta").alias("h")).unionByName(pairs.select(F.col("b").alias("i"), F.col("tb").alias("h"))).distinct()
    if pairs.count() <= BROADCAST // 2:
        need = F.broadcast(need)  # then only texts of candidates are shuffled
    text = F.col(text_col).cast("string")
    texts = docs.select(F.col(id_col).alias("i"), F.xxhash64(text).alias("h"), text.alias("text")).join(need, ["i", "h"], "left_semi").dropDuplicates(["i", "h"])
    side = lambda k: texts.select(F.col("i").alias(k), F.col("h").alias(f"t{k}"), F.col("text").alias(f"text_{k}"))
    both = pairs.join(side("b"), ["b", "tb"]).join(side("a"), ["a", "ta"]).select("a", "ta", "b", "tb", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zero = lambda s: labelled(s, np.zeros(len(s), np.uint64)) if len(s) else s
        for batch in batches:
            good = []
            for s in range(0, len(batch), 256):
                x, y = (word_hashes([t or "" for t in batch.column(k).slice(s, 256).to_pylist()]) for k in (4, 5))
                good += [similar(zero(shingles(p)), zero(shingles(q)), limit) for p, q in zip(x, y)]
            yield batch.select(["a", "ta", "b", "tb"]).filter(pa.array(good, pa.bool_()))
        _known.clear()

    return map_arrow(both, run, pairs.select("a", "ta", "b", "tb").schema)


def labelled_texts(need: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``rep, t, lab``: labelled shingles in text order (64 bits each) of the texts ``need`` names by ``rep, t``."""
    if need.count() <= BROADCAST:
        need = F.broadcast(need)  # then only these texts are shuffled
    text = F.col(text_col).cast("string")
    texts = docs.select(F.col(id_col).alias("rep"), F.xxhash64(text).alias("t"), text.alias("text")).join(need, ["rep", "t"], "left_semi").dropDuplicates(["rep", "t"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for some in grouped((t.as_py() or "" for t in batch.column(2)), 1_000_000):
                sh = [shingles(h) for h in word_hashes(some)]
                lab = [labelled(x, np.zeros(len(x), np.uint64)).tobytes() if len(x) else b"" for x in sh]
                yield pa.RecordBatch.from_arrays([*(batch.column(k).slice(at, len(some)) for k in (0, 1)), pa.array(lab, pa.binary())], names=["rep", "t", "lab"])
                at += len(some)
        _known.clear()

    return map_arrow(texts, run, f"rep {texts.schema['rep'].dataType.simpleString()}, t bigint, lab binary")


def _signature(lab: np.ndarray) -> np.ndarray:
    return signatures(lab, np.array([len(lab)]))


class _Sets:
    """Disjoint sets of small numbers."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def top(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def unite(self, x: int, y: int) -> None:
        self.up[self.top(x)] = self.top(y)


def cross_links(members: DataFrame, labs: DataFrame, limit: float = LIMIT, tile: int = TILE) -> DataFrame:
    """Links ``a, ta, b, tb`` that join the components of a bucket's members as far as similar pairs do.

    ``members``: ``sketch, rep, t, n, component``; ``labs``: ``rep, t, lab``. The
    shingles join the members when these are dealt, and are shuffled once with
    them. A pair is aligned only if links found before do not already join its
    components; a block gives fewer links than it has members.
    """
    size = members.groupBy("sketch").agg(F.count(F.lit(1)).alias("size"))
    spread = tiled(members.join(size, "sketch"), ["sketch"], "size", "t", tile)
    spread = spread.select("block", "own", "left", "rep", "t", "n", F.xxhash64("component").alias("component"))
    spread = by_block(spread.join(labs, ["rep", "t"]))
    kind = members.schema["rep"].dataType.simpleString()

    def work(x: pa.Table) -> pa.RecordBatch:
        block, own, left, n = (x[c].to_numpy() for c in ("block", "own", "left", "n"))
        every, component = np.unique(x["component"].to_numpy(), return_inverse=True)
        sets, found, labs_ = _Sets(len(every)), [], x["lab"].combine_chunks()
        lab = lambda p: np.frombuffer(labs_[p].as_buffer(), np.uint64)
        sig = np.concatenate([_signature(lab(p)) for p in range(len(x))]) if len(x) else np.zeros((0, 2 * BYTES), np.uint8)
        for i, j in neighbours(block):
            ok = (own[i] | (left[i] != left[j])) & (component[i] != component[j]) & (np.minimum(n[i], n[j]) >= limit * np.maximum(n[i], n[j]))
            i, j = i[ok], j[ok]
            for s in range(0, len(i), 20_000):
                p, q = i[s : s + 20_000], j[s : s + 20_000]
                near = may_reach(sig[p], sig[q], np.maximum(n[p], n[q]), limit)
                for a, b in zip(p[near].tolist(), q[near].tolist()):
                    u, v = component[a], component[b]
                    if sets.top(u) != sets.top(v) and similar(lab(a), lab(b), limit):
                        sets.unite(u, v)
                        found.append((a, b))
        i, j = (pa.array([f[k] for f in found], pa.int64()) for k in (0, 1))
        rep, t = x["rep"].combine_chunks(), x["t"].combine_chunks()
        return pa.RecordBatch.from_arrays([rep.take(i), t.take(i), rep.take(j), t.take(j)], names=["a", "ta", "b", "tb"])

    return map_arrow(spread, in_blocks(work, 2000), f"a {kind}, ta bigint, b {kind}, tb bigint")


def _joined(links: DataFrame) -> DataFrame:
    """``rep, t, component`` of every text on a link; a component is named by its smallest (id, text)."""
    node = lambda i, h: F.struct(F.col(i).alias("i"), F.col(h).alias("h"))
    found = components(links.select(node("a", "ta").alias("a"), node("b", "tb").alias("b")))
    return found.select(F.col("node.i").alias("rep"), F.col("node.h").alias("t"), "component")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: float = LIMIT, tile: int = TILE) -> DataFrame:
    """``doc_id, t, class_id, component_id, kept`` per input row; ``t`` is the text's hash.

    ``class_id``: smallest id with the same words; ``component_id``: smallest id
    reachable by near-duplicate links; ``kept``: the row stands for its
    component, as the smallest id and hash of its smallest class.
    """
    d = checkpointed(sketch_documents(docs, id_col, text_col))
    first = [F.first(c).alias(c) for c in ("n", "sketches", "bits", "low")]
    reps = d.filter("doc_id is not null").groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "t")).alias("r"), *first)
    reps = checkpointed(reps.select("k1", "k2", F.col("r.doc_id").alias("rep"), F.col("r.t").alias("t"), "n", "sketches", "bits", "low"))
    rows = reps.select("rep", "t", "n", F.explode("sketches").alias("sketch"))
    me = F.struct("rep", "t", "n")
    buckets = rows.groupBy("sketch").agg(F.count(F.lit(1)).alias("size"), F.min(me).alias("low"), F.max(me).alias("high")).filter("size > 1")
    members = checkpointed(rows.join(buckets.drop("size"), "sketch"))
    # A pair is named once per bucket: the greatest member's by the smallest.
    is_low, is_high = ((F.col("rep") == F.col(f"{c}.rep")) & (F.col("t") == F.col(f"{c}.t")) for c in ("low", "high"))
    centres = F.when(is_low, F.slice(F.array("low"), 1, 0)).when(is_high, F.array("low"))
    star = members.withColumn("c", F.explode(centres.otherwise(F.array("low", "high")))).filter(F.least("n", "c.n") >= limit * F.greatest("n", "c.n"))
    star = _pairs(star.select(F.col("rep").alias("a"), F.col("t").alias("ta"), F.col("c.rep").alias("b"), F.col("c.t").alias("tb")), SHARED)
    star = promising(star, reps, limit)
    done = checkpointed(verified(checkpointed(star), docs, id_col, text_col, limit))
    # What the centres have not joined: members of one bucket in different components.
    own = F.struct(F.col("rep").alias("i"), F.col("t").alias("h"))
    split = members.select("sketch", "rep", "t", "n").join(_joined(done), ["rep", "t"], "left").withColumn("component", F.coalesce("component", own))
    open_ = split.groupBy("sketch").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y").select("sketch")
    left = checkpointed(split.join(open_, "sketch"))
    labs = labelled_texts(left.select("rep", "t").distinct(), docs, id_col, text_col)
    more = cross_links(left, labs, limit, tile)
    comp = _joined(checkpointed(done.unionByName(more)))
    # Every class with its component; a row belongs to its own class.
    classes = reps.select("k1", "k2", "rep", "t").join(comp, ["rep", "t"], "left").withColumn("component", F.coalesce("component", own))
    classes = classes.select("k1", "k2", "rep", F.col("t").alias("rep_t"), F.col("component.i").alias("component_id"), (F.col("component") == own).alias("leads"))
    out = d.select("doc_id", "t", "k1", "k2").join(classes, ["k1", "k2"], "left")
    known, leads = F.col("doc_id").isNotNull(), F.col("leads") & (F.col("doc_id") == F.col("rep")) & F.col("t").eqNullSafe(F.col("rep_t"))
    return out.select(
        "doc_id", "t", F.when(known, F.col("rep")).alias("class_id"), F.when(known, F.col("component_id")).alias("component_id"),
        (~known | F.coalesce(leads, F.lit(False))).alias("kept"),
    )


def _pairs(df: DataFrame, least: int = 1) -> DataFrame:
    """Pairs ``a, ta, b, tb`` named ``least`` times or more, smaller id first."""
    x, y = F.struct(F.col("a").alias("i"), F.col("ta").alias("h")), F.struct(F.col("b").alias("i"), F.col("tb").alias("h"))
    p = df.groupBy(F.least(x, y).alias("p"), F.greatest(x, y).alias("q")).agg(F.count(F.lit(1)).alias("k")).filter(F.col("k") >= least)
    return p.select(F.col("p.i").alias("a"), F.col("p.h").alias("ta"), F.col("q.i").alias("b"), F.col("q.h").alias("tb"))


def op3_order_minhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("t")


def neardup_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each component stays, with all its columns.

    Rows are matched by id and text: an id's texts of other components stay, and
    of rows with the same id and text one.
    """
    found = checkpointed(near_duplicates(docs))
    gone = found.filter("not kept").select(F.col("doc_id").alias("_id"), F.col("t").alias("_h")).distinct()
    keyed = docs.withColumn("_t", F.xxhash64(F.col("text").cast("string")))
    out = keyed.join(gone, (F.col("doc_id") == F.col("_id")) & (F.col("_t") == F.col("_h")), "left_anti")
    if found.filter("kept and doc_id is not null").groupBy("doc_id", "t").count().filter("count > 1").isEmpty():
        return out.select(*docs.columns)
    null = F.col("doc_id").isNull()
    return out.filter(~null).dropDuplicates(["doc_id", "_t"]).unionByName(out.filter(null)).select(*docs.columns)
