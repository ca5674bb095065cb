"""Secret scans: pattern rules plus a character convolutional network.

The base patterns give spans of three kinds. A candidate is any further long
run of key characters with a digit or mixed case; the network (numpy, inside
the tasks) reads the candidate with its surrounding context and adds it as a
span of kind ``cnn`` if its calibrated probability reaches the threshold: the
highest that keeps ``RECALL`` of the labelled findings set aside for it. The
share of the other candidates there that it flags stands beside it.

Labels: base spans are findings and candidates outside them are not. Every
distinct window of all documents is used: a quarter, by hash, is set aside, and
the network is fitted on the others in rounds, block by block on Spark, the
blocks' networks averaged after each round. Calibration, threshold and recall
come from the counts of all windows set aside, by score. Half of the findings
lose their keyword, so the network must read the characters too.

Defined cases: a null text counts as empty (no spans, the digest of the empty
string); repeated rows and null ids each give a row; fewer than ``MIN_LABELS``
findings or others in the whole table: base spans only; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import checkpointed, map_arrow, table

# Fixed by the query contract.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # maximal runs, so the length may stand in the pattern
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "cnn")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
SHAPE = re.compile(r"[0-9]|[a-z][A-Z].*[a-z][A-Z]")
CONTEXT = 24  # characters on either side
BODY = 48  # characters of the candidate itself: all of it if shorter, else both ends
BLOCK = 2000  # windows a block of the training has, about
ROUNDS, EPOCHS = 3, 4  # the blocks' networks are averaged after so many epochs
BINS = 64  # scores are counted by parts of 1 / BINS ...
LIMIT = 64  # ... between -LIMIT and LIMIT
MIN_LABELS = 30
RECALL = 0.95
WIDTH, FILTERS = 5, 24

_CLASSES = ["abcdef", "ghijklmnopqrstuvwxyz", "ABCDEF", "GHIJKLMNOPQRSTUVWXYZ", "0123456789", "+/", "=", "_-", ".", "\"'", " \t", "\n", ":", "@", "\x00"]
_CODE = {c: k for k, s in enumerate(_CLASSES) for c in s}
_N = len(_CLASSES) + 2  # other characters, and "inside the candidate"


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base patterns, by start, then kind as listed."""
    out = []
    low = text.lower()
    if "passw" in low or "secret" in low or "token" in low or "api" in low:
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def candidates(text: str, spans: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """Further runs of key characters, none overlapping a base span."""
    out = []
    for m in CANDIDATE.finditer(text):
        a, b = m.span()
        if SHAPE.search(m[0]) and not any(s < b and a < e for s, e, _ in spans):
            out.append((a, b))
    return out


def window(text: str, a: int, b: int) -> str:
    """Left context, candidate, right context; of fixed length, padded with NUL."""
    body = text[a:b] if b - a <= BODY else text[a : a + BODY // 2] + text[b - BODY // 2 : b]
    left, right = text[max(0, a - CONTEXT) : a], text[b : b + CONTEXT]
    return left.rjust(CONTEXT, "\0") + body.ljust(BODY, "\0") + right.ljust(CONTEXT, "\0")


def encoded(windows: list[str]) -> np.ndarray:
    """One-hot character classes plus the mark of the candidate's own characters."""
    codes = np.array([[_CODE.get(c, _N - 2) for c in w] for w in windows], np.int64).reshape(len(windows), 2 * CONTEXT + BODY)
    x = np.eye(_N, dtype=np.float32)[codes]
    x[:, CONTEXT : CONTEXT + BODY, _N - 1] = (codes[:, CONTEXT : CONTEXT + BODY] != _CODE["\0"]).astype(np.float32)
    return x


@dataclass
class CharNet:
    """Convolution, rectifier, max and mean pooling, logistic output."""

    kernel: np.ndarray  # (WIDTH * _N, FILTERS)
    offset: np.ndarray
    out: np.ndarray  # (2 * FILTERS + 1)
    scale: tuple[float, float] = (1.0, 0.0)
    threshold: float = 2.0
    recall: float = 0.0  # share of the findings set aside that reach the threshold ...
    false_share: float = 0.0  # ... and of the other candidates

    def _forward(self, x: np.ndarray):
        u = np.lib.stride_tricks.sliding_window_view(x, WIDTH, axis=1).transpose(0, 1, 3, 2).reshape(len(x), x.shape[1] - WIDTH + 1, -1)
        h = np.maximum(u @ self.kernel + self.offset, 0)
        f = np.concatenate([h.max(1), h.mean(1), np.ones((len(x), 1), np.float32)], 1)
        return u, h, f

    def probability(self, windows: list[str]) -> np.ndarray:
        if not windows:
            return np.zeros(0)
        z = self._forward(encoded(windows))[2] @ self.out
        return 1 / (1 + np.exp(-np.clip(self.scale[0] * z + self.scale[1], -30, 30)))


def _new(seed: int = 5) -> CharNet:
    kernel = np.random.default_rng(seed).normal(0, 0.2, (WIDTH * _N, FILTERS)).astype(np.float32)
    return CharNet(kernel, np.zeros(FILTERS, np.float32), np.zeros(2 * FILTERS + 1, np.float32))


def _without_keyword(window: str) -> str:
    return "\0" * CONTEXT + window[CONTEXT:]


def fitted(net: CharNet, windows: list[str], y: np.ndarray, weights: tuple[float, float], epochs: int, seed: int) -> CharNet:
    """The network after some epochs over the windows (Adam); ``weights`` of label 0 and 1."""
    rng = np.random.default_rng(seed)
    params = [net.kernel.copy(), net.offset.copy(), net.out.copy()]
    net = CharNet(*params)
    m, v, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    weight = np.where(y > 0, weights[1], weights[0]).astype(np.float32)
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(len(windows)), max(1, len(windows) // 64)):
            u, h, f = net._forward(encoded([windows[k] for k in rows]))
            p = 1 / (1 + np.exp(-np.clip(f @ net.out, -30, 30)))
            d = (p - y[rows]) * weight[rows] / len(rows)
            g_out = f.T @ d
            top = d[:, None] * net.out[:FILTERS]
            g_h = np.repeat((d[:, None] * net.out[FILTERS : 2 * FILTERS] / h.shape[1])[:, None, :], h.shape[1], 1)
            np.put_along_axis(g_h, h.argmax(1)[:, None, :], np.take_along_axis(g_h, h.argmax(1)[:, None, :], 1) + top[:, None, :], 1)
            g_h *= h > 0
            grads = [np.tensordot(u, g_h, ([0, 1], [0, 1])), g_h.sum((0, 1)), g_out]
            t += 1
            for k, g in enumerate(grads):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                params[k] -= (3e-3 * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
    return net


def score_bins(net: CharNet, windows: list[str]) -> np.ndarray:
    """Bin of each window's raw score: [bin / BINS, (bin + 1) / BINS)."""
    z = np.concatenate([net._forward(encoded(windows[k : k + 500]))[2] @ net.out for k in range(0, len(windows), 500)])
    return np.clip(np.floor(z.astype(np.float64) * BINS), -LIMIT * BINS, LIMIT * BINS).astype(np.int64)


def calibrated(net: CharNet, bins: np.ndarray, y: np.ndarray, n: np.ndarray) -> CharNet:
    """Scale, threshold and recall from ``n`` windows a bin and label: the windows set aside."""
    z, share = (bins + 0.5) / BINS, n / n.sum()
    a, b = 1.0, 0.0
    sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
    for _ in range(200):  # Platt scaling
        d = (sigmoid(z) - y) * share
        a, b = a - 0.05 * float((d * z).sum()), b - 0.05 * float(d.sum())
    net.scale = (float(a), float(b))
    if (n * (y == 1)).sum() and (n * (y == 0)).sum():
        least = np.minimum(sigmoid(bins / BINS), sigmoid((bins + 1) / BINS))  # of any window in the bin
        order = np.argsort(least, kind="stable")
        upto = np.cumsum((n * (y == 1))[order])
        net.threshold = float(least[order][np.searchsorted(upto, np.floor((1 - RECALL) * (upto[-1] - 1)), side="right")])
        net.recall, net.false_share = (float(n[(y == k) & (least >= net.threshold)].sum() / n[y == k].sum()) for k in (1, 0))
    return net


def _weights(found: int, other: int) -> tuple[float, float]:
    """Both labels weigh the same together."""
    return (found + other) / (2 * max(other, 1)), (found + other) / (2 * max(found, 1))


def train(found: list[str], other: list[str], seed: int = 5) -> CharNet:
    """Fit on three quarters of the given windows; calibrate and set the threshold on the rest."""
    net = _new(seed)
    if min(len(found), len(other)) < MIN_LABELS:
        return net
    windows = [w if k % 2 else _without_keyword(w) for k, w in enumerate(found)] + other
    y = np.array([1.0] * len(found) + [0.0] * len(other), np.float32)
    order = np.random.default_rng(seed).permutation(len(windows))
    used, held = np.split(order, [len(order) * 3 // 4])
    net = fitted(net, [windows[k] for k in used], y[used], _weights(len(found), len(other)), ROUNDS * EPOCHS, seed)
    return calibrated(net, score_bins(net, [windows[k] for k in held]), y[held], np.ones(len(held)))


def labelled_windows(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``w, y``: every distinct window of the documents, 1 for findings."""
    d = docs.select(F.col(text_col).cast("string").alias("text")).filter("text is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            rows = set()
            for text in batch.column(0).to_pylist():
                spans = base_spans(text)
                rows |= {(window(text, s, e), 1) for s, e in {_body(text, s, e, k) for s, e, k in spans}}
                rows |= {(window(text, s, e), 0) for s, e in candidates(text, spans)}
            arrays = [pa.array([w for w, _ in rows], pa.string()), pa.array([y for _, y in rows], pa.int32())]
            yield pa.RecordBatch.from_arrays(arrays, names=["w", "y"])

    return map_arrow(d, run, "w string, y int").distinct()


def train_on(docs: DataFrame, text_col: str = "text", labels: int | None = None) -> CharNet:
    """Train on every distinct window of the documents, or with ``labels`` on so many a class (smallest hashes).

    Whatever the partitions, a window falls into the same block and the sums of a
    round are whole numbers, so equal documents give equal networks.
    """
    w = labelled_windows(docs, text_col).withColumn("h", F.xxhash64("w"))
    if labels is not None:
        w = checkpointed(w)
        w = reduce(DataFrame.unionByName, [w.filter(F.col("y") == y).orderBy("h", "w").limit(labels) for y in (1, 0)])
    held, part = F.pmod(F.shiftright("h", 1), F.lit(4)) == 0, F.shiftright("h", 3)
    hidden = (F.col("y") == 1) & (F.pmod("h", F.lit(2)) == 0)
    bare = F.concat(F.lit("\0" * CONTEXT), F.substring("w", CONTEXT + 1, BODY + CONTEXT))
    w = checkpointed(w.select("h", "y", F.when(hidden, bare).otherwise(F.col("w")).alias("w"), held.alias("held"), part.alias("part")))
    n = {(r["y"], r["held"]): r["count"] for r in w.groupBy("y", "held").count().collect()}
    net, total = _new(), [n.get((y, False), 0) + n.get((y, True), 0) for y in (0, 1)]
    if min(total) < MIN_LABELS:
        return net
    weights = _weights(total[1], total[0])
    blocks = max(1, (n.get((0, False), 0) + n.get((1, False), 0)) // BLOCK)
    used = w.filter(~F.col("held")).withColumn("block", F.pmod("part", F.lit(blocks))).repartition(blocks, "block")
    for k in range(ROUNDS):
        net = _round(used, net, weights, k)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            if len(b):
                yield pa.RecordBatch.from_arrays([pa.array(score_bins(net, b.column(0).to_pylist())), b.column(1)], names=["bin", "y"])

    counts = map_arrow(w.filter("held").select("w", "y"), score, "bin bigint, y int").groupBy("bin", "y").count().orderBy("bin", "y").collect()
    columns = [np.array([r[c] for r in counts]) for c in ("bin", "y", "count")]
    return calibrated(net, *columns) if counts else net


def _round(used: DataFrame, net: CharNet, weights: tuple[float, float], k: int) -> CharNet:
    """One round: every block goes on from the network, and their parameters are averaged."""
    shapes = [p.shape for p in (net.kernel, net.offset, net.out)]
    fixed = 2.0**32

    def fit(block: pa.Table) -> pa.Table:
        block = block.sort_by([("h", "ascending"), ("w", "ascending")])
        y = block["y"].to_numpy().astype(np.float32)
        got = fitted(net, block["w"].to_pylist(), y, weights, EPOCHS, k)
        flat = np.concatenate([p.ravel() for p in (got.kernel, got.offset, got.out)]).astype(np.float64)
        return pa.table({"place": pa.array(range(len(flat)), pa.int32()), "value": pa.array(np.rint(flat * fixed).astype(np.int64))})

    found = used.groupBy("block").applyInArrow(fit, "place int, value bigint")
    rows = found.groupBy("place").agg(F.sum("value").alias("s"), F.count("value").alias("n")).orderBy("place").collect()
    if not rows:
        return net
    flat = np.array([r["s"] / r["n"] for r in rows]) / fixed
    cuts = np.cumsum([int(np.prod(s)) for s in shapes])[:-1]
    return CharNet(*[p.reshape(s).astype(np.float32) for p, s in zip(np.split(flat, cuts), shapes)])


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in smaller parts, so few texts are unpacked at once."""
    for b in batches:
        for s in range(0, len(b), rows):
            yield b.slice(s, rows)


def _body(text: str, start: int, end: int, kind: str) -> tuple[int, int]:
    """The secret itself, without an assignment's keyword."""
    if kind == "assign":
        return ASSIGN.match(text, start).span(2)
    return start, end


def all_spans(texts: list[str], net: CharNet) -> list[list[tuple[int, int, str]]]:
    spans = [base_spans(t) for t in texts]
    if net.threshold <= 1:
        found = [(k, a, b) for k, t in enumerate(texts) for a, b in candidates(t, spans[k])]
        p = net.probability([window(texts[k], a, b) for k, a, b in found])
        for (k, a, b), x in zip(found, p):
            if x >= net.threshold:
                spans[k].append((a, b, "cnn"))
    return [sorted(s, key=lambda x: (x[0], KINDS.index(x[2]))) for s in spans]


def scan_secrets(docs: DataFrame, net: CharNet, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, spans`` per input row: array of (kind, start, end), code points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in sliced(batches):
            spans = all_spans([t or "" for t in batch.column(1).to_pylist()], net)
            rows = [[{"kind": k, "start": a, "end": b} for a, b, k in s] for s in spans]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], names=["doc_id", "spans"])

    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = d.schema["doc_id"].dataType.simpleString()
    return map_arrow(d, run, f"doc_id {kind}, spans array<struct<kind: string, start: bigint, end: bigint>>")


def op5_secret_scan(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    s = scan_secrets(docs, train_on(docs))
    n = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("bigint")
    joined = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    return s.select(
        "doc_id",
        n("assign").alias("n_assign"),
        n("access").alias("n_access"),
        n("hex").alias("n_hex"),
        F.sha2(joined(F.filter("spans", lambda x: x["kind"] != "cnn")), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def redacted(text: str, spans: list[tuple[int, int, str]], by: str = "[SECRET]") -> str:
    out, at = [], 0
    for a, b, _ in spans:
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], by]
        at = b
    return "".join([*out, text[at:]])


def secrets_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every span is replaced by ``[SECRET]``; ``n_chars`` follows."""
    net = train_on(docs)
    cols = docs.columns
    at = cols.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = batch.column(at).to_pylist()
            spans = all_spans([t or "" for t in texts], net)
            new = [redacted(t, s) if s else t for t, s in zip(texts, spans)]
            arrays = list(batch.columns)
            arrays[at] = pa.array(new, batch.schema.field(at).type)
            if "n_chars" in cols:
                k = cols.index("n_chars")
                arrays[k] = pa.array([len(n) if s else c for n, s, c in zip(new, spans, arrays[k].to_pylist())], batch.schema.field(k).type)
            yield pa.RecordBatch.from_arrays(arrays, schema=batch.schema)

    return map_arrow(docs, run, docs.schema)
