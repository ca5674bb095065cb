"""Toxic spans by a linear-chain conditional random field.

Every token gets one of two tags (clean, toxic). Emissions are sums of weights
of hashed character features of the token, transitions a 2 x 2 table. With two
tags the forward and the backward pass are recursions of one log-ratio per
token, and their sum is the logit of the token's marginal. A document's score is
a calibrated function of its tokens' marginals; tokens with a marginal of one
half or more are its offending spans.

Training: a bounded sample of labelled documents (``SAMPLE`` per class, whole
texts of at most ``SAMPLE_CHARS`` characters). Labels are per document, so
tokens are labelled first: a token of a toxic document is toxic if one of its
features occurs in enough toxic documents of the sample and almost never in
clean ones. One part of the sample fits the field, the other the calibration.

Defined cases: a null text counts as empty; an empty text has no tokens and
scores the calibrated base rate; a null id counts as the empty string for the
held-out split; repeated rows each get a row; with no toxic (or no clean)
labelled document every score is the labelled rate; other columns are ignored.
"""

from __future__ import annotations

import itertools
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import WORD, map_arrow, table
from slotwise.llm.prefix_tokens import grouped

SAMPLE = 3000  # labelled documents per class, about
SAMPLE_CHARS = 8000
FOLDS = 5  # fixed by the query contract; fold 0 is held out
BITS = 18
WINDOW = 24  # tokens of a training sequence, at most
MIN_DOCS = 4  # toxic documents a feature must occur in to label tokens, more where chance gives as many
PURITY = 0.9
CHANCE = 0.05
FLAG = 0.5
CACHE = 200_000

_words = re.compile(WORD)
_core = re.compile(r"[\W_]+")


def features(token: str) -> list[str]:
    """Character features of a token; the form itself, its beginnings and endings."""
    return _features_of(_core_of(token))


def _core_of(token: str) -> str:
    t = token.lower()
    return t if t.isalnum() else _core.sub("", t)


def _features_of(t: str) -> list[str]:
    out = ["=" + t]
    out += [f"^{t[:k]}" for k in (3, 4, 5, 6) if len(t) >= k]
    out += [f"{t[-k:]}$" for k in (3, 5) if len(t) > k]
    return out


def _hashed(feats: list[str]) -> list[int]:
    return [zlib.crc32(f.encode("utf-8")) & ((1 << BITS) - 1) for f in feats]


_FORM, _BEGIN = zlib.crc32(b"="), zlib.crc32(b"^")


def _add_hashes(t: str, out: list[int]) -> int:
    """Appends the hashes of ``_features_of(t)``, all bits, in order; how many.

    A beginning's hash goes on from the one before it.
    """
    if not t.isascii():
        feats = _features_of(t)
        out.extend(zlib.crc32(f.encode("utf-8")) for f in feats)
        return len(feats)
    crc, b, n = zlib.crc32, t.encode(), len(t)
    out.append(crc(b, _FORM))
    if n < 3:
        return 1
    out.append(h := crc(b[:3], _BEGIN))
    if n == 3:
        return 2
    for k in range(3, min(n, 6)):
        out.append(h := crc(b[k : k + 1], h))
    out.append(crc(b"$", crc(b[-3:])))
    if n == 4 or n == 5:
        return n
    out.append(crc(b"$", crc(b[-5:])))
    return 7


@dataclass
class Field:
    """Weights of the field and of the document calibration."""

    weights: np.ndarray
    bias: float
    trans: np.ndarray  # log potentials [from, to]
    calibration: np.ndarray  # of 1, highest marginal logit, log of expected toxic tokens
    rate: float
    trained: bool = True

    def emission(self, token: str) -> float:
        return self.bias + float(self.weights[_hashed(features(token))].sum())

    def emissions(self, tokens: list[str]) -> np.ndarray:
        """``emission`` of each token; weights are added in the same order, tokens of one core form once."""
        cores = [_core_of(t) for t in tokens]
        place = {c: k for k, c in enumerate(dict.fromkeys(cores))}
        found: list[int] = []
        n = np.fromiter((_add_hashes(c, found) for c in place), np.int64, len(place))
        weights = self.weights[np.array(found, np.int64) & ((1 << BITS) - 1)]
        first, total = np.cumsum(n) - n, np.zeros(len(n), self.weights.dtype)
        for k in range(n.max(initial=0)):
            on = np.flatnonzero(n > k)
            total[on] += weights[first[on] + k]
        return (self.bias + total.astype(np.float64))[np.fromiter(map(place.__getitem__, cores), np.int64, len(cores))]

    def marginals(self, emissions: list[np.ndarray]) -> list[np.ndarray]:
        """Marginal logits of toxic; documents advance together, longest first.

        Step ``t`` takes the token ``t`` from the beginning forward and the one ``t``
        from the end backward: both passes are the same recursion with the
        transitions turned round, so one loop runs them as two rows.
        """
        lengths = np.array([len(e) for e in emissions], np.int64)
        if not lengths.sum():
            return [np.zeros(0) for _ in emissions]
        order = np.argsort(-lengths, kind="stable")
        active = np.searchsorted(-lengths[order], -np.arange(lengths.max()), side="left")  # documents longer than t
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        ends, offsets = np.cumsum(lengths), np.cumsum(active) - active
        # Where a token's step and document lie when tokens are laid out by steps.
        t = np.arange(ends[-1]) - np.repeat(ends - lengths, lengths)
        rank, turned = np.repeat(rank, lengths), np.repeat(lengths, lengths) - 1 - t
        at = np.array([offsets[t] + rank, offsets[turned] + rank])
        flat = np.concatenate(emissions)
        given, state, odds = np.empty(at.shape), np.empty(at.shape), np.zeros(at.shape)
        given[0, at[0]], given[1, at[1]] = flat, flat
        a, b, c, d = np.exp(self.trans).ravel()  # 00 01 10 11
        over, under = np.array([[b], [c]]), np.array([[c], [b]])
        before = given[:, :0]
        for o, n in zip(offsets.tolist(), active.tolist()):
            now = state[:, o : o + n]
            if o:
                x = np.exp(before[:, :n])
                ratio = odds[:, o : o + n]
                np.log((over + d * x) / (a + under * x), out=ratio)
                np.add(given[:, o : o + n], ratio, out=now)
            else:
                now[:] = given[:, :n]
            np.maximum(now, -40, out=now)
            np.minimum(now, 40, out=now)
            before = now
        total = state[0, at[0]] + odds[1, at[1]]
        return [total[e - n : e] for e, n in zip(ends, lengths)]

    def summary(self, logits: np.ndarray) -> tuple[float, float, float]:
        if not len(logits):
            return 1.0, -20.0, np.log(1e-6)
        p = 1 / (1 + np.exp(-np.clip(logits, -20, 20)))
        return 1.0, float(np.clip(logits.max(), -20, 20)), float(np.log(1e-6 + p.sum()))

    def score(self, logits: np.ndarray) -> float:
        if not self.trained:
            return self.rate
        x = float(np.dot(self.calibration, self.summary(logits)))
        return float(1 / (1 + np.exp(-np.clip(x, -30, 30))))


def label_tokens(texts: list[str], toxic: list[int]) -> list[tuple[list[str], np.ndarray]]:
    """Tokens of each text and their 0/1 labels, from document labels."""
    tokens = [_words.findall(t) for t in texts]
    feats = {w: features(w) for w in {w for ts in tokens for w in ts}}
    seen, count, met = (Counter(), Counter()), [0, 0], set()
    for ts, y in zip(tokens, toxic):
        grams = set(zip(ts, ts[1:], ts[2:]))
        if len(grams & met) > 0.3 * len(grams):
            continue  # a near copy of an earlier document is no further evidence
        met |= grams
        count[y] += 1
        seen[y].update({f for w in set(ts) for f in feats[w]})
    n0, n1 = max(1, count[0]), max(1, count[1])
    # So many toxic documents and no clean one must not be likely by chance for any of the features.
    often = sum(k >= MIN_DOCS for k in seen[1].values())
    chance = math.log(max(often, 1) / CHANCE) / math.log((n0 + n1) / n1)
    support = max(MIN_DOCS, chance)
    bad = set()
    for f, k in seen[1].items():
        t, c = k / n1, seen[0][f] / n0
        if k >= support and t / (t + c + 0.2 / n0) >= PURITY:
            bad.add(f)
    is_bad = {w: int(any(f in bad for f in fs)) for w, fs in feats.items()}
    return [(ts, np.array([is_bad[w] if y else 0 for w in ts], np.int8)) for ts, y in zip(tokens, toxic)]


def fit_field(labelled: list[tuple[list[str], np.ndarray]], epochs: int = 12, seed: int = 7) -> tuple[np.ndarray, float, np.ndarray]:
    """Maximum likelihood of the tag sequences by AdaGrad over windows of tokens; shorter ones are padded and masked."""
    rng = np.random.default_rng(seed)
    seqs, tags = [], []
    for ts, y in labelled:
        for s in range(0, len(ts), WINDOW):
            part = y[s : s + WINDOW]
            if part.any() or rng.random() < 0.3:
                seqs.append(ts[s : s + WINDOW])
                tags.append(part)
    w, bias, trans = np.zeros(1 << BITS), -2.0, np.zeros((2, 2))
    if not seqs:
        return w, bias, trans
    ids = {t: k for k, t in enumerate({t for s in seqs for t in s})}
    hashed = [_hashed(features(t)) for t in ids]
    width = max(map(len, hashed))
    table_ = np.full((len(ids) + 1, width), 1 << BITS)  # one slot and one token beyond for padding
    for k, h in enumerate(hashed):
        table_[k, : len(h)] = h
    real = np.arange(WINDOW) < np.array([[len(s)] for s in seqs])
    x, y = np.full(real.shape, len(ids)), np.zeros(real.shape, np.int8)
    x[real], y[real] = [ids[t] for s in seqs for t in s], np.concatenate(tags)
    w = np.zeros((1 << BITS) + 1)
    g_w, g_b, g_t = np.full_like(w, 1e-2), 1e-2, np.full((2, 2), 1e-2)
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(len(x)), max(1, len(x) // 256)):
            xb, yb, on = x[rows], y[rows], real[rows]
            e = bias + w[table_[xb]].sum(2)
            n, m = e.shape
            a = np.zeros((n, m, 2))
            a[:, 0, 1] = e[:, 0]
            for t in range(1, m):
                a[:, t] = np.logaddexp(a[:, t - 1, :1] + trans[0], a[:, t - 1, 1:] + trans[1])
                a[:, t, 1] += e[:, t]
                a[~on[:, t], t] = a[~on[:, t], t - 1]
            z = np.logaddexp(a[:, -1, 0], a[:, -1, 1])
            b = np.zeros((n, m, 2))
            pair = np.zeros((2, 2))
            for t in range(m - 2, -1, -1):
                nxt = b[:, t + 1] + np.stack([np.zeros(n), e[:, t + 1]], 1)
                b[:, t] = np.logaddexp(trans[:, 0] + nxt[:, :1], trans[:, 1] + nxt[:, 1:])
                b[~on[:, t + 1], t] = 0
                pair += np.exp(a[:, t, :, None] + trans + nxt[:, None, :] - z[:, None, None])[on[:, t + 1]].sum(0)
            grad = (yb - np.exp(a[:, :, 1] + b[:, :, 1] - z[:, None])) * on
            np.add.at(pair, (yb[:, :-1][on[:, 1:]], yb[:, 1:][on[:, 1:]]), -1.0)
            step = np.bincount(table_[xb].ravel(), np.repeat(grad.ravel(), width), len(w)) - 1e-3 * w
            step[-1] = 0
            g_w += step**2
            w += 0.3 * step / np.sqrt(g_w)
            g = grad.sum()
            g_b += g**2
            bias += 0.3 * g / np.sqrt(g_b)
            g_t += pair**2
            trans -= 0.1 * pair / np.sqrt(g_t)
            trans -= trans[0, 0]
    return w[:-1], float(bias), trans


def fit(texts: list[str], toxic: list[int], rate: float) -> Field:
    """Field and calibration from labelled texts; ``rate``: toxic share of all labels."""
    if not 0 < sum(toxic) < len(toxic):
        return Field(np.zeros(1 << BITS, np.float32), 0.0, np.zeros((2, 2)), np.zeros(3), rate, False)
    labelled = label_tokens(texts, toxic)
    calibrate = len(toxic) >= 200
    train = [k for k in range(len(texts)) if not calibrate or k % 4]
    held = [k for k in range(len(texts)) if not calibrate or not k % 4]
    w, bias, trans = fit_field([labelled[k] for k in train])
    field = Field(w.astype(np.float32), bias, trans, np.zeros(3), rate)
    emit = {t: field.emission(t) for t in {t for k in held for t in labelled[k][0]}}
    logits = field.marginals([np.array([emit[t] for t in labelled[k][0]]) for k in held])
    x, y = np.array([field.summary(v) for v in logits]), np.array([toxic[k] for k in held], float)
    share = y.mean() if 0 < y.mean() < 1 else 0.5
    weight = np.where(y > 0, rate / share, (1 - rate) / (1 - share))  # the sample is balanced, the labels are not
    c = np.zeros(3)
    for _ in range(50):  # Newton steps of a ridge logistic regression
        p = 1 / (1 + np.exp(-np.clip(x @ c, -30, 30)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(3)
        c += np.linalg.solve(h, x.T @ (weight * (y - p)) - 1e-2 * c)
    field.calibration = c
    return field


def fold(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


def train_field(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> Field:
    """Fit on labelled rows outside the held-out fold."""
    known = labels.filter(F.col(label_col).isin(0, 1) & (fold(F.col(id_col)) != 0)).select(
        F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y"), F.pmod(F.xxhash64(id_col, F.lit("sample")), F.lit(1 << 20)).alias("_r")
    )
    n = {r["_y"]: r["n"] for r in known.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = [min(1.0, sample / max(1, n.get(y, 0))) for y in (0, 1)]
    chosen = known.filter(F.col("_r") < F.when(F.col("_y") == 1, share[1]).otherwise(share[0]) * (1 << 20)).distinct()
    # about 2 * sample rows by construction
    d = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")).filter(F.length("_text") <= SAMPLE_CHARS)
    rows = sorted(d.join(F.broadcast(chosen), "_id").select("_id", "_y", "_text").distinct().collect())
    total = sum(n.values())
    return fit([r["_text"] for r in rows], [r["_y"] for r in rows], n.get(1, 0) / total if total else 0.0)


def score_documents(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score, n_toxic, spans`` per input row; spans as code point offsets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emit: dict[str, float] = {}
        for batch in batches:
            at = 0
            for texts in grouped(t.as_py() or "" for t in batch.column(1)):
                tokens = [_words.findall(t) for t in texts]
                if len(emit) > CACHE:
                    emit.clear()
                new = list(set().union(*tokens) - emit.keys())
                emit.update(zip(new, field.emissions(new).tolist()))
                get = emit.__getitem__
                logits = field.marginals([np.fromiter(map(get, ts), np.float64, len(ts)) for ts in tokens])
                spans = []
                for text, v in zip(texts, logits):
                    bad = np.flatnonzero(v >= np.log(FLAG / (1 - FLAG))) if field.trained else ()
                    if len(bad):
                        where = [m.span() for m in _words.finditer(text)]
                        spans.append([{"start": where[i][0], "end": where[i][1]} for i in bad])
                    else:
                        spans.append([])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(texts)),
                        pa.array([field.score(v) for v in logits], pa.float64()),
                        pa.array([len(s) for s in spans], pa.int64()),
                        pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    ],
                    names=["doc_id", "score", "n_toxic", "spans"],
                )
                at += len(texts)

    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = d.schema["doc_id"].dataType.simpleString()
    return map_arrow(d, run, f"doc_id {kind}, score double, n_toxic bigint, spans array<struct<start: bigint, end: bigint>>")


def op2_toxic_spans(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    s = score_documents(docs, train_field(docs, table(spark, sf_dir, "labels")))
    return s.select(
        "doc_id",
        (fold(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "n_toxic",
        F.transform("spans", lambda x: F.concat_ws(":", x["start"], x["end"])).alias("spans"),
    )
