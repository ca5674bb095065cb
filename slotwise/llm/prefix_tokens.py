"""Exact token counts at every prefix of a text.

For each document the operator stores, per code point, by how much the token
count of the prefix ending there differs from the one before. Their running sum
answers "how many tokens do the first n characters have" and "how much of the
text fits in a budget" without encoding anything again. The counts come from
the forward programme of :mod:`prefix_coder`, run once for every distinct
pre-token a worker meets.

Defined cases: a null text counts as empty (0 bytes, 0 tokens, empty prefix
table); the added token's string inside a text counts one token, as the
library does by default; rows are independent, so repeated rows and null ids
give a row each; other columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import map_arrow, table, vocabulary
from slotwise.llm.prefix_coder import Memo, PrefixCoder

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 512  # fixed by the query contract
CACHE = 300_000  # distinct pre-tokens per generation of a worker's memo
KEEP = 64  # longer pre-tokens are computed each time
GROUP_CHARS = 2_000_000  # characters handled at once

# Letters and digits of the common Latin range; texts with anything else are
# split by the tokenizer library itself, whose Unicode tables decide.
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_SIMPLE = re.compile("[\\t-\\r -~¡-±´-¸º-»¿-ɏ‐-‧‰-⁞€]*\\Z").match
_SPLIT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[^\s{_LETTERS}0-9]+|\s+(?!\S)|\s+").findall
# Fixed value (of the public tokenizers): the split that _SPLIT does for such texts.
COMMON_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_BLANK = "\\t-\\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"  # Unicode's White_Space
_RUN = re.compile(f"[{_BLANK}]{{2,}}(?=[^{_BLANK}])").finditer
_PAIR = ("'re", "'ve", "'ll")  # of the library's split pattern; cut short, they fall into two pre-tokens


def split_common(text: str) -> list[str] | None:
    """Pre-tokens of a text of common characters; None for any other text."""
    return _SPLIT(text) if _SIMPLE(text) else None


def _byte_alphabet() -> dict[str, str]:
    """The byte-level alphabet's characters to characters of the same byte value."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): chr(b) for b in plain} | {chr(256 + k): chr(b) for k, b in enumerate(rest)}


class PrefixCounter:
    def __init__(self, path: str = TOKENIZER):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        spec = json.load(open(vocabulary(path), encoding="utf-8"))
        back = str.maketrans(_byte_alphabet())
        ranks = {tuple(x.translate(back) for x in (m.split(" ") if isinstance(m, str) else m)): k for k, m in enumerate(spec["model"]["merges"])}
        added = [t["content"] for t in spec["added_tokens"]]
        self.coder = PrefixCoder({t.translate(back): i for t, i in spec["model"]["vocab"].items() if t not in added}, lambda a, b: ranks.get((a, b)))
        self.added = re.compile("(" + "|".join(map(re.escape, added)) + ")") if added else None
        self.library = Tokenizer.from_file(vocabulary(path))
        self.cache = Memo(CACHE)

    def split(self, text: str) -> list[str]:
        if _SIMPLE(text):
            return _SPLIT(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def learn(self, tokens: set[str]) -> list[str]:
        """Remember the count changes per code point of the pre-tokens (bytes of int8).

        Returns the long ones, to be forgotten after use.
        """
        new = self.cache.missing(tokens)
        by_bytes = {t.encode("utf-8").decode("latin-1"): t for t in new}
        for word, _, count, _ in self.coder.walk(sorted(by_bytes)):
            t = by_bytes[word]
            c = count
            if len(t) < len(word):
                c = [0, *(count[i] for i in accumulate(len(x.encode("utf-8")) for x in t))]
            elif t in _PAIR:
                c = [0, 1, 2, count[3]]
            self.cache.now[t] = bytes([(y - x) & 255 for x, y in zip(c, c[1:])])
        return [t for t in new if len(t) > KEEP]

    def changes(self, texts: list[str]) -> list[np.ndarray]:
        """Per text an int8 array: change of the token count at each code point."""
        parts: list[list[str]] = []
        for t in texts:
            if self.added and self.added.search(t):
                p = self.added.split(t)  # text, token, text, ...
                # an added token counts only once it is complete; until then it is plain text
                parts.append([x + p[2 * i + 1][:-1] if 2 * i + 1 < len(p) else x for i, x in enumerate(p[::2])])
            else:
                parts.append([t])
        split = [[self.split(x) for x in p] for p in parts]
        runs = [[[m.group() for m in _RUN(x)] for x in p] for p in parts]
        every = set()
        for p, r in zip(split, runs):
            every.update(*p, *r)
        long = self.learn(every)
        get, out = self.cache.now.__getitem__, []
        for t, p, s, r in zip(texts, parts, split, runs):
            done = []
            for k, (x, tokens) in enumerate(zip(p, s)):
                d = np.frombuffer(b"".join(map(get, tokens)), np.int8)
                if r[k]:
                    d = self._blanks(x, d, get)
                if k < len(p) - 1:
                    token = self.added.split(t)[2 * k + 1]
                    base = int(d[: len(x) - len(token) + 1].sum(dtype=np.int64))
                    d = np.append(d, np.int8(base + 1 - int(d.sum(dtype=np.int64))))
                done.append(d)
            out.append(done[0] if len(done) == 1 else np.concatenate(done))
        for t in long:
            del self.cache.now[t]
        return out

    @staticmethod
    def _blanks(text: str, d: np.ndarray, get) -> np.ndarray:
        """A prefix that ends with a run of blanks has the run in one pre-token."""
        d = d.copy()
        for m in _RUN(text):
            run, end = m.group(), m.end()
            whole = np.frombuffer(get(run), np.int8).sum(dtype=np.int64)
            more = whole - d[m.start() : end].sum(dtype=np.int64)
            d[end - 1] += more
            d[end] -= more
        return d


@lru_cache(maxsize=2)
def _counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def tokens_at(changes: bytes, n_chars: int) -> int:
    """Tokens of the first ``n_chars`` characters."""
    return int(np.frombuffer(changes, np.int8)[:n_chars].sum(dtype=np.int64))


def fitting_prefix(changes: bytes, budget: int) -> int:
    """Length of the longest prefix of at most ``budget`` tokens."""
    fits = np.flatnonzero(np.cumsum(np.frombuffer(changes, np.int8), dtype=np.int64) <= budget)
    return int(fits[-1]) + 1 if len(fits) else 0


def grouped(texts: Iterable[str], most: int = GROUP_CHARS) -> Iterator[list[str]]:
    group, n = [], 0
    for t in texts:
        group.append(t)
        n += len(t)
        if n > most:
            yield group
            group, n = [], 0
    if group:
        yield group


def prefix_token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = LIMIT, path: str = TOKENIZER) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, fit_chars, prefix_changes`` per input row.

    ``prefix_changes`` is the prefix table (see :func:`tokens_at` and
    :func:`fitting_prefix`); ``fit_chars`` the longest prefix within ``budget``.
    Rows are independent: a map without shuffle, memory bounded by
    ``GROUP_CHARS`` and ``CACHE``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path)
        for batch in batches:
            ids, at = batch.column(0), 0
            for texts in grouped(t.as_py() or "" for t in batch.column(1)):
                ch = counter.changes(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(at, len(texts)),
                        pa.array([len(t.encode("utf-8")) for t in texts], pa.int64()),
                        pa.array([int(c.sum(dtype=np.int64)) for c in ch], pa.int64()),
                        pa.array([fitting_prefix(c, budget) for c in ch], pa.int64()),
                        pa.array([c.tobytes() for c in ch], pa.binary()),
                    ],
                    names=["doc_id", "n_bytes", "n_tokens", "fit_chars", "prefix_changes"],
                )
                at += len(texts)

    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = d.schema["doc_id"].dataType.simpleString()
    return map_arrow(d, run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, fit_chars bigint, prefix_changes binary")


def op6_prefix_token_counts(spark, sf_dir: str) -> DataFrame:
    p = prefix_token_counts(table(spark, sf_dir, "documents"))
    return p.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"), "fit_chars")
