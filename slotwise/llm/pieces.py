"""SentencePiece encoding and decoding by a shared-prefix forward search.

A text is cut into marked words (a run of word markers and the characters up to
the next marker). The distinct words are sorted, which lists the leaves of
their trie depth-first, and the forward states of a common prefix are computed
once. For unigram vocabularies a state is the best score (Viterbi); for merge
vocabularies, whose scores are merge ranks and not probabilities, the best-score
path is not what the library returns, so the forward step of
:mod:`prefix_coder` takes its place: same trie, same traversal, exact result.

Defined cases: a null or empty text has no ids and decodes to the empty text;
characters outside the vocabulary become byte pieces; a literal marker character
counts as a blank; rows are independent, so repeated rows and null ids give a
row each; other columns are kept by the general operator.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotwise.llm.common import map_arrow, table, vocabulary
from slotwise.llm.prefix_coder import Memo, PrefixCoder
from slotwise.llm.prefix_tokens import grouped

MODEL = "piece_bpe_32k.model"
CACHE = 300_000  # distinct words per generation of a worker's memo
GROUP = 500_000  # characters handled at once
KEEP = 64  # longer words are computed each time
MARK = "▁"  # the library's word marker


class PieceCodec:
    def __init__(self, path: str = MODEL, memo: int = CACHE):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=vocabulary(path))
        size = sp.get_piece_size()
        self.ids, scores, self.byte = {}, {}, {}
        self.surface = [b""] * size
        for i in range(size):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte[int(piece[1:-1], 16)] = i
                self.surface[i] = bytes([int(piece[1:-1], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.ids[piece] = i
                scores[piece] = sp.get_score(i)
                self.surface[i] = piece.replace(MARK, " ").encode("utf-8")
        self.unknown = sp.unk_id()
        self.surface[self.unknown] = " ⁇ ".encode()
        # Merge models score their pieces by rank, in whole numbers; unigram models by log probability.
        self.merges = all(s == int(s) for s in scores.values())
        self.scores = scores
        get = scores.get
        self.coder = PrefixCoder(self.ids, lambda a, b: -s if (s := get(a + b)) is not None else None)
        # A character that is in no longer piece never merges: words end there.
        joined = {c for p in scores if len(p) > 1 for c in p}
        alone = "".join(c for c in "\n\t\r" if c not in joined)
        inner = any(MARK in p.lstrip(MARK) for p in scores)
        rest = re.escape(alone)
        self.words = (lambda t: [t]) if inner else re.compile(f"{MARK}*[^{MARK}{rest}]+|{MARK}+" + (f"|[{rest}]" if rest else "")).findall
        self.cache = Memo(memo)

    def _ids(self, word: str, last: list[int], token: list[int | None]) -> bytes:
        """The word's ids, traced back from its end."""
        out, i = [], len(word)
        while i:
            x = token[i]
            if x is not None:
                out.append(x)
            elif self.byte:
                out.extend(self.byte[b] for b in reversed(word[i - 1].encode("utf-8")))
            else:
                out.append(self.unknown)
            i -= last[i]
        out.reverse()
        return array("i", out).tobytes()

    def _viterbi(self, words: list[str]) -> Iterator[tuple[str, list[int], list[int | None]]]:
        """Best-score segmentation; forward scores shared along the trie."""
        scores, longest = self.scores, self.coder.longest
        low = min(scores.values(), default=0.0) - 10.0  # the library's score of an unknown character
        before, best, last, token = "", [0.0], [0], [None]
        for word in words:
            k = 0
            while k < min(len(word), len(before)) and word[k] == before[k]:
                k += 1
            del best[k + 1 :], last[k + 1 :], token[k + 1 :]
            for i in range(k + 1, len(word) + 1):
                top, length = best[i - 1] + scores.get(word[i - 1], low), 1
                for t in range(2, min(i, longest) + 1):
                    s = scores.get(word[i - t : i])
                    if s is not None and best[i - t] + s > top:
                        top, length = best[i - t] + s, t
                best.append(top)
                last.append(length)
                token.append(self.ids.get(word[i - length : i]))
            before = word
            yield word, last, token

    def learn(self, words: set[str]) -> list[str]:
        """Remember the ids of the words; returns the long ones, to be forgotten after use."""
        new = self.cache.missing(words)
        walk = ((w, last, token) for w, last, _, token in self.coder.walk(new)) if self.merges else self._viterbi(new)
        for w, last, token in walk:
            self.cache.now[w] = self._ids(w, last, token)
        return [w for w in new if len(w) > KEEP]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        split = [self.words(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        long = self.learn(set().union(*split))
        get = self.cache.now.__getitem__
        out = [np.frombuffer(b"".join(map(get, w)), np.int32) for w in split]
        for w in long:
            del self.cache.now[w]
        return out

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join([self.surface[i] for i in ids.tolist()]).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


@lru_cache(maxsize=2)
def _codec(path: str, memo: int = CACHE) -> PieceCodec:
    return PieceCodec(path, memo)


def code_pieces(df: DataFrame, text_col: str = "text", ids_col: str = "piece_ids", decoded_col: str | None = None, path: str = MODEL, memo: int = CACHE) -> DataFrame:
    """``df`` with the ids of ``text_col`` added (or replaced) as ``array<int>``.

    With ``decoded_col`` also the text that the ids decode to. A map without
    shuffle; a result batch holds ``GROUP`` characters of text at most (or one
    document), however long the input batches are; a worker remembers up to
    twice ``memo`` words.
    """
    new = [c for c in (ids_col, decoded_col) if c]
    cols = [c for c in df.columns if c not in new]
    out = df.select(*[F.col(f"`{c}`") for c in cols])
    at = cols.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path, memo)
        for batch in batches:
            done = 0
            for texts in grouped((t.as_py() or "" for t in batch.column(at)), GROUP):
                ids = codec.encode(texts)
                ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                arrays = [*batch.slice(done, len(texts)).columns, pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))]
                if decoded_col:
                    arrays.append(pa.array([codec.decode(x) for x in ids], pa.string()))
                yield pa.RecordBatch.from_arrays(arrays, names=[*cols, *new])
                done += len(texts)

    fields = [T.StructField(ids_col, T.ArrayType(T.IntegerType()))] + [T.StructField(c, T.StringType()) for c in new[1:]]
    return map_arrow(out, run, T.StructType([*out.schema.fields, *fields]))


def decode_pieces(df: DataFrame, ids_col: str = "piece_ids", decoded_col: str = "decoded", path: str = MODEL) -> DataFrame:
    """``df`` with the text of ``ids_col`` added (or replaced) as ``decoded_col``."""
    cols = [c for c in df.columns if c != decoded_col]
    out = df.select(*[F.col(f"`{c}`") for c in cols])
    at = cols.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path)
        for batch in batches:
            for s in range(0, len(batch), 500):
                part = batch.slice(s, 500)
                texts = [codec.decode(np.array(x.as_py() or [], np.int32)) for x in part.column(at)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*cols, decoded_col])

    return map_arrow(out, run, T.StructType([*out.schema.fields, T.StructField(decoded_col, T.StringType())]))


def op9_sentencepiece(spark, sf_dir: str) -> DataFrame:
    """Ids of every document, and whether they decode to its text again."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    d = code_pieces(d, decoded_col="decoded")
    back = F.col("decoded") == F.replace("text", F.lit(MARK), F.lit(" "))
    return d.select("doc_id", F.size("piece_ids").cast("bigint").alias("n_pieces"), "piece_ids", back.alias("round_trip"))


def pieces_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage (last): every document with its piece ids; workers of earlier stages hold memory too."""
    return code_pieces(docs, memo=100_000)
