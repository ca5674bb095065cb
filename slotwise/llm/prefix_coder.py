"""Forward dynamic programme over prefixes of a word, for merge-based vocabularies.

A merge tokenizer's encoding is the only segmentation in which every two
neighbouring tokens encode to themselves when joined. So each prefix of a word
has exactly one possible last token, and the state of a prefix (that token's
length and the number of tokens so far) follows from the states of shorter
prefixes. States depend on the prefix alone: words visited in sorted order
share the states of their common prefix with the word before, which is a
depth-first walk of the trie of all words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import ahocorasick

PAIR_MEMO = 150_000  # remembered neighbour tests; forgotten together when full


class Memo:
    """A bounded memo in two generations: what is used again survives, the rest goes."""

    def __init__(self, size: int):
        self.size = size
        self.now: dict = {}
        self.old: dict = {}

    def missing(self, keys: set[str]) -> list[str]:
        """The keys to be computed, sorted; known ones are in ``now`` afterwards."""
        if len(self.now) > self.size:
            self.now, self.old = {}, self.now
        now, old, out = self.now, self.old, []
        for k in keys.difference(now):
            if k in old:
                now[k] = old[k]
            else:
                out.append(k)
        out.sort()
        return out


class PrefixCoder:
    """``vocab``: ids of the tokens, strings over base symbols (one symbol a character).

    ``rank(a, b)``: priority of merging neighbours ``a`` and ``b`` (lower first),
    or None if they don't merge. A symbol outside the vocabulary stands alone.
    """

    def __init__(self, vocab: dict[str, int], rank: Callable[[str, str], float | None]):
        self.vocab = vocab
        self.rank = rank
        self.longest = max(map(len, self.vocab), default=1)
        # lists the tokens that end at each position of a word, the longest first
        self.tokens = ahocorasick.Automaton()
        for t in self.vocab:
            self.tokens.add_word(t, len(t))
        self.tokens.make_automaton()
        self._fits: dict[tuple[str, str], bool] = {}
        self._whole: dict[str, bool] = {}

    def merged(self, text: str) -> list[str]:
        """Plain merging, lowest rank first and leftmost among equals; for short texts."""
        parts = list(text)
        rank = self.rank
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = rank(parts[i], parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _fit(self, a: str, b: str) -> bool:
        if len(self._fits) > PAIR_MEMO:
            self._fits.clear()
        ok = self._fits[a, b] = self.merged(a + b) == [a, b]
        return ok

    def _self(self, a: str) -> bool:
        if len(self._whole) > PAIR_MEMO:
            self._whole.clear()
        ok = self._whole[a] = self.merged(a) == [a]
        return ok

    def walk(self, words: Iterable[str]) -> Iterator[tuple[str, list[int], list[int], list[int | None]]]:
        """For sorted words: (word, last, count, token), lists by prefix length.

        ``last[i]`` is the length of the last token of the prefix of length i,
        ``token[i]`` its id (None outside the vocabulary) and ``count[i]`` the
        number of tokens. The lists are reused: read them before asking for the
        next word.
        """
        vocab, fits, whole, ends = self.vocab, self._fits, self._whole, self.tokens.iter if self.vocab else lambda word: ()
        before, last, count, token = "", [0], [0], [None]
        for word in words:
            n, k = len(word), 0
            most = min(n, len(before))
            if word[:most] == before[:most]:
                k = most
            else:
                while word[k] == before[k]:
                    k += 1
            del last[k + 1 :], count[k + 1 :], token[k + 1 :]
            done = k  # prefixes whose last token is known
            for end, t in ends(word):
                i = end + 1
                if i <= done:
                    continue
                j = i - t
                if t > 1:
                    right = word[j:i]
                    if j == 0:
                        ok = whole.get(right)
                        if ok is None:
                            ok = self._self(right)
                    else:
                        if j > done:  # a symbol outside the vocabulary came before
                            self._alone(word, done, j, last, count, token)
                            done = j
                        left = word[j - last[j] : j]
                        ok = fits.get((left, right))
                        if ok is None:
                            ok = self._fit(left, right)
                    if not ok:
                        continue
                if j > done or i - 1 > done:
                    self._alone(word, done, i - 1, last, count, token)
                last.append(t)
                token.append(vocab[word[j:i]])
                count.append(count[j] + 1)
                done = i
            if done < n:
                self._alone(word, done, n, last, count, token)
            before = word
            yield word, last, count, token

    def _alone(self, word: str, done: int, until: int, last: list, count: list, token: list) -> None:
        """Prefixes at whose end no longer token fits: the symbol itself is their last token."""
        for i in range(done + 1, until + 1):
            last.append(1)
            token.append(self.vocab.get(word[i - 1]))
            count.append(count[i - 1] + 1)
