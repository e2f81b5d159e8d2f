"""Prediction by partial matching over the bytes of words.

One variable-order context tree per language is counted on trusted texts and
then frozen. A word costs the exact code length in bits that the tree gives to
its bytes and to the blank that ends it: an unseen symbol pays the escape of
its context (method C: distinct symbols over total plus distinct) and is coded
one order lower without the symbols already excluded, down to a uniform choice.
Contexts start at the blank before the word, so the cost of a word does not
depend on its neighbours and may be kept.
"""

from __future__ import annotations

from collections.abc import Iterable
from math import log2

import numpy as np

from strataloom.llm.text import words


class ContextTree:
    """A frozen context tree of one language."""

    def __init__(self, texts: Iterable[str], order: int = 5) -> None:
        self.order = order
        counts: dict[bytes, dict[int, int]] = {}
        for text in texts:
            for word in words(text):
                if word.isdigit():
                    continue
                data = b" " + word.encode() + b" "
                for at in range(1, len(data)):
                    for length in range(min(order, at) + 1):
                        seen = counts.setdefault(data[at - length : at], {})
                        seen[data[at]] = seen.get(data[at], 0) + 1
        self.counts = {context: (seen, sum(seen.values())) for context, seen in counts.items()}

    def bits(self, context: bytes, symbol: int) -> float:
        """Code length of one symbol after a context of at most ``order`` bytes."""
        total, excluded = 0.0, None
        for start in range(len(context) + 1):
            node = self.counts.get(context[start:])
            if node is None:
                continue
            seen, n = node
            if excluded:
                seen = {s: c for s, c in seen.items() if s not in excluded}
                n = sum(seen.values())
                if not seen:
                    continue
            count = seen.get(symbol)
            if count:
                return total - log2(count / (n + len(seen)))
            total -= log2(len(seen) / (n + len(seen)))
            excluded = excluded | seen.keys() if excluded else set(seen)
        return total + log2(256 - len(excluded or ()))


class LanguageCoder:
    """The trees of several languages, with the costs of words kept."""

    def __init__(self, samples: Iterable[tuple[str, str]], order: int = 5) -> None:
        by: dict[str, list[str]] = {}
        for language, text in samples:
            by.setdefault(language, []).append(text)
        self.order = order
        self.languages = sorted(by)
        self.trees = [ContextTree(by[language], order) for language in self.languages]
        self._forget()

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.grams: dict[bytes, np.ndarray] = {}
        self.rows = np.zeros((1024, len(self.languages) + 1), np.float64)

    def word_bits(self, word: str) -> np.ndarray:
        """Code lengths of a word and of the blank after it, by language."""
        data, total, grams = b" " + word.encode() + b" ", np.zeros(len(self.languages)), self.grams
        for at in range(1, len(data)):
            gram = data[max(0, at - self.order) : at + 1]
            bits = grams.get(gram)
            if bits is None:
                bits = grams[gram] = np.array([tree.bits(gram[:-1], gram[-1]) for tree in self.trees])
            total += bits
        return total

    def rows_of(self, tokens: list[str], keep: int = 400_000) -> np.ndarray:
        """Indexes of the cost rows of ``tokens``; numbers cost nothing. ``keep``
        bounds the memory of kept words; it never changes a cost."""
        if len(self.index) > keep:
            self._forget()
        index = self.index
        for token in set(tokens).difference(index):
            at = index[token] = len(index)
            if at >= len(self.rows):
                self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
            if not token.isdigit():
                self.rows[at, :-1] = self.word_bits(token)
                self.rows[at, -1] = len(token)
        return np.fromiter(map(index.__getitem__, tokens), np.int64, len(tokens))

    def costs(self, parts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Code lengths of token lists, a row per list and a column per
        language, and the letters of each list."""
        flat = [token for part in parts for token in part]
        out = np.zeros((len(parts), len(self.languages) + 1))
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        if flat:
            picked = self.rows_of(flat)
            full = np.flatnonzero(sizes)
            starts = (np.cumsum(sizes) - sizes)[full]
            out[full] = np.add.reduceat(self.rows[picked], starts, axis=0)
        return out[:, :-1], out[:, -1]
