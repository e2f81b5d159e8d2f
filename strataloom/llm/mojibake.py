"""Problem 10: texts garbled by a wrong character encoding, and their restoration.

Method: every adjacent pair of characters is scored by the mutual information
that it has over the whole corpus. A character's surprise after its neighbour is
its self-information less that mutual information; improbable runs are the
maximal scoring segments of surprise above ``SURPRISE``. The inverse of every
known misreading is tried inside those runs only, and taken where it shortens
the description of the run. A replacement character inside a word is garbled
text that nothing can restore.

A run that is no more than the content of quotation marks, without a blank and
at least half of it beyond ASCII, is a quotation of such characters, and a
character that stands alone is a sign: neither makes a text garbled.

Only words with a character beyond ASCII can be in a garbled run, and words
recur. So a task scores every such word once, and looks for runs in the texts
alone that hold a word with an improbable pair which a misreading would explain. The table of pairs goes to all
tasks where it is small; a larger one is joined with blocks of texts instead.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataloom.llm.text import in_parts
from strataloom.session import durable

#: Bits of surprise that a pair in a run must exceed on average.
SURPRISE = 9.0
#: Bits by which a restoration must shorten a run.
GAIN = 6.0
#: Entries of the pair table up to which it is sent to the tasks (16 bytes each);
#: a larger one is joined with blocks of about ``BLOCK`` texts, with the same result.
PAIRS, BLOCK = 1_000_000, 2000

#: Fixed values: (read as, was) of the misreadings that are tried.
MISREADINGS = [(read, was) for was in ("utf-8", "cp1252", "cp850", "cp437", "mac_roman") for read in ("cp1252", "cp437", "cp850", "mac_roman", "cp1251", "cp1250", "iso8859_15", "latin-1") if read != was]
_CHUNK = re.compile(r"[^\x00-\x7f]+")
_QUOTED = re.compile(r"(?<![^\s(])[“«„\"'‘`]([^\s“”«»„\"'‘’`]+)[”»“\"'’`]")
_LOST = re.compile("\\w\ufffd|\ufffd\\w")
_TOKEN = re.compile(r"[^ \t\r\n]+")
_BREAK = re.compile(r"[\t\r\n]")

FOUND = "garbled boolean, restored string, misreading string, runs int"


def code_points(text: str) -> np.ndarray:
    """The characters of a text as numbers; lone surrogates count as replacement characters."""
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(np.int64)


def pair_counts(df: DataFrame, text: str) -> DataFrame:
    """``pair long, n long``: how often each pair of adjacent characters occurs
    in all texts. Blanks of any kind count as one character and begin each text."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        plain, keys, sizes = np.zeros(128 * 128, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in in_parts(batches):
            texts = [t for t in batch["text"] if t]
            if not texts:
                continue
            flat = code_points(" " + " ".join(texts))
            flat[flat <= 32] = 32
            a, b = flat[:-1], flat[1:]
            ascii_ = (a | b) < 128
            plain += np.bincount(a[ascii_] << 7 | b[ascii_], minlength=len(plain))
            other = ~ascii_
            new, n = np.unique(a[other] << 21 | b[other], return_counts=True)
            keys, inverse = np.unique(np.concatenate([keys, new]), return_inverse=True)
            sizes = np.bincount(inverse, np.concatenate([sizes, n]), len(keys)).astype(np.int64)
        at = np.flatnonzero(plain)
        yield pd.DataFrame({"pair": np.concatenate([at >> 7 << 21 | at & 127, keys]), "n": np.concatenate([plain[at], sizes])})

    rows = df.select(F.col(f"`{text}`").cast("string").alias("text")).mapInPandas(count, "pair long, n long")
    return rows.groupBy("pair").agg(F.sum("n").alias("n"))


class PairModel:
    """Mutual information of adjacent characters, from frozen counts.

    ``marginals`` has the characters with their counts as left and as right
    neighbours; without it they are those of the pairs given.
    """

    def __init__(self, pairs: np.ndarray, counts: np.ndarray, marginals: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None) -> None:
        order = np.argsort(pairs)
        self.pairs, counts = pairs[order], counts[order].astype(float)
        left, right = self.pairs >> 21, self.pairs & (1 << 21) - 1
        if marginals is None:
            chars = np.unique(np.concatenate([left, right]))
            marginals = chars, np.bincount(np.searchsorted(chars, left), counts, len(chars)), np.bincount(np.searchsorted(chars, right), counts, len(chars))
        chars, n_left, n_right = marginals
        self.total = float(n_right.sum()) or 1.0
        # mutual information of the pair; log2 p(a, b) / (p(a) p(b))
        at, to = np.searchsorted(chars, left), np.searchsorted(chars, right)
        self.information = np.log2(counts * self.total / np.maximum(n_left[at] * n_right[to], 1e-9)) if len(counts) else counts
        self.right = chars[n_right > 0]
        self.self_information = -np.log2(np.maximum(n_right[n_right > 0], 0.5) / self.total)
        self.unseen = np.log2(2 * self.total)
        self.readings: dict[str, list] = {}
        self.words: dict[str, bool] = {}
        self.ascii = np.array([self._surprise(np.full(128, a), np.arange(128)) for a in range(128)])

    def look_up(self, words: list[str]) -> None:
        """Note in ``words`` for each of the words given whether it may be garbled: it has a character of more than
        ``SURPRISE`` bits, and is shorter to describe without a misreading or has lost a character."""
        new = list(set(words).difference(self.words))
        if new:
            flat = code_points(" " + " ".join(new) + " ")
            flat[flat <= 32] = 32
            starts = np.cumsum([0, *(len(w) + 1 for w in new[:-1])])
            self.words.update(dict.fromkeys(new, False))
            for at in np.flatnonzero(np.maximum.reduceat(self.surprise(flat), starts) > SURPRISE).tolist():
                word = new[at]
                self.words[word] = bool(_LOST.search(word)) or any(self.bits(word) - self.bits(back) > 1 for back in _undone(word, self).values())

    def _surprise(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.full(len(a), self.unseen)
        if not len(self.pairs):
            return out
        key = a << 21 | b
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        seen = self.pairs[at] == key
        to = np.searchsorted(self.right, b[seen])
        out[seen] = self.self_information[to] - self.information[at[seen]]
        # an unseen pair: half a count beside its left neighbour, and no knowledge of the character itself
        right = np.minimum(np.searchsorted(self.right, b), len(self.right) - 1)
        known = ~seen & (self.right[right] == b)
        out[known] = self.self_information[right[known]] + 3
        return out

    def surprise(self, flat: np.ndarray) -> np.ndarray:
        """Surprise in bits of every character after its left neighbour."""
        a, b = flat[:-1], flat[1:]
        plain = (a < 128) & (b < 128)
        out = np.empty(len(a))
        out[plain] = self.ascii[a[plain], b[plain]]
        out[~plain] = self._surprise(a[~plain], b[~plain])
        return out

    def rarity(self, text: str) -> tuple[float, float]:
        """Self-information of the characters beyond ASCII: of all, and of the rarest."""
        flat = code_points(text)
        flat = flat[flat > 127]
        if not len(flat) or not len(self.right):
            return 0.0, 0.0
        at = np.minimum(np.searchsorted(self.right, flat), len(self.right) - 1)
        bits = np.where(self.right[at] == flat, self.self_information[at], self.unseen)
        return float(bits.sum()), float(bits.max())

    def bits(self, text: str) -> float:
        """Description length of a text between blanks."""
        flat = code_points(f" {text} ")
        flat[flat <= 32] = 32
        return float(self.surprise(flat).sum())


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int]]:
    """All maximal scoring segments (start, end) of an array of scores, in linear time."""
    totals = np.concatenate([[0.0], np.cumsum(scores)])
    stack: list[tuple[float, float, int, int]] = []  # total before, total after, start, end
    for i in np.flatnonzero(scores > 0).tolist():
        segment = (totals[i], totals[i + 1], i, i + 1)
        while True:
            k = len(stack) - 1
            while k >= 0 and stack[k][0] >= segment[0]:
                k -= 1
            if k < 0 or stack[k][1] >= segment[1]:
                stack.append(segment)
                break
            segment = (stack[k][0], segment[1], stack[k][2], segment[3])
            del stack[k:]
    return [(start, end) for _, _, start, end in stack]


def _bytes_of(chunk: str, read: str) -> bytes:
    out = bytearray()
    for ch in chunk:
        try:
            out += ch.encode(read)
        except UnicodeEncodeError:
            if ord(ch) < 0xA0 and read.startswith("cp125"):  # bytes that this encoding leaves undefined
                out.append(ord(ch))
            else:
                raise
    return bytes(out)


def undo(token: str, read: str, was: str) -> str | None:
    """``token`` as it was before bytes in ``was`` were read as ``read``; null if that can't have been."""
    try:
        return _CHUNK.sub(lambda m: _bytes_of(m[0], read).decode(was), token)
    except (UnicodeDecodeError, UnicodeEncodeError):
        return None


def _readings(chunk: str, model: PairModel) -> list[tuple[str, float] | None]:
    """For each misreading, the characters a chunk was before it, or before a
    doubled one, and how much more usual they are; null where it can't have been,
    and where one of them is rarer than all there are."""
    out, (rarity, rarest) = [], model.rarity(chunk)
    for read, was in MISREADINGS:
        back = undo(chunk, read, was)
        if back is not None and was == "utf-8" and not back.isascii():
            again = undo(back, read, was)
            if again and again != back and model.rarity(again)[0] < model.rarity(back)[0]:
                back = again
        if back is None or back == chunk or any(0x7F <= ord(ch) < 0xA0 for ch in back):
            out.append(None)
        else:
            usual, most = model.rarity(back)
            out.append((back, rarity - usual) if most <= rarest else None)
    return out


def _undone(token: str, model: PairModel) -> dict[int, str]:
    """By misreading, ``token`` without it, where that leaves more usual characters."""
    memo = model.readings
    if len(memo) > 100_000:  # bounds the memory, never changes a result
        memo.clear()
    chunks, out = _CHUNK.findall(token), {}
    for chunk in chunks:
        if chunk not in memo:
            memo[chunk] = _readings(chunk, model)
    for at in range(len(MISREADINGS)):
        back = [memo[chunk][at] for chunk in chunks]
        if None not in back and sum(gain for _, gain in back) > 0:
            taken = iter(back)
            out[at] = _CHUNK.sub(lambda m: next(taken)[0], token)
    return out


def _inside(text: str, start: int, end: int) -> bool:
    """Whether an unusual character stands beside a letter."""
    part = text[max(0, start - 1) : end + 1]
    return bool(re.search(r"[A-Za-zæøåäöüßéíóáñ][^\x00-\x7f]|[^\x00-\x7f][A-Za-z]", part))


def repair(text: str | None, model: PairModel) -> tuple[bool, str | None, str | None, int]:
    """(garbled, restored text, misreadings, runs) of a text.

    The restored text is null where the text isn't garbled and where nothing can
    restore it. What one misreading leaves garbled is tried once more, so a text
    may be restored from two. Null, empty and plain ASCII texts are not garbled.
    """
    garbled, restored, misreading, runs = _repair(text, model)
    if restored is not None:
        _, again, other, more = _repair(restored, model)
        if again is not None:
            return garbled, again, f"{misreading}, {other}", runs + more
    return garbled, restored, misreading, runs


def _repair(text: str | None, model: PairModel) -> tuple[bool, str | None, str | None, int]:
    if not text or text.isascii():
        return False, None, None, 0
    flat = code_points(" " + text)
    flat[flat <= 32] = 32
    surprise = model.surprise(flat)
    quoted = [m.span(1) for m in _QUOTED.finditer(text) if not m[1].isascii() and len(_CHUNK.findall(m[1])) and sum(len(c) for c in _CHUNK.findall(m[1])) * 2 >= len(m[1])]
    tokens: dict[tuple[int, int], None] = {}
    segments = maximal_segments(surprise - SURPRISE)
    if not segments:
        return False, None, None, 0
    spans = [m.span() for m in _TOKEN.finditer(text)]
    ends = [end for _, end in spans]
    for start, end in segments:
        k = bisect_right(ends, start)
        while k < len(spans) and spans[k][0] < end:
            tokens[spans[k]] = None
            k += 1
    odd = []
    for start, end in tokens:
        if any(a >= start and b <= end for a, b in quoted) or text[start:end].isascii():
            continue
        odd.append((start, end))
    if not odd:
        return False, None, None, 0
    gains: dict[int, float] = {}
    done: dict[int, int] = {}
    inside: set[int] = set()
    for a, b in odd:
        token = text[a:b]
        for at, back in _undone(token, model).items():
            gain = model.bits(token) - model.bits(back)
            if gain > 1:
                gains[at] = gains.get(at, 0.0) + gain
                done[at] = done.get(at, 0) + 1
                if MISREADINGS[at][1] == "utf-8" or len(token) > 1 and _inside(text, a, b):
                    inside.add(at)
    best = max((at for at in gains if at in inside and gains[at] >= GAIN), key=lambda at: (round(gains[at], 6), -at), default=None)
    if best is not None:
        out, last = [], 0
        for m in _TOKEN.finditer(text):
            if not m[0].isascii() and not any(x >= m.start() and y <= m.end() for x, y in quoted):
                back = _undone(m[0], model).get(best)
                if back is not None:
                    out += [text[last : m.start()], back]
                    last = m.end()
        restored = "".join(out) + text[last:]
        read, was = MISREADINGS[best]
        return True, None if "\ufffd" in restored else restored, f"{was} read as {read}", done[best]
    lost = [(a, b) for a, b in odd if _LOST.search(text[a:b])]
    if lost:
        return True, None, None, len(lost)
    return False, None, None, 0


def garbled(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each record whose text is at least partly garbled.

    Columns: ``key``, ``restored`` (null where it can't be restored),
    ``misreading`` and ``runs``. The pair counts cover all texts. Null and empty
    texts are not garbled; repeated keys give repeated rows; an empty table gives
    no rows.
    """
    kind = dict(df.dtypes)[key]
    pairs = durable(pair_counts(df, text))
    left, right = F.shiftright("pair", 21), F.col("pair").bitwiseAND(F.lit((1 << 21) - 1))
    sides = pairs.select(F.explode(F.array(F.struct(left.alias("c"), F.col("n").alias("l"), F.lit(0).cast("long").alias("r")), F.struct(right.alias("c"), F.lit(0).cast("long").alias("l"), F.col("n").alias("r")))).alias("s"))
    chars = sides.groupBy("s.c").agg(F.sum("s.l").alias("l"), F.sum("s.r").alias("r")).orderBy("c").toPandas()  # at most all characters there are
    marginals = tuple(chars[c].to_numpy(np.int64 if c == "c" else float) for c in ("c", "l", "r"))
    odd = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text")).where(F.col("text").rlike(r"[^\x00-\x7F]"))
    schema = f"key {kind}, restored string, misreading string, runs int"
    if pairs.count() <= PAIRS:
        table = pairs.toPandas()
        shared = df.sparkSession.sparkContext.broadcast(PairModel(table["pair"].to_numpy(np.int64), table["n"].to_numpy(np.int64), marginals))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            model = shared.value
            for batch in in_parts(batches):
                yield repairs(batch, model)

        found = odd.mapInPandas(run, schema)
    else:
        found = joined_repairs(odd, pairs, marginals, schema)
    return found.withColumnRenamed("key", key)


def repairs(batch: pd.DataFrame, model: PairModel) -> pd.DataFrame:
    """The garbled ones of the texts ``key, text``."""
    if len(model.words) > 500_000:  # bounds the memory, never changes a result
        model.words.clear()
    words = [[w for w in _BREAK.sub(" ", t).split(" ") if not w.isascii()] for t in batch["text"]]
    model.look_up([w for some in words for w in some])
    known, rows = model.words, []
    for k, t, some in zip(batch["key"], batch["text"], words):
        if any(map(known.__getitem__, some)):
            is_, restored, misreading, runs = repair(t, model)
            if is_:
                rows.append((k, restored, misreading, runs))
    return pd.DataFrame(rows, columns=["key", "restored", "misreading", "runs"])


def pairs_wanted(text: str) -> np.ndarray:
    """All pairs that ``repair`` may ask for: those of a text, and of what its characters
    beyond ASCII, with a neighbour on each side, may have been before four misreadings."""
    padded = f" {text} "
    seen = level = {padded[m.start() - 1 : m.end() + 1] for m in _CHUNK.finditer(padded)}
    for _ in range(4):  # two repairs, each of a misreading or a doubled one
        level = {back for part in level for read, was in MISREADINGS if (back := undo(part, read, was)) is not None} - seen
        seen = seen | level
    flat = code_points("\n".join([padded, *seen, *(f" {m[0]} " for part in seen for m in _TOKEN.finditer(part))]))
    flat[flat <= 32] = 32
    return np.unique(flat[:-1] << 21 | flat[1:])


def joined_repairs(odd: DataFrame, pairs: DataFrame, marginals: tuple, schema: str) -> DataFrame:
    """The repairs by a model of their own for each block of texts, which has the counts of just the pairs it may ask for."""
    shared = odd.sparkSession.sparkContext.broadcast(marginals)
    blocks = max(1, odd.count() // BLOCK)
    placed = odd.withColumn("block", F.pmod(F.xxhash64("key", "text"), F.lit(blocks)))

    def want(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in in_parts(batches, 100):
            for block, part in batch.groupby("block"):
                yield pd.DataFrame({"block": block, "pair": np.unique(np.concatenate([pairs_wanted(t) for t in part["text"]]))})

    wanted = placed.select("block", "text").mapInPandas(want, "block long, pair long").distinct().join(pairs, "pair")

    def mend(texts: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        return repairs(texts, PairModel(counts["pair"].to_numpy(np.int64), counts["n"].to_numpy(np.int64), shared.value))

    return placed.groupBy("block").cogroup(wanted.groupBy("block")).applyInPandas(mend, schema)
