"""Problem 1: the language of every text and of every segment of mixed texts.

Method: prediction by partial matching (``ppm``). The trees are counted on the
trusted ``language_samples`` only, a table that does not grow. A text is cut
into sentences; quoted spans and fenced code take no part, so a quoted phrase
never makes a text multilingual, but for a line that is nothing but a quotation of
several sentences. The languages of the sentences are the path
with the shortest total code, where every change of language costs
``SWITCH_BITS``. A segment is a longest run of sentences in one language.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataloom.llm.ppm import LanguageCoder
from strataloom.llm.text import in_parts, language_of_label, words
from strataloom.sources.tables import table

#: Bits that a change of language costs.
SWITCH_BITS = 24.0
#: Sentences with fewer words count as part of a segment, not as full sentences.
FULL_WORDS = 4
#: Full sentences a language needs in a multilingual text.
FULL_SENTENCES = 2
#: Letters below which a text has no language.
LEAST_LETTERS = 6

_CODE = re.compile(r"```.*?(?:```|\Z)|`[^`\n]*`", re.S)
_QUOTED = re.compile(r"“[^”\n]*”|«[^»\n]*»|„[^“”\n]*[“”]|\"[^\"\n]*\"|‘[^’\n]*’")
_END = re.compile(r"[.!?…\n][\"'”’»)\]\s]*")

BRIEF = "language string, confidence double, languages array<string>"
LABELLED = "language string, confidence double, languages array<string>, segments array<struct<start:int,end:int,language:string,confidence:double>>"


@lru_cache(maxsize=2)
def coder_of(samples: tuple[tuple[str, str], ...]) -> LanguageCoder:
    """One coder per Python worker and set of samples."""
    return LanguageCoder(samples)


def read_samples(spark: SparkSession, folder: str) -> tuple[tuple[str, str], ...]:
    """The trusted samples: a table of fixed size."""
    rows = table(spark, folder, "language_samples").select("sample_id", "lang", "text").where("lang is not null and text is not null")
    return tuple((r.lang, r.text) for r in sorted(rows.collect(), key=lambda r: (r.sample_id, r.lang, r.text)))


def _blank(match: re.Match) -> str:
    return " " * len(match[0])


def _phrase(match: re.Match) -> str:
    """Blanks for a quoted phrase; a line that is all one quotation of several sentences is no phrase."""
    text, (start, end) = match.string, match.span()
    alone = not text[text.rfind("\n", 0, start) + 1 : start].strip() and not text[end : end + 1 + (text + "\n").find("\n", end) - end].strip()
    return match[0] if alone and len(_END.findall(match[0][:-1])) >= FULL_SENTENCES else " " * len(match[0])


def unquoted(text: str) -> str:
    """A text with blanks in place of fenced code and quoted phrases, of the same length."""
    if "`" in text:
        text = _CODE.sub(_blank, text)
    if any(mark in text for mark in "“«„\"‘"):
        text = _QUOTED.sub(_phrase, text)
    return text


def spans_of(text: str) -> list[tuple[int, int]]:
    """Start and end of every non-blank sentence."""
    spans, start = [], 0
    for match in _END.finditer(text):
        end = match.end()
        if text[end - 1].isspace():
            spans.append((start, end))
            start = end
    if start < len(text) and not text[start:].isspace():
        spans.append((start, len(text)))
    return spans


def shortest_path(costs: np.ndarray) -> list[int]:
    """The language of each sentence on the path of the least total cost."""
    best, back = costs[0].copy(), []
    for row in costs[1:]:
        away = int(best.argmin())
        move = best[away] + SWITCH_BITS < best
        back.append(np.where(move, away, np.arange(len(best))))
        best = np.where(move, best[away] + SWITCH_BITS, best) + row
    path = [int(best.argmin())]
    for step in reversed(back):
        path.append(int(step[path[-1]]))
    return path[::-1]


def _sure(costs: np.ndarray, at: int) -> float:
    """The share of the likelihood that falls on language ``at``."""
    return float(1 / np.exp2(-np.clip(costs - costs[at], -60, 200)).sum())


def label_texts(texts: list[str | None], coder: LanguageCoder) -> list[tuple]:
    """(language, confidence, languages, segments) of each text.

    ``languages`` holds the main language, or every language with enough full
    sentences when there are several. A text without letters, empty or null has
    a null language, confidence 0 and no segments. Ties go to the language whose
    code comes first.
    """
    parts: list[list[str]] = []
    spans: list[tuple[int, int]] = []
    sizes = []
    for text in texts:
        before = len(parts)
        if text:
            plain = unquoted(text)
            for span in spans_of(plain):
                found = words(plain[slice(*span)])
                if found:
                    parts.append(found)
                    spans.append(span)
        sizes.append(len(parts) - before)
    out: list[tuple] = [(None, 0.0, [], [])] * len(texts)
    costs, letters = coder.costs(parts)
    some = np.flatnonzero(sizes)
    if not len(some):
        return out
    ends = np.cumsum(sizes)[some]
    starts = ends - np.array(sizes)[some]
    totals = np.add.reduceat(costs, starts, axis=0)
    mains = totals.argmin(axis=1)
    own = totals[np.arange(len(some)), mains]
    sure = 1 / np.exp2(-np.clip(totals - own[:, None], -60, 200)).sum(axis=1)
    # no change of language can pay where all that there is to gain is less than one change costs
    gain = own - np.add.reduceat(costs.min(axis=1), starts)
    long = np.add.reduceat(letters, starts) >= LEAST_LETTERS
    for at, first, end, main, confidence, more, enough in zip(*(v.tolist() for v in (some, starts, ends, mains, sure, gain, long))):
        if not enough:
            continue
        main_language = coder.languages[main]
        if end - first == 1 or more <= SWITCH_BITS:
            out[at] = (main_language, confidence, [main_language], [(spans[first][0], spans[end - 1][1], main_language, confidence)])
            continue
        mine = costs[first:end]
        path = shortest_path(mine)
        full: dict[int, int] = {}
        for i, language in enumerate(path):
            if len(parts[first + i]) >= FULL_WORDS:
                full[language] = full.get(language, 0) + 1
        several = sorted(language for language, k in full.items() if k >= FULL_SENTENCES)
        segments, start = [], 0
        for i in range(1, len(path) + 1):
            if i == len(path) or path[i] != path[start]:
                segments.append((spans[first + start][0], spans[first + i - 1][1], coder.languages[path[start]], _sure(mine[start:i].sum(axis=0), path[start])))
                start = i
        out[at] = (main_language, confidence, [coder.languages[language] for language in (several if len(several) > 1 else [main])], segments)
    return out


def labeller(samples: tuple[tuple[str, str], ...], segments: bool = True):
    """A pandas UDF from a text to the struct ``LABELLED``, or to ``BRIEF`` without the segments."""

    @F.pandas_udf(LABELLED if segments else BRIEF)
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        coder = coder_of(samples)
        for texts in batches:
            rows: list[tuple] = []
            for part in in_parts([texts]):
                rows += label_texts(list(part), coder) if segments else [row[:3] for row in label_texts(list(part), coder)]
            yield pd.DataFrame(rows, columns=["language", "confidence", "languages", "segments"][: 4 if segments else 3])

    return label


def named_language(label: Column) -> Column:
    """The language that a label names in any spelling, else null."""

    @F.pandas_udf("string")
    def named(labels: pd.Series) -> pd.Series:
        known = {x: language_of_label(x) for x in labels.dropna().unique()}
        return pd.Series([known.get(x) for x in labels], dtype=object)

    return named(label)


def detect(df: DataFrame, text: str, samples: tuple[tuple[str, str], ...], into: str = "detected", segments: bool = True) -> DataFrame:
    """``df`` with a struct column ``into``: language, confidence, languages and segments of ``text``.

    All other columns stay as they are. A clashing column ``into`` is replaced.
    """
    return df.withColumn(into, labeller(samples, segments)(F.col(f"`{text}`")))


def label_cases(df: DataFrame, label: str, detected: Column) -> Column:
    """Whether a label is missing or names another language than the text has, or the text has several languages."""
    named = named_language(F.col(f"`{label}`").cast("string"))
    return detected["language"].isNotNull() & (named.isNull() | (named != detected["language"]) | (F.size(detected["languages"]) > 1))
