"""Text primitives shared by the corpus operators."""

from __future__ import annotations

import re

#: A word is a longest run of letters and digits.
WORD = re.compile(r"[^\W_]+")
#: Sentence ends: a closing mark and white space, or a line break. A pattern that begins with few characters is found fast.
SENTENCE = re.compile(r"(?:[.!?…][\"'”’»)\]]*\s|\n)\s*")

#: Spellings of the six languages and of an unknown language.
LANGUAGE_NAMES = {
    "english": "en", "danish": "da", "german": "de", "swedish": "sv", "norwegian": "nb", "spanish": "es",
    "en": "en", "da": "da", "de": "de", "sv": "sv", "nb": "nb", "no": "nb", "es": "es",
    "eng": "en", "dan": "da", "deu": "de", "ger": "de", "swe": "sv", "nob": "nb", "nor": "nb", "spa": "es",
    "norwegian bokmål": "nb", "bokmål": "nb", "castilian": "es",
}
UNKNOWN_LABELS = {"", "und", "unknown", "xx", "none", "null", "n/a", "na", "mul", "zxx", "?", "-"}


#: Texts that a task holds as words at one time.
AT_ONCE = 1000


def in_parts(batches, size: int = AT_ONCE):
    """Arrow batches in parts of at most ``size`` rows, so that a task's memory doesn't follow the length of its batches."""
    for batch in batches:
        for first in range(0, len(batch), size):
            yield batch.iloc[first : first + size]


def words(text: str | None) -> list[str]:
    """The lower-case words of a text; none for null."""
    return WORD.findall(text.lower()) if text else []


def sentences(text: str | None) -> list[str]:
    """The non-blank sentences of a text, in order, without the marks that end them but for the last."""
    return [s for s in SENTENCE.split(text) if s and not s.isspace()] if text else []


def language_of_label(label: str | None) -> str | None:
    """The language a label names in any spelling; null if it names none."""
    if label is None:
        return None
    plain = label.strip().lower()
    if plain in UNKNOWN_LABELS:
        return None
    return LANGUAGE_NAMES.get(plain) or LANGUAGE_NAMES.get(re.split(r"[-_\s]", plain)[0]) or plain
