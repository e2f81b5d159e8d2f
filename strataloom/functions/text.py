"""Column functions over texts: predicates, normalisation, digests and budgets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of any script, as a character class.
BLANK = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: Control characters but for line feed, tab and carriage return.
CONTROL = r"[\x{00}-\x{08}\x{0b}\x{0c}\x{0e}-\x{1f}\x{7f}-\x{9f}]"
#: Words that point to code.
CODE_WORDS = "def|class|function|select|import|const|let"
CODE = rf"```|(?:^|[^A-Za-z0-9_])(?:{CODE_WORDS})(?:$|[^A-Za-z0-9_])|[\{{\}};]{{2,}}"
#: Phrases of generation prompts that must not show in a request.
LEAKS = "generation task|required language|additional requirements|return the user message only|do not mention these instructions"
LEAK = rf"(?:^|[^A-Za-z0-9_])(?:{LEAKS})(?:$|[^A-Za-z0-9_])"
#: Function words that cannot end a finished text.
UNFINISHED = "a af an and at but de den der det eller en er et for har hvis i if is kan med men når of og om or på skal som the til to vil with".split()
#: Characters that may end a finished text.
TERMINAL = ".!?…;:)]}'\"|$`"


def stripped(text: Column) -> Column:
    """``text`` without white space at its ends."""
    return F.regexp_replace(text, rf"^{BLANK}+|{BLANK}+$", "")


def has_control(text: Column) -> Column:
    """Whether there is a control character."""
    return text.rlike(CONTROL)


def looks_like_code(text: Column) -> Column:
    """Whether there is a fence, a code word or a run of braces and semicolons."""
    return F.lower(text).rlike(CODE)


def leaks_prompt(text: Column) -> Column:
    """Whether a phrase of a generation prompt shows."""
    return F.lower(text).rlike(LEAK)


def folded(text: Column) -> Column:
    """The comparison form of a text: case folded, runs of white space as one blank."""
    return F.regexp_replace(stripped(F.replace(F.lower(text), F.lit("ß"), F.lit("ss"))), rf"{BLANK}+", " ")


def digest(text: Column) -> Column:
    """SHA-256 of a text in hexadecimal; its order is the order of the bytes."""
    return F.sha2(F.encode(text, "UTF-8"), 256)


def word_list(text: Column) -> Column:
    """Words of letters, digits and underscores of the folded text."""
    return F.regexp_extract_all(folded(text), F.lit(r"([\p{L}\p{N}_]+)"), 1)


def opening(text: Column, words: int = 6) -> Column:
    """The first words of a text, joined by blanks."""
    return F.array_join(F.slice(word_list(text), 1, words), " ")


def cut_at(text: Column, boundary: str) -> Column:
    """The text before the first boundary, without white space at its ends."""
    return stripped(F.split_part(text, F.lit(boundary), F.lit(1)))


def outer_object(text: Column) -> Column:
    """The outermost JSON object of a text, with or without a fence around it; empty without one."""
    return F.regexp_extract(text, r"(?s)\{.*\}", 0)


def uuid5_url(name: Column) -> Column:
    """The version 5 UUID of a name in the URL name space."""
    space = F.unhex(F.lit("6ba7b8119dad11d180b400c04fd430c8"))
    h = F.sha1(F.concat(space, F.encode(name, "UTF-8")))
    variant = F.substring(F.lower(F.hex((F.conv(F.substring(h, 17, 2), 16, 10).cast("long").bitwiseAND(F.lit(63))).bitwiseOR(F.lit(128)))), -2, 2)
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 19, 2)), F.substring(h, 21, 12))


def age_band(age: Column) -> Column:
    """Ten-year band of an age; empty for no number, ages below 0 count as 0."""
    tens = F.greatest(F.lit(0), F.floor(F.trim(age).try_cast("int") / 10) * 10)
    band = F.concat_ws("-", tens.cast("string"), (tens + 9).cast("string"))
    return F.when(age.rlike(r"^\s*-?\d{1,4}\s*$"), band).otherwise("")


def without_name(text: Column, name: Column, noun: str) -> Column:
    """``text`` with the full name, then the first name, replaced by a noun."""
    full = F.when(F.length(name) > 0, F.replace(text, name, F.lit(noun))).otherwise(text)
    first = F.split_part(name, F.lit(" "), F.lit(1))
    return F.when(F.length(first) > 0, F.replace(full, first, F.lit(noun))).otherwise(full)


def words_for(language: Column, tokens: Column, attempt: Column) -> Column:
    """Words to ask for within a token budget: fewer for Danish and with every attempt, at least 24."""
    share = F.when(language == "da", F.lit(0.42)).otherwise(F.lit(0.60))
    return F.greatest(F.lit(24), F.floor(tokens * (share * F.pow(F.lit(0.78), attempt))).cast("int"))
