"""Problem 4: template residue, filler, error pages and notices among requests.

Method: records of the same template are aligned and their slots induced. Where
a text holds a marker (a variable name, a default or a blank in brackets), the
two words before it are its place in the template; the place is a slot where at
least ``REPEATS`` different fillers follow the same two words in records without
markers. A text is flagged where it retains a marker in such a slot.

A page is a text whose openings, the first two words of its sentences, keep no
free company: the sentences of requests are combined freely, so an opening of
theirs has many companions of about equal weight (the inverse of Simpson's
index of its neighbours), while those of an error page or a notice only recur
together. Pages that share their opening are aligned: the words that recur in
them are the template. It is one where it has a closed vocabulary, small beside
the words of a record and covering most of them. The words that mainly such
templates use then tell filler whose order is random. Names and numbers count as
slots everywhere.

A page of which there are too few copies for a template is left to the
vocabularies of filler, errors and notices below: they see nothing but the texts
without free company that no template explains.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataloom.llm.neardup import FILTER, only_keys
from strataloom.llm.text import SENTENCE, WORD, in_parts
from strataloom.session import durable

#: Companions of equal weight that make an opening one of free requests.
COMPANIONS = 3
#: Records that share a template, or fillers of a slot, for it to be one.
REPEATS = 3
#: Recurring words of a template to one word of a record, at most.
CLOSED = 5
#: Share of the pages with a word that must be of a template for the word to be of filler.
LEARNED = 0.25

#: How an unfilled slot is written.
SLOT = re.compile(
    r"\{\{[^{}\n]*\}\}|\$\{[^{}\n]+\}|#\{[^{}\n]+\}|<%[^%\n]+%>|%\(\w+\)[sd]|(?<![\w%])%[sd]\b"
    r"|(?<![\w{])\{[^\W\d][^{}\n\"':;=]*\}|\[[^\W\d][^\]\[\n]+\](?!\()|(?<![^\W_])__+[^\W_][^\n]*?__+(?!\w)|(?<!\w)_{3,}(?!\w)"
    r"|<[^\W\d][\w -]*>|@@[^\W_]\w*@@|(?<!\d)%[A-Z_]{3,}%|\[\s*\](?!\()"
)
#: Tags of markup, which are no slots.
MARKUP = {"p", "br", "b", "i", "a", "u", "ul", "ol", "li", "div", "span", "code", "pre", "em", "strong", "noscript", "script", "style", "html", "head", "body", "table", "tr", "td", "th", "h1", "h2", "h3", "title"}
#: The vocabulary of filler text.
FILLER_WORDS = set(
    "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim "
    "veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo consequat duis aute irure in reprehenderit voluptate velit esse "
    "cillum fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum "
    "asdf qwerty jkl test bla blah foo bar baz todo tbd xxx xxxx xxxxx".split()
)
FILLER = re.compile(r"(?i)\b(?:placeholder|fill(?:er)? text|sample text|dummy text|text to come|text goes here|fyldtekst|eksempeltekst|brødtekst|pladsholder|kommer der (?:mere )?tekst|skriv noget|lorem ipsum)\b")
#: The vocabulary of error pages, error output and notices.
PAGE = re.compile(
    r"(?i)\b(?:javascript|noscript|cookies?|browser\w*|scripts?|scripting|error|errors|fejl\w*|exception|traceback|forbidden|denied|nægtet|permission|unauthori[sz]ed|not be found|not found|"
    r"nothing matches|findes ikke|blev ikke fundet|ikke fundet|unavailable|utilgængelig|timed? ?out|gateway|maintenance|vedligeholdelse|too many requests|quota|session|captcha|robot|sign in|log ?in|log ind|loading|indlæs\w*|"
    r"reload|connection is secure|status|stack trace|segmentation fault|null ?pointer|undefined|access|adgang|subscri\w+|abonn\w+|40\d|41\d|42\d|50\d)\b"
)
#: One of these stands in every match of the two vocabularies.
_FILLER_HINTS = ("placeholder", "fill", "sample text", "dummy", "text to come", "text goes", "fyldtekst", "eksempeltekst", "brødtekst", "pladsholder", "kommer der", "skriv noget", "lorem")
_PAGE_HINTS = (
    "script", "cookie", "browser", "err", "fejl", "exception", "traceback", "forbidden", "denied", "nægtet", "permission", "unauthori", "found", "matches", "findes", "fundet", "available", "utilgængelig", "time", "gateway", "mainten", "vedligehold",
    "requests", "quota", "session", "captcha", "robot", "sign in", "log", "load", "indlæs", "secure", "status", "trace", "fault", "pointer", "undefined", "access", "adgang", "subscri", "abonn", "40", "41", "42", "50",
)
_QUOTED = re.compile(r"`[^`\n]*`|“[^”\n]*”|«[^»\n]*»|„[^“”\n]*[“”]|(?<!\w)\"[^\"\n]*\"(?!\w)|(?<!\w)'[^'\n]*'(?!\w)|‘[^’\n]*’")
_CODE = re.compile(r"```.*?(?:```|\Z)", re.S)
_TWO = re.compile(r"([^\W_]+)(?:[\W_]+([^\W_]+))?")
_MARKS, _QUOTES = re.compile(r"[{\[<%_@]"), re.compile(r"[`“«„\"'‘]")

FEATURES = "id string, blank boolean, openings array<long>, contexts array<long>"


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


def plain(text: str) -> str:
    """A text with marks in place of code and quotations."""
    if "```" in text:
        text = _CODE.sub(" ", text)
    return _QUOTED.sub(" # ", text) if _QUOTES.search(text) else text


def slots_of(text: str) -> list[re.Match]:
    """The unfilled slots of a text that is free of quotations and code."""
    if not _MARKS.search(text):
        return []
    return [m for m in SLOT.finditer(text) if m[0][0] != "<" or m[0].strip("<>/ ").split(" ")[0].lower() not in MARKUP]


def masks(words: list[str]) -> list[str]:
    """Words in lower case; names, numbers and codes become slots (``#``)."""
    return ["#" if (at and word[0].isupper()) or not word.isalpha() else word.lower() for at, word in enumerate(words)]


def masked(text: str) -> list[str]:
    """The words of a text with its slots."""
    return masks(WORD.findall(text))


def openings_of(text: str) -> list[int]:
    """The hashes of the first two words of every sentence, in order; none where both are slots."""
    out = []
    for sentence in SENTENCE.split(text):
        two = _TWO.search(sentence)
        if two:
            tokens = masks([w for w in two.groups() if w])
            if any(token != "#" for token in tokens):
                out.append(_hash(" ".join(tokens)))
    return out


_HASHES: tuple[dict[str, int], dict[str, int]] = ({}, {})


def _hashes(tokens: list[str], masked: bool = False) -> np.ndarray:
    """The hashes of words as they are, or of what they are behind the first of a text: lower case or a slot."""
    known = _HASHES[masked]
    if len(known) > 500_000:  # bounds the memory, never changes a hash
        known.clear()
    for token in set(tokens).difference(known):
        known[token] = xxhash.xxh64_intdigest(masks(["", token])[1] if masked and token not in "^{$" else token)
    return np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))


def _pairs(h: np.ndarray) -> np.ndarray:
    """A hash of every two neighbours."""
    mixed = (h[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ (h[1:] + np.uint64(0x7F4A7C15))
    return (mixed * np.uint64(0xD6E8FEB86659FD93)).view(np.int64)


def contexts_of(text: str) -> list[int]:
    """The places of the unfilled slots of a plain text: hashes of the two words before each."""
    found, out = slots_of(text), []
    if found:
        tokens, at = ["^", "^"], 0
        for m in found:
            tokens += WORD.findall(text[at : m.start()])
            at = m.end()
            both = [t if t in "^{" else "#" if (i and t[0].isupper()) or not t.isalpha() else t.lower() for i, t in enumerate(tokens[-2:], len(tokens) - 4)]
            out.append(int(_pairs(_hashes(both))[0]))
            tokens += ["{", "{"]  # what follows a marker has no known place until two words are between
    return out


def features(df: DataFrame, key: str, text: str) -> DataFrame:
    """One row of ``FEATURES`` for every row of ``df``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in in_parts(batches):
            rows = []
            for id_, said in zip(batch["id"], batch["text"]):
                if not said or not WORD.search(said):
                    rows.append((id_, True, [], []))
                else:
                    rows.append((id_, False, openings_of(said), contexts_of(plain(said))))
            yield pd.DataFrame(rows, columns=["id", "blank", "openings", "contexts"])

    return df.select(F.col(f"`{key}`").cast("string").alias("id"), F.col(f"`{text}`").cast("string").alias("text")).mapInPandas(run, FEATURES)


def filled_places(df: DataFrame, text: str, contexts: DataFrame) -> DataFrame:
    """``context, fillers``: how many different two words follow each place in texts without markers.

    A bitmap of ``FILTER`` hashed places, of a fixed size whatever the rows, tells
    which places of a text are worth a row.
    """
    spot = F.pmod("context", F.lit(FILTER)) + 1  # buckets and positions count from 1
    bits = contexts.select(spot.alias("spot")).groupBy(F.bitmap_bucket_number("spot").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("spot")).alias("bitmap")).collect()
    wanted = np.zeros(FILTER, bool)
    for row in bits:  # at most FILTER / 32768 rows of 4 KB
        at = (row["bucket"] - 1) * 32768
        wanted[at : at + 32768] = np.unpackbits(np.frombuffer(bytes(row["bitmap"]), np.uint8), bitorder="little")
    shared = df.sparkSession.sparkContext.broadcast(np.packbits(wanted))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wanted = np.unpackbits(shared.value).astype(bool)
        for batch in in_parts(batches):
            tokens, firsts = [], []
            for said in batch["text"]:
                if said:
                    said = plain(said)
                    if not slots_of(said):
                        firsts.append(len(tokens) + 2)
                        tokens += ["^", "^", *WORD.findall(said), "$", "$"]
            if tokens:
                filler, place = _pairs(_hashes(tokens)), _hashes(tokens, masked=True)
                place[firsts] = _hashes([masks(tokens[at : at + 1])[0] for at in firsts])
                place = _pairs(place)
                at = np.flatnonzero(wanted[place[:-2] % FILTER])
                yield pd.DataFrame({"context": place[at], "filler": filler[at + 2]}).drop_duplicates()

    rows = df.select(F.col(f"`{text}`").cast("string").alias("text")).mapInPandas(run, "context long, filler long")
    return rows.distinct().groupBy("context").agg(F.count("*").alias("fillers"))


def page_words(text: str | None) -> tuple[int | None, list[int]]:
    """The first opening of a text and the hashes of its different words but names and numbers."""
    first = next(iter(openings_of(text or "")), None)
    return first, [_hash(w) for w in dict.fromkeys(masked(text or "")) if w != "#"]


def named_kind(text: str) -> str | None:
    """``filler`` or ``notice`` where the vocabulary of a text says so: a text is
    filler where more than half of its words but names and numbers are."""
    low, words = text.lower(), [w for w in masked(text) if w != "#"]
    if any(hint in low for hint in _FILLER_HINTS) and FILLER.search(text) or 2 * sum(w in FILLER_WORDS for w in words) > len(words):
        return "filler"
    return "notice" if any(hint in low for hint in _PAGE_HINTS) and PAGE.search(text) else None


def isolated(rows: DataFrame) -> DataFrame:
    """``id`` of the texts of which less than half of the known openings keep free company."""
    spoken = rows.where(F.size("openings") > 0)
    known = spoken.select(F.explode("openings").alias("opening")).groupBy("opening").agg(F.count("*").alias("records")).where(F.col("records") >= REPEATS)
    sides = spoken.where(F.size("openings") > 1).select(
        F.explode(F.arrays_zip(F.expr("slice(openings, 1, size(openings) - 1)").alias("a"), F.expr("slice(openings, 2, size(openings) - 1)").alias("b"))).alias("p")
    )
    sides = sides.where("p.a <> p.b").select(F.explode(F.array(F.struct(F.col("p.a").alias("opening"), F.col("p.b").alias("beside")), F.struct(F.col("p.b").alias("opening"), F.col("p.a").alias("beside")))).alias("s")).select("s.*")
    company = sides.groupBy("opening", "beside").agg(F.count("*").cast("double").alias("n")).groupBy("opening").agg((F.sum("n") * F.sum("n") / F.sum(F.col("n") * F.col("n"))).alias("companions"))
    free = known.join(company, "opening", "left").select("opening", (F.coalesce("companions", F.lit(0.0)) >= COMPANIONS).alias("free"))
    # a row number in place of the id keeps the shuffle small
    said = spoken.select("row", F.explode(F.array_distinct("openings")).alias("opening")).join(free, "opening")
    requests = said.groupBy("row").agg(F.count("*").alias("known"), F.count_if("free").alias("free")).where("2 * free >= known").select("row")
    return rows.where("not blank").select("id", "row").join(requests, "row", "left_anti").select("id").distinct()


def template_pages(pages: DataFrame) -> DataFrame:
    """``id, kind`` of the pages (``id, opening, words, named``) that are of a template (``page``), made of
    the words of templates (``filler``), or neither and ``named`` by their vocabulary."""
    counts = pages.select("opening", F.explode("words").alias("word")).groupBy("opening", "word").agg(F.count("*").alias("n"))
    counts = counts.where("opening is not null")
    sizes = counts.groupBy("opening").agg(F.count_if(F.col("n") >= REPEATS).alias("recurring"), F.sum(F.when(F.col("n") >= REPEATS, F.col("n")).otherwise(0)).alias("covered"), F.sum("n").alias("total"))
    records = pages.groupBy("opening").agg(F.count("*").alias("records"))
    closed = sizes.join(records, "opening").where((F.col("records") >= REPEATS) & (F.col("recurring") * F.col("records") <= CLOSED * F.col("total")) & (2 * F.col("covered") >= F.col("total"))).select("opening")
    # bounded: a closed vocabulary is at most CLOSED records' worth of words
    templates = counts.where(F.col("n") >= REPEATS).join(closed, "opening", "left_semi").groupBy("opening").agg(F.collect_list("word").alias("template"))
    found = pages.join(templates, "opening", "left").select("id", "words", "named", F.coalesce(2 * F.size(F.array_intersect("words", "template")) >= F.size("words"), F.lit(False)).alias("flagged"))
    found = durable(found)
    learned = found.select("flagged", F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n"), F.count_if("flagged").alias("k"))
    learned = learned.where((F.col("k") >= REPEATS) & (F.col("k") >= LEARNED * F.col("n"))).select("word", F.lit(1).alias("known"))
    rest = found.where("not flagged").select("id", F.explode("words").alias("word")).join(learned, "word", "left").groupBy("id").agg(F.count("*").alias("n"), F.count("known").alias("known")).where("2 * known > n")
    named = found.where("not flagged and named is not null").select("id", F.col("named").alias("kind"))
    return found.where("flagged").select("id", F.lit("page").alias("kind")).unionByName(rest.select("id", F.lit("filler").alias("kind"))).unionByName(named)


def template_residue(df: DataFrame, key: str = "id", text: str = "instruction") -> DataFrame:
    """Each record that is template residue, filler, an error page or a notice.

    Columns: ``id``, ``kind`` (``slots``, ``blank``, ``page``, ``filler`` or
    ``notice``, the first that holds). Rows that share a key count once. A null text and one
    without letters and digits is ``blank``. What occurs in fewer than
    ``REPEATS`` records is no template. Rows with a null key are left out; an empty table
    gives no rows; other columns are ignored.
    """
    texts = df.where(F.col(f"`{key}`").isNotNull()).select(F.col(f"`{key}`").cast("string").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    rows = durable(features(texts, "id", "text").withColumn("row", F.monotonically_increasing_id()))

    @F.pandas_udf("opening long, words array<long>, named string")
    def measure(said: pd.Series) -> pd.DataFrame:
        found = [page_words(t) for t in said]
        return pd.DataFrame({"opening": pd.array([f[0] for f in found], "Int64"), "words": [f[1] for f in found], "named": pd.Series([named_kind(t) for t in said], dtype=object)})

    alone = durable(isolated(rows))
    pages = only_keys(texts, alone, ["id"]).join(alone, "id").dropDuplicates(["id"]).withColumn("p", measure("text")).select("id", "p.opening", "p.words", "p.named")
    kinds = template_pages(durable(pages))
    holes = rows.where(F.size("contexts") > 0).select("id", F.explode("contexts").alias("context"))
    places = filled_places(texts, "text", holes.select("context").distinct())
    slotted = holes.join(places.where(F.col("fillers") >= REPEATS), "context").select("id", F.lit("slots").alias("kind"))
    blank = rows.where("blank").select("id", F.lit("blank").alias("kind"))
    every = slotted.unionByName(blank).unionByName(kinds)
    rank = F.array_position(F.array(*map(F.lit, ("slots", "blank", "page", "filler", "notice"))), F.col("kind"))
    return every.groupBy("id").agg(F.min(F.struct(rank.alias("rank"), "kind")).alias("best")).select("id", F.col("best.kind").alias("kind"))
