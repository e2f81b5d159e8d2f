"""Problem 5: questions whose answer is empty, truncated, a refusal, a copy or in another language.

Method: the openings of the sentences of all answers, with names and numbers made
slots, are clustered by MinHash: each band is a star around its commonest
opening, and a member is one whose words are verified to be like that centre. An
answer is bare where none of its sentences has a slot, so that it says nothing
particular. A cluster refuses where it recurs across unrelated prompts and nearly
all answers that use it are bare; an answer is a refusal where it is bare and
every sentence is of a cluster that refuses. No list of phrases takes part. Copy, language and termination checks label
the other defects.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataloom.llm.language import coder_of, label_texts, unquoted
from strataloom.llm.neardup import only_keys, run_hashes
from strataloom.llm.text import AT_ONCE, SENTENCE, WORD, in_parts, words
from strataloom.session import durable

#: Unrelated prompts across which a cluster must recur to be one that refuses.
PROMPTS = 3
#: Words of a sentence's opening.
OPENING = 8
#: Share of common words that an opening must have with the centre of its cluster.
ALIKE = 0.4
#: Share of bare answers among those that use a cluster.
BARE = 0.8
#: Bits by which an answer must be shorter in its own language than in the question's.
LANGUAGE_BITS = 40.0
#: Words that an answer needs to have a language.
LANGUAGE_WORDS = 4
#: Bits within which two languages count as tied, beyond any rounding of sums.
TIED_BITS = 1e-6

#: Names of the languages in each of them.
ASKED = {
    "en": r"english|engelsk\w*|englisch\w*|engelska|inglés|inglesa",
    "da": r"danish|dansk\w*|dänisch\w*|danska|danés|danesa",
    "de": r"german|tysk\w*|deutsch\w*|tyska|alemán|alemana",
    "sv": r"swedish|svensk\w*|schwedisch\w*|svenska|sueco|sueca",
    "nb": r"norwegian|norsk\w*|norwegisch\w*|norska|noruego|noruega|bokmål",
    "es": r"spanish|spansk\w*|spanisch\w*|spanska|español\w*|castellano",
}
_ASKED = {code: re.compile(rf"(?i)\b(?:{names})\b") for code, names in ASKED.items()}
#: One of these stands in every name of a language.
_STEMS = ("engl", "engel", "ingl", "dans", "danis", "dän", "danés", "danes", "tysk", "germ", "deut", "alem", "svens", "schwed", "swed", "suec", "norsk", "norw", "norue", "bokm", "span", "spansk", "españ", "castell")
_TAGS = re.compile(r"<[^<>]*>|&\w+;|\[\s*\]|\{\s*\}")
_ITEM = re.compile(r"^\s*(?:[-*•–]|\d+[.)])\s+(.*)$")
_CLOSED = ".!?…`”\"»’'|)]}>"



def exchanges_of(roles, contents) -> list[tuple[int, str, str | None]]:
    """(exchange, question, answer) of every user turn; turns without a role are skipped, and
    the answer is the assistant turn that directly follows, or null."""
    turns = [t for t in zip(roles, contents) if t[0] is not None]
    out = []
    for i, (role, content) in enumerate(turns):
        if role == "user":
            follows = turns[i + 1] if i + 1 < len(turns) else (None, None)
            out.append((len(out) + 1, content or "", follows[1] if follows[0] == "assistant" else None))
    return out


def asked_in(roles, contents) -> set[str]:
    """The languages that user turns name."""
    named = [c for r, c in zip(roles, contents) if r == "user" and c and any(stem in low for low in (c.lower(),) for stem in _STEMS)]
    return {code for code, pattern in _ASKED.items() if any(map(pattern.search, named))}


def is_empty(answer: str | None) -> bool:
    """Whether an answer is missing or has nothing but blanks, marks, markup or invisible characters."""
    if answer is None:
        return True
    return not WORD.search(_TAGS.sub(" ", answer) if any(mark in answer for mark in "<&[{") else answer)


def is_copy(asked: list[str], said: list[str]) -> bool:
    """Whether an answer's words give the question back and nothing of their own:
    three fifths of the question's runs of three words come back, and at most
    four words, and no more than half, lie in no such run."""
    if not asked or not said or 5 * len(said) < 2 * len(asked):
        return False
    known, own = set(asked), set()
    for word in said:
        if word not in known:
            own.add(word)
            if len(own) > 4:  # more words of its own than a copy has
                return False
    run = min(3, len(said), len(asked))
    known = {tuple(asked[i : i + run]) for i in range(len(asked) - run + 1)}
    covered = [False] * len(said)
    for i in range(len(said) - run + 1):
        if tuple(said[i : i + run]) in known:
            covered[i : i + run] = [True] * run
    own = len(said) - sum(covered)
    given = {tuple(said[i : i + run]) for i in range(len(said) - run + 1)}
    back = sum(g in given for g in (tuple(asked[i : i + run]) for i in range(len(asked) - run + 1)))
    return own <= 4 and own * 2 <= len(said) and back * 5 >= 3 * (len(asked) - run + 1)


def own_words(text: str, said: list[str]) -> list[str]:
    """The words of a text, ``said``, without those of its quotations and code."""
    plain = unquoted(text)
    return said if plain == text else words(plain)


def may_differ(costs: np.ndarray) -> np.ndarray:
    """Whether the main languages of two texts can differ, for rows of costs that
    hold a question and its answer by turns.

    Where the same language is cheapest in both and not tied, it is the main
    language that ``label_texts`` gives to both, whatever their segments; the
    answer is then no shorter in its own language than in the question's.
    """
    least = np.partition(costs, min(1, costs.shape[1] - 1), axis=1)
    tied = (least[:, 1] - least[:, 0] <= TIED_BITS) if costs.shape[1] > 1 else np.zeros(len(costs), bool)
    main = costs.argmin(axis=1)
    return (main[::2] != main[1::2]) | tied[::2] | tied[1::2]


def is_truncated(answer: str) -> bool:
    """Whether a text breaks off: an open code block, or no end of a sentence
    where its siblings have one. A list of bare items is complete where its last item is like the others."""
    text = answer.rstrip()
    if text.count("```") % 2:
        return True
    if text[-1] in _CLOSED:
        return False
    lines = text.split("\n")
    last = _ITEM.match(lines[-1])
    if last:
        items, at = [], len(lines) - 1
        while at >= 0 and (m := _ITEM.match(lines[at])):
            items.append(m[1].strip())
            at -= 1
        if len(items) > 1:
            siblings = items[1:]
            bare = [s for s in siblings if s[-1:] not in ".!?…"]
            shape = lambda s: (bool(re.match(r"\d", s)), len(s.split()) > 6)
            if len(bare) == len(siblings) and text[-1] not in ",;:–—-(" and items[0] and shape(items[0]) == shape(siblings[0]) and len(items[0].split()) >= min(len(s.split()) for s in siblings):
                return False
        return True
    return True


class _Masks(dict):
    """What a word is behind the first of its sentence: lower case, or a slot (``#``) for numbers and capital words."""

    def __missing__(self, word: str) -> str:
        if len(self) > 500_000:  # bounds the memory, never changes a mask
            self.clear()
        mask = self[word] = word if word.isalpha() and word[0].islower() else "i" if word == "I" else "#"
        return mask.lower()


_MASKS = _Masks()


def openings_of(answer: str) -> tuple[list[str], bool, list[str]]:
    """The masked openings of the sentences of an answer, whether it is bare, and its words in lower case.

    An opening is the first ``OPENING`` words of a sentence in lower case; numbers,
    and capital words after the first, are slots (``#``).
    """
    out, bare, said = [], True, []
    for sentence in SENTENCE.split(answer):
        found = WORD.findall(sentence)
        if found:
            said += found
            head = [found[0].lower() if found[0].isalpha() else "#", *map(_MASKS.__getitem__, found[1:OPENING])]
            out.append(" ".join(head).lower())
            # once a slot is seen the words behind the openings need no mask
            bare = bare and "#" not in head and "#" not in map(_MASKS.__getitem__, found[OPENING:])
    return out, bare, list(map(str.lower, said))


BANDS, ROWS = 16, 2


@lru_cache(maxsize=1)
def _salts() -> np.ndarray:
    return np.random.default_rng(7).integers(1, 2**63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)


_HASHES: dict[str, int] = {}


def _bands(openings: list[str]) -> list[list[int]]:
    """The band keys of each opening: hashes of its least word hashes."""
    known = _HASHES
    if len(known) > 500_000:  # bounds the memory, never changes a hash
        known.clear()
    sets = [list(dict.fromkeys(opening.split(" "))) for opening in openings]
    for word in {w for s in sets for w in s}.difference(known):
        known[word] = xxhash.xxh64_intdigest(word)
    if not sets:
        return []
    h = np.array([known[w] for s in sets for w in s], np.uint64)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    mins = np.minimum.reduceat((h[:, None] * _salts()[None, :]) >> np.uint64(16), starts, axis=0).reshape(len(sets), BANDS, ROWS)
    mixed = (mins[:, :, 0] * np.uint64(0x9E3779B97F4A7C15)) ^ mins[:, :, 1] ^ (np.arange(BANDS, dtype=np.uint64) << np.uint64(58))
    return mixed.view(np.int64).tolist()


def refusing(openings: DataFrame) -> DataFrame:
    """``opening`` of all that are of a cluster that refuses.

    ``openings`` has ``opening, n, bare, prompts``: how many answers use it, how many
    of them are bare, and a bitmap of 63 places of their prompts, which counts no
    prompt that isn't there. Every opening is compared with the centre of each of
    its bands, so the work is in proportion to the openings, however many share a band.
    """

    @F.pandas_udf("array<long>")
    def bands(opening: pd.Series) -> pd.Series:
        return pd.Series(_bands(opening.tolist()), dtype=object)

    sums = openings.groupBy("opening").agg(F.sum("n").alias("n"), F.sum("bare").alias("bare"), F.bit_or("prompts").alias("prompts"))
    known = durable(sums.withColumn("bands", bands("opening")))
    wanted = known.where("bare > 0").select(F.explode("bands").alias("band")).distinct()
    banded = only_keys(known.select("opening", "n", "bare", "prompts", F.explode("bands").alias("band")), wanted, ["band"]).join(wanted, "band", "left_semi")
    centres = banded.groupBy("band").agg(F.max(F.struct("n", "opening")).alias("c")).select("band", F.col("c.opening").alias("centre"))
    one, two = F.array_distinct(F.split("opening", " ")), F.array_distinct(F.split("centre", " "))
    both = F.size(F.array_intersect(one, two))
    members = durable(banded.join(centres, "band").where(both >= ALIKE * (F.size(one) + F.size(two) - both)).drop("centre"))
    stars = members.groupBy("band").agg(F.sum("n").alias("of"), F.sum("bare").alias("of_bare"), F.bit_count(F.bit_or("prompts")).alias("of_prompts"))
    found = members.where("bare > 0").join(stars, "band").groupBy("opening").agg((F.sum("of_bare") / F.sum("of")).alias("share"), F.max("of_prompts").alias("prompts"))
    return found.where((F.col("share") >= BARE) & (F.col("prompts") >= PROMPTS)).select("opening")


def defects(df: DataFrame, samples: tuple[tuple[str, str], ...], key: str = "id", messages: str = "messages") -> DataFrame:
    """``id, exchange, defect`` of every question with a defective answer, at most one each.

    The first that holds of ``empty``, ``copy``, ``refusal``, ``truncated`` and
    ``language``. Rows that share a key count once. Null messages and
    conversations without a user turn give no rows; neither does an empty table.
    """
    talks = df.where(F.col(f"`{key}`").isNotNull()).select(F.col(f"`{key}`").cast("string").alias("id"), F.col(f"`{messages}`.role").alias("roles"), F.col(f"`{messages}`.content").alias("contents")).where("roles is not null")

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = coder_of(samples)
        column = {code: i for i, code in enumerate(coder.languages)}
        for batch in in_parts(batches, AT_ONCE // 2):
            rows, open_, used = [], [], Counter()
            talks = list(zip(batch["id"], batch["roles"], batch["contents"]))
            for at, (id_, exchange, question, answer) in ((at, (t[0], *x)) for at, t in enumerate(talks) for x in exchanges_of(*t[1:])):
                if is_empty(answer):
                    rows.append([id_, exchange, "empty", [], [], 0])
                    continue
                theirs = words(question)
                openings, bare, ours = openings_of(answer)
                if is_copy(theirs, ours):
                    rows.append([id_, exchange, "copy", [], [], 0])
                    continue
                cut = is_truncated(answer)
                if bare:
                    # related prompts share their least run of three words
                    runs = run_hashes(theirs, min(3, len(theirs))) if theirs else np.zeros(1, np.uint32)
                    rows.append([id_, exchange, "truncated" if cut else None, openings, [], 1 << int(runs.min()) % 63])
                else:
                    used.update(openings)
                    if cut:
                        rows.append([id_, exchange, "truncated", [], [], 0])
                if not cut:
                    open_.append((id_, exchange, question, answer, at, own_words(question, theirs), own_words(answer, ours)))
            # segments are looked at only where the languages of the texts without quotations and code can differ
            apart = may_differ(coder.costs([t for x in open_ for t in x[5:]])[0]) if open_ else ()
            open_ = [x for x, differ in zip(open_, apart) if differ]
            if open_:
                questions = label_texts([x[2] for x in open_], coder)
                answers_ = label_texts([x[3] for x in open_], coder)
                for (id_, exchange, _, _, at, _, said), theirs, ours in zip(open_, questions, answers_):
                    if not theirs[0] or not ours[0] or ours[0] in theirs[2] or theirs[0] in ours[2] or ours[0] in asked_in(*talks[at][1:]):
                        continue
                    tokens = [w for w in said if not w.isdigit()]
                    if len(tokens) < LANGUAGE_WORDS:
                        continue
                    costs = coder.costs([tokens])[0][0]
                    if costs[column[theirs[0]]] - costs[column[ours[0]]] >= LANGUAGE_BITS:
                        rows.append([id_, exchange, "language", [], [], 0])
            rows.append([None, 0, None, list(used), list(used.values()), 0])
            yield pd.DataFrame(rows, columns=["id", "exchange", "defect", "openings", "counts", "prompt"])

    judged = durable(talks.mapInPandas(judge, "id string, exchange long, defect string, openings array<string>, counts array<long>, prompt long"))
    plain = judged.where("id is null").select(F.explode(F.arrays_zip("openings", "counts")).alias("o")).select("o.openings", "o.counts")
    plain = plain.select(F.col("openings").alias("opening"), F.col("counts").alias("n"), F.lit(0).cast("long").alias("bare"), F.lit(0).cast("long").alias("prompts"))
    said = judged.where("id is not null and size(openings) > 0").select("id", "exchange", F.explode("openings").alias("opening"), "prompt")
    bare = said.select("opening", F.lit(1).cast("long").alias("n"), F.lit(1).cast("long").alias("bare"), F.col("prompt").alias("prompts"))
    known = refusing(plain.unionByName(bare)).withColumn("refuses", F.lit(True))
    refused = said.join(known, "opening", "left").groupBy("id", "exchange").agg(F.bool_and(F.col("refuses").isNotNull()).alias("refuses"))
    refused = refused.where("refuses").select("id", "exchange", F.lit("refusal").alias("defect"))
    every = judged.where("id is not null and defect is not null").select("id", "exchange", "defect").unionByName(refused)
    rank = F.array_position(F.array(*map(F.lit, ("empty", "copy", "refusal", "truncated", "language"))), F.col("defect"))
    return every.groupBy("id", "exchange").agg(F.min(F.struct(rank.alias("rank"), "defect")).alias("first")).select("id", "exchange", F.col("first.defect").alias("defect"))
