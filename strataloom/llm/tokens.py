"""Problem 3: exact token counts, and their totals by slices.

Method: a text longer than ``CHUNK`` characters is cut only where the tokenizer
provably sees a boundary, its chunks are spread over the workers by a salt,
counted exactly, summed per text, and then rolled up. The tokenizer splits a
text by its pattern before any merge, and no alternative of the pattern takes a
blank after another character, nor a letter beside a digit, nor a mark beside
either but for an apostrophe before a letter. A cut after a letter or digit and
before a blank, a line break or a mark, or between a letter and a digit,
therefore changes no token. A single run of letters has no such place: it is one
piece to the tokenizer too.
"""

from __future__ import annotations

import base64
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The vocabulary: a public byte-level BPE for many languages.
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Fixed value: the pattern that the vocabulary was made with.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters beyond which a text is cut.
CHUNK = 20_000


def vocabulary(spark: SparkSession) -> str:
    """The path of the vocabulary on every worker: the setting ``spark.strataloom.vocabulary``, or the public default."""
    return spark.conf.get("spark.strataloom.vocabulary", "") or spark.sparkContext.getConf().get("spark.strataloom.vocabulary", "") or VOCABULARY


@lru_cache(maxsize=4)
def encoding(path: str):
    """The tokenizer of a vocabulary file, once per worker."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("strataloom", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(text: str | None, path: str = VOCABULARY) -> int:
    """Tokens of a text; 0 for null."""
    return len(encoding(path).encode_ordinary(text)) if text else 0


def independent_chunks(text: str, size: int = CHUNK) -> list[str]:
    """The text cut at boundaries that the tokenizer keeps, each chunk at least
    ``size`` characters long but for the last; uncut where there is no such boundary."""
    chunks, start, at = [], 0, size
    while at < len(text):
        before, after = text[at - 1], text[at]
        if (before.isalnum() and before.isprintable() and (after in " \n" or unicodedata.category(after)[0] in "PS")) or (before.isascii() and after.isascii() and (before.isalpha() and after.isdigit() or before.isdigit() and after.isalpha())):
            chunks.append(text[start:at])
            start = at
            at += size
        else:
            at += 1
    return [*chunks, text[start:]]


def _counter(path: str):
    @F.pandas_udf("long")
    def count(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        code = encoding(path).encode_ordinary
        for batch in texts:
            yield pd.Series([len(code(t)) if t else 0 for t in batch], dtype="int64")

    return count


def token_counts(df: DataFrame, keys: list[str], text: str, path: str | None = None, chunk: int = CHUNK, salts: int = 64) -> DataFrame:
    """``keys`` and ``tokens``: a row for every row of ``df``.

    Null and empty texts have 0 tokens. Only the chunks of long texts are
    shuffled. Rows with equal keys keep a row each; an empty table gives none.
    """
    path = path or vocabulary(df.sparkSession)
    picked = df.select(*keys, F.col(f"`{text}`").cast("string").alias("_text"))
    long = F.coalesce(F.length("_text"), F.lit(0)) > chunk
    short = picked.where(~long).select(*keys, _counter(path)("_text").alias("tokens"))

    @F.pandas_udf("array<string>")
    def cut(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: independent_chunks(t, chunk))

    pieces = picked.where(long).withColumn("_row", F.monotonically_increasing_id()).select(*keys, "_row", F.posexplode(cut("_text")).alias("_at", "_text"))
    pieces = pieces.repartition(salts, "_row", "_at") if salts else pieces
    summed = pieces.withColumn("tokens", _counter(path)("_text")).groupBy(*keys, "_row").agg(F.sum("tokens").alias("tokens")).drop("_row")
    return short.unionByName(summed)


def slice_totals(counts: DataFrame, slices: dict[str, Column]) -> DataFrame:
    """Texts and tokens by every combination of the slices and by each slice alone.

    A null in a slice column is the total over it; unknown values are ``?``.
    """
    named = counts.select("tokens", *(F.coalesce(column, F.lit("?")).alias(name) for name, column in slices.items()))
    sums = named.groupBy(*slices).agg(F.count("*").alias("texts"), F.sum("tokens").alias("tokens"))
    # rolled up from the sums: the rows are aggregated once, before any shuffle
    return sums.cube(*slices).agg(F.sum("texts").alias("texts"), F.sum("tokens").alias("tokens"))
