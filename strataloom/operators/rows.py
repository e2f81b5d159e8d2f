"""Row-level shaping: resent rows, normalised dedup, bands, turns and accessors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataloom.functions import text as T


def latest(df: DataFrame, key: str = "id", at: str = "ingested_at") -> DataFrame:
    """One row per key, the latest: an aggregate, so partial results shrink the shuffle.

    Rows of the same time are told apart by a hash of all their columns; a null time
    comes before any other. All columns are shuffled, so compute what is wanted of
    a text first and call this on the result.
    """
    others = [c for c in df.columns if c != key]
    order = F.struct(F.col(at).isNotNull(), F.col(at), F.xxhash64(*others))
    kept = df.groupBy(key).agg(F.max_by(F.struct(*others), order).alias("_row"))
    return kept.select(key, "_row.*").select(*df.columns)


def keep_first(df: DataFrame, digest: Column, order: list[str]) -> DataFrame:
    """Keep-first dedup: the first row, by ``order``, of every digest.

    An aggregate, as a group of copies may hold a third of the rows. Nulls of the
    order come last, and a null digest is a digest. ``df`` should have a column of
    digests instead of the text: what it has is shuffled.
    """
    by = F.struct(*(part for c in order for part in (F.col(c).isNull(), F.col(c))))
    first = df.groupBy(digest.alias("_digest")).agg(F.min_by(F.struct(*df.columns), by).alias("_row"))
    return first.select("_row.*")


def banded(df: DataFrame, bands: DataFrame, band: str, tokens: Column, most: int) -> DataFrame:
    """``df`` with ``in_band``: within its band and the longest sequence (F12, J5). Unknown bands are false."""
    limits = F.broadcast(bands.select(F.col("length_band").alias(band), "min_tokens", "max_tokens"))
    inside = tokens.between(F.col("min_tokens"), F.col("max_tokens")) & (tokens <= most)
    return df.join(limits, band, "left").withColumn("in_band", F.coalesce(inside, F.lit(False))).drop("min_tokens", "max_tokens")


def first_user(messages: Column, instruction: Column | None = None) -> Column:
    """The first user text, after ``instruction`` where there is one."""
    said = F.get(F.filter(messages, lambda m: m["role"] == "user"), F.lit(0))["content"]
    return said if instruction is None else F.coalesce(instruction, said)


def exchanges(messages: Column) -> Column:
    """Number of assistant messages."""
    return F.coalesce(F.size(F.filter(messages, lambda m: m["role"] == "assistant")), F.lit(0))


def turn_array(messages: Column, usage: Column) -> Column:
    """An array of what ``turns`` gives but the transcript, one struct per assistant message: what is wanted of it is
    computed inside the row, before any shuffle."""
    at = F.filter(F.sequence(F.lit(0), F.size(messages)), lambda i: F.coalesce(F.get(messages, i)["role"] == "assistant", F.lit(False)))
    return F.transform(at, lambda i, n: F.struct(
        i.alias("position"), (n + 1).alias("turn"), F.when(i > 0, F.get(messages, i - 1)["content"]).alias("question"), F.get(messages, i)["content"].alias("answer"),
        F.get(usage, n)["finish_reason"].alias("finish_reason"), F.get(usage, n)["actual_output_tokens"].alias("output_tokens"),
    ))


def turns(df: DataFrame, key: str = "id", messages: str = "messages", usage: str = "turn_token_usage") -> DataFrame:
    """A row per assistant message: its number, the message before it, and its usage."""
    said = df.select(key, F.posexplode(messages).alias("position", "m"), F.col(messages).alias("_all"), F.col(usage).alias("_usage"))
    said = said.where("m.role = 'assistant'")
    before = F.when(F.col("position") > 0, F.get("_all", F.col("position") - 1))
    number = F.size(F.filter(F.slice("_all", F.lit(1), F.col("position") + 1), lambda m: m["role"] == "assistant"))
    out = said.select(key, "position", number.alias("turn"), before["content"].alias("question"), F.col("m.content").alias("answer"), "_usage", F.slice("_all", F.lit(1), F.col("position") + 1).alias("transcript"))
    used = F.get("_usage", F.col("turn") - 1)
    return out.select(key, "position", "turn", "question", "answer", used["finish_reason"].alias("finish_reason"), used["actual_output_tokens"].alias("output_tokens"), "transcript")


def or_unknown(value: Column) -> Column:
    """A value, or ``unknown`` where it is null or empty."""
    return F.coalesce(F.nullif(value.cast("string"), F.lit("")), F.lit("unknown"))


def unioned(first: DataFrame, *others: DataFrame) -> DataFrame:
    """UNION ALL by name; missing columns become null."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def numbered(df: DataFrame, by: list[str], order: list[str], into: str = "position") -> DataFrame:
    """Positions from 0 within ``by`` in ``order``."""
    return df.withColumn(into, (F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1).cast("long"))


def digest_of_prompt(text: Column) -> Column:
    """The digest that repeated prompts share."""
    return T.digest(T.folded(text))
