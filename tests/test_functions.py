"""Column functions and validators on edge texts."""

import uuid

import pytest
from pyspark.sql import functions as F

from strataloom.functions import text as T
from strataloom.operators import validation

DDL = "id long, text string"


def value(spark, column, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], DDL)
    return [r[0] for r in df.orderBy("id").select(column(F.col("text"))).collect()]


def test_folding_joins_all_kinds_of_white_space(spark):
    assert value(spark, T.folded, " Straße  og\n\tÆBLE ", "", None) == ["strasse og æble", "", None]


def test_control_characters_but_not_line_ends(spark):
    assert value(spark, T.has_control, "a\nb\tc\r", "a\x07b", "a\x85b", "") == [False, True, True, False]


def test_code_and_leaks(spark):
    assert value(spark, T.looks_like_code, "```x```", "my class is big", "classes", "a {} b", "let it be") == [True, True, False, True, True]
    assert value(spark, T.leaks_prompt, "Return the user message only.", "generation tasks", None) == [True, False, None]


@pytest.mark.parametrize("name", ["", "æøå", "strataloom:a:1:7", "x" * 500])
def test_uuid5_is_the_standard_one(spark, name):
    assert value(spark, T.uuid5_url, name) == [str(uuid.uuid5(uuid.NAMESPACE_URL, name))]


def test_age_bands(spark):
    assert value(spark, T.age_band, "34", " 7 ", "-3", "", "old", "120") == ["30-39", "0-9", "0-9", "", "", "120-129"]


def test_opening_has_six_words(spark):
    assert value(spark, T.opening, "One, two; three_x FOUR five six seven", "") == ["one two three_x four five six", ""]


@pytest.mark.parametrize(
    ("text", "finish", "reason"),
    [
        ("All done.", "stop", "complete"),
        ("All done.", "length", "not stopped"),
        (None, "stop", "empty generation"),
        ("  \n", "stop", "empty generation"),
        ("```python\nx = 1", "stop", "unclosed code fence"),
        ("This ends with the", "stop", "generation ends with an incomplete function word"),
        ("What are you looking for?", "stop", "generation ends with an incomplete function word"),
        ("no end", "stop", "generation has no complete terminal boundary"),
        ("***", "stop", "generation has no complete terminal boundary"),
        ("Finished **now.**", "stop", "complete"),
    ],
)
def test_completions(spark, text, finish, reason):
    df = spark.createDataFrame([(text, finish)], "text string, finish string")
    assert df.select(validation.completion_reason(F.col("text"), F.col("finish"))).first()[0] == reason


@pytest.mark.parametrize(
    ("text", "detected", "sure", "verdict"),
    [
        (None, None, None, (False, "empty instruction")),
        ("  ", None, None, (False, "empty instruction")),
        ("bad \x01 character in this text", "en", 0.9, (False, "invalid control character")),
        ("Please return the user message only, thanks", "en", 0.9, (False, "generation-control leakage")),
        ("x" * 19, "en", 0.9, (False, "instruction too short to be useful")),
        ("x" * 79, "da", 0.9, (True, "language audit required")),
        ("x" * 80, None, None, (True, "language audit required")),
        ("x" * 80, "en", 0.79, (True, "language audit required")),
        ("x" * 80, "da", 0.9, (False, "language mismatch")),
        ("x" * 80, "en", 0.9, (True, "ok")),
    ],
)
def test_requests(spark, text, detected, sure, verdict):
    df = spark.createDataFrame([(text, detected, sure)], "t string, d string, s double")
    got = df.select(validation.request_verdict(F.col("t"), F.lit("en"), F.col("d"), F.col("s")).alias("v")).first().v
    assert (got.accepted, got.reason) == verdict


def test_pairs_and_sanitising(spark):
    none = F.lit(None)
    df = spark.createDataFrame([("q", " ")], "q string, a string")
    assert df.select(validation.pair_verdict(F.col("q"), F.col("a"), F.lit("en"), none.cast("string"), none.cast("double"))["reason"]).first()[0] == "empty instruction or response"
    cut = lambda t: value(spark, lambda c: validation.sanitized(c, "<end>", ["<|x|>"]), t)[0]
    assert tuple(cut(" keep <end> drop")) == ("keep", None)
    assert tuple(cut("a <|x|> b")) == (None, "control token")
    assert tuple(cut("<end>")) == (None, "empty")
