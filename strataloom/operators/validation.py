"""Validators of requests, completions and pairs.

Every validator gives a struct ``accepted, reason, detected, uncertain``. The
first rule that holds decides. A null text counts as empty. The language
detector is a pair of columns, so that any detector, or none, can be used.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strataloom.functions import text as T

SURE = 0.80


def _verdict(accepted: bool, reason: str, detected: Column | None = None, uncertain: bool = False) -> Column:
    none = F.lit(None).cast("string")
    return F.struct(F.lit(accepted).alias("accepted"), F.lit(reason).alias("reason"), (none if detected is None else detected).alias("detected"), F.lit(uncertain).alias("uncertain"))


def _by_language(ladder: Column, expected: Column, detected: Column, confidence: Column) -> Column:
    return (
        ladder.when(detected.isNull(), _verdict(True, "language audit required", uncertain=True))
        .when(F.coalesce(confidence, F.lit(0.0)) < SURE, _verdict(True, "language audit required", detected, True))
        .when(~detected.eqNullSafe(expected), _verdict(False, "language mismatch", detected))
        .otherwise(_verdict(True, "ok", detected))
    )


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def request_verdict(instruction: Column, expected: Column, detected: Column, confidence: Column) -> Column:
    """Verdict on a request."""

    def rules(text: Column) -> Column:
        ladder = (
            F.when(text == "", _verdict(False, "empty instruction"))
            .when(T.has_control(text), _verdict(False, "invalid control character"))
            .when(T.leaks_prompt(text), _verdict(False, "generation-control leakage"))
            .when(F.length(text) < 20, _verdict(False, "instruction too short to be useful"))
            .when((F.length(text) < 80) | T.looks_like_code(text), _verdict(True, "language audit required", uncertain=True))
        )
        return _by_language(ladder, expected, detected, confidence)

    return let(T.stripped(F.coalesce(instruction, F.lit(""))), rules)


def pair_verdict(instruction: Column, response: Column, expected: Column, detected: Column, confidence: Column) -> Column:
    """Verdict on a request with its response."""
    both = F.concat(instruction, F.lit("\n"), response)
    ladder = (
        F.when((T.stripped(F.coalesce(instruction, F.lit(""))) == "") | (T.stripped(F.coalesce(response, F.lit(""))) == ""), _verdict(False, "empty instruction or response"))
        .when(T.has_control(both), _verdict(False, "invalid control character"))
        .when((F.length(both) < 80) | T.looks_like_code(both), _verdict(True, "language audit required", uncertain=True))
    )
    return _by_language(ladder, expected, detected, confidence)


def completion_reason(text: Column, finish_reason: Column) -> Column:
    """``complete``, or why a completion is not. A text of nothing but markup has no end."""
    body = F.regexp_replace(F.coalesce(text, F.lit("")), rf"{T.BLANK}+$", "")
    visible = F.regexp_replace(body, r"[*_`~ ]+$", "")
    found = F.regexp_extract_all(F.lower(visible), F.lit(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)"), 1)
    fences = F.size(F.split(body, "```")) - 1
    return (
        F.when(~finish_reason.eqNullSafe(F.lit("stop")), "not stopped")
        .when(body == "", "empty generation")
        .when(fences % 2 == 1, "unclosed code fence")
        .when(F.coalesce(F.try_element_at(found, F.lit(-1)), F.lit("")).isin(*T.UNFINISHED), "generation ends with an incomplete function word")
        .when(~F.coalesce(F.substring(visible, -1, 1).isin(*T.TERMINAL), F.lit(False)), "generation has no complete terminal boundary")
        .otherwise("complete")
    )


def all_true(*flags: Column) -> Column:
    """Conjunction in which null is false."""
    out = F.lit(True)
    for flag in flags:
        out = out & F.coalesce(flag, F.lit(False))
    return out


def conversation_accepted(turns: Column) -> Column:
    """Whether there are turns and every one is accepted."""
    return (F.size(turns) > 0) & F.forall(turns, lambda t: F.coalesce(t["accepted"], F.lit(False)))


def sanitized(text: Column, boundary: str, control_tokens: list[str]) -> Column:
    """Struct ``text, error``: the text before the boundary; an error where it is empty or holds a control token."""
    cut = T.cut_at(text, boundary)
    leak = F.lit(False)
    for token in control_tokens:
        leak = leak | F.contains(cut, F.lit(token))
    error = F.when(F.coalesce(cut, F.lit("")) == "", "empty").when(leak, "control token")
    return F.struct(F.when(error.isNull(), cut).alias("text"), error.alias("error"))
