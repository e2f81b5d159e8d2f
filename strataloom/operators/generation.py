"""Generation and audit phases around a teacher."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataloom.functions import text as T
from strataloom.operators import prompts, validation
from strataloom.operators import rows as rows_

#: The fields of a request verdict and of a turn verdict, all required and no others allowed.
INSTRUCTION_VERDICT = (
    "accepted boolean, language string, quality int, topic_adherent boolean, mode_adherent boolean, realistic boolean, answerable boolean, "
    "persona_coherent boolean, useful_for_training boolean, safe boolean, category string, reason string"
)
TURN_VERDICT = "accepted boolean, language string, instruction_quality int, response_quality int, coherent boolean, safe boolean, category string, difficulty string, reason string"
#: Steps between the seeds of attempts, of repeated tasks and of the judge.
ATTEMPT_SEED, TASK_SEED, JUDGE_SEED = 1_000_003, 10_000_019, 7_000_001


def fields_of(verdict: str) -> dict[str, str]:
    """The fields of a verdict and their kinds."""
    return dict(part.split() for part in verdict.split(", "))


def verdict_schema(verdict: str, languages: list[str]) -> dict:
    """The strict JSON schema of a verdict: qualities from 1 to 5, one of the languages."""
    kinds = {"boolean": {"type": "boolean"}, "int": {"type": "integer", "minimum": 1, "maximum": 5}, "string": {"type": "string"}}
    fields = fields_of(verdict)
    shapes = {name: {"type": "string", "enum": languages} if name == "language" else kinds[kind] for name, kind in fields.items()}
    return {"type": "object", "properties": shapes, "required": list(fields), "additionalProperties": False}


def checked_verdict(result: dict, verdict: str) -> dict:
    """The verdict of a structured call; raises where it did not stop or has other fields or kinds than asked for."""
    from strataloom.sources.teacher import verdict_of

    value, fields = verdict_of(result), fields_of(verdict)
    kinds = {"boolean": bool, "int": int, "string": str}
    wrong = value.keys() ^ fields.keys() or {k for k, kind in fields.items() if not isinstance(value[k], kinds[kind]) or kind == "int" and isinstance(value[k], bool)}
    if wrong:
        raise ValueError(f"the verdict has wrong fields: {sorted(wrong)}")
    return value


def condition(language: Column, least: Column, most: Column, exchanges: Column) -> Column:
    """The sentence that states the wanted length."""
    danish = F.format_string("Samtalen skal fylde %d til %d tokens over %d udvekslinger.", least, most, exchanges)
    return F.when(language == "da", danish).otherwise(F.format_string("The conversation should take %d to %d tokens over %d exchanges.", least, most, exchanges))


def profile_sentence(*parts: Column) -> Column:
    """The non-empty parts of a persona, joined."""
    return F.array_join(F.filter(F.array(*parts), lambda p: F.coalesce(p, F.lit("")) != ""), "; ")


def shifted(seed: Column, by: Column) -> Column:
    """A seed some steps on, within a long."""
    return F.pmod(seed.cast("decimal(20,0)") + by.cast("decimal(20,0)"), F.lit(2**63 - 1).cast("decimal(20,0)")).cast("long")


def instruction_accepted(verdict: Column, lane: Column, least: int = 4) -> Column:
    """Conjunction of a request verdict (N28); nulls reject."""
    flags = [verdict[name] for name, kind in fields_of(INSTRUCTION_VERDICT).items() if kind == "boolean"]
    return validation.all_true(verdict["language"] == lane, verdict["quality"] >= least, *flags)


def turn_accepted(verdict: Column, lane: Column) -> Column:
    """Conjunction of a turn verdict (N29); nulls reject."""
    return validation.all_true(verdict["accepted"], verdict["coherent"], verdict["safe"], verdict["language"] == lane, verdict["instruction_quality"] >= 4, verdict["response_quality"] >= 4)


def audit_requests(rows: DataFrame, teacher: Callable[..., dict], lane: str = "language_lane", text: str = "instruction", least: int = 4, detected: Column | None = None, confidence: Column | None = None) -> DataFrame:
    """``rows`` with ``instruction_audit``: rejected by the native rules, or judged.

    Only survivors reach the teacher. ``detected`` and ``confidence`` are those of
    any language detector, or none. A failed call is in ``audit_error``: the shard
    is to be judged again. A ``seed`` column gives the seeds of the calls.
    """
    none = F.lit(None)
    detected, confidence = none.cast("string") if detected is None else detected, none.cast("double") if confidence is None else confidence
    native = rows.withColumn("_v", validation.request_verdict(F.col(text), F.col(lane), detected, confidence))
    seed = F.col("seed").cast("long") if "seed" in rows.columns else F.lit(0).cast("long")
    judge = _judge(teacher, "Judge this request and answer with a JSON object.", INSTRUCTION_VERDICT)
    judged = native.where("_v.accepted").withColumn("_j", judge(F.col(text), seed, F.col(lane)))
    verdict = F.from_json("_j.verdict", INSTRUCTION_VERDICT)
    names = [name for name in fields_of(INSTRUCTION_VERDICT) if name not in ("accepted", "reason")]
    kinds = fields_of(INSTRUCTION_VERDICT)
    judged = judged.withColumn("_p", verdict).withColumn("instruction_audit", F.struct(
        instruction_accepted(F.col("_p"), F.col(lane), least).alias("accepted"), F.when(F.col("_p").isNull(), "judge error").otherwise(F.coalesce("_p.reason", F.lit("judged"))).alias("reason"), F.lit(False).alias("deterministic"),
        F.col("_v.uncertain").alias("deterministic_language_uncertain"), F.col("_j.error").alias("audit_error"), *(F.col(f"_p.{n}").alias(n) for n in names),
    )).drop("_j", "_p")
    rejected = native.where("not _v.accepted").withColumn("instruction_audit", F.struct(
        F.lit(False).alias("accepted"), F.col("_v.reason").alias("reason"), F.lit(True).alias("deterministic"), F.col("_v.uncertain").alias("deterministic_language_uncertain"),
        none.cast("string").alias("audit_error"), *(none.cast(kinds[n]).alias(n) for n in names),
    ))
    return judged.unionByName(rejected).drop("_v")


def audit_turns(turns: DataFrame, teacher: Callable[..., dict], lane: str = "language_lane", detected: Column | None = None, confidence: Column | None = None) -> DataFrame:
    """``turns`` with ``accepted, reason, deterministic, audit_error`` (G8): gates first, then the judge.

    ``turns`` has id, question, answer, finish_reason and lane. A ``length_valid``
    column gates them (F9), a ``transcript`` column is what the judge reads instead
    of the exchange alone, and ``seed`` with ``turn`` gives the seeds of the calls.
    """
    none = F.lit(None)
    pair = validation.pair_verdict(F.col("question"), F.col("answer"), F.col(lane), none.cast("string") if detected is None else detected, none.cast("double") if confidence is None else confidence)
    length = F.coalesce("length_valid", F.lit(False)) if "length_valid" in turns.columns else F.lit(True)
    completion = validation.completion_reason(F.col("answer"), F.col("finish_reason"))
    gate = F.when(~length, "length outside its band").when(~F.col("finish_reason").eqNullSafe("stop"), "not stopped").when(completion != "complete", completion).when(~pair["accepted"], pair["reason"])
    gated = turns.withColumn("_gate", gate)
    said = F.to_json("transcript") if "transcript" in turns.columns else F.to_json(F.struct("question", "answer"))
    seed = shifted(F.col("seed"), F.col("turn")) if {"seed", "turn"} <= set(turns.columns) else F.lit(0).cast("long")
    open_ = gated.where("_gate is null").withColumn("_j", _judge(teacher, "Judge this exchange and answer with a JSON object.", TURN_VERDICT)(said, seed, F.col(lane)))
    verdict = F.from_json("_j.verdict", TURN_VERDICT)
    judged = open_.withColumn("accepted", turn_accepted(verdict, F.col(lane))).withColumn("reason", F.coalesce(verdict["reason"], F.lit("judge error"))).withColumn("deterministic", F.lit(False)).withColumn("audit_error", F.col("_j.error")).drop("_j")
    stopped = gated.where("_gate is not null").withColumn("accepted", F.lit(False)).withColumn("reason", F.col("_gate")).withColumn("deterministic", F.lit(True)).withColumn("audit_error", none.cast("string"))
    return judged.unionByName(stopped).drop("_gate")


def _judge(teacher: Callable[..., dict], prompt: str, verdict: str, concurrency: int = 32):
    """A pandas UDF from text, seed and lane to ``verdict`` (JSON) and ``error``. A verdict cut by its length is
    null without an error: its row is rejected, while other failures are to be tried again."""

    @F.pandas_udf("verdict string, error string")
    def judge(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        def one(text, seed, lane):
            try:
                result = teacher([{"role": "user", "content": f"{prompt}\nLanguage: {lane}\n\n{text}"}], {"temperature": 0.0, "max_tokens": 384}, int(seed) + JUDGE_SEED, verdict_schema(verdict, ["da", "en"]))
                if result.get("finish_reason") == "length":
                    return None, None
                return json.dumps(checked_verdict(result, verdict)), None
            except Exception as problem:  # the row keeps its failure
                return None, repr(problem)[-4000:]

        with ThreadPoolExecutor(concurrency) as pool:
            for texts, seeds, lanes in batches:
                yield pd.DataFrame(list(pool.map(one, texts, seeds, lanes)), columns=["verdict", "error"], dtype=object)

    return judge


def write_requests(rows: DataFrame, teacher: Callable[..., dict], prompts: list[str], sampling: dict | None = None) -> DataFrame:
    """``rows`` with ``instruction, finish_reason, generation_attempt, error``: a request each, asked for by the first of
    the ``prompts`` columns whose answer ends by itself (G5). Only an answer cut by its length is asked for again."""
    settings, kinds = sampling or {}, ", ".join(f"`{n}` {k}" for n, k in rows.dtypes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def one(seed, *asked):
            try:
                for attempt, prompt in enumerate(asked):
                    result = teacher([{"role": "user", "content": prompt}], settings, int(seed) + attempt * ATTEMPT_SEED)
                    if result.get("finish_reason") != "length":
                        return result["content"], result.get("finish_reason"), attempt, None
                return None, "length", len(asked) - 1, "the request was cut by its length"
            except Exception as problem:  # the row keeps its failure
                return None, None, None, repr(problem)[-4000:]

        with ThreadPoolExecutor(32) as pool:
            for batch in batches:
                out = list(pool.map(one, batch["seed"], *(batch[p] for p in prompts)))
                more = pd.DataFrame(out, columns=["instruction", "finish_reason", "generation_attempt", "error"], dtype=object)
                yield pd.concat([batch.reset_index(drop=True), more.astype({"generation_attempt": "Int32"})], axis=1)

    return rows.mapInPandas(run, f"{kinds}, instruction string, finish_reason string, generation_attempt int, error string").drop(*prompts)


def user_turn_budget(cap: int, current: int, remaining: int, most: int, least_user: int = 64, least_assistant: int = 192) -> int:
    """Tokens of the next question (N14): a third of an even share, at least ``least_user``, within what all later turns leave."""
    reserve = least_assistant + (remaining - 1) * (least_user + least_assistant + 12)
    return min(most, cap - current - reserve, max(least_user, (cap - current) // max(1, 3 * remaining)))


def answer_turn_budget(cap: int, prompt: int, future: int, most: int, limit: int, least_user: int = 64, least_assistant: int = 192) -> int:
    """Tokens of the next answer (N15): an even share of what the ``future`` questions leave, at least ``least_assistant``, within the cap and the limit."""
    reserve = future * (least_user + 12)
    return min(most, cap - prompt - reserve - 4, limit - prompt - 4, max(least_assistant, (cap - prompt - reserve) // (future + 1)))


def completion_fault(text: str | None, finish: str | None) -> str | None:
    """Why a completion is not whole, or null: ``validation.completion_reason`` of one text."""
    body = re.sub(r"\s+$", "", text or "")
    visible = body.rstrip("*_`~ ")
    words = re.findall(r"[A-Za-zÀ-ÖØ-öø-ÿ]+", visible.lower())
    if finish != "stop":
        return "not stopped"
    if not body:
        return "empty generation"
    if body.count("```") % 2:
        return "unclosed code fence"
    if words and words[-1] in T.UNFINISHED:
        return "generation ends with an incomplete function word"
    return None if visible and visible[-1] in T.TERMINAL else "generation has no complete terminal boundary"


def assistant_budget(residual: int, remaining: int, most: int) -> int:
    """Tokens of the next answer: a fair share of what is left, less four for markers."""
    return min(most, residual - 4, (2 * residual) // (3 * remaining))


def user_budget(residual: int, remaining: int, least_user: int, least_assistant: int) -> int:
    """Tokens of the next question: what is left after reserving the least of all later turns, or a fair share."""
    reserved = remaining * least_assistant + (remaining - 1) * least_user
    return min(residual - reserved, residual // (3 * remaining))


def respond(rows: DataFrame, teacher: Callable[..., dict], count: Callable[[str], int], most: int = 3968, retries: int = 4, least_user: int = 64, least_assistant: int = 192, limit: int = 4096, most_user: int = 512, most_assistant: int = 1024) -> DataFrame:
    """Whole conversations from requests (G7): ``messages, turn_token_usage, finish_reason, error``.

    ``rows`` has ``id, instruction, desired_exchanges, seed``, and may have
    ``max_tokens``, the end of its band, ``attempts``, those of its task, and
    ``language_lane``. Every turn depends on the tokens of the turns before it, so a
    conversation is made in one row. A turn is asked for until it is whole, at most
    ``retries`` times; a conversation without room for its next turn ends there.
    """
    schema = "id string, messages array<struct<role:string,content:string>>, turn_token_usage array<struct<exchange:int,actual_output_tokens:int,finish_reason:string>>, finish_reason string, error string"
    extras = ["max_tokens", "attempts", "language_lane"]

    def turn(messages, budget, seed, words):
        for attempt in range(retries):
            asked = messages(max(24, int(budget * words * 0.78**attempt)))
            result = teacher(asked, {"max_tokens": budget}, seed + attempt * ATTEMPT_SEED)
            fault = completion_fault(result["content"], result.get("finish_reason"))
            if not fault:
                return result
        raise ValueError(f"no whole turn in {retries} attempts: {fault}")

    def talk(instruction: str, wanted: int, seed: int, cap: int, lane: str):
        size = lambda: sum(count(m["content"]) for m in messages)
        messages, usage, share = [{"role": "user", "content": instruction}], [], 0.42 if lane == "da" else 0.6
        for exchange in range(wanted):
            if exchange:
                budget = user_turn_budget(cap, size(), wanted - exchange, most_user, least_user, least_assistant)
                if budget < least_user:
                    return messages, usage, "insufficient_user_budget", None
                follow = lambda words: [*messages, {"role": "user", "content": json.dumps({"follow_up": True, "most_words": words})}]
                messages.append({"role": "user", "content": turn(follow, budget, seed + 2 * exchange + 1, share)["content"]})
            budget = answer_turn_budget(cap, size(), wanted - exchange - 1, most_assistant, limit, least_user, least_assistant)
            if budget < least_assistant:
                return messages[:-1] if exchange else messages, usage, "insufficient_assistant_budget", None
            control = lambda words: [{"role": "system", "content": prompts.answer_control_text(lane, words)}, *messages]
            result = turn(control, budget, seed + 2 * exchange, share)
            messages.append({"role": "assistant", "content": result["content"]})
            usage.append({"exchange": exchange + 1, "actual_output_tokens": count(result["content"]), "finish_reason": result.get("finish_reason")})
        return messages, usage, "stop", None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for id_, instruction, wanted, seed, cap, attempts, lane in zip(*(batch[c] for c in ("id", "instruction", "desired_exchanges", "seed", *extras))):
                try:
                    out.append((id_, *talk(instruction, int(wanted), int(seed) + int(attempts) * TASK_SEED, min(int(cap), most), lane)))
                except Exception as problem:  # the row keeps its failure
                    out.append((id_, None, None, None, repr(problem)[-4000:]))
            yield pd.DataFrame(out, columns=["id", "messages", "turn_token_usage", "finish_reason", "error"])

    picked = [F.col(c) if c in rows.columns else F.lit(default).alias(c) for c, default in zip(extras, (most, 0, "en"))]
    return rows.select("id", "instruction", "desired_exchanges", "seed", *picked).mapInPandas(run, schema)


def personas(raw: DataFrame, noun: str = "the person", limit: int = 500) -> DataFrame:
    """Privacy-safe persona fields (P3, N4-N6): no names, no exact ages, blanks collapsed, at most ``limit`` characters."""
    clean = lambda c: F.left(F.regexp_replace(T.stripped(F.coalesce(F.col(c).cast("string"), F.lit(""))), rf"{T.BLANK}+", " "), F.lit(limit))
    return raw.select(
        F.col("uuid").alias("source_id"), T.age_band(F.coalesce(F.col("age").cast("string"), F.lit(""))).alias("age_band"), clean("occupation").alias("occupation"), clean("education_level").alias("education"),
        T.without_name(F.coalesce(F.nullif(clean("hobbies_and_interests"), F.lit("")), clean("skills_and_expertise")), F.coalesce("name", F.lit("")), noun).alias("interests"),
    )


def persona_store(raw: DataFrame, noun: str = "the person") -> DataFrame:
    """``language, position, source_id, payload`` of personas (G14, P3): positions from 0 in the order of their ids within a language.

    ``raw`` has language, source, uuid, name, age and the free fields of a source;
    lists are taken before plain texts where they hold something. Names, places
    and sex never get into a payload. Occupation and education keep 160 characters,
    the others 500.
    """
    def text(c: str, most: int = 500) -> Column:
        value = F.col(c).cast("string") if c in raw.columns else F.lit(None).cast("string")
        return F.left(F.regexp_replace(T.stripped(F.coalesce(value, F.lit(""))), rf"{T.BLANK}+", " "), F.lit(most))

    def listed(c: str) -> Column:
        return F.left(F.coalesce(F.nullif(F.array_join(F.col(f"{c}_list"), ", "), F.lit("")), text(c)), F.lit(500)) if f"{c}_list" in raw.columns else text(c)

    name = F.coalesce("name", F.lit(""))
    interests = T.without_name(F.coalesce(F.nullif(listed("hobbies_and_interests"), F.lit("")), listed("skills_and_expertise")), name, noun)
    fields = F.struct(
        F.col("source"), T.age_band(F.coalesce(F.col("age").cast("string"), F.lit(""))).alias("age_band"), T.without_name(text("occupation", 160), name, noun).alias("occupation"),
        text("education_level", 160).alias("education"), interests.alias("interests"), F.when(F.col("language") == "da", F.lit("")).otherwise(T.without_name(text("profile"), name, noun)).alias("profile"),
    )
    rows = raw.select("language", F.col("uuid").alias("source_id"), F.to_json(fields).alias("payload"))
    return rows_.numbered(rows, ["language"], ["source_id"]).select("language", "position", "source_id", "payload")


def write_persona_store(spark, store: DataFrame, path: str) -> DataFrame:
    """Write a store by language and give its totals (S11, A25): ids are unique and positions run from 0 without a gap, or it is refused."""
    from strataloom.sources.files import write_table

    write_table(store, path, partition_by=["language"])
    written = spark.read.parquet(path)
    totals = written.groupBy("language").agg(F.count("*").alias("rows"), F.count_distinct("source_id").alias("ids"), F.count_distinct("position").alias("positions"), F.min("position").alias("first"), F.max("position").alias("last"))
    wrong = totals.where("ids <> rows or positions <> rows or first <> 0 or last <> rows - 1")
    if not wrong.isEmpty():
        raise ValueError(f"the persona store is not sound: {[r.asDict() for r in wrong.limit(5).collect()]}")
    return totals.select("language", "rows")
