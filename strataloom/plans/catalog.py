"""The queries of the core operators and the same results in DuckDB's SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataloom.functions import text as T
from strataloom.operators import diversity, finalize, ledger, planning, prompts, rows, selection, validation
from strataloom.session import durable, shared_folder
from strataloom.sources import files
from strataloom.sources.tables import table
from strataloom.streaming import phases

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

_BLANK, _CODE, _LEAK, _CONTROL = (p.replace("'", "''") for p in (T.BLANK, T.CODE, T.LEAK, T.CONTROL))
_LATEST = "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ingested_at DESC) AS rn FROM {0}) WHERE rn = 1"
_REQUESTS = f"requests AS ({_LATEST.format('instruction_rows')})"
_TALKS = f"talks AS ({_LATEST.format('audit_rows')})"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_BLANK}+|{_BLANK}+$', '', 'g')"


def _fold(x: str) -> str:
    return f"regexp_replace({_strip(f"replace(lower({x}), 'ß', 'ss')")}, '{_BLANK}+', ' ', 'g')"


_LANE = "substring(lower(trim(language_lane)), 1, 2)"
_UNFINISHED = ", ".join(f"'{w}'" for w in T.UNFINISHED)
#: Parameters of the selection queries.
TARGETS, SHARES, SEED, LIMIT = {"da": 300, "en": 250}, {"accessible": 0.2, "general": 0.5, "advanced": 0.2, "specialist": 0.1}, 7, 3968


def query(sql: str | None = None):
    """Register a query under the name of its function."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def lane_of(column: str = "language_lane") -> Column:
    """The two letters of a lane."""
    return F.substring(F.lower(F.trim(column)), 1, 2)


def requests(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """The latest row of every request."""
    df = table(spark, d, "instruction_rows")
    return rows.latest(df.select("id", *columns, "ingested_at") if columns else df)


def talks(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """The latest row of every conversation."""
    df = table(spark, d, "audit_rows")
    return rows.latest(df.select("id", *columns, "ingested_at") if columns else df)


@query("SELECT id, language_lane, diversity.topic_id AS topic_id, length(instruction) AS n_chars FROM instruction_rows")
def scan_projection(spark, d):
    return table(spark, d, "instruction_rows").select("id", "language_lane", F.col("diversity.topic_id").alias("topic_id"), F.length("instruction").alias("n_chars"))


@query(f"SELECT doc_id FROM documents WHERE regexp_matches(text, '{_CONTROL}')")
def filter_control_chars(spark, d):
    return table(spark, d, "documents").where(T.has_control(F.col("text"))).select("doc_id")


@query(f"SELECT doc_id, regexp_matches(lower(text), '{_CODE}') AS code, length(text) < 80 AS short FROM documents")
def filter_code_or_short(spark, d):
    return table(spark, d, "documents").select("doc_id", T.looks_like_code(F.col("text")).alias("code"), (F.length("text") < 80).alias("short"))


@query(f"WITH {_REQUESTS} SELECT id, regexp_matches(lower(instruction), '{_LEAK}') AS leaks FROM requests")
def filter_meta_leak(spark, d):
    return rows.latest(table(spark, d, "instruction_rows").select("id", "ingested_at", T.leaks_prompt(F.col("instruction")).alias("leaks"))).select("id", "leaks")


_BY_LANGUAGE = """
  WHEN detected IS NULL THEN 'language audit required' WHEN sure < 0.8 THEN 'language audit required'
  WHEN detected IS DISTINCT FROM lane THEN 'language mismatch' ELSE 'ok' END AS reason"""


@query(f"""WITH {_REQUESTS}, s AS (SELECT id, {_strip('instruction')} AS t, {_LANE} AS lane, validation_result.detected_language AS detected,
    CASE WHEN validation_result.uncertain_language THEN 0.5 ELSE 0.99 END AS sure FROM requests),
  v AS (SELECT id, CASE WHEN t = '' THEN 'empty instruction' WHEN regexp_matches(t, '{_CONTROL}') THEN 'invalid control character'
    WHEN regexp_matches(lower(t), '{_LEAK}') THEN 'generation-control leakage' WHEN length(t) < 20 THEN 'instruction too short to be useful'
    WHEN regexp_matches(lower(t), '{_CODE}') OR length(t) < 80 THEN 'language audit required' {_BY_LANGUAGE} FROM s)
  SELECT id, reason IN ('ok', 'language audit required') AS accepted, reason FROM v""")
def validate_instruction(spark, d):
    df = table(spark, d, "instruction_rows")
    sure = F.when(F.col("validation_result.uncertain_language"), 0.5).otherwise(0.99)
    verdict = validation.request_verdict(F.col("instruction"), lane_of(), F.col("validation_result.detected_language"), sure)
    return rows.latest(df.select("id", "ingested_at", verdict.alias("v")).select("id", "ingested_at", "v.accepted", "v.reason")).drop("ingested_at")


_TURNS = f"""{_TALKS}, places AS (SELECT id, language_lane, messages, turn_token_usage, unnest(range(1, len(messages) + 1)) AS p FROM talks),
  turns AS (SELECT id, language_lane, p - 1 AS position, len(list_filter(messages[1:p], lambda m: m.role = 'assistant')) AS turn,
    CASE WHEN p > 1 THEN messages[p - 1].content END AS question, messages[p].content AS answer, messages[1:p] AS transcript, turn_token_usage FROM places WHERE messages[p].role = 'assistant'),
  used AS (SELECT *, turn_token_usage[turn].finish_reason AS finish_reason, turn_token_usage[turn].actual_output_tokens AS output_tokens FROM turns)"""


def _turns(spark, d, **wanted):
    """What is wanted of each assistant message of the latest conversations; only that is shuffled."""
    df = table(spark, d, "audit_rows").withColumn("said", rows.turn_array(F.col("messages"), F.col("turn_token_usage")))
    each = F.transform("said", lambda t: F.struct(t["turn"].alias("turn"), *(make(t).alias(name) for name, make in wanted.items())))
    return rows.latest(df.select("id", "ingested_at", each.alias("turns"))).select("id", F.explode("turns").alias("t")).select("id", "t.*")


@query(f"""WITH {_TURNS}, b AS (SELECT *, regexp_replace(coalesce(answer, ''), '{_BLANK}+$', '') AS body FROM used),
  v AS (SELECT *, regexp_replace(body, '[*_`~ ]+$', '') AS visible FROM b)
  SELECT id, turn, CASE WHEN finish_reason IS DISTINCT FROM 'stop' THEN 'not stopped' WHEN body = '' THEN 'empty generation'
    WHEN (len(string_split(body, '```')) - 1) % 2 = 1 THEN 'unclosed code fence'
    WHEN coalesce(regexp_extract_all(lower(visible), '[A-Za-zÀ-ÖØ-öø-ÿ]+')[-1], '') IN ({_UNFINISHED}) THEN 'generation ends with an incomplete function word'
    WHEN visible = '' OR NOT contains('{T.TERMINAL.replace("'", "''")}', right(visible, 1)) THEN 'generation has no complete terminal boundary' ELSE 'complete' END AS reason FROM v""")
def validate_completion(spark, d):
    return _turns(spark, d, reason=lambda t: validation.completion_reason(t["answer"], t["finish_reason"]))


@query(f"""WITH {_TURNS}, s AS (SELECT id, turn, question AS q, answer AS a, concat(question, chr(10), answer) AS t, NULL::VARCHAR AS detected, 0.0 AS sure, {_LANE} AS lane FROM used)
  SELECT id, turn, CASE WHEN coalesce({_strip('q')}, '') = '' OR coalesce({_strip('a')}, '') = '' THEN 'empty instruction or response'
    WHEN regexp_matches(t, '{_CONTROL}') THEN 'invalid control character' WHEN length(t) < 80 OR regexp_matches(lower(t), '{_CODE}') THEN 'language audit required' {_BY_LANGUAGE} FROM s""")
def validate_pair(spark, d):
    none = F.lit(None)
    return _turns(spark, d, reason=lambda t: validation.pair_verdict(t["question"], t["answer"], none.cast("string"), none.cast("string"), none.cast("double"))["reason"])


@query(f"""WITH c AS (SELECT doc_id, {_strip("split_part(text, 'Assistant:', 1)")} AS t FROM documents)
  SELECT doc_id, CASE WHEN t = '' OR contains(t, '<|') OR contains(t, '</s>') THEN NULL ELSE t END AS text, CASE WHEN t = '' THEN 'empty' WHEN contains(t, '<|') OR contains(t, '</s>') THEN 'control token' END AS error FROM c""")
def sanitize_text(spark, d):
    return table(spark, d, "documents").select("doc_id", validation.sanitized(F.col("text"), "Assistant:", ["<|", "</s>"]).alias("s")).select("doc_id", "s.text", "s.error")


@query(f"SELECT doc_id, sha256({_fold('text')}) AS digest FROM documents")
def prompt_digest(spark, d):
    return table(spark, d, "documents").select("doc_id", rows.digest_of_prompt(F.col("text")).alias("digest"))


@query(f"SELECT doc_id, source FROM (SELECT *, row_number() OVER (PARTITION BY sha256({_fold('text')}) ORDER BY created_at, doc_id) AS rn FROM documents) WHERE rn = 1")
def exact_dedup_first(spark, d):
    df = table(spark, d, "documents").select("doc_id", "source", "created_at", rows.digest_of_prompt(F.col("text")).alias("digest"))
    return rows.keep_first(df, F.col("digest"), ["created_at", "doc_id"]).select("doc_id", "source")


_KEPT = f"""{_TALKS}, first AS (SELECT *, {_LANE} AS language, list_filter(messages, lambda m: m.role = 'user')[1].content AS prompt FROM talks WHERE coalesce(audit.accepted, false)),
  seen AS (SELECT *, row_number() OVER (PARTITION BY sha256({_fold('prompt')}) ORDER BY ingested_at, id) AS nth FROM first),
  kept AS (SELECT s.id, s.language, s.user_complexity_level AS complexity, s.length_band AS band, s.rendered_token_count AS tokens,
    coalesce(s.rendered_token_count BETWEEN b.min_tokens AND b.max_tokens AND s.rendered_token_count <= {LIMIT}, false) AS in_band FROM seen s LEFT JOIN length_bands b ON s.length_band = b.length_band WHERE nth = 1)"""


def _kept(spark, d):
    df = table(spark, d, "audit_rows").select(
        "id", "ingested_at", F.coalesce("audit.accepted", F.lit(False)).alias("accepted"), rows.digest_of_prompt(rows.first_user(F.col("messages"))).alias("digest"), lane_of().alias("language"),
        F.col("user_complexity_level").alias("complexity"), F.col("length_band").alias("band"), F.col("rendered_token_count").alias("tokens"),
    )
    df = rows.keep_first(rows.latest(df).where("accepted"), F.col("digest"), ["ingested_at", "id"]).select("id", "language", "complexity", "band", "tokens")
    return rows.banded(df, table(spark, d, "length_bands"), "band", F.col("tokens"), LIMIT)


@query(f"WITH {_KEPT} SELECT id, language, complexity, band, tokens, in_band FROM kept")
def dedup_then_band(spark, d):
    return _kept(spark, d).select("id", "language", "complexity", "band", "tokens", "in_band")


@query("""WITH g AS (SELECT length_band AS band, 17 * share AS raw, floor(17 * share) AS base FROM length_bands)
  SELECT band, CAST(base + CASE WHEN row_number() OVER (ORDER BY raw - base DESC, band DESC) <= 17 - sum(base) OVER () THEN 1 ELSE 0 END AS BIGINT) AS quota FROM g""")
def apportion_largest_remainder(spark, d):
    df = table(spark, d, "length_bands").select(F.lit(0).alias("scope"), F.col("length_band").alias("band"), "share")
    return planning.apportion(df, ["scope"], "band", F.lit(17), F.col("share")).select("band", "quota")


def _quotas_sql(factor: float) -> str:
    lanes = ", ".join(f"('{k}', CAST(ceil({v} * {factor}::DOUBLE) AS BIGINT))" for k, v in TARGETS.items())
    shares = ", ".join(f"('{k}', {v}::DOUBLE)" for k, v in SHARES.items())
    return f"""lanes(language, target) AS (VALUES {lanes}), complexities(complexity, share) AS (VALUES {shares}),
  g AS (SELECT language, complexity, target, target * share AS raw, floor(target * share) AS base FROM lanes, complexities),
  c AS (SELECT language, complexity, CAST(base + CASE WHEN row_number() OVER (PARTITION BY language ORDER BY raw - base DESC, complexity DESC) <= target - sum(base) OVER (PARTITION BY language) THEN 1 ELSE 0 END AS BIGINT) AS target FROM g),
  h AS (SELECT language, complexity, length_band AS band, target, target * share AS raw, floor(target * share) AS base FROM c, length_bands),
  quotas AS (SELECT language, complexity, band, CAST(base + CASE WHEN row_number() OVER (PARTITION BY language, complexity ORDER BY raw - base DESC, band DESC) <= target - sum(base) OVER (PARTITION BY language, complexity) THEN 1 ELSE 0 END AS BIGINT) AS quota FROM h)"""


def _quotas(spark, d, factor: float = 1.0):
    lanes = spark.createDataFrame(list(TARGETS.items()), "language string, target long")
    shares = spark.createDataFrame(list(SHARES.items()), "complexity string, share double")
    return planning.cell_quotas(lanes, shares, table(spark, d, "length_bands"), factor)


@query(f"WITH {_quotas_sql(1.05)} SELECT language, complexity, band, quota FROM quotas")
def cell_quotas_buffered(spark, d):
    return _quotas(spark, d, 1.05)


@query(f"""WITH {_quotas_sql(1.0)}, s AS (SELECT language, complexity, band, quota, unnest(range(0, (quota - 1) // 16 + 1)) AS shard FROM quotas WHERE quota > 0),
  r AS (SELECT *, least(16, quota - shard * 16) AS n FROM s)
  SELECT format('{{}}-{{}}-{{}}-{{:06d}}', language, complexity, band, shard) AS shard_key, language, complexity, band, n AS rows,
    CAST(coalesce(sum(n) OVER (PARTITION BY language ORDER BY complexity, band, shard ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS assignment_start FROM r""")
def shard_plan(spark, d):
    return planning.shard_plan(_quotas(spark, d), 16)


@query("""WITH n AS (SELECT doc_id, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode('strataloom:' || source || ':' || doc_id || ':7')) AS h FROM documents)
  SELECT doc_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || format('{:02x}', (('0x' || substr(h, 17, 2))::INTEGER & 63) | 128) || substr(h, 19, 2) || '-' || substr(h, 21, 12) AS id FROM n""")
def uuid5_ids(spark, d):
    return table(spark, d, "documents").select("doc_id", planning.row_ids(F.col("source"), F.col("doc_id"), F.lit(7)).alias("id"))


@query("SELECT shard_key, sha256('7:response:' || shard_key) AS place FROM (SELECT DISTINCT shard_key FROM tasks)")
def stable_hash_order(spark, d):
    return table(spark, d, "tasks").select("shard_key").distinct().withColumn("place", selection.stable_order(SEED, "response", F.col("shard_key")))


@query(f"""WITH {_REQUESTS}, s AS (SELECT id, {_LANE} AS lane FROM requests) SELECT id, lane, rn AS sample_rank FROM
  (SELECT *, row_number() OVER (PARTITION BY lane ORDER BY sha256('probe:' || id), id) AS rn FROM s) WHERE rn <= 100""")
def hash_sample_100(spark, d):
    df = requests(spark, d, "language_lane").select("id", lane_of().alias("lane"))
    return diversity.hash_sample(df, ["lane"], "id", "probe").select("id", "lane", F.col("sample_rank"))


_COUNTS = f"""{_REQUESTS}, parts AS (SELECT shard_key, count_if(coalesce(validation_result.accepted, true)) AS emitted, count_if(NOT coalesce(validation_result.accepted, true)) AS unresolved FROM requests GROUP BY shard_key),
  cells AS (SELECT split_part(shard_key, '-', 1) AS language, split_part(shard_key, '-', 2) AS complexity, split_part(shard_key, '-', 3) AS band, CAST(sum(emitted) AS BIGINT) AS emitted, CAST(sum(unresolved) AS BIGINT) AS unresolved FROM parts GROUP BY 1, 2, 3),
  lane AS (SELECT language, sum(emitted) AS e, sum(unresolved) AS u FROM cells GROUP BY 1),
  kept AS (SELECT c.*, coalesce(c.emitted / nullif(c.emitted + c.unresolved, 0), e / nullif(e + u, 0), 0.97) AS retention FROM cells c JOIN lane USING (language))"""


def _shard_counts(spark, d):
    ok = F.coalesce("validation_result.accepted", F.lit(True))
    parts = requests(spark, d, "shard_key", "validation_result").groupBy("shard_key").agg(F.count_if(ok).alias("emitted"), F.count_if(~ok).alias("unresolved"))
    cell = F.split("shard_key", "-", 4)
    return parts.select("shard_key", cell[0].alias("language"), cell[1].alias("complexity"), cell[2].alias("band"), "emitted", "unresolved")


def _retention(spark, d):
    cells = _shard_counts(spark, d).groupBy("language", "complexity", "band").agg(F.sum("emitted").alias("emitted"), F.sum("unresolved").alias("unresolved"))
    return selection.retention(cells, 0.97)


@query(f"WITH {_COUNTS} SELECT language, complexity, band, emitted, unresolved, round(retention, 9) AS retention FROM kept")
def retention_fallback(spark, d):
    return _retention(spark, d).select("language", "complexity", "band", "emitted", "unresolved", F.round("retention", 9).alias("retention"))


def _selection_sql(stage: str) -> str:
    return f"""{_COUNTS}, t AS (SELECT shard_key, status FROM tasks WHERE phase = '{stage}'),
  p AS (SELECT t.shard_key, t.status, k.language, k.complexity, k.band, k.retention, x.emitted FROM t JOIN parts x USING (shard_key)
    JOIN kept k ON split_part(shard_key, '-', 1) = k.language AND split_part(shard_key, '-', 2) = k.complexity AND split_part(shard_key, '-', 3) = k.band),
  b AS (SELECT language, complexity, band, CAST(ceil(0.6 * sum(emitted)) AS BIGINT) AS quota, coalesce(sum(emitted) FILTER (status IN ('done', 'running')), 0) AS baseline FROM p GROUP BY 1, 2, 3),
  picked AS (SELECT p.shard_key, p.status, p.language, p.complexity, p.band, coalesce(sum(round(p.emitted * p.retention, 6)) OVER (PARTITION BY p.language, p.complexity, p.band ORDER BY sha256('7:{stage}:' || shard_key)
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < greatest(0, quota - baseline) AS selected FROM p JOIN b USING (language, complexity, band) WHERE status IN ('pending', 'held'))"""


def _selection(spark, d, stage: str):
    cell = ["language", "complexity", "band"]
    tasks = table(spark, d, "tasks").where(F.col("phase") == stage).select("shard_key", "status")
    p = tasks.join(_shard_counts(spark, d), "shard_key").join(_retention(spark, d).select(*cell, "retention"), cell)
    b = p.groupBy(*cell).agg(F.ceil(0.6 * F.sum("emitted")).alias("quota"), F.coalesce(F.sum(F.when(F.col("status").isin("done", "running"), F.col("emitted"))), F.lit(0)).alias("baseline"))
    open_ = p.where(F.col("status").isin("pending", "held")).join(b, cell)
    need = F.greatest(F.lit(0), F.col("quota") - F.col("baseline"))
    return selection.take_until(open_, cell, need, F.round(F.col("emitted") * F.col("retention"), 6), selection.stable_order(SEED, stage, F.col("shard_key")))


@query(f"WITH {_selection_sql('response')} SELECT shard_key, language, complexity, band, selected FROM picked")
def select_prefix_quota(spark, d):
    return _selection(spark, d, "response").select("shard_key", "language", "complexity", "band", "selected")


@query(f"WITH {_selection_sql('instruction_audit')} SELECT shard_key, language, complexity, band, selected FROM picked")
def select_audit_prefix(spark, d):
    return _selection(spark, d, "instruction_audit").select("shard_key", "language", "complexity", "band", "selected")


@query(f"""WITH {_selection_sql('response')} SELECT t.id, t.shard_key, CASE WHEN t.status = 'pending' AND s.shard_key IS NULL THEN 'held' WHEN t.status = 'held' AND s.shard_key IS NOT NULL THEN 'pending' ELSE t.status END AS status
  FROM tasks t LEFT JOIN (SELECT shard_key FROM picked WHERE selected) s USING (shard_key) WHERE t.phase = 'response'""")
def hold_release(spark, d):
    picked = _selection(spark, d, "response").where("selected")
    return selection.hold_and_release(table(spark, d, "tasks").where("phase = 'response'"), picked).select("id", "shard_key", "status")


@query(f"WITH {_selection_sql('response')} SELECT shard_key FROM tasks WHERE phase = 'response' AND status = 'done' AND shard_key NOT IN (SELECT shard_key FROM picked WHERE selected)")
def completed_not_selected(spark, d):
    done = table(spark, d, "tasks").where("phase = 'response' and status = 'done'").select("shard_key")
    return selection.outside(done, _selection(spark, d, "response").where("selected"))


@query("""WITH n AS (SELECT DISTINCT 'export' AS phase, shard_key FROM instruction_rows UNION SELECT DISTINCT 'response', shard_key FROM instruction_rows),
  f AS (SELECT * FROM n WHERE NOT EXISTS (SELECT 1 FROM tasks t WHERE t.phase = n.phase AND t.shard_key = n.shard_key))
  SELECT (SELECT max(id) FROM tasks) + row_number() OVER (ORDER BY phase, shard_key) AS id, phase, shard_key, 'pending' AS status, 0 AS attempts FROM f""")
def enqueue_new(spark, d):
    keys = table(spark, d, "instruction_rows").select("shard_key").distinct()
    new = keys.select(F.explode(F.array(F.lit("export"), F.lit("response"))).alias("phase"), "shard_key", F.lit("{}").alias("payload"))
    return ledger.enqueue(table(spark, d, "tasks"), new).select("id", "phase", "shard_key", "status", "attempts")


@query("SELECT id, phase, shard_key FROM tasks WHERE phase = 'response' AND status = 'pending' ORDER BY id LIMIT 1")
def claim_next(spark, d):
    return ledger.next_pending(table(spark, d, "tasks"), "response").select("id", "phase", "shard_key")


@query("SELECT phase, status, count(*) AS tasks FROM tasks GROUP BY ALL")
def status_counts(spark, d):
    return ledger.status_counts(table(spark, d, "tasks"))


@query("""SELECT id, CASE WHEN status = 'running' AND claimed_at < now_ - 3600 THEN 'pending' ELSE status END AS status, CASE WHEN status = 'running' AND claimed_at < now_ - 3600 THEN NULL ELSE worker END AS worker
  FROM tasks, (SELECT max(claimed_at) AS now_ FROM tasks)""")
def stale_reset(spark, d):
    tasks = table(spark, d, "tasks")
    now = tasks.agg(F.max("claimed_at").alias("_now"))
    return ledger.reset_stale(tasks.crossJoin(F.broadcast(now)), F.col("_now"), 3600).select("id", "status", "worker")


@query("SELECT id, CASE WHEN status = 'failed' THEN 'pending' ELSE status END AS status, CASE WHEN status = 'failed' THEN 0 ELSE attempts END AS attempts FROM tasks")
def failed_reset(spark, d):
    return ledger.reset_failed(table(spark, d, "tasks")).select("id", "status", "attempts")


_CHOSEN = f"""{_KEPT}, {_quotas_sql(1.0).replace(' c AS', ' cc AS').replace('FROM c,', 'FROM cc,')}, ranked AS (SELECT k.*, quota, row_number() OVER (PARTITION BY k.language, k.complexity, k.band ORDER BY sha256(id), id) AS rn
    FROM kept k JOIN quotas q ON k.language = q.language AND k.complexity = q.complexity AND k.band = q.band WHERE in_band),
  chosen AS (SELECT * FROM ranked WHERE rn <= quota),
  cell_rows AS (SELECT q.language, q.complexity, q.band, (SELECT count(*) FROM ranked r WHERE r.language = q.language AND r.complexity = q.complexity AND r.band = q.band) AS available,
    count(c.id) AS n, CAST(coalesce(sum(c.tokens), 0) AS BIGINT) AS tokens, q.quota AS target FROM quotas q LEFT JOIN chosen c ON c.language = q.language AND c.complexity = q.complexity AND c.band = q.band GROUP BY q.language, q.complexity, q.band, q.quota),
  cell_out AS (SELECT language, complexity, band, available, n AS rows, tokens, target, greatest(n - target, 0) AS surplus, greatest(target - n, 0) AS shortfall FROM cell_rows)"""


def _chosen(spark, d):
    """The rows in band with whether they are chosen, and the quotas; the chain before is run once."""
    available, quotas = durable(_kept(spark, d).where("in_band").drop("in_band")), _quotas(spark, d)
    return finalize.flagged(available, ["language", "complexity", "band"], quotas), quotas


@query(f"WITH {_CHOSEN} SELECT id, language, complexity, band, tokens FROM chosen")
def topn_per_cell(spark, d):
    return _chosen(spark, d)[0].where("chosen").select("id", "language", "complexity", "band", "tokens")


@query(f"WITH {_CHOSEN} SELECT * FROM cell_out")
def cell_report(spark, d):
    return finalize.flagged_report(*_chosen(spark, d))


@query(f"WITH {_CHOSEN} SELECT language, band, " + ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in ("available", "rows", "tokens", "target", "surplus", "shortfall")) + " FROM cell_out GROUP BY language, band")
def band_report(spark, d):
    return finalize.band_report(finalize.flagged_report(*_chosen(spark, d)))


@query(f"""WITH {_CHOSEN} SELECT language, CAST(sum(rows) AS BIGINT) AS rows, CAST(sum(tokens) AS BIGINT) AS tokens, CAST(sum(target) AS BIGINT) AS target,
  CAST(greatest(sum(rows) - sum(target), 0) AS BIGINT) AS surplus, CAST(greatest(sum(target) - sum(rows), 0) AS BIGINT) AS shortfall FROM cell_out GROUP BY language""")
def lane_report(spark, d):
    return finalize.lane_report(finalize.flagged_report(*_chosen(spark, d)))


@query(f"""WITH {_KEPT} SELECT (SELECT count(*) FROM talks) AS conversations, (SELECT count(*) FROM talks WHERE NOT coalesce(audit.accepted, false)) AS not_accepted,
  (SELECT count(*) FROM first) - (SELECT count(*) FROM kept) AS repeated, (SELECT count(*) FROM kept WHERE NOT in_band) AS out_of_band""")
def final_totals(spark, d):
    all_ = rows.latest(table(spark, d, "audit_rows").select("id", "ingested_at", "audit")).agg(F.count("*").alias("conversations"), F.count_if(~F.coalesce("audit.accepted", F.lit(False))).alias("not_accepted"))
    kept = _kept(spark, d).agg(F.count("*").alias("kept"), F.count_if(~F.col("in_band")).alias("out_of_band"))
    return all_.crossJoin(kept).select("conversations", "not_accepted", (F.col("conversations") - F.col("not_accepted") - F.col("kept")).alias("repeated"), "out_of_band")


_DIMENSIONS = {"lane": _LANE, "complexity": "user_complexity_level", "band": "length_band", "domain": "diversity.topic_domain", "mode": "diversity.interaction_mode", "finish": "finish_reason", "exchanges": "desired_exchanges::VARCHAR"}


@query(f"WITH {_TALKS}, f AS (" + " UNION ALL ".join(f"SELECT '{k}' AS dimension, coalesce(nullif({v}, ''), 'unknown') AS value, coalesce(audit.accepted, false) AS ok FROM talks" for k, v in _DIMENSIONS.items()) + ") SELECT dimension, value, count_if(ok) AS accepted, count_if(NOT ok) AS rejected FROM f GROUP BY ALL")
def gate_counts_by_dimension(spark, d):
    df = talks(spark, d, "language_lane", "user_complexity_level", "length_band", "diversity", "finish_reason", "desired_exchanges", "audit")
    dims = {"lane": lane_of(), "complexity": F.col("user_complexity_level"), "band": F.col("length_band"), "domain": F.col("diversity.topic_domain"), "mode": F.col("diversity.interaction_mode"), "finish": F.col("finish_reason"), "exchanges": F.col("desired_exchanges")}
    return finalize.gate_counts(df, F.col("audit.accepted"), dims)


@query(f"WITH {_TALKS} SELECT id, list_filter(messages, lambda m: m.role = 'user')[1].content AS first_user, len(list_filter(messages, lambda m: m.role = 'assistant')) AS exchanges FROM talks")
def first_user_and_exchanges(spark, d):
    return talks(spark, d, "messages").select("id", rows.first_user(F.col("messages")).alias("first_user"), rows.exchanges(F.col("messages")).alias("exchanges"))


@query(f"WITH {_TURNS} SELECT id, turn, position, len(transcript) AS messages, CAST(list_sum(list_transform(transcript, lambda m: coalesce(length(m.content), 0))) AS BIGINT) AS chars, output_tokens FROM used")
def turn_transcripts(spark, d):
    said = rows.turn_array(F.col("messages"), F.col("turn_token_usage"))
    size = lambda n: F.aggregate(F.slice("sizes", F.lit(1), n), F.lit(0).cast("long"), lambda a, c: a + c)
    df = table(spark, d, "audit_rows").withColumn("sizes", F.transform("messages", lambda m: F.coalesce(F.length(m["content"]), F.lit(0)))).withColumn("said", said)
    each = F.transform("said", lambda t: F.struct(t["turn"].alias("turn"), t["position"].alias("position"), (t["position"] + 1).alias("messages"), size(t["position"] + 1).alias("chars"), t["output_tokens"].alias("output_tokens")))
    df = df.select("id", "ingested_at", each.alias("turns"))
    return rows.latest(df).select("id", F.explode("turns").alias("t")).select("id", "t.turn", "t.position", "t.messages", "t.chars", "t.output_tokens")


@query(f"WITH {_TALKS} SELECT id, coalesce(len(turn_token_usage), 0) > 0 AND len(list_filter(turn_token_usage, lambda u: u.finish_reason IS DISTINCT FROM 'stop')) = 0 AS accepted FROM talks")
def conversation_acceptance(spark, d):
    df = talks(spark, d, "turn_token_usage").withColumn("turns", F.transform("turn_token_usage", lambda u: F.struct((u["finish_reason"] == "stop").alias("accepted"))))
    return df.select("id", F.coalesce(validation.conversation_accepted(F.col("turns")), F.lit(False)).alias("accepted"))


@query(f"""WITH {_TALKS} SELECT id, coalesce(rendered_token_count BETWEEN min_tokens AND max_tokens AND rendered_token_count <= {LIMIT} AND actual_exchanges = desired_exchanges, false) AS length_valid
  FROM talks LEFT JOIN length_bands USING (length_band)""")
def length_validity(spark, d):
    df = talks(spark, d, "length_band", "rendered_token_count", "actual_exchanges", "desired_exchanges")
    df = rows.banded(df, table(spark, d, "length_bands"), "length_band", F.col("rendered_token_count"), LIMIT)
    return df.select("id", F.coalesce(F.col("in_band") & (F.col("actual_exchanges") == F.col("desired_exchanges")), F.lit(False)).alias("length_valid"))


@query(f"""WITH {_REQUESTS}, c AS (SELECT {_LANE} AS lane, coalesce(diversity.topic_id, '') AS v, count(*) AS n FROM requests GROUP BY ALL), t AS (SELECT lane, sum(n) AS total, count(*) AS k FROM c GROUP BY lane)
  SELECT c.lane, k AS values, round(CASE WHEN k > 1 THEN -sum(n / total * ln(n / total)) / ln(k) ELSE 0 END, 6) AS entropy FROM c JOIN t ON c.lane IS NOT DISTINCT FROM t.lane WHERE c.lane IS NOT NULL GROUP BY c.lane, k""")
def entropy_by_lane(spark, d):
    df = requests(spark, d, "language_lane", "diversity").select(lane_of().alias("lane"), F.col("diversity.topic_id").alias("topic")).where("lane is not null")
    return diversity.entropy(diversity.frequencies(df, ["lane"], F.coalesce("topic", F.lit(""))), ["lane"]).select("lane", "values", F.round("entropy", 6).alias("entropy"))


@query(f"""WITH {_REQUESTS}, w AS (SELECT {_LANE} AS lane, array_to_string(regexp_extract_all({_fold('instruction')}, '[\\p{{L}}\\p{{N}}_]+')[1:6], ' ') AS prefix FROM requests),
  c AS (SELECT lane, prefix, count(*) AS n FROM w WHERE lane IS NOT NULL GROUP BY ALL) SELECT lane, prefix, n, rn AS rank FROM (SELECT *, row_number() OVER (PARTITION BY lane ORDER BY n DESC, prefix) AS rn FROM c) WHERE rn <= 10""")
def top_prefixes(spark, d):
    df = rows.latest(table(spark, d, "instruction_rows").select("id", "ingested_at", lane_of().alias("lane"), T.opening(F.col("instruction")).alias("prefix"))).where("lane is not null")
    return diversity.top_values(diversity.frequencies(df, ["lane"], F.col("prefix")), ["lane"]).select("lane", F.col("value").alias("prefix"), "n", "rank")


@query("SELECT event_type, count(DISTINCT user_id) AS users, max(n) AS most FROM (SELECT event_type, user_id, count(*) AS n FROM events GROUP BY ALL) GROUP BY event_type")
def distinct_and_max_reuse(spark, d):
    counts = diversity.frequencies(table(spark, d, "events"), ["event_type"], F.col("user_id"))
    return counts.groupBy("event_type").agg(F.count("value").alias("users"), F.max("n").alias("most"))


@query(f"""WITH {_REQUESTS}, s AS (SELECT id, {_LANE} AS lane, instruction FROM requests WHERE {_LANE} IN ('da', 'en')),
  p AS (SELECT id, lane, instruction FROM (SELECT *, row_number() OVER (PARTITION BY lane ORDER BY sha256('near:' || id), id) AS rn FROM s) WHERE rn <= 100),
  w AS (SELECT id, lane, ' ' || unnest(regexp_extract_all(lower(instruction), '\\S+')) || ' ' AS word FROM p),
  g AS (SELECT id, lane, unnest(list_concat(list_transform(range(1, length(word) - 1), lambda i: substr(word, i, 3)), list_transform(range(1, length(word) - 2), lambda i: substr(word, i, 4)), list_transform(range(1, length(word) - 3), lambda i: substr(word, i, 5)))) AS gram FROM w),
  tf AS (SELECT id, lane, gram, count(*) AS tf FROM g GROUP BY ALL), df AS (SELECT lane, gram, count(*) AS df FROM tf GROUP BY ALL), n AS (SELECT lane, count(*) AS docs FROM p GROUP BY lane),
  x AS (SELECT id, lane, gram, tf * (ln((1 + docs) / (1 + df)) + 1) AS w FROM tf JOIN df USING (lane, gram) JOIN n USING (lane)),
  u AS (SELECT x.id, lane, gram, w / norm AS w FROM x JOIN (SELECT id, sqrt(sum(w * w)) AS norm FROM x GROUP BY id) USING (id)),
  q AS (SELECT a.lane, a.id AS a, b.id AS b, sum(a.w * b.w) AS similarity FROM u a JOIN u b ON a.lane = b.lane AND a.gram = b.gram AND a.id < b.id GROUP BY ALL)
  SELECT lane, a, b, round(similarity, 6) AS similarity FROM q WHERE similarity >= 0.65""")
def near_duplicates_tfidf(spark, d):
    # the sample is drawn from the keys; only its texts are fetched
    df = requests(spark, d, "language_lane").select("id", lane_of().alias("lane"), "ingested_at").where("lane in ('da', 'en')")
    keys = diversity.hash_sample(df, ["lane"], "id", "near").drop("sample_rank")
    texts = table(spark, d, "instruction_rows").select("id", "ingested_at", "instruction").join(F.broadcast(keys), ["id", "ingested_at"])
    sample = durable(texts.groupBy("id", "lane").agg(F.max("instruction").alias("instruction")))
    return diversity.tfidf_pairs(sample, ["lane"], "id", "instruction", 0.65).select("lane", "a", "b", F.round("similarity", 6).alias("similarity"))


@query(f"""WITH {_REQUESTS}, t AS (SELECT id AS topic_id, domain AS topic_domain, row_number() OVER (ORDER BY domain, id) - 1 AS p FROM topics), m AS (SELECT id AS interaction_mode, row_number() OVER (ORDER BY id) - 1 AS p FROM interaction_modes),
  s AS (SELECT language, source_id AS persona_source_id, position AS p FROM personas), ns AS (SELECT language, count(*) AS np FROM s GROUP BY language),
  k AS (SELECT (SELECT count(*) FROM t) AS nt, (SELECT count(*) FROM m) AS nm),
  i AS (SELECT r.id, substring(lower(trim(language_lane)), 1, 2) AS lane, split_part(shard_key, '-', 4)::BIGINT * 64 + row_index AS i FROM requests r)
  SELECT i.id, topic_id, topic_domain, interaction_mode, persona_source_id FROM i, k LEFT JOIN t ON i.i % nt = t.p LEFT JOIN m ON (i.i + i.i // nt) % nm = m.p LEFT JOIN ns ON i.lane = ns.language LEFT JOIN s ON s.language = i.lane AND (17 + i.i * 101) % np = s.p""")
def assign_topic_mode_persona(spark, d):
    topics = rows.numbered(table(spark, d, "topics").withColumn("_g", F.lit(0)), ["_g"], ["domain", "id"])
    modes = rows.numbered(table(spark, d, "interaction_modes").withColumn("_g", F.lit(0)), ["_g"], ["id"])
    personas = table(spark, d, "personas")
    sizes = [(r["language"], r["count"], planning.stride(r["count"], 101)) for r in personas.groupBy("language").count().collect()]  # a line a language
    sizes = spark.createDataFrame(sizes, "lane string, people long, step long")
    df = requests(spark, d, "shard_key", "row_index", "language_lane").withColumn("lane", lane_of()).join(F.broadcast(sizes), "lane", "left")
    index = F.split("shard_key", "-", 4)[3].cast("long") * 64 + F.col("row_index")
    out = planning.assign(df, index, topics, modes, personas, topics.count(), modes.count(), F.col("people"), 17, F.col("step"), "lane")
    return out.select("id", "topic_id", "topic_domain", "interaction_mode", "persona_source_id")


@query("""SELECT language, position, source_id, coalesce(nullif(json_extract_string(payload, '$.age_band'), ''), 'unknown') AS age_band, array_to_string(list_filter([json_extract_string(payload, '$.occupation'),
  json_extract_string(payload, '$.education'), json_extract_string(payload, '$.interests')], lambda p: coalesce(p, '') <> ''), '; ') AS profile FROM personas""")
def persona_normalize(spark, d):
    from strataloom.operators.generation import profile_sentence

    df = table(spark, d, "personas").withColumn("p", F.from_json("payload", "age_band string, occupation string, education string, interests string"))
    return df.select("language", "position", "source_id", rows.or_unknown(F.col("p.age_band")).alias("age_band"), profile_sentence(F.col("p.occupation"), F.col("p.education"), F.col("p.interests")).alias("profile"))


@query(f"""WITH {_TALKS} SELECT id, greatest(24, CAST(floor(rendered_token_count * (CASE WHEN {_LANE} = 'da' THEN 0.42::DOUBLE ELSE 0.6::DOUBLE END * pow(0.78::DOUBLE, actual_exchanges))) AS INTEGER)) AS words,
  CAST(floor(({LIMIT} - rendered_token_count)::DOUBLE / (3 * desired_exchanges)) AS BIGINT) AS user_budget FROM talks WHERE rendered_token_count IS NOT NULL""")
def word_budget(spark, d):
    df = talks(spark, d, "rendered_token_count", "actual_exchanges", "desired_exchanges", "language_lane").where("rendered_token_count is not null")
    budget = F.floor((LIMIT - F.col("rendered_token_count")).cast("double") / (3 * F.col("desired_exchanges"))).cast("long")
    return df.select("id", T.words_for(lane_of(), F.col("rendered_token_count"), F.col("actual_exchanges")).alias("words"), budget.alias("user_budget"))


@query("SELECT id, json_extract_string(payload, '$.language') AS language, json_extract_string(payload, '$.count')::INTEGER AS n, json_extract_string(payload, '$.source') AS source FROM tasks")
def json_payload_parse(spark, d):
    df = table(spark, d, "tasks").withColumn("p", F.from_json("payload", "language string, count int, source string"))
    return df.select("id", "p.language", F.col("p.count").alias("n"), "p.source")


@query(f"""WITH {_TALKS}, t AS (SELECT id, least(max_tokens, {LIMIT}) AS cap, CAST(rendered_token_count AS BIGINT) AS now, CAST(desired_exchanges AS BIGINT) AS rem FROM talks JOIN length_bands USING (length_band) WHERE rendered_token_count IS NOT NULL AND desired_exchanges > 0)
  SELECT id, CAST(least(512, cap - now - (192 + (rem - 1) * 268), greatest(64, floor((cap - now)::DOUBLE / greatest(1, 3 * rem)))) AS BIGINT) AS user_budget,
    CAST(least(1024, cap - now - (rem - 1) * 76 - 4, 4096 - now - 4, greatest(192, floor((cap - now - (rem - 1) * 76)::DOUBLE / rem))) AS BIGINT) AS answer_budget FROM t""")
def turn_budgets(spark, d):
    df = rows.latest(table(spark, d, "audit_rows").select("id", "ingested_at", "length_band", "rendered_token_count", "desired_exchanges"))
    df = df.join(F.broadcast(table(spark, d, "length_bands")), "length_band").where("rendered_token_count is not null and desired_exchanges > 0")
    cap, now, rem = F.least("max_tokens", F.lit(LIMIT)), F.col("rendered_token_count").cast("long"), F.col("desired_exchanges").cast("long")
    return df.select("id", prompts.user_turn_budget(cap, now, rem, 512).alias("user_budget"), prompts.answer_turn_budget(cap, now, rem - 1, 1024, 4096).alias("answer_budget"))


_VERDICT = "'{\"accepted\": ' || CASE WHEN audit.accepted THEN 'true' ELSE 'false' END || ', \"language\": \"' || coalesce(language_lane, '') || '\", \"quality\": ' || coalesce(audit.turns, 0) || ', \"safe\": true}'"


@query(f"""WITH {_TALKS}, v AS (SELECT id, {_LANE} AS lane, {_VERDICT} AS j FROM talks WHERE audit IS NOT NULL)
  SELECT id, coalesce(json_extract_string(j, '$.accepted') = 'true' AND substring(lower(trim(json_extract_string(j, '$.language'))), 1, 2) = lane AND json_extract_string(j, '$.quality')::INTEGER >= 2, false) AS accepted, json_extract_string(j, '$.quality')::INTEGER AS quality FROM v""")
def json_verdict_parse(spark, d):
    """Verdicts written as JSON between other text are read back leniently and decided by their conjunction."""
    df = rows.latest(table(spark, d, "audit_rows").select("id", "ingested_at", "language_lane", "audit")).where("audit is not null")
    said = F.to_json(F.struct(F.coalesce("audit.accepted", F.lit(False)).alias("accepted"), F.coalesce("language_lane", F.lit("")).alias("language"), F.coalesce("audit.turns", F.lit(0)).alias("quality"), F.lit(True).alias("safe")))
    text = F.concat(F.lit("Here it is:\n```json\n"), said, F.lit("\n```"))
    df = df.select("id", "language_lane", F.from_json(T.outer_object(text), "accepted boolean, language string, quality int, safe boolean").alias("v"))
    ok = validation.all_true(F.col("v.accepted"), F.substring(F.lower(F.trim("v.language")), 1, 2) == lane_of(), F.col("v.quality") >= 2, F.col("v.safe"))
    return df.select("id", ok.alias("accepted"), F.col("v.quality").alias("quality"))


_PAGES = "SELECT id || '.md' AS name, 'See [' || en || '](' || CASE WHEN length(da) % 3 = 0 THEN domain ELSE id END || '.md#top) and [home](https://home.example/x).' AS text FROM topics"


@query(f"""WITH pages AS ({_PAGES}), l AS (SELECT name, unnest(regexp_extract_all(text, '\\]\\(([^)#\\s]+)(?:#[^)\\s]*)?\\)', 1)) AS target FROM pages)
  SELECT name, target FROM l WHERE NOT regexp_matches(target, '^[a-z]+:') AND target NOT IN (SELECT name FROM pages)""")
def md_links_unresolved(spark, d):
    """Relative links of pages made from the topics whose target is no page."""
    target = F.when(F.length("da") % 3 == 0, F.col("domain")).otherwise(F.col("id"))
    pages = table(spark, d, "topics").select(F.concat("id", F.lit(".md")).alias("name"), F.concat(F.lit("See ["), "en", F.lit("]("), target, F.lit(".md#top) and [home](https://home.example/x).")).alias("text"))
    return files.unresolved(pages)


_REPORT = f"""{_REQUESTS}, n AS (SELECT {_LANE} AS lane, coalesce(diversity.topic_id, '') AS topic, coalesce(diversity.topic_domain, '') AS domain, coalesce(diversity.interaction_mode, '') AS mode, coalesce(diversity.persona_source_id, '') AS persona FROM requests WHERE language_lane IS NOT NULL)"""


def _entropy_sql(name: str) -> str:
    return f"""{name}_h AS (SELECT lane, count(*) AS k, CASE WHEN count(*) > 1 THEN -sum(p * ln(p)) / ln(count(*)) ELSE 0 END AS h FROM (SELECT lane, {name}, count(*) / sum(count(*)) OVER (PARTITION BY lane) AS p FROM n GROUP BY lane, {name}) GROUP BY lane)"""


@query(f"""WITH {_REPORT}, {_entropy_sql('topic')}, {_entropy_sql('domain')}, {_entropy_sql('mode')}, p AS (SELECT lane, count(*) AS personas, max(c) AS most_uses FROM (SELECT lane, persona, count(*) AS c FROM n GROUP BY ALL) GROUP BY lane)
  SELECT p.lane, (SELECT count(*) FROM n WHERE n.lane = p.lane) AS rows, t.k AS topics, round(t.h, 6) AS topic_entropy, o.k AS domains, round(o.h, 6) AS domain_entropy, m.k AS modes, round(m.h, 6) AS mode_entropy, personas, most_uses
  FROM p JOIN topic_h t USING (lane) JOIN domain_h o USING (lane) JOIN mode_h m USING (lane)""")
def lane_diversity(spark, d):
    """The counted part of the lane report."""
    df = table(spark, d, "instruction_rows").select("id", "ingested_at", lane_of().alias("lane"), "diversity", F.col("instruction").alias("text")).where("lane is not null")
    report = diversity.lane_report(rows.latest(df.select("id", "ingested_at", "lane", "diversity")).join(df.select("id", "ingested_at", "text"), ["id", "ingested_at"]).dropDuplicates(["id"]))[0]
    return report.select("lane", "rows", "topics", F.round("topic_entropy", 6).alias("topic_entropy"), "domains", F.round("domain_entropy", 6).alias("domain_entropy"), "modes", F.round("mode_entropy", 6).alias("mode_entropy"), "personas", "most_uses")


@query("""SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS n FROM lineitem GROUP BY ALL""")
def pricing_summary(spark, d):
    return table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.count("*").alias("n"))


def _streamed(stream: DataFrame, mode: str = "append") -> DataFrame:
    """Run a stream over what there is and read its result back from the shared folder."""
    spark = stream.sparkSession
    folder = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    stream.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start(f"{folder}/rows").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/rows")


def _stream(spark, d, name):
    # a pattern, as a stream can't begin at the path of a single file
    return spark.readStream.schema(table(spark, d, name).schema).parquet(f"{d}/{name}.parque[t]")


@query(f"SELECT DISTINCT sha256({_fold('instruction')}) AS digest FROM instruction_rows")
def stream_dedup(spark, d):
    return _streamed(phases.first_seen(_stream(spark, d, "instruction_rows").select("instruction", "ingested_at"), "instruction", "ingested_at", "3650 days").select("digest"))


@query("SELECT shard_key, count(*) AS rows FROM instruction_rows GROUP BY shard_key")
def stream_phase_advance(spark, d):
    """The shards of a phase folder of JSON lines, handed over as they arrive."""
    folder = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    table(spark, d, "instruction_rows").select("id", "row_index", "shard_key").repartition("shard_key").write.json(f"{folder}/phase")
    phases.advance(spark, f"{folder}/phase", "id string, row_index int, shard_key string", f"{folder}/state", lambda df, n: df.write.mode("overwrite").parquet(f"{folder}/rows/batch={n}"), shard="shard_key", glob="*.json")
    return spark.read.parquet(f"{folder}/rows").groupBy("shard_key").agg(F.sum("rows").alias("rows"))


@query("SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS rows FROM events GROUP BY ALL")
def stream_windows(spark, d):
    # windows that the watermark has not closed come out as updates; the last of each window counts
    stream = phases.windows(_stream(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp")), "ts", ["event_type"])
    folder = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    batch = lambda df, n: df.select(F.col("window.start").cast("timestamp_ntz").alias("hour"), "event_type", "rows", F.lit(n).alias("batch")).write.mode("overwrite").parquet(f"{folder}/rows/run={n}")
    stream.writeStream.outputMode("update").foreachBatch(batch).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/rows").groupBy("hour", "event_type").agg(F.max_by("rows", "batch").alias("rows"))
