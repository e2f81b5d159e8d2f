"""A whole small campaign with a deterministic teacher."""

import json

import pytest
from conftest import found
from pyspark.sql import functions as F

from strataloom.operators import generation, prompts
from strataloom.plans.campaign import CampaignRun, exchanges_for
from strataloom.sources.config import Band, Campaign, Lane, Selection


def fake():
    fields = {c.split()[0]: True for c in (generation.INSTRUCTION_VERDICT + ", coherent boolean").split(", ") if c.endswith("boolean")}
    every = fields | {"language": "en", "quality": 5, "instruction_quality": 5, "response_quality": 4, "category": "c", "difficulty": "d", "reason": "r"}

    def teach(messages, sampling, seed, schema=None):
        return {"content": json.dumps({k: every[k] for k in schema["required"]}) if schema else f"A plain sentence about number {seed} that says enough.", "finish_reason": "stop"}

    return teach


@pytest.fixture
def run(spark, tmp_path):
    lane = Lane("en", 6, {"general": "p", "expert": "p"}, {"general": 0.5, "expert": 0.5}, oversample=1.5)
    config = Campaign((lane,), bands={"short": Band(1, 3000, 1.0, 1, 2)}, selection=Selection({"en": 6}, 1.0, 1.0), shard_size=2, seed=3)
    return CampaignRun(spark, config, str(tmp_path / "c"), fake())


def test_run_all(run, tmp_path):
    report = run.run_all(str(tmp_path / "out"))
    assert found(report, "complexity", "rows", "target") == {("general", 3, 3), ("expert", 3, 3)}
    final = run.spark.read.parquet(str(tmp_path / "out"))
    assert final.count() == 6 and "instruction" not in final.columns
    assert found(run.status(), "status") == {"done"}


def test_planning_again_adds_nothing_and_selection_extends(run):
    run.plan()
    tasks = run.plan()
    assert tasks.count() == tasks.select("phase", "shard_key").distinct().count()
    counts = tasks.select("shard_key", F.lit(2).alias("emitted"), F.lit(0).alias("unresolved"))
    picked = found(run.select("instruction", counts).where("status = 'pending'"), "shard_key")
    assert len(picked) == 4
    run.release_held("instruction")
    assert run.tasks().where("status = 'held'").count() == 0
    assert run.reset_failed().count() == tasks.count() and run.reset_stale(10.0, 1.0).count() == tasks.count()


def test_a_phase_in_two_runs_keeps_the_rows_of_both(run):
    run.plan()
    keys = sorted(found(run.tasks(), "shard_key"))
    hold = lambda some: run.publish(run.tasks().withColumn("status", F.when(F.col("status") == "done", "done").when(F.col("shard_key").isin(some), "pending").otherwise("held")))
    hold(keys[:2])
    first = run.run("instruction")
    hold(keys[2:])
    second = run.run("instruction")
    assert first and second and run.table("instruction").count() == first + second
    assert found(run.table("instruction"), "shard_key") == set(keys) and found(run.tasks(), "status") == {"done"}
    run.run("instruction")  # nothing waits: nothing is lost
    assert run.table("instruction").count() == first + second


def test_only_one_writer_gets_a_number(run):
    run.plan()
    number = run._snapshots()[-1]
    run.publish(run.tasks(), number)
    with pytest.raises(RuntimeError):
        run.publish(run.tasks(), number)


def sick(bad):
    well = fake()

    def teach(messages, sampling, seed, schema=None):
        if not schema and seed % 2**63 in bad:
            raise OSError("away")
        return well(messages, sampling, seed, schema)

    return teach


def test_failures_are_kept_and_their_shards_tried_again(spark, run):
    """A shard of which all fails waits again and has failed at last; one within its tolerance is done without those rows."""
    run.plan()
    task = run.tasks().orderBy("id").select("shard_key", F.from_json("payload", "count long, seed long").alias("p")).select("shard_key", "p.*").collect()
    all_of, one_of = task[0], task[1]
    from strataloom.operators.generation import TASK_SEED

    bad = {(all_of.seed + i + k * TASK_SEED) % (2**63 - 1) for i in range(all_of["count"]) for k in range(9)} | {one_of.seed % (2**63 - 1)}
    run.teacher = sick(bad)
    run.run("instruction")
    status = {r.shard_key: r.status for r in run.tasks().collect()}
    assert status[all_of.shard_key] == "pending" and status[one_of.shard_key] == ("done" if one_of["count"] > 1 else "pending")
    assert all_of.shard_key not in found(run.table("instruction"), "shard_key")
    assert {r.shard_key for r in run.failures("instruction").collect()} == {all_of.shard_key, one_of.shard_key} and "away" in run.failures("instruction").first().error
    for _ in range(5):
        run.run("instruction")
    tasks = {r.shard_key: r for r in run.tasks().collect()}
    assert tasks[all_of.shard_key].status == "failed" and tasks[all_of.shard_key].attempts == run.config.max_retries and "tolerates" in tasks[all_of.shard_key].error


def test_requests_carry_topic_mode_and_persona(spark, run):
    topics = spark.createDataFrame([("d", f"t{i}", f"topic {i}", f"emne {i}") for i in range(3)], "domain string, id string, en string, da string")
    modes = spark.createDataFrame([("m0", "ask", "spørg", False), ("m1", "rewrite", "omskriv", True)], "id string, en string, da string, embedded_input boolean")
    people = spark.createDataFrame([("en", i, f"p{i}", json.dumps({"source": "s", "age_band": "", "occupation": "cook"})) for i in range(5)], "language string, position int, source_id string, payload string")
    said = []
    well = fake()

    def teach(messages, sampling, seed, schema=None):
        return {"content": messages[-1]["content"] + ".", "finish_reason": "stop"} if not schema else well(messages, sampling, seed, schema)

    run = CampaignRun(spark, run.config, run.root, teach, catalogue=(topics, modes), personas=people)
    run.plan()
    run.run("instruction")
    rows = run.table("instruction").collect()
    assert {r.diversity.topic_id for r in rows} == {"t0", "t1", "t2"} and {r.diversity.interaction_mode for r in rows} <= {"m0", "m1"} and {r.diversity.persona_source for r in rows} == {"s"}
    for r in rows:
        name = r.diversity.topic_id.replace("t", "topic ")
        assert name in r.instruction and "cook" in r.instruction and "tokens" in r.instruction and ("part of the message" in r.instruction) == (r.diversity.interaction_mode == "m1")
        assert 1 <= r.desired_exchanges <= 2
    assert not said and run.diversity_report().first().topics == 3
    with pytest.raises(ValueError):
        run.assert_gate()
    with pytest.raises(ValueError):
        CampaignRun(spark, run.config, run.root, teach, personas=people)


def test_only_requests_cut_by_length_are_asked_again(spark):
    rows = spark.createDataFrame([(1, 10, "a", "b", "c"), (2, 20, "x", "b", "c"), (3, 30, "x", "x", "x"), (4, 40, "boom", "b", "c")], "id int, seed long, p0 string, p1 string, p2 string")

    def teach(messages, sampling, seed, schema=None):
        text = messages[-1]["content"]
        if text == "boom":
            raise OSError("boom")
        return {"content": f"{text} {seed}", "finish_reason": "length" if text == "x" else "stop"}

    got = {r.id: r for r in generation.write_requests(rows, teach, ["p0", "p1", "p2"]).collect()}
    assert (got[1].instruction, got[1].generation_attempt) == ("a 10", 0) and (got[2].instruction, got[2].generation_attempt) == (f"b {20 + generation.ATTEMPT_SEED}", 1)
    assert got[3].instruction is None and "length" in got[3].error and "boom" in got[4].error


def test_selection_writes_its_receipt_and_keeps_what_is_done(spark, run):
    run.plan()
    tasks = run.tasks()
    run.publish(tasks.withColumn("phase", F.lit("audit")))
    counts = tasks.select("shard_key", F.lit(2).alias("emitted"), F.lit(0).alias("unresolved"))
    picked = found(run.select("audit", counts).where("status = 'pending'"), "shard_key")
    receipt = json.loads(open(f"{run.root}/audit-selection.json").read())
    assert set(receipt["shard_keys"]) == picked and receipt["projected_rows"] == {"en": 2 * len(picked)} and receipt["shortfalls"] == {}
    left = sorted(found(run.tasks(), "shard_key") - picked)[0]
    run.publish(run.tasks().withColumn("status", F.when(F.col("shard_key") == left, "done").otherwise(F.col("status"))))
    with pytest.raises(RuntimeError):
        run.select("audit", counts)
    run.publish(run.tasks().withColumn("status", F.lit("running")))
    with pytest.raises(RuntimeError):
        run.select("audit", counts)


def test_final_reports_and_stale_counts(spark, run, tmp_path):
    out = str(tmp_path / "final")
    run.run_all(out)
    totals = spark.read.json(f"{out}.totals").first()
    assert totals.rows == 6 and totals.tokens > 0 and len(totals.config_hash) == 64 and totals.rejected == run.table("audit").count() - spark.read.json(f"{out}.report").agg(F.sum("available")).first()[0]
    assert spark.read.json(f"{out}.lanes").first().rows == 6 and spark.read.json(f"{out}.bands").count() == 1 and {"language", "complexity"} <= found(spark.read.json(f"{out}.gates"), "dimension")
    assert json.loads(open(f"{run.root}/config.json").read())["config_hash"] == run.config.receipt()
    run.count = lambda text: 2 * len(text.split())
    with pytest.raises(Exception, match="tokens differ"):
        run.finalize(str(tmp_path / "again"))


def test_the_gate_waits_for_rows(run, monkeypatch):
    run.plan()
    run.run("instruction")
    monkeypatch.setattr(run, "assert_gate", lambda phase: phase)
    assert run.wait_for_gate(0.5, poll=0.0) == "instruction"
    with pytest.raises(TimeoutError):
        run.wait_for_gate(100.0, poll=0.0, polls=2)
    run.advance("instruction")
    run.publish(run.tasks().withColumn("status", F.when(F.col("phase") == "instruction_audit", "held").otherwise(F.col("status"))))
    assert run.resume("instruction_audit") == run.table("instruction").count()


def test_prompts(spark):
    df = spark.createDataFrame([("da", "a", True), ("en", "a", None)], "l string, t string, e boolean")
    got = df.select(prompts.diversity_sentence(F.col("l"), F.col("t"), F.col("t"), F.col("t"), F.col("e")).alias("s"), prompts.request_words(F.lit(400), F.lit(1)).alias("w"), prompts.request_prompt(F.col("l"), F.lit("c"), F.lit(2), F.lit(50)).alias("p"), prompts.answer_control(F.col("l"), F.lit(9)).alias("a")).collect()
    assert got[0].s.startswith("Emne: a.") and got[0].s.endswith("beskeden.") and got[1].s == "Topic: a. Form: a. Sender: a."
    assert got[0].w == 86 and "50" in got[1].p and "9" in got[1].a
    assert 2 <= exchanges_for(5, 2, 4) <= 4
