"""Planning, selection, finalisation, diversity, ledger and generation."""

import json
import random

import pytest
from conftest import found
from pyspark.sql import functions as F

from strataloom.operators import diversity, finalize, generation, ledger, planning, rows, selection, validation
from strataloom.sources import config, files, teacher
from strataloom.streaming import phases


def test_apportionment_adds_up_and_breaks_ties_by_greatest_key(spark):
    shares = [("short", 0.2), ("medium", 0.35), ("long", 0.35), ("near", 0.1)]
    df = spark.createDataFrame([(0, k, s) for k, s in shares], "g int, k string, s double")
    assert found(planning.apportion(df, ["g"], "k", F.lit(17), F.col("s")), "k", "quota") == {("short", 3), ("medium", 6), ("long", 6), ("near", 2)}
    tie = spark.createDataFrame([(0, k, 0.25) for k in "abcd"], "g int, k string, s double")
    assert found(planning.apportion(tie, ["g"], "k", F.lit(2), F.col("s")).where("quota > 0"), "k") == {"c", "d"}
    assert planning.apportion(tie.limit(0), ["g"], "k", F.lit(2), F.col("s")).count() == 0


def test_shards_cover_the_quota_and_run_on(spark):
    quotas = spark.createDataFrame([("da", "general", "short", 5), ("da", "general", "long", 0), ("da", "expert", "short", 4)], "language string, complexity string, band string, quota long")
    got = [tuple(r) for r in planning.shard_plan(quotas, 2).orderBy("assignment_start").select("shard_key", "rows", "assignment_start").collect()]
    assert got == [("da-expert-short-000000", 2, 0), ("da-expert-short-000001", 2, 2), ("da-general-short-000000", 2, 4), ("da-general-short-000001", 2, 6), ("da-general-short-000002", 1, 8)]


def test_every_topic_before_a_repeat_and_every_persona_once(spark):
    topics = spark.createDataFrame([(i, f"t{i}", "d") for i in range(6)], "position long, id string, domain string")
    modes = spark.createDataFrame([(i, f"m{i}") for i in range(4)], "position long, id string")
    personas = spark.createDataFrame([(i, f"p{i}") for i in range(7)], "position long, source_id string")
    got = planning.assign(spark.range(24), F.col("id"), topics, modes, personas, 6, 4, 7, 3, planning.stride(7, 5)).toPandas().sort_values("id")
    assert got.topic_id[:6].nunique() == 6 and got.persona_source_id[:7].nunique() == 7
    assert len(set(zip(got.topic_id, got.interaction_mode))) == 24


def test_a_greater_need_only_adds_shards(spark):
    df = spark.createDataFrame([("en", f"en-general-short-{i:06d}", 2.0) for i in range(9)], "cell string, shard_key string, rows double")
    take = lambda n: found(selection.take_until(df, ["cell"], F.lit(n), F.col("rows"), selection.stable_order(0, "s", F.col("shard_key"))).where("selected"), "shard_key")
    assert len(take(2)) == 1 and len(take(4)) == 2 and len(take(5)) == 3 and take(0) == set()
    assert take(2) < take(4) < take(5)


def test_retention_falls_back_to_the_lane_and_then_to_the_constant(spark):
    df = spark.createDataFrame([("da", "a", 8, 2), ("da", "b", 0, 0), ("en", "a", 0, 0)], "language string, complexity string, emitted long, unresolved long")
    assert found(selection.retention(df, 0.9), "language", "complexity", "retention") == {("da", "a", 0.8), ("da", "b", 0.8), ("en", "a", 0.9)}


def test_hold_release_and_outside(spark):
    tasks = spark.createDataFrame([("a", "pending"), ("b", "held"), ("c", "done"), ("d", "pending")], "shard_key string, status string")
    picked = spark.createDataFrame([("a",), ("b",)], "shard_key string")
    assert found(selection.hold_and_release(tasks, picked), "shard_key", "status") == {("a", "pending"), ("b", "pending"), ("c", "done"), ("d", "held")}
    assert found(selection.outside(tasks.where("status = 'done'"), picked), "shard_key") == {"c"}


def test_top_of_cells_is_the_plain_ranking(spark):
    import hashlib

    ids = [(f"id{i}", "da" if i % 3 else "en") for i in range(300)]
    df = spark.createDataFrame(ids, "id string, language string")
    quotas = spark.createDataFrame([("da", 37), ("en", 1000), ("sv", 5)], "language string, quota long")
    want = {i for lane, n in (("da", 37), ("en", 1000)) for i in sorted((i for i, x in ids if x == lane), key=lambda i: hashlib.sha256(i.encode()).hexdigest())[:n]}
    for bits in (4, 12):
        assert found(finalize.top_of_cells(df, ["language"], quotas, bits=bits), "id") == want
    assert finalize.top_of_cells(df, ["language"], quotas, retain=True).count() == 300


def test_reports_clip_where_they_should(spark):
    cells = [("da", "general", "short"), ("da", "expert", "short")]
    quotas = spark.createDataFrame([(*cells[0], 1), (*cells[1], 2)], "language string, complexity string, band string, quota long")
    got = spark.createDataFrame([(*cells[0], 10), (*cells[0], 20)], "language string, complexity string, band string, tokens long")
    report = finalize.cell_report(got, got, quotas)
    assert found(report, "complexity", "rows", "tokens", "surplus", "shortfall") == {("general", 2, 30, 1, 0), ("expert", 0, 0, 0, 2)}
    assert found(finalize.band_report(report), "surplus", "shortfall") == {(1, 2)}
    assert found(finalize.lane_report(report), "surplus", "shortfall") == {(0, 1)}
    with pytest.raises(ValueError):
        finalize.require_targets(report)


def test_first_copy_is_kept_by_order(spark):
    df = spark.createDataFrame([(2, "Hej  DU"), (1, "hej du"), (3, "andet"), (4, None)], "at int, text string")
    assert found(rows.keep_first(df, rows.digest_of_prompt(F.col("text")), ["at"]), "at") == {1, 3, 4}


def test_turns_and_messages(spark):
    m = [("system", "s"), ("user", "u1"), ("assistant", "a1"), ("user", "u2"), ("assistant", "a2")]
    df = spark.createDataFrame([("x", m, [("stop", 3)]), ("y", None, None), ("z", [], [])], "id string, messages array<struct<role:string,content:string>>, turn_token_usage array<struct<finish_reason:string,actual_output_tokens:int>>")
    assert found(rows.turns(df), "id", "turn", "position", "question", "answer", "finish_reason") == {("x", 1, 2, "u1", "a1", "stop"), ("x", 2, 4, "u2", "a2", None)}
    assert found(df.select("id", rows.first_user(F.col("messages")).alias("f"), rows.exchanges(F.col("messages")).alias("n")), "id", "f", "n") == {("x", "u1", 2), ("y", None, 0), ("z", None, 0)}


def test_entropy_and_top_values(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x"), ("b", "x"), ("a", "x"), ("a", "y")], "g string, v string")
    counts = diversity.frequencies(df, ["g"], F.col("v"))
    assert found(diversity.entropy(counts, ["g"]), "g", "entropy") == {("a", 1.0), ("b", 0.0)}
    assert found(diversity.top_values(counts, ["g"], 1), "g", "value", "n") == {("a", "x", 2), ("b", "x", 2)}


def test_cosine_of_equal_and_foreign_texts(spark):
    df = spark.createDataFrame([("g", "1", "the same text"), ("g", "2", "the same text"), ("g", "3", "qqq zzz"), ("g", "4", "ab")], "g string, id string, t string")
    assert [(r.a, r.b, round(r.similarity, 6)) for r in diversity.tfidf_pairs(df, ["g"], "id", "t", 0.5).collect()] == [("1", "2", 1.0)]
    assert diversity.tfidf_pairs(df.limit(0), ["g"], "id", "t", 0.5).count() == 0


def task(i, status="pending", attempts=0, claimed=None):
    return (i, "audit", f"k{i}", "{}", status, attempts, None, claimed, None, None)


def test_ledger_transitions(spark):
    df = spark.createDataFrame([task(1), task(2, "running", 2, 10.0), task(3, "failed", 3)], ledger.SCHEMA)
    new = spark.createDataFrame([("audit", "k1", "{}"), ("audit", "k9", "{}"), ("audit", "k9", "{}")], "phase string, shard_key string, payload string")
    assert found(ledger.enqueue(df, new), "id", "shard_key") == {(4, "k9")}
    assert ledger.next_pending(df, "audit").first().id == 1
    assert found(ledger.claim(df, 1, "w", 5.0), "id", "status", "attempts") >= {(1, "running", 1)}
    assert found(ledger.fail(df, 2, "x" * 5000, 3), "id", "status") >= {(2, "pending")}
    assert found(ledger.fail(df, 2, "e", 2), "id", "status") >= {(2, "failed")}
    assert found(ledger.finish(df, 2, 9.0), "id", "status") >= {(2, "done")}
    assert found(ledger.reset_stale(df, F.lit(100.0), 60), "id", "status") >= {(2, "pending")}
    assert found(ledger.reset_stale(df, F.lit(50.0), 60), "id", "status") >= {(2, "running")}
    assert found(ledger.reset_failed(df), "id", "status", "attempts") >= {(3, "pending", 0)}
    assert found(ledger.reset_failed(df, "other"), "id", "status") >= {(3, "failed")}


def fake():
    """A deterministic teacher, local so that workers get it by value."""
    fields = {c.split()[0]: True for c in (generation.INSTRUCTION_VERDICT + ", coherent boolean").split(", ") if c.endswith("boolean")}
    every = fields | {"language": "en", "quality": 5, "instruction_quality": 5, "response_quality": 4, "category": "c", "difficulty": "d", "reason": "r"}

    def teach(messages, sampling, seed, schema=None):
        text = messages[-1]["content"]
        if "boom" in text:
            raise OSError("boom")
        return {"content": json.dumps({k: every[k] for k in schema["required"]}) if schema else f"Answer {seed}.", "finish_reason": "stop"}

    return teach


def test_failures_stay_in_their_row(spark):
    df = spark.createDataFrame([(1, [("user", "hi")], 5), (2, [("user", "boom")], 6)], "id int, messages array<struct<role:string,content:string>>, seed long")
    got = {r.id: r for r in teacher.ask(df, fake()).collect()}
    assert got[1].content == "Answer 5." and got[1].error is None and "boom" in got[2].error
    good, bad = files.split_errors(teacher.ask(df, fake()))
    assert (good.count(), bad.count()) == (1, 1)


def test_requests_and_turns_are_judged(spark):
    df = spark.createDataFrame([("a", "en", "x" * 100), ("b", "en", ""), ("c", "da", "y" * 100)], "id string, language_lane string, instruction string")
    got = {r.id: (r.instruction_audit.accepted, r.instruction_audit.deterministic) for r in generation.audit_requests(df, fake()).collect()}
    assert got == {"a": (True, False), "b": (False, True), "c": (False, False)}
    turns = spark.createDataFrame([("a", "en", "q", "Done.", "stop"), ("b", "en", "q", "Not done", "stop"), ("c", "en", "q", "Done.", None)], "id string, language_lane string, question string, answer string, finish_reason string")
    assert found(generation.audit_turns(turns, fake()), "id", "accepted") == {("a", True), ("b", False), ("c", False)}


def test_conversations_keep_their_budget(spark):
    df = spark.createDataFrame([("a", "Question?", 3, 7), ("b", "boom", 2, 7)], "id string, instruction string, desired_exchanges int, seed long")
    got = {r.id: r for r in generation.respond(df, fake(), lambda t: len(t.split())).collect()}
    assert [m.role for m in got["a"].messages] == ["user", "assistant"] * 3 and len(got["a"].turn_token_usage) == 3
    assert got["b"].messages is None and "boom" in got["b"].error


def test_verdicts_are_strict():
    for verdict, n in ((generation.INSTRUCTION_VERDICT, 12), (generation.TURN_VERDICT, 9)):
        schema = generation.verdict_schema(verdict, ["da", "en"])
        assert len(schema["required"]) == n and schema["additionalProperties"] is False and schema["properties"]["language"]["enum"] == ["da", "en"]
        sample = {k: {"boolean": True, "int": 4, "string": "x"}[v] for k, v in generation.fields_of(verdict).items()}
        result = lambda value: {"content": json.dumps(value), "finish_reason": "stop"}
        assert generation.checked_verdict(result(sample), verdict) == sample
        for wrong in (sample | {"more": 1}, {k: v for k, v in sample.items() if k != "safe"}, sample | {"safe": "yes"}, sample | {next(k for k, v in sample.items() if v == 4): True}):
            with pytest.raises(ValueError):
                generation.checked_verdict(result(wrong), verdict)


def test_turn_budgets_in_rows_and_columns(spark):
    from strataloom.operators import prompts

    rows = [(cap, now, rem) for cap in (200, 1023, 3968) for now in (0, 150, 900) for rem in (1, 2, 5)]
    df = spark.createDataFrame(rows, "cap long, now long, rem long")
    got = df.select("*", prompts.user_turn_budget(F.col("cap"), F.col("now"), F.col("rem"), 512).alias("u"), prompts.answer_turn_budget(F.col("cap"), F.col("now"), F.col("rem") - 1, 1024, 4096).alias("a")).collect()
    for r in got:
        assert r.u == generation.user_turn_budget(r.cap, r.now, r.rem, 512) and r.a == generation.answer_turn_budget(r.cap, r.now, r.rem - 1, 1024, 4096)
    assert generation.user_turn_budget(3968, 968, 2, 512) == 500 and generation.answer_turn_budget(3968, 100, 0, 1024, 4096) == 1024 and generation.answer_turn_budget(500, 100, 1, 1024, 4096) == 192


def test_completions_in_rows_and_columns(spark):
    texts = ["Done.", "and then the", "```x", "", None, "  ", "**Bold.**", "no end", "Ends with og", "list)"]
    df = spark.createDataFrame([(i, t, f) for i, t in enumerate(texts) for f in ("stop", "length", None)], "i int, t string, f string")
    for r in df.withColumn("why", validation.completion_reason(F.col("t"), F.col("f"))).collect():
        assert (generation.completion_fault(r.t, r.f) or "complete") == r.why, r


@pytest.mark.parametrize(("seed", "people", "offset", "step"), [(17, 7, 3, 5), (110032, 5000, 32, 67), (110032, 1_000_000, 110032, 220067)])
def test_assigner(spark, seed, people, offset, step):
    topics = spark.createDataFrame([("d", f"t{i}") for i in range(6)], "domain string, id string")
    modes = spark.createDataFrame([(f"m{i}",) for i in range(4)], "id string")
    got = planning.assigner(topics, modes, people, seed, "da")
    assert got[2:] == (offset, step) and sorted(r.position for r in got[0].collect()) == list(range(6))
    assert [r.id for r in got[0].orderBy("position").collect()] == [r.id for r in planning.assigner(topics, modes, people, seed, "da")[0].orderBy("position").collect()]
    with pytest.raises(ValueError):
        planning.assigner(topics, modes, 0, seed, "da")


def test_latest_and_first_with_nulls_and_ties(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", 5, 2), ("a", 5, 3), ("b", None, 4), ("c", None, 5), ("c", None, 6)], "id string, ingested_at int, v int")
    for parts in (1, 3):
        got = {r.id: r.v for r in rows.latest(df.repartition(parts)).collect()}
        assert got["b"] == 4 and got["a"] == {r.id: r.v for r in rows.latest(df).collect()}["a"] in (2, 3) and len(got) == 3
    rows_ = spark.createDataFrame([(1, "x", None), (2, "x", 3), (3, "y", None), (4, None, 1), (5, "x", 3)], "id int, digest string, at int")
    assert found(rows.keep_first(rows_, F.col("digest"), ["at", "id"]), "id") == {2, 3, 4}


def test_a_cluster_needs_its_shared_folder():
    from types import SimpleNamespace

    from strataloom.session import shared_folder

    for master, fails in (("spark://host:7077", True), ("local-cluster[2,1,1024]", True), ("yarn", True), ("local[4]", False), ("local", False)):
        at = []
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: at[-1] if at else None, setCheckpointDir=at.append, getConf=lambda: {})
        spark = SimpleNamespace(sparkContext=context, conf={})
        if fails:
            with pytest.raises(RuntimeError):
                shared_folder(spark)
        else:
            assert shared_folder(spark) == at[-1]


def test_reports_from_flags_are_those_of_frames(spark):
    cells = [("da", "general", "short"), ("da", "expert", "short"), ("en", "general", "short")]
    quotas = spark.createDataFrame([(*cells[0], 5), (*cells[1], 40), (*cells[2], 0)], "language string, complexity string, band string, quota long")
    rows_ = spark.createDataFrame([(f"r{i}", *cells[i % 3], i) for i in range(90)] + [("z", "sv", "general", "short", 1)], "id string, language string, complexity string, band string, tokens long")
    cell = ["language", "complexity", "band"]
    for bits in (4, 12):
        marked = finalize.flagged(rows_, cell, quotas, bits=bits)
        assert found(marked.where("chosen"), "id") == found(finalize.top_of_cells(rows_, cell, quotas, bits=bits), "id")
        assert found(finalize.flagged_report(marked, quotas), "complexity", "available", "rows", "tokens") == found(finalize.cell_report(rows_.join(quotas.select(*cell), cell, "left_semi"), finalize.top_of_cells(rows_, cell, quotas), quotas), "complexity", "available", "rows", "tokens")


def test_front_matter_and_dates(spark):
    pages = spark.createDataFrame([("a.md", "---\ntitle: A: b\nstatus: open\n---\n# 2024-05-01 start\n## [2024-06-02] more\n"), ("b.md", "no head\n---\nx: y\n---\n")], "name string, text string")
    assert found(files.front_matter(pages), "name", "key", "value") == {("a.md", "title", "A: b"), ("a.md", "status", "open")}
    assert found(files.date_headings(pages), "day") == {"2024-05-01", "2024-06-02"}


def test_chat_templates():
    from strataloom.sources.template import ChatTemplate, chat_tokens, counter

    render = lambda messages, answer: "".join(f"<|{m['role']}|>{m['content']}<|end|>\n" for m in messages) + ("<|assistant|>" if answer else "")
    template = ChatTemplate.derived(render)
    talk = [{"role": "user", "content": "Hi"}, {"role": "assistant", "content": "Hello."}]
    assert template.rendered(talk, True) == render(talk, True) and template.boundary() == "<|end|>\n"
    assert template.open_user(talk, "Be kind.") == render([{"role": "system", "content": "Be kind."}, *talk], False) + "<|user|>"
    encode = lambda text: [ord(c) for c in text]
    assert counter(template, encode)(talk) == len(render(talk, False)) == len(chat_tokens(talk, template, encode))
    for wrong in (lambda m, a: "x", lambda m, a: "".join(x["content"] for x in m) * 2, lambda m, a: f"[{len(m)}]" + render(m, a)):
        with pytest.raises(ValueError):
            ChatTemplate.derived(wrong)


def test_persona_store(spark, tmp_path):
    raw = spark.createDataFrame(
        [("da", "s", "b", "Ann Lee", 34, "Ann is a nurse", "x" * 400, "", ["tea", "jam"], "likes Ann", "secret"), ("da", "s", "a", None, None, None, None, "chess", [], None, None), ("en", "s", "c", "Bo", 7, "cook", "none", "Bo rows", [], "Bo Smith cooks", "secret")],
        "language string, source string, uuid string, name string, age int, occupation string, education_level string, hobbies_and_interests string, hobbies_and_interests_list array<string>, profile string, sex string",
    )
    store = generation.persona_store(raw)
    totals = generation.write_persona_store(spark, store, str(tmp_path / "store"))
    assert found(totals, "language", "rows") == {("da", 2), ("en", 1)}
    got = {r.source_id: (r.position, json.loads(r.payload)) for r in store.collect()}
    assert [got[k][0] for k in "abc"] == [0, 1, 0] and got["b"][1]["occupation"] == "the person is a nurse" and len(got["b"][1]["education"]) == 160
    assert got["b"][1]["interests"] == "tea, jam" and got["a"][1]["interests"] == "chess" and got["c"][1]["profile"] == "the person Smith cooks" and got["b"][1]["profile"] == ""
    assert all("secret" not in json.dumps(v) for v in got.values())
    with pytest.raises(ValueError):
        generation.write_persona_store(spark, store.unionByName(store), str(tmp_path / "twice"))


def test_teachers_take_turns(monkeypatch):
    import io
    import pickle

    asked = []

    def answer(request, timeout):
        asked.append((request.full_url, json.loads(request.data)))
        if len(asked) == 1:
            raise OSError("away")
        return io.BytesIO(json.dumps({"choices": [{"text": "more", "message": {"content": '{"a": 1}'}, "finish_reason": "stop"}]}).encode())

    monkeypatch.setattr(teacher.urllib.request, "urlopen", answer)
    monkeypatch.setattr(teacher.time, "sleep", lambda s: None)
    one = pickle.loads(pickle.dumps(teacher.HttpTeacher(["http://x/", "http://y"], "m", concurrency=2)))
    assert one.chat([{"role": "user", "content": "q"}], {"top_p": 0.5}, 7) == '{"a": 1}' and [u for u, _ in asked] == ["http://x/chat/completions", "http://y/chat/completions"]
    assert one.completion("go", {}, 1, ["."]) == "more" and asked[-1] == ("http://x/completions", {"model": "m", "prompt": "go", "seed": 1, "stop": ["."]})
    assert one.verdict([], {}, 1, {"type": "object"}) == {"a": 1} and asked[-1][1]["response_format"]["json_schema"]["strict"]
    with pytest.raises(ValueError):
        teacher.HttpTeacher([], "m")


def test_shard_decisions(spark):
    df = spark.createDataFrame([("all", "e")] * 3 + [("few", None)] * 90 + [("few", "e")] * 8 + [("many", None)] * 9 + [("many", "e")] * 9, "shard_key string, error string")
    assert found(teacher.shard_decisions(df), "shard_key", "accepted") == {("all", False), ("few", True), ("many", False)}


def test_personas_lose_names_and_ages(spark):
    raw = spark.createDataFrame([("u", "Ann Lee", 34, "nurse", None, "Ann likes  tea", "x")], "uuid string, name string, age int, occupation string, education_level string, hobbies_and_interests string, skills_and_expertise string")
    assert tuple(generation.personas(raw).first()) == ("u", "30-39", "nurse", "", "the person likes tea")


def test_config_constraints():
    lane = config.Lane("da", 10, {"general": "p"}, {"general": 1.0})
    assert len(config.Campaign((lane,)).receipt()) == 64
    for wrong in (lambda: config.Lane("da", 1, {"a": ""}, {"b": 1.0}), lambda: config.Lane("da", 1, {"a": ""}, {"a": 0.5}), lambda: config.Campaign((lane, lane)), lambda: config.Band(5, 4, 1.0), lambda: config.Campaign((lane,), bands={"x": config.Band(1, 10, 0.5)}), lambda: config.Campaign((lane,), selection=config.Selection({"en": 1}))):
        with pytest.raises(ValueError):
            wrong()


def test_files(spark, tmp_path):
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "en-a-b-000001.jsonl").write_text('{"id": 1}\n\n{"id": 2}\n')
    assert found(files.read_shards(spark, str(tmp_path / "s"), "id long"), "id", "shard_key") == {(1, "en-a-b-000001"), (2, "en-a-b-000001")}
    assert files.write_table(spark.range(5), str(tmp_path / "out")) == 5
    files.write_json(str(tmp_path / "deep" / "r.json"), {"b": 1, "a": "æ"})
    assert json.loads((tmp_path / "deep" / "r.json").read_text()) == {"b": 1, "a": "æ"} and len(list((tmp_path / "deep").iterdir())) == 1
    (tmp_path / "index.md").write_text("[a](a.md) [x](gone.md) [w](https://x.y)")
    (tmp_path / "a.md").write_text("text")
    (tmp_path / "b.md").write_text("text")
    pages = files.read_markdown(spark, str(tmp_path))
    assert found(files.unresolved(pages), "target") == {"gone.md"} and found(files.unlinked(pages, "index.md"), "name") == {"b.md"}


def test_shards_are_handed_over_once(spark, tmp_path):
    folder, seen = tmp_path / "in", []
    folder.mkdir()
    step = lambda: phases.advance(spark, str(folder), "id long", str(tmp_path / "state"), lambda df, n: seen.extend(tuple(r) for r in df.collect()))
    (folder / "a.jsonl").write_text('{"id": 1}\n{"id": 2}\n')
    step()
    step()
    (folder / "b.jsonl").write_text('{"id": 3}\n')
    step()
    assert seen == [("a", 2), ("b", 1)]


def test_budgets_and_objects():
    assert generation.assistant_budget(1000, 2, 4096) == 333 and generation.user_budget(100, 2, 64, 192) == -348
    assert teacher.lenient_object('```json\n{"a": 1}\n```') == {"a": 1}
    with pytest.raises(ValueError):
        teacher.verdict_of({"content": "{}", "finish_reason": "length"})
    assert planning.shard_seeds(3, 5) == planning.shard_seeds(3, 5) and random.Random(5).randrange(2**63) == planning.shard_seeds(1, 5)[0]
