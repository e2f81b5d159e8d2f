"""A whole campaign: plan, phases, selection and finalisation (G1, G9-G12, T8, T10, T11, the command surface).

Every phase reads the table of the phase before and writes its own below the
root of the campaign. The ledger is a folder of numbered snapshots: a
transition writes the next one, and readers take the last complete one, so a
lost job leaves the ledger as it was. A writer first creates the claim of its
number, which only one can. The table of a phase has a partition for each run,
named by the ledger's number, so a run adds to what earlier ones wrote and a
repeated one replaces nothing but its own.
"""

from __future__ import annotations

import random
import time
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataloom.operators import diversity, finalize, generation, ledger, planning, prompts, rows, selection, validation
from strataloom.session import durable
from strataloom.sources.config import Campaign, load
from strataloom.sources.files import split_errors, write_json, write_table
from strataloom.streaming import phases


class CampaignRun:
    """Runs a configuration below a root folder."""

    PHASES = ("instruction", "instruction_audit", "response", "audit")

    def __init__(
        self, spark: SparkSession, config: Campaign, root: str, teacher: Callable[..., dict] | None = None, count: Callable[[str], int] | None = None,
        catalogue: tuple[DataFrame, DataFrame] | None = None, personas: DataFrame | None = None, detector: Callable[[Column], tuple[Column, Column]] | None = None,
    ) -> None:
        """``catalogue`` has topics and modes (see ``sources.config.catalog``), ``personas`` language, position, source_id and payload; both or
        neither. ``detector`` gives language and confidence of a text column. Without it languages are left to the judge."""
        if (catalogue is None) != (personas is None):
            raise ValueError("a catalogue needs personas, and they a catalogue")
        self.spark, self.config, self.root, self.teacher = spark, config, root.rstrip("/"), teacher
        self.count = count or (lambda text: len(text.split()))
        self.catalogue, self.personas, self.detector = catalogue, personas, detector or (lambda text: (F.lit(None).cast("string"), F.lit(None).cast("double")))

    @classmethod
    def load(cls, spark: SparkSession, path: str, root: str, **others) -> CampaignRun:
        """A run of a YAML configuration."""
        return cls(spark, load(path), root, **others)

    # --- the ledger -----------------------------------------------------------
    def _snapshots(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/ledger")
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
        done = lambda n: fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/ledger/{n}/_SUCCESS"))
        return sorted(int(n) for n in names if n.isdigit() and done(n))

    def tasks(self) -> DataFrame:
        """The last complete snapshot."""
        known = self._snapshots()
        if not known:
            return self.spark.createDataFrame([], ledger.SCHEMA)
        return self.spark.read.schema(ledger.SCHEMA).parquet(f"{self.root}/ledger/{known[-1]}")

    def publish(self, tasks: DataFrame, after: int | None = None) -> DataFrame:
        """Write the next snapshot and give it; raises where another writer has claimed its number.

        ``after`` is the number of the snapshot that ``tasks`` was made from. A claim
        whose writer was lost is removed by ``abandon``.
        """
        number = ((self._snapshots() or [0])[-1] if after is None else after) + 1
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/ledger/_claims/{number}")
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.createNewFile(path):
            raise RuntimeError(f"snapshot {number} of the ledger is being written by another")
        write_table(tasks, f"{self.root}/ledger/{number}")
        return self.tasks()

    def abandon(self) -> None:
        """Remove the claim of the next snapshot, whose writer was lost."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/ledger/_claims/{(self._snapshots() or [0])[-1] + 1}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, False)

    def status(self) -> DataFrame:
        """Tasks by phase and status."""
        return ledger.status_counts(self.tasks())

    def reset_stale(self, now: float, age: float) -> DataFrame:
        """Let tasks wait again that run for too long."""
        return self.publish(ledger.reset_stale(self.tasks(), F.lit(now), age))

    def reset_failed(self, phase: str | None = None) -> DataFrame:
        """Let failed tasks wait again."""
        return self.publish(ledger.reset_failed(self.tasks(), phase))

    def release_held(self, phase: str) -> DataFrame:
        """Let held tasks of a phase wait again if nothing of it runs."""
        tasks = self.tasks()
        if not tasks.where((F.col("phase") == phase) & (F.col("status") == "running")).isEmpty():
            raise ValueError(f"tasks of {phase} are running")
        status = F.when((F.col("phase") == phase) & (F.col("status") == "held"), "pending").otherwise(F.col("status"))
        return self.publish(tasks.withColumn("status", status))

    # --- planning -------------------------------------------------------------
    def quotas(self, factor: float = 1.0, targets: dict[str, int] | None = None) -> DataFrame:
        """Quotas of all cells, from the targets of the selection or else of the lanes."""
        lanes, shares, bands = self.config.frames(self.spark)
        wanted = targets or (self.config.selection.targets if self.config.selection else {lane.language: lane.accepted_target for lane in self.config.lanes})
        goals = self.spark.createDataFrame(list(wanted.items()), "language string, target long")
        grid = goals.select("language", F.ceil(F.col("target") * factor).cast("long").alias("lane_target")).join(shares.withColumnRenamed("share", "complexity_share"), "language")
        grid = planning.apportion(grid, ["language"], "complexity", F.col("lane_target"), F.col("complexity_share"), "complexity_target")
        grid = grid.crossJoin(F.broadcast(bands.select(F.col("length_band").alias("band"), F.col("share").alias("band_share"))))
        return planning.apportion(grid, ["language", "complexity"], "band", F.col("complexity_target"), F.col("band_share")).select("language", "complexity", "band", "quota")

    def plan(self) -> DataFrame:
        """Enqueue the request shards with their seeds, in plan order."""
        parts = []
        for lane in self.config.lanes:
            parts.append(planning.shard_plan(self.quotas(lane.oversample, {lane.language: lane.accepted_target}), self.config.shard_size))
        shards = parts[0]
        for part in parts[1:]:
            shards = shards.unionByName(part)
        plan = shards.orderBy("language", "complexity", "band", "shard_key").collect()  # shards, not rows
        seeds = planning.shard_seeds(len(plan), self.config.seed)
        rows_ = [("instruction", r.shard_key, r["rows"], r.assignment_start, s) for r, s in zip(plan, seeds)]
        new = self.spark.createDataFrame(rows_, "phase string, shard_key string, count long, assignment_start long, seed long")
        new = new.select("phase", "shard_key", F.to_json(F.struct("count", "assignment_start", "seed")).alias("payload"))
        return self.publish(self.tasks().unionByName(ledger.enqueue(self.tasks(), new)))

    def advance(self, phase: str) -> DataFrame:
        """Enqueue the next phase for every finished shard of a phase."""
        following = self.PHASES[self.PHASES.index(phase) + 1]
        if phase == "instruction" and not self.config.audit_requests:
            following = "response"  # unaudited requests are answered at once
        done = self.tasks().where((F.col("phase") == phase) & (F.col("status") == "done"))
        if self.catalogue is not None:  # in an order that mixes topics
            done = done.orderBy(F.sha2("shard_key", 256))
        new = done.select(F.lit(following).alias("phase"), "shard_key", F.to_json(F.struct(F.concat_ws("/", F.lit(phase), "shard_key").alias("source"))).alias("payload"))
        return self.publish(self.tasks().unionByName(ledger.enqueue(self.tasks(), new)))

    # --- phases ---------------------------------------------------------------
    def table(self, phase: str) -> DataFrame:
        """The table of a phase, with the rows of all its runs."""
        return self.spark.read.parquet(f"{self.root}/{phase}").drop("run")

    def failures(self, phase: str) -> DataFrame:
        """``shard_key, index, error`` of the failed rows of a phase."""
        return self.spark.read.schema("shard_key string, index long, error string, run int").parquet(f"{self.root}/{phase}-failures").drop("run")

    def run(self, phase: str) -> int:
        """Process the pending shards of a phase in one job; gives the rows written.

        A shard whose failures its phase tolerates is done; any other writes no rows
        and waits again, or has failed after ``max_retries`` attempts.
        """
        number = (self._snapshots() or [0])[-1]
        tasks = self.tasks()
        pending = tasks.where((F.col("phase") == phase) & (F.col("status") == "pending")).select("shard_key", "payload", "attempts")
        rows_ = durable(getattr(self, f"_{phase}")(pending))
        sums = rows_.groupBy("shard_key").agg(F.count("*").alias("rows"), F.count("error").alias("failures"))
        allowed = {"instruction": F.greatest(F.lit(8), F.ceil(F.col("rows") * 0.02)), "response": F.col("rows") - 1}.get(phase, F.lit(0))
        sums = sums.withColumn("ok", (F.col("failures") == 0) | (F.col("failures") <= allowed) & (F.col("failures") < F.col("rows")))
        verdicts = durable(pending.select("shard_key").join(sums.select("shard_key", "ok"), "shard_key", "left").withColumn("ok", F.coalesce("ok", F.lit(True))))
        good, bad = split_errors(rows_)
        failed = bad.select("shard_key", F.col("row_index").cast("long").alias("index"), "error")
        write_table(failed, f"{self.root}/{phase}-failures/run={number}")
        written = write_table(good.join(verdicts.where("ok"), "shard_key", "left_semi"), f"{self.root}/{phase}/run={number}")
        marked = tasks.join(verdicts.withColumn("phase", F.lit(phase)), ["phase", "shard_key"], "left")
        again = F.when(F.col("attempts") + 1 < self.config.max_retries, "pending").otherwise("failed")
        mine = F.col("ok").isNotNull() & (F.col("status") == "pending")
        status = F.when(mine, F.when(F.col("ok"), "done").otherwise(again)).otherwise(F.col("status"))
        error = F.when(mine & ~F.col("ok"), F.lit("more rows failed than the phase tolerates")).otherwise(F.col("error"))
        marked = marked.select(*(
            {"status": status.alias("status"), "attempts": F.when(mine, F.col("attempts") + 1).otherwise(F.col("attempts")).alias("attempts"), "error": error.alias("error")}.get(c, F.col(c)) for c in tasks.columns
        ))
        self.publish(marked, number)
        return written

    def _bands(self) -> DataFrame:
        return F.broadcast(self.config.frames(self.spark)[2].drop("share"))

    def _instruction(self, pending: DataFrame) -> DataFrame:
        """Requests by prompts that state language, length and diversity, in at most three attempts with fewer words each."""
        task = pending.withColumn("p", F.from_json("payload", "count long, assignment_start long, seed long"))
        asked = task.select("shard_key", "attempts", "p.*").withColumn("row_index", F.explode(F.sequence(F.lit(0).cast("long"), F.col("count") - 1)))
        asked = asked.withColumn("seed", generation.shifted(generation.shifted(F.col("seed"), F.col("row_index")), F.col("attempts") * generation.TASK_SEED))
        cell = F.split("shard_key", "-", 4)
        asked = asked.select(
            planning.row_ids(F.col("shard_key"), F.col("row_index"), F.col("seed")).alias("id"), "shard_key", "row_index", "seed", "assignment_start", cell[0].alias("language_lane"), cell[1].alias("complexity"), cell[2].alias("length_band")
        ).join(self._bands(), "length_band")

        @F.pandas_udf("int")
        def exchanges(seed: pd.Series, least: pd.Series, most: pd.Series) -> pd.Series:
            return pd.Series([exchanges_for(int(s), int(a), int(b)) for s, a, b in zip(seed, least, most)])

        asked = asked.withColumn("desired_exchanges", exchanges("seed", "min_exchanges", "max_exchanges"))
        about = F.lit("")
        if self.catalogue is not None:
            asked = self._assigned(asked)
            told = prompts.by_language(F.col("language_lane"), F.col("d.da"), F.col("d.en"))
            how = prompts.by_language(F.col("language_lane"), F.col("d.mode_da"), F.col("d.mode_en"))
            about = prompts.diversity_sentence(F.col("language_lane"), told, how, F.col("d.profile"), F.col("d.embedded_input"))
        system = F.create_map(*(F.lit(x) for lane in self.config.lanes for c, text in lane.system_prompts.items() for x in (f"{lane.language}-{c}", text)))
        states = generation.condition(F.col("language_lane"), F.col("min_tokens"), F.col("max_tokens"), F.col("desired_exchanges"))
        residual = F.least(F.col("max_tokens"), F.lit(self.config.soft_sequence)) - F.col("desired_exchanges") * self.config.min_assistant
        for attempt in range(3):
            text = prompts.request_prompt(F.col("language_lane"), states, F.col("desired_exchanges"), prompts.request_words(residual, F.lit(attempt)))
            asked = asked.withColumn(f"_p{attempt}", F.concat_ws("\n", F.nullif(F.get(F.array(system[F.concat_ws("-", "language_lane", "complexity")]), F.lit(0)), F.lit("")), F.nullif(about, F.lit("")), text))
        asked = asked.drop("min_tokens", "max_tokens", "min_exchanges", "max_exchanges", "assignment_start")
        written = generation.write_requests(asked, self.teacher, ["_p0", "_p1", "_p2"])
        clean = validation.sanitized(F.col("instruction"), self.config.boundary, list(self.config.control_tokens))
        written = written.withColumn("_c", F.when(F.col("error").isNull(), clean))
        written = written.withColumn("error", F.coalesce("error", "_c.error")).withColumn("instruction", F.col("_c.text")).drop("_c")
        return written.withColumn("diversity", F.struct(*(F.col(f"d.{c}") for c in DIVERSITY))).drop("d") if self.catalogue is not None else written

    def _assigned(self, asked: DataFrame) -> DataFrame:
        """``asked`` with a struct ``d`` of topic, mode and persona by the lane-wide index of a row."""
        topics, modes = self.catalogue
        parts = []
        for lane in self.config.lanes:
            people = self.personas.where(F.col("language") == lane.language)
            n = people.count()
            mine, others, offset, step = planning.assigner(topics, modes, n, self.config.seed, lane.language)
            rows_ = planning.assign(asked.where(F.col("language_lane") == lane.language), F.col("assignment_start") + F.col("row_index"), mine, others, people, topics.count(), modes.count(), n, offset, step)
            parts.append(rows_)
        every = rows.unioned(*parts)
        every = every.join(F.broadcast(topics.select(F.col("id").alias("topic_id"), "en", "da")), "topic_id").join(F.broadcast(modes.select(F.col("id").alias("interaction_mode"), F.col("en").alias("mode_en"), F.col("da").alias("mode_da"), "embedded_input")), "interaction_mode")
        people = self.personas.select(F.col("language").alias("language_lane"), F.col("source_id").alias("persona_source_id"), F.from_json("payload", "source string, age_band string, occupation string, education string, interests string, profile string").alias("who"))
        every = every.join(people, ["language_lane", "persona_source_id"], "left")
        profile = generation.profile_sentence(F.col("who.age_band"), F.col("who.occupation"), F.col("who.education"), F.col("who.interests"), F.col("who.profile"))
        inner = {"topic_id": F.col("topic_id"), "topic_domain": F.col("topic_domain"), "interaction_mode": F.col("interaction_mode"), "persona_source": rows.or_unknown(F.col("who.source")), "persona_source_id": F.col("persona_source_id"),
                 "en": F.col("en"), "da": F.col("da"), "mode_en": F.col("mode_en"), "mode_da": F.col("mode_da"), "embedded_input": F.col("embedded_input"), "profile": rows.or_unknown(profile)}
        # a row without a persona is an error of the store, not of the row
        found = F.when(F.col("persona_source_id").isNull(), F.raise_error(F.lit("a row has no persona"))).otherwise(F.struct(*(v.alias(k) for k, v in inner.items())))
        return every.withColumn("d", found).select(*asked.columns, "d")

    def _instruction_audit(self, pending: DataFrame) -> DataFrame:
        detected, sure = self.detector(F.col("instruction"))
        judged = generation.audit_requests(self.table("instruction").join(pending.select("shard_key"), "shard_key", "left_semi"), self.teacher, least=self.config.minimum_quality, detected=detected, confidence=sure)
        return judged.withColumn("error", F.col("instruction_audit.audit_error"))

    def _response(self, pending: DataFrame) -> DataFrame:
        source = self.table("instruction_audit" if self.config.audit_requests else "instruction")
        if self.config.audit_requests:
            source = source.where(F.coalesce("instruction_audit.accepted", F.lit(False)))
        source = source.join(pending.select("shard_key", "attempts"), "shard_key").join(self._bands(), "length_band")
        talked = generation.respond(source, self.teacher, self.count, self.config.soft_sequence, self.config.max_retries, self.config.min_user, self.config.min_assistant, self.config.max_sequence)
        counter = self.count

        @F.pandas_udf("int")
        def measure(said: pd.Series) -> pd.Series:
            return pd.Series([None if talk is None else sum(counter(m["content"] or "") for m in talk) for talk in said], dtype="Int32")

        answered = source.drop("finish_reason").join(talked, "id").withColumn("rendered_token_count", measure("messages")).withColumn("actual_exchanges", rows.exchanges(F.col("messages")))
        fits = F.col("rendered_token_count").between(F.col("min_tokens"), F.col("max_tokens")) & (F.col("rendered_token_count") <= self.config.soft_sequence) & (F.col("actual_exchanges") == F.col("desired_exchanges"))
        return answered.withColumn("length_valid", F.coalesce(fits, F.lit(False))).drop("min_tokens", "max_tokens", "min_exchanges", "max_exchanges", "attempts")

    def _audit(self, pending: DataFrame) -> DataFrame:
        source = self.table("response").join(pending.select("shard_key"), "shard_key", "left_semi")
        turns = rows.turns(source).join(source.select("id", "language_lane", "length_valid", "seed"), "id")
        detected, sure = self.detector(F.concat_ws("\n", "question", "answer"))
        judged = generation.audit_turns(turns, self.teacher, detected=detected, confidence=sure)
        each = F.array_sort(F.collect_list(F.struct("turn", "accepted", "reason", "deterministic")))  # the turns of one conversation
        judged = judged.groupBy("id").agg(F.bool_and("accepted").alias("_ok"), F.count("*").cast("int").alias("_n"), each.alias("turn_audits"), F.max("audit_error").alias("error"))
        verdict = F.struct(F.coalesce("_ok", F.lit(False)).alias("accepted"), F.coalesce("_n", F.lit(0)).alias("turns"))
        return source.join(judged, "id", "left").withColumn("audit", verdict).drop("_ok", "_n")

    # --- selection and finalisation ---------------------------------------------
    def select(self, stage: str, counts: DataFrame) -> DataFrame:
        """Hold the surplus and release the selection of a phase. ``counts`` has
        ``shard_key, emitted, unresolved`` of the shards.

        An audit is not selected anew while one runs, nor so that a finished shard
        would fall out. The receipt is in ``<root>/<stage>-selection.json``.
        """
        chosen = self.config.selection
        cell, parts = ["language", "complexity", "band"], F.split("shard_key", "-", 4)
        counts = counts.select("shard_key", parts[0].alias("language"), parts[1].alias("complexity"), parts[2].alias("band"), "emitted", "unresolved")
        kept = selection.retention(counts.groupBy(*cell).agg(F.sum("emitted").alias("emitted"), F.sum("unresolved").alias("unresolved")), chosen.fallback_retention if chosen else 1.0)
        number, tasks = (self._snapshots() or [0])[-1], self.tasks()
        mine = tasks.where(F.col("phase") == stage).select("shard_key", "status").join(counts, "shard_key").join(kept.select(*cell, "retention"), cell)
        expected = F.col("emitted") * F.col("retention")
        quotas, order = self.quotas(chosen.audit_buffer if chosen else 1.0), selection.stable_order(self.config.seed, stage, F.col("shard_key"))
        if stage == "audit":  # the same prefix over the rows there are, of all shards
            if not mine.where("status = 'running'").isEmpty():
                raise RuntimeError("audits are running")
            picked = durable(selection.take_until(mine.join(quotas, cell), cell, F.col("quota"), F.col("emitted"), order))
            if not selection.outside(mine.where("status = 'done'"), picked.where("selected")).isEmpty():
                raise RuntimeError("the selection would leave out finished shards")
            had = picked.where("false").groupBy(*cell).agg(F.sum("emitted").alias("had"))
        else:
            had = mine.where("status in ('done', 'running')").groupBy(*cell).agg(F.sum(F.when(F.col("status") == "running", expected).otherwise(F.col("emitted"))).alias("had"))
            open_ = mine.where("status in ('pending', 'held')").join(quotas, cell).join(had, cell, "left")
            need = F.greatest(F.lit(0), F.col("quota") - F.coalesce("had", F.lit(0)))
            picked = durable(selection.take_until(open_, cell, need, expected, order))
        taken = picked.where("selected")
        report = selection.cell_projection(quotas, kept, had, taken.withColumn("expected", F.col("emitted") if stage == "audit" else expected), cell)
        write_json(f"{self.root}/{stage}-selection.json", selection.receipt(report, taken, cell), self.spark)
        changed = selection.hold_and_release(tasks.where(F.col("phase") == stage), taken)
        return self.publish(tasks.where(F.col("phase") != stage).unionByName(changed), number)

    def finalize(self, out: str) -> DataFrame:
        """Write the final dataset, sorted by id, and its reports, and give the cell report.

        Reports are ``<out>.report``, ``.bands``, ``.lanes``, ``.gates`` and ``.totals``. A
        stored token count that differs from the one counted now is refused.
        """
        chosen = self.config.selection
        audited = self.table("audit")
        accepted = audited.where(F.coalesce("audit.accepted", F.lit(False))).withColumn("_prompt", rows.digest_of_prompt(rows.first_user(F.col("messages"))))
        # the first of every prompt is found on keys alone; the conversations are joined to it
        firsts = rows.keep_first(accepted.select("id", "shard_key", "row_index", "_prompt"), F.col("_prompt"), ["shard_key", "row_index", "id"])
        counter = self.count

        @F.pandas_udf("long")
        def measure(said: pd.Series) -> pd.Series:
            return pd.Series([sum(counter(m["content"] or "") for m in talk) for talk in said], dtype="int64")

        counted = accepted.drop("_prompt").join(firsts.select("id"), "id", "left_semi").withColumn("_now", measure("messages"))
        stale = F.col("rendered_token_count").isNotNull() & (F.col("rendered_token_count") != F.col("_now"))
        counted = counted.withColumn("rendered_token_count", F.when(stale, F.raise_error(F.concat(F.lit("stored and counted tokens differ: "), F.col("id")))).otherwise(F.col("_now"))).drop("_now")
        inside = rows.banded(counted, self.config.frames(self.spark)[2], "length_band", F.col("rendered_token_count"), self.config.max_sequence).where("in_band").drop("in_band", "instruction")
        inside = inside.withColumnRenamed("language_lane", "language").withColumnRenamed("length_band", "band").withColumn("tokens", F.col("rendered_token_count"))
        quotas, cell = self.quotas(), ["language", "complexity", "band"]
        narrow = durable(inside.select("id", *cell, "tokens"))
        if chosen is None or chosen.retain_surplus:
            marked = durable(narrow.join(F.broadcast(quotas.select(*cell)), cell, "left_semi").withColumn("chosen", F.lit(True)))
        else:
            marked = durable(finalize.flagged(narrow, cell, quotas))
        report = durable(finalize.flagged_report(marked, quotas))
        if chosen and chosen.require_targets:
            finalize.require_targets(report)
        best = inside.drop("tokens").join(marked.where("chosen").select("id"), "id", "left_semi")
        write_table(best.orderBy("id"), out)
        reports = {"report": report, "bands": finalize.band_report(report), "lanes": finalize.lane_report(report)}
        if self.config.audit_requests:
            requests = self.table("instruction_audit")
            dims = {"language": F.col("language_lane"), "complexity": F.col("complexity"), "length_band": F.col("length_band")}
            if "diversity" in requests.columns:
                dims |= {"topic": F.col("diversity.topic_id"), "topic_domain": F.col("diversity.topic_domain"), "interaction_mode": F.col("diversity.interaction_mode"), "persona_source": F.col("diversity.persona_source")}
            reports["gates"] = finalize.gate_counts(requests, F.col("instruction_audit.accepted"), dims).orderBy("dimension", "value")
        totals = marked.agg(F.count_if("chosen").alias("rows"), F.coalesce(F.sum(F.when(F.col("chosen"), F.col("tokens"))), F.lit(0)).alias("tokens"), F.count("*").alias("_in"))
        everything = audited.agg(F.count("*").alias("_all"))
        reports["totals"] = totals.crossJoin(everything).select(F.lit(self.config.receipt()).alias("config_hash"), "rows", "tokens", (F.col("_all") - narrow.count()).alias("rejected"))
        for name, frame in reports.items():
            write_table(frame.coalesce(1), f"{out}.{name}", "json")
        return report

    def diversity_report(self, phase: str = "instruction") -> DataFrame:
        """The lane report of a phase (G13), also written with its sample to ``<root>/<phase>-diversity`` and ``-sample``."""
        requests = self.table(phase).select("id", F.col("language_lane").alias("lane"), "diversity", rows.first_user(F.col("messages"), F.col("instruction")).alias("text") if phase != "instruction" else F.col("instruction").alias("text"))
        report, sample = diversity.lane_report(requests)
        write_table(sample.coalesce(1), f"{self.root}/{phase}-sample", "json")
        write_table(report.coalesce(1), f"{self.root}/{phase}-diversity", "json")
        return report

    def assert_gate(self, phase: str = "instruction") -> DataFrame:
        """The lane report, if every lane is diverse enough; raises otherwise."""
        report = self.diversity_report(phase)
        for line in report.collect():  # a line a lane
            diversity.gate({"topics": line.topics, "modes": line.modes, "topic_entropy": line.topic_entropy, "mode_entropy": line.mode_entropy, "near_rows": line.near_rows_65})
        return report

    def wait_for_gate(self, fraction: float = 0.01, phase: str = "instruction", poll: float = 60.0, polls: int | None = None) -> DataFrame:
        """Wait until every lane has its ``fraction`` of rows, then check the gate and give the report.

        Raises ``TimeoutError`` after ``polls`` looks without success.
        """
        targets, looks = {lane.language: lane.accepted_target for lane in self.config.lanes}, 0
        while not phases.thresholds_reached(self.table(phase).groupBy(F.col("language_lane").alias("language")).agg(F.count("*").alias("rows")), targets, fraction):
            looks += 1
            if polls is not None and looks >= polls:
                raise TimeoutError(f"{phase} has too few rows")
            time.sleep(poll)
        return self.assert_gate(phase)

    def resume(self, phase: str) -> int:
        """Release what the gate held of a phase and run it."""
        self.release_held(phase)
        return self.run(phase)

    def run_all(self, out: str) -> DataFrame:
        """Plan, run all phases and finalise."""
        write_json(f"{self.root}/config.json", {"config_hash": self.config.receipt()}, self.spark)
        self.plan()
        for phase in self.PHASES:
            if phase == "instruction_audit" and not self.config.audit_requests:
                continue
            self.run(phase)
            if phase != self.PHASES[-1]:
                self.advance(phase)
        return self.finalize(out)


#: The fields of a row's diversity that are kept.
DIVERSITY = ("topic_id", "topic_domain", "interaction_mode", "persona_source", "persona_source_id")


def exchanges_for(seed: int, least: int, most: int) -> int:
    """A number of exchanges drawn from a row's seed."""
    return random.Random(seed ^ 0x5DEECE66D).randint(least, most)
