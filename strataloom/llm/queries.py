"""The pN queries: each takes a session and the folder of the tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataloom.llm import answers, language, mixing, mojibake, neardup, packing, repetition, residue, sampling, tokens
from strataloom.session import durable
from strataloom.sources.tables import table


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """Texts whose label is missing or wrong or that have several languages, one row per language."""
    samples = language.read_samples(spark, folder)

    def cases(name: str, key: str, label: str, text: str) -> DataFrame:
        found = language.detect(table(spark, folder, name).select(key, label, text), text, samples, segments=False)
        found = found.where(language.label_cases(found, label, F.col("detected")))
        return found.select(F.lit(name).alias("record_table"), F.col(key).cast("string").alias("record_key"), F.explode("detected.languages").alias("language"))

    requests = cases("instruction_rows", "id", "language_lane", "instruction")
    requests = requests.join(p4_found(spark, folder).withColumnRenamed("id", "record_key"), "record_key", "left_anti")
    return cases("documents", "doc_id", "lang", "text").unionByName(requests).distinct()


def p1_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Every document and request with its language, the confidence and the language of each segment."""
    samples = language.read_samples(spark, folder)

    def labels(name: str, key: str, text: str) -> DataFrame:
        found = language.detect(table(spark, folder, name).select(key, text), text, samples)
        return found.select(F.lit(name).alias("record_table"), F.col(key).cast("string").alias("record_key"), "detected.language", "detected.confidence", "detected.segments")

    return labels("documents", "doc_id", "text").unionByName(labels("instruction_rows", "id", "instruction")).distinct()


def p2_shares(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation with the share of its assistants' words that repeat, its distance and whether it is rejected."""
    said = F.array_join(F.filter("messages", lambda m: m["role"] == "assistant")["content"], "\n")
    rows = table(spark, folder, "audit_rows").select("id", said.alias("text"), "language_lane", "diversity")
    lane = F.substring(F.lower(F.trim("language_lane")), 1, 2)
    return repetition.repetition(rows, "id", "text", lane, F.col("diversity.persona_source"))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations rejected as outliers of which at least a third repeats."""
    return p2_shares(spark, folder).where("rejected and share * 3 >= 1").select("id")


def conversation_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """``id, tokens`` of every conversation: the tokens of its messages."""
    rows = table(spark, folder, "audit_rows").select("id", F.explode(F.concat(F.array(F.lit("")), F.coalesce(F.transform("messages", lambda m: m["content"]), F.array().cast("array<string>")))).alias("text"), "ingested_at")
    counted = tokens.token_counts(rows, ["id", "ingested_at"], "text")
    sums = counted.groupBy("id", "ingested_at").agg(F.sum("tokens").alias("tokens"))
    return sums.groupBy("id").agg(F.max("tokens").alias("tokens"))


def document_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, source, tokens`` of every document; the source in one spelling."""
    rows = table(spark, folder, "documents").select("doc_id", one_spelling(F.col("source")).alias("source"), "text")
    return tokens.token_counts(rows, ["doc_id", "source"], "text")


def one_spelling(name):
    """A name without differences of case, blanks, hyphens and underscores."""
    return F.regexp_replace(F.lower(F.trim(name)), r"[\s_-]+", "_")


def setting(spark: SparkSession, folder: str, name: str) -> float:
    """A run setting."""
    return table(spark, folder, "run_settings").where(F.col("setting") == name).first()["setting_value"]


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations whose stored count is more than twice or less than half the tokens of their messages."""
    stored = table(spark, folder, "audit_rows").where("rendered_token_count is not null").groupBy("id").agg(F.min("rendered_token_count").cast("long").alias("stored"))
    return stored.join(conversation_tokens(spark, folder), "id").where("stored > 2 * tokens or 2 * stored < tokens").select("id")


def p3_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Texts and tokens of documents and conversations by source, language and domain, and by each alone."""
    documents = table(spark, folder, "documents").select("doc_id", "source", "lang", "topic_domain", "text")
    counted = tokens.token_counts(documents, ["source", "lang", "topic_domain"], "text")
    of_documents = tokens.slice_totals(counted, {"source": one_spelling(F.col("source")), "language": language.named_language(F.col("lang")), "domain": one_spelling(F.col("topic_domain"))})
    lanes = table(spark, folder, "audit_rows").groupBy("id").agg(F.min(F.struct("language_lane", "diversity.topic_domain")).alias("of"))
    talks = conversation_tokens(spark, folder).join(lanes, "id").select("tokens", "of.language_lane", "of.topic_domain")
    of_talks = tokens.slice_totals(talks, {"language": language.named_language(F.col("language_lane")), "domain": one_spelling(F.col("topic_domain"))})
    of_talks = of_talks.select(F.lit("audit_rows").alias("record_table"), F.lit(None).cast("string").alias("source"), "language", "domain", "texts", "tokens")
    return of_documents.select(F.lit("documents").alias("record_table"), "source", "language", "domain", "texts", "tokens").unionByName(of_talks)


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """Requests that are template residue, filler, an error page or a notice."""
    return residue.template_residue(table(spark, folder, "instruction_rows").select("id", "instruction")).select("id")


def p4_kinds(spark: SparkSession, folder: str) -> DataFrame:
    """The same requests with what they are: slots, blank, page, filler or notice."""
    return residue.template_residue(table(spark, folder, "instruction_rows").select("id", "instruction"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """Questions whose answer is defective, outside the conversations of p2_found."""
    rows = table(spark, folder, "audit_rows").select("id", "messages")
    return answers.defects(rows, language.read_samples(spark, folder)).join(p2_found(spark, folder), "id", "left_anti").select("id", "exchange", "defect")


def drawn_sample(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The sample of problem 6 and its report."""
    rows = table(spark, folder, "instruction_rows").select("id", F.substring(F.lower(F.trim("language_lane")), 1, 2).alias("language_lane"), F.lower(F.trim("diversity.topic_domain")).alias("topic_domain"))
    return sampling.cell_sample(rows, table(spark, folder, "sample_targets"), setting(spark, folder, "sample_fraction"))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """Cells with fewer requests than needed."""
    return drawn_sample(spark, folder)[1].where("short").select("language_lane", "topic_domain")


def p6_sample(spark: SparkSession, folder: str) -> DataFrame:
    """The requests of the sample."""
    return drawn_sample(spark, folder)[0]


def p6_report(spark: SparkSession, folder: str) -> DataFrame:
    """The cells with what they need, have and give."""
    return drawn_sample(spark, folder)[1]


def near_texts(spark: SparkSession, folder: str) -> tuple[DataFrame, dict[str, int]]:
    """The texts of problem 7 and the least words of each field."""
    requests = table(spark, folder, "instruction_rows").select(F.lit("instruction").alias("field"), "id", F.col("instruction").alias("text"))
    talks = table(spark, folder, "audit_rows").select(F.lit("messages").alias("field"), "id", F.array_join("messages.content", " ").alias("text"))
    return requests.unionByName(talks), {"instruction": 60, "messages": 100}


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of records that share at least half of their runs of three words."""
    return neardup.expand(*neardup.near_duplicates(*near_texts(spark, folder), similarity=0.5, run=3))


def p7_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Every record with its class of equal texts, its links at five words and similarity 0.8, and their group."""
    texts, fields = near_texts(spark, folder)
    return neardup.grouped(*neardup.near_duplicates(texts, dict.fromkeys(fields, 1), similarity=0.8, run=5, every=True))


def p7_links(spark: SparkSession, folder: str) -> DataFrame:
    """The links of ``p7_groups``: pairs of classes of equal texts, each named by its least record, with their similarity."""
    texts, fields = near_texts(spark, folder)
    members, links = neardup.near_duplicates(texts, dict.fromkeys(fields, 1), similarity=0.8, run=5)
    ends = links.select(F.explode(F.array("a", "b")).alias("cid")).distinct()
    names = members.join(ends, "cid", "left_semi").groupBy("cid").agg(F.min("id").alias("name"))
    named = links.join(names.select(F.col("cid").alias("a"), F.col("name").alias("one")), "a").join(names.select(F.col("cid").alias("b"), F.col("name").alias("two")), "b")
    return named.select("field", F.least("one", "two").alias("class_a"), F.greatest("one", "two").alias("class_b"), F.round("similarity", 6).alias("similarity"))


def filled(spark: SparkSession, folder: str) -> tuple[DataFrame, int]:
    """The assignment of problem 8 and the capacity."""
    capacity = int(setting(spark, folder, "container_capacity"))
    return packing.containers(durable(document_tokens(spark, folder).select("doc_id", "tokens")), capacity), capacity


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that alone exceed a container."""
    return filled(spark, folder)[0].where("oversized").select("doc_id").distinct()


def p8_containers(spark: SparkSession, folder: str) -> DataFrame:
    """The container of every document, or of each piece of an oversized one."""
    return filled(spark, folder)[0]


def p8_report(spark: SparkSession, folder: str) -> DataFrame:
    """The number of containers and the space that stays unused."""
    return packing.fill_report(*filled(spark, folder))


def mixed(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The mix of problem 9 and its report."""
    targets = table(spark, folder, "mix_targets").withColumn("source", one_spelling(F.col("source")))
    return mixing.mix(durable(document_tokens(spark, folder)), targets, setting(spark, folder, "mix_fraction"))


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    """Sources that cannot reach their share."""
    return mixed(spark, folder)[1].where("short").select("source")


def p9_mix(spark: SparkSession, folder: str) -> DataFrame:
    """The documents of the mix and how often each is used."""
    return mixed(spark, folder)[0]


def p9_report(spark: SparkSession, folder: str) -> DataFrame:
    """The target and the actual share of each source."""
    return mixed(spark, folder)[1]


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of whose text at least a part is garbled."""
    return mojibake.garbled(table(spark, folder, "documents").select("doc_id", "text")).select("doc_id").distinct()


def p10_restored(spark: SparkSession, folder: str) -> DataFrame:
    """Garbled documents with the restored text, where there is one, and the misreading."""
    return mojibake.garbled(table(spark, folder, "documents").select("doc_id", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        p1_found, p1_labels, p2_found, p2_shares, p3_found, p3_totals, p4_found, p4_kinds, p5_found, p6_found, p6_report, p6_sample, p7_found, p7_groups, p7_links,
        p8_containers, p8_found, p8_report, p9_found, p9_mix, p9_report, p10_found, p10_restored,
    )
}
_SAID = "array_to_string(list_transform({0}, lambda m: m.content), '{1}')"
_WORDS = "regexp_extract_all(lower({0}), '[\\p{{L}}\\p{{N}}]+')"

#: The same results in DuckDB's SQL, where SQL can express them.
SQL: dict[str, str] = {
    "p2_found": f"""WITH one AS (SELECT id, any_value(messages) AS messages FROM audit_rows GROUP BY id),
  t AS (SELECT id, {_WORDS.format(_SAID.format("list_filter(messages, lambda m: m.role = 'assistant')", " "))} AS w FROM one),
  g AS (SELECT id, len(w) AS n, w, unnest(range(1, len(w) - 3)) AS i FROM t),
  e AS (SELECT id, n, i, min(i) OVER (PARTITION BY id, array_to_string(w[i:i + 4], ' ')) AS f FROM g),
  m AS (SELECT DISTINCT id, n, i + k AS p FROM e, range(0, 5) AS r(k) WHERE f < i)
  SELECT id FROM m GROUP BY id, n HAVING count(*) * 3 >= n""",
    "p6_found": """WITH r AS (SELECT DISTINCT id, substring(lower(trim(language_lane)), 1, 2) AS language_lane, lower(trim(diversity.topic_domain)) AS topic_domain FROM instruction_rows),
  h AS (SELECT t.language_lane, t.topic_domain, target_share, min_rows, count(r.id) AS present FROM sample_targets t LEFT JOIN r ON r.language_lane = t.language_lane AND r.topic_domain = t.topic_domain GROUP BY ALL),
  n AS (SELECT floor((SELECT setting_value FROM run_settings WHERE setting = 'sample_fraction') * sum(present)) AS size FROM h)
  SELECT language_lane, topic_domain FROM h, n WHERE present < greatest(min_rows, floor(target_share * size + 1e-9))""",
    "p7_links": f"""WITH x AS (SELECT 'instruction' AS field, id, any_value(instruction) AS body FROM instruction_rows GROUP BY id
    UNION ALL SELECT 'messages', id, any_value({_SAID.format("messages", " ")}) FROM audit_rows GROUP BY id),
  t AS (SELECT field, id, {_WORDS.format("body")} AS w FROM x),
  c AS (SELECT field, min(id) AS id, w FROM t WHERE len(w) >= 5 GROUP BY field, w),
  g AS (SELECT DISTINCT field, id, array_to_string(w[i:i + 4], ' ') AS run FROM (SELECT field, id, w, unnest(range(1, len(w) - 3)) AS i FROM c)),
  n AS (SELECT field, id, count(*) AS runs FROM g GROUP BY ALL),
  b AS (SELECT a.field, a.id AS class_a, b.id AS class_b, count(*) AS shared FROM g a JOIN g b ON a.field = b.field AND a.run = b.run AND a.id < b.id GROUP BY ALL)
  SELECT b.field, class_a, class_b, round(shared / (p.runs + q.runs - shared), 6) AS similarity FROM b JOIN n p ON p.field = b.field AND p.id = class_a JOIN n q ON q.field = b.field AND q.id = class_b WHERE 5 * shared >= 4 * (p.runs + q.runs - shared)""",
    "p7_found": f"""WITH x AS (SELECT 'instruction' AS field, id, any_value(instruction) AS body, 60 AS least FROM instruction_rows GROUP BY id
    UNION ALL SELECT 'messages', id, any_value({_SAID.format("messages", " ")}), 100 FROM audit_rows GROUP BY id),
  t AS (SELECT field, id, least, {_WORDS.format("body")} AS w FROM x),
  g AS (SELECT DISTINCT field, id, array_to_string(w[i:i + 2], ' ') AS run FROM (SELECT field, id, w, unnest(range(1, len(w) - 1)) AS i FROM t WHERE len(w) >= least)),
  n AS (SELECT field, id, count(*) AS runs FROM g GROUP BY ALL),
  b AS (SELECT a.field, a.id AS id_a, b.id AS id_b, count(*) AS shared FROM g a JOIN g b ON a.field = b.field AND a.run = b.run AND a.id < b.id GROUP BY ALL)
  SELECT b.field, id_a, id_b FROM b JOIN n p ON p.field = b.field AND p.id = id_a JOIN n q ON q.field = b.field AND q.id = id_b WHERE 2 * shared >= p.runs + q.runs - shared""",
}
