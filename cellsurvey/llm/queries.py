"""The dealt operators over their whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellsurvey.llm import (
    decontamination, dialogue, html_text, lexical_search, lm_scoring, ngram_join, packing, paragraphs, quality, secrets, spelling, toxicity, warc,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, folder, "documents"))
    spans = F.arrays_zip("kinds", "starts", "ends")
    text = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kinds"], s["starts"], s["ends"])), ",")
    count = lambda kind: F.size(F.filter("kinds", lambda k: k == kind)).cast("bigint").alias(f"n_{kind}")
    base = F.filter(spans, lambda s: s["kinds"].isin(*secrets.BASE_KINDS))
    return found.select(
        "doc_id", *[count(k) for k in secrets.BASE_KINDS], F.sha2(F.encode(text(base), "UTF-8"), 256).alias("base_sha256"),
        text(spans).alias("spans"), *[count(k) for k in secrets.KINDS[3:]])


@query
def op2_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.jaccard_classes(table(spark, folder, "documents"))


@query
def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(table(spark, folder, "documents"), table(spark, folder, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed_rules")


@query
def op4_perspectives(spark: SparkSession, folder: str) -> DataFrame:
    return dialogue.rotate(table(spark, folder, "conversations")).select(
        "conv_id", "perspective", "part", "n_turns", "text",
        F.array_join(F.transform("mask", lambda m: F.concat_ws(":", m["start"], m["end"])), ",").alias("mask"))


@query
def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    index = warc.write_archives(table(spark, folder, "pages"))
    return warc.read_records(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


@query
def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    chain = toxicity.train(docs, table(spark, folder, "labels"))
    return toxicity.score(docs.select("doc_id", "text"), chain).select(
        "doc_id", *[F.round(f"p_{c}", 6).alias(f"p_{c}") for c in toxicity.CATEGORIES], "is_toxic")


@query
def op7_backoff_scores(spark: SparkSession, folder: str) -> DataFrame:
    return lm_scoring.backoff_scores(table(spark, folder, "documents"))


@query
def op8_best_fit(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


@query
def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    hits = decontamination.find_hits(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "benchmark"))
    return hits.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.encode(F.array_join("items", ","), "UTF-8"), 256).alias("items_sha256"), "contaminated")


@query
def op10_paragraph_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return paragraphs.repeated_passages(table(spark, folder, "documents"))


@query
def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variant_groups(table(spark, folder, "documents"), drop_one_in=97)


@query
def op12_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    index = lexical_search.build_index(table(spark, folder, "documents"))
    return lexical_search.rank_documents(index, table(spark, folder, "benchmark"))


ORACLES["op12_lexical_search"] = r"""
WITH docs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM docs GROUP BY ALL),
lens AS (SELECT doc_id, count(*) AS n FROM docs GROUP BY ALL),
totals AS (SELECT count(*) AS nd, sum(n)::BIGINT AS nt FROM lens),
norms AS (SELECT doc_id, 75 + (25 * n * nd) // nt AS m FROM lens, totals),
weights AS (SELECT term, floor(1000 * ln((2 * any_value(nd) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, totals GROUP BY term),
uses AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
  GROUP BY ALL),
scores AS (
  SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM uses JOIN weights USING (term) JOIN tf USING (term) JOIN norms USING (doc_id) GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 20
"""


@query
def op13_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract_text(table(spark, folder, "pages"))
