"""One query per operator over the whole table ``documents``, with its SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlake.llm import (
    alignment,
    bpe,
    exact_dedup,
    filter_audit,
    lm_score,
    mixing,
    near_dedup,
    pii,
    quality_classifier,
    quality_rules,
    sharding,
    substring_dedup,
    suffix_dedup,
)
from spendlake.llm.common import read

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


@query(
    "op1_quality_rules",
    r"""
    WITH docs AS (
        SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
               list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
               list_filter(string_split(coalesce(text, ''), chr(10)),
                           lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
        FROM documents
    ), windows AS (
        SELECT rid, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
        FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM docs)
    ), counted AS (
        SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM windows
    ), repeated AS (
        SELECT rid, count(DISTINCT i + o) AS n
        FROM counted, (SELECT unnest([0, 1, 2]) AS o) WHERE n > 1 GROUP BY rid
    ), stats AS (
        SELECT doc_id, len(w)::BIGINT AS n_words,
               length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
               (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
               len(lines)::BIGINT AS n_lines,
               (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
               coalesce(r.n, 0)::BIGINT AS n_repeat_words
        FROM docs LEFT JOIN repeated r USING (rid)
    ), based AS (
        SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM stats
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT (base_failed OR 100 * n_symbols > 40 * n_words OR 100 * n_dup_lines > 30 * n_lines
                OR word_chars > 20 * n_words OR word_chars < 2 * n_words) AS kept
    FROM based
    """,
)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.judged_with_statistics(
        read(spark, folder, "documents").select("doc_id", "text")
    )
    base = F.lit(False)
    for rule in quality_rules.BASE_RULES:
        base = base | rule.rejects(F.col)
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base.alias("base_failed"),
        F.col("rejected_by").isNull().alias("kept"),
    )


@query("op2_near_dedup")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(read(spark, folder, "documents"), percent=85)


@query("op3_suffix_dedup")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.repeated_bytes(read(spark, folder, "documents")).drop("kept")


@query("op4_lm_score")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    documents = read(spark, folder, "documents").select("doc_id", "text")
    model, counts = lm_score.train(documents.where(~lm_score.held_out(F.col("doc_id"))))
    return lm_score.score(documents, model, counts).select(
        "doc_id",
        lm_score.held_out(F.col("doc_id")).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


@query("op5_bpe")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    documents = read(spark, folder, "documents")
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return bpe.round_trip(texts, keep_ids=False)


@query("op6_mixing")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.Mixture(read(spark, folder, "documents")).taken()


@query("op7_substring_dedup")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.repeated_passages(read(spark, folder, "documents")).drop("kept")


@query(
    "op8_exact_dedup",
    """
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_groups(read(spark, folder, "documents"))


@query(
    "op9_sharding",
    """
    WITH crc AS (  -- one step of CRC-32 for each value of a byte
        SELECT list_transform(range(256), lambda c: list_reduce(
                   list_concat([c], range(8)),
                   lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS step
    ), ranked AS (
        SELECT doc_id, source, coalesce(strlen(text), 0) + 1 AS size,
               list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
                              lambda x: ('0x' || x)::BIGINT) AS bytes,
               md5('1|' || coalesce(doc_id::VARCHAR, '')) AS hash,
               row_number() OVER (PARTITION BY source ORDER BY md5('1|' || coalesce(doc_id::VARCHAR, ''))) AS r,
               count(*) OVER (PARTITION BY source) AS n
        FROM documents
    ), placed AS (
        SELECT *, row_number() OVER (ORDER BY (2 * r - 1) / (2 * n), hash, source) - 1 AS place,
               count(*) OVER () AS total
        FROM ranked
    )
    SELECT doc_id, size, 
           xor(4294967295, list_reduce(list_concat([4294967295], bytes),
               lambda a, b: xor(a >> 8, step[(xor(a, b) & 255) + 1]))) AS text_crc32, 'rows' AS law, (place * 16 // total)::INTEGER AS shard,
           place - (((place * 16 // total) * total + 15) // 16) AS slot, NULL::INTEGER AS grown_shard
    FROM placed, crc
    """,
)
def op9(spark: SparkSession, folder: str) -> DataFrame:
    rows = read(spark, folder, "documents").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "source",
        (F.octet_length(F.coalesce("text", F.lit(""))) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
    )
    return sharding.stratified_shards(rows).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op10_quality_classifier")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    documents = read(spark, folder, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = quality_classifier.fit(documents, read(spark, folder, "labels"))
    return quality_classifier.quality_scores(documents, model).select(
        "doc_id", quality_classifier.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted"
    )


@query(
    "op11_filter_audit",
    r"""
    WITH docs AS (
        SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
               list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
        FROM documents
    ), marks AS (
        SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic
        FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
    ), judged AS (
        SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
               CASE WHEN len(w) < 200 THEN 'A' ELSE '' END
               || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
               || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 3 * length(text)
                       THEN 'C' ELSE '' END
               || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
               || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END AS fails
        FROM docs LEFT JOIN marks USING (doc_id)
    ), counts AS (
        SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
        FROM judged GROUP BY part, fails
    ), letters AS (
        SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
    ), orders AS (
        SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
        FROM letters a, letters b, letters c, letters d, letters e
        WHERE b.x <> a.x AND c.x NOT IN (a.x, b.x) AND d.x NOT IN (a.x, b.x, c.x)
              AND e.x NOT IN (a.x, b.x, c.x, d.x)
    ), steps AS (
        SELECT filter_order, step, substr(filter_order, step, 1) AS f, substr(filter_order, 1, step - 1) AS before
        FROM orders, (SELECT unnest(range(1, 6))::INTEGER AS step)
    ), told AS (
        SELECT c.*, s.*, contains(fails, f) AS failing,
               length(translate(fails, before, '')) < length(fails) AS gone
        FROM counts c, steps s
    ), found AS (
        SELECT part, filter_order, step, f,
               coalesce(sum(n) FILTER (NOT gone AND NOT failing), 0)::BIGINT AS kept,
               coalesce(sum(n) FILTER (NOT gone AND failing), 0)::BIGINT AS removed,
               coalesce(sum(n) FILTER (gone AND failing), 0)::BIGINT AS redundant,
               coalesce(sum(n) FILTER (fails = f), 0)::BIGINT AS unique_fails,
               coalesce(sum(good) FILTER (NOT gone AND failing), 0)::BIGINT AS good_lost,
               coalesce(sum(toxic) FILTER (NOT gone AND failing), 0)::BIGINT AS toxic_lost
        FROM told GROUP BY ALL
    )
    SELECT * EXCLUDE (f), (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM found
    """,
)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.filter_audit(read(spark, folder, "documents"), read(spark, folder, "labels"))


@query("op12_token_alignment")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.linked(read(spark, folder, "documents"))


@query("op13_personal_data")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    documents = read(spark, folder, "documents")
    return pii.found(documents, pii.fit(documents))
