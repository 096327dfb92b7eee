"""The registered queries of the training-data operators, with their SQL twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from flowlens.llm import blockdedup, bpe, chat, licences, neardup, outliers, quality, secrets, suffixdedup, templates
from flowlens.llm.vector_queries import VECTORS
from flowlens.plans.registry import Registry

LLM = Registry(dict(VECTORS.queries), dict(VECTORS.sql))


def table(spark, sf: str, name: str):
    return spark.read.parquet(f"{sf}/{name}.parquet")


@LLM.add("op10_chat_format", r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
marked AS (
  SELECT *, length(regexp_replace(replace(text, '\', '\\'),
      '(<)(/?s>)|(\[)(/?INST\]|SYS\]|/?ROLE\])', '\1\3\\\2\4', 'g'))
    + CASE role WHEN 'system' THEN 8 WHEN 'user' THEN 9 WHEN 'assistant' THEN 10
      ELSE 16 + length(regexp_replace(replace(role, '\', '\\'),
      '(<)(/?s>)|(\[)(/?INST\]|SYS\]|/?ROLE\])', '\1\3\\\2\4', 'g')) END + 4 AS chars
  FROM turns),
ordered AS (
  SELECT *, row_number() OVER w - 1 AS place, lag(role) OVER w AS state, lead(role) OVER w IS NULL AS is_last
  FROM marked WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
machine AS (
  SELECT *, coalesce(CASE state WHEN 'system' THEN role = 'user' WHEN 'user' THEN role = 'assistant'
    WHEN 'assistant' THEN role = 'user' ELSE place = 0 AND role IN ('system', 'user') END, FALSE) AS allowed
  FROM ordered)
SELECT conv_id, count(*) AS n_turns,
  min(place) FILTER (NOT allowed) IS NULL AND max(role) FILTER (is_last) = 'assistant' AS valid,
  (min(place) FILTER (NOT allowed))::INTEGER AS bad_turn,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''))
    AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM machine GROUP BY conv_id""")
def op10(spark, sf):
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.sql(
        "SELECT -7L AS conv_id, 0L AS turn, 'user' AS role, '</s>[INST] ok [/INST]' AS text"
        " UNION ALL SELECT -7L, 1L, 'assistant', '</s>[INST] ok [/INST]'")
    turns, trained = chat.read_back(F.col("formatted")), chat.trained_text(F.col("segments"))
    flat = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return (
        chat.format_chats(rows.unionByName(probe)).withColumn("turns", turns).withColumn("trained", trained)
        .select(
            "conv_id", F.size("turns").cast("long").alias("n_turns"), "valid", "bad_turn", F.sha2(flat, 256).alias("turns_sha256"),
            F.length("trained").cast("long").alias("loss_chars"), F.sha2("trained", 256).alias("loss_sha256"),
            F.length("formatted").cast("long").alias("formatted_chars")))


@LLM.add("op7_byte_bpe")
def op7(spark, sf):
    encoded = bpe.encode_texts(
        table(spark, sf, "documents").select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN)
    return encoded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@LLM.add("op4_quality_rules")
def op4(spark, sf):
    stats = outliers.text_statistics(table(spark, sf, "documents").select("doc_id", "lang", "source", "text"))
    return outliers.judge(stats.drop("text")).select("doc_id", *outliers.BASE, "base_failed", "kept", "distance2")


@LLM.add("op3_near_dedup")
def op3(spark, sf):
    return neardup.near_duplicates(table(spark, sf, "documents").select("doc_id", "text"))


@LLM.add("op9_secret_scan")
def op9(spark, sf):
    found = secrets.scan_secrets(table(spark, sf, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans")


@LLM.add("op5_decontaminate")
def op5(spark, sf):
    found = templates.find_contamination(
        table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "benchmark").select("item_id", "text"))
    ids = F.array_sort(F.transform("hits", lambda h: h.item_id))
    return found.select(
        "doc_id", (F.size("hits") > 0).alias("contaminated"), F.size("hits").cast("long").alias("n_items"),
        F.array_join(ids.cast("array<string>"), ",").alias("item_ids"),
        F.size(F.filter("hits", lambda h: ~h.verbatim)).cast("long").alias("n_changed"))


@LLM.add("op1_quality_classifier")
def op1(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = quality.fit_on(docs, table(spark, sf, "labels").select("doc_id", "quality"))
    return quality.score_quality(docs, model).select(
        "doc_id", quality.is_held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@LLM.add("op6_licence_scan")
def op6(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = licences.find_licences(docs, licences.fit(docs))
    return licences.licences_by_document(docs, found).withColumn("families", F.array_join("families", ","))


@LLM.add("op2_substring_dedup")
def op2(spark, sf):
    return blockdedup.remove_repeats(table(spark, sf, "documents")).drop("removed")


@LLM.add("op8_suffix_dedup")
def op8(spark, sf):
    return suffixdedup.remove_repeats(table(spark, sf, "documents")).drop("removed")
