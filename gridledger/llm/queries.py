"""The registered queries of this subpackage, over whole tables, and their SQL where it can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridledger.llm import (
    chat,
    embeddings,
    language,
    lines,
    merkle,
    minhash,
    mixing,
    oracle,
    packing,
    quality,
    repair,
    repeats,
    sharding,
    spotsigs,
)
from gridledger.llm.common import table


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op2_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.fingerprints(table(spark, sf_dir, "documents"))


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.deduplicated_lines(table(spark, sf_dir, "documents"))


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_documents(table(spark, sf_dir, "documents"))


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digests(chat.with_example(table(spark, sf_dir, "conversations")))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predicted(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tampered_documents(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repaired_conversations(table(spark, sf_dir, "conversations"))


def op13_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.removed_passages(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_document_fingerprints": op2_document_fingerprints,
    "op3_embedding_near_dedup": op3_embedding_near_dedup,
    "op4_line_dedup": op4_line_dedup,
    "op5_source_mixing": op5_source_mixing,
    "op6_minhash_near_dedup": op6_minhash_near_dedup,
    "op7_chat_formatting": op7_chat_formatting,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_packing": op9_packing,
    "op10_language_id": op10_language_id,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_repeated_passages": op13_repeated_passages,
}


def _mixing_sql() -> str:
    """The same takes by running sums in the order of the hash."""
    passes = ""
    for k in range(mixing.PASSES):
        before = f"p{k - 1}" if k else "start"
        room = f"room{k}"
        opened = "NOT taken" + (f" AND size <= {room}" if k else "")
        passes += f""",
o{k} AS (SELECT *, sum(CASE WHEN {opened} THEN size ELSE 0 END)
                   OVER (PARTITION BY source ORDER BY digits RANGE UNBOUNDED PRECEDING) AS t{k} FROM {before}),
p{k} AS (SELECT * REPLACE (taken OR ({opened} AND t{k} <= {room}) AS taken),
                {room} - coalesce(max(CASE WHEN {opened} AND t{k} <= {room} THEN t{k} END)
                                  OVER (PARTITION BY source), 0) AS room{k + 1} FROM o{k})"""
    end, room = f"p{mixing.PASSES - 1}", f"room{mixing.PASSES}"
    weights = "[" + ", ".join(map(str, mixing.WEIGHTS)) + "]"
    return f"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size,
         substr(md5(coalesce(CAST(doc_id AS VARCHAR), '-') || '|' || coalesce(md5(text), '-')), 1, {mixing.DIGITS}) AS own,
         row_number() OVER (PARTITION BY own) - 1 AS number,
         CASE WHEN number = 0 THEN own ELSE substr(md5(own || '|' || number), 1, {mixing.DIGITS}) END AS digits
  FROM documents),
sources AS (SELECT source, sum(size) AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT source, source_size, {mixing.EPOCHS} * source_size AS bound,
         {weights}[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)}] AS weight
  FROM sources),
levels AS (
  SELECT *, (sum(source_size) OVER () * {mixing.SHARE / 100}::DOUBLE - coalesce(sum(bound) OVER before, 0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM ranked
  WINDOW before AS (ORDER BY bound::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lowest AS (
  SELECT *, first_value(CASE WHEN level * weight <= bound THEN level END IGNORE NULLS) OVER (
            ORDER BY bound::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cut
  FROM levels),
targets AS (
  SELECT source, source_size, CASE WHEN cut IS NULL THEN bound::DOUBLE ELSE least(cut * weight, bound::DOUBLE) END AS target
  FROM lowest),
start AS (
  SELECT s.*, t.source_size, t.target, false AS taken,
         CASE WHEN t.target >= t.source_size THEN t.target - t.source_size ELSE t.target END AS room0
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source){passes},
cells AS (
  SELECT source, digits, sum(size) AS cell, any_value({room}) AS room
  FROM {end} WHERE NOT taken AND size > 0 AND size < 2 * {room} GROUP BY source, digits),
last AS (
  SELECT source, arg_min(digits, (abs(cell - room), digits)) AS digits FROM cells WHERE cell < 2 * room GROUP BY source),
done AS (
  SELECT e.* REPLACE (e.taken OR coalesce(e.digits = l.digits, false) AS taken)
  FROM {end} e LEFT JOIN last l ON e.source IS NOT DISTINCT FROM l.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST(size * (CAST(taken AS INT) + CAST(target >= source_size AS INT)) AS BIGINT) AS taken
FROM done"""


ORACLE_SQL: dict[str, str] = {"op5_source_mixing": _mixing_sql()} | oracle.ORACLE_SQL
