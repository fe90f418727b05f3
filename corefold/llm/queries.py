"""The queries ``opN_<name>``: each applies its operator to its whole table. SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import html, licenses, linededup, packing, pii, quality, sentencepieces, simhash, spotsigs, substring

TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_read(spark, sf_dir, "documents"))


def op2_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(_read(spark, sf_dir, "documents"), pii.run_key(spark))


def op3_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.dedup_table(_read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op4_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(_read(spark, sf_dir, "pages"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_read(spark, sf_dir, "documents"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sentencepieces.encoded(_read(spark, sf_dir, "documents"), sentencepieces.read_model(TOKENIZER))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "n_bytes", F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"), "parity", "round_trip")


def op7_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linededup.dedup(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_removed").alias("n_removed"), F.char_length("text").cast("long").alias("n_kept_chars"), F.sha2("text", 256).alias("kept_sha256"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digest columns of every document; the spans stay with the operator."""
    return licenses.scan(_read(spark, sf_dir, "documents")).drop("matches")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op10_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.compared(_read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_pseudonyms": op2_pseudonyms,
    "op3_passages": op3_passages,
    "op4_pages": op4_pages,
    "op5_packing": op5_packing,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_lines": op7_lines,
    "op8_licenses": op8_licenses,
    "op9_quality": op9_quality,
    "op10_spotsigs": op10_spotsigs,
}

#: Only the passages can be checked in SQL; the others hash with XXH64, train, align, parse or tokenise, and are tested against brute force.
ORACLE_SQL: dict[str, str] = {
    "op3_passages": r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws FROM documents),
windows AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM d WHERE len(ws) >= 50)),
first AS (SELECT k, min(doc_id) AS low FROM windows GROUP BY k HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(i, i + 50)) AS p FROM windows JOIN first USING (k) WHERE low < doc_id)),
placed AS (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS p FROM d),
kept AS (SELECT placed.doc_id, count(gone.p) AS n_removed, coalesce(string_agg(w, ' ' ORDER BY placed.p) FILTER (WHERE gone.p IS NULL), '') AS t
  FROM placed LEFT JOIN gone ON gone.doc_id = placed.doc_id AND gone.p = placed.p GROUP BY placed.doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id
""",
}
