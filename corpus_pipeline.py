"""A pipeline over ``documents``: from raw documents to packed training batches. Each stage works on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corefold.llm import jaccard, linededup, packing, pii, quality, scratch
from corefold.llm.columns import fresh


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules or the classifier reject go; the classifier learns from the labels of these documents."""
    scratch.small_batches(spark)
    model = quality.train(*quality.sample(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    rows = docs.select("text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return quality.score(rows, model, ("row",)).where("__kept").select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Aligned lines go from later documents; a document of which no word is left goes as a whole."""
    n_lines, n_removed = fresh(docs.columns, "n_lines", "n_removed")
    out = linededup.dedup(docs, counts=(n_lines, n_removed)).where(f"{n_removed} = 0 OR {n_removed} < {n_lines}")
    return _recounted(out).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate group (a Jaccard similarity of 0.8 or more of their five-word shingles links two), the document with the smallest id stays."""
    return jaccard.one_of_each(docs, size=5, threshold=0.8)


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data give way to format-preserving pseudonyms."""
    return _recounted(pii.pseudonymised(docs, key=pii.run_key(spark), found=None)).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document, with its bucket and batch."""
    return packing.packed(docs)


def _recounted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


STAGES = [("quality", quality_rules), ("lines", line_dedup), ("near", near_dedup), ("pii", pseudonyms), ("packing", packed)]

#: SQL can't express the classifier, the alignment, the network and the dynamic program; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each one's rows are written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs, _ = scratch.table(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
