"""Readers and writers: entity tables, ground truth, Parquet, submissions, JSON metrics, cached tables."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

ENTITY = StructType([StructField(c, StringType()) for c in ("entity_id", "business_name", "business_address", "country")])
TRUTH = StructType([StructField(c, StringType()) for c in ("source1_entity_id", "matched_entity_ids")])
# Strings that default parsing takes for missing.
NA_WORDS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def read_tsv(spark: SparkSession, path: str, schema: StructType = ENTITY, na_mode: str = "pandas_default", columns: list[str] | None = None) -> DataFrame:
    """A tab-separated file with a header, all strings; only ``columns`` are parsed if given.

    ``na_mode``: ``pandas_default`` takes blanks and words such as NA or NULL for null; ``literal`` keeps words and gives "" for blanks.
    """
    if na_mode not in ("pandas_default", "literal"):
        raise ValueError(na_mode)
    df = spark.read.schema(schema).options(sep="\t", header=True, quote='"', escape='"', enforceSchema=False, mode="PERMISSIVE").csv(path)
    if columns:
        df = df.select(*columns)
    value = (lambda c: F.when(~F.col(c).isin(NA_WORDS), F.col(c))) if na_mode == "pandas_default" else (lambda c: F.coalesce(F.col(c), F.lit("")))
    return df.select(*[value(c).alias(c) for c in df.columns])


def with_positions(df: DataFrame, out: str = "pos") -> DataFrame:
    """Number rows in file order from 0, without gaps: partition sizes first, then ranks within partitions."""
    tagged = df.withColumn("__id", F.monotonically_increasing_id()).withColumn("__part", F.shiftright("__id", 33))
    sizes = tagged.groupBy("__part").agg(F.count("*").alias("__n"))
    before = sizes.select("__part", F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))  # one row for each partition
    return tagged.join(before, "__part").withColumn(out, F.col("__before") + F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))).drop("__id", "__part", "__before")


def pool(s2: DataFrame, s3: DataFrame) -> DataFrame:
    """Both noisy sources with their names."""
    return s2.withColumn("source", F.lit("S2")).unionByName(s3.withColumn("source", F.lit("S3")))


def truth_pairs(raw: DataFrame) -> DataFrame:
    """``s1_id, noisy_id, source`` of a ground-truth table of comma-joined ids."""
    ids = F.transform(F.split(F.coalesce("matched_entity_ids", F.lit("")), ","), lambda x: F.trim(x))
    exploded = raw.select(F.trim("source1_entity_id").alias("s1_id"), F.explode(F.filter(ids, lambda x: x != "")).alias("noisy_id"))
    return exploded.withColumn("source", F.split("noisy_id", "-")[0])


def head(df: DataFrame, n: int, order: str) -> DataFrame:
    """The first n rows in a given order, for smoke tests."""
    return df.orderBy(order).limit(n)


def cached(spark: SparkSession, path: str, inputs: list[DataFrame], compute, overwrite: bool = False) -> DataFrame:
    """The table at ``path`` if it was made from the same inputs by the same plan, else computed and written. The fingerprint is part of the path, so nothing stale is served."""
    plans = "".join(i._jdf.queryExecution().analyzed().canonicalized().toString() + "".join(sorted(i.inputFiles())) for i in inputs)
    at = f"{path}/{hashlib.sha256(plans.encode()).hexdigest()[:16]}"
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{at}/_SUCCESS")
    if overwrite or not jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jvm_path):
        compute(*inputs).write.mode("overwrite").parquet(at)
    return spark.read.parquet(at)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_sample(df: DataFrame, path: str, order: str, n: int = 100) -> None:
    write_tsv(df.orderBy(order).limit(n), path)


def write_tsv(df: DataFrame, path: str, one_file: bool = False) -> None:
    """A folder of tab-separated files with headers; blanks are written as nothing. ``one_file`` suits outputs that must be a single file."""
    (df.coalesce(1) if one_file else df).write.mode("overwrite").options(sep="\t", header=True, emptyValue="", nullValue="", quote="\u0000", escapeQuotes=False).csv(path)


def submission(matches: DataFrame, ids: str = "matched_entity_ids", order: str | None = "pos") -> DataFrame:
    """``source1_entity_id`` and comma-joined ids, in the order of the input records."""
    joined = matches.withColumn(ids, F.array_join(ids, ","))
    ordered = joined.orderBy(order) if order and order in joined.columns else joined
    return ordered.select(F.col("s1_id").alias("source1_entity_id"), ids)


def write_submission(matches: DataFrame, path: str, ids: str = "matched_entity_ids", one_file: bool = True) -> None:
    write_tsv(submission(matches, ids), path, one_file)


def reformatted(df: DataFrame, ids: str = "matched_entity_ids") -> DataFrame:
    """An id list split, stripped of blanks and joined again with plain commas."""
    each = F.filter(F.transform(F.split(F.coalesce(ids, F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")
    return df.withColumn(ids, F.array_join(each, ","))


def write_metrics(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").json(path)


def metrics_json(df: DataFrame) -> str:
    """A small table of metrics as one JSON text."""
    return json.dumps([r.asDict(recursive=True) for r in df.collect()], indent=2, default=str)


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df
