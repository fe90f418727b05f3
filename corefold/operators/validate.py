"""Checks of submission files against the entity tables: one row per rule with the number of offences and examples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MATCH_HEADER = ["source1_entity_id", "matched_entity_ids"]
CANDIDATE_HEADER = ["source1_entity_id", "candidate_entity_ids"]


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def header_problem(first_line: str | None, expected: list[str] = MATCH_HEADER) -> str | None:
    """What is wrong with a header line, if anything."""
    if first_line is None:
        return "the file is empty"
    if first_line.rstrip("\r") == "\t".join(expected):
        return None
    if "\t" not in first_line and "," in first_line:
        return "the header is separated by commas; tabs are expected"
    return f"the header is {first_line!r}"


def parsed(lines: DataFrame, header: list[str] = MATCH_HEADER) -> DataFrame:
    """``s1_id, ids, n_fields`` of the lines after the header. Ids are as written, not stripped."""
    body = lines.where(F.col("value") != "\t".join(header)).where(F.col("value") != "")
    parts = F.split(F.regexp_replace("value", "\r$", ""), "\t", -1)
    listed = F.when(F.coalesce(F.get(parts, 1), F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split(F.get(parts, 1), ","))
    return body.select(F.get(parts, 0).alias("s1_id"), listed.alias("ids"), F.size(parts).alias("n_fields"))


def _rule(name: str, severity: str, rows: DataFrame, what: Column) -> DataFrame:
    """Number of offences and the first five examples in order."""
    found = rows.select(what.alias("x"))
    first = found.distinct().orderBy("x").limit(5).agg(F.array_sort(F.collect_list("x")).alias("examples"))
    return found.agg(F.count("*").alias("n")).crossJoin(F.broadcast(first)).select(F.lit(name).alias("rule"), F.lit(severity).alias("severity"), "n", F.array_join("examples", " | ").alias("examples"))


def report(matches: DataFrame, s1: DataFrame, pool: DataFrame | None = None, candidates: DataFrame | None = None, strict_subset: bool = False) -> DataFrame:
    """``rule, severity, n, examples`` for parsed matches (and candidates). A rule holds if n is 0; warnings don't fail.

    Existence of ids is checked where ``pool`` is given, the subset rule where candidates are; that one fails only if ``strict_subset``.
    """
    ids = s1.select(F.col("entity_id").alias("s1_id")).distinct()
    each = matches.select("s1_id", F.explode("ids").alias("id"))
    bad_prefix = ~F.col("id").rlike("^S[23]-")
    rules = [
        _rule("two fields per line", "error", matches.where("n_fields <> 2"), F.col("s1_id")),
        _rule("each record once", "error", matches.groupBy("s1_id").count().where("count > 1"), F.col("s1_id")),
        _rule("no record is missing", "error", ids.join(matches, "s1_id", "left_anti"), F.col("s1_id")),
        _rule("no unknown record", "error", matches.join(ids, "s1_id", "left_anti"), F.col("s1_id")),
        _rule("no id twice in a row", "error", matches.where(F.size("ids") != F.size(F.array_distinct("ids"))), F.col("s1_id")),
        _rule("no S1 id as a match", "error", each.where(F.col("id").startswith("S1-")), F.col("id")),
        _rule("ids start with S2- or S3-", "error", each.where(bad_prefix), F.col("id")),
    ]
    if pool is not None:
        known = pool.select(F.col("entity_id").alias("id")).distinct()
        rules.append(_rule("every id exists", "error", each.join(known, "id", "left_anti"), F.col("id")))
    if candidates is not None:
        rules.append(_rule("no candidate twice in a row", "error", candidates.where(F.size("ids") != F.size(F.array_distinct("ids"))), F.col("s1_id")))
        inside = candidates.select("s1_id", F.explode("ids").alias("id")).distinct()
        rules.append(_rule("matches are candidates", "error" if strict_subset else "warning", each.join(inside, ["s1_id", "id"], "left_anti"), F.concat_ws(":", "s1_id", "id")))
    out = rules[0]
    for r in rules[1:]:
        out = out.unionByName(r)
    return out


def empties(matches: DataFrame) -> DataFrame:
    """Some rows, but not all, should be empty: ``n_rows, n_empty, ok``."""
    sums = matches.agg(F.count("*").alias("n_rows"), F.count_if(F.size("ids") == 0).alias("n_empty"))
    return sums.withColumn("ok", (F.col("n_empty") > 0) & (F.col("n_empty") < F.col("n_rows")))


def coverage(matches: DataFrame) -> DataFrame:
    """Rows with none, one and more matches, and all matches."""
    n = F.size("ids")
    return matches.agg(F.count("*").alias("n_rows"), F.count_if(n == 0).alias("none"), F.count_if(n == 1).alias("one"), F.count_if(n > 1).alias("many"), F.coalesce(F.sum(n), F.lit(0)).alias("n_matches"))


def passed(found: DataFrame) -> bool:
    return found.where("severity = 'error' AND n > 0").isEmpty()


def same_order(left: DataFrame, right: DataFrame) -> DataFrame:
    """Positions (``pos``) at which two outputs name different records, or only one names any."""
    a, b = left.select("pos", F.col("s1_id").alias("left_id")), right.select("pos", F.col("s1_id").alias("right_id"))
    return a.join(b, "pos", "full").where(~F.col("left_id").eqNullSafe(F.col("right_id")))
