"""Profiles of tables, ground truth, candidates and matches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import similarity as S
from ..functions import text as T


def columns(df: DataFrame, approximate: bool = False) -> DataFrame:
    """``column, dtype, n_rows, n_null, null_percent, n_distinct`` in one pass; distinct counts may be approximate."""
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    each = [F.struct(F.lit(c).alias("column"), F.lit(t).alias("dtype"), F.count("*").alias("n_rows"), F.count_if(F.col(c).isNull()).alias("n_null"), distinct(c).alias("n_distinct")) for c, t in df.dtypes]
    out = df.agg(F.array(*each).alias("all")).select(F.explode("all").alias("x")).select("x.*")
    return out.withColumn("null_percent", F.round(F.when(F.col("n_rows") > 0, 100 * F.col("n_null") / F.col("n_rows")).otherwise(0.0), 4))


def duplicates(df: DataFrame, key: str) -> DataFrame:
    """Rows beyond the first of equal ones, and of those with an equal key."""
    rows = df.groupBy(*df.columns).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"))
    keys = df.groupBy(key).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_keys"))
    return rows.crossJoin(F.broadcast(keys))  # one row each


def id_prefixes(df: DataFrame, key: str = "entity_id") -> DataFrame:
    return df.groupBy(F.split(key, "-")[0].alias("prefix")).agg(F.count("*").alias("n"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Counts of values, null included, with their share in percent."""
    n = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    total = df.agg(F.count("*").alias("__total"))
    return n.crossJoin(F.broadcast(total)).select("value", "n", F.round(100 * F.col("n") / F.col("__total"), 4).alias("percent"))  # one row


def sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """The n rows whose keys have the smallest seeded hash: the same on every run and partitioning."""
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(n)


def text_lengths(df: DataFrame, names: list[str]) -> DataFrame:
    """Length statistics of columns: minimum, maximum, mean, median and sample deviation."""
    each = []
    for c in names:
        n = F.char_length(c)
        each.append(F.struct(F.lit(c).alias("column"), F.min(n).alias("min"), F.max(n).alias("max"), F.round(F.avg(n), 6).alias("mean"), F.percentile(n, F.lit(0.5)).alias("median"), F.round(F.stddev_samp(n), 6).alias("std")))
    return df.agg(F.array(*each).alias("all")).select(F.explode("all").alias("x")).select("x.*")


def coverage(s1: DataFrame, truth_ids: DataFrame) -> DataFrame:
    """How many s1 ids the ground truth has, lacks, and has in excess."""
    left = s1.select(F.col("entity_id").alias("id")).distinct().withColumn("in_s1", F.lit(1))
    right = truth_ids.select(F.col("s1_id").alias("id")).distinct().withColumn("in_truth", F.lit(1))
    both = left.join(right, "id", "full")
    return both.agg(F.count_if(F.col("in_s1").isNotNull() & F.col("in_truth").isNotNull()).alias("both"), F.count_if(F.col("in_truth").isNull()).alias("only_s1"), F.count_if(F.col("in_s1").isNull()).alias("only_truth"))


def per_entity(s1: DataFrame, pairs: DataFrame, out: str = "n") -> DataFrame:
    """Number of distinct partners of every s1 row, 0 included."""
    n = pairs.groupBy("s1_id").agg(F.count_distinct("noisy_id").alias(out))
    return s1.select(F.col("entity_id").alias("s1_id")).join(n, "s1_id", "left").na.fill(0, [out])


def cardinality(counted: DataFrame, n: str = "n") -> DataFrame:
    return counted.groupBy(F.col(n).alias("cardinality")).agg(F.count("*").alias("n_entities"))


def match_kinds(counted: DataFrame, n: str = "n") -> DataFrame:
    """Records with none, one and more matches, and all matches."""
    return counted.agg(F.count("*").alias("n_entities"), F.count_if(F.col(n) == 0).alias("none"), F.count_if(F.col(n) == 1).alias("one"), F.count_if(F.col(n) > 1).alias("many"), F.sum(n).alias("n_matches"))


PERCENTILES = [("p25", 0.25), ("p50", 0.5), ("p75", 0.75), ("p90", 0.9), ("p95", 0.95), ("p99", 0.99), ("p999", 0.999)]


def distribution(counted: DataFrame, n: str = "n") -> DataFrame:
    """Minimum, maximum, mean, population deviation and exact percentiles (interpolated)."""
    return counted.agg(F.count("*").alias("n_entities"), F.min(n).alias("min"), F.max(n).alias("max"), F.round(F.avg(n), 6).alias("mean"), F.round(F.stddev_pop(n), 6).alias("std"), *[F.round(F.percentile(n, F.lit(q)), 6).alias(k) for k, q in PERCENTILES])


def source_links(truth: DataFrame) -> DataFrame:
    """Links to each source, and records with links to each and to both."""
    per = truth.groupBy("s1_id").agg(F.count_if(F.col("source") == "S2").alias("s2"), F.count_if(F.col("source") == "S3").alias("s3"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    return per.agg(
        zero(F.sum("s2")).alias("s2_links"), zero(F.sum("s3")).alias("s3_links"), F.count_if(F.col("s2") > 0).alias("has_s2"), F.count_if(F.col("s3") > 0).alias("has_s3"),
        F.count_if((F.col("s2") > 0) & (F.col("s3") > 0)).alias("has_both"), F.count_if((F.col("s2") > 0) & (F.col("s3") == 0)).alias("only_s2"), F.count_if((F.col("s2") == 0) & (F.col("s3") > 0)).alias("only_s3"),
    )


def dangling(truth: DataFrame, pool: DataFrame) -> DataFrame:
    """Links to ids that no noisy record has."""
    return truth.join(pool.select(F.col("entity_id").alias("noisy_id")), "noisy_id", "left_anti")


def prefix_anomalies(truth: DataFrame) -> DataFrame:
    """Links whose id has another prefix than its source."""
    return truth.where(~F.col("noisy_id").startswith("S2-") & ~F.col("noisy_id").startswith("S3-"))


def multi_parent(truth: DataFrame) -> DataFrame:
    """Noisy ids that more than one record claims."""
    return truth.groupBy("noisy_id").agg(F.count_distinct("s1_id").alias("n_parents")).where("n_parents > 1")


def repeated_in_row(raw: DataFrame, ids: str = "matched_entity_ids") -> DataFrame:
    """Rows whose id list repeats an id."""
    each = F.filter(F.transform(F.split(F.coalesce(ids, F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")
    return raw.where(F.size(each) != F.size(F.array_distinct(each)))


def source_coverage(truth: DataFrame, pool: DataFrame) -> DataFrame:
    """Per source: records, those that are someone's match, and their share."""
    matched = truth.select(F.col("noisy_id").alias("entity_id")).distinct().withColumn("m", F.lit(1))
    joined = pool.join(matched, "entity_id", "left")
    return joined.groupBy("source").agg(F.count("*").alias("n_records"), F.count("m").alias("n_matched"), F.round(100 * F.count("m") / F.count("*"), 4).alias("percent"))


def homonyms(s1: DataFrame) -> DataFrame:
    """Names that more than one record has."""
    return s1.where("business_name IS NOT NULL").groupBy("business_name").agg(F.count("*").alias("n")).where("n > 1")


BINS = [(10, "0-10"), (25, "11-25"), (50, "26-50"), (100, "51-100"), (200, "101-200"), (300, "201-300"), (500, "301-500")]


def size_bin(n: Column) -> Column:
    out = F.when(n <= BINS[0][0], BINS[0][1])
    for most, name in BINS[1:]:
        out = out.when(n <= most, name)
    return out.otherwise("500+")


def candidate_sizes(counted: DataFrame, n_pool: int, n: str = "n") -> DataFrame:
    """Sizes of candidate sets, and the share of all pairs that blocking avoids."""
    stats = distribution(counted, n).join(F.broadcast(counted.agg(F.sum(n).alias("n_pairs"))))  # one row each
    return stats.withColumn("reduction_ratio", F.round(1 - F.col("n_pairs") / (F.col("n_entities") * F.lit(n_pool)), 9))


def candidate_bins(counted: DataFrame, n: str = "n") -> DataFrame:
    return counted.groupBy(size_bin(F.col(n)).alias("bin")).agg(F.count("*").alias("n_entities"))


def largest(counted: DataFrame, keyed: DataFrame, most: int = 20, n: str = "n") -> DataFrame:
    """The records with the most candidates, with their blocking keys."""
    top = counted.orderBy(F.col(n).desc(), "s1_id").limit(most)
    return top.join(keyed.select(F.col("entity_id").alias("s1_id"), "keys"), "s1_id")


def recall(truth: DataFrame, pairs: DataFrame, s1: DataFrame) -> DataFrame:
    """Pair recall overall, by country and by source, in one pass of grouping sets: ``country, source, n_true, captured, recall``."""
    hit = truth.join(pairs.select("s1_id", "noisy_id").distinct().withColumn("hit", F.lit(1)), ["s1_id", "noisy_id"], "left")
    placed = hit.join(s1.select(F.col("entity_id").alias("s1_id"), "country"), "s1_id")
    grouped = placed.groupingSets([[], ["country"], ["source"]], "country", "source").agg(F.grouping("country").alias("gc"), F.grouping("source").alias("gs"), F.count("*").alias("n_true"), F.count("hit").alias("captured"))
    named = lambda c, g: F.when(F.col(g) == 1, "all").otherwise(F.col(c)).alias(c)
    return grouped.select(named("country", "gc"), named("source", "gs"), "n_true", "captured", F.round(F.when(F.col("n_true") > 0, F.col("captured") / F.col("n_true")).otherwise(0.0), 6).alias("recall"))


def retention(truth: DataFrame, pairs: DataFrame) -> DataFrame:
    """Records of whose matches blocking found all, some and none."""
    hit = truth.join(pairs.select("s1_id", "noisy_id").distinct().withColumn("hit", F.lit(1)), ["s1_id", "noisy_id"], "left")
    per = hit.groupBy("s1_id").agg(F.count("*").alias("n"), F.count("hit").alias("h"))
    return per.agg(F.count("*").alias("n_entities"), F.count_if(F.col("h") == F.col("n")).alias("full"), F.count_if((F.col("h") > 0) & (F.col("h") < F.col("n"))).alias("partial"), F.count_if(F.col("h") == 0).alias("lost"))


def pass_contribution(truth: DataFrame, query_keys: DataFrame, pool_keys: DataFrame, key_type) -> DataFrame:
    """Per key type: true pairs that share a key of it, and shared keys. Keys are those of the truth's records only."""
    q = query_keys.select(F.col("entity_id").alias("s1_id"), "block_key").distinct()
    p = pool_keys.select(F.col("entity_id").alias("noisy_id"), "block_key").distinct()
    shared = truth.join(q, "s1_id").join(p, ["noisy_id", "block_key"])
    return shared.groupBy(key_type(F.col("block_key")).alias("key_type")).agg(F.count_distinct("s1_id", "noisy_id").alias("n_pairs"), F.count("*").alias("n_keys"))


def forensics(pairs: DataFrame) -> DataFrame:
    """Noise of true pairs, one row per pair: boolean columns on names and addresses. Input: ``s1_name, s1_address, noisy_name, noisy_address`` (clean, not null)."""
    n1, n2, a1, a2 = (F.col(c) for c in ("s1_name", "noisy_name", "s1_address", "noisy_address"))
    p1, p2, q1, q2 = (T.forensic_punctuation(c) for c in (n1, n2, a1, a2))
    bare = lambda c: F.replace(c, F.lit(" "), F.lit(""))
    in_order = lambda c: F.array_sort(T.tokens(c))
    exact, same = (n1 == n2) & (n1 != ""), p1 == p2
    ratio = 100 * S.similarity("ratio", F.lower(n1), F.lower(n2))
    addr_ratio = F.when((a1 != "") & (a2 != ""), 100 * S.similarity("ratio", F.lower(a1), F.lower(a2))).otherwise(0.0)
    latin = "Latin/English"
    missing = (a2 == "") | F.lower(a2).isin("nan", "null")
    a_exact = ~missing & (a1 == a2)
    other = ~missing & ~a_exact
    z1, z2 = T.zip_tokens(a1), T.zip_tokens(a2)
    zips = (F.size(z1) > 0) & (F.size(z2) > 0)
    out = pairs.withColumns({"name_ratio": ratio, "addr_ratio": addr_ratio})
    r, ar = F.col("name_ratio"), F.col("addr_ratio")
    return out.withColumns(
        {
            "name_exact": exact, "name_case": ~exact & (F.lower(n1) == F.lower(n2)), "name_whitespace": ~exact & same & (bare(n1) == bare(n2)), "name_punctuation": ~exact & same & (bare(n1) != bare(n2)),
            "name_reordered": ~exact & ~same & (in_order(p1) == in_order(p2)) & (F.size(T.tokens(p1)) > 1), "name_legal": ~exact & ~same & (T.forensic_legal(p1) == T.forensic_legal(p2)) & (T.forensic_legal(p1) != ""),
            "name_domain": T.has_domain(n2) & ~T.has_domain(n1), "name_script": (T.script(n1) != latin) | (T.script(n2) != latin), "name_typo_slight": (r >= 80) & (r < 100), "name_typo_moderate": (r >= 50) & (r < 80), "name_low": r < 50,
            "addr_missing": missing, "addr_exact": a_exact, "addr_whitespace": other & (q1 == q2) & (bare(a1) == bare(a2)), "addr_punctuation": other & (q1 == q2) & (bare(a1) != bare(a2)),
            "addr_reordered": other & (q1 != q2) & (in_order(q1) == in_order(q2)) & (F.size(T.tokens(q1)) > 2), "addr_abbreviation": other & T.address_variant(q1, q2), "addr_state": other & T.state_variant(q1, q2),
            "addr_zip_exact": other & zips & S.overlap(z1, z2), "addr_zip_differs": other & zips & ~S.overlap(z1, z2), "addr_zip_missing": other & ~zips, "addr_script": other & ((T.script(a1) != latin) | (T.script(a2) != latin)),
            "addr_informative": (r < 40) & (ar >= 75), "name_informative": (r >= 85) & (ar < 40),
        }
    )


FORENSIC_FLAGS = (
    "name_exact name_case name_whitespace name_punctuation name_reordered name_legal name_domain name_script name_typo_slight name_typo_moderate name_low addr_missing addr_exact addr_whitespace "
    "addr_punctuation addr_reordered addr_abbreviation addr_state addr_zip_exact addr_zip_differs addr_zip_missing addr_script addr_informative name_informative"
).split()


def forensic_counts(marked: DataFrame) -> DataFrame:
    """``kind, n, percent`` of each flag over all pairs."""
    sums = marked.agg(F.count("*").alias("__n"), *[F.count_if(F.col(k)).alias(k) for k in FORENSIC_FLAGS])
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("n")) for k in FORENSIC_FLAGS])).alias("x")
    return sums.select("__n", each).select("x.kind", "x.n", F.round(F.when(F.col("__n") > 0, 100 * F.col("x.n") / F.col("__n")).otherwise(0.0), 4).alias("percent"))


def script_pairs(pairs: DataFrame, left: str = "s1_name", right: str = "noisy_name") -> DataFrame:
    """Counts of script combinations that are not both Latin."""
    a, b = T.script(left), T.script(right)
    return pairs.where((a != "Latin/English") | (b != "Latin/English")).groupBy(F.concat(a, F.lit(" -> "), b).alias("scripts")).agg(F.count("*").alias("n"))
