"""Queries over the driver's tables, one for each operator or family, and SQL for those that DuckDB can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import blocking as B
from ..operators import keys as K
from ..operators import ranking as R
from . import oracle as O
from .entities import table

CAP = 150
KS = [5, 10, 15, 20, 22, 30, 40, 50, 75, 100]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL if there is any."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def postings(spark: SparkSession, sf_dir: str, source: str, variant: str = "serve") -> DataFrame:
    return K.postings(K.with_keys(table(spark, sf_dir, source), variant))


def meetings(spark: SparkSession, sf_dir: str, cap: int = CAP, variant: str = "serve") -> DataFrame:
    pool = postings(spark, sf_dir, "pool", variant)
    return B.hits(postings(spark, sf_dir, "s1", variant), pool, B.active_keys(pool, cap, "train" if variant == "train" else "serve"))


# Keys and candidates

for _variant in ("serve", "train", "v4"):

    def _keys(spark, sf_dir, variant=_variant):
        return postings(spark, sf_dir, "pool", variant).groupBy("entity_id", "block_key").agg(F.count("*").alias("n"))

    QUERIES[f"blocking_keys_{_variant}"] = _keys
    ORACLE_SQL[f"blocking_keys_{_variant}"] = O.sql("SELECT entity_id, block_key, count(*) AS n FROM pk GROUP BY ALL", O.keyed("pool", "pk", _variant))


@query(O.sql("SELECT regexp_extract(block_key, '\\|([a-z0-9]+):', 1) AS key_type, count(*) AS n_keys, CAST(sum(bucket_len) AS BIGINT) AS n_postings, max(bucket_len) AS longest FROM active GROUP BY 1", O.met(CAP)))
def hot_key_pruning(spark, sf_dir):
    active = B.active_keys(postings(spark, sf_dir, "pool"), CAP)
    return active.groupBy(K.key_type(F.col("block_key")).alias("key_type")).agg(F.count("*").alias("n_keys"), F.sum("bucket_len").alias("n_postings"), F.max("bucket_len").alias("longest"))


_IDS = "SELECT s1.entity_id AS s1_id, coalesce(count(c.noisy_id), 0) AS n_candidates, coalesce(string_agg(c.noisy_id, ',' ORDER BY c.noisy_id), '') AS candidate_ids FROM s1 LEFT JOIN {} c ON c.s1_id = s1.entity_id GROUP BY s1.entity_id"


def _listed(spark, sf_dir, pairs):
    done = B.completed(table(spark, sf_dir, "s1"), pairs)
    return done.select("s1_id", F.size("candidate_ids").cast("long").alias("n_candidates"), F.array_join("candidate_ids", ",").alias("candidate_ids"))


@query(O.sql(_IDS.format("cand"), O.met(CAP), "cand AS (SELECT DISTINCT s1_id, noisy_id FROM met)"))
def candidates(spark, sf_dir):
    return _listed(spark, sf_dir, B.candidates(meetings(spark, sf_dir)))


@query(O.sql(_IDS.format("cand"), O.met(300), "cand AS (SELECT DISTINCT s1_id, noisy_id FROM met)"))
def candidates_cap_300(spark, sf_dir):
    return _listed(spark, sf_dir, B.candidates(meetings(spark, sf_dir, 300)))


@query(O.sql(_IDS.format("cand"), O.met(200, "train"), "cand AS (SELECT DISTINCT s1_id, noisy_id FROM met)"))
def candidates_train(spark, sf_dir):
    return _listed(spark, sf_dir, B.candidates(meetings(spark, sf_dir, 200, "train")))


_FIRST = "first AS (SELECT s1_id, noisy_id, min((s1_key_pos, noisy_pos, noisy_key_pos)) AS f FROM {} GROUP BY s1_id, noisy_id)"
_LEGACY = (
    "sliced AS (SELECT * FROM met QUALIFY row_number() OVER (PARTITION BY s1_id, s1_key_pos ORDER BY noisy_pos, noisy_key_pos) <= 8)",
    _FIRST.format("sliced"),
    "read AS (SELECT s1_id, k, coalesce(sum(n) OVER (PARTITION BY s1_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM (SELECT s1_id, f[1] AS k, count(*) AS n FROM first GROUP BY 1, 2))",
    "cand AS (SELECT first.s1_id, noisy_id FROM first JOIN read ON first.s1_id = read.s1_id AND f[1] = k WHERE before < 15)",
)


@query(O.sql(_IDS.format("cand"), O.met(CAP), *_LEGACY))
def candidates_legacy_cap(spark, sf_dir):
    return _listed(spark, sf_dir, B.legacy_candidates(meetings(spark, sf_dir)))


_EARLY = (
    f"buckets AS (SELECT s1_id, block_key, row_number() OVER (PARTITION BY s1_id ORDER BY {O.weight('block_key')} DESC, bucket_len, block_key) AS k FROM (SELECT DISTINCT s1_id, block_key, bucket_len FROM met))",
    "first AS (SELECT s1_id, noisy_id, min(k) AS k FROM met JOIN buckets USING (s1_id, block_key) GROUP BY ALL)",
    "read AS (SELECT s1_id, k, coalesce(sum(n) OVER (PARTITION BY s1_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM (SELECT s1_id, k, count(*) AS n FROM first GROUP BY ALL))",
    "cand AS (SELECT s1_id, noisy_id FROM first JOIN read USING (s1_id, k) WHERE before < 60)",
)


@query(O.sql(_IDS.format("cand"), O.met(200, "train"), *_EARLY))
def candidates_early_stop(spark, sf_dir):
    return _listed(spark, sf_dir, B.early_stop_candidates(meetings(spark, sf_dir, 200, "train"), 60))


_RANKED = _FIRST.format("met") + ", ranked AS (SELECT s1_id, noisy_id, row_number() OVER (PARTITION BY s1_id ORDER BY f, noisy_id) AS rank FROM first)"


@query(
    O.sql(
        f"SELECT CAST(k AS INT) AS k, count(t.s1_id) AS captured, count(*) AS pairs FROM ranked JOIN (SELECT unnest([{', '.join(map(str, KS))}]) AS k) ON rank <= k LEFT JOIN truth t ON t.s1_id = ranked.s1_id AND t.noisy_id = ranked.noisy_id GROUP BY k",
        O.met(CAP), _RANKED,
    )
)
def k_sensitivity(spark, sf_dir):
    return B.k_sensitivity(meetings(spark, sf_dir), table(spark, sf_dir, "truth"), KS)


@query(O.sql("SELECT s1_id, noisy_id FROM ranked WHERE rank <= 10", O.met(CAP), _RANKED))
def first_10_candidates(spark, sf_dir):
    return B.first_k(meetings(spark, sf_dir), 10)


# Ranking

_SCORED = f"scored AS (SELECT s1_id, noisy_id, round(sum({O.weight('block_key')} / log2(2 + bucket_len)), 9) AS score, min((s1_key_pos, noisy_pos, noisy_key_pos)) AS f, count(*) AS n_meetings FROM met GROUP BY s1_id, noisy_id)"
_RANKS = _SCORED + ", ranks AS (SELECT s1_id, noisy_id, score, n_meetings, row_number() OVER (PARTITION BY s1_id ORDER BY score DESC, f, noisy_id) AS rank FROM scored)"


def ranks(spark, sf_dir, cap: int = CAP):
    return R.ranked(R.evidence(meetings(spark, sf_dir, cap)))


@query(O.sql("SELECT s1_id, noisy_id, round(score, 6) AS score, n_meetings, CAST(rank AS INT) AS rank FROM ranks WHERE rank <= 25", O.met(CAP), _RANKS))
def top_25_by_evidence(spark, sf_dir):
    return R.ranked(R.evidence(meetings(spark, sf_dir)), 25).select("s1_id", "noisy_id", F.round("score", 6).alias("score"), "n_meetings", "rank")


_MARKED = "marked AS (SELECT t.*, rank FROM truth t LEFT JOIN ranks r ON r.s1_id = t.s1_id AND r.noisy_id = t.noisy_id)"


@query(O.sql("SELECT CAST(k AS INT) AS k, count_if(rank <= k) AS captured, count(*) AS total, round(count_if(rank <= k)::DOUBLE / count(*), 6) AS recall FROM marked, (SELECT unnest([10, 25, 50, 75, 100]) AS k) GROUP BY k", O.met(CAP), _RANKS, _MARKED))
def recall_at_k(spark, sf_dir):
    return R.recall_at(ranks(spark, sf_dir), table(spark, sf_dir, "truth"), [10, 25, 50, 75, 100])


@query(O.sql("SELECT CASE WHEN rank IS NULL THEN 'lost' WHEN rank <= 10 THEN '1-10' WHEN rank <= 25 THEN '11-25' WHEN rank <= 50 THEN '26-50' WHEN rank <= 75 THEN '51-75' WHEN rank <= 100 THEN '76-100' ELSE '100+' END AS band, count(*) AS n FROM marked GROUP BY 1", O.met(CAP), _RANKS, _MARKED))
def rank_distribution(spark, sf_dir):
    return R.rank_distribution(ranks(spark, sf_dir), table(spark, sf_dir, "truth"))


@query(O.sql("SELECT count(*) AS captured, " + ", ".join(f"quantile_cont(rank, {q})::DOUBLE AS {n}" for n, q in (("p50", 0.5), ("p75", 0.75), ("p90", 0.9), ("p95", 0.95), ("p99", 0.99))) + ", max(rank)::DOUBLE AS max_rank FROM marked WHERE rank IS NOT NULL", O.met(CAP), _RANKS, _MARKED))
def rank_percentiles(spark, sf_dir):
    return R.rank_percentiles(ranks(spark, sf_dir), table(spark, sf_dir, "truth"))


# Normalisation

from ..functions import text as T  # noqa: E402
from ..operators import decision as D  # noqa: E402
from ..operators import features as FE  # noqa: E402
from ..operators import metrics as M  # noqa: E402
from ..operators import pairs as P  # noqa: E402
from ..operators import profile as PR  # noqa: E402
from ..operators import taxonomy as TX  # noqa: E402

_CLEAN = r"CASE WHEN lower(trim(coalesce({0}, ''))) IN ('nan', 'null', 'none', '<missing>', 'n/a') THEN '' ELSE trim(coalesce({0}, '')) END"
_NFC = "lower(nfc_normalize({}))"
_PUNCT = r"trim(regexp_replace(regexp_replace(replace({}, '&', ' and '), '[\p{{P}}\p{{S}}]', ' ', 'g'), '\s+', ' ', 'g'))"
_NORMAL = f"""
input AS (SELECT page_id AS id, url AS name, 'x' AS addr, '' AS country FROM pages
  UNION ALL SELECT doc_id AS id, substring(text, 1, 200) AS name, substring(text, 50, 120) AS addr, source AS country FROM documents),
norm AS (SELECT id, {_NFC.format(_CLEAN.format('name'))} AS n, {_NFC.format(_CLEAN.format('addr'))} AS a, {_CLEAN.format('country')} AS c FROM input),
cleaned AS (SELECT id, {_PUNCT.format('n')} AS clean, {_PUNCT.format(O.domain('n'))} AS domain_clean, {_PUNCT.format('a')} AS addr_clean, upper(c) AS country FROM norm)"""


def _normal_input(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select(F.col("page_id").alias("id"), F.col("url").alias("name"), F.lit("x").alias("addr"), F.lit("").alias("country"))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").alias("id"), F.substring("text", 1, 200).alias("name"), F.substring("text", 50, 120).alias("addr"), F.col("source").alias("country"))
    return pages.unionAll(docs)


_TOKS = O.toks("clean")
_ATOKS = O.toks("addr_clean")


@query(
    f"WITH {_NORMAL.strip()} SELECT id, clean, regexp_replace(lower(clean), '[\\p{{P}}\\p{{S}}\\p{{Z}}]', '', 'g') AS alphanumeric, array_to_string(list_sort({_TOKS}), ' ') AS sorted_tokens, "
    f"array_to_string({O.no_legal(_TOKS)}, ' ') AS no_legal, domain_clean, addr_clean, array_to_string(list_sort({O.standard(_ATOKS)}), ' ') AS standardized_sorted, country FROM cleaned"
)
def normalized_text(spark, sf_dir):
    records = T.normalize_records(_normal_input(spark, sf_dir).toDF("entity_id", "business_name", "business_address", "country"))
    out = records.select(F.col("entity_id").cast("long").alias("id"), F.col("name").alias("n"), F.col("address").alias("a"), "country")
    return out.select("id", "n.clean", "n.alphanumeric", "n.sorted_tokens", "n.no_legal", "n.domain_clean", F.col("a.clean").alias("addr_clean"), "a.standardized_sorted", "country")


@query(O.sql("SELECT source, country, count(*) AS n FROM (SELECT source, " + f"upper({_CLEAN.format('country')})" + " AS country FROM pool) GROUP BY ALL"))
def countries(spark, sf_dir):
    return table(spark, sf_dir, "pool").groupBy("source", T.country("country").alias("country")).agg(F.count("*").alias("n"))


# Features: those of the JVM; the kernels have golden tests

def _feature_sql(variant: str) -> str:
    train = variant == "train"
    read = _CLEAN if train else "coalesce({}, '')"
    flag = lambda c: f"CASE WHEN {c} THEN 1.0 ELSE 0.0 END::DOUBLE"
    rec = lambda src, out: f"""
{out}_r AS (SELECT entity_id, {read.format('business_name')} AS n, {read.format('business_address')} AS a, upper({read.format('country')}) AS c, lower(coalesce(business_name, '')) AS ln, lower(coalesce(business_address, '')) AS la FROM {src}),
{out}_p AS (SELECT *, trim({O.punct('n')}) AS pn, trim({O.punct('a')}) AS pa FROM {out}_r),
{out}_t AS (SELECT *, {O.toks('pn')} AS nt, {O.toks('pa')} AS att, {'ln' if train else 'pn'} AS fn, {'la' if train else 'pa'} AS fa FROM {out}_p),
{out} AS (SELECT *, array_to_string({O.no_legal('nt')}, ' ') AS nl, {O.grams('pn', 3)} AS n3, {O.grams('pn', 4)} AS n4, {O.grams('pa', 3)} AS a3, {O.grams('pa', 4)} AS a4,
  array_to_string(list_sort({O.standard('att')}), ' ') AS std, regexp_extract_all(pa, '\\b\\d+\\b') AS nums, regexp_extract_all(pa, '\\b\\d{{5,6}}\\b') AS zips, regexp_extract_all(fa, '\\b\\d+\\b') AS fnums,
  array_to_string(list_filter(list_transform({O.toks('fn')}, lambda t: substring(t, 1, 1)), lambda x: regexp_matches(x, '[\\p{{L}}\\p{{N}}]')), '') AS acr, regexp_replace(fn, '[^\\p{{L}}\\p{{N}}]', '', 'g') AS compact,
  substring(fn, 1, 4) AS pfx4, {O.toks('fa')} AS fset FROM {out}_t)"""  # noqa: E731
    have_n, have_a = "l.pn <> '' AND r.pn <> ''", "l.pa <> '' AND r.pa <> ''"
    gate = lambda have, v: f"CASE WHEN {have} THEN {v} ELSE 0.0 END::DOUBLE"
    same = lambda k: flag(f"l.{k} <> '' AND r.{k} <> '' AND l.{k} = r.{k}")
    some = lambda k: f"len(l.{k}) > 0 AND len(r.{k}) > 0"
    meet = lambda k: f"list_has_any(l.{k}, r.{k})"
    shared = "len(list_intersect(list_distinct(l.fset), list_distinct(r.fset)))::DOUBLE"
    f = {"name_exact_match": same("n"), "name_clean_exact": same("pn")}
    for k, p, t, g, have in (("name", "pn", "nt", "n", have_n), ("addr", "pa", "att", "a", have_a)):
        f[f"{k}_token_jaccard"] = O.jaccard(f"l.{t}", f"r.{t}")
        for i in (3, 4):
            f[f"{k}_char_{i}gram_jaccard"] = O.jaccard(f"l.{g}{i}", f"r.{g}{i}")
        diff, cdiff = f"abs(length(l.{p}) - length(r.{p}))::DOUBLE", f"abs(len(l.{t}) - len(r.{t}))::DOUBLE"
        f[f"{k}_len_diff"], f[f"{k}_token_count_diff"] = (gate(have, diff), gate(have, cdiff)) if train else (diff, cdiff)
        f[f"{k}_len_ratio"] = gate(have, f"least(length(l.{p}), length(r.{p}))::DOUBLE / greatest(length(l.{p}), length(r.{p}))")
    f["name_no_legal_exact"] = gate(have_n, same("nl")) if train else same("nl")
    f["addr_is_missing"] = flag("l.pa = '' OR r.pa = ''" if train else "l.a = '' OR r.a = ''")
    f["addr_exact_match"], f["addr_clean_exact"] = same("a"), same("pa")
    f["addr_std_sorted_exact"] = gate(have_a, same("std")) if train else same("std")
    if train:
        f["addr_number_match"] = gate(have_a, f"CASE WHEN {some('nums')} THEN {flag('l.nums[1] = r.nums[1]')} ELSE 0.5 END")
        f["addr_zip_match"] = gate(have_a, f"CASE WHEN {some('zips')} THEN {flag(meet('zips'))} ELSE 0.5 END")
    else:
        f["addr_number_match"] = flag(f"{some('nums')} AND {meet('nums')}")
        f["addr_zip_match"] = flag(r"length(l.pa) >= 5 AND length(r.pa) >= 5 AND len(list_filter(l.att, lambda t: regexp_full_match(t, '\d{5,6}') AND contains(r.pa, t))) > 0")
    f["country_exact_match"] = same("c")
    f["country_is_missing"] = flag("l.c = '' OR r.c = ''" + (" OR r.c IN ('NAN', 'NULL', 'NONE')" if train else ""))
    f["addr_num_exact_mismatch"] = flag(f"{some('fnums')} AND NOT {meet('fnums')}")
    f["name_acronym_match"] = flag("(l.acr <> '' AND l.acr = r.compact) OR (r.acr <> '' AND r.acr = l.compact)")
    f["name_pfx4_match"] = flag("l.pfx4 <> '' AND l.pfx4 = r.pfx4")
    f["addr_token_containment"] = f"CASE WHEN len(l.fset) > 0 AND len(r.fset) > 0 THEN greatest({shared} / len(list_distinct(l.fset)), {shared} / len(list_distinct(r.fset))) ELSE 0.0 END"
    listed = ", ".join(f"round({v}, 9) AS {k}" for k, v in f.items())
    return O.sql(f"SELECT c.s1_id, c.noisy_id, {listed} FROM ranked c JOIN l ON l.entity_id = c.s1_id JOIN r ON r.entity_id = c.noisy_id WHERE rank <= 5", O.met(CAP), _RANKED, rec("s1", "l"), rec("pool", "r"))


for _variant in ("serve", "train"):

    def _features(spark, sf_dir, variant=_variant):
        out = FE.features(B.first_k(meetings(spark, sf_dir), 5), table(spark, sf_dir, "s1"), table(spark, sf_dir, "pool"), variant, kernels=False)
        return out.select("s1_id", "noisy_id", *[F.round(n, 9).alias(n) for n in FE.NAMES if n in out.columns])

    QUERIES[f"features_{_variant}"] = _features
    ORACLE_SQL[f"features_{_variant}"] = _feature_sql(_variant)


@query()
def features_44(spark, sf_dir):
    """All 44 features of the serving variant for the five best candidates."""
    return FE.features(R.ranked(R.evidence(meetings(spark, sf_dir)), 5), table(spark, sf_dir, "s1"), table(spark, sf_dir, "pool"))


# Decisions and metrics, on probabilities made of the evidence scores

_PROB = _RANKS + ", scored AS (SELECT s1_id, noisy_id, round(score / (score + 0.6), 6) AS prob FROM ranks WHERE rank <= 25)"
_PROB = _PROB.replace("scored AS (SELECT s1_id, noisy_id, round(sum", "evidence AS (SELECT s1_id, noisy_id, round(sum").replace("FROM scored)", "FROM evidence)")


def scored(spark, sf_dir):
    top = R.ranked(R.evidence(meetings(spark, sf_dir)), 25)
    return top.select("s1_id", "noisy_id", F.round(F.col("score") / (F.col("score") + 0.6), 6).alias("prob"))


@query(
    O.sql(
        "SELECT s1.entity_id AS s1_id, coalesce(string_agg(noisy_id, ', ' ORDER BY prob DESC, noisy_id), '') AS matched_entity_ids FROM s1 LEFT JOIN scored ON s1_id = entity_id AND prob >= 0.7 GROUP BY s1.entity_id",
        O.met(CAP), _PROB,
    )
)
def decisions(spark, sf_dir):
    return D.formatted(D.ordered(table(spark, sf_dir, "s1"), D.chosen(scored(spark, sf_dir), 0.7))).select("s1_id", "matched_entity_ids")


def _conflicted(spark, sf_dir):
    number = lambda c: F.regexp_replace(c, "[^0-9]", "").cast("bigint")
    return scored(spark, sf_dir).withColumn("addr_num_exact_mismatch", (F.pmod(number("noisy_id"), F.lit(7)) == 0).cast("int"))


@query(
    O.sql(
        "SELECT s1_id, noisy_id, prob FROM final",
        O.met(CAP), _PROB,
        r"marked AS (SELECT *, CAST(regexp_replace(noisy_id, '[^0-9]', '', 'g') AS BIGINT) % 7 = 0 AS clash FROM scored)",
        "kept AS (SELECT *, prob >= CASE WHEN clash THEN 0.83 ELSE 0.75 END AS keep FROM marked)",
        "placed AS (SELECT *, row_number() OVER w AS rank, lead(prob, 1, 0.0) OVER w AS after, bool_or(keep) OVER (PARTITION BY s1_id) AS any_kept FROM kept WINDOW w AS (PARTITION BY s1_id ORDER BY prob DESC, noisy_id))",
        "final AS (SELECT * FROM placed WHERE keep OR (NOT any_kept AND rank = 1 AND prob >= 0.7 AND round(prob - after, 9) >= 0.25 AND NOT clash))",
    )
)
def decisions_with_rules(spark, sf_dir):
    return D.chosen_with_rules(_conflicted(spark, sf_dir), 0.75).select("s1_id", "noisy_id", "prob")


_COUNTS = """paired AS (SELECT coalesce(t.s1_id, p.s1_id) AS s1_id, t.noisy_id AS tn, p.noisy_id AS pn FROM truth t FULL JOIN picked p ON t.s1_id = p.s1_id AND t.noisy_id = p.noisy_id),
counted AS (SELECT entity_id AS s1_id, count(tn) AS n_true, count(pn) AS n_pred, count_if(tn IS NOT NULL AND pn IS NOT NULL) AS tp FROM s1 LEFT JOIN paired ON paired.s1_id = entity_id GROUP BY entity_id)"""
_PRF = "CASE WHEN n_true = 0 THEN CASE WHEN n_pred = 0 THEN 1.0 ELSE 0.0 END WHEN n_pred = 0 THEN 0.0 ELSE tp::DOUBLE / {} END"
_SCORES = f"""pr AS (SELECT *, {_PRF.format('n_pred')} AS p, {_PRF.format('n_true')} AS r FROM {{src}}),
measured AS (SELECT *, CASE WHEN n_true = 0 THEN p WHEN tp = 0 THEN 0.0 ELSE 1.25 * p * r / nullif(0.25 * p + r, 0) END AS f05 FROM pr)"""
_PICKED = "picked AS (SELECT s1_id, noisy_id FROM scored WHERE prob >= 0.7)"
_MICRO = """sum(tp)::BIGINT AS tp, (sum(n_pred) - sum(tp))::BIGINT AS fp, (sum(n_true) - sum(tp))::BIGINT AS fn,
  round(CASE WHEN sum(n_pred) > 0 THEN sum(tp)::DOUBLE / sum(n_pred) ELSE 0 END, 6) AS micro_precision, round(CASE WHEN sum(n_true) > 0 THEN sum(tp)::DOUBLE / sum(n_true) ELSE 0 END, 6) AS micro_recall,
  round(CASE WHEN sum(tp) > 0 THEN 1.25 * (sum(tp)::DOUBLE / sum(n_pred)) * (sum(tp)::DOUBLE / sum(n_true)) / (0.25 * sum(tp)::DOUBLE / sum(n_pred) + sum(tp)::DOUBLE / sum(n_true)) ELSE 0 END, 6) AS micro_f05"""
_RATE = "round(CASE WHEN count_if({0}) > 0 THEN count_if({0} AND {1})::DOUBLE / count_if({0}) ELSE 0 END, 6)"
_WRONG = "(tp <> n_true OR tp <> n_pred)"


def _measured(spark, sf_dir):
    s1 = table(spark, sf_dir, "s1")
    return M.scores(M.counts(s1, table(spark, sf_dir, "truth"), D.chosen(scored(spark, sf_dir), 0.7)))


@query(
    O.sql(
        f"SELECT count(*) AS n_entities, round(avg(p), 6) AS macro_precision, round(avg(r), 6) AS macro_recall, round(avg(f05), 6) AS macro_f05, {_MICRO}, {_RATE.format('n_true = 0', 'n_pred > 0')} AS singleton_fp_rate, {_RATE.format('n_true = 1', _WRONG)} AS single_error_rate, {_RATE.format('n_true > 1', _WRONG)} AS multi_error_rate FROM measured",
        O.met(CAP), _PROB, _PICKED, _COUNTS, _SCORES.format(src="counted"),
    )
)
def match_quality(spark, sf_dir):
    return M.summary(_measured(spark, sf_dir))


@query(
    O.sql(
        f"SELECT CASE WHEN n_true = 0 THEN '0' WHEN n_true = 1 THEN '1' ELSE '2+' END AS cohort, count(*) AS n_entities, count_if(NOT {_WRONG}) AS exact, count_if({_WRONG} AND NOT (n_pred = 0 AND n_true > 0)) AS partial, count_if(n_pred = 0 AND n_true > 0) AS empty, round(avg(f05), 6) AS macro_f05 FROM measured GROUP BY 1",
        O.met(CAP), _PROB, _PICKED, _COUNTS, _SCORES.format(src="counted"),
    )
)
def cohort_quality(spark, sf_dir):
    return M.cohorts(_measured(spark, sf_dir))


_GRID = f"grid AS (SELECT unnest([{', '.join(map(str, M.GRID))}]::DOUBLE[]) AS threshold)"


@query(
    O.sql(
        f"SELECT threshold, round(avg(p), 6) AS macro_precision, round(avg(r), 6) AS macro_recall, round(avg(f05), 6) AS macro_f05, {_MICRO} FROM measured GROUP BY threshold",
        O.met(CAP), _PROB, _GRID,
        "n_t AS (SELECT s1_id, count(*) AS n_true FROM truth GROUP BY s1_id)",
        "marked AS (SELECT s.s1_id, prob, t.noisy_id IS NOT NULL AS hit FROM scored s LEFT JOIN truth t ON t.s1_id = s.s1_id AND t.noisy_id = s.noisy_id)",
        "swept AS (SELECT threshold, entity_id, coalesce(any_value(n_true), 0) AS n_true, count(prob) AS n_pred, coalesce(count_if(hit), 0) AS tp FROM s1 CROSS JOIN grid LEFT JOIN n_t ON n_t.s1_id = entity_id LEFT JOIN marked m ON m.s1_id = entity_id AND prob >= threshold GROUP BY threshold, entity_id)",
        _SCORES.format(src="swept"),
    )
)
def threshold_sweep(spark, sf_dir):
    return M.sweep(table(spark, sf_dir, "s1"), table(spark, sf_dir, "truth"), scored(spark, sf_dir))


_LABEL = "labelled AS (SELECT s.*, CASE WHEN t.noisy_id IS NULL THEN 0 ELSE 1 END AS label FROM scored s LEFT JOIN truth t ON t.s1_id = s.s1_id AND t.noisy_id = s.noisy_id)"


def labelled_scores(spark, sf_dir):
    truth = table(spark, sf_dir, "truth").select("s1_id", "noisy_id", F.lit(1).alias("label"))
    return scored(spark, sf_dir).join(truth, ["s1_id", "noisy_id"], "left").na.fill(0, ["label"])


@query(
    O.sql(
        "SELECT threshold, tp, fp, fn, tn, round(CASE WHEN tp > 0 THEN 1.25 * (tp::DOUBLE / (tp + fp)) * (tp::DOUBLE / (tp + fn)) / (0.25 * tp::DOUBLE / (tp + fp) + tp::DOUBLE / (tp + fn)) ELSE 0 END, 6) AS f05, round(CASE WHEN tp > 0 THEN 2.0 * tp / (2 * tp + fp + fn) ELSE 0 END, 6) AS f1 FROM c",
        O.met(CAP), _PROB, _LABEL, _GRID,
        "c AS (SELECT threshold, count_if(label = 1 AND prob >= threshold) AS tp, count_if(label = 0 AND prob >= threshold) AS fp, count_if(label = 1 AND prob < threshold) AS fn, count_if(label = 0 AND prob < threshold) AS tn FROM labelled, grid GROUP BY threshold)",
    )
)
def pair_threshold_sweep(spark, sf_dir):
    return M.pair_sweep(labelled_scores(spark, sf_dir))


# Profiles

@query("SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", '{t}' AS dtype, count(*) AS n_rows, count_if({c} IS NULL) AS n_null, count(DISTINCT {c}) AS n_distinct, round(100.0 * count_if({c} IS NULL) / count(*), 4)::DOUBLE AS null_percent FROM customer" for c, t in (("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "double"), ("c_mktsegment", "string"))) + ")")
def column_profile(spark, sf_dir):
    return PR.columns(spark.read.parquet(f"{sf_dir}/customer.parquet"))


@query(O.sql("SELECT (SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM x)) FROM x) AS duplicate_rows, (SELECT count(*) FROM x) AS n_rows, (SELECT count(*) - count(DISTINCT business_name) FROM x) AS duplicate_keys", "x AS (SELECT business_name, country FROM pool)"))
def duplicate_rows(spark, sf_dir):
    return PR.duplicates(table(spark, sf_dir, "pool").select("business_name", "country"), "business_name")


@query(O.sql("SELECT split_part(entity_id, '-', 1) AS prefix, count(*) AS n FROM pool GROUP BY 1"))
def id_prefixes(spark, sf_dir):
    return PR.id_prefixes(table(spark, sf_dir, "pool"))


@query(O.sql("SELECT country AS value, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM pool), 4)::DOUBLE AS percent FROM pool GROUP BY 1"))
def country_counts(spark, sf_dir):
    return PR.value_counts(table(spark, sf_dir, "pool"), "country")


@query(O.sql("SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", min(length({c})) AS \"min\", max(length({c})) AS \"max\", round(avg(length({c})), 6) AS mean, quantile_cont(length({c}), 0.5)::DOUBLE AS median, round(stddev_samp(length({c})), 6) AS std FROM pool" for c in ("business_name", "business_address")) + ")"))
def text_lengths(spark, sf_dir):
    return PR.text_lengths(table(spark, sf_dir, "pool"), ["business_name", "business_address"])


_PER = "per AS (SELECT entity_id, count(DISTINCT noisy_id) AS n FROM s1 LEFT JOIN truth ON s1_id = entity_id GROUP BY entity_id)"


def _per_truth(spark, sf_dir):
    return PR.per_entity(table(spark, sf_dir, "s1"), table(spark, sf_dir, "truth"))


@query(O.sql("SELECT n AS cardinality, count(*) AS n_entities FROM per GROUP BY n", _PER))
def match_cardinality(spark, sf_dir):
    return PR.cardinality(_per_truth(spark, sf_dir))


@query(O.sql('SELECT count(*) AS n_entities, count_if(n = 0) AS none, count_if(n = 1) AS one, count_if(n > 1) AS "many", sum(n)::BIGINT AS n_matches FROM per', _PER))
def match_kinds(spark, sf_dir):
    return PR.match_kinds(_per_truth(spark, sf_dir))


_DIST = "count(*) AS n_entities, min(n) AS \"min\", max(n) AS \"max\", round(avg(n), 6) AS mean, round(stddev_pop(n), 6) AS std, " + ", ".join(f"round(quantile_cont(n, {q}), 6)::DOUBLE AS {k}" for k, q in PR.PERCENTILES)


@query(O.sql(f"SELECT {_DIST} FROM per", _PER))
def match_distribution(spark, sf_dir):
    return PR.distribution(_per_truth(spark, sf_dir))


_TWO = "two AS (SELECT s1_id, count_if(source = 'S2') AS s2, count_if(source = 'S3') AS s3 FROM truth GROUP BY s1_id)"


@query(O.sql("SELECT sum(s2)::BIGINT AS s2_links, sum(s3)::BIGINT AS s3_links, count_if(s2 > 0) AS has_s2, count_if(s3 > 0) AS has_s3, count_if(s2 > 0 AND s3 > 0) AS has_both, count_if(s2 > 0 AND s3 = 0) AS only_s2, count_if(s2 = 0 AND s3 > 0) AS only_s3 FROM two", _TWO))
def source_links(spark, sf_dir):
    return PR.source_links(table(spark, sf_dir, "truth"))


@query(O.sql("SELECT source, count(*) AS n_records, count(t.noisy_id) AS n_matched, round(100.0 * count(t.noisy_id) / count(*), 4)::DOUBLE AS percent FROM pool LEFT JOIN (SELECT DISTINCT noisy_id FROM truth) t ON noisy_id = entity_id GROUP BY source"))
def source_coverage(spark, sf_dir):
    return PR.source_coverage(table(spark, sf_dir, "truth").drop("source"), table(spark, sf_dir, "pool"))


@query(O.sql("SELECT count_if(t.s1_id IS NOT NULL AND s.entity_id IS NOT NULL) AS \"both\", count_if(t.s1_id IS NULL) AS only_s1, count_if(s.entity_id IS NULL) AS only_truth FROM s1 s FULL JOIN (SELECT DISTINCT s1_id FROM truth) t ON s1_id = entity_id"))
def truth_coverage(spark, sf_dir):
    return PR.coverage(table(spark, sf_dir, "s1"), table(spark, sf_dir, "truth"))


_EXPECTED = "expected AS (SELECT entity_id AS s1_id, replace(entity_id, 'S1-', 'S2-') AS noisy_id FROM s1 UNION ALL SELECT s1_id, noisy_id FROM truth)"


@query(O.sql("SELECT e.noisy_id, e.s1_id FROM expected e WHERE e.noisy_id NOT IN (SELECT entity_id FROM pool)", _EXPECTED))
def dangling_links(spark, sf_dir):
    """Links to records that the pool lacks, of the truth and of a link from every record to its namesake in source 2."""
    expected = table(spark, sf_dir, "s1").select(F.col("entity_id").alias("s1_id"), F.replace("entity_id", F.lit("S1-"), F.lit("S2-")).alias("noisy_id"))
    return PR.dangling(expected.unionByName(table(spark, sf_dir, "truth").select("s1_id", "noisy_id")), table(spark, sf_dir, "pool")).select("noisy_id", "s1_id")


@query(O.sql("SELECT noisy_id, count(DISTINCT s1_id) AS n_parents FROM met GROUP BY noisy_id HAVING count(DISTINCT s1_id) > 1", O.met(CAP)))
def multi_parent_ids(spark, sf_dir):
    """Pool records that more than one record has as a candidate."""
    return PR.multi_parent(meetings(spark, sf_dir).select("s1_id", "noisy_id"))


_NAMES = "named AS (SELECT business_name FROM s1 UNION ALL SELECT business_name FROM pool)"


@query(O.sql("SELECT business_name, count(*) AS n FROM named GROUP BY 1 HAVING count(*) > 1", _NAMES))
def homonyms(spark, sf_dir):
    """Names that several records of all sources have."""
    return PR.homonyms(table(spark, sf_dir, "s1").select("business_name").unionAll(table(spark, sf_dir, "pool").select("business_name")))


_CANDS = "cand AS (SELECT DISTINCT s1_id, noisy_id FROM met), per AS (SELECT entity_id, count(noisy_id) AS n FROM s1 LEFT JOIN cand ON s1_id = entity_id GROUP BY entity_id)"


@query(O.sql(f"SELECT {_DIST}, sum(n)::BIGINT AS n_pairs, round(1 - sum(n)::DOUBLE / (count(*) * (SELECT count(*) FROM pool)::DOUBLE), 9) AS reduction_ratio FROM per", O.met(CAP), _CANDS))
def candidate_sizes(spark, sf_dir):
    pool = table(spark, sf_dir, "pool")
    return PR.candidate_sizes(PR.per_entity(table(spark, sf_dir, "s1"), meetings(spark, sf_dir)), pool.count())


@query(O.sql("SELECT CASE WHEN n <= 10 THEN '0-10' WHEN n <= 25 THEN '11-25' WHEN n <= 50 THEN '26-50' WHEN n <= 100 THEN '51-100' WHEN n <= 200 THEN '101-200' WHEN n <= 300 THEN '201-300' WHEN n <= 500 THEN '301-500' ELSE '500+' END AS bin, count(*) AS n_entities FROM per GROUP BY 1", O.met(CAP), _CANDS))
def candidate_bins(spark, sf_dir):
    return PR.candidate_bins(PR.per_entity(table(spark, sf_dir, "s1"), meetings(spark, sf_dir)))


@query(O.sql("SELECT entity_id AS s1_id, per.n, array_to_string(ks, ';') AS keys FROM per JOIN (SELECT entity_id, list(block_key ORDER BY key_pos) AS ks FROM qk GROUP BY entity_id) USING (entity_id) ORDER BY per.n DESC, entity_id LIMIT 20", O.met(CAP), _CANDS))
def largest_candidate_sets(spark, sf_dir):
    s1 = table(spark, sf_dir, "s1")
    return PR.largest(PR.per_entity(s1, meetings(spark, sf_dir)), K.with_keys(s1)).select("s1_id", "n", F.array_join("keys", ";").alias("keys"))


_HITS = "hits AS (SELECT t.s1_id, t.source, s1.country, c.noisy_id IS NOT NULL AS hit FROM truth t JOIN s1 ON s1.entity_id = t.s1_id LEFT JOIN cand c ON c.s1_id = t.s1_id AND c.noisy_id = t.noisy_id)"


@query(O.sql("SELECT CASE WHEN grouping(country) = 1 THEN 'all' ELSE country END AS country, CASE WHEN grouping(source) = 1 THEN 'all' ELSE source END AS source, count(*) AS n_true, count_if(hit) AS captured, round(count_if(hit)::DOUBLE / count(*), 6) AS recall FROM hits GROUP BY GROUPING SETS ((), (country), (source))", O.met(CAP), _CANDS, _HITS))
def blocking_recall(spark, sf_dir):
    return PR.recall(table(spark, sf_dir, "truth"), meetings(spark, sf_dir), table(spark, sf_dir, "s1"))


@query(O.sql('SELECT count(*) AS n_entities, count_if(h = n) AS "full", count_if(h > 0 AND h < n) AS partial, count_if(h = 0) AS lost FROM (SELECT s1_id, count(*) AS n, count_if(hit) AS h FROM hits GROUP BY s1_id)', O.met(CAP), _CANDS, _HITS))
def entity_retention(spark, sf_dir):
    return PR.retention(table(spark, sf_dir, "truth"), meetings(spark, sf_dir))


@query(O.sql(r"SELECT regexp_extract(q.block_key, '\|([a-z0-9]+):', 1) AS key_type, count(DISTINCT (t.s1_id, t.noisy_id)) AS n_pairs, count(*) AS n_keys FROM truth t JOIN (SELECT DISTINCT entity_id, block_key FROM qk) q ON q.entity_id = t.s1_id JOIN (SELECT DISTINCT entity_id, block_key FROM pk) p ON p.entity_id = t.noisy_id AND p.block_key = q.block_key GROUP BY 1", O.keyed("s1", "qk", "train"), O.keyed("pool", "pk", "train")))
def pass_contribution(spark, sf_dir):
    return PR.pass_contribution(table(spark, sf_dir, "truth"), postings(spark, sf_dir, "s1", "train"), postings(spark, sf_dir, "pool", "train"), K.key_type)


@query(O.sql("SELECT t.s1_id, t.noisy_id, t.source FROM truth t LEFT JOIN cand c ON c.s1_id = t.s1_id AND c.noisy_id = t.noisy_id WHERE c.noisy_id IS NULL", O.met(CAP), _CANDS))
def lost_matches(spark, sf_dir):
    return B.lost(table(spark, sf_dir, "truth"), meetings(spark, sf_dir)).select("s1_id", "noisy_id", "source")


# Pairs, taxonomies and forensics

def true_pairs(spark, sf_dir):
    """Truth with both sides' attributes and the number of keys they share."""
    names = {"business_name": "name", "business_address": "address", "country": "country"}
    side = lambda src, p: K.with_keys(table(spark, sf_dir, src)).select(F.col("entity_id").alias(f"{p}_id"), *[T.clean_input(c).alias(f"{p}_{n}") for c, n in names.items()], F.col("keys").alias(f"{p}_keys"))
    both = table(spark, sf_dir, "truth").join(side("s1", "s1"), "s1_id").join(side("pool", "noisy"), "noisy_id")
    return both.withColumn("n_shared_keys", F.size(F.array_intersect("s1_keys", "noisy_keys"))).drop("s1_keys", "noisy_keys")


@query()
def match_forensics(spark, sf_dir):
    return PR.forensic_counts(PR.forensics(true_pairs(spark, sf_dir)))


@query()
def blocking_loss_modes(spark, sf_dir):
    return TX.counts(TX.blocking_loss(TX.with_ratios(true_pairs(spark, sf_dir))))


@query()
def truncation_loss_modes(spark, sf_dir):
    return TX.counts(TX.truncation_loss(TX.with_ratios(true_pairs(spark, sf_dir))))


@query()
def lost_failure_modes(spark, sf_dir):
    return TX.counts(TX.lost_failure(TX.with_ratios(true_pairs(spark, sf_dir))))


@query()
def rank_failure_modes(spark, sf_dir):
    ranked = ranks(spark, sf_dir)
    sizes = ranked.groupBy("s1_id").agg(F.count("*").cast("int").alias("total_candidates"))
    pairs = true_pairs(spark, sf_dir).join(ranked.select("s1_id", "noisy_id", "rank"), ["s1_id", "noisy_id"], "left").join(sizes, "s1_id", "left").na.fill(0, ["total_candidates"])
    return TX.top_per_band(TX.rank_failure(pairs).withColumn("band", R.rank_band(F.col("rank"))))


@query()
def hard_negative_causes(spark, sf_dir):
    names = {"business_name": "name", "business_address": "address", "country": "country"}
    side = lambda src, p: table(spark, sf_dir, src).select(F.col("entity_id").alias(f"{p}_id"), *[T.clean_input(c).alias(f"{p}_{n}") for c, n in names.items()])
    wrong = R.ranked(R.evidence(meetings(spark, sf_dir)), 10).join(table(spark, sf_dir, "truth"), ["s1_id", "noisy_id"], "left_anti")
    return TX.counts(TX.hard_negative(wrong.join(side("s1", "s1"), "s1_id").join(side("pool", "noisy"), "noisy_id")))


@query()
def error_causes(spark, sf_dir):
    pairs = labelled_scores(spark, sf_dir)
    names = {"business_name": "name", "business_address": "address", "country": "country"}
    side = lambda src, p: table(spark, sf_dir, src).select(F.col("entity_id").alias(f"{p}_id"), *[T.clean_input(c).alias(f"{p}_{n}") for c, n in names.items()])
    marked = TX.errors(pairs, 0.7).where("error IS NOT NULL").join(side("s1", "s1"), "s1_id").join(side("pool", "noisy"), "noisy_id")
    return TX.error_cause(marked, 0.7).groupBy("error", "category").agg(F.count("*").alias("n"))


_SAMPLED = "entities AS (SELECT s1_id FROM (SELECT DISTINCT s1_id FROM truth) ORDER BY ((CAST(regexp_replace(s1_id, '[^0-9]', '', 'g') AS BIGINT) + 42) * 2654435761) % 1000003, s1_id LIMIT 40000)"


@query(O.sql("SELECT s1_id, ((CAST(regexp_replace(s1_id, '[^0-9]', '', 'g') AS BIGINT) + 42) * 2654435761) % 1000 < 200 AS is_validation FROM entities", _SAMPLED))
def entity_split(spark, sf_dir):
    return P.split(P.sampled(table(spark, sf_dir, "truth"), 40_000))


def training_set(spark, sf_dir, most: int = 40_000, per_entity: int = 25):
    """Labelled pairs of sampled entities, with their split."""
    entities = P.split(P.sampled(table(spark, sf_dir, "truth"), most))
    pairs = P.labelled(entities, table(spark, sf_dir, "truth"), B.first_k(meetings(spark, sf_dir), per_entity), table(spark, sf_dir, "s1"), table(spark, sf_dir, "pool"))
    return pairs.join(entities, "s1_id")


@query()
def training_pairs(spark, sf_dir):
    return P.summary(training_set(spark, sf_dir))


from . import checks  # noqa: E402, F401  registers more queries
