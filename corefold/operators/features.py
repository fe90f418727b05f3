"""The 44 pairwise features, in two variants: as they are computed for training and for serving.

Everything that belongs to one record is computed once per record (``prepared``), before pairs are formed; per pair remain set
operations in the JVM and nine kernels on longest common subsequences.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import similarity as S
from ..functions import text as T

# The features in the order of the vector.
NAMES = [
    "name_exact_match", "name_clean_exact", "name_fuzz_ratio", "name_partial_ratio", "name_token_sort_ratio", "name_token_set_ratio", "name_token_jaccard",
    "name_char_3gram_jaccard", "name_char_4gram_jaccard", "name_len_diff", "name_len_ratio", "name_token_count_diff", "name_no_legal_exact",
    "name_no_legal_token_sort", "addr_is_missing", "addr_exact_match", "addr_clean_exact", "addr_fuzz_ratio", "addr_partial_ratio", "addr_token_sort_ratio",
    "addr_token_set_ratio", "addr_token_jaccard", "addr_char_3gram_jaccard", "addr_char_4gram_jaccard", "addr_len_diff", "addr_len_ratio", "addr_token_count_diff",
    "addr_std_sorted_exact", "addr_number_match", "addr_zip_match", "country_exact_match", "country_is_missing", "cross_name_addr_prod", "cross_name_addr_mean",
    "cross_name_addr_min", "cross_name_addr_max", "cross_name_addr_harm_mean", "cross_exact_name_strong_addr", "cross_strong_name_weak_addr",
    "cross_strong_addr_weak_name", "addr_num_exact_mismatch", "name_acronym_match", "name_pfx4_match", "addr_token_containment",
]
BASE_40 = NAMES[:40]
#: Features that need a kernel outside the JVM.
KERNEL_FEATURES = [n for n in NAMES if n.endswith(("fuzz_ratio", "partial_ratio", "sort_ratio", "set_ratio", "no_legal_token_sort"))]


def prepared(df: DataFrame, variant: str = "serve", entity: str = "entity_id", name: str = "business_name", address: str = "business_address", country: str = "country") -> DataFrame:
    """``entity_id`` and a struct ``f`` of what the features need of one record."""
    if variant not in ("serve", "train"):
        raise ValueError(variant)
    read = T.clean_input if variant == "train" else (lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")))
    base = df.select(F.col(entity).alias("entity_id"), read(name).alias("n"), read(address).alias("a"), F.upper(read(country)).alias("c"), *[F.lower(F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(k) for k, c in (("ln", name), ("la", address))])
    base = base.withColumns({"pn": T.trim(T.fast_punctuation("n")), "pa": T.trim(T.fast_punctuation("a"))})
    base = base.withColumns({"nt": T.tokens("pn"), "at": T.tokens("pa")}).withColumns({"nl": F.array_join(T.strip_legal(F.col("nt")), " ")})
    # The four forensic features look at raw lower texts in training, at cleaned ones in serving.
    fn, fa = ("ln", "la") if variant == "train" else ("pn", "pa")
    firsts = F.filter(F.transform(T.tokens(fn), lambda t: F.substring(t, 1, 1)), lambda x: x.rlike(r"[\p{L}\p{N}]"))
    record = F.struct(
        "n", "a", "c", "pn", "pa", "nl",
        F.size("nt").alias("n_nt"), F.size("at").alias("n_at"), F.array_distinct("nt").alias("nset"), F.array_distinct("at").alias("aset"),
        S.char_ngrams(F.col("pn"), 3).alias("n3"), S.char_ngrams(F.col("pn"), 4).alias("n4"), S.char_ngrams(F.col("pa"), 3).alias("a3"), S.char_ngrams(F.col("pa"), 4).alias("a4"),
        T.sorted_text(T.standardize_address(F.col("at"))).alias("std"), T.digit_tokens("pa").alias("nums"), T.zip_tokens("pa").alias("zips"),
        F.filter("at", lambda t: T.is_digits(t) & F.char_length(t).isin(5, 6)).alias("ztoks"),
        T.digit_tokens(fa).alias("fnums"), F.array_join(firsts, "").alias("acr"), T.alnum_only(fn).alias("compact"), F.substring(fn, 1, 4).alias("pfx4"), F.array_distinct(T.tokens(fa)).alias("fset"),
    )
    return base.select("entity_id", record.alias("f"))


def _flag(c: Column) -> Column:
    return F.when(c, 1.0).otherwise(0.0)


def _diff(a: Column, b: Column) -> Column:
    return F.abs(a - b).cast("double")


def compute(pairs: DataFrame, variant: str = "serve", kernels: bool = True) -> DataFrame:
    """Add the features to pairs with structs ``s1`` and ``noisy`` (of ``prepared``). Without kernels the features that need one, and those derived from them, are absent."""
    a = {k: F.col(f"s1.{k}") for k in ("n", "a", "c", "pn", "pa", "nl", "n_nt", "n_at", "nset", "aset", "n3", "n4", "a3", "a4", "std", "nums", "zips", "ztoks", "fnums", "acr", "compact", "pfx4", "fset")}
    b = {k: F.col(f"noisy.{k}") for k in a}
    train = variant == "train"
    have_n, have_a = (a["pn"] != "") & (b["pn"] != ""), (a["pa"] != "") & (b["pa"] != "")
    same = lambda k: _flag((a[k] != "") & (b[k] != "") & (a[k] == b[k]))
    gate = lambda have, value: F.when(have, value).otherwise(0.0)
    lengths = lambda k: (F.char_length(a[k]), F.char_length(b[k]))
    kernel = lambda kind, k: gate((a[k] != "") & (b[k] != ""), S.similarity(kind, a[k], b[k]))
    f: dict[str, Column] = {"name_exact_match": same("n"), "name_clean_exact": same("pn")}
    for field, p, tokens_, grams, have in (("name", "pn", "nset", "n", have_n), ("addr", "pa", "aset", "a", have_a)):
        count = "n_nt" if field == "name" else "n_at"
        la, lb = lengths(p)
        if kernels:
            f |= {f"{field}_{n}": kernel(kind, p) for n, kind in (("fuzz_ratio", "ratio"), ("partial_ratio", "partial_ratio"), ("token_sort_ratio", "token_sort_ratio"), ("token_set_ratio", "token_set_ratio"))}
        f |= {f"{field}_token_jaccard": S.jaccard(a[tokens_], b[tokens_])}
        f |= {f"{field}_char_{n}gram_jaccard": S.jaccard(a[f"{grams}{n}"], b[f"{grams}{n}"]) for n in (3, 4)}
        diffs = {f"{field}_len_diff": _diff(la, lb), f"{field}_token_count_diff": _diff(a[count], b[count])}
        f |= {k: gate(have, v) for k, v in diffs.items()} if train else diffs
        f |= {f"{field}_len_ratio": gate(have, F.least(la, lb) / F.greatest(la, lb))}
    f |= {"name_no_legal_exact": same("nl") if not train else gate(have_n, same("nl"))}
    if kernels:
        f |= {"name_no_legal_token_sort": kernel("token_sort_ratio", "nl")}
    missing = ~have_a if train else (a["a"] == "") | (b["a"] == "")
    f |= {"addr_is_missing": _flag(missing), "addr_exact_match": same("a"), "addr_clean_exact": same("pa"), "addr_std_sorted_exact": gate(have_a, same("std")) if train else same("std")}
    both = lambda k: (F.size(a[k]) > 0) & (F.size(b[k]) > 0)
    if train:
        f["addr_number_match"] = gate(have_a, F.when(both("nums"), _flag(F.get(a["nums"], 0) == F.get(b["nums"], 0))).otherwise(0.5))
        f["addr_zip_match"] = gate(have_a, F.when(both("zips"), _flag(S.overlap(a["zips"], b["zips"]))).otherwise(0.5))
    else:
        f["addr_number_match"] = _flag(both("nums") & S.overlap(a["nums"], b["nums"]))
        long = (F.char_length(a["pa"]) >= 5) & (F.char_length(b["pa"]) >= 5)
        f["addr_zip_match"] = _flag(long & F.exists(a["ztoks"], lambda z: b["pa"].contains(z)))
    f["country_exact_match"] = same("c")
    f["country_is_missing"] = _flag((a["c"] == "") | (b["c"] == "") | (b["c"].isin("NAN", "NULL", "NONE") if train else F.lit(False)))
    f["addr_num_exact_mismatch"] = _flag(both("fnums") & ~S.overlap(a["fnums"], b["fnums"]))
    f["name_acronym_match"] = _flag(((a["acr"] != "") & (a["acr"] == b["compact"])) | ((b["acr"] != "") & (b["acr"] == a["compact"])))
    f["name_pfx4_match"] = _flag((a["pfx4"] != "") & (a["pfx4"] == b["pfx4"]))
    f["addr_token_containment"] = S.containment(a["fset"], b["fset"])
    out = pairs.withColumns(f)
    return _cross(out, train) if kernels else out


def _cross(df: DataFrame, train: bool) -> DataFrame:
    """Interactions of a name and an address signal, which differ between the variants."""
    n, a = (F.col("name_fuzz_ratio"), F.col("addr_fuzz_ratio")) if train else (F.col("name_token_sort_ratio"), F.col("addr_char_3gram_jaccard"))
    harmonic = 2 * n * a / (n + a + 1e-6) if train else F.when(n + a > 0, 2 * n * a / (n + a)).otherwise(0.0)
    strong_name = n >= 0.95 if train else F.col("name_clean_exact") == 1.0
    return df.withColumns(
        {
            "cross_name_addr_prod": n * a, "cross_name_addr_mean": 0.5 * (n + a), "cross_name_addr_min": F.least(n, a), "cross_name_addr_max": F.greatest(n, a), "cross_name_addr_harm_mean": harmonic,
            "cross_exact_name_strong_addr": _flag(strong_name & (a >= 0.70)), "cross_strong_name_weak_addr": _flag((n >= 0.85) & (a < 0.40)),
            "cross_strong_addr_weak_name": _flag((a >= 0.80) & (n < 0.45) if train else (a >= 0.85) & (n < 0.40)),
        }
    )


def joined(pairs: DataFrame, s1: DataFrame, pool: DataFrame, variant: str = "serve") -> DataFrame:
    """Pairs ``(s1_id, noisy_id)`` with the structs ``s1`` and ``noisy`` of their records."""
    left = prepared(s1, variant).select(F.col("entity_id").alias("s1_id"), F.col("f").alias("s1"))
    right = prepared(pool, variant).select(F.col("entity_id").alias("noisy_id"), F.col("f").alias("noisy"))
    return pairs.join(left, "s1_id").join(right, "noisy_id")


def features(pairs: DataFrame, s1: DataFrame, pool: DataFrame, variant: str = "serve", keep: tuple[str, ...] = (), kernels: bool = True) -> DataFrame:
    """``s1_id, noisy_id``, the columns ``keep`` of the pairs, and the features in their order."""
    out = compute(joined(pairs, s1, pool, variant), variant, kernels)
    return out.select("s1_id", "noisy_id", *keep, *[n for n in NAMES if n in out.columns])


def describe(df: DataFrame, label: str = "label", names: list[str] | None = None) -> DataFrame:
    """``feature, mean, std, min, p50, max, corr`` (with the label; null where a column is constant), in one pass."""
    names = names or [n for n in NAMES if n in df.columns]
    aggs = []
    for n in names:
        aggs.append(
            F.struct(
                F.lit(n).alias("feature"), F.round(F.avg(n), 6).alias("mean"), F.round(F.stddev_samp(n), 6).alias("std"), F.min(n).alias("min"), F.percentile(n, F.lit(0.5)).alias("p50"),
                F.max(n).alias("max"), F.when((F.stddev_samp(n) > 0) & (F.stddev_samp(label) > 0), F.round(F.covar_samp(n, label) / (F.stddev_samp(n) * F.stddev_samp(label)), 6)).alias("corr"),
            )
        )
    return df.agg(F.array(*aggs).alias("all")).select(F.explode("all").alias("x")).select("x.*")
