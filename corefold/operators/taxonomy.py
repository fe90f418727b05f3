"""Ordered ladders that name why a match was lost, ranked low, missed or made up.

Input pairs have ``s1_name, s1_address, s1_country, noisy_name, noisy_address, noisy_country`` (not null). Ratios are 0 to 100.
The names of the categories and the cuts between them are fixed values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import similarity as S
from ..functions import text as T
from ..functions import vocabulary as V


def with_ratios(pairs: DataFrame) -> DataFrame:
    """Add ``name_sim, addr_sim, name_sort, addr_sort``: of lower texts, 0 where one is empty."""

    def sim(kind: str, k: str) -> Column:
        a, b = F.col(f"s1_{k}"), F.col(f"noisy_{k}")
        return F.when((a != "") & (b != ""), 100 * S.similarity(kind, F.lower(a), F.lower(b))).otherwise(0.0)

    return pairs.withColumns({"name_sim": sim("ratio", "name"), "addr_sim": sim("ratio", "address"), "name_sort": sim("token_sort_ratio", "name"), "addr_sort": sim("token_sort_ratio", "address")})


def _ladder(steps: list[tuple[Column, str]], last: str) -> Column:
    out = F.when(steps[0][0], F.lit(steps[0][1]))
    for condition, name in steps[1:]:
        out = out.when(condition, F.lit(name))
    return out.otherwise(F.lit(last))


def _sides() -> tuple[Column, ...]:
    return tuple(F.col(c) for c in ("s1_name", "s1_address", "s1_country", "noisy_name", "noisy_address", "noisy_country"))


def _short_single(n1: Column, n2: Column) -> Column:
    return (F.size(T.tokens(n2)) == 1) & (F.char_length(n2) <= 4) & (F.size(T.tokens(n1)) > 1)


def _no_name(n: Column) -> Column:
    return (n == "") | F.lower(n).isin("nan", "null")


def blocking_loss(pairs: DataFrame, out: str = "category") -> DataFrame:
    """Seven modes of lost true pairs. Needs ``with_ratios``."""
    n1, _, _, n2, _, _ = _sides()
    ns, as_ = F.col("name_sim"), F.col("addr_sim")
    steps = [
        ((T.script_type(n2) != "Latin") & (T.script_type(n1) == "Latin"), "Cross-Script Transliteration (English vs Non-Latin Script)"),
        (_no_name(n2), "Missing / Empty Name in Noisy Source"),
        (_short_single(n1, n2), "Acronym / Initialism Representation (e.g. 'IAG' vs 'Indian Ace Global')"),
        ((ns < 40) & (as_ < 40), "Severe Dissimilarity / DBA (Completely Different Brand Name)"),
        ((ns < 50) & (as_ >= 60), "Address Correlated but Name Unmatched (Missed Address Block Key)"),
        ((ns >= 60) & (as_ < 40), "Moderate Name Similarity (Typo / Prefix Mismatch in First 6 Chars)"),
    ]
    return pairs.withColumn(out, _ladder(steps, "Multiple Word Splitting / Sub-token Shift"))


def truncation_loss(pairs: DataFrame, out: str = "category") -> DataFrame:
    """Eight categories; shared keys (``n_shared_keys``) mean that a cap cut the pair off. Needs ``with_ratios``."""
    n1, _, c1, n2, _, c2 = _sides()
    ns, as_ = F.col("name_sim"), F.col("addr_sim")
    steps = [
        (F.col("n_shared_keys") > 0, "Top-K Truncation / Bucket Slicing"),
        (_no_name(n2), "Missing / Empty Name"),
        ((F.upper(c1) != F.upper(c2)) & (c1 != "") & (c2 != ""), "Country Mismatch"),
        ((ns < 40) & (as_ < 40), "Severe Dissimilarity / Alternate Brand"),
        ((ns < 50) & (as_ >= 60), "Address Correlated but Name Unmatched"),
        ((ns >= 60) & (as_ < 40), "Moderate Name Similarity (Typo/Prefix Mismatch)"),
        (_short_single(n1, n2), "Acronym / Initialism"),
    ]
    return pairs.withColumn(out, _ladder(steps, "No Blocking Rule Hit"))


def _words_without_generic(c: Column, punct: bool = False) -> Column:
    return F.filter(T.tokens(T.fast_punctuation(c) if punct else F.lower(c)), lambda t: ~t.isin(V.STOPWORDS))


def lost_failure(pairs: DataFrame, out: str = "category") -> DataFrame:
    """Nine categories with a reason in ``reason``. Needs ``with_ratios`` and ``n_shared_keys``."""
    n1, a1, _, n2, a2, _ = _sides()
    ns, as_, nt, at = (F.col(c) for c in ("name_sim", "addr_sim", "name_sort", "addr_sort"))
    foreign1, foreign2 = n1.rlike(r"[^\x00-\x7F]"), n2.rlike(r"[^\x00-\x7F]")
    w1, w2 = _words_without_generic(n1), _words_without_generic(n2)
    initials = lambda a, b: (F.size(a) == 1) & (F.char_length(F.get(a, 0)) <= 4) & (F.get(a, 0) == T.acronym(b))
    # The formats of the reasons.
    sims = lambda *parts: F.concat(*[F.lit(x) if isinstance(x, str) else F.round(x, 1).cast("string") for x in parts])
    versus = lambda a, b, what: F.concat(F.lit(f"{what} ('"), a, F.lit("' vs '"), b, F.lit("')"))
    steps = [
        (F.col("n_shared_keys") > 0, "OTHER", F.lit("Shared keys present")),
        ((n1 == "") | (n2 == ""), "MISSING_FIELD", F.lit("Missing or empty business name")),
        ((a1 == "") | (a2 == ""), "MISSING_FIELD", F.lit("Missing or empty business address")),
        ((foreign1 != foreign2) | (foreign1 & foreign2 & (ns < 40)), "NON_LATIN_OR_TRANSLITERATION", versus(n1, n2, "Non-Latin script or cross-script transliteration")),
        ((nt >= 80) & (ns < 60), "TOKEN_ORDER", versus(n1, n2, "Name token reordering")),
        ((at >= 80) & (as_ < 60), "TOKEN_ORDER", versus(a1, a2, "Address token reordering")),
        (initials(w1, w2) | initials(w2, w1), "ABBREVIATION", versus(n1, n2, "Acronym / initialism")),
        (ns >= 65, "NAME_VARIATION", sims("Name typo or character perturbation (Sim: ", ns, "%)")),
        (as_ >= 65, "ADDRESS_VARIATION", sims("Address variation / abbreviation (Addr Sim: ", as_, "%, Name Sim: ", ns, "%)")),
        ((ns < 40) & (as_ < 40), "ALTERNATE_BRAND_NAME", sims("Alternate DBA / Trade Name (Name Sim: ", ns, "%, Addr Sim: ", as_, "%)")),
    ]
    why = F.when(steps[0][0], steps[0][2])
    for condition, _, reason in steps[1:]:
        why = why.when(condition, reason)
    return pairs.withColumns({out: _ladder([(c, k) for c, k, _ in steps], "NO_BLOCKING_RULE_HIT"), "reason": why.otherwise(sims("No shared blocking key generated (Name Sim: ", ns, "%, Addr Sim: ", as_, "%)"))})


def acronym_match(n1: Column, n2: Column) -> Column:
    w1, w2 = _words_without_generic(n1, True), _words_without_generic(n2, True)
    one = lambda a, b: (F.size(a) == 1) & (F.char_length(F.get(a, 0)) >= 2) & (F.get(a, 0) == T.acronym(b))
    return F.coalesce((F.size(w1) > 0) & (F.size(w2) > 0) & (one(w1, w2) | one(w2, w1)), F.lit(False))


def abbreviation_match(n1: Column, a1: Column, n2: Column, a2: Column) -> Column:
    t1, t2 = T.tokens(T.fast_punctuation(F.concat_ws(" ", n1, a1))), T.tokens(T.fast_punctuation(F.concat_ws(" ", n2, a2)))
    out = F.lit(False)
    for short, full in V.ABBREVIATIONS.items():
        has = lambda t, w: F.array_contains(t, w)
        out = out | (has(t1, short) & has(t2, full)) | (has(t1, full) & has(t2, short))
    return out


def token_order_match(n1: Column, n2: Column) -> Column:
    core = lambda n: F.array_sort(F.array_distinct(F.filter(T.strip_legal(T.tokens(T.fast_punctuation(n))), lambda t: ~t.isin(V.STOPWORDS))))
    return (F.size(core(n1)) >= 2) & (core(n1) == core(n2))


def transliteration_match(n1: Column, a1: Column, n2: Column, a2: Column, country: Column) -> Column:
    """Indic spellings that fold to one another; India only."""
    f1, f2 = (T.indic_fold(T.fast_alpha(F.concat_ws(" ", n, a))) for n, a in ((n1, a1), (n2, a2)))
    near = f2.contains(f1) | f1.contains(f2) | (F.levenshtein(F.substring(f1, 1, 12), F.substring(f2, 1, 12)) <= 1)
    return (country == "India") & (F.char_length(f1) >= 6) & (F.char_length(f2) >= 6) & near


def rank_failure(pairs: DataFrame, out: str = "category") -> DataFrame:
    """Eleven categories of true pairs with a low rank. Needs ``total_candidates`` and ``n_shared_keys``."""
    n1, a1, c1, n2, a2, c2 = _sides()
    core = lambda n: T.strip_legal(T.tokens(T.fast_punctuation(n)))
    std = lambda a: T.standardize_address(T.tokens(T.fast_punctuation(a)))
    work = pairs.withColumns({"__t1": core(n1), "__t2": core(n2), "__s1": std(a1), "__s2": std(a2), "__l1": T.fast_alpha(n1), "__l2": T.fast_alpha(n2)})
    l1, l2 = F.col("__l1"), F.col("__l2")
    set_jaccard = lambda a, b: F.size(F.array_intersect(a, b)) / F.greatest(F.lit(1), F.size(F.array_union(a, b)))
    nj, aj = set_jaccard(F.col("__t1"), F.col("__t2")), set_jaccard(F.col("__s1"), F.col("__s2"))
    edits = F.levenshtein(F.substring(l1, 1, 15), F.substring(l2, 1, 15))
    generic = F.exists("__t1", lambda t: t.isin(V.STOPWORDS)) | (F.char_length(l1) < 5)
    steps = [
        ((n1 == "") | (n2 == "") | (a1 == "") | (a2 == ""), "MISSING_FIELD"),
        (acronym_match(n1, n2), "ACRONYM_INITIALISM"),
        (token_order_match(n1, n2), "TOKEN_ORDER"),
        (transliteration_match(n1, a1, n2, a2, c1), "TRANSLITERATION_OR_NON_LATIN"),
        (abbreviation_match(n1, a1, n2, a2), "ABBREVIATION"),
        (edits.between(1, 2) & (F.char_length(l1) >= 4) & (F.char_length(l2) >= 4), "TYPO_OR_CHARACTER_PERTURBATION"),
        ((F.col("total_candidates") >= 50) & (F.col("n_shared_keys") <= 1) & generic, "GENERIC_KEY_POLLUTION"),
        (nj >= 0.6, "ADDRESS_SIMILARITY_FAILURE"),
        ((nj < 0.2) & (c1 == c2) & (aj >= 0.3), "ALTERNATE_DBA_NAME"),
        (nj < 0.5, "NAME_SIMILARITY_FAILURE"),
    ]
    return work.withColumn(out, _ladder(steps, "OTHER")).drop("__t1", "__t2", "__s1", "__s2", "__l1", "__l2")


def hard_negative(pairs: DataFrame, out: str = "category") -> DataFrame:
    """Six causes of a wrong candidate with a high rank."""
    n1, a1, c1, n2, a2, c2 = _sides()
    work = pairs.withColumns({"__n": F.array_intersect(_words_without_generic(n1, True), _words_without_generic(n2, True)), "__a": F.array_intersect(_words_without_generic(a1, True), _words_without_generic(a2, True))})
    shared = lambda c, items: F.exists(c, lambda t: t.isin(items))
    some = lambda c: F.size(c) >= 1
    steps = [
        (shared("__n", V.GENERIC_NAME_TOKENS), "GENERIC_NAME_TOKEN"),
        (shared("__a", V.STREET_TOKENS), "SHARED_STREET_OR_ADDRESS"),
        ((c1 == c2) & some("__n") & some("__a"), "SHARED_NAME_AND_LOCATION_TOKENS"),
        (some("__n"), "SHARED_STEM_OR_PREFIX"),
        (c1 == c2, "SAME_GEOGRAPHY_AND_GENERIC_KEY"),
    ]
    return work.withColumn(out, _ladder(steps, "WEAK_BUCKET_OVERLAP")).drop("__n", "__a")


def error_cause(pairs: DataFrame, threshold: float, out: str = "category") -> DataFrame:
    """Four causes of false positives (``label`` 0) and eight of false negatives (``label`` 1). Needs ``prob``."""
    n1, a1, _, n2, a2, _ = _sides()
    work = pairs.withColumns({"__n1": T.name_struct("s1_name"), "__n2": T.name_struct("noisy_name"), "__a1": T.address_struct("s1_address"), "__a2": T.address_struct("noisy_address")})
    sim = lambda kind, k: 100 * S.similarity(kind, F.col(f"__{k}1.clean"), F.col(f"__{k}2.clean"))
    work = work.withColumns({"__nr": sim("ratio", "n"), "__ns": sim("token_sort_ratio", "n"), "__ar": sim("ratio", "a"), "__as": sim("token_sort_ratio", "a")})
    nr, ns, ar, as_ = (F.col(c) for c in ("__nr", "__ns", "__ar", "__as"))
    t1, t2 = F.col("__n1.tokens"), F.col("__n2.tokens")
    initials = (F.size(t1) > 0) & (F.size(t2) > 0) & ((T.acronym(t1) == F.col("__n2.alphanumeric")) | (T.acronym(t2) == F.col("__n1.alphanumeric")))
    missed = _ladder(
        [
            (F.col("prob") >= round(threshold - 0.15, 9), "Threshold Near-Miss (0.68 <= prob < tau)"),
            (F.concat(n1, n2).rlike(r"[^\x00-\x7F]") & (nr < 40), "Cross-Script Transliteration (Non-Latin vs Latin)"),
            (initials, "Name Acronym / Abbreviation"),
            ((ar < 30) & (nr > 80), "Severe Address Variation / Missing Branch Info"),
            ((nr < 40) & (ar > 75), "Trade Name vs Legal Name (Address Matches)"),
            ((ns > 75) & (nr < 50), "Multi-Token Word Reordering / Complex Name"),
            ((nr < 50) & (ar < 50), "Heavily Obfuscated Name & Address"),
        ],
        "Complex Typo / Multi-Component Difference",
    )
    made_up = _ladder(
        [
            ((ns > 90) & (ar < 35), "Same-Name Different-Business (Homonym / Different Location)"),
            ((ns > 90) & (as_ > 70), "Parent/Sub-Brand in Same Mall/Building"),
            ((nr > 85) & (ar < 40), "Chain / Franchise In Separate City"),
        ],
        "Coincidental Surface Similarity",
    )
    return work.withColumn(out, F.when(F.col("label") == 1, missed).otherwise(made_up)).drop(*[c for c in work.columns if c.startswith("__")])


def errors(scored: DataFrame, threshold: float, near: float = 0.65) -> DataFrame:
    """Add ``error``: FP, FN, NEAR_MISS (a false negative that is close) or null."""
    miss = (F.col("label") == 1) & (F.col("prob") < threshold)
    kind = F.when((F.col("label") == 0) & (F.col("prob") >= threshold), "FP").when(miss & (F.col("prob") >= near), "NEAR_MISS").when(miss, "FN")
    return scored.withColumn("error", kind)


def examples(marked: DataFrame, most: int = 5) -> DataFrame:
    """The most extreme errors of each kind."""
    sign = F.when(F.col("error") == "FP", -F.col("prob")).otherwise(F.col("prob"))
    w = Window.partitionBy("error").orderBy(sign, "s1_id", "noisy_id")
    return marked.where("error IS NOT NULL").withColumn("__rank", F.row_number().over(w)).where(F.col("__rank") <= most).drop("__rank")


def counts(marked: DataFrame, category: str = "category") -> DataFrame:
    return marked.groupBy(category).agg(F.count("*").alias("n"))


def top_per_band(marked: DataFrame, band: str = "band", category: str = "category", most: int = 2) -> DataFrame:
    """The most frequent categories of each rank band."""
    n = marked.groupBy(band, category).agg(F.count("*").alias("n"))
    w = Window.partitionBy(band).orderBy(F.col("n").desc(), category)
    return n.withColumn("place", F.row_number().over(w)).where(F.col("place") <= most)
