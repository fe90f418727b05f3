"""More queries and their SQL: similarity kernels, loss ladders, training pairs, submission checks, statistics of features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import similarity as S
from ..functions import text as T
from ..functions import vocabulary as V
from ..operators import blocking as B
from ..operators import features as FE
from ..operators import metrics as M
from ..operators import ranking as R
from ..operators import validate as VA
from ..sources import tables as IO
from . import oracle as O
from . import queries as Q
from .entities import table
from .queries import CAP, ORACLE_SQL, query

# Longest common subsequences in SQL: Hyyrö's recurrence on 128 bits, for texts of up to 120 characters.


def _lcs(a: str, b: str) -> str:
    full = f"((1::HUGEINT << length({b})) - 1)"
    masks = f"list_transform(string_split({a}, ''), lambda c: coalesce(list_sum(list_transform(range(1, length({b}) + 1), lambda j: CASE WHEN substring({b}, j, 1) = c THEN 1::HUGEINT << (j - 1) ELSE 0::HUGEINT END)), 0)::HUGEINT)"
    state = f"list_reduce(list_prepend({full}, {masks}), lambda s, m: ((s + (s & m)) | (s - (s & m))) & {full})"
    return f"CASE WHEN length({a}) = 0 OR length({b}) = 0 THEN 0 ELSE length({b}) - bit_count({state}) END"


def _ratio(a: str, b: str) -> str:
    return f"CASE WHEN length({a}) + length({b}) = 0 THEN 1.0 ELSE 2.0::DOUBLE * ({_lcs(a, b)}) / (length({a}) + length({b})) END"


def _both(have: str, value: str, scale: str = "") -> str:
    return f"CASE WHEN {have} THEN {scale}({value}) ELSE 0.0 END::DOUBLE"


def _flag(c: str) -> str:
    return f"CASE WHEN {c} THEN 1.0 ELSE 0.0 END::DOUBLE"


_SORTED = "array_to_string(list_sort({}), ' ')"


# Features that need a kernel, and those derived from them

_RECORDS = ", ".join(
    f"{out} AS (SELECT entity_id, pn, pa, nl, {O.toks('pn')} AS nt, {O.toks('pa')} AS att, {_SORTED.format(O.toks('pn'))} AS ns, {_SORTED.format(O.toks('pa'))} AS as_, {_SORTED.format(O.toks('nl'))} AS nls, {O.grams('pa', 3)} AS a3 "
    f"FROM (SELECT entity_id, pn, pa, array_to_string({O.no_legal(O.toks('pn'))}, ' ') AS nl FROM (SELECT entity_id, trim({O.punct('coalesce(business_name, ' + chr(39) * 2 + ')')}) AS pn, trim({O.punct('coalesce(business_address, ' + chr(39) * 2 + ')')}) AS pa FROM {src})))"
    for src, out in (("s1", "l"), ("pool", "r"))
)
_SPLIT = (
    "paired AS (SELECT c.s1_id, c.noisy_id, l.pn AS lpn, r.pn AS rpn, l.pa AS lpa, r.pa AS rpa, l.nl AS lnl, r.nl AS rnl, l.ns AS lns, r.ns AS rns, l.as_ AS las, r.as_ AS ras, l.nls AS lnls, r.nls AS rnls, l.a3 AS la3, r.a3 AS ra3, "
    + ", ".join(
        f"list_sort(list_distinct(list_filter(l.{t}, lambda x: list_contains(r.{t}, x)))) AS {k}_both, array_to_string(list_sort(list_distinct(list_filter(l.{t}, lambda x: NOT list_contains(r.{t}, x)))), ' ') AS {k}_x, "
        f"array_to_string(list_sort(list_distinct(list_filter(r.{t}, lambda x: NOT list_contains(l.{t}, x)))), ' ') AS {k}_y"
        for k, t in (("name", "nt"), ("addr", "att"))
    )
    + " FROM ranked c JOIN l ON l.entity_id = c.s1_id JOIN r ON r.entity_id = c.noisy_id WHERE rank <= 5)"
)


def _token_set(k: str) -> str:
    shared, gap = f"length(array_to_string({k}_both, ' '))", f"CASE WHEN len({k}_both) > 0 THEN 1 ELSE 0 END"
    left, right = f"({shared} + {gap} + length({k}_x))", f"({shared} + {gap} + length({k}_y))"
    best = f"2.0::DOUBLE * ({shared} + {gap} + ({_lcs(k + '_x', k + '_y')})) / ({left} + {right})"
    return f"CASE WHEN len({k}_both) > 0 AND ({k}_x = '' OR {k}_y = '') THEN 1.0 WHEN len({k}_both) > 0 THEN greatest({best}, 2.0::DOUBLE * {shared} / ({shared} + {left}), 2.0::DOUBLE * {shared} / ({shared} + {right})) ELSE {best} END"


_KERNELS = (
    "kernels AS (SELECT s1_id, noisy_id, " + ", ".join(
        [f"{_both(have, _ratio('l' + p, 'r' + p))} AS {k}_fuzz_ratio, {_both(have, _ratio('l' + s, 'r' + s))} AS {k}_token_sort_ratio, {_both(have, _token_set(k))} AS {k}_token_set_ratio"
         for k, p, s, have in (("name", "pn", "ns", "lpn <> '' AND rpn <> ''"), ("addr", "pa", "as", "lpa <> '' AND rpa <> ''"))]
        + [f"{_both(chr(108) + 'nl <> ' + chr(39) * 2 + ' AND rnl <> ' + chr(39) * 2, _ratio('lnls', 'rnls'))} AS name_no_legal_token_sort", f"{O.jaccard('la3', 'ra3')} AS a", f"{_flag('lpn <> ' + chr(39) * 2 + ' AND lpn = rpn')} AS same"]
    ) + " FROM paired)"
)
_CROSS = {
    "cross_name_addr_prod": "n * a", "cross_name_addr_mean": "0.5 * (n + a)", "cross_name_addr_min": "least(n, a)", "cross_name_addr_max": "greatest(n, a)",
    "cross_name_addr_harm_mean": "CASE WHEN n + a > 0 THEN 2 * n * a / (n + a) ELSE 0.0 END", "cross_exact_name_strong_addr": _flag("same = 1.0 AND a >= 0.7"),
    "cross_strong_name_weak_addr": _flag("n >= 0.85 AND a < 0.4"), "cross_strong_addr_weak_name": _flag("a >= 0.85 AND n < 0.4"),
}
_KERNEL_NAMES = [n for n in FE.KERNEL_FEATURES if "partial" not in n]


@query(
    O.sql(
        "SELECT s1_id, noisy_id, " + ", ".join([f"round({n}, 6) AS {n}" for n in _KERNEL_NAMES] + [f"round({v}, 6) AS {n}" for n, v in _CROSS.items()]) + " FROM (SELECT *, name_token_sort_ratio AS n FROM kernels)",
        O.met(CAP), Q._RANKED, _RECORDS, _SPLIT, _KERNELS,
    )
)
def features_kernels(spark, sf_dir):
    """The features of the longest common subsequence, but the windowed ones, and the crossed ones, for the candidates of the feature queries."""
    out = FE.features(B.first_k(Q.meetings(spark, sf_dir), 5), table(spark, sf_dir, "s1"), table(spark, sf_dir, "pool"))
    return out.select("s1_id", "noisy_id", *[F.round(n, 6).alias(n) for n in [*_KERNEL_NAMES, *_CROSS]])


# Ladders of lost matches

_side = lambda alias, p: ", ".join(f"{Q._CLEAN.format(f'{alias}.{c}')} AS {n}{p}" for c, n in (("business_name", "n"), ("business_address", "a"), ("country", "c")))
_KEYS = (O.keyed("s1", "qk"), O.keyed("pool", "pk"))
_SHARED_KEYS = "shared_keys AS (SELECT t.s1_id, t.noisy_id, count(DISTINCT q.block_key) AS n_shared FROM truth t JOIN qk q ON q.entity_id = t.s1_id JOIN pk p ON p.entity_id = t.noisy_id AND p.block_key = q.block_key GROUP BY ALL)"
_TRUE = f"true_pairs AS (SELECT t.s1_id, t.noisy_id, {_side('s', 1)}, {_side('p', 2)}, coalesce(k.n_shared, 0) AS n_shared FROM truth t JOIN s1 s ON s.entity_id = t.s1_id JOIN pool p ON p.entity_id = t.noisy_id LEFT JOIN shared_keys k ON k.s1_id = t.s1_id AND k.noisy_id = t.noisy_id)"
_SORT = lambda c: _SORTED.format(O.toks(f"lower({c})"))
_SIMS = (
    f"lowered AS (SELECT *, lower(n1) AS ln1, lower(n2) AS ln2, lower(a1) AS la1, lower(a2) AS la2, {_SORT('n1')} AS sn1, {_SORT('n2')} AS sn2, {_SORT('a1')} AS sa1, {_SORT('a2')} AS sa2 FROM true_pairs)",
    "sims AS (SELECT *, " + ", ".join(f"{_both(f'{k}1 <> {chr(39) * 2} AND {k}2 <> {chr(39) * 2}', _ratio(f'{p}{k}1', f'{p}{k}2'), '100 * ')} AS {out}" for out, p, k in (("ns", "l", "n"), ("as_", "l", "a"), ("nt", "s", "n"), ("at_", "s", "a"))) + " FROM lowered)",
)
_NO_NAME = "(n2 = '' OR lower(n2) IN ('nan', 'null'))"
_SHORT_SINGLE = f"(len({O.toks('n2')}) = 1 AND length(n2) <= 4 AND len({O.toks('n1')}) > 1)"
_FOREIGN = lambda c: f"regexp_matches({c}, '[^\\x00-\\x7F]')"


def _ladder(steps: list[tuple[str, str]], last: str) -> str:
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    return "CASE " + " ".join(f"WHEN {c} THEN {quoted(n)}" for c, n in steps) + f" ELSE {quoted(last)} END"


def _counted(ladder: str) -> str:
    return O.sql(f"SELECT {ladder} AS category, count(*) AS n FROM sims GROUP BY 1", *_KEYS, _SHARED_KEYS, _TRUE, *_SIMS)


ORACLE_SQL["blocking_loss_modes"] = _counted(
    _ladder(
        [
            (f"{_FOREIGN('n2')} AND NOT {_FOREIGN('n1')}", "Cross-Script Transliteration (English vs Non-Latin Script)"),
            (_NO_NAME, "Missing / Empty Name in Noisy Source"),
            (_SHORT_SINGLE, "Acronym / Initialism Representation (e.g. 'IAG' vs 'Indian Ace Global')"),
            ("ns < 40 AND as_ < 40", "Severe Dissimilarity / DBA (Completely Different Brand Name)"),
            ("ns < 50 AND as_ >= 60", "Address Correlated but Name Unmatched (Missed Address Block Key)"),
            ("ns >= 60 AND as_ < 40", "Moderate Name Similarity (Typo / Prefix Mismatch in First 6 Chars)"),
        ],
        "Multiple Word Splitting / Sub-token Shift",
    )
)
ORACLE_SQL["truncation_loss_modes"] = _counted(
    _ladder(
        [
            ("n_shared > 0", "Top-K Truncation / Bucket Slicing"),
            (_NO_NAME, "Missing / Empty Name"),
            ("upper(c1) <> upper(c2) AND c1 <> '' AND c2 <> ''", "Country Mismatch"),
            ("ns < 40 AND as_ < 40", "Severe Dissimilarity / Alternate Brand"),
            ("ns < 50 AND as_ >= 60", "Address Correlated but Name Unmatched"),
            ("ns >= 60 AND as_ < 40", "Moderate Name Similarity (Typo/Prefix Mismatch)"),
            (_SHORT_SINGLE, "Acronym / Initialism"),
        ],
        "No Blocking Rule Hit",
    )
)
_CORE = lambda c: f"list_filter({O.toks(f'lower({c})')}, lambda t: t NOT IN ({O.words(V.STOPWORDS)}))"
_INITIALS = lambda a, b: f"(len({a}) = 1 AND length({a}[1]) <= 4 AND {a}[1] = array_to_string(list_transform({b}, lambda x: substring(x, 1, 1)), ''))"
_LOST = [
    ("n_shared > 0", "OTHER", "'Shared keys present'"),
    ("n1 = '' OR n2 = ''", "MISSING_FIELD", "'Missing or empty business name'"),
    ("a1 = '' OR a2 = ''", "MISSING_FIELD", "'Missing or empty business address'"),
    (f"({_FOREIGN('n1')} <> {_FOREIGN('n2')}) OR ({_FOREIGN('n1')} AND {_FOREIGN('n2')} AND ns < 40)", "NON_LATIN_OR_TRANSLITERATION", "'Non-Latin script or cross-script transliteration (''' || n1 || ''' vs ''' || n2 || ''')'"),
    ("nt >= 80 AND ns < 60", "TOKEN_ORDER", "'Name token reordering (''' || n1 || ''' vs ''' || n2 || ''')'"),
    ("at_ >= 80 AND as_ < 60", "TOKEN_ORDER", "'Address token reordering (''' || a1 || ''' vs ''' || a2 || ''')'"),
    (f"{_INITIALS('w1', 'w2')} OR {_INITIALS('w2', 'w1')}", "ABBREVIATION", "'Acronym / initialism (''' || n1 || ''' vs ''' || n2 || ''')'"),
    ("ns >= 65", "NAME_VARIATION", "'Name typo or character perturbation (Sim: ' || round(ns, 1) || '%)'"),
    ("as_ >= 65", "ADDRESS_VARIATION", "'Address variation / abbreviation (Addr Sim: ' || round(as_, 1) || '%, Name Sim: ' || round(ns, 1) || '%)'"),
    ("ns < 40 AND as_ < 40", "ALTERNATE_BRAND_NAME", "'Alternate DBA / Trade Name (Name Sim: ' || round(ns, 1) || '%, Addr Sim: ' || round(as_, 1) || '%)'"),
]
_WORDED = f"worded AS (SELECT *, {_CORE('n1')} AS w1, {_CORE('n2')} AS w2 FROM sims)"
_LOST_CATEGORY = _ladder([(c, k) for c, k, _ in _LOST], "NO_BLOCKING_RULE_HIT")
ORACLE_SQL["lost_failure_modes"] = O.sql(f"SELECT {_LOST_CATEGORY} AS category, count(*) AS n FROM worded GROUP BY 1", *_KEYS, _SHARED_KEYS, _TRUE, *_SIMS, _WORDED)


@query(
    O.sql(
        f"SELECT s1_id, noisy_id, {_LOST_CATEGORY} AS category, CASE " + " ".join(f"WHEN {c} THEN {r}" for c, _, r in _LOST) + " ELSE 'No shared blocking key generated (Name Sim: ' || round(ns, 1) || '%, Addr Sim: ' || round(as_, 1) || '%)' END AS reason FROM worded",
        *_KEYS, _SHARED_KEYS, _TRUE, *_SIMS, _WORDED,
    )
)
def lost_failure_reasons(spark, sf_dir):
    return Q.TX.lost_failure(Q.TX.with_ratios(Q.true_pairs(spark, sf_dir))).select("s1_id", "noisy_id", "category", "reason")


_PLAIN = lambda c: f"list_filter({O.toks(O.punct(c))}, lambda t: t NOT IN ({O.words(V.STOPWORDS)}))"
ORACLE_SQL["hard_negative_causes"] = O.sql(
    "SELECT " + _ladder(
        [
            (f"len(list_filter(sn, lambda t: t IN ({O.words(V.GENERIC_NAME_TOKENS)}))) > 0", "GENERIC_NAME_TOKEN"),
            (f"len(list_filter(sa, lambda t: t IN ({O.words(V.STREET_TOKENS)}))) > 0", "SHARED_STREET_OR_ADDRESS"),
            ("c1 = c2 AND len(sn) >= 1 AND len(sa) >= 1", "SHARED_NAME_AND_LOCATION_TOKENS"),
            ("len(sn) >= 1", "SHARED_STEM_OR_PREFIX"),
            ("c1 = c2", "SAME_GEOGRAPHY_AND_GENERIC_KEY"),
        ],
        "WEAK_BUCKET_OVERLAP",
    ) + " AS category, count(*) AS n FROM met_words GROUP BY 1",
    O.met(CAP), Q._RANKS,
    f"wrong AS (SELECT r.s1_id, r.noisy_id, {_side('s', 1)}, {_side('p', 2)} FROM ranks r JOIN s1 s ON s.entity_id = r.s1_id JOIN pool p ON p.entity_id = r.noisy_id LEFT JOIN truth t ON t.s1_id = r.s1_id AND t.noisy_id = r.noisy_id WHERE rank <= 10 AND t.s1_id IS NULL)",
    f"met_words AS (SELECT c1, c2, list_intersect({_PLAIN('n1')}, {_PLAIN('n2')}) AS sn, list_intersect({_PLAIN('a1')}, {_PLAIN('a2')}) AS sa FROM wrong)",
)

# Training pairs

ORACLE_SQL["training_pairs"] = O.sql(
    "SELECT count(*) AS n_pairs, count_if(label = 1) AS n_positive, count_if(label = 0) AS n_negative, count_if(label = 0 AND hard) AS n_hard, count(DISTINCT s1_id) AS n_entities FROM labelled",
    O.met(CAP), Q._RANKED, Q._SAMPLED,
    "mine AS (SELECT DISTINCT t.s1_id, t.noisy_id FROM truth t JOIN entities USING (s1_id))",
    f"others AS (SELECT r.s1_id, r.noisy_id, lower({Q._CLEAN.format('s.business_name')}) AS n1, lower({Q._CLEAN.format('s.business_address')}) AS a1, lower({Q._CLEAN.format('p.business_name')}) AS n2, lower({Q._CLEAN.format('p.business_address')}) AS a2 "
    "FROM ranked r JOIN entities e ON e.s1_id = r.s1_id JOIN s1 s ON s.entity_id = r.s1_id JOIN pool p ON p.entity_id = r.noisy_id LEFT JOIN mine m ON m.s1_id = r.s1_id AND m.noisy_id = r.noisy_id WHERE rank <= 25 AND m.s1_id IS NULL)",
    f"rated AS (SELECT s1_id, noisy_id, {_both(chr(110) + '1 <> ' + chr(39) * 2 + ' AND n2 <> ' + chr(39) * 2, _ratio('n1', 'n2'), '100 * ')} AS nr, {_both('a1 <> ' + chr(39) * 2 + ' AND a2 <> ' + chr(39) * 2, _ratio('a1', 'a2'), '100 * ')} AS ar FROM others)",
    "placed AS (SELECT *, round(0.7 * greatest(nr, ar) + 0.15 * (nr + ar), 9) AS combined FROM rated)",
    "hardest AS (SELECT p.s1_id, nr >= 60 OR ar >= 65 OR combined >= 55 AS hard, row_number() OVER (PARTITION BY p.s1_id ORDER BY combined DESC, p.noisy_id) AS k, n_true FROM placed p JOIN (SELECT s1_id, count(*) AS n_true FROM mine GROUP BY 1) c ON c.s1_id = p.s1_id)",
    "labelled AS (SELECT s1_id, 1 AS label, false AS hard FROM mine UNION ALL SELECT s1_id, 0, hard FROM hardest WHERE k <= greatest(2, 4 * n_true))",
)


# Cheap scores of true pairs

_CHEAP_SIDE = lambda p: f"trim({O.punct(f'n{p}')}) AS p{p}, trim({O.punct(f'a{p}')}) AS q{p}"


def _cheap_sql(weights: tuple[float, ...]) -> str:
    wn, wa, wnj, waj, wnum, wc, we = weights
    both = lambda k: f"{k}1 <> '' AND {k}2 <> ''"
    return (
        f"{wn} * nr + {wa} * ar + {wnj} * {O.jaccard('t1', 't2')} + {waj} * {O.jaccard('u1', 'u2')} + {wnum} * {_flag('list_has_any(m1, m2)')} + {wc} * {_flag(both('c') + ' AND c1 = c2')} + {we} * {_flag(both('p') + ' AND p1 = p2')}"
    )


@query(
    O.sql(
        f"SELECT s1_id, noisy_id, round({_cheap_sql((0.35, 0.25, 0.15, 0.10, 0.05, 0.05, 0.05))}, 6) AS cheap_score, round({_cheap_sql((0.40, 0.25, 0.15, 0.10, 0.05, 0.05, 0.0))}, 6) AS micro_score FROM scored_sides",
        *_KEYS, _SHARED_KEYS, _TRUE,
        f"sides AS (SELECT *, {_CHEAP_SIDE(1)}, {_CHEAP_SIDE(2)} FROM true_pairs)",
        f"scored_sides AS (SELECT *, {O.toks('p1')} AS t1, {O.toks('p2')} AS t2, {O.toks('q1')} AS u1, {O.toks('q2')} AS u2, regexp_extract_all(q1, '\\b\\d+\\b') AS m1, regexp_extract_all(q2, '\\b\\d+\\b') AS m2, "
        f"{_both('p1 <> ' + chr(39) * 2 + ' AND p2 <> ' + chr(39) * 2, _ratio('p1', 'p2'))} AS nr, {_both('q1 <> ' + chr(39) * 2 + ' AND q2 <> ' + chr(39) * 2, _ratio('q1', 'q2'))} AS ar FROM sides)",
    )
)
def cheap_scores(spark, sf_dir):
    pairs = Q.true_pairs(spark, sf_dir).withColumns({f"{s}_{k}": T.trim(T.fast_punctuation(f"{s}_{k}")) for s in ("s1", "noisy") for k in ("name", "address")})
    for s in ("s1", "noisy"):
        pairs = pairs.withColumns({f"{s}_name_tokens": T.tokens(f"{s}_name"), f"{s}_address_tokens": T.tokens(f"{s}_address"), f"{s}_numbers": T.digit_tokens(f"{s}_address")})
    out = R.micro_score(R.cheap_score(pairs))
    return out.select("s1_id", "noisy_id", F.round("cheap_score", 6).alias("cheap_score"), F.round("micro_score", 6).alias("micro_score"))


# Submissions: the truth, with planted offences against each rule

_LINES = """listed AS (SELECT s1.entity_id, s1.pos, coalesce(string_agg(noisy_id, ',' ORDER BY noisy_id), '') AS ids FROM s1 LEFT JOIN truth ON s1_id = s1.entity_id GROUP BY ALL),
lines AS (SELECT entity_id AS s1_id, CASE pos % 50 WHEN 3 THEN 'S2-1,S2-1' WHEN 4 THEN 'S1-7' WHEN 5 THEN 'X9-1' WHEN 6 THEN 'S2-1, S3-2' WHEN 7 THEN 'S2-99999999' WHEN 9 THEN 'S2-12' ELSE ids END AS ids, CASE WHEN pos % 50 = 8 THEN 1 ELSE 2 END AS n_fields, pos % 50 = 2 AS twice
  FROM listed WHERE pos % 50 <> 1),
matches AS (SELECT s1_id, CASE WHEN n_fields = 1 OR ids = '' THEN [] ELSE string_split(ids, ',') END AS ids, n_fields FROM (SELECT * FROM lines UNION ALL SELECT * FROM lines WHERE twice UNION ALL SELECT 'S1-0', 'S2-2', 2, false)),
cands AS (SELECT entity_id AS s1_id, CASE WHEN ids = '' THEN [] WHEN pos % 70 = 0 THEN string_split(ids || ',' || ids, ',') ELSE string_split(ids, ',') END AS ids FROM listed),
each AS (SELECT s1_id, unnest(ids) AS id FROM matches),
inside AS (SELECT DISTINCT s1_id, unnest(ids) AS id FROM cands)"""
_RULES = [
    ("two fields per line", "error", "SELECT s1_id AS x FROM matches WHERE n_fields <> 2"),
    ("each record once", "error", "SELECT s1_id AS x FROM matches GROUP BY s1_id HAVING count(*) > 1"),
    ("no record is missing", "error", "SELECT entity_id AS x FROM s1 WHERE entity_id NOT IN (SELECT s1_id FROM matches)"),
    ("no unknown record", "error", "SELECT s1_id AS x FROM matches WHERE s1_id NOT IN (SELECT entity_id FROM s1)"),
    ("no id twice in a row", "error", "SELECT s1_id AS x FROM matches WHERE len(ids) <> len(list_distinct(ids))"),
    ("no S1 id as a match", "error", "SELECT id AS x FROM each WHERE starts_with(id, 'S1-')"),
    ("ids start with S2- or S3-", "error", "SELECT id AS x FROM each WHERE NOT regexp_matches(id, '^S[23]-')"),
    ("every id exists", "error", "SELECT id AS x FROM each WHERE id NOT IN (SELECT entity_id FROM pool)"),
    ("no candidate twice in a row", "error", "SELECT s1_id AS x FROM cands WHERE len(ids) <> len(list_distinct(ids))"),
    ("matches are candidates", "error", "SELECT s1_id || ':' || id AS x FROM each WHERE NOT EXISTS (SELECT 1 FROM inside i WHERE i.s1_id = each.s1_id AND i.id = each.id)"),
]


def _listed(spark, sf_dir) -> DataFrame:
    ids = table(spark, sf_dir, "truth").groupBy("s1_id").agg(F.sort_array(F.collect_list("noisy_id")).alias("ids"))
    joined = table(spark, sf_dir, "s1").select(F.col("entity_id").alias("s1_id"), "pos").join(ids, "s1_id", "left")
    return joined.withColumn("ids", F.coalesce(F.array_join("ids", ","), F.lit("")))


def submitted(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """The lines of a matches file and of a candidates file, headers included."""
    k, listed = F.col("pos") % 50, _listed(spark, sf_dir)
    planted = F.when(k == 3, "S2-1,S2-1").when(k == 4, "S1-7").when(k == 5, "X9-1").when(k == 6, "S2-1, S3-2").when(k == 7, "S2-99999999").when(k == 9, "S2-12").otherwise(F.col("ids"))
    line = F.when(k == 8, F.col("s1_id")).otherwise(F.concat_ws("\t", "s1_id", planted))
    rows = listed.where(k != 1).select(F.explode(F.when(k == 2, F.array(line, line)).otherwise(F.array(line))).alias("value"))
    extra = spark.createDataFrame([("\t".join(VA.MATCH_HEADER),), ("S1-0\tS2-2",)], "value string")
    again = F.when((F.col("pos") % 70 == 0) & (F.col("ids") != ""), F.concat_ws(",", "ids", "ids")).otherwise(F.col("ids"))
    candidates = listed.select(F.concat_ws("\t", "s1_id", again).alias("value"))
    header = spark.createDataFrame([("\t".join(VA.CANDIDATE_HEADER),)], "value string")
    return extra.unionByName(rows), header.unionByName(candidates)


def _parsed(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    lines, candidates = submitted(spark, sf_dir)
    return VA.parsed(lines), VA.parsed(candidates, VA.CANDIDATE_HEADER)


@query(O.sql(" UNION ALL ".join(f"SELECT '{name}' AS rule, '{severity}' AS severity, (SELECT count(*) FROM ({rows})) AS n, coalesce((SELECT string_agg(x, ' | ' ORDER BY x) FROM (SELECT DISTINCT x FROM ({rows}) ORDER BY x LIMIT 5)), '') AS examples" for name, severity, rows in _RULES), _LINES))
def submission_report(spark, sf_dir):
    matches, candidates = _parsed(spark, sf_dir)
    return VA.report(matches, table(spark, sf_dir, "s1"), table(spark, sf_dir, "pool"), candidates, strict_subset=True)


@query(O.sql("SELECT count(*) AS n_rows, count_if(len(ids) = 0) AS none, count_if(len(ids) = 1) AS one, count_if(len(ids) > 1) AS \"many\", sum(len(ids))::BIGINT AS n_matches FROM matches", _LINES))
def submission_coverage(spark, sf_dir):
    return VA.coverage(_parsed(spark, sf_dir)[0])


@query(O.sql("SELECT count(*) AS n_rows, count_if(len(ids) = 0) AS n_empty, count_if(len(ids) = 0) > 0 AND count_if(len(ids) = 0) < count(*) AS ok FROM matches", _LINES))
def submission_empties(spark, sf_dir):
    return VA.empties(_parsed(spark, sf_dir)[0])


@query(O.sql("SELECT l.pos, l.entity_id AS left_id, r.right_id FROM s1 l LEFT JOIN (SELECT pos, CASE WHEN pos % 97 = 0 THEN 'S1-0' ELSE entity_id END AS right_id FROM s1 WHERE pos % 89 <> 0) r ON r.pos = l.pos WHERE l.entity_id IS DISTINCT FROM r.right_id"))
def submission_order(spark, sf_dir):
    left = table(spark, sf_dir, "s1").select("pos", F.col("entity_id").alias("s1_id"))
    right = left.where("pos % 89 <> 0").withColumn("s1_id", F.when(F.col("pos") % 97 == 0, "S1-0").otherwise(F.col("s1_id")))
    return VA.same_order(left, right).select("pos", "left_id", "right_id")


@query(O.sql("SELECT entity_id AS source1_entity_id, coalesce(string_agg(noisy_id, ',' ORDER BY noisy_id), '') AS matched_entity_ids FROM s1 LEFT JOIN truth ON s1_id = entity_id GROUP BY entity_id"))
def submission_reformatted(spark, sf_dir):
    """A loosely written id list in the strict format."""
    loose = _listed(spark, sf_dir).select("s1_id", "pos", F.transform(F.split("ids", ","), lambda x: F.concat(F.lit(" "), x, F.lit(" "))).alias("matched_entity_ids"))
    return IO.reformatted(IO.submission(loose))


@query(O.sql("SELECT s1_id, noisy_id, source FROM truth"))
def truth_read_back(spark, sf_dir):
    """The links of a ground-truth table of comma-joined ids."""
    return IO.truth_pairs(IO.submission(_listed(spark, sf_dir).withColumn("matched_entity_ids", F.split("ids", ",")).drop("ids")))


# Metrics without credit for empty predictions; statistics of features

@query(
    O.sql(
        "SELECT count(*) AS n_entities, round(avg(CASE WHEN n_true = 0 THEN 0.0 ELSE p END), 6) AS macro_precision, round(avg(CASE WHEN n_true = 0 THEN 0.0 ELSE r END), 6) AS macro_recall, round(avg(CASE WHEN n_true = 0 THEN 0.0 ELSE f05 END), 6) AS macro_f05 FROM measured",
        O.met(CAP), Q._PROB, Q._PICKED, Q._COUNTS, Q._SCORES.format(src="counted"),
    )
)
def match_quality_without_credit(spark, sf_dir):
    counted = M.counts(table(spark, sf_dir, "s1"), table(spark, sf_dir, "truth"), Q.D.chosen(Q.scored(spark, sf_dir), 0.7))
    return M.summary(M.scores(counted, singleton_credit=False)).select("n_entities", "macro_precision", "macro_recall", "macro_f05")


_JVM = [n for n in FE.NAMES if n not in FE.KERNEL_FEATURES and not n.startswith("cross_")]


@query(
    f"WITH {O.CTES.strip()}, f AS ({ORACLE_SQL['features_serve']}), labelled AS (SELECT f.*, CASE WHEN t.s1_id IS NULL THEN 0 ELSE 1 END AS label FROM f LEFT JOIN truth t ON t.s1_id = f.s1_id AND t.noisy_id = f.noisy_id) "
    + " UNION ALL ".join(
        f"SELECT '{n}' AS feature, round(round(avg({n}), 6), 5) AS mean, round(round(stddev_samp({n}), 6), 5) AS std, min({n}) AS min, quantile_cont({n}, 0.5) AS p50, max({n}) AS max, "
        f"CASE WHEN stddev_samp({n}) > 0 AND stddev_samp(label) > 0 THEN round(round(covar_samp({n}, label) / (stddev_samp({n}) * stddev_samp(label)), 6), 5) END AS corr FROM labelled"
        for n in _JVM
    )
)
def feature_statistics(spark, sf_dir):
    """Mean, deviation, range and correlation with the label of the features without a kernel."""
    truth = table(spark, sf_dir, "truth").select("s1_id", "noisy_id", F.lit(1).alias("label"))
    pairs = B.first_k(Q.meetings(spark, sf_dir), 5).join(truth, ["s1_id", "noisy_id"], "left").na.fill(0, ["label"])
    out = FE.features(pairs, table(spark, sf_dir, "s1"), table(spark, sf_dir, "pool"), keep=("label",), kernels=False)
    found = FE.describe(out.select("label", *[F.round(n, 9).alias(n) for n in _JVM]), names=_JVM)
    # Values of six digits often end in 5: rounded as doubles, as the SQL does, and not as decimals.
    five = lambda c: (F.signum(c) * F.floor(F.abs(c) * 1e5 + 0.5) / 1e5).alias(c)
    return found.select("feature", five("mean"), five("std"), "min", "p50", "max", five("corr"))


@query(O.sql("SELECT s1_id, noisy_id, " + ", ".join(f"{'round(' + _ratio(a, b) + ', 6)'} AS {n}" for n, a, b in (("name_ratio", "ln1", "ln2"), ("name_sort_ratio", "sn1", "sn2"), ("address_ratio", "la1", "la2"))) + " FROM lowered", *_KEYS, _SHARED_KEYS, _TRUE, _SIMS[0]))
def similarity_kernels(spark, sf_dir):
    pairs = Q.true_pairs(spark, sf_dir)
    low = lambda c: F.lower(f"{c}")
    sims = {"name_ratio": ("ratio", "name"), "name_sort_ratio": ("token_sort_ratio", "name"), "address_ratio": ("ratio", "address")}
    return pairs.select("s1_id", "noisy_id", *[F.round(S.similarity(kind, low(f"s1_{k}"), low(f"noisy_{k}")), 6).alias(n) for n, (kind, k) in sims.items()])
