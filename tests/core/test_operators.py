"""Operators against plain Python on small tables."""

import random

import pytest
from pyspark.sql import functions as F

from corefold.functions import similarity as S
from corefold.operators import blocking as B
from corefold.operators import decision as D
from corefold.operators import features as FE
from corefold.operators import keys as K
from corefold.operators import metrics as M
from corefold.operators import pairs as P
from corefold.operators import profile as PR
from corefold.operators import taxonomy as TX
from corefold.operators import validate as V

RECORD = "entity_id string, business_name string, business_address string, country string, pos long"


def keys_of(spark, name, address=None, country="US", variant="serve"):
    df = spark.createDataFrame([("S1-1", name, address, country, 0)], RECORD)
    return K.with_keys(df, variant).first()["keys"]


def test_keys_by_hand(spark):
    assert keys_of(spark, "Blue Blue Inc", "12 Main Street, 12345") == ["US|alpha:blueblueinc", "US|pfx6:bluebl", "US|pfx8:blueblue", "US|tok:blue", "US|tok:blue", "US|2tok:blue_blue", "US|anum:12_main"]
    assert keys_of(spark, "abc") == [] and keys_of(spark, "abcd", country=None) == ["GLOBAL|alpha:abcd", "GLOBAL|tok:abcd"]
    assert keys_of(spark, "Services Group", country="<MISSING>")[-1] == "GLOBAL|tok:services" or "GLOBAL|tok:services" not in keys_of(spark, "Services Group", country="<MISSING>")
    assert keys_of(spark, "12345 7777") == ["US|alpha:123457777", "US|pfx6:123457", "US|pfx8:12345777", "US|2tok:12345_7777"]
    assert "US|dom6:foobar" in keys_of(spark, "foobar.com") and "US|tok:foobar" in keys_of(spark, "foobar.com", variant="train")
    train = keys_of(spark, "Blue Blue", "12 Main Street 12345", variant="train")
    assert "US|zip:12345" in train and len(train) == len(set(train))
    assert keys_of(spark, "null", "none", variant="train") == [] and keys_of(spark, "null") != []


def test_pruning_at_the_cap(spark):
    rows = [(f"S2-{i}", i, 0, "k299") for i in range(299)] + [(f"S2-{i}", i, 0, "k300") for i in range(300)] + [(f"S2-{i}", i, 0, "k500") for i in range(500)] + [(f"S2-{i}", i, 0, "k501") for i in range(501)]
    posted = spark.createDataFrame(rows, "entity_id string, pos long, key_pos int, block_key string")
    assert {r.block_key for r in B.active_keys(posted, 300).collect()} == {"k299"}
    assert {r.block_key for r in B.active_keys(posted, 500, "train").collect()} == {"k299", "k300", "k500"}


def test_features_by_hand(spark):
    rows = [("a", "International Business Machines", "1 Main Street, Austin 73301", "US", 0), ("b", "IBM", "1 Main St Austin 73301", "us", 1), ("c", "ibm", "", None, 2)]
    df = spark.createDataFrame(rows, RECORD)
    pairs = spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "c")], "s1_id string, noisy_id string")
    serve = {(r.s1_id, r.noisy_id): r for r in FE.features(pairs, df, df).collect()}
    train = {(r.s1_id, r.noisy_id): r for r in FE.features(pairs, df, df, "train").collect()}
    assert list(serve["a", "b"].asDict())[2:] == FE.NAMES and len(FE.NAMES) == 44 and len(FE.KERNEL_FEATURES) == 9
    ab = serve["a", "b"]
    assert ab.name_acronym_match == 1 and ab.addr_std_sorted_exact == 1 and ab.addr_zip_match == 1 and ab.country_exact_match == 1
    assert ab.name_fuzz_ratio == pytest.approx(S.ratio("international business machines", "ibm"))
    assert ab.cross_name_addr_prod == pytest.approx(ab.name_token_sort_ratio * ab.addr_char_3gram_jaccard)
    bc = serve["b", "c"]
    assert bc.name_exact_match == 0 and bc.name_clean_exact == 1 and bc.addr_is_missing == 1 and bc.addr_len_diff == 22 and bc.country_is_missing == 1
    assert train["b", "c"].addr_len_diff == 0 and train["a", "c"].addr_number_match == 0 and train["a", "b"].addr_number_match == 1
    assert train["a", "b"].cross_name_addr_prod == pytest.approx(train["a", "b"].name_fuzz_ratio * train["a", "b"].addr_fuzz_ratio)
    assert all(0 <= v <= 1 for r in serve.values() for k, v in r.asDict().items() if k.endswith(("ratio", "jaccard", "containment")))


def scenario(spark):
    s1 = spark.createDataFrame([(f"S1-{i}", "n", "a", "US", i) for i in range(6)], RECORD)
    truth = spark.createDataFrame([("S1-0", "S2-1"), ("S1-0", "S3-1"), ("S1-1", "S2-2"), ("S1-2", "S2-3"), ("S1-5", "S2-9")], "s1_id string, noisy_id string")
    scored = spark.createDataFrame(
        [("S1-0", "S2-1", 0.9, 0), ("S1-0", "S3-1", 0.7, 0), ("S1-0", "S2-7", 0.7, 0), ("S1-0", "S2-1", 0.2, 0), ("S1-1", "S2-2", 0.75, 1), ("S1-2", "S2-8", 0.8, 0), ("S1-3", "S2-8", 0.72, 0), ("S1-5", "S2-9", 0.71, 0), ("S1-5", "S2-8", 0.3, 0)],
        "s1_id string, noisy_id string, prob double, addr_num_exact_mismatch int",
    )
    return s1, truth, scored


def test_decisions(spark):
    s1, _, scored = scenario(spark)
    got = {r.s1_id: r.matched_entity_ids for r in D.ordered(s1, D.chosen(scored, 0.7)).collect()}
    assert got == {"S1-0": ["S2-1", "S2-7", "S3-1"], "S1-1": ["S2-2"], "S1-2": ["S2-8"], "S1-3": ["S2-8"], "S1-4": [], "S1-5": ["S2-9"]}
    ruled = {(r.s1_id, r.noisy_id) for r in D.chosen_with_rules(scored, 0.74).collect()}
    assert ruled == {("S1-0", "S2-1"), ("S1-2", "S2-8"), ("S1-3", "S2-8"), ("S1-5", "S2-9")}


def plain_scores(true, pred):
    if not true:
        p = 1.0 if not pred else 0.0
        return p, p, p
    if not pred:
        return 0.0, 0.0, 0.0
    tp = len(true & pred)
    p, r = tp / len(pred), tp / len(true)
    return p, r, 1.25 * p * r / (0.25 * p + r) if tp else 0.0


def test_metrics_and_sweep(spark):
    s1, truth, scored = scenario(spark)
    rng = random.Random(1)
    scored = scored.unionByName(spark.createDataFrame([(f"S1-{rng.randint(0, 5)}", f"S2-{rng.randint(1, 9)}", round(rng.random(), 3), 0) for _ in range(40)], scored.schema))
    best, true = {}, {}
    for r in scored.collect():
        best[r.s1_id, r.noisy_id] = max(r.prob, best.get((r.s1_id, r.noisy_id), 0))
    for r in truth.collect():
        true.setdefault(r.s1_id, set()).add(r.noisy_id)
    swept = {r.threshold: r for r in M.sweep(s1, truth, scored).collect()}
    assert len(swept) == 91
    for t in (0.05, 0.3, 0.57, 0.7, 0.95):
        each = [plain_scores(true.get(f"S1-{i}", set()), {n for (s, n), p in best.items() if s == f"S1-{i}" and p >= t}) for i in range(6)]
        want = [sum(x[k] for x in each) / 6 for k in range(3)]
        assert [swept[t].macro_precision, swept[t].macro_recall, swept[t].macro_f05] == pytest.approx(want, abs=1e-6)
        row = M.summary(M.scores(M.counts(s1, truth, D.chosen(scored, t)))).first()
        assert (row.macro_f05, row.tp, row.fp, row.fn) == (swept[t].macro_f05, swept[t].tp, swept[t].fp, swept[t].fn)
    top = max(r.macro_f05 for r in swept.values())
    assert M.best_threshold(M.sweep(s1, truth, scored)) == min(t for t, r in swept.items() if r.macro_f05 == top)
    cohorts = {r.cohort: r for r in M.cohorts(M.scores(M.counts(s1, truth, D.chosen(scored, 0.7)))).collect()}
    assert sum(r.n_entities for r in cohorts.values()) == 6 and cohorts["0"].n_entities == 2


def test_training_pairs(spark):
    rng = random.Random(2)
    name = lambda i: f"Company {i} {rng.choice('abc')}"
    s1 = spark.createDataFrame([(f"S1-{i}", name(i), f"{i} Road", "US", i) for i in range(20)], RECORD)
    pool = spark.createDataFrame([(f"S2-{i}", name(i), f"{i} Rd", "US", i) for i in range(60)], RECORD)
    truth = spark.createDataFrame([(f"S1-{i}", f"S2-{i}") for i in range(15)] + [("S1-0", "S2-59"), ("S1-1", "S2-404")], "s1_id string, noisy_id string")
    candidates = spark.createDataFrame([(f"S1-{i}", f"S2-{j}") for i in range(20) for j in range(60) if (i + j) % 3], "s1_id string, noisy_id string")
    entities = P.split(P.sampled(truth, 10))
    assert entities.count() == 10 and entities.where("is_validation").join(entities.where("NOT is_validation"), "s1_id").count() == 0
    got = P.labelled(entities, truth, candidates, s1, pool).collect()
    chosen = {r.s1_id for r in entities.collect()}
    assert {r.s1_id for r in got} == chosen
    for s in chosen:
        n_true = sum(1 for a, b in truth.collect() if a == s)
        assert sum(1 for r in got if r.s1_id == s and r.label == 0) == max(2, 4 * n_true)
        for r in got:
            if r.s1_id == s and r.label == 0:
                n, a = 100 * S.ratio(r.s1_name.lower(), r.noisy_name.lower()), 100 * S.ratio(r.s1_address.lower(), r.noisy_address.lower())
                assert r.is_hard_negative == int(n >= 60 or a >= 65 or 0.7 * max(n, a) + 0.15 * (n + a) >= 55)


SIDES = "s1_name string, s1_address string, s1_country string, noisy_name string, noisy_address string, noisy_country string"


def test_taxonomies(spark):
    def of(f, rows, extra=""):
        df = spark.createDataFrame(rows, SIDES + extra)
        return [r.category for r in f(df).collect()]

    us = ("US",)
    rank = lambda a, b, c, d, country="US", n=5, k=3: (a, b, country, c, d, country, n, k)
    got = of(
        TX.rank_failure,
        [
            rank("A", "x", "", "y"), rank("Indian Ace Global", "x", "ia", "y"), rank("Blue Tools", "x", "Tools Blue", "y"), rank("Shree Poornima", "x1", "Sri Purnima", "x1", "India"),
            rank("Zeta", "1 Oak St", "Omega", "1 Oak Street"), rank("Brightly", "x", "Brightlyy", "y"), rank("Care Home Quartz", "a b", "Lumber Yard", "c d", n=80, k=1), rank("Red Fox Den", "a", "Red Fox Den Yard", "b"),
            rank("Red Fox", "1 Elm Way", "Blue Hen", "1 Elm Way"), rank("Red Fox", "1 Elm Way", "Blue Hen", "9 Ash Row"), rank("Red Fox Hut", "q", "Red Fox Pen", "p"),
        ],
        ", total_candidates int, n_shared_keys int",
    )
    assert got == ["MISSING_FIELD", "ACRONYM_INITIALISM", "TOKEN_ORDER", "TRANSLITERATION_OR_NON_LATIN", "ABBREVIATION", "TYPO_OR_CHARACTER_PERTURBATION", "GENERIC_KEY_POLLUTION", "ADDRESS_SIMILARITY_FAILURE", "ALTERNATE_DBA_NAME", "NAME_SIMILARITY_FAILURE", "OTHER"]
    hard = of(TX.hard_negative, [("Fox Trading", "a", "US", "Hen Trading", "b", "US"), ("Fox", "1 Oak Nagar", "US", "Hen", "2 Elm Nagar", "US"), ("Fox Den", "Oak", "US", "Fox Hut", "Oak", "US"), ("Fox", "a", "US", "Fox", "b", "India"), ("Fox", "q", "US", "Hen", "p", "US"), ("Fox", "q", "US", "Hen", "p", "India")])
    assert hard[1:] == ["SHARED_STREET_OR_ADDRESS", "SHARED_NAME_AND_LOCATION_TOKENS", "SHARED_STEM_OR_PREFIX", "SAME_GEOGRAPHY_AND_GENERIC_KEY", "WEAK_BUCKET_OVERLAP"]
    loss = of(lambda d: TX.lost_failure(TX.with_ratios(d)), [("a", "b", "US", "a", "b", "US", 1), ("", "b", "US", "a", "b", "US", 0), ("Müller", "b", "US", "Muller", "b", "US", 0), ("zebra quick moth", "x", "US", "moth quick zebra", "x", "US", 0), ("Abcdefgh", "x", "US", "Abcdefgi", "y", "US", 0), ("Qqqq", "1 Oak Street", "US", "Zzzz", "1 Oak Stret", "US", 0), ("Qqqq", "wwww", "US", "Zzzz", "vvvv", "US", 0)], ", n_shared_keys int")
    assert loss == ["OTHER", "MISSING_FIELD", "NON_LATIN_OR_TRANSLITERATION", "TOKEN_ORDER", "NAME_VARIATION", "ADDRESS_VARIATION", "ALTERNATE_BRAND_NAME"]
    causes = of(lambda d: TX.error_cause(d, 0.83), [("a", "b", "US", "a", "b", "US", 1, 0.7), ("Acme Foo", "1 Oak", "US", "af", "1 Oak", "US", 1, 0.1), ("Fox Den", "11 Elm", "US", "Den Fox", "zz", "US", 0, 0.9)], ", label int, prob double")
    assert causes[0].startswith("Threshold") and causes[1].startswith("Name Acronym") and causes[2].startswith("Same-Name")
    assert us == ("US",)


def test_forensics(spark):
    rows = [("Acme Inc", "1 Main Street", "ACME INC", "1 Main St"), ("Acme", "a", "Acme", ""), ("A-B", "12 x, california 12345", "A B", "12 x ca 12345"), ("Blue Fox", "a", "Fox Blue", "a"), ("Foo", "a", "foo.com", "b")]
    marked = PR.forensics(spark.createDataFrame(rows, "s1_name string, s1_address string, noisy_name string, noisy_address string")).collect()
    assert marked[0].name_case and marked[0].addr_abbreviation and marked[1].name_exact and marked[1].addr_missing
    assert marked[2].name_punctuation and marked[2].addr_state and marked[2].addr_zip_exact and marked[3].name_reordered and marked[4].name_domain
    counts = {r.kind: r.n for r in PR.forensic_counts(PR.forensics(spark.createDataFrame(rows, "s1_name string, s1_address string, noisy_name string, noisy_address string"))).collect()}
    assert counts["name_exact"] == 1 and len(counts) == len(PR.FORENSIC_FLAGS)


def report(spark, lines, candidates=None):
    s1 = spark.createDataFrame([(f"S1-{i}", "n", "a", "US", i) for i in range(1, 4)], RECORD)
    pool = spark.createDataFrame([(f"S2-{i}", "n", "a", "US", i) for i in range(1, 4)], RECORD)
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    listed = V.parsed(spark.createDataFrame([(x,) for x in candidates], "value string"), V.CANDIDATE_HEADER) if candidates else None
    return {r.rule: r for r in V.report(V.parsed(df), s1, pool, listed).collect()}


def test_validation_rules(spark):
    head = "source1_entity_id\tmatched_entity_ids"
    good = [head, "S1-1\tS2-1,S2-2", "S1-2\t", "S1-3\tS2-3"]
    wide = ["source1_entity_id\tcandidate_entity_ids", "S1-1\tS2-1,S2-2", "S1-2\tS2-1", "S1-3\tS2-3"]
    assert all(r.n == 0 for r in report(spark, good, wide).values())
    broken = {
        "two fields per line": ["S1-1"], "each record once": ["S1-1\tS2-1"], "no unknown record": ["S1-9\t"], "no id twice in a row": ["S1-1\tS2-1,S2-1"],
        "no S1 id as a match": ["S1-1\tS1-2"], "ids start with S2- or S3-": ["S1-1\tS2-1, S2-2"], "every id exists": ["S1-1\tS2-77"],
    }
    for rule, lines in broken.items():
        assert report(spark, good + lines)[rule].n > 0, rule
    assert report(spark, good[:-1])["no record is missing"].examples == "S1-3"
    outside = report(spark, good, [*wide[:-1], "S1-3\tS2-1,S2-1"])
    assert outside["matches are candidates"].n == 1 and outside["matches are candidates"].severity == "warning" and outside["no candidate twice in a row"].n == 1
    assert V.header_problem(head) is None and "commas" in V.header_problem("source1_entity_id,matched_entity_ids") and V.header_problem(None) and V.header_problem("x\ty")
    parsed = V.parsed(spark.createDataFrame([(x,) for x in good], "value string"))
    assert V.empties(parsed).first().ok and tuple(V.coverage(parsed).first()) == (3, 1, 1, 1, 3)
    a = spark.createDataFrame([(0, "a"), (1, "b")], "pos long, s1_id string")
    assert V.same_order(a, a).isEmpty() and V.same_order(a, a.where("pos = 0")).count() == 1


def test_profiles(spark):
    df = spark.createDataFrame([("S1-1", "a"), ("S1-1", "a"), ("S2-2", None)], "entity_id string, x string")
    rows = {r.column: r for r in PR.columns(df).collect()}
    assert (rows["x"].n_null, rows["x"].n_distinct, rows["x"].null_percent) == (1, 1, 33.3333)
    assert tuple(PR.duplicates(df, "entity_id").first()) == (1, 3, 1)
    assert PR.sample(df, "entity_id", 2).count() == 2
    raw = spark.createDataFrame([("S1-1", "S2-1, S2-1"), ("S1-2", "S2-1"), ("S1-3", None)], "source1_entity_id string, matched_entity_ids string")
    assert [r.source1_entity_id for r in PR.repeated_in_row(raw).collect()] == ["S1-1"]
    assert PR.prefix_anomalies(spark.createDataFrame([("S1-1", "X-1"), ("S1-1", "S3-1")], "s1_id string, noisy_id string")).count() == 1
    assert PR.script_pairs(spark.createDataFrame([("é", "e"), ("a", "b")], "s1_name string, noisy_name string")).first().n == 1
    told = FE.describe(spark.createDataFrame([(1.0, 2.0, 1), (0.0, 2.0, 0)], "name_exact_match double, name_clean_exact double, label int")).collect()
    assert told[0]["corr"] == 1.0 and told[1]["corr"] is None and told[0].p50 == 0.5
    counted = spark.createDataFrame([(str(i), i) for i in (0, 10, 11, 600)], "s1_id string, n long")
    assert {r.bin for r in PR.candidate_bins(counted).collect()} == {"0-10", "11-25", "500+"}
    assert F is not None
