import random

import numpy as np

import corpus_pipeline
from corefold.llm import jaccard


def sets(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def brute(rows):
    """Ids that stay: the smallest of each component."""
    rows = sorted(rows)
    found = [sets(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for j in range(len(rows)):
        for i in range(j):
            a, b = found[i], found[j]
            if a == b or len(a & b) >= 0.8 * len(a | b):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return {rows[i][0] for i in range(len(rows)) if parent[i] == i}


def corpus():
    rng = random.Random(8)
    words = lambda n: [f"w{rng.randint(0, 5000)}" for _ in range(n)]
    common = words(30)
    base = [words(rng.randint(20, 150)) + common * (rng.random() < 0.6) for _ in range(40)]
    texts = [None, "", " \n", "one", "ONE", "one two", "a b c d", "a b c d e", "a b c d e f"]
    for t in base:
        for _ in range(rng.randint(0, 6)):
            now = list(t)
            for _ in range(rng.randint(0, 3)):
                now[rng.randrange(len(now))] = words(1)[0]
            texts.append(" ".join(now).upper() if rng.random() < 0.2 else "\n".join(now))
    chain = words(100)
    for k in range(0, 40, 4):  # each alike the next, not the last
        texts.append(" ".join(words(k) + chain[k:]))
    texts += [" ".join(chain[k:]) for k in range(0, 60, 6)]
    ids = [5 * i + 1 for i in range(len(texts))]
    rng.shuffle(ids)
    return list(zip(ids, texts))


def test_near_stage_matches_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    assert {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()} == want
    assert len(want) < len(rows) - 60


def test_the_order_of_shingles_does_not_matter(spark, monkeypatch):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(jaccard, "OFTEN", 1)
    monkeypatch.setattr(jaccard, "SAMPLE", 1)
    assert {r.doc_id for r in jaccard.one_of_each(docs).collect()} == brute(rows)


def test_repeated_rows_null_ids_and_empty_tables(spark):
    long = " ".join(f"q{i}" for i in range(50))
    rows = [(3, long), (3, long), (7, long + " x"), (None, long), (None, "nobody has these words"), (None, "nobody has these words"), (9, ""), (4, None)]
    got = sorted(((r.doc_id, r.text) for r in jaccard.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == sorted([(3, long), (None, "nobody has these words"), (4, None)], key=str)
    assert jaccard.one_of_each(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_bits_differ_by_no_more_than_the_sets():
    rng = np.random.default_rng(4)
    for _ in range(50):
        pool = rng.integers(0, 2**64, 400, np.uint64)
        a, b = (np.unique(rng.choice(pool, rng.integers(1, 390), replace=False)) for _ in range(2))
        x, y = (jaccard.parities(np.zeros(len(v), np.int64), v, 1).view(np.uint64) for v in (a, b))
        assert len(x) == jaccard.BITS // 64 and np.bitwise_count(x ^ y).sum() <= len(np.setxor1d(a, b))


def test_wide_bits_differ_by_no_more_than_the_sets(spark):
    rng = np.random.default_rng(5)
    rows, want = [], []
    for _ in range(60):
        pool = rng.integers(0, 2**64, 4000, np.uint64)
        a = np.unique(rng.choice(pool, rng.integers(200, 3900), replace=False))
        b = np.unique(np.concatenate((a[: rng.integers(1, len(a))], rng.choice(pool, rng.integers(1, 3000)))))
        wide = [jaccard.wide_parities(np.zeros(len(v), np.int64), v, np.array([len(v)])) for v in (a, b)]
        assert all(len(x) == k[0] and (64 * k[0] >= 2 * len(v) or (2 * len(v) <= jaccard.BITS and not k[0])) for (k, x), v in zip(wide, (a, b)))
        rows.append([x.tolist() for _, x in wide])
        want.append(len(np.setxor1d(a, b)))
    got = spark.createDataFrame(rows, "widea array<long>, wideb array<long>").coalesce(1).select(jaccard._wide_differ().alias("d")).collect()
    assert all(r.d <= w for r, w in zip(got, want)) and sum(r.d > w / 3 for r, w in zip(got, want)) > 30
    assert spark.createDataFrame([(None, [1]), ([], [1]), ([3, 5], [6])], "widea array<long>, wideb array<long>").select(jaccard._wide_differ().alias("d")).collect() == [(0,), (0,), (0,)]


def test_long_sets_that_are_not_alike_are_not_intersected(spark, monkeypatch):
    rng = random.Random(3)
    shared = [f"w{rng.randint(0, 10**6)}" for _ in range(1500)]
    rows = [(i, " ".join([f"x{rng.randint(0, 10**6)}" for _ in range(1500)] + shared)) for i in range(6)]
    tried, table = [], jaccard.scratch.table
    monkeypatch.setattr(jaccard.scratch, "table", lambda df, label: (found := table(df, label), label == "near-pairs" and tried.append(found[0].count()))[0])
    assert len(jaccard.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()) == 6
    assert tried and sum(tried) == 0


def test_near_stage_goes_through_the_balls_of_simhash(spark, monkeypatch):
    rng = random.Random(4)
    text = [f"w{rng.randint(0, 10**6)}" for _ in range(3000)]
    rows = [(i, " ".join([*text[:-1], f"y{i}"])) for i in range(5)] + [(9, " ".join(reversed(text)))]
    found, pairs = [], jaccard.ball_pairs
    monkeypatch.setattr(jaccard, "ball_pairs", lambda base: (out := pairs(base), found.extend(out.collect()))[0])
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()) == [0, 9]
    assert len({x for r in found for x in (r.a, r.b)}) == 5 and all(r.a < r.b for r in found)
