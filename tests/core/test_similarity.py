import random

import pytest
from pyspark.sql import functions as F

from corefold.functions import similarity as S


def brute_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def pairs(n=400):
    rng = random.Random(3)
    words = ["new", "york", "mets", "é", "aab", "bab", "ü", "corp", "x"]
    text = lambda: " ".join(rng.choices(words, k=rng.randint(0, 5))) if rng.random() < 0.5 else "".join(rng.choices("abcé ", k=rng.randint(0, 14)))
    return [(text(), text()) for _ in range(n)]


def test_lcs_against_dynamic_programming():
    for a, b in pairs():
        assert S.lcs(a, b) == S.lcs(b, a) == brute_lcs(a, b)


def test_known_values():
    assert S.ratio("this is a test", "this is a test!") == pytest.approx(28 / 29)
    assert S.partial_ratio("this is a test", "this is a test!") == 1.0
    assert S.ratio("fuzzy wuzzy was a bear", "wuzzy fuzzy was a bear") == pytest.approx(0.9090909, abs=1e-6)
    assert S.token_sort_ratio("fuzzy wuzzy was a bear", "wuzzy fuzzy was a bear") == 1.0
    assert S.token_set_ratio("fuzzy was a bear", "fuzzy fuzzy was a bear") == 1.0
    assert S.token_set_ratio("", "a") == 0.0 and S.ratio("", "") == 1.0 and S.ratio("a", "") == 0.0


def test_partial_ratio_is_the_best_window():
    def windows(a, b):
        out = [S.ratio(a, b[i:j]) for i in range(len(b)) for j in range(i + 1, len(b) + 1) if j - i == len(a) or (j - i < len(a) and (i == 0 or j == len(b)))]
        return max(out, default=0.0)

    for a, b in pairs():
        if a and b:
            short, long = (a, b) if len(a) <= len(b) else (b, a)
            want = max(windows(short, long), windows(long, short)) if len(a) == len(b) else windows(short, long)
            assert S.partial_ratio(a, b) == pytest.approx(want), (a, b)


def test_token_set_ratio_from_its_definition():
    for a, b in pairs():
        x, y = set(a.split()), set(b.split())
        got = S.token_set_ratio(a, b)
        if not x or not y:
            assert got == 0
            continue
        both = " ".join(sorted(x & y))
        left, right = (both + " " + " ".join(sorted(s)) if both and s else both or " ".join(sorted(s)) for s in (x - y, y - x))
        if both and (not x - y or not y - x):
            assert got == 1
        else:
            parts = [S.ratio(left, right)] + ([S.ratio(both, left), S.ratio(both, right)] if both else [])
            assert got >= S.ratio(left, right) - 1e-12 or got == pytest.approx(max(parts))
            assert got == pytest.approx(max(parts), abs=0.2) and 0 <= got <= 1


def test_in_spark_and_sql(spark):
    rows = pairs(60)
    df = spark.createDataFrame(rows, "a string, b string")
    got = df.select("a", "b", S.similarity("ratio", F.col("a"), F.col("b")).alias("r"), F.expr(S.lcs_sql("a", "b")).alias("n")).collect()
    assert all(r.r == pytest.approx(S.ratio(r.a, r.b)) and r.n == S.lcs(r.a, r.b) for r in got)
    S.register(spark)
    assert spark.sql("SELECT token_sort_ratio('a b', 'b a') AS x, nfc('é') AS y").first() == (1.0, "é")
    both = F.array(F.lit("a"), F.lit("b"))
    one = spark.range(1).select(S.jaccard(both, F.array(F.lit("b"))).alias("j"), S.jaccard(both, F.array().cast("array<string>")).alias("e"), S.char_ngrams(F.lit("ab"), 3).alias("g"), S.containment(both, F.array(F.lit("b"))).alias("c")).first()
    assert tuple(one) == (0.5, 0.0, ["ab"], 1.0)
