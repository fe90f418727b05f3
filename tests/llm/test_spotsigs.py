import hashlib
import random
import re
import unicodedata

import pytest

from corefold.llm import spotsigs


def words_of(text):
    out, now = [], ""
    for c in (text or "").lower():
        if unicodedata.category(c)[0] in "LMN":
            now += c
        else:
            out.append(now)
            now = ""
    return [w for w in [*out, now] if w]


def brute_set(text):
    words, out = words_of(text), set()
    content = [i for i, w in enumerate(words) if w not in spotsigs.ANCHORS]
    for i, w in enumerate(words):
        chain = [words[j] for j in content if j > i][: spotsigs.CHAIN]
        if w in spotsigs.ANCHORS and len(chain) == spotsigs.CHAIN:
            out.add((w, *chain))
    return out or {("whole", " ".join(words))}


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out = []
    for k, (d, t) in enumerate(rows):
        t, n = t or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(t) // 2
        e = t[: len(t) - half] + n[:half]
        a, b, c = brute_set(t), brute_set(e), brute_set(n)
        out.append((d, len(t), hashlib.sha256(e.encode()).hexdigest(), len(a & b) / len(a | b), len(a & c) / len(a | c)))
    return out


def corpus():
    rng = random.Random(4)
    pool = ["the", "of", "Der", "la", "que", "a"] + [f"word{i}" for i in range(30)] + ["Été", "naïve,", "x-ray", "日本", "😀"]
    texts = [None, "", " ", "the", "the word1", "the word1 word2", "lonely words", "the of a la word1 the word2 of", "the cat sat " * 4000]
    texts += [" ".join(rng.choices(pool, k=rng.randint(1, 120))) for _ in range(50)]
    texts += texts[20:30]
    rows = [(rng.choice([1, 3, 1000]) * 7 * i + 2, t) for i, t in enumerate(texts)]
    return rows + [rows[9], (rows[10][0], "the other one here"), (None, "the null id word"), (None, None), (-(10**15), "far the below all"), (10**17, "far above the rest")]


@pytest.mark.parametrize("rows_per_block", [1, 7, 2000])
def test_matches_brute_force(spark, monkeypatch, rows_per_block):
    monkeypatch.setattr(spotsigs.with_next, "__defaults__", (None, rows_per_block))
    monkeypatch.setattr(spotsigs, "MOST_CUTS", 20)
    rows = corpus()
    docs = spark.createDataFrame([(d, t, "x", 3) for d, t in rows], "doc_id long, text string, signatures string, block int")
    got = spotsigs.compared(docs).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted([(r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in got], key=key) == sorted(brute(rows), key=key)
    by_text = {}
    for r in got:
        by_text.setdefault(r.edited_sha256, set()).add(r.edited_fingerprint)
    assert all(len(x) == 1 for x in by_text.values())
    for r in got:
        assert (r.fingerprint == r.edited_fingerprint) == (r.near_edited == 1)


def test_one_row_and_empty_table(spark):
    one = spark.createDataFrame([(5, "the word1 word2 word3")], "doc_id long, text string")
    (r,) = spotsigs.compared(one).collect()
    assert (r.doc_id, r.near_next) == (5, 1.0)
    assert spotsigs.compared(one.limit(0)).collect() == []


def test_search_finds_all_that_are_alike(spark):
    rng = random.Random(9)
    pool = ["the", "of", "la"] + [f"w{i}" for i in range(40)]
    rows = []
    for i in range(12):
        base = rng.choices(pool, k=rng.randint(30, 300))
        for j in range(6):
            words = list(base)
            for _ in range(rng.choice([0, 1, 2, 12])):
                words[rng.randrange(len(words))] = rng.choice(pool)
            rows.append((10 * i + j, " ".join(words[: len(words) - rng.choice([0, 0, 9])])))
    rows += [(500, None), (501, ""), (502, "lonely"), (503, "lonely"), (None, rows[0][1]), rows[3]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    queries = docs.where("doc_id % 5 = 0 OR doc_id > 499")
    got = {(r.query_id, r.doc_id): r.likeness for r in spotsigs.similar(queries, docs).collect()}
    sets = {d: brute_set(t) for d, t in rows if d is not None}
    want = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a in sets if a % 5 == 0 or a > 499 for b in sets}
    assert got == {k: v for k, v in want.items() if v >= 0.8} and len(got) > 40


def test_threshold_of_one_finds_equal_sets(spark):
    rows = [(1, "the quick fox and the lazy dog of old"), (2, "the quick fox and the lazy dog of old"), (3, "a slow cat in the sun"), (4, ""), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.query_id, r.doc_id) for r in spotsigs.similar(docs, docs, 1.0).collect()}
    assert got == {(1, 1), (1, 2), (2, 1), (2, 2), (3, 3), (4, 4), (4, 5), (5, 4), (5, 5)}
