import random
import re
import time

from pyspark.sql import functions as F

from corefold.llm import licenses


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_base(text):
    words = words_of(text)
    places = [(i, label) for phrase, label in licenses.BASE.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute_fuzzy(text):
    """Labels of the notices that some run of words is within the allowed edits of."""
    words, out = words_of(text), set()
    for notice, label in licenses.NOTICES.items():
        k = licenses.edits_for(notice)
        for i in range(len(words)):
            for j in range(i + 1, min(len(words), i + 20) + 1):
                run = " ".join(words[i:j])
                if abs(len(run) - len(notice)) <= k and distance(run, notice) <= k:
                    out.add(label)
    return out


def test_base_and_fuzzy_match_brute_force(spark):
    rng = random.Random(11)
    pool = ["CC", "by", "cc-by", "BY", "General", "public", "license", "All", "rights", "reserved.", "é", "\x7f", "MIT", "x9", "{", "\n", "ünder", "the"]
    texts = [None, "", "   ", "cc by cc by", "CC BY-CC.BY, cc by", "all rights reserved all rights reserved"] + [" ".join(rng.choices(pool, k=rng.randint(1, 40))) for _ in range(60)]
    for notice in licenses.NOTICES:
        for edits in range(6):
            chars = list(notice)
            for _ in range(edits):
                at = rng.randrange(len(chars))
                chars[at : at + 1] = rng.choice([[], ["q"], [chars[at], "z"]])
            texts.append("before it " + "".join(chars).title() + " and after")
    texts.append("word " * 30000 + "Released under the MIT Licence.")
    docs = spark.createDataFrame(list(enumerate(texts)) + [(3, texts[3]), (None, "cc by")], "doc_id long, text string").selectExpr("*", "'k' AS labels_", "1 AS n_chars")
    got = licenses.scan(docs).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        text = "cc by" if r.doc_id is None else texts[r.doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_base(text)
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)
        if len(text or "") < 5000:
            assert {x for x in r.labels.split(",") if x} == brute_fuzzy(text) | {x for x in r.base_labels.split(",") if x}, text
        for m in r.matches:
            assert distance(" ".join(words_of(text)[m.first_word : m.end_word]), m.notice) == m.edits


def test_neighbouring_notices_are_each_found():
    for gap in ("", "x ", "and then "):
        cleaned, _ = licenses.clean(f"relesed under the mit license {gap}released under the mit license")
        assert [(m.label, m.edits, m.first_word) for m in licenses.fuzzy(cleaned)] == [("mit", 1, 0), ("mit", 0, 5 + len(gap.split()))]


def test_long_texts_take_linear_time(spark):
    texts = ["cc by " * 1_700_000, "filler words " * 700_000 + "all rights reserved", "relesed under the mit license " * 3000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    began = time.monotonic()
    got = {r.doc_id: r for r in licenses.scan(docs).select("doc_id", "n_base", "last_word", F.size("matches").alias("n")).collect()}
    assert (got[0].n_base, got[0].last_word) == (1_700_000, 3_399_998) and got[1].n_base == 1 and got[2].n == 3000
    assert time.monotonic() - began < 120


def test_empty_table(spark):
    assert licenses.scan(spark.createDataFrame([], "doc_id long, text string")).collect() == []
