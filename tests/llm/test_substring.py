import random
import re
import uuid

import pytest

from corefold.llm import scratch, substring


def brute(rows):
    """(doc_id, n_words, n_removed, kept text) of each row."""
    split = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    low = {}
    for d, words in split:
        for i in range(len(words) - 49):
            if d is not None:
                key = tuple(words[i : i + 50])
                low[key] = min(low.get(key, d), d)
    out = []
    for d, words in split:
        gone = set()
        for i in range(len(words) - 49):
            if d is not None and low[tuple(words[i : i + 50])] < d:
                gone.update(range(i, i + 50))
        out.append((d, len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return sorted(out, key=str)


def corpus():
    rng = random.Random(8)
    word = lambda: rng.choice(["ab", "é", "Ab", "x,", "zz", "q"]) + str(rng.randint(0, 400))
    passage = [[word() for _ in range(n)] for n in (49, 50, 51, 60, 90, 200)]
    texts = [None, "", " \n", "one", " ".join(passage[1]), "a " * 49, "a " * 50, "a " * 51, "b a " * 3000, "a b " * 2000]
    for _ in range(50):
        words = []
        for _ in range(rng.randint(1, 5)):
            p = rng.choice(passage)
            cut = rng.randint(0, 20)
            words += p[cut:] if rng.random() < 0.3 else p[: len(p) - cut] if rng.random() < 0.3 else p
            words += [word() for _ in range(rng.choice([0, 0, 1, 30]))]
        texts.append(rng.choice([" ", "\n", " \t"]).join(words))
    texts += texts[-6:] * 3
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    rows = list(zip(ids, texts))
    return rows + [rows[20], (rows[21][0], rows[22][1]), (None, rows[23][1]), (None, None)]


@pytest.mark.parametrize("batches", [1, 2, 3])
def test_matches_brute_force(spark, batches):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, 4, "x") for i, t in rows], "doc_id long, text string, at int, sig string")
    got = substring.dedup_table(docs, batches).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_batches_with_compaction_match_one_batch(spark, tmp_path):
    rows = [r for r in corpus() if r[0] is not None]
    docs = spark.createDataFrame(rows, "doc_id long, text string").cache()
    index = substring.Index(spark, f"{scratch.shared_dir(spark)}/{tmp_path.name}-{uuid.uuid4().hex}")
    got = []
    for low, high in ((0, 15), (15, 30), (30, 50), (50, 99)):
        got += substring.dedup(docs.where(f"doc_id >= {low} AND doc_id < {high}"), index, docs.where(f"doc_id < {high}")).collect()
        if low == 15:
            before = index.read().count()
            index.compact()
            assert len(index.runs) == 1 and 0 < index.read().count() <= before
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_empty_table(spark):
    assert substring.dedup_table(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_workers_get_few_texts_at_a_time(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10_000)
    try:
        docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
        assert [r.n_words for r in substring.dedup_table(docs).orderBy("doc_id").collect()] == [2, 0]
        assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) == 2000
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
