import random
from collections import Counter
from functools import cache

import pytest
from pyspark.sql import functions as F

from corefold.llm import packing


def least_padding(lengths, counts, buckets):
    @cache
    def best(j, k):
        if j == 0:
            return 0
        if k == 0:
            return float("inf")
        return min(best(i, k - 1) + sum((lengths[j - 1] - lengths[x]) * counts[x] for x in range(i, j)) for i in range(j))

    return best(len(lengths), buckets)


@pytest.mark.parametrize("seed", range(25))
def test_bounds_need_the_least_padding(seed):
    rng = random.Random(seed)
    lengths = sorted(rng.sample(range(1, 400), rng.randint(1, 25)))
    counts = [rng.choice([1, 2, 50, 1000]) for _ in lengths]
    for k in (1, 2, 3, 5, 40):
        found = packing.bounds(lengths, counts, k)
        assert len(found) <= k and found[-1] == lengths[-1] and set(found) <= set(lengths)
        padding = sum((next(b for b in found if b >= n) - n) * c for n, c in zip(lengths, counts))
        assert padding == least_padding(tuple(lengths), tuple(counts), k)


def test_every_token_is_in_one_full_batch(spark):
    rng = random.Random(1)
    texts = [None, "", " \n", "one", "w " * 250, "w " * 100, "w " * 101] + ["w " * int(rng.expovariate(1 / 40)) for _ in range(400)]
    rows = [(i, t, "x", 7) for i, t in enumerate(texts)] + [(6, texts[6], "x", 7), (None, "a b", "x", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, bucket string, length int")
    cut = packing.pieces(docs, packing.words(), 100)
    got = packing.pack(cut, 100, 5, rows_per_block=10).collect()
    lengths = Counter()
    for r in got:
        assert 0 <= r.length <= r.bucket <= 100 and r.padding == r.bucket - r.length and r.first_token == 100 * r.piece
        lengths[r.doc_id] += r.length
    want = Counter()
    for d, t, *_ in rows:
        want[d] += len((t or "").split())
    assert lengths == want and len(got) == sum(max(1, -(-len((t or "").split()) // 100)) for _, t, *_ in rows)
    batches = Counter((r.bucket, r.batch) for r in got if r.bucket)
    for (bucket, batch), n in batches.items():
        last = max(b for k, b in batches if k == bucket)
        assert n == 100 // bucket or batch == last and n <= 100 // bucket
    histogram = Counter(r.length for r in got if r.length)
    sizes = sorted(histogram)
    assert sum(r.padding for r in got) == least_padding(tuple(sizes), tuple(histogram[s] for s in sizes), 5)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert packing.packed(empty).collect() == []
    assert packing.packed(empty).columns == ["doc_id", "piece", "first_token", "length", "bucket", "batch", "padding"]
