import random
import re

import xxhash

from corefold.llm import graph, simhash


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, fps):
    parent = {i: i for i in range(len(ids))}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                parent[root(i)] = root(j)
    best = {}
    for i, d in enumerate(ids):
        r = root(i)
        if d is not None:
            best[r] = min(best.get(r, d), d)
    return [best.get(root(i)) for i in range(len(ids))]


def test_near_duplicates_match_brute_force(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "ÇA", "A b", "Zürich"]
    base = [" ".join(rng.choices(vocabulary, k=rng.randint(100, 400))) for _ in range(20)]
    texts = [None, "", "  \t\n", "one", "ONE", "one two", "One  two\x0b", "a b c", "x " * 20000] + base
    for t in base[:12]:
        for _ in range(6):
            words = t.split(" ")
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            texts.append("\t".join(words))
    rows = [(i * 7 % 1009 + 3, t) for i, t in enumerate(texts)]
    rows += [rows[15], rows[15], (None, texts[15]), (None, "all alone here")]
    docs = spark.createDataFrame([(i, t, "fp", "s", 7) for i, t in rows], "doc_id long, text string, fingerprint string, rep string, component_id int")
    got = simhash.near_duplicates(docs).collect()
    fps = [brute_fingerprint(t) for _, t in rows]
    want = sorted(((i, f"{f:016x}", c) for (i, _), f, c in zip(rows, fps, brute_components([i for i, _ in rows], fps))), key=str)
    assert sorted((tuple(r) for r in got), key=str) == want


def test_empty_table(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_components_of_chains_stars_and_cycles(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 160)] + [(1000, 1000 + i) for i in range(1, 300)] + [(rng.randint(2000, 2100), rng.randint(2000, 2100)) for _ in range(120)]
    rng.shuffle(edges)
    got = {r.node: r.component for r in graph.components(spark.createDataFrame([(b, a) if rng.random() < 0.5 else (a, b) for a, b in edges], "a long, b long")).collect()}
    parent = {}

    def root(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    low = {}
    for i in list(parent):
        low[root(i)] = min(low.get(root(i), i), i)
    assert got == {i: low[root(i)] for a, b in edges for i in (a, b) if a != b}
