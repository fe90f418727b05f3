import random
import re
from itertools import combinations

import numpy as np

from corefold.llm import linededup, queries

SPACES = " \t\n\v\f\r"


def longest_rising(values):
    """A longest rising run by quadratic programming; among equals the smallest last value, and so on backwards."""
    best, before = [], []
    for i, v in enumerate(values):
        below = [j for j in range(i) if values[j] < v]
        best.append(1 + max((best[j] for j in below), default=0))
        before.append(min((j for j in range(i) if best[j] == best[i] - 1), key=lambda j: values[j], default=None))
    if not values:
        return []
    out, i = [], min((i for i in range(len(values)) if best[i] == max(best)), key=lambda i: values[i])
    while i is not None:
        out.append(i)
        i = before[i] if best[i] > 1 else None
    return out[::-1]


def token_lists(rows):
    out = []
    for d, t in rows:
        seen, tokens = {}, []
        for line in (t or "").split("\n"):
            if line.strip(SPACES):
                bare = line.strip(SPACES)
                seen[bare] = seen.get(bare, 0) + 1
                tokens.append((bare, seen[bare]))
        out.append((d, t, tokens))
    return out


def brute(rows, least):
    """Kept texts. A line is aligned if a longest rising run has it: of the tokens that link a pair, or of all that it shares with any earlier document."""
    listed = token_lists(rows)
    earlier = sorted((x for x in listed if x[0] is not None), key=lambda x: x[0])
    holders = {}
    for d, t, tokens in earlier:
        for q, tok in enumerate(tokens):
            holders.setdefault(tok, []).append((d, q))
    out = []
    for d, t, tokens in listed:
        aligned = set()
        if d is not None:
            pairs = {}
            for p, tok in enumerate(tokens):
                for e, q in holders[tok]:
                    if e < d:
                        pairs.setdefault(("all", e), []).append((p, q))
                        if len(holders[tok]) <= linededup.RARE or e == holders[tok][0][0]:
                            pairs.setdefault(("linked", e), []).append((p, q))
            for common in pairs.values():
                aligned |= {common[i][0] for i in longest_rising([q for _, q in common])}
        gone, block = set(), []
        for p in [*sorted(aligned), None]:
            if block and p != block[-1] + 1:
                if sum(len(re.findall(r"[^\x20\x09-\x0D]+", tokens[i][0])) for i in block) >= least:
                    gone |= set(block)
                block = []
            if p is not None:
                block.append(p)
        kept, n, drop = [], 0, False
        for line in (t or "").split("\n"):
            if line.strip(SPACES):
                drop = n in gone
                n += 1
            if not drop:
                kept.append(line)
        out.append((d, None if t is None else "\n".join(kept), len(tokens), len(gone)))
    return sorted(out, key=str)


def corpus():
    rng = random.Random(12)
    line = lambda n: " ".join(rng.choice(["ab", "é", "Zz", "q,"]) + str(rng.randint(0, 999)) for _ in range(n))
    shared = [line(rng.choice([1, 2, 4, 9, 15])) for _ in range(30)]
    texts = [None, "", "\n\n", "one line", shared[3] * 1, "a b\n" * 3000 + "x", "\n".join(shared), "\n".join(reversed(shared))]
    for _ in range(60):
        at = rng.randrange(20)
        body = [line(rng.randint(1, 12)) for _ in range(rng.randint(0, 4))] + shared[at : at + rng.randint(1, 8)] + [line(3), "", " "] + rng.choices(shared, k=rng.randint(0, 3))
        texts.append("\n".join(b if rng.random() < 0.8 else f"  {b}\t" for b in body))
    texts += [texts[20]] * 4 + ["a b\n" * 2000]
    ids = [3 * i for i in range(len(texts))]
    rng.shuffle(ids)
    return list(zip(ids, texts))


def test_matches_brute_force(spark):
    rows = corpus()
    extra = rows + [(None, rows[9][1]), (None, None)]
    docs = spark.createDataFrame([(d, t, 1, "h") for d, t in extra], "doc_id long, text string, at int, home string")
    out = linededup.dedup(docs)
    assert out.columns == ["doc_id", "text", "at", "home", "__n_lines", "__n_removed"]
    got = sorted(((r.doc_id, r.text, r["__n_lines"], r["__n_removed"]) for r in out.collect()), key=str)
    assert got == brute(extra, linededup.MIN_BLOCK_WORDS)
    assert sum(g[3] for g in got) > 50


def test_repeated_rows_keep_each_other(spark):
    text = "a line of more than eight words that stands here\nand one more"
    docs = spark.createDataFrame([(5, text), (5, text), (9, text)], "doc_id long, text string")
    assert sorted((r.doc_id, r.text) for r in linededup.dedup(docs).collect()) == [(5, text), (5, text), (9, "")]


def test_rising_is_longest_on_all_small_inputs():
    for n in range(7):
        for values in combinations(range(8), n):
            mixed = [v * 5 % 8 for v in values]
            assert linededup.rising(np.array(mixed)) == longest_rising(mixed)


def test_copies_go_whole_whatever_order_earlier_documents_have(spark, tmp_path):
    lines = [f"line {i} of this passage has as many as twelve words in all {i}" for i in range(10)]
    texts = [(1, "\n".join(reversed(lines))), (2, "\n".join(lines)), (3, "\n".join(lines)), (4, "\n".join(lines[5:] + lines[:5]))]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.n_removed for r in queries.op7_lines(spark, str(tmp_path)).collect()}
    assert got[1] == 0 and got[3] == 10 and got[2] == 1
    assert got == {d: n for d, _, _, n in brute(texts, linededup.MIN_BLOCK_WORDS)}


def test_frequent_and_scrambled_lines_in_several_rounds(spark, monkeypatch):
    monkeypatch.setattr(linededup, "HOLDERS", 2)
    rng = random.Random(5)
    lines = [f"w{i} x{i} y{i}" * rng.choice([1, 2, 4]) for i in range(12)]
    rows = [(i, "\n".join(rng.sample(lines, rng.randint(1, 9)))) for i in range(60)]
    docs = spark.createDataFrame([*rows, (None, rows[9][1])], "doc_id long, text string")
    got = sorted(((r.doc_id, r.text, r["__n_lines"], r["__n_removed"]) for r in linededup.dedup(docs).collect() if r.doc_id is not None), key=str)
    assert got == brute(rows, linededup.MIN_BLOCK_WORDS)


def test_columns_with_clashing_names_stay(spark):
    names = ["__packed", "__gone", "__key", "__text_key", "__doc_id", "n_lines", "row", "gone", "packed", "key"]
    docs = spark.createDataFrame([(1, "a b", *range(10)), (2, "c d", *range(10))], "doc_id long, text string, " + ", ".join(f"{n} int" for n in names))
    out = linededup.dedup(docs, counts=("n_lines_", "n_removed_"))
    assert out.columns == [*docs.columns, "n_lines_", "n_removed_"] and sorted(tuple(r)[2:12] for r in out.collect()) == [tuple(range(10))] * 2


def test_empty_table(spark):
    assert linededup.dedup(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_texts_meet_their_deletions_by_one_plan_at_every_size(spark):
    docs = spark.createDataFrame([(i, "one two three four five six seven eight nine") for i in range(3)], "doc_id long, text string")
    out = linededup.dedup(docs)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert [r.text == "" for r in out.orderBy("doc_id").collect()] == [False, True, True]
