"""Unequal words that every polynomial hash modulo 2**64 takes for equal (Thue-Morse) are told apart."""

import numpy as np

from corefold.llm import linededup, quality, substring, textvec


def morse(n):
    x = "a"
    while len(x) < n:
        x += x.translate(str.maketrans("ab", "ba"))
    return x, x.translate(str.maketrans("ab", "ba"))


def test_thue_morse_words_differ(spark):
    x, y = morse(1024)
    buf = np.frombuffer(f"{x} {y} {x}".encode(), np.uint8)
    w = textvec.words(buf, np.array([0, len(buf)]))
    assert len(set(w.hashes().tolist())) == 2 and w.ids().tolist()[0] == w.ids().tolist()[2] != w.ids().tolist()[1]
    words = [f"w{i}" for i in range(61)]
    rows = [(1, " ".join([*words[:30], x, *words[31:]])), (2, " ".join([*words[:30], y, *words[31:]])), (3, " ".join([*words[:30], x, *words[31:]]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in substring.dedup_table(docs).collect()} == {1: 0, 2: 0, 3: 61}
    lines = spark.createDataFrame([(1, f"{x} and eight more words to make a block"), (2, f"{y} and eight more words to make a block")], "doc_id long, text string")
    assert {r["__n_removed"] for r in linededup.dedup(lines).collect()} == {0}
    buf = np.frombuffer(f"{x}\n{y}\n{x}".encode(), np.uint8)
    assert quality.counts(textvec.words(buf, np.array([0, len(buf)])))["n_dup_lines"].tolist() == [1]


def test_sequences_of_words_differ_as_their_words_do():
    x, y = (np.array([ord(c) for c in s], np.uint64) for s in morse(64))
    assert textvec.runs(textvec.mix(x), 64)[0] != textvec.runs(textvec.mix(y), 64)[0]
    rng = np.random.default_rng(3)
    ids = rng.integers(0, 3, 5000).astype(np.uint64)
    for k in (1, 2, 3, 5, 10, 50):
        hashes = textvec.runs(textvec.mix(ids), k)
        seen = {}
        assert len(hashes) == len(ids) - k + 1
        for i, h in enumerate(hashes.tolist()):
            assert seen.setdefault(h, tuple(ids[i : i + k])) == tuple(ids[i : i + k])
        assert len(set(seen.values())) == len(seen)


def test_words_of_equal_hash_are_compared(monkeypatch):
    monkeypatch.setattr(textvec, "byte_hash", lambda buf, starts, ends, seed=0: np.zeros(len(starts), np.uint64))
    buf = np.frombuffer(b"a b a abcdefghi abcdefghj c b", np.uint8)
    assert textvec.words(buf, np.array([0, len(buf)])).ids().tolist() == [0, 1, 0, 2, 3, 4, 1]
