import random
import re
from collections import Counter

import numpy as np

from corefold.llm import quality


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    repeat = len({i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)})
    failed = len(words) < 50 or 100 * repeat > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, repeat, failed


def corpus():
    rng = random.Random(2)
    clean = ["the", "reading", "of", "old", "maps", "été", "Straße", "is", "calm,", "and", "slow.", "rivers", "turn"]
    junk = ["BUY!!", "###", "$$$", "click|", "<<", "&&&", "NOW!!"]
    good = [" ".join(rng.choices(clean, k=rng.randint(60, 200))) for _ in range(120)]
    bad = [" ".join(rng.choices(junk + clean[:3], k=rng.randint(60, 200))) for _ in range(60)]
    return good, bad


def test_counts_match_brute_force(spark):
    rng = random.Random(1)
    odd = [None, "", "\n\n", "a", "a b c a b c", "x\nx\nx ", "é é z", "# * $\n# * $", "a\x0bb\x0cc\rd", "one two three\n" * 3, "w " * 30000, "\n".join(rng.choices(["a b", "c", " ", ""], k=200))]
    odd += [" ".join(rng.choices("abcdé", k=rng.randint(1, 90))) for _ in range(60)]
    good, bad = corpus()
    texts = odd + good + bad
    docs = spark.createDataFrame(list(enumerate(texts)) + [(2, "\n\n"), (None, "a b")], "doc_id long, text string").selectExpr("*", "9 AS n_words", "true AS kept", "'x' AS row")
    labels = spark.createDataFrame([(i, int(i < len(odd) + len(good)), None) for i in range(len(odd), len(texts))] + [(None, 1, 0), (3, None, 1), (99999, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality.judged(docs, labels).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        want = brute("a b" if r.doc_id is None else texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want, r.doc_id
        assert not (r.base_failed and r.kept)
    kept = {r.doc_id: r.kept for r in got}
    assert all(kept[i] for i in range(len(odd), len(odd) + len(good)) if not brute(texts[i])[-1])
    assert not any(kept[i] for i in range(len(odd) + len(good), len(texts)))


def test_model_separates_held_out_rows_and_is_calibrated():
    good, bad = corpus()
    model = quality.train(good[:90] + bad[:45], [1] * 90 + [0] * 45)
    w = [quality.textvec.words(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())])) for t in good[90:] + bad[45:]]
    p = np.array([model.probability(x)[0] for x in w])
    assert p[:30].min() > 0.5 > p[30:].max()
    again = quality.Model.load(model.dump())
    assert np.allclose([again.probability(x)[0] for x in w], p, atol=1e-4)


def test_one_class_and_no_labels_keep_all(spark):
    docs = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(60)))], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.kept for r in quality.judged(docs, none).collect()] == [True]
    assert quality.judged(docs.limit(0), none).collect() == []
