import random
import shutil
from collections import Counter

import corpus_pipeline
from corefold.llm import linededup, packing, pii, quality, scratch, simhash
from tests.llm import test_jaccard, test_linededup, test_pii, test_quality


def table(spark, tmp_path):
    rng = random.Random(9)
    good, bad = test_quality.corpus()
    texts = good[:80] + bad[:30]
    texts += good[:4] + [good[5] + " and one more"] + ["\n".join([good[6], good[7]])]
    texts += [f"card {test_pii.card(rng)} of it\n" + " ".join(f"w{rng.randint(0, 9999)}" for _ in range(80)) for _ in range(5)]
    texts += [None, "", "too short"]
    rows = [(i, t, "en", "src", len(t or "")) for i, t in enumerate(texts)] + [(None, " ".join(f"x{i}" for i in range(70)), "en", "src", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, int(i < 80), 0) for i in range(110)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return {r[0]: r[1] for r in rows}


def test_each_stage_against_brute_force(spark, tmp_path):
    texts = table(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    now, kept = dict(texts), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out, _ = scratch.table(stage(spark, docs, str(tmp_path)), f"test-{name}")
        assert out.columns == docs.columns
        got = {r.doc_id: r.text for r in out.collect()}
        assert len(got) == out.count()
        if name == "quality":
            assert all(i in got for i in range(80)) and not any(i in got for i in range(80, 110))
            assert all(not test_quality.brute(t)[-1] for t in got.values()) and all(now[i] == t for i, t in got.items())
        if name == "lines":
            want = {d: t for d, t, n, gone in test_linededup.brute(list(now.items()), linededup.MIN_BLOCK_WORDS) if gone == 0 or gone < n}
            assert got == want and len(want) < len(now)
        if name == "near":
            assert {i for i in got if i is not None} == test_jaccard.brute([(i, t) for i, t in now.items() if i is not None])
        if name == "pii":
            assert set(got) == set(now) and sum(got[i] != now[i] for i in got) == 5
            assert all(test_pii.luhn_ok(t.split()[1]) for i, t in got.items() if t != now[i])
        docs, now = out, got
        kept.append(len(now))
    final = corpus_pipeline.packed(spark, docs, str(tmp_path)).collect()
    assert Counter({r.doc_id: sum(x.length for x in final if x.doc_id == r.doc_id) for r in final}) == Counter({i: len(t.split()) for i, t in now.items()})
    assert max(r.bucket for r in final) <= packing.BUDGET
    spark.conf.set(pii.KEY_SETTING, "k")
    again = corpus_pipeline.run(spark, str(tmp_path)).collect()
    spark.conf.unset(pii.KEY_SETTING)
    assert sorted(map(str, again)) == sorted(map(str, final))
    shutil.rmtree(tmp_path)


def test_one_of_each_with_repeated_rows_and_null_ids(spark):
    long = " ".join(f"q{i}" for i in range(50))
    rows = [(3, long), (3, long), (3, "other words here now"), (7, long), (None, long), (None, "nobody has these words"), (None, "nobody has these words"), (9, ""), (4, None)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, fp string, n_chars int")
    got = sorted(((r.doc_id, r.text) for r in simhash.one_of_each(docs).collect()), key=str)
    assert len(got) == 4 and (3, long) in got and (None, "nobody has these words") in got and (4, None) in got
    assert corpus_pipeline.ORACLE_SQL is None and quality.MIN_WORDS == 50


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_stages_keep_columns_with_clashing_names(spark, tmp_path):
    names = "__packed __gone __key __text_key __doc_id __n_lines __kept __p_good __k1 __k2 __matches __values __found row s n bits prefix".split()
    text = " ".join(f"q{i}" for i in range(60))
    docs = spark.createDataFrame([(i, f"{text} {i} 4111111111111111\nline", *range(len(names))) for i in range(3)], "doc_id long, text string, " + ", ".join(f"{n} int" for n in names))
    spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and all(tuple(r)[2:] == tuple(range(len(names))) for r in out.collect()), name
