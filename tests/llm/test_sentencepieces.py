import hashlib
import random
import struct

import pytest

from corefold.llm import sentencepieces as sp
from corefold.llm.queries import TOKENIZER


@pytest.fixture(scope="module")
def data():
    return sp.read_model(TOKENIZER)


def odd_texts():
    rng = random.Random(1)
    alphabet = " " * 6 + "abcdeé日\n\t😀▁<0x41>aaahe"
    texts = ["", " ", "  ", " " * 17 + "a", " " * 40, "a" + " " * 33 + "b", "▁", "<s>", "<unk>", "<0x41>", "\x00", "aaaaaaa", "the cat\nsat on the mat", "é " * 20000]
    texts += ["".join(rng.choices(alphabet, k=rng.randint(1, 60))) for _ in range(500)]
    return texts + [" " * k + w for k in range(1, 40) for w in ("a", "the", "日", "")]


def test_parity_and_round_trip_on_odd_texts(spark, data):
    pytest.importorskip("sentencepiece")
    texts = odd_texts()
    rows = list(enumerate(texts)) + [(3, texts[3]), (None, "null id"), (-1, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS ids", "'x' AS parity_")
    out = sp.encoded(docs, data)
    got = out.collect()
    assert len(got) == len(rows) and all(r.parity and r.round_trip for r in got)
    back = {r.doc_id: r.text for r in sp.decoded(out, data).collect()}
    assert back[-1] == "" and back[None] == "null id"
    assert all(back[i] == t.replace(sp.MARK, " ") for i, t in enumerate(texts))
    assert any(r.n_bytes for r in got)


def test_every_text_is_verified_as_a_whole(data):
    rng = random.Random(5)
    words = ["the", "cat\nsat", "é", "日本", "😀", "\t", "x\x00y", "aaaa", "Straße,", "ing", "<s>"]
    texts = [" ".join(rng.choices(words, k=rng.randint(1, 30))) for _ in range(300)]
    codec = sp.Codec(data)
    found = codec.verified(texts)
    assert all(p and r for _, p, r in found) and codec.decode([ids for ids, _, _ in found]) == texts
    encode = codec.encode
    codec.encode = lambda texts: [ids[::-1] if i == 7 else ids for i, ids in enumerate(encode(texts))]
    assert [i for i, (_, p, r) in enumerate(codec.verified(texts)) if not (p and r)] == [7]


def _field(number, value):
    if isinstance(value, bytes):
        return bytes([number << 3 | 2]) + _number(len(value)) + value
    return _number(number << 3) + _number(value)


def _number(n):
    out = b""
    while n > 127:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n])


def test_unigram_model_takes_the_best_segmentation():
    scores = {"▁": -3.0, "a": -2.0, "b": -2.5, "ab": -2.2, "▁ab": -4.6, "ba": -3.1, "aba": -6.0, "▁a": -3.9}
    rows = [("<unk>", 0.0, sp.UNKNOWN)] + [(p, s, sp.NORMAL) for p, s in scores.items()] + [(f"<0x{i:02X}>", 0.0, sp.BYTE) for i in range(256)]
    body = b"".join(_field(1, _field(1, p.encode()) + bytes([2 << 3 | 5]) + struct.pack("<f", s) + _field(3, k)) for p, s, k in rows)
    data = body + _field(2, _field(3, sp.UNIGRAM) + _field(35, 1)) + _field(3, _field(3, 1) + _field(4, 1) + _field(5, 1))
    codec = sp.Codec(data, parity=False)
    rng = random.Random(2)
    for _ in range(60):
        text = "".join(rng.choices("aab ", k=rng.randint(1, 12)))
        clean = "▁" + "▁".join(text.split()) if text.split() else ""
        best = [0.0] + [-1e9] * len(clean)
        for j in range(1, len(clean) + 1):
            best[j] = max([best[i] + scores[clean[i:j]] for i in range(j) if clean[i:j] in scores], default=-1e9)
        ids = codec.encode([text])[0]
        pieces = [rows[i][0] for i in ids]
        if clean:
            assert "".join(pieces) == clean and abs(sum(scores[p] for p in pieces) - best[-1]) < 1e-6
    assert [rows[i][0] for i in codec.encode(["aé"])[0]][-2:] == ["<0xC3>", "<0xA9>"]


def _model(scores, kind=sp.UNIGRAM, user=(), fallback=1, spaces=1):
    rows = [("<unk>", 0.0, sp.UNKNOWN)] + [(p, s, sp.NORMAL) for p, s in scores.items()] + [(p, 0.0, sp.USER) for p in user]
    rows += [(f"<0x{i:02X}>", 0.0, sp.BYTE) for i in range(256)] if fallback else []
    body = b"".join(_field(1, _field(1, p.encode()) + bytes([2 << 3 | 5]) + struct.pack("<f", s) + _field(3, k)) for p, s, k in rows)
    return body + _field(2, _field(3, kind) + _field(35, fallback)) + _field(3, _field(3, 1) + _field(4, spaces) + _field(5, 1))


def test_unigram_table_and_user_symbols_have_parity(spark):
    scores = {"▁": -3.0, "a": -2.0, "b": -2.5, "ab": -2.21, "▁ab": -4.63, "ba": -3.17, "aba": -6.09, "▁a": -3.94, "[": -7.0, "]": -7.1}
    rng = random.Random(4)
    texts = ["", "a"] + ["".join(rng.choices("aaabb [", k=rng.randint(1, 30))).strip() for _ in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sp.encoded(docs, _model(scores)).collect()
    assert len(got) == len(texts) and all(r.parity for r in got)
    merged = {p: float(-i) for i, p in enumerate(["ab", "▁a", "▁ab", "▁", "a", "b", "[", "]"])}
    marked = ["a [ab] b", "[ab]", "ab[ab]", "b[ab]a ab[ a", "a", "[ab][ab]", "ba]["]
    for model in (_model(scores, user=("[ab]", "ab[")), _model(merged, sp.BPE, user=("[ab]", "ab["))):
        codec = sp.Codec(model)
        assert [t for t, (_, parity, _) in zip(marked, codec.verified(marked)) if not parity] == []


def test_not_a_model_and_empty_table(spark, data):
    with pytest.raises(ValueError):
        sp.Model.parse(b"\x0f\x0f")
    assert sp.encoded(spark.createDataFrame([], "doc_id long, text string"), data).collect() == []
    assert hashlib.sha256(b"").hexdigest()


def test_decoding_goes_over_no_piece_for_its_marker_and_long_texts_are_cut(data, monkeypatch):
    from tokenizers import decoders

    codec = sp.Codec(data, parity=False)
    assert isinstance(codec.decoder.decoder, decoders.ByteFallback)
    texts = odd_texts()
    ids = codec.encode(texts)
    rng = random.Random(6)
    ids += [[rng.randrange(len(codec.model.pieces)) for _ in range(rng.randint(0, 20))] for _ in range(300)] + [[], [10**6]]
    marker = [next(i for i, (p, _, _) in enumerate(codec.model.pieces) if p == f"<0x{b:02X}>") for b in sp.MARK.encode()]
    ids += [marker, marker[:2], [5, *marker, 7]]
    assert codec.decode(ids) == codec.tokenizer.decode_batch(ids, skip_special_tokens=False)
    whole = codec.encode(texts)
    for most in (-1, 20):
        monkeypatch.setattr(sp, "MOST_UNCUT", most)
        assert codec.encode(texts) == whole
    alike = sp.Codec(_model({"▁a": -1.0, " a": -2.0, "▁": -3.0, "a": -4.0}, sp.BPE), parity=False)
    assert alike.decoder is None and alike.decode(alike.encode(["a a"])) == ["a a"]


def test_decoding_joins_bytes_as_the_library_does(data):
    """Also of ids that make no UTF-8 and of ids that the model lacks; texts that do are not left to the library."""
    codec = sp.Codec(data, parity=False)
    rng = random.Random(2)
    single = [i for i, p in enumerate(codec.model.pieces) if p[2] == sp.BYTE]
    ids = [[rng.choice(single) if rng.random() < q else rng.randrange(len(codec.model.pieces)) for _ in range(rng.randrange(12))] for q in (0.1, 0.5, 0.9) for _ in range(2000)]
    ids += [[], [0], [1, 2], [len(codec.model.pieces) + 5, 300]]
    want = [t.removeprefix(" ") for t in codec.decoder.decode_batch(ids, skip_special_tokens=False)]
    assert codec.decode(ids) == want and any("�" in t for t in want)
    texts = odd_texts()
    ids = codec.encode(texts)
    codec.decoder = "unused"
    assert codec.decode(ids) == [t.replace(sp.MARK, " ") for t in texts]
