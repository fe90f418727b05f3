"""SentencePiece encoding and decoding on the tokenizers library.

The model's protobuf is parsed here; normaliser, metaspace marker, scores and byte fallback are rebuilt from it. A unigram
model becomes a Unigram over its scores; a BPE model's merges follow from its scores: of all pairs that join to a piece,
those of better pieces come first. Batches of whole texts are encoded on as many threads as a task has cores. Each text's ids are compared with the sentencepiece library's
(``parity``), and decoded again (``round_trip``).
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from . import textvec

MARK = "▁"
# Fixed values of the format: types of pieces and of models.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
BATCH_BYTES = 1 << 20
MOST_UNCUT = 100_000  # characters; merging a text in one piece takes the logarithm of its length for each


def _varint(b: bytes, i: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        c = b[i]
        i += 1
        value |= (c & 127) << shift
        shift += 7
        if c < 128:
            return value, i


def _fields(b: bytes) -> Iterator[tuple[int, int | bytes]]:
    i = 0
    while i < len(b):
        key, i = _varint(b, i)
        kind = key & 7
        if kind == 0:
            value, i = _varint(b, i)
        elif kind in (1, 5):
            n = 8 if kind == 1 else 4
            value, i = b[i : i + n], i + n
        elif kind == 2:
            n, i = _varint(b, i)
            value, i = b[i : i + n], i + n
        else:
            raise ValueError("not a SentencePiece model")
        yield key >> 3, value


@dataclass
class Model:
    """What a model file says."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    remove_extra_spaces: bool = True
    escape_spaces: bool = True
    suffix_space: bool = False

    @classmethod
    def parse(cls, data: bytes) -> Model:
        m = cls()
        for number, value in _fields(data):
            if number == 1:
                got = dict(_fields(value))
                m.pieces.append((got.get(1, b"").decode(), struct.unpack("<f", got[2])[0] if 2 in got else 0.0, got.get(3, NORMAL)))
            elif number == 2:
                got = dict(_fields(value))
                m.kind, m.byte_fallback, m.suffix_space = got.get(3, UNIGRAM), bool(got.get(35, 0)), bool(got.get(24, 0))
            elif number == 3:
                got = dict(_fields(value))
                m.charsmap = got.get(2, b"")
                m.dummy_prefix, m.remove_extra_spaces, m.escape_spaces = bool(got.get(3, 1)), bool(got.get(4, 1)), bool(got.get(5, 1))
        return m


def merges(m: Model) -> list[tuple[str, str]]:
    """Pairs that join to a piece, those of better pieces first; of one piece's pairs those of better parts."""
    rank = {p: i for i, (p, _, kind) in enumerate(m.pieces) if kind in (NORMAL, USER)}
    out = []
    for piece, score, kind in m.pieces:
        if kind == NORMAL:
            for k in range(1, len(piece)):
                a, b = piece[:k], piece[k:]
                if a in rank and b in rank:
                    out.append((-score, rank[piece], rank[a], rank[b], a, b))
    return [(a, b) for *_, a, b in sorted(out)]


def build(m: Model):
    """A ``tokenizers.Tokenizer`` that encodes as the model does, without control symbols. In BPE models, user-defined symbols are always pieces of their own."""
    from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    unknown = next((i for i, p in enumerate(m.pieces) if p[2] == UNKNOWN), None)
    if m.kind == UNIGRAM:
        # A user-defined symbol scores as its bytes would at best, less a little.
        top = max((s for _, s, kind in m.pieces if kind == NORMAL), default=0.0)
        core = models.Unigram([(p, len(p.encode()) * top - 0.1 if kind == USER else s) for p, s, kind in m.pieces], unknown, m.byte_fallback)
    elif m.kind == BPE:
        core = models.BPE({p: i for i, (p, _, _) in enumerate(m.pieces)}, merges(m), unk_token=m.pieces[unknown][0] if unknown is not None else None, fuse_unk=True, byte_fallback=m.byte_fallback)
    else:
        raise ValueError("only unigram and BPE models are supported")
    t = Tokenizer(core)
    steps = [normalizers.Precompiled(m.charsmap)] if m.charsmap else []
    if m.remove_extra_spaces:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if m.dummy_prefix and not m.suffix_space:
        steps.append(normalizers.Prepend(" "))
    if m.escape_spaces:
        steps.append(normalizers.Replace(" ", MARK))
    t.normalizer = normalizers.Sequence(steps)
    crossing = any(MARK in p.lstrip(MARK) for p, _, kind in m.pieces if kind in (NORMAL, USER))
    if not crossing and not m.suffix_space:
        # No piece holds a marker after another character: cutting before each run of markers changes nothing and makes words short.
        longest = max([0, *(len(p) for p, _, _ in m.pieces if p.strip(MARK) == "")])
        runs = f"{MARK}{{{longest}}}(?={MARK})|" if longest > 1 else ""
        t.pre_tokenizer = pre_tokenizers.Split(Regex(f"{runs}{MARK}*[^{MARK}]+|{MARK}+"), "isolated")
    if m.kind == BPE:
        t.add_tokens([AddedToken(p, normalized=False, special=False) for p, _, kind in m.pieces if kind == USER])
    t.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(), *([decoders.Strip(" ", 1, 0)] if m.dummy_prefix else [])])
    return t


def build_decoder(m: Model):
    """A ``tokenizers.Tokenizer`` that decodes as that of ``build`` does, but for the first space; None if pieces differ in nothing but the marker.

    Its pieces hold spaces for markers, so that no decoding step goes over each of them.
    """
    from tokenizers import Tokenizer, decoders, models

    pieces = {p.replace(MARK, " "): i for i, (p, _, _) in enumerate(m.pieces)}
    if len(pieces) < len(m.pieces):
        return None
    t = Tokenizer(models.WordLevel(pieces, unk_token=""))
    t.decoder = decoders.ByteFallback()
    return t


def piece_bytes(m: Model) -> dict[int, bytes]:
    """What each piece of ``build_decoder`` adds to a text: its UTF-8, or the one byte that ``<0xNN>`` stands for."""
    return {i: bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-Fa-f]{2}>", p) else p.replace(MARK, " ").encode() for i, (p, _, _) in enumerate(m.pieces)}


class Codec:
    """Encodes and decodes batches with one model. It keeps nothing of the texts. ``threads`` are the sentencepiece library's; the tokenizers library reads its own from the environment."""

    def __init__(self, data: bytes, parity: bool = True, threads: int = 1):
        from tokenizers import pre_tokenizers

        self.model = Model.parse(data)
        self.tokenizer, self.decoder, self.threads = build(self.model), build_decoder(self.model), threads
        self.bytes = piece_bytes(self.model) if self.decoder is not None else {}
        self.before = None
        # Cuts before each marker are the same cuts where a text has no run of markers, and take no search by a regex.
        self.cuts = None if self.tokenizer.pre_tokenizer is None else (self.tokenizer.pre_tokenizer, pre_tokenizers.Split(MARK, "merged_with_next"))
        if not self.model.charsmap and not self.model.remove_extra_spaces:
            # What is left of the normaliser is a prefix and a replacement: on plain strings it keeps no track of each character's origin.
            self.before, self.tokenizer.normalizer = self._marked, None
        elif self.model.kind == BPE and any(kind == USER for _, _, kind in self.model.pieces):
            # User-defined symbols cut a text in parts; it is normalised as a whole first, so that only its start gets a marker.
            self.before, self.tokenizer.normalizer = self.tokenizer.normalizer.normalize_str, None
        self.other = None
        if parity:
            import sentencepiece

            self.other = sentencepiece.SentencePieceProcessor(model_proto=data)

    def _marked(self, text: str) -> str:
        text = " " + text if self.model.dummy_prefix and not self.model.suffix_space else text
        return text.replace(" ", MARK) if self.model.escape_spaces else text

    def encode(self, texts: list[str]) -> list[list[int]]:
        if self.before is not None:
            texts = [self.before(t) if t else t for t in texts]
        if self.cuts is None or self.tokenizer.normalizer is not None:
            return self._encode(texts)
        # Cutting a text costs more than merging it in one piece, unless it is long.
        uncut = MOST_UNCUT if self.model.kind == BPE else -1
        out: list = [None] * len(texts)
        ways = [2 if len(t) <= uncut else 0 if MARK * 2 in t else 1 for t in texts]
        for way, cut in enumerate((*self.cuts, None)):
            mine = [i for i, w in enumerate(ways) if w == way]
            if mine:
                self.tokenizer.pre_tokenizer = cut
                for i, ids in zip(mine, self._encode([texts[i] for i in mine])):
                    out[i] = ids
        return out

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def verified(self, texts: list[str], verify: bool = True) -> list[tuple[list[int], bool | None, bool | None]]:
        """(ids, parity, round trip) of each text, each over the whole text."""
        ids = self.encode(texts)
        if not verify:
            return [(x, None, None) for x in ids]
        back = [x == t.replace(MARK, " ") for x, t in zip(self.decode(ids), texts)]
        return list(zip(ids, self.same(texts, ids), back))

    def decode(self, ids: list) -> list[str]:
        if self.decoder is None:
            return self.tokenizer.decode_batch(ids, skip_special_tokens=False)
        texts = [self._joined(x) for x in ids]
        return [t.removeprefix(" ") for t in texts] if self.model.dummy_prefix else texts

    def _joined(self, ids: list[int]) -> str:
        """The pieces' bytes as one text; ids that make no UTF-8, or are none of the model's, are the library's to decode."""
        try:
            return b"".join(map(self.bytes.__getitem__, ids)).decode()
        except (KeyError, UnicodeDecodeError):
            return self.decoder.decode(list(ids), skip_special_tokens=False)

    def same(self, texts: list[str], ids: list[list[int]]) -> list[bool | None]:
        """Whether the sentencepiece library gives the same ids; None without ``parity``."""
        if self.other is None:
            return [None] * len(texts)
        return [a == b for a, b in zip(self.other.encode(texts, num_threads=self.threads), ids)]


@lru_cache(maxsize=1)
def _codec(data: bytes, parity: bool, threads: int) -> Codec:
    """One codec for all tasks of a worker process."""
    return Codec(data, parity, threads)


def read_model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encoded(docs: DataFrame, model: bytes, text: str = "text", keep: tuple[str, ...] = ("doc_id",), verify: bool = True) -> DataFrame:
    """The columns ``keep`` and ``ids`` (array of int), ``n_bytes`` (ids that stand for single bytes), ``parity`` and ``round_trip``.

    ``verify`` compares each text's ids with the sentencepiece library's, and the decoded ids with the text itself; else both are null. Null texts
    count as empty; texts of any length are encoded whole, in batches of about ``BATCH_BYTES`` and at least one text, and repeated rows each for itself. A text that holds the marker character decodes to a space there, as the format has it.
    """
    threads = int(docs.sparkSession.conf.get("spark.task.cpus", "1"))  # more would take other tasks' cores, and wait on them
    schema = docs.select(*keep).schema.add("ids", DataType.fromDDL("array<int>")).add("n_bytes", "long").add("parity", "boolean").add("round_trip", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"], os.environ["RAYON_NUM_THREADS"] = "true" if threads > 1 else "false", str(threads)
        codec = _codec(model, verify, threads)
        is_byte = np.array([kind == BYTE for _, _, kind in codec.model.pieces])
        for b in batches:
            for at, to, _, _ in textvec.slices(b.column(0), BATCH_BYTES):
                texts = [t or "" for t in b.column(0).slice(at, to - at).to_pylist()]
                listed, parity, back = zip(*codec.verified(texts, verify))
                ids = [np.array(x, np.int32) for x in listed]
                n_bytes = [int(is_byte[x].sum()) for x in ids]
                lengths = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
                array = pa.ListArray.from_arrays(pa.array(lengths), pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32)))
                more = [array, pa.array(n_bytes, pa.int64()), pa.array(parity, pa.bool_()), pa.array(back, pa.bool_())]
                yield pa.RecordBatch.from_arrays([x.slice(at, to - at) for x in b.columns[1:]] + more, names=schema.names)

    return docs.select(F.col(text).cast("string").alias("__text"), *keep).mapInArrow(run, schema)


def decoded(df: DataFrame, model: bytes, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and ``text``; null ids give null."""
    schema = df.select(*keep).schema.add("text", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(model, False)
        for b in batches:
            rows = b.column(0).to_pylist()
            texts = [None if x is None else t for x, t in zip(rows, codec.decode([x or [] for x in rows]))]
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(texts, pa.string())], names=schema.names)

    return df.select(F.col(ids).alias("__ids"), *keep).mapInArrow(run, schema)
