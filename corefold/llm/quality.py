"""Quality rules: countable base rules, then a hashed word and character n-gram logistic regression with calibrated probabilities.

The model is fitted on a bounded sample of labelled rows (``TRAIN_ROWS``); counts and verdicts cover every row and whole texts.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec

MIN_WORDS = 50
REPEAT_PERCENT = 50
TRAIN_ROWS = 3000
HASH_BITS = 17
CHAR_GRAM = 4
REJECT_BELOW = 0.2
HOLDOUT = 5  # every fifth sampled row calibrates
EPOCHS = 12

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def counts(w: textvec.Words) -> dict[str, np.ndarray]:
    """The base counts of each row of a slice."""
    buf, offsets, rows = w.buf, w.offsets, len(w.offsets) - 1
    leads = (buf & 0xC0) != 0x80
    out = {
        "n_words": w.counts(),
        "word_chars": textvec.per_row(leads & ~textvec.SPACE[buf], offsets),
        "n_symbols": textvec.per_row(SYMBOLS[buf], offsets),
        "n_dup_lines": np.zeros(rows, np.int64),
        "n_repeat_words": np.zeros(rows, np.int64),
    }
    if not len(w.starts):
        return out
    cuts = np.flatnonzero(buf == 10)
    starts = np.unique(np.concatenate((offsets[:-1], cuts + 1)))
    starts = starts[starts < len(buf)]
    ends = np.concatenate((starts[1:], [len(buf)]))
    ends = ends - (buf[ends - 1] == 10)
    row = np.searchsorted(offsets, starts, "right") - 1
    has_word = np.searchsorted(w.starts, ends, "left") > np.searchsorted(w.starts, starts, "left")
    data, seen = buf.tobytes(), set()
    for r, i, j in zip(row[has_word].tolist(), starts[has_word].tolist(), ends[has_word].tolist()):
        line = (r, data[i:j])
        if line in seen:
            out["n_dup_lines"][r] += 1
        seen.add(line)
    # Numbers of words, of pairs and of windows: equal if and only if the words are.
    ids = w.ids()
    n = np.int64(len(ids) + 1)
    at = np.flatnonzero(w.row[: max(len(ids) - 2, 0)] == w.row[2:]) if len(ids) > 2 else np.zeros(0, np.int64)
    pairs = np.unique(ids[at] * n + ids[at + 1], return_inverse=True)[1]
    windows = np.unique(pairs * n + ids[at + 2], return_inverse=True)[1]
    _, which, times = np.unique(windows * np.int64(rows) + w.row[at], return_inverse=True, return_counts=True)
    twice = at[times[which] > 1]
    covered = np.zeros(len(w.starts), bool)
    for k in range(3):
        covered[twice + k] = True
    out["n_repeat_words"] = np.bincount(w.row[covered], minlength=rows)
    return out


def features(w: textvec.Words, bits: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, bucket, weight) of the words and of the character n-grams: each kind's weights sum to 1 in a row."""
    rows = len(w.offsets) - 1
    shift, half = np.uint64(64 - bits + 1), np.int64(1 << (bits - 1))
    out = []
    if len(w.starts):
        out.append((w.row, (textvec.mix(w.hashes() + np.uint64(11)) >> shift).astype(np.int64), (1 / np.maximum(w.counts(), 1))[w.row]))
    points = np.frombuffer(w.buf.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    lengths = textvec.per_row((w.buf & 0xC0) != 0x80, w.offsets)
    row = np.repeat(np.arange(rows), lengths)
    if len(points) >= CHAR_GRAM and len(row) == len(points):
        at = np.flatnonzero(row[: len(row) - CHAR_GRAM + 1] == row[CHAR_GRAM - 1 :])
        grams = textvec.runs(textvec.mix(points.astype(np.uint64) + textvec.SEEDS[2]), CHAR_GRAM)[at]
        out.append((row[at], (grams >> shift).astype(np.int64) + half, (1 / np.maximum(lengths - CHAR_GRAM + 1, 1))[row[at]]))
    return out


@dataclass
class Model:
    """``weights`` of the buckets, ``bias``, and the calibration ``(slope, shift)`` on top of the raw score."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float
    bits: int = HASH_BITS

    def raw(self, w: textvec.Words) -> np.ndarray:
        score = np.full(len(w.offsets) - 1, self.bias)
        for row, bucket, weight in features(w, self.bits):
            score += np.bincount(row, weights=self.weights[bucket] * weight, minlength=len(score))
        return score

    def probability(self, w: textvec.Words) -> np.ndarray:
        return _sigmoid(self.slope * self.raw(w) + self.shift)

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez_compressed(out, weights=self.weights.astype(np.float32), rest=np.array([self.bias, self.slope, self.shift, self.bits]))
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Model:
        got = np.load(io.BytesIO(data))
        bias, slope, shift, bits = got["rest"].tolist()
        return cls(got["weights"].astype(np.float64), bias, slope, shift, int(bits))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def train(texts: list[str], good: list[int], bits: int = HASH_BITS, epochs: int = EPOCHS) -> Model:
    """Fit by AdaGrad on four of five rows, calibrate by Platt's method on the fifth. With one class only, its model keeps all."""
    y = np.array(good, np.float64)
    model = Model(np.zeros(1 << bits), 0.0, 1.0, 0.0, bits)
    if not len(y) or y.min() == y.max():
        model.bias = 4.0 if not len(y) or y.max() > 0 else -4.0
        return model
    held = np.arange(len(y)) % HOLDOUT == HOLDOUT - 1
    if min(y[held].sum(), (1 - y[held]).sum(), y[~held].sum(), (1 - y[~held]).sum()) < 1:
        held[:] = False
    rows = [_sparse(t, bits) for t in texts]
    fit = np.flatnonzero(~held)
    balance = np.where(y == 1, 0.5 / max(y[fit].mean(), 1e-9), 0.5 / max(1 - y[fit].mean(), 1e-9))
    squared, bias_squared = np.full(1 << bits, 1e-6), 1e-6
    rng = np.random.default_rng(7)
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(fit), max(1, len(fit) // 32)):
            index = np.concatenate([rows[i][0] for i in part])
            value = np.concatenate([rows[i][1] for i in part])
            owner = np.repeat(np.arange(len(part)), [len(rows[i][0]) for i in part])
            z = model.bias + np.bincount(owner, weights=model.weights[index] * value, minlength=len(part))
            error = (_sigmoid(z) - y[part]) * balance[part] / len(part)
            touched, inverse = np.unique(index, return_inverse=True)
            gradient = np.bincount(inverse, weights=value * error[owner], minlength=len(touched)) + 1e-7 * model.weights[touched]
            squared[touched] += gradient**2
            model.weights[touched] -= 0.5 * gradient / np.sqrt(squared[touched])
            bias_squared += error.sum() ** 2
            model.bias -= 0.1 * error.sum() / np.sqrt(bias_squared)
    raw = np.array([model.bias + (model.weights[i] * v).sum() for i, v in rows])
    at = held if held.any() else ~held
    model.slope, model.shift = _platt(raw[at], y[at])
    del rows, squared
    textvec.release()  # the driver trains
    return model


def _sparse(text: str, bits: int) -> tuple[np.ndarray, np.ndarray]:
    buf = np.frombuffer((text or "").encode(), np.uint8)
    found = features(textvec.words(buf, np.array([0, len(buf)])), bits) if len(buf) else []
    if not found:
        return np.zeros(0, np.int64), np.zeros(0)
    index = np.concatenate([b for _, b, _ in found])
    value = np.concatenate([v for _, _, v in found])
    index, inverse = np.unique(index, return_inverse=True)
    return index, np.bincount(inverse, weights=value)


def _platt(raw: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Newton's method for sigmoid(slope * raw + shift), with Platt's smoothed targets."""
    high, low = (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2)
    target = np.where(y == 1, high, low)
    scale = max(raw.std(), 1e-9)
    x = np.stack([(raw - raw.mean()) / scale, np.ones(len(raw))])
    beta = np.array([1.0, 0.0])
    for _ in range(100):
        p = _sigmoid(beta @ x)
        hessian = (x * (p * (1 - p))) @ x.T + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, x @ (p - target) + 1e-3 * beta)
        beta = beta - step * min(1.0, 5 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0] / scale), float(beta[1] - beta[0] * raw.mean() / scale)


def sample(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> tuple[list[str], list[int]]:
    """Texts and labels of at most ``most`` labelled rows: those whose id has the smallest hash."""
    chosen = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "quality").distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(most)
    # The chosen labels number ``most`` at most, which bounds the broadcast.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(most).collect()
    return [r.text or "" for r in rows], [int(r.quality > 0) for r in rows]


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The columns ``keep``, the base counts, ``base_failed``, ``p_good`` and ``kept``; null texts count as empty."""
    data = model.dump()
    schema = docs.select(*keep).schema
    for name in COUNTS:
        schema = schema.add(f"__{name}", "long")
    schema = schema.add("__base_failed", "boolean").add("__p_good", "double").add("__kept", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        local = Model.load(data)
        for b in batches:
            for at, to, buf, offsets in textvec.slices(b.column(0)):
                w = textvec.words(buf, offsets)
                c = counts(w)
                failed = (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > REPEAT_PERCENT * c["n_words"])
                p = local.probability(w)
                more = [pa.array(c[k].astype(np.int64)) for k in COUNTS] + [pa.array(failed), pa.array(p), pa.array(~failed & (p >= REJECT_BELOW))]
                yield pa.RecordBatch.from_arrays([x.slice(at, to - at) for x in b.columns[1:]] + more, names=schema.names)

    return docs.select(F.col(text).cast("string").alias("__text"), *keep).mapInArrow(run, schema)


def judged(docs: DataFrame, labels: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Train on the labels, then score all documents; the new columns have their plain names."""
    out = score(docs, train(*sample(docs, labels)), keep)
    return out.withColumnsRenamed({f"__{k}": k for k in (*COUNTS, "base_failed", "p_good", "kept") if k not in keep})
