"""Removal of repeated passages with a log-structured index of window fingerprints.

A window of ``WINDOW`` words is represented by its anchor: of the ``GRAM``-word hashes inside it, the smallest (the last of
equals). The anchor is a function of the window alone, so equal windows have equal anchors at equal offsets, and neighbouring
windows share one: a *span* is a maximal run of windows with the same anchor place. A batch of documents adds one sorted,
immutable run of its spans to the index. To judge a batch, its anchors are merge-joined with the earlier runs and its own:

1. spans whose whole word sequences are equal are equal window by window; the smallest document keeps them;
2. where an anchor stands in unequal spans, one span of each kind is compared window by window.

Word sequences are verified by collision-resistant digests of the words themselves (BLAKE2b, 128 bits); the anchors only find what may be equal.

``compact`` merges runs into one, which keeps one entry of each kind of span: that with the smallest document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import scratch, textvec

WINDOW = 50
GRAM = 10
_REACH = WINDOW - GRAM + 1  # grams in a window

RUN_SCHEMA = "anchor bigint, sig bigint, sig2 bigint, doc_id bigint, text_key bigint, at int, before int, len int"


def _digests(w: textvec.Words, first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Two longs for each run of ``n`` words from ``first`` on: the BLAKE2b digest of the words, joined by one space."""
    data = w.buf.tobytes()
    starts, ends = w.starts[first].tolist(), w.ends[first + n - 1].tolist()
    # Most texts have single spaces between words; only other runs are joined anew.
    gaps = np.concatenate(([0], np.cumsum((w.starts[1:] - w.ends[:-1] != 1) | (w.buf[w.ends[:-1]] != 32)))) if len(w.starts) > 1 else np.zeros(1, np.int64)
    plain = (gaps[first + n - 1] == gaps[first]).tolist()
    digest = hashlib.blake2b
    out = b"".join(digest(data[i:j] if p else b" ".join(data[i:j].split()), digest_size=16).digest() for i, j, p in zip(starts, ends, plain))
    return np.frombuffer(out, "<u8").reshape(-1, 2)


def _spans(w: textvec.Words) -> dict[str, np.ndarray]:
    """Spans of a slice: row, first window's word ``at`` (in its row), number of windows ``len``, anchor hash, words from ``at`` to the anchor, digest of all words."""
    at, gram = textvec.grams(w.hashes(), w, GRAM)
    starts = np.flatnonzero(w.row[: len(w.starts) - WINDOW + 1] == w.row[WINDOW - 1 :]) if len(w.starts) >= WINDOW else np.zeros(0, np.int64)
    if not len(starts):
        return {k: np.zeros(0, np.int64) for k in ("row", "at", "before", "len")} | {k: np.zeros(0, np.uint64) for k in ("anchor", "sig", "sig2")}
    full = np.full(len(w.starts), np.iinfo(np.uint64).max, np.uint64)
    full[at] = gram
    view = np.lib.stride_tricks.sliding_window_view(full, _REACH)
    anchor_at = np.empty(len(starts), np.int64)
    for part in range(0, len(starts), 65536):
        s = starts[part : part + 65536]
        block = view[s[0] : s[-1] + 1][:, ::-1]
        anchor_at[part : part + 65536] = (s + _REACH - 1) - np.argmin(block, axis=1)[s - s[0]]
    breaks = np.flatnonzero((np.diff(anchor_at) != 0) | (np.diff(starts) != 1)) + 1
    lo = np.concatenate(([0], breaks))
    hi = np.concatenate((breaks, [len(starts)]))
    first, length = starts[lo], hi - lo
    digests = _digests(w, first, length + WINDOW - 1)
    row = w.row[first]
    return {"row": row, "at": first - w.first[row], "len": length, "before": anchor_at[lo] - first, "anchor": full[anchor_at[lo]], "sig": digests[:, 0], "sig2": digests[:, 1]}


def spans(docs: DataFrame) -> DataFrame:
    """The entries of a run, for documents ``(doc_id, text)``. Rows with a null id neither own nor lose words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, to, buf, offsets in textvec.slices(b.column(0)):
                s = _spans(textvec.words(buf, offsets))
                take = pa.array(s["row"] + at)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[pa.array(np.ascontiguousarray(s[k]).view(np.int64)) for k in ("anchor", "sig", "sig2")],
                        b.column(1).take(take), b.column(2).take(take),
                        *[pa.array(s[k].astype(np.int32)) for k in ("at", "before", "len")],
                    ],
                    names=["anchor", "sig", "sig2", "doc_id", "text_key", "at", "before", "len"],
                )

    return _keyed(docs).where("doc_id IS NOT NULL").select("text", "doc_id", "text_key").mapInArrow(run, RUN_SCHEMA)


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows that repeat an id are told apart by a hash of their text."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("text_key", F.xxhash64("text"))


class Index:
    """Sorted immutable runs below ``path``, a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.runs, self.written = spark, path.rstrip("/"), [], 0

    def append(self, entries: DataFrame) -> DataFrame:
        """Write a run of files sorted by anchor; returns it. A frequent anchor's entries go to many files."""
        run = f"{self.path}/run-{self.written:05d}"
        self.written += 1
        found = scratch.write(entries.repartition("anchor", "doc_id").sortWithinPartitions("anchor"), run)
        self.runs.append(run)
        return found

    def read(self) -> DataFrame | None:
        return self.spark.read.schema(RUN_SCHEMA).parquet(*self.runs) if self.runs else None

    def compact(self) -> None:
        """Merge all runs into one, with the smallest document's entry of each kind of span."""
        if len(self.runs) < 2:
            return
        whole = f"{self.path}/compact-{self.written:05d}"
        rest = [c for c in self.read().columns if c not in ("anchor", "sig", "sig2", "before", "len")]
        kept = self.read().groupBy("anchor", "sig", "sig2", "before", "len").agg(F.min(F.struct(*rest)).alias("e"))
        scratch.write(kept.select("anchor", "sig", "sig2", "e.doc_id", "e.text_key", "e.at", "before", "len").repartition("anchor", "doc_id").sortWithinPartitions("anchor"), whole)
        for run in self.runs:
            scratch.delete(self.spark, run)
        self.runs = [whole]


def _kinds(entries: DataFrame) -> DataFrame:
    """One row for each kind of span: its smallest document and that document's first place."""
    kind = ["anchor", "before", "len", "sig", "sig2"]
    return entries.groupBy(*kind).agg(F.min(F.struct("doc_id", "text_key", "at")).alias("owner"), F.count("*").alias("n"))


def repeated(batch: DataFrame, history: DataFrame | None, documents: DataFrame) -> DataFrame:
    """``(doc_id, text_key, repeats)`` for documents of ``batch`` (a run): repeats is a list of ``(at, len)``, windows that also start in a document with a smaller id.

    ``history`` holds earlier runs, ``documents`` the texts of both.
    """
    both = batch if history is None else batch.unionByName(history)
    spark = documents.sparkSession
    kinds, kinds_path = scratch.table(
        _kinds(both).withColumn("doc_id", F.col("owner.doc_id")).withColumn("owner_key", F.col("owner.text_key")).withColumn("owner_at", F.col("owner.at")).drop("owner"), "kinds"
    )
    # Anchors of more than one kind: counted by a plain aggregate, so that a frequent anchor is no single task's work.
    mixed = kinds.groupBy("anchor").agg(F.count("*").alias("n_kinds")).where("n_kinds > 1").select("anchor")
    open_kinds = kinds.join(mixed, "anchor", "left_semi")
    windows, windows_path = scratch.table(_windows(documents, open_kinds), "windows")
    first = windows.groupBy("h1", "h2").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").drop("high")
    partly = windows.join(first, ["h1", "h2"]).where("low < doc_id").groupBy("anchor", "sig", "sig2", "before", "len").agg(F.collect_set("offset").alias("offsets"))
    # Written so that the join below shuffles both sides, which lets Spark split a kind that very many documents have.
    known, _ = scratch.table(
        kinds.select("anchor", "sig", "sig2", "before", "len", F.col("doc_id").alias("owner_id"), "n")
        .join(partly, ["anchor", "sig", "sig2", "before", "len"], "left")
        .where("n > 1 OR offsets IS NOT NULL")
        .drop("n"),
        "known",
    )
    for path in (windows_path, kinds_path):  # all that is left to know is in ``known``
        scratch.delete(spark, path)
    hit = batch.join(known, ["anchor", "sig", "sig2", "before", "len"]).where("owner_id < doc_id OR offsets IS NOT NULL")
    whole = F.array(F.struct(F.col("at"), F.col("len")))
    single = F.transform("offsets", lambda o: F.struct((F.col("at") + o).alias("at"), F.lit(1).alias("len")))
    parts = hit.select("doc_id", "text_key", F.when(F.col("owner_id") < F.col("doc_id"), whole).otherwise(single).alias("parts"))
    return parts.groupBy("doc_id", "text_key").agg(F.flatten(F.collect_list("parts")).alias("repeats"))


def _windows(documents: DataFrame, kinds: DataFrame) -> DataFrame:
    """Every window of the given spans, with two hashes; the words come from the documents' own texts."""
    wanted = kinds.groupBy("doc_id", F.col("owner_key").alias("text_key")).agg(F.collect_list(F.struct("anchor", "sig", "sig2", "before", "len", "owner_at")).alias("spans"))
    texts = _packed(documents.where("doc_id IS NOT NULL"))
    joined = texts.join(wanted, ["doc_id", "text_key"]).select("packed", "doc_id", "spans")
    names = ["h1", "h2", "doc_id", "offset", "anchor", "sig", "sig2", "before", "len"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for b in textvec.chunks(batches):
            for k in range(b.num_rows):
                buf = np.frombuffer(unpack.decompress(b.column(0)[k].as_py()), np.uint8)
                w = textvec.words(buf, np.array([0, len(buf)]))
                list_ = b.column(2)[k].values
                f = {n: list_.field(n).to_numpy(zero_copy_only=False) for n in ("anchor", "sig", "sig2", "before", "len", "owner_at")}
                pick = np.repeat(np.arange(len(f["len"])), f["len"])
                offset = np.arange(len(pick)) - np.repeat(np.cumsum(f["len"]) - f["len"], f["len"])
                at = f["owner_at"][pick] + offset
                digests = _digests(w, at, np.full(len(at), WINDOW))
                yield pa.RecordBatch.from_arrays(
                    [
                        *[pa.array(np.ascontiguousarray(d).view(np.int64)) for d in digests.T],
                        pa.repeat(b.column(1)[k], len(at)), pa.array(offset.astype(np.int32)),
                        *[pa.array(f[n][pick]) for n in names[4:]],
                    ],
                    names=names,
                )

    return joined.mapInArrow(run, "h1 bigint, h2 bigint, doc_id bigint, offset int, anchor bigint, sig bigint, sig2 bigint, before int, len int")


def _packed(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, packed): compressed texts take a third of the room in a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        for b in textvec.chunks(batches):
            yield pa.RecordBatch.from_arrays([b.column(1), b.column(2), pa.array([pack.compress((t.as_py() or "").encode()) for t in b.column(0)], pa.binary())], names=["doc_id", "text_key", "packed"])

    return _keyed(docs).select("text", "doc_id", "text_key").mapInArrow(run, "doc_id bigint, text_key bigint, packed binary")


def removed(docs: DataFrame, repeats: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text``: the words that no repeated window covers, joined by one space."""
    joined = _packed(docs).join(repeats, ["doc_id", "text_key"], "left").select("packed", "doc_id", "repeats")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for b in textvec.chunks(batches):
            n, gone, kept = [], [], []
            for packed, spans_ in zip(b.column(0), b.column(2)):
                found = unpack.decompress(packed.as_py()).split()
                n.append(len(found))
                if not spans_.is_valid:
                    gone.append(0)
                else:
                    step = np.zeros(len(found) + 1, np.int64)
                    at, length = (spans_.values.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                    np.add.at(step, at, 1)
                    np.add.at(step, at + length + WINDOW - 1, -1)
                    keep = np.cumsum(step[:-1]) == 0
                    gone.append(int(len(found) - keep.sum()))
                    found = [found[i] for i in np.flatnonzero(keep)]
                kept.append(b" ".join(found).decode())
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_text"])

    return joined.mapInArrow(run, "doc_id bigint, n_words bigint, n_removed bigint, kept_text string")


def dedup(docs: DataFrame, index: Index, documents: DataFrame | None = None) -> DataFrame:
    """Judge one batch against the index and itself, then add it to the index.

    ``documents`` must hold the texts of all documents in the index and the batch; by default the batch is all. Batches may
    come in any order of ids, but a document is judged against what has come so far. Null texts have no words; rows with a
    null id are returned whole; rows that repeat an id don't remove each other's words.
    """
    docs = docs.select("doc_id", "text")
    history = index.read()
    batch = index.append(spans(docs))
    return removed(docs, repeated(batch, history, docs if documents is None else documents))


def dedup_table(docs: DataFrame, batches: int = 2) -> DataFrame:
    """``dedup`` of a whole table as successive batches of ascending ids; their bounds are approximate quantiles of doc_id."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    spark = docs.sparkSession
    scratch.small_batches(spark)
    index = Index(spark, scratch.folder(spark, "passages"))
    cuts = sorted(set(docs.approxQuantile("doc_id", [i / batches for i in range(1, batches)], 0.01) or [])) if batches > 1 else []
    bounds = [None, *(int(c) for c in cuts), None]
    out = None
    for low, high in zip(bounds, bounds[1:]):
        part = docs.where((F.lit(True) if low is None else F.col("doc_id") >= low) & (F.lit(True) if high is None else F.col("doc_id") < high))
        if low is None:
            part = docs.where(F.col("doc_id").isNull() | (F.lit(True) if high is None else F.col("doc_id") < high))
        judged = dedup(part, index, docs if high is None else docs.where(F.col("doc_id") < high))
        out = judged if out is None else out.unionByName(judged)
    return out
