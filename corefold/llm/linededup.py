"""Removal of repeated lines by pairwise alignment.

A line is the text between line feeds without the white space around it; those without a word don't count. A collision-resistant digest (BLAKE2b, 128 bits) stands for a line, shifted by
its ordinal among equal lines of its document, so that in every document all of these *tokens* differ and any can anchor.

Documents overlap where they share rare lines: a token that ``RARE`` rows at most hold pairs each of them with all earlier ones. A token in more documents is
linked with the first that has it, its home: so a line in very many documents makes as many links, not their square, and none
is dropped for being frequent. Each pair is aligned by patience: the longest run of the tokens that link it which rises in both
documents. A line that no such alignment has is *open* if its block could be long enough, and is tried with all its other earlier
holders, over all the tokens that the two documents share, until one of them aligns it. Only open lines cost more than their links. Holders are
tried in growing ranges of their rank.

From the later document go the blocks (runs of aligned lines, whichever earlier documents they align with) of ``MIN_BLOCK_WORDS`` words or more: a
shorter run is no passage.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import scratch, textvec

MIN_BLOCK_WORDS = 8
RARE = 4
HOLDERS = 16  # ranks of an open line's holders that the first round tries; each further round goes up to so many times more

TOKENS = "k1 bigint, k2 bigint, doc_id bigint, text_key bigint, at int, words int"


def _tokens(w: textvec.Words) -> dict[str, np.ndarray]:
    """Tokens of a slice: row, ordinal ``at`` among the row's lines that have words, two hashes, number of words."""
    n = len(w.starts)
    if not n:
        return {k: np.zeros(0, np.int64) for k in ("row", "at", "words")} | {k: np.zeros(0, np.uint64) for k in ("k1", "k2")}
    feeds = np.searchsorted(np.flatnonzero(w.buf == 10), w.starts)
    new = np.ones(n, bool)
    new[1:] = (feeds[1:] != feeds[:-1]) | (w.row[1:] != w.row[:-1])
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:], [n])) - 1
    row = w.row[first]
    data = w.buf.tobytes()
    digests = b"".join(hashlib.blake2b(data[i:j], digest_size=16).digest() for i, j in zip(w.starts[first].tolist(), w.ends[last].tolist()))
    one, two = np.frombuffer(digests, "<u8").reshape(-1, 2).T
    order = np.lexsort((np.arange(len(first)), two, one, row))
    same = np.zeros(len(first), bool)
    same[1:] = (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1]) & (row[order][1:] == row[order][:-1])
    group = np.flatnonzero(~same)
    ordinal = np.empty(len(first), np.int64)
    ordinal[order] = np.arange(len(first)) - np.repeat(group, np.diff(np.concatenate((group, [len(first)]))))
    salt = textvec.mix(ordinal.astype(np.uint64) + np.uint64(5))
    return {"row": row, "at": np.arange(len(first)) - np.searchsorted(row, row), "words": last - first + 1, "k1": one + salt, "k2": two}


def tokens(docs: DataFrame) -> DataFrame:
    """``TOKENS`` of all documents with an id. Rows that repeat an id are told apart by a hash of their text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, _, buf, offsets in textvec.slices(b.column(0)):
                t = _tokens(textvec.words(buf, offsets))
                take = pa.array(t["row"] + at)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[pa.array(t[k].view(np.int64)) for k in ("k1", "k2")], b.column(1).take(take), b.column(2).take(take),
                        *[pa.array(t[k].astype(np.int32)) for k in ("at", "words")],
                    ],
                    names=["k1", "k2", "doc_id", "text_key", "at", "words"],
                )

    named = docs.select(F.col("text").cast("string").alias("text"), F.col("doc_id").cast("long").alias("doc_id")).withColumn("text_key", F.xxhash64("text"))
    return named.where("doc_id IS NOT NULL").mapInArrow(run, TOKENS)


def rising(values: np.ndarray) -> list[int]:
    """Indices of a longest strictly increasing subsequence (patience sorting)."""
    tails: list[int] = []
    ends: list[int] = []
    before = [-1] * len(values)
    for i, v in enumerate(values.tolist()):
        at = bisect_left(tails, v)
        before[i] = ends[at - 1] if at else -1
        tails[at : at + 1] = [v]
        ends[at : at + 1] = [i]
    out, i = [], ends[-1] if ends else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def aligned(pair: np.ndarray, at: np.ndarray, other_at: np.ndarray) -> np.ndarray:
    """The lines ``at`` of one later document that some alignment has. ``pair`` numbers the earlier documents."""
    order = np.lexsort((at, pair))
    pair, at, other_at = pair[order], at[order], other_at[order]
    new = np.ones(len(at), bool)  # a repeated row brings each token twice
    new[1:] = (pair[1:] != pair[:-1]) | (at[1:] != at[:-1])
    pair, at, other_at = pair[new], at[new], other_at[new]
    cuts = np.flatnonzero(np.diff(pair)) + 1
    kept = [at[lo:hi][rising(other_at[lo:hi])] for lo, hi in zip([0, *cuts], [*cuts, len(pair)])]
    return np.unique(np.concatenate(kept))


def blocks(at: np.ndarray, words: np.ndarray, least: int) -> np.ndarray:
    """Of the lines ``at`` (ascending): which are in runs of neighbours of ``least`` words or more."""
    if not len(at):
        return np.zeros(0, bool)
    block = np.cumsum(np.concatenate(([0], np.diff(at) != 1)))
    return np.bincount(block, weights=words)[block] >= least


def _shared(found: DataFrame) -> DataFrame:
    """The tokens that more than one document has, with their ``home_id, home_key, home_at`` and the number ``n`` of rows that hold them.

    The counts are written first: the join then shuffles both sides by itself, which lets Spark split a line that very many documents have.
    """
    counts = found.groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "text_key", "at")).alias("home"), F.max("doc_id").alias("high"), F.count("*").alias("n")).where("home.doc_id < high")
    counts, _ = scratch.table(counts.select("k1", "k2", F.col("home.doc_id").alias("home_id"), F.col("home.text_key").alias("home_key"), F.col("home.at").alias("home_at"), "n"), "lines-counts")
    return scratch.table(found.join(counts, ["k1", "k2"]), "lines-shared")[0]


def _first_aligned(shared: DataFrame, least: int) -> DataFrame:
    """Alignment of the linked pairs: ``doc_id, text_key``, the lines that an earlier document has (``at``, ``words``), those ``done`` (aligned) and those ``open``, and the lines ``gone``."""
    later = ["doc_id", "text_key", "at", "words"]
    homes = shared.where((F.col("n") > RARE) & (F.col("home_id") < F.col("doc_id"))).select(*later, "home_id", "home_key", "home_at")
    rare = shared.where(F.col("n") <= RARE)
    holders = rare.select("k1", "k2", F.col("doc_id").alias("home_id"), F.col("text_key").alias("home_key"), F.col("at").alias("home_at"))
    links = homes.union(rare.select("k1", "k2", *later).join(holders, ["k1", "k2"]).where("home_id < doc_id").select(*later, "home_id", "home_key", "home_at"))
    grouped = links.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct(F.xxhash64("home_id", "home_key").alias("pair"), "at", "home_at", "words")).alias("common"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in textvec.chunks(batches):
            out: list[list[np.ndarray]] = [[] for _ in range(5)]
            for row in b.column(2):
                pair, at, home_at, words = (row.values.field(i).to_numpy(zero_copy_only=False) for i in range(4))
                lines = aligned(pair, at, home_at)
                at, first = np.unique(at, return_index=True)
                words, done = words[first], np.isin(at, lines)
                gone = at[done][blocks(at[done], words[done], least)]
                for values, v in zip(out, (at, words, at[done], at[~done & blocks(at, words, least)], gone)):
                    values.append(v.astype(np.int32))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *[pa.array(v, pa.list_(pa.int32())) for v in out]], names=["doc_id", "text_key", "at", "words", "done", "open", "gone"])

    return grouped.mapInArrow(run, "doc_id bigint, text_key bigint, at array<int>, words array<int>, done array<int>, open array<int>, gone array<int>")


def _pair_aligned(pairs: DataFrame, mine: DataFrame, found: DataFrame) -> DataFrame:
    """``doc_id, text_key, more``: the lines that an alignment with one of the pairs' other documents (``e_id, e_key``) has, over all the tokens the two share."""
    others = pairs.select("e_id", "e_key").distinct()
    theirs = found.select(F.col("doc_id").alias("e_id"), F.col("text_key").alias("e_key"), "k1", "k2", F.col("at").alias("e_at")).join(others, ["e_id", "e_key"]).distinct()
    common = pairs.join(theirs, ["e_id", "e_key"]).join(mine, ["doc_id", "text_key", "k1", "k2"])
    grouped = common.groupBy("doc_id", "text_key", "e_id", "e_key").agg(F.sort_array(F.collect_list(F.struct("at", "e_at"))).alias("common")).select("doc_id", "text_key", "common")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in textvec.chunks(batches):
            more = []
            for row in b.column(2):
                at, e_at = (row.values.field(i).to_numpy(zero_copy_only=False) for i in range(2))
                more.append(at[rising(e_at)].astype(np.int32))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(more, pa.list_(pa.int32()))], names=["doc_id", "text_key", "more"])

    lines = grouped.mapInArrow(run, "doc_id bigint, text_key bigint, more array<int>")
    return lines.groupBy("doc_id", "text_key").agg(F.array_distinct(F.flatten(F.collect_list("more"))).alias("more"))


def _ranked(held: DataFrame) -> DataFrame:
    """Each token's holders with their ``rank`` by id. They are dealt to ranges, counted there, and shifted by the ranges before, so that a frequent line spans many tasks."""
    order = ["k1", "k2", "e_id", "e_key"]
    dealt, _ = scratch.table(held.repartitionByRange(*order).distinct().withColumn("range", F.spark_partition_id()), "lines-held")
    counts = dealt.groupBy("k1", "k2", "range").agg(F.count("*").alias("n"))
    before = Window.partitionBy("k1", "k2").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # over one row for each range
    shifts, _ = scratch.table(counts.select("k1", "k2", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift")), "lines-shifts")
    local = F.row_number().over(Window.partitionBy("k1", "k2", "range").orderBy("e_id", "e_key"))
    return dealt.withColumn("local", local).join(shifts, ["k1", "k2", "range"]).select(*order, (F.col("local") + F.col("shift")).alias("rank"))


def _settled(found: DataFrame, state: DataFrame, least: int) -> DataFrame:
    """``(doc_id, text_key, gone)`` of the documents of ``state`` that have open lines, once all earlier holders of these have been tried."""
    state = state.where(F.size("open") > 0).select("doc_id", "text_key", "at", "words", "done", "open")
    mine, _ = scratch.table(found.join(state.select("doc_id", "text_key"), ["doc_id", "text_key"], "left_semi").select("doc_id", "text_key", "k1", "k2", "at").distinct(), "lines-mine")
    keys = lambda s: s.select("doc_id", "text_key", F.explode("open").alias("at")).join(mine, ["doc_id", "text_key", "at"]).select("doc_id", "text_key", "k1", "k2")
    # Written first, and repeated rows are dropped behind the next shuffle, so that no task has all rows of a frequent line.
    asked, _ = scratch.table(keys(state).groupBy("k1", "k2").agg(F.max("doc_id").alias("high")), "lines-asked")
    held = found.join(asked, ["k1", "k2"]).where("doc_id < high").select("k1", "k2", F.col("doc_id").alias("e_id"), F.col("text_key").alias("e_key"))
    holders, _ = scratch.table(_ranked(held), "lines-holders")
    most = holders.agg(F.max("rank")).first()[0] or 0
    # An equal text aligns all lines, whatever its rank.
    firsts = found.where("at = 0").join(state.select("text_key").distinct(), "text_key").groupBy("text_key").agg(F.min("doc_id").alias("e_id"))
    copies = state.select("doc_id", "text_key").join(firsts, "text_key").where("e_id < doc_id").select("doc_id", "text_key", "e_id", F.col("text_key").alias("e_key"))
    low, high = 0, HOLDERS
    while low < most:
        near = holders.where((F.col("rank") > low) & (F.col("rank") <= high)).drop("rank")
        pairs = keys(state).join(near, ["k1", "k2"]).where("e_id < doc_id").select("doc_id", "text_key", "e_id", "e_key")
        more = _pair_aligned((pairs.union(copies) if low == 0 else pairs).distinct(), mine, found)
        none = F.array().cast("array<int>")
        joined = state.join(more, ["doc_id", "text_key"], "left").withColumn("more", F.coalesce("more", none))
        state, _ = scratch.table(joined.select("doc_id", "text_key", "at", "words", F.array_union("done", "more").alias("done"), F.array_except("open", "more").alias("open")), "lines-open")
        low, high = high, high * HOLDERS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in textvec.chunks(batches):
            gone = []
            for row in zip(*b.columns[2:]):
                at, words, done = (v.values.to_numpy(zero_copy_only=False) for v in row)
                kept = np.isin(at, done)
                gone.append(at[kept][blocks(at[kept], words[kept], least)].astype(np.int32))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(gone, pa.list_(pa.int32()))], names=["doc_id", "text_key", "gone"])

    return state.select("doc_id", "text_key", "at", "words", "done").mapInArrow(run, "doc_id bigint, text_key bigint, gone array<int>")


def repeated(docs: DataFrame, least: int = MIN_BLOCK_WORDS) -> DataFrame:
    """``(doc_id, text_key, gone)``: ordinals of the lines to delete, for the documents that have such."""
    found, _ = scratch.table(tokens(docs), "lines-tokens")
    shared = _shared(found)
    state, _ = scratch.table(_first_aligned(shared, least).where("size(open) > 0 OR size(gone) > 0"), "lines-first")
    return state.where("size(open) = 0").select("doc_id", "text_key", "gone").union(_settled(shared, state, least)).where(F.size("gone") > 0)


def without(text: str, gone: np.ndarray) -> tuple[str, int]:
    """The text without those lines, and how many of its lines have words. Lines without words go with the deleted line before them."""
    kept, n, drop, gone = [], 0, False, set(gone.tolist())
    for line in text.split("\n"):
        if line.strip(" \t\n\v\f\r"):
            drop = n in gone
            n += 1
        if not drop:
            kept.append(line)
    return "\n".join(kept), n


def dedup(docs: DataFrame, least: int = MIN_BLOCK_WORDS, counts: tuple[str, str] = ("__n_lines", "__n_removed")) -> DataFrame:
    """``docs`` (with ``doc_id`` and ``text``) with the repeated lines deleted from ``text``, and the columns ``counts``: its lines that have words, and how many of them were deleted.

    All rows stay, and all columns whatever their names, but those named like ``counts``. A text of which nothing is left is empty; null texts stay null; texts of
    any length are read whole. Rows with a null id neither own nor lose lines; rows that repeat an id don't remove each other's lines.
    """
    rest = [c for c in docs.columns if c not in ("doc_id", "text", *counts)]
    row = F.struct(*[F.col(f"`{c}`") for c in rest]) if rest else F.lit(None).cast("int")
    source = docs.select(F.col("text").cast("string").alias("text"), F.col("doc_id").cast("long").alias("doc_id"), row.alias("row")).withColumn("key", F.xxhash64("text"))
    packed_schema = source.select("doc_id", "row", "key").schema.add("packed", "binary")
    out_schema = source.select("doc_id", "row").schema.add("text", "string").add("n_lines", "long").add("n_removed", "long")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        for b in textvec.chunks(batches):
            small = pa.array([squeeze.compress(t.as_py().encode()) if t.is_valid else None for t in b.column(0)], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns[1:], small], names=packed_schema.names)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        nothing = np.zeros(0, np.int32)
        for b in textvec.chunks(batches):
            texts, n_lines, n_gone = [], [], []
            for small, gone in zip(b.column(1), b.column(0)):
                lost = gone.values.to_numpy(zero_copy_only=False) if gone.is_valid else nothing
                text, n = without(unpack.decompress(small.as_py()).decode(), lost) if small.is_valid else (None, 0)
                texts.append(text)
                n_lines.append(n)
                n_gone.append(len(lost))
            yield pa.RecordBatch.from_arrays([*b.columns[2:], pa.array(texts, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_gone, pa.int64())], names=out_schema.names)

    packed = source.select("text", "doc_id", "row", "key").mapInArrow(pack, packed_schema)
    # Merged, and so shuffled, at every size: a broadcast where the deletions are few would only hide what the texts take of a shuffle at size.
    gone = repeated(docs, least).select(F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_key"), "gone").hint("merge")
    joined = packed.join(gone, (F.col("doc_id") == F.col("gone_id")) & (F.col("key") == F.col("gone_key")), "left")
    out = joined.select("gone", "packed", "doc_id", "row").mapInArrow(cut, out_schema)
    return out.select(*[F.col(c) if c in ("doc_id", "text") else F.col(f"row.`{c}`") for c in docs.columns if c not in counts], *[F.col(c).alias(name) for c, name in zip(("n_lines", "n_removed"), counts)])
