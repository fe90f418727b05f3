"""Near-duplicate groups by the Jaccard similarity of word shingles; SimHash balls first, then a prefix filter for what they miss; exact.

A document is the set of its runs of ``SHINGLE`` words (one run of all its words where they are fewer; lower case). Sets that are alike enough share one of
their first shingles in any common order (prefix filter). The order here puts shingles that are frequent in a sample last, which
matters for the cost alone. Equal sets are merged first. Of those that share a prefix shingle, each is compared with the
smallest, as are those whose SimHash fingerprints are within two bits (the balls of ``simhash``); then those that are in different groups yet are compared pairwise, so a group of near copies costs links in proportion to its size.
Each set has a bit for each of ``BITS`` ranges of hashes, on if it has an odd number of shingles there. Two sets differ in as many shingles at
least as in bits, which rules out most pairs. Where sets are large for so many bits, the others are tried with two bits or more for each
shingle; the sets of those that are left are intersected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType

from . import graph, scratch, simhash, textvec

SHINGLE = 5
SIMILARITY = 0.8
BITS = 512
SAMPLE = 8  # one text in so many is read for the order of the shingles
OFTEN = 4  # as often in the sample, a shingle is frequent
MOST_BROADCAST = 100_000  # rows of three longs, under 10 MB
MOST_FREQUENT = 100_000  # what goes to every worker; the rest are ordered like rare ones


def shingles(buf: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and hashes of the rows' distinct shingles, in ascending order of both."""
    w = textvec.words(buf, offsets)
    if not len(w.starts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    words = w.hashes()
    at, hashes = textvec.grams(words, w, size)
    short = np.flatnonzero((w.counts() > 0) & (w.counts() < size))
    row = np.concatenate((w.row[at], short))
    hashes = np.concatenate((hashes, textvec.folded(words, w.first[short], w.counts()[short])))
    order = np.lexsort((hashes, row))
    row, hashes = row[order], hashes[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])
    return row[new], hashes[new]


def least_shared(n: np.ndarray, threshold: float) -> np.ndarray:
    """How many of ``n`` shingles a set must share at least."""
    return np.ceil(threshold * n - 1e-9).astype(np.int64)


def parities(row: np.ndarray, hashes: np.ndarray, n_rows: int) -> np.ndarray:
    """``BITS`` bits a row, as longs."""
    cells, times = np.unique(row * BITS + (hashes >> np.uint64(64 - BITS.bit_length() + 1)).astype(np.int64), return_counts=True)
    odd = cells[times % 2 == 1]
    out = np.zeros(n_rows * BITS // 8, np.uint8)
    np.bitwise_or.at(out, odd >> 3, (1 << (odd & 7)).astype(np.uint8))
    return out.view(np.int64)


def wide_parities(row: np.ndarray, hashes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of more than ``BITS`` / 2 shingles at least twice as many bits, a power of two, by the hashes' low bits; how many longs a row has, and all longs."""
    width = np.where(2 * n > BITS, 1 << np.ceil(np.log2(np.maximum(2 * n, 2))).astype(np.int64), 0)
    start = np.concatenate(([0], np.cumsum(width)))
    large = width[row] > 0
    row, hashes = row[large], textvec.mix(hashes[large])
    cells, times = np.unique(start[row] + (hashes & (width[row] - 1).astype(np.uint64)).astype(np.int64), return_counts=True)
    odd = cells[times % 2 == 1]
    out = np.zeros(start[-1] // 8, np.uint8)
    np.bitwise_or.at(out, odd >> 3, (1 << (odd & 7)).astype(np.uint8))
    return width // 64, out.view(np.int64)


def fingerprints(row: np.ndarray, hashes: np.ndarray, n: np.ndarray) -> np.ndarray:
    """SimHash fingerprints of the rows' sets: a bit is set if over half of the shingles' hashes have it; 0 without shingles. Rows ascend."""
    ones = np.zeros((len(n), simhash.BITS), np.int64)
    for at in range(0, len(hashes), 65536):
        bits = np.unpackbits(textvec.mix(hashes[at : at + 65536]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        rows = row[at : at + 65536]
        starts = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
        ones[rows[starts]] += np.add.reduceat(bits, starts, axis=0, dtype=np.int64)
    return np.packbits((2 * ones > n[:, None]).astype(np.uint8), axis=1, bitorder="little").view(np.int64).ravel()


def _lists(row: np.ndarray, values: np.ndarray, n_rows: int) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(np.bincount(row, minlength=n_rows)))).astype(np.int32)), pa.array(values.view(np.int64)))


def _sets(docs: DataFrame, keep: list[str], size: int) -> DataFrame:
    """The columns ``keep`` and ``items``, the shingles of ``text``."""
    schema = docs.select(*keep).schema.add("items", ArrayType(LongType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, to, buf, offsets in textvec.slices(b.column(0)):
                row, hashes = shingles(buf, offsets, size)
                yield pa.RecordBatch.from_arrays([*b.slice(at, to - at).columns[1:], _lists(row, hashes, to - at)], names=schema.names)

    return docs.select(F.lower(F.col("text").cast("string")).alias("__text"), *keep).mapInArrow(run, schema)


def frequent(docs: DataFrame, size: int) -> np.ndarray:
    """Shingles that are frequent in a sample of the distinct texts, sorted."""
    sample = docs.select("text", F.xxhash64("text").alias("key")).where(F.pmod("key", F.lit(SAMPLE)) == 0)
    items = _sets(sample, ["key"], size).dropDuplicates(["key"]).select(F.explode("items").alias("item"))
    often, _ = scratch.table(items.groupBy("item").count().where(F.col("count") >= OFTEN), "near-frequent")  # written, so that its shuffles go at once
    rows = often.orderBy(F.col("count").desc(), "item").limit(MOST_FREQUENT).collect()
    return np.sort(np.array([r.item for r in rows], np.int64).view(np.uint64))


def _prefixes(keyed: DataFrame, last: np.ndarray, size: int, threshold: float) -> DataFrame:
    """``doc_id, __k1, __k2``, the set's hash ``s`` (0: no words), its size ``n``, its ``prefix``, its ``bits``, its ``wide`` bits (none where ``bits`` are enough) and its fingerprint ``fp``."""
    keep = ["doc_id", "__k1", "__k2"]
    schema = keyed.select(*keep).schema.add("s", "long").add("n", IntegerType()).add("prefix", ArrayType(LongType())).add("bits", ArrayType(LongType())).add("wide", ArrayType(LongType())).add("fp", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, to, buf, offsets in textvec.slices(b.column(0)):
                row, hashes = shingles(buf, offsets, size)
                n = np.bincount(row, minlength=to - at)
                first = np.concatenate(([0], np.cumsum(n)))
                sums = np.zeros(len(hashes) + 1, np.uint64)
                np.cumsum(textvec.mix(hashes ^ np.uint64(0x9E3779B97F4A7C15)), out=sums[1:], dtype=np.uint64)
                s = np.where(n > 0, textvec.mix((sums[first[1:]] - sums[first[:-1]]) ^ n.astype(np.uint64)), np.uint64(0))
                bits = pa.ListArray.from_arrays(pa.array((np.arange(to - at + 1) * (BITS // 64)).astype(np.int32)), pa.array(parities(row, hashes, to - at)))
                longs, wide = wide_parities(row, hashes, n)
                wide = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(longs))).astype(np.int32)), pa.array(wide))
                fp = pa.array(fingerprints(row, hashes, n))
                if len(last) and len(hashes):
                    found = last[np.minimum(np.searchsorted(last, hashes), len(last) - 1)] == hashes
                    order = np.lexsort((hashes, found, row))
                    hashes = hashes[order]
                early = np.arange(len(hashes)) - first[row] < (n - least_shared(n, threshold) + 1)[row]
                yield pa.RecordBatch.from_arrays(
                    [*b.slice(at, to - at).columns[1:], pa.array(s.view(np.int64)), pa.array(n.astype(np.int32)), _lists(row[early], hashes[early], to - at), bits, wide, fp], names=schema.names
                )

    return keyed.select(F.lower(F.col("text").cast("string")).alias("__text"), *keep).mapInArrow(run, schema)


def _room(n: Column, other_n: Column, threshold: float) -> Column:
    """In how many shingles sets of so many may differ."""
    return F.lit((1 - threshold) / (1 + threshold)) * (n + other_n) + 1e-6


def _may_be_alike(n: Column, bits: Column, other_n: Column, other_bits: Column, threshold: float) -> Column:
    """Whether the bits leave room for the threshold: sets differ in as many shingles at least as in bits."""
    differ = sum((F.bit_count(bits[i].bitwiseXOR(other_bits[i])) for i in range(BITS // 64)), F.lit(0))
    return differ <= _room(n, other_n, threshold)


def _wide_differ() -> Column:
    """In how many bits ``widea`` and ``wideb`` differ, the longer folded to the other's length; 0 where either has none."""
    fold = lambda x: f"if(size({x}) = m, {x}, transform(sequence(0, m - 1), i -> aggregate(sequence(i, size({x}) - 1, m), 0L, (all, j) -> all ^ {x}[j])))"
    count = f"aggregate(zip_with({fold('widea')}, {fold('wideb')}, (p, q) -> bit_count(p ^ q)), 0, (all, k) -> all + k)"
    return F.expr(f"transform(array(least(coalesce(size(widea), 0), coalesce(size(wideb), 0))), m -> if(m <= 0, 0, {count}))[0]")


def _alike(pairs: DataFrame, keyed: DataFrame, base: DataFrame, size: int, threshold: float) -> DataFrame:
    """Those pairs ``(a, b)`` of set hashes whose Jaccard similarity is ``threshold`` or more."""
    path = scratch.folder(keyed.sparkSession, "near-links")
    with scratch.passing(keyed.sparkSession):
        known = base.select("s", F.struct("n", "bits").alias("known")).dropDuplicates(["s"])
        side = lambda c: known.select(F.col("s").alias(c), F.col("known.n").alias(f"n{c}"), F.col("known.bits").alias(f"bits{c}"))
        near = pairs.distinct().join(side("a"), "a").join(side("b"), "b").where(_may_be_alike(F.col("na"), F.col("bitsa"), F.col("nb"), F.col("bitsb"), threshold))
        near, _ = scratch.table(near.select("a", "b", "na", "nb"), "near-bits")
        large = base.where(F.size("wide") > 0).select("s", "wide").dropDuplicates(["s"])
        wide = lambda c: large.select(F.col("s").alias(c), F.col("wide").alias(f"wide{c}"))
        near = near.join(wide("a"), "a", "left").join(wide("b"), "b", "left").where(_wide_differ() <= _room(F.col("na"), F.col("nb"), threshold))
        pairs, _ = scratch.table(near.select("a", "b"), "near-pairs")
        nodes = pairs.select(F.col("a").alias("s")).union(pairs.select("b")).distinct()
        rows = base.join(nodes, "s").groupBy("s").agg(F.min(F.struct("__k1", "__k2")).alias("k")).select("s", F.col("k.__k1").alias("__k1"), F.col("k.__k2").alias("__k2"))
        rows, _ = scratch.table(rows, "near-rows")
        rows = F.broadcast(rows) if rows.count() <= MOST_BROADCAST else rows  # where they are few, the texts stay where they are
        texts = keyed.select("text", "__k1", "__k2").join(rows, ["__k1", "__k2"]).dropDuplicates(["__k1", "__k2"])
        sets, _ = scratch.table(_sets(texts, ["s"], size), "near-sets")
        both = pairs.join(sets.select(F.col("s").alias("a"), F.col("items").alias("x")), "a").join(sets.select(F.col("s").alias("b"), F.col("items").alias("y")), "b")
        shared = F.size(F.array_intersect("x", "y"))
        return scratch.write(both.where(shared >= F.lit(threshold) * (F.size("x") + F.size("y") - shared) - 1e-9).select("a", "b"), path)


def ball_pairs(base: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` of set hashes, a < b, whose fingerprints are equal or within two bits: each set with the smallest of its fingerprint, and the smallest of two fingerprints."""
    sets = base.select("fp", "s", "n").distinct()
    reps, _ = scratch.table(sets.groupBy("fp").agg(F.min(F.struct("s", "n")).alias("low")), "near-balls")
    same = sets.join(reps, "fp").select(F.col("low").alias("x"), F.struct("s", "n").alias("y"))
    side = lambda c, out: reps.select(F.col("fp").alias(c), F.col("low").alias(out))
    pairs = same.union(simhash.links(reps.select("fp")).join(side("a", "x"), "a").join(side("b", "y"), "b").select("x", "y"))
    return pairs.where("x.s <> y.s").select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).select(F.col("x.s").alias("a"), F.col("y.s").alias("b"), F.col("x.n").alias("na"), F.col("y.n").alias("nb"))


def groups(keyed: DataFrame, base: DataFrame, size: int, threshold: float) -> DataFrame:
    """``(node, component)`` of the set hashes that have a link."""
    bucket = Window.partitionBy("item")
    entries = base.select("s", "n", F.explode("prefix").alias("item"))
    met = entries.withColumns({"low": F.min(F.struct("s", "n")).over(bucket), "high": F.max("s").over(bucket)}).where("low.s < high")
    met, _ = scratch.table(met.select("item", "s", "n", F.col("low.s").alias("a"), F.col("low.n").alias("na")).distinct(), "near-met")
    fits = lambda x, y: F.least(x, y) >= F.lit(threshold) * F.greatest(x, y) - 1e-9
    first = met.where(F.col("a") < F.col("s")).where(fits("n", "na")).select("a", F.col("s").alias("b"))
    links = _alike(ball_pairs(base).where(fits("na", "nb")).select("a", "b").union(first), keyed, base, size, threshold)
    found = graph.components(links)
    named = met.join(found, met.s == found.node, "left").select("item", "s", "n", F.coalesce("component", "s").alias("c"))
    mixed = named.groupBy("item").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("item")
    # The bits go along, so that pairs are judged where they meet and only those that may be alike are shuffled.
    open_, _ = scratch.table(named.join(mixed, "item").join(base.select("s", "bits").dropDuplicates(["s"]), "s"), "near-open")
    other = open_.select("item", F.col("s").alias("b"), F.col("n").alias("nb"), F.col("c").alias("cb"), F.col("bits").alias("bitsb"))
    may = fits("n", "nb") & _may_be_alike(F.col("n"), F.col("bits"), F.col("nb"), F.col("bitsb"), threshold)
    cross = open_.join(other, "item").where((F.col("s") < F.col("b")) & (F.col("c") != F.col("cb")) & may).select(F.col("s").alias("a"), "b")
    # The smallest of each bucket has been compared with all.
    tried = met.where(F.col("a") < F.col("s")).select("a", F.col("s").alias("b")).distinct()
    more = _alike(cross.distinct().join(tried, ["a", "b"], "left_anti"), keyed, base, size, threshold)
    return graph.components(links.union(more)) if more.head(1) else found


def one_of_each(docs: DataFrame, size: int = SHINGLE, threshold: float = SIMILARITY) -> DataFrame:
    """``docs`` (with ``doc_id`` and ``text``) with one row of each group that similarities of ``threshold`` or more connect: that with the smallest id, nulls last; of equals
    that with the smallest hash of the row, and of rows equal in all columns one.

    Texts without words (null, empty, blank) are one group. Texts of any length are read whole. All columns stay, whatever their names.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rest = [F.col(f"`{f.name}`") for f in docs.schema if f.name not in ("doc_id", "text") and "map<" not in f.dataType.simpleString()]
    keys = F.xxhash64("doc_id", "text", *rest).alias("__k1"), F.xxhash64("text", "doc_id", *rest).alias("__k2")
    keyed = docs.select(F.struct(*columns).alias("row"), "doc_id", "text", *keys)
    spark = docs.sparkSession
    path = scratch.folder(spark, "near-kept")
    with scratch.passing(spark):
        base, _ = scratch.table(_prefixes(keyed, frequent(docs, size), size, threshold), "near-prefix")
        found = groups(keyed, base, size, threshold)
        named = base.select("doc_id", "__k1", "__k2", "s").join(found, F.col("s") == F.col("node"), "left").withColumn("component", F.coalesce("component", "s"))
        first = named.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "__k1", "__k2")).alias("r"))
        kept = scratch.write(first.select("r.__k1", "r.__k2"), path)
    return keyed.select("row", "__k1", "__k2").join(kept, ["__k1", "__k2"], "left_semi").dropDuplicates(["__k1", "__k2"]).select("row.*")
