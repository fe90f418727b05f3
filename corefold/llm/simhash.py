"""Near-duplicate groups by SimHash with meet-in-the-middle ball hashing.

Each distinct fingerprint emits itself and its one-bit variants (half of the radius of two). Two fingerprints within
two bits share a variant, and all that share a variant are within two bits of each other, so a variant's bucket holds
65 distinct fingerprints at most whatever the data. Copies are merged before variants are made.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import graph, scratch, textvec

BITS = 64
RADIUS = 2
SHINGLE = 3
SEED = 42


def fingerprint(text: str | None, size: int = SHINGLE, seed: int = SEED) -> int:
    """A bit is set if over half of the shingles' XXH64 have it; 0 without words."""
    return int(_fingerprint((text or "").encode(), size, seed))


def _fingerprint(data: bytes, size: int, seed: int) -> np.uint64:
    found = data.lower().split()  # of bytes, both go by ASCII alone
    if not found:
        return np.uint64(0)
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(found) > size:
        starts, ends = starts[: len(found) - size + 1], ends[size - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    ones, n = np.zeros(BITS, np.int64), len(starts)
    for at in range(0, n, 4096):
        hashes = np.array([digest(joined[s:e], seed) for s, e in zip(starts[at : at + 4096].tolist(), ends[at : at + 4096].tolist())], np.uint64)
        # Counts of 255 rows at a time fit a byte, so that the sums stay narrow.
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        for block in range(0, len(bits), 255):
            ones += bits[block : block + 255].sum(axis=0, dtype=np.uint8)
    return np.packbits((2 * ones > n).astype(np.uint8), bitorder="little").view(np.uint64)[0]


def fingerprints(docs: DataFrame, text: str = "text", size: int = SHINGLE, seed: int = SEED, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and ``fp`` (the fingerprint's 64 bits as a long). Null and blank texts get 0."""
    schema = docs.select(*keep).schema.add("fp", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in textvec.chunks(batches):
            fp = np.fromiter((_fingerprint((t.as_py() or "").encode(), size, seed) for t in b.column(0)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(fp.view(np.int64))], names=[*keep, "fp"])

    return docs.select(F.col(text).cast("string").alias("__text"), *keep).mapInArrow(run, schema)


def links(fps: DataFrame) -> DataFrame:
    """Verified links ``(a, b)`` between the distinct fingerprints ``fp``; enough to connect all within two bits."""
    variants = F.array(F.lit(0).cast("long"), *[F.expr(f"shiftleft(1L, {i})") for i in range(BITS)])
    # A fixed number of partitions: small as the fingerprints are, their 65 variants each are made on all cores.
    spread = fps.select("fp").repartition(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")
    emitted = spread.select("fp", F.explode(variants).alias("flip")).select(F.expr("fp ^ flip").alias("variant"), "fp")
    # 65 members at most share a variant: all differ from it by one bit at most.
    met = emitted.groupBy("variant").agg(F.sort_array(F.collect_list("fp")).alias("ms")).where(F.size("ms") > 1)
    pairs = met.select(F.col("ms")[0].alias("b"), F.explode(F.expr("slice(ms, 2, size(ms) - 1)")).alias("a"))
    return pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS).select("a", "b").distinct()


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """One row per input row: ``doc_id``, ``fingerprint`` (16 hex digits), ``component_id`` (the smallest doc_id that is reachable).

    Rows with a null id take part with their fingerprint but don't name a group; component_id is null where no row of the group has an
    id. Rows without words have fingerprint 0 and link like others.
    """
    base, _ = scratch.table(fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text", size, seed), "simhash-fp")
    return base.join(_groups(base), "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _groups(base: DataFrame) -> DataFrame:
    """``(fp, component, component_id)`` of the distinct fingerprints: their group's smallest fingerprint and smallest doc_id."""
    reps, _ = scratch.table(base.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-rep")
    found = graph.components(links(reps))
    named = reps.join(found, reps.fp == found.node, "left").select("fp", "rep", F.coalesce("component", "fp").alias("component"))
    return named.drop("rep").join(named.groupBy("component").agg(F.min("rep").alias("component_id")), "component")


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` (with ``doc_id`` and ``text``) with one row of each near-duplicate group: that with the smallest id, nulls last; of equals one."""
    keyed = docs.select("*", F.xxhash64("doc_id", "text").alias("__k1"), F.xxhash64("text", "doc_id").alias("__k2"))
    base, _ = scratch.table(fingerprints(keyed, keep=("doc_id", "__k1", "__k2")), "simhash-fp")
    first = base.join(_groups(base), "fp").groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "__k1", "__k2")).alias("r"))
    return keyed.join(first.select("r.__k1", "r.__k2"), ["__k1", "__k2"], "left_semi").dropDuplicates(["__k1", "__k2"]).select(*docs.columns)
