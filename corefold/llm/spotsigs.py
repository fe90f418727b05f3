"""SpotSigs document fingerprints, with DataFrame functions only.

A signature is a chain of content words that follows a common word (the anchor): for each anchor, its next ``CHAIN``
content words, skipping common words between. A document's fingerprint is its set of signatures; the likeness of two
fingerprints is the Jaccard similarity of their sets. A text with no signature has one for its whole word sequence, so
only equal such texts are alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Common words of English, French, German and Spanish that anchor a chain.
ANCHORS = (
    "a an and are as at be by for from had has have he in is it its of on or she that the their there they this to was were which will with you "
    "au aux ce dans de des du elle en est et il la le les leur ne nous on ou par pas pour que qui se son sur un une vous "
    "als am auf aus bei das dem den der die ein eine er es für hat ich im ist mit nach nicht sich sie sind und von war wie zu "
    "al como con del el ella era esta este ha los las lo más no para pero por sin su sus una y"
).split()
CHAIN = 2
SIMILARITY = 0.8
ROWS_PER_BLOCK = 2000
MOST_CUTS = 1000
MOST_BLOCKS = 100_000  # what names their first ids fits a broadcast


def words(text: str | Column) -> Column:
    """Lower-case runs of letters, marks and digits; null counts as empty."""
    text = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}\p{N}]+"), lambda w: w != "")


def _signatures(w: str) -> tuple[Column, Column]:
    """Of the column of words named ``w``: the places of its content words, and, for each of them, the signatures of the common words just before it."""
    common = sorted(set(ANCHORS))
    content = F.filter(F.transform(w, lambda x, i: F.when(x.isin(common), F.lit(-1)).otherwise(i)), lambda i: i >= 0)
    chains = F.transform(
        F.col("__content"),
        lambda at, j: F.when(
            (j + CHAIN <= F.size("__content")) & (at > F.when(j > 0, F.get("__content", j - 1)).otherwise(F.lit(-1)) + 1),
            F.transform(
                F.slice(w, F.when(j > 0, F.get("__content", j - 1) + 2).otherwise(F.lit(1)), at - F.when(j > 0, F.get("__content", j - 1)).otherwise(F.lit(-1)) - 1),
                lambda anchor: F.xxhash64(anchor, *[F.get(F.col(w), F.get("__content", j + k)) for k in range(CHAIN)]),
            ),
        ).otherwise(F.array().cast("array<bigint>")),
    )
    return content, chains


def with_signatures(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add the column ``name``: the distinct signatures of the column ``text``."""
    content, chains = _signatures("__w")
    whole = F.array(F.xxhash64(F.lit("whole"), F.array_join("__w", " ")))
    out = df.withColumn("__w", words(text)).withColumn("__content", content).withColumn("__s", F.array_distinct(F.flatten(chains)))
    return out.withColumn(name, F.when(F.size("__s") > 0, F.col("__s")).otherwise(whole)).drop("__w", "__content", "__s")


def fingerprint(signatures: str | Column) -> Column:
    """A digest of the set: 64 hex digits."""
    return F.sha2(F.array_join(F.transform(F.array_sort(signatures), lambda s: F.hex(s)), ","), 256)


def likeness(a: str, b: str) -> Column:
    """Jaccard similarity of two sets of signatures, 0 to 1."""
    shared = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(shared.cast("double") / (F.size(a) + F.size(b) - shared))


def with_next(docs: DataFrame, derive=None, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """``doc_id, text`` (null: empty) with its successor by ascending id as the struct ``next``; the first follows the last.

    Rows are dealt to blocks of neighbouring ids: approximate quantiles of the ids (``MOST_CUTS`` at most), each cut evenly by value, ``MOST_BLOCKS`` in all or twice that at most. A
    block also gets a copy of the row that follows it. Null ids come first; rows that repeat an id are in the order of their
    texts. ``derive`` may add columns to a row, once and before its successor's are taken over.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ids = docs.select("doc_id")
    n_rows, low, high = ids.agg(F.count("*"), F.min("doc_id"), F.max("doc_id")).first()
    blocks = min(max(1, -(-n_rows // rows_per_block)), MOST_BLOCKS)
    cuts: list[int] = []
    if blocks > 1 and low is not None:
        n = min(blocks, MOST_CUTS)
        cuts = sorted({*ids.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 10 * n)).first()[0]} - {low})
    within = -(-blocks // (len(cuts) + 1))
    block = _block(F.col("doc_id"), cuts, low, high, within)
    order = Window.orderBy("block")
    firsts = ids.select(block.alias("block"), "doc_id").groupBy("block").agg(F.min("doc_id").alias("doc_id"))
    # One row for each block: twice MOST_BLOCKS at most, since each of the cuts' ranges has the same number of blocks.
    follows = F.broadcast(firsts.withColumn("block", F.lag("block").over(order)).where("block IS NOT NULL"))
    top = docs.orderBy(F.asc_nulls_first("doc_id"), "text").limit(1)
    last = firsts.agg(F.max("block").alias("block"))
    rows = (
        docs.select("*", block.alias("block"), F.lit(0).alias("copy"))
        .unionByName(docs.join(follows, "doc_id").select("doc_id", "text", "block", F.lit(1).alias("copy")))
        .unionByName(top.join(F.broadcast(last)).select("doc_id", "text", "block", F.lit(2).alias("copy")))
    )
    dealt = rows.repartition("block")
    if derive is not None:
        dealt = derive(dealt)
    window = Window.partitionBy("block").orderBy("copy", F.asc_nulls_first("doc_id"), "text")
    more = [c for c in dealt.columns if c not in ("block", "copy")]
    return dealt.withColumn("next", F.lead(F.struct(*more)).over(window)).where("copy = 0").drop("block", "copy")


def _block(ids: Column, cuts: list[int], low: int | None, high: int | None, within: int) -> Column:
    """A block's number, ascending with the ids."""
    edges = F.array(*[F.lit(c).cast("long") for c in [low or 0, *cuts, high or 0]])
    at = F.size(F.filter(F.array(*[F.lit(c).cast("long") for c in cuts]), lambda c: c <= ids)) if cuts else F.lit(0)
    at = at.cast("long")
    if within == 1:
        return at
    start, end = F.get(edges, at.cast("int")), F.get(edges, at.cast("int") + 1)
    part = F.floor((ids - start).cast("double") / (F.greatest(end - start, F.lit(1)) + 1) * within)
    return at * within + F.least(F.coalesce(part, F.lit(0)), F.lit(within - 1)).cast("long")


def edit_likeness(docs: DataFrame) -> DataFrame:
    """Fingerprints of each document and of its edited text: the last half of its characters gives way to as many of its successor's first."""
    rows = with_next(docs, lambda d: with_signatures(d, "text", "signatures"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    out = rows.withColumn("n_chars", F.char_length("text").cast("long"))
    out = out.withColumn("edited_text", F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")), F.substring(F.col("next.text"), F.lit(1), half)))
    return with_signatures(out, "edited_text", "edited_signatures").withColumn("next_signatures", F.col("next.signatures"))


def compared(docs: DataFrame) -> DataFrame:
    """The digest of ``edit_likeness``: one row per document."""
    out = edit_likeness(docs)
    return out.select(
        "doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"),
        fingerprint("signatures").alias("fingerprint"), fingerprint("edited_signatures").alias("edited_fingerprint"),
        likeness("signatures", "edited_signatures").alias("near_edited"), likeness("signatures", "next_signatures").alias("near_next"),
    )


def _prefixed(df: DataFrame, id_: str, threshold: float) -> DataFrame:
    """Each distinct set's first signatures in a global order (their hashes'): sets that are alike enough share one of them. ``part`` numbers geometric ranges of set sizes."""
    sets = with_signatures(df.select(F.col("doc_id").cast("long").alias(id_), F.col("text").cast("string").alias("text")), "text", "s").drop("text")
    sized = sets.withColumns({"s": F.sort_array("s"), "n": F.size("s")})
    part = F.col("n") if threshold >= 1 else F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1 / threshold)) + 1e-9).cast("int")
    least = F.ceil(F.lit(threshold) * F.col("n") - 1e-9).cast("int")
    return sized.withColumns({"part": part, "prefix": F.slice("s", F.lit(1), F.col("n") - least + 1)})


def similar(queries: DataFrame, docs: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """``query_id, doc_id, likeness`` of all documents (``doc_id, text``) with a Jaccard similarity of ``threshold`` or more to a query; exact.

    Documents are partitioned by set size, in ranges by the factor ``1 / threshold``: a query looks in its own and the two next to it. Within a partition the
    sets that share a prefix signature are compared, those first ruled out whose sizes alone forbid the likeness. Null ids take no part.
    """
    q = _prefixed(queries.where("doc_id IS NOT NULL"), "query_id", threshold)
    d = _prefixed(docs.where("doc_id IS NOT NULL"), "doc_id", threshold)
    left = q.select("query_id", "s", "n", F.explode(F.array(F.col("part") - 1, F.col("part"), F.col("part") + 1)).alias("part"), "prefix")
    left = left.select("query_id", F.col("s").alias("qs"), F.col("n").alias("qn"), "part", F.explode("prefix").alias("sig"))
    right = d.select("doc_id", "s", "n", "part", F.explode("prefix").alias("sig"))
    fits = (F.col("n") >= F.lit(threshold) * F.col("qn") - 1e-9) & (F.col("qn") >= F.lit(threshold) * F.col("n") - 1e-9)
    alike = right.join(left, ["part", "sig"]).where(fits).withColumn("likeness", likeness("qs", "s")).where(F.col("likeness") >= threshold)
    return alike.select("query_id", "doc_id", "likeness").distinct()
