"""Matching of records as they arrive: an extension beside the batch plans."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import blocking as B
from ..operators import keys as K
from ..operators import ranking as R


def blocked_pool(pool: DataFrame, cap: int = B.SERVE_CAP) -> DataFrame:
    """Postings of the pool on active keys with their bucket sizes: prepared once, joined with each batch."""
    posted = K.postings(K.with_keys(pool))
    return posted.join(B.active_keys(posted, cap), "block_key")


def match_stream(records: DataFrame, blocked: DataFrame, most: int, write: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """For every micro-batch of s1 records, hand ``write`` the ``most`` best candidates by evidence of each. Batches are numbered, so that a repeated one can be told."""

    def handle(batch: DataFrame, number: int) -> None:
        q = K.postings(K.with_keys(batch.withColumn("pos", F.lit(0).cast("long")))).select(F.col("entity_id").alias("s1_id"), F.col("key_pos").alias("s1_key_pos"), "block_key")
        p = blocked.select(F.col("entity_id").alias("noisy_id"), F.col("pos").alias("noisy_pos"), F.col("key_pos").alias("noisy_key_pos"), "block_key", "bucket_len")
        write(R.ranked(R.evidence(p.join(q, "block_key")), most), number)

    return records.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
