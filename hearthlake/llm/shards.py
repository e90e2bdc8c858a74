"""Proportional stratified interleaving into shards (operator 2). DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthlake.llm.common import ROWS_PER_BUCKET, bucket_bits, checkpointed, given, leading, ranked, seeded, whole_text

SEED = 7
SHARDS = 16


def interleaved(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """doc_id, size, text_crc32, source, shard and slot, one row for each row of ``docs`` (doc_id, text, source).

    Rows are shuffled within their source by a seeded key and ranked. A row's fractional
    rank is (rank + u) / rows of its source, u a seeded share in [0, 1) for each source,
    so that many small sources don't all stand at one place. All rows sorted by it and
    cut into equal runs give shards whose counts differ by one at most (the law is
    ``rows``) and in which every source has its share to within two rows.

    size is the UTF-8 bytes of the text plus 1, NULL text counts as empty. NULL source is
    a source of its own. Ties of the key (a doc_id that repeats) are ordered by checksum
    and size; rows alike in all of these are interchangeable. An empty table gives an
    empty result. The text itself is read once and never shuffled.
    """
    rows = checkpointed(
        docs.select(
            "doc_id",
            (F.octet_length(whole_text()) + 1).cast("long").alias("size"),
            F.crc32(whole_text()).alias("text_crc32"),
            "source",
            F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("s"), "source")).alias("_source"),
            seeded(seed, "doc_id").alias("_key"),
        )
    )
    count = rows.count()
    bits = bucket_bits(count, rows_per_bucket)
    ties = [F.col("text_crc32"), F.col("size")]
    in_source = ranked(rows.withColumn("_bucket", leading(F.col("_key"), bits)), ["_source"], "_bucket", [F.col("_key"), *ties], "_rank", sizes="_rows_of_source")
    share = F.conv(F.substring(seeded(seed, "_source"), 1, 8), 16, 10).cast("long") / F.lit(2.0**32)
    place = (F.col("_rank") + share) / F.col("_rows_of_source")
    placed = in_source.drop("_bucket").withColumn("_place", place).withColumn("_part", F.floor(F.col("_place") * F.lit(2**bits)))
    in_all = ranked(placed, [], "_part", [F.col("_place"), F.col("_source"), F.col("_key"), *ties], "_position")
    shard = F.floor(F.col("_position") * F.lit(shards) / F.lit(max(1, count)))
    # Whole numbers only: a quotient in floating point would be off by one beyond 2^53.
    shard = F.expr(f"(_position * {shards}L) div {max(1, count)}L") if count else shard
    first = F.expr(f"(_shard * {count}L + {shards - 1}L) div {shards}L")
    return in_all.withColumn("_shard", shard).select(
        "doc_id", "size", "text_crc32", "source", F.col("_shard").cast("int").alias("shard"), (F.col("_position") - first).cast("long").alias("slot")
    )


def op2_proportional_interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = interleaved(given(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source"
    )
