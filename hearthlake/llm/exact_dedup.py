"""Exact deduplication with salted digest groups (operator 8)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthlake.llm.common import apart, ascii_lower, checkpointed, given, whole_text

#: Parts of one digest group; a third of 10^11 rows still leaves each part a few rows for every map task.
SALTS = 16


def sha256_digest(text: Column) -> Column:
    return F.sha2(text, 256)


def winners(rows: DataFrame, salts: int = SALTS) -> DataFrame:
    """One row for each different ``_text``: its digest, the largest doc_id and the number of rows.

    ``rows`` has doc_id, _text, _digest. Three stages, each with the whole text in its
    grouping key, so texts that only share a digest never meet: every map task combines
    its own rows; the parts of a digest group, told apart by a salt, are merged; the
    salts' winners are merged by digest. A group of copies reaches a salt as one row
    for each map task and the last stage as one row for each salt.
    """
    salted = (
        rows.withColumn("_salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)))
        .groupBy("_digest", "_salt", "_text")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    )
    # Dealt by the digest alone, so that what follows by digest needs no further shuffle.
    return (
        salted.repartition(F.col("_digest"))
        .groupBy("_digest", "_text")
        .agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    )


def exact_duplicates(
    docs: DataFrame, normal: Callable[[Column], Column] = ascii_lower, digest: Callable[[Column], Column] = sha256_digest, salts: int = SALTS
) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256, one row for each row of ``docs`` (doc_id, text).

    NULL text counts as empty. Of equal normalised texts the row with the largest
    doc_id stays; a NULL doc_id is smaller than any. Rows that repeat a doc_id with an
    equal text are one document: they count in group_size and share ``kept``. An empty
    table gives an empty result.

    The text is shuffled twice, by (digest, salt) and by digest. Rows find their group
    by the digest; only those of a digest with several texts find it by digest and text.
    """
    rows = docs.select("doc_id", normal(whole_text()).alias("_text")).withColumn("_digest", digest(F.col("_text")))
    won = winners(rows, salts)
    # One row per digest, which nearly always has one text; with several the digest alone doesn't tell the group.
    groups = checkpointed(
        won.groupBy("_digest").agg(
            F.count(F.lit(1)).alias("_texts"), F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size")
        )
    )
    kept = F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("doc_id").isNull() & F.col("keep_id").isNull())
    sha = F.col("_digest") if digest is sha256_digest else F.sha2("_text", 256)
    found = rows.withColumn("text_sha256", sha).select("doc_id", "_digest", "text_sha256").join(groups.where("_texts = 1"), "_digest")
    columns = ["doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256"]
    found = found.select(*columns)
    shared = groups.where("_texts > 1").select("_digest")
    if shared.isEmpty():
        return found
    by_text = rows.join(shared, "_digest", "left_semi").join(won, ["_digest", "_text"])
    return found.unionByName(by_text.withColumn("text_sha256", sha).select(*columns))


def without_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, all columns, whatever their names; of rows that repeat doc_id and text, one."""
    names, docs = docs.columns, apart(docs, "doc_id", "text")
    found = exact_duplicates(docs)
    kept = found.where("kept").groupBy(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha")).agg(F.count(F.lit(1)).alias("_rows"))
    match = F.col("doc_id").eqNullSafe(F.col("_id")) & (sha256_digest(ascii_lower(whole_text())) == F.col("_sha"))
    rows = docs.join(kept, match)
    once = rows.where("_rows = 1").select(*docs.columns)
    return once.unionByName(rows.where("_rows > 1").dropDuplicates(["_id", "_sha"]).select(*docs.columns)).toDF(*names)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(given(spark, sf_dir, "documents"))


ORACLE = """
WITH normal AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM normal WINDOW g AS (PARTITION BY t)
"""
