"""Union of partial results and keep-last deduplication."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values.
KEY_CANDIDATES = ["propertydetails_propertyid", "url"]


def collect_union(frames: Iterable[DataFrame]) -> DataFrame:
    """All rows of all frames; a column absent from a frame is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def dedup_key(df: DataFrame) -> str | None:
    """The key column to deduplicate on: the property id, else the url, else none."""
    by_lower = {c.lower(): c for c in df.columns}
    return next((by_lower[k] for k in KEY_CANDIDATES if k in by_lower), None)


def dedup_keep_last(
    df: DataFrame, order: Sequence[Column | str], key: str | None = None
) -> DataFrame:
    """One row per key, the last one by ``order``; rows without key form one group.

    ``order`` should be unique within a key, or the row kept among equals is open.
    Filtering ``row_number`` to 1 lets Spark limit every key to one row per map task
    before the shuffle, so a key that holds a third of the rows arrives as one row
    per task. A frame without a key column is returned as it is.
    """
    key = key or dedup_key(df)
    if key is None:
        return df
    latest_first = [F.desc(o) if isinstance(o, str) else o.desc() for o in order]
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*latest_first))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def dedup_counts(df: DataFrame, key: str) -> DataFrame:
    """Rows before and after deduplication on ``key``, and the difference."""
    counts = df.agg(
        F.count("*").alias("rows_before"),
        (F.countDistinct(key) + F.coalesce(F.max(F.col(key).isNull().cast("int")), F.lit(0))).alias("rows_after"),
    )
    return counts.withColumn("duplicates_removed", F.col("rows_before") - F.col("rows_after"))
