"""Hot keys: joins whose hot side must be split, and results that stay whole."""

import pytest
from pyspark.sql import functions as F

from hearthlake.functions.keys import MERGE_KEY, NORMALIZED_PRICE
from hearthlake.functions.text import SITE
from hearthlake.operators import changes, extract

ROWS = 60_000

# Small limits, so that the adaptive split shows on little data.
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture
def small_limits(spark):
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    yield spark
    for name in SETTINGS:
        spark.conf.unset(name)


def final_plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def hot(column, share=3):
    return F.when(F.col("id") % share == 0, F.lit("hot")).otherwise(column)


def test_a_listing_linked_from_a_third_of_all_pages(small_limits):
    spark = small_limits
    number = (F.col("id") % 500).cast("string")
    results = spark.range(0, ROWS, 1, 16).select(
        F.col("id").alias("page_id"),
        F.concat(F.lit('<a href="/'), hot(number), F.lit('-pid1">x</a>')).alias("html"),
    )
    names = spark.range(500).select(F.col("id").cast("string").alias("n")).union(
        spark.range(1).select(F.lit("hot").alias("n"))
    )
    details = names.select(
        F.concat(F.lit("/"), "n", F.lit("-pid1")).alias("url"), F.concat(F.lit("<h1>"), "n", F.lit("</h1>")).alias("html")
    )
    found = extract.extract_listings(results, details, "2024-01-01")
    assert len(found.collect()) == ROWS
    assert "SortMergeJoin(skew=true)" in final_plan(found)
    assert found.filter(F.col("url") == f"{SITE}/hot-pid1").count() == ROWS // 3


def test_a_property_that_is_a_third_of_all_candidates(small_limits):
    spark = small_limits
    key = hot(F.col("id").cast("string"))
    candidates = spark.range(0, ROWS, 1, 16).select(
        key.alias("id"), F.concat(key, F.lit("-"), (F.col("id") % 2).cast("string")).alias("fingerprint"),
        F.lit("f").alias("is_prefix"), F.lit("buy").alias("rentOrBuy"), F.lit("c").alias("city"),
        F.lit("t").alias("propertyType"), F.lit(0).alias("radius"), (F.col("id") % 2).alias("last_normalized_price"),
    )
    keys = spark.range(ROWS).select(F.col("id").cast("string").alias(MERGE_KEY))
    existing = keys.union(spark.range(1).select(F.lit("hot"))).withColumn(NORMALIZED_PRICE, F.lit(0))
    changed = changes.changed_or_new(candidates, existing)
    assert len(changed.collect()) == ROWS // 2
    assert "skew=true" in final_plan(changed)
    assert changed.filter("id = 'hot'").count() == ROWS // 6


def test_a_frequent_id_reaches_a_semi_join_once_per_task(small_limits):
    spark = small_limits
    ids = spark.range(0, ROWS, 1, 16).select(hot(F.col("id").cast("string")).alias("id"))
    existing = spark.range(ROWS).select(F.col("id").cast("string").alias(MERGE_KEY))
    kept = changes.existing_semi(existing, ids)
    assert kept.count() == ROWS - ROWS // 3
    assert "HashAggregate" in final_plan(kept)
