"""Deduplication, change detection, upsert and checks."""

import random

import pytest
from pyspark.sql import functions as F

from hearthlake.functions.keys import MERGE_KEY, NORMALIZED_PRICE
from hearthlake.operators import changes, checks, dedup, upsert


def plan(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


def test_keep_last_takes_the_highest_order(spark):
    rows = [("a", 1, 9, "old"), ("a", 2, 1, "new"), ("b", 1, 1, "only"), (None, 1, 1, "n1"), (None, 1, 2, "n2")]
    frame = spark.createDataFrame(rows, "url string, version int, seq int, v string")
    got = {r.url: r.v for r in dedup.dedup_keep_last(frame, ["version", "seq"]).collect()}
    assert got == {"a": "new", "b": "only", None: "n2"}


def test_keep_last_key_choice(spark):
    frame = spark.createDataFrame([("k", "u", 1), ("k", "v", 2)], f"{MERGE_KEY} string, url string, seq int")
    assert dedup.dedup_key(frame) == MERGE_KEY
    assert dedup.dedup_keep_last(frame, ["seq"]).count() == 1
    assert dedup.dedup_keep_last(frame, ["seq"], "url").count() == 2
    keyless = frame.select("seq")
    assert dedup.dedup_keep_last(keyless, ["seq"]).count() == 2


def test_hot_key_is_cut_before_the_shuffle(spark):
    rows = spark.range(0, 30000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("url"),
        F.col("id").alias("seq"),
    )
    kept = dedup.dedup_keep_last(rows, ["seq"])
    text = plan(kept)
    exchange = text.index("Exchange hashpartitioning")
    assert "Partial" in text[exchange:], "no limit per key below the shuffle"
    assert kept.count() == 20001
    assert kept.filter("url = 'hot'").first().seq == 29997


def test_dedup_counts_treats_missing_key_as_one(spark):
    frame = spark.createDataFrame([("a",), ("a",), (None,), (None,)], "url string")
    assert tuple(dedup.dedup_counts(frame, "url").first()) == (4, 2, 2)
    assert tuple(dedup.dedup_counts(frame.filter("false"), "url").first()) == (0, 0, 0)


def test_collect_union_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    b = spark.createDataFrame([(2.5, 2)], "d double, n int")
    got = dedup.collect_union([a, b, a.filter("false")]).orderBy("n").collect()
    assert [tuple(r) for r in got] == [(1, "x", None), (2, None, 2.5)]


CANDIDATES = (
    "id string, fingerprint string, is_prefix string, rentOrBuy string, city string, "
    "propertyType string, radius int, last_normalized_price long"
)
EXISTING = f"{MERGE_KEY} string, {NORMALIZED_PRICE} long"


def test_changed_or_new_against_brute_force(spark):
    rng = random.Random(3)
    stored = {f"p{i}": rng.choice([None, 1, 2, 3]) for i in range(60)}
    found = []
    for i in range(90):
        price = rng.choice([None, 1, 2, 3])
        found.append((f"p{i}", None if price is None else f"p{i}-{price}", "f", "buy", "c", "t", 0, price))
    found.append((None, "x-1", "f", "buy", "c", "t", 0, 1))
    expected = set()
    for row in found:
        key, mark = row[0], row[1]
        old = None if stored.get(key) is None else f"{key}-{stored[key]}"
        if old is None or (mark is not None and mark != old):
            expected.add(key)
    candidates = spark.createDataFrame(found, CANDIDATES)
    existing = spark.createDataFrame(list(stored.items()), EXISTING)
    changed = changes.changed_or_new(candidates, existing)
    got = [r.id for r in changed.collect()]
    assert len(got) == len(set(got)) and set(got) == expected
    assert changed.columns == changes.CANDIDATE_COLUMNS
    unchanged = candidates.filter("id is not null").join(changed.select("id"), "id", "left_anti").count()
    assert unchanged + len(got) == len(found)


def test_existing_semi(spark):
    existing = spark.createDataFrame([("a", 1), ("b", 2)], EXISTING)
    ids = spark.createDataFrame([("a",), ("a",), ("z",)], "id string")
    assert [r[0] for r in changes.existing_semi(existing, ids).collect()] == ["a"]


def upserted(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_upsert_updates_inserts_and_is_idempotent(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2)], f"{MERGE_KEY} string, n int")
    source = spark.createDataFrame([("b", 20), ("c", 30)], f"{MERGE_KEY} string, n int")
    once = upsert.upsert_by_key(target, source)
    assert upserted(once) == [("a", 1), ("b", 20), ("c", 30)]
    assert upserted(upsert.upsert_by_key(once, source)) == upserted(once)


def test_upsert_keeps_columns_of_both_sides(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], f"old int, {MERGE_KEY} string")
    source = spark.createDataFrame([("b", 20)], f"{MERGE_KEY} string, new int")
    merged = upsert.upsert_by_key(target, source)
    assert merged.columns == ["old", MERGE_KEY, "new"]
    assert sorted(map(tuple, merged.collect()), key=str) == [(1, "a", None), (None, "b", 20)]


def test_schema_diff(spark):
    old = spark.createDataFrame([], "a int, b string, c int")
    new = spark.createDataFrame([], "a int, b int, d int")
    assert checks.schema_diff(old, new) == [
        ("a", "int", "int", "same"), ("b", "string", "int", "changed"),
        ("c", "int", None, "removed"), ("d", None, "int", "added"),
    ]
    assert not checks.is_compatible(old, new) and checks.is_compatible(old, old)
    assert checks.schema_diff_frame(spark, old, new).count() == 4


@pytest.mark.parametrize(("published", "ok"), [(5, True), (4, False), (0, False)])
def test_verify_counts(spark, published, ok):
    assert tuple(checks.verify_counts(spark.range(5), spark.range(published)).first()) == (5, published, ok)


def test_verify_counts_of_empty_tables(spark):
    assert tuple(checks.verify_counts(spark.range(0), spark.range(0)).first()) == (0, 0, True)
