"""The serving table in folders of city and month, and lookups in the stored table."""

import pytest
from pyspark.sql import functions as F

from hearthlake.functions.keys import MERGE_KEY, with_merge_key
from hearthlake.operators import analytics
from hearthlake.plans import refresh, reports
from hearthlake.sources import serving, snapshots

CITIES = ["hanoi", "hue", "", None, "12", "a/b=c d"]


@pytest.fixture(scope="module")
def listings(spark):
    """240 listings over six cities and twelve months; some without a readable date, price or area."""
    n = F.col("id")
    return spark.range(240).select(
        F.concat(F.lit("u"), n).alias("url"),
        F.when(n % 11 != 0, (n * 1000).cast("string")).otherwise("Thỏa thuận").alias("muc_gia"),
        F.when(n % 13 != 0, F.concat(20 + n, F.lit(" m²"))).alias("dien_tich"),
        F.lit("here").alias("ia_chi"),
        F.when(n % 7 != 0, F.date_add(F.lit("2023-01-01").cast("date"), (n * 3 / 2).cast("int")).cast("string")).otherwise("soon").alias("ngay_ang"),
        F.array(*[F.lit(c) for c in CITIES])[(n % 6).cast("int")].alias("search_city"),
        n.alias("seq"),
    )


@pytest.fixture(scope="module")
def folders(spark, listings, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("served"))
    refresh.merge_listings(listings, f"{root}/bronze", ["seq"])
    refresh.publish(spark, f"{root}/bronze", f"{root}/serving")
    return root


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_published_rows_and_columns_are_those_of_the_stored_table(spark, listings, folders):
    served = serving.read_served(spark, f"{folders}/serving")
    assert served.columns == [*listings.columns, MERGE_KEY.lower()]
    assert rows(served.select(listings.columns)) == rows(listings)
    typed = serving.read_served(spark, f"{folders}/serving", typed=True)
    kinds = {f.name: f.dataType.simpleString() for f in typed.schema.fields}
    assert [kinds[c] for c in (serving.PRICE, serving.AREA, serving.POSTED)] == ["double", "double", "date"]
    want = analytics.with_numbers(listings).select("seq", "price", "area", F.col("ngay_ang").try_cast("date"))
    assert rows(typed.select("seq", serving.PRICE, serving.AREA, serving.POSTED)) == rows(want)


@pytest.mark.parametrize("cities", ["hanoi", ["hue", "12"], "a/b=c d", ["nowhere"], "", None])
def test_a_city_is_read_from_its_folders(spark, listings, folders, cities):
    served = serving.read_served(spark, f"{folders}/serving", cities)
    wanted = [cities] if isinstance(cities, str) else cities
    want = listings if not cities else listings.where(F.col("search_city").isin(wanted))
    assert rows(served.select("seq", "search_city")) == rows(want.select("seq", "search_city"))
    if cities:
        partition_filters = plan(served).split("PartitionFilters: [")[1].split("PushedFilters")[0]
        assert serving.CITY in partition_filters


@pytest.mark.parametrize("days", [1, 30, 70, 1000])
def test_trends_read_the_latest_months_only(spark, listings, folders, days):
    got = reports.latest_trends(spark, f"{folders}/serving", days)
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in analytics.recent_trends(listings, days).collect()]
    since = serving.month_of_latest_dates(spark, f"{folders}/serving", days)
    dates = {r.date.isoformat() for r in analytics.recent_trends(listings, 1000).collect()}
    months = sorted({d[:7] for d in dates}, reverse=True)
    read = months.index(since) + 1
    assert read == len(months) or sum(d[:7] >= since for d in dates) >= days
    # Half as many months would not have been enough.
    assert read <= 2 or sum(d[:7] >= months[(read + 1) // 2 - 1] for d in dates) < days
    partition_filters = plan(got).split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert f"{serving.MONTH}" in partition_filters and since in partition_filters


def test_a_lookup_reads_one_bucket_with_the_key_pushed_down(spark, listings, folders):
    key = with_merge_key(listings).where("seq = 17").first()[MERGE_KEY]
    found = snapshots.read_key(spark, f"{folders}/bronze", MERGE_KEY, key)
    assert [r.seq for r in found.collect()] == [17]
    assert f"EqualTo({MERGE_KEY},{key})" in plan(found) and "md5" not in plan(found)
    live, _ = snapshots.live_buckets(spark, f"{folders}/bronze", 0)
    assert len(found.inputFiles()) == 1 < len(live)
    assert snapshots.read_key(spark, f"{folders}/bronze", MERGE_KEY, "no such key").count() == 0
    assert snapshots.read_key(spark, f"{folders}/nothing", MERGE_KEY, key) is None


def test_stored_files_are_sorted_by_key(folders):
    from pathlib import Path

    import pyarrow.parquet as pq

    for file in Path(folders, "bronze").rglob("*.parquet"):
        stored = pq.ParquetFile(file).read(columns=[MERGE_KEY]).column(0).to_pylist()
        assert stored == sorted(stored)
        at = pq.ParquetFile(file).metadata.row_group(0).to_dict()["columns"]
        assert any(c["path_in_schema"] == MERGE_KEY and c["statistics"]["has_min_max"] for c in at)


def test_publishing_reads_the_stored_table_once_and_a_missing_row_ends_the_job(spark, folders, tmp_path, monkeypatch):
    root = str(tmp_path / "serving")
    whole = serving.read_served
    monkeypatch.setattr(refresh, "read_served", lambda *a: whole(*a).limit(239))
    with pytest.raises(RuntimeError, match="published 239 of 240 rows"):
        refresh.publish(spark, f"{folders}/bronze", root)


def test_publishing_no_rows_and_rows_without_the_known_columns(spark, folders, tmp_path):
    root = str(tmp_path / "serving")
    published = refresh.publish(spark, f"{folders}/bronze", root, "nowhere")
    assert published.count() == 0 and "search_city" in published.columns
    assert reports.latest_trends(spark, root).count() == 0
    assert serving.read_served(spark, root, "hanoi", "2023-01").count() == 0
    other = spark.range(3).select(F.col("id").alias("a"))
    assert serving.write_served(other, root) == 3
    assert rows(serving.read_served(spark, root, "hanoi")) == [(0,), (1,), (2,)]
    assert serving.month_of_latest_dates(spark, root, 30) is None
    assert serving.read_served(spark, str(tmp_path / "none")) is None
