import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from hearthlake.operators import analytics, charts, profile
from hearthlake.plans import reports

SCHEMA = "muc_gia string, dien_tich string, ia_chi string, ngay_ang string"


def listings(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows(frame):
    return [tuple(r) for r in frame.collect()]


MARKET = [
    ("1000000000", "100 m²", "A", "2024-01-01"),
    ("3000000000", "50 m²", "A", "2024-01-02"),
    ("12000000000", "80,5 m²", "B", "2024-01-02"),
    ("Thỏa thuận", "70 m²", "A", "2024-01-03"),
    ("2000000000", None, "B", "2024-01-01"),
    (None, "60 m²", "C", "2024-01-01"),
    ("500000000", "0 m²", None, "bad"),
    ("0", "10 m²", "C", None),
]


def test_basic_stats(spark):
    frame = analytics.basic_stats(listings(spark, MARKET))
    assert rows(frame) == [(5, "3,300,000,000", "0", "12,000,000,000", "193.", 3)]


def test_basic_stats_of_nothing(spark):
    assert rows(analytics.basic_stats(listings(spark, []))) == [(0, None, None, None, None, 0)]


def test_price_by_city_ranks_by_number(spark):
    frame = analytics.price_by_city(listings(spark, MARKET))
    assert rows(frame) == [
        ("B", 1, "12,000,000,000", "12,000,000,000", "12,000,000,000", "14,906,832"),
        ("A", 2, "2,000,000,000", "1,000,000,000", "3,000,000,000", "35,000,000"),
    ]


def test_location_distribution_shares_are_of_all_locations(spark):
    many = [("1", "1 m²", f"L{i:03}", "2024-01-01") for i in range(40) for _ in range(1 + i % 4)]
    frame = analytics.location_distribution(listings(spark, many + [("1", "1 m²", None, "2024-01-01")]))
    got = rows(frame)
    assert len(got) == 20 and len(many) == 100
    assert got[0] == ("L003", 4, 4.0, "1", "1.")
    assert [g[0] for g in got] == sorted((g[0] for g in got), key=lambda n: (-(1 + int(n[1:]) % 4), n))
    whole = analytics.location_distribution(listings(spark, many), top=50)
    assert sum(r[2] for r in rows(whole)) == pytest.approx(100, abs=0.5)
    assert rows(analytics.location_distribution(listings(spark, []))) == []


def test_percentage_rounds_half_up(spark):
    # 1 of 800 is 0.125 percent.
    many = [("1", "1 m²", "big", "d")] * 799 + [("1", "1 m²", "one", "d")]
    assert {r[0]: r[2] for r in rows(analytics.location_distribution(listings(spark, many)))} == {
        "big": 99.88, "one": 0.13,
    }


def test_recent_trends_takes_the_latest_dates_with_data(spark):
    days = [("1000", "10 m²", "A", f"2024-01-{d:02}") for d in range(1, 30, 2)]
    got = rows(analytics.recent_trends(listings(spark, days + MARKET), days=3))
    assert [str(r[0]) for r in got] == ["2024-01-29", "2024-01-27", "2024-01-25"]
    assert got[0][1:] == (1, "1,000", "10.")
    assert len(rows(analytics.recent_trends(listings(spark, MARKET)))) == 2


def test_price_ranges(spark):
    edges = [("999999999", "1 m²"), ("1000000000", "2 m²"), ("2999999999", None), ("10000000000", "3 m²"), ("0", "9 m²")]
    frame = analytics.price_ranges(listings(spark, [(p, a, "x", "d") for p, a in edges]))
    assert rows(frame) == [
        ("< 1 tỷ", 1, 25.0, "1."), ("1-3 tỷ", 2, 50.0, "2."), ("> 10 tỷ", 1, 25.0, "3."),
    ]


def test_top_expensive_areas(spark):
    data = [("c1", "d1", 900.0, 10.0)] * 5 + [("c1", None, 1000.0, 10.0)] * 5 + [("c2", "d2", 9e9, 1.0)] * 4
    data += [("c3", "d3", 900.0, 5.0)] * 5 + [("c4", "d4", 1.0, 0.0)] * 9
    frame = spark.createDataFrame(data, "city string, district string, price double, area double")
    assert rows(analytics.top_expensive_areas(frame)) == [
        ("c1", 5, "1,000", "1,000", "100"), ("d1", 5, "900", "900", "90"), ("d3", 5, "900", "900", "180"),
    ]
    assert len(rows(analytics.top_expensive_areas(frame, limit=1))) == 1


def test_city_value_counts(spark):
    frame = spark.createDataFrame([("b",), ("a",), ("a",), (None,)], "search_city string")
    assert rows(analytics.city_value_counts(frame)) == [("a", 2), ("b", 1)]


@pytest.mark.parametrize("values", [[1.0, 2.0, 2.5, 10.0], [3.0, 3.0], list(np.linspace(8, 24, 777)), [5.0]])
def test_histogram_against_numpy(spark, values):
    text = [str(v) for v in values] + ["n/a", "", None, "NaN"]
    frame = spark.createDataFrame([(t,) for t in text], "latitude string")
    got = rows(analytics.histogram(frame, "latitude", 7))
    counts, edges = np.histogram(values, bins=7)
    assert [g[2] for g in got] == list(counts)
    assert [g[1] for g in got] == pytest.approx(list(edges[:-1]))


def test_histogram_of_nothing(spark):
    assert rows(analytics.histogram(spark.createDataFrame([("x",)], "v string"), "v")) == []


@pytest.mark.parametrize("accuracy", [5, 40, 100_000])
def test_exact_quantiles_against_numpy(spark, accuracy):
    rng = random.Random(accuracy)
    columns = {
        "many": [rng.gauss(0, 1) for _ in range(900)],
        "hot": [7.0] * 300 + [rng.random() * 100 for _ in range(500)],
        "few": [1.0, 2.0],
        "one": [4.5],
        "six": [1.0, 2.0, 3.0, 4.0, 5.0, 6.0],
    }
    data = [(name, v) for name, values in columns.items() for v in values]
    frame = spark.createDataFrame(data, "column string, value double").repartition(5)
    asked = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = {(r.column, r["quantile"]): r.result for r in profile.exact_quantiles(frame, asked, accuracy).collect()}
    for name, values in columns.items():
        for q in asked:
            assert got[name, q] == pytest.approx(np.quantile(values, q)), (name, q)


def test_describe_against_pandas(spark):
    pdf = pd.DataFrame(
        {"t": ["b", "a", "a", None, "c"], "n": [1.0, 2.0, None, 4.0, 10.0], "k": [5, 5, 6, 7, 8], "empty": [None] * 5}
    )
    frame = spark.createDataFrame(
        [tuple(None if pd.isna(v) else v for v in row) for row in pdf.itertuples(index=False)],
        "t string, n double, k long, empty string",
    )
    got = {r.column: r for r in profile.describe(frame).collect()}
    assert (got["t"]["count"], got["t"].unique, got["t"].top, got["t"].freq) == (4, 3, "a", 2)
    assert (got["empty"]["count"], got["empty"].unique, got["empty"].top, got["empty"].freq) == (0, 0, None, None)
    expected = pdf[["n", "k"]].describe()
    for name in ("n", "k"):
        mine = [got[name][c] for c in ("count", "mean", "std", "min", "p25", "p50", "p75", "max")]
        assert mine == pytest.approx(list(expected[name]))


def test_charts(spark):
    market = listings(spark, MARKET)
    bars = rows(charts.overview_bars(analytics.basic_stats(market)))
    assert bars == [("Tổng BĐS", 5.0), ("Giá TB (tỷ)", 3.3), ("Diện tích TB (m²)", 193.0), ("Số TP", 3.0)]
    assert rows(charts.price_bars(analytics.price_by_city(market), 1)) == [("B", "B", 1, 12e9, 12.0)]
    trends = analytics.recent_trends(market)
    assert [(str(d), label) for d, label, _ in rows(charts.trend_lastdays(trends, 1))] == [("2024-01-02", "01-02")]
    scatter = rows(charts.trend_scatter(trends))
    assert [(str(r[0]), r[1], r[4]) for r in scatter] == [("2024-01-01", 1, 10), ("2024-01-02", 2, 20)]
    shares = charts.location_shares(analytics.location_distribution(market), 2)
    assert [r.location for r in shares.collect()] == ["A", "B"]
    assert charts.location_bars(analytics.location_distribution(market), 1).count() == 1


def test_reports_by_name(spark):
    results = reports.run_reports(listings(spark, MARKET), limit=1)
    assert list(results) == reports.SERVING_REPORTS
    assert all(len(rows(df)) == 1 for df in results.values())
    assert all(r.description for r in reports.REPORTS.values())
    whole = reports.run_reports(listings(spark, MARKET), ["price_ranges"], limit=None)
    assert len(rows(whole["price_ranges"])) == 4


def test_bad_rows_never_fail_a_report(spark):
    bad = [(p, a, "x", d) for p in ("", ".", "1.2.3", "Thỏa thuận", None) for a in ("", "..", None) for d in ("x", None)]
    for df in reports.run_reports(listings(spark, bad)).values():
        df.collect()
    assert analytics.with_numbers(listings(spark, bad)).filter(F.col("price").isNotNull()).count() == 0


@pytest.mark.parametrize("which", ["market", "bad", "empty", "places"])
def test_reports_in_one_pass_agree(spark, which):
    bad = [(p, a, x, d) for p in ("", "1.2.3", "0", "-5", None, "7") for a in ("", "0", "40", None) for x in ("x", None) for d in ("x", None, "2024-01-02")]
    made = {
        "market": MARKET,
        "bad": bad,
        "empty": [],
        "places": [(str(10**8 * (i % 90)), str(i % 50), f"p{i % 25}", f"2024-0{1 + i % 9}-{10 + i % 17}") for i in range(600)],
    }[which]
    frame = spark.createDataFrame(made, "muc_gia string, dien_tich string, ia_chi string, ngay_ang string") if which == "empty" else listings(spark, made)
    once, each = reports.run_reports_in_one_pass(frame), reports.run_reports(frame)
    assert list(once) == list(each)
    for name in each:
        assert once[name].columns == each[name].columns
        assert once[name].collect() == each[name].collect(), name


def test_the_summary_scans_the_listings_once(spark, tmp_path):
    folder = str(tmp_path / "listings")
    listings(spark, MARKET).write.parquet(folder)
    plan = analytics.market_summary(spark.read.parquet(folder))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and plan.count("Exchange") == 1


@pytest.mark.parametrize("accuracy,most", [(20, 40), (100, 10), (1000, 10**6)])
def test_brackets_are_narrowed_until_they_fit(spark, accuracy, most):
    draw = np.random.default_rng(accuracy)
    made = {
        "wide": draw.normal(size=20_000),
        "tied": draw.integers(0, 7, 20_000).astype(float),
        "hot": np.where(draw.random(20_000) < 0.4, 3.0, draw.random(20_000) * 9),
        "gone": np.where(draw.random(20_000) < 0.5, np.nan, draw.random(20_000)),
    }
    frame = spark.createDataFrame(pd.DataFrame(made))
    found = {r.column: r for r in profile._number_profile(frame, list(made), accuracy, most).collect()}
    for name, values in made.items():
        values = values[~np.isnan(values)]
        assert found[name]["count"] == len(values) and found[name].min == values.min() and found[name].max == values.max()
        assert np.allclose([found[name][f"p{p}"] for p in (25, 50, 75)], np.quantile(values, [0.25, 0.5, 0.75]), rtol=1e-12, atol=0)


def test_profile_scans_three_times(spark, tmp_path):
    folder = str(tmp_path / "profiled")
    spark.createDataFrame([(1, 2.5, "a"), (2, None, "b"), (4, float("nan"), "a")], "n int, x double, t string").write.parquet(folder)
    frame = profile.describe(spark.read.parquet(folder))
    # One scan ran while the frame was built, two are in its plan.
    assert frame._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 2
    empty = spark.createDataFrame([], "n int, x double")
    assert [(r["count"], r.mean, r.p50) for r in profile.describe(empty).collect()] == [(0, None, None)] * 2
