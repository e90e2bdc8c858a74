"""Market reports over the published listings.

Input columns are the sanitized names of the serving table; price (``muc_gia``) and
area (``dien_tich``) are text and cleaned once per row. A row whose price or area holds
no number is left out where the report needs it. Amounts come out as formatted text,
rankings use the number behind it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthlake.functions.numbers import clean_number, format_area, format_money

# Fixed values.
LOCATION_TOP = 20
TREND_DAYS = 30
MIN_AREA_LISTINGS = 5
TOP_AREAS = 10
PRICE_BANDS = [
    (1_000_000_000, "< 1 tỷ"),
    (3_000_000_000, "1-3 tỷ"),
    (5_000_000_000, "3-5 tỷ"),
    (10_000_000_000, "5-10 tỷ"),
]
TOP_BAND = "> 10 tỷ"


def with_numbers(listings: DataFrame) -> DataFrame:
    """Add ``price`` and ``area`` as doubles, NULL where the text holds no number."""
    return listings.withColumns(
        {"price": clean_number(F.col("muc_gia")), "area": clean_number(F.col("dien_tich"))}
    )


def _priced(listings: DataFrame) -> DataFrame:
    return with_numbers(listings).filter(F.col("price").isNotNull() & F.col("area").isNotNull())


def _money(aggregate: Column, name: str) -> Column:
    return format_money(aggregate).alias(name)


def _percentage(count: Column, total: Column) -> Column:
    # Decimal division, so that a half in the third decimal is rounded up exactly.
    share = F.lit(100).cast("decimal(3,0)") * count.cast("decimal(18,0)") / total.cast("decimal(18,0)")
    return F.round(share, 2).cast("double")


def basic_stats(listings: DataFrame) -> DataFrame:
    """One row: listings, average/lowest/highest price, average area, distinct locations."""
    return _priced(listings).agg(
        F.count("*").alias("total_properties"),
        _money(F.avg("price"), "avg_price"),
        _money(F.min("price"), "min_price"),
        _money(F.max("price"), "max_price"),
        format_area(F.avg("area")).alias("avg_area"),
        F.countDistinct("ia_chi").alias("cities_count"),
    )


def price_by_city(listings: DataFrame) -> DataFrame:
    """Per location with positive price and area: count, prices, price per square metre."""
    located = with_numbers(listings).filter("price > 0 AND area > 0 AND ia_chi IS NOT NULL")
    average = F.avg("price")
    return (
        located.groupBy(F.col("ia_chi").alias("city"))
        .agg(
            F.count("*").alias("property_count"),
            _money(average, "avg_price"),
            _money(F.min("price"), "min_price"),
            _money(F.max("price"), "max_price"),
            _money(F.avg(F.col("price") / F.nullif("area", F.lit(0.0))), "avg_price_per_sqm"),
            average.alias("_rank"),
        )
        .orderBy(F.desc("_rank"), "city")
        .drop("_rank")
    )


def location_distribution(listings: DataFrame, top: int = LOCATION_TOP) -> DataFrame:
    """The locations with most listings and their share of all located listings.

    The grand total is one more row of the same aggregate (rollup) and is kept by the
    cut to ``top + 1`` rows, so the listings are read once and the window that hands
    the total to the others sees those few rows only, however many locations there are.
    """
    located = _priced(listings).withColumn("location", F.col("ia_chi")).filter("location IS NOT NULL")
    grouped = located.rollup("location").agg(
        F.grouping("location").alias("_is_total"),
        F.count("*").alias("count"),
        _money(F.avg("price"), "avg_price"),
        format_area(F.avg("area")).alias("avg_area"),
    )
    kept = grouped.orderBy(F.desc("_is_total"), F.desc("count"), "location").limit(top + 1)
    total = F.max(F.when(F.col("_is_total") == 1, F.col("count"))).over(Window.partitionBy())
    return (
        kept.withColumn("percentage", _percentage(F.col("count"), total))
        .filter("_is_total = 0")
        .select("location", "count", "percentage", "avg_price", "avg_area")
        .orderBy(F.desc("count"), "location")
    )


def recent_trends(listings: DataFrame, days: int = TREND_DAYS) -> DataFrame:
    """Per posting date, the latest ``days`` dates that have listings, newest first."""
    dated = _priced(listings).withColumn("date", F.col("ngay_ang").try_cast("date"))
    return (
        dated.filter(F.col("date").isNotNull())
        .groupBy("date")
        .agg(
            F.count("*").alias("daily_count"),
            _money(F.avg("price"), "avg_price"),
            format_area(F.avg("area")).alias("avg_area"),
        )
        .orderBy(F.desc("date"))
        .limit(days)
    )


def price_band(price: Column) -> Column:
    band = F.lit(TOP_BAND)
    for below, label in reversed(PRICE_BANDS):
        band = F.when(price < below, F.lit(label)).otherwise(band)
    return band


def price_ranges(listings: DataFrame) -> DataFrame:
    """Per price band, cheapest first: count, share, average area.

    There are five bands at most, so the window for the total sees five rows.
    """
    bands = (
        with_numbers(listings)
        .filter("price > 0")
        .groupBy(price_band(F.col("price")).alias("price_range"))
        .agg(
            F.count("*").alias("count"),
            format_area(F.avg("area")).alias("avg_area"),
            F.min("price").alias("_cheapest"),
        )
    )
    total = F.sum("count").over(Window.partitionBy())
    return (
        bands.withColumn("percentage", _percentage(F.col("count"), total))
        .orderBy("_cheapest")
        .select("price_range", "count", "percentage", "avg_area")
    )


def top_expensive_areas(
    properties: DataFrame, limit: int = TOP_AREAS, min_listings: int = MIN_AREA_LISTINGS
) -> DataFrame:
    """Areas with the highest average price among those with enough listings.

    Input has numeric ``price`` and ``area``, ``city`` and a ``district`` that may be
    NULL. Ranked by the average itself, not by its text.
    """
    average = F.avg("price")
    return (
        properties.filter("price > 0 AND area > 0")
        .select("price", F.col("area").alias("_sqm"), F.coalesce("district", "city").alias("area"))
        .groupBy("area")
        .agg(
            F.count("*").alias("property_count"),
            _money(average, "avg_price"),
            _money(F.max("price"), "max_price"),
            _money(F.avg(F.col("price") / F.col("_sqm")), "price_per_sqm"),
            average.alias("_rank"),
        )
        .filter(F.col("property_count") >= min_listings)
        .orderBy(F.desc("_rank"), "area")
        .limit(limit)
        .drop("_rank")
    )


#: The grouping sets of ``market_summary``, as ``grouping_id`` numbers them.
BY_LOCATION, BY_DATE, BY_BAND, OVERALL = 3, 5, 6, 7


def market_summary(listings: DataFrame) -> DataFrame:
    """All that the reports over the serving table need, from one pass: a row per location, date and price band, and one of all.

    ``_set`` tells which of these a row is. n, avg_price, min_price, max_price and
    avg_area are of the listings with price and area; the columns that begin with pos_
    of those where both are positive; the columns that begin with priced_ of those with
    a positive price. Numbers stay numbers, so that the reports can rank by them. The
    listings are expanded to four narrow rows each and combined in every task before
    the shuffle, so a location that holds a third of them is one row for each task.
    """
    full, positive = F.col("price").isNotNull() & F.col("area").isNotNull(), F.expr("price > 0 AND area > 0")
    rows = with_numbers(listings).filter(full | (F.col("price") > 0))
    rows = rows.select(
        F.col("ia_chi").alias("location"),
        F.col("ngay_ang").try_cast("date").alias("date"),
        F.when(F.col("price") > 0, price_band(F.col("price"))).alias("band"),
        *[F.when(full, F.col(c)).alias(c) for c in ("price", "area")],
        *[F.when(positive, F.col(c)).alias(f"pos_{c}") for c in ("price", "area")],
        F.when(F.col("price") > 0, F.col("price")).alias("priced_price"),
        F.when(F.col("price") > 0, F.col("area")).alias("priced_area"),
    )
    sets = [[F.col("location")], [F.col("date")], [F.col("band")], []]
    return rows.groupingSets(sets, "location", "date", "band").agg(
        F.grouping_id().alias("_set"),
        F.count("price").alias("n"),
        F.avg("price").alias("avg_price"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.avg("area").alias("avg_area"),
        F.count("pos_price").alias("pos_n"),
        F.avg("pos_price").alias("pos_avg"),
        F.min("pos_price").alias("pos_min"),
        F.max("pos_price").alias("pos_max"),
        F.avg(F.col("pos_price") / F.col("pos_area")).alias("pos_per_sqm"),
        F.count("priced_price").alias("priced_n"),
        F.avg("priced_area").alias("priced_area"),
        F.min("priced_price").alias("priced_min"),
    )


def _of_set(summary: DataFrame, kind: int, key: str, count: str) -> DataFrame:
    return summary.filter((F.col("_set") == kind) & F.col(key).isNotNull() & (F.col(count) > 0))


def summary_basic_stats(summary: DataFrame) -> DataFrame:
    """``basic_stats`` of a summary."""
    whole = F.col("_set") == OVERALL
    place = (F.col("_set") == BY_LOCATION) & F.col("location").isNotNull() & (F.col("n") > 0)
    return summary.agg(
        F.coalesce(F.max(F.when(whole, F.col("n"))), F.lit(0)).alias("total_properties"),
        *[_money(F.max(F.when(whole, F.col(c))), c) for c in ("avg_price", "min_price", "max_price")],
        format_area(F.max(F.when(whole, F.col("avg_area")))).alias("avg_area"),
        F.count(F.when(place, 1)).alias("cities_count"),
    )


def summary_price_by_city(summary: DataFrame) -> DataFrame:
    """``price_by_city`` of a summary."""
    return _of_set(summary, BY_LOCATION, "location", "pos_n").orderBy(F.desc("pos_avg"), "location").select(
        F.col("location").alias("city"),
        F.col("pos_n").alias("property_count"),
        _money(F.col("pos_avg"), "avg_price"),
        _money(F.col("pos_min"), "min_price"),
        _money(F.col("pos_max"), "max_price"),
        _money(F.col("pos_per_sqm"), "avg_price_per_sqm"),
    )


def summary_location_distribution(summary: DataFrame, top: int = LOCATION_TOP) -> DataFrame:
    """``location_distribution`` of a summary; the total is found as there."""
    grouped = _of_set(summary, BY_LOCATION, "location", "n").rollup("location").agg(
        F.grouping("location").alias("_is_total"), F.sum("n").alias("count"), F.max("avg_price").alias("_price"), F.max("avg_area").alias("_area")
    )
    kept = grouped.orderBy(F.desc("_is_total"), F.desc("count"), "location").limit(top + 1)
    total = F.max(F.when(F.col("_is_total") == 1, F.col("count"))).over(Window.partitionBy())
    return (
        kept.withColumn("percentage", _percentage(F.col("count"), total))
        .filter("_is_total = 0")
        .select("location", "count", "percentage", _money(F.col("_price"), "avg_price"), format_area(F.col("_area")).alias("avg_area"))
        .orderBy(F.desc("count"), "location")
    )


def summary_recent_trends(summary: DataFrame, days: int = TREND_DAYS) -> DataFrame:
    """``recent_trends`` of a summary."""
    latest = _of_set(summary, BY_DATE, "date", "n").orderBy(F.desc("date")).limit(days)
    return latest.select("date", F.col("n").alias("daily_count"), _money(F.col("avg_price"), "avg_price"), format_area(F.col("avg_area")).alias("avg_area"))


def summary_price_ranges(summary: DataFrame) -> DataFrame:
    """``price_ranges`` of a summary; five bands at most."""
    total = F.sum("priced_n").over(Window.partitionBy())
    return (
        _of_set(summary, BY_BAND, "band", "priced_n")
        .withColumn("percentage", _percentage(F.col("priced_n"), total))
        .orderBy("priced_min")
        .select(F.col("band").alias("price_range"), F.col("priced_n").alias("count"), "percentage", format_area(F.col("priced_area")).alias("avg_area"))
    )


def city_value_counts(listings: DataFrame, column: str = "search_city") -> DataFrame:
    """Rows per value, most frequent first; NULL is not counted."""
    return (
        listings.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), column)
    )


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Equal-width bins from the smallest to the largest number; the last bin is closed.

    Text that is no number is dropped. Equal numbers only are put around the middle of
    a range of width one. Empty bins are listed with zero.
    """
    numbers = df.select(F.col(column).try_cast("double").alias("x")).filter("x IS NOT NULL AND NOT isnan(x)")
    limits = numbers.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    flat = F.col("lo") == F.col("hi")
    limits = limits.select(
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    lo, hi = limits.select("lo").scalar(), limits.select("hi").scalar()
    position = F.floor((F.col("x") - lo) / (hi - lo) * bins)
    counts = (
        numbers.groupBy(F.least(position, F.lit(bins - 1)).alias("bin"))
        .agg(F.count("*").alias("count"))
    )
    width = (hi - lo) / bins
    return (
        df.sparkSession.range(bins)
        .withColumnRenamed("id", "bin")
        .join(counts, "bin", "left")
        .select(
            "bin",
            (lo + F.col("bin") * width).alias("bin_start"),
            F.coalesce("count", F.lit(0)).alias("count"),
        )
        .filter(F.col("bin_start").isNotNull())
        .orderBy("bin")
    )


def latitude_histogram(listings: DataFrame) -> DataFrame:
    return histogram(listings, "latitude")
