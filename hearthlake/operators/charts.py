"""The tables behind the charts of the reports.

Each reads a report and parses its formatted amounts back, so a chart shows exactly the
figures of the printed table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthlake.functions.numbers import in_billions, parse_formatted
from hearthlake.functions.text import month_day, truncate_label

# Fixed values.
CITY_LABEL = 15
LOCATION_LABEL = 20
PIE_LABEL = 40
BAR_LABEL = 25
POINT_SIZE = 10


def _billions(column: str):
    return in_billions(parse_formatted(F.col(column)))


def overview_bars(stats: DataFrame) -> DataFrame:
    """One bar per figure of the basic statistics."""
    figures = F.array(
        F.struct(F.lit("Tổng BĐS").alias("label"), F.col("total_properties").cast("double").alias("value")),
        F.struct(F.lit("Giá TB (tỷ)").alias("label"), _billions("avg_price").alias("value")),
        F.struct(F.lit("Diện tích TB (m²)").alias("label"), parse_formatted(F.col("avg_area")).alias("value")),
        F.struct(F.lit("Số TP").alias("label"), F.col("cities_count").cast("double").alias("value")),
    )
    return stats.select(F.inline(figures))


def price_bars(by_city: DataFrame, top: int, label_size: int = CITY_LABEL) -> DataFrame:
    """The first ``top`` rows of the price report with short labels and prices in billions."""
    return by_city.limit(top).select(
        "city",
        truncate_label(F.col("city"), label_size).alias("label"),
        "property_count",
        parse_formatted(F.col("avg_price")).alias("avg_price_num"),
        _billions("avg_price").alias("avg_price_billion"),
    )


def location_bars(distribution: DataFrame, top: int = 5) -> DataFrame:
    """The first ``top`` locations with short labels, count and average area."""
    return distribution.limit(top).select(
        "location",
        truncate_label(F.col("location"), LOCATION_LABEL).alias("label"),
        "count",
        parse_formatted(F.col("avg_area")).alias("avg_area"),
    )


def location_shares(distribution: DataFrame, top: int = 15) -> DataFrame:
    """The first ``top`` locations with legend and axis labels, count and share."""
    return distribution.limit(top).select(
        "location",
        truncate_label(F.col("location"), PIE_LABEL).alias("legend"),
        truncate_label(F.col("location"), BAR_LABEL).alias("label"),
        "count",
        "percentage",
    )


def trend_lastdays(trends: DataFrame, days: int = 10) -> DataFrame:
    """The latest ``days`` dates in calendar order with month-day labels."""
    return (
        trends.orderBy(F.desc("date"))
        .limit(days)
        .orderBy("date")
        .select("date", month_day(F.col("date")).alias("label"), _billions("avg_price").alias("avg_price_billion"))
    )


def trend_scatter(trends: DataFrame) -> DataFrame:
    """Price against area per date in calendar order; the point grows with the count."""
    return trends.orderBy("date").select(
        "date",
        "daily_count",
        parse_formatted(F.col("avg_area")).alias("avg_area"),
        parse_formatted(F.col("avg_price")).alias("avg_price"),
        (F.col("daily_count") * POINT_SIZE).alias("point_size"),
    )
