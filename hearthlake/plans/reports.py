"""The set of market reports by name."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from hearthlake.operators import analytics
from hearthlake.session import staged
from hearthlake.sources import serving


class Report(NamedTuple):
    build: Callable[[DataFrame], DataFrame]
    description: str


REPORTS = {
    "basic_stats": Report(analytics.basic_stats, "Number of listings, prices, average area, locations"),
    "price_by_city": Report(analytics.price_by_city, "Prices per location"),
    "location_distribution": Report(analytics.location_distribution, "Share of listings per location"),
    "recent_trends": Report(analytics.recent_trends, "Daily count and averages, latest 30 dates"),
    "price_ranges": Report(analytics.price_ranges, "Listings per price band"),
    "top_expensive_areas": Report(analytics.top_expensive_areas, "Areas with the highest prices"),
}
# The reports that read the serving table as it is; the last one above needs numeric columns.
SERVING_REPORTS = [name for name in REPORTS if name != "top_expensive_areas"]


def run_reports(
    listings: DataFrame, names: Iterable[str] = SERVING_REPORTS, limit: int | None = None
) -> dict[str, DataFrame]:
    """The named reports over the serving table, each cut to its first ``limit`` rows if that is given.

    Nothing runs until a result is read, so one failing report does not stop the others.
    """
    results = {name: REPORTS[name].build(listings) for name in names}
    return {n: df if limit is None else df.limit(limit) for n, df in results.items()}


SUMMARY_REPORTS = {
    "basic_stats": analytics.summary_basic_stats,
    "price_by_city": analytics.summary_price_by_city,
    "location_distribution": analytics.summary_location_distribution,
    "recent_trends": analytics.summary_recent_trends,
    "price_ranges": analytics.summary_price_ranges,
}


def run_reports_in_one_pass(listings: DataFrame) -> dict[str, DataFrame]:
    """The serving reports, as ``run_reports`` gives them, from one scan of the listings.

    The summary they share, a row per location, date and band, is written to the shared
    folder; the reports read only that. Its folder is left for the caller to remove.
    """
    summary = staged(analytics.market_summary(listings))
    return {name: build(summary) for name, build in SUMMARY_REPORTS.items()}


def latest_trends(spark: SparkSession, serving_root: str, days: int = analytics.TREND_DAYS) -> DataFrame:
    """``recent_trends`` of the stored serving table, from the months that hold the latest dates only."""
    since = serving.month_of_latest_dates(spark, serving_root, days)
    return analytics.recent_trends(serving.read_served(spark, serving_root, since=since), days)
