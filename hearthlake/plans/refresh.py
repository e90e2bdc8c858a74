"""The listing refresh: from search criteria and stored pages to the serving table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthlake.functions.keys import MERGE_KEY, with_merge_key
from hearthlake.functions.text import normalize_url
from hearthlake.operators.checks import schema_diff, widened
from hearthlake.operators.columns import LISTING_SCHEMA, attach_lineage
from hearthlake.operators.criteria import with_search_url
from hearthlake.operators.dedup import dedup_keep_last
from hearthlake.operators.extract import DEFAULT_LINKS_PER_PAGE, extract_listings
from hearthlake.operators.upsert import upsert_by_key
from hearthlake.session import shared_folder
from hearthlake.sources.serving import read_served, serving_rows, write_served
from hearthlake.sources.snapshots import BUCKETS, buckets_of, latest_version, live_buckets, read_buckets, read_current, write_buckets, write_snapshot


def find_listings(
    criteria: DataFrame,
    result_pages: DataFrame,
    detail_pages: DataFrame,
    collected_on: str,
    limit: int = DEFAULT_LINKS_PER_PAGE,
    fetched: Sequence[str] = (),
) -> DataFrame:
    """Listings on the result pages of the criteria, each with the criterion it was found by.

    Result pages of no criterion are left out before their links are looked for. Pages are
    extracted before criteria are joined: a page that several criteria share is read once,
    and only ids and short rows move, never pages.
    """
    wanted = with_search_url(criteria)
    # The lookup tables bound the different search urls: cities x categories x actions.
    urls = F.broadcast(wanted.select("search_url").distinct())
    with_url = result_pages.withColumn("search_url", normalize_url(F.col("url")))
    result_pages = with_url.join(urls, "search_url", "left_semi")
    searched = with_url.select("page_id", "search_url").join(wanted, "search_url").drop("search_url")
    found = extract_listings(result_pages, detail_pages, collected_on, limit, fetched).join(searched, "page_id")
    with_criterion = attach_lineage(
        found,
        F.coalesce("city", F.lit("")),
        F.coalesce("propertyType", F.lit("")),
        F.coalesce("rentOrBuy", F.lit("")),
        F.coalesce("radius", F.lit(0)),
    )
    lineage = [c for c in with_criterion.columns if c.startswith("search_")]
    return with_criterion.select(*LISTING_SCHEMA.names, *lineage, "page_id", "position")


def merge_listings(
    listings: DataFrame, root: str, order: Sequence[Column | str], transient: Sequence[str] = (), buckets: int = BUCKETS
) -> int:
    """Upsert listings into the stored table and return its new version.

    The new rows are deduplicated by ``order`` and written to the shared folder first:
    the upsert reads them twice and would otherwise extract them twice. Columns that
    only serve the order are named in ``transient`` and not stored. The stored table keeps
    all its columns, bulky ones too. A column may come or go; numbers take the wider of
    both types, any other change of type is refused. The table lies in buckets of its key:
    only the buckets of the new rows' keys are read and written, the others stay as they
    are. The whole table is written anew where its columns change. ``buckets`` is for a
    table that has none yet; choose it so that a bucket is a few files. The old version of the
    table stays as it is, so a failed attempt leaves it readable; without new rows it stays
    the current one.
    """
    spark = listings.sparkSession
    latest = dedup_keep_last(with_merge_key(listings), order, MERGE_KEY).drop(*transient)
    staged = shared_folder(spark)
    latest.write.parquet(staged)
    new = spark.read.schema(latest.schema).parquet(staged)
    try:
        return _merge_staged(spark, new, root, buckets)
    finally:
        _delete(spark, staged)


def _merge_staged(spark: SparkSession, new: DataFrame, root: str, buckets: int) -> int:
    current = read_current(spark, root, without=())
    if current is None:
        return write_snapshot(new, root, "CREATE") if new.isEmpty() else write_buckets(new, root, MERGE_KEY, "CREATE", True, buckets)
    stored = current
    current, new = widened(current, new), widened(new, current)
    changed = [name for name, *_, status in schema_diff(current, new) if status == "changed"]
    if changed:
        raise ValueError(f"columns of another type than stored: {', '.join(changed)}")
    if new.isEmpty():
        return latest_version(spark, root)
    live, had = live_buckets(spark, root, latest_version(spark, root))
    merged = upsert_by_key(current, new)
    if not live or _kinds(merged) != _kinds(stored):
        return write_buckets(merged, root, MERGE_KEY, "MERGE", True, had or buckets)
    touched = read_buckets(spark, root, live, buckets_of(new, MERGE_KEY, had))
    return write_buckets(upsert_by_key(touched, new).select(*[f"`{c}`" for c in stored.columns]), root, MERGE_KEY, "MERGE", False, had)


def _kinds(df: DataFrame) -> dict[str, object]:
    return {field.name: field.dataType for field in df.schema.fields}


def _delete(spark: SparkSession, folder: str) -> None:
    """Remove a staged folder through the file system it lies in."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def publish(
    spark: SparkSession, root: str, serving_root: str, cities: str | Sequence[str] | None = None
) -> DataFrame:
    """Replace the serving table by the current rows of the stored table; returns it as read back.

    The merge leaves one row per key, so this reads the stored table once, deals its rows to
    folders of city and month and writes them. All stored columns are published. The rows
    in the written files are counted by their footers against those that the write was
    given, and a difference ends the job.
    """
    rows = serving_rows(read_current(spark, root, without=()), cities=cities)
    handed = write_served(rows, serving_root)
    published = read_served(spark, serving_root)
    found = published.count()
    if found != handed:
        raise RuntimeError(f"published {found} of {handed} rows")
    return published


def refresh(
    criteria: DataFrame,
    result_pages: DataFrame,
    detail_pages: DataFrame,
    root: str,
    serving_root: str,
    collected_on: str,
    limit: int = DEFAULT_LINKS_PER_PAGE,
    cities: str | Sequence[str] | None = None,
    fetched: Sequence[str] = (),
) -> DataFrame:
    """The whole job for one crawl; returns the serving table, cut to ``cities`` if given.

    Of several fetches of a detail page the last by the columns ``fetched`` counts.

    Of several finds of one listing in a crawl the one furthest down counts. Of several
    criteria with one search url the last counts, so a listing isn't multiplied by them.
    """
    names = ["city", "propertyType", "rentOrBuy", "radius"]
    last = [F.coalesce(c, F.lit(0) if c == "radius" else F.lit("")) for c in names]
    criteria = dedup_keep_last(with_search_url(criteria), last, "search_url").select(*criteria.columns)
    found = find_listings(criteria, result_pages, detail_pages, collected_on, limit, fetched)
    lineage = [c for c in found.columns if c.startswith("search_")]
    merge_listings(found, root, ["page_id", "position", *lineage], ["page_id", "position"])
    return publish(criteria.sparkSession, root, serving_root, cities)
