"""The registered queries: one per operator, each over the whole given tables."""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthlake.functions import keys, numbers, text
from hearthlake.operators import (
    analytics,
    changes,
    charts,
    checks,
    columns,
    criteria,
    dedup,
    extract,
    nested,
    profile,
    upsert,
)
from hearthlake.plans import inputs, refresh, reports
from hearthlake.session import shared_folder
from hearthlake.sources import files, serving, snapshots

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ORDER = ["run_version", "seq"]
FIRST_LINKS = 2
LINKS = 20
COLLECTED_ON = "2024-01-01"
FIRST_CRAWL_UNTIL = "1999-01-01"
SECOND_CRAWL_FROM = "1997-01-01"
REPRICED_TYPES = ["BUILDING", "MACHINERY"]
CITIES = ["asia", "europe"]
ONE_PROPERTY = hashlib.md5(b"https://example.test/listing-pid10").hexdigest()[: keys.KEY_LENGTH]
SERVING_NAMES = {
    "Diện tích": "dien_tich",
    "Mức giá": "muc_gia",
    "Địa chỉ": "ia_chi",
    "Ngày đăng": "ngay_ang",
    "Tiêu đề": "tieu_e",
}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


# Frames several queries start from.


def raw_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings under the names the extraction gives them."""
    return inputs.listings(spark, sf_dir).withColumnsRenamed({v: k for k, v in SERVING_NAMES.items()})


def first_crawl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.listings(spark, sf_dir).filter(F.col("ngay_ang") < FIRST_CRAWL_UNTIL)


def second_crawl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later crawl that overlaps the first; some property types cost ten times as much."""
    repriced = F.when(
        F.col("search_property_type").isin(REPRICED_TYPES), F.concat("muc_gia", F.lit("0"))
    ).otherwise(F.col("muc_gia"))
    later = inputs.listings(spark, sf_dir).filter(F.col("ngay_ang") >= SECOND_CRAWL_FROM)
    return later.withColumn("muc_gia", repriced)


def stored(crawl: DataFrame) -> DataFrame:
    """One row per property with its key and whole-number price."""
    keyed = keys.with_merge_key(crawl).withColumn(
        keys.NORMALIZED_PRICE, F.col("muc_gia").try_cast("bigint")
    )
    return dedup.dedup_keep_last(keyed, ORDER, keys.MERGE_KEY)


def candidates(crawl: DataFrame) -> DataFrame:
    price = F.col(keys.NORMALIZED_PRICE)
    return stored(crawl).select(
        F.col(keys.MERGE_KEY).alias("id"),
        keys.fingerprint(F.col(keys.MERGE_KEY), price).alias("fingerprint"),
        F.lit("false").alias("is_prefix"),
        F.col("search_rent_or_buy").alias("rentOrBuy"),
        F.col("search_city").alias("city"),
        F.col("search_property_type").alias("propertyType"),
        F.col("search_radius").alias("radius"),
        price.alias("last_normalized_price"),
    )


def property_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings as the nested records a property service sends."""
    price = F.struct(F.col("muc_gia").try_cast("bigint").alias("price"))
    return keys.with_merge_key(inputs.listings(spark, sf_dir)).select(
        F.col("seq").cast("string").alias("id"),
        F.struct(F.struct(price.alias("buy")).alias("prices")).alias("listing"),
        F.struct(
            F.col(keys.MERGE_KEY).alias("propertyId"),
            F.array("search_city", "search_rent_or_buy").alias("images"),
            F.array().cast("array<string>").alias("pdfs"),
            F.col("dien_tich").alias("rooms"),
        ).alias("propertyDetails"),
        F.lit("f").alias("FactId"),
        F.col("tieu_e").alias("odd name;x"),
    )


# Sources and sinks.


@query
def read_json_folder(spark, sf_dir):
    folder = shared_folder(spark)
    files.write_json_gzip(property_records(spark, sf_dir), folder)
    read = files.read_json_folder(spark, folder)
    return read.select("id", "oddnamex", F.col("listing.prices.buy.price").alias("price"))


@query
def json_gzip_roundtrip(spark, sf_dir):
    folder = shared_folder(spark)
    written = inputs.listings(spark, sf_dir).select("url", "muc_gia", "latitude", "seq")
    files.write_json_gzip(written, folder)
    return files.read_json_folder(spark, folder, written.schema)


@query
def read_json_documents(spark, sf_dir):
    """Files of one JSON list each, of a thousand records at most."""
    folder = shared_folder(spark)
    record = property_records(spark, sf_dir).withColumn("part", F.floor(F.col("id").cast("long") / 1000))
    lists = record.groupBy("part").agg(F.to_json(F.collect_list(F.struct("id", "listing"))).alias("value"))
    lists.write.partitionBy("part").text(folder, compression="gzip")
    read = files.read_json_documents(spark, folder, "id string, listing struct<prices: struct<buy: struct<price: bigint>>>")
    return read.select("id", F.col("listing.prices.buy.price").alias("price"))


@query
def read_parquet_union(spark, sf_dir):
    folder = shared_folder(spark)
    rows = inputs.listings(spark, sf_dir)
    early = F.col("ngay_ang") < FIRST_CRAWL_UNTIL
    rows.filter(early).select("url", "muc_gia", "seq").write.parquet(f"{folder}/early")
    rows.filter(~early).select("url", "muc_gia", "dien_tich", "seq").write.parquet(f"{folder}/late/deep")
    return files.read_parquet_union(spark, folder).select("url", "muc_gia", "dien_tich", "seq")


@query
def snapshot_write_read(spark, sf_dir):
    folder = shared_folder(spark)
    version = snapshots.write_snapshot(inputs.listings(spark, sf_dir), folder)
    return snapshots.read_version(spark, folder, version)


@query
def snapshot_history(spark, sf_dir):
    folder = shared_folder(spark)
    snapshots.write_snapshot(first_crawl(spark, sf_dir), folder, "CREATE")
    snapshots.write_snapshot(second_crawl(spark, sf_dir), folder, "OVERWRITE")
    versions = [
        snapshots.read_version(spark, folder, v).agg(F.lit(v).alias("version"), F.count("*").alias("stored_rows")) for v in (0, 1)
    ]
    counts = versions[0].unionByName(versions[1])
    return snapshots.history(spark, folder).join(counts, "version").select("version", "operation", "stored_rows")


@query
def read_current_table(spark, sf_dir):
    folder = shared_folder(spark)
    flat = nested.flatten_records(property_records(spark, sf_dir))
    snapshots.write_snapshot(flat, folder)
    return snapshots.read_current(spark, folder)


@query
def publish_full_refresh(spark, sf_dir):
    folder = shared_folder(spark)
    rows = serving.serving_rows(raw_listings(spark, sf_dir), ORDER, CITIES, "url")
    snapshots.write_snapshot(rows, folder, "PUBLISH")
    return snapshots.read_current(spark, folder)


def _merged(spark, sf_dir):
    """A folder with two crawls merged one after the other into the stored table."""
    folder = shared_folder(spark)
    refresh.merge_listings(first_crawl(spark, sf_dir), f"{folder}/bronze", ORDER)
    refresh.merge_listings(second_crawl(spark, sf_dir), f"{folder}/bronze", ORDER)
    return folder


def _published(spark, sf_dir):
    folder = _merged(spark, sf_dir)
    refresh.publish(spark, f"{folder}/bronze", f"{folder}/serving")
    return folder


@query
def merge_and_publish(spark, sf_dir):
    """Two crawls merged one after the other into the stored table, then published."""
    folder = _merged(spark, sf_dir)
    published = refresh.publish(spark, f"{folder}/bronze", f"{folder}/serving", CITIES)
    return published.select(keys.MERGE_KEY.lower(), "url", "muc_gia", "search_city", "seq")


@query
def served_city(spark, sf_dir):
    """One city of the published table, from its folders only."""
    folder = _published(spark, sf_dir)
    served = serving.read_served(spark, f"{folder}/serving", "asia")
    return served.select(keys.MERGE_KEY.lower(), "url", "muc_gia", "search_city", "seq")


@query
def served_trends(spark, sf_dir):
    """The latest dates of the published table, from the months that hold them only."""
    return reports.latest_trends(spark, f"{_published(spark, sf_dir)}/serving")


@query
def stored_lookup(spark, sf_dir):
    """One listing of the merged table, from its key's bucket only."""
    rows = snapshots.read_key(spark, f"{_merged(spark, sf_dir)}/bronze", keys.MERGE_KEY, ONE_PROPERTY)
    return rows.select(keys.MERGE_KEY, "url", "muc_gia", "seq")


@query
def merge_keeps_columns(spark, sf_dir):
    """A stored table with a bulky column, merged with a crawl without it and published."""
    folder = shared_folder(spark)
    first = first_crawl(spark, sf_dir).withColumn("propertyDetails_images", F.concat(F.lit("image of "), "seq"))
    refresh.merge_listings(first, f"{folder}/bronze", ORDER)
    refresh.merge_listings(second_crawl(spark, sf_dir), f"{folder}/bronze", ORDER)
    published = refresh.publish(spark, f"{folder}/bronze", f"{folder}/serving")
    return published.select(keys.MERGE_KEY.lower(), "seq", F.col("propertydetails_images").alias("images"))


@query
def refresh_listings(spark, sf_dir):
    """The whole job: result pages that many criteria share, pages of no criterion, several fetches of a detail page."""
    folder = shared_folder(spark)
    searches = inputs.searches(spark, sf_dir)
    link = lambda n: F.concat(F.lit('<a href="/tin-pid'), n.cast("string"), F.lit('">x</a>'))
    results = criteria.with_search_url(searches).select(
        F.col("search_id").alias("page_id"),
        F.col("search_url").alias("url"),
        F.concat(link(F.col("search_id")), link(2 * F.col("search_id"))).alias("html"),
    )
    pages = inputs.detail_pages(spark, sf_dir)
    again = pages.filter("page_id % 3 = 0").withColumn("html", F.concat(F.lit("<h1>Fetch 2</h1>"), "html"))
    fetches = pages.withColumn("fetch", F.lit(1)).unionByName(again.withColumn("fetch", F.lit(2)))
    # Written first, as a crawler leaves them.
    for name, frame in {"results": results.unionByName(pages), "fetches": fetches}.items():
        frame.write.parquet(f"{folder}/{name}")
    stored_results, stored_fetches = (spark.read.parquet(f"{folder}/{name}") for name in ("results", "fetches"))
    published = refresh.refresh(
        searches, stored_results, stored_fetches, f"{folder}/bronze", f"{folder}/serving", COLLECTED_ON, LINKS, fetched=["fetch"]
    )
    lineage = ["search_city", "search_property_type", "search_rent_or_buy", "search_radius"]
    return published.select(keys.MERGE_KEY.lower(), "url", "muc_gia", "dien_tich", "ia_chi", "tieu_e", *lineage)


@query
def empty_crawl(spark, sf_dir):
    """A crawl without listings leaves the stored table and its version as they are."""
    root = f"{shared_folder(spark)}/bronze"
    crawl = first_crawl(spark, sf_dir)
    refresh.merge_listings(crawl, root, ORDER)
    refresh.merge_listings(columns.emit_if(crawl, False), root, ORDER)
    rows = snapshots.read_current(spark, root).select(F.lit(1).alias("r"), F.lit(0).alias("v"))
    tagged = rows.unionAll(snapshots.history(spark, root).select(F.lit(0), F.lit(1)))
    return tagged.agg(F.sum("r").alias("stored_rows"), F.sum("v").alias("versions"))


# Nested records.


@query
def flatten_json(spark, sf_dir):
    return nested.flatten_records(property_records(spark, sf_dir))


@query
def arrays_to_json(spark, sf_dir):
    flat = nested.flatten(property_records(spark, sf_dir))
    return nested.arrays_to_json(flat.select("id", "propertyDetails_images", "propertyDetails_pdfs"))


@query
def unify_price_column(spark, sf_dir):
    flat = nested.unify_price(nested.flatten(property_records(spark, sf_dir)))
    return flat.select("id", keys.NORMALIZED_PRICE)


@query
def json_validity(spark, sf_dir):
    return inputs.bodies(spark, sf_dir).select("event_id", nested.is_json(F.col("body")).alias("is_valid"))


# Columns and filters.


@query
def sanitize_columns(spark, sf_dir):
    return columns.sanitize_columns(raw_listings(spark, sf_dir))


@query
def parquet_safe_columns(spark, sf_dir):
    return columns.parquet_safe_columns(
        inputs.listings(spark, sf_dir).select(
            "url", F.col("muc_gia").alias("gia (VND)"), F.col("dien_tich").alias("dien.tich; m2")
        )
    )


@query
def prefix_columns(spark, sf_dir):
    return columns.prefix_columns(inputs.listings(spark, sf_dir).select("url", "muc_gia"), "listing_")


@query
def canonicalize_columns(spark, sf_dir):
    return columns.canonicalize_columns(inputs.searches(spark, sf_dir))


@query
def replace_values(spark, sf_dir):
    return columns.replace_values(inputs.listings(spark, sf_dir), "rent", "lease").select(
        "seq", "muc_gia", "search_rent_or_buy"
    )


@query
def conform_schema(spark, sf_dir):
    partial = raw_listings(spark, sf_dir).drop("Tiêu đề", "longitude")
    return columns.conform(partial).toDF(
        "url", "dien_tich", "muc_gia", "ia_chi", "ngay_ang", "tieu_e", "latitude", "longitude"
    )


@query
def attach_lineage(spark, sf_dir):
    bare = inputs.listings(spark, sf_dir).select("seq", "url")
    return columns.attach_lineage(bare, "hanoi", "can-ho-chung-cu", "buy", 0)


@query
def filter_city(spark, sf_dir):
    return columns.filter_city(inputs.listings(spark, sf_dir), "asia").select("seq", "url", "search_city")


@query
def lookup_property(spark, sf_dir):
    keyed = keys.with_merge_key(inputs.listings(spark, sf_dir))
    return columns.lookup(
        keyed, keys.MERGE_KEY, ONE_PROPERTY, [keys.MERGE_KEY, "muc_gia", "url", "latitude", "longitude"]
    )


@query
def emit_if(spark, sf_dir):
    rows = inputs.listings(spark, sf_dir).select("seq")
    return columns.emit_if(rows, True).unionByName(columns.emit_if(rows, False))


@query
def sample_one(spark, sf_dir):
    """The drawn value is one of the table's."""
    urls = inputs.listings(spark, sf_dir).select("url")
    return columns.sample_one(urls, "url", 5).join(urls.distinct(), "url").agg(F.count("*").alias("drawn"))


# Joins.


@query
def changed_or_new(spark, sf_dir):
    return changes.changed_or_new(
        candidates(second_crawl(spark, sf_dir)), stored(first_crawl(spark, sf_dir))
    )


@query
def existing_semi(spark, sf_dir):
    existing = stored(first_crawl(spark, sf_dir)).select(keys.MERGE_KEY, keys.NORMALIZED_PRICE)
    return changes.existing_semi(existing, candidates(second_crawl(spark, sf_dir)))


@query
def upsert_by_key(spark, sf_dir):
    merged = upsert.upsert_by_key(
        stored(first_crawl(spark, sf_dir)), stored(second_crawl(spark, sf_dir))
    )
    return merged.select(keys.MERGE_KEY, "url", "muc_gia", "ngay_ang", "seq")


@query
def upsert_new_columns(spark, sf_dir):
    """The stored table lacks a column the new rows have, and the other way round."""
    merged = upsert.upsert_by_key(
        stored(first_crawl(spark, sf_dir)).select(keys.MERGE_KEY, "seq", "muc_gia"),
        stored(second_crawl(spark, sf_dir)).select(keys.MERGE_KEY, "seq", "dien_tich"),
    )
    return merged.select(keys.MERGE_KEY, "seq", "muc_gia", "dien_tich")


@query
def schema_diff(spark, sf_dir):
    """A crawl that comes as JSON, its schema inferred from all rows, against the stored table."""
    folder = shared_folder(spark)
    snapshots.write_snapshot(first_crawl(spark, sf_dir).drop("longitude"), f"{folder}/table")
    later = second_crawl(spark, sf_dir).withColumn("search_radius", F.lit("none")).drop("tieu_e")
    files.write_json_gzip(later, f"{folder}/crawl")
    crawl = files.read_json_folder(spark, f"{folder}/crawl")
    return checks.schema_diff_frame(spark, snapshots.read_current(spark, f"{folder}/table"), crawl)


@query
def criteria_urls(spark, sf_dir):
    return criteria.with_search_url(inputs.searches(spark, sf_dir)).select("search_id", "search_url")


@query
def criteria_keys(spark, sf_dir):
    return criteria.with_criterion_key(inputs.searches(spark, sf_dir)).select("search_id", "criterion_key")


# Reports.


@query
def basic_stats(spark, sf_dir):
    return analytics.basic_stats(inputs.listings(spark, sf_dir))


@query
def price_by_city(spark, sf_dir):
    return analytics.price_by_city(inputs.listings(spark, sf_dir))


@query
def location_distribution(spark, sf_dir):
    return analytics.location_distribution(inputs.listings(spark, sf_dir))


@query
def recent_trends(spark, sf_dir):
    return analytics.recent_trends(inputs.listings(spark, sf_dir))


@query
def price_ranges(spark, sf_dir):
    return analytics.price_ranges(inputs.listings(spark, sf_dir))


@query
def top_expensive_areas(spark, sf_dir):
    numeric = analytics.with_numbers(inputs.listings(spark, sf_dir))
    return analytics.top_expensive_areas(
        numeric.withColumnsRenamed({"search_city": "city", "ia_chi": "district"})
    )


@query
def report_rows(spark, sf_dir):
    """Every report over the serving table, and how many rows each has."""
    found = reports.run_reports(inputs.listings(spark, sf_dir))
    counts = [frame.agg(F.count("*").alias("report_rows")).select(F.lit(name).alias("report"), "report_rows") for name, frame in found.items()]
    return functools.reduce(DataFrame.unionByName, counts)


@query
def report_values(spark, sf_dir):
    """The values of every report over the serving table, from one scan of the listings."""
    found = reports.run_reports_in_one_pass(inputs.listings(spark, sf_dir))
    prices = F.concat_ws("/", "avg_price", "min_price", "max_price")
    share = {"location_distribution": F.col("percentage"), "price_ranges": F.col("percentage")}
    shown = {
        "basic_stats": (F.col("cities_count"), "total_properties", prices, "avg_area"),
        "price_by_city": (F.col("city"), "property_count", prices, "avg_price_per_sqm"),
        "location_distribution": (F.col("location"), "count", F.col("avg_price"), "avg_area"),
        "recent_trends": (F.col("date"), "daily_count", F.col("avg_price"), "avg_area"),
        "price_ranges": (F.col("price_range"), "count", F.lit(""), "avg_area"),
    }
    parts = [
        found[report].select(
            F.lit(report).alias("report"),
            name.cast("string").alias("name"),
            F.col(count).alias("n"),
            price.alias("prices"),
            F.col(area).alias("area"),
            share.get(report, F.lit(None)).cast("double").alias("percentage"),
        )
        for report, (name, count, price, area) in shown.items()
    ]
    return functools.reduce(DataFrame.unionByName, parts)


@query
def city_value_counts(spark, sf_dir):
    return analytics.city_value_counts(inputs.listings(spark, sf_dir))


@query
def describe_profile(spark, sf_dir):
    described = profile.describe(inputs.listings(spark, sf_dir))
    rounded = ["mean", "std", "p25", "p50", "p75"]
    return described.withColumns({c: F.round(c, 6) for c in rounded})


@query
def latitude_histogram(spark, sf_dir):
    return analytics.latitude_histogram(inputs.listings(spark, sf_dir))


@query
def dedup_counts(spark, sf_dir):
    return dedup.dedup_counts(inputs.listings(spark, sf_dir), "url")


@query
def chart_overview(spark, sf_dir):
    return charts.overview_bars(basic_stats(spark, sf_dir))


@query
def chart_price_top5(spark, sf_dir):
    return charts.price_bars(price_by_city(spark, sf_dir), 5)


@query
def chart_price_top10(spark, sf_dir):
    return charts.price_bars(price_by_city(spark, sf_dir), 10, 30)


@query
def chart_location_top5(spark, sf_dir):
    return charts.location_bars(location_distribution(spark, sf_dir))


@query
def chart_location_top15(spark, sf_dir):
    return charts.location_shares(location_distribution(spark, sf_dir))


@query
def trend_last10(spark, sf_dir):
    return charts.trend_lastdays(recent_trends(spark, sf_dir))


@query
def chart_trend_scatter(spark, sf_dir):
    return charts.trend_scatter(recent_trends(spark, sf_dir))


# Union and deduplication.


@query
def collect_union(spark, sf_dir):
    rows = inputs.listings(spark, sf_dir)
    parts = [rows.filter(F.col("search_rent_or_buy") == action) for action in ("rent", "buy")]
    return dedup.collect_union(parts).select("seq", "url", "search_rent_or_buy")


@query
def dedup_keep_last(spark, sf_dir):
    return dedup.dedup_keep_last(inputs.listings(spark, sf_dir), ORDER)


# Scalar functions.


@query
def clean_numbers(spark, sf_dir):
    return analytics.with_numbers(inputs.listings(spark, sf_dir)).select("seq", "price", "area")


@query
def parse_areas(spark, sf_dir):
    return inputs.listings(spark, sf_dir).select("seq", numbers.parse_area(F.col("dien_tich")).alias("area"))


@query
def format_money(spark, sf_dir):
    numeric = analytics.with_numbers(inputs.listings(spark, sf_dir))
    return numeric.select(
        "seq",
        numbers.format_money(F.col("price")).alias("price_text"),
        numbers.format_area(F.col("area") / 8).alias("area_text"),
    )


@query
def parse_formatted(spark, sf_dir):
    formatted = format_money(spark, sf_dir)
    price = numbers.parse_formatted(F.col("price_text"))
    return formatted.select(
        "seq",
        price.alias("price"),
        numbers.in_billions(price).alias("price_billion"),
        numbers.parse_formatted(F.col("area_text")).alias("area"),
    )


@query
def merge_key(spark, sf_dir):
    return keys.with_merge_key(inputs.listings(spark, sf_dir).select("seq", "url"))


@query
def fingerprint(spark, sf_dir):
    keyed = keys.with_merge_key(inputs.listings(spark, sf_dir))
    price = F.col("muc_gia").try_cast("bigint")
    return keyed.select("seq", keys.fingerprint(F.col(keys.MERGE_KEY), price).alias("fingerprint"))


@query
def normalize_url(spark, sf_dir):
    return inputs.detail_pages(spark, sf_dir).select(
        "page_id", text.normalize_url(F.col("url")).alias("url")
    )


@query
def truncate_labels(spark, sf_dir):
    return inputs.listings(spark, sf_dir).select(
        "seq", text.truncate_label(F.col("search_property_type"), 8).alias("label")
    )


# Extraction from stored pages.


@query
def links_per_page(spark, sf_dir):
    return extract.links_per_page(inputs.detail_pages(spark, sf_dir), FIRST_LINKS)


@query
def page_titles(spark, sf_dir):
    pages = extract.with_elements(inputs.given(spark, sf_dir, "pages"))
    return extract.with_title(pages).select("page_id", "title")


@query
def detail_titles(spark, sf_dir):
    pages = extract.with_elements(inputs.detail_pages(spark, sf_dir))
    return extract.with_title(pages).select("page_id", "title")


@query
def extract_address(spark, sf_dir):
    pages = extract.with_elements(inputs.detail_pages(spark, sf_dir))
    return extract.with_address(pages).select("page_id", "address")


@query
def extract_price(spark, sf_dir):
    pages = extract.with_elements(inputs.detail_pages(spark, sf_dir))
    return extract.with_price(pages).select("page_id", "price")


@query
def extract_area(spark, sf_dir):
    pages = extract.with_elements(inputs.detail_pages(spark, sf_dir))
    return extract.with_area(pages).select("page_id", "area")


@query
def extract_coordinates(spark, sf_dir):
    found = inputs.detail_pages(spark, sf_dir).select(
        "page_id", extract.coordinates(F.col("html")).alias("at")
    )
    return found.select("page_id", "at.latitude", "at.longitude")


@query
def drop_blocked_pages(spark, sf_dir):
    return extract.drop_blocked_pages(inputs.detail_pages(spark, sf_dir)).select("page_id", "url")


@query
def extract_listings(spark, sf_dir):
    pages = inputs.detail_pages(spark, sf_dir)
    found = extract.extract_listings(pages, pages, COLLECTED_ON, LINKS)
    return found.withColumnsRenamed(SERVING_NAMES)


@query
def extraction_rate(spark, sf_dir):
    pages = inputs.detail_pages(spark, sf_dir)
    return extract.extraction_rate(pages, pages, LINKS)


@query
def extraction_rate_overall(spark, sf_dir):
    return extract.overall_extraction_rate(extraction_rate(spark, sf_dir), LINKS)


# Checks.


@query
def verify_counts(spark, sf_dir):
    folder = shared_folder(spark)
    rows = serving.serving_rows(raw_listings(spark, sf_dir), ORDER, CITIES, "url")
    snapshots.write_snapshot(rows, folder, "PUBLISH")
    return checks.verify_counts(rows, snapshots.read_current(spark, folder))
