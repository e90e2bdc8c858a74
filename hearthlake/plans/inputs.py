"""Input views of the registered queries, derived from the given tables.

The SQL is written so that Spark and DuckDB read it alike; the checks use the same text.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from hearthlake.session import shared_folder

LISTING_SCHEMA = (
    "url string, muc_gia string, dien_tich string, ia_chi string, ngay_ang string, tieu_e string, "
    "latitude double, longitude double, search_city string, search_property_type string, "
    "search_rent_or_buy string, search_radius int, run_version int, seq bigint"
)
PAGE_SCHEMA = "page_id bigint, url string, html string"

# Serving-table shape: prices and areas are text, some without a number or NULL; one
# url in ten occurs twice.
LISTINGS = """
SELECT
  'https://example.test/listing-pid' || CAST(CASE WHEN o_orderkey % 10 = 9 THEN o_orderkey - 9 ELSE o_orderkey END AS STRING) AS url,
  CASE WHEN o_orderkey % 23 = 0 THEN NULL WHEN o_orderkey % 17 = 0 THEN 'Thỏa thuận'
       ELSE CAST(CAST(ROUND(o_totalprice * 100) AS BIGINT) * 300 AS STRING) END AS muc_gia,
  CASE WHEN o_orderkey % 29 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN CAST(20 + o_orderkey % 180 AS STRING) || ' m2'
       ELSE CAST(20 + o_orderkey % 180 AS STRING) || ' m²' END AS dien_tich,
  CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE n_name END AS ia_chi,
  CAST(CAST(o_orderdate AS DATE) AS STRING) AS ngay_ang,
  'Listing ' || CAST(o_orderkey AS STRING) AS tieu_e,
  CAST(850 + o_orderkey % 1500 AS DOUBLE) / CAST(100 AS DOUBLE) AS latitude,
  CAST(10250 + o_orderkey % 700 AS DOUBLE) / CAST(100 AS DOUBLE) AS longitude,
  LOWER(r_name) AS search_city,
  c_mktsegment AS search_property_type,
  CASE WHEN o_orderkey % 4 = 0 THEN 'rent' ELSE 'buy' END AS search_rent_or_buy,
  CAST(0 AS INT) AS search_radius,
  CAST(o_orderkey % 3 AS INT) AS run_version,
  o_orderkey AS seq
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""

# Stored pages, each both a result page (links to other pages) and a detail page. Every
# branch of the extractors is taken by some pages.
DETAIL_PAGES = """
SELECT o_orderkey AS page_id,
  CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE 'https://nhadat247.com.vn' END || '/tin-pid' || CAST(o_orderkey AS STRING) AS url,
  '<html><head><title>T' || CAST(o_orderkey AS STRING) || ' &amp; co</title><script>var t = "<h1>no</h1>";</script></head><body>' ||
  CASE WHEN o_orderkey % 19 = 0 THEN 'Checking your browser' WHEN o_orderkey % 37 = 0 THEN '<p>Cloudflare</p>' ELSE '' END ||
  CASE WHEN o_orderkey % 7 = 0 THEN ''
       WHEN o_orderkey % 7 = 2 THEN '<h1>Listing ' || CAST(o_orderkey AS STRING) || ' &apos;&#150;</h1>'
       WHEN o_orderkey % 7 = 1 THEN '<!-- <h1>old</h1> --><h1 class="t">Listing <b>' || CAST(o_orderkey AS STRING) || ' &amp; more</b> </h1>'
       ELSE '<h1>Listing ' || CAST(o_orderkey AS STRING) || '</h1>' END ||
  CASE WHEN o_orderkey % 8 = 0 THEN '<span>Ward 1</span><span>Bán nhà 3.5 tỷ, Thanh Xuân, Hà Nội 4 tầng</span>'
       WHEN o_orderkey % 8 = 1 THEN '<span class="re__pr-short-description">Ward ' || CAST(o_orderkey % 9 AS STRING) || ' </span>'
       WHEN o_orderkey % 8 = 2 THEN '<span>Đà Nẵng, Ward ' || CAST(o_orderkey % 9 AS STRING) || ' 80m2 x</span>'
       WHEN o_orderkey % 8 = 3 THEN '<span>Ward ' || CAST(o_orderkey % 9 AS STRING) || '</span>'
       WHEN o_orderkey % 8 = 4 THEN '<span class="re__pr-short-description"><span>Ward ' || CAST(o_orderkey % 9 AS STRING) || '</span>, <b>District</b>, City, extra text</span>'
       ELSE '<span class="js re__pr-short-description">Ward ' || CAST(o_orderkey % 9 AS STRING) || ', District ' || CAST(o_orderkey % 5 AS STRING) || ', City, extra text</span>' END ||
  CASE WHEN o_orderkey % 5 = 0 THEN '<input value="' || CAST(CAST(ROUND(o_totalprice * 100) AS BIGINT) AS STRING) || ' VND" class="a js-gia-bds">'
       WHEN o_orderkey % 5 = 1 THEN '<input class="js-gia-other" value="1">'
       ELSE '<input class="js-gia-bds" value="' || CASE WHEN o_orderkey % 17 < 2 THEN 'n/a' ELSE CAST(CAST(ROUND(o_totalprice * 100) AS BIGINT) AS STRING) || ' VND' END || '">' END ||
  CASE WHEN o_orderkey % 17 = 0 THEN '<p>Thỏa thuận</p>' ELSE '' END ||
  CASE WHEN o_orderkey % 6 = 0 THEN '<div class="re__pr-short-info-item"><span class="title">Diện tích</span><span class="value"> ' || CAST(20 + o_orderkey % 180 AS STRING) || ' m²</span></div>'
       WHEN o_orderkey % 6 = 1 THEN '<p>Rộng ' || CAST(20 + o_orderkey % 180 AS STRING) || 'm2</p>'
       WHEN o_orderkey % 6 = 2 THEN '<p>Mặt tiền</p>'
       WHEN o_orderkey % 6 = 3 THEN '<p>70 m2</p><div class="re__pr-short-info-item"><div class="icon"></div><span>Diện tích</span><span class="value">' || CAST(20 + o_orderkey % 180 AS STRING) || ' m²</span></div>'
       WHEN o_orderkey % 6 = 4 THEN '<p>Giá 70 m2</p><p><b>x</b> Diện tích ' || CAST(20 + o_orderkey % 180 AS STRING) || ' m²</p>'
       ELSE '<p>Diện tích: <b>' || CAST(20 + o_orderkey % 180 AS STRING) || '.5</b> m²</p>' END ||
  CASE WHEN o_orderkey % 13 = 0 THEN '<i>@1.5,2.5</i>' ELSE '' END ||
  CASE WHEN o_orderkey % 11 = 0 THEN ''
       WHEN o_orderkey % 6 = 0 THEN '<a href="https://m.test/place?q=21.' || CAST(1000 + o_orderkey % 9000 AS STRING) || ',105.' || CAST(1000 + o_orderkey % 9000 AS STRING) || '">m</a>'
       WHEN o_orderkey % 6 = 1 THEN '<i>105.' || CAST(1000 + o_orderkey % 9000 AS STRING) || ', 21.' || CAST(1000 + o_orderkey % 9000 AS STRING) || '</i>'
       WHEN o_orderkey % 6 = 2 THEN '<script>{"lat": 10.' || CAST(o_orderkey % 90 AS STRING) || ', "zoom": 3, "lng": 106.' || CAST(o_orderkey % 90 AS STRING) || '}</script>'
       WHEN o_orderkey % 6 = 3 THEN '<script>{"latitude": "16.' || CAST(o_orderkey % 90 AS STRING) || '", "longitude": "108.' || CAST(o_orderkey % 90 AS STRING) || '"}</script>'
       WHEN o_orderkey % 6 = 4 THEN '<a href="https://m.test/?center=105.' || CAST(o_orderkey % 900 AS STRING) || ',21.' || CAST(o_orderkey % 900 AS STRING) || '">m</a>'
       ELSE '<a href="https://m.test/@10.' || CAST(1000 + o_orderkey % 9000 AS STRING) || ',106.' || CAST(1000 + o_orderkey % 9000 AS STRING) || '">m</a>' END ||
  '<a href="/tin-pid' || CAST(o_orderkey + 1 AS STRING) || '">x</a><a class="k" href="https://nhadat247.com.vn/tin-pid' || CAST(o_orderkey * 2 AS STRING) || '">y</a>' ||
  '<a href="/about">z</a><a href="tin-pid' || CAST(o_orderkey % 3 AS STRING) || '">w</a></body></html>' AS html
FROM orders
"""

# Searches as customers enter them: known and unknown cities in several spellings.
SEARCHES = """
SELECT c_custkey AS search_id,
  CASE c_custkey % 8 WHEN 0 THEN 'hanoi' WHEN 1 THEN 'Ho Chi Minh' WHEN 2 THEN 'Đà Nẵng' WHEN 3 THEN 'lâm-đồng'
       WHEN 4 THEN 'Thua Thien Hue' WHEN 5 THEN 'Atlantis' WHEN 6 THEN NULL ELSE 'sài gòn' END AS city,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'office-commerce-industry' WHEN 'FURNITURE' THEN 'can-ho-chung-cu'
       WHEN 'MACHINERY' THEN 'plot' WHEN 'HOUSEHOLD' THEN 'nha-rieng' ELSE LOWER(c_mktsegment) END AS propertyType,
  CASE c_nationkey % 3 WHEN 0 THEN 'rent' WHEN 1 THEN 'buy' ELSE 'swap' END AS rentOrBuy,
  CAST(c_custkey % 50 AS INT) AS radius
FROM customer
"""

# Request bodies, some of them broken or followed by other text.
BODIES = """
SELECT event_id,
  CASE event_type WHEN 'error' THEN SUBSTR(props, 2) WHEN 'view' THEN props || ' x' WHEN 'click' THEN '[' || props || ', null]' ELSE props END AS body
FROM events
"""


def given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _derived(sql: str, **frames: DataFrame) -> DataFrame:
    """Run the SQL with its tables taken from ``frames``."""
    text = sql.replace("{", "{{").replace("}", "}}")
    for table in frames:
        for word in ("FROM", "JOIN"):
            text = text.replace(f"{word} {table}", f"{word} {{{table}}}")
    return next(iter(frames.values())).sparkSession.sql(text, **frames)


_STORED: dict[tuple[str, str, str], str] = {}  # by application, tables and view


def _stored(spark: SparkSession, sf_dir: str, view: str, sql: str, schema: str, *joined: str) -> DataFrame:
    """A table the jobs read, derived from the orders and written once per application.

    It lies in the shared folder, as a crawler or an earlier publish leaves it. Few
    bytes of an order become much text, so the orders are spread over a shuffle's tasks.
    """
    key = (spark.conf.get("spark.app.id"), sf_dir, view)
    if key in _STORED:
        try:
            return spark.read.schema(schema).parquet(_STORED[key])
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    folder = shared_folder(spark)
    orders = given(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    orders = orders.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    others = {t: given(spark, sf_dir, t) for t in joined}
    _derived(sql, orders=orders, **others).write.parquet(folder)
    _STORED[key] = folder
    return spark.read.schema(schema).parquet(folder)


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "listings", LISTINGS, LISTING_SCHEMA, "customer", "nation", "region")


def detail_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "detail_pages", DETAIL_PAGES, PAGE_SCHEMA)


def searches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derived(SEARCHES, customer=given(spark, sf_dir, "customer"))


def bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derived(BODIES, events=given(spark, sf_dir, "events"))
