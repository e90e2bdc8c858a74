"""Listings out of stored web pages.

A stored page is a row ``page_id, url, html``; ``html`` is NULL when the fetch failed.
Every field is a column expression over the whole page, so extraction is one
shuffle-free pass. Markup is matched by patterns; spans and divs end where their tags
balance, headings at the first closing tag, and attribute values do not contain ``>``. Comments, scripts and
styles are removed before elements are looked for; the patterns that are meant for the
raw page (coordinates, blocking, the last area fallback) see it whole.

The ``with_`` functions work in steps. What a step finds is a column of its own, empty
when there is nothing, because Spark evaluates a column once that several later
expressions use, but a repeated expression inside a condition again and again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthlake.functions.text import absolute_url, around, elements, normalize_url, raw_text_of, strip, text_of, unquote
from hearthlake.operators.columns import LISTING_SCHEMA, conform
from hearthlake.operators.dedup import dedup_keep_last
from hearthlake.operators.prefilter import key_bitmap, with_possible_key
from hearthlake.session import staged

# Texts and patterns that decide what is found.
BLOCKED_TEXTS = ["Cloudflare", "Checking your browser"]
LINK_PART = "-pid"
DEFAULT_LINKS_PER_PAGE = 5
DESCRIPTION_CLASS = "re__pr-short-description"
PRICE_CLASS = "js-gia-bds"
AREA_ITEM_CLASS = "re__pr-short-info-item"
AREA_VALUE_CLASS = "re__pr-specs-content-item-value|value"
AREA_LABEL = "Diện tích"
NEGOTIABLE = "Thỏa thuận"
PLACE_NAMES = ["Thanh Xuân", "Hà Nội", "TP.HCM", "Đà Nẵng", "Cần Thơ"]
ADDRESS_NOISE = [
    r"Bán\s+.*?\d+(?:\.\d+)?\s*(?:tỷ|triệu).*?(?=\w)",
    r"\d+(?:\.\d+)?\s*(?:tỷ|triệu).*",
    r"\d+\s*tầng.*",
    r"\d+m2.*",
]
ADDRESS_PARTS = 3
ADDRESS_MIN_LENGTH = 3
AREA_PATTERN = r"(\d+(?:\.\d+)?\s*(?:m²|m2|mét|vuông))"
COORDINATE_PATTERNS = [
    r"place\?q=([-+]?\d*\.\d+),([-+]?\d*\.\d+)",
    r"([-+]?\d{1,3}\.\d{4,}),\s*([-+]?\d{1,3}\.\d{4,})",
    r'"lat"\s*:\s*([-+]?\d*\.\d+).*?"lng"\s*:\s*([-+]?\d*\.\d+)',
    r"""latitude["']\s*:\s*["']?([-+]?\d*\.\d+)["']?.*?longitude["']\s*:\s*["']?([-+]?\d*\.\d+)["']?""",
    r"center=([-+]?\d*\.\d+),([-+]?\d*\.\d+)",
    r"@([-+]?\d*\.\d+),([-+]?\d*\.\d+)",
]
LATITUDE_RANGE = (8, 24)
LONGITUDE_RANGE = (102, 110)

# Markup patterns. (?U) makes classes Unicode-aware, (?d) lets only \n end a line.
QUOTED = r"""("[^"]*"|'[^']*'|[^\s"'>]+)"""
NOT_MARKUP = r"(?is)<(?:!--.*?--|(script|style)\b.*?</\1\s*)>"
FIRST_H1 = r"(?is)<h1\b[^>]*>.*?</h1\s*>"
FIRST_TITLE = r"(?is)<title\b[^>]*>.*?</title\s*>"
ANY_SPAN = r"(?is)<span\b[^>]*>"
LINK = rf"(?is)<a\s(?:[^>]*?\s)?href\s*=\s*{QUOTED}"
VALUE = rf"(?is)\svalue\s*=\s*{QUOTED}"


def _start(tag: str, css_class: str) -> str:
    """A start tag whose class attribute contains the given pattern."""
    return rf"""(?is)<{tag}\s(?:[^>]*?\s)?class\s*=\s*["'][^"'>]*?(?:{css_class})[^>]*>"""


DESCRIPTION_SPAN = _start("span", DESCRIPTION_CLASS)
AREA_ITEM = _start("div", AREA_ITEM_CLASS)
AREA_VALUE_SPAN = _start("span", AREA_VALUE_CLASS)
PRICE_INPUT = rf"""(?is)<input\s(?:[^>]*?\s)?class\s*=\s*["']?(?:[^"'>]*\s)?{PRICE_CLASS}(?=[\s"'/>])[^>]*>"""


def _found(text: Column, pattern: str) -> Column:
    """First match of the whole pattern, empty without a match."""
    return F.regexp_extract(text, pattern, 0)


def _all(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def _first_filled(*names: str) -> Column:
    """The first of the columns that is neither NULL nor empty, else NULL."""
    return F.coalesce(*[F.when(F.col(n) != "", F.col(n)) for n in names])


def with_elements(pages: DataFrame) -> DataFrame:
    """Add the page without comments, scripts and styles, which the element patterns read."""
    return pages.withColumn("_elements", F.regexp_replace("html", NOT_MARKUP, ""))


def is_blocked(html: Column) -> Column:
    blocked = F.lit(False)
    for text in BLOCKED_TEXTS:
        blocked = blocked | html.contains(text)
    return blocked


def drop_blocked_pages(pages: DataFrame) -> DataFrame:
    """Pages that were fetched and are not a bot check."""
    return pages.filter(F.col("html").isNotNull() & ~is_blocked(F.col("html")))


def detail_links(markup: Column) -> Column:
    """Absolute urls of all links to detail pages, in page order."""
    hrefs = F.transform(_all(markup, LINK, 1), unquote)
    details = F.filter(hrefs, lambda h: h.contains(LINK_PART))
    return F.transform(F.transform(details, strip), lambda h: absolute_url(h))


def with_title(pages: DataFrame) -> DataFrame:
    """Add ``title``: text of the first ``h1``, else of the first ``title``."""
    markup, heading = F.col("_elements"), F.col("_heading")
    return (
        pages.withColumn("_h1", _found(markup, FIRST_H1))
        .withColumn(
            "_heading", F.when(F.col("_h1") != "", F.col("_h1")).otherwise(_found(markup, FIRST_TITLE))
        )
        .withColumn("title", F.when(heading != "", text_of(heading)))
    )


def _address_from_spans(markup: Column) -> Column:
    def names_place(text: Column) -> Column:
        found = F.lit(False)
        for place in PLACE_NAMES:
            found = found | text.contains(place)
        return found

    def without_noise(text: Column) -> Column:
        for noise in ADDRESS_NOISE:
            text = F.regexp_replace(text, "(?Ud)" + noise, "")
        return strip(text)

    texts = F.transform(elements(markup, "span", ANY_SPAN), text_of)
    cleaned = F.transform(F.filter(texts, names_place), without_noise)
    return F.get(F.filter(cleaned, lambda t: F.length(t) > ADDRESS_MIN_LENGTH), F.lit(0))


def with_address(pages: DataFrame) -> DataFrame:
    """Add ``address``: first three comma parts of the description, else a span that names a known place."""
    described = F.col("_description")
    described_spans = elements(F.col("_elements"), "span", DESCRIPTION_SPAN)
    parts = F.slice(F.split(described, ","), 1, ADDRESS_PARTS)
    return (
        pages.withColumn("_description", F.coalesce(text_of(F.get(described_spans, F.lit(0))), F.when(F.col("html").isNotNull(), "")))
        .withColumn("_span", F.when(described == "", _address_from_spans(F.col("_elements"))))
        .withColumn(
            "address",
            F.when(described != "", strip(F.array_join(parts, ","))).otherwise(F.col("_span")),
        )
    )


def with_price(pages: DataFrame) -> DataFrame:
    """Add ``price``: digits of the price input; without digits the negotiable mark or the raw value."""
    html, value, raw = F.col("html"), F.col("_value"), F.col("_raw")
    negotiable = html.contains(NEGOTIABLE) | F.lower(html).contains(NEGOTIABLE.lower())
    return (
        pages.withColumn("_input", _found(F.col("_elements"), PRICE_INPUT))
        .withColumn("_value", unquote(F.regexp_extract("_input", VALUE, 1)))
        .withColumn("_raw", strip(value))
        .withColumn("_digits", F.regexp_replace(raw, r"(?U)\D", ""))
        .withColumn(
            "price",
            F.when(F.col("_digits") != "", F.col("_digits"))
            .when((value != "") & negotiable, F.lit(NEGOTIABLE))
            .when(raw != "", raw),
        )
    )


def with_area(pages: DataFrame) -> DataFrame:
    """Add ``area``: value of the labelled item, else the area near the label, else the first on the page."""
    html, markup = F.col("html"), F.col("_elements")
    pattern = "(?iU)" + AREA_PATTERN
    items = F.filter(elements(markup, "div", AREA_ITEM), lambda i: raw_text_of(i).contains(AREA_LABEL))
    values = F.filter(F.transform(items, lambda i: F.get(elements(i, "span", AREA_VALUE_SPAN), F.lit(0))), lambda v: v.isNotNull())
    labelled = F.coalesce(strip(F.regexp_extract(around(markup, AREA_LABEL), pattern, 1)), F.lit(""))
    return (
        pages.withColumn("_item", F.coalesce(text_of(F.get(values, F.lit(0))), F.lit("")))
        .withColumn("_labelled", F.when(F.col("_item") == "", labelled))
        .withColumn("_anywhere", F.when(F.col("_labelled") == "", F.regexp_extract(html, pattern, 1)))
        .withColumn("area", _first_filled("_item", "_labelled", "_anywhere"))
    )


def coordinates(html: Column) -> Column:
    """Struct of latitude and longitude: the first pair in range, patterns tried in order.

    A pair may be written either way round. Later patterns are only run on pages where
    the earlier ones found nothing in range.
    """

    def pair(pattern: str) -> Column:
        def read(match: Column) -> Column:
            a = F.regexp_extract(match, pattern, 1).try_cast("double")
            b = F.regexp_extract(match, pattern, 2).try_cast("double")
            straight = a.between(*LATITUDE_RANGE) & b.between(*LONGITUDE_RANGE)
            turned = b.between(*LATITUDE_RANGE) & a.between(*LONGITUDE_RANGE)
            return F.when(straight, F.struct(a.alias("latitude"), b.alias("longitude"))).when(
                turned, F.struct(b.alias("latitude"), a.alias("longitude"))
            )

        found = F.transform(_all(html, pattern), read)
        return F.get(F.filter(found, lambda p: p.isNotNull()), F.lit(0))

    return F.coalesce(*[pair("(?id)" + p) for p in COORDINATE_PATTERNS])


def links_per_page(pages: DataFrame, limit: int = DEFAULT_LINKS_PER_PAGE) -> DataFrame:
    """The first ``limit`` detail links of each page that is not blocked: page_id, position, link."""
    links = F.slice(detail_links(F.col("_elements")), 1, limit)
    # The outer form, because for the plain one Spark adds a filter that finds all links twice.
    return (
        with_elements(drop_blocked_pages(pages))
        .select("page_id", F.posexplode_outer(links).alias("position", "link"))
        .filter(F.col("link").isNotNull())
    )


def extract_details(pages: DataFrame, collected_on: Column | str, keep: Sequence[str] = ()) -> DataFrame:
    """One listing row per fetched detail page: the fixed listing columns and those to ``keep`` of the page."""
    day = F.lit(collected_on) if isinstance(collected_on, str) else collected_on
    extracted = with_elements(pages.filter(F.col("html").isNotNull()))
    for step in (with_title, with_address, with_price, with_area):
        extracted = step(extracted)
    extracted = extracted.withColumn("_at", coordinates(F.col("html")))
    return conform(
        extracted.select(
            normalize_url(F.col("url")).alias("url"),
            F.col("area").alias("Diện tích"),
            F.col("price").alias("Mức giá"),
            F.col("address").alias("Địa chỉ"),
            day.alias("Ngày đăng"),
            F.col("title").alias("Tiêu đề"),
            "_at.latitude",
            "_at.longitude",
            *keep,
        ),
        T.StructType([*LISTING_SCHEMA.fields, *[pages.schema[c] for c in keep]]),
    )


def extract_listings(
    result_pages: DataFrame,
    detail_pages: DataFrame,
    collected_on: str,
    limit: int = DEFAULT_LINKS_PER_PAGE,
    fetched: Sequence[str] = (),
) -> DataFrame:
    """Listings behind the first ``limit`` links of each result page, one row per link.

    ``detail_pages`` holds one stored page per url, or several fetches of a url of which
    the last in the order of the columns ``fetched`` counts. Links are found first and
    written to the shared folder; detail pages that none of them can lead to are left out
    before anything is looked for in them, by a bitmap of the linked urls, so no page is
    shuffled. Fields are extracted once per detail page and before the join, which then
    moves short listing rows only. When one listing is linked from very many pages the
    links are the skewed side and adaptive execution splits them.
    """
    links = staged(links_per_page(result_pages, limit).select("page_id", "position", F.col("link").alias("url")))
    linked = with_possible_key(detail_pages, normalize_url(F.col("url")), key_bitmap(links, "url"))
    details = extract_details(linked, collected_on, fetched)
    if fetched:
        details = dedup_keep_last(details, fetched, "url").drop(*fetched)
    return links.join(details, "url").select(
        "page_id", "position", *LISTING_SCHEMA.names
    )


def _percent(found: Column, expected: Column) -> Column:
    return F.when(expected > 0, found * 100.0 / expected).otherwise(F.lit(0.0))


def extraction_rate(
    result_pages: DataFrame, detail_pages: DataFrame, limit: int = DEFAULT_LINKS_PER_PAGE
) -> DataFrame:
    """Per result page: listings found, and their share of ``limit`` in percent.

    Blocked pages and pages without links count with zero: every page adds a zero row
    that only needs its id, instead of an outer join on a missing link.
    """
    stored = detail_pages.filter(F.col("html").isNotNull()).select(
        normalize_url(F.col("url")).alias("link")
    )
    hits = links_per_page(result_pages, limit).join(stored, "link", "left_semi")
    counted = hits.select("page_id", F.lit(1).alias("_hit")).unionByName(
        result_pages.select("page_id", F.lit(0).alias("_hit"))
    )
    rates = counted.groupBy("page_id").agg(F.sum("_hit").alias("found"))
    return rates.withColumn("success_rate", _percent(F.col("found"), F.lit(limit)))


def overall_extraction_rate(rates: DataFrame, limit: int = DEFAULT_LINKS_PER_PAGE) -> DataFrame:
    """One row: pages, listings found and the share of all expected listings in percent."""
    totals = rates.agg(
        F.count("*").alias("pages"), F.coalesce(F.sum("found"), F.lit(0)).alias("found")
    )
    return totals.withColumn("success_rate", _percent(F.col("found"), F.col("pages") * limit))
