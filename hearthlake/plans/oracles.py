"""DuckDB SQL with the result each registered query must have."""

from __future__ import annotations

from hearthlake.plans import catalog, inputs, site_values

VIEWS = {
    "listings": inputs.LISTINGS,
    "detail_pages": inputs.DETAIL_PAGES,
    "searches": inputs.SEARCHES,
    "bodies": inputs.BODIES,
}

KEY = "substr(md5(url), 1, 16)"
PRICE = "TRY_CAST(regexp_replace(muc_gia, '[^0-9.]', '', 'g') AS DOUBLE)"
AREA = "TRY_CAST(regexp_replace(dien_tich, '[^0-9.]', '', 'g') AS DOUBLE)"


def money(x: str) -> str:
    return f"format('{{:,.0f}}', {x})"


def area_text(x: str) -> str:
    trimmed = f"regexp_replace(format('{{:,.2f}}', {x}), '0{{1,2}}$', '')"
    return f"regexp_replace({trimmed}, '^(-?)0(\\.[0-9])', '\\1\\2')"


def percentage(count: str, total: str) -> str:
    # Hundredths of a percent rounded half up in whole numbers.
    return f"CAST((20000 * {count} + {total}) // (2 * {total}) AS DOUBLE) / 100"


VIEWS["numeric"] = f"SELECT *, {PRICE} AS price, {AREA} AS area FROM listings"
VIEWS["priced"] = "SELECT * FROM numeric WHERE price IS NOT NULL AND area IS NOT NULL"
VIEWS["first_crawl"] = f"SELECT * FROM listings WHERE ngay_ang < '{catalog.FIRST_CRAWL_UNTIL}'"
VIEWS["second_crawl"] = f"""
SELECT * REPLACE (CASE WHEN search_property_type IN ('BUILDING', 'MACHINERY') THEN muc_gia || '0' ELSE muc_gia END AS muc_gia)
FROM listings WHERE ngay_ang >= '{catalog.SECOND_CRAWL_FROM}'"""
for crawl in ("first", "second"):
    VIEWS[f"stored_{crawl}"] = f"""
SELECT DISTINCT ON (url) *, {KEY} AS "propertyDetails_propertyId", TRY_CAST(muc_gia AS BIGINT) AS "propertyDetails_normalizedPrice"
FROM {crawl}_crawl ORDER BY url, run_version DESC, seq DESC"""
VIEWS["candidates"] = """
SELECT "propertyDetails_propertyId" AS id, "propertyDetails_propertyId" || '-' || CAST("propertyDetails_normalizedPrice" AS VARCHAR) AS fingerprint,
  'false' AS is_prefix, search_rent_or_buy AS "rentOrBuy", search_city AS city, search_property_type AS "propertyType",
  search_radius AS radius, "propertyDetails_normalizedPrice" AS last_normalized_price
FROM stored_second"""
VIEWS["merged"] = """
SELECT f.* FROM stored_first f WHERE f.url NOT IN (SELECT url FROM stored_second)
UNION ALL SELECT * FROM stored_second"""
VIEWS["latest"] = "SELECT DISTINCT ON (url) * FROM listings ORDER BY url, run_version DESC, seq DESC"
VIEWS["stats"] = f"""
SELECT COUNT(*) AS total_properties, {money('AVG(price)')} AS avg_price, {money('MIN(price)')} AS min_price,
  {money('MAX(price)')} AS max_price, {area_text('AVG(area)')} AS avg_area, COUNT(DISTINCT ia_chi) AS cities_count
FROM priced"""
VIEWS["by_city"] = f"""
SELECT ia_chi AS city, COUNT(*) AS property_count, {money('AVG(price)')} AS avg_price, {money('MIN(price)')} AS min_price,
  {money('MAX(price)')} AS max_price, {money('AVG(price / NULLIF(area, 0))')} AS avg_price_per_sqm, AVG(price) AS rank_price
FROM numeric WHERE price > 0 AND area > 0 AND ia_chi IS NOT NULL GROUP BY ia_chi"""
VIEWS["by_location"] = f"""
SELECT location, n AS "count", {percentage('n', 'total')} AS percentage, avg_price, avg_area FROM (
  SELECT ia_chi AS location, COUNT(*) AS n, CAST(SUM(COUNT(*)) OVER () AS BIGINT) AS total,
    {money('AVG(price)')} AS avg_price, {area_text('AVG(area)')} AS avg_area
  FROM priced WHERE ia_chi IS NOT NULL GROUP BY ia_chi)
ORDER BY "count" DESC, location LIMIT 20"""
VIEWS["trends"] = f"""
SELECT CAST(ngay_ang AS DATE) AS date, COUNT(*) AS daily_count, {money('AVG(price)')} AS avg_price, {area_text('AVG(area)')} AS avg_area
FROM priced WHERE ngay_ang IS NOT NULL GROUP BY 1 ORDER BY 1 DESC LIMIT 30"""

VIEWS["merged_priced"] = f"""SELECT * FROM (SELECT *, {PRICE} AS price, {AREA} AS area FROM merged) WHERE price IS NOT NULL AND area IS NOT NULL"""

NUMBER = "CAST(replace({0}, ',', '') AS DOUBLE)"


def number(column: str) -> str:
    return NUMBER.format(column)


# Stored pages, read a second way. The patterns here only know the markup of the view.
SITE = "https://nhadat247.com.vn"
BLOCKED = "(html LIKE '%Cloudflare%' OR html LIKE '%Checking your browser%')"
DETAIL_URL = f"CASE WHEN url LIKE 'http%' THEN url ELSE '{SITE}' || url END"
SHOWN = "regexp_replace(html, '<!--.*?-->|<script>.*?</script>', '', 'g')"


def plain(x: str) -> str:
    text = f"trim(regexp_replace({x}, ' *<[^>]*> *', '', 'g'))"
    for name, character in (("quot", '"'), ("apos", "''"), ("#150", "–"), ("#39", "''"), ("lt", "<"), ("gt", ">"), ("amp", "&")):
        text = f"replace({text}, '&{name};', '{character}')"
    return text


TITLE = f"""CASE WHEN {SHOWN} LIKE '%<h1%' THEN {plain(f"regexp_extract({SHOWN}, '<h1.*?</h1>')")}
  ELSE {plain(f"regexp_extract({SHOWN}, '<title>.*?</title>')")} END"""
# Pages whose markup is nested have their value stated, as the view writes it.
ADDRESS = """CASE
  WHEN page_id % 8 = 4 THEN 'Ward ' || CAST(page_id % 9 AS VARCHAR) || ',District, City'
  WHEN html LIKE '%re__pr-short-description%' THEN
    trim(array_to_string(list_slice(string_split(regexp_extract(html, 're__pr-short-description">([^<]*)<', 1), ','), 1, 3), ','))
  WHEN html LIKE '%<span>Bán nhà%' THEN
    trim(regexp_replace(regexp_replace(regexp_extract(html, '<span>(Bán[^<]*)<', 1),
      'Bán\\s+.*?[0-9.]+\\s*tỷ[^\\p{L}\\p{N}_]*([\\p{L}\\p{N}_])', '\\1'), '[0-9]+\\s*tầng.*', ''))
  WHEN html LIKE '%<span>Đà Nẵng%' THEN trim(regexp_replace(regexp_extract(html, '<span>(Đà Nẵng[^<]*)<', 1), '[0-9]+m2.*', ''))
  END"""
INPUT_VALUE = """coalesce(
  nullif(regexp_extract(html, '<input value="([^"]*)" class="[^"]*js-gia-bds">', 1), ''),
  nullif(regexp_extract(html, '<input class="js-gia-bds" value="([^"]*)">', 1), ''))"""
LISTING_PRICE = f"""CASE WHEN regexp_replace({INPUT_VALUE}, '[^0-9]', '', 'g') <> '' THEN regexp_replace({INPUT_VALUE}, '[^0-9]', '', 'g')
  WHEN {INPUT_VALUE} IS NOT NULL AND html LIKE '%Thỏa thuận%' THEN 'Thỏa thuận' ELSE {INPUT_VALUE} END"""
SIZE = "([0-9]+(?:\\.[0-9]+)?\\s*(?:m²|m2|mét|vuông))"
LISTING_AREA = f"""CASE WHEN page_id % 6 IN (3, 4) THEN CAST(20 + page_id % 180 AS VARCHAR) || ' m²' ELSE coalesce(
  nullif(trim(regexp_extract(html, 'Diện tích</span><span class="value">([^<]*)</span>', 1)), ''),
  nullif(regexp_extract(regexp_replace(regexp_extract(html, '<p>(Diện tích.*?)</p>', 1), '<[^>]*>', '', 'g'), '{SIZE}', 1), ''),
  nullif(regexp_extract(html, '{SIZE}', 1), '')) END"""


def _coordinate_pairs(pattern: str) -> str:
    found = pattern.replace("'", "''")
    a, b = (f"regexp_extract_all(html, '(?i){found}', {g})" for g in (1, 2))
    return f"""list_filter(list_transform(list_zip({a}, {b}), lambda p: CASE
    WHEN CAST(p[1] AS DOUBLE) BETWEEN 8 AND 24 AND CAST(p[2] AS DOUBLE) BETWEEN 102 AND 110 THEN [CAST(p[1] AS DOUBLE), CAST(p[2] AS DOUBLE)]
    WHEN CAST(p[2] AS DOUBLE) BETWEEN 8 AND 24 AND CAST(p[1] AS DOUBLE) BETWEEN 102 AND 110 THEN [CAST(p[2] AS DOUBLE), CAST(p[1] AS DOUBLE)] END),
    lambda p: p IS NOT NULL)[1]"""


POSITION = "coalesce(" + ",\n  ".join(_coordinate_pairs(p) for p in site_values.COORDINATES) + ")"
VIEWS["details"] = f"""
SELECT {DETAIL_URL} AS url, {LISTING_AREA} AS dien_tich, {LISTING_PRICE} AS muc_gia, {ADDRESS} AS ia_chi,
  '{catalog.COLLECTED_ON}' AS ngay_ang, {TITLE} AS tieu_e, {POSITION} AS place FROM detail_pages"""
VIEWS["links"] = f"""
SELECT page_id, CAST(i - 1 AS INTEGER) AS position, hrefs[i] AS link FROM (
  SELECT page_id, unnest(range(1, {catalog.LINKS} + 1)) AS i, list_transform(
    list_filter(regexp_extract_all({SHOWN}, '<a[^>]* href="([^"]*)"', 1), lambda h: h LIKE '%-pid%'),
    lambda h: CASE WHEN h LIKE 'http%' THEN h WHEN h LIKE '/%' THEN '{SITE}' || h ELSE '{SITE}/' || h END) AS hrefs
  FROM detail_pages WHERE NOT {BLOCKED})
WHERE i <= len(hrefs)"""
VIEWS["rates"] = f"""
SELECT page_id, CAST(COALESCE(found, 0) AS BIGINT) AS found, COALESCE(found, 0) * 100.0::DOUBLE / {catalog.LINKS} AS success_rate
FROM detail_pages LEFT JOIN (
  SELECT page_id, COUNT(*) AS found FROM links WHERE link IN (SELECT url FROM details) GROUP BY page_id) USING (page_id)"""

TEXT_COLUMNS = [
    "url", "muc_gia", "dien_tich", "ia_chi", "ngay_ang", "tieu_e",
    "search_city", "search_property_type", "search_rent_or_buy",
]
NUMBER_COLUMNS = ["latitude", "longitude", "search_radius", "run_version", "seq"]


def _text_profile(c: str) -> str:
    return f"""SELECT '{c}' AS "column", COUNT({c}) AS "count", COUNT(DISTINCT {c}) AS "unique",
  (SELECT {c} FROM listings WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY COUNT(*) DESC, {c} LIMIT 1) AS top,
  (SELECT COUNT(*) FROM listings WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY COUNT(*) DESC LIMIT 1) AS freq,
  NULL::DOUBLE AS mean, NULL::DOUBLE AS std, NULL::DOUBLE AS min, NULL::DOUBLE AS max,
  NULL::DOUBLE AS p25, NULL::DOUBLE AS p50, NULL::DOUBLE AS p75 FROM listings"""


def _number_profile(c: str) -> str:
    quartiles = ", ".join(
        f"ROUND(quantile_cont(CAST({c} AS DOUBLE), {q}), 6) AS p{int(q * 100)}" for q in (0.25, 0.5, 0.75)
    )
    return f"""SELECT '{c}', COUNT({c}), NULL::BIGINT, NULL::VARCHAR, NULL::BIGINT, ROUND(AVG({c}), 6), ROUND(STDDEV_SAMP({c}), 6),
  CAST(MIN({c}) AS DOUBLE), CAST(MAX({c}) AS DOUBLE), {quartiles} FROM listings"""


VIEWS["search_urls"] = f"""
SELECT searches.*, '{SITE}/' || COALESCE(action, 'mua-ban') || '-nha-dat-' || COALESCE(code || '-', '') || COALESCE(category, 'ci38') || '.html' AS search_url
FROM searches LEFT JOIN (VALUES {site_values.CITIES}) AS cities(slug, code) ON slug = lower(replace(city, ' ', '-'))
LEFT JOIN (VALUES {site_values.CATEGORIES}) AS types(name, category) ON types.name = "propertyType"
LEFT JOIN (VALUES {site_values.ACTIONS}) AS actions(name, action) ON actions.name = "rentOrBuy" """
VIEWS["last_criteria"] = """
SELECT DISTINCT ON (search_url) search_url, COALESCE(city, '') AS search_city, COALESCE("propertyType", '') AS search_property_type,
  COALESCE("rentOrBuy", '') AS search_rent_or_buy, COALESCE(radius, 0) AS search_radius
FROM search_urls ORDER BY search_url, 2 DESC, 3 DESC, 4 DESC, 5 DESC"""
VIEWS["found_links"] = f"""
SELECT search_id AS page_id, 0 AS position, search_url, '{SITE}/tin-pid' || CAST(search_id AS VARCHAR) AS link FROM search_urls
UNION ALL SELECT search_id, 1, search_url, '{SITE}/tin-pid' || CAST(2 * search_id AS VARCHAR) FROM search_urls"""

SERVING_COLUMNS = """url, muc_gia, dien_tich, ia_chi, ngay_ang, tieu_e, latitude, longitude, search_city,
  search_property_type, search_rent_or_buy, search_radius, run_version, seq"""
CITIES = "('asia', 'europe')"

BODY: dict[str, str] = {
    "read_json_folder": "SELECT CAST(seq AS VARCHAR) AS id, tieu_e AS oddnamex, TRY_CAST(muc_gia AS BIGINT) AS price FROM listings",
    "json_gzip_roundtrip": "SELECT url, muc_gia, latitude, seq FROM listings",
    "read_parquet_union": f"""SELECT url, muc_gia, CASE WHEN ngay_ang >= '{catalog.FIRST_CRAWL_UNTIL}' THEN dien_tich END AS dien_tich, seq
FROM listings""",
    "snapshot_write_read": "SELECT * FROM listings",
    "snapshot_history": """SELECT 0 AS version, 'CREATE' AS operation, COUNT(*) AS stored_rows FROM first_crawl
UNION ALL SELECT 1, 'OVERWRITE', COUNT(*) FROM second_crawl""",
    "read_json_documents": "SELECT CAST(seq AS VARCHAR) AS id, TRY_CAST(muc_gia AS BIGINT) AS price FROM listings",
    "refresh_listings": f"""SELECT DISTINCT ON (url) {KEY} AS propertydetails_propertyid, url, muc_gia, dien_tich, ia_chi,
  CASE WHEN CAST(regexp_extract(url, 'pid([0-9]+)$', 1) AS BIGINT) % 3 = 0 THEN 'Fetch 2' ELSE tieu_e END AS tieu_e,
  search_city, search_property_type, search_rent_or_buy, search_radius
FROM found_links JOIN last_criteria USING (search_url) JOIN details ON link = url ORDER BY url, page_id DESC, position DESC""",
    "empty_crawl": "SELECT COUNT(*) AS stored_rows, CAST(1 AS BIGINT) AS versions FROM stored_first",
    "emit_if": "SELECT seq FROM listings",
    "sample_one": "SELECT LEAST(COUNT(*), 1) AS drawn FROM listings",
    "report_rows": """SELECT 'basic_stats' AS report, COUNT(*) AS report_rows FROM stats UNION ALL SELECT 'price_by_city', COUNT(*) FROM by_city
UNION ALL SELECT 'location_distribution', COUNT(*) FROM by_location UNION ALL SELECT 'recent_trends', COUNT(*) FROM trends
UNION ALL SELECT 'price_ranges', COUNT(DISTINCT CASE WHEN price < 1e9 THEN 1 WHEN price < 3e9 THEN 2 WHEN price < 5e9 THEN 3 WHEN price < 1e10 THEN 4 ELSE 5 END)
FROM numeric WHERE price > 0""",
    "report_values": f"""SELECT 'basic_stats' AS report, CAST(cities_count AS VARCHAR) AS name, total_properties AS n,
  concat_ws('/', avg_price, min_price, max_price) AS prices, avg_area AS area, CAST(NULL AS DOUBLE) AS percentage FROM stats
UNION ALL SELECT 'price_by_city', city, property_count, concat_ws('/', avg_price, min_price, max_price), avg_price_per_sqm, NULL FROM by_city
UNION ALL SELECT 'location_distribution', location, "count", avg_price, avg_area, percentage FROM by_location
UNION ALL SELECT 'recent_trends', CAST(date AS VARCHAR), daily_count, avg_price, avg_area, NULL FROM trends
UNION ALL SELECT 'price_ranges', price_range, n, '', avg_area, {percentage('n', 'total')} FROM (
  SELECT CASE WHEN price < 1000000000 THEN '< 1 tỷ' WHEN price < 3000000000 THEN '1-3 tỷ' WHEN price < 5000000000 THEN '3-5 tỷ'
    WHEN price < 10000000000 THEN '5-10 tỷ' ELSE '> 10 tỷ' END AS price_range, COUNT(*) AS n,
    CAST(SUM(COUNT(*)) OVER () AS BIGINT) AS total, {area_text('AVG(area)')} AS avg_area
  FROM numeric WHERE price > 0 GROUP BY 1)""",
    "read_current_table": f"""SELECT CAST(seq AS VARCHAR) AS id, TRY_CAST(muc_gia AS BIGINT) AS "propertyDetails_normalizedPrice",
  {KEY} AS "propertyDetails_propertyId", dien_tich AS "propertyDetails_rooms", tieu_e AS oddnamex FROM listings""",
    "publish_full_refresh": f"SELECT {SERVING_COLUMNS} FROM latest WHERE search_city IN {CITIES}",
    "merge_keeps_columns": """SELECT "propertyDetails_propertyId" AS propertydetails_propertyid, seq,
  CASE WHEN url NOT IN (SELECT url FROM stored_second) THEN 'image of ' || CAST(seq AS VARCHAR) END AS images FROM merged""",
    "served_city": """SELECT "propertyDetails_propertyId" AS propertydetails_propertyid, url, muc_gia, search_city, seq
FROM merged WHERE search_city = 'asia'""",
    "served_trends": f"""SELECT CAST(ngay_ang AS DATE) AS date, COUNT(*) AS daily_count, {money('AVG(price)')} AS avg_price, {area_text('AVG(area)')} AS avg_area
FROM merged_priced WHERE ngay_ang IS NOT NULL GROUP BY 1 ORDER BY 1 DESC LIMIT 30""",
    "stored_lookup": f"""SELECT "propertyDetails_propertyId", url, muc_gia, seq FROM merged WHERE "propertyDetails_propertyId" = '{catalog.ONE_PROPERTY}'""",
    "merge_and_publish": f"""SELECT "propertyDetails_propertyId" AS propertydetails_propertyid, url, muc_gia, search_city, seq
FROM merged WHERE search_city IN {CITIES}""",
    "flatten_json": f"""SELECT CAST(seq AS VARCHAR) AS id, TRY_CAST(muc_gia AS BIGINT) AS "propertyDetails_normalizedPrice",
  {KEY} AS "propertyDetails_propertyId", '["' || search_city || '","' || search_rent_or_buy || '"]' AS "propertyDetails_images",
  '[]' AS "propertyDetails_pdfs", dien_tich AS "propertyDetails_rooms", tieu_e AS oddnamex FROM listings""",
    "arrays_to_json": """SELECT CAST(seq AS VARCHAR) AS id, CAST(to_json([search_city, search_rent_or_buy]) AS VARCHAR) AS "propertyDetails_images",
  '[]' AS "propertyDetails_pdfs" FROM listings""",
    "unify_price_column": 'SELECT CAST(seq AS VARCHAR) AS id, TRY_CAST(muc_gia AS BIGINT) AS "propertyDetails_normalizedPrice" FROM listings',
    "json_validity": "SELECT event_id, COALESCE(json_valid(body), FALSE) AS is_valid FROM bodies",
    "sanitize_columns": "SELECT * FROM listings",
    "parquet_safe_columns": 'SELECT url, muc_gia AS "giaVND", dien_tich AS "dien_tichm2" FROM listings',
    "prefix_columns": "SELECT url AS listing_url, muc_gia AS listing_muc_gia FROM listings",
    "canonicalize_columns": 'SELECT search_id, city, "propertyType" AS propertytype, "rentOrBuy" AS rentorbuy, radius FROM searches',
    "replace_values": """SELECT seq, muc_gia, CASE WHEN search_rent_or_buy = 'rent' THEN 'lease' ELSE search_rent_or_buy END AS search_rent_or_buy
FROM listings""",
    "conform_schema": """SELECT url, dien_tich, muc_gia, ia_chi, ngay_ang, NULL::VARCHAR AS tieu_e, latitude, NULL::DOUBLE AS longitude
FROM listings""",
    "attach_lineage": """SELECT seq, url, 'hanoi' AS search_city, 'can-ho-chung-cu' AS search_property_type, 'buy' AS search_rent_or_buy,
  CAST(0 AS INTEGER) AS search_radius FROM listings""",
    "filter_city": "SELECT seq, url, search_city FROM listings WHERE search_city = 'asia'",
    "lookup_property": f"""SELECT {KEY} AS "propertyDetails_propertyId", muc_gia, url, latitude, longitude FROM listings
WHERE {KEY} = '{catalog.ONE_PROPERTY}'""",
    "changed_or_new": """SELECT p.* FROM candidates p LEFT JOIN (
  SELECT "propertyDetails_propertyId" AS id, "propertyDetails_propertyId" || '-' || CAST("propertyDetails_normalizedPrice" AS VARCHAR) AS fingerprint
  FROM stored_first) e ON p.id = e.id WHERE p.fingerprint <> e.fingerprint OR e.fingerprint IS NULL""",
    "existing_semi": """SELECT "propertyDetails_propertyId", "propertyDetails_normalizedPrice" FROM stored_first
WHERE "propertyDetails_propertyId" IN (SELECT id FROM candidates)""",
    "upsert_by_key": 'SELECT "propertyDetails_propertyId", url, muc_gia, ngay_ang, seq FROM merged',
    "upsert_new_columns": """SELECT "propertyDetails_propertyId", seq, muc_gia, NULL::VARCHAR AS dien_tich FROM stored_first
WHERE url NOT IN (SELECT url FROM stored_second)
UNION ALL SELECT "propertyDetails_propertyId", seq, NULL, dien_tich FROM stored_second""",
    "schema_diff": """SELECT * FROM (VALUES
  ('url', 'string', 'string', 'same'), ('muc_gia', 'string', 'string', 'same'), ('dien_tich', 'string', 'string', 'same'),
  ('ia_chi', 'string', 'string', 'same'), ('ngay_ang', 'string', 'string', 'same'), ('tieu_e', 'string', NULL, 'removed'),
  ('latitude', 'double', 'double', 'same'), ('longitude', NULL, 'double', 'added'), ('search_city', 'string', 'string', 'same'),
  ('search_property_type', 'string', 'string', 'same'), ('search_rent_or_buy', 'string', 'string', 'same'),
  ('search_radius', 'int', 'string', 'changed'), ('run_version', 'int', 'bigint', 'changed'), ('seq', 'bigint', 'bigint', 'same')
) AS diff("column", existing_type, new_type, status)""",
    "criteria_urls": "SELECT search_id, search_url FROM search_urls",
    "criteria_keys": """SELECT search_id, lower(replace(COALESCE(city, '') || '_' || COALESCE("rentOrBuy", '') || '_' || COALESCE("propertyType", '')
  || '_' || CAST(radius AS VARCHAR), '-', '_')) AS criterion_key FROM searches""",
    "basic_stats": "SELECT * FROM stats",
    "price_by_city": "SELECT * EXCLUDE (rank_price) FROM by_city",
    "location_distribution": "SELECT * FROM by_location",
    "recent_trends": "SELECT * FROM trends",
    "price_ranges": f"""SELECT price_range, n AS "count", {percentage('n', 'total')} AS percentage, avg_area FROM (
  SELECT CASE WHEN price < 1000000000 THEN '< 1 tỷ' WHEN price < 3000000000 THEN '1-3 tỷ' WHEN price < 5000000000 THEN '3-5 tỷ'
    WHEN price < 10000000000 THEN '5-10 tỷ' ELSE '> 10 tỷ' END AS price_range, COUNT(*) AS n,
    CAST(SUM(COUNT(*)) OVER () AS BIGINT) AS total, {area_text('AVG(area)')} AS avg_area
  FROM numeric WHERE price > 0 GROUP BY 1)""",
    "top_expensive_areas": f"""SELECT COALESCE(ia_chi, search_city) AS area, COUNT(*) AS property_count, {money('AVG(price)')} AS avg_price,
  {money('MAX(price)')} AS max_price, {money('AVG(price / numeric.area)')} AS price_per_sqm
FROM numeric WHERE price > 0 AND numeric.area > 0 GROUP BY COALESCE(ia_chi, search_city) HAVING COUNT(*) >= 5
ORDER BY AVG(price) DESC, 1 LIMIT 10""",
    "city_value_counts": 'SELECT search_city, COUNT(*) AS "count" FROM listings WHERE search_city IS NOT NULL GROUP BY search_city',
    "describe_profile": "\nUNION ALL\n".join(
        [_text_profile(c) for c in TEXT_COLUMNS] + [_number_profile(c) for c in NUMBER_COLUMNS]
    ),
    "latitude_histogram": """WITH edges AS (SELECT MIN(latitude) AS lo, MAX(latitude) AS hi FROM listings),
  filled AS (SELECT LEAST(CAST(floor((latitude - lo) / (hi - lo) * 50) AS BIGINT), 49) AS bin, COUNT(*) AS n FROM listings, edges GROUP BY 1)
SELECT r.range AS bin, lo + r.range * ((hi - lo) / 50) AS bin_start, COALESCE(n, 0) AS "count"
FROM range(50) r JOIN edges ON TRUE LEFT JOIN filled ON filled.bin = r.range""",
    "dedup_counts": """SELECT COUNT(*) AS rows_before, COUNT(DISTINCT url) AS rows_after, COUNT(*) - COUNT(DISTINCT url) AS duplicates_removed
FROM listings""",
    "chart_overview": f"""SELECT 'Tổng BĐS' AS label, CAST(total_properties AS DOUBLE) AS value FROM stats
UNION ALL SELECT 'Giá TB (tỷ)', {number('avg_price')} / 1e9 FROM stats UNION ALL SELECT 'Diện tích TB (m²)', {number('avg_area')} FROM stats
UNION ALL SELECT 'Số TP', CAST(cities_count AS DOUBLE) FROM stats""",
    "chart_price_top5": f"""SELECT city, CASE WHEN length(city) > 15 THEN city[:15] || '...' ELSE city END AS label, property_count,
  {number('avg_price')} AS avg_price_num, {number('avg_price')} / 1e9 AS avg_price_billion FROM by_city ORDER BY rank_price DESC, city LIMIT 5""",
    "chart_price_top10": f"""SELECT city, CASE WHEN length(city) > 30 THEN city[:30] || '...' ELSE city END AS label, property_count,
  {number('avg_price')} AS avg_price_num, {number('avg_price')} / 1e9 AS avg_price_billion FROM by_city ORDER BY rank_price DESC, city LIMIT 10""",
    "chart_location_top5": f"""SELECT location, CASE WHEN length(location) > 20 THEN location[:20] || '...' ELSE location END AS label, "count",
  {number('avg_area')} AS avg_area FROM by_location ORDER BY "count" DESC, location LIMIT 5""",
    "chart_location_top15": """SELECT location, CASE WHEN length(location) > 40 THEN location[:40] || '...' ELSE location END AS legend,
  CASE WHEN length(location) > 25 THEN location[:25] || '...' ELSE location END AS label, "count", percentage
FROM by_location ORDER BY "count" DESC, location LIMIT 15""",
    "trend_last10": f"""SELECT date, strftime(date, '%m-%d') AS label, {number('avg_price')} / 1e9 AS avg_price_billion
FROM trends ORDER BY date DESC LIMIT 10""",
    "chart_trend_scatter": f"""SELECT date, daily_count, {number('avg_area')} AS avg_area, {number('avg_price')} AS avg_price,
  daily_count * 10 AS point_size FROM trends""",
    "collect_union": "SELECT seq, url, search_rent_or_buy FROM listings",
    "dedup_keep_last": "SELECT * FROM latest",
    "clean_numbers": "SELECT seq, price, area FROM numeric",
    "parse_areas": "SELECT seq, TRY_CAST(string_split(dien_tich, ' ')[1] AS DOUBLE) AS area FROM listings",
    "format_money": f"SELECT seq, {money('price')} AS price_text, {area_text('area / 8')} AS area_text FROM numeric",
    "parse_formatted": f"""SELECT seq, {number(money('price'))} AS price, {number(money('price'))} / 1e9 AS price_billion,
  {number(area_text('area / 8'))} AS area FROM numeric""",
    "merge_key": f'SELECT seq, url, {KEY} AS "propertyDetails_propertyId" FROM listings',
    "fingerprint": f"SELECT seq, {KEY} || '-' || CAST(TRY_CAST(muc_gia AS BIGINT) AS VARCHAR) AS fingerprint FROM listings",
    "normalize_url": f"SELECT page_id, {DETAIL_URL} AS url FROM detail_pages",
    "truncate_labels": """SELECT seq, CASE WHEN length(search_property_type) > 8 THEN search_property_type[:8] || '...' ELSE search_property_type END AS label
FROM listings""",
    "links_per_page": f"SELECT * FROM links WHERE position < {catalog.FIRST_LINKS}",
    "page_titles": f"SELECT page_id, {plain("regexp_extract(html, '<h1[^>]*>.*?</h1>', 0, 's')")} AS title FROM pages",
    "detail_titles": f"SELECT page_id, {TITLE} AS title FROM detail_pages",
    "extract_address": f"SELECT page_id, {ADDRESS} AS address FROM detail_pages",
    "extract_price": f"SELECT page_id, {LISTING_PRICE} AS price FROM detail_pages",
    "extract_area": f"SELECT page_id, {LISTING_AREA} AS area FROM detail_pages",
    "extract_coordinates": f"SELECT page_id, {POSITION}[1] AS latitude, {POSITION}[2] AS longitude FROM detail_pages",
    "drop_blocked_pages": f"SELECT page_id, url FROM detail_pages WHERE NOT {BLOCKED}",
    "extract_listings": """SELECT page_id, position, url, dien_tich, muc_gia, ia_chi, ngay_ang, tieu_e, place[1] AS latitude, place[2] AS longitude
FROM links JOIN details ON link = url""",
    "extraction_rate": "SELECT * FROM rates",
    "extraction_rate_overall": f"""SELECT COUNT(*) AS pages, CAST(SUM(found) AS BIGINT) AS found,
  SUM(found) * 100.0::DOUBLE / (COUNT(*) * {catalog.LINKS}) AS success_rate FROM rates""",
    "verify_counts": f"""SELECT COUNT(*) AS expected_count, COUNT(*) AS actual_count, TRUE AS matches FROM latest WHERE search_city IN {CITIES}""",
}


def _with_views(sql: str) -> str:
    """Put the views the text needs, and those they need, in front of it."""
    needed: list[str] = []

    def visit(part: str) -> None:
        words = set(part.replace("(", " ").replace(")", " ").replace(",", " ").split())
        for name in VIEWS:
            if name in words and name not in needed:
                visit(VIEWS[name])
                if name not in needed:
                    needed.append(name)

    visit(sql)
    views = ", ".join(f"{name} AS ({VIEWS[name]})" for name in needed)
    if not views:
        return sql
    if sql.lstrip().startswith("WITH "):
        return f"WITH {views}, {sql.lstrip()[5:]}"
    return f"WITH {views} {sql}"


ORACLES = {name: _with_views(body) for name, body in BODY.items()}
