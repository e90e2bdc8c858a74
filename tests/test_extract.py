"""Extraction from pages. The accepted markup is stated by the cases."""

import itertools
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from hearthlake.functions.text import elements, normalize_url, running_sum
from hearthlake.operators import extract, prefilter

SITE = "https://nhadat247.com.vn"


def field(spark, step, name, pages):
    frame = spark.createDataFrame(list(enumerate(pages)), "page_id int, html string")
    rows = step(extract.with_elements(frame)).select("page_id", name).orderBy("page_id").collect()
    return [row[name] for row in rows]


def test_title(spark):
    pages = [
        "<title>T</title><H1 class='x'> A <b>&amp; B</b></H1><h1>second</h1>",
        "<title> only\n title </title>",
        "<!-- <h1>no</h1> --><script>'<h1>no</h1>'</script><h1>yes</h1>",
        "<h1></h1><title>unused</title>",
        "<p>none</p>",
        None,
    ]
    assert field(spark, extract.with_title, "title", pages) == ["A& B", "only\n title", "yes", "", None, None]


def test_address(spark):
    description = '<span class="x re__pr-short-description y">{}</span>'
    pages = [
        description.format(" Ward, District , City, more, text "),
        description.format("Ward only"),
        description.format("") + "<span>Quận 1, TP.HCM 2 tầng đẹp</span>",
        "<span>nothing</span><span>Bán đất 2.5 tỷ, Thanh Xuân, Hà Nội</span>",
        "<span>Cần Thơ 80m2 mặt tiền</span>",
        "<span>Đà Nẵng giá 3 tỷ 500</span>",
        "<span>3 tầng Hà Nội</span><span>Hà Nội</span>",
        "<span>nowhere</span>",
        description.format("<span>Ward</span>, <b>District</b>, City, text"),
        "<span><span>x</span> Hà Nội <span>y</span></span><span>Hà Nội 2</span>",
        description.format("Open <span>never closed"),
    ]
    assert field(spark, extract.with_address, "address", pages) == [
        "Ward, District , City", "Ward only", "Quận 1, TP.HCM", "Thanh Xuân, Hà Nội", "Cần Thơ",
        "Đà Nẵng giá", "Hà Nội", None, "Ward,District, City", "xHà Nộiy", "Open" + "never closed",
    ]


def test_price(spark):
    pages = [
        '<input class="js-gia-bds" value="3.500 VND">',
        "<input value='12 000' type=text class='a js-gia-bds b'/>",
        '<input class="js-gia-bds" value="n/a"><p>THỎA THUẬN</p>',
        '<input class="js-gia-bds" value=" n/a ">',
        '<input class="js-gia-bds" value=""><p>Thỏa thuận</p>',
        '<input class="js-gia-bds-2" value="5">',
        '<input class="js-gia-bds">',
        "<p>Thỏa thuận</p>",
    ]
    assert field(spark, extract.with_price, "price", pages) == [
        "3500", "12000", "Thỏa thuận", "n/a", None, None, None, None,
    ]


def test_area(spark):
    item = '<div class="re__pr-short-info-item"><span>{}</span><span class="value">{}</span></div>'
    pages = [
        item.format("Giá", "5 tỷ") + item.format("Diện tích", " 80 m² ") + "<p>70 m²</p>",
        item.format("Giá", "5 tỷ") + "<p>Diện tích: <b>62.5</b> m²</p><p>70 m2</p>",
        "<p>DIỆN TÍCH 55&nbsp;M2</p>",
        "<p>Diện tích lớn</p><p>45mét</p>",
        "<p>30 vuông</p>",
        "<p>12 ha</p>",
        '<p>70 m2</p><div class="re__pr-short-info-item"><div class="icon"></div>' + item[item.index("<span>"):].format("Diện tích", "80 m²"),
        "<p>Giá 70 m2</p><p><b>x</b> Diện tích<br> 50 m²</p><p>60 m2</p>",
        "<p>70 m2</p><div><p>80 m2</p>Diện tích</div>",
    ]
    assert field(spark, extract.with_area, "area", pages) == [
        "80 m²", "62.5 m²", "55\xa0M2", "45mét", "30 vuông", None, "80 m²", "50 m²", "80 m2",
    ]


def test_links_keep_page_order_and_the_first_k(spark):
    page = (
        '<a href="/x-pid1">1</a><a class=k href = \'b-pid2\'>2</a><!-- <a href="/no-pid0"> -->'
        '<A HREF=/c-pid3>3</A><a href="/about">no</a><a href="//h/d-pid4?a=1&amp;b=2">4</a><a href="/x-pid1">5</a>'
    )
    blocked = "<p>Checking your browser</p>" + page
    frame = spark.createDataFrame([(1, page), (2, blocked), (3, None), (4, "<p></p>")], "page_id int, html string")
    got = [tuple(r) for r in extract.links_per_page(frame, 4).orderBy("position").collect()]
    assert got == [
        (1, 0, f"{SITE}/x-pid1"), (1, 1, f"{SITE}/b-pid2"), (1, 2, f"{SITE}/c-pid3"), (1, 3, "https://h/d-pid4?a=1&b=2"),
    ]
    assert extract.links_per_page(frame, 10).count() == 5
    assert [r.page_id for r in extract.drop_blocked_pages(frame).collect()] == [1, 4]


def position(page):
    """First in-range pair, one way of stating it after the other."""
    pairs = ((float(a), float(b)) for way in extract.COORDINATE_PATTERNS for a, b in re.findall(way, page, re.IGNORECASE))
    for low, high in (sorted(pair) for pair in pairs):
        if 8 <= low <= 24 and 102 <= high <= 110:
            return (low, high)
    return None


def test_coordinates_against_brute_force(spark):
    rng = random.Random(11)
    forms = [
        "place?q={a},{b}", "PLACE?Q={a},{b}", "x {a}, {b} y", '"lat": {a}, "z": 1, "lng": {b}',
        '"lat": {a},\n"lng": {b}', "'latitude': '{a}', 'longitude': '{b}'", '"Latitude":{a};"longitude":{b}',
        "center={a},{b}", "@{a},{b}", "@{a};{b}",
    ]
    pages = []
    for _ in range(300):
        parts = []
        for _ in range(rng.randint(0, 4)):
            a, b = rng.choice([(21.0, 105.0), (10.0, 106.0), (1.5, 2.5), (50.0, 60.0), (8.0, 110.0)])
            digits = rng.choice([1, 3, 6])
            a, b = (round(v + rng.random() / 2, digits) for v in (a, b))
            if rng.random() < 0.5:
                a, b = b, a
            parts.append(rng.choice(forms).format(a=a, b=b))
        pages.append(rng.choice([" ", "\n", "<br>"]).join(parts))
    frame = spark.createDataFrame(list(enumerate(pages)), "page_id int, html string")
    found = frame.select("page_id", extract.coordinates(F.col("html")).alias("at")).orderBy("page_id").collect()
    got = [None if r["at"] is None else tuple(r["at"]) for r in found]
    expected = [position(p) for p in pages]
    assert got == expected
    assert None in expected and len([e for e in expected if e]) > 100


def test_extract_details_has_the_listing_schema(spark):
    frame = spark.createDataFrame(
        [(1, "/a-pid1", '<h1>Nhà</h1>"lat": 10.5, "lng": 106.5'), (2, "/gone", None)],
        "page_id int, url string, html string",
    )
    got = extract.extract_details(frame, "2024-05-06").collect()
    assert [tuple(r) for r in got] == [(f"{SITE}/a-pid1", None, None, None, "2024-05-06", "Nhà", 10.5, 106.5)]


RESULTS = [
    (1, '<a href="/a-pid1">a</a><a href="/b-pid2">b</a><a href="/c-pid3">c</a>'),
    (2, '<a href="/a-pid1">a</a><a href="/gone-pid9">g</a>'),
    (3, '<p>Cloudflare</p><a href="/a-pid1">a</a>'),
    (4, "<p>no links</p>"),
    (5, None),
]
DETAILS = [("/a-pid1", "<h1>A</h1>"), (f"{SITE}/b-pid2", "<h1>B</h1>"), ("/c-pid3", "<h1>C</h1>"), ("/x-pid4", None)]


def stored(spark):
    return (
        spark.createDataFrame(RESULTS, "page_id int, html string"),
        spark.createDataFrame(DETAILS, "url string, html string"),
    )


def test_extract_listings_follows_links(spark):
    results, details = stored(spark)
    got = extract.extract_listings(results, details, "2024-01-01", 2).collect()
    assert sorted((r.page_id, r.position, r.url, r["Tiêu đề"]) for r in got) == [
        (1, 0, f"{SITE}/a-pid1", "A"), (1, 1, f"{SITE}/b-pid2", "B"), (2, 0, f"{SITE}/a-pid1", "A"),
    ]


def test_extraction_rate_counts_every_page(spark):
    results, details = stored(spark)
    rates = extract.extraction_rate(results, details, 2)
    assert sorted(map(tuple, rates.collect())) == [
        (1, 2, 100.0), (2, 1, 50.0), (3, 0, 0.0), (4, 0, 0.0), (5, 0, 0.0),
    ]
    assert tuple(extract.overall_extraction_rate(rates, 2).first()) == (5, 3, 30.0)


def test_extraction_rate_of_nothing(spark):
    results, details = stored(spark)
    none = extract.extraction_rate(results.filter("false"), details, 2)
    assert tuple(extract.overall_extraction_rate(none, 2).first()) == (0, 0, 0.0)


@pytest.mark.parametrize("size", [200_000])
def test_long_pages_are_read_whole(spark, size):
    filler = "<div class='x'><span>" + "y" * 50 + "</span></div>"
    page = filler * (size // len(filler)) + "<h1>End</h1><p>Diện tích: 77 m²</p>@10.5,106.5"
    frame = extract.with_elements(spark.createDataFrame([(1, page)], "page_id int, html string"))
    row = extract.with_area(extract.with_title(frame)).select(
        "title", "area", extract.coordinates(F.col("html")).alias("at")
    ).first()
    assert (row.title, row.area, tuple(row["at"])) == ("End", "77 m²", (10.5, 106.5))


def test_running_sum(spark):
    rows = spark.createDataFrame([([],), ([5],), (list(range(-40, 60)),)], "a array<int>")
    for row in rows.select("a", running_sum(F.col("a")).alias("s")).collect():
        assert row.s == list(itertools.accumulate(row.a))


def balanced_elements(markup):
    """Start tags of spans with what they hold: to the balancing end tag, else the next one, else left out."""
    tags = [(m.start(), m.group()) for m in re.finditer(r"(?i)</?span\b", markup)]
    out = []
    for i, (at, tag) in enumerate(tags):
        if tag[1] == "/" or not re.match(r"(?is)<span\b[^>]*>", markup[at:]):
            continue
        depth, end = 0, None
        for place, other in tags[i:]:
            depth += -1 if other[1] == "/" else 1
            if depth == 0:
                end = place
                break
        if end is None:
            end = next((place for place, other in tags[i:] if other[1] == "/"), None)
        if end is not None:
            out.append(markup[at:end] + re.match("[^>]*>?", markup[end:]).group())
    return out


def test_elements_against_brute_force(spark):
    draw = random.Random(2)
    bits = ["<span>", '<span class="a">', "</span>", "x", "<b>", "</SPAN>", "<spanx>", " y ", "</span >", "é"]
    texts = ["".join(draw.choice(bits) for _ in range(draw.randrange(30))) for _ in range(400)]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, m string")
    found = rows.select("id", elements(F.col("m"), "span", r"(?is)<span\b[^>]*>").alias("e")).collect()
    for row in found:
        assert (row.e or []) == balanced_elements(texts[row.id])


def test_flat_elements_take_one_pattern(spark):
    """Brute force on mostly flat markup with a class; pages without nesting cost well below pages with it."""
    draw = random.Random(5)
    bits = ["<span>", '<span class="a">q</span>', "</span>", "x", "<b>", "<SPAN>", "</span >", "<i>&lt;</i>", "< "]
    texts = ["".join(draw.choices(bits, [1, 9, 1, 9, 9, 1, 1, 5, 2])[0] for _ in range(draw.randrange(20))) for _ in range(400)]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, m string")
    for row in rows.select("id", elements(F.col("m"), "span", r"(?is)<span\b[^>]*>").alias("e")).collect():
        assert (row.e or []) == balanced_elements(texts[row.id])
    seconds = []
    for page in ('<span class="a">x</span>' * 12, "<span>" + '<span class="a">x</span>' * 11 + "</span>"):
        pages = spark.range(0, 96_000, 1, 8).select(F.concat(F.lit(page), F.col("id").cast("string")).alias("m"))
        found = pages.select(F.sum(F.size(elements(F.col("m"), "span", r"(?is)<span\b[^>]*>"))))
        found.collect()
        start = time.time()
        assert found.first()[0] == 96_000 * 12
        seconds.append(time.time() - start)
    assert seconds[0] < seconds[1] / 1.5


def test_long_pages_cost_in_proportion(spark):
    """8,000 spans, nested or in a row, are as good as at once; place by place they took many times as long as 4,000."""
    for page in ("<span>Ward 1</span>" * 8000, "<span>" * 400 + "</span>" * 400 + "<span>x" * 8000):
        pages = spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string")
        start = time.time()
        assert extract.with_address(extract.with_elements(pages)).select("address").first().address is None
        assert time.time() - start < 60


def test_only_possibly_linked_pages_are_read(spark):
    """Half of the pages aren't linked: they pass the bitmap by chance at most, and no page is shuffled."""
    pages = spark.range(2000).select(F.col("id").alias("page_id"), F.concat(F.lit("/tin-pid"), "id").alias("url"), F.lit("<h1>T</h1>").alias("html"))
    links = pages.where("page_id % 2 = 0").select(normalize_url(F.col("url")).alias("url")).unionByName(spark.sql("SELECT CAST(NULL AS STRING) AS url"))
    some = pages.unionByName(spark.createDataFrame([(-1, None, "x")], "page_id long, url string, html string"))
    found = prefilter.with_possible_key(some, normalize_url(F.col("url")), prefilter.key_bitmap(links, "url"))
    ids = {r.page_id for r in found.collect()}
    assert ids >= set(range(0, 2000, 2)) and len(ids) < 1010 and -1 not in ids
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    few = prefilter.with_possible_key(some, normalize_url(F.col("url")), prefilter.key_bitmap(links, "url", 8), 8)
    assert {r.page_id for r in few.collect()} >= set(range(0, 2000, 2))


def test_listings_of_linked_pages_only(spark):
    results = spark.createDataFrame([(1, "r", '<a href="/tin-pid2">x</a><a href="/tin-pid9">x</a>')], "page_id long, url string, html string")
    details = spark.createDataFrame([(i, f"/tin-pid{i}", f"<h1>T{i}</h1>") for i in range(8)], "page_id long, url string, html string")
    assert [r["Tiêu đề"] for r in extract.extract_listings(results, details, "2024-01-01").collect()] == ["T2"]
