import hashlib
import html

import pytest
from pyspark.sql import functions as F

from hearthlake.functions import keys, numbers, text


def values(spark, inputs, build, kind="string"):
    """Apply a column function to each input, in order."""
    frame = spark.createDataFrame(list(enumerate(inputs)), f"i int, x {kind}")
    return [row.y for row in frame.select("i", build(F.col("x")).alias("y")).orderBy("i").collect()]


def test_clean_number_keeps_digits_and_dots(spark):
    given = ["3500000001", "80 m²", "80 m2", "80,5 m²", "Thỏa thuận", "", None, "1.5.2", ".", "5."]
    expected = [3500000001.0, 80.0, 802.0, 805.0, None, None, None, None, None, 5.0]
    assert values(spark, given, numbers.clean_number) == expected


def test_parse_area_knows_the_unit_and_the_comma(spark):
    given = ["80 m2", "80,5 m²", "Rộng 62.5M2 đẹp", "90 m²", "80", None]
    assert values(spark, given, numbers.parse_area) == [80.0, 80.5, 62.5, 90.0, None, None]


def test_format_money_rounds_halves_to_even(spark):
    given = [2.5, 3.5, 1234567.0, 0.2, 3500000001.0, None]
    expected = ["2", "4", "1,234,567", "0", "3,500,000,001", None]
    assert values(spark, given, numbers.format_money, "double") == expected


def test_format_area_drops_zeros_but_keeps_the_point(spark):
    given = [80.0, 80.5, 0.5, 0.0, 1234.567, 100.0, None]
    expected = ["80.", "80.5", ".5", "0.", "1,234.57", "100.", None]
    assert values(spark, given, numbers.format_area, "double") == expected


def test_formatted_text_parses_back(spark):
    assert values(spark, ["1,234,568", "80.", ".5", "n/a", None], numbers.parse_formatted) == [
        1234568.0, 80.0, 0.5, None, None,
    ]
    billions = values(spark, ["7,523,162,306"], lambda c: numbers.in_billions(numbers.parse_formatted(c)))
    assert billions == [7.523162306]


def test_strip_removes_what_python_strips(spark):
    given = ["  a b \n", "\t\x1f x　", "", " \r\n", None]
    assert values(spark, given, text.strip) == [s.strip() if s is not None else None for s in given]


def test_truncate_label(spark):
    given = ["Hà Nội", "Thừa Thiên Huế", "", None]
    assert values(spark, given, lambda c: text.truncate_label(c, 6)) == ["Hà Nội", "Thừa T...", "", None]


def test_normalize_url(spark):
    given = ["/a-pid1", "a", " https://x/y ", "//h/x", "", "  ", "http://z", None]
    site = "https://nhadat247.com.vn"
    expected = [f"{site}/a-pid1", f"{site}/a", "https://x/y", "https://h/x", "", f"{site}/", "http://z", None]
    assert values(spark, given, text.normalize_url) == expected


def test_unescape_agrees_with_the_standard_library(spark):
    given = [
        "a &amp; b", "&lt;b&gt;", "&#7927;&#x1EF7;", "&eacute;&nbsp;x", "&bogus; &", "no entity",
        "&amp;amp;", "&#x1F600;", "&apos;&lsqb;&NotEqualTilde;&#150;&#x80;&#129;", "&Agrave;&acirc;", "", "&&amp;&",
    ]
    assert values(spark, given, text.unescape) == [html.unescape(s) for s in given]
    assert values(spark, ["&#xD800;", "&#0;"], text.unescape) == ["�", "�"]


def test_text_of_strips_every_run(spark):
    given = ["<h1> A <b>&amp; B</b>\n&nbsp;</h1>", "<p></p>", "plain", None, "<i>a b</i> <i>c</i>"]
    assert values(spark, given, text.text_of) == ["A& B", "", "plain", None, "a bc"]
    assert values(spark, ["<p>Diện tích: <b>80</b> m²</p>"], text.raw_text_of) == ["Diện tích: 80 m²"]


def test_month_day(spark):
    assert values(spark, ["2024-02-09"], lambda c: text.month_day(c.cast("date"))) == ["02-09"]


def test_merge_key_sources(spark):
    urls = spark.createDataFrame([("https://x",), (None,)], "url string")
    got = [r[keys.MERGE_KEY] for r in keys.with_merge_key(urls).collect()]
    assert got == [hashlib.md5(u).hexdigest()[:16] for u in (b"https://x", b"None")]
    ids = spark.createDataFrame([(7, "https://x")], "id long, url string")
    assert keys.with_merge_key(ids).first()[keys.MERGE_KEY] == "7"
    keyed = spark.createDataFrame([("k", "https://x")], f"{keys.MERGE_KEY} string, url string")
    assert keys.with_merge_key(keyed).first()[keys.MERGE_KEY] == "k"


def test_fingerprint_is_null_without_price(spark):
    frame = spark.createDataFrame([("a", 100000000), ("a", None), (None, 1)], "k string, p long")
    got = [r[0] for r in frame.select(keys.fingerprint(F.col("k"), F.col("p"))).collect()]
    assert got == ["a-100000000", None, None]


@pytest.mark.parametrize(
    ("criterion", "expected"),
    [
        (("hanoi", "buy", "can-ho-chung-cu", 0), "hanoi_buy_can_ho_chung_cu_0"),
        (("Ho Chi Minh", "rent", "plot", 5), "ho chi minh_rent_plot_5"),
        ((None, "buy", None, None), "_buy__0"),
    ],
)
def test_criterion_key(spark, criterion, expected):
    frame = spark.createDataFrame([criterion], "c string, a string, t string, r int")
    key = keys.criterion_key(F.col("c"), F.col("a"), F.col("t"), F.col("r"))
    assert frame.select(key).first()[0] == expected
