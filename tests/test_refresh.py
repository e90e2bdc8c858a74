"""The whole job on two small crawls."""

import pytest
from pyspark.sql import functions as F

from hearthlake.functions.keys import MERGE_KEY, with_merge_key
from hearthlake.operators import criteria
from hearthlake.plans import refresh
from hearthlake.sources import snapshots

SITE = "https://nhadat247.com.vn"
HANOI = f"{SITE}/mua-ban-nha-dat-ha-noi-xc1-ci38.html"


@pytest.mark.parametrize(
    ("criterion", "url"),
    [
        (("hanoi", "can-ho-chung-cu", "buy"), HANOI),
        (("Ho Chi Minh", "house", "rent"), f"{SITE}/cho-thue-nha-dat-tp-hcm-xc79-ci40.html"),
        (("Đà Nẵng", "castle", "swap"), f"{SITE}/mua-ban-nha-dat-da-nang-xc48-ci38.html"),
        (("Gia Lâm", "plot", "buy"), f"{SITE}/mua-ban-nha-dat-gia-lam-xc8-ci42.html"),
        (("tuyen-quang", "plot", "buy"), f"{SITE}/mua-ban-nha-dat-tuyen-quang-xc8-ci42.html"),
        (("Bắc Giang", "flat", "buy"), f"{SITE}/mua-ban-nha-dat-ci38.html"),
        (("Atlantis", "plot", "rent"), f"{SITE}/cho-thue-nha-dat-ci42.html"),
        ((None, None, None), f"{SITE}/mua-ban-nha-dat-ci38.html"),
    ],
)
def test_search_url(spark, criterion, url):
    given = dict(zip(("city", "propertyType", "rentOrBuy"), criterion))
    frame = criteria.with_search_url(criteria.criteria_frame(spark, [given]))
    assert frame.first().search_url == url


def test_city_codes():
    codes = criteria.CITY_CODES
    assert len(codes) == 129 and len(set(codes.values())) == 63
    assert codes["thừa-thiên-huế"] == codes["thua-thien-hue"] == "thua-thien-hue-xc46"


def test_criteria_keep_rows_and_columns(spark):
    rows = [{"city": c, "propertyType": "x", "rentOrBuy": "buy", "radius": 1} for c in ("a", "a", None)]
    frame = criteria.with_criterion_key(criteria.with_search_url(criteria.criteria_frame(spark, rows)))
    assert frame.columns == ["city", "propertyType", "rentOrBuy", "radius", "search_url", "criterion_key"]
    assert sorted(r.criterion_key for r in frame.collect()) == ["_buy_x_1", "a_buy_x_1", "a_buy_x_1"]


def page(price, title):
    return f'<h1>{title}</h1><input class="js-gia-bds" value="{price}"><p>Diện tích: 50 m²</p>'


def test_two_crawls(spark, tmp_path):
    wanted = criteria.criteria_frame(
        spark,
        [
            {"city": "hanoi", "propertyType": "can-ho-chung-cu", "rentOrBuy": "buy", "radius": 0},
            {"city": "hue", "propertyType": "plot", "rentOrBuy": "rent", "radius": 0},
        ],
    )
    results = spark.createDataFrame(
        [
            (1, HANOI, '<a href="/a-pid1">a</a><a href="/b-pid2">b</a><a href="/a-pid1">a</a>'),
            (2, "/cho-thue-nha-dat-ci42.html", '<a href="/c-pid3">c</a>'),
            (3, "/never-asked.html", '<a href="/d-pid4">d</a>'),
        ],
        "page_id int, url string, html string",
    )
    details = [("/a-pid1", page("100", "A")), ("/b-pid2", page("200", "B")), ("/c-pid3", page("300", "C")), ("/d-pid4", "")]
    first = spark.createDataFrame(details, "url string, html string")
    bronze, serving = str(tmp_path / "bronze"), str(tmp_path / "serving")

    published = refresh.refresh(wanted, results, first, bronze, serving, "2024-01-01")
    assert published.columns == [
        "url", "dien_tich", "muc_gia", "ia_chi", "ngay_ang", "tieu_e", "latitude", "longitude",
        "search_city", "search_property_type", "search_rent_or_buy", "search_radius", "propertydetails_propertyid",
    ]
    got = sorted((r.tieu_e, r.muc_gia, r.dien_tich, r.search_city, r.ngay_ang) for r in published.collect())
    assert got == [
        ("A", "100", "50 m²", "hanoi", "2024-01-01"),
        ("B", "200", "50 m²", "hanoi", "2024-01-01"),
        ("C", "300", "50 m²", "hue", "2024-01-01"),
    ]

    later = spark.createDataFrame([("/a-pid1", page("150", "A2"))], "url string, html string")
    published = refresh.refresh(wanted, results, later, bronze, serving, "2024-02-02", cities="hanoi")
    got = sorted((r.tieu_e, r.muc_gia, r.ngay_ang) for r in published.collect())
    assert got == [("A2", "150", "2024-02-02"), ("B", "200", "2024-01-01")]
    log = snapshots.history(spark, bronze).orderBy("version").collect()
    assert [(r.version, r.operation) for r in log] == [(0, "CREATE"), (1, "MERGE")]
    assert snapshots.read_current(spark, bronze).count() == 3


def test_merge_refuses_a_changed_type_and_ignores_an_empty_crawl(spark, tmp_path):
    root = str(tmp_path / "bronze")
    rows = spark.createDataFrame([("u", 1, "a")], "url string, seq int, v string")
    assert refresh.merge_listings(rows, root, ["seq"]) == 0
    assert refresh.merge_listings(rows.filter("false"), root, ["seq"]) == 0
    with pytest.raises(ValueError, match="v"):
        refresh.merge_listings(rows.withColumn("v", rows.seq), root, ["seq"])
    wider = spark.createDataFrame([("w", 1, 2)], "url string, seq int, extra int")
    assert refresh.merge_listings(wider, root, ["seq"]) == 1
    stored = snapshots.read_current(spark, root)
    assert sorted(((r.url, r.v, r.extra) for r in stored.collect()), key=str) == [("u", "a", None), ("w", None, 2)]


def test_merge_and_publish_keep_all_columns_and_widen_numbers(spark, tmp_path):
    root, serving = f"{tmp_path}/bronze", f"{tmp_path}/serving"
    first = spark.createDataFrame([("a", "1", 1, "x"), ("b", "2", 1, "y")], "url string, `Mức giá` string, seq int, propertyDetails_images string")
    later = spark.createDataFrame([("b", "3", 2)], "url string, `Mức giá` string, seq bigint")
    refresh.merge_listings(first, root, ["seq"])
    refresh.merge_listings(later, root, ["seq"])
    published = refresh.publish(spark, root, serving)
    assert {(r.url, r.seq, r.propertydetails_images) for r in published.collect()} == {("a", 1, "x"), ("b", 2, None)}
    assert published.schema["seq"].dataType.simpleString() == "bigint"


def test_merge_touches_only_the_buckets_of_new_keys(spark, tmp_path):
    """A crawl that hits one bucket reads and writes that bucket; the files of the others stay where they are."""
    root = str(tmp_path / "table")
    first = spark.range(500).select(F.concat(F.lit("u"), "id").alias("url"), F.lit("1").alias("muc_gia"), F.col("id").alias("seq"))
    refresh.merge_listings(first, root, ["seq"])
    later = first.where("seq in (3)").withColumn("muc_gia", F.lit("2"))
    key = with_merge_key(later).first()[MERGE_KEY]
    refresh.merge_listings(later, root, ["seq"])
    hit = snapshots.buckets_of(with_merge_key(later), MERGE_KEY, snapshots.BUCKETS)
    assert [p.name for p in (tmp_path / "table" / "version=1").glob("_bucket=*")] == [f"_bucket={hit[0]}"]
    live, buckets = snapshots.live_buckets(spark, root, 1)
    assert {b for b, version in live.items() if version == 1} == set(hit) and len(live) == buckets == snapshots.BUCKETS
    assert len(snapshots.read_buckets(spark, root, live, hit).inputFiles()) == 1
    rows = {r.url: r.muc_gia for r in snapshots.read_current(spark, root).collect()}
    assert len(rows) == 500 and rows["u3"] == "2" and sum(p == "2" for p in rows.values()) == 1
    assert snapshots.read_version(spark, root, 0).where("muc_gia = '2'").count() == 0
    # A column that comes is a table written anew, in which no old bucket lives on.
    refresh.merge_listings(later.withColumn("more", F.lit(1)), root, ["seq"])
    assert set(snapshots.live_buckets(spark, root, 2)[0].values()) == {2}
    assert snapshots.read_current(spark, root).where("more IS NULL").count() == 499
    assert snapshots.read_current(spark, root).where(F.col(MERGE_KEY) == key).count() == 1
