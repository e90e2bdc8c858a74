import pytest

from hearthlake.operators import columns, nested


def test_sanitize_name():
    given = ["Mức giá", "Diện tích", "Địa chỉ", "Ngày đăng", "Tiêu đề", "a--b__c", "_x_", "đđ", "", "URL 2"]
    assert [columns.sanitize_name(n) for n in given] == [
        "muc_gia", "dien_tich", "ia_chi", "ngay_ang", "tieu_e", "a_b_c", "x", "column", "column", "url_2",
    ]


def test_parquet_safe_name():
    assert columns.parquet_safe_name("odd name;{x}(y)=z\t,\n.w") == "oddnamexyz_w"


def test_renaming_refuses_clashes(spark):
    frame = spark.createDataFrame([(1, 2)], "`Giá` int, gia int")
    with pytest.raises(ValueError, match="gia"):
        columns.sanitize_columns(frame)


def test_prefix_and_canonicalize(spark):
    frame = spark.createDataFrame([(1, 2)], "A int, b int")
    assert columns.prefix_columns(frame, "p_").columns == ["p_A", "p_b"]
    assert columns.canonicalize_columns(frame).columns == ["a", "b"]


def test_replace_values(spark):
    frame = spark.createDataFrame([("x", "y", 1), ("z", "x", 2)], "a string, b string, n int")
    assert [tuple(r) for r in columns.replace_values(frame, "x", "w").collect()] == [("w", "y", 1), ("z", "w", 2)]


def test_conform_adds_and_orders_columns(spark):
    frame = spark.createDataFrame([(5, "t", "u")], "extra int, `Tiêu đề` string, url string")
    got = columns.conform(frame)
    assert got.schema.names == columns.LISTING_SCHEMA.names
    assert [f.dataType for f in got.schema] == [f.dataType for f in columns.LISTING_SCHEMA]
    assert tuple(got.first()) == ("u", None, None, None, None, "t", None, None)


def test_empty_listings(spark):
    empty = columns.empty_listings(spark)
    assert empty.isEmpty() and empty.schema == columns.LISTING_SCHEMA


def test_attach_lineage(spark):
    frame = columns.attach_lineage(spark.range(1), "hanoi", "plot", "rent", 3)
    assert tuple(frame.first()) == (0, "hanoi", "plot", "rent", 3)


def test_filter_city(spark):
    frame = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "search_city string, n int")
    assert [r.n for r in columns.filter_city(frame, "a").collect()] == [1]
    assert [r.n for r in columns.filter_city(frame, ["a", "c"]).collect()] == [1, 3]
    assert columns.filter_city(frame, None).count() == 3
    assert columns.filter_city(frame, "").count() == 3
    assert columns.filter_city(frame.drop("search_city"), "a").count() == 3


def test_lookup_sample_and_emit(spark):
    frame = spark.createDataFrame([("k", 1, 2), ("l", 3, 4)], "id string, a int, `b c` int")
    assert [tuple(r) for r in columns.lookup(frame, "id", "l", ["a", "b c"]).collect()] == [(3, 4)]
    assert columns.sample_one(frame, "id", 7).first().id in {"k", "l"}
    assert columns.sample_one(frame, "id", 7).collect() == columns.sample_one(frame, "id", 7).collect()
    assert columns.emit_if(frame, True).count() == 2
    assert columns.emit_if(frame, False).count() == 0


def test_flatten_records(spark):
    schema = (
        "id string, listing struct<prices:struct<buy:struct<price:int>>>, "
        "propertyDetails struct<images:array<string>,pdfs:array<string>>, FactId string, `odd name;x` int"
    )
    record = ("1", (((5,),),), (["a", "b"], None), "f", 2)
    flat = nested.flatten_records(spark.createDataFrame([record], schema))
    assert flat.columns == [
        "id", "propertyDetails_normalizedPrice", "propertyDetails_images", "propertyDetails_pdfs", "oddnamex",
    ]
    assert tuple(flat.first()) == ("1", 5, '["a","b"]', None, 2)


@pytest.mark.parametrize("both", [True, False])
def test_unify_price_prefers_buy(spark, both):
    schema = "listing_prices_rent_price int" + (", listing_prices_buy_price int" if both else "")
    frame = nested.unify_price(spark.createDataFrame([(1, 2) if both else (1,)], schema))
    assert frame.first()["propertyDetails_normalizedPrice"] == (2 if both else 1)
    assert ("listing_prices_rent_price" in frame.columns) == both


def test_flatten_refuses_clashing_names(spark):
    frame = spark.createDataFrame([((1,), 2)], "a struct<b:int>, a_b int")
    with pytest.raises(ValueError, match="a_b"):
        nested.flatten_records(frame)


def test_drop_bulky_ignores_missing(spark):
    frame = spark.createDataFrame([(1, "x")], "id int, propertyDetails_images string")
    assert nested.drop_bulky(frame).columns == ["id"]


def test_is_json(spark):
    cases = {
        '{"a":1}': True, "1": True, "null": True, '"a"': True, "[]": True, ' {"a": [1, 2]} ': True,
        "": False, "[1,2": False, '{"a":1}x': False, "{'a':1}": False, "01": False, "1]": False,
        "1}": False, "1,2": False, '{"a":1,"a":2}': True, "1],[2": False, '{"a":1} {"b":2}': False,
    }
    frame = spark.createDataFrame([(k,) for k in cases], "t string")
    got = {r.t: r.ok for r in frame.select("t", nested.is_json(frame.t).alias("ok")).collect()}
    assert got == cases
