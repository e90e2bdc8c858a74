import gzip
import json

import pytest
from pyspark.sql import SparkSession

from hearthlake import session
from hearthlake.operators import nested
from hearthlake.sources import files, serving, snapshots


def test_shared_folder_comes_from_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = session.shared_folder(spark), session.shared_folder(spark)
    assert first.startswith(root) and second.startswith(root) and first != second


def test_json_folder_reads_plain_and_gzip(spark, tmp_path):
    record = {"id": "1", "odd name;x": 2, "listing": {"prices": {"rent": {"price": 7}}}, "tags": ["a"]}
    (tmp_path / "a.json").write_text(json.dumps(record) + "\n")
    with gzip.open(tmp_path / "b.json.gz", "wt") as file:
        file.write(json.dumps(record | {"id": "2"}) + "\n")
    frame = files.read_json_folder(spark, str(tmp_path))
    assert sorted(r.id for r in frame.collect()) == ["1", "2"]
    assert "oddnamex" in frame.columns
    flat = nested.flatten_records(frame)
    assert sorted((r.id, r.propertyDetails_normalizedPrice, r.tags) for r in flat.collect()) == [
        ("1", 7, '["a"]'), ("2", 7, '["a"]'),
    ]


def test_json_folder_with_a_schema(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"a": 1, "b": 2}\n')
    assert files.read_json_folder(spark, str(tmp_path), "a long, c string").first() == (1, None)


@pytest.mark.parametrize(("document", "expected"), [({"a": 1}, [1]), ([{"a": 1}, {"a": 2}], [1, 2])])
def test_json_document_is_an_object_or_a_list(spark, tmp_path, document, expected):
    path = tmp_path / "doc.json.gz"
    with gzip.open(path, "wt") as file:
        json.dump(document, file, indent=2)
    assert [r.a for r in files.read_json_documents(spark, str(path)).collect()] == expected


def test_write_json_gzip(spark, tmp_path):
    folder = tmp_path / "out"
    files.write_json_gzip(spark.range(3), str(folder))
    written = [line for f in folder.glob("*.json.gz") for line in gzip.open(f, "rt")]
    assert sorted(json.loads(line)["id"] for line in written) == [0, 1, 2]


def test_parquet_union_of_nested_folders(spark, tmp_path):
    spark.createDataFrame([(1, "a")], "n int, s string").write.parquet(str(tmp_path / "x"))
    spark.createDataFrame([(2, 2.5)], "n int, d double").write.parquet(str(tmp_path / "y" / "version=1"))
    got = files.read_parquet_union(spark, str(tmp_path)).select("n", "s", "d").orderBy("n").collect()
    assert [tuple(r) for r in got] == [(1, "a", None), (2, None, 2.5)]
    known = files.read_parquet_union(spark, str(tmp_path), "s string, n int").orderBy("n")
    assert [tuple(r) for r in known.collect()] == [("a", 1), (None, 2)]


def test_object_path():
    assert files.object_path("lake", "/bronze/property") == files.object_path("lake", "bronze/property")


def test_snapshots(spark, tmp_path):
    root = str(tmp_path / "table")
    assert snapshots.read_current(spark, root) is None
    assert snapshots.history(spark, root).count() == 0
    assert snapshots.write_snapshot(spark.range(2), root, "CREATE") == 0
    wider = spark.range(3).selectExpr("id", "'x' AS propertyDetails_images", "id * 2 AS twice")
    assert snapshots.write_snapshot(wider, root, "OVERWRITE") == 1
    log = snapshots.history(spark, root).orderBy("version").collect()
    assert [(r.version, r.operation) for r in log] == [(0, "CREATE"), (1, "OVERWRITE")]
    assert all(r.timestamp is not None for r in log)
    current = snapshots.read_current(spark, root)
    assert current.columns == ["id", "twice"] and current.count() == 3
    assert snapshots.read_version(spark, root, 0).count() == 2


def test_unfinished_snapshot_is_invisible_and_replaced(spark, tmp_path):
    root = str(tmp_path / "table")
    snapshots.write_snapshot(spark.range(2), root)
    spark.range(9).write.parquet(f"{root}/version=1")
    assert snapshots.read_current(spark, root).count() == 2
    assert snapshots.write_snapshot(spark.range(4), root) == 1
    assert snapshots.read_current(spark, root).count() == 4


def test_serving_rows(spark):
    raw = spark.createDataFrame(
        [("u", 1, "hanoi", "a"), ("u", 2, "hanoi", "b"), ("v", 1, "hue", "c")],
        "url string, seq int, search_city string, `Mức giá` string",
    )
    rows = serving.serving_rows(raw, ["seq"], "hanoi", "url")
    assert rows.columns == ["url", "seq", "search_city", "muc_gia"]
    assert [r.muc_gia for r in rows.collect()] == ["b"]
    assert serving.serving_rows(raw).count() == 3


def test_publish_table_replaces(spark):
    for size in (3, 2):
        serving.publish_table(spark.range(size), "published_numbers")
        assert spark.table("published_numbers").count() == size
    spark.sql("DROP TABLE published_numbers")


def test_jdbc_url():
    assert serving.jdbc_url("db.test", 5432, "market") == "jdbc:postgresql://db.test:5432/market"


def test_session_fixture_is_local(spark):
    assert isinstance(spark, SparkSession) and spark.conf.get("spark.master").startswith("local")
