"""Registered queries against their oracle SQL, and the shape of their plans."""

import re

import pytest

import __spark_entry__ as registered
from hearthlake.plans import catalog, oracles
from tests.oracle import connect, differences

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


def plan(frame):
    return frame._sc._jvm.PythonSQLUtils.explainString(frame._jdf.queryExecution(), "formatted")


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(oracles.ORACLES)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_agrees_with_oracle(spark, db, name):
    assert differences(spark, db, name, SF_DIR) == []


def test_entry(spark):
    frame = registered.entry(spark)
    assert frame.columns[0] == "city" and frame.count() > 0


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_cross_join_and_no_python_worker(spark, name):
    text = plan(registered.queries()[name](spark, SF_DIR))
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|ArrowEval|BatchEvalPython|MapInPandas", text)


def test_reports_read_only_the_columns_they_use(spark):
    text = plan(registered.queries()["price_by_city"](spark, SF_DIR))
    assert re.search(r"ReadSchema: struct<muc_gia:string,dien_tich:string,ia_chi:string>", text)
    assert re.search(r"PushedFilters: \[.*IsNotNull\(ia_chi\).*\]", text)


def test_distribution_cuts_before_its_window(spark):
    text = plan(registered.queries()["location_distribution"](spark, SF_DIR)).split("\n\n")[0]
    window, cut = text.index("Window"), text.index("TakeOrderedAndProject", text.index("Window"))
    assert window < cut and text.count("Scan parquet") == 1


@pytest.mark.parametrize("name", ["dedup_keep_last", "changed_or_new", "upsert_by_key"])
def test_every_key_is_limited_before_the_shuffle(spark, name):
    text = plan(registered.queries()[name](spark, SF_DIR)).split("\n\n")[0]
    assert text.count("WindowGroupLimit (") == 2 * len(re.findall(r"\bWindow \(", text)) > 0
