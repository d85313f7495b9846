import datetime as dt

from pyspark.sql import functions as F

from ledgerline.operators import history as H
from conftest import rows

D = "2024-01-15"


def _hist(spark):
    return spark.createDataFrame(
        [(1, "A", "X1", dt.date(2024, 1, 15)), (2, "B", None, dt.date(2024, 1, 15)),
         (3, "C", "X2", dt.date(2024, 1, 15)), (4, "D", "X1", dt.date(2024, 1, 14))],
        "id int, v string, country string, createddttm date")


def test_replace_slice_null_key_kept_and_rerun_safe(spark):
    hist = _hist(spark)
    raw = spark.createDataFrame([(10, "N", "X1"), (11, "M", None), (12, "Q", "X9")], "id int, v string, country string")
    once = H.snapshot_to_history(raw, hist, D, "country", ["X1", "X2"])
    # NULL-country history row stays, NULL / other-country raw rows are not inserted
    assert rows(once, "id") == [(2,), (4,), (10,)]
    twice = H.snapshot_to_history(raw, once, D, "country", ["X1", "X2"])
    assert rows(twice) == rows(once)


def test_empty_incoming_still_removes_slice(spark):
    hist = _hist(spark)
    raw = spark.createDataFrame([], "id int, v string, country string")
    out = H.snapshot_to_history(raw, hist, D, "country", ["X1"])
    assert rows(out, "id") == [(2,), (3,), (4,)]


def test_alias_normalisation(spark):
    hist = _hist(spark)
    alias = spark.createDataFrame([("x1", "X1"), ("X1", "X1")], "raw string, key string")
    raw = spark.createDataFrame([(10, "N", "x1"), (11, "M", "zz")], "id int, v string, country string")
    out = H.snapshot_to_history(raw, hist, D, "country", ["X1"], alias=alias)
    assert rows(out, "id") == [(2,), (3,), (4,), (10,)]


def test_resolve_countries_default_and_requested(spark):
    region = spark.createDataFrame([(1, "asia"), (2, "EUROPE")], "RegionId long, RegionKey string")
    country = spark.createDataFrame([("C1", 1, True), ("C2", 1, False), ("C3", 2, True)],
                                    "CountryKey string, RegionId long, Active boolean")
    assert rows(H.resolve_countries(spark, region, country, "ASIA")) == [("C1",)]
    assert rows(H.resolve_countries(spark, region, country, "Europe")) == [("C3",)]
    req = H.resolve_countries(spark, region, country, "asia", " c2 ,c9,, ")
    assert rows(req) == [("C2",), ("C9",)]


def test_active_sources_and_component(spark):
    ds = spark.createDataFrame([(2, "p", True, "ASIA"), (1, "p", True, "asia"), (3, "p", False, "asia"), (4, "q", True, "asia")],
                               "DataSourceId long, DataSourceName string, Active boolean, Region string")
    act = H.active_sources(ds, "p", "Asia")
    assert [r.DataSourceId for r in act.collect()] == [1, 2]
    cm = spark.createDataFrame([("comp", 2)], "ComponentName string, DataSourceId long")
    assert rows(H.component_sources(act, cm, "comp"), "DataSourceId") == [(2,)]
    assert rows(H.component_sources(act, cm, ""), "DataSourceId") == [(1,), (2,)]
