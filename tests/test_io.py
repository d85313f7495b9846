import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.sinks import tables as SK
from ledgerline.sources import files as SRC
from conftest import rows


def test_list_files_and_discovery(spark, tmp_path):
    from ledgerline.operators import manifest as MF
    for n in ["src1_a.csv", "src1_b.txt", "other.csv"]:
        (tmp_path / n).write_text("x\n")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "src1_c.csv").write_text("x\n")
    listing = SRC.list_files(spark, str(tmp_path))
    assert sorted(r.name for r in listing.collect()) == ["other.csv", "src1_a.csv", "src1_b.txt"]
    m = [dict(region="r", datasource="d", pattern="src1_", patternfilter="", extension=".csv", topic="t")]
    assert rows(MF.discover_files(listing, m, "r", "d"), "name") == [("src1_a.csv",)]


def test_import_tables_append_truncate(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,v\n1,x\n2,y\n")
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.StringType())])
    out = SRC.import_tables(spark, {"t": (str(tmp_path / "a.csv"), schema)}, str(tmp_path / "tables"))
    assert rows(spark.read.parquet(out["t"])) == [(1, "x"), (2, "y")]
    SK.append_table(spark.createDataFrame([("z", 3, "extra")], "v string, k int, e string"), out["t"], ["k", "v"])
    assert rows(spark.read.parquet(out["t"])) == [(1, "x"), (2, "y"), (3, "z")]
    SK.truncate_source(spark, [out["t"]])
    t = spark.read.parquet(out["t"])
    assert t.count() == 0 and t.columns == ["k", "v"]


def test_read_layout(spark, tmp_path):
    p = tmp_path / "layout.json"
    p.write_text(json.dumps({"Headers": {"IsFixed": True, "Values": ["H"]}, "Body": []}))
    assert SRC.read_layout(spark, str(p))["Headers"]["Values"] == ["H"]
    bad = tmp_path / "bad.json"
    bad.write_text("{not json")
    import pytest
    with pytest.raises(Exception):
        SRC.read_layout(spark, str(bad))


def test_file_configs(spark):
    cfg = spark.createDataFrame([("r", "d", "us", "c1"), ("r", "d", "CA", "c2"), ("x", "d", "US", "c1")],
                                "Region string, DataSource string, Country string, Component string")
    assert rows(SRC.file_configs(cfg, "r", "d", "2024-01-15", " US ,mx", "c1"), "Country") == [("us",)]
    import pytest
    with pytest.raises(ValueError):
        SRC.file_configs(cfg, "r", "", "2024-01-15")


def test_partitioned_lines_keep_order(spark, tmp_path):
    df = spark.createDataFrame([("f1", i, f"l{i:03d}") for i in range(200)] + [("f2", 0, "only")],
                               "fid string, k int, line string")
    path = str(tmp_path / "out")
    SK.write_partitioned_lines(df.repartition(7), path, "fid", [F.col("fid"), F.col("k")])
    merged = str(tmp_path / "merged")
    SK.merge_files(spark, f"{path}/fid=f1", merged)
    got = [r.value for r in spark.read.text(merged).collect()]
    assert got == [f"l{i:03d}" for i in range(200)]


def test_single_date_export(spark, tmp_path):
    import datetime as dt
    df = spark.createDataFrame([(1, dt.date(2024, 1, 14)), (2, dt.date(2024, 1, 15))], "k int, createddttm date")
    SK.export_table(df, str(tmp_path / "x"), header=False, date_col="createddttm", run_date="2024-01-15")
    assert [r.value for r in spark.read.text(str(tmp_path / "x")).collect()] == ["2,2024-01-15"]


def test_publish_views(spark):
    import pytest
    spark.createDataFrame([(1, "O"), (2, "F")], "k int, s string").createOrReplaceTempView("ll_pub_src")
    cfg = spark.createDataFrame([("p.d.ll_open", "SELECT k FROM ll_pub_src WHERE s = 'O'"),
                                 ("p.d.ll_all", "SELECT k FROM ll_pub_src")], "ViewName string, ViewSql string")
    names = SRC.publish_views(spark, cfg, "2024-01-15")
    assert names == ["ll_open_2024_01_15", "ll_all_2024_01_15"]
    assert rows(SRC.read_dated_view(spark, "ll_all", "2024-01-15", order_by="k")) == [(1,), (2,)]
    bad = spark.createDataFrame([("ll_x", "SELECT 1")], "ViewName string, ViewSql string")
    with pytest.raises(ValueError):
        SRC.publish_views(spark, bad, "2024-01-15")


def test_worker_functions_ship_by_value():
    """Functions run on Python workers must not need this package importable there."""
    from ledgerline.plans.q_io import reverse_words
    assert "<locals>" in reverse_words().__qualname__
