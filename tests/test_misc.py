import pytest
from pyspark.sql import functions as F

from ledgerline.functions.text import glob_to_regex, parse_fields_literal, parse_list_literal
from ledgerline.operators import checks as CK
from ledgerline.operators import manifest as MF
from ledgerline.operators import staging as ST
from ledgerline.plans.sql_template import apply_replacements, bind_config
from ledgerline.streaming import landing as LD
from conftest import rows


def test_glob_and_literals():
    import re
    rx = glob_to_regex("src2_*_?.{csv,txt}")
    assert re.match(rx, "src2_en_1.csv") and not re.match(rx, "src2_a/b_1.csv") and not re.match(rx, "src2_en_12.csv")
    assert parse_list_literal("('a', 'b')") == ["a", "b"] and parse_list_literal("['x']") == ["x"]
    assert parse_fields_literal("{2: 'b', 1: 'a'}") == [(2, "b"), (1, "a")]


def test_discover_files_dedupes_and_filters(spark):
    listing = spark.createDataFrame([("p_fr_de.csv",), ("p_fr.txt",), ("p_x.csv",), ("dir/p_fr.csv",), ("q_fr.csv",)],
                                    "name string")
    maps = [dict(region="r", datasource="d", pattern=["_fr", "_de"], patternfilter="p*", extension=".csv", topic="t1"),
            dict(region="R", datasource="d", pattern="q", patternfilter="", extension=".csv", topic="wrongcase"),
            dict(region="r", datasource="d", pattern="q", patternfilter="", extension=".csv", topic="t2")]
    got = rows(MF.discover_files(listing, maps, "r", "d"), "topic", "name")
    assert got == [("t1", "p_fr_de.csv"), ("t2", "q_fr.csv")]


def test_routing(spark):
    df = spark.createDataFrame([("a_x : t1 ,t2 |\n b_y:| ledger_north:t3",)], "m string")
    r = ST.parse_routing(df, "m", region_agnostic=["ledger_north"])
    assert rows(r) == [("a", "x", "t1"), ("a", "x", "t2"), ("ledger", None, "t3")]
    req = spark.createDataFrame([("a", "x"), ("ledger", "zz"), ("b", "y")], "datasource string, region string")
    assert rows(ST.route_staging(r, req)) == [("a", "x", "t1"), ("a", "x", "t2"), ("ledger", "zz", "t3")]


def test_reconcile_and_dependencies(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    b = spark.createDataFrame([(1,), (3,)], "k int")
    assert rows(CK.reconcile_tables(a, b)) == [(1, "only_in_a"), (2, "only_in_a"), (3, "only_in_b")]
    assert rows(CK.check_dependencies(a, b, ["k"])) == [(2,)]


def test_sql_template_binding():
    cfg = {"a": {"b": "{c.d}_x"}, "c": {"d": "v"}}
    assert bind_config("select {a.b}", cfg) == "select v_x"
    with pytest.raises(KeyError):
        bind_config("{nope.x}", cfg)
    assert apply_replacements("x y", "DEV,x,1;y,2", "prod") == "x 2"
    assert apply_replacements("x y", "DEV,x,1;y,2", "dev") == "1 2"


def test_landing_replay_is_harmless(spark, tmp_path):
    src = tmp_path / "src"
    spark.range(5).withColumnRenamed("id", "k").write.parquet(str(src / "a"))
    schema = spark.read.parquet(str(src / "a")).schema
    sink, ck = str(tmp_path / "sink"), str(tmp_path / "ck")
    LD.stream_landing(spark, str(src / "a"), schema, sink, ck, ingest_ts="2024-01-15 00:00:00")
    LD.stream_landing(spark, str(src / "a"), schema, sink, ck, ingest_ts="2024-01-15 00:00:00")   # same checkpoint
    LD._batch_writer(sink, ck, None)(spark.range(5).withColumnRenamed("id", "k"), 0)             # replayed batch
    assert LD.read_landed(spark, sink).count() == 5


def test_landing_streams_share_a_sink(spark, tmp_path):
    sink = str(tmp_path / "sink")
    for i, n in enumerate((3, 4)):
        spark.range(n).withColumnRenamed("id", "k").write.parquet(str(tmp_path / f"src{i}"))
        schema = spark.read.parquet(str(tmp_path / f"src{i}")).schema
        for _ in range(2):
            LD.stream_landing(spark, str(tmp_path / f"src{i}"), schema, sink, str(tmp_path / f"ck{i}"))
    assert LD.read_landed(spark, sink).count() == 7


def test_replace_partitions_touches_only_the_slice(spark, tmp_path):
    import datetime as dt
    from ledgerline.sinks import tables as SK
    path = str(tmp_path / "hist")
    d1, d2 = dt.date(2024, 1, 14), dt.date(2024, 1, 15)
    spark.createDataFrame([(1, "A", d1), (2, "A", d2), (3, "B", d2)], "id int, c string, createddttm date") \
        .write.partitionBy("createddttm").parquet(path)
    inc = spark.createDataFrame([(9, "A", d2)], "id int, c string, createddttm date")
    pred = (F.col("createddttm") == F.lit("2024-01-15").cast("date")) & (F.col("c") == "A")
    SK.replace_partitions(spark, path, inc, pred, "createddttm", ["2024-01-15"])
    assert rows(spark.read.parquet(path), "id") == [(1,), (3,), (9,)]
    # empty slice: the partition disappears instead of staying stale
    pred_all = F.col("createddttm") == F.lit("2024-01-15").cast("date")
    SK.replace_partitions(spark, path, inc.limit(0), pred_all, "createddttm", ["2024-01-15"])
    assert rows(spark.read.parquet(path), "id") == [(1,)]
    with pytest.raises(ValueError):
        SK.replace_partitions(spark, path, inc, pred_all, "createddttm", ["2024-01-13"])
    assert rows(spark.read.parquet(path), "id") == [(1,)]


def test_ensure_and_export(spark, tmp_path):
    from ledgerline.sinks import tables as SK
    from ledgerline.sources import files as SRC
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    assert SK.ensure_file(df.limit(0), str(tmp_path / "e"), True) is True
    assert spark.read.text(str(tmp_path / "e")).count() == 0
    assert SK.ensure_file(df, str(tmp_path / "e2"), True) is False
    SK.export_table(df, str(tmp_path / "x"), header=True)
    back = SRC.load_delimited(spark, str(tmp_path / "x"), df.schema.json())
    assert rows(back) == [(1, "a")]
