"""Disjoint slices, staged tables, threshold flags and stream identity."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import staging as ST
from ledgerline.operators import thresholds as TH
from ledgerline.sinks import slices as SL
from ledgerline.streaming import landing as LD
from conftest import rows

COLS = ["day", "country"]


def _rows(spark, *data):
    return spark.createDataFrame([(i, dt.date(2024, 1, d), c) for i, d, c in data], "id int, day date, country string")


def _read(spark, path):
    return rows(SL.read_slices(spark, path, _rows(spark).schema), "id", "country")


def test_slices_are_replaced_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    assert _read(spark, path) == []
    SL.replace_slices(spark, path, _rows(spark, (1, 15, "A"), (2, 15, "B =/%"), (3, 14, "A"), (4, 15, None)), COLS, {})
    SL.replace_slices(spark, path, _rows(spark, (9, 15, "A")), COLS, {"day": ["2024-01-15"], "country": ["A"]})
    assert _read(spark, path) == [(2, "B =/%"), (3, "A"), (4, None), (9, "A")]
    SL.replace_slices(spark, path, _rows(spark), COLS, {"day": ["2024-01-15"], "country": ["B =/%", None]})   # emptied: gone
    assert _read(spark, path) == [(3, "A"), (9, "A")]
    with pytest.raises(ValueError):
        SL.replace_slices(spark, path, _rows(spark, (7, 13, "A")), COLS, {"day": ["2024-01-15"]})
    assert _read(spark, path) == [(3, "A"), (9, "A")]
    SL.replace_slices(spark, path, _rows(spark, (5, 15, "C")), COLS, {"day": ["2024-01-15"]})   # all countries of the day
    assert _read(spark, path) == [(3, "A"), (5, "C")]


def test_overlapping_writers_and_a_broken_swap(spark, tmp_path):
    path = str(tmp_path / "t")
    SL.replace_slices(spark, path, _rows(spark, (1, 15, "A"), (2, 15, "B")), COLS, {})
    a = SL.stage_slices(spark, path, _rows(spark, (8, 15, "A")), COLS, {"country": ["A"]})
    b = SL.stage_slices(spark, path, _rows(spark, (9, 15, "B")), COLS, {"country": ["B"]})
    assert _read(spark, path) == [(1, "A"), (2, "B")]          # staged rows aren't visible
    SL.commit_slices(spark, b)
    SL.commit_slices(spark, a)
    assert _read(spark, path) == [(8, "A"), (9, "B")]
    # a swap that broke off after moving the old slice aside: the next one of that slice finds it again
    old, aside = tmp_path / "t/day=2024-01-15/country=A", tmp_path / "t/_aside/day=2024-01-15/country=A"
    aside.parent.mkdir(parents=True, exist_ok=True)
    old.rename(aside)
    staged = SL.stage_slices(spark, path, _rows(spark, (7, 14, "A")), COLS, {"day": ["2024-01-14", "2024-01-15"], "country": ["A"]})
    staged.where["day"] = ["2024-01-14"]
    SL.commit_slices(spark, staged)
    assert _read(spark, path) == [(7, "A"), (9, "B")]
    SL.replace_slices(spark, path, _rows(spark, (6, 15, "C")), COLS, {"day": ["2024-01-15"], "country": ["A", "C"]})
    assert _read(spark, path) == [(6, "C"), (7, "A"), (9, "B")]


def test_key_columns_keep_their_types(spark, tmp_path):
    df = spark.createDataFrame([(1, "007")], "id int, component string")
    SL.replace_slices(spark, str(tmp_path / "t"), df, ["component"], {"component": ["007"]})
    assert rows(SL.read_slices(spark, str(tmp_path / "t"), df.schema, {"component": ["007"]})) == [(1, "007")]


def test_staged_tables_live_and_end(spark, tmp_path):
    root, now = str(tmp_path / "s"), dt.datetime(2024, 1, 15, 12)
    a = ST.stage_tables({"t": spark.range(3)}, root, "2024-01-15", now, 2)
    b = ST.stage_tables({"t": spark.range(5), "u": spark.range(1)}, root, "2024-01-16", now + dt.timedelta(days=1), 2)
    assert a["t"] == "t_temp_2024_01_15_20240115120000000000"
    spark.range(1).write.parquet(f"{root}/t_temp_unfinished")      # a run that broke off before it registered
    assert ST.staged_tables(spark, root).count() == 3 and ST.read_staged(spark, root, b["t"]).count() == 5
    assert ST.purge_staged(spark, root, now + dt.timedelta(days=2)) == []           # the very moment is not past
    assert ST.purge_staged(spark, root, now + dt.timedelta(days=2, seconds=1)) == [a["t"]]
    assert rows(ST.staged_tables(spark, root), "physical") == sorted((x,) for x in b.values())
    assert not (tmp_path / "s" / a["t"]).exists()
    for name in (a["t"], "t_temp_unfinished"):
        with pytest.raises(KeyError):
            ST.read_staged(spark, root, name)
    assert ST.stage_tables({}, root, "2024-01-15", now, 2) == {}


def test_flags_of_both_levels(spark):
    log = spark.createDataFrame([("A", "x", "Error"), ("A", "x", "Error"), ("A", "y", "Warning"), ("A", None, "Error"), ("B", "x", "Error"),
                                 ("Z", "x", "Error")], "country string, sourcecomponent string, type string")
    base = spark.createDataFrame([("A", "x", 10), ("A", "y", 90), ("A", None, 1), ("B", "x", 4)], "country string, sourcecomponent string, baseline long")
    limits = spark.createDataFrame([("A", "10"), ("B", "")], "country string, threshold string")
    got = {(r.Country, r.Component, r.level): (r.baseline, r.stagefailure, r.status, r.Is_Threshold_Exceeded)
           for r in TH.access_flags(log, base, limits).collect()}
    assert got == {("A", "x", "component"): (10, 2, "Failure", "Y"), ("A", "y", "component"): (90, 0, "Success", "N"),
                   ("A", None, "component"): (1, 1, "Failure", "Y"), ("A", None, "country"): (101, 3, "Partial", "N"),
                   ("B", "x", "component"): (4, 1, "Failure", "Y"), ("B", None, "country"): (4, 1, "Failure", "Y")}


def test_new_stream_at_an_old_path_adds_its_rows(spark, tmp_path):
    """Five rows landed, the checkpoint moved away, a new stream at its path lands two more: seven rows."""
    sink, ck = str(tmp_path / "sink"), tmp_path / "ck"
    for n, moved in ((5, "moved"), (2, None)):
        src = str(tmp_path / f"src{n}")
        spark.range(n).write.parquet(src)
        LD.stream_landing(spark, src, spark.read.parquet(src).schema, sink, str(ck))
        LD.stream_landing(spark, src, spark.read.parquet(src).schema, sink, f"file:{ck}")   # the same stream by another path
        if moved:
            ck.rename(tmp_path / moved)
    assert LD.read_landed(spark, sink).count() == 7
    first = LD.stream_id(spark, str(tmp_path / "moved"))
    assert LD.read_landed(spark, sink).where(F.col("_batch_id").startswith(first)).count() == 5


def test_a_slice_is_written_by_several_tasks(spark, tmp_path):
    """Rows that lie in one task are dealt anew before they are sorted by slice, a slice to several tasks."""
    df = spark.range(0, 4000, 1, 1).select("id", F.lit(dt.date(2024, 1, 15)).alias("day"),
                                           F.when(F.col("id") % 2 == 0, "A").otherwise("B").alias("country"))
    path = str(tmp_path / "t")
    SL.replace_slices(spark, path, df, COLS, {"day": ["2024-01-15"], "country": ["A", "B"]})
    back = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("file"))
    per_file = back.groupBy("country", "file").count().collect()
    assert {r.country for r in per_file} == {"A", "B"} and max(r["count"] for r in per_file) < 2000
    assert sorted(r.id for r in back.collect()) == list(range(4000))
