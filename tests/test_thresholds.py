from pyspark.sql import functions as F

from ledgerline.functions.numeric import error_percentage, threshold_status, threshold_value
from ledgerline.operators import thresholds as TH
from conftest import rows


def test_error_percentage_and_status(spark):
    df = spark.createDataFrame(
        [(1, 8, "0"), (0, 0, "5"), (5, 0, "5"), (1, 800, "0.12"), (5, 100, "5"), (51, 1000, "5"), (1, 3, ""),
         (2675, 100000, "9"), (1005, 100000, "9")],
        "f long, b long, thr string")
    out = df.select("f", "b", error_percentage(F.col("f"), F.col("b")).alias("p"), threshold_value(F.col("thr")).alias("t"))
    out = out.withColumn("s", threshold_status(F.col("p"), F.col("t")))
    got = {(r.f, r.b): (r.p, r.s) for r in out.collect()}
    assert got[(1, 8)] == (12.5, "Failure")
    assert got[(0, 0)] == (0.0, "Success")
    assert got[(5, 0)] == (0.0, "Success")          # baseline 0 is Success even with failures
    assert got[(1, 800)] == (0.12, "Partial")       # 0.125 rounds half-even to 0.12; exactly at threshold
    assert got[(5, 100)] == (5.0, "Partial")
    assert got[(51, 1000)] == (5.1, "Failure")      # just above
    assert got[(1, 3)] == (33.33, "Failure")        # blank threshold is 0


def test_count_mismatch_and_summary(spark):
    lines = spark.createDataFrame([("A", "x"), ("A", " "), ("B", "y")], "k string, line string")
    v1 = spark.createDataFrame([("A",), ("A",), ("C",)], "k string")
    fc = TH.record_counts(lines, ["k"])
    vc = TH.view_counts([v1, v1.where("k = 'A'")], ["k"])
    mm = TH.count_mismatch(fc, vc, ["k"])
    assert rows(mm) == [("A", 1, 4, 3), ("B", 1, 0, 1), ("C", 0, 1, 1)]
    log = spark.createDataFrame([("A", "Error"), ("A", "Warning"), ("B", "Error")], "k string, type string")
    base = spark.createDataFrame([("A", 10), ("B", 0)], "k string, baseline long")
    thr = spark.createDataFrame([("A", "30"), ("B", "")], "k string, threshold string")
    s = TH.summary_rows(base, TH.failure_counts(log, ["k"]), mm, thr, ["k"])
    got = rows(s, "k", "stagefailure", "g2vsviewcountfailure", "totalfailure", "errorpercentage", "status")
    assert got == [("A", 1, 3, 4, 40.0, "Failure"), ("B", 1, 1, 2, 0.0, "Success"),
                   ("C", 0, 1, 1, 0.0, "Success")]       # no baseline row: the failure stays
    flags = TH.access_threshold(s, ["k"])
    assert rows(flags) == [("A", "Y"), ("B", "N"), ("C", "N")]


def test_log_with_stage_drops_unmapped(spark):
    log = spark.createDataFrame([("dag05", "r"), ("Ingestion", "r"), ("dag05", "other")], "stage string, region string")
    sm = spark.createDataFrame([("dag05", "Access")], "Stage string, StageDescription string")
    got = TH.log_with_stage(log, sm, region="r")
    assert rows(got, "stage", "stagedescription") == [("dag05", "Access")]


def test_log_with_stage_duplicate_map_fans_out(spark):
    log = spark.createDataFrame([("dag05", "r")], "stage string, region string")
    sm = spark.createDataFrame([("dag05", "A"), ("dag05", "B")], "Stage string, StageDescription string")
    assert rows(TH.log_with_stage(log, sm), "stagedescription") == [("A",), ("B",)]


def test_view_counts_by_name(spark):
    spark.createDataFrame([("A",), ("A",), ("B",)], "k string").createOrReplaceTempView("ll_v1_2024_01_15")
    spark.createDataFrame([("A",)], "k string").createOrReplaceTempView("ll_v2_2024_01_15")
    got = TH.view_counts_by_name(spark, "ll_v1, ll_v2", "2024-01-15", ["k"])
    assert rows(got) == [("A", 3), ("B", 1)]


def test_log_with_stage_never_gathers_a_stage(spark):
    """A run's rows share one stage: they stay where they are, whatever the planner knows of the map's size."""
    log = spark.range(0, 1000, 1, 8).select(F.lit("dag05").alias("stage"), F.col("id").alias("n"))
    stages = spark.createDataFrame([("dag05", "Data"), ("dag05", "Again"), ("dag06", "File")], "Stage string, StageDescription string")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = TH.log_with_stage(log, stages)
        sizes = out.groupBy(F.spark_partition_id().alias("p")).count().collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "SortMergeJoin" not in plan
    assert sorted(r["count"] for r in sizes) == [250] * 8    # 125 rows a task, two descriptions of the stage
