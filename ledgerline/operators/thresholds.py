"""Counts, failure totals, threshold status and summaries, grouped for all keys at once.

Operators: E2 view_counts, E3 record_counts, E4 count_mismatch, E5 baseline_count,
E6 failure_counts, E7 threshold_status, E8 summary_rows, E12 access_threshold,
D4 log_with_stage.  Every count is a grouped aggregation with map-side partial
aggregation, so a hot key costs one partial row per task, never a hot partition.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.numeric import error_percentage, threshold_status, threshold_value


def record_counts(lines: DataFrame, keys: list[str], line_col: str = "line") -> DataFrame:
    """Non-blank record lines per key (blank and whitespace-only lines do not count)."""
    return (lines.where(F.trim(F.col(line_col)) != "")
            .groupBy(*keys).agg(F.count(F.lit(1)).alias("file_count")))


def view_counts(views: list[DataFrame], keys: list[str]) -> DataFrame:
    """Rows per key summed over several views (UNION ALL of per-view counts)."""
    per_view = [v.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")) for v in views]
    allv = reduce(lambda a, b: a.unionByName(b), per_view)
    return allv.groupBy(*keys).agg(F.sum("n").alias("view_count"))


def view_counts_by_name(spark, names: str | list[str], run_date: str, keys: list[str]) -> DataFrame:
    """E2 by view name: a comma list of output views, each read as ``<name>_YYYY_MM_DD``."""
    from ..sources.files import read_dated_view
    names = [n.strip() for n in names.split(",")] if isinstance(names, str) else list(names)
    return view_counts([read_dated_view(spark, n, run_date) for n in names if n], keys)


def count_mismatch(file_counts: DataFrame, view_counts_df: DataFrame, keys: list[str]) -> DataFrame:
    """``|file records - Σ view rows|`` per key; a key missing on one side counts as 0."""
    j = file_counts.join(view_counts_df, keys, "full_outer")
    return j.select(
        *keys,
        F.coalesce("file_count", F.lit(0)).cast("long").alias("file_count"),
        F.coalesce("view_count", F.lit(0)).cast("long").alias("view_count"),
        F.abs(F.coalesce("file_count", F.lit(0)) - F.coalesce("view_count", F.lit(0))).cast("long")
        .alias("g2vsviewcountfailure"),
    )


def baseline_count(df: DataFrame, keys: list[str], count_col: str | None = None) -> DataFrame:
    """Baseline per key: the sum of a count column (a UNION ALL of counts) or a row count."""
    if count_col:
        return df.groupBy(*keys).agg(F.sum(count_col).cast("long").alias("baseline"))
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("baseline"))


def failure_counts(log: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of type ``Error`` per key (all stages of the run)."""
    return log.groupBy(*keys).agg(
        F.count_if(F.col("type") == F.lit(K.ERROR_TYPE)).cast("long").alias("stagefailure"))


def with_status(df: DataFrame, failures: str = "totalfailure", baseline: str = "baseline",
                threshold: str = "thresholdpercentage") -> DataFrame:
    """Add ``errorpercentage`` and ``status`` columns."""
    pct = error_percentage(F.col(failures), F.col(baseline))
    return df.withColumn("errorpercentage", pct).withColumn(
        "status", threshold_status(F.col("errorpercentage"), F.col(threshold)))


def summary_rows(baseline: DataFrame, stage_failures: DataFrame, mismatch: DataFrame | None,
                 thresholds: DataFrame, keys: list[str]) -> DataFrame:
    """Per key: stage failures, count mismatch, total, threshold, percentage and status.

    ``thresholds`` carries ``keys`` + ``threshold`` text ('' -> 0).  A key without baseline rows keeps its failures
    (baseline 0).
    """
    j = baseline.join(stage_failures, keys, "full")
    if mismatch is not None:
        j = j.join(mismatch.select(*keys, "g2vsviewcountfailure"), keys, "full")
    else:
        j = j.withColumn("g2vsviewcountfailure", F.lit(0).cast("long"))
    j = j.join(thresholds, keys, "left")
    j = j.select(
        *keys,
        F.coalesce("baseline", F.lit(0)).cast("long").alias("baseline"),
        F.coalesce("stagefailure", F.lit(0)).cast("long").alias("stagefailure"),
        F.coalesce("g2vsviewcountfailure", F.lit(0)).cast("long").alias("g2vsviewcountfailure"),
        threshold_value(F.col("threshold")).alias("thresholdpercentage"),
    ).withColumn("totalfailure", F.col("stagefailure") + F.col("g2vsviewcountfailure"))
    return with_status(j)


def access_threshold(summary: DataFrame, keys: list[str]) -> DataFrame:
    """Threshold flags ``{keys, Is_Threshold_Exceeded}``: ``Y`` iff the status is Failure."""
    return summary.select(*keys, F.when(F.col("status") == F.lit(K.STATUS_FAILURE), F.lit("Y"))
                          .otherwise(F.lit("N")).alias("Is_Threshold_Exceeded"))


def access_flags(log: DataFrame, baseline: DataFrame, thresholds: DataFrame, country: str = "country",
                 component: str = "sourcecomponent") -> DataFrame:
    """Threshold flags from a run's log, by country and component and by country alone.

    The log is read once: grouping sets count both levels, told apart by ``level`` (``component`` or ``country``; a country
    row has no component).  ``baseline`` holds the checked rows per (country, component); its keys decide which flags exist.
    ``thresholds`` has (country, threshold text).  Columns: ``Country, Component, level, baseline, stagefailure,
    errorpercentage, status, Is_Threshold_Exceeded``.
    """
    def both(df: DataFrame, value: Column, name: str) -> DataFrame:
        grouped = df.groupingSets([[country, component], [country]], country, component).agg(
            value.alias(name), F.grouping(component).alias("__all"))
        return grouped.select(F.col(country).alias("__c"), F.col(component).alias("__m"), "__all", name)
    failures = both(log, F.count_if(F.col("type") == F.lit(K.ERROR_TYPE)).cast("long"), "stagefailure")
    rows = both(baseline, F.sum("baseline").cast("long"), "baseline")
    f = failures.select(*[F.col(c).alias(c + "_f") for c in ("__c", "__m", "__all")], "stagefailure")
    same = (F.col("__all") == F.col("__all_f")) & F.col("__c").eqNullSafe(F.col("__c_f")) & F.col("__m").eqNullSafe(F.col("__m_f"))
    limits = thresholds.select(F.col(country).alias("__t"), "threshold")
    j = (rows.join(f, same, "left").join(limits, F.col("__c") == F.col("__t"), "left")
         .select("__c", "__m", "__all", "baseline", F.coalesce("stagefailure", F.lit(0)).cast("long").alias("stagefailure"),
                 threshold_value(F.col("threshold")).alias("thresholdpercentage")))
    j = with_status(j, failures="stagefailure")
    return j.select(F.col("__c").alias("Country"), F.col("__m").alias("Component"),
                    F.when(F.col("__all") == 1, "country").otherwise("component").alias("level"), "baseline", "stagefailure",
                    "errorpercentage", "status",
                    F.when(F.col("status") == F.lit(K.STATUS_FAILURE), "Y").otherwise("N").alias("Is_Threshold_Exceeded"))


def log_with_stage(log: DataFrame, stage_map: DataFrame, **equals) -> DataFrame:
    """Log rows of one run with their stage description (inner join: unmapped stages drop out, a repeated one fans out).

    A run's rows mostly share one stage, so a join by shuffle would sort them all in one task: the map, which is
    configuration, goes to the log rows instead.
    """
    df = log
    for c, v in equals.items():
        df = df.where(F.col(c) == (v if not isinstance(v, str) else F.lit(v)))
    sm = stage_map.select(F.col("Stage").alias("__stage"), F.col("StageDescription").alias("stagedescription"))
    return df.join(F.broadcast(sm), F.col("stage") == F.col("__stage")).drop("__stage")
