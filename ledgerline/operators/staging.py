"""Run-scoped staging tables: routing, names, and their life from the write to the purge."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

REGISTRY = "logical string, physical string, expires_at timestamp_ntz, state string"



def parse_routing(df: DataFrame, text_col: str, region_agnostic: list[str] | None = None) -> DataFrame:
    """``key:t1,t2|key:t3`` text (all whitespace ignored) -> ``(datasource, region, table)`` rows.

    A key is ``<datasource>_<region>``; for data sources listed in ``region_agnostic`` the
    region part is ignored (``region`` NULL = any region).  An empty table list yields no rows.
    """
    agn = region_agnostic or []
    clean = F.regexp_replace(F.col(text_col), r"\s", "")
    entries = df.select(F.explode(F.split(clean, r"\|")).alias("e"))
    kv = entries.select(F.substring_index("e", ":", 1).alias("key"),
                        F.explode(F.split(F.substring_index("e", ":", -1), ",")).alias("table"))
    kv = kv.where(F.col("table") != "")
    ds = F.regexp_extract("key", r"^(.*)_([^_]*)$", 1)
    rg = F.regexp_extract("key", r"^(.*)_([^_]*)$", 2)
    is_agn = F.col("key").isin(agn) | ds.isin(agn)
    return kv.select(
        ds.alias("datasource"),
        F.when(is_agn, F.lit(None).cast("string")).otherwise(rg).alias("region"),
        "table")


def route_staging(routing: DataFrame, requests: DataFrame) -> DataFrame:
    """Logical tables of each ``(datasource, region)`` request; NULL routing region matches any."""
    r = routing.withColumnRenamed("datasource", "__ds").withColumnRenamed("region", "__rg")
    cond = (F.col("datasource") == F.col("__ds")) & (F.col("__rg").isNull() | (F.col("region") == F.col("__rg")))
    return requests.join(r, cond).select("datasource", "region", "table")


def stage_output(tables: DataFrame, run_date: str, now: Column, ttl_days: int) -> DataFrame:
    """Registry rows ``(logical, physical, expires_at)``: ``<t>_temp_<YYYY_MM_DD>_<yyyyMMddHHmmssSSSSSS>``."""
    suffix = F.concat(F.lit(run_date.replace("-", "_") + "_"), F.date_format(now, "yyyyMMddHHmmssSSSSSS"))
    return tables.select(
        F.col("table").alias("logical"),
        F.concat(F.col("table"), F.lit("_temp_"), suffix).alias("physical"),
        F.timestamp_add("DAY", F.lit(ttl_days), now).alias("expires_at"))


def expired(registry: DataFrame, now: Column) -> DataFrame:
    """Staging tables whose expiry has passed (to purge)."""
    return registry.where(F.col("expires_at") < now)


# --------------------------------------------------------------------------- the tables themselves

def stage_tables(frames: Mapping[str, DataFrame], root: str, run_date: str, now: _dt.datetime, ttl_days: int) -> dict[str, str]:
    """Write each logical table under its run's own name below ``root``, then register them all; returns logical -> physical.

    The registry is written last: a run that broke off has registered nothing, and its folders are never read.
    """
    if not frames:
        return {}
    suffix = f"{run_date.replace('-', '_')}_{now:%Y%m%d%H%M%S%f}"
    names = {t: f"{t}_temp_{suffix}" for t in frames}
    for t, df in frames.items():
        df.write.parquet(f"{root}/{names[t]}")
    _register(next(iter(frames.values())).sparkSession, root,
              [(t, n, now + _dt.timedelta(days=ttl_days), "staged") for t, n in names.items()])
    return names


def _register(spark: SparkSession, root: str, rows: list[tuple]) -> None:
    spark.createDataFrame(rows, REGISTRY).coalesce(1).write.mode("append").parquet(f"{root}/_registry")


def staged_tables(spark: SparkSession, root: str) -> DataFrame:
    """Registered tables that weren't purged: ``(logical, physical, expires_at)``."""
    rows = spark.read.schema(REGISTRY).parquet(f"{root}/_registry")
    gone = rows.where(F.col("state") == "purged").select("physical").distinct()
    return rows.where(F.col("state") == "staged").join(gone, "physical", "left_anti").select("logical", "physical", "expires_at")


def read_staged(spark: SparkSession, root: str, physical: str) -> DataFrame:
    """A registered table's rows; one that was purged or never finished raises."""
    if staged_tables(spark, root).where(F.col("physical") == F.lit(physical)).limit(1).count() == 0:
        raise KeyError(f"no staged table {physical!r}")
    return spark.read.parquet(f"{root}/{physical}")


def purge_staged(spark: SparkSession, root: str, now: _dt.datetime) -> list[str]:
    """Remove the tables whose expiry has passed; returns their physical names.

    They leave the registry before their files go.  Files that an interrupted purge left behind go with the next one.
    """
    from ..sinks.tables import _fs
    at = F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz")
    due = [(r.logical, r.physical, r.expires_at, "purged") for r in expired(staged_tables(spark, root), at).collect()]
    if due:
        _register(spark, root, due)
    fs, _, jvm = _fs(spark, root)
    gone = spark.read.schema(REGISTRY).parquet(f"{root}/_registry").where(F.col("state") == "purged").select("physical").distinct()
    for r in gone.collect():
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{root}/{r.physical}"), True)
    return sorted(r[1] for r in due)
