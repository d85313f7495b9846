"""Readers: landed-file listings, record files, delimited loads, dated views and layouts (A1 listing, A3-A6, A11)."""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def list_files(spark: SparkSession, root: str, glob: str | None = None, recursive: bool = False) -> DataFrame:
    """Object listing under ``root`` as ``(path, name, length, modificationTime)``.

    Uses the ``binaryFile`` source without selecting ``content``, so no file body is read.
    ``name`` is the path relative to ``root``.
    """
    r = spark.read.format("binaryFile")
    if glob:
        r = r.option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    df = r.load(root).select("path", "length", "modificationTime")
    base = root.split(":", 1)[-1].rstrip("/") + "/"
    return df.withColumn("name", F.regexp_replace("path", "^.*?" + re.escape(base), ""))


def read_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Header-less record file(s) as ``(line, source_file)``; blank / whitespace-only lines dropped.

    The whole line is kept as text (no delimiter parsing at read time).  An empty file
    yields no rows.
    """
    df = spark.read.text(path).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("source_file"))
    return df.where(F.trim("line") != "")


def load_delimited(spark: SparkSession, path: str | list[str], schema: T.StructType | str,
                   header: bool = True, sep: str = ",") -> DataFrame:
    """Delimited files with an explicit schema document (``StructType`` or its JSON); no inference."""
    st = T.StructType.fromJson(json.loads(schema)) if isinstance(schema, str) else schema
    return (spark.read.schema(st).option("header", header).option("sep", sep)
            .option("mode", "FAILFAST").csv(path))


def import_tables(spark: SparkSession, sources: dict[str, tuple[str, T.StructType]], target_root: str,
                  mode: str = "overwrite") -> dict[str, str]:
    """Load several delimited fixtures into several parquet tables (``mode`` = write disposition)."""
    out = {}
    for key, (path, schema) in sources.items():
        dest = f"{target_root.rstrip('/')}/{key}"
        load_delimited(spark, path, schema).write.mode(mode).parquet(dest)
        out[key] = dest
    return out


def dated_view_name(name: str, run_date: str) -> str:
    return f"{name}_{run_date.replace('-', '_')}"


def publish_view(df: DataFrame, name: str, run_date: str) -> str:
    """Register ``df`` as the dated view ``<name>_YYYY_MM_DD``."""
    full = dated_view_name(name, run_date)
    df.createOrReplaceTempView(full)
    return full


def publish_views(spark: SparkSession, configs: DataFrame, run_date: str, name_col: str = "ViewName",
                  sql_col: str = "ViewSql") -> list[str]:
    """Publish one dated output view per configuration row.

    A view name has at least three dotted parts (``project.dataset.view``); the last part, suffixed
    with the run date, names the temp view, defined by the row's SQL (run as one Spark plan each).
    The configurations are streamed to the driver, which registers each name in the session catalog.
    """
    published = []
    for r in configs.select(name_col, sql_col).toLocalIterator():
        parts = (r[name_col] or "").split(".")
        if len(parts) < 3 or not all(parts):
            raise ValueError(f"view name needs at least three dotted parts: {r[name_col]!r}")
        published.append(publish_view(spark.sql(r[sql_col]), parts[-1], run_date))
    return published


def read_dated_view(spark: SparkSession, name: str, run_date: str, order_by: str | None = None) -> DataFrame:
    """``<name>_YYYY_MM_DD``, optionally ordered by a comma list of columns (an empty view is no error)."""
    df = spark.table(dated_view_name(name, run_date))
    if order_by:
        df = df.orderBy(*[c.strip() for c in order_by.split(",") if c.strip()])
    return df


def read_layout(spark: SparkSession, path: str) -> dict:
    """One JSON layout document (configuration, small); missing, malformed or several files raise."""
    rows = spark.read.text(path, wholetext=True).limit(2).collect()
    if not rows:
        raise FileNotFoundError(path)
    if len(rows) > 1:
        raise ValueError(f"{path} matches several layout files")
    doc = json.loads(rows[0].value)
    if "Body" not in doc or "Headers" not in doc:
        raise ValueError(f"layout {path} needs Headers and Body")
    return doc


def file_configs(configs: DataFrame, region: str, datasource: str, run_date: str,
                 countries: str = "", component: str = "") -> DataFrame:
    """File configurations of a run: region, datasource and date required; countries and component optional."""
    if not (region and datasource and run_date):
        raise ValueError("region, datasource and requested date are required")
    df = configs.where((F.col("Region") == region) & (F.col("DataSource") == datasource))
    wanted = [c.strip().upper() for c in countries.split(",") if c.strip()]
    if wanted:
        df = df.where(F.upper("Country").isin(wanted))
    if component:
        df = df.where(F.col("Component") == component)
    return df
