"""Raw -> dated history: source resolution, country scope, snapshot and rerun-safe replace.

Operators: A7 active_sources, D5 component_sources, C2 effective date (functions.dates),
C3 resolve_countries, D10 normalise_country, C1 stamp_snapshot, B2 replace_slice,
B3 delete_slice and the composed ``snapshot_to_history``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F



def active_sources(data_source: DataFrame, datasource: str, region: str) -> DataFrame:
    """Active tables of one data source in one region (region compared case-insensitively)."""
    return (
        data_source.where(
            (F.col("DataSourceName") == F.lit(datasource))
            & F.coalesce(F.col("Active"), F.lit(False))
            & (F.lower("Region") == F.lit(region.lower()))
        )
        .orderBy("DataSourceId")
    )


def component_sources(sources: DataFrame, component_map: DataFrame, component: str | None,
                      region_id=None) -> DataFrame:
    """Keep sources valid for ``component``; no component keeps all sources."""
    if not component:
        return sources
    valid = component_map.where(F.col("ComponentName") == F.lit(component))
    if region_id is not None and "RegionId" in component_map.columns:
        valid = valid.where(F.col("RegionId") == F.lit(region_id))
    valid = valid.select("DataSourceId").distinct()
    return sources.join(valid, "DataSourceId", "left_semi")


def resolve_countries(spark: SparkSession, region: DataFrame, country: DataFrame, region_key: str,
                      requested: str = "") -> DataFrame:
    """Countries of a run, one ``CountryKey`` per row.

    Default: active countries of the region (``RegionKey`` compared lower-cased on both
    sides).  A non-empty ``requested`` list replaces the default: split on ',', trimmed,
    upper-cased, with no active or region check.
    """
    if requested and requested.strip():
        return (
            spark.range(1)
            .select(F.explode(F.split(F.upper(F.lit(requested)), ",")).alias("CountryKey"))
            .select(F.trim("CountryKey").alias("CountryKey"))
            .where(F.col("CountryKey") != "")
            .distinct()
        )
    rid = region.where(F.lower("RegionKey") == F.lit(region_key.lower())).select("RegionId")
    return (
        country.where(F.coalesce(F.col("Active"), F.lit(False)))
        .join(rid, "RegionId", "left_semi")
        .select("CountryKey")
        .distinct()
    )


def normalise_country(df: DataFrame, raw_col: str, alias: DataFrame | None,
                      out_col: str = "__country_key") -> DataFrame:
    """Add the canonical country key of ``raw_col``.

    ``alias`` maps raw spellings (``raw``) to canonical keys (``key``); a spelling that is
    not mapped gets NULL.  Without an alias table the raw value is the key.
    """
    if alias is None:
        return df.withColumn(out_col, F.col(raw_col))
    a = alias.select(F.col("raw").alias("__alias_raw"), F.col("key").alias(out_col))
    return (
        df.join(a, F.col(raw_col) == F.col("__alias_raw"), "left")
        .drop("__alias_raw")
    )


def stamp_snapshot(raw: DataFrame, run_date: str, key_col: str, countries: list[str]) -> DataFrame:
    """Raw rows of the run's countries, with ``createddttm`` = run date."""
    return (
        raw.where(F.col(key_col).isin(countries))
        .withColumn("createddttm", F.lit(run_date).cast("date"))
    )


def replace_slice(target: DataFrame, incoming: DataFrame, slice_pred: Column) -> DataFrame:
    """Rerun-safe DELETE + INSERT as one frame.

    Rows of ``target`` where ``slice_pred`` is TRUE are dropped (a NULL predicate keeps
    the row: SQL three-valued logic of DELETE), then ``incoming`` is appended by name.
    An empty ``incoming`` still removes the old slice.
    """
    kept = target.where(~F.coalesce(slice_pred, F.lit(False)))
    return kept.unionByName(incoming, allowMissingColumns=True)


def delete_slice(target: DataFrame, slice_pred: Column) -> DataFrame:
    """``replace_slice`` with nothing to insert."""
    return target.where(~F.coalesce(slice_pred, F.lit(False)))


def snapshot_to_history(raw: DataFrame, history: DataFrame, run_date: str, country_field: str,
                        countries: list[str], alias: DataFrame | None = None) -> DataFrame:
    """Copy the run's slice of ``raw`` into ``history`` (C1 + D10 + B2).

    The slice is ``createddttm = run date AND key(country_field) IN countries`` on both
    the delete and the insert side; a NULL key is neither deleted nor inserted.
    """
    key = "__country_key"
    hist_k = normalise_country(history, country_field, alias, key)
    raw_k = normalise_country(raw, country_field, alias, key)
    pred = (F.col("createddttm") == F.lit(run_date).cast("date")) & F.col(key).isin(countries)
    incoming = stamp_snapshot(raw_k, run_date, key, countries)
    cols = history.columns
    return replace_slice(hist_k, incoming, pred).select(*cols)
