"""Registered queries: raw -> history."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import history as H
from .registry import query
from .tables import PRIOR_DATE, RUN_DATE, RUN_REGION, Tables


def _raw(t: Tables):
    """customer ⋈ nation as a raw feed; country spellings vary and some are missing."""
    return (
        t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "c_custkey", "c_name", "c_mktsegment",
            F.when(F.col("c_custkey") % 7 == 0, F.lit(None).cast("string"))
            .when(F.col("c_custkey") % 3 == 0, F.lower("n_name"))
            .otherwise(F.col("n_name")).alias("country_raw"),
        )
    )


def _alias(t: Tables):
    """Raw spelling -> canonical key, derived from nation (stand-in for the key function)."""
    n = t.nation
    return (n.select(F.col("n_name").alias("raw"), F.col("n_name").alias("key"))
            .unionByName(n.select(F.lower("n_name").alias("raw"), F.col("n_name").alias("key"))))


def _prior_history(t: Tables):
    raw = _raw(t)
    a = raw.where(F.col("c_custkey") % 2 == 0).withColumn("c_mktsegment", F.lit("OLD")) \
        .withColumn("createddttm", F.lit(RUN_DATE).cast("date"))
    b = raw.where(F.col("c_custkey") % 5 == 0).withColumn("createddttm", F.lit(PRIOR_DATE).cast("date"))
    return a.unionByName(b)


def _region_refs(t: Tables):
    region = t.region.select(F.col("r_regionkey").cast("long").alias("RegionId"),
                             F.col("r_name").alias("RegionKey"))
    country = t.nation.select(F.col("n_name").alias("CountryKey"),
                              F.col("n_regionkey").cast("long").alias("RegionId"),
                              (F.col("n_nationkey") % 4 != 3).alias("Active"))
    return region, country


def _countries(t: Tables, region_key: str = RUN_REGION, requested: str = ""):
    region, country = _region_refs(t)
    df = H.resolve_countries(t.spark, region, country, region_key, requested)
    return [r.CountryKey for r in df.collect()]


_SQL_RAW = """raw AS (SELECT c_custkey, c_name, c_mktsegment,
    CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN lower(n_name) ELSE n_name END AS country_raw
    FROM customer JOIN nation ON c_nationkey = n_nationkey),
alias AS (SELECT n_name AS raw, n_name AS key FROM nation UNION ALL SELECT lower(n_name), n_name FROM nation),
hist AS (SELECT c_custkey, c_name, 'OLD' AS c_mktsegment, country_raw, DATE '{run}' AS createddttm FROM raw WHERE c_custkey % 2 = 0
    UNION ALL SELECT c_custkey, c_name, c_mktsegment, country_raw, DATE '{prior}' FROM raw WHERE c_custkey % 5 = 0),
cty AS (SELECT n_name FROM nation JOIN region ON n_regionkey = r_regionkey
    WHERE lower(r_name) = lower('{region}') AND n_nationkey % 4 <> 3)""".format(run=RUN_DATE, prior=PRIOR_DATE,
                                                                              region=RUN_REGION)

HISTORY_REPLACE_SQL = f"""WITH {_SQL_RAW}
SELECT h.c_custkey, h.c_name, h.c_mktsegment, h.country_raw, h.createddttm
FROM hist h LEFT JOIN alias a ON h.country_raw = a.raw
WHERE NOT coalesce(h.createddttm = DATE '{RUN_DATE}' AND a.key IN (SELECT n_name FROM cty), false)
UNION ALL
SELECT r.c_custkey, r.c_name, r.c_mktsegment, r.country_raw, DATE '{RUN_DATE}'
FROM raw r JOIN alias a ON r.country_raw = a.raw WHERE a.key IN (SELECT n_name FROM cty)"""


@query("history_replace", HISTORY_REPLACE_SQL)
def history_replace(spark, sf_dir):
    """Rerun-safe snapshot of one region's countries into dated history (C1 + D10 + B2)."""
    t = Tables(spark, sf_dir)
    return H.snapshot_to_history(_raw(t), _prior_history(t), RUN_DATE, "country_raw",
                                 _countries(t), alias=_alias(t))


HISTORY_DELETE_EMPTY_SQL = f"""WITH {_SQL_RAW}
SELECT h.c_custkey, h.c_name, h.c_mktsegment, h.country_raw, h.createddttm
FROM hist h LEFT JOIN alias a ON h.country_raw = a.raw
WHERE NOT coalesce(h.createddttm = DATE '{RUN_DATE}' AND a.key IN (SELECT n_name FROM cty), false)"""


@query("history_delete_empty", HISTORY_DELETE_EMPTY_SQL)
def history_delete_empty(spark, sf_dir):
    """A rerun whose raw feed is empty: the old slice must still vanish."""
    t = Tables(spark, sf_dir)
    empty_raw = _raw(t).limit(0)
    return H.snapshot_to_history(empty_raw, _prior_history(t), RUN_DATE, "country_raw",
                                 _countries(t), alias=_alias(t))


COUNTRY_SCOPE_DEFAULT_SQL = """SELECT DISTINCT n_name AS CountryKey FROM nation JOIN region ON n_regionkey = r_regionkey
WHERE lower(r_name) = lower('Asia') AND n_nationkey % 4 <> 3"""


@query("country_scope_default", COUNTRY_SCOPE_DEFAULT_SQL)
def country_scope_default(spark, sf_dir):
    """Active countries of a region, region compared case-insensitively on both sides."""
    t = Tables(spark, sf_dir)
    region, country = _region_refs(t)
    return H.resolve_countries(spark, region, country, "Asia")


REQUESTED = " nation_1,NATION_7 , nation_99"

COUNTRY_SCOPE_REQUESTED_SQL = f"""WITH req AS (SELECT DISTINCT trim(k) AS CountryKey
    FROM (SELECT unnest(string_split(upper('{REQUESTED}'), ',')) AS k) WHERE trim(k) <> '')
SELECT CountryKey, n_nationkey, n_regionkey, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS n_customers
FROM req LEFT JOIN nation ON n_name = CountryKey"""


@query("country_scope_requested", COUNTRY_SCOPE_REQUESTED_SQL)
def country_scope_requested(spark, sf_dir):
    """A requested list replaces the region's countries, without active/region checks; their customers."""
    t = Tables(spark, sf_dir)
    region, country = _region_refs(t)
    req = H.resolve_countries(spark, region, country, "Asia", REQUESTED)
    customers = t.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    return (req.join(t.nation, F.col("n_name") == F.col("CountryKey"), "left")
            .join(customers, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .select("CountryKey", "n_nationkey", "n_regionkey", F.coalesce("n", F.lit(0)).cast("long").alias("n_customers")))


def _data_sources(t: Tables):
    return (
        t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("n_nationkey").cast("long").alias("DataSourceId"),
            F.when(F.col("n_nationkey") % 3 == 1, F.lit("rates")).otherwise(F.lit("payroll")).alias("DataSourceName"),
            F.concat(F.lit("raw."), F.lower("n_name")).alias("DataSourceRawValue"),
            F.concat(F.lit("raw."), F.lower("n_name"), F.lit("_history")).alias("DataSourceRawHistValue"),
            F.lit("country_raw").alias("CountryKeyField"),
            (F.col("n_nationkey") % 5 != 4).alias("Active"),
            F.when(F.col("n_nationkey") % 2 == 0, F.col("r_name")).otherwise(F.lower("r_name")).alias("Region"),
        )
    )


def _component_map(t: Tables):
    return (t.customer.where(F.col("c_acctbal") > 8000)
            .select(F.col("c_mktsegment").alias("ComponentName"),
                    F.col("c_nationkey").cast("long").alias("DataSourceId")).distinct())


ACTIVE_SOURCES_COMPONENT_SQL = """WITH ds AS (SELECT CAST(n_nationkey AS BIGINT) AS DataSourceId,
    CASE WHEN n_nationkey % 3 = 1 THEN 'rates' ELSE 'payroll' END AS DataSourceName,
    'raw.' || lower(n_name) AS DataSourceRawValue, 'raw.' || lower(n_name) || '_history' AS DataSourceRawHistValue,
    'country_raw' AS CountryKeyField, n_nationkey % 5 <> 4 AS Active,
    CASE WHEN n_nationkey % 2 = 0 THEN r_name ELSE lower(r_name) END AS Region
    FROM nation JOIN region ON n_regionkey = r_regionkey),
cm AS (SELECT DISTINCT c_mktsegment AS ComponentName, CAST(c_nationkey AS BIGINT) AS DataSourceId
    FROM customer WHERE c_acctbal > 8000)
SELECT * FROM ds WHERE DataSourceName = 'payroll' AND Active AND lower(Region) = lower('asia')
AND DataSourceId IN (SELECT DataSourceId FROM cm WHERE ComponentName = 'BUILDING')"""


@query("active_sources_component", ACTIVE_SOURCES_COMPONENT_SQL)
def active_sources_component(spark, sf_dir):
    """Active tables of a data source in a region, kept when valid for the component (A7 + D5)."""
    t = Tables(spark, sf_dir)
    src = H.active_sources(_data_sources(t), "payroll", "asia")
    return H.component_sources(src, _component_map(t), "BUILDING")
