"""Quality configuration for the registered queries.

Configuration (rules, error codes, severities, layouts, mappings) is small by nature and is
written here as rows; every frame that *data* flows through is derived from the shared
test tables, so each query's work grows with them.  Country lists inside the rule rows are
taken from the ``nation`` table.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import RUN_DATE, RUN_REGION, SOURCE, Tables

S = T.StringType()

CONFIG_SCHEMA = T.StructType([T.StructField(n, S) for n in [
    "Country", "Stage", "ObjectType", "ObjectName", "ObjectField", "Operator", "ObjectFieldValue",
    "AdditionalCondition", "ErrorCode", "Recommendation", "SeverityID", "FieldsCode",
    "CountryKeyField", "FileIngestionCondition", "Vendor", "Component", "Source"]]
    + [T.StructField("IsActive", T.BooleanType())])


def _nation_rows(t: Tables) -> list:
    """(n_name, r_name) of every nation, collected once per query (the run's country configuration)."""
    cache = t.__dict__.setdefault("_config_cache", {})
    if "nations" not in cache:
        df = (t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
              .select("n_name", "r_name").orderBy("n_name"))
        cache["nations"] = df.collect()
    return cache["nations"]


def all_nations(t: Tables) -> str:
    return ",".join(r.n_name for r in _nation_rows(t))


def run_countries(t: Tables, region: str = RUN_REGION) -> list[str]:
    """Countries of the run region: nations of ``region``."""
    return [r.n_name for r in _nation_rows(t) if r.r_name == region]


# Table-rule templates: (stage, type, object, field, condition, error, recommendation,
# severity, fields code, country field, ingestion condition, vendor, component, active)
TABLE_RULES = [
    ("dag05", "table", "lineitem_history", "l_quantity", "l_quantity > 45", "E001",
     "Check quantity", "S1", "F1", "n_name", "", "vend1", "core", True),
    ("dag05", "table", "lineitem_history", "l_discount", "l_discount >= 0.09", "E002",
     "Check discount", "S2", "F1", "n_name", "", "vend1", "core", True),
    ("dag05", "table", "lineitem_history", "l_returnflag", "l_returnflag = 'R' OR o_orderstatus = 'P'", "E003",
     "Check flag and status", "S1", "F2", "n_name", "", "vend1", "core", True),
    ("dag05", "table", "lineitem_history", "l_shipdate", "l_shipdate < o_orderdate + INTERVAL 30 DAYS", "E005",
     "Check ship date", "S2", "F3", "n_name", "", "vend1", "core", True),
    ("dag05", "table", "lineitem_history", "l_tax", "l_tax > 0.07", "E001",
     "inactive rule", "S1", "F1", "n_name", "", "vend1", "core", False),
    ("dag05", "table", "lineitem_history", "l_tax", "l_tax > 0.07", "E001",
     "other vendor", "S1", "F1", "n_name", "", "vend2", "core", True),
    ("dag04", "table", "lineitem_history", "l_tax", "l_tax > 0.07", "E001",
     "other stage", "S1", "F1", "n_name", "", "vend1", "core", True),
]

ERROR_MAP = [("E001", "Quantity above limit", "Error"), ("E002", "Discount above limit", "Warning"),
             ("E003", "Return flag against status", "Error"), ("E004", "Country mismatch", "Error"),
             ("E005", "Shipped before order window", "Error"), ("E006", "Ingestion", "Error")]
SEVERITY_MAP = [("S1", "High"), ("S2", "Low")]
FIELDS_MAP = [("F1", "l_orderkey,l_linenumber"),
              ("F2", "l_orderkey, l_linenumber,l_returnflag,o_orderstatus"),
              ("F3", "l_orderkey,l_linenumber,l_shipdate"),
              ("F4", "s_suppkey,s_name,c_custkey"),
              ("F5", "o_orderkey,o_orderstatus"),
              ("F6", "event_id,user_id")]
VENDOR_REGION = [("vend1", "ASIA"), ("vend2", "EUROPE"), ("vend3", "ASIA")]


def local_frame(spark: SparkSession, rows: list[tuple], schema: T.StructType | str) -> DataFrame:
    """A configuration frame as a local relation (exact size statistics, so joins can prove it small)."""
    st = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    pdf = pd.DataFrame(rows, columns=[f.name for f in st.fields])
    return spark.createDataFrame(pdf, schema=st)


def error_map(spark: SparkSession) -> DataFrame:
    return local_frame(spark, ERROR_MAP, "code string, Description string, Type string")


def severity_map(spark: SparkSession) -> DataFrame:
    return local_frame(spark, SEVERITY_MAP, "SeverityID string, SeverityDescription string")


def fields_map(spark: SparkSession, extra: list[tuple] | None = None) -> DataFrame:
    return local_frame(spark, FIELDS_MAP + (extra or []), "FieldsCode string, LogFields string")


def vendor_region(spark: SparkSession) -> DataFrame:
    return local_frame(spark, VENDOR_REGION, "Vendor string, Region string")


def table_rules_config(t: Tables, templates=TABLE_RULES, countries: str | None = None) -> DataFrame:
    countries = countries if countries is not None else all_nations(t)
    rows = [
        (countries, st, ot, on, fld, "", "", cond, err, rec, sev, fc, ck, ing, ven, comp, SOURCE, act)
        for (st, ot, on, fld, cond, err, rec, sev, fc, ck, ing, ven, comp, act) in templates
    ]
    return local_frame(t.spark, rows, CONFIG_SCHEMA)


RULE_DEFAULTS = dict(Stage="dag06", ObjectType="file", ObjectName="", ObjectField="", Operator="",
                     ObjectFieldValue="", AdditionalCondition="", ErrorCode="E001", Recommendation="",
                     SeverityID="S1", FieldsCode="F1", CountryKeyField="", FileIngestionCondition="",
                     Vendor="vend1", Component="core", Source=SOURCE, IsActive=True)


def rules_config(t: Tables, specs: list[dict], countries: str | None = None) -> DataFrame:
    """Configuration rows from partial specs; ``Country`` defaults to every nation."""
    countries = countries if countries is not None else all_nations(t)
    names = [f.name for f in CONFIG_SCHEMA.fields]
    rows = []
    for spec in specs:
        d = dict(RULE_DEFAULTS, Country=countries, **spec)
        rows.append(tuple(d[n] for n in names))
    return local_frame(t.spark, rows, CONFIG_SCHEMA)


def lineitem_history(t: Tables, run_date: str = RUN_DATE) -> DataFrame:
    """lineitem ⋈ orders ⋈ customer ⋈ nation stamped as the run date's history slice."""
    return (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .withColumn("createddttm", F.lit(run_date).cast("date"))
    )
