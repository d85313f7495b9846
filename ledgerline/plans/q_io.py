"""Registered queries: discovery, staging, checks, SQL jobs, transforms, streaming and on-disk round trips."""

from __future__ import annotations

import datetime as _dt
import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import checks as CK
from ..operators import history as H
from ..operators import manifest as MF
from ..operators import staging as ST
from ..session import scratch_path
from ..sinks import tables as SK
from ..sources import files as SRC
from ..streaming import landing as LD
from . import q_history as QH
from . import q_records as QR
from .registry import query
from .sql_template import param_sql
from .tables import FIXED_NOW, RUN_DATE, Tables

# ----------------------------------------------------------------------------- A1 / A2

MAPPINGS = [
    dict(region="north", datasource="rates", pattern="src1_", patternfilter="", extension=".csv", topic="t_src1"),
    dict(region="north", datasource="rates", pattern="src2_en", patternfilter="src2_*_*.csv", extension=".csv",
         topic="t_src2"),
    dict(region="north", datasource="rates", pattern=["_fr_", "_de_", "src3_"], patternfilter="src3*",
         extension=".csv", topic="t_src3"),
    dict(region="north", datasource="rates", pattern=["src4_", "src5_"], patternfilter="", extension=".txt",
         topic="t_src45"),
    dict(region="NORTH", datasource="rates", pattern="src6_", patternfilter="", extension=".csv", topic="t_case"),
    dict(region="north", datasource="payroll", pattern="src7_", patternfilter="", extension=".csv", topic="t_other"),
]


def _listing(t: Tables):
    d = t.documents
    name = F.concat(F.when(F.col("doc_id") % 7 == 0, F.lit("archive/")).otherwise(F.lit("")),
                    F.col("source"), F.lit("_"), F.col("lang"), F.lit("_"), F.col("doc_id").cast("string"),
                    F.when(F.col("doc_id") % 3 == 0, F.lit(".txt")).otherwise(F.lit(".csv")))
    return d.select(name.alias("name"))


_LIST_SQL = ("f AS (SELECT CASE WHEN doc_id % 7 = 0 THEN 'archive/' ELSE '' END || source || '_' || lang || '_' "
             "|| CAST(doc_id AS VARCHAR) || CASE WHEN doc_id % 3 = 0 THEN '.txt' ELSE '.csv' END AS name FROM documents)")
_MATCH_SQL = f"""WITH {_LIST_SQL}, m AS (
SELECT 0 AS mapping_id, 't_src1' AS topic, name FROM f
  WHERE starts_with(name, 'src1_') AND NOT contains(substr(name, 6), '/') AND suffix(name, '.csv')
UNION ALL SELECT 1, 't_src2', name FROM f WHERE name GLOB 'src2_*_*.csv' AND NOT contains(name, '/') AND suffix(name, '.csv')
UNION ALL SELECT 2, 't_src3', name FROM f WHERE name GLOB 'src3*' AND NOT contains(name, '/') AND suffix(name, '.csv')
  AND (contains(name, '_fr_') OR contains(name, '_de_') OR contains(name, 'src3_'))
UNION ALL SELECT 3, 't_src45', name FROM f
  WHERE ((starts_with(name, 'src4_') AND NOT contains(substr(name, 6), '/'))
      OR (starts_with(name, 'src5_') AND NOT contains(substr(name, 6), '/')))
  AND suffix(name, '.txt') AND (contains(name, 'src4_') OR contains(name, 'src5_')))"""


@query("manifest", f"{_MATCH_SQL}\nSELECT mapping_id, topic, name FROM m")
def manifest(spark, sf_dir):
    """Landed files of one (region, datasource) matched to topics by prefix / glob / pattern list (A1)."""
    t = Tables(spark, sf_dir)
    return MF.discover_files(_listing(t), MAPPINGS, "north", "rates")


@query("manifest_summary", f"""{_MATCH_SQL}
SELECT mapping_id, topic, count(*) AS n_files, min(name) AS first_name, max(name) AS last_name
FROM m GROUP BY mapping_id, topic""")
def manifest_summary(spark, sf_dir):
    """One manifest row per mapping with files: count and first / last name (A2)."""
    t = Tables(spark, sf_dir)
    return MF.manifest_summary(MF.discover_files(_listing(t), MAPPINGS, "north", "rates"))


# ----------------------------------------------------------------------------- D11 / B9

REQUESTS = [("payroll", "asia"), ("payroll", "europe"), ("ledger", "asia"), ("rates", "west"), ("payroll", "nowhere")]


def _routing_text(t: Tables):
    per_region = (t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
                  .groupBy("r_name").agg(F.concat_ws(" , ", F.sort_array(F.collect_list(F.lower("n_name")))).alias("tl")))
    entries = per_region.select(F.concat(F.lit("payroll_"), F.lower(F.regexp_replace("r_name", " ", "")),
                                         F.lit(" : "), F.col("tl")).alias("e"))
    ledger = per_region.where(F.col("r_name") == "EUROPE").select(F.concat(F.lit("ledger_north:"), F.col("tl")).alias("e"))
    empty = per_region.where(F.col("r_name") == "AMERICA").select(F.lit("rates_west:").alias("e"))
    allv = entries.unionByName(ledger).unionByName(empty)
    return allv.agg(F.concat_ws("\n|\t", F.sort_array(F.collect_list("e"))).alias("mapping"))


def _routing(t: Tables):
    from .config import local_frame
    req = local_frame(t.spark, REQUESTS, "datasource string, region string")
    routing = ST.parse_routing(_routing_text(t), "mapping", region_agnostic=["ledger_north", "ledger"])
    return ST.route_staging(routing, req)


_ROUTING_SQL = """m AS (SELECT 'payroll' AS ds, lower(replace(r_name, ' ', '')) AS rg, lower(n_name) AS tbl
      FROM nation JOIN region ON n_regionkey = r_regionkey
    UNION ALL SELECT 'ledger', NULL, lower(n_name) FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'EUROPE'),
req AS (SELECT * FROM (VALUES ('payroll', 'asia'), ('payroll', 'europe'), ('ledger', 'asia'), ('rates', 'west'),
    ('payroll', 'nowhere')) r(datasource, region)),
routed AS (SELECT req.datasource, req.region, m.tbl AS "table" FROM req JOIN m
    ON req.datasource = m.ds AND (m.rg IS NULL OR m.rg = req.region))"""


@query("stage_routing", f"WITH {_ROUTING_SQL}\nSELECT * FROM routed")
def stage_routing(spark, sf_dir):
    """Logical staging tables per (datasource, region) from a ``key:t1,t2|...`` mapping."""
    return _routing(Tables(spark, sf_dir))


def _registry(t: Tables):
    routed = _routing(t)
    old = F.lit((FIXED_NOW - _dt.timedelta(days=5)).isoformat(sep=" ")).cast("timestamp_ntz")
    now = F.lit(FIXED_NOW.isoformat(sep=" ")).cast("timestamp_ntz")
    return (ST.stage_output(routed.where(F.col("region") == "asia"), "2024-01-10", old, 2)
            .unionByName(ST.stage_output(routed.where(F.col("region") != "asia"), RUN_DATE, now, 7)))


@query("staging_expired", f"""WITH {_ROUTING_SQL},
reg AS (SELECT "table" AS logical, "table" || '_temp_2024_01_10_' || strftime(TIMESTAMP '2024-01-10 12:00:00', '%Y%m%d%H%M%S%f') AS physical,
           TIMESTAMP '2024-01-10 12:00:00' + INTERVAL 2 DAY AS expires_at FROM routed WHERE region = 'asia'
        UNION ALL SELECT "table", "table" || '_temp_2024_01_15_' || strftime(TIMESTAMP '2024-01-15 12:00:00', '%Y%m%d%H%M%S%f'),
           TIMESTAMP '2024-01-15 12:00:00' + INTERVAL 7 DAY FROM routed WHERE region <> 'asia')
SELECT * FROM reg WHERE expires_at < TIMESTAMP '2024-01-15 12:00:00'""")
def staging_expired(spark, sf_dir):
    """Run-scoped staging names with an expiry; entries past it are due for purge."""
    t = Tables(spark, sf_dir)
    return ST.expired(_registry(t), F.lit(FIXED_NOW.isoformat(sep=" ")).cast("timestamp_ntz"))


# ----------------------------------------------------------------------------- G7, I9, I8

_RC_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def _edited_orders(t: Tables):
    o = t.orders.select(*_RC_COLS)
    kept = o.where(F.col("o_orderkey") % 11 != 0)
    changed = kept.withColumn("o_orderpriority", F.when(F.col("o_orderkey") % 13 == 0, F.lit("9-CHANGED"))
                              .otherwise(F.col("o_orderpriority")))
    changed = changed.withColumn("o_totalprice", F.when(F.col("o_orderkey") % 19 == 0, F.col("o_totalprice") + 1)
                                 .otherwise(F.col("o_totalprice")))
    dups = o.where(F.col("o_orderkey") % 17 == 0)
    return o, changed.unionByName(dups)


_EDIT_SQL = """a AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders),
b AS (SELECT o_orderkey, o_custkey, o_orderstatus,
        CASE WHEN o_orderkey % 19 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderdate,
        CASE WHEN o_orderkey % 13 = 0 THEN '9-CHANGED' ELSE o_orderpriority END AS o_orderpriority
      FROM a WHERE o_orderkey % 11 <> 0
      UNION ALL SELECT * FROM a WHERE o_orderkey % 17 = 0)"""


@query("tables_reconciled", f"""WITH {_EDIT_SQL}
SELECT *, 'only_in_a' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
UNION ALL SELECT *, 'only_in_b' FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""")
def tables_reconciled(spark, sf_dir):
    """Rows that differ between a table and its moved copy, compared as multisets."""
    a, b = _edited_orders(Tables(spark, sf_dir))
    return CK.reconcile_tables(a, b)


@query("dependencies_missing", """WITH req AS (SELECT DISTINCT n_name AS country, CAST(o_orderdate AS DATE) AS day
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
ld AS (SELECT DISTINCT n_name AS country, CAST(l_shipdate AS DATE) AS day
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)
SELECT * FROM req WHERE NOT EXISTS (SELECT 1 FROM ld WHERE ld.country = req.country AND ld.day = req.day)""")
def dependencies_missing(spark, sf_dir):
    """Required (country, day) inputs of the run that were never loaded."""
    t = Tables(spark, sf_dir)
    req = (t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
           .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
           .select(F.col("n_name").alias("country"), F.to_date("o_orderdate").alias("day")))
    ld = (t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
          .join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
          .select(F.col("n_name").alias("country"), F.to_date("l_shipdate").alias("day")))
    return CK.check_dependencies(req, ld, ["country", "day"])


EXPECTED_LINEITEM = T.StructType([
    T.StructField("l_orderkey", T.LongType()), T.StructField("l_partkey", T.LongType()),
    T.StructField("l_suppkey", T.LongType()), T.StructField("l_linenumber", T.LongType()),
    T.StructField("l_quantity", T.DoubleType()), T.StructField("l_extendedprice", T.DoubleType()),
    T.StructField("l_discount", T.DoubleType()), T.StructField("l_returnflag", T.StringType()),
    T.StructField("l_linestatus", T.StringType()), T.StructField("l_shipdate", T.DateType()),
    T.StructField("l_comment", T.StringType()),
])


def _expected_values_sql() -> str:
    rows = ", ".join(f"('{f.name}', '{f.dataType.simpleString()}')" for f in EXPECTED_LINEITEM.fields)
    return f"(VALUES {rows}) AS e(c, t)"


_TRY = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE"}
_HELD = [(c, t) for c, t in [("l_linenumber", "bigint"), ("l_shipdate", "date"), ("l_tax", None)]]

SCHEMA_DIFF_SQL = f"""WITH actual AS (SELECT column_name AS c, CASE column_type WHEN 'BIGINT' THEN 'bigint'
    WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string'
    WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'DATE' THEN 'date' WHEN 'FLOAT' THEN 'float'
    WHEN 'BOOLEAN' THEN 'boolean' ELSE lower(column_type) END AS t FROM (DESCRIBE lineitem)),
expected AS (SELECT * FROM {_expected_values_sql()}),
diff AS (SELECT e.c AS "column", e.t AS expected, CAST(NULL AS VARCHAR) AS actual, 'missing' AS problem
  FROM expected e WHERE e.c NOT IN (SELECT c FROM actual)
UNION ALL SELECT e.c, e.t, a.t, 'type' FROM expected e JOIN actual a ON e.c = a.c WHERE e.t <> a.t
UNION ALL SELECT a.c, CAST(NULL AS VARCHAR), a.t, 'unexpected' FROM actual a WHERE a.c NOT IN (SELECT c FROM expected)),
held AS ({" UNION ALL ".join(f"SELECT '{c}' AS c, count({c}) AS n_values, " + (f"count_if({c} IS NOT NULL AND TRY_CAST({c} AS {_TRY[t]}) IS NULL)" if t else "CAST(NULL AS BIGINT)") + " AS n_lost FROM lineitem" for c, t in _HELD)})
SELECT diff.*, CAST(n_values AS BIGINT) AS n_values, CAST(n_lost AS BIGINT) AS n_lost FROM diff LEFT JOIN held ON c = "column\""""


@query("schema_diff", SCHEMA_DIFF_SQL)
def schema_diff(spark, sf_dir):
    """Differences between lineitem's schema and its expected schema document, with the values they touch (I8)."""
    t = Tables(spark, sf_dir)
    return CK.check_schema(spark, t.lineitem, EXPECTED_LINEITEM.json())


# ----------------------------------------------------------------------------- C12

TEMPLATE = ("SELECT {params.status_col} AS status, count(*) AS n, "
            "CAST(sum(CAST(o_totalprice AS DECIMAL(15,2))) AS DECIMAL(18,2)) AS total FROM {tables.orders} "
            "WHERE o_orderdate >= :start AND o_orderpriority <> '@placeholder_countrykey' "
            "GROUP BY {params.status_col}")
TEMPLATE_CONFIG = {"tables": {"orders": "{views.orders}"}, "views": {"orders": "ll_orders_src"},
                   "params": {"status_col": "o_orderstatus"}}


@query("sql_template", """SELECT o_orderstatus AS status, count(*) AS n,
  CAST(sum(CAST(o_totalprice AS DECIMAL(15,2))) AS DECIMAL(18,2)) AS total
FROM orders WHERE o_orderdate >= DATE '1997-01-01' AND o_orderpriority <> '5-LOW' GROUP BY o_orderstatus""")
def sql_template(spark, sf_dir):
    """A templated SQL job: nested config lookups, environment replacements, placeholders, named args."""
    t = Tables(spark, sf_dir)
    t.orders.createOrReplaceTempView("ll_orders_src")
    return param_sql(spark, TEMPLATE, TEMPLATE_CONFIG, args={"start": _dt.date(1997, 1, 1)},
                     replacements="DEV,o_totalprice,0;PROD,count(*),0", environment="TEST", country_key="5-LOW")


# ----------------------------------------------------------------------------- L2

def reverse_words():
    """User transform script over a file's lines: composed characters (NFC), words in reverse order.

    Returns the batch function; it is defined locally so that it ships to the Python workers by
    value and does not need this package importable there.
    """
    def run(batches):
        for pdf in batches:
            pdf["line"] = pdf["line"].str.normalize("NFC").str.split(" ").str[::-1].str.join(" ")
            yield pdf
    return run


def transform_lines(df, fn, schema: str):
    """Run a user line transform over Arrow batches (``mapInPandas``); Spark partitions the work (L2)."""
    return df.mapInPandas(fn, schema=schema)


@query("transform_lines", """WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
    CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS INTEGER) AS line_no FROM documents)
SELECT doc_id, line_no, array_to_string(list_reverse(string_split(nfc_normalize(line), ' ')), ' ') AS line FROM l""")
def transform_lines_q(spark, sf_dir):
    """Every line of every document through a user transform in Arrow batches (L2)."""
    t = Tables(spark, sf_dir)
    lines = t.documents.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    return transform_lines(lines, reverse_words(), "doc_id long, line_no int, line string")


# ----------------------------------------------------------------------------- K1

@query("landing_stream", "SELECT * FROM events")
def landing_stream(spark, sf_dir):
    """Landed events file streamed once (availableNow) into an append-only landing table (K1)."""
    t = Tables(spark, sf_dir)
    base = scratch_path(spark, "landing")
    LD.stream_landing(spark, sf_dir, t.events.schema, f"{base}/sink", f"{base}/checkpoint",
                      glob="events.parquet", ingest_ts=FIXED_NOW.isoformat(sep=" "))
    return LD.read_landed(spark, f"{base}/sink").drop("rawingestiondttm", "_batch_id")


# ----------------------------------------------------------------------------- B2 / B3 / B4 / B5 / B7 / A3 / A5 / A6 / I7

@query("history_written", QH.HISTORY_REPLACE_SQL)
def history_written(spark, sf_dir):
    """History on disk partitioned by createddttm; a rerun rewrites only the run date's partition (B2 sink)."""
    t = Tables(spark, sf_dir)
    path = scratch_path(spark, "history")
    QH._prior_history(t).write.partitionBy("createddttm").parquet(path)
    touched = [RUN_DATE]
    current = SK.read_partitions(spark, path, "createddttm", touched)
    nxt = H.snapshot_to_history(QH._raw(t), current, RUN_DATE, "country_raw", QH._countries(t), alias=QH._alias(t))
    SK.swap_partitions(spark, path, nxt, "createddttm", touched)
    return spark.read.parquet(path).select("c_custkey", "c_name", "c_mktsegment", "country_raw", "createddttm")


ORDERS_SCHEMA = json.dumps({"type": "struct", "fields": [
    {"name": "o_orderkey", "type": "long", "nullable": True, "metadata": {}},
    {"name": "o_custkey", "type": "long", "nullable": True, "metadata": {}},
    {"name": "o_orderstatus", "type": "string", "nullable": True, "metadata": {}},
    {"name": "o_totalprice", "type": "double", "nullable": True, "metadata": {}},
    {"name": "o_orderdate", "type": "timestamp_ntz", "nullable": True, "metadata": {}},
    {"name": "o_orderpriority", "type": "string", "nullable": True, "metadata": {}}]})


@query("export_reload", "SELECT * FROM orders")
def export_reload(spark, sf_dir):
    """Export a table as headed CSV and load it back with an explicit schema document (B4 + A3)."""
    t = Tables(spark, sf_dir)
    path = scratch_path(spark, "export")
    SK.export_table(t.orders, path, fmt="csv", header=True)
    return SRC.load_delimited(spark, path, ORDERS_SCHEMA, header=True)


@query("records_roundtrip", f"{QR.VIOLATIONS_CTE}\nSELECT line FROM lines")
def records_roundtrip(spark, sf_dir):
    """Record lines written as ordered parts and read back."""
    t = Tables(spark, sf_dir)
    base = scratch_path(spark, "records")
    lines = QR._lines(t)
    SK.write_records(lines, f"{base}/parts", order=[F.col("l_orderkey"), F.col("l_linenumber")])
    return SRC.read_records(spark, f"{base}/parts").select("line")


@query("dated_view_read", """SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'O'""")
def dated_view_read(spark, sf_dir):
    """Publish a dated output view and read it back ordered (I7 + A6)."""
    t = Tables(spark, sf_dir)
    SRC.publish_view(t.orders.where(F.col("o_orderstatus") == "O").select("o_orderkey", "o_custkey", "o_totalprice"),
                     "ll_orders_open", RUN_DATE)
    return SRC.read_dated_view(spark, "ll_orders_open", RUN_DATE, order_by="o_orderkey")

