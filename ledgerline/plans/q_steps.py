"""Registered queries: imports, appends, truncation, layouts and file configurations, user steps, per-source file
checks, gates over several components, and the threshold's edge cases."""

from __future__ import annotations

import datetime as _dt
import json

from pyspark.sql import functions as F

from ..functions.dates import effective_date, month_start
from ..functions.text import log_fields, sql_text
from ..operators import checks as CK
from ..operators import history as H
from ..operators import records as RC
from ..operators import render as RD
from ..operators import rules as R
from ..operators import thresholds as TH
from ..session import scratch_path
from ..sinks import tables as SK
from ..sources import files as SRC
from . import config as C
from . import q_files as QF
from . import q_history as QH
from . import q_records as QR
from . import q_rules as QRL
from .registry import query
from .sql_template import run_step
from .tables import FIXED_NOW, ORCHESTRATOR, PRIOR_DATE, RUN_DATE, SOURCE, Tables

# ----------------------------------------------------------------------------- A4, B1, A8, C10, B10, B4, B8

@query("tables_imported", """SELECT 'orders' AS target, o.*, NULL::BIGINT AS c_custkey, NULL::VARCHAR AS c_name, NULL::INTEGER AS c_nationkey,
  NULL::DOUBLE AS c_acctbal, NULL::VARCHAR AS c_mktsegment FROM orders o
UNION ALL SELECT 'customer', NULL, NULL, NULL, NULL, NULL, NULL, c.* FROM customer c""")
def tables_imported(spark, sf_dir):
    """Several delimited folders loaded into several tables by one call, read back from the targets (A4)."""
    t = Tables(spark, sf_dir)
    base = scratch_path(spark, "import")
    tables = {"orders": t.orders, "customer": t.customer}
    for name, df in tables.items():
        SK.export_table(df, f"{base}/in/{name}", header=True)
    out = SRC.import_tables(spark, {n: (f"{base}/in/{n}", df.schema) for n, df in tables.items()}, f"{base}/tables")
    o, c = spark.read.parquet(out["orders"]), spark.read.parquet(out["customer"])
    return (o.withColumn("target", F.lit("orders")).unionByName(c.withColumn("target", F.lit("customer")), allowMissingColumns=True))


@query("table_appended", """SELECT * FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT * REPLACE (CAST(NULL AS VARCHAR) AS o_orderpriority) FROM orders WHERE o_orderstatus <> 'F'""")
def table_appended(spark, sf_dir):
    """Rows appended by name onto a table's schema: other order, one column absent, one too many."""
    t = Tables(spark, sf_dir)
    path = scratch_path(spark, "append")
    t.orders.where(F.col("o_orderstatus") == "F").write.parquet(path)
    target = spark.read.parquet(path)
    incoming = t.orders.where(F.col("o_orderstatus") != "F").select(
        F.lit("x").alias("extra"), *[c for c in reversed(t.orders.columns) if c != "o_orderpriority"])
    SK.append_table(incoming, path, target.schema)
    return spark.read.parquet(path)


_SUPP_COLS = ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"]  # all of them


@query("all_columns_logged", "SELECT s_suppkey, 'Supplier;' || " + " || '|' || ".join(
    f"'{c}:' || {QRL._lf(c)}" for c in _SUPP_COLS) + " AS entry FROM supplier")
def all_columns_logged(spark, sf_dir):
    """Log text over a table's live column list, as for a rule without configured fields."""
    s = Tables(spark, sf_dir).supplier
    return s.select("s_suppkey", log_fields("Supplier", CK.table_columns(s)).alias("entry"))


@query("table_truncated", "SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_acctbal > 0")
def table_truncated(spark, sf_dir):
    """A partitioned table emptied before a fresh load, then loaded again partition by partition."""
    t = Tables(spark, sf_dir)
    path = scratch_path(spark, "truncate")
    rows = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    rows.write.partitionBy("c_mktsegment").parquet(path)
    SK.truncate_source(spark, [path])
    fresh = t.customer.where(F.col("c_acctbal") > 0).select(*rows.columns)
    fresh.write.mode("append").partitionBy("c_mktsegment").parquet(path)
    return spark.read.parquet(path).select(*rows.columns)


@query("export_single_date", f"""WITH {QH._SQL_RAW}
SELECT c_custkey, c_name, c_mktsegment, country_raw FROM hist WHERE createddttm = DATE '{PRIOR_DATE}'""")
def export_single_date(spark, sf_dir):
    """One date of a history table exported without header and read back by its schema."""
    t = Tables(spark, sf_dir)
    path = scratch_path(spark, "export-date")
    hist = QH._prior_history(t)
    SK.export_table(hist, path, date_col="createddttm", run_date=PRIOR_DATE)
    back = SRC.load_delimited(spark, path, hist.schema.json(), header=False)
    return back.select("c_custkey", "c_name", "c_mktsegment", "country_raw")


_STATUSES = ["F", "O", "P", "none"]


@query("required_files", "SELECT s AS status, count(o_orderkey) AS n_lines, count(o_orderkey) = 0 AS made_empty FROM (VALUES "
       + ", ".join(f"('{s}')" for s in _STATUSES) + ") v(s) LEFT JOIN orders ON o_orderstatus = s GROUP BY s")
def required_files(spark, sf_dir):
    """One file per status; a status without rows still gets its required, empty file."""
    t = Tables(spark, sf_dir)
    base = scratch_path(spark, "required")
    out = None
    for s in _STATUSES:
        lines = t.orders.where(F.col("o_orderstatus") == s).select(F.col("o_orderkey").cast("string").alias("line"))
        made = SK.ensure_file(lines, f"{base}/{s}", True)
        if not made:
            SK.write_records(lines, f"{base}/{s}")
        row = spark.read.text(f"{base}/{s}").agg(F.count(F.lit(1)).alias("n_lines")).select(
            F.lit(s).alias("status"), "n_lines", F.lit(made).alias("made_empty"))
        out = row if out is None else out.unionByName(row)
    return out


# ----------------------------------------------------------------------------- C2

@query("stamped_effective_date", f"""WITH {QH._SQL_RAW}
SELECT c_custkey, country_raw, d AS createddttm FROM raw, (VALUES (DATE '{RUN_DATE}'), (DATE '{PRIOR_DATE}')) v(d)
WHERE country_raw IN (SELECT n_name FROM cty)""")
def stamped_effective_date(spark, sf_dir):
    """Raw rows stamped by a mocked run (today's date, given) and by a run that asks for a date."""
    t = Tables(spark, sf_dir)
    raw, countries = QH._raw(t), QH._countries(t)
    dates = (effective_date("2001-01-01", True, _dt.date.fromisoformat(RUN_DATE)), effective_date(PRIOR_DATE, False))
    a, b = (H.stamp_snapshot(raw, d, "country_raw", countries).select("c_custkey", "country_raw", "createddttm")
            for d in dates)
    return a.unionByName(b)


# ----------------------------------------------------------------------------- A10, A11, J2 in the configured order

@query("file_configs_scope", """SELECT n_name AS "Country", 'PAY_' || n_name AS "FileName"
FROM nation JOIN region ON n_regionkey = r_regionkey
WHERE r_name = 'ASIA' AND n_name IN ('NATION_7', 'NATION_12', 'NATION_8')""")
def file_configs_scope(spark, sf_dir):
    """File configurations of a run: region, source and date, a country list in any case, a component (A10)."""
    t = Tables(spark, sf_dir)
    cfg = SRC.file_configs(QF._file_configs(t), "ASIA", SOURCE, RUN_DATE, countries=" nation_7,NATION_12, Nation_8,",
                           component="core")
    return cfg.select("Country", "FileName")


@query("layout_body_ordered", f"""WITH {QF._BASE_SQL}
SELECT n_name, view_rank, block, CASE WHEN order_key IS NULL THEN NULL ELSE (SELECT CASE WHEN o.o_orderkey % 50 = 0
    THEN NULL ELSE o.o_orderpriority END FROM orders o WHERE o.o_orderkey = order_key) END AS key_priority,
  order_key AS key_order, line FROM body""")
def layout_body_ordered(spark, sf_dir):
    """Bodies through layouts read from stored documents, ordered by a text and a number column."""
    t = Tables(spark, sf_dir)
    base, path = QF._base(t), scratch_path(spark, "layouts")
    layouts = []
    for i, doc in enumerate((QF.LAYOUT_OPEN, QF.LAYOUT_OTHER)):
        spark.createDataFrame([(json.dumps(doc),)], "value string").coalesce(1).write.text(f"{path}/{i}")
        layouts.append(SRC.read_layout(spark, f"{path}/{i}"))
    views = [base.where(F.col("Status") == "O"), base.where(F.col("Status") != "O")]
    body = RD.render_body(t.nation.select("n_name"), views, layouts, "n_name", "Priority, o_orderkey",
                          {"GetPeriodStartDate": month_start(RUN_DATE)})
    return body.select("n_name", "view_rank", "block", F.col("order_key.Priority").alias("key_priority"),
                       F.col("order_key.o_orderkey").alias("key_order"), "line")


# ----------------------------------------------------------------------------- L3

def _segment_balances(customers, least: float):
    """User step: rich customers per segment."""
    return (customers.where(F.col("c_acctbal") >= least).groupBy(F.col("c_mktsegment").alias("name"))
            .agg(F.count(F.lit(1)).alias("n")))


@query("user_steps", """SELECT c_mktsegment AS name, count(*) AS n FROM customer WHERE c_acctbal >= 5000 GROUP BY 1
UNION ALL SELECT o_orderstatus, count(*) FROM orders GROUP BY 1""")
def user_steps(spark, sf_dir):
    """The two kinds of user step: a callable over a table, and a SQL template (L3)."""
    t = Tables(spark, sf_dir)
    t.orders.createOrReplaceTempView("ll_orders_src")
    own = run_step(spark, _segment_balances, t.customer, {"least": 5000.0})
    sql = run_step(spark, "SELECT {col} AS name, count(*) AS n FROM ll_orders_src GROUP BY {col}",
                   config={"col": "o_orderstatus"})
    return own.unionByName(sql)


# ----------------------------------------------------------------------------- H11, I5

@query("record_unknown_rules", f"""WITH {QR._LINES_SQL}
SELECT 'A' AS record_type, 'LENGTHCHECK' AS operator, '3' AS object_field,
  (SELECT count(*) FROM p WHERE record_type = 'A') AS n_unchecked""")
def record_unknown_rules(spark, sf_dir):
    """Rules whose operator has no check, with the records they leave unchecked."""
    t = Tables(spark, sf_dir)
    return RC.unknown_rule_report(QR._lines(t), QR._compiled(t))


_OTHER_SPECS = [s for s in QR.RECORD_SPECS if s["Operator"].upper() in ("DATEFORMAT", "HOURSFORMAT")] + [
    dict(ObjectName=QR._OBJ, Operator="BASELINEQUERY", ErrorCode="E001",
         ObjectFieldValue="SELECT COUNT(*) AS n FROM ll_lines_<COUNTRY_PLACEHOLDER>_datasource_suffix")]


@query("record_send_other_source", f"""{QR.VIOLATIONS_CTE},
agg AS (SELECT (SELECT count(*) FROM lines) AS baseline,
  (SELECT count(*) FROM viol WHERE operator IN ('DATEFORMAT', 'HOURSFORMAT') AND type = 'Error') AS stagefailure,
  abs((SELECT count(*) FROM lines WHERE trim(line) <> '') - (SELECT count(*) FROM lineitem WHERE l_linestatus = 'F'))
    AS g2vsviewcountfailure),
t AS (SELECT *, stagefailure + g2vsviewcountfailure AS totalfailure FROM agg),
pc AS (SELECT *, CASE WHEN baseline = 0 OR totalfailure = 0 THEN 0.0
  ELSE round_even(totalfailure / baseline * 100.0, 2) END AS errorpercentage FROM t)
SELECT stagefailure, CAST(g2vsviewcountfailure AS BIGINT) AS g2vsviewcountfailure,
  CAST(totalfailure AS BIGINT) AS totalfailure, CAST(5.0 AS DOUBLE) AS thresholdpercentage, errorpercentage,
  CASE WHEN errorpercentage = 0 THEN 'Success' WHEN errorpercentage > 5 THEN 'Failure' ELSE 'Partial' END AS status
FROM pc""")
def record_send_other_source(spark, sf_dir):
    """The file check of another data source: the same operator under its own rule set, view and threshold."""
    from ..operators.send import send_check
    t = Tables(spark, sf_dir)
    res = send_check(spark, QR._stored_lines(t), QR._compiled(t, _OTHER_SPECS), RC.References(QR.RUN_COUNTRY),
                     [t.lineitem.where(F.col("l_linestatus") == "F")], None, QF._stage_map(spark),
                     orchestrator_id=ORCHESTRATOR, stage="dag06", region=QR.REGION_LC, country=QR.RUN_COUNTRY,
                     source="rates", component="core", vendor=QR.VENDOR, objectname="other.csv", run_date=RUN_DATE,
                     threshold="5", now=FIXED_NOW)
    return res.summary.select("stagefailure", "g2vsviewcountfailure", "totalfailure", "thresholdpercentage",
                              "errorpercentage", "status")


# ----------------------------------------------------------------------------- D3, E12, I6 by component

@query("component_gate_run", f"""WITH seg AS (SELECT DISTINCT c_mktsegment AS comp FROM customer
    JOIN nation ON c_nationkey = n_nationkey WHERE n_name IN {QRL._ASIA})
{QRL._log_select("n_name", "", "customer_history", "High", "Error",
                 QRL._desc("Quantity above limit", ["c_custkey", "c_mktsegment"]), "c_acctbal", "Check balance")
    .replace("'' AS sourcecomponent", "c_mktsegment AS sourcecomponent")}
FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE c_acctbal < 1000 AND n_name IN {QRL._ASIA} AND c_mktsegment IN (SELECT comp FROM seg)
  AND (n_nationkey + length(c_mktsegment)) % 3 <> 0""")
def component_gate_run(spark, sf_dir):
    """A region run over every component whose gate flags differ by (country, component)."""
    t = Tables(spark, sf_dir)
    countries = C.run_countries(t)
    execs = (t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
             .where(F.col("n_name").isin(countries)))
    comps = sorted(r.component for r in R.distinct_components(
        execs.select(F.col("c_mktsegment").alias("component")), by_country=False).toLocalIterator())
    specs = [dict(Stage="dag05", ObjectType="table", ObjectName="customer_history", ObjectField="c_acctbal",
                  AdditionalCondition="c_acctbal < 1000 AND c_mktsegment = " + sql_text(c), ErrorCode="E001",
                  Recommendation="Check balance", SeverityID="S1", FieldsCode="F9", CountryKeyField="n_name",
                  Component=c) for c in comps]
    flags = execs.select(
        F.col("n_name").alias("Country"), F.col("c_mktsegment").alias("Component"),
        F.when((F.col("n_nationkey") + F.length("c_mktsegment")) % 3 == 0, F.lit("Y")).otherwise(F.lit("N"))
        .alias("Is_Threshold_Exceeded")).distinct()
    ctx = QRL._ctx()
    rules = R.resolve_rules(C.rules_config(t, specs), C.error_map(spark), C.severity_map(spark),
                            C.fields_map(spark, [("F9", "c_custkey,c_mktsegment")]), C.vendor_region(spark), ctx,
                            countries, components=comps)
    res = R.access_check(rules, {"customer_history": QRL._customer_history(t)}, ctx, R.empty_log(spark), countries,
                         flags, components=comps)
    if res.problems:
        raise RuntimeError(f"rule problems: {res.problems}")
    return res.log.select(*QRL.LOG_OUT)


# ----------------------------------------------------------------------------- I1 on views, duplicated rules

_VIEW_RULES = [
    ("dag05", "view", "orders_<COUNTRY_PLACEHOLDER>", "o_totalprice", "o_totalprice > 300000", "E001",
     "Ask <COUNTRY_PLACEHOLDER>", "S1", "F5", "", "", "vend1", "core", True),
]


@query("rules_view", QRL._log_select(
    "n_name", "core", "", "High", "Error", QRL._desc("Quantity above limit", ["o_orderkey", "o_orderstatus"]),
    "o_totalprice", "")
    .replace("'' AS objectname", f"'orders_' || lower(n_name) || '_{RUN_DATE.replace('-', '_')}' AS objectname")
    .replace("'' AS recommendation", "'Ask ' || n_name AS recommendation")
    + f""" FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE o_totalprice > 300000 AND n_name IN {QRL._ASIA}""")
def rules_view(spark, sf_dir):
    """Rules on the dated output views of all countries, one scan of their base, the country bound in the texts."""
    t = Tables(spark, sf_dir)
    ctx = QRL._ctx()
    base = (t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
            .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")))
    family = R.ViewFamily(base, "n_name")
    log, problems = R.evaluate_rules(QRL._rules(t, ctx, _VIEW_RULES), spark.table, ctx,
                                     families={"orders_<COUNTRY_PLACEHOLDER>": family})
    if problems:
        raise RuntimeError(f"rule problems: {problems}")
    return log.select(*QRL.LOG_OUT)


@query("rules_duplicate_vendor", f"""WITH twice AS (SELECT unnest([1, 2]) AS i)
{QRL._log_select("n_name", "core", "lineitem_history", "High", "Error",
                 QRL._desc("Quantity above limit", QRL._F1), "l_quantity", "Check quantity")}
FROM {QRL._OBJ}, twice WHERE l_quantity > 45 AND n_name IN {QRL._ASIA}""")
def rules_duplicate_vendor(spark, sf_dir):
    """A rule that its vendor's region mapping fans out twice reports twice."""
    t = Tables(spark, sf_dir)
    ctx = QRL._ctx()
    vendors = C.local_frame(spark, [*C.VENDOR_REGION, ("vend1", "ASIA")], "Vendor string, Region string")
    rules = R.resolve_rules(C.table_rules_config(t, C.TABLE_RULES[:1]), C.error_map(spark), C.severity_map(spark),
                            C.fields_map(spark), vendors, ctx, C.run_countries(t))
    log, problems = R.evaluate_rules(rules, {"lineitem_history": C.lineitem_history(t)}, ctx)
    if problems:
        raise RuntimeError(f"rule problems: {problems}")
    return log.select(*QRL.LOG_OUT)


# ----------------------------------------------------------------------------- E6-E8 at the edges

@query("threshold_edges", """WITH f AS (SELECT n_name AS country, n_nationkey AS k, count(*) AS failures
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    WHERE o_totalprice > 200000 GROUP BY 1, 2),
s AS (SELECT country, CASE WHEN k % 5 IN (0, 1) THEN 0 ELSE 4 * failures END AS baseline, failures AS stagefailure,
    CASE WHEN k % 5 = 3 THEN 24.99 WHEN k % 5 = 4 THEN 0.0 ELSE 25.0 END AS thresholdpercentage FROM f)
SELECT country, CAST(baseline AS BIGINT) AS baseline, stagefailure, CAST(thresholdpercentage AS DOUBLE) AS thresholdpercentage,
  CASE WHEN baseline = 0 THEN 0.0 ELSE 25.0 END::DOUBLE AS errorpercentage,
  CASE WHEN baseline = 0 THEN 'Success' WHEN 25.0 > thresholdpercentage THEN 'Failure' ELSE 'Partial' END AS status FROM s""")
def threshold_edges(spark, sf_dir):
    """Summary rows for a baseline of zero, no baseline row, an exact tie and an empty threshold."""
    t = Tables(spark, sf_dir)
    k = F.col("n_nationkey")
    fails = (t.orders.where(F.col("o_totalprice") > 200000).join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
             .join(t.nation, F.col("c_nationkey") == k)
             .groupBy(F.col("n_name").alias("country"), k).agg(F.count(F.lit(1)).alias("stagefailure")))
    baseline = fails.where(k % 5 != 1).select(
        "country", F.when(k % 5 == 0, F.lit(0)).otherwise(F.col("stagefailure") * 4).cast("long").alias("baseline"))
    limits = t.nation.select(F.col("n_name").alias("country"), F.when(k % 5 == 3, F.lit("24.99"))
                             .when(k % 5 == 4, F.lit(" ")).otherwise(F.lit("25")).alias("threshold"))
    return TH.summary_rows(baseline, fails.select("country", "stagefailure"), None, limits, ["country"]).select(
        "country", "baseline", "stagefailure", "thresholdpercentage", "errorpercentage", "status")
