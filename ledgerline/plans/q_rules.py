"""Registered queries: table/view rule evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import sql_text
from ..operators import rules as R
from . import config as C
from .registry import query
from .tables import FIXED_NOW, ORCHESTRATOR, RUN_DATE, RUN_REGION, SOURCE, Tables

LOG_OUT = ["orchestratorid", "stage", "region", "country", "source", "sourcecomponent", "objectname",
           "errorseverity", "type", "errordescription", "erroridentifier", "createddttm", "recommendation"]


def _ctx(stage="dag05", component=""):
    return R.RunContext(ORCHESTRATOR, stage, RUN_REGION, SOURCE, RUN_DATE, component=component, now=FIXED_NOW)


def _rules(t: Tables, ctx, templates=C.TABLE_RULES, countries=None):
    sp = t.spark
    clist = ",".join(countries) if countries is not None else None
    return R.resolve_rules(C.table_rules_config(t, templates, clist), C.error_map(sp), C.severity_map(sp),
                           C.fields_map(sp), C.vendor_region(sp), ctx,
                           countries if countries is not None else C.run_countries(t))


_ASIA = "(SELECT n_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA')"
_OBJ = ("(SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey "
        "JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)")


def _lf(col):
    return f"replace(coalesce(CAST({col} AS VARCHAR), 'null'), ',', '')"


def _desc(desc, cols):
    # labels are the configured entries verbatim; values read the trimmed column
    parts = " || '|' || ".join(f"'{c}:' || {_lf(c.strip())}" for c in cols)
    return f"'{desc};' || {parts}"


def _log_select(country, comp, obj, sev, typ, desc_sql, ident, rec, stage="dag05"):
    return (f"SELECT '{ORCHESTRATOR}' AS orchestratorid, '{stage}' AS stage, '{RUN_REGION}' AS region, "
            f"{country} AS country, '{SOURCE}' AS source, '{comp}' AS sourcecomponent, '{obj}' AS objectname, "
            f"'{sev}' AS errorseverity, '{typ}' AS type, {desc_sql} AS errordescription, "
            f"'{ident}' AS erroridentifier, DATE '{RUN_DATE}' AS createddttm, '{rec}' AS recommendation")


_F1 = ["l_orderkey", "l_linenumber"]
_F2 = ["l_orderkey", " l_linenumber", "l_returnflag", "o_orderstatus"]   # as configured: "l_orderkey, l_linenumber,..."
_F3 = ["l_orderkey", "l_linenumber", "l_shipdate"]

RULES_TABLE_VIOLATIONS_SQL = "\nUNION ALL\n".join([
    _log_select("n_name", "core", "lineitem_history", "High", "Error", _desc("Quantity above limit", _F1),
                "l_quantity", "Check quantity") + f" FROM {_OBJ} WHERE (l_quantity > 45) AND n_name IN {_ASIA}",
    _log_select("n_name", "core", "lineitem_history", "Low", "Warning", _desc("Discount above limit", _F1),
                "l_discount", "Check discount") + f" FROM {_OBJ} WHERE (l_discount >= 0.09) AND n_name IN {_ASIA}",
    _log_select("n_name", "core", "lineitem_history", "High", "Error", _desc("Return flag against status", _F2),
                "l_returnflag", "Check flag and status")
    + f" FROM {_OBJ} WHERE (l_returnflag = 'R' OR o_orderstatus = 'P') AND n_name IN {_ASIA}",
    _log_select("n_name", "core", "lineitem_history", "Low", "Error", _desc("Shipped before order window", _F3),
                "l_shipdate", "Check ship date")
    + f" FROM {_OBJ} WHERE (l_shipdate < o_orderdate + INTERVAL 30 DAYS) AND n_name IN {_ASIA}",
])


@query("rules_table_violations", RULES_TABLE_VIOLATIONS_SQL)
def rules_table_violations(spark, sf_dir):
    """Flagship: resolve rules, evaluate all rules of the history object in one scan."""
    t = Tables(spark, sf_dir)
    ctx = _ctx()
    rules = _rules(t, ctx)
    log, problems = R.evaluate_rules(rules, {"lineitem_history": C.lineitem_history(t)}, ctx)
    if problems:
        raise RuntimeError(f"rule problems: {problems}")
    return log.select(*LOG_OUT)


# --------------------------------------------------------------------------- D1 / D2 / G1

DAG06_SPECS = [
    dict(ObjectName="vend1/<REGION_PLACEHOLDER>/payfile_<COUNTRY_PLACEHOLDER>", ObjectField="1",
         Operator="NOTIN", ObjectFieldValue="['1','2']", AdditionalCondition="A", ErrorCode="E001",
         FieldsCode="F1"),
    dict(ObjectName="vend1/<REGION_PLACEHOLDER>/payfile_<COUNTRY_PLACEHOLDER>", ObjectField="2",
         Operator="DATEFORMAT", ObjectFieldValue=r"^\d{4}\d{2}\d{2}$", AdditionalCondition="N",
         ErrorCode="E005", SeverityID="S2", FieldsCode="F3"),
    dict(ObjectName="vend1/<REGION_PLACEHOLDER>/payfile_<COUNTRY_PLACEHOLDER>", Operator="BASELINEQUERY",
         ObjectFieldValue="SELECT COUNT(*) FROM lines", ErrorCode="E001"),
    dict(ObjectName="vend1/<REGION_PLACEHOLDER>/payfile_<COUNTRY_PLACEHOLDER>", Operator="BASELINEQUERY",
         ObjectFieldValue="SELECT COUNT(*) FROM other", ErrorCode="E999", Vendor="vend3"),
    dict(ObjectName="skipped_inactive", Operator="IN", IsActive=False),
    dict(ObjectName="skipped_component", Operator="IN", Component="other"),
    dict(ObjectName="skipped_vendor", Operator="IN", Vendor="vend2"),
]


def _values_sql(specs):
    cols = [f.name for f in C.CONFIG_SCHEMA.fields if f.name != "Country"]
    rows = []
    for spec in specs:
        d = dict(C.RULE_DEFAULTS, **spec)
        vals = []
        for c in cols:
            v = d[c]
            vals.append(("TRUE" if v else "FALSE") if isinstance(v, bool) else "'" + str(v).replace("'", "''") + "'")
        rows.append("(" + ", ".join(vals) + ")")
    return f"(VALUES {', '.join(rows)}) AS cfg({', '.join(cols)})"


def _map_values(rows, cols):
    body = ", ".join("(" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS m({', '.join(cols)})"


RULES_RESOLVED_SQL = f"""WITH cfg AS (SELECT (SELECT string_agg(n_name, ',' ORDER BY n_name) FROM nation) AS Country, *
    FROM {_values_sql(DAG06_SPECS)}),
err AS (SELECT * FROM {_map_values(C.ERROR_MAP, ['code', 'Description', 'Type'])}),
sev AS (SELECT * FROM {_map_values(C.SEVERITY_MAP, ['SeverityID', 'SeverityDescription'])}),
fm AS (SELECT * FROM {_map_values(C.FIELDS_MAP, ['FieldsCode', 'LogFields'])}),
vr AS (SELECT * FROM {_map_values(C.VENDOR_REGION, ['Vendor', 'Region'])}),
base AS (SELECT * FROM cfg WHERE Source = '{SOURCE}' AND Stage = 'dag06' AND IsActive AND Component = 'core'),
allr AS (
  SELECT b.Country, b.Stage, b.ObjectType, b.ObjectName, b.ObjectField, b.Operator, b.ObjectFieldValue,
         b.AdditionalCondition, b.ErrorCode, b.Recommendation, err.Description AS ErrorDescription,
         sev.SeverityDescription AS ErrorSeverity, err.Type AS Type, fm.LogFields AS AdditionalFields,
         b.CountryKeyField, b.FileIngestionCondition, b.Vendor, b.Component
  FROM base b JOIN err ON b.ErrorCode = err.code JOIN sev ON b.SeverityID = sev.SeverityID
  JOIN fm ON b.FieldsCode = fm.FieldsCode JOIN vr ON b.Vendor = vr.Vendor WHERE vr.Region = '{RUN_REGION}'
  UNION ALL
  SELECT b.Country, b.Stage, b.ObjectType, b.ObjectName, b.ObjectField, b.Operator, b.ObjectFieldValue,
         b.AdditionalCondition, b.ErrorCode, b.Recommendation, '', '', '', '', '', '', b.Vendor, b.Component
  FROM base b JOIN vr ON b.Vendor = vr.Vendor WHERE vr.Region = '{RUN_REGION}' AND b.Operator = 'BASELINEQUERY')
SELECT c AS Country, Stage, ObjectType, ObjectName, ObjectField, Operator, ObjectFieldValue, AdditionalCondition,
       ErrorCode, Recommendation, ErrorDescription, ErrorSeverity, Type, AdditionalFields, CountryKeyField,
       FileIngestionCondition, Vendor, Component
FROM (SELECT *, unnest(string_split(Country, ',')) AS c FROM allr)
WHERE c IN (SELECT n_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = '{RUN_REGION}')"""


@query("rules_resolved", RULES_RESOLVED_SQL)
def rules_resolved(spark, sf_dir):
    """Rules of the file stage: 4 joins, baseline branch (UNION ALL), countries exploded."""
    t = Tables(spark, sf_dir)
    ctx = _ctx(stage="dag06", component="core")
    sp = t.spark
    return R.resolve_rules(C.rules_config(t, DAG06_SPECS), C.error_map(sp), C.severity_map(sp),
                           C.fields_map(sp), C.vendor_region(sp), ctx, C.run_countries(t))


# --------------------------------------------------------------------------- C6 (E004)

MISMATCH_RULES = [
    ("dag05", "table", "orders_history", "country_raw", "o_orderstatus = 'F'", "E004",
     "Check country", "S1", "F5", "country_raw", "", "vend1", "core", True),
]


def _orders_history(t: Tables):
    return (t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
            .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .withColumn("country_raw", F.when(F.col("o_orderkey") % 10 == 0, F.lit(None).cast("string"))
                        .otherwise(F.col("n_name")))
            .withColumn("createddttm", F.date_sub(F.lit(RUN_DATE).cast("date"), (F.col("o_orderkey") % 3).cast("int"))))


_OH = ("(SELECT *, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE n_name END AS country_raw, "
       f"CAST(DATE '{RUN_DATE}' - CAST(o_orderkey % 3 AS INTEGER) AS DATE) AS createddttm "
       "FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)")
_F5 = ["o_orderkey", "o_orderstatus"]

RULES_COUNTRY_MISMATCH_SQL = (
    _log_select("cty.n_name", "core", "orders_history", "High", "Error", _desc("Country mismatch", _F5),
                "country_raw", "Check country")
    + f" FROM {_OH} o JOIN {_ASIA} cty ON coalesce(o.country_raw, '') <> cty.n_name"
    + f" WHERE (o_orderstatus = 'F') AND o.createddttm = DATE '{RUN_DATE}'")


@query("rules_country_mismatch", RULES_COUNTRY_MISMATCH_SQL)
def rules_country_mismatch(spark, sf_dir):
    """E004 rules scope with ``IFNULL(key,'') NOT IN (country)`` instead of ``key IN``."""
    t = Tables(spark, sf_dir)
    ctx = _ctx()
    rules = _rules(t, ctx, MISMATCH_RULES)
    log, problems = R.evaluate_rules(rules, {"orders_history": _orders_history(t)}, ctx)
    if problems:
        raise RuntimeError(f"rule problems: {problems}")
    return log.select(*LOG_OUT)


# --------------------------------------------------------------------------- C5

SLICE_RULES = [
    ("dag05", "table", "orders_history", "o_totalprice", "o_totalprice > 300000", "E001",
     "Check price", "S1", "F5", "n_name", "", "vend1", "core", True),
]

RULES_HISTORY_SLICE_SQL = (
    _log_select("n_name", "core", "orders_history", "High", "Error", _desc("Quantity above limit", _F5),
                "o_totalprice", "Check price")
    + f" FROM {_OH} o WHERE (o_totalprice > 300000) AND o.createddttm = DATE '{RUN_DATE}' AND n_name IN {_ASIA}")


@query("rules_history_slice", RULES_HISTORY_SLICE_SQL)
def rules_history_slice(spark, sf_dir):
    """A table named ``...history`` is scoped to ``createddttm = run date``."""
    t = Tables(spark, sf_dir)
    ctx = _ctx()
    rules = _rules(t, ctx, SLICE_RULES)
    log, problems = R.evaluate_rules(rules, {"orders_history": _orders_history(t)}, ctx)
    if problems:
        raise RuntimeError(f"rule problems: {problems}")
    return log.select(*LOG_OUT)


# --------------------------------------------------------------------------- D9 / E1

INGEST_RULES = [
    ("dag05", "table", "events_raw", "value", "value > 50", "E001", "Check value", "S1", "F6",
     "event_type", "value < 90", "vend1", "core", True),
    ("dag05", "table", "events_raw", "user_id", "user_id % 7 = 0", "E002", "Check user", "S2", "F6",
     "event_type", "", "vend1", "core", True),
]
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
_F6 = ["event_id", "user_id"]
_EV = "(SELECT *, date_trunc('day', ts) AS rawingestiondttm FROM events)"

RULES_LATEST_INGESTION_SQL = (
    _log_select("e.event_type", "core", "events_raw", "High", "Error", _desc("Quantity above limit", _F6),
                "value", "Check value")
    + f" FROM {_EV} e JOIN (SELECT event_type AS c, max(rawingestiondttm) AS mx FROM {_EV} WHERE value < 90"
    " GROUP BY event_type) m ON e.event_type = m.c AND e.rawingestiondttm = m.mx WHERE (value > 50)"
    "\nUNION ALL\n"
    + _log_select("e.event_type", "core", "events_raw", "Low", "Warning", _desc("Discount above limit", _F6),
                  "user_id", "Check user")
    + f" FROM {_EV} e JOIN (SELECT event_type AS c, max(rawingestiondttm) AS mx FROM {_EV}"
    " GROUP BY event_type) m ON e.event_type = m.c AND e.rawingestiondttm = m.mx WHERE (user_id % 7 = 0)")


@query("rules_latest_ingestion", RULES_LATEST_INGESTION_SQL)
def rules_latest_ingestion(spark, sf_dir):
    """Raw tables are scoped to the latest load of the rule's country (D9 scalar subquery, E1)."""
    t = Tables(spark, sf_dir)
    ctx = _ctx()
    rules = _rules(t, ctx, INGEST_RULES, countries=EVENT_TYPES)
    obj = t.events.withColumn("rawingestiondttm", F.date_trunc("day", "ts"))
    log, problems = R.evaluate_rules(rules, {"events_raw": obj}, ctx)
    if problems:
        raise RuntimeError(f"rule problems: {problems}")
    return log.select(*LOG_OUT)


# --------------------------------------------------------------------------- I3

PROCESSES = [("Payroll",), ("rates",), (None,)]


def _ingestion_rows(t: Tables):
    ev = t.events
    return ev.select(
        F.lit("Ingestion").alias("stage"),
        F.when(F.col("user_id") % 2 == 0, F.lit("ASIA")).otherwise(F.lit("EUROPE")).alias("region"),
        F.concat(F.lit("NATION_"), (F.col("user_id") % 25).cast("string")).alias("country"),
        F.lit(SOURCE).alias("source"), F.lit("core").alias("sourcecomponent"),
        F.lit("events").alias("objectname"), F.lit("High").alias("errorseverity"),
        F.lit("Error").alias("type"),
        F.concat(F.lit("bad event "), F.col("event_id").cast("string")).alias("errordescription"),
        "event_type",
    )


def _prior_log(t: Tables):
    ing = _ingestion_rows(t)
    cols = ["stage", "region", "country", "source", "sourcecomponent", "objectname", "errorseverity",
            "type", "errordescription"]

    def mk(df, d):
        return df.select(F.lit(ORCHESTRATOR).alias("orchestratorid"), *cols, F.lit("").alias("erroridentifier"),
                         F.lit(d).cast("date").alias("createddttm"),
                         F.lit(FIXED_NOW.isoformat(sep=" ")).cast("timestamp_ntz").alias("recordtimestamp"), F.lit("").alias("recommendation"))
    return mk(ing.where(F.col("event_type") == "click"), RUN_DATE).unionByName(
        mk(ing.where(F.col("event_type") == "view"), "2024-01-14"))


_ING_SQL = ("(SELECT 'Ingestion' AS stage, CASE WHEN user_id % 2 = 0 THEN 'ASIA' ELSE 'EUROPE' END AS region, "
            "'NATION_' || CAST(user_id % 25 AS VARCHAR) AS country, 'payroll' AS source, 'core' AS sourcecomponent, "
            "'events' AS objectname, 'High' AS errorseverity, 'Error' AS type, "
            "'bad event ' || CAST(event_id AS VARCHAR) AS errordescription, event_type FROM events)")
_ING_COLS = ("stage, region, country, source, sourcecomponent, objectname, errorseverity, type, errordescription")

INGESTION_ERRORS_MOVED_SQL = f"""WITH ing AS {_ING_SQL},
log0 AS (SELECT '{ORCHESTRATOR}' AS orchestratorid, {_ING_COLS}, '' AS erroridentifier, DATE '{RUN_DATE}' AS createddttm,
           '' AS recommendation FROM ing WHERE event_type = 'click'
         UNION ALL SELECT '{ORCHESTRATOR}', {_ING_COLS}, '', DATE '2024-01-14', '' FROM ing WHERE event_type = 'view')
SELECT * FROM log0 WHERE NOT coalesce(createddttm = DATE '{RUN_DATE}' AND source = '{SOURCE}' AND region = '{RUN_REGION}'
  AND stage = 'Ingestion' AND orchestratorid = '{ORCHESTRATOR}' AND sourcecomponent = 'core'
  AND country IN {_ASIA}, false)
UNION ALL
SELECT '{ORCHESTRATOR}', {_ING_COLS}, '', DATE '{RUN_DATE}', '' FROM ing
WHERE event_type = 'error' AND source = '{SOURCE}' AND region = '{RUN_REGION}' AND country IN {_ASIA}
  AND sourcecomponent = 'core'"""


@query("ingestion_errors_moved", INGESTION_ERRORS_MOVED_SQL)
def ingestion_errors_moved(spark, sf_dir):
    """Stage dag02 of an ingestion source replaces the log's Ingestion slice (A9 + I3)."""
    t = Tables(spark, sf_dir)
    ctx = _ctx(stage="dag02", component="core")
    processes = C.local_frame(spark, PROCESSES, "Process string")
    log = _prior_log(t)
    if ctx.stage == "dag02" and R.is_ingestion_source(processes, ctx.source):
        ing = _ingestion_rows(t).where(F.col("event_type") == "error").drop("event_type")
        log = R.move_ingestion_errors(ing, log, ctx, C.run_countries(t))
    return log.select(*LOG_OUT)


# --------------------------------------------------------------------------- D3 / E12

def _thresholds(t: Tables):
    return t.nation.select(F.col("n_name").alias("country"),
                           F.when(F.col("n_nationkey") % 3 == 0, F.lit(""))
                           .when(F.col("n_nationkey") % 3 == 1, F.lit("117"))
                           .otherwise(F.lit("200")).alias("threshold"))


def _flagship_log(t: Tables):
    ctx = _ctx()
    rules = _rules(t, ctx)
    hist = C.lineitem_history(t)
    log, _ = R.evaluate_rules(rules, {"lineitem_history": hist}, ctx)
    return log, rules, hist


def _flagship_summary(t: Tables, log=None, rules=None, hist=None):
    """Per-country summary of the flagship run; reuses an already built log when given."""
    from ..operators import thresholds as TH
    if log is None:
        log, rules, hist = _flagship_log(t)
    base = TH.baseline_count(hist.where(F.col("n_name").isin(C.run_countries(t)))
                             .withColumnRenamed("n_name", "country"), ["country"])
    fails = TH.failure_counts(log, ["country"])
    return TH.summary_rows(base, fails, None, _thresholds(t), ["country"]), rules


_SUMMARY_CTE = f"""v AS ({RULES_TABLE_VIOLATIONS_SQL}),
b AS (SELECT n_name AS country, count(*) AS baseline FROM {_OBJ} WHERE n_name IN {_ASIA} GROUP BY n_name),
f AS (SELECT country, count_if(type = 'Error') AS stagefailure FROM v GROUP BY country),
th AS (SELECT n_name AS country, CASE n_nationkey % 3 WHEN 0 THEN '' WHEN 1 THEN '117' ELSE '200' END AS threshold
       FROM nation),
s0 AS (SELECT b.country, b.baseline, CAST(coalesce(f.stagefailure, 0) AS BIGINT) AS stagefailure,
       CAST(0 AS BIGINT) AS g2vsviewcountfailure,
       coalesce(TRY_CAST(nullif(trim(th.threshold), '') AS DOUBLE), 0.0) AS thresholdpercentage
       FROM b LEFT JOIN f ON b.country = f.country LEFT JOIN th ON b.country = th.country),
s1 AS (SELECT *, stagefailure + g2vsviewcountfailure AS totalfailure FROM s0),
s2 AS (SELECT *, CASE WHEN baseline = 0 OR totalfailure = 0 THEN 0.0
       ELSE round_even(totalfailure / baseline * 100.0, 2) END AS errorpercentage FROM s1),
summ AS (SELECT *, CASE WHEN errorpercentage = 0 THEN 'Success' WHEN errorpercentage > thresholdpercentage
       THEN 'Failure' ELSE 'Partial' END AS status FROM s2)"""

THRESHOLD_GATE_SQL = f"""WITH {_SUMMARY_CTE},
flags AS (SELECT country, CASE WHEN status = 'Failure' THEN 'Y' ELSE 'N' END AS ex FROM summ)
SELECT DISTINCT upper(c) AS Country, ObjectField, ErrorCode FROM (
  SELECT unnest(['l_quantity', 'l_discount', 'l_returnflag', 'l_shipdate']) AS ObjectField,
         unnest(['E001', 'E002', 'E003', 'E005']) AS ErrorCode) r,
  (SELECT n_name AS c FROM nation WHERE n_name IN {_ASIA}) cc
WHERE upper(c) IN (SELECT upper(country) FROM flags WHERE ex = 'N')"""


@query("threshold_gate", THRESHOLD_GATE_SQL)
def threshold_gate(spark, sf_dir):
    """Per-country threshold flags from the run's summary (E12), then the rule gate (D3)."""
    from ..operators import thresholds as TH
    t = Tables(spark, sf_dir)
    summary, rules = _flagship_summary(t)
    flags = TH.access_threshold(summary, ["country"]).withColumnRenamed("country", "Country")
    gated = R.gate_by_threshold(rules, flags, override=False)
    return gated.select("Country", "ObjectField", "ErrorCode").distinct()


THRESHOLD_STATUS_SQL = f"""WITH {_SUMMARY_CTE}
SELECT country, baseline, stagefailure, g2vsviewcountfailure, totalfailure, thresholdpercentage,
       errorpercentage, status FROM summ"""


@query("threshold_status", THRESHOLD_STATUS_SQL)
def threshold_status_q(spark, sf_dir):
    """Failure totals, half-even error percentage and Success/Partial/Failure per country."""
    t = Tables(spark, sf_dir)
    summary, _ = _flagship_summary(t)
    return summary.select("country", "baseline", "stagefailure", "g2vsviewcountfailure", "totalfailure",
                          "thresholdpercentage", "errorpercentage", "status")


# --------------------------------------------------------------------------- E9 / I6

COMPONENT_FANOUT_SQL = f"""SELECT DISTINCT c_mktsegment AS component FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE n_name IN {_ASIA}"""


@query("component_fanout", COMPONENT_FANOUT_SQL)
def component_fanout(spark, sf_dir):
    """Region run: one quality run per distinct component of the executions."""
    t = Tables(spark, sf_dir)
    execs = (t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
             .where(F.col("n_name").isin(C.run_countries(t)))
             .select(F.col("c_mktsegment").alias("component"), F.col("n_name").alias("country")))
    return R.distinct_components(execs, by_country=False)


# --------------------------------------------------------------------------- I2

ACCESS_CHECK_LOG_SQL = f"""WITH v AS ({RULES_TABLE_VIOLATIONS_SQL}),
prior AS (SELECT * FROM v UNION ALL
          SELECT orchestratorid, stage, region, country, source, sourcecomponent, objectname, errorseverity, type,
                 errordescription, erroridentifier, DATE '2024-01-14', recommendation FROM v WHERE erroridentifier = 'l_quantity')
SELECT * FROM prior WHERE NOT coalesce(createddttm = DATE '{RUN_DATE}' AND source = '{SOURCE}'
  AND region = '{RUN_REGION}' AND stage = 'dag05' AND orchestratorid = '{ORCHESTRATOR}' AND country IN {_ASIA}, false)
UNION ALL SELECT * FROM v"""


@query("access_check_log", ACCESS_CHECK_LOG_SQL)
def access_check_log(spark, sf_dir):
    """A rerun of the table-level check: the log's run slice is replaced, other dates stay."""
    t = Tables(spark, sf_dir)
    ctx = _ctx()
    rules = _rules(t, ctx)
    objects = {"lineitem_history": C.lineitem_history(t)}
    first, _ = R.evaluate_rules(rules, objects, ctx)
    prior = first.unionByName(first.where(F.col("erroridentifier") == "l_quantity")
                              .withColumn("createddttm", F.lit("2024-01-14").cast("date")))
    res = R.access_check(rules, objects, ctx, prior, C.run_countries(t))
    if res.problems:
        raise RuntimeError(f"rule problems: {res.problems}")
    return res.log.select(*LOG_OUT)


# --------------------------------------------------------------------------- I6 as one run

def _customer_history(t: Tables):
    return (t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .withColumn("createddttm", F.lit(RUN_DATE).cast("date")))


COMPONENTS_RUN_SQL = f"""WITH seg AS (SELECT DISTINCT c_mktsegment AS comp FROM customer JOIN nation ON c_nationkey = n_nationkey
    WHERE n_name IN {_ASIA})
SELECT '{ORCHESTRATOR}' AS orchestratorid, 'dag05' AS stage, '{RUN_REGION}' AS region, n_name AS country,
  '{SOURCE}' AS source, c_mktsegment AS sourcecomponent, 'customer_history' AS objectname, 'High' AS errorseverity,
  'Error' AS type, 'Quantity above limit;c_custkey:' || {_lf('c_custkey')} || '|c_mktsegment:' || {_lf('c_mktsegment')}
  AS errordescription, 'c_acctbal' AS erroridentifier, DATE '{RUN_DATE}' AS createddttm, 'Check balance' AS recommendation
FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE (c_acctbal < 1000 AND c_mktsegment = c_mktsegment) AND n_name IN {_ASIA} AND c_mktsegment IN (SELECT comp FROM seg)"""


@query("component_fanout_run", COMPONENTS_RUN_SQL)
def component_fanout_run(spark, sf_dir):
    """Region run over every distinct component of the executions as one rule evaluation."""
    t = Tables(spark, sf_dir)
    countries = C.run_countries(t)
    execs = (t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
             .where(F.col("n_name").isin(countries)).select(F.col("c_mktsegment").alias("component")))
    comps = sorted(r.component for r in R.distinct_components(execs, by_country=False).collect())
    fm = C.fields_map(spark, [("F9", "c_custkey,c_mktsegment")])
    specs = [dict(Stage="dag05", ObjectType="table", ObjectName="customer_history", ObjectField="c_acctbal",
                  AdditionalCondition="c_acctbal < 1000 AND c_mktsegment = " + sql_text(c), ErrorCode="E001",
                  Recommendation="Check balance", SeverityID="S1", FieldsCode="F9", CountryKeyField="n_name",
                  Component=c) for c in comps]
    ctx = _ctx()
    rules = R.resolve_rules(C.rules_config(t, specs), C.error_map(spark), C.severity_map(spark), fm,
                            C.vendor_region(spark), ctx, countries, components=comps)
    log, problems = R.evaluate_rules(rules, {"customer_history": _customer_history(t)}, ctx)
    if problems:
        raise RuntimeError(f"rule problems: {problems}")
    return log.select(*LOG_OUT)


@query("access_check_written", ACCESS_CHECK_LOG_SQL)
def access_check_written(spark, sf_dir):
    """The table-level run against a validation log stored as Parquet, partitioned by its delete key: a rerun replaces
    only its own slices (I2 with the B2 sink)."""
    from ..session import scratch_path
    from ..sinks.slices import LOG_SLICE, by_slice, read_slices
    t = Tables(spark, sf_dir)
    ctx = _ctx()
    rules = _rules(t, ctx)
    objects = {"lineitem_history": C.lineitem_history(t)}
    path = scratch_path(spark, "validation-log")
    first, _ = R.evaluate_rules(rules, objects, ctx)
    prior = first.unionByName(first.where(F.col("erroridentifier") == "l_quantity")
                              .withColumn("createddttm", F.lit("2024-01-14").cast("date")))
    by_slice(prior, LOG_SLICE, 2 * len(C.run_countries(t))).write.partitionBy(*LOG_SLICE).parquet(path)
    R.run_access_check(spark, rules, objects, ctx, path, C.run_countries(t))
    return read_slices(spark, path, R.LOG_SCHEMA).select(*LOG_OUT)


# --------------------------------------------------------------------------- L1 (country-key function)

FUNCTION_RULES = [
    ("dag05", "table", "orders_fn_history", "o_totalprice", "o_totalprice > 350000", "E001",
     "Check price", "S1", "F5", "ll_valid_country_key(country_raw)", "", "vend1", "core", True),
]


@query("rules_country_function", f"""WITH o AS (SELECT *, CASE o_orderkey % 4 WHEN 0 THEN lower(n_name)
    WHEN 1 THEN ' ' || n_name || ' ' ELSE n_name END AS country_raw
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
{_log_select("upper(trim(country_raw))", "core", "orders_fn_history", "High", "Error",
             _desc("Quantity above limit", _F5), "o_totalprice", "Check price")}
FROM o WHERE (o_totalprice > 350000) AND upper(trim(country_raw)) IN {_ASIA}""")
def rules_country_function(spark, sf_dir):
    """A rule's country field calls a user-supplied SQL function (the absent key function, L1)."""
    from ..functions.udfs import register_sql_function
    t = Tables(spark, sf_dir)
    register_sql_function(spark, "ll_valid_country_key", "raw STRING", "STRING", "upper(trim(raw))")
    k = F.col("o_orderkey") % 4
    obj = (t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
           .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
           .withColumn("country_raw", F.when(k == 0, F.lower("n_name"))
                       .when(k == 1, F.concat(F.lit(" "), F.col("n_name"), F.lit(" "))).otherwise(F.col("n_name")))
           .withColumn("createddttm", F.lit(RUN_DATE).cast("date")))
    ctx = _ctx()
    log, problems = R.evaluate_rules(_rules(t, ctx, FUNCTION_RULES), {"orders_fn_history": obj}, ctx)
    if problems:
        raise RuntimeError(f"rule problems: {problems}")
    return log.select(*LOG_OUT)
