"""Registered queries: rendering, names, routing, error-log lines, stage join, count reconcile."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.dates import month_start
from ..operators import render as RD
from ..operators import thresholds as TH
from . import q_records as QR
from . import q_rules as QRL
from .registry import query
from .tables import FIXED_NOW, ORCHESTRATOR, RUN_DATE, RUN_REGION, SOURCE, Tables

LAYOUT_OPEN = {
    "Headers": {"IsFixed": True, "Values": ["IGNORED"], "HeaderFunction": ""},
    "Body": [
        {"Repeat": False, "Layout": "PERIOD|{GetPeriodStartDate}", "Variables": [{"FunctionName": "GetPeriodStartDate"}]},
        {"Repeat": True, "Layout": '0015|"{Id}|"{Amount}|"{Status}',
         "Variables": [{"ViewFieldName": "Id"}, {"ViewFieldName": "Amount"}, {"ViewFieldName": "Status"}]},
    ],
}
LAYOUT_OTHER = {
    "Headers": {"IsFixed": True, "Values": ["HDR|PAY", "V1"], "HeaderFunction": ""},
    "Body": [{"Repeat": True, "Layout": '0020|"{Id}|"{Priority}',
              "Variables": [{"ViewFieldName": "Id"}, {"ViewFieldName": "Priority"}]}],
    "Footers": [{"Value": "TRL|{TotalLineCount}"}, {"Value": "IGNORED"}],
}


def _base(t: Tables):
    k = F.col("o_orderkey")
    return (t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
            .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select("n_name", "o_orderkey", k.cast("string").alias("Id"),
                    F.when(k % 97 == 0, F.lit("{Status}"))
                    .otherwise(F.col("o_totalprice").cast("decimal(15,2)").cast("string")).alias("Amount"),
                    F.col("o_orderstatus").alias("Status"),
                    F.when(k % 50 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderpriority")).alias("Priority")))


def _body(t: Tables):
    base = _base(t)
    views = [base.where(F.col("Status") == "O"), base.where(F.col("Status") != "O")]
    files = t.nation.select("n_name")
    body = RD.render_body(files, views, [LAYOUT_OPEN, LAYOUT_OTHER], "n_name", "o_orderkey",
                          {"GetPeriodStartDate": month_start(RUN_DATE)})
    return files, body


_BASE_SQL = """base AS (SELECT n_name, o_orderkey, CAST(o_orderkey AS VARCHAR) AS Id,
    CASE WHEN o_orderkey % 97 = 0 THEN '{Status}' ELSE CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) END AS Amount,
    o_orderstatus AS Status, CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_orderpriority END AS Priority
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
body AS (
  SELECT n_name, 1 AS view_rank, 0 AS block, CAST(NULL AS BIGINT) AS order_key, 'PERIOD|2024-01-01' AS line FROM nation
  UNION ALL SELECT n_name, 1, 1, o_orderkey, replace(replace(replace('0015|"{Id}|"{Amount}|"{Status}', '{Id}', coalesce(Id, '')),
      '{Amount}', coalesce(Amount, '')), '{Status}', coalesce(Status, '')) FROM base WHERE Status = 'O'
  UNION ALL SELECT n_name, 0, 0, o_orderkey, replace(replace('0020|"{Id}|"{Priority}', '{Id}', coalesce(Id, '')),
      '{Priority}', coalesce(Priority, '')) FROM base WHERE Status <> 'O')"""

RENDER_BODY_SQL = f"WITH {_BASE_SQL}\nSELECT n_name, 1 AS section, view_rank, block, order_key, line FROM body"


@query("render_body", RENDER_BODY_SQL)
def render_body_q(spark, sf_dir):
    """Two views through two layouts, later view first; static block bound once per file."""
    _, body = _body(Tables(spark, sf_dir))
    return body.select("n_name", "section", "view_rank", "block", "order_key", "line")


RENDER_FILE_SQL = f"""WITH {_BASE_SQL}
SELECT n_name, 0 AS section, CAST(NULL AS INTEGER) AS view_rank, b AS block, CAST(NULL AS BIGINT) AS order_key, l AS line
FROM nation, (VALUES (0, 'HDR|PAY'), (1, 'V1')) h(b, l)
UNION ALL SELECT n_name, 1, view_rank, block, order_key, line FROM body
UNION ALL SELECT n.n_name, 2, NULL, 0, NULL, 'TRL|' || CAST(coalesce(c.n, 0) + 2 AS VARCHAR)
FROM nation n LEFT JOIN (SELECT n_name, count(*) AS n FROM body GROUP BY n_name) c ON n.n_name = c.n_name"""


@query("render_file", RENDER_FILE_SQL)
def render_file_q(spark, sf_dir):
    """Header (last layout), body, first footer with TotalLineCount = body + 2."""
    files, body = _body(Tables(spark, sf_dir))
    return RD.assemble_file(files, body, "n_name", LAYOUT_OTHER)


def _file_configs(t: Tables):
    k = F.col("n_nationkey")
    return (t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.col("r_name").alias("Region"), F.col("n_name").alias("Country"),
                    F.lit(SOURCE).alias("DataSource"), F.lit("core").alias("Component"),
                    F.concat(F.lit("PAY_"), F.col("n_name")).alias("FileName"),
                    F.when(k % 4 == 0, F.lit("calculatedFileName"))
                    .otherwise(F.concat(F.lit("  PAY_"), F.col("n_name"), F.lit(" "))).alias("OutputFileName"),
                    F.when(k % 3 == 0, F.lit(".SAP")).otherwise(F.lit(".csv")).alias("OutputFileExtension")))


FILE_NAMES_SQL = """WITH cfg AS (SELECT r_name AS Region, n_name AS Country, 'payroll' AS DataSource, 'core' AS Component,
    'PAY_' || n_name AS FileName,
    CASE WHEN n_nationkey % 4 = 0 THEN 'calculatedFileName' ELSE '  PAY_' || n_name || ' ' END AS OutputFileName,
    CASE WHEN n_nationkey % 3 = 0 THEN '.SAP' ELSE '.csv' END AS OutputFileExtension
    FROM nation JOIN region ON n_regionkey = r_regionkey),
ts AS (SELECT *, strftime(TIMESTAMP '2024-01-15 12:00:00' + to_seconds(row_number() OVER
    (ORDER BY Region, Country, DataSource, Component, FileName) - 1), '%Y%m%d%H%M%S') AS TimestampFile FROM cfg),
nm AS (SELECT *, CASE WHEN upper(OutputFileName) = 'CALCULATEDFILENAME'
    THEN lower(Country) || '_01_' || TimestampFile || '.txt'
    ELSE trim(OutputFileName) || '_' || TimestampFile || OutputFileExtension END AS file_name FROM ts)
SELECT Country, TimestampFile, file_name,
    CASE WHEN suffix(file_name, '.csv') THEN file_name ELSE string_split(file_name, '.')[1] || '.csv' END AS csv_name
FROM nm"""


@query("file_names", FILE_NAMES_SQL)
def file_names(spark, sf_dir):
    """Per-file timestamps start + i seconds in a fixed order (F1); plain or calculated names."""
    t = Tables(spark, sf_dir)
    cfg = RD.timestamp_sequence(_file_configs(t), FIXED_NOW.isoformat(sep=" "),
                                ["Region", "Country", "DataSource", "Component", "FileName"])
    month = F.lit(RUN_DATE[5:7])
    calculated = F.concat(F.lower("Country"), F.lit("_"), month, F.lit("_"), F.col("TimestampFile"), F.lit(".txt"))
    name = RD.file_name(F.col("OutputFileName"), F.col("OutputFileExtension"), F.col("TimestampFile"), calculated)
    return cfg.select("Country", "TimestampFile", name.alias("file_name")) \
        .withColumn("csv_name", RD.csv_name(F.col("file_name")))


ROUTE_OUTPUTS_SQL = f"""WITH {QRL._SUMMARY_CTE}
SELECT s.country, s.status,
  CASE WHEN n_nationkey % 5 <> 0 AND s.status = 'Failure' AND NOT (n_nationkey % 2 = 0) THEN 'failed'
       WHEN n_nationkey % 3 = 0 THEN 'skipped' ELSE 'success' END AS route
FROM summ s JOIN nation ON s.country = n_name"""


@query("route_outputs", ROUTE_OUTPUTS_SQL)
def route_outputs(spark, sf_dir):
    """Failed (check on, Failure, no override) wins over skipped, else success (C14)."""
    t = Tables(spark, sf_dir)
    summary, _ = QRL._flagship_summary(t)
    k = F.col("n_nationkey")
    flags = t.nation.select(F.col("n_name").alias("country"),
                            F.when(k % 2 == 0, F.lit("TRUE")).otherwise(F.lit("false")).alias("override"),
                            F.when(k % 3 == 0, F.lit("true")).otherwise(F.lit("FALSE")).alias("skip"),
                            (k % 5 != 0).alias("check"))
    j = summary.join(flags, "country")
    return j.select("country", "status",
                    RD.route(F.col("status"), RD.flag(F.col("override")), RD.flag(F.col("skip")), F.col("check"))
                    .alias("route"))


STAGE_MAP = [("dag05", "Data access checks"), ("dag06", "File checks")]
LOG_FILE_COLS = ["orchestratorid", "stage", "stagedescription", "region", "country", "source", "sourcecomponent",
                 "objectname", "errorseverity", "type", "erroridentifier", "createddttm", "recordtimestamp",
                 "errordescription", "recommendation"]


def _log_with_ingestion(t: Tables, log=None):
    if log is None:
        log, _, _ = QRL._flagship_log(t)
    ing = QRL._prior_log(t).where(F.col("createddttm") == F.lit(RUN_DATE).cast("date"))
    return log.unionByName(ing)


def _stage_map(spark):
    from .config import local_frame
    return local_frame(spark, STAGE_MAP, "Stage string, StageDescription string")


_LOG_ING_SQL = f"""tv AS ({QRL.RULES_TABLE_VIOLATIONS_SQL}),
ing AS {QRL._ING_SQL},
lg AS (SELECT *, TIMESTAMP '2024-01-15 12:00:00' AS recordtimestamp FROM tv
       UNION ALL SELECT '{ORCHESTRATOR}', {QRL._ING_COLS}, '', DATE '{RUN_DATE}', '', TIMESTAMP '2024-01-15 12:00:00'
       FROM ing WHERE event_type = 'click'),
sm AS (SELECT * FROM (VALUES ('dag05', 'Data access checks'), ('dag06', 'File checks')) s(map_stage, StageDescription))"""

LOG_BY_STAGE_SQL = f"""WITH {_LOG_ING_SQL}
SELECT orchestratorid, stage, StageDescription AS stagedescription, region, country, source, sourcecomponent, objectname,
  errorseverity, type, erroridentifier, createddttm, errordescription, recommendation
FROM lg JOIN sm ON lg.stage = sm.map_stage
WHERE orchestratorid = '{ORCHESTRATOR}' AND createddttm = DATE '{RUN_DATE}' AND region = '{RUN_REGION}' AND source = '{SOURCE}'"""


@query("log_by_stage", LOG_BY_STAGE_SQL)
def log_by_stage(spark, sf_dir):
    """Run's log rows with stage descriptions; a stage missing from the map drops out."""
    t = Tables(spark, sf_dir)
    df = TH.log_with_stage(_log_with_ingestion(t), _stage_map(spark), orchestratorid=ORCHESTRATOR,
                           createddttm=F.lit(RUN_DATE).cast("date"), region=RUN_REGION, source=SOURCE)
    return df.select(*[c for c in LOG_FILE_COLS if c != "recordtimestamp"])


_INFO_VALUES = ["'2024-01-15 12:00:00'", f"'{RUN_DATE}'", f"'{RUN_REGION}'", "country", f"'{SOURCE}'", "'core'",
                "CAST(stagefailure AS VARCHAR)", "CAST(g2vsviewcountfailure AS VARCHAR)", "CAST(baseline AS VARCHAR)",
                "CAST(totalfailure AS VARCHAR)", "CAST(thresholdpercentage AS VARCHAR)",
                "CAST(errorpercentage AS VARCHAR)", "status"]


def _sql_cell(c):
    s = f"coalesce(CAST({c} AS VARCHAR), '')"
    return f"CASE WHEN contains({s}, ',') OR {s} = ' ' THEN '\"' || {s} || '\"' ELSE {s} END"


ERROR_LOG_LINES_SQL = f"""WITH {QRL._SUMMARY_CTE}, {_LOG_ING_SQL},
rows AS (SELECT lg.*, sm.StageDescription AS stagedescription FROM lg JOIN sm ON lg.stage = sm.map_stage
    WHERE orchestratorid = '{ORCHESTRATOR}' AND createddttm = DATE '{RUN_DATE}' AND region = '{RUN_REGION}'
    AND source = '{SOURCE}' AND sourcecomponent = 'core' AND country IN (SELECT country FROM summ)),
info AS (SELECT country, unnest([{', '.join(f"'{lbl} : ' || coalesce({v}, '')" for lbl, v in zip(
    K.ERROR_LOG_INFO_LABELS, _INFO_VALUES))}]) AS line,
    unnest(range(13)) AS seq FROM summ)
SELECT country, 0 AS section, CAST(seq AS BIGINT) AS seq, line FROM info
UNION ALL SELECT DISTINCT country, 1, CAST(0 AS BIGINT), '{','.join(K.ERROR_LOG_FILE_COLUMNS)}' FROM rows
UNION ALL SELECT country, 2, CAST(NULL AS BIGINT), concat_ws(',', {', '.join(_sql_cell(c) for c in LOG_FILE_COLS)}) FROM rows"""


@query("error_log_lines", ERROR_LOG_LINES_SQL)
def error_log_lines_q(spark, sf_dir):
    """Error-log file per country: info lines, column line, quoted comma rows."""
    from ..session import cut_lineage
    t = Tables(spark, sf_dir)
    log, rules, hist = QRL._flagship_log(t)
    log = cut_lineage(log)  # the run's log is stored once, then summarised and listed
    summary, _ = QRL._flagship_summary(t, log, rules, hist)
    vals = [F.lit(FIXED_NOW.isoformat(sep=" ")), F.lit(RUN_DATE), F.lit(RUN_REGION), F.col("country"), F.lit(SOURCE),
            F.lit("core"), F.col("stagefailure"), F.col("g2vsviewcountfailure"), F.col("baseline"),
            F.col("totalfailure"), F.col("thresholdpercentage"), F.col("errorpercentage"), F.col("status")]
    rows = TH.log_with_stage(_log_with_ingestion(t, log), _stage_map(spark), orchestratorid=ORCHESTRATOR,
                             createddttm=F.lit(RUN_DATE).cast("date"), region=RUN_REGION, source=SOURCE,
                             sourcecomponent="core")
    # one summary row a country, but all its log rows: the countries go to the rows, no country is sorted in one task
    rows = rows.join(F.broadcast(summary.select("country")), "country", "left_semi")
    return RD.error_log_lines(summary, vals, rows, "country")


COUNT_RECONCILE_SQL = f"""{QR.VIOLATIONS_CTE},
clean AS (SELECT string_split(line, '|"')[7] AS country FROM lines WHERE trim(line) <> '' AND NOT EXISTS
    (SELECT 1 FROM viol v WHERE v.line = lines.line)),
fc AS (SELECT country, count(*) AS file_count FROM clean GROUP BY country),
vw AS (SELECT n_name AS country, l_linestatus FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey),
vc AS (SELECT country, sum(n) AS view_count FROM (
    SELECT country, count(*) AS n FROM vw WHERE l_linestatus = 'F' GROUP BY country
    UNION ALL SELECT country, count(*) FROM vw WHERE l_linestatus = 'O' GROUP BY country) GROUP BY country)
SELECT coalesce(fc.country, vc.country) AS country, CAST(coalesce(file_count, 0) AS BIGINT) AS file_count,
  CAST(coalesce(view_count, 0) AS BIGINT) AS view_count,
  CAST(abs(coalesce(file_count, 0) - coalesce(view_count, 0)) AS BIGINT) AS g2vsviewcountfailure
FROM fc FULL OUTER JOIN vc ON fc.country = vc.country"""


@query("count_reconcile", COUNT_RECONCILE_SQL)
def count_reconcile(spark, sf_dir):
    """|records in the cleaned file - Σ rows of the views it came from| per country."""
    from ..operators import records as RC
    t = Tables(spark, sf_dir)
    _, clean, _ = QR._checked(t)
    clean = clean.withColumn("country", F.get(F.split("line", r'\|"', -1), 6))
    fc = TH.record_counts(clean, ["country"])
    vw = (t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
          .join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
          .select(F.col("n_name").alias("country"), "l_linestatus"))
    vc = TH.view_counts([vw.where(F.col("l_linestatus") == "F"), vw.where(F.col("l_linestatus") == "O")], ["country"])
    return TH.count_mismatch(fc, vc, ["country"])


# ----------------------------------------------------------------------------- J8

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
GEN_RULES = [
    dict(AdditionalCondition="0015", ObjectField="2", Operator="AMOUNTFORMAT", ObjectFieldValue=r"\d+(\.\d{1,2})?$",
         AdditionalFields="{1: 'Id', 2: 'Amount'}", ErrorSeverity="High", Type="Error", ErrorDescription="Bad amount",
         Recommendation="fix"),
    dict(AdditionalCondition="0020", ObjectField="2", Operator="NOTIN", ObjectFieldValue=repr(PRIORITIES),
         AdditionalFields="{1: 'Id', 2: 'Priority'}", ErrorSeverity="High", Type="Error", ErrorDescription="Bad priority",
         Recommendation="fix"),
    dict(AdditionalCondition="0020", ObjectField="1", Operator="IN", ObjectFieldValue="('7', '77', '777', '7777')",
         AdditionalFields="{1: 'Id'}", ErrorSeverity="Low", Type="Warning", ErrorDescription="Held id",
         Recommendation="check"),
]


def _generate(t: Tables):
    from ..operators import records as RC
    base = _base(t)
    views = [base.where(F.col("Status") == "O"), base.where(F.col("Status") != "O")]
    k = F.col("n_nationkey")
    files = t.nation.select(
        "n_name", (k % 5 != 0).alias("check_enabled"), RD.flag(F.when(k % 2 == 0, F.lit("TRUE"))).alias("override"),
        (k % 3 == 0).alias("skip"),
        F.when(k % 3 == 0, F.lit("")).when(k % 3 == 1, F.lit("1")).otherwise(F.lit("5")).alias("threshold"))
    compiled = RC.compile_rules(t.spark, GEN_RULES)
    return RD.generate_files(files, "n_name", views, [LAYOUT_OPEN, LAYOUT_OTHER], "o_orderkey",
                             {"GetPeriodStartDate": month_start(RUN_DATE)}, compiled, RC.References("NATION_7"))


_GEN_SQL = f"""WITH {_BASE_SQL},
flags AS (SELECT n_name, n_nationkey % 5 <> 0 AS chk, n_nationkey % 2 = 0 AS ovr, n_nationkey % 3 = 0 AS skp,
    CASE n_nationkey % 3 WHEN 0 THEN '' WHEN 1 THEN '1' ELSE '5' END AS threshold FROM nation),
p AS (SELECT *, string_split(line, '|"') AS f FROM body),
viol AS (
  SELECT n_name, line, 'Error' AS type FROM p WHERE f[1] = '0015' AND len(f) > 2 AND f[3] <> ''
    AND NOT regexp_matches(f[3], '^(?:\\d+(\\.\\d{{1,2}})?$)')
  UNION ALL SELECT n_name, line, 'Error' FROM p WHERE f[1] = '0020' AND len(f) > 2
    AND NOT list_contains({PRIORITIES!r}, f[3])
  UNION ALL SELECT n_name, line, 'Warning' FROM p WHERE f[1] = '0020' AND len(f) > 1
    AND list_contains(['7', '77', '777', '7777'], f[2])),
vchk AS (SELECT v.* FROM viol v JOIN flags USING (n_name) WHERE chk),
clean AS (SELECT b.* FROM body b WHERE NOT EXISTS (SELECT 1 FROM vchk v WHERE v.n_name = b.n_name AND v.line = b.line)),
vc AS (SELECT n_name, count(*) AS view_count FROM base GROUP BY n_name),
fc AS (SELECT n_name, count(*) AS file_count FROM body WHERE trim(line) <> '' GROUP BY n_name),
sf AS (SELECT n_name, count_if(type = 'Error') AS stagefailure FROM vchk GROUP BY n_name),
s0 AS (SELECT fl.n_name, coalesce(vc.view_count, 0) AS baseline, CAST(coalesce(sf.stagefailure, 0) AS BIGINT) AS stagefailure,
    abs(coalesce(fc.file_count, 0) - coalesce(vc.view_count, 0)) AS g2vsviewcountfailure,
    coalesce(TRY_CAST(nullif(trim(fl.threshold), '') AS DOUBLE), 0.0) AS thresholdpercentage, fl.chk, fl.ovr, fl.skp
    FROM flags fl LEFT JOIN vc USING (n_name) LEFT JOIN fc USING (n_name) LEFT JOIN sf USING (n_name)),
s1 AS (SELECT *, stagefailure + g2vsviewcountfailure AS totalfailure FROM s0),
s2 AS (SELECT *, CASE WHEN baseline = 0 OR totalfailure = 0 THEN 0.0
       ELSE round_even(totalfailure / baseline * 100.0, 2) END AS errorpercentage FROM s1),
s3 AS (SELECT *, CASE WHEN errorpercentage = 0 THEN 'Success' WHEN errorpercentage > thresholdpercentage
       THEN 'Failure' ELSE 'Partial' END AS status FROM s2),
st AS (SELECT *, CASE WHEN chk AND status = 'Failure' AND NOT ovr THEN 'failed' WHEN skp THEN 'skipped'
       ELSE 'success' END AS route FROM s3)"""

GENERATE_FILES_STATUS_SQL = f"""{_GEN_SQL}
SELECT n_name, baseline, stagefailure, g2vsviewcountfailure, totalfailure, thresholdpercentage, errorpercentage,
       status, route FROM st"""

GENERATE_FILES_SQL = f"""{_GEN_SQL}
SELECT st.n_name, 0 AS section, CAST(NULL AS INTEGER) AS view_rank, h.b AS block, CAST(NULL AS BIGINT) AS order_key,
       h.l AS line, route FROM st, (VALUES (0, 'HDR|PAY'), (1, 'V1')) h(b, l) WHERE route <> 'failed'
UNION ALL SELECT c.n_name, 1, c.view_rank, c.block, c.order_key, c.line, st.route FROM clean c JOIN st USING (n_name)
UNION ALL SELECT st.n_name, 2, NULL, 0, NULL, 'TRL|' || CAST(coalesce(cc.n, 0) + 2 AS VARCHAR), route
FROM st LEFT JOIN (SELECT n_name, count(*) AS n FROM clean GROUP BY n_name) cc USING (n_name) WHERE route <> 'failed'"""


@query("generate_files", GENERATE_FILES_SQL)
def generate_files_q(spark, sf_dir):
    """Files rendered, checked (lines removed by value), routed and formatted in one plan."""
    lines, _ = _generate(Tables(spark, sf_dir))
    return lines


@query("generate_files_status", GENERATE_FILES_STATUS_SQL)
def generate_files_status(spark, sf_dir):
    """Per-file failures, count mismatch, half-even percentage, status and route of a file run."""
    _, status = _generate(Tables(spark, sf_dir))
    return status.select("n_name", "baseline", "stagefailure", "g2vsviewcountfailure", "totalfailure",
                         "thresholdpercentage", "errorpercentage", "status", "route")
