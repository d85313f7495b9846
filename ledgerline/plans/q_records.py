"""Registered queries: record-file checks (C13, D6-D8, H1-H12, C11) on lines built from lineitem."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants as K
from ..operators import records as RC
from ..operators import rules as R
from . import config as C
from .registry import query
from .tables import FIXED_NOW, ORCHESTRATOR, RUN_DATE, SOURCE, Tables

RUN_COUNTRY = "NATION_7"
VENDOR, REGION_LC = "vend1", "asia"
SOURCE_PATH, SOURCE_OBJECT = "vend1/asia/", "payfile_nation_7"

DATE_RX = r"^\d{4}\d{2}\d{2}$"
AMOUNT_RX = r"\d+(\.\d{1,2})?$"
HOURS_RX = r"\d{1,2}$"
FORBIDDEN_KEYS = ("3", "5", "8", "13", "21", "34", "55", "89", "144", "233", "377", "610", "987")
ALLOWED_NATIONS = ["NATION_1", "NATION_7", "NATION_12", "NATION_17"]

FILE_FIELDS = [("G1", "{1: 'OrderKey', 2: 'ShipDate'}"), ("G2", "{1: 'OrderKey', 3: 'Amount'}"),
               ("G3", "{1: 'OrderKey', 4: 'Hours'}"), ("G4", "{1: 'OrderKey', 5: 'WageType'}"),
               ("G5", "{1: 'OrderKey', 6: 'Country'}"), ("G6", "{1: 'OrderKey', 5: 'WageType', 7: 'Currency'}"),
               ("G7", "{1: 'OrderKey'}"), ("G8", "{6: 'Country', 1: 'OrderKey', 9: 'Missing'}")]

_OBJ = "payfile_<COUNTRY_PLACEHOLDER>"


def _spec(rt, idx, op, val, err, fc, sev="S1", rec="Fix the record"):
    return dict(ObjectName=_OBJ, AdditionalCondition=rt, ObjectField=str(idx), Operator=op,
                ObjectFieldValue=val, ErrorCode=err, FieldsCode=fc, SeverityID=sev, Recommendation=rec)


RECORD_SPECS = (
    [_spec(rt, 2, "DATEFORMAT", DATE_RX, "E005", "G1") for rt in ("A", "N", "R")]
    + [_spec(rt, 3, "AMOUNTFORMAT", AMOUNT_RX, "E001", "G2", "S2") for rt in ("A", "N", "R")]
    + [_spec("A", 4, "HoursFormat", HOURS_RX, "E002", "G3", "S2"),
       _spec("N", 4, "HOURSFORMAT", HOURS_RX, "E002", "G3", "S2")]
    + [_spec(rt, 5, "WAGETYPECHECK", "SELECT Wagetype, Infotype FROM ll_wagetypes_<COUNTRY_PLACEHOLDER>", "E003", "G4")
       for rt in ("A", "N", "R")]
    + [_spec("A", 5, "INFOTYPECOMBINATIONFORMAT", "SELECT Country, Infotype, Wagetype FROM ll_infotypes", "E003", "G4")]
    + [_spec(rt, 6, "COUNTRYCHECK", "", "E004", "G5") for rt in ("A", "R")]
    + [_spec("N", 6, "NOTIN", repr(ALLOWED_NATIONS), "E004", "G8", "S2")]
    + [_spec(rt, 7, "CURRENCYCHECK", "", "E001", "G6") for rt in ("N",)]
    + [_spec(rt, 7, "WAGETYPECURRENCYCHECK", "", "E001", "G6") for rt in ("A", "R")]
    + [_spec("R", 1, "IN", repr(FORBIDDEN_KEYS), "E002", "G7", "S2")]
    + [_spec("A", 3, "LENGTHCHECK", "10", "E002", "G2"),
       dict(ObjectName=_OBJ, Operator="BASELINEQUERY",
            ObjectFieldValue="SELECT COUNT(*) AS n FROM ll_lines_<COUNTRY_PLACEHOLDER>_datasource_suffix "
                             "UNION ALL SELECT COUNT(*) FROM ll_lines_<COUNTRY_PLACEHOLDER>_datasource_suffix "
                             "WHERE line LIKE 'R%'",
            ErrorCode="E001")]
)


def _lines(t: Tables):
    """One record per lineitem row: type|"orderkey|"date|"amount|"hours|"wagetype|"country|"currency."""
    k = F.col("l_orderkey")
    amount = F.col("l_extendedprice").cast("decimal(15,2)").cast("string")
    date = (F.when(k % 17 == 0, F.concat(F.year("l_shipdate").cast("string"), F.lit("0230")))
            .when(k % 19 == 0, F.date_format("l_shipdate", "yyyy-MM-dd"))
            .otherwise(F.date_format("l_shipdate", "yyyyMMdd")))
    amt = (F.when(k % 13 == 0, F.concat(amount, F.lit("x")))
           .when(k % 23 == 0, F.lit(""))
           .when(k % 29 == 0, F.concat(F.lit("x"), amount))
           .otherwise(amount))
    hours = F.when(k % 11 == 0, F.lit("1,5")).otherwise(F.col("l_quantity").cast("int").cast("string"))
    wt = F.when(k % 31 == 0, F.lit("")).otherwise(F.col("p_brand"))
    ccy = F.concat(F.lit("CUR"), (F.col("s_nationkey") % 5).cast("string"))
    li = (t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
          .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
          .join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")))
    line = F.concat_ws('|"', F.col("l_returnflag"), k.cast("string"), date, amt, hours, wt, F.col("n_name"), ccy)
    return li.select("l_orderkey", "l_linenumber", line.alias("line"))


def _refs(t: Tables) -> RC.References:
    p = t.part
    rt = F.when(F.col("p_partkey") % 3 == 0, F.lit("A")).when(F.col("p_partkey") % 3 == 1, F.lit("N")).otherwise(F.lit("R"))
    wagetypes = p.where(F.col("p_size") <= 2).select(F.col("p_brand").alias("Wagetype"), rt.alias("Infotype"))
    infotypes = p.where(F.col("p_size").between(3, 5)).select(F.lit(RUN_COUNTRY).alias("Country"),
                                                              rt.alias("Infotype"), F.col("p_brand").alias("Wagetype"))
    ck = t.nation.select(F.col("n_name").alias("CountryKey"),
                         F.concat(F.lit("CUR"), (F.col("n_nationkey") % 5).cast("string")).alias("CurrencyKey"))
    wtc = p.where(F.col("p_size") > 45).select(
        F.lit(RUN_COUNTRY).alias("Country"), F.col("p_brand").alias("WageType"), F.lit(SOURCE).alias("DataSource"),
        F.concat(F.lit("CUR"), (F.col("p_size") % 5).cast("string")).alias("CurrencyKey"))
    return RC.References(RUN_COUNTRY, SOURCE, wagetypes, infotypes, ck, wtc)


def _compiled(t: Tables, specs=RECORD_SPECS):
    sp = t.spark
    ctx = R.RunContext(ORCHESTRATOR, "dag06", "ASIA", SOURCE, RUN_DATE, component="core", now=FIXED_NOW)
    fm = C.fields_map(sp, FILE_FIELDS)
    rules = R.resolve_rules(C.rules_config(t, specs), C.error_map(sp), C.severity_map(sp), fm,
                            C.vendor_region(sp), ctx, [RUN_COUNTRY])
    scoped = RC.file_scope(rules, VENDOR, REGION_LC, RUN_COUNTRY, SOURCE_PATH, SOURCE_OBJECT)
    return RC.compile_rules(sp, scoped)


def _refs_from_rules(t: Tables, compiled) -> RC.References:
    """References built the way the rules describe them: the WAGETYPECHECK / INFOTYPECOMBINATIONFORMAT
    rules carry the queries that produce their reference sets (over tables registered as views)."""
    base = _refs(t)
    base.wagetypes.createOrReplaceTempView("ll_wagetypes_" + RUN_COUNTRY.lower())
    base.infotypes.createOrReplaceTempView("ll_infotypes")
    wt = RC.reference_frame(t.spark, compiled.wagetype_queries, ["Wagetype", "Infotype"], RUN_COUNTRY, REGION_LC, "core")
    it = RC.reference_frame(t.spark, compiled.infotype_queries, ["Country", "Infotype", "Wagetype"], RUN_COUNTRY,
                            REGION_LC, "core")
    return RC.References(RUN_COUNTRY, SOURCE, wt, it, base.currencykey, base.wagetype_currency)


def _checked(t: Tables):
    # failing lines are removed by value: identical lines go together
    compiled = _compiled(t)
    return RC.check_and_split(_lines(t), compiled, _refs_from_rules(t, compiled))


def _violations(t: Tables):
    return _checked(t)[0]


VIOL_COLS = ["l_orderkey", "l_linenumber", "line", "record_type", "field_index", "operator", "value",
             "errorseverity", "type", "errordescription", "erroridentifier", "recommendation"]

# ----------------------------------------------------------------------------- SQL oracle

_LINES_SQL = """lines AS (SELECT l_orderkey, l_linenumber, concat_ws('|"', l_returnflag, CAST(l_orderkey AS VARCHAR),
    CASE WHEN l_orderkey % 17 = 0 THEN CAST(year(l_shipdate) AS VARCHAR) || '0230'
         WHEN l_orderkey % 19 = 0 THEN strftime(l_shipdate, '%Y-%m-%d') ELSE strftime(l_shipdate, '%Y%m%d') END,
    CASE WHEN l_orderkey % 13 = 0 THEN CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS VARCHAR) || 'x'
         WHEN l_orderkey % 23 = 0 THEN ''
         WHEN l_orderkey % 29 = 0 THEN 'x' || CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS VARCHAR)
         ELSE CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS VARCHAR) END,
    CASE WHEN l_orderkey % 11 = 0 THEN '1,5' ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END,
    CASE WHEN l_orderkey % 31 = 0 THEN '' ELSE p_brand END, n_name, 'CUR' || CAST(s_nationkey % 5 AS VARCHAR)) AS line
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey),
p AS (SELECT *, string_split(line, '|"') AS f, string_split(line, '|"')[1] AS record_type FROM lines),
rt AS (SELECT p_brand, p_size, CASE WHEN p_partkey % 3 = 0 THEN 'A' WHEN p_partkey % 3 = 1 THEN 'N' ELSE 'R' END AS it FROM part),
wt AS (SELECT DISTINCT p_brand AS Wagetype, it AS Infotype FROM rt WHERE p_size <= 2),
itr AS (SELECT DISTINCT 'NATION_7' AS Country, it AS Infotype, p_brand AS Wagetype FROM rt WHERE p_size BETWEEN 3 AND 5),
ck AS (SELECT (SELECT min('CUR' || CAST(n_nationkey % 5 AS VARCHAR)) FROM nation WHERE n_name = 'NATION_7') AS c),
wtc AS (SELECT p_brand AS WageType, min('CUR' || CAST(p_size % 5 AS VARCHAR)) AS c FROM part WHERE p_size > 45 GROUP BY p_brand)"""


def _sql_desc(desc, pairs):
    return f"'{desc};' || " + " || '|' || ".join(f"'{n}:' || coalesce(f[{i + 1}], '')" for i, n in pairs)


_ERR = {c: (d, t) for c, d, t in C.ERROR_MAP}
_SEV = dict(C.SEVERITY_MAP)


def _sql_rule(rt, idx, op, err, sev, pairs, ident, cond, rec="Fix the record"):
    desc, typ = _ERR[err]
    return (f"SELECT l_orderkey, l_linenumber, line, record_type, {idx} AS field_index, '{op}' AS operator, "
            f"f[{idx + 1}] AS value, '{_SEV[sev]}' AS errorseverity, '{typ}' AS type, "
            f"{_sql_desc(desc, pairs)} AS errordescription, {ident} AS erroridentifier, '{rec}' AS recommendation "
            f"FROM p WHERE record_type = '{rt}' AND len(f) > {idx} AND ({cond})")


def _v(i):
    return f"f[{i + 1}]"


_WT_IDX = 5
_SQL_PIECES = (
    [_sql_rule(rt, 2, "DATEFORMAT", "E005", "S1", [(1, "OrderKey"), (2, "ShipDate")], "'ShipDate'",
               f"NOT regexp_matches({_v(2)}, '^(?:{DATE_RX})') OR try_strptime({_v(2)}, '%Y%m%d') IS NULL")
     for rt in ("A", "N", "R")]
    + [_sql_rule(rt, 3, "AMOUNTFORMAT", "E001", "S2", [(1, "OrderKey"), (3, "Amount")], "'Amount'",
                 f"{_v(3)} <> '' AND NOT regexp_matches({_v(3)}, '^(?:{AMOUNT_RX})')") for rt in ("A", "N", "R")]
    + [_sql_rule(rt, 4, "HOURSFORMAT", "E002", "S2", [(1, "OrderKey"), (4, "Hours")], "'Hours'",
                 f"{_v(4)} <> '' AND NOT regexp_matches({_v(4)}, '^(?:{HOURS_RX})')") for rt in ("A", "N")]
    + [_sql_rule(rt, 5, "WAGETYPECHECK", "E003", "S1", [(1, "OrderKey"), (5, "WageType")], "'WageType'",
                 f"{_v(5)} = '' OR NOT EXISTS (SELECT 1 FROM wt WHERE wt.Infotype = p.record_type AND wt.Wagetype = {_v(5)})")
       for rt in ("A", "N", "R")]
    + [_sql_rule("A", 5, "INFOTYPECOMBINATIONFORMAT", "E003", "S1", [(1, "OrderKey"), (5, "WageType")], "'WageType'",
                 f"{_v(5)} = '' OR NOT EXISTS (SELECT 1 FROM itr WHERE itr.Country = 'NATION_7' "
                 f"AND itr.Infotype = p.record_type AND itr.Wagetype = {_v(5)})")]
    + [_sql_rule(rt, 6, "COUNTRYCHECK", "E004", "S1", [(1, "OrderKey"), (6, "Country")], "'Country'",
                 f"{_v(6)} IS DISTINCT FROM 'NATION_7'") for rt in ("A", "R")]
    + [_sql_rule("N", 6, "NOTIN", "E004", "S2", [(6, "Country"), (1, "OrderKey"), (9, "Missing")], "'Country'",
                 f"NOT list_contains({ALLOWED_NATIONS!r}, {_v(6)})")]
    + [_sql_rule("N", 7, "CURRENCYCHECK", "E001", "S1", [(1, "OrderKey"), (5, "WageType"), (7, "Currency")],
                 "'Currency'", f"{_v(7)} IS DISTINCT FROM (SELECT c FROM ck)")]
    + [_sql_rule(rt, 7, "WAGETYPECURRENCYCHECK", "E001", "S1", [(1, "OrderKey"), (5, "WageType"), (7, "Currency")],
                 "'Currency'", f"{_v(7)} IS DISTINCT FROM coalesce((SELECT c FROM wtc WHERE wtc.WageType = {_v(_WT_IDX)}), "
                 "(SELECT c FROM ck))") for rt in ("A", "R")]
    + [_sql_rule("R", 1, "IN", "E002", "S2", [(1, "OrderKey")], "'OrderKey'",
                 f"list_contains({list(FORBIDDEN_KEYS)!r}, {_v(1)})")]
)

VIOLATIONS_CTE = f"WITH {_LINES_SQL},\nviol AS (" + "\nUNION ALL\n".join(_SQL_PIECES) + ")"

_OP_QUERIES = {
    "record_in": "IN", "record_notin": "NOTIN", "record_dateformat": "DATEFORMAT",
    "record_amountformat": "AMOUNTFORMAT", "record_hoursformat": "HOURSFORMAT",
    "record_infotype": "INFOTYPECOMBINATIONFORMAT", "record_wagetype": "WAGETYPECHECK",
    "record_country": "COUNTRYCHECK", "record_currency": "CURRENCYCHECK",
    "record_wagetype_currency": "WAGETYPECURRENCYCHECK",
}


def _make_op_query(name, op):
    sql = f"{VIOLATIONS_CTE}\nSELECT {', '.join(VIOL_COLS)} FROM viol WHERE operator = '{op}'"

    @query(name, sql)
    def _q(spark, sf_dir):
        t = Tables(spark, sf_dir)
        return _violations(t).where(F.col("operator") == op).select(*VIOL_COLS)

    _q.__doc__ = f"Record-file check {op}: one row per violating (line, rule)."
    return _q


for _name, _op in _OP_QUERIES.items():
    _make_op_query(_name, _op)


RECORD_CLEAN_SQL = (f"{VIOLATIONS_CTE}\nSELECT l_orderkey, l_linenumber, line FROM lines "
                    "WHERE NOT EXISTS (SELECT 1 FROM viol v WHERE v.line = lines.line)")
RECORD_FAILED_SQL = (f"{VIOLATIONS_CTE}\nSELECT l_orderkey, l_linenumber, line FROM lines "
                     "WHERE EXISTS (SELECT 1 FROM viol v WHERE v.line = lines.line)")


@query("record_clean", RECORD_CLEAN_SQL)
def record_clean(spark, sf_dir):
    """Lines with no violation of any rule type (warnings remove a line too)."""
    _, clean, _ = _checked(Tables(spark, sf_dir))
    return clean.select("l_orderkey", "l_linenumber", "line")


@query("record_failed", RECORD_FAILED_SQL)
def record_failed(spark, sf_dir):
    """Lines removed from the file because they broke at least one rule."""
    _, _, failed = _checked(Tables(spark, sf_dir))
    return failed.select("l_orderkey", "l_linenumber", "line")


SEND_LOG_SQL = (f"{VIOLATIONS_CTE}\nSELECT '{ORCHESTRATOR}' AS orchestratorid, 'dag06' AS stage, 'asia' AS region, "
                f"'{RUN_COUNTRY}' AS country, '{SOURCE}' AS source, 'core' AS sourcecomponent, "
                f"'{SOURCE_PATH}{SOURCE_OBJECT}.csv' AS objectname, errorseverity, type, errordescription, "
                f"erroridentifier, DATE '{RUN_DATE}' AS createddttm, recommendation FROM viol")


@query("record_send_log", SEND_LOG_SQL)
def record_send_log(spark, sf_dir):
    """Validation-log rows of the record-file check of one output file (I4)."""
    t = Tables(spark, sf_dir)
    log = RC.send_log_rows(_violations(t), ORCHESTRATOR, "dag06", REGION_LC, RUN_COUNTRY, SOURCE, "core",
                           f"{SOURCE_PATH}{SOURCE_OBJECT}.csv", RUN_DATE, FIXED_NOW)
    return log.drop("recordtimestamp")


SEND_SUMMARY_SQL = (f"{VIOLATIONS_CTE},\nagg AS (SELECT (SELECT count(*) FROM lines) + "
                    "(SELECT count(*) FROM lines WHERE line LIKE 'R%') AS baseline, "
                    "(SELECT count_if(type = 'Error') FROM viol) AS stagefailure, "
                    "abs((SELECT count(*) FROM lines WHERE trim(line) <> '') - (SELECT count(*) FROM lineitem)) "
                    "AS g2vsviewcountfailure, CAST(150.0 AS DOUBLE) AS thresholdpercentage),\n"
                    "t AS (SELECT *, stagefailure + g2vsviewcountfailure AS totalfailure FROM agg),\n"
                    "pc AS (SELECT *, CASE WHEN baseline = 0 OR totalfailure = 0 THEN 0.0 "
                    "ELSE round_even(totalfailure / baseline * 100.0, 2) END AS errorpercentage FROM t)\n"
                    f"SELECT DATE '{RUN_DATE}' AS executiondate, '{ORCHESTRATOR}' AS orchestratorid, 'asia' AS region, "
                    f"'{RUN_COUNTRY}' AS country, '{SOURCE}' AS source, 'core' AS sourcecomponent, "
                    "CAST(stagefailure AS BIGINT) AS stagefailure, CAST(g2vsviewcountfailure AS BIGINT) AS g2vsviewcountfailure, "
                    "CAST(totalfailure AS BIGINT) AS totalfailure, thresholdpercentage, errorpercentage, "
                    "CASE WHEN errorpercentage = 0 THEN 'Success' WHEN errorpercentage > thresholdpercentage "
                    "THEN 'Failure' ELSE 'Partial' END AS status FROM pc")


def _stored_lines(t: Tables, path: str | None = None):
    """The record file as it lies in storage (at ``path``); the baseline query reads it by its dated name."""
    from ..session import keep, scratch_path
    lines = keep(_lines(t), path or scratch_path(t.spark, "payfile"))
    lines.createOrReplaceTempView("ll_lines_nation_7_" + RUN_DATE.replace("-", "_"))
    return lines


_SEND = dict(orchestrator_id=ORCHESTRATOR, stage="dag06", region=REGION_LC, country=RUN_COUNTRY, source=SOURCE, component="core",
             vendor=VENDOR, objectname=f"{SOURCE_PATH}{SOURCE_OBJECT}.csv", run_date=RUN_DATE, threshold="150", now=FIXED_NOW)


@query("record_send_summary", SEND_SUMMARY_SQL)
def record_send_summary(spark, sf_dir):
    """Summary row of a record-file check through the composed I4 operator: baseline from the
    file's BASELINEQUERY rule (E5), Error count, file vs view count, half-even percentage, status."""
    from ..operators.send import send_check
    from .q_files import _stage_map
    t = Tables(spark, sf_dir)
    res = send_check(spark, _stored_lines(t), _compiled(t), _refs(t), [t.lineitem], None, _stage_map(spark), **_SEND)
    return res.summary.drop("logtimestamp")


def _send_written(t: Tables, runs: int) -> str:
    """The file check with its writes, ``runs`` times over the same tables; returns their folder.  The stored record file goes once
    all runs are done."""
    from ..operators.send import run_send_check
    from ..session import drop_scratch, scratch_path
    from .q_files import _stage_map
    base = scratch_path(t.spark, "send")
    lines, compiled = _stored_lines(t, f"{base}/payfile"), _compiled(t)
    refs = _refs_from_rules(t, compiled)
    for _ in range(runs):
        run_send_check(t.spark, lines, compiled, refs, [t.lineitem], _stage_map(t.spark), log_path=f"{base}/log",
                       summary_path=f"{base}/summary", clean_path=f"{base}/clean", failed_path=f"{base}/failed",
                       log_file_path=f"{base}/logfile", order=[F.col("l_orderkey"), F.col("l_linenumber")],
                       failed_compression="gzip", **_SEND)
    drop_scratch(t.spark, f"{base}/payfile")
    return base


@query("record_send_written", SEND_SUMMARY_SQL)
def record_send_written(spark, sf_dir):
    """The record-file check with its writes (log slice, summary, clean file, removed lines, error-log file) into the shared
    scratch folder; the written summary is read back (I4 end to end)."""
    base = _send_written(Tables(spark, sf_dir), 1)
    return spark.read.parquet(f"{base}/summary").select(
        "executiondate", "orchestratorid", "region", "country", "source", "sourcecomponent", "stagefailure",
        "g2vsviewcountfailure", "totalfailure", "thresholdpercentage", "errorpercentage", "status")


def _sql_entry(c):
    s = f"coalesce(CAST({c} AS VARCHAR), '')"
    return f"CASE WHEN contains({s}, ',') OR {s} = ' ' THEN '\"' || {s} || '\"' ELSE {s} END"


_SEND_INFO = ["'2024-01-15 12:00:00'", f"'{RUN_DATE}'", "'asia'", f"'{RUN_COUNTRY}'", f"'{SOURCE}'", "'core'",
              "CAST(stagefailure AS VARCHAR)", "CAST(g2vsviewcountfailure AS VARCHAR)", "CAST(baseline AS VARCHAR)",
              "CAST(totalfailure AS VARCHAR)", "CAST(thresholdpercentage AS VARCHAR)", "CAST(errorpercentage AS VARCHAR)", "status"]

SEND_RERUN_SQL = f"""{SEND_SUMMARY_SQL.split("SELECT DATE")[0].rstrip()},
sm AS (SELECT *, CASE WHEN errorpercentage = 0 THEN 'Success' WHEN errorpercentage > thresholdpercentage THEN 'Failure'
    ELSE 'Partial' END AS status FROM pc),
lg AS (SELECT '{ORCHESTRATOR}' AS orchestratorid, 'dag06' AS stage, 'File checks' AS stagedescription, 'asia' AS region,
    '{RUN_COUNTRY}' AS country, '{SOURCE}' AS source, 'core' AS sourcecomponent, '{SOURCE_PATH}{SOURCE_OBJECT}.csv' AS objectname,
    errorseverity, type, erroridentifier, DATE '{RUN_DATE}' AS createddttm, TIMESTAMP '2024-01-15 12:00:00' AS recordtimestamp,
    errordescription, recommendation FROM viol)
SELECT 'summary' AS output, 1 AS n, concat_ws('|', {', '.join(_SEND_INFO)}) AS line FROM sm
UNION ALL SELECT 'log', count(*), errordescription || '|' || coalesce(erroridentifier, '') FROM lg GROUP BY errordescription, erroridentifier
UNION ALL SELECT 'clean', count(*), line FROM lines WHERE NOT EXISTS (SELECT 1 FROM viol v WHERE v.line = lines.line) GROUP BY line
UNION ALL SELECT 'failed', count(*), line FROM lines WHERE EXISTS (SELECT 1 FROM viol v WHERE v.line = lines.line) GROUP BY line
UNION ALL SELECT 'logfile', count(*), line FROM (
  SELECT unnest([{', '.join(f"'{lbl} : ' || {v}" for lbl, v in zip(K.ERROR_LOG_INFO_LABELS, _SEND_INFO))}]) AS line FROM sm
  UNION ALL SELECT '{','.join(K.ERROR_LOG_FILE_COLUMNS)}' WHERE EXISTS (SELECT 1 FROM lg)
  UNION ALL SELECT concat_ws(',', {', '.join(_sql_entry(c) for c in K.ERROR_LOG_FILE_COLUMNS)}) FROM lg) GROUP BY line"""


@query("record_send_rerun", SEND_RERUN_SQL)
def record_send_rerun(spark, sf_dir):
    """The file check run twice: every output of the second run, read back from storage, equals the first's."""
    base = _send_written(Tables(spark, sf_dir), 2)
    total = (spark.read.text(f"{base}/logfile").where(F.col("value").startswith("Total Base Record : "))
             .select(F.substring_index("value", " : ", -1)))
    s = spark.read.parquet(f"{base}/summary").withColumn("baseline", total.scalar())
    info = [F.col(c) for c in ("logtimestamp", "executiondate", "region", "country", "source", "sourcecomponent", "stagefailure",
                               "g2vsviewcountfailure", "baseline", "totalfailure", "thresholdpercentage", "errorpercentage", "status")]
    out = s.select(F.lit("summary").alias("output"), F.concat_ws("|", *[c.cast("string") for c in info]).alias("line"))
    log = spark.read.parquet(f"{base}/log").select(
        F.lit("log").alias("output"), F.concat("errordescription", F.lit("|"), F.coalesce("erroridentifier", F.lit(""))).alias("line"))
    out = out.unionByName(log)
    for name in ("clean", "failed", "logfile"):
        out = out.unionByName(spark.read.text(f"{base}/{name}").select(F.lit(name).alias("output"), F.col("value").alias("line")))
    return out.groupBy("output", "line").agg(F.count(F.lit(1)).alias("n"))
