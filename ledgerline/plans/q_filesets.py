"""Registered queries: files with their own configuration and their writes, numbered and merged line files, disjoint slices,
staged tables, flags by component, and stream identity (J8, I4, C14, J9, B2, B5, B6, B7, B9, E12, D3, K1)."""

from __future__ import annotations

import datetime as _dt
import json

from pyspark.sql import functions as F

from ..operators import filesets as FS
from ..operators import records as RC
from ..operators import render as RD
from ..operators import rules as R
from ..operators import staging as ST
from ..operators import thresholds as TH
from ..session import scratch_path, store
from ..sinks import lines as LN
from ..sinks import slices as SL
from ..sinks.tables import _fs, _rename
from ..streaming import landing as LD
from . import config as C
from . import q_files as QF
from . import q_io as QI
from . import q_records as QR
from . import q_rules as QRL
from .registry import query
from .tables import FIXED_NOW, ORCHESTRATOR, RUN_DATE, SOURCE, Tables

# ----------------------------------------------------------------------------- J8: every file by its own configuration

LAYOUT_DOCS = {
    "pay.json": {"Headers": {"IsFixed": True, "Values": ["HDR|PAY", "V2"]},
                 "Body": [{"Repeat": False, "Layout": "PERIOD|{GetPeriodStartDate}", "Variables": [{"FunctionName": "GetPeriodStartDate"}]},
                          {"Repeat": True, "Layout": '0015|"{Id}|"{Amount}|"{Land}|"{Currency}|"{Priority}',
                           "Variables": [{"ViewFieldName": c} for c in ("Id", "Amount", "Land", "Currency", "Priority")]}]},
    "held.json": {"Headers": {"IsFixed": False, "HeaderFunction": "GetHeader"},
                  "Body": [{"Repeat": True, "Layout": '0020|"{Id}|"{Priority}|"{Land}',
                            "Variables": [{"ViewFieldName": c} for c in ("Id", "Priority", "Land")]}],
                  "Footers": [{"Value": "TRL|{TotalLineCount}"}]},
}

_PATH = "vend1/asia/out/"


def _spec(rt, idx, op, val, err, fc, sev="S1"):
    return dict(ObjectName="out/payfile_<COUNTRY_PLACEHOLDER>", AdditionalCondition=rt, ObjectField=str(idx), Operator=op,
                ObjectFieldValue=val, ErrorCode=err, FieldsCode=fc, SeverityID=sev, Recommendation="Fix the record")


FILE_SPECS = [_spec("0015", 2, "AMOUNTFORMAT", QR.AMOUNT_RX, "E001", "H1"), _spec("0015", 3, "COUNTRYCHECK", "", "E004", "H2"),
              _spec("0015", 4, "CURRENCYCHECK", "", "E001", "H3"), _spec("0015", 5, "WAGETYPECHECK", "by country", "E003", "H4"),
              _spec("0020", 3, "COUNTRYCHECK", "", "E004", "H2"), _spec("0020", 2, "NOTIN", repr(QF.PRIORITIES), "E002", "H5", "S2")]
OWN_SPECS = [_spec("0015", 1, "IN", "('7', '77', '777', '7777')", "E005", "H6"),
             dict(_spec("0015", 1, "IN", "('1')", "E005", "H6"), ObjectName="elsewhere/payfile")]
OWN_COUNTRIES = "NATION_3,NATION_7"
HELD_FIELDS = [("H1", "{1: 'Id', 2: 'Amount'}"), ("H2", "{1: 'Id', 3: 'Land'}"), ("H3", "{1: 'Id', 4: 'Currency'}"),
               ("H4", "{1: 'Id', 5: 'Priority'}"), ("H5", "{1: 'Id', 2: 'Priority'}"), ("H6", "{1: 'Id'}")]


def _view_base(t: Tables):
    k, n = F.col("o_orderkey"), F.col("n_nationkey")
    return (t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == n)
            .select("n_name", "o_orderkey", k.cast("string").alias("Id"),
                    F.when(k % 97 == 0, F.lit("x")).otherwise(F.col("o_totalprice").cast("decimal(15,2)").cast("string")).alias("Amount"),
                    F.when(k % 41 == 0, F.lit("NOWHERE")).otherwise(F.col("n_name")).alias("Land"),
                    F.when(k % 43 == 0, F.lit("CUR9")).otherwise(F.concat(F.lit("CUR"), (n % 5).cast("string"))).alias("Currency"),
                    F.when(k % 50 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderpriority")).alias("Priority"),
                    F.col("o_orderstatus").alias("Status")))


def _files(t: Tables):
    """One row per nation; views, layouts, order, functions, flags and names differ."""
    k = F.col("n_nationkey")
    day = F.date_add(F.lit(RUN_DATE).cast("date"), k * 20)  # the file's own requested date
    month = F.date_format(day, "MM")
    return t.nation.select(
        "n_name", F.col("n_name").alias("country"), F.lit("vend1").alias("Vendor"), F.lit("asia").alias("Region"),
        F.lit(_PATH).alias("source_path"),
        F.when(k % 4 == 3, "open").when(k % 2 == 0, "open,other").otherwise(" other, open").alias("OutputViewName"),
        F.when(k % 4 == 3, "pay.json").when(k % 2 == 0, "pay.json,held.json").otherwise("held.json,pay.json").alias("LayoutPath"),
        F.when(k % 3 == 0, "Priority, o_orderkey").when(k % 3 == 1, "o_orderkey").otherwise("Id").alias("OrderByColumn"),
        F.create_map(F.lit("GetPeriodStartDate"), F.trunc(day, "month").cast("string"),
                     F.lit("GetHeader"), F.concat(F.lit("HEAD|"), "n_name", F.lit("|"), month)).alias("functions"),
        month.alias("month"), (k % 5 != 0).alias("check_enabled"), (k % 2 == 0).alias("override"), (k % 6 == 0).alias("skip"),
        F.when(k % 3 == 0, "").when(k % 3 == 1, "9").otherwise("35").alias("threshold"),
        F.when(k % 4 == 0, "calculatedFileName").otherwise(F.concat(F.lit(" OUT_"), "n_name")).alias("OutputFileName"),
        F.when(k % 3 == 0, ".SAP").otherwise(".csv").alias("OutputFileExtension"))


def _file_references(t: Tables) -> RC.References:
    n = F.col("n_nationkey")
    currencies = t.nation.select(F.col("n_name").alias("CountryKey"), F.concat(F.lit("CUR"), (n % 5).cast("string")).alias("CurrencyKey"))
    # NATION_8 has no wage types: its check is skipped
    wagetypes = (t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == n)
                 .where(((n + F.substring("o_orderpriority", 1, 1).cast("int")) % 4 != 0) & (F.col("n_name") != "NATION_8"))
                 .select(F.col("n_name").alias("Country"), F.lit("0015").alias("Infotype"), F.col("o_orderpriority").alias("Wagetype")).distinct())
    return RC.References(datasource=SOURCE, wagetypes=wagetypes, currencykey=currencies, country_col="country")


def _file_set(t: Tables):
    sp = t.spark
    files = _files(t)
    ctx = R.RunContext(ORCHESTRATOR, "dag06", "ASIA", SOURCE, RUN_DATE, component="core", now=FIXED_NOW)
    config = C.rules_config(t, FILE_SPECS).unionByName(C.rules_config(t, OWN_SPECS, OWN_COUNTRIES))
    rules = R.resolve_rules(config, C.error_map(sp), C.severity_map(sp), C.fields_map(sp, HELD_FIELDS), C.vendor_region(sp), ctx)
    compiled, bits = RC.compile_file_rules(FS.file_rules(rules, files, "n_name"), "n_name")
    layouts = FS.parse_layouts(sp.createDataFrame([(n, json.dumps(d)) for n, d in LAYOUT_DOCS.items()], "layout string, text string"))
    base = _view_base(t)
    views = {"open": base.where(F.col("Status") == "O"), "other": base.where(F.col("Status") != "O")}
    return files, FS.generate_file_set(files, views, layouts, "n_name", compiled, bits, _file_references(t))


_SET_SQL = f"""WITH vb AS (SELECT n_name, n_nationkey AS nk, o_orderkey AS ok, CAST(o_orderkey AS VARCHAR) AS Id,
    CASE WHEN o_orderkey % 97 = 0 THEN 'x' ELSE CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) END AS Amount,
    CASE WHEN o_orderkey % 41 = 0 THEN 'NOWHERE' ELSE n_name END AS Land,
    CASE WHEN o_orderkey % 43 = 0 THEN 'CUR9' ELSE 'CUR' || CAST(n_nationkey % 5 AS VARCHAR) END AS Currency,
    CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_orderpriority END AS Priority, o_orderstatus AS Status
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
fl AS (SELECT n_name, n_nationkey AS nk, n_nationkey % 5 <> 0 AS chk, n_nationkey % 2 = 0 AS ovr, n_nationkey % 6 = 0 AS skp,
    CASE n_nationkey % 3 WHEN 0 THEN 0.0 WHEN 1 THEN 9.0 ELSE 35.0 END AS limit_,
    CASE WHEN n_nationkey % 4 = 3 THEN 0 WHEN n_nationkey % 2 = 0 THEN 1 ELSE 0 END AS open_rank,
    CASE WHEN n_nationkey % 4 = 3 THEN NULL WHEN n_nationkey % 2 = 0 THEN 0 ELSE 1 END AS other_rank,
    CAST(DATE '{RUN_DATE}' + CAST(20 * n_nationkey AS INTEGER) AS DATE) AS day FROM nation),
body AS (
  SELECT n_name, nk, open_rank AS view_rank, 0 AS block, NULL AS ok, NULL AS Id, NULL AS prio, FALSE AS own,
    'PERIOD|' || strftime(date_trunc('month', day), '%Y-%m-%d') AS line FROM fl
  UNION ALL SELECT n_name, vb.nk, open_rank, 1, ok, Id, Priority, TRUE, '0015|"' || Id || '|"' || Amount || '|"' || Land || '|"' || Currency || '|"'
    || coalesce(Priority, '') FROM vb JOIN fl USING (n_name) WHERE Status = 'O'
  UNION ALL SELECT n_name, vb.nk, other_rank, 0, ok, Id, Priority, TRUE, '0020|"' || Id || '|"' || coalesce(Priority, '') || '|"' || Land
    FROM vb JOIN fl USING (n_name) WHERE Status <> 'O' AND other_rank IS NOT NULL),
p AS (SELECT body.*, string_split(line, '|"') AS f, chk FROM body JOIN fl USING (n_name)),
wt AS (SELECT DISTINCT n_name, o_orderpriority AS v FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    WHERE (n_nationkey + CAST(o_orderpriority[1] AS INTEGER)) % 4 <> 0 AND n_name <> 'NATION_8'),
viol AS (
  SELECT n_name, line, 'AMOUNTFORMAT' AS operator, 'Error' AS type FROM p WHERE chk AND f[1] = '0015' AND f[3] <> '' AND NOT regexp_matches(f[3], '^(?:{QR.AMOUNT_RX})')
  UNION ALL SELECT n_name, line, 'COUNTRYCHECK', 'Error' FROM p WHERE chk AND f[1] IN ('0015', '0020') AND f[4] <> n_name
  UNION ALL SELECT n_name, line, 'CURRENCYCHECK', 'Error' FROM p WHERE chk AND f[1] = '0015' AND f[5] <> 'CUR' || CAST(nk % 5 AS VARCHAR)
  UNION ALL SELECT n_name, line, 'WAGETYPECHECK', 'Error' FROM p WHERE chk AND f[1] = '0015' AND n_name IN (SELECT n_name FROM wt)
    AND (f[6] = '' OR NOT EXISTS (SELECT 1 FROM wt WHERE wt.n_name = p.n_name AND wt.v = p.f[6]))
  UNION ALL SELECT n_name, line, 'NOTIN', 'Warning' FROM p WHERE chk AND f[1] = '0020' AND NOT list_contains({QF.PRIORITIES!r}, f[3])
  UNION ALL SELECT n_name, line, 'IN', 'Error' FROM p WHERE chk AND f[1] = '0015' AND n_name IN ('NATION_3', 'NATION_7')
    AND list_contains(['7', '77', '777', '7777'], f[2])),
clean AS (SELECT * FROM body b WHERE NOT EXISTS (SELECT 1 FROM viol v WHERE v.n_name = b.n_name AND v.line = b.line)),
cnt AS (SELECT n_name, count_if(own) AS baseline, abs(count(*) - count_if(own)) AS mismatch FROM body GROUP BY n_name),
s0 AS (SELECT fl.*, CAST(cnt.baseline AS BIGINT) AS baseline, cnt.mismatch, coalesce(vf.failures, 0) AS failures FROM fl JOIN cnt USING (n_name)
    LEFT JOIN (SELECT n_name, CAST(count_if(type = 'Error') AS BIGINT) AS failures FROM viol GROUP BY n_name) vf USING (n_name)),
s1 AS (SELECT *, failures + mismatch AS total FROM s0),
s2 AS (SELECT *, CASE WHEN baseline = 0 OR total = 0 THEN 0.0 ELSE round_even(total / baseline * 100.0, 2) END AS pct FROM s1),
s3 AS (SELECT *, CASE WHEN pct = 0 THEN 'Success' WHEN pct > limit_ THEN 'Failure' ELSE 'Partial' END AS status FROM s2),
st AS (SELECT *, CASE WHEN chk AND status = 'Failure' AND NOT ovr THEN 'failed' WHEN skp THEN 'skipped' ELSE 'success' END AS route FROM s3),
ln AS (
  SELECT n_name, 0 AS section, NULL AS view_rank, b AS block, NULL AS ok, NULL AS Id, NULL AS prio, l AS line FROM st,
    (VALUES (0, 'HDR|PAY'), (1, 'V2')) h(b, l) WHERE route <> 'failed' AND open_rank = 0
  UNION ALL SELECT n_name, 0, NULL, 0, NULL, NULL, NULL, 'HEAD|' || n_name || '|' || strftime(day, '%m') FROM st WHERE route <> 'failed' AND other_rank = 0
  UNION ALL SELECT n_name, 1, view_rank, block, ok, Id, prio, line FROM clean
  UNION ALL SELECT n_name, 2, NULL, 0, NULL, NULL, NULL, 'TRL|' || CAST((SELECT count(*) FROM clean c WHERE c.n_name = st.n_name) + 2 AS VARCHAR)
    FROM st WHERE route <> 'failed' AND other_rank = 0),
num AS (SELECT ln.n_name, route, line, row_number() OVER (PARTITION BY ln.n_name ORDER BY section, view_rank NULLS FIRST, block,
    CASE st.nk % 3 WHEN 0 THEN prio WHEN 2 THEN Id END NULLS FIRST, CASE WHEN st.nk % 3 < 2 THEN ok END NULLS FIRST, line) AS line_no
  FROM ln JOIN st USING (n_name))"""


@query("files_by_country", f"{_SET_SQL}\nSELECT n_name, route, line_no, line FROM num")
def files_by_country(spark, sf_dir):
    """Every nation's file by its own views, layouts, order, rules, country and flags, with line numbers."""
    _, result = _file_set(Tables(spark, sf_dir))
    return LN.number_lines(result.lines, ["n_name"], FS.line_order()).select("n_name", "route", "line_no", "line")


@query("files_by_country_status", f"""{_SET_SQL}
SELECT n_name, baseline, failures AS stagefailure, CAST(mismatch AS BIGINT) AS g2vsviewcountfailure, CAST(limit_ AS DOUBLE) AS thresholdpercentage,
  CAST(pct AS DOUBLE) AS errorpercentage, status, route FROM st""")
def files_by_country_status(spark, sf_dir):
    """Counts, percentage, status and route of every file, each against its own threshold."""
    _, result = _file_set(Tables(spark, sf_dir))
    return result.status.select("n_name", "baseline", "stagefailure", "g2vsviewcountfailure", "thresholdpercentage", "errorpercentage",
                                "status", "route")


@query("files_by_country_log", f"{_SET_SQL}\nSELECT n_name, line, operator, type FROM viol")
def files_by_country_log(spark, sf_dir):
    """What each file's own rules found: country, currency and wage types of its own country."""
    _, result = _file_set(Tables(spark, sf_dir))
    return result.log.select("n_name", "line", "operator", "type")


def _names(t: Tables, files):
    """Names with the file's own month and its turn's second."""
    cfg = RD.timestamp_sequence(files, FIXED_NOW.isoformat(sep=" "), ["n_name"])
    calculated = F.concat(F.lower("n_name"), F.lit("_"), "month", F.lit("_"), "TimestampFile", F.lit(".txt"))
    name = RD.file_name(F.col("OutputFileName"), F.col("OutputFileExtension"), F.col("TimestampFile"), calculated)
    return cfg.select("n_name", name.alias("file_name")).withColumn("csv_name", RD.csv_name(F.col("file_name")))


@query("files_written", f"""{_SET_SQL},
ts AS (SELECT n_name, strftime(TIMESTAMP '2024-01-15 12:00:00' + to_seconds(row_number() OVER (ORDER BY n_name) - 1), '%Y%m%d%H%M%S') AS ts FROM nation),
nm AS (SELECT st.n_name, route, CASE WHEN nk % 4 = 0 THEN lower(n_name) || '_' || strftime(day, '%m') || '_' || ts || '.txt'
    ELSE 'OUT_' || n_name || '_' || ts || CASE WHEN nk % 3 = 0 THEN '.SAP' ELSE '.csv' END END AS file_name FROM st JOIN ts USING (n_name)),
tg AS (SELECT n_name, 'failed' AS folder, CASE WHEN suffix(file_name, '.csv') THEN file_name ELSE string_split(file_name, '.')[1] || '.csv' END AS file_name
    FROM nm WHERE route = 'failed'
  UNION ALL SELECT n_name, 'skipped', file_name FROM nm WHERE route = 'skipped'
  UNION ALL SELECT n_name, unnest(['success', 'destination']), file_name FROM nm WHERE route = 'success')
SELECT folder, file_name, line_no, line FROM num JOIN tg USING (n_name)""")
def files_written(spark, sf_dir):
    """All files written to failed, skipped, success and destination under their final names, and read back by the manifest
    in the order of their lines (C14, J6, J9, B5)."""
    t = Tables(spark, sf_dir)
    files, result = _file_set(t)
    root = scratch_path(spark, "files")
    run = FS.write_files(result, _names(t, files), root, "n_name")
    return FS.read_files(spark, root, run)


# ----------------------------------------------------------------------------- B5, B6, B7: lines of equal keys, merged files

_FLAG_LINES = "l_returnflag || '|' || CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR)"


def _flag_lines(t: Tables):
    return t.lineitem.select("l_returnflag", (F.col("l_linenumber") > 3).alias("late"), F.concat_ws(
        "|", "l_returnflag", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("line"))


@query("lines_numbered", """WITH c AS (SELECT l_returnflag, l_linenumber > 3 AS late, count(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT l_returnflag, late, n AS n_lines, n AS n_numbers, CAST(sum(n) OVER w - n + 1 AS BIGINT) AS first_no, CAST(sum(n) OVER w AS BIGINT) AS last_no
FROM c WINDOW w AS (PARTITION BY l_returnflag ORDER BY late)""")
def lines_numbered(spark, sf_dir):
    """Three files whose lines share two sort keys: gapless numbers over all parts, one key after the other."""
    numbered = LN.number_lines(_flag_lines(Tables(spark, sf_dir)), ["l_returnflag"], [F.col("late")])
    return numbered.groupBy("l_returnflag", "late").agg(
        F.count(F.lit(1)).alias("n_lines"), F.countDistinct("line_no").alias("n_numbers"), F.min("line_no").alias("first_no"),
        F.max("line_no").alias("last_no"))


@query("records_ordered", f"""{QR.VIOLATIONS_CTE}
SELECT line, row_number() OVER (ORDER BY l_orderkey, l_linenumber, line) AS line_no FROM lines""")
def records_ordered(spark, sf_dir):
    """A record file written as parts and read back with its lines' numbers: the order survives."""
    t = Tables(spark, sf_dir)
    path = scratch_path(spark, "ordered")
    LN.write_lines(QR._lines(t), path, [F.col("l_orderkey"), F.col("l_linenumber"), F.col("line")])
    back = LN.read_lines(spark, path).withColumn("file", F.lit("payfile"))
    return LN.number_lines(back, ["file"], LN.written_order()).select("line", "line_no")


@query("files_merged", f"""SELECT l_returnflag, {_FLAG_LINES} AS line,
  row_number() OVER (PARTITION BY l_returnflag ORDER BY l_linenumber > 3, {_FLAG_LINES}) AS line_no, CAST(1 AS BIGINT) AS n_parts FROM lineitem""")
def files_merged(spark, sf_dir):
    """Files written in parts, then joined into one object each, all files by one call; read back in order."""
    t = Tables(spark, sf_dir)
    base = scratch_path(spark, "merge")
    LN.write_lines(_flag_lines(t), f"{base}/parts", [F.col("late"), F.col("line")], ["l_returnflag"])
    LN.merge_files(spark, f"{base}/parts", f"{base}/whole", ["l_returnflag"])
    whole = store(LN.read_lines(spark, f"{base}/whole"), "whole")
    parts = whole.groupBy("l_returnflag").agg(F.countDistinct("part").alias("n_parts"))
    return (LN.number_lines(whole, ["l_returnflag"], LN.written_order()).join(parts, "l_returnflag")
            .select("l_returnflag", "line", "line_no", "n_parts"))


# ----------------------------------------------------------------------------- B2: overlapping writers of one day

@query("slices_overlapping", f"""WITH raw AS (SELECT c_custkey, c_acctbal, n_name AS country FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT c_custkey, 'new' AS load, DATE '{RUN_DATE}' AS createddttm, country FROM raw WHERE country IN ('NATION_7', 'NATION_12') AND c_acctbal >= 0
UNION ALL SELECT c_custkey, 'old', DATE '{RUN_DATE}', country FROM raw WHERE country NOT IN ('NATION_7', 'NATION_12', 'NATION_8')
UNION ALL SELECT c_custkey, 'old', DATE '2024-01-14', country FROM raw""")
def slices_overlapping(spark, sf_dir):
    """Three countries of one date replaced by writers that overlap in time, one of them with nothing: each slice holds its
    own writer's rows, no other is touched (B2, B3)."""
    t = Tables(spark, sf_dir)
    path, cols = scratch_path(spark, "slices"), ["createddttm", "country"]
    raw = (t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
           .select("c_custkey", "c_acctbal", F.col("n_name").alias("country")))

    def load(df, name, day):
        return df.select("c_custkey", F.lit(name).alias("load"), F.lit(day).cast("date").alias("createddttm"), "country")
    load(raw, "old", RUN_DATE).unionByName(load(raw, "old", "2024-01-14")).write.partitionBy(*cols).parquet(path)
    staged = []
    for country, rows in (("NATION_7", raw), ("NATION_12", raw), ("NATION_8", raw.limit(0))):
        own = rows.where((F.col("country") == country) & (F.col("c_acctbal") >= 0))
        staged.append(SL.stage_slices(spark, path, load(own, "new", RUN_DATE), cols, {"createddttm": [RUN_DATE], "country": [country]}))
    for s in reversed(staged):
        SL.commit_slices(spark, s)
    return SL.read_slices(spark, path, load(raw, "x", RUN_DATE).schema)


# ----------------------------------------------------------------------------- B9: staged tables and their end

@query("staged_lifecycle", """SELECT 'orders' AS logical, 'orders_temp_2024_01_15_20240115120000000000' AS physical, count(*) AS n FROM orders
UNION ALL SELECT 'supplier', 'supplier_temp_2024_01_15_20240115120000000000', count(*) FROM supplier""")
def staged_lifecycle(spark, sf_dir):
    """Tables staged by two runs, the older ones expired and purged: what is left, read back."""
    t = Tables(spark, sf_dir)
    root = scratch_path(spark, "staged")
    frames = {"orders": t.orders, "supplier": t.supplier}
    old = FIXED_NOW - _dt.timedelta(days=5)
    gone = ST.stage_tables(frames, root, "2024-01-10", old, 2)
    ST.stage_tables(frames, root, RUN_DATE, FIXED_NOW, 7)
    if ST.purge_staged(spark, root, FIXED_NOW) != sorted(gone.values()) or ST.purge_staged(spark, root, FIXED_NOW):
        raise RuntimeError("the expired tables weren't purged once")
    out = None
    for r in ST.staged_tables(spark, root).orderBy("physical").collect():
        n = ST.read_staged(spark, root, r.physical).agg(F.count(F.lit(1)).alias("n"))
        row = n.select(F.lit(r.logical).alias("logical"), F.lit(r.physical).alias("physical"), "n")
        out = row if out is None else out.unionByName(row)
    return out


# ----------------------------------------------------------------------------- E12 by component, from a log

_BALANCE_LOG = f"""lg AS (SELECT n_name AS country, c_mktsegment AS sourcecomponent FROM customer JOIN nation ON c_nationkey = n_nationkey
    WHERE c_acctbal < 1000 AND n_name IN {QRL._ASIA}),
bs AS (SELECT n_name AS country, c_mktsegment AS sourcecomponent, count(*) AS baseline FROM customer JOIN nation ON c_nationkey = n_nationkey
    WHERE n_name IN {QRL._ASIA} GROUP BY 1, 2),
lv AS (SELECT country, sourcecomponent, 'component' AS level, baseline, (SELECT count(*) FROM lg WHERE lg.country = bs.country
      AND lg.sourcecomponent = bs.sourcecomponent) AS f FROM bs
    UNION ALL SELECT country, NULL, 'country', sum(baseline), (SELECT count(*) FROM lg WHERE lg.country = b2.country) FROM bs b2 GROUP BY country),
fl AS (SELECT country AS "Country", sourcecomponent AS "Component", level, CAST(baseline AS BIGINT) AS baseline, f AS stagefailure,
    CASE WHEN f = 0 THEN 0.0 ELSE round_even(f / baseline * 100.0, 2) END AS errorpercentage FROM lv),
flags AS (SELECT *, CASE WHEN errorpercentage = 0 THEN 'Success' WHEN errorpercentage > 18 THEN 'Failure' ELSE 'Partial' END AS status FROM fl)"""


def _balance_rules(t: Tables, ctx):
    """One rule per component: its customers' balances."""
    from ..functions.text import sql_text
    comps = sorted(r.c_mktsegment for r in t.customer.select("c_mktsegment").distinct().collect())
    specs = [dict(Stage="dag05", ObjectType="table", ObjectName="customer_history", ObjectField="c_acctbal",
                  AdditionalCondition="c_acctbal < 1000 AND c_mktsegment = " + sql_text(c), ErrorCode="E001",
                  Recommendation="Check balance", SeverityID="S1", FieldsCode="F9", CountryKeyField="n_name", Component=c) for c in comps]
    sp = t.spark
    return comps, R.resolve_rules(C.rules_config(t, specs), C.error_map(sp), C.severity_map(sp),
                                  C.fields_map(sp, [("F9", "c_custkey,c_mktsegment")]), C.vendor_region(sp), ctx,
                                  C.run_countries(t), components=comps)


def _component_flags(t: Tables):
    ctx = QRL._ctx()
    hist = QRL._customer_history(t)
    _, rules = _balance_rules(t, ctx)
    log, problems = R.evaluate_rules(rules, {"customer_history": hist}, ctx)
    if problems:
        raise RuntimeError(f"rule problems: {problems}")
    baseline = (hist.where(F.col("n_name").isin(C.run_countries(t)))
                .groupBy(F.col("n_name").alias("country"), F.col("c_mktsegment").alias("sourcecomponent"))
                .agg(F.count(F.lit(1)).alias("baseline")))
    limits = t.nation.select(F.col("n_name").alias("country"), F.lit("18").alias("threshold"))
    return TH.access_flags(log, baseline, limits)


@query("component_flags", f"""WITH {_BALANCE_LOG}
SELECT *, CASE WHEN status = 'Failure' THEN 'Y' ELSE 'N' END AS "Is_Threshold_Exceeded" FROM flags""")
def component_flags(spark, sf_dir):
    """Threshold flags by country and component and by country, from one pass over a run's log."""
    return _component_flags(Tables(spark, sf_dir))


@query("component_flags_gate", f"""WITH {_BALANCE_LOG}
SELECT DISTINCT "Country", "Component" FROM flags WHERE level = 'component' AND status <> 'Failure'""")
def component_flags_gate(spark, sf_dir):
    """Flags from the log drive the gate of the next run: the rules that stay, by country and component."""
    t = Tables(spark, sf_dir)
    flags = _component_flags(t).where(F.col("level") == "component").select("Country", "Component", "Is_Threshold_Exceeded")
    _, rules = _balance_rules(t, QRL._ctx())
    return R.gate_by_threshold(rules, flags, False, by_component=True).select("Country", "Component").distinct()


# ----------------------------------------------------------------------------- K1: streams tell themselves apart

@query("landing_identity", """SELECT o_orderkey, 'first' AS stream FROM orders UNION ALL SELECT o_orderkey, 'second' FROM orders
UNION ALL SELECT o_orderkey, 'second' FROM orders""")
def landing_identity(spark, sf_dir):
    """Two streams into one sink: one is restarted (nothing lands twice) and one of its batches replayed (the same folder);
    then a new stream starts at the path that the other's checkpoint was moved away from: no row is lost or doubled (K1)."""
    t = Tables(spark, sf_dir)
    base = scratch_path(spark, "streams")
    schema = t.orders.schema

    def land(checkpoint):
        LD.stream_landing(spark, sf_dir, schema, f"{base}/sink", f"{base}/{checkpoint}", glob="orders.parquet",
                          ingest_ts=FIXED_NOW.isoformat(sep=" "))
    land("first")
    land("first")
    LD._batch_writer(f"{base}/sink", f"{base}/first", None)(t.orders, 0)
    first = LD.stream_id(spark, f"{base}/first")
    land("second")
    fs, _, jvm = _fs(spark, base)
    path = jvm.org.apache.hadoop.fs.Path
    _rename(fs, path(f"{base}/second"), path(f"{base}/moved"))
    land("second")
    landed = LD.read_landed(spark, f"{base}/sink")
    return landed.select("o_orderkey", F.when(F.col("_batch_id").startswith(first), "first").otherwise("second").alias("stream"))
