import datetime as dt

from pyspark.sql import functions as F

from ledgerline.operators import rules as R
from conftest import rows

CTX = R.RunContext("o1", "dag05", "ASIA", "src", "2024-01-15", now=dt.datetime(2024, 1, 15, 12))


def _rule(**kw):
    base = dict(Country="C1", Stage="dag05", ObjectType="table", ObjectName="t_history", ObjectField="f",
                Operator="", ObjectFieldValue="", AdditionalCondition="TRUE", ErrorCode="E1", Recommendation="r",
                ErrorDescription="d", ErrorSeverity="High", Type="Error", AdditionalFields="id",
                CountryKeyField="country", FileIngestionCondition="", Vendor="v", Component="c")
    base.update(kw)
    return base


def _obj(spark):
    return spark.createDataFrame(
        [(1, "C1", 5, "x", dt.date(2024, 1, 15)), (2, "C2", 5, "y", dt.date(2024, 1, 15)),
         (3, "C1", 1, "y", dt.date(2024, 1, 14)), (4, None, 5, "y", dt.date(2024, 1, 15))],
        "id int, country string, q int, s string, createddttm date")


def test_predicate_is_parenthesised(spark):
    log, probs = R.evaluate_rules([_rule(AdditionalCondition="s = 'x' OR q = 5")], {"t_history": _obj(spark)}, CTX)
    assert not probs
    # without parentheses row 2 (country C2) would match through "q = 5"
    assert rows(log, "errordescription") == [("d;id:1",)]


def test_e004_scope_and_null_key(spark):
    log, _ = R.evaluate_rules([_rule(ErrorCode="E004", AdditionalCondition="q = 5")], {"t_history": _obj(spark)}, CTX)
    assert rows(log, "errordescription") == [("d;id:2",), ("d;id:4",)]


def test_bad_rule_isolated(spark):
    log, probs = R.evaluate_rules([_rule(AdditionalCondition="no_such_col = 1"), _rule(AdditionalCondition="q = 1",
                                   ObjectField="q")], {"t_history": _obj(spark)}, CTX)
    assert len(probs) == 1
    assert log.count() == 0  # the good rule ran (row 3 is outside the history slice)


def test_latest_ingestion_scope(spark):
    df = spark.createDataFrame(
        [(1, "C1", dt.datetime(2024, 1, 1)), (2, "C1", dt.datetime(2024, 1, 2)), (3, "C1", dt.datetime(2024, 1, 3)),
         (4, "C2", dt.datetime(2024, 1, 5))], "id int, country string, rawingestiondttm timestamp_ntz")
    r = _rule(ObjectName="t_raw", FileIngestionCondition="id < 3")
    log, probs = R.evaluate_rules([r], {"t_raw": df}, CTX)
    assert not probs
    assert rows(log, "errordescription") == [("d;id:2",)]


def test_raw_table_without_country_field_is_a_problem(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1))], "id int, rawingestiondttm timestamp_ntz")
    log, probs = R.evaluate_rules([_rule(ObjectName="t_raw", CountryKeyField="")], {"t_raw": df}, CTX)
    assert log is None and len(probs) == 1


def test_view_gets_date_suffix_and_no_scope(spark):
    v = _obj(spark)
    log, probs = R.evaluate_rules([_rule(ObjectType="view", ObjectName="v_<COUNTRY_PLACEHOLDER>",
                                         AdditionalCondition="q = 5")], {"v_c1_2024_01_15": v}, CTX)
    assert not probs and log.count() == 3


def test_all_columns_when_no_log_fields(spark):
    log, _ = R.evaluate_rules([_rule(AdditionalFields="", AdditionalCondition="id = 1")], {"t_history": _obj(spark)}, CTX)
    assert rows(log, "errordescription") == [("d;id:1|country:C1|q:5|s:x|createddttm:2024-01-15",)]


def test_one_scan_per_object(spark):
    rs = [_rule(AdditionalCondition="q = 5"), _rule(AdditionalCondition="s = 'y'"), _rule(AdditionalCondition="id > 1")]
    log, _ = R.evaluate_rules(rs, {"t_history": _obj(spark)}, CTX)
    plan = log._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD[id#") == 1   # the object; the rules are stored files
    assert "BatchEvalPython" not in plan


def test_gate(spark):
    rules = spark.createDataFrame([("c1", "A"), ("C2", "A"), ("C3", "B")], "Country string, Component string")
    flags = spark.createDataFrame([("C1", "A", "N"), ("C2", "A", "Y"), ("C3", None, "N")],
                                  "Country string, Component string, Is_Threshold_Exceeded string")
    assert rows(R.gate_by_threshold(rules, flags, override=True)) == rows(rules)
    assert rows(R.gate_by_threshold(rules, flags, False)) == [("C1", "A"), ("C3", "B")]
    assert rows(R.gate_by_threshold(rules, flags, False, component="A")) == [("C1", "A")]
    empty = flags.limit(0)
    assert rows(R.gate_by_threshold(rules, empty, False)) == rows(rules)


def test_run_access_check_writes_partition(spark, tmp_path):
    import pytest
    path = str(tmp_path / "log")
    obj = {"t_history": _obj(spark)}
    R.run_access_check(spark, [_rule(AdditionalCondition="q = 5")], obj, CTX, path, ["C1"])
    assert spark.read.parquet(path).count() == 1
    R.run_access_check(spark, [_rule(AdditionalCondition="q = 5")], obj, CTX, path, ["C1"])   # rerun: same
    assert spark.read.parquet(path).count() == 1
    with pytest.raises(RuntimeError):
        R.run_access_check(spark, [_rule(AdditionalCondition="q = 5"), _rule(AdditionalCondition="nope = 1")],
                           obj, CTX, path, ["C1"])
    assert spark.read.parquet(path).count() == 1   # good rule written before raising


def test_rules_differing_only_by_country_are_merged(spark):
    rs = [_rule(Country=c, AdditionalCondition="q = 5") for c in ("C1", "C2", "C9")]
    log, probs = R.evaluate_rules(rs, {"t_history": _obj(spark)}, CTX)
    assert not probs
    assert rows(log, "country", "errordescription") == [("C1", "d;id:1"), ("C2", "d;id:2")]
    # a quoted country in the predicate is the row's own
    rs2 = [_rule(Country=c, AdditionalCondition="country = '<COUNTRY_PLACEHOLDER>' AND q = 5") for c in ("C1", "C2")]
    log2, _ = R.evaluate_rules(rs2, {"t_history": _obj(spark)}, CTX)
    assert rows(log2, "country", "errordescription") == [("C1", "d;id:1"), ("C2", "d;id:2")]


def test_missing_object_is_a_problem_not_a_crash(spark):
    log, probs = R.evaluate_rules([_rule(ObjectName="nowhere_history"), _rule(AdditionalCondition="q = 5")],
                                  {"t_history": _obj(spark)}, CTX)
    assert len(probs) == 1 and probs[0].objectname == "nowhere_history"
    assert rows(log, "errordescription") == [("d;id:1",)]   # the good rule still ran (C1, run date)


def _plan(log):
    """The plan's text without numbers and run-scoped paths."""
    import re
    text = log._jdf.queryExecution().executedPlan().toString()
    return re.sub(r"[0-9a-f]{12}|#\d+L?|\d+", "", text)


def test_plan_does_not_grow_with_countries(spark):
    """5 and 500 (rule, country) rows: the same plan, one scan, the rows of each country once."""
    obj = spark.range(2000).select("id", F.concat(F.lit("C"), (F.col("id") % 500).cast("string")).alias("country"),
                                   F.lit(dt.date(2024, 1, 15)).alias("createddttm"), F.lit(dt.datetime(2024, 1, 1)).alias("rawingestiondttm"))

    def run(n, **kw):
        rs = [_rule(Country=f"C{i}", AdditionalCondition="id < 1000 AND country = '<COUNTRY_PLACEHOLDER>'", **kw) for i in range(n)]
        log, probs = R.evaluate_rules(rs, {"t_history": obj, "t_raw": obj}, CTX)
        assert not probs
        return log
    for kw in ({}, {"ObjectName": "t_raw", "FileIngestionCondition": "id > 3 AND country = '<COUNTRY_PLACEHOLDER>'"}):
        few, many = run(5, **kw), run(500, **kw)
        assert len(_plan(few)) == len(_plan(many))
        assert few.count() == 10 and many.count() == 1000


def test_views_of_all_countries_in_one_scan(spark):
    base = spark.createDataFrame([(1, "C1", 5), (2, "C2", 5), (3, "C1", 1), (4, None, 5), (5, "C9", 5)], "id int, country string, q int")
    rs = [_rule(Country=c, ObjectType="view", ObjectName="v_<COUNTRY_PLACEHOLDER>", AdditionalCondition="q = 5", Recommendation="ask <COUNTRY_PLACEHOLDER>")
          for c in ("C1", "C2", "C3")]
    log, probs = R.evaluate_rules(rs, {}, CTX, families={"v_<COUNTRY_PLACEHOLDER>": R.ViewFamily(base, "country")})
    assert not probs
    assert log._jdf.queryExecution().executedPlan().toString().count("Scan ExistingRDD[id#") == 1
    assert rows(log, "country", "objectname", "errordescription", "recommendation") == [
        ("C1", "v_c1_2024_01_15", "d;id:1", "ask C1"), ("C2", "v_c2_2024_01_15", "d;id:2", "ask C2")]


def test_mixed_scopes_of_one_object(spark):
    """Rules of the same and of other countries, and a country text that isn't quoted alone, in one scan."""
    rs = [_rule(AdditionalCondition="q = 5"), _rule(ErrorCode="E004", AdditionalCondition="q = 5", ErrorDescription="other"),
          _rule(Country="C2", AdditionalCondition="concat('<COUNTRY_PLACEHOLDER>', 'x<COUNTRY_PLACEHOLDER>') = 'C2xC2'", ErrorDescription="text"),
          _rule(CountryKeyField="", Country="C7", AdditionalCondition="id = 4", ErrorDescription="any"),
          _rule(AdditionalCondition="q = 5"), _rule(AdditionalCondition="", Country="C2", ErrorDescription="all")]
    log, probs = R.evaluate_rules(rs, {"t_history": _obj(spark)}, CTX)
    assert not probs
    assert rows(log, "country", "errordescription") == [
        ("C1", "d;id:1"), ("C1", "d;id:1"), ("C1", "other;id:2"), ("C1", "other;id:4"), ("C2", "all;id:2"), ("C2", "text;id:2"), ("C7", "any;id:4")]


def test_one_moment_for_a_run():
    ctx = R.RunContext("o1", "dag05", "ASIA", "src", "2024-01-15")
    assert ctx.now is not None and ctx.now.tzinfo is None
