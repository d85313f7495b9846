"""Property tests (hypothesis): algebraic facts the operators must keep on any input."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.operators import history as H
from ledgerline.operators import records as RC
from ledgerline.operators import render as RD
from ledgerline.operators import rules as R
from conftest import rows

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
COUNTRY = st.sampled_from(["C1", "C2", "C3", None])
DATES = st.sampled_from([dt.date(2024, 1, 14), dt.date(2024, 1, 15)])


@SETTINGS
@given(hist=st.lists(st.tuples(st.integers(0, 50), COUNTRY, DATES), max_size=25),
       raw=st.lists(st.tuples(st.integers(0, 50), COUNTRY), max_size=25))
def test_replace_twice_equals_once(spark, hist, raw):
    h = spark.createDataFrame(hist, "id int, country string, createddttm date")
    r = spark.createDataFrame(raw, "id int, country string")
    once = H.snapshot_to_history(r, h, "2024-01-15", "country", ["C1", "C2"])
    twice = H.snapshot_to_history(r, once, "2024-01-15", "country", ["C1", "C2"])
    assert rows(once) == rows(twice)
    # rows outside the slice are untouched
    outside = [x for x in hist if not (x[2] == dt.date(2024, 1, 15) and x[1] in ("C1", "C2"))]
    inside_new = [(i, c, dt.date(2024, 1, 15)) for i, c in raw if c in ("C1", "C2")]
    from conftest import _key
    assert rows(once) == sorted(outside + inside_new, key=_key)


FIELD = st.text(alphabet="0123456789x.-", max_size=6)


@SETTINGS
@given(lines=st.lists(st.tuples(st.sampled_from(["A", "B"]), FIELD, FIELD), max_size=30))
def test_clean_and_failed_partition_the_input(spark, lines):
    text = [f'{t}|"{a}|"{b}' for t, a, b in lines]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(text)], "id int, line string")
    comp = RC.compile_rules(spark, [
        dict(AdditionalCondition="A", ObjectField="1", Operator="AMOUNTFORMAT", ObjectFieldValue=r"\d+(\.\d{1,2})?$",
             AdditionalFields="{1: 'a'}", ErrorSeverity="H", Type="Error", ErrorDescription="d", Recommendation="r"),
        dict(AdditionalCondition="B", ObjectField="2", Operator="DATEFORMAT", ObjectFieldValue=r"^\d{4}\d{2}\d{2}$",
             AdditionalFields="{2: 'b'}", ErrorSeverity="H", Type="Warning", ErrorDescription="d", Recommendation="r")])
    viol, clean, failed = RC.check_and_split(df, comp, RC.References("US"))
    c, f = rows(clean, "id"), rows(failed, "id")
    assert sorted(c + f) == rows(df, "id") and not set(c) & set(f)
    failed_text = {r.line for r in viol.collect()}
    assert {text[i] for (i,) in f} == failed_text          # removed by value, exactly the violating lines


@SETTINGS
@given(countries=st.lists(st.sampled_from(["c1", "C2", "c3"]), min_size=1, max_size=6),
       flags=st.lists(st.tuples(st.sampled_from(["C1", "C2", "C3"]), st.sampled_from(["Y", "N"])), max_size=6))
def test_gate_with_override_is_identity(spark, countries, flags):
    rules = spark.createDataFrame([(c, "x") for c in countries], "Country string, Component string")
    fl = spark.createDataFrame(flags, "Country string, Is_Threshold_Exceeded string")
    assert rows(R.gate_by_threshold(rules, fl, override=True)) == rows(rules)
    gated = rows(R.gate_by_threshold(rules, fl, override=False))
    ok = {c for c, e in flags if e == "N"}
    expect = rows(rules) if not flags else sorted((c.upper(), "x") for c in countries if c.upper() in ok)
    assert gated == expect


@SETTINGS
@given(status=st.lists(st.tuples(st.sampled_from(["Success", "Partial", "Failure", None]), st.booleans(),
                                 st.booleans(), st.booleans()), min_size=1, max_size=8))
def test_every_file_gets_exactly_one_route(spark, status):
    df = spark.createDataFrame([(i, *s) for i, s in enumerate(status)], "id int, st string, ov boolean, sk boolean, ck boolean")
    out = df.select("id", RD.route(F.col("st"), F.col("ov"), F.col("sk"), F.col("ck")).alias("r"))
    got = dict((r.id, r.r) for r in out.collect())
    assert len(got) == len(status)
    for i, (s, ov, sk, ck) in enumerate(status):
        exp = "failed" if (ck and s == "Failure" and not ov) else ("skipped" if sk else "success")
        assert got[i] == exp
