from pyspark.sql import functions as F

from ledgerline.operators import records as RC
from ledgerline.sources import files as SRC
from conftest import rows

LINES = [
    '0015|"10000001|"20240131|"125.50|"M100|"US|"USD',
    '0015|"10000002|"20240230|"12.5x|"ZZZZ|"CA|"USD',
    '0015|"10000003|"20240131|"|"M100|"CA|"EUR',
    '0015|"10000003|"20240131|"|"M100|"CA|"EUR',
    '0020|"10000009|"2024013|"1.234|"|"US|"USD|"',
    '0030|"10000010',
]


def _rule(rt, idx, op, val="", fields="{1: 'EmployeeId'}", typ="Error", desc="bad"):
    return dict(AdditionalCondition=rt, ObjectField=str(idx), Operator=op, ObjectFieldValue=val,
                AdditionalFields=fields, ErrorSeverity="High", Type=typ, ErrorDescription=desc, Recommendation="fix")


RULES = [
    _rule("0015", 2, "DATEFORMAT", r"^\d{4}\d{2}\d{2}$", "{1: 'EmployeeId', 2: 'Date'}"),
    _rule("0015", 3, "AMOUNTFORMAT", r"\d+(\.\d{1,2})?$", "{1: 'EmployeeId', 3: 'Amount'}"),
    _rule("0015", 4, "WAGETYPECHECK", "q", "{1: 'EmployeeId', 4: 'WageType'}"),
    _rule("0015", 5, "COUNTRYCHECK", "", "{1: 'EmployeeId', 5: 'Country'}"),
    _rule("0015", 6, "WAGETYPECURRENCYCHECK", "", "{1: 'EmployeeId', 6: 'Currency'}"),
    _rule("0015", 1, "notin", "('10000001', '10000002', '10000003')"),
    _rule("0020", 3, "HOURSFORMAT", r"\d+(\.\d{1,2})?$", "{3: 'Hours'}", typ="Warning"),
    _rule("0020", 7, "IN", "['']", "{7: 'Tail', 8: 'Beyond'}"),
    _rule("0020", 6, "WAGETYPECURRENCYCHECK", "", "{6: 'Currency'}"),
    _rule("0015", 3, "LENGTHCHECK", "3"),
    dict(AdditionalCondition="", ObjectField="", Operator="BASELINEQUERY", ObjectFieldValue="SELECT 1",
         AdditionalFields="", ErrorSeverity="", Type="", ErrorDescription="", Recommendation=""),
]


def _refs(spark, wagetypes=True):
    wt = spark.createDataFrame([("M100", "0015")], "Wagetype string, Infotype string") if wagetypes else \
        spark.createDataFrame([], "Wagetype string, Infotype string")
    ck = spark.createDataFrame([("US", "USD")], "CountryKey string, CurrencyKey string")
    wtc = spark.createDataFrame([("US", "M100", "ds", "EUR")], "Country string, WageType string, DataSource string, CurrencyKey string")
    return RC.References("US", "ds", wt, None, ck, wtc)


def _check(spark, refs=None):
    lines = spark.createDataFrame([(i, line) for i, line in enumerate(LINES)], "id int, line string")
    comp = RC.compile_rules(spark, RULES)
    viol = RC.check_records(RC.parse_records(lines), comp, refs or _refs(spark))
    return lines, comp, viol


def test_compile(spark):
    _, comp, _ = _check(spark)
    assert [r["Operator"] for r in comp.unknown] == ["LENGTHCHECK"]
    assert comp.baseline_queries == ["SELECT 1"]
    assert comp.wagetype_queries == ["q"]


def test_violations(spark):
    _, _, viol = _check(spark)
    got = rows(viol, "id", "operator", "errordescription", "erroridentifier")
    ops = {(r[0], r[1]) for r in got}
    assert ops == {
        (0, "WAGETYPECURRENCYCHECK"),                       # wage type M100 carries EUR, line says USD
        (1, "AMOUNTFORMAT"), (1, "COUNTRYCHECK"), (1, "DATEFORMAT"), (1, "WAGETYPECHECK"),
        (2, "COUNTRYCHECK"), (3, "COUNTRYCHECK"),           # empty amount passes; identical lines both fail
        (4, "HOURSFORMAT"), (4, "IN"),                      # '1.234' fails the anchored pattern; trailing empty field
    }
    d = {(r[0], r[1]): (r[2], r[3]) for r in got}
    assert d[(4, "IN")] == ("bad;Tail:|Beyond:", "Tail")
    assert d[(1, "DATEFORMAT")] == ("bad;EmployeeId:10000002|Date:20240230", "Date")   # not a calendar date
    assert d[(0, "WAGETYPECURRENCYCHECK")] == ("bad;EmployeeId:10000001|Currency:USD", "Currency")


def test_identical_lines_fail_together_and_split_is_complete(spark):
    lines, _, viol = _check(spark)
    _, clean, failed = RC.check_and_split(lines, RC.compile_rules(spark, RULES), _refs(spark))
    c, f = rows(clean, "id"), rows(failed, "id")
    assert {r[0] for r in f} == {r.id for r in viol.collect()}
    assert (2,) in f and (3,) in f            # identical lines go together
    assert sorted(c + f) == rows(lines, "id")
    assert (5,) in c


def test_empty_wagetype_reference_skips_check(spark):
    _, _, viol = _check(spark, _refs(spark, wagetypes=False))
    assert viol.where("operator = 'WAGETYPECHECK'").count() == 0


def test_warning_only_line_is_removed(spark):
    lines = spark.createDataFrame([(0, '0020|"1|"2|"x.1')], "id int, line string")
    comp = RC.compile_rules(spark, [_rule("0020", 3, "HOURSFORMAT", r"\d", typ="Warning")])
    _, clean, failed = RC.check_and_split(lines, comp, RC.References("US"))
    assert clean.count() == 0 and failed.count() == 1


def test_read_records_drops_blank_lines(spark, tmp_path):
    p = tmp_path / "f.txt"
    p.write_text('a|"1\n\n   \nb|"2\nNA\n')
    got = rows(SRC.read_records(spark, str(p)), "line")
    assert got == [('NA',), ('a|"1',), ('b|"2',)]


def test_file_scope(spark):
    rules = spark.createDataFrame([("pay_<COUNTRY_PLACEHOLDER>_x",), ("other",)], "ObjectName string")
    got = RC.file_scope(rules, "vend", "ASIA", "US", "vend/asia/", "PAYFILE_US_2024")
    assert rows(got) == [("vend/ASIA/PAYFILE_US_2024",), ("vend/ASIA/PAYFILE_US_2024",)]
    got2 = RC.file_scope(rules, "vend", "ASIA", "US", "vend/asia/", "pay_us_x", replace_last=False)
    assert rows(got2) == [("vend/ASIA/pay_us_x",)]


def test_checked_lines_carry_their_violations(spark):
    lines, comp, viol = _check(spark)
    checked = RC.check_lines(RC.parse_records(lines), comp, _refs(spark))
    cols = ["id", "operator", "errordescription", "erroridentifier", "field_index", "value"]
    assert rows(RC.violations_of(checked, comp), *cols) == rows(viol, *cols)
    broken = {r.id: r.violated for r in checked.collect()}
    assert sum(map(len, broken.values())) == viol.count() and broken[5] == []
    plan = checked._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan


def test_membership_of_any_size_is_one_hash_join(spark):
    """A reference of ten million values is joined by (record type, value), never gathered into an array."""
    lines = spark.createDataFrame([(0, '0015|"1|"2|"3|"w7'), (1, '0015|"1|"2|"3|"none')], "id int, line string")
    comp = RC.compile_rules(spark, [_rule("0015", 4, "WAGETYPECHECK", "q"), _rule("0015", 4, "INFOTYPECOMBINATIONFORMAT", "q")])
    big = spark.range(10_000_000).select(F.concat(F.lit("w"), F.col("id").cast("string")).alias("Wagetype"), F.lit("0015").alias("Infotype"))
    refs = RC.References("US", wagetypes=big, infotypes=big.withColumn("Country", F.lit("US")))
    checked = RC.check_lines(RC.parse_records(lines), comp, refs)
    plan = checked._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "collect_set" not in plan and "NestedLoop" not in plan and "SortMergeJoin" in plan
    small = [f.where("Wagetype IN ('w7', 'w8')") for f in (refs.wagetypes, refs.infotypes)]
    checked = RC.check_lines(RC.parse_records(lines), comp, RC.References("US", wagetypes=small[0], infotypes=small[1]))
    assert {r.id: len(r.violated) for r in checked.collect()} == {0: 0, 1: 2}


def test_rules_of_many_files_are_compiled_once(spark):
    a, b = _rule("T", 1, "IN", "['x']"), _rule("T", 2, "COUNTRYCHECK")
    cols = ["f", *RC.FILE_RULE_COLUMNS]
    data = [("f1", a), ("f2", a), ("f2", b), ("f3", b), ("f3", b), ("f3", _rule("T", 1, "LENGTHCHECK"))]
    frame = spark.createDataFrame([tuple({"f": f, **r}[c] for c in cols) for f, r in data], ", ".join(f"{c} string" for c in cols))
    comp, bits = RC.compile_file_rules(frame, "f")
    assert len(comp.rows) == 3 and [r["Operator"] for r in comp.unknown] == ["LENGTHCHECK"]   # f3 has b twice
    lines = spark.createDataFrame([(f, c, 'T|"x|"US') for f, c in (("f1", "CA"), ("f2", "CA"), ("f2", "US"), ("f3", "CA"), ("f4", "CA"))],
                                  "f string, country string, line string").join(bits, "f", "left")
    checked = RC.check_lines(RC.parse_records(lines), comp, RC.References(country_col="country"), "rule_bits")
    got = {(r.f, r.country): sorted(comp.rows[n].op for n in r.violated) for r in checked.collect()}
    assert got == {("f1", "CA"): ["IN"], ("f2", "CA"): ["COUNTRYCHECK", "IN"], ("f2", "US"): ["IN"],
                   ("f3", "CA"): ["COUNTRYCHECK", "COUNTRYCHECK"], ("f4", "CA"): []}


def test_many_rules_need_several_words(spark):
    cols = ["f", *RC.FILE_RULE_COLUMNS]
    data = [("f1" if i % 2 else "f2", _rule("T", 1, "IN", f"['{i}']")) for i in range(150)]
    frame = spark.createDataFrame([tuple({"f": f, **r}[c] for c in cols) for f, r in data], ", ".join(f"{c} string" for c in cols))
    comp, bits = RC.compile_file_rules(frame, "f")
    assert len(comp.rows) == 150 and all(len(r.rule_bits) == 3 for r in bits.collect())
    lines = spark.createDataFrame([(f, f'T|"{i}') for f in ("f1", "f2") for i in range(150)], "f string, line string").join(bits, "f")
    checked = RC.check_lines(RC.parse_records(lines), comp, RC.References("US"), "rule_bits")
    assert {(r.f, r.line) for r in checked.where("size(violated) > 0").collect()} == {("f1" if i % 2 else "f2", f'T|"{i}') for i in range(150)}


def test_references_by_country(spark):
    lines = spark.createDataFrame([("US", 'T|"w1|"USD'), ("CA", 'T|"w1|"USD'), ("MX", 'T|"w1|"MXN'), ("CA", 'T|"w2|"EUR')], "c string, line string")
    wt = spark.createDataFrame([("w1", "T", "US"), ("w2", "T", "CA")], "Wagetype string, Infotype string, Country string")
    ck = spark.createDataFrame([("US", "USD"), ("CA", "CAD"), ("MX", "MXN")], "CountryKey string, CurrencyKey string")
    wtc = spark.createDataFrame([("CA", "w2", "ds", "EUR")], "Country string, WageType string, DataSource string, CurrencyKey string")
    comp = RC.compile_rules(spark, [_rule("T", 1, "WAGETYPECHECK", "q"), _rule("T", 2, "CURRENCYCHECK"), _rule("T", 2, "WAGETYPECURRENCYCHECK")])
    checked = RC.check_lines(RC.parse_records(lines), comp, RC.References(None, "ds", wt, None, ck, wtc, country_col="c"))
    got = {(r.c, r.line): sorted(comp.rows[n].op for n in r.violated) for r in checked.collect()}
    assert got == {("US", 'T|"w1|"USD'): [], ("CA", 'T|"w1|"USD'): ["CURRENCYCHECK", "WAGETYPECHECK", "WAGETYPECURRENCYCHECK"],
                   ("MX", 'T|"w1|"MXN'): [], ("CA", 'T|"w2|"EUR'): ["CURRENCYCHECK"]}   # MX has no wage types: no check


def test_send_check_composition(spark):
    import datetime as dt
    from ledgerline.operators.send import send_check
    lines, comp, _ = _check(spark)
    lines.select("line").createOrReplaceTempView("ll_send_lines")
    comp.baseline_queries[:] = ["SELECT COUNT(*) FROM ll_send_lines"]
    stage_map = spark.createDataFrame([("dag06", "File checks")], "Stage string, StageDescription string")
    res = send_check(spark, lines.select("line"), comp, _refs(spark), [lines], None, stage_map,
                     orchestrator_id="o", stage="dag06", region="r", country="US", source="s", component="c",
                     vendor="v", objectname="f.csv", run_date="2024-01-15", threshold="50",
                     now=dt.datetime(2024, 1, 15, 12))
    summ = res.summary.first()
    assert summ.stagefailure == res.log_rows.where("type = 'Error'").count()
    assert summ.g2vsviewcountfailure == 0
    assert res.clean.count() + res.failed.count() == lines.count()
    file_lines = [r.line for r in res.log_file.orderBy("section", "seq").collect()]
    assert file_lines[0] == "Timestamp : 2024-01-15 12:00:00" and file_lines[12].startswith("Status : ")
    assert [r["Operator"] for r in res.unknown_rules] == ["LENGTHCHECK"]


def test_reference_frame_from_rule_queries(spark):
    spark.createDataFrame([("W1", "0015"), ("W1", "0015"), ("W2", "0020")], "a string, b string") \
        .createOrReplaceTempView("ll_test_wt_us")
    spark.createDataFrame([("W3", "0015")], "a string, b string").createOrReplaceTempView("ll_test_wt_extra")
    qs = ["SELECT a, b FROM ll_test_wt_<COUNTRY_PLACEHOLDER>", "SELECT a, b FROM ll_test_wt_extra"]
    ref = RC.reference_frame(spark, qs, ["Wagetype", "Infotype"], "US", "ASIA", "core")
    assert rows(ref) == [("W1", "0015"), ("W2", "0020"), ("W3", "0015")]
    assert RC.reference_frame(spark, [], ["Wagetype", "Infotype"], "US", "ASIA", "core") is None


def test_literal_and_position_edge_cases(spark):
    from ledgerline.functions.text import parse_list_literal
    assert parse_list_literal("[1, '2', 3.0]") == ["2"] and parse_list_literal("'x'") == ["x"]
    lines = spark.createDataFrame([(0, 'T|"1|"2')], "id int, line string")
    comp = RC.compile_rules(spark, [
        _rule("T", 1, "IN", "[1, 2]"),        # integers never equal a text field: no violation
        _rule("T", 1, "NOTIN", "[1, 2]"),     # ... so NOTIN always fires
        dict(_rule("T", 2, "IN", "['2']"), ObjectField="02"),   # non-canonical position never applies
    ])
    got = rows(RC.check_records(RC.parse_records(lines), comp, RC.References("US")), "operator")
    assert got == [("NOTIN",)]


def _written(spark, path):
    df = spark.read.text(path) if path.endswith(("clean", "failed", "logfile")) else spark.read.parquet(path)
    return rows(df)


def test_two_file_checks_of_one_day_keep_their_rows(spark, tmp_path):
    """Each check owns its slices: another country's check of the same run neither reads nor rewrites them."""
    import datetime as dt
    from ledgerline.operators.send import run_send_check
    lines, comp, _ = _check(spark)
    lines.select("line").createOrReplaceTempView("ll_send_lines3")
    comp.baseline_queries[:] = ["SELECT COUNT(*) FROM ll_send_lines3"]
    stage_map = spark.createDataFrame([("dag06", "File checks")], "Stage string, StageDescription string")
    base = dict(orchestrator_id="o", stage="dag06", region="r", source="s", component="007", vendor="v", objectname="f.csv",
                run_date="2024-01-15", threshold="50")
    for country in ("US", "CA", "US"):
        run_send_check(spark, lines.select("line"), comp, _refs(spark), [lines], stage_map, log_path=str(tmp_path / "log"),
                       summary_path=str(tmp_path / "summary"), clean_path=str(tmp_path / f"clean{country}"),
                       log_file_path=str(tmp_path / f"file{country}"), country=country, now=dt.datetime(2024, 1, 15, 12), **base)
    summary = spark.read.parquet(str(tmp_path / "summary"))
    assert rows(summary, "country", "stagefailure") == [("CA", 8), ("US", 8)]
    assert dict(spark.read.parquet(str(tmp_path / "log")).groupBy("country").count().collect()) == {"US": 9, "CA": 9}


def test_run_send_check_writes_and_reruns(spark, tmp_path):
    import datetime as dt
    from ledgerline.operators.send import run_send_check
    lines, comp, _ = _check(spark)
    lines.select("line").createOrReplaceTempView("ll_send_lines2")
    comp.baseline_queries[:] = ["SELECT COUNT(*) FROM ll_send_lines2"]
    stage_map = spark.createDataFrame([("dag06", "File checks")], "Stage string, StageDescription string")
    paths = {k: str(tmp_path / k) for k in ("log", "summary", "clean", "failed", "logfile")}
    first = None
    params = dict(orchestrator_id="o", stage="dag06", region="r", country="US", source="s", component="c",
                  vendor="v", objectname="f.csv", run_date="2024-01-15", threshold="50",
                  now=dt.datetime(2024, 1, 15, 12))
    for _ in range(2):   # a rerun replaces, never duplicates
        status, proceed = run_send_check(spark, lines.select("line"), comp, _refs(spark), [lines], stage_map,
                                         log_path=paths["log"], summary_path=paths["summary"],
                                         clean_path=paths["clean"], failed_path=paths["failed"],
                                         log_file_path=paths["logfile"], **params)
        first = first if _ else {k: _written(spark, p) for k, p in paths.items()}
    assert {k: _written(spark, p) for k, p in paths.items()} == first
    assert len(first["summary"]) == 1 and first["failed"]
    n_log = spark.read.parquet(paths["log"]).count()
    assert n_log == RC.check_records(RC.parse_records(lines.select("line")), comp, _refs(spark)).count()
    from ledgerline.sinks import lines as LN
    assert LN.read_lines(spark, paths["logfile"]).orderBy(*LN.written_order()).first().line.startswith("Timestamp : ")
    assert status in ("Success", "Partial", "Failure") and proceed == (status != "Failure")


def test_record_type_missing_from_reference_is_a_violation(spark):
    lines = spark.createDataFrame([(0, '0015|"1|"2|"3|"M100')], "id int, line string")
    comp = RC.compile_rules(spark, [_rule("0015", 4, "WAGETYPECHECK", "q")])
    wt = spark.createDataFrame([("M100", "0020")], "Wagetype string, Infotype string")   # no 0015 entries at all
    refs = RC.References("US", wagetypes=wt)
    assert rows(RC.check_records(RC.parse_records(lines), comp, refs), "operator") == [("WAGETYPECHECK",)]
    checked = RC.check_lines(RC.parse_records(lines), comp, RC.References("US", wagetypes=wt))
    assert [r.violated for r in checked.collect()] == [[0]]


def test_error_log_file_is_compressed(spark, tmp_path):
    """The error-log file, many times the record file, is written as gzip parts of the same lines; record files stay plain."""
    import datetime as dt
    import gzip
    from ledgerline.operators.send import run_send_check
    lines, comp, _ = _check(spark)
    lines.select("line").createOrReplaceTempView("ll_send_lines3")
    comp.baseline_queries[:] = ["SELECT COUNT(*) FROM ll_send_lines3"]
    stage_map = spark.createDataFrame([("dag06", "File checks")], "Stage string, StageDescription string")

    def run(to, **more):
        run_send_check(spark, lines.select("line"), comp, _refs(spark), [lines], stage_map, log_path=str(to / "log"),
                       summary_path=str(to / "summary"), clean_path=str(to / "clean"), failed_path=str(to / "failed"),
                       log_file_path=str(to / "file"), orchestrator_id="o", stage="dag06", region="r", country="US", source="s",
                       component="c", vendor="v", objectname="f.csv", run_date="2024-01-15", threshold="50",
                       now=dt.datetime(2024, 1, 15, 12), **more)
    run(tmp_path / "a")
    run(tmp_path / "b", log_compression="none")
    packed = b"".join(p.read_bytes() for p in sorted((tmp_path / "a" / "file").glob("part-*.txt.gz")))
    plain = "".join(p.read_text() for p in sorted((tmp_path / "b" / "file").glob("part-*.txt")))
    assert gzip.decompress(packed).decode() == plain and plain.startswith("Timestamp : ")
    assert not list((tmp_path / "a" / "failed").glob("*.gz")) and list((tmp_path / "a" / "failed").glob("part-*.txt"))


def test_send_check_leaves_no_scratch_and_packs_its_outputs(spark, tmp_path):
    """The stored lines go once all is written; log slices are zstd, removed lines gzip on demand, and hold the same rows (F1)."""
    import datetime as dt
    import glob
    import gzip
    from ledgerline.operators.send import run_send_check
    from ledgerline.session import ensure_checkpoint_dir
    lines, comp, _ = _check(spark)
    lines.select("line").createOrReplaceTempView("ll_send_lines4")
    comp.baseline_queries[:] = ["SELECT COUNT(*) FROM ll_send_lines4"]
    stage_map = spark.createDataFrame([("dag06", "File checks")], "Stage string, StageDescription string")
    stored = f"{ensure_checkpoint_dir(spark).removeprefix('file:')}/ledgerline/send-lines-*"
    before = glob.glob(stored)

    def run(to, **more):
        for _ in range(2):
            run_send_check(spark, lines, comp, _refs(spark), [lines], stage_map, log_path=str(to / "log"),
                           summary_path=str(to / "summary"), clean_path=str(to / "clean"), failed_path=str(to / "failed"),
                           log_file_path=str(to / "file"), order=[F.col("line")], orchestrator_id="o", stage="dag06", region="r",
                           country="US", source="s", component="c", vendor="v", objectname="f.csv", run_date="2024-01-15",
                           threshold="50", now=dt.datetime(2024, 1, 15, 12), **more)
    run(tmp_path / "a", failed_compression="gzip")
    run(tmp_path / "b")
    assert glob.glob(stored) == before
    packed = b"".join(p.read_bytes() for p in sorted((tmp_path / "a" / "failed").glob("part-*.txt.gz")))
    plain = "".join(p.read_text() for p in sorted((tmp_path / "b" / "failed").glob("part-*.txt")))
    assert plain and gzip.decompress(packed).decode() == plain
    parts = list((tmp_path / "a" / "log").rglob("part-*"))
    assert parts and all(p.name.endswith(".zstd.parquet") for p in parts)
    assert _written(spark, str(tmp_path / "a" / "log")) == _written(spark, str(tmp_path / "b" / "log"))


def test_send_check_meets_small_references_without_a_shuffle(spark, tmp_path):
    """The stored references' size is known, so the lines are checked where they are read, and the error-log file's rows are made
    once, not again to find the bounds of the ranges they are sorted in; its lines are those of the log rows (F1)."""
    import datetime as dt
    from ledgerline.operators import send as S
    from ledgerline.sinks import lines as LN
    lines, comp, _ = _check(spark)
    lines = lines.withColumn("twice", F.explode(F.array(F.lit(1), F.lit(2))))
    lines.createOrReplaceTempView("ll_send_lines5")
    comp.baseline_queries[:] = ["SELECT COUNT(*) FROM ll_send_lines5"]
    stage_map = spark.createDataFrame([("dag06", "File, checks"), ("dag06", "again"), ("dag05", "x")], "Stage string, StageDescription string")
    made = _refs(spark)
    refs = S._kept_references(made, str(tmp_path / "refs"))
    for name in ("wagetypes", "currencykey", "wagetype_currency"):
        assert rows(getattr(refs, name)) == rows(getattr(made, name).distinct())
    stored = S.keep(lines, str(tmp_path / "lines"))
    plan = RC.check_lines(RC.parse_records(stored), comp, refs)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    kinds = []
    lines_written = LN.in_order
    LN.in_order = lambda df, order: kinds.append(df.columns) or lines_written(df, order)
    try:
        S.run_send_check(spark, lines, comp, made, [lines], stage_map, log_path=str(tmp_path / "log"), summary_path=str(tmp_path / "summary"),
                         clean_path=str(tmp_path / "clean"), failed_path=str(tmp_path / "failed"), log_file_path=str(tmp_path / "file"),
                         order=[F.col("id")], orchestrator_id="o", stage="dag06", region="r", country="US", source="s", component="c",
                         vendor="v", objectname="f.csv", run_date="2024-01-15", threshold="50", now=dt.datetime(2024, 1, 15, 12))
    finally:
        LN.in_order = lines_written
    assert len(kinds) == 2 and all("section" not in c for c in kinds)   # the clean and the removed lines only
    text = [r.line for r in LN.read_lines(spark, str(tmp_path / "file")).orderBy(*LN.written_order()).collect()]
    assert text[0] == "Timestamp : 2024-01-15 12:00:00" and text[12].startswith("Status : ") and text[13].startswith("orchestratorid,stage,")
    want = []
    for r in RC.check_records(RC.parse_records(lines), comp, _refs(spark)).collect():
        desc = f'"{r.errordescription}"' if "," in r.errordescription else r.errordescription
        for stage in ('"File, checks"', "again"):
            want.append(f"o,dag06,{stage},r,US,s,c,f.csv,High,{r.type},{r.erroridentifier or ''},2024-01-15,2024-01-15 12:00:00,{desc},fix")
    assert len(want) == 36 and text[14:] == sorted(want)


def test_descriptions_of_rules_with_other_fields(spark):
    """Fields beyond the line, names with commas, rules without fields: the description's texts and fields in the rule's order."""
    lines = spark.createDataFrame([(0, 'T|"a|"b,c|"')], "id int, line string")
    comp = RC.compile_rules(spark, [_rule("T", 1, "IN", "['a']", "{2: 'x, y', 1: 'z', 9: 'w', 0: 't'}", desc="d"),
                                    _rule("T", 1, "IN", "['a']", "", desc=""), _rule("T", 3, "IN", "['']", "{3: 'e'}", desc=None)])
    got = rows(RC.check_records(RC.parse_records(lines), comp, RC.References("US")), "errordescription", "erroridentifier", "value")
    assert got == sorted([(";", None, "a"), (";e:", "e", ""), ("d;x, y:b,c|z:a|w:|t:T", "z", "a")])


def test_dates_are_looked_up_as_they_are_parsed(spark):
    """The look-up of the day finds what parsing finds, leap days and the year 0 included, and parses only what it can't tell (F1)."""
    dates = ["20240131", "20240230", "20230229", "20240229", "19000229", "20000229", "00000101", "00000229", "00010101", "99991231",
             "20241301", "20240001", "20240100", "20240431", "20240430", "20240132", "20240131\n", "2024-01-31", "2024013", ""]
    lines = spark.createDataFrame([(f'T|"{d}',) for d in dates], "line string")
    comp = RC.compile_rules(spark, [_rule("T", 1, "DATEFORMAT", r"^\d{4}\d{2}\d{2}$")])
    checked = RC.check_lines(RC.parse_records(lines), comp, RC.References("US"))
    value = F.get(F.split("line", r'\|"', -1), 1)
    want = F.coalesce(~F.regexp_like(value, F.lit(r"^\d{4}\d{2}\d{2}$")) | F.try_to_timestamp(value, F.lit("yyyyMMdd")).isNull(), F.lit(False))
    got = {r.line: (bool(r.violated), r.want) for r in checked.withColumn("want", want).collect()}
    assert len(got) == 20 and all(a == b for a, b in got.values()), got
    assert sum(a for a, _ in got.values()) == 12
    assert "0131" in RC._DAYS and "0229" not in RC._DAYS and len(RC._DAYS) == 365
    assert "CASE" in str(RC._no_date(F.col("v"), comp.rows[0]))   # the old check parsed every date
