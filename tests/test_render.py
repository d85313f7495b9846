import pytest
from pyspark.sql import functions as F

from ledgerline.operators import render as RD
from conftest import rows

LAYOUT = {"Headers": {"IsFixed": True, "Values": ["H1", "H2"]},
          "Body": [{"Repeat": False, "Layout": "P|{GetPeriodStartDate}", "Variables": [{"FunctionName": "GetPeriodStartDate"}]},
                   {"Repeat": True, "Layout": "R|{A}|{B}", "Variables": [{"ViewFieldName": "A"}, {"ViewFieldName": "B"}]}],
          "Footers": [{"Value": "T|{TotalLineCount}"}]}


def _view(spark):
    return spark.createDataFrame([("f1", 2, "x", None), ("f1", 1, "{B}", "b"), ("f2", 3, "", "z")],
                                 "fid string, k int, A string, B string")


def test_render_chained_and_nulls(spark):
    files = spark.createDataFrame([("f1",), ("f2",), ("f3",)], "fid string")
    body = RD.render_body(files, [_view(spark)], [LAYOUT], "fid", "k", {"GetPeriodStartDate": "2024-01-01"})
    got = rows(body, "fid", "block", "order_key", "line")
    assert ("f1", 1, 1, "R|b|b") in got        # value holding {B} is replaced again by the later variable
    assert ("f1", 1, 2, "R|x|") in got         # null -> ''
    assert ("f3", 0, None, "P|2024-01-01") in got
    full = RD.assemble_file(files, body, "fid", LAYOUT)
    foot = rows(full.where("section = 2"), "fid", "line")
    assert foot == [("f1", "T|5"), ("f2", "T|4"), ("f3", "T|3")]   # body lines + 2, header size ignored


def test_render_errors(spark):
    files = spark.createDataFrame([("f1",)], "fid string")
    bad = {"Headers": {"IsFixed": True, "Values": []}, "Body": [{"Repeat": True, "Layout": "{Z}",
                                                                   "Variables": [{"ViewFieldName": "Z"}]}]}
    with pytest.raises(KeyError):
        RD.render_body(files, [_view(spark)], [bad], "fid", "k")
    with pytest.raises(ValueError):
        RD.render_body(files, [_view(spark), _view(spark)], [LAYOUT], "fid", "k")


def test_later_view_first(spark):
    files = spark.createDataFrame([("f1",)], "fid string")
    l1 = {"Headers": {"IsFixed": True, "Values": []}, "Body": [{"Repeat": True, "Layout": "one|{A}", "Variables": [{"ViewFieldName": "A"}]}]}
    l2 = {"Headers": {"IsFixed": True, "Values": []}, "Body": [{"Repeat": True, "Layout": "two|{A}", "Variables": [{"ViewFieldName": "A"}]}]}
    v = _view(spark).where("fid = 'f1'")
    body = RD.render_body(files, [v, v], [l1, l2], "fid", "k")
    ordered = [r.line for r in body.orderBy(*RD.file_order("fid")).collect()]
    assert ordered[0].startswith("two|") and ordered[-1].startswith("one|")


def test_route_precedence(spark):
    df = spark.createDataFrame([("Failure", "FALSE", "TRUE", True), ("Failure", "TRUE", "TRUE", True),
                                ("Failure", "false", None, False), ("Success", None, "true", True)],
                               "status string, ov string, sk string, chk boolean")
    got = [r.r for r in df.select(RD.route(F.col("status"), RD.flag(F.col("ov")), RD.flag(F.col("sk")),
                                           F.col("chk")).alias("r")).collect()]
    assert got == ["failed", "skipped", "success", "skipped"]


def test_error_log_lines_quoting(spark):
    cols = RD.K.ERROR_LOG_FILE_COLUMNS
    vals = ["o", "s", "d", "r", "c", "src", "comp", "obj", "High", "Error", "id", "2024-01-15", "ts", "a,b", " "]
    rows_df = spark.createDataFrame([tuple(vals)], ", ".join(f"`{c}` string" for c in cols))
    info = spark.createDataFrame([("c",)], "country string")
    values = [F.lit(str(i)) for i in range(13)]
    out = RD.error_log_lines(info, values, rows_df, "country")
    lines = [r.line for r in out.orderBy("section", "seq").collect()]
    assert lines[0] == "Timestamp : 0" and lines[12] == "Status : 12"
    assert lines[13] == ",".join(cols)
    assert lines[14].endswith(',"a,b"," "')
    empty = RD.error_log_lines(info, values, rows_df.limit(0), "country")
    assert empty.count() == 13


def test_file_names(spark):
    cfg = spark.createDataFrame([("B", " name ", ".csv"), ("A", "CALCULATEDFILENAME", ".txt")],
                                "k string, OutputFileName string, OutputFileExtension string")
    seq = RD.timestamp_sequence(cfg, "2024-01-15 23:59:59", ["k"])
    got = rows(seq.select("k", "TimestampFile", RD.file_name(F.col("OutputFileName"), F.col("OutputFileExtension"),
                                                             F.col("TimestampFile"), F.lit("calc")).alias("n")))
    assert got == [("A", "20240115235959", "calc"), ("B", "20240116000000", "name_20240116000000.csv")]


def test_header_function_and_date_helpers(spark):
    import datetime as dt
    from ledgerline.functions.dates import date_suffix, effective_date, month_of, month_start
    files = spark.createDataFrame([("f1", "US")], "fid string, country string")
    layout = {"Headers": {"IsFixed": False, "HeaderFunction": "hdr"}, "Body": []}
    head = RD.header_lines(files, "fid", layout["Headers"],
                           lambda f: F.concat(F.lit("HDR|"), F.col("country"), F.lit("|"), F.lit(month_of("2024-03-05"))))
    assert [r.line for r in head.collect()] == ["HDR|US|03"]
    import pytest
    with pytest.raises(KeyError):
        RD.header_lines(files, "fid", layout["Headers"])
    assert effective_date("2024-01-15", False) == "2024-01-15"
    assert effective_date("2024-01-15", True, dt.date(2026, 2, 3)) == "2026-02-03"
    assert date_suffix("2024-01-15") == "2024_01_15" and month_start("2024-01-15") == "2024-01-01"
    names = spark.createDataFrame([("a.SAP",), ("b.csv",), ("c_1.txt",)], "n string")
    assert [r.c for r in names.select(RD.csv_name(F.col("n")).alias("c")).collect()] == ["a.csv", "b.csv", "c_1.csv"]


def test_generate_files_without_checks_and_empty_view(spark):
    files = spark.createDataFrame([("f1", False, False, True, "5"), ("f2", False, True, False, "")],
                                  "fid string, check_enabled boolean, override boolean, skip boolean, threshold string")
    view = spark.createDataFrame([("f1", 1, "a", "b")], "fid string, k int, A string, B string")
    lines, status = RD.generate_files(files, "fid", [view], [LAYOUT], "k", {"GetPeriodStartDate": "2024-01-01"})
    routes = dict((r.fid, r.route) for r in status.collect())
    assert routes == {"f1": "skipped", "f2": "success"}       # no check: never failed
    got = rows(lines, "fid", "section", "line")
    assert ("f1", 2, "T|4") in got and ("f2", 2, "T|3") in got   # f2 has no view rows: static line only
    assert ("f2", 1, "P|2024-01-01") in got


def test_layout_without_footer(spark):
    files = spark.createDataFrame([("f1",)], "fid string")
    no_footer = {"Headers": {"IsFixed": True, "Values": ["H"]},
                 "Body": [{"Repeat": True, "Layout": "R|{A}", "Variables": [{"ViewFieldName": "A"}]}]}
    body = RD.render_body(files, [_view(spark).where("fid = 'f1'")], [no_footer], "fid", "k")
    out = RD.assemble_file(files, body, "fid", no_footer)
    assert sorted(r.section for r in out.collect()) == [0, 1, 1]
