"""Numbered and merged line files, file sets with their own configuration, and their writes."""

import json

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import filesets as FS
from ledgerline.sinks import lines as LN
from conftest import rows


def test_equal_keys_spread_over_parts(spark, tmp_path):
    """200,000 lines with one sort key: several parts, gapless numbers, and the written order is the numbers' order."""
    df = spark.range(200_000, numPartitions=3).select(F.lit("f").alias("f"), F.lit(None).cast("long").alias("seq"),
                                                      F.col("id").cast("string").alias("line"))
    numbered = LN.number_lines(df, ["f"], [F.col("seq")])
    got = numbered.agg(F.min("line_no"), F.max("line_no"), F.countDistinct("line_no"), F.countDistinct("line")).first()
    assert tuple(got) == (1, 200_000, 200_000, 200_000)
    path = str(tmp_path / "out")
    LN.write_lines(df, path, [F.col("seq")], ["f"])
    back = LN.read_lines(spark, path)
    sizes = [r["count"] for r in back.groupBy("part").count().collect()]
    assert len(sizes) > 1 and max(sizes) < 100_000 and sum(sizes) == 200_000


def test_numbers_follow_the_order_in_each_file(spark):
    df = spark.createDataFrame([(f, k, f"{k:03d}") for f in ("a", "b") for k in range(300)] + [("c", 0, "only")], "f string, k int, line string")
    got = LN.number_lines(df.repartition(5), ["f"], [F.col("k").desc()]).collect()
    assert {(r.f, r.line_no): r.k for r in got} == {(f, 300 - k): k for f in ("a", "b") for k in range(300)} | {("c", 1): 0}
    assert LN.number_lines(df.limit(0), ["f"], [F.col("k")]).collect() == []


def test_merged_files_are_single_objects(spark, tmp_path):
    df = spark.createDataFrame([(f, k, f"{f}{k:04d}") for f in ("a", "b x/y") for k in range(2000)], "f string, k int, line string")
    LN.write_lines(df.repartition(4), str(tmp_path / "parts"), [F.col("k")], ["f"])
    LN.merge_files(spark, str(tmp_path / "parts"), str(tmp_path / "whole"), ["f"])
    back = LN.read_lines(spark, str(tmp_path / "whole"))
    assert {r.f: r.n for r in back.groupBy("f").agg(F.countDistinct("part").alias("n")).collect()} == {"a": 1, "b x/y": 1}
    got = LN.number_lines(back, ["f"], LN.written_order())
    assert all(r.line == f"{r.f}{r.line_no - 1:04d}" for r in got.collect()) and got.count() == 4000


DOCS = {"a.json": {"Headers": {"IsFixed": True, "Values": ["H1", "H2"]},
                   "Body": [{"Repeat": False, "Layout": "P|{day}", "Variables": [{"FunctionName": "day"}]},
                            {"Repeat": True, "Layout": "R|{A}|{B}", "Variables": [{"ViewFieldName": "A"}, {"ViewFieldName": "B"}]}],
                   "Footers": [{"Value": "T|{TotalLineCount}"}]},
        "b.json": {"Headers": {"IsFixed": False, "HeaderFunction": "head"},
                   "Body": [{"Repeat": True, "Layout": "S|{B}", "Variables": [{"ViewFieldName": "B"}]}]},
        "none.json": {"Headers": {"IsFixed": True, "Values": []}, "Body": [{"Repeat": False, "Layout": "fixed"}]}}


def _layouts(spark, docs=DOCS):
    return FS.parse_layouts(spark.createDataFrame([(k, json.dumps(v)) for k, v in docs.items()], "layout string, text string"))


def _files(spark, rows_):
    df = spark.createDataFrame(rows_, "f string, OutputViewName string, LayoutPath string, OrderByColumn string")
    return df.select("*", F.create_map(F.lit("day"), F.concat(F.lit("d-"), "f"), F.lit("head"), F.concat(F.lit("h-"), "f")).alias("functions"),
                     F.lit(True).alias("check_enabled"), F.lit(False).alias("override"), (F.col("f") == "f3").alias("skip"),
                     F.lit("100").alias("threshold"))


VIEW = [("f1", 2, "x", None), ("f1", 10, "{B}", "b"), ("f2", 3, "", "z"), ("f2", 1, None, "a"), ("f3", 5, "q", "r")]


def _view(spark):
    return spark.createDataFrame(VIEW, "f string, k int, A string, B string")


def _texts(result, key="f"):
    numbered = LN.number_lines(result.lines, [key], FS.line_order())
    out = {}
    for r in numbered.orderBy(key, "line_no").collect():
        out.setdefault(r[key], []).append(r.line)
    return out


def test_files_by_their_own_configuration(spark):
    files = _files(spark, [("f1", "v", "a.json", "k"), ("f2", "v, w", "a.json,b.json", "B"), ("f3", "w", "none.json", ""), ("f4", "v", "a.json", "k")])
    views = {"v": _view(spark), "w": _view(spark).where("k > 1")}
    result = FS.generate_file_set(files, views, _layouts(spark), "f")
    assert _texts(result) == {
        "f1": ["H1", "H2", "P|d-f1", "R|x|", "R|b|b", "T|5"],          # by number: 2 before 10; {B} filled again; null -> ''
        "f2": ["h-f2", "S|z", "P|d-f2", "R||a", "R||z"],               # the later view first, by text; the last layout's header, no footer
        "f3": ["fixed"],
        "f4": ["H1", "H2", "P|d-f4", "T|3"]}                            # no view rows
    status = {r.f: (r.file_count, r.view_count, r.baseline, r.route) for r in result.status.collect()}
    assert status == {"f1": (3, 2, 2, "success"), "f2": (4, 3, 3, "success"), "f3": (1, 1, 1, "skipped"), "f4": (1, 0, 0, "success")}


def test_file_set_errors(spark):
    views = {"v": _view(spark)}
    layouts = _layouts(spark)
    for row, error in ((("f1", "v,v", "a.json", "k"), "differ in number"), (("f1", "v", "gone.json", "k"), "no such layout")):
        with pytest.raises(Exception, match=error):
            FS.generate_file_set(_files(spark, [row]), views, layouts, "f")
    with pytest.raises(KeyError, match="no such view"):
        FS.generate_file_set(_files(spark, [("f1", "u", "a.json", "k")]), views, layouts, "f")
    with pytest.raises(KeyError, match="doesn't have"):
        FS.generate_file_set(_files(spark, [("f1", "v", "a.json", "nope")]), views, layouts, "f")
    odd = dict(DOCS, **{"a.json": {"Headers": {"IsFixed": True, "Values": []}, "Body": [
        {"Repeat": False, "Layout": "{x}", "Variables": [{"FunctionName": "x"}]}]}})
    with pytest.raises(Exception, match="no value for layout variable"):
        FS.generate_file_set(_files(spark, [("f1", "v", "a.json", "k")]), views, _layouts(spark, odd), "f").lines.collect()
    with pytest.raises(Exception, match="Headers and Body"):
        FS.parse_layouts(spark.createDataFrame([("x", "{}")], "layout string, text string")).collect()
    with pytest.raises(Exception):
        FS.parse_layouts(spark.createDataFrame([("x", "{not json")], "layout string, text string")).collect()


def test_order_values_compare_like_their_types(spark):
    df = spark.createDataFrame([(1, 10, 2.5, "b"), (2, 9, -1.0, "B"), (3, None, None, None), (4, -3, float("inf"), "a")], "id int, n long, d double, s string")
    for c, want in (("n", [3, 4, 2, 1]), ("d", [3, 2, 1, 4]), ("s", [3, 2, 4, 1])):
        key = FS.order_value(F.col(c), df.schema[c].dataType)
        assert [r.id for r in df.orderBy(F.array(key)).collect()] == want


def test_written_files_and_manifest(spark, tmp_path):
    root = str(tmp_path / "root")
    files = _files(spark, [("f1", "v", "a.json", "k"), ("f2", "v", "a.json", "B"), ("f3", "v", "a.json", "k")])
    result = FS.generate_file_set(files.withColumn("threshold", F.lit("20")), {"v": _view(spark)}, _layouts(spark), "f",
                                  baseline=spark.createDataFrame([("f1", 100), ("f2", 2), ("f3", 100)], "f string, baseline long"))
    assert {r.f: r.route for r in result.status.collect()} == {"f1": "success", "f2": "failed", "f3": "skipped"}
    names = files.select("f", F.concat("f", F.lit(" {1}=x/y.SAP")).alias("file_name"), F.concat("f", F.lit(".csv")).alias("csv_name"))
    run = FS.write_files(result, names, root, "f")
    got = {}
    for r in FS.read_files(spark, root, run).orderBy("folder", "file_name", "line_no").collect():
        got.setdefault((r.folder, r.file_name), []).append(r.line)
    whole = ["H1", "H2", "P|d-f1", "R|x|", "R|b|b", "T|5"]
    assert got == {("success", "f1 {1}=x/y.SAP"): whole, ("destination", "f1 {1}=x/y.SAP"): whole, ("failed", "f2.csv"): ["P|d-f2", "R||a", "R||z"],
                   ("skipped", "f3 {1}=x/y.SAP"): ["H1", "H2", "P|d-f3", "R|q|r", "T|4"]}
    assert {tuple(r) for r in spark.read.parquet(f"{root}/_manifest/{run}").select("folder", "n_lines").collect()} == {
        ("success", 6), ("destination", 6), ("failed", 3), ("skipped", 5)}
    with pytest.raises(Exception):
        FS.read_files(spark, root, "unfinished")


def test_rules_of_a_file_by_its_path(spark):
    files = spark.createDataFrame([("f1", "US", "Vend", "asia", "vend/asia/out/"), ("f2", "CA", "vend", "asia", "vend/asia/")],
                                  "f string, country string, Vendor string, Region string, source_path string")
    cols = ["Country", "Vendor", "ObjectName", "Operator"]
    rules = spark.createDataFrame([("US", "v", "out/pay_<COUNTRY_PLACEHOLDER>", "A"), ("US", "v", "other/pay", "B"), ("CA", "v", "pay", "C"),
                                   ("CA", "v", "out/pay", "D"), ("MX", "v", "pay", "E")], ", ".join(f"{c} string" for c in cols))
    assert rows(FS.file_rules(rules, files, "f"), "f", "Operator") == [("f1", "A"), ("f2", "C")]


def test_merge_sorts_pieces_not_lines(spark, tmp_path):
    """The task that writes a file gets pieces of joined lines, cut by bytes, whatever lines and folder values look like."""
    long = "x" * 3000
    df = spark.createDataFrame([(f, k, f"{k:05d}," + (long if k % 3 else '"é') + "|") for f in ("7", "b/=", None) for k in range(1500)],
                               "f string, k int, line string")
    LN.write_lines(df.repartition(3), str(tmp_path / "parts"), [F.col("k")], ["f"])
    lines = LN.read_lines(spark, str(tmp_path / "parts"))
    pieces = lines.mapInArrow(LN._join_lines, lines.schema).collect()
    assert len(pieces) < 200 and max(len(p.line) for p in pieces) < 2 * LN._PIECE
    LN.merge_files(spark, str(tmp_path / "parts"), str(tmp_path / "whole"), ["f"])
    for f, folder in (("7", "f=7"), ("b/=", "f=b%2F%3D"), (None, "f=__HIVE_DEFAULT_PARTITION__")):
        (written,) = (tmp_path / "whole" / folder).glob("*.txt")
        assert written.read_text(encoding="utf-8") == "".join(f"{k:05d}," + (long if k % 3 else '"é') + "|\n" for k in range(1500))
    LN.write_lines(df.where("f = '7'"), str(tmp_path / "one"), [F.col("k")])
    LN.merge_files(spark, str(tmp_path / "one"), str(tmp_path / "alone"))
    (written,) = (tmp_path / "alone").glob("*.txt")
    assert len(written.read_text(encoding="utf-8").splitlines()) == 1500


def test_lines_dealt_by_a_sample(spark, tmp_path):
    """Bounds from a sample: the parts in name order are the sorted file, a hot key lies in several parts, the rows ahead come first,
    and without any sampled key all is still written (F1)."""
    data = spark.range(4000).select(
        F.lit(2).alias("section"), F.when(F.col("id") % 2 == 0, "m").otherwise(F.concat(F.lit("k\u00e9"), F.col("id").cast("string"))).alias("line"))
    data = data.unionByName(spark.createDataFrame([(0, "z first"), (1, "a second")], "section int, line string")).repartition(3)
    order = [F.col("section"), F.col("line")]
    want = ["z first", "a second", *sorted(r.line for r in data.where("section = 2").collect())]
    for name, sample in (("some", data.where("section = 2").sample(0.3, seed=1)), ("none", data.limit(0)), ("hot", data.where("line = 'm'"))):
        path = str(tmp_path / name)
        LN.write_lines(data, path, order, dealt=(sample.select("line"), F.col("section") < 2))
        parts = [p.read_text().splitlines() for p in sorted((tmp_path / name).glob("part-*.txt"))]
        assert [x for p in parts for x in p] == want
        holding = sum("m" in p for p in parts)
        assert holding == 1 if name == "none" else holding >= 3
