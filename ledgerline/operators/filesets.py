"""J8 with I4 and C14: many output files at once, each with its own views, layouts, order, rules, country and flags.

Everything that differs by file is a frame keyed by ``file_key``: which views it takes and through which layouts (comma lists of
equal length), which rules apply (a bitmap over the distinct rules), its country, threshold and flags.  A layout block is a
template with its variable names; a view row fills it by a fold over the names, so the plan does not grow with the files or
the layouts, and each view is scanned once for all files.  The rendered lines are checked and stored once; counts,
status, routes, log, headers, bodies and footers derive from the stored lines.

``write_files`` puts the files into their folders (failed, skipped, success and the copy in destination) under a run's own
folder and makes them visible by one manifest, written last.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import constants as K
from ..session import store
from ..sinks.lines import number_lines, read_lines, write_lines
from . import records as RC
from . import thresholds as TH
from .render import SECTION_BODY, SECTION_FOOTER, SECTION_HEADER, route

LAYOUT_SCHEMA = ("Headers struct<IsFixed:boolean,Values:array<string>,HeaderFunction:string>, "
                 "Body array<struct<Repeat:boolean,Layout:string,Variables:array<struct<ViewFieldName:string,FunctionName:string>>>>, "
                 "Footers array<struct<Value:string>>")
ORDER_PART = "struct<n:decimal(38,10),d:double,s:string>"


def _fail(bad: Column, message: Column, value: Column) -> Column:
    return F.when(bad, F.raise_error(message)).otherwise(value)


# --------------------------------------------------------------------------- configuration frames

def parse_layouts(texts: DataFrame) -> DataFrame:
    """Layout documents ``(layout, text)`` as ``(layout, header, header_function, footer, blocks)``.

    ``blocks``: number, repeat, template, names of the variables.  Malformed JSON and a document without Headers or Body raise.
    """
    doc = F.from_json("text", LAYOUT_SCHEMA, {"mode": "FAILFAST"})
    whole = _fail(doc["Body"].isNull() | doc["Headers"].isNull(),
                  F.concat(F.lit("layout needs Headers and Body: "), "layout"), doc)
    d = texts.select("layout", whole.alias("d"))

    def names(block: Column) -> Column:
        of = F.transform(block["Variables"], lambda v: F.when(F.coalesce(block["Repeat"], F.lit(False)), v["ViewFieldName"])
                         .otherwise(v["FunctionName"]))
        return F.array_compact(F.coalesce(of, F.array().cast("array<string>")))
    blocks = F.transform("d.Body", lambda b, i: F.struct(
        i.cast("int").alias("block"), F.coalesce(b["Repeat"], F.lit(False)).alias("repeat"), b["Layout"].alias("template"),
        names(b).alias("names")))
    fixed = F.coalesce("d.Headers.IsFixed", F.lit(False))
    return d.select(
        "layout", F.when(fixed, F.coalesce("d.Headers.Values", F.array().cast("array<string>"))).alias("header"),
        F.when(~fixed, F.col("d.Headers.HeaderFunction")).alias("header_function"), F.get("d.Footers", F.lit(0))["Value"].alias("footer"),
        blocks.alias("blocks"))


def _list(text: str) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(F.col(text), F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")


def file_parts(files: DataFrame, layouts: DataFrame, file_key: str) -> DataFrame:
    """One row per file and view: ``view_rank`` (later views come first), view, the layout's columns, order names, functions.

    ``files``: ``OutputViewName`` and ``LayoutPath`` (comma lists; unequal lengths raise), ``OrderByColumn`` (comma list),
    ``functions`` (values of layout functions by name).  A layout that isn't there raises.
    """
    views, paths = _list("OutputViewName"), _list("LayoutPath")
    pairs = _fail(F.size(views) != F.size(paths), F.concat(F.lit("views and layouts differ in number: "), F.col(file_key)),
                  F.arrays_zip(views.alias("view"), paths.alias("layout")))
    own = (files.select(file_key, _list("OrderByColumn").alias("order_names"), "functions", pairs.alias("pairs"))
           .select("*", F.posexplode("pairs").alias("position", "pair"))
           .select(file_key, "order_names", "functions", F.size("pairs").alias("n") - 1 - F.col("position"),
                   F.col("pair.view").alias("view"), F.col("pair.layout").alias("wanted"))
           .toDF(file_key, "order_names", "functions", "view_rank", "view", "wanted"))
    j = own.join(layouts, F.col("wanted") == F.col("layout"), "left")
    return j.withColumn("blocks", _fail(F.col("layout").isNull(), F.concat(F.lit("no such layout: "), "wanted"), F.col("blocks"))).drop("layout")


def file_rules(rules: DataFrame, files: DataFrame, file_key: str) -> DataFrame:
    """The rules of each file (C13, D6): resolved rule rows with the ``file_key`` of every file they belong to.

    ``files`` has ``country``, ``Vendor``, ``Region`` and ``source_path``.  A rule belongs to a file of its country when the
    folder of its object, below ``vendor/region/`` with the placeholders bound (lower-cased), is the file's, ignoring case; the
    object's last part stands for the file itself, whatever its name.
    """
    own = files.select(file_key, F.col("country").alias("__country"), F.col("Vendor").alias("__vendor"),
                       F.col("Region").alias("__region"), "source_path")
    j = rules.join(own, F.col("Country") == F.col("__country"))
    name = F.concat("__vendor", F.lit("/"), "__region", F.lit("/"), "ObjectName")
    for token, c in ((K.COUNTRY_PLACEHOLDER, "__country"), (K.REGION_PLACEHOLDER, "__region"), (K.VENDOR_PLACEHOLDER, "__vendor")):
        name = F.replace(name, F.lit(token), F.lower(c))
    folder = F.regexp_extract(name, "^((?:.*/)?)[^/]*$", 1)
    return j.where(F.lower(folder) == F.lower("source_path")).select(file_key, *rules.columns)


# --------------------------------------------------------------------------- rendering

def order_value(c: Column, kind: T.DataType) -> Column:
    """A value of any type as one comparable struct: numbers by size, texts by their characters, nulls first."""
    n, d, s = F.lit(None).cast("decimal(38,10)"), F.lit(None).cast("double"), F.lit(None).cast("string")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        d = c.cast("double")
    elif isinstance(kind, (T.IntegralType, T.DecimalType, T.BooleanType)):
        n = c.cast("int").cast("decimal(38,10)") if isinstance(kind, T.BooleanType) else c.cast("decimal(38,10)")
    elif isinstance(kind, T.DateType):
        n = F.unix_date(c).cast("decimal(38,10)")
    elif isinstance(kind, T.TimestampType):
        n = F.unix_micros(c).cast("decimal(38,10)")
    else:
        s = c.cast("string")
    return F.struct(n.alias("n"), d.alias("d"), s.alias("s"))


def fill(template: Column, names: Column, values: Column) -> Column:
    """``{name}`` replaced by its value, name by name (a value holding a later ``{name}`` is replaced again); null -> ''."""
    def step(text: Column, name: Column) -> Column:
        value = _fail(~F.map_contains_key(values, name), F.concat(F.lit("no value for layout variable "), name),
                      F.coalesce(F.element_at(values, name), F.lit("")))
        return F.replace(text, F.concat(F.lit("{"), name, F.lit("}")), value)
    return F.aggregate(names, template, step)


def _map(pairs: list[Column], value_type: str) -> Column:
    return (F.create_map(*pairs) if pairs else F.create_map()).cast(f"map<string,{value_type}>")


def render_files(parts: DataFrame, views: Mapping[str, DataFrame], file_key: str) -> DataFrame:
    """Body lines ``(file_key, view_rank, block, order_key, line, head)`` of all files; each view is read once.

    ``parts`` as ``file_parts`` gives them, stored.  A view carries ``file_key`` and is rendered for its files; ``head``
    marks one line per view row, with a null line where the layout repeats nothing, so that rows can be counted.
    """
    # names that the configuration uses: no more of them than the views have columns
    used = (parts.select("view", F.explode(F.flatten(F.transform(F.filter("blocks", lambda b: b["repeat"]), lambda b: b["names"])))
                         .alias("name"), F.lit(False).alias("order"))
            .unionByName(parts.select("view", F.explode("order_names").alias("name"), F.lit(True).alias("order"))).distinct())
    names: dict[tuple[str, bool], set[str]] = {}
    for r in used.collect():
        names.setdefault((r["view"], r["order"]), set()).add(r["name"])
    wanted = {r["view"] for r in parts.select("view").distinct().collect()}
    if missing := sorted(wanted - set(views)):
        raise KeyError(f"no such view: {missing}")
    fixed = parts.select(file_key, "view_rank", "functions", F.explode(F.filter("blocks", lambda b: ~b["repeat"])).alias("b"))
    out = [fixed.select(file_key, "view_rank", F.col("b.block").alias("block"), F.lit(None).cast(f"array<{ORDER_PART}>").alias("order_key"),
                        fill(F.col("b.template"), F.col("b.names"), F.col("functions")).alias("line"), F.lit(False).alias("head"))]
    for name in sorted(wanted):
        view = views[name]
        types = {f.name: f.dataType for f in view.schema.fields}
        if absent := sorted((names.get((name, False), set()) | names.get((name, True), set())) - set(types)):
            raise KeyError(f"columns that view {name!r} doesn't have: {absent}")
        values = _map([x for c in sorted(names.get((name, False), ())) for x in (F.lit(c), F.col(f"`{c}`").cast("string"))], "string")
        order = _map([x for c in sorted(names.get((name, True), ())) for x in (F.lit(c), order_value(F.col(f"`{c}`"), types[c]))], ORDER_PART)
        own = parts.where(F.col("view") == F.lit(name)).select(
            file_key, "view_rank", "order_names", F.filter("blocks", lambda b: b["repeat"]).alias("blocks"))
        rows = view.select(F.col(file_key), values.alias("__values"), order.alias("__order")).join(own, file_key)
        rows = rows.select(file_key, "view_rank", "__values", "blocks",
                           F.transform("order_names", lambda n: F.element_at(F.col("__order"), n)).alias("order_key"))
        rows = rows.select(file_key, "view_rank", "__values", "order_key", F.posexplode_outer("blocks").alias("at", "b"))
        out.append(rows.select(file_key, "view_rank", F.col("b.block").alias("block"), "order_key",
                               F.when(F.col("b").isNotNull(), fill(F.col("b.template"), F.col("b.names"), F.col("__values"))).alias("line"),
                               (F.coalesce("at", F.lit(0)) == 0).alias("head")))
    return reduce(lambda a, b: a.unionByName(b), out)


# --------------------------------------------------------------------------- J8

@dataclass
class FileSet:
    lines: DataFrame     # (file_key, section, view_rank, block, order_key, line, route), files formatted unless failed
    status: DataFrame    # one row per file: counts, percentage, status, route
    log: DataFrame       # one row per (file, line, violated rule)


def generate_file_set(files: DataFrame, views: Mapping[str, DataFrame], layouts: DataFrame, file_key: str,
                      compiled: RC.CompiledRules | None = None, rule_bits: DataFrame | None = None,
                      refs: RC.References | None = None, baseline: DataFrame | None = None) -> FileSet:
    """Render, check, count, route and format all files of a run (J8 with I4 and C14).

    ``files``: one row per file with the columns of ``file_parts``, the booleans ``check_enabled``, ``override``, ``skip``, the
    text ``threshold``, and ``country`` where the checks of ``refs`` go by country.  ``layouts`` as ``parse_layouts`` gives
    them.  ``rule_bits``: which of the ``compiled`` rules apply to a file (all, when omitted).  ``baseline``:
    ``(file_key, baseline)``; without it the files' view rows are their baselines.

    Lines that break any rule leave their file, warnings included; a file's failures are its ``Error`` violations and the
    difference between its lines and its view rows.  A failed file keeps its checked body unformatted; the others get the
    last layout's header (fixed values, or the value of its header function), the body and the first footer, whose
    ``TotalLineCount`` counts the lines that are left plus 2.
    """
    files = store(files, "files")
    layouts = store(layouts, "layouts")
    parts = store(file_parts(files, layouts, file_key), "file-parts")
    rendered = render_files(parts, views, file_key)
    config = files.select(file_key, "check_enabled", *[c for c in ("country",) if c in files.columns])
    if rule_bits is not None:
        config = config.join(rule_bits, file_key, "left")
    rendered = rendered.join(config, file_key)
    rules = compiled or RC.CompiledRules([], [], [], [], [])
    checked = RC.check_lines(RC.parse_records(rendered), rules, refs or RC.References(""),
                             "rule_bits" if rule_bits is not None else None)
    on = F.col("check_enabled") & F.col("line").isNotNull()
    checked = store(checked.select(
        file_key, "view_rank", "block", "order_key", "line", "head", "record_type",
        F.when(on, F.col("violated")).otherwise(F.array().cast("array<int>")).alias("violated")), "file-lines")
    clean = F.col("line").isNotNull() & (F.size("violated") == 0)
    counts = checked.groupBy(file_key).agg(
        F.count_if(F.trim("line") != "").alias("file_count"), F.count_if("head").alias("view_count"),
        F.sum(RC.is_error(rules)).cast("long").alias("stagefailure"), F.count_if(clean).alias("clean_count"))
    own = files.select(file_key, "check_enabled", "override", "skip", "threshold").join(counts, file_key, "left").fillna(
        0, ["file_count", "view_count", "stagefailure", "clean_count"])
    own = (own.join(baseline, file_key, "left") if baseline is not None else own.withColumn("baseline", F.col("view_count")))
    own = (own.withColumn("baseline", F.coalesce("baseline", F.lit(0)).cast("long"))
           .withColumn("g2vsviewcountfailure", F.abs(F.col("file_count") - F.col("view_count")).cast("long"))
           .withColumn("totalfailure", F.col("stagefailure") + F.col("g2vsviewcountfailure"))
           .withColumn("thresholdpercentage", TH.threshold_value(F.col("threshold"))))
    status = TH.with_status(own).withColumn(
        "route", route(F.col("status"), F.col("override"), F.col("skip"), F.col("check_enabled")))
    last = (parts.where(F.col("view_rank") == 0)
            .select(file_key, F.coalesce("header", F.array(_fail(~F.map_contains_key("functions", F.col("header_function")),
                                                                 F.concat(F.lit("no value for header function "), "header_function"),
                                                                 F.element_at("functions", F.col("header_function"))))).alias("header"), "footer"))
    status = store(status.join(last, file_key, "left"), "file-status")

    formatted = status.where(F.col("route") != "failed")
    none = F.lit(None).cast(f"array<{ORDER_PART}>").alias("order_key")
    header = formatted.select(file_key, F.lit(SECTION_HEADER).alias("section"), F.lit(None).cast("int").alias("view_rank"),
                              F.posexplode("header").alias("block", "line"), none, "route")
    body = (checked.where(clean).join(status.select(file_key, "route"), file_key)
            .select(file_key, F.lit(SECTION_BODY).alias("section"), F.col("view_rank").cast("int"), F.col("block").cast("int"),
                    "order_key", "line", "route"))
    total = F.replace("footer", F.lit(K.TOTAL_LINE_COUNT_TOKEN), (F.col("clean_count") + 2).cast("string"))
    footer = formatted.where(F.coalesce("footer", F.lit("")) != "").select(
        file_key, F.lit(SECTION_FOOTER).alias("section"), F.lit(None).cast("int").alias("view_rank"), F.lit(0).alias("block"), none,
        total.alias("line"), "route")
    log = RC.violations_of(checked.select(file_key, "line", "record_type", "violated"), rules)
    return FileSet(header.unionByName(body).unionByName(footer), status.drop("header", "footer"), log)


def line_order() -> list[Column]:
    """Sort key of a file's lines; lines with equal keys are ordered by their text."""
    return [F.col("section"), F.col("view_rank").asc_nulls_first(), F.col("block"), F.col("order_key").asc_nulls_first(), F.col("line")]


# --------------------------------------------------------------------------- C14, write side

def write_files(result: FileSet, names: DataFrame, root: str, file_key: str) -> str:
    """Write all files of a run and return the run's id.

    ``names``: ``(file_key, file_name, csv_name)``.  A failed file goes to ``failed`` under its csv name, a skipped one to
    ``skipped``, the others to ``success`` and, as the copy that is picked up, to ``destination``.  Each file is a folder of
    ordered parts below ``run=<id>/folder=<folder>``.  The manifest (``folder, file_name, n_lines``) is written last: readers go
    by it, so a run that broke off, or is still writing, shows nothing.
    """
    spark = result.lines.sparkSession
    run = uuid.uuid4().hex[:12]
    spots = F.when(F.col("route") == "success", F.array(F.lit("success"), F.lit("destination"))).otherwise(F.array("route"))
    target = store(result.status.select(file_key, "route", spots.alias("folders")).join(names, file_key).select(
        file_key, F.explode("folders").alias("folder"),
        F.when(F.col("route") == "failed", F.col("csv_name")).otherwise(F.col("file_name")).alias("file_name")), "file-targets")
    placed = result.lines.join(target, file_key)
    write_lines(placed, f"{root}/run={run}", line_order(), ["folder", "file_name"], mode="errorifexists")
    written = read_lines(spark, f"{root}/run={run}").groupBy("folder", "file_name").agg(F.count(F.lit(1)).alias("n_lines"))
    (target.join(written, ["folder", "file_name"], "left").select("folder", "file_name", F.coalesce("n_lines", F.lit(0)).alias("n_lines"))
     .coalesce(1).write.parquet(f"{root}/_manifest/{run}"))
    return run


def read_files(spark: SparkSession, root: str, run: str) -> DataFrame:
    """Lines of a finished run: ``(folder, file_name, line_no, line)``.  A run without a manifest raises."""
    manifest = spark.read.parquet(f"{root}/_manifest/{run}")
    lines = read_lines(spark, f"{root}/run={run}").join(manifest.select("folder", "file_name"), ["folder", "file_name"], "left_semi")
    numbered = number_lines(lines, ["folder", "file_name"], [F.col("part"), F.col("block"), F.col("position")])
    return numbered.select("folder", "file_name", "line_no", "line")
