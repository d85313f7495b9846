"""Layout-driven file rendering: body blocks, headers, footers, names, routing, error-log lines.

Operators: J1 render_row, J2 render_body, J3 header_lines, J4/E13 footer_lines, J5 assemble_file,
J6 file_name, J7/G6 combine_views (later views first), J9 month/period helpers, F1 timestamp_sequence,
C14 route, B6/G5 error_log_lines.

Layouts are configuration (one JSON document per file kind) and compile to Column
expressions on the driver.  Rendered files are frames of ``(file_id, section, view_rank,
block, order_key, line)``: the order of a file is a sort key, never a global window, so a
file with a third of all rows still renders and writes in parallel (range partitioning in
the sink).
"""

from __future__ import annotations

import json
from functools import reduce
from typing import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as K

SECTION_HEADER, SECTION_BODY, SECTION_FOOTER = 0, 1, 2


def parse_layout(text: str) -> dict:
    """One layout document; malformed JSON or a missing Body raise."""
    doc = json.loads(text)
    if "Body" not in doc or "Headers" not in doc:
        raise ValueError("layout needs Headers and Body")
    return doc


def render_row(layout: str, variables: list[str], columns: list[str]) -> Column:
    """``{Field}`` replaced per variable, sequentially (a value holding ``{Other}`` is replaced
    again by a later variable); null / empty -> ''.  A field missing from the view raises."""
    expr = F.lit(layout)
    for v in variables:
        if v not in columns:
            raise KeyError(f"layout variable {v!r} is not a column of the view")
        expr = F.replace(expr, F.lit("{" + v + "}"), F.coalesce(F.col(f"`{v}`").cast("string"), F.lit("")))
    return expr


def order_key(order_col: str | None) -> Column:
    """The configured order columns (a comma list, any type) as one sortable value: a single column
    as it is, several as a struct (compared field by field, NULLs first)."""
    names = [c.strip() for c in (order_col or "").split(",") if c.strip()]
    if not names:
        return F.lit(None).cast("long")
    return F.col(f"`{names[0]}`") if len(names) == 1 else F.struct(*[F.col(f"`{c}`") for c in names])


def render_body(files: DataFrame, views: list[DataFrame], layouts: list[dict], file_key: str,
                order_col: str | None, functions: dict[str, str] | None = None) -> DataFrame:
    """Body lines of every file, one frame.

    ``files`` has one row per file (``file_key``); each view carries ``file_key``.  View i is
    rendered with layout i; later views come first in the file (``view_rank`` = position
    from the end).  A non-repeating block renders once per file with function values bound
    (e.g. ``{GetPeriodStartDate}``); a repeating block renders once per view row.
    """
    if len(views) != len(layouts):
        raise ValueError(f"{len(views)} views but {len(layouts)} layouts")
    functions = functions or {}
    okey = order_key(order_col).alias("order_key")
    otype = views[0].select(okey).schema["order_key"].dataType
    parts = []
    n = len(views)
    for pos, (view, layout) in enumerate(zip(views, layouts)):
        rank = n - 1 - pos
        for b, block in enumerate(layout["Body"]):
            if not block.get("Repeat"):
                text = block["Layout"]
                for var in block.get("Variables", []):
                    fn = var.get("FunctionName")
                    if fn:
                        if fn not in functions:
                            raise KeyError(f"no value for layout function {fn!r}")
                        text = text.replace("{" + fn + "}", functions[fn])
                parts.append(files.select(
                    F.col(file_key), F.lit(rank).alias("view_rank"), F.lit(b).alias("block"),
                    F.lit(None).cast(otype).alias("order_key"), F.lit(text).alias("line")))
            else:
                names = [v["ViewFieldName"] for v in block.get("Variables", [])]
                parts.append(view.select(
                    F.col(file_key), F.lit(rank).alias("view_rank"), F.lit(b).alias("block"),
                    okey, render_row(block["Layout"], names, view.columns).alias("line")))
    body = reduce(lambda a, c: a.unionByName(c), parts)
    return body.withColumn("section", F.lit(SECTION_BODY))


def header_lines(files: DataFrame, file_key: str, header: dict,
                 header_function: Callable[[DataFrame], Column] | None = None, order_type="long") -> DataFrame:
    """Fixed header values (one line each) or a user function of the file row.

    ``order_type`` is the type of the body's order key (NULL here)."""
    if header.get("IsFixed"):
        vals = list(header.get("Values", []))
        arr = F.array(*[F.lit(v) for v in vals]) if vals else F.array().cast("array<string>")
        h = files.select(F.col(file_key), F.posexplode(arr).alias("block", "line"))
    else:
        if header_function is None:
            raise KeyError(f"no header function {header.get('HeaderFunction')!r}")
        h = files.select(F.col(file_key), F.lit(0).alias("block"), header_function(files).alias("line"))
    return h.select(file_key, F.lit(SECTION_HEADER).alias("section"), F.lit(None).cast("int").alias("view_rank"),
                    F.col("block").cast("int").alias("block"), F.lit(None).cast(order_type).alias("order_key"), "line")


def footer_lines(files: DataFrame, body: DataFrame, file_key: str, footer: str | None) -> DataFrame | None:
    """First footer of the layout with ``{TotalLineCount}`` = body lines + 2."""
    if not footer:
        return None
    counts = body.groupBy(file_key).agg(F.count(F.lit(1)).alias("__n"))
    f = files.select(file_key).join(counts, file_key, "left")
    total = (F.coalesce(F.col("__n"), F.lit(0)) + 2).cast("string")
    return f.select(file_key, F.lit(SECTION_FOOTER).alias("section"), F.lit(None).cast("int").alias("view_rank"),
                    F.lit(0).alias("block"), F.lit(None).cast(body.schema["order_key"].dataType).alias("order_key"),
                    F.replace(F.lit(footer), F.lit(K.TOTAL_LINE_COUNT_TOKEN), total).alias("line"))


def assemble_file(files: DataFrame, body: DataFrame, file_key: str, layout: dict,
                  header_function=None) -> DataFrame:
    """Header, body (if any), footer (if the layout has one) of every file.

    Header and footer come from the given layout (the *last* layout of the file).
    """
    parts = [header_lines(files, file_key, layout["Headers"], header_function, body.schema["order_key"].dataType),
             body.select(file_key, "section", F.col("view_rank").cast("int"), F.col("block").cast("int"),
                         "order_key", "line")]
    footers = layout.get("Footers") or []
    foot = footer_lines(files, body, file_key, footers[0]["Value"] if footers else None)
    if foot is not None:
        parts.append(foot)
    return reduce(lambda a, c: a.unionByName(c), parts)


def file_order(file_key: str) -> list[Column]:
    """Sort key of rendered lines inside a file."""
    return [F.col(file_key), F.col("section"), F.col("view_rank").asc_nulls_first(), F.col("block"),
            F.col("order_key").asc_nulls_first()]


# --------------------------------------------------------------------------- F1, J6, J9

def timestamp_sequence(configs: DataFrame, start: str, order_cols: list[str]) -> DataFrame:
    """``TimestampFile`` = start + i seconds (``yyyyMMddHHmmss``) in a fixed order of the config rows.

    File configurations are a bounded configuration frame (one row per output file), so a
    single ordered window over them is fine; data rows never go through this.
    """
    w = Window.orderBy(*[F.col(c).asc_nulls_first() for c in order_cols])
    ts = F.timestamp_add("SECOND", F.row_number().over(w) - 1, F.lit(start).cast("timestamp_ntz"))
    return configs.withColumn("TimestampFile", F.date_format(ts, K.FILE_TIMESTAMP_FORMAT))


def file_name(output_file_name: Column, extension: Column, timestamp: Column,
              calculated: Column | None = None) -> Column:
    """``CalculatedFileName`` (case-insensitive) -> a calculated name; else ``trim(name)_ts.ext``."""
    plain = F.concat(F.trim(output_file_name), F.lit("_"), timestamp, extension)
    if calculated is None:
        calculated = F.lit(None).cast("string")
    return F.when(F.upper(output_file_name) == F.lit(K.CALCULATED_FILE_NAME.upper()), calculated).otherwise(plain)


def csv_name(name: Column) -> Column:
    """The body file of a non-csv output keeps the stem with ``.csv``."""
    return F.when(name.endswith(".csv"), name).otherwise(F.concat(F.split(name, r"\.").getItem(0), F.lit(".csv")))


# --------------------------------------------------------------------------- C14

def route(status: Column, override: Column, skip: Column, check_enabled: Column) -> Column:
    """Destination folder kind of a rendered file.

    Check on, status Failure and override off -> ``failed`` (wins over skip); else skip
    flag -> ``skipped``; else ``success``.  Flags are booleans (true only for TRUE).
    """
    failed = check_enabled & (status == F.lit(K.STATUS_FAILURE)) & ~F.coalesce(override, F.lit(False))
    return (F.when(failed, F.lit("failed"))
            .when(F.coalesce(skip, F.lit(False)), F.lit("skipped"))
            .otherwise(F.lit("success")))


def flag(text: Column) -> Column:
    """Configuration flag text -> boolean (``TRUE`` in any case is true, anything else false)."""
    return F.coalesce(F.upper(F.trim(text)) == F.lit("TRUE"), F.lit(False))


# --------------------------------------------------------------------------- B6 / G5

def _cell(c: Column) -> Column:
    s = F.coalesce(c.cast("string"), F.lit(""))
    return F.when(F.contains(s, F.lit(",")) | (s == F.lit(" ")), F.concat(F.lit('"'), s, F.lit('"'))).otherwise(s)


def log_line_ends(column: str) -> tuple[Column, Column]:
    """The text of a log row's line before and after the cell of ``column``, which is neither the first nor the last one.

    Where only that cell differs from row to row, both texts are made once and ``log_line`` puts the cell between them.
    """
    at = K.ERROR_LOG_FILE_COLUMNS.index(column)
    cells = [_cell(F.col(c)) for c in K.ERROR_LOG_FILE_COLUMNS]
    return F.concat_ws(",", *cells[:at], F.lit("")), F.concat_ws(",", F.lit(""), *cells[at + 1:])


def log_line(before: Column, cell: Column, after: Column) -> Column:
    """The line of a log row by the texts of ``log_line_ends``."""
    return F.concat(before, _cell(cell), after)


def error_log_lines(info: DataFrame, values: list[Column], rows: DataFrame, file_key: str,
                    lines: DataFrame | None = None, files: DataFrame | None = None) -> DataFrame:
    """Lines of the error-log file: 13 ``Key : value`` info lines, then (only when there are log
    rows) the column line and one comma-joined line per log row (cells holding ',' or equal to
    one space are quoted).  ``values`` are the 13 info values, in label order, as expressions
    over ``info`` (one row per file); ``rows`` has ``file_key`` plus the log-file columns.
    ``lines`` are the lines of further log rows (``file_key``, ``line``), and ``files`` has the key of every file among them.
    """
    labels = K.ERROR_LOG_INFO_LABELS
    if len(values) != len(labels):
        raise ValueError(f"need {len(labels)} info values")
    info_arr = F.array(*[F.concat(F.lit(lbl + " : "), F.coalesce(v.cast("string"), F.lit("")))
                         for lbl, v in zip(labels, values)])
    info_l = info.select(file_key, F.posexplode(info_arr).alias("seq", "line")) \
        .select(file_key, F.lit(0).alias("section"), F.col("seq").cast("long").alias("seq"), "line")
    has_rows = (rows.select(file_key) if files is None else rows.select(file_key).unionByName(files.select(file_key))).distinct()
    head = has_rows.select(file_key, F.lit(1).alias("section"), F.lit(0).cast("long").alias("seq"),
                           F.lit(",".join(K.ERROR_LOG_FILE_COLUMNS)).alias("line"))
    body = rows.select(file_key, F.lit(2).alias("section"), F.lit(None).cast("long").alias("seq"),
                       F.concat_ws(",", *[_cell(F.col(c)) for c in K.ERROR_LOG_FILE_COLUMNS]).alias("line"))
    if lines is not None:
        body = body.unionByName(lines.select(file_key, F.lit(2).alias("section"), F.lit(None).cast("long").alias("seq"), "line"))
    return info_l.unionByName(head).unionByName(body)


# --------------------------------------------------------------------------- J8

def generate_files(files: DataFrame, file_key: str, views: list[DataFrame], layouts: list[dict],
                   order_col: str | None, functions: dict[str, str] | None, compiled=None, refs=None,
                   baseline: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``(lines, status)`` of many files that share their views, layouts, order and rules (J8 with I4 and C14).

    ``files``: one row per file with ``file_key`` and the flags ``check_enabled``, ``override``, ``skip`` (booleans) and
    ``threshold`` (text); the rest of the configuration is the same for all.  See ``filesets.generate_file_set``.
    """
    from . import filesets as FS
    if len(views) != len(layouts):
        raise ValueError(f"{len(views)} views but {len(layouts)} layouts")
    spark = files.sparkSession
    names = [str(i) for i in range(len(views))]
    values = [x for k, v in (functions or {}).items() for x in (F.lit(k), F.lit(v))]
    config = files.select("*", F.lit(",".join(names)).alias("OutputViewName"), F.lit(",".join(names)).alias("LayoutPath"),
                          F.lit(order_col or "").alias("OrderByColumn"),
                          (F.create_map(*values) if values else F.create_map()).cast("map<string,string>").alias("functions"))
    docs = FS.parse_layouts(spark.createDataFrame([(n, json.dumps(doc)) for n, doc in zip(names, layouts)], "layout string, text string"))
    result = FS.generate_file_set(config, dict(zip(names, views)), docs, file_key, compiled, None, refs, baseline)
    return result.lines.withColumn("order_key", _plain_order(views[0], order_col)), result.status


def _plain_order(view: DataFrame, order_col: str | None) -> Column:
    """The order key of rendered files in the order columns' own types, as ``order_key`` gives it."""
    cols = [c.strip() for c in (order_col or "").split(",") if c.strip()]
    if not cols:
        return F.lit(None).cast("long")

    def value(i: int, c: str) -> Column:
        kind = view.schema[c].dataType
        part = F.get("order_key", F.lit(i))
        field = "d" if kind.typeName() in ("float", "double") else "s" if kind.typeName() in ("string", "timestamp_ntz") else "n"
        return part[field].cast(kind)
    if len(cols) == 1:
        return value(0, cols[0])
    return F.when(F.col("order_key").isNotNull(), F.struct(*[value(i, c).alias(c) for i, c in enumerate(cols)]))
