"""String-level Column helpers and small driver-side config helpers."""

from __future__ import annotations

import ast
import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K


def prefix_match(value: Column, pattern) -> Column:
    """Python ``re.match`` semantics (anchored at the start, not at the end).

    ``rlike`` searches anywhere, so the pattern is wrapped in ``^(?:...)``.  ``pattern``
    may be a Python string or a Column (rlike accepts a pattern column).
    """
    p = F.lit(pattern) if isinstance(pattern, str) else pattern
    return F.regexp_like(value, F.concat(F.lit("^(?:"), p, F.lit(")")))


def glob_to_regex(glob: str) -> str:
    """Translate an object-store glob (``*``, ``?``, ``[...]``, ``{a,b}``) to an anchored regex.

    Used on small mapping configuration on the driver; the listing itself stays in Spark.
    ``*`` does not cross ``/`` (top-level listing semantics), ``**`` does.
    """
    out, i, n = ["^"], 0, len(glob)
    while i < n:
        c = glob[i]
        if c == "*":
            if i + 1 < n and glob[i + 1] == "*":
                out.append(".*")
                i += 2
                continue
            out.append("[^/]*")
        elif c == "?":
            out.append("[^/]")
        elif c == "[":
            j = glob.find("]", i + 1)
            if j == -1:
                out.append(re.escape(c))
            else:
                body = glob[i + 1 : j]
                if body.startswith("!"):
                    body = "^" + body[1:]
                out.append("[" + body + "]")
                i = j
        elif c == "{":
            j = glob.find("}", i + 1)
            if j == -1:
                out.append(re.escape(c))
            else:
                alts = glob[i + 1 : j].split(",")
                out.append("(?:" + "|".join(re.escape(a) for a in alts) + ")")
                i = j
        else:
            out.append(re.escape(c))
        i += 1
    out.append("$")
    return "".join(out)


def bind_name(name: str, country: str = "", region: str = "", vendor: str = "",
              component: str = "") -> str:
    """Bind placeholders in an object name: all bound values are lower-cased."""
    return (
        name.replace(K.COUNTRY_PLACEHOLDER, (country or "").lower())
        .replace(K.REGION_PLACEHOLDER, (region or "").lower())
        .replace(K.VENDOR_PLACEHOLDER, (vendor or "").lower())
        .replace(K.COMPONENT_PLACEHOLDER, (component or "").lower())
    )


def bind_predicate(text: str, run_date: str, country: str = "", region: str = "") -> str:
    """Bind a rule predicate: date token, then country/region in their original case."""
    return (
        (text or "")
        .replace(K.DATE_TOKEN, run_date)
        .replace(K.COUNTRY_PLACEHOLDER, country or "")
        .replace(K.REGION_PLACEHOLDER, region or "")
    )


def bind_query(text: str, run_date: str, country: str = "", region: str = "",
               vendor: str = "", component: str = "") -> str:
    """Bind a reference / baseline query: date, date suffix, lower-cased names."""
    return bind_name(
        (text or "").replace(K.DATE_TOKEN, run_date).replace(
            K.DATE_SUFFIX_TOKEN, run_date.replace("-", "_")),
        country, region, vendor, component)


def log_field_value(c: Column) -> Column:
    """``REPLACE(IFNULL(SAFE_CAST(f AS STRING), 'null'), ',', '')``."""
    return F.replace(F.coalesce(c.try_cast("string"), F.lit("null")), F.lit(","), F.lit(""))


def log_fields(description, fields: list[str]) -> Column:
    """``description;f1:v1|f2:v2`` over the given columns.

    Each entry is used verbatim as its label (a configured list ``"a, b"`` labels the second
    field `` b``, as the original does) and, trimmed, as the column it reads.
    """
    desc = F.lit(description) if isinstance(description, str) else description
    parts = [F.concat(F.lit(f + ":"), log_field_value(F.col(f"`{f.strip()}`"))) for f in fields]
    return F.concat(desc, F.lit(";"), F.concat_ws("|", *parts))


def parse_list_literal(text: str) -> list[str]:
    """The string elements of a Python list/tuple literal from configuration.

    Record fields are text, so a non-string element (``[1, 2]``) can never equal a field value;
    such elements are dropped, which keeps membership results identical to comparing the typed
    literal.  A bare string literal is a one-element list.
    """
    v = ast.literal_eval(text) if text and text.strip() else []
    if isinstance(v, str):
        return [v]
    if not isinstance(v, (list, tuple, set, frozenset)):
        return []
    return [x for x in v if isinstance(x, str)]


def parse_fields_literal(text: str) -> list[tuple[int, str]]:
    """A Python dict literal ``{index: 'name'}`` from configuration, in its written order."""
    if not text or not text.strip():
        return []
    v = ast.literal_eval(text)
    if not isinstance(v, dict):
        raise ValueError(f"log-field mapping must be a dict literal: {text!r}")
    return [(int(k), str(n)) for k, n in v.items()]


def sql_text(value: str) -> str:
    """A value as a string literal of Spark SQL."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def split_csv_param(text: str, upper: bool = False) -> list[str]:
    """Comma list parameter: split on ',', trim, optionally upper-case, drop empties."""
    vals = [x.strip() for x in (text or "").split(",")]
    vals = [x.upper() if upper else x for x in vals]
    return [x for x in vals if x]


def any_of(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conds) if conds else F.lit(False)


def all_of(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds) if conds else F.lit(True)
