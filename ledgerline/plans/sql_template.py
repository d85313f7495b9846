"""Parameterised SQL jobs (C12): configuration lookups, replacements, placeholders, Spark SQL args.

Only the text of a job is prepared on the driver; values reach Spark either as named
parameters (``spark.sql(text, args=...)``) or as identifiers through ``IDENTIFIER(:name)``.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..functions import constants as K

_VAR = re.compile(K.CONFIG_VARIABLE)


def lookup(config: dict, dotted: str):
    cur = config
    for k in dotted.split("."):
        if not isinstance(cur, dict) or k not in cur:
            raise KeyError(f"configuration key {dotted!r} not found")
        cur = cur[k]
    return cur


def bind_config(text: str, config: dict, depth: int = 0) -> str:
    """Replace ``{a.b.c}`` by configuration values; values may themselves hold ``{x.y}``."""
    if depth > 20:
        raise ValueError("configuration references are cyclic")

    def repl(m):
        val = lookup(config, m.group(0)[1:-1])
        val = str(val)
        return bind_config(val, config, depth + 1) if _VAR.search(val) else val
    return _VAR.sub(repl, text)


def apply_replacements(text: str, replacements: str = "", environment: str | None = None) -> str:
    """``from,to;from,to`` pairs; a three-part ``ENV,from,to`` applies only in that environment."""
    if not replacements:
        return text
    for item in replacements.split(";"):
        parts = item.split(",")
        if len(parts) == 3:
            if environment is not None and parts[0].upper() == environment.upper():
                text = text.replace(parts[1], parts[2])
        elif len(parts) == 2:
            text = text.replace(parts[0], parts[1])
    return text


def bind_placeholders(text: str, country_key: str | None = None, feature_flag=None) -> str:
    if country_key is not None:
        text = text.replace(K.COUNTRYKEY_PLACEHOLDER, country_key)
    if feature_flag is not None:
        text = text.replace(K.FEATUREFLAG_PLACEHOLDER, str(feature_flag))
    return text


def param_sql(spark: SparkSession, template: str, config: dict | None = None, args: dict | None = None,
              replacements: str = "", environment: str | None = None, country_key: str | None = None,
              feature_flag=None) -> DataFrame:
    """Prepare a templated job and run it as one Spark SQL plan."""
    text = bind_config(template, config or {})
    text = apply_replacements(text, replacements, environment)
    text = bind_placeholders(text, country_key, feature_flag)
    return spark.sql(text, args=args or {})


def run_step(spark: SparkSession, step: str | Callable[..., DataFrame], source: DataFrame | None = None,
             params: dict | None = None, **sql) -> DataFrame:
    """A user step of a run (L3): a callable over ``source`` (called with ``params``), or a SQL template for ``param_sql``."""
    if callable(step):
        return source.transform(step, **(params or {}))
    return param_sql(spark, step, **sql)
