"""L1: user-supplied functions whose bodies the original system keeps in its warehouse.

They are parameters here, never guessed: a lookup becomes a broadcast join (alias / currency
tables), and a scalar function becomes a SQL temporary function, which Spark inlines into the
plan (JVM-side, inside whole-stage codegen) so rule expressions such as a country field
``valid_country_key(country_raw)`` can call it.
"""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

_NAME = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def register_sql_function(spark: SparkSession, name: str, params: str, returns: str, body: str) -> str:
    """``CREATE OR REPLACE TEMPORARY FUNCTION name(params) RETURNS returns RETURN body``."""
    if not _NAME.match(name):
        raise ValueError(f"invalid function name {name!r}")
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS {returns} RETURN {body}")
    return name
