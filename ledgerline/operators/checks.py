"""Run checks: table columns, reconciliation, schema and dependency checks."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table_columns(df: DataFrame) -> list[str]:
    """Live top-level column list of a table (schema metadata, no scan)."""
    return list(df.columns)


def reconcile_tables(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows moved incorrectly between two tables: ``side`` = ``only_in_a`` / ``only_in_b``.

    Multiset difference both ways (``exceptAll``), so duplicated rows are compared by count.
    """
    return (a.exceptAll(b).withColumn("side", F.lit("only_in_a"))
            .unionByName(b.exceptAll(a).withColumn("side", F.lit("only_in_b"))))


def check_schema(spark: SparkSession, df: DataFrame, expected: T.StructType | str) -> DataFrame:
    """Differences between a table's schema and the expected one, one row per column problem.

    ``n_values`` says how many rows the difference touches: values that the column holds (null for a missing one), and
    ``n_lost`` of them that would not survive a cast to the expected type.
    """
    exp = T.StructType.fromJson(json.loads(expected)) if isinstance(expected, str) else expected
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    want = {f.name: f.dataType.simpleString() for f in exp.fields}
    rows = [(n, t, None, "missing") for n, t in want.items() if n not in actual]
    rows += [(n, t, actual[n], "type") for n, t in want.items() if n in actual and actual[n] != t]
    rows += [(n, None, t, "unexpected") for n, t in actual.items() if n not in want]
    held = [(n, t) for n, t, a, _ in rows if a is not None]
    found = spark.createDataFrame(rows, "column string, expected string, actual string, problem string")
    if not held:
        return found.withColumn("n_values", F.lit(None).cast("long")).withColumn("n_lost", F.lit(None).cast("long"))

    def lost(n, t):
        return F.count_if(F.col(f"`{n}`").isNotNull() & F.col(f"`{n}`").try_cast(t).isNull()) if t else F.lit(None).cast("long")
    counts = df.agg(F.array(*[F.struct(F.lit(n).alias("column"), F.count(F.col(f"`{n}`")).alias("n_values"), lost(n, t).alias("n_lost"))
                              for n, t in held]).alias("c"))
    return found.join(counts.select(F.explode("c").alias("c")).select("c.*"), "column", "left")


def check_dependencies(required: DataFrame, loaded: DataFrame, keys: list[str]) -> DataFrame:
    """Required inputs of the run that are not loaded (anti-join on ``keys``)."""
    return required.select(*keys).distinct().join(loaded.select(*keys).distinct(), keys, "left_anti")
