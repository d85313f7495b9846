"""Numeric Column helpers: error percentage and threshold status."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K


def error_percentage(failures: Column, baseline: Column) -> Column:
    """0 when either count is 0, else failures / baseline * 100 rounded half-even to 2 places."""
    return (
        F.when((baseline == 0) | (failures == 0), F.lit(0.0))
        .otherwise(F.bround(failures.cast("double") / baseline.cast("double") * 100.0, 2))
    )


def threshold_status(pct: Column, threshold: Column) -> Column:
    """``> threshold`` Failure, ``0 < pct <= threshold`` Partial, 0 Success."""
    return (
        F.when(pct == 0, F.lit(K.STATUS_SUCCESS))
        .when(pct > threshold, F.lit(K.STATUS_FAILURE))
        .otherwise(F.lit(K.STATUS_PARTIAL))
    )


def threshold_value(text: Column) -> Column:
    """Threshold configuration text: '' (or null) -> 0, else parsed as a double."""
    return F.coalesce(F.nullif(F.trim(text), F.lit("")).try_cast("double"), F.lit(0.0))
