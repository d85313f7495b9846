"""Landed-file discovery and load manifests (A1, A2).

File->topic mappings are configuration; each compiles on the driver to one Column condition
over the listing.  All mappings are evaluated in a single pass over the listing
(``explode(array_compact(array(when(cond_m, m))))``), so a listing of millions of objects
is scanned once, with no join.  A manifest is kept as one row per (mapping, file) plus a
per-mapping summary; file lists are never gathered into a single row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import glob_to_regex


def mapping_condition(name: Column, pattern, pattern_filter: str, extension: str) -> Column:
    """Whether a listed object name belongs to one mapping.

    With a glob ``pattern_filter`` the name must match it, else it must start with the
    prefix (a list without a filter: any of the prefixes); the listing is top level only
    (nothing after the prefix may contain ``/``).  The name must end with ``extension``.
    A list ``pattern`` also requires one listed pattern to be contained in the name.
    """
    patterns = [pattern] if isinstance(pattern, str) else list(pattern)
    if pattern_filter:
        scope = F.regexp_like(name, F.lit(glob_to_regex(pattern_filter)))
    else:
        scope = F.lit(False)
        for p in patterns:
            rest = F.substring(name, len(p) + 1, 1 << 30)
            scope = scope | (name.startswith(p) & ~F.contains(rest, F.lit("/")))
    cond = scope & name.endswith(extension)
    if not isinstance(pattern, str):
        cond = cond & F.exists(F.array(*[F.lit(p) for p in patterns]), lambda x: F.contains(name, x))
    return cond


def discover_files(listing: DataFrame, mappings: list[dict], region: str, datasource: str,
                   name_col: str = "name") -> DataFrame:
    """``(mapping_id, topic, name)`` for every listed object of the (region, datasource) mappings.

    Mappings are compared case-sensitively on region and datasource.  A name matching a
    mapping through two listed patterns appears once (deduplicated per mapping).
    """
    chosen = [(i, m) for i, m in enumerate(mappings)
              if m.get("region") == region and m.get("datasource") == datasource]
    if not chosen:
        return listing.sparkSession.createDataFrame([], "mapping_id int, topic string, name string")
    name = F.col(name_col)
    hits = F.array(*[
        F.when(mapping_condition(name, m["pattern"], m.get("patternfilter") or "", m.get("extension") or ""),
               F.struct(F.lit(i).alias("mapping_id"), F.lit(m["topic"]).alias("topic")))
        for i, m in chosen])
    return (listing.select(F.explode(F.array_compact(hits)).alias("m"), name.alias("name"))
            .select("m.mapping_id", "m.topic", "name"))


def manifest_summary(matches: DataFrame) -> DataFrame:
    """Per mapping: file count and first / last name (only mappings with files appear)."""
    return matches.groupBy("mapping_id", "topic").agg(
        F.count(F.lit(1)).alias("n_files"), F.min("name").alias("first_name"), F.max("name").alias("last_name"))
