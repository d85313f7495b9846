"""Access to the shared test tables and run-wide parameters of the registered queries."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

# Fixed run parameters shared by the registered queries and their SQL oracles.
RUN_DATE = "2024-01-15"
PRIOR_DATE = "2024-01-14"
RUN_REGION = "ASIA"
ORCHESTRATOR = "orch-001"
SOURCE = "payroll"
FIXED_NOW = _dt.datetime(2024, 1, 15, 12, 0, 0)


class Tables:
    """Lazy parquet readers for one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        raise AttributeError(name)
