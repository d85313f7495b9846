"""Session helpers.

Library code never creates its own session: every operator takes DataFrames (and,
where a new frame must be built, the session of an input).  ``get_session`` is only a
convenience for tests, benches and scripts.
"""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int = 8) -> SparkSession:
    builder = (
        SparkSession.builder.master(master or "local[*]")
        .appName("ledgerline")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


# Settings for a large cluster (hundreds of executors, ~100 TB inputs).  Applied by the job
# launcher, not by library code; listed here so they travel with the code that relies on them.
CLUSTER_SETTINGS = {
    # AQE sizes shuffles at run time: start wide, coalesce to ~256 MB partitions, split skew.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    # Scan splits that fit executor memory comfortably.
    "spark.sql.files.maxPartitionBytes": "256m",
    # Static broadcast only for small sides; operators add explicit broadcasts behind proven bounds.
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    # Rewrite only the partitions a job touches when a sink uses partition overwrite.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


ROW_GROUP = 8 << 20  # bytes of a row group of stored intermediates


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    On a cluster the setting points at shared storage and is used as is; there, a missing
    setting is an error, as executors don't share their local folders.  Only a single-machine
    session (``local[...]``, as in tests) without it gets a scratch folder of its own.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = os.path.join("/tmp", "ledgerline-ckpt-" + uuid.uuid4().hex[:8])
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def cut_lineage(df):
    """Reliable checkpoint of ``df`` in the shared checkpoint folder (survives executor loss).

    Used where one intermediate feeds several consumers (a rendered body that is checked,
    counted and formatted; a run log that is summarised and listed), so it is computed once
    instead of once per consumer.  Never a local checkpoint.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def store(df, name: str):
    """Write ``df`` once as Parquet in the shared checkpoint folder and read it back.

    Several consumers then share one computation, a lost executor costs a re-read, and the planner knows the
    written size, so it broadcasts or shuffles by what is really there.  Scratch data is written with zstd, as it is bound by disk.
    """
    return keep(df, scratch_path(df.sparkSession, name))


def keep(df, path: str):
    """``store`` into a folder named by the caller.

    Row groups are small: a task reads one at least, and what follows can make many times its rows.
    """
    df.write.option("compression", "zstd").option("parquet.block.size", ROW_GROUP).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location for written intermediates."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/ledgerline/{name}-{uuid.uuid4().hex[:12]}"


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``scratch_path`` named, once nothing reads it any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
