"""Structured Streaming landing of files (K1).

Message-triggered ingestion becomes a file-source stream: every new file under the landing
folder is read once (the stream's checkpoint remembers which), stamped with
``rawingestiondttm``, and written to the landing table's partition of its own batch, named by the
stream's identity and the micro-batch number.  The identity is the id that Spark keeps in the checkpoint, wherever the folder
lies and however its path is written: a replay after a failure overwrites its partition, every other stream, also a new one
at a path that an earlier one had, adds to the same sink.  The dated
history snapshot then runs as a batch job over the landed data; ``replace_slice`` is never
run inside ``foreachBatch`` (a second micro-batch of the same date would erase the first).
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the stream that a checkpoint belongs to; Spark writes it before the stream's first batch."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def _batch_writer(sink: str, checkpoint: str, ingest_ts: str | None):
    def write(batch: DataFrame, batch_id: int) -> None:
        ts = F.lit(ingest_ts).cast("timestamp_ntz") if ingest_ts else F.localtimestamp()
        (batch.withColumn("rawingestiondttm", ts).write.mode("overwrite")
         .parquet(f"{sink.rstrip('/')}/_batch_id={stream_id(batch.sparkSession, checkpoint)}-{batch_id}"))
    return write


def stream_landing(spark: SparkSession, source_dir: str, schema: T.StructType, sink: str, checkpoint: str,
                   fmt: str = "parquet", glob: str | None = None, ingest_ts: str | None = None,
                   max_files_per_trigger: int | None = None) -> None:
    """Land every file now present under ``source_dir`` into ``sink`` and stop (``availableNow``)."""
    r = spark.readStream.format(fmt).schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    q = (r.load(source_dir).writeStream.foreachBatch(_batch_writer(sink, checkpoint, ingest_ts))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    q.stop()


def read_landed(spark: SparkSession, sink: str) -> DataFrame:
    # the batches' folders are listed by name: a leading underscore hides them from a plain read of the sink
    return spark.read.option("basePath", sink).parquet(f"{sink.rstrip('/')}/_batch_id=*")
