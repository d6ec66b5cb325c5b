"""Streaming landing with content-hash dedup.

``readStream`` over the raw JSONL feed folder -> fingerprint ->
``dropDuplicates`` on the payload hash -> ``foreachBatch`` into the landing
table. The dedup has no watermark: a payload lands however late it comes, and
only once. Its state lives in the RocksDB store with the stream's checkpoint, so
a micro-batch costs what the batch holds and never reads the table; it is the 32
bytes of a SHA-256 a payload ever landed, on disk and spread over the state
partitions, and is bounded by the table that it guards. Rows without a payload
have no hash and pass by the state, all of them, as in the batch landing.
Unreadable lines are deduplicated by their text's hash and go to a reject folder.
Each micro-batch overwrites folders of its own, named by the query and the epoch,
so a replayed batch replaces itself.
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.sources import schemas
from cartwheel.sources.landing import feed_lines, fingerprint

STATE_STORE = ("spark.sql.streaming.stateStore.providerClass",
               "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def write_epoch(batch: DataFrame, epoch_id: int, target_path: str, run: str, rejects_path: str | None = None) -> None:
    """foreachBatch body: the micro-batch is one load, in a folder of its own."""
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    load = f"stream-{run}-{epoch_id}"
    stamped = batch.withColumn("ingested_at", F.lit(now).cast("timestamp_ntz"))
    stamped.persist()  # read for both sinks; lost blocks are recomputed
    try:
        columns = [f.name for f in schemas.LANDING.fields if f.name != "load_id"]
        (stamped.where("line is null").select(*columns)
         .write.mode("overwrite").partitionBy("dt").parquet(f"{target_path}/load_id={load}"))
        if rejects_path:
            columns = [f.name for f in schemas.REJECTS.fields if f.name != "load_id"]
            (stamped.where("line is not null").withColumn("line_hash", F.col("payload_hash")).select(*columns)
             .write.mode("overwrite").parquet(f"{rejects_path}/load_id={load}"))
    finally:
        stamped.unpersist()


def read_stream_table(spark: SparkSession, target_path: str) -> DataFrame:
    """The landed rows; load id and date come from the folders."""
    return spark.read.schema(schemas.LANDING).parquet(target_path)


def read_stream_rejects(spark: SparkSession, rejects_path: str) -> DataFrame:
    """The unreadable lines that the stream has met."""
    return spark.read.schema(schemas.REJECTS).parquet(rejects_path)


def landing_stream(spark: SparkSession, source_dir: str, target_path: str, checkpoint: str,
                   id_source: str = "metadata", id_path: str = "$.event_id", rejects_path: str | None = None):
    """Start the stream (``availableNow``) and return the StreamingQuery."""
    spark.conf.set(*STATE_STORE)
    parsed = feed_lines(spark.readStream.text(source_dir))
    rows = parsed.select(
        F.get_json_object(F.col(id_source), id_path).alias("event_id"),
        F.col("metadata").alias("metadata_json"),
        F.col("keys").alias("keys_json"),
        F.col("raw_payload").alias("raw_payload_json"),
        "dt", "filename", "line",
        F.when(F.col("line").isNull(), fingerprint("raw_payload")).otherwise(F.sha2("line", 256)).alias("payload_hash"))
    # a line and a payload of the same text are different things
    key = F.unhex(F.sha2(F.concat(F.when(F.col("line").isNull(), "p").otherwise("l"), F.col("payload_hash")), 256))
    hashed = rows.where(F.col("payload_hash").isNotNull()).withColumn("_key", key).dropDuplicates(["_key"]).drop("_key")
    without = rows.where(F.col("payload_hash").isNull())
    run = os.path.basename(os.path.dirname(checkpoint.rstrip("/"))) or "run"
    return (hashed.unionByName(without).writeStream
            .foreachBatch(lambda df, epoch: write_epoch(df, epoch, target_path, run, rejects_path))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())


def run_landing_stream(spark: SparkSession, source_dir: str, root: str) -> DataFrame:
    """Run the stream to completion over what is new in ``source_dir``; read the table."""
    target = os.path.join(root, "table")
    q = landing_stream(spark, source_dir, target, os.path.join(root, "checkpoint"), rejects_path=os.path.join(root, "rejects"))
    q.awaitTermination()
    return read_stream_table(spark, target)
