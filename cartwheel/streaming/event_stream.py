"""The event fact kept up by a stream of deliveries.

``readStream`` over the landing table -> typed rows -> keyed state -> ``foreachBatch``
upsert. The state (RocksDB, with the stream's checkpoint) holds for every payload its
best delivery so far and the event keys it was delivered under; in update mode a
micro-batch emits the payloads that it changed. These are merged into the ledger by
payload, and the events of all their keys, old and new, are rebuilt from the ledger
and merged into the fact, in the dates that lose or gain rows (``RunState``). So a
payload that comes again under another event id takes its earlier event away, however
late.

Ledger, fact and the number of the micro-batch are committed together. A micro-batch
that is replayed after its commit is passed over; one that was cut off is done again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.functions.columns import blank_to_null
from cartwheel.operators import events, staging
from cartwheel.plans.run_state import PART, RunState
from cartwheel.plans.warehouse import TIME_ORDERED
from cartwheel.sources import schemas
from cartwheel.streaming.landing_stream import STATE_STORE

LEDGER, FACT = "stg_clickstream_events", "fct_events"


def _key() -> F.Column:
    return F.coalesce(blank_to_null("event_id"), F.col("payload_hash"))


def best_deliveries(landing: DataFrame) -> DataFrame:
    """Payload by payload the latest delivery (``staging.latest_delivery``) and all event keys, as a streaming aggregate."""
    typed = staging.typed_clicks(landing).drop(*staging.RAW)
    order = F.struct("ingested_at", "filename", "load_id")  # NULL is the least, so it comes last
    columns = [c for c in typed.columns if c != "payload_hash"]
    return typed.groupBy("payload_hash").agg(F.max_by(F.struct(*columns), order).alias("best"), F.collect_set(_key()).alias("event_keys"))


def apply_changes(store: RunState, changes: DataFrame, epoch: int, query: str) -> None:
    """Upsert a micro-batch of changed payloads: ledger first, then the events of all their keys."""
    mark = f"epoch of {query}"
    if epoch <= int(store.marks.get(mark, -1)):
        changes.write.format("noop").mode("overwrite").save()  # its state is still to be committed
        return
    store.begin()
    rows = store.scratch("changes", changes)
    staged = rows.select("payload_hash", "best.*")
    keys = store.scratch("touched", rows.select(F.explode("event_keys").alias("event_pk")).distinct())
    store.merge(LEDGER, staged, ["payload_hash"], F.col("event_ts"), keep_old=False)
    history = store.rows_of(LEDGER, keys, {"event_pk": _key()})
    store.merge(FACT, events.fct_events(history.drop(PART)), ["event_pk"], F.col("event_date"), touched=keys, keep_old=False, order=TIME_ORDERED[FACT])
    store.commit({mark: str(epoch)})


def event_stream(spark: SparkSession, landing_path: str, root: str, files_a_trigger: int | None = None):
    """Start the stream over a landing table (``availableNow``); ``root`` holds its tables and checkpoint."""
    spark.conf.set(*STATE_STORE)
    reader = spark.readStream.schema(schemas.LANDING)
    if files_a_trigger:
        reader = reader.option("maxFilesPerTrigger", str(files_a_trigger))
    store = RunState(spark, f"{root}/models")
    return (best_deliveries(reader.parquet(landing_path)).writeStream.outputMode("update")
            .foreachBatch(lambda changes, epoch: apply_changes(store, changes, epoch, "events"))
            .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start())


def run_event_stream(spark: SparkSession, landing_path: str, root: str, files_a_trigger: int | None = None) -> DataFrame:
    """Run the stream over what is new in the landing table; the event fact after it."""
    event_stream(spark, landing_path, root, files_a_trigger).awaitTermination()
    return RunState(spark, f"{root}/models").read(FACT).drop(PART)
