"""Staging (C1, C2): latest delivery per payload hash, then JSON -> columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.columns import epoch_to_ntz
from cartwheel.functions.dedup import keep_first
from cartwheel.sources import schemas

LINEAGE = ["dt", "filename", "load_id", "ingested_at", "payload_hash"]
RAW = ["metadata_json", "keys_json", "raw_payload_json"]


def latest_delivery(landing: DataFrame) -> DataFrame:
    """One landing row per payload hash: the latest load (then latest file)."""
    return keep_first(landing, ["payload_hash"], [
        F.col("ingested_at").desc_nulls_last(),
        F.col("filename").desc_nulls_last(),
        F.col("load_id").desc_nulls_last(),
    ])


def stage_clickstream(landing: DataFrame) -> DataFrame:
    """Typed clickstream events, one row per distinct payload.

    Parsed first: the rows that meet by payload carry the typed columns, and documents only if they are asked for.
    """
    return latest_delivery(typed_clicks(landing))


def typed_clicks(src: DataFrame) -> DataFrame:
    """Landing rows of the click feed with their JSON as typed columns."""
    meta = F.from_json("metadata_json", schemas.CLICK_METADATA)
    body = F.from_json("raw_payload_json", schemas.CLICK_PAYLOAD)
    return (src.withColumn("_m", meta).withColumn("_p", body).select(
        "event_id",
        F.col("_m.source_system").alias("source_system"),
        F.col("_m.schema_version").alias("schema_version"),
        F.col("_m.batch_id").alias("batch_id"),
        F.col("_m.ingested_at").try_cast("timestamp_ntz").alias("envelope_timestamp"),
        # the numeric key that joins use, and the id as delivered
        F.col("_p.user_id").try_cast("bigint").alias("user_id"),
        F.col("_p.user_id").alias("user_id_raw"),
        F.col("_p.user_session").alias("user_session"),
        F.col("_p.event_time").try_cast("timestamp_ntz").alias("event_ts"),
        F.col("_p.event_type").alias("event_type"),
        F.col("_p.product_id").alias("product_id"),
        F.col("_p.category_id").alias("category_id"),
        F.col("_p.category_code").alias("category_code"),
        F.col("_p.brand").alias("brand"),
        F.col("_p.price").alias("price"),
        *LINEAGE, *RAW,
    ))


def stage_payments(landing: DataFrame) -> DataFrame:
    """Typed payment-provider events, one row per distinct payload.

    Besides the reference columns the parsed ``data.object`` is kept as the
    struct column ``object`` so later jobs read fields without re-parsing.
    """
    src = latest_delivery(landing)
    return (src
            .withColumn("_m", F.from_json("metadata_json", schemas.PAYMENT_METADATA))
            .withColumn("_k", F.from_json("keys_json", schemas.PAYMENT_KEYS))
            .withColumn("_p", F.from_json("raw_payload_json", schemas.PAYMENT_PAYLOAD))
            .select(
                F.col("_m.event_id").alias("envelope_event_id"),
                F.col("_m.source_system").alias("source_system"),
                F.col("_m.schema_version").alias("schema_version"),
                F.col("_m.batch_id").alias("batch_id"),
                F.col("_m.ingestion_timestamp").try_cast("timestamp_ntz").alias("envelope_timestamp"),
                F.col("event_id").alias("provider_event_id"),
                F.col("_p.api_version").alias("api_version"),
                F.col("_k.event_time").try_cast("timestamp_ntz").alias("event_time"),
                F.col("_k.user_id").try_cast("bigint").alias("user_id"),
                F.col("_k.user_id").alias("user_id_raw"),
                F.col("_k.user_session").alias("user_session"),
                epoch_to_ntz(F.col("_p.created").try_cast("bigint")).alias("provider_created_ts"),
                F.col("_p.type").alias("event_type"),
                *LINEAGE, *RAW,
                F.col("_p.data.object").alias("object"),
            ))
