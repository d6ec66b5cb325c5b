"""Clickstream event fact (C4): normalised, one row per event key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.columns import blank_to_null, completeness
from cartwheel.functions.dedup import keep_first

EVENT_COLUMNS = [
    "event_pk", "event_time", "event_date", "received_ts", "event_type", "user_id",
    "user_id_raw", "user_session", "product_id", "category_id", "category_code", "brand", "price",
    "source_system", "schema_version", "batch_id", "dt", "filename", "load_id",
    "ingested_at", "payload_hash",
]


def fct_events(staged: DataFrame) -> DataFrame:
    """Trim/lower/null-normalise, score completeness, keep best then latest copy."""
    typed = staged.select(
        F.coalesce(blank_to_null("event_id"), F.col("payload_hash")).alias("event_pk"),
        F.col("event_ts").alias("event_time"),
        F.to_date("event_ts").alias("event_date"),
        F.col("ingested_at").alias("received_ts"),
        F.nullif(F.lower(F.trim("event_type")), F.lit("")).alias("event_type"),
        "user_id",
        "user_id_raw",
        blank_to_null("user_session").alias("user_session"),
        blank_to_null("product_id").alias("product_id"),
        blank_to_null("category_id").alias("category_id"),
        blank_to_null("category_code").alias("category_code"),
        "brand",
        F.col("price").try_cast("double").alias("price"),
        blank_to_null("source_system").alias("source_system"),
        blank_to_null("schema_version").alias("schema_version"),
        blank_to_null("batch_id").alias("batch_id"),
        "dt", "filename", "load_id", "ingested_at", "payload_hash",
    ).where(F.col("event_pk").isNotNull())
    score = completeness(["event_time", "user_id_raw", "event_type", "user_session"])
    best = keep_first(typed, ["event_pk"], [
        score.desc(), F.col("received_ts").desc_nulls_last(),
        F.col("payload_hash").desc_nulls_last()])
    return best.select(*EVENT_COLUMNS)
