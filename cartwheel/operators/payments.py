"""Payment-provider jobs: cleaned feed (C3), intents (C5), charges (C6),
refunds (C7), rejects (C8, C9) and the payment fact (B5).

Amounts are parsed to LONG cents (``*_cents``); the DOUBLE major-unit
columns of the reference are derived from them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.fixed_values import (
    CHARGE_TYPE_PREFIX, ID_QUALITY, INTENT_TYPE_PREFIX, REFUND_TYPE_PREFIX, REJECTION_REASON,
    SUCCEEDED,
)
from cartwheel.functions.columns import blank_to_null, cents_to_amount, completeness
from cartwheel.functions.dedup import keep_first


def parse_cents(text: str | Column) -> Column:
    """Integer-text amount -> LONG; a fractional text is rounded half away from 0."""
    c = F.col(text) if isinstance(text, str) else text
    return F.coalesce(c.try_cast("bigint"),
                      F.round(c.try_cast("decimal(38,6)")).try_cast("bigint"))


def _of_type(df: DataFrame, prefix: str) -> DataFrame:
    return df.where(F.lower("event_type").startswith(prefix))


def clean_payment_events(staged: DataFrame) -> DataFrame:
    """One row per logical provider event (``event_pk``), best-identified copy."""
    typed = staged.select(
        F.coalesce(blank_to_null("provider_event_id"), blank_to_null("envelope_event_id"),
                   F.col("payload_hash")).alias("event_pk"),
        F.coalesce("event_time", "provider_created_ts").alias("event_time"),
        F.coalesce("ingested_at", "envelope_timestamp").alias("received_ts"),
        F.lower(F.trim("event_type")).alias("event_type"),
        "user_id",
        blank_to_null("user_session").alias("user_session"),
        blank_to_null("provider_event_id").alias("provider_event_id"),
        blank_to_null("envelope_event_id").alias("envelope_event_id"),
        blank_to_null("api_version").alias("api_version"),
        blank_to_null("source_system").alias("source_system"),
        blank_to_null("schema_version").alias("schema_version"),
        blank_to_null("batch_id").alias("batch_id"),
        "dt", "filename", "ingested_at", "payload_hash", "raw_payload_json", "object",
    ).where(F.col("event_pk").isNotNull())
    provider_tier, envelope_tier, hash_tier = ID_QUALITY
    id_quality = (F.when(F.col("provider_event_id").isNotNull(), provider_tier)
                   .when(F.col("envelope_event_id").isNotNull(), envelope_tier)
                   .otherwise(hash_tier))
    best = keep_first(typed, ["event_pk"], [
        id_quality.desc(),
        F.col("event_time").isNotNull().desc(),
        F.col("event_type").isNotNull().desc(),
        F.col("received_ts").desc_nulls_last(),
        F.col("schema_version").desc_nulls_last(),
        F.col("batch_id").desc_nulls_last(),
        F.col("payload_hash").desc_nulls_last(),
    ])
    return best.select(
        "event_pk", "event_time", F.to_date("event_time").alias("event_date"), "received_ts",
        "event_type", "user_id", "user_session", "provider_event_id", "envelope_event_id",
        "api_version", "source_system", "schema_version", "batch_id", "dt", "filename",
        "ingested_at", "payload_hash", "raw_payload_json", "object")


def payment_intents(clean: DataFrame) -> DataFrame:
    """Latest most-complete state per payment intent (reads the cleaned feed)."""
    o = "object"
    parsed = _of_type(clean, INTENT_TYPE_PREFIX).where(F.col(f"{o}.id").isNotNull()).select(
        blank_to_null(f"{o}.id").alias("payment_intent_id"),
        "event_time", "received_ts",
        blank_to_null(f"{o}.status").alias("status"),
        parse_cents(f"{o}.amount").alias("amount_gross_cents"),
        blank_to_null(f"{o}.currency").alias("currency"),
        blank_to_null(f"{o}.latest_charge").alias("latest_charge_id"),
        blank_to_null(f"{o}.metadata.order_id").alias("order_id"),
        F.col(f"{o}.metadata.attempt_number").try_cast("int").alias("attempt_number"),
        blank_to_null(f"{o}.metadata.payment_method").alias("payment_method"),
        F.nullif(F.lower(F.trim("event_type")), F.lit("")).alias("event_type"),
        blank_to_null("provider_event_id").alias("provider_event_id"),
        "user_id", "user_session",
        F.get_json_object("raw_payload_json", "$.data.object").alias("payment_intent_json"),
    ).where(F.col("payment_intent_id").isNotNull())
    score = completeness(["event_time", "status", "amount_gross_cents", "currency"])
    best = keep_first(parsed, ["payment_intent_id"], [
        score.desc(), F.col("received_ts").desc_nulls_last(),
        F.col("provider_event_id").desc_nulls_last()])
    return best.select(
        "payment_intent_id", "event_time", "received_ts", "status",
        cents_to_amount("amount_gross_cents").alias("amount_gross"), "currency",
        "latest_charge_id", "order_id", "attempt_number", "payment_method", "event_type",
        "provider_event_id", "user_id", "user_session", "payment_intent_json",
        "amount_gross_cents")


def charges(staged: DataFrame) -> DataFrame:
    """Latest most-complete state per charge (reads the staged feed)."""
    o = "object"
    parsed = _of_type(staged, CHARGE_TYPE_PREFIX).where(F.col(f"{o}.id").isNotNull()).select(
        blank_to_null(f"{o}.id").alias("charge_id"),
        F.coalesce("event_time", "provider_created_ts").alias("event_time"),
        F.col("ingested_at").alias("received_ts"),
        blank_to_null(f"{o}.status").alias("status"),
        parse_cents(f"{o}.amount").alias("amount_gross_cents"),
        blank_to_null(f"{o}.currency").alias("currency"),
        blank_to_null(f"{o}.payment_intent").alias("payment_intent_id"),
        parse_cents(f"{o}.balance_transaction.fee").alias("fee_cents"),
        parse_cents(f"{o}.balance_transaction.net").alias("amount_net_cents"),
        F.nullif(F.lower(F.trim("event_type")), F.lit("")).alias("event_type"),
        blank_to_null("provider_event_id").alias("provider_event_id"),
        F.get_json_object("raw_payload_json", "$.data.object").alias("charge_json"),
    ).where(F.col("charge_id").isNotNull())
    score = completeness(["event_time", "status", "amount_gross_cents", "currency",
                          "fee_cents", "amount_net_cents"])
    best = keep_first(parsed, ["charge_id"], [
        score.desc(), F.col("received_ts").desc_nulls_last(),
        F.col("provider_event_id").desc_nulls_last()])
    return best.select(
        "charge_id", "event_time", "received_ts", "status",
        cents_to_amount("amount_gross_cents").alias("amount_gross"), "currency",
        cents_to_amount("fee_cents").alias("fee"),
        cents_to_amount("amount_net_cents").alias("amount_net"),
        "payment_intent_id", "event_type", "provider_event_id", "charge_json",
        "amount_gross_cents")


def refunds(staged: DataFrame) -> DataFrame:
    """Earliest received state per refund id (no completeness score).

    As in the reference, ids that are blank after trimming are not removed:
    they share the NULL ``refund_id`` group.
    """
    o = "object"
    parsed = _of_type(staged, REFUND_TYPE_PREFIX).where(F.col(f"{o}.id").isNotNull()).select(
        blank_to_null(f"{o}.id").alias("refund_id"),
        F.coalesce("event_time", "provider_created_ts").alias("event_time"),
        F.col("ingested_at").alias("received_ts"),
        blank_to_null(f"{o}.status").alias("status"),
        parse_cents(f"{o}.amount").alias("amount_refunded_cents"),
        blank_to_null(f"{o}.currency").alias("currency"),
        blank_to_null(f"{o}.reason").alias("reason"),
        blank_to_null(f"{o}.charge").alias("charge_id"),
        blank_to_null(f"{o}.metadata.order_id").alias("order_id"),
        F.nullif(F.lower(F.trim("event_type")), F.lit("")).alias("event_type"),
        blank_to_null("provider_event_id").alias("provider_event_id"),
        F.get_json_object("raw_payload_json", "$.data.object").alias("refund_json"),
    )
    first = keep_first(parsed, ["refund_id"], [
        F.col("received_ts").asc_nulls_last(), F.col("event_time").asc_nulls_last(),
        F.col("provider_event_id").asc_nulls_last()])
    return first.select(
        "refund_id", "event_time", "received_ts", "status",
        cents_to_amount("amount_refunded_cents").alias("amount_refunded"), "currency",
        "reason", "charge_id", "order_id", "event_type", "provider_event_id", "refund_json",
        "amount_refunded_cents")


def rejected(events: DataFrame, type_prefix: str, id_name: str,
             time_cols: tuple[str, ...], received_col: str, time_name: str = "event_time") -> DataFrame:
    """Audit rows: events of a type whose ``data.object.id`` is missing."""
    return (_of_type(events, type_prefix).where(F.col("object.id").isNull()).select(
        "provider_event_id",
        F.lower(F.trim("event_type")).alias("event_type"),
        F.coalesce(*time_cols).alias(time_name),
        F.col(received_col).alias("received_ts"),
        F.col("object.id").alias(id_name),
        F.lit(REJECTION_REASON.format(id_name=id_name)).alias("rejection_reason"),
        "raw_payload_json"))


def charges_invalid(staged: DataFrame) -> DataFrame:
    return rejected(staged, CHARGE_TYPE_PREFIX, "charge_id", ("event_time", "provider_created_ts"),
                    "ingested_at", time_name="event_ts")


def payment_intents_invalid(clean: DataFrame) -> DataFrame:
    return rejected(clean, INTENT_TYPE_PREFIX, "payment_intent_id", ("event_time",),
                    "received_ts")


def fct_payments(intents: DataFrame, charges_df: DataFrame, refunds_df: DataFrame) -> DataFrame:
    """One row per payment intent with its best charge and its refunds.

    Best charge = succeeded first, then latest event time, then latest receipt
    (charge id breaks remaining ties); ``succeeded_at`` is the earliest
    succeeded charge. Both come from one aggregation per intent, which Spark
    combines map-side before the shuffle.
    """
    c = charges_df.where(F.col("payment_intent_id").isNotNull())
    is_ok = F.lower("status") == SUCCEEDED
    best = c.groupBy("payment_intent_id").agg(
        F.max_by(
            F.struct(F.col("charge_id"), F.col("amount_gross_cents"), F.col("currency")),
            F.struct(F.coalesce(is_ok, F.lit(False)), F.col("event_time"), F.col("received_ts"),
                     F.col("charge_id")),
        ).alias("_best"),
        F.min(F.when(is_ok, F.col("event_time"))).alias("succeeded_at"),
    )
    refund_ok = (F.lower(F.col("status")) == SUCCEEDED) | F.col("status").isNull()
    refund_cents = F.when(refund_ok, F.col("amount_refunded_cents")).otherwise(F.lit(0))
    r = refunds_df.select("charge_id", refund_cents.alias("_cents"))
    # refunds without a charge id can never match: they skip the join (a NULL
    # key would otherwise send all of them to one task) and land in the NULL
    # intent bucket, as a left join would put them
    linked = (r.where(F.col("charge_id").isNotNull())
              .join(charges_df.select("charge_id", "payment_intent_id"), "charge_id", "left"))
    orphan = r.where(F.col("charge_id").isNull()).select(
        F.lit(None).cast("string").alias("payment_intent_id"), "_cents")
    by_intent = (linked.select("payment_intent_id", "_cents").unionByName(orphan)
                 .groupBy("payment_intent_id").agg(F.sum("_cents").alias("_refunded_cents")))
    pi = intents.select(
        "payment_intent_id", "event_time", "received_ts", "status", "amount_gross_cents",
        "currency", "order_id", "attempt_number", "payment_method", "user_id", "user_session")
    j = (pi.join(best, "payment_intent_id", "left")
           .join(by_intent, "payment_intent_id", "left"))
    amount_cents = F.coalesce(F.col("amount_gross_cents"), F.col("_best.amount_gross_cents"))
    refunded_cents = F.coalesce(F.col("_refunded_cents"), F.lit(0).cast("bigint"))
    succeeded = F.col("succeeded_at").isNotNull() | (F.lower("status") == SUCCEEDED)
    return j.select(
        "payment_intent_id",
        F.col("event_time").alias("payment_intent_event_ts"),
        "succeeded_at",
        F.coalesce(succeeded, F.lit(False)).alias("is_succeeded"),
        "status",
        cents_to_amount(amount_cents).alias("amount"),
        F.coalesce(F.col("currency"), F.col("_best.currency")).alias("currency"),
        F.col("_best.charge_id").alias("charge_id"),
        cents_to_amount(refunded_cents).alias("refunded_amount"),
        (refunded_cents > 0).alias("is_refunded"),
        "user_id", "user_session", "order_id", "attempt_number", "payment_method",
        F.col("received_ts").alias("last_received_ts"),
        amount_cents.alias("amount_cents"),
        refunded_cents.alias("refunded_cents"),
    )
