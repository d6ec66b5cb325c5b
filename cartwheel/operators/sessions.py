"""Sessions: per-session rollup of events (B4) and the session fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.fixed_values import CART, PURCHASE, VIEW
from cartwheel.functions.columns import cents_to_amount, second_boundaries


def _any(cond) -> F.Column:
    return F.max(F.when(cond, 1).otherwise(0)) == 1


def sessions_base(events: DataFrame) -> DataFrame:
    """One row per ``user_session``: bounds, duration, counts and funnel flags.

    ``user_id`` is the numeric maximum (ids are unified to BIGINT at staging).
    All aggregates combine map-side; the distinct-type count is planned as a
    two-level aggregate, so a very large session does not land whole in one
    task.
    """
    t = F.col("event_type")
    agg = (events.where(F.col("user_session").isNotNull())
           .groupBy(F.col("user_session").alias("session_id"))
           .agg(F.max("user_id").alias("user_id"),
                F.min("event_time").alias("session_start_at"),
                F.max("event_time").alias("session_end_at"),
                F.max("received_ts").alias("last_received_ts"),
                F.count(F.lit(1)).alias("events_count"),
                F.countDistinct(t).alias("distinct_event_types_count"),
                _any(t == VIEW).alias("has_product_view"),
                _any(t == CART).alias("has_add_to_cart"),
                _any(t == PURCHASE).alias("has_purchase_event")))
    return agg.select(
        "session_id", "user_id", "session_start_at", "session_end_at",
        second_boundaries("session_start_at", "session_end_at").alias("session_duration_seconds"),
        F.to_date("session_start_at").alias("session_date"),
        "events_count", "distinct_event_types_count",
        (F.col("events_count") == 1).alias("is_bounce"),
        "has_product_view", "has_add_to_cart", "has_purchase_event", "last_received_ts")


def fct_sessions(base: DataFrame, payment_sessions: DataFrame, payments: DataFrame) -> DataFrame:
    """Sessions with their succeeded payments, revenue and refunds.

    ``payment_sessions`` (the payment->session map) holds one row per payment,
    so counting rows per session equals counting distinct payments.
    """
    paid = (payment_sessions.where(F.col("session_id").isNotNull())
            .select("payment_intent_id", "session_id")
            .join(payments.where(F.col("is_succeeded"))
                  .select("payment_intent_id", "amount_cents", "refunded_cents"),
                  "payment_intent_id")
            .groupBy("session_id")
            .agg(F.count(F.lit(1)).alias("_n"),
                 F.sum("amount_cents").alias("_rev"),
                 F.sum("refunded_cents").alias("_ref")))
    j = base.join(paid, "session_id", "left")
    n = F.coalesce(F.col("_n"), F.lit(0).cast("bigint"))
    rev = F.coalesce(F.col("_rev"), F.lit(0).cast("bigint"))
    ref = F.coalesce(F.col("_ref"), F.lit(0).cast("bigint"))
    return j.select(
        "session_id", "user_id", "session_start_at", "session_end_at",
        "session_duration_seconds", "session_date", "events_count",
        "distinct_event_types_count", "is_bounce", "has_product_view", "has_add_to_cart",
        "has_purchase_event",
        n.alias("payments_count"), (n > 0).alias("has_purchase"),
        cents_to_amount(rev).alias("session_revenue"),
        cents_to_amount(ref).alias("session_refunded_amount"),
        rev.alias("session_revenue_cents"), ref.alias("session_refunded_cents"))
