"""README KPIs without reference SQL (K1-K13); definitions are ours and are
documented per function. Each is a thin aggregation over the facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.columns import cents_to_amount, safe_ratio, second_boundaries
from cartwheel.operators import metrics

RETENTION_SNAPSHOT_AGES = (1, 7, 30)
LTV_SNAPSHOT_AGES = (7, 30, 60)


def sessions_per_user_daily(user_daily: DataFrame) -> DataFrame:
    """K1: sessions per active user and day."""
    known = F.col("user_id").isNotNull()
    agg = user_daily.groupBy("activity_date").agg(
        F.sum("sessions_count").alias("sessions"),
        F.count_if(known & F.col("is_active")).alias("active_users"))
    return agg.select("activity_date", "sessions", "active_users",
                      safe_ratio("sessions", "active_users").alias("sessions_per_user"))


def bounce_rate_daily(sessions: DataFrame) -> DataFrame:
    """K2: share of single-event sessions per session day."""
    agg = sessions.groupBy("session_date").agg(
        F.count(F.lit(1)).alias("sessions"), F.count_if("is_bounce").alias("bounced_sessions"))
    return agg.select("session_date", "sessions", "bounced_sessions",
                      safe_ratio("bounced_sessions", "sessions").alias("bounce_rate"))


def payment_success_rate_daily(payments: DataFrame) -> DataFrame:
    """K3: succeeded intents / intents per intent day."""
    agg = (payments.groupBy(F.to_date("payment_intent_event_ts").alias("payment_date"))
           .agg(F.count(F.lit(1)).alias("intents"),
                F.count_if("is_succeeded").alias("succeeded_intents")))
    return agg.select("payment_date", "intents", "succeeded_intents",
                      safe_ratio("succeeded_intents", "intents").alias("success_rate"))


def time_to_purchase(payment_sessions: DataFrame, sessions: DataFrame,
                     payments: DataFrame) -> DataFrame:
    """K4: seconds from session start to a succeeded payment mapped to it,
    per payment day (count, mean, min, max)."""
    j = (payment_sessions.where(F.col("is_session_found"))
         .select("payment_intent_id", "session_id")
         .join(sessions.select("session_id", "session_start_at"), "session_id")
         .join(payments.where(F.col("is_succeeded"))
               .select("payment_intent_id", "payment_intent_event_ts"), "payment_intent_id"))
    secs = second_boundaries("session_start_at", "payment_intent_event_ts")
    agg = (j.select(F.to_date("payment_intent_event_ts").alias("payment_date"), secs.alias("s"))
           .groupBy("payment_date")
           .agg(F.count(F.lit(1)).alias("payments"), F.sum("s").alias("_sum"),
                F.min("s").alias("min_seconds_to_purchase"),
                F.max("s").alias("max_seconds_to_purchase")))
    return agg.select("payment_date", "payments",
                      safe_ratio("_sum", "payments").alias("avg_seconds_to_purchase"),
                      "min_seconds_to_purchase", "max_seconds_to_purchase")


def revenue_per_session_daily(sessions: DataFrame) -> DataFrame:
    """K5: gross session revenue and revenue per session, per session day."""
    agg = sessions.groupBy("session_date").agg(
        F.count(F.lit(1)).alias("sessions"), F.sum("session_revenue_cents").alias("_rev"))
    rev = cents_to_amount("_rev")
    return agg.select("session_date", "sessions", rev.alias("revenue"),
                      safe_ratio(rev, "sessions").alias("revenue_per_session"))


def revenue_by_brand(product_daily: DataFrame, products: DataFrame) -> DataFrame:
    """K6: attributed revenue, refunds and payments by the product's brand."""
    j = product_daily.join(products.select("product_id", "brand"), "product_id", "left")
    agg = j.groupBy("brand").agg(
        F.sum("payments_count").alias("payments_count"),
        F.sum("revenue_cents").alias("_rev"), F.sum("refunded_cents").alias("_ref"))
    return agg.select("brand", "payments_count", cents_to_amount("_rev").alias("revenue_amount"),
                      cents_to_amount("_ref").alias("refunded_amount"),
                      cents_to_amount(F.col("_rev") - F.col("_ref")).alias("net_revenue"))


def retention_snapshots(retention: DataFrame, ages=RETENTION_SNAPSHOT_AGES) -> DataFrame:
    """K7: D1 / D7 / D30 retention per cohort (NULL where not observed)."""
    return retention.groupBy("cohort_date").agg(
        F.max("cohort_sizes").alias("cohort_size"),
        *[F.max(F.when(F.col("cohort_age_days") == a, F.col("retention_rate"))).alias(f"d{a}_retention")
          for a in ages])


def retention_heatmap(retention: DataFrame) -> DataFrame:
    """K8: cohort x age matrix of retention rates in long form, one row per cell.

    A cohort's row of the matrix runs from age 0 to the last age that its users
    were seen at, whatever that is; a cell without activity has no rate.
    """
    spans = retention.groupBy("cohort_date").agg(F.max("cohort_age_days").alias("_last"))
    cells = spans.select("cohort_date", F.explode(F.sequence(F.lit(0).cast("bigint"), "_last")).alias("cohort_age_days"))
    return cells.join(retention.select("cohort_date", "cohort_age_days", "retention_rate"),
                      ["cohort_date", "cohort_age_days"], "left")


def revenue_retention_cohorts(users: DataFrame, user_daily: DataFrame) -> DataFrame:
    """K9: net revenue at each observed age relative to the cohort's day-0 revenue."""
    curve = metrics.ltv_cohort_curve(users, user_daily, max_age=None, fill=True)
    base = F.max(F.when(F.col("cohort_age_days") == 0, F.col("revenue_amount"))).over(
        Window.partitionBy("cohort_date"))
    return curve.select("cohort_date", "cohort_age_days", "cohort_size", "revenue_amount",
                        base.alias("day0_revenue")).select(
        "*", safe_ratio("revenue_amount", "day0_revenue").alias("revenue_retention"))


def ltv_snapshots(users: DataFrame, user_daily: DataFrame, ages=LTV_SNAPSHOT_AGES) -> DataFrame:
    """LTV at D7 / D30 / D60 per cohort (running total carried forward)."""
    curve = metrics.ltv_cohort_curve(users, user_daily, max_age=max(ages), fill=True)
    return curve.groupBy("cohort_date").agg(
        F.max("cohort_size").alias("cohort_size"),
        *[F.max(F.when(F.col("cohort_age_days") == a, F.col("ltv"))).alias(f"ltv_d{a}") for a in ages])


def new_vs_repeat_revenue(payments: DataFrame) -> DataFrame:
    """Per day, succeeded revenue from each buyer's first payment (new)
    versus later payments (repeat). First = earliest time, then intent id.

    The first payment per buyer comes from a ``min_by`` aggregation (combined
    map-side), so no per-buyer sort or join is needed.
    """
    known = payments.where(F.col("is_succeeded") & F.col("user_id").isNotNull()
                           & F.col("payment_intent_event_ts").isNotNull())
    day = F.to_date("payment_intent_event_ts")
    total = known.groupBy(day.alias("activity_date")).agg(
        F.count(F.lit(1)).alias("payments"), F.sum("amount_cents").alias("_all"))
    first = (known.groupBy("user_id")
             .agg(F.min_by(F.struct(day.alias("d"), F.col("amount_cents").alias("c")),
                           F.struct("payment_intent_event_ts", "payment_intent_id")).alias("f"))
             .groupBy(F.col("f.d").alias("activity_date"))
             .agg(F.count(F.lit(1)).alias("new_buyers"), F.sum("f.c").alias("_new")))
    j = total.join(first, "activity_date", "left")
    zero = F.lit(0).cast("bigint")
    new_c = F.coalesce("_new", zero)
    new_n = F.coalesce("new_buyers", zero)
    return j.select(
        "activity_date", "payments", cents_to_amount("_all").alias("revenue"),
        new_n.alias("new_buyers"), cents_to_amount(new_c).alias("new_revenue"),
        (F.col("payments") - new_n).alias("repeat_payments"),
        cents_to_amount(F.col("_all") - new_c).alias("repeat_revenue"),
        safe_ratio(F.col("_all") - new_c, "_all").alias("repeat_revenue_share"))


def brand_retention(payments: DataFrame, mapping: DataFrame) -> DataFrame:
    """Buyers grouped by the brand of the click their first succeeded
    payment is attributed to; share of them who bought again."""
    known = payments.where(F.col("is_succeeded") & F.col("user_id").isNotNull()
                           & F.col("payment_intent_event_ts").isNotNull())
    buyers = known.groupBy("user_id").agg(
        F.min_by("payment_intent_id", F.struct("payment_intent_event_ts", "payment_intent_id"))
        .alias("payment_intent_id"),
        F.count(F.lit(1)).alias("_n"))
    j = buyers.join(mapping.select("payment_intent_id", "brand"), "payment_intent_id")
    agg = j.groupBy("brand").agg(F.count(F.lit(1)).alias("first_buyers"),
                                 F.count_if(F.col("_n") >= 2).alias("repeat_buyers"))
    return agg.select("brand", "first_buyers", "repeat_buyers",
                      safe_ratio("repeat_buyers", "first_buyers").alias("repeat_share"))


def revenue_decomposition_daily(sessions: DataFrame) -> DataFrame:
    """revenue = sessions x conversion rate x revenue per paying session."""
    agg = sessions.groupBy("session_date").agg(
        F.count(F.lit(1)).alias("sessions"),
        F.count_if("has_purchase").alias("paying_sessions"),
        F.sum("payments_count").alias("payments"),
        F.sum("session_revenue_cents").alias("_rev"))
    rev = cents_to_amount("_rev")
    return agg.select(
        "session_date", "sessions", "paying_sessions", "payments", rev.alias("revenue"),
        safe_ratio("paying_sessions", "sessions").alias("conversion_rate"),
        safe_ratio(rev, "paying_sessions").alias("revenue_per_paying_session"),
        safe_ratio(rev, "payments").alias("average_order_value"))
