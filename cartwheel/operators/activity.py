"""Daily activity facts (B7, B8) and dimensions.

The reference builds each daily fact as a distinct key spine plus two left
joins. Here both measure sources are projected onto one row shape and
``unionByName`` + ``groupBy`` combines them: one shuffle, partial
aggregation on the map side, no join. Keys that the reference's equi-joins
could never match (NULL user or NULL date) keep their row with zero
measures, exactly as the spine produces them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.fixed_values import CART, PURCHASE, VIEW
from cartwheel.functions.columns import cents_to_amount, week_start

def _zero() -> F.Column:
    return F.lit(0).cast("bigint")


def _flag(cond) -> F.Column:
    return F.when(cond, 1).otherwise(0).cast("bigint")


#: Rows of sessions, events and payments that a daily row is made of; a day goes when its last one does.
SOURCE_ROWS = "source_rows"
USER_DAY, PRODUCT_DAY = ["user_id", "activity_date"], ["product_id", "activity_date"]
USER_MEASURES = ["sessions_count", "events_count", "payments_count", "revenue_cents", "refunded_cents"]
PRODUCT_MEASURES = ["events_count", "views_count", "add_to_cart_count", "purchase_events_count",
                    "payments_count", "revenue_cents", "refunded_cents"]


def _combine(rows: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    matchable = F.lit(True)
    for k in keys:
        matchable = matchable & F.col(k).isNotNull()
    agg = rows.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures], F.sum(SOURCE_ROWS).alias(SOURCE_ROWS))
    return agg.where(F.col(SOURCE_ROWS) > 0).select(*keys, *[
        F.when(matchable, F.coalesce(F.col(m), _zero())).otherwise(_zero()).alias(m)
        for m in measures], SOURCE_ROWS)


def signed_change(stored: DataFrame, added: DataFrame, removed: DataFrame | None, keys: list[str], measures: list[str]) -> DataFrame:
    """Rows whose sums are the stored daily rows with the new versions' measures added and the old versions' taken away.

    All three are measure rows (or daily rows) of the touched keys; nothing else of their history is read.
    """
    columns = [*keys, *measures, SOURCE_ROWS]
    rows = stored.select(*columns).unionByName(added.select(*columns))
    if removed is None:
        return rows
    return rows.unionByName(removed.select(*keys, *[(-F.col(m)).alias(m) for m in [*measures, SOURCE_ROWS]]))


def user_day_measures(sessions: DataFrame, payments: DataFrame) -> DataFrame:
    """A row with its measures for every session and payment that has a day."""
    s = sessions.where(F.col("session_date").isNotNull()).select(
        "user_id", F.col("session_date").alias("activity_date"),
        F.lit(1).cast("bigint").alias("sessions_count"),
        F.col("events_count").cast("bigint").alias("events_count"),
        _zero().alias("payments_count"), _zero().alias("revenue_cents"), _zero().alias("refunded_cents"))
    day = F.to_date("payment_intent_event_ts")
    p = payments.where(day.isNotNull()).select(
        "user_id", day.alias("activity_date"), _zero().alias("sessions_count"),
        _zero().alias("events_count"),
        _flag(F.col("is_succeeded")).alias("payments_count"),
        F.when(F.col("is_succeeded"), F.col("amount_cents")).otherwise(_zero()).alias("revenue_cents"),
        F.when(F.col("is_refunded"), F.col("refunded_cents")).otherwise(_zero()).alias("refunded_cents"))
    return s.unionByName(p).withColumn(SOURCE_ROWS, F.lit(1).cast("bigint"))


def user_days(rows: DataFrame, with_source_rows: bool = False) -> DataFrame:
    """One row per (user, day) from measure rows."""
    daily = _combine(rows, USER_DAY, USER_MEASURES)
    return daily.select(
        "user_id", "activity_date", week_start("activity_date").alias("week"),
        "sessions_count", "events_count", "payments_count",
        cents_to_amount("revenue_cents").alias("revenue_amount"),
        cents_to_amount("refunded_cents").alias("refunded_amount"),
        (F.col("sessions_count") > 0).alias("is_active"),
        (F.col("payments_count") > 0).alias("is_payer_day"),
        F.current_timestamp().alias("updated_at"),
        "revenue_cents", "refunded_cents", *[SOURCE_ROWS] * with_source_rows)


def fct_user_daily_activity(sessions: DataFrame, payments: DataFrame) -> DataFrame:
    """One row per (user, day) with sessions, events, payments and money."""
    return user_days(user_day_measures(sessions, payments))


def product_day_measures(events: DataFrame, mapping: DataFrame, payments: DataFrame) -> DataFrame:
    """A row with its measures for every event of a product and every payment attributed to one.

    The mapping carries the matched click's product and time, so the event fact is read once.
    """
    ev = events.where(F.col("product_id").isNotNull())
    t = F.col("event_type")
    e_rows = ev.select(
        "product_id", F.to_date("event_time").alias("activity_date"),
        F.lit(1).cast("bigint").alias("events_count"),
        _flag(t == VIEW).alias("views_count"), _flag(t == CART).alias("add_to_cart_count"),
        _flag(t == PURCHASE).alias("purchase_events_count"),
        _zero().alias("payments_count"), _zero().alias("revenue_cents"), _zero().alias("refunded_cents"))
    paid = (mapping.where(F.col("product_id").isNotNull())
            .select("payment_intent_id", "product_id", F.col("clickstream_time").alias("event_time"))
            .join(payments.select("payment_intent_id", "is_succeeded", "is_refunded",
                                  "amount_cents", "refunded_cents"), "payment_intent_id"))
    p_rows = paid.select(
        "product_id", F.to_date("event_time").alias("activity_date"),
        _zero().alias("events_count"), _zero().alias("views_count"), _zero().alias("add_to_cart_count"),
        _zero().alias("purchase_events_count"),
        _flag(F.col("is_succeeded")).alias("payments_count"),
        F.when(F.col("is_succeeded"), F.col("amount_cents")).otherwise(_zero()).alias("revenue_cents"),
        F.when(F.col("is_refunded"), F.col("refunded_cents")).otherwise(_zero()).alias("refunded_cents"))
    return e_rows.unionByName(p_rows).withColumn(SOURCE_ROWS, F.lit(1).cast("bigint"))


def product_days(rows: DataFrame, with_source_rows: bool = False) -> DataFrame:
    """One row per (product, day) from measure rows."""
    daily = _combine(rows, PRODUCT_DAY, PRODUCT_MEASURES)
    return daily.select(
        "product_id", "activity_date", "events_count", "views_count", "add_to_cart_count",
        "purchase_events_count", "payments_count",
        cents_to_amount("revenue_cents").alias("revenue_amount"),
        cents_to_amount("refunded_cents").alias("refunded_amount"),
        (F.col("views_count") > 0).alias("had_view"),
        (F.col("payments_count") > 0).alias("had_payment"),
        F.current_timestamp().alias("updated_at"),
        "revenue_cents", "refunded_cents", *[SOURCE_ROWS] * with_source_rows)


def fct_product_daily_activity(events: DataFrame, mapping: DataFrame,
                               payments: DataFrame) -> DataFrame:
    """One row per (product, day): funnel event counts and attributed payments."""
    return product_days(product_day_measures(events, mapping, payments))


def dim_users(sessions: DataFrame, payments: DataFrame) -> DataFrame:
    """User dimension: session bounds, purchase bounds (any intent), lifetime
    revenue (succeeded intents only)."""
    base = sessions.groupBy("user_id").agg(
        F.min("session_start_at").alias("first_session_at"),
        F.max("session_start_at").alias("last_session_at"))
    pay = payments.groupBy("user_id").agg(
        F.min("payment_intent_event_ts").alias("first_purchase_at"),
        F.max("payment_intent_event_ts").alias("last_purchase_at"),
        F.sum(F.when(F.col("is_succeeded"), F.col("amount_cents"))).alias("_rev"))
    j = base.join(pay, "user_id", "left")
    rev = F.coalesce(F.col("_rev"), _zero())
    payer = F.col("first_purchase_at").isNotNull()
    return j.select(
        "user_id", "first_session_at", F.to_date("first_session_at").alias("first_seen_date"),
        "last_session_at", "first_purchase_at", "last_purchase_at",
        cents_to_amount(rev).alias("lifetime_revenue"),
        payer.alias("is_payer"), payer.alias("user_type"),
        F.current_timestamp().alias("updated_at"),
        rev.alias("lifetime_revenue_cents"))


def dim_products(events: DataFrame) -> DataFrame:
    """Product dimension (SCD type 1): latest attributes plus lifecycle bounds.

    Latest = greatest (event_time, received_ts, event_pk); ``max_by`` keeps it
    inside the same map-side-combined aggregation as the bounds.
    """
    src = events.where(F.col("product_id").isNotNull())
    agg = src.groupBy("product_id").agg(
        F.max_by(F.struct("brand", "category_id", "category_code", "price"),
                 F.struct("event_time", "received_ts", "event_pk")).alias("_last"),
        F.min("event_time").alias("first_seen_at"),
        F.max("event_time").alias("last_seen_at"),
        F.count(F.lit(1)).alias("events_count"),
        F.max("received_ts").alias("last_received_ts"))
    return agg.select(
        "product_id", F.col("_last.brand").alias("brand"),
        F.col("_last.category_id").alias("category_id"),
        F.col("_last.category_code").alias("category_code"),
        F.col("_last.price").alias("price"),
        "first_seen_at", "last_seen_at", "events_count", "last_received_ts")
