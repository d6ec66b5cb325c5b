"""KPI tables (M1-M7)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.columns import cents_to_amount, safe_ratio, week_start

from cartwheel.fixed_values import (  # noqa: F401  (re-exported)
    LTV_MAX_AGE, REPEAT_HORIZONS, ROLLING_WINDOWS,
)


def _active_user_days(user_daily: DataFrame) -> DataFrame:
    # (user_id, activity_date) is unique in the daily fact; NULL users are
    # never active there (their measures are zero by construction)
    return user_daily.where(F.col("is_active") & F.col("user_id").isNotNull()).select(
        "user_id", "activity_date")


def rolling_active_users(user_daily: DataFrame,
                         windows: dict[str, int] | None = None) -> DataFrame:
    """Distinct active users over trailing windows, for every date.

    A user active on day ``a`` counts for dates ``a .. a+L-1``. Each active
    day contributes +1 at ``a`` and -1 at ``min(a+L, next active day)``, so a
    user is never counted twice; the running sum of these deltas over dates
    is the distinct count. The per-user step is a window partitioned by user
    (bounded by the number of days); the running sum runs over one row per
    calendar date, a table whose size is bounded by the calendar, not by the
    data volume. No per-date rescans, no 30x explode of user-days.
    """
    windows = windows or ROLLING_WINDOWS
    days = _active_user_days(user_daily)
    nxt = F.lead("activity_date").over(Window.partitionBy("user_id").orderBy("activity_date"))
    days = days.withColumn("_next", nxt)
    deltas = [days.select(F.col("activity_date").alias("d"),
                          *[F.lit(1).cast("bigint").alias(n) for n in windows])]
    for name, length in windows.items():
        stop = F.date_add("activity_date", length)
        end = F.when(F.col("_next").isNotNull() & (F.col("_next") < stop), F.col("_next")).otherwise(stop)
        deltas.append(days.select(end.alias("d"), *[
            (F.lit(-1) if n == name else F.lit(0)).cast("bigint").alias(n) for n in windows]))
    stacked = deltas[0]
    for d in deltas[1:]:
        stacked = stacked.unionByName(d)
    per_date = stacked.groupBy("d").agg(*[F.sum(n).alias(n) for n in windows])
    running = Window.orderBy("d").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per_date.select(F.col("d").alias("activity_date"),
                           *[F.sum(n).over(running).alias(n) for n in windows])


def dau_wau_mau(user_daily: DataFrame) -> DataFrame:
    """DAU, WAU (7 days), MAU (30 days) on dates with at least one active user."""
    daily = (_active_user_days(user_daily).groupBy("activity_date")
             .agg(F.count(F.lit(1)).alias("dau")))
    rolled = rolling_active_users(user_daily)
    j = daily.join(rolled, "activity_date", "left")
    return j.select(
        "activity_date", "dau", "wau", "mau",
        safe_ratio("wau", "dau").alias("wau_dau_ratio"),
        safe_ratio("mau", "dau").alias("mau_dau_ratio"))


def session_funnel_daily(sessions: DataFrame, distinct_paid: bool = False) -> DataFrame:
    """Daily session funnel: counts and step conversion rates.

    The reference left-joins sessions to the *non-distinct* list of paid
    sessions, so a session with k succeeded payments is counted k times in
    every column (``distinct_paid=False`` keeps that). Since the session fact
    already carries k (``payments_count``), the same numbers come from one
    aggregation over the fact, weighting each session by max(k, 1); no join.
    ``distinct_paid=True`` counts every session once.
    """
    k = F.col("payments_count")
    weight = F.lit(1).cast("bigint") if distinct_paid else F.greatest(k, F.lit(1).cast("bigint"))
    paid = F.when(k > 0, 1).otherwise(0).cast("bigint") if distinct_paid else k

    def wsum(flag: str) -> F.Column:
        return F.sum(F.when(F.col(flag), weight).otherwise(F.lit(0).cast("bigint")))

    agg = sessions.groupBy("session_date").agg(
        F.sum(weight).alias("sessions"),
        wsum("has_product_view").alias("sessions_with_view"),
        wsum("has_add_to_cart").alias("sessions_with_cart"),
        wsum("has_purchase_event").alias("sessions_with_purchase_event"),
        F.sum(paid).alias("sessions_with_payment"))
    return agg.select(
        "session_date", "sessions", "sessions_with_view", "sessions_with_cart",
        "sessions_with_purchase_event", "sessions_with_payment",
        safe_ratio("sessions_with_view", "sessions").alias("session_to_view_cr"),
        safe_ratio("sessions_with_cart", "sessions_with_view").alias("view_to_cart_cr"),
        safe_ratio("sessions_with_purchase_event", "sessions_with_cart").alias("cart_to_purchase_event_cr"),
        safe_ratio("sessions_with_payment", "sessions_with_purchase_event").alias("purchase_event_to_payment_cr"),
        safe_ratio("sessions_with_payment", "sessions_with_view").alias("view_to_payment_cr"),
        safe_ratio("sessions_with_payment", "sessions").alias("session_to_payment_cr"))


def product_conversion_daily(product_daily: DataFrame) -> DataFrame:
    """Per product-day conversion rates, average order value and refund rate."""
    zero = F.lit(0).cast("bigint")
    b = product_daily.select(
        "activity_date", "product_id",
        F.coalesce("views_count", zero).alias("views_count"),
        F.coalesce("add_to_cart_count", zero).alias("add_to_cart_count"),
        F.coalesce("payments_count", zero).alias("payments_count"),
        F.coalesce("revenue_amount", F.lit(0.0)).alias("revenue_amount"),
        F.coalesce("refunded_amount", F.lit(0.0)).alias("refunded_amount"))
    return b.select(
        "*",
        safe_ratio("add_to_cart_count", "views_count").alias("view_to_cart_cr"),
        safe_ratio("payments_count", "add_to_cart_count").alias("cart_to_payment_cr"),
        safe_ratio("payments_count", "views_count").alias("view_to_payment_cr"),
        safe_ratio("revenue_amount", "payments_count").alias("avg_order_value"),
        safe_ratio("refunded_amount", "revenue_amount").alias("refund_rate"))


def _cohorts(users: DataFrame) -> DataFrame:
    return users.select("user_id", F.col("first_seen_date").alias("cohort_date"))


def _cohort_sizes(cohorts: DataFrame, name: str) -> DataFrame:
    # user_id is the dimension key, so counting non-NULL ids counts distinct users
    return cohorts.groupBy("cohort_date").agg(F.count("user_id").alias(name))


def retention_cohorts(users: DataFrame, user_daily: DataFrame) -> DataFrame:
    """Observed (cohort day, age) cells: users active at that age / cohort size."""
    cohorts = _cohorts(users)
    active = _active_user_days(user_daily)
    joined = cohorts.join(active, "user_id").where(F.col("activity_date") >= F.col("cohort_date"))
    # (user, activity day) is unique, so for a fixed cohort and age each user
    # appears once: a plain count is the distinct count
    cells = (joined.groupBy("cohort_date", F.datediff("activity_date", "cohort_date")
                            .cast("bigint").alias("cohort_age_days"))
             .agg(F.count(F.lit(1)).alias("retained_users")))
    j = cells.join(_cohort_sizes(cohorts, "cohort_sizes"), "cohort_date")
    return j.select("cohort_date", "cohort_age_days", "retained_users", "cohort_sizes",
                    safe_ratio("retained_users", "cohort_sizes").alias("retention_rate"))


def first_two_purchases(payments: DataFrame) -> DataFrame:
    """Per user: first succeeded payment time and the next strictly later one.

    Equal times fold first (combined map-side), so ties can't pile up; then
    ``row_number() <= 2`` is planned with a partial group limit before the
    shuffle, and a user ships at most two times per map task.
    """
    succ = payments.where(F.col("is_succeeded")).select(
        "user_id", F.col("payment_intent_event_ts").alias("ts")).distinct()
    w = Window.partitionBy("user_id").orderBy(F.col("ts").asc_nulls_last())
    top = succ.withColumn("_dr", F.row_number().over(w)).where(F.col("_dr") <= 2)
    return top.groupBy("user_id").agg(
        F.min("ts").alias("first_purchase_ts"),
        F.min(F.when((F.col("_dr") == 2) & F.col("user_id").isNotNull(), F.col("ts")))
        .alias("second_purchase_ts"))


def repeat_retention_cohorts(payments: DataFrame,
                             horizons: Sequence[int] = REPEAT_HORIZONS) -> DataFrame:
    """Weekly first-purchase cohorts: share with a 2nd purchase within h days."""
    users = first_two_purchases(payments).select(
        "user_id", week_start("first_purchase_ts").alias("cohort_week"),
        F.datediff(F.to_date("second_purchase_ts"), F.to_date("first_purchase_ts")).alias("_days"))
    known = F.col("user_id").isNotNull()
    agg = users.groupBy("cohort_week").agg(
        F.count("user_id").alias("cohort_size"),
        *[F.count_if(known & (F.col("_days") <= h)).alias(f"_r{h}") for h in horizons])
    cells = F.explode(F.array(*[
        F.struct(F.lit(h).cast("bigint").alias("cohort_age_days"), F.col(f"_r{h}").alias("retained_users"))
        for h in horizons])).alias("_c")
    out = agg.select("cohort_week", "cohort_size", cells)
    return out.select(
        "cohort_week", "_c.cohort_age_days", "_c.retained_users", "cohort_size",
        safe_ratio("_c.retained_users", "cohort_size").alias("retention_rate"))


def ltv_cohort_curve(users: DataFrame, user_daily: DataFrame, max_age: int | None = LTV_MAX_AGE,
                     cohort_end: dt.date | str | None = None, fill: bool = False) -> DataFrame:
    """Cohort x age (0..max_age) net revenue, running total and per-capita LTV.

    ``max_age=None`` covers, for each cohort, every age that its users were seen at.

    ``fill=False`` reproduces the reference: the running total is partitioned
    by the *revenue* side's cohort, so ages without revenue fall into one
    NULL partition and show a running total of 0. ``fill=True`` carries the
    total forward over such gaps.
    """
    cohorts = _cohorts(users)
    sizes = _cohort_sizes(cohorts, "cohort_size")
    rev = (cohorts.join(user_daily.select("user_id", "activity_date", "revenue_cents",
                                          "refunded_cents"), "user_id")
           .where(F.col("activity_date") >= F.col("cohort_date"))
           .groupBy(F.col("cohort_date").alias("r_cohort_date"),
                    F.datediff("activity_date", "cohort_date").cast("bigint").alias("r_age"))
           .agg(F.sum(F.col("revenue_cents") - F.col("refunded_cents")).alias("r_cents")))
    last_age = F.lit(max_age).cast("bigint")
    if max_age is None:
        observed = rev.groupBy(F.col("r_cohort_date").alias("cohort_date")).agg(F.max("r_age").alias("_last"))
        sizes = sizes.join(observed, "cohort_date", "left")
        last_age = F.coalesce("_last", F.lit(0).cast("bigint"))
    cal = sizes.select("cohort_date", "cohort_size",
                       F.explode(F.sequence(F.lit(0).cast("bigint"), last_age)).alias("cohort_age_days"))
    if cohort_end is not None:
        cal = cal.where(F.col("cohort_date") < F.lit(str(cohort_end)).cast("date"))
    j = cal.join(rev, (cal["cohort_date"] == rev["r_cohort_date"]) &
                 (cal["cohort_age_days"] == rev["r_age"]), "left")
    cents = F.coalesce(F.col("r_cents"), F.lit(0).cast("bigint"))
    if fill:
        w = Window.partitionBy("cohort_date").orderBy("cohort_age_days")
    else:
        w = Window.partitionBy("r_cohort_date").orderBy("r_age")
    w = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    curve = j.select("cohort_date", "cohort_age_days", "cohort_size",
                     cents.alias("_c"), F.sum(cents).over(w).alias("_cum"))
    return curve.select(
        "cohort_date", "cohort_age_days", "cohort_size",
        cents_to_amount("_c").alias("revenue_amount"),
        cents_to_amount("_cum").alias("cumulative_revenue"),
        safe_ratio(cents_to_amount("_cum"), "cohort_size").alias("ltv"),
    ).orderBy("cohort_date", "cohort_age_days")


def unit_economics_daily(user_daily: DataFrame) -> DataFrame:
    """Daily ARPU, ARPPU and payer rate."""
    known = F.col("user_id").isNotNull()
    agg = user_daily.groupBy("activity_date").agg(
        F.count_if(known & F.col("is_active")).alias("active_users"),
        F.count_if(known & F.col("is_payer_day")).alias("paying_users"),
        F.sum("revenue_cents").alias("_rev"))
    rev = cents_to_amount("_rev")
    return agg.select(
        "activity_date", "active_users", "paying_users", rev.alias("revenue_amount"),
        safe_ratio(rev, "active_users").alias("arpu"),
        safe_ratio(rev, "paying_users").alias("arppu"),
        safe_ratio("paying_users", "active_users").alias("payer_rate"),
    ).orderBy("activity_date")
