"""DuckDB SQL of the data-quality checks, stated apart from the Spark rules.

Generic checks come from the catalogue's columns; every row predicate has its
own SQL here, keyed by model and label.
"""

from __future__ import annotations

from collections.abc import Mapping

from cartwheel.operators.quality import Check

# (model, label) -> rows that break the check
ROW_SQL = {
    "dim_products": {
        "events_count_positive": "events_count < 1", "last_seen_not_in_future": "last_seen_at > now()::TIMESTAMP",
        "price_non_negative": "sign(price) = -1", "lifecycle_bounds": "last_seen_at < first_seen_at"},
    "dim_users": {
        "lifetime_revenue_non_negative": "sign(lifetime_revenue) = -1",
        "non_payer_zero_revenue": "lifetime_revenue != 0 AND NOT is_payer",
        "payer_has_first_purchase": "is_payer AND coalesce(first_purchase_at, last_purchase_at) IS NULL",
        "session_bounds": "last_session_at < first_session_at"},
    "fct_events": {
        "event_time_not_in_future": "event_time > now()::TIMESTAMP",
        "event_type_allowed": "list_position(['view', 'cart', 'purchase'], event_type) IS NULL AND event_type IS NOT NULL",
        "price_non_negative": "sign(price) = -1"},
    "fct_payments": {
        "refund_within_amount": "amount - refunded_amount < 0", "refunded_has_amount": "is_refunded AND NOT refunded_amount > 0",
        "succeeded_has_amount": "is_succeeded AND NOT amount > 0", "succeeded_has_time": "succeeded_at IS NULL AND is_succeeded"},
    "fct_product_daily_activity": {
        "events_cover_funnel": "list_sum([views_count, add_to_cart_count, purchase_events_count]) > events_count",
        "payment_flag": "had_payment IS DISTINCT FROM (payments_count > 0)", "payments_non_negative": "sign(payments_count) = -1",
        "refund_within_revenue": "revenue_amount - refunded_amount < 0"},
    "fct_sessions": {
        "duration_non_negative": "sign(session_duration_seconds) = -1", "time_bounds": "session_end_at < session_start_at"},
    "fct_user_daily_activity": {
        "active_flag": "is_active IS DISTINCT FROM (sessions_count > 0)",
        "payer_day_flag": "is_payer_day IS DISTINCT FROM (payments_count > 0)", "payments_non_negative": "sign(payments_count) = -1",
        "refund_within_revenue": "revenue_amount - refunded_amount < 0", "revenue_non_negative": "sign(revenue_amount) = -1",
        "sessions_non_negative": "sign(sessions_count) = -1"},
    "dau_wau_mau": {
        "dau_non_negative": "sign(dau) = -1", "mau_at_least_wau": "wau > mau", "wau_at_least_dau": "dau > wau"},
    "ltv_cohort_curve": {
        "age_non_negative": "sign(cohort_age_days) = -1", "cohort_size_positive": "cohort_size < 1",
        "cumulative_non_negative": "sign(cumulative_revenue) = -1"},
    "product_conversion_daily": {
        "amounts_non_negative": "list_min([revenue_amount, refunded_amount]) < 0",
        "counts_non_negative": "list_min([views_count, add_to_cart_count, payments_count]) < 0",
        "refund_within_revenue": "revenue_amount - refunded_amount < 0",
        "no_payment_no_aov": "avg_order_value IS NOT NULL AND NOT payments_count <> 0"},
    "repeat_retention_cohorts": {
        "cohort_size_positive": "cohort_size < 1", "retained_within_cohort": "cohort_size < retained_users",
        "rate_in_unit_interval": "abs(retention_rate - 0.5) > 0.5"},
    "retention_cohorts": {
        "age_non_negative": "sign(cohort_age_days) = -1", "cohort_not_in_future": "cohort_date > today()",
        "cohort_size_positive": "cohort_sizes < 1", "retained_within_cohort": "cohort_sizes < retained_users",
        "rate_in_unit_interval": "abs(retention_rate - 0.5) > 0.5"},
    "session_funnel_daily": {
        "views_within_sessions": "sessions < sessions_with_view",
        "no_sessions_no_rates": "sessions = 0 AND len(list_filter([session_to_view_cr, session_to_payment_cr], lambda r: r IS NOT NULL)) > 0"},
    "unit_economics_daily": {"active_users_non_negative": "sign(active_users) = -1"},
}


def check_sql(c: Check, source: Mapping[str, str]) -> str:
    """SQL counting the violations of one check."""
    table, names = source[c.model], ", ".join(c.cols)
    if c.kind == "not_null":
        count = f"SELECT count(*) - count({names}) FROM {table}"
    elif c.kind == "predicate":
        count = f"SELECT count(*) FILTER (WHERE {ROW_SQL[c.model][c.label]}) FROM {table}"
    elif c.kind in ("unique", "unique_combination"):
        known = f"WHERE {names} IS NOT NULL" if c.kind == "unique" else ""
        count = f"SELECT count(*) FILTER (WHERE n > 1) FROM (SELECT count(*) AS n FROM {table} {known} GROUP BY {names})"
    elif c.kind == "relationships":
        parent = source[c.parent]
        count = f"SELECT count(*) FROM {table} child ANTI JOIN {parent} up ON up.{c.parent_col} = child.{names} WHERE child.{names} IS NOT NULL"
    elif c.kind == "accepted_values":
        allowed = ", ".join(repr(v) for v in c.values)
        count = f"SELECT count(*) FROM (SELECT DISTINCT {names} AS v FROM {table}) WHERE v IS NOT NULL AND list_position([{allowed}], v) IS NULL"
    else:
        raise ValueError(c.kind)
    return f"SELECT '{c.name}' AS check_name, '{c.model}' AS model, CAST(({count}) AS BIGINT) AS violations"
