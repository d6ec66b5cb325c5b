"""Data-quality checks (Q1-Q6): each returns the violating rows (0 rows = pass).

``CHECKS`` lists every assertion the reference declares on its models
(generic column tests and singular row predicates). Row-level checks of a model
that is written are counted while it is written (``observe``); ``dq_summary`` then
reads only the key columns of such models, all columns of a key domain in one
aggregation. A model that isn't written is read once for all its checks. Row predicates are Column rules built from a few rule functions; the
oracle states the same checks in SQL of its own (``plans/oracle_checks.py``).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from cartwheel.fixed_values import FUNNEL_EVENT_TYPES, REPEAT_HORIZONS, SESSION_MATCH, USER_MATCH


# ---------------------------------------------------------------- checks
def not_null(df: DataFrame, col: str) -> DataFrame:
    """Q1: rows where ``col`` is NULL."""
    return df.where(F.col(col).isNull())


def unique(df: DataFrame, cols: Sequence[str] | str) -> DataFrame:
    """Q2: non-NULL values of ``cols`` that occur more than once (with count)."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    present = F.lit(True)
    for c in cols:
        present = present & F.col(c).isNotNull()
    return (df.where(present).groupBy(*cols)
            .agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1"))


def unique_combination(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Q5: combinations of ``cols`` (NULL included) that occur more than once."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1")


def relationships(child: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Q3: child rows whose non-NULL ``col`` has no ``parent_col`` match (orphans)."""
    keys = parent.select(F.col(parent_col).alias("_parent_key")).where("_parent_key IS NOT NULL")
    return (child.where(F.col(col).isNotNull())
            .join(keys, F.col(col) == F.col("_parent_key"), "left_anti"))


def accepted_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Q4: distinct non-NULL values of ``col`` outside ``values`` (with counts)."""
    return (df.where(F.col(col).isNotNull() & ~F.col(col).isin(list(values)))
            .groupBy(F.col(col).alias("value_field")).agg(F.count(F.lit(1)).alias("n_records")))


Rule = Callable[[], Column]


def predicate(df: DataFrame, rule: Rule) -> DataFrame:
    """Q6: rows that break a rule (a rule gives the Column that is true for them)."""
    return df.where(rule())


# Rules. Each names what must hold; the column it gives is true where it doesn't.
def not_negative(*cols: str) -> Rule:
    return lambda: F.least(*cols, F.lit(0)) < 0


def above_zero(col: str) -> Rule:
    return lambda: ~(F.col(col) > 0)


def in_order(low: str, high: str) -> Rule:
    return lambda: F.col(high) < F.col(low)


def share(col: str) -> Rule:
    return lambda: ~F.col(col).between(0, 1)


def not_after(col: str, now: Callable[[], Column]) -> Rule:
    return lambda: F.col(col) > now()


def flags(flag: str, count: str) -> Rule:
    """The flag says whether the (never negative) count is above zero."""
    return lambda: (F.col(count) >= 0) & (F.col(flag) != (F.col(count) > 0))


def given(condition: Callable[[], Column], rule: Rule) -> Rule:
    return lambda: condition() & rule()


def missing(*cols: str) -> Rule:
    """None of the columns may be missing."""
    return lambda: F.array_contains(F.array(*[F.col(c).isNull() for c in cols]), True)


def unset(*cols: str) -> Rule:
    """All of the columns must be missing."""
    return lambda: F.coalesce(*[F.col(c).cast("string") for c in cols]).isNotNull()


def one_of(col: str, values: Sequence) -> Rule:
    return lambda: ~F.col(col).isin(list(values))


def covers(total: str, *parts: str) -> Rule:
    """The total is at least the sum of its parts."""
    return lambda: F.aggregate(F.array(*parts), F.col(total).cast("bigint"), lambda left, part: left - part) < 0


def is_zero(col: str) -> Rule:
    return lambda: F.col(col) != 0


def true(col: str) -> Callable[[], Column]:
    return lambda: F.col(col)


def refunds_exceeding_charge(refunds: DataFrame, charges: DataFrame) -> DataFrame:
    """Refunds larger than the gross amount of their charge (inner join check)."""
    c = charges.select("charge_id", F.col("amount_gross").alias("charge_amount_gross"))
    return (refunds.join(c, "charge_id")
            .where(F.col("amount_refunded") > F.col("charge_amount_gross")))


# ---------------------------------------------------------------- catalogue
@dataclass(frozen=True)
class Check:
    model: str
    kind: str                       # not_null | unique | unique_combination | relationships
    cols: tuple[str, ...] = ()      # | accepted_values | predicate
    parent: str | None = None
    parent_col: str | None = None
    values: tuple = ()
    rule: Rule | None = field(default=None, compare=False)
    label: str | None = None
    extra: dict = field(default_factory=dict, compare=False, hash=False)

    @property
    def name(self) -> str:
        if self.label:
            return f"{self.model}.{self.label}"
        if self.kind == "relationships":
            return f"{self.model}.{self.cols[0]}.references.{self.parent}.{self.parent_col}"
        return f"{self.model}.{'+'.join(self.cols)}.{self.kind}"


def _nn(model: str, *cols: str) -> list[Check]:
    return [Check(model, "not_null", (c,)) for c in cols]


def _rules(model: str, **rules: Rule) -> list[Check]:
    return [Check(model, "predicate", rule=rule, label=label) for label, rule in rules.items()]


CHECKS: list[Check] = [
    # staging
    *_nn("stg_clickstream_events", "event_id", "payload_hash", "ingested_at"),
    Check("stg_clickstream_events", "unique", ("payload_hash",)),
    *_nn("stg_payment_events", "provider_event_id", "payload_hash", "ingested_at"),
    Check("stg_payment_events", "unique", ("payload_hash",)),
    # payment intermediates
    *_nn("payment_intents", "payment_intent_id", "event_time", "received_ts", "status",
         "amount_gross", "currency", "event_type", "provider_event_id"),
    Check("payment_intents", "unique", ("payment_intent_id",)),
    *_nn("charges", "charge_id", "event_time", "received_ts", "status", "amount_gross", "currency",
         "payment_intent_id", "event_type", "provider_event_id"),
    Check("charges", "unique", ("charge_id",)),
    Check("charges", "relationships", ("payment_intent_id",), "payment_intents", "payment_intent_id"),
    *_nn("refunds", "refund_id", "event_time", "received_ts", "status", "amount_refunded",
         "currency", "charge_id", "event_type", "provider_event_id"),
    Check("refunds", "unique", ("refund_id",)),
    Check("refunds", "relationships", ("charge_id",), "charges", "charge_id"),
    *_nn("payment_events_clean", "event_pk", "event_time", "event_date", "received_ts",
         "event_type", "raw_payload_json"),
    Check("payment_events_clean", "unique", ("event_pk",)),
    # attribution
    *_nn("payment_event_candidates", "payment_intent_id", "event_id", "match_score", "matched_type"),
    Check("payment_event_candidates", "relationships", ("payment_intent_id",), "fct_payments",
          "payment_intent_id"),
    Check("payment_event_candidates", "relationships", ("event_id",), "fct_events", "event_pk"),
    Check("payment_event_candidates", "accepted_values", ("matched_type",),
          values=(SESSION_MATCH, USER_MATCH)),
    *_nn("map_payment_to_event", "payment_intent_id", "event_id", "matched_type", "match_score"),
    Check("map_payment_to_event", "unique", ("payment_intent_id",)),
    Check("map_payment_to_event", "relationships", ("payment_intent_id",), "fct_payments",
          "payment_intent_id"),
    Check("map_payment_to_event", "relationships", ("event_id",), "fct_events", "event_pk"),
    Check("map_payment_to_event", "accepted_values", ("matched_type",),
          values=(SESSION_MATCH, USER_MATCH)),
    *_nn("map_payment_to_session", "payment_intent_id", "is_session_found"),
    Check("map_payment_to_session", "unique", ("payment_intent_id",)),
    Check("map_payment_to_session", "relationships", ("payment_intent_id",), "fct_payments",
          "payment_intent_id"),
    Check("map_payment_to_session", "relationships", ("session_id",), "sessions_base", "session_id"),
    # sessions (declared in the reference on a model name that does not exist)
    *_nn("sessions_base", "session_id", "user_id", "session_start_at", "session_end_at",
         "session_date", "events_count", "distinct_event_types_count", "is_bounce",
         "has_product_view", "has_add_to_cart", "has_purchase_event", "last_received_ts"),
    Check("sessions_base", "unique", ("session_id",)),
    # metrics
    *_nn("session_funnel_daily", "session_date", "sessions", "sessions_with_view",
         "sessions_with_cart", "sessions_with_purchase_event", "sessions_with_payment"),
    Check("session_funnel_daily", "unique", ("session_date",)),
    Check("product_conversion_daily", "unique_combination", ("product_id", "activity_date")),
    *_nn("product_conversion_daily", "activity_date", "product_id", "views_count",
         "add_to_cart_count", "payments_count", "revenue_amount", "refunded_amount"),
    Check("product_conversion_daily", "relationships", ("product_id",), "dim_products", "product_id"),
    Check("retention_cohorts", "unique_combination", ("cohort_date", "cohort_age_days")),
    *_nn("retention_cohorts", "cohort_date", "cohort_age_days", "retained_users", "cohort_sizes"),
    Check("repeat_retention_cohorts", "unique_combination", ("cohort_week", "cohort_age_days")),
    *_nn("repeat_retention_cohorts", "cohort_week", "cohort_age_days", "retained_users",
         "cohort_size"),
    Check("repeat_retention_cohorts", "accepted_values", ("cohort_age_days",),
          values=REPEAT_HORIZONS),
    *_nn("unit_economics_daily", "activity_date", "active_users", "paying_users", "revenue_amount"),
    Check("unit_economics_daily", "unique", ("activity_date",)),
    *_nn("dau_wau_mau", "activity_date", "dau", "wau", "mau"),
    Check("dau_wau_mau", "unique", ("activity_date",)),
    Check("ltv_cohort_curve", "unique_combination", ("cohort_date", "cohort_age_days")),
    *_nn("ltv_cohort_curve", "cohort_date", "cohort_age_days", "cohort_size", "revenue_amount",
         "cumulative_revenue"),
    # row predicates
    *_rules("dim_products", events_count_positive=above_zero("events_count"),
            last_seen_not_in_future=not_after("last_seen_at", F.current_timestamp),
            price_non_negative=not_negative("price"), lifecycle_bounds=in_order("first_seen_at", "last_seen_at")),
    *_rules("dim_users", lifetime_revenue_non_negative=not_negative("lifetime_revenue"),
            non_payer_zero_revenue=given(lambda: F.col("first_purchase_at").isNull(), is_zero("lifetime_revenue")),
            payer_has_first_purchase=given(true("is_payer"), missing("first_purchase_at")),
            session_bounds=in_order("first_session_at", "last_session_at")),
    *_rules("fct_events", event_time_not_in_future=not_after("event_time", F.current_timestamp),
            event_type_allowed=one_of("event_type", FUNNEL_EVENT_TYPES), price_non_negative=not_negative("price")),
    *_rules("fct_payments", refund_within_amount=in_order("refunded_amount", "amount"),
            refunded_has_amount=given(true("is_refunded"), above_zero("refunded_amount")),
            succeeded_has_amount=given(true("is_succeeded"), above_zero("amount")),
            succeeded_has_time=given(true("is_succeeded"), missing("succeeded_at"))),
    *_rules("fct_product_daily_activity",
            events_cover_funnel=covers("events_count", "views_count", "add_to_cart_count", "purchase_events_count"),
            payment_flag=flags("had_payment", "payments_count"), payments_non_negative=not_negative("payments_count"),
            refund_within_revenue=in_order("refunded_amount", "revenue_amount")),
    *_rules("fct_sessions", duration_non_negative=not_negative("session_duration_seconds"),
            time_bounds=in_order("session_start_at", "session_end_at")),
    *_rules("fct_user_daily_activity", active_flag=flags("is_active", "sessions_count"),
            payer_day_flag=flags("is_payer_day", "payments_count"), payments_non_negative=not_negative("payments_count"),
            refund_within_revenue=in_order("refunded_amount", "revenue_amount"),
            revenue_non_negative=not_negative("revenue_amount"), sessions_non_negative=not_negative("sessions_count")),
    *_rules("dau_wau_mau", dau_non_negative=not_negative("dau"), mau_at_least_wau=in_order("wau", "mau"),
            wau_at_least_dau=in_order("dau", "wau")),
    *_rules("ltv_cohort_curve", age_non_negative=not_negative("cohort_age_days"),
            cohort_size_positive=above_zero("cohort_size"), cumulative_non_negative=not_negative("cumulative_revenue")),
    *_rules("product_conversion_daily", amounts_non_negative=not_negative("revenue_amount", "refunded_amount"),
            counts_non_negative=not_negative("views_count", "add_to_cart_count", "payments_count"),
            refund_within_revenue=in_order("refunded_amount", "revenue_amount"),
            no_payment_no_aov=given(lambda: F.col("payments_count") == 0, unset("avg_order_value"))),
    *_rules("repeat_retention_cohorts", cohort_size_positive=above_zero("cohort_size"),
            retained_within_cohort=in_order("retained_users", "cohort_size"), rate_in_unit_interval=share("retention_rate")),
    *_rules("retention_cohorts", age_non_negative=not_negative("cohort_age_days"),
            cohort_not_in_future=not_after("cohort_date", F.current_date), cohort_size_positive=above_zero("cohort_sizes"),
            retained_within_cohort=in_order("retained_users", "cohort_sizes"), rate_in_unit_interval=share("retention_rate")),
    *_rules("session_funnel_daily", views_within_sessions=in_order("sessions_with_view", "sessions"),
            no_sessions_no_rates=given(lambda: F.col("sessions") == 0, unset("session_to_view_cr", "session_to_payment_cr"))),
    *_rules("unit_economics_daily", active_users_non_negative=not_negative("active_users")),
]
# the refunds-vs-charge check joins two models; it is evaluated separately
REFUND_VS_CHARGE = "refunds.amount_within_charge"


def _broken(c: Check) -> Column:
    """True where a row breaks a row-level check; a comparison with a missing value doesn't."""
    if c.kind == "not_null":
        return F.col(c.cols[0]).isNull()
    return F.coalesce(c.rule(), F.lit(False))


def _stack(df: DataFrame, names: Sequence[str], model: str) -> DataFrame:
    """Turn the one-row ``_c0.._cN`` counts into (check_name, model, violations) rows
    with a single SQL ``stack`` (one expression instead of one per check)."""
    args = ", ".join(f"'{n}', CAST(_c{i} AS BIGINT)" for i, n in enumerate(names))
    return df.selectExpr(f"stack({len(names)}, {args}) AS (check_name, violations)").selectExpr(
        "check_name", f"'{model}' AS model", "violations")


def _model_pass(df: DataFrame, model: str, checks: Sequence[Check]) -> DataFrame | None:
    """All row-level checks of a model plus its (at most one) key-uniqueness
    check in one aggregation: grouped by the key when there is one (one
    shuffle, combined map-side), a global aggregate otherwise."""
    rows = [c for c in checks if c.kind in ("not_null", "predicate")]
    keyed = [c for c in checks if c.kind in ("unique", "unique_combination")]
    if not rows and not keyed:
        return None
    if len(keyed) > 1:
        raise ValueError(f"{model}: one uniqueness check per pass")
    names = [c.name for c in rows]
    if not keyed:
        agg = df.agg(*[F.count_if(_broken(c)).alias(f"_c{i}") for i, c in enumerate(rows)])
        return _stack(agg, names, model)
    k = keyed[0]
    per_key = df.groupBy(*k.cols).agg(
        F.expr("count(1) AS _n"),
        *[F.count_if(_broken(c)).alias(f"_r{i}") for i, c in enumerate(rows)])
    dup = "_n > 1" + "".join(f" AND {col} IS NOT NULL" for col in k.cols if k.kind == "unique")
    agg = per_key.selectExpr(*[f"sum(_r{i}) AS _c{i}" for i in range(len(rows))],
                             f"count_if({dup}) AS _c{len(rows)}")
    return _stack(agg, names + [k.name], model)


def row_checks(model: str, checks: Sequence[Check] = CHECKS) -> list[Check]:
    """The checks of a model that look at one row at a time."""
    return [c for c in checks if c.model == model and c.kind in ("not_null", "predicate", "accepted_values")]


def observe(df: DataFrame, model: str, checks: Sequence[Check] = CHECKS) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """``df`` with the model's row checks counted while an action runs over it (a write), and how to get the counts.

    The counts are by check name: rows that break it. A task that runs twice may count twice, so a count above zero says
    that there are violations and not how many; zero is exact.
    """
    rows = row_checks(model, checks)
    if not rows:
        return df, dict
    seen = Observation(f"checks of {model}")
    broken = [F.count_if(F.col(c.cols[0]).isNotNull() & ~F.col(c.cols[0]).isin(list(c.values)) if c.kind == "accepted_values" else _broken(c))
              for c in rows]
    return df.observe(seen, *[b.alias(f"c{i}") for i, b in enumerate(broken)]), lambda: {c.name: seen.get[f"c{i}"] for i, c in enumerate(rows)}


def _count(bad: DataFrame, check: Check) -> DataFrame:
    return bad.agg(F.count(F.lit(1)).cast("bigint").alias("violations")).select(
        F.lit(check.name).alias("check_name"), F.lit(check.model).alias("model"), "violations")


def _key_passes(models: Mapping[str, DataFrame], checks: Sequence[Check]) -> list[DataFrame]:
    """Uniqueness and references by key domain: the parent's key column and all columns that refer to it meet in one
    aggregate by value, which every map task combines first. A value more than once in the parent breaks its
    uniqueness; the rows of a value that the parent hasn't are orphans.
    """
    domains: dict[tuple[str, str], list[Check]] = {}
    parts = []
    for c in checks:
        if c.kind == "relationships":
            domains.setdefault((c.parent, c.parent_col), []).append(c)
        elif c.kind == "unique" and len(c.cols) == 1:
            domains.setdefault((c.model, c.cols[0]), []).append(c)
        elif c.kind in ("unique", "unique_combination"):
            bad = unique(models[c.model], c.cols) if c.kind == "unique" else unique_combination(models[c.model], c.cols)
            parts.append(_count(bad, c))
    for (parent, col), members in domains.items():
        children = [c for c in members if c.kind == "relationships"]
        sources = [(models[parent], col)] + [(models[c.model], c.cols[0]) for c in children]
        values = union_all([df.select(F.col(name).alias("key"), F.lit(i).alias("source")).where("key IS NOT NULL")
                            for i, (df, name) in enumerate(sources)])
        by_value = values.groupBy("key").agg(*[F.count_if(F.col("source") == i).alias(f"_n{i}") for i in range(len(sources))])
        orphans = iter(range(1, len(sources)))
        counts = [f"coalesce(sum(if(_n0 = 0, _n{next(orphans)}, 0)), 0)" if c.kind == "relationships" else "count_if(_n0 > 1)" for c in members]
        args = ", ".join(f"'{c.name}', '{c.model}', CAST(_c{i} AS BIGINT)" for i, c in enumerate(members))
        parts.append(by_value.selectExpr(*[f"{e} AS _c{i}" for i, e in enumerate(counts)])
                     .selectExpr(f"stack({len(members)}, {args}) AS (check_name, model, violations)"))
    return parts


def dq_summary(models: Mapping[str, DataFrame], checks: Sequence[Check] = CHECKS,
               observed: Mapping[str, Mapping[str, int]] | None = None) -> DataFrame:
    """One row per check: ``(check_name, model, violations)``.

    ``observed`` holds what ``observe`` counted while a model was written: its row checks that no row broke need no
    scan, and those that some did are counted anew, exactly. Keys of observed models are checked by domain
    (``_key_passes``); a model that nobody wrote is read once for all its checks.
    """
    return union_all(_summary_parts(models, checks, observed))


def dq_summary_in_turn(models: Mapping[str, DataFrame], checks: Sequence[Check] = CHECKS,
                       observed: Mapping[str, Mapping[str, int]] | None = None) -> DataFrame:
    """The rows of ``dq_summary``, counted pass by pass: the driver holds one pass's plan, broadcasts and tasks at a time.

    Only the counts, a row a check, come to the driver.
    """
    counted = [tuple(r) for part in _summary_parts(models, checks, observed) for r in part.collect()]
    return next(iter(models.values())).sparkSession.createDataFrame(counted, SUMMARY)


#: What a check's row holds.
SUMMARY = "check_name string, model string, violations bigint"


def _summary_parts(models: Mapping[str, DataFrame], checks: Sequence[Check],
                   observed: Mapping[str, Mapping[str, int]] | None) -> list[DataFrame]:
    """The passes of ``dq_summary``: each a row for some checks."""
    observed = observed or {}
    parts: list[DataFrame] = []
    clean: list[tuple[str, str, int]] = []
    keyed: list[Check] = []
    by_model: dict[str, list[Check]] = {}
    for c in checks:
        by_model.setdefault(c.model, []).append(c)
    for model, cks in by_model.items():
        df, counts = models[model], observed.get(model)
        unique_ = [c for c in cks if c.kind.startswith("unique")]
        in_pass = unique_[:1] if counts is None else []  # the one pass over a model that isn't written takes one key along
        keyed += [c for c in cks if c.kind == "relationships"] + [c for c in unique_ if c not in in_pass]
        if counts is not None:
            clean += [(c.name, model, 0) for c in cks if counts.get(c.name) == 0]
            cks = [c for c in cks if counts.get(c.name) != 0]
        cks = [c for c in cks if c not in unique_] + in_pass
        one_pass = _model_pass(df, model, cks)
        if one_pass is not None:
            parts.append(one_pass)
        parts += [_count(accepted_values(df, c.cols[0], c.values), c) for c in cks if c.kind == "accepted_values"]
    parts += _key_passes(models, keyed)
    if "refunds" in models and "charges" in models:
        bad = refunds_exceeding_charge(models["refunds"], models["charges"])
        parts.append(_count(bad, Check("refunds", "predicate", label=REFUND_VS_CHARGE.split(".")[1])))
    if clean:
        spark = next(iter(models.values())).sparkSession
        parts.append(spark.createDataFrame(clean, SUMMARY))
    return parts


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    """Union many same-shaped frames as a balanced tree: each step analyses a
    small plan, instead of re-analysing an ever longer chain (quadratic)."""
    level = list(parts)
    while len(level) > 1:
        nxt = [level[i].union(level[i + 1]) for i in range(0, len(level) - 1, 2)]
        if len(level) % 2:
            nxt.append(level[-1])
        level = nxt
    return level[0]
