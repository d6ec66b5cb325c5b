
from pyspark.sql import functions as F

from cartwheel.functions.columns import second_boundaries
from cartwheel.operators import activity, matching, metrics, payments as pay_ops, sessions
from tests.helpers import d, events, payments, ts


def test_second_boundary(spark):
    df = spark.createDataFrame([(ts("2024-01-01 00:00:00.9"), ts("2024-01-01 00:00:01.1"))],
                               "a timestamp_ntz, b timestamp_ntz")
    r = df.select(second_boundaries("a", "b").alias("fwd"),
                  second_boundaries("b", "a").alias("back")).first()
    assert (r.fwd, r.back) == (1, -1)


def _sessions_fact(spark, k_payments):
    base = spark.createDataFrame(
        [("s1", 1, ts("2024-01-01 10:00:00"), d("2024-01-01"), True, True, True, k)
         for k in [k_payments]],
        "session_id string, user_id long, session_start_at timestamp_ntz, session_date date, "
        "has_product_view boolean, has_add_to_cart boolean, has_purchase_event boolean, "
        "payments_count long")
    return base


def test_two_payments_one_session_fan_out(spark):
    """A session with two succeeded payments counts twice (parity) or once."""
    s = _sessions_fact(spark, 2)
    parity = metrics.session_funnel_daily(s).first()
    fixed = metrics.session_funnel_daily(s, distinct_paid=True).first()
    assert (parity.sessions, parity.sessions_with_view, parity.sessions_with_payment) == (2, 2, 2)
    assert (fixed.sessions, fixed.sessions_with_view, fixed.sessions_with_payment) == (1, 1, 1)


def test_session_without_payment(spark):
    s = _sessions_fact(spark, 0)
    r = metrics.session_funnel_daily(s).first()
    assert r.sessions == 1 and r.sessions_with_payment == 0 and r.session_to_payment_cr == 0.0


def _daily(spark, rows):
    return spark.createDataFrame(
        [(u, d(a), rev, ref, True) for u, a, rev, ref in rows],
        "user_id long, activity_date date, revenue_cents long, refunded_cents long, "
        "is_active boolean")


def test_ltv_gap_null_partition(spark):
    """Ages without revenue show cumulative 0 (parity) or carry forward (filled)."""
    users = spark.createDataFrame([(1, d("2024-01-01"))], "user_id long, first_seen_date date")
    daily = _daily(spark, [(1, "2024-01-01", 1000, 0), (1, "2024-01-03", 500, 0)])
    parity = {r.cohort_age_days: r.cumulative_revenue
              for r in metrics.ltv_cohort_curve(users, daily, max_age=3).collect()}
    filled = {r.cohort_age_days: r.cumulative_revenue
              for r in metrics.ltv_cohort_curve(users, daily, max_age=3, fill=True).collect()}
    assert parity == {0: 10.0, 1: 0.0, 2: 15.0, 3: 0.0}
    assert filled == {0: 10.0, 1: 10.0, 2: 15.0, 3: 15.0}


def test_null_user_payment_day_has_zero_measures(spark):
    """A payment without user makes a (NULL, day) row whose measures are 0."""
    sess = spark.createDataFrame([], "user_id long, session_date date, events_count long")
    p = payments(spark, [("pi_1", "2024-01-02 10:00:00", True, None, None, 500, 0)])
    rows = activity.fct_user_daily_activity(sess, p).collect()
    assert len(rows) == 1
    r = rows[0]
    assert r.user_id is None and r.payments_count == 0 and r.revenue_amount == 0.0
    assert r.is_payer_day is False


def test_late_refund_reaches_payment(spark):
    """Refunds reach their intent through the charge; unknown charges do not."""
    intents = spark.createDataFrame(
        [("pi_1", ts("2024-01-01 10:00:00"), ts("2024-01-01 10:00:00"), "succeeded", 1000, "usd",
          None, None, None, 1, "s")],
        "payment_intent_id string, event_time timestamp_ntz, received_ts timestamp_ntz, "
        "status string, amount_gross_cents long, currency string, order_id string, "
        "attempt_number int, payment_method string, user_id long, user_session string")
    charges = spark.createDataFrame(
        [("ch_1", "pi_1", "succeeded", ts("2024-01-01 10:01:00"), ts("2024-01-01 10:01:00"), 1000,
          "usd")],
        "charge_id string, payment_intent_id string, status string, event_time timestamp_ntz, "
        "received_ts timestamp_ntz, amount_gross_cents long, currency string")
    refunds = spark.createDataFrame(
        [("re_1", "ch_1", "succeeded", 400), ("re_2", "ch_1", None, 100),
         ("re_3", "ch_1", "failed", 999), ("re_4", "ch_unknown", "succeeded", 50)],
        "refund_id string, charge_id string, status string, amount_refunded_cents long")
    r = pay_ops.fct_payments(intents, charges, refunds).first()
    assert r.refunded_amount == 5.0 and r.is_refunded and r.is_succeeded
    assert r.charge_id == "ch_1" and r.succeeded_at == ts("2024-01-01 10:01:00")


def test_best_charge_prefers_succeeded_then_latest(spark):
    intents = spark.createDataFrame(
        [("pi_1", ts("2024-01-01 10:00:00"), ts("2024-01-01 10:00:00"), None, None, None,
          None, None, None, 1, "s")],
        "payment_intent_id string, event_time timestamp_ntz, received_ts timestamp_ntz, "
        "status string, amount_gross_cents long, currency string, order_id string, "
        "attempt_number int, payment_method string, user_id long, user_session string")
    charges = spark.createDataFrame(
        [("ch_a", "pi_1", "failed", ts("2024-01-01 10:05:00"), ts("2024-01-01 10:05:00"), 700, "eur"),
         ("ch_b", "pi_1", "succeeded", ts("2024-01-01 10:01:00"), ts("2024-01-01 10:01:00"), 900, "usd"),
         ("ch_c", "pi_1", "succeeded", None, ts("2024-01-01 10:09:00"), 800, "usd")],
        "charge_id string, payment_intent_id string, status string, event_time timestamp_ntz, "
        "received_ts timestamp_ntz, amount_gross_cents long, currency string")
    refunds = spark.createDataFrame([], "refund_id string, charge_id string, status string, "
                                        "amount_refunded_cents long")
    r = pay_ops.fct_payments(intents, charges, refunds).first()
    # succeeded first; NULL event time sorts last; amount falls back to the charge
    assert r.charge_id == "ch_b" and r.amount == 9.0 and r.currency == "usd"
    assert r.is_succeeded


def test_session_key_beats_user_key_and_ties_break_on_event_id(spark):
    """Same event found by session and user key; equidistant ties."""
    p = payments(spark, [("pi_1", "2024-01-01 10:00:00", True, 7, "7-2024-01-01", 100, 0)])
    p = p.withColumnRenamed("payment_intent_event_ts", "payment_intent_event_ts")
    ev = events(spark, [
        ("evt_b", "2024-01-01 09:50:00", "2024-01-01 09:50:00", "view", 7, "7-2024-01-01", "1"),
        ("evt_a", "2024-01-01 10:10:00", "2024-01-01 09:50:00", "view", 7, "7-2024-01-01", "1"),
        ("evt_far", "2024-01-01 11:00:01", "2024-01-01 11:00:01", "purchase", 7, "7-2024-01-01", "1"),
        ("evt_other", "2024-01-01 10:00:00", "2024-01-01 10:00:00", "purchase", 7, "x", "1"),
    ])
    cand = matching.match_candidates(p, ev, 60)
    kinds = sorted((r.event_id, r.matched_type) for r in cand.collect())
    assert kinds == [("evt_a", "user_id"), ("evt_a", "user_session"), ("evt_b", "user_id"),
                     ("evt_b", "user_session"), ("evt_other", "user_id")]
    best = matching.map_payment_to_event(cand).first()
    assert best.event_id == "evt_a" and best.match_score == 100


def test_band_join_edges_inclusive(spark):
    p = payments(spark, [("pi_1", "2024-01-01 10:00:00", True, 7, "s", 100, 0)])
    ev = events(spark, [
        ("lo", "2024-01-01 09:00:00", "2024-01-01 09:00:00", "view", 7, "s", "1"),
        ("hi", "2024-01-01 11:00:00", "2024-01-01 11:00:00", "view", 7, "s", "1"),
        ("out", "2024-01-01 11:00:00.000001", "2024-01-01 11:00:00", "view", 7, "s", "1"),
    ])
    got = sorted(r.event_id for r in matching.match_candidates(p, ev, 60)
                 .where("matched_type = 'user_session'").collect())
    assert got == ["hi", "lo"]


def test_repeat_horizons(spark):
    """M5: 2nd purchase after 1, 7, 8, 60 and 61 days, cumulative by horizon."""
    rows = []
    for u, gap in enumerate([1, 7, 8, 60, 61]):
        rows.append((f"a{u}", "2024-01-01 12:00:00", True, u, "s", 100, 0))
        second = (d("2024-01-01").toordinal() + gap)
        day = d("2024-01-01").fromordinal(second).isoformat()
        rows.append((f"b{u}", f"{day} 09:00:00", True, u, "s", 100, 0))
    rows.append(("c9", "2024-01-01 12:00:00", True, 9, "s", 100, 0))   # never repeats
    out = {r.cohort_age_days: r.retained_users
           for r in metrics.repeat_retention_cohorts(payments(spark, rows)).collect()}
    assert out == {1: 1, 7: 2, 14: 3, 21: 3, 30: 3, 60: 4}


def test_null_order_refunds_earliest_received(spark):
    """§1.4 #7 / T18: earliest received wins, NULL received time sorts last."""
    staged = spark.createDataFrame(
        [("refund.created", None, ts("2024-01-02 00:00:00"), "e1", None, "re_1", "succeeded", "100"),
         ("refund.created", ts("2024-01-03 00:00:00"), ts("2024-01-02 00:00:00"), "e2", None, "re_1", "failed", "200"),
         ("refund.created", ts("2024-01-04 00:00:00"), ts("2024-01-02 00:00:00"), "e3", None, " ", "succeeded", "5")],
        "event_type string, ingested_at timestamp_ntz, event_time timestamp_ntz, "
        "provider_event_id string, provider_created_ts timestamp_ntz, id string, status string, "
        "amount string")
    staged = staged.select(
        "event_type", "ingested_at", "event_time", "provider_event_id", "provider_created_ts",
        F.lit("{}").alias("raw_payload_json"),
        F.struct("id", "status", "amount", F.lit("usd").alias("currency"),
                 F.lit(None).cast("string").alias("reason"), F.lit("ch_1").alias("charge"),
                 F.struct(F.lit(None).cast("string").alias("order_id")).alias("metadata")
                 ).alias("object"))
    got = {r.refund_id: (r.status, r.amount_refunded) for r in pay_ops.refunds(staged).collect()}
    # blank ids stay as one NULL-key refund (not filtered), as in the reference
    assert got == {"re_1": ("failed", 2.0), None: ("succeeded", 0.05)}


def test_session_over_batches_recomputed_in_full(spark):
    """Events of one session in two slices give the full-history session."""
    from cartwheel.operators import incremental as inc
    ev1 = events(spark, [("e1", "2024-01-01 10:00:00", "2024-01-01 10:00:00", "view", 1, "s1", "1")])
    ev_all = ev1.unionByName(events(spark, [
        ("e2", "2024-01-01 10:30:00", "2024-01-09 10:00:00", "cart", 1, "s1", "1")]))
    t1 = sessions.sessions_base(ev1)
    wm = inc.high_watermark(t1, "last_received_ts")
    slice_ = inc.lookback(ev_all, "received_ts", wm, 3)
    t2 = inc.recompute_touched(t1, ev_all, slice_.select("user_session"), ["user_session"],
                               sessions.sessions_base, out_keys=["session_id"])
    r = t2.collect()
    assert len(r) == 1 and r[0].events_count == 2 and r[0].has_add_to_cart
    assert r[0].session_duration_seconds == 1800


def test_rolling_active_users_matches_brute_force(spark):
    import random
    rnd = random.Random(7)
    rows = sorted({(rnd.randint(1, 6), rnd.randint(0, 70)) for _ in range(120)})
    base = d("2024-01-01").toordinal()
    daily = spark.createDataFrame(
        [(u, d("2024-01-01").fromordinal(base + k), True) for u, k in rows],
        "user_id long, activity_date date, is_active boolean")
    got = {r.activity_date: (r.dau, r.wau, r.mau) for r in metrics.dau_wau_mau(daily).collect()}
    days = sorted({k for _, k in rows})
    for k in days:
        def users(lo):
            return len({u for u, kk in rows if lo <= kk <= k})
        want = (users(k), users(k - 6), users(k - 29))
        assert got[d("2024-01-01").fromordinal(base + k)] == want
