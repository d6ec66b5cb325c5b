"""Physical-plan properties that matter at scale."""

import re

import pytest

import __spark_entry__ as E
from cartwheel.plans.warehouse import Warehouse

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_no_nested_loop_or_cartesian_join(spark, name):
    plan = _plan(E.queries()[name](spark, SF))
    assert "BroadcastNestedLoopJoin" not in plan
    assert "CartesianProduct" not in plan


def test_dedups_use_partial_group_limit(spark):
    wh = Warehouse(spark, SF, materialise=False)
    for df in (wh.fct_events(), wh.payment_intents()):
        plan = _plan(df)
        # a partial limit before the shuffle and a final one after it
        assert len(re.findall(r"WindowGroupLimit", plan)) >= 2


def test_product_day_and_brand_jobs_leave_the_event_fact_alone(spark):
    from cartwheel.operators import activity, kpis
    wh = Warehouse(spark, SF)
    plan = _plan(activity.fct_product_daily_activity(wh.fct_events(), wh.map_payment_to_event(), wh.fct_payments()))
    assert plan.count("FileScan parquet") == 3
    assert _plan(kpis.brand_retention(wh.fct_payments(), wh.map_payment_to_event())).count("FileScan parquet") == 2


def test_band_join_shuffles_on_key_bucket_and_salt_without_broadcasts(spark):
    from cartwheel.operators import matching
    wh = Warehouse(spark, SF)
    pays, events = wh.fct_payments(), wh.fct_events()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(matching.match_candidates(pays, events, 60))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    keyed = re.findall(r"SortMergeJoin \[([^\]]*)\]", plan)
    assert len(keyed) == 2 and all("_bucket" in k and "_salt" in k for k in keyed)
    assert plan.count("FileScan parquet") == 4 and "Broadcast" not in plan


def test_band_join_is_an_equi_join_on_key_and_bucket(spark):
    wh = Warehouse(spark, SF, materialise=False)
    plan = _plan(wh.payment_event_candidates())
    joins = re.findall(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin) \[([^\]]*)\]", plan)
    keyed = [keys for _, keys in joins if "_bucket" in keys]
    assert len(keyed) == 2


def test_materialised_scans_prune_columns(spark):
    wh = Warehouse(spark, SF)
    plan = _plan(wh.session_funnel_daily())
    scan = [line for line in plan.split("\n") if "FileScan parquet" in line][0]
    assert "session_date" in scan and "session_revenue" not in scan


def test_event_fact_is_written_in_time_order(spark):
    """Files cover disjoint time ranges, so a time-bounded read skips most of them."""
    import glob

    import pyarrow.parquet as pq
    from cartwheel.plans import warehouse
    wh = Warehouse(spark, SF)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        wh.fct_events()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spans = []
    for f in glob.glob(f"{wh.root.removeprefix('file:')}/fct_events/*.parquet"):
        times = [t for t in pq.read_table(f, columns=["event_time"])["event_time"].to_pylist() if t is not None]
        if times:
            assert times == sorted(times)
            spans.append((times[0], times[-1]))
    spans.sort()
    assert len(spans) > 1 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    assert set(warehouse.TIME_ORDERED) == {"fct_events"}


def test_bucketed_tables_join_without_a_shuffle(spark):
    from cartwheel.operators import matching, payments, sessions
    from cartwheel.plans.warehouse import BUCKETED, Warehouse
    plain, wh = Warehouse(spark, SF), Warehouse(spark, SF, buckets=4)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for name in ("fct_sessions", "fct_payments", "map_payment_to_session"):
        rows = [sorted(repr(tuple(r)) for r in w.__getattribute__(name)().drop("updated_at").collect()) for w in (plain, wh)]
        assert rows[0] == rows[1], name
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        def exchanges(df):
            return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
        assert exchanges(wh.payment_intents().join(wh.charges(), "payment_intent_id")) == 0
        assert exchanges(wh.map_payment_to_session().join(wh.fct_payments(), "payment_intent_id")) == 0
        assert exchanges(matching.map_payment_to_session(wh.map_payment_to_event(), wh.sessions_base())) == 0
        assert exchanges(plain.payment_intents().join(plain.charges(), "payment_intent_id")) == 2
        # only what is grouped anew is shuffled: refunds by charge and by intent; payments of a session
        assert exchanges(payments.fct_payments(wh.payment_intents(), wh.charges(), wh.refunds())) <= 3
        assert exchanges(sessions.fct_sessions(wh.sessions_base(), wh.map_payment_to_session(), wh.fct_payments())) == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    for name, key in BUCKETED.items():
        table = f"{name}_{wh.root.rsplit('/', 1)[1]}"
        described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE FORMATTED {table}").collect()}
        assert described["Num Buckets"] == "4" and key in described["Bucket Columns"] and key in described["Sort Columns"]


def test_best_matches_and_their_facts_build_no_candidates(spark):
    from cartwheel.operators import matching
    wh = Warehouse(spark, SF)
    best = wh.map_payment_to_event()
    wh.fct_sessions(), wh.fct_product_daily_activity()
    assert "payment_event_candidates" not in wh._models
    again = matching.map_payment_to_event(wh.payment_event_candidates()).select(*best.columns)
    assert best.count() == again.count() and not best.exceptAll(again).count() and not again.exceptAll(best).count()


def test_candidates_are_taken_from_the_join_and_checked_unwritten(spark):
    from cartwheel.operators import quality
    wh = Warehouse(spark, SF)
    assert "_bucket" in _plan(wh.payment_event_candidates()) and "payment_event_candidates" not in wh.observed
    checks = [c for c in quality.CHECKS if c.model == "payment_event_candidates"]
    models = {m: getattr(wh, m)() for m in ("payment_event_candidates", "fct_payments", "fct_events")}
    assert {(r["check_name"], r["violations"]) for r in quality.dq_summary(models, checks, wh.observed).collect()} == {(c.name, 0) for c in checks}


def test_clicks_meet_by_payload_as_typed_columns(spark, monkeypatch):
    from cartwheel.operators import staging
    seen, latest = [], staging.latest_delivery
    monkeypatch.setattr(staging, "latest_delivery", lambda rows: (seen.append(rows.columns), latest(rows))[1])
    staged = staging.stage_clickstream(Warehouse(spark, SF).landing_clickstream())
    assert len(seen) == 1 and {"brand", "event_ts", "price"} <= set(seen[0]) and set(staged.columns) == set(seen[0])
