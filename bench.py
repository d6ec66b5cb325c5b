"""Benchmark: build the warehouse from the raw tables and run the KPI queries.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Prints one JSON line: total seconds plus per-stage / per-query seconds.
Stages: ``build_*`` materialise the core models (landing -> staging -> facts);
every other entry is a registered query collected over those models. The last
three (landing, stream, incremental) aren't part of the total.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cartwheel.plans import registry  # noqa: E402
from cartwheel.plans.warehouse import warehouse_for  # noqa: E402
from cartwheel.session import local_session  # noqa: E402

BUILD_STAGES = [
    ("build_fct_events", "fct_events"),
    ("build_fct_payments", "fct_payments"),
    ("build_attribution", "map_payment_to_session"),
    ("build_fct_sessions", "fct_sessions"),
    ("build_daily_facts", "fct_user_daily_activity"),
    ("build_product_daily", "fct_product_daily_activity"),
    ("build_dims", "dim_users"),
]
HEADLINE = [
    "session_funnel_daily", "dau_wau_mau", "product_conversion_daily", "retention_cohorts",
    "repeat_retention_cohorts", "ltv_cohort_curve", "unit_economics_daily",
    "payment_event_candidates", "map_payment_to_event", "dim_products", "revenue_by_brand",
    "new_vs_repeat_revenue", "time_to_purchase", "dq_summary",
]
# Timed after the total, so that it stays comparable: the landing of the raw feed, its stream,
# and three incremental deliveries of the whole model graph.
BEYOND = ["landing_clickstream", "streaming_landing_dedup", "fct_events_incremental"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) * 2)
    times: dict[str, float] = {}
    t_all = time.time()
    t0 = time.time()   # first job of a fresh JVM: class loading + codegen warm-up
    spark.range(1000).selectExpr("sum(id)").collect()
    times["session_warmup"] = round(time.time() - t0, 3)
    wh = warehouse_for(spark, sf_dir)
    for stage, model in BUILD_STAGES:
        t0 = time.time()
        getattr(wh, model)()
        times[stage] = round(time.time() - t0, 3)
    for name in HEADLINE:
        t0 = time.time()
        registry.QUERIES[name](spark, sf_dir).collect()
        times[name] = round(time.time() - t0, 3)
    total = round(time.time() - t_all, 3)
    for name in BEYOND:
        t0 = time.time()
        registry.QUERIES[name](spark, sf_dir).collect()
        times[name] = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "warehouse_build_plus_kpis_total", "value": total, "unit": "sec",
                      "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
