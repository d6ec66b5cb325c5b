"""Single-node reference timing: the oracle SQL run model-by-model in DuckDB,
each model materialised as a table (the reference's execution model), then
the headline KPI queries over those tables. Prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cartwheel.plans import oracle, registry  # noqa: E402

MODELS = ["kept", "click_rows", "click_landing", "purch", "pay_kinds", "pay_landing", "stg_click",
          "stg_pay", "pay_clean", "intents", "charges_t", "refunds_t", "charge_pick", "refund_sums",
          "payments", "fevents", "sess_base", "cand", "map_event", "map_session", "sess",
          "user_daily", "product_daily", "users_dim", "products_dim"]
HEADLINE = ["session_funnel_daily", "dau_wau_mau", "product_conversion_daily",
            "retention_cohorts", "repeat_retention_cohorts", "ltv_cohort_curve",
            "unit_economics_daily", "payment_event_candidates", "map_payment_to_event",
            "dim_products", "revenue_by_brand", "new_vs_repeat_revenue", "time_to_purchase",
            "dq_summary"]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    threads = int(os.environ.get("BENCH_CPUS", "8"))
    con = duckdb.connect()
    con.execute(f"SET threads = {threads}")
    for t in ("events", "part"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    times = {}
    t_all = time.time()
    t0 = time.time()
    for m in MODELS:   # dependency order; each model becomes a table
        con.execute(f"CREATE TABLE {m} AS {oracle.CTES[m]}")
    times["build_all_models"] = round(time.time() - t0, 3)
    for q in HEADLINE:
        t0 = time.time()
        sql = oracle.sql_for(registry.ORACLE_FINAL[q], existing=frozenset(MODELS))
        con.execute(sql).fetchall()
        times[q] = round(time.time() - t0, 3)
    print(json.dumps({"engine": "duckdb", "threads": threads, "value": round(time.time() - t_all, 3),
                      "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir)}))


if __name__ == "__main__":
    main()
