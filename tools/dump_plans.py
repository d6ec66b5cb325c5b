"""Write the formatted physical plan of the headline jobs to docs/plans/.

Usage: python tools/dump_plans.py [sf_dir]. Shared models are materialised
first, as in a normal build, so each plan is the job that actually runs: it
starts at the written upstream tables (see ReadSchema / PushedFilters).
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cartwheel.plans.warehouse import Warehouse  # noqa: E402
from cartwheel.session import local_session  # noqa: E402

JOBS = ["fct_events", "fct_payments", "payment_event_candidates", "map_payment_to_event",
        "sessions_base", "fct_user_daily_activity", "dim_products", "dau_wau_mau",
        "repeat_retention_cohorts", "session_funnel_daily"]


def _producing_job(wh: Warehouse, name: str):
    """The model's defining job over its (materialised) inputs."""
    from cartwheel.operators import activity, events, matching, payments, sessions, staging
    build = {
        "fct_events": lambda: events.fct_events(staging.stage_clickstream(wh.landing_clickstream())),
        "fct_payments": lambda: payments.fct_payments(wh.payment_intents(), wh.charges(),
                                                      wh.refunds()),
        "payment_event_candidates": lambda: matching.match_candidates(
            wh.fct_payments(), wh.fct_events(), wh.match_window_minutes),
        "map_payment_to_event": lambda: matching.map_payment_to_event(
            wh.payment_event_candidates()),
        "sessions_base": lambda: sessions.sessions_base(wh.fct_events()),
        "fct_user_daily_activity": lambda: activity.fct_user_daily_activity(
            wh.fct_sessions(), wh.fct_payments()),
    }
    return build[name]()


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    out_dir = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                           "docs", "plans")
    os.makedirs(out_dir, exist_ok=True)
    spark = local_session()
    wh = Warehouse(spark, sf_dir)
    # the test data would fit in broadcasts; show the joins that large tables get
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    for name in JOBS:
        df = getattr(wh, name)()
        if name in ("fct_events", "fct_payments", "payment_event_candidates",
                    "map_payment_to_event", "sessions_base", "fct_user_daily_activity"):
            # a materialised model: show the job that produced it
            df = _producing_job(wh, name)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        text = buf.getvalue().replace(wh.root, "<scratch>")
        with open(os.path.join(out_dir, f"{name}.txt"), "w") as fh:
            fh.write(text)
        print(name, len(text.splitlines()), "lines")


if __name__ == "__main__":
    main()
