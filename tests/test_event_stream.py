"""The event fact from a stream: late, repeated and replayed deliveries."""


import pytest
from pyspark.sql import functions as F

from cartwheel.operators import events, staging
from cartwheel.plans.run_state import PART, RunState
from cartwheel.session import new_run_id, scratch_path
from cartwheel.sources import fixtures, landing, schemas
from cartwheel.streaming import event_stream as S
from tests.test_incremental_state import delivery

SF = "/root/testdata/sf0.001"


def content(df):
    return sorted(repr(tuple(r)) for r in df.select(*events.EVENT_COLUMNS).collect())


def table(spark, rows):
    return spark.createDataFrame(rows, schemas.LANDING).withColumn("payload_hash", landing.fingerprint("raw_payload_json"))


def test_stream_equals_the_event_fact_with_late_and_replayed_batches(spark, monkeypatch):
    click = fixtures.landing_tables(spark, SF)[0].where("dt < '2024-01-25'")
    root = scratch_path(spark, "test_event_stream", new_run_id())
    bounds = [F.lit(c).cast("timestamp_ntz") for c in ("2024-01-08", "2024-01-16")]
    drops = [(F.col("ingested_at") >= bounds[0]) & (F.col("ingested_at") < bounds[1]), F.col("ingested_at") < bounds[0], F.col("ingested_at") >= bounds[1]]
    landed = click.where("false")
    for i, drop in enumerate(drops):  # the middle first: the second drop comes late
        landing.append_landing_table(click.where(drop), f"{root}/landing")
        landed = landed.unionByName(click.where(drop))
        if i == 1:  # the driver is lost after the tables are written, before the commit
            def lost(*args):
                raise RuntimeError("driver lost")
            with monkeypatch.context() as m:
                m.setattr(RunState, "commit", lost)
                with pytest.raises(Exception, match="driver lost"):
                    S.run_event_stream(spark, f"{root}/landing", f"{root}/out")
        fact = S.run_event_stream(spark, f"{root}/landing", f"{root}/out")
        assert content(fact) == content(events.fct_events(staging.stage_clickstream(landed)))
    # a micro-batch that comes again after its commit changes nothing
    before = RunState(spark, f"{root}/out/models")
    commits = f"{root}/out/checkpoint/commits"
    last = max(int(n) for n in before._names(commits) if n.isdigit())
    before._delete(f"{commits}/{last}")
    fact = S.run_event_stream(spark, f"{root}/landing", f"{root}/out")
    after = RunState(spark, f"{root}/out/models")
    assert after.batch == before.batch and after.marks == before.marks and content(fact) == content(before.read("fct_events"))


def test_a_payload_that_moves_to_another_event(spark):
    root = scratch_path(spark, "test_event_stream", new_run_id())
    drops = [[delivery("a", 1, "2024-01-01 10:00:00", "2024-01-02 00:00:00"), delivery("a", 2, "2024-01-03 10:00:00", "2024-01-02 00:00:01"),
              delivery("x", 3, "2024-01-01 11:00:00", "2024-01-02 00:00:02")],
             [delivery("b", 2, "2024-01-03 10:00:00", "2024-01-04 00:00:00")],
             [delivery("c", 2, "2024-01-03 10:00:00", "2024-01-03 00:00:00"), delivery("x", 4, "2024-01-09 11:00:00", "2024-01-05 00:00:00")]]
    want = [{("a", 2), ("x", 3)}, {("a", 1), ("b", 2), ("x", 3)}, {("a", 1), ("b", 2), ("x", 4)}]
    for rows, expected in zip(drops, want):
        landing.append_landing_table(table(spark, rows), f"{root}/landing")
        fact = S.run_event_stream(spark, f"{root}/landing", f"{root}/out", files_a_trigger=1)
        assert {(r["event_pk"], r["user_id"]) for r in fact.collect()} == expected
    everything = table(spark, [r for d in drops for r in d])
    assert content(fact) == content(events.fct_events(staging.stage_clickstream(everything)))
    # the last drop touched the dates of x (old and new) and the moved payload's
    store = RunState(spark, f"{root}/out/models")
    assert set(store.tables["fct_events"]["parts"]) == {"2024-01-01", "2024-01-03", "2024-01-09"}
