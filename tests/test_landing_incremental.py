import datetime as dt

from pyspark.sql import functions as F

from cartwheel.operators import incremental as inc
from cartwheel.session import new_run_id, scratch_path
from cartwheel.sources import fixtures, landing

SF = "/root/testdata/sf0.001"


def test_jsonl_round_trip_and_idempotent_landing(spark):
    click, _ = fixtures.landing_tables(spark, SF)
    path = scratch_path(spark, "test_landing", "click")
    landing.write_jsonl(landing.envelope_lines(click), path)
    raw = landing.read_clickstream(spark, f"{path}/dt=*/part-*")
    first = landing.land(raw, load_id="L1", now=dt.datetime(2024, 2, 1))
    assert first.count() == click.count()                       # in-load duplicates kept (T6)
    assert first.select("payload_hash").distinct().count() == click.select("payload_hash").distinct().count()
    # dt comes from the folder name
    assert first.where(F.col("dt").isNull()).count() == 0
    assert (first.join(click.select("event_id", "dt"), ["event_id", "dt"], "left_anti").count() == 0)
    # a second load of the same files appends nothing
    again = landing.land(raw, target=first, load_id="L2")
    assert again.count() == 0


def test_payments_feed_unions_refunds(spark):
    _, pay = fixtures.landing_tables(spark, SF)
    path = scratch_path(spark, "test_landing", "pay")
    is_refund = F.col("filename").contains("/refunds/")
    landing.write_jsonl(landing.envelope_lines(pay.where(~is_refund)), f"{path}/main")
    landing.write_jsonl(landing.envelope_lines(pay.where(is_refund)), f"{path}/refunds")
    raw = landing.read_payments(spark, f"{path}/main/dt=*/part-*", f"{path}/refunds/dt=*/part-*")
    assert raw.count() == pay.count()
    assert raw.where(F.col("event_id").startswith("evt_re_")).count() == \
        pay.where(F.col("event_id").startswith("evt_re_")).count()


def test_upsert_replaces_all_rows_of_touched_keys_and_syncs_columns(spark):
    target = spark.createDataFrame([(1, "a", "old"), (1, "b", "old"), (2, "c", "old"),
                                    (None, "n", "old")], "k long, v string, extra string")
    source = spark.createDataFrame([(1, "z"), (None, "m"), (3, "w")], "k long, v string")
    out = sorted((tuple(r) for r in inc.upsert(target, source, ["k"]).collect()), key=lambda t: str(t))
    # All rows of key 1 replaced; NULL key matches NULL; columns follow the source
    assert out == sorted([(2, "c"), (1, "z"), (None, "m"), (3, "w")], key=lambda t: str(t))
    kept = inc.upsert(target, source, ["k"], sync_columns=False)
    assert "extra" in kept.columns


def test_lookback_inclusive_vs_exclusive(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 7),), (dt.datetime(2024, 1, 8),)],
                               "ts timestamp_ntz")
    wm = inc.high_watermark(df, "ts")
    assert inc.lookback(df, "ts", wm, days=1, inclusive=True).count() == 2
    assert inc.lookback(df, "ts", wm, days=1, inclusive=False).count() == 1
    assert inc.high_watermark(None, "ts") == inc.EPOCH_FLOOR
    # the bound is a literal, so it reaches the scan
    path = scratch_path(spark, "test_lookback")
    df.write.mode("overwrite").parquet(path)
    plan = inc.lookback(spark.read.parquet(path), "ts", wm, 1)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in plan


def test_streaming_landing_is_idempotent(spark):
    from cartwheel.streaming.landing_stream import landing_stream, run_landing_stream
    click, _ = fixtures.landing_tables(spark, SF)
    src = scratch_path(spark, "test_stream", "src")
    landing.write_jsonl(landing.envelope_lines(click), src)
    root = scratch_path(spark, "test_stream", "out")
    table = run_landing_stream(spark, src, root)
    n = table.count()
    assert n == click.select("payload_hash").distinct().count()   # one row per payload
    assert table.where(F.col("dt").isNull() | F.col("filename").isNull()).count() == 0
    # a second stream with a fresh checkpoint re-reads every file and appends nothing
    q = landing_stream(spark, src, f"{root}/table", f"{root}/checkpoint2")
    q.awaitTermination()
    assert landing.read_landing_table(spark, f"{root}/table").count() == n


def test_composite_key_upsert_daily_rows(spark):
    """(user_id, activity_date) merge; a NULL user row is replaced, not duplicated."""
    target = spark.createDataFrame(
        [(1, dt.date(2024, 1, 1), 1), (1, dt.date(2024, 1, 2), 1), (None, dt.date(2024, 1, 2), 0)],
        "user_id long, activity_date date, sessions_count long")
    source = spark.createDataFrame(
        [(1, dt.date(2024, 1, 2), 3), (None, dt.date(2024, 1, 2), 0), (2, dt.date(2024, 1, 2), 1)],
        "user_id long, activity_date date, sessions_count long")
    out = {(r.user_id, r.activity_date): r.sessions_count
           for r in inc.upsert(target, source, ["user_id", "activity_date"]).collect()}
    assert out == {(1, dt.date(2024, 1, 1)): 1, (1, dt.date(2024, 1, 2)): 3,
                   (None, dt.date(2024, 1, 2)): 0, (2, dt.date(2024, 1, 2)): 1}
    assert inc.upsert(target, source, ["user_id", "activity_date"]).count() == 4


def test_models_as_sql_views(spark):
    from cartwheel.plans.warehouse import Warehouse
    wh = Warehouse(spark, SF, materialise=False)
    names = wh.register_views(prefix="t_")
    assert "t_fct_payments" in names
    got = spark.sql("""
        SELECT s.session_date, count(*) AS n
        FROM t_fct_sessions s JOIN t_map_payment_to_session m ON m.session_id = s.session_id
        GROUP BY 1""").collect()
    want = (wh.map_payment_to_session().where("session_id IS NOT NULL")
            .join(wh.fct_sessions(), "session_id").count())
    assert sum(r.n for r in got) == want


def test_staged_clicks_are_a_view(spark):
    from cartwheel.plans.warehouse import Warehouse
    wh = Warehouse(spark, SF, materialise=False)
    assert "u_stg_clickstream_events" in wh.register_views(prefix="u_")
    assert spark.sql("SELECT count(*) AS n FROM u_stg_clickstream_events").first().n == wh.stg_clickstream_events().count() > 0


def test_declared_sources_read_the_landing_table(spark):
    click, _ = fixtures.landing_tables(spark, SF)
    root = scratch_path(spark, "test_sources")
    landing.append_landing_table(click, f"{root}/clickstream")
    df = landing.load_source(spark, "landing.clickstream_events_raw", root)
    assert df.count() == click.count()
    assert df.where("dt = DATE '2024-01-05'").count() == click.where("dt = DATE '2024-01-05'").count()


def test_landing_keeps_new_payloads_with_all_their_copies(spark):
    base = spark.createDataFrame(
        [(f"e{i % 3}", "{}", "{}", '{"p":%d}' % (i % 3), dt.date(2024, 1, 1), f"f{i}")
         for i in range(30)],
        "event_id string, metadata_json string, keys_json string, raw_payload_json string, "
        "dt date, filename string")
    target = landing.land(base.where("raw_payload_json = '{\"p\":0}'").limit(1), load_id="L0")
    landed = landing.land(base, target=target, load_id="L1")
    assert sorted(r.event_id for r in landed.collect()) == ["e1"] * 10 + ["e2"] * 10


def test_land_scans_the_load_and_the_target_once(spark):
    click, _ = fixtures.landing_tables(spark, SF)
    root = scratch_path(spark, "test_land_scans")
    landing.append_landing_table(click, f"{root}/target")
    feed = click.select("event_id", "metadata_json", "keys_json", "raw_payload_json", "dt", "filename")
    feed.write.mode("overwrite").parquet(f"{root}/feed")
    plan = landing.land(spark.read.parquet(f"{root}/feed"), landing.read_landing_table(spark, f"{root}/target"))
    assert plan._jdf.queryExecution().executedPlan().toString().count("FileScan") == 2


def test_streaming_lands_payloads_that_come_late(spark):
    from cartwheel.streaming.landing_stream import run_landing_stream
    click, _ = fixtures.landing_tables(spark, SF)
    root = scratch_path(spark, "test_stream_late")
    for part in ("ingested_at >= timestamp_ntz'2024-02-01'", "ingested_at < timestamp_ntz'2024-01-10'",
                 "ingested_at between timestamp_ntz'2024-01-10' and timestamp_ntz'2024-02-01'"):
        landing.write_jsonl(landing.envelope_lines(click.where(part)), f"{root}/src", mode="append")
        table = run_landing_stream(spark, f"{root}/src", f"{root}/out")
    want = sorted(r[0] for r in click.select("payload_hash").distinct().collect())
    assert sorted(r[0] for r in table.select("payload_hash").collect()) == want


def test_a_cluster_needs_a_shared_folder():
    import pytest
    from cartwheel import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError):
        session.checkpoint_root(Session())


def test_refresh_sees_changed_data(spark):
    from cartwheel.plans.warehouse import refresh, warehouse_for
    root = scratch_path(spark, "test_refresh_data")
    for name in ("events", "part"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.mode("overwrite").parquet(f"{root}/{name}.parquet")
    before = warehouse_for(spark, root).fct_events().count()
    few = spark.read.parquet(f"{SF}/events.parquet").where("event_id < 100")
    few.write.mode("overwrite").parquet(f"{root}/events.parquet")
    assert warehouse_for(spark, root).fct_events().count() == before
    refresh(spark, root)
    assert warehouse_for(spark, root).fct_events().count() == few.count() < before


LINES = ['{"metadata":{"event_id":"a"},"keys":{"k":1},"raw_payload":{"p":1}}', '{"metadata":{"event_id":"b"},"keys":{}', "no json", "",
         '{"metadata":{"event_id":"c"},"keys":{}}', '{"metadata":{"event_id":"d"},"keys":{},"raw_payload":null}', '[1', "5",
         '{"metadata":{"event_id":"a2"},"keys":{},"raw_payload":{"p":1}}', "no json"]


def _feed(spark, path, lines, date="2024-01-05", mode="append"):
    landing.write_jsonl(spark.createDataFrame([(x, dt.date.fromisoformat(date)) for x in lines], "value string, dt date").coalesce(1), path, mode=mode)


def test_unreadable_lines_land_once_in_quarantine(spark):
    root = scratch_path(spark, "test_quarantine", new_run_id())
    _feed(spark, f"{root}/src", LINES)
    table = landing.LandingTable(spark, f"{root}/table")
    bad = {'{"metadata":{"event_id":"b"},"keys":{}', "no json", "[1", "5"}
    for load in ("L1", "L2", "L3"):
        table.load(landing.feed_lines(spark.read.text(f"{root}/src")), *landing.CLICK_ID, load_id=load)
        rejects = table.rejects().collect()
        assert sorted(r["line"] for r in rejects) == sorted(bad) and {r["load_id"] for r in rejects} == {"L1"}
        assert all(r["filename"] and r["dt"] == dt.date(2024, 1, 5) for r in rejects)
        # readable rows: both copies of the payload once, rows without a payload with every delivery
        ids = sorted(r["event_id"] for r in table.rows().collect())
        assert ids == sorted(["a", "a2"] + ["c", "d"] * int(load[1]))
    assert {r["line"] for r in landing.read_quarantined(spark, f"{root}/src").collect()} == bad
    assert landing.read_clickstream(spark, f"{root}/src").count() == 4


def test_batch_and_stream_agree_on_null_and_unreadable_lines(spark):
    from cartwheel.streaming.landing_stream import read_stream_rejects, run_landing_stream
    root = scratch_path(spark, "test_lanes", new_run_id())
    table = landing.LandingTable(spark, f"{root}/batch")
    for day, lines in (("2024-01-05", LINES), ("2024-01-06", LINES[:5] + ["late [", '{"metadata":{"event_id":"e"},"raw_payload":{"p":2}}'])):
        _feed(spark, f"{root}/src", lines, day)
        table.load(landing.feed_lines(spark.read.text(f"{root}/src/dt={day}")), *landing.CLICK_ID)
        streamed = run_landing_stream(spark, f"{root}/src", f"{root}/stream")
        batch = table.rows()
        assert sorted(r[0] for r in streamed.select("payload_hash").dropna().collect()) == sorted(
            r[0] for r in batch.select("payload_hash").dropna().distinct().collect())
        without = lambda df: sorted((r["event_id"], str(r["dt"])) for r in df.where("payload_hash is null").collect())
        assert without(streamed) == without(batch)
        rejects = read_stream_rejects(spark, f"{root}/stream/rejects")
        assert sorted(r["line"] for r in rejects.collect()) == sorted(r["line"] for r in table.rejects().collect())


def test_payload_filters_miss_nothing_and_spare_the_stored_hashes(spark):
    from cartwheel.sources import payload_filter
    click, _ = fixtures.landing_tables(spark, SF)
    root = scratch_path(spark, "test_filters", new_run_id())
    feed = click.select("event_id", "metadata_json", "keys_json", "raw_payload_json", "dt", "filename")
    feed.write.parquet(f"{root}/feed")
    feed = spark.read.parquet(f"{root}/feed")
    first, rest = feed.where("dt < '2024-01-15'"), feed.where("dt >= '2024-01-15'")
    landed = landing.land(first, load_id="L1")
    landing.append_landing_table(landed, f"{root}/rows")
    target = landing.read_landing_table(spark, f"{root}/rows")
    payload_filter.build(landed, "L1").write.parquet(f"{root}/filters")
    filters = spark.read.schema(payload_filter.SCHEMA).parquet(f"{root}/filters")
    stored = {(r[0], r[1]) for r in landed.select("payload_hash", "dt").distinct().collect()}
    hits = {(r[0], r[1]) for r in payload_filter.possible(landed.select("payload_hash").distinct(), filters).collect()}
    assert stored <= hits
    strange = spark.range(20_000).select(F.sha2(F.col("id").cast("string"), 256).alias("payload_hash"))
    folders = filters.select("dt").distinct().count()
    assert payload_filter.possible(strange, filters).count() <= 0.002 * 20_000 * folders
    # exact, with and without filters
    for part in (first, rest, feed):
        plain, filtered = (landing.land(part, target, load_id="L2", filters=f) for f in (None, filters))
        assert sorted(r[0] for r in plain.select("event_id").collect()) == sorted(r[0] for r in filtered.select("event_id").collect())
    # a load of new payloads has no scan of the landing table in its plan (and a filter takes a tenth of the hashes' bytes)
    new = feed.withColumn("raw_payload_json", F.concat(F.lit('{"other":'), "raw_payload_json", F.lit("}"))).limit(20)
    new.write.parquet(f"{root}/new")
    plan = landing.land(spark.read.parquet(f"{root}/new"), target, filters=filters)._jdf.queryExecution().executedPlan().toString()
    assert f"{root}/rows" not in plan and plan.count("FileScan") == 1
    bits = filters.agg(F.sum(F.lit(8 * (payload_filter.WORDS + 1)))).first()[0]
    assert bits <= max(64 * len(stored) / 4, 40 * folders * 4)
    assert payload_filter.possible(strange, filters.limit(0)).count() == 0
