"""Incremental runs: ledger, touched dates, committed state."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cartwheel.operators import incremental as inc
from cartwheel.operators import staging
from cartwheel.plans.incremental_run import PARTS, IncrementalModels
from cartwheel.plans.run_state import PART, RunState, part_of
from cartwheel.plans.warehouse import Warehouse
from cartwheel.session import new_run_id, scratch_path
from cartwheel.sources import fixtures, landing, schemas

SF = "/root/testdata/sf0.001"
VOLATILE = {"updated_at", "load_id"}


def before(df, cut):
    return df if cut is None else df.where(F.col("ingested_at") < F.lit(cut).cast("timestamp_ntz"))


@pytest.fixture(scope="module")
def feeds(spark):
    """Two weeks of both landing tables, written once."""
    root, out = scratch_path(spark, "test_state", new_run_id()), []
    for name, df in zip(("click", "pay"), fixtures.landing_tables(spark, SF)):
        df.where("dt < '2024-01-15'").write.mode("overwrite").parquet(f"{root}/{name}")
        out.append(spark.read.parquet(f"{root}/{name}"))
    return out


@pytest.fixture(scope="module")
def full(spark, feeds):
    return Warehouse(spark, SF, landing=tuple(feeds))


def content(df, columns=None):
    columns = columns or sorted(c for c in df.columns if c not in VOLATILE and c not in ("object", PART))
    return sorted((repr(tuple(r)) for r in df.select(*columns).collect()))


def same(df, other):
    columns = sorted(set(df.columns) & set(other.columns) - VOLATILE - {"object", PART})
    return content(df, columns) == content(other, columns)


MODELS = [m for m in PARTS if not m.startswith("stg_")]


def test_stopped_run_resumes_in_a_new_session(spark, feeds, full, monkeypatch):
    click, pay = feeds
    root = scratch_path(spark, "test_state", new_run_id())
    IncrementalModels(spark, root=root).run(before(click, "2024-01-05"), before(pay, "2024-01-05"))
    first = {m: content(t) for m, t in IncrementalModels(spark, root=root).state.items() if m in ("fct_events", "dim_users")}

    stopped = IncrementalModels(spark, root=root)
    assert stopped.batch == 1

    def lost(*args):
        raise RuntimeError("driver lost")
    with monkeypatch.context() as m:
        m.setattr(IncrementalModels, "_user_facts", lost)  # after events, payments and attribution of the batch are written
        with pytest.raises(RuntimeError, match="driver lost"):
            stopped.run(before(click, "2024-01-10"), before(pay, "2024-01-10"))

    again = IncrementalModels(spark.newSession(), root=root)
    assert again.batch == 1
    assert {m: content(again.state[m]) for m in first} == first  # nothing of the lost batch shows
    again.run(before(click, "2024-01-10"), before(pay, "2024-01-10"))
    last = IncrementalModels(spark.newSession(), root=root)
    last.run(click, pay)
    assert last.batch == 3
    for model in MODELS:
        assert same(last.state[model], getattr(full, model)()), model
    # the ledger holds what staging everything at once gives
    staged = staging.stage_clickstream(click)
    assert same(last.state["stg_clickstream_events"], staged)
    assert same(last.state["stg_payment_events"], full.stg_payment_events())


def test_a_batch_writes_only_the_dates_it_touches(spark, feeds):
    click, pay = feeds
    im = IncrementalModels(spark)
    im.run(before(click, "2024-01-10"), before(pay, "2024-01-10"))
    old = {m: dict(im.store.tables[m]["parts"]) for m in PARTS}
    old_rows = {m: im.state[m] for m in ("fct_events", "fct_payments", "fct_sessions")}
    old_content = {m: {p: content(im.store.read(m, [p])) for p in old[m]} for m in old_rows}
    im.run(before(click, "2024-01-11"), before(pay, "2024-01-11"))
    for model in old_rows:
        now = im.store.tables[model]["parts"]
        written = {p for p, b in now.items() if b == 2}
        assert set(im.store._names(f"{im.store.root}/tables/{model}/batch=2")) - {"_SUCCESS"} == {f"part={p}" for p in written}
        changed = {p for p in set(now) | set(old_content[model])
                   if p not in now or content(im.store.read(model, [p])) != old_content[model].get(p)}
        assert changed <= written | (set(old[model]) - set(now)), model
        assert 0 < len(written) < len(now), model
        assert {p: b for p, b in now.items() if p not in written} == {p: 1 for p in now if p not in written}
    # a batch without anything new writes no date of any fact
    before_third = {m: dict(im.store.tables[m]["parts"]) for m in PARTS}
    im.run(before(click, "2024-01-11"), before(pay, "2024-01-11"))
    assert im.batch == 3
    assert {m: dict(im.store.tables[m]["parts"]) for m in PARTS} == before_third


def test_staging_a_batch_reads_the_look_back_and_its_dates_alone(spark, feeds):
    click, _ = feeds
    im = IncrementalModels(spark)
    im.store.begin()
    mark, _, _ = im._stage("stg_clickstream_events", before(click, "2024-01-10"), "m", staging.stage_clickstream)
    im.store.commit({"m": mark})
    im.store.begin()
    read = []
    plain = im.store.read
    im.store.read = lambda table, parts=None: read.append(parts) or plain(table, parts)
    _, changed, prior = im._stage("stg_clickstream_events", before(click, "2024-01-11"), "m", staging.stage_clickstream)
    bound = dt.datetime.fromisoformat(mark) - dt.timedelta(days=im.lookback_days)
    slice_ = click.where(F.col("ingested_at").between(F.lit(bound).cast("timestamp_ntz"), F.lit("2024-01-10 23:59:59.999999").cast("timestamp_ntz")))
    dates = {r[0] for r in staging.stage_clickstream(slice_).select(part_of(F.col("event_ts"))).distinct().collect()}
    # the written ledger is read back whole (lazily) as the result; all reads for the work name their dates
    asked = [set(p) for p in read if p is not None]
    assert asked and all(p <= dates for p in asked)
    new = click.where(F.col("ingested_at") >= F.lit("2024-01-10").cast("timestamp_ntz")).where("ingested_at < '2024-01-11'")
    assert changed.select("payload_hash").distinct().count() == new.select("payload_hash").distinct().count()
    assert prior.join(changed, "payload_hash", "left_anti").count() == 0


def delivery(event_id, user, at, ingested, filename="f1", kind="view", payload_more=""):
    payload = (f'{{"user_id":"{user}","user_session":"s{user}","event_time":"{at}","event_type":"{kind}","product_id":"p1",'
               f'"category_id":"1","category_code":"c","brand":"b","price":"1.0"{payload_more}}}')
    return (event_id, f'{{"event_id":"{event_id}"}}', "{}", payload, dt.date(2024, 1, 1), filename, "L",
            dt.datetime.fromisoformat(ingested), None)


def test_a_payload_delivered_again_under_another_event_id(spark, feeds):
    """The earlier delivery's event goes; the event that it hid comes back."""
    rows = [delivery("a", 1, "2024-01-01 10:00:00", "2024-01-02 00:00:00"),
            delivery("a", 2, "2024-01-03 10:00:00", "2024-01-02 00:00:01"),           # hides the first: received later
            delivery("x", 3, "2024-01-01 11:00:00", "2024-01-02 00:00:02")]
    later = [delivery("b", 2, "2024-01-03 10:00:00", "2024-01-04 00:00:00"),          # the second payload again, under b
             delivery("x", 3, "2024-01-01 11:00:00", "2024-01-04 00:00:01", "f2")]    # the third again, unchanged but for the file
    pay = feeds[1].limit(0)

    def table(some):
        df = spark.createDataFrame(some, schemas.LANDING)
        return df.withColumn("payload_hash", landing.fingerprint("raw_payload_json"))
    im = IncrementalModels(spark)
    im.run(table(rows), pay)
    assert {(r["event_pk"], r["user_id"]) for r in im.state["fct_events"].collect()} == {("a", 2), ("x", 3)}
    im.run(table(rows + later), pay)
    assert {(r["event_pk"], r["user_id"], r["filename"]) for r in im.state["fct_events"].collect()} == {("a", 1, "f1"), ("b", 2, "f1"), ("x", 3, "f2")}
    whole = Warehouse(spark, SF, landing=(table(rows + later), pay), materialise=False)
    for model in ("fct_events", "sessions_base", "fct_sessions", "fct_product_daily_activity", "dim_users", "dim_products", "fct_payments"):
        assert same(im.state[model], getattr(whole, model)()), model


def test_merge_equals_upsert_where_keys_move(spark):
    rng = random.Random(5)
    schema, state, root = "k long, d date, v long", None, scratch_path(spark, "test_state", new_run_id())
    store = RunState(spark, root)
    for batch in range(3):
        store.begin()
        rows = [(rng.choice([None, *range(12)]), rng.choice([None, *(dt.date(2024, 1, d) for d in range(1, 6))]), batch * 100 + i) for i in range(10)]
        rebuilt = spark.createDataFrame(rows, schema)
        touched = spark.createDataFrame([(k,) for k in {r[0] for r in rows} | {rng.randrange(12)}], "k long")
        state = inc.upsert(state, rebuilt, ["k"], touched=touched if state is not None else None)
        state = spark.createDataFrame(state.collect(), schema)
        store.merge("t", rebuilt, ["k"], F.col("d"), touched if batch else None)
        assert content(store.read("t").drop(PART)) == content(state)
        store.commit({"seen": str(batch)})
    assert content(RunState(spark, root).read("t").drop(PART)) == content(state)
    assert RunState(spark, root).marks == {"seen": "2"}


def test_commit_is_one_step_and_taken_once(spark):
    root = scratch_path(spark, "test_state", new_run_id())
    one = RunState(spark, root)
    one.begin()
    rows = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], f"v long, {PART} string")
    one.replace("t", rows)
    other = RunState(spark, root)
    assert other.batch == 0 and other.read("t") is None
    one.commit()
    with pytest.raises(RuntimeError, match="another run"):
        other.commit()
    # a part without rows goes; untouched parts stay where they are
    one.begin()
    one.replace("t", rows.where("v = 3"), ["2024-01-01"])
    with pytest.raises(ValueError):
        one.replace("t", rows, ["2024-01-02"])
    one.begin()
    one.replace("t", rows.where("v = 3"), ["2024-01-01"])
    one.commit()
    held = RunState(spark, root)
    assert held.tables["t"]["parts"] == {"2024-01-02": 1} and [r["v"] for r in held.read("t").collect()] == [2]
    assert held._names(f"{root}/tables/t") == ["batch=1"] and set(held._names(f"{root}/tables/t/batch=1")) - {"_SUCCESS"} == {"part=2024-01-02"}


def test_signed_changes_keep_the_sums_and_drop_empty_days(spark):
    from cartwheel.operators import activity
    rng, cols = random.Random(6), "user_id long, activity_date date, " + ", ".join(f"{m} long" for m in [*activity.USER_MEASURES, activity.SOURCE_ROWS])

    def some(n):
        return [(rng.choice([None, 1, 2, 3]), rng.choice([None, dt.date(2024, 1, 1), dt.date(2024, 1, 2)]),
                 *(rng.randrange(5) for _ in activity.USER_MEASURES), 1) for _ in range(n)]
    kept, gone, new = some(6), some(5), some(4)
    gone += [(9, dt.date(2024, 1, 3), 1, 1, 0, 0, 0, 1)]  # a day whose only row goes
    frame = lambda rows: spark.createDataFrame(rows, cols)
    stored = activity.user_days(frame(kept + gone), True)
    changed = activity.user_days(activity.signed_change(stored, frame(new), frame(gone), activity.USER_DAY, activity.USER_MEASURES), True)
    assert same(changed, activity.user_days(frame(kept + new), True))
    assert same(activity.user_days(activity.signed_change(stored, frame(new), None, activity.USER_DAY, activity.USER_MEASURES), True),
                activity.user_days(frame(kept + gone + new), True))


def test_a_run_broadcasts_by_measured_size_alone(spark, feeds):
    """What file sizes say of a pruned table isn't what the driver would hold."""
    click, pay = feeds
    keys = [c for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")]
    seen, before_run = [], [spark.conf.get(k, None) for k in keys]
    models = IncrementalModels(spark, root=scratch_path(spark, "test_state", new_run_id()))
    scratch = models.store.scratch

    def spy(name, rows):
        seen.append([spark.conf.get(k) for k in keys])
        return scratch(name, rows)

    models.store.scratch = spy
    models.run(before(click, "2024-01-05"), before(pay, "2024-01-05"))
    models.run(before(click, "2024-01-06"), before(pay, "2024-01-06"))
    assert seen and {tuple(s) for s in seen} == {("-1", "1m")}
    assert [spark.conf.get(k, None) for k in keys] == before_run


def test_a_run_without_candidates_maps_every_payment(spark, feeds, monkeypatch):
    """The best matches come from the sweep: a batch makes no pair of a payment and a click."""
    from cartwheel.operators import matching

    def pairs(*args, **kwargs):
        raise AssertionError("candidates were built")

    click, pay = feeds
    root = scratch_path(spark, "test_state", new_run_id())
    with monkeypatch.context() as m:
        m.setattr(matching, "match_candidates", pairs)
        models = IncrementalModels(spark, root=root, candidates=False)
        for cut in ("2024-01-05", "2024-01-07"):
            models.run(before(click, cut), before(pay, cut))
    assert "payment_event_candidates" not in models.state
    wh = Warehouse(spark, SF, landing=(before(click, "2024-01-07"), before(pay, "2024-01-07")))
    for name in ("map_payment_to_event", "map_payment_to_session", "fct_sessions"):
        assert same(models.state[name], getattr(wh, name)()), name
    with pytest.raises(ValueError, match="without the candidates"):
        IncrementalModels(spark, root=root)


def zstd_only(root, *below):
    import glob

    import pyarrow.parquet as pq
    files = [pq.ParquetFile(f).metadata for f in glob.glob("/".join([root.removeprefix("file:"), *below]), recursive=True)]
    assert files
    return {m.row_group(g).column(c).compression for m in files for g in range(m.num_row_groups) for c in range(m.num_columns)} == {"ZSTD"}


def test_shuffles_of_a_run_open_no_file_for_each_partition_and_go_with_their_job(spark, monkeypatch):
    from cartwheel.plans import incremental_run
    wanted = []
    for own in (4, 200, 201, 600):
        monkeypatch.setattr(spark.conf, "get", lambda key, default=None, own=own: str(own) if key == "spark.sql.shuffle.partitions" else default)
        wanted.append(incremental_run._initial_partitions(spark))
    monkeypatch.undo()
    assert wanted == [4, 201, 201, 600]
    empty, seen = spark.createDataFrame([], schemas.LANDING).withColumn("payload_hash", landing.fingerprint("raw_payload_json")), []
    im = IncrementalModels(spark)
    replace = im.store.replace
    im.store.replace = lambda *a, **k: seen.append(spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")) or replace(*a, **k)
    row = spark.createDataFrame([delivery("a", 1, "2024-01-01 10:00:00", "2024-01-02 00:00:00")], schemas.LANDING).withColumn(
        "payload_hash", landing.fingerprint("raw_payload_json"))
    im.run(row, empty)
    assert seen and set(seen) == {"true"}
    assert zstd_only(im.store.root, "tables", "**", "*.parquet")


def test_landing_tables_are_written_as_zstd(spark):
    root = scratch_path(spark, "test_state", new_run_id())
    landing.append_landing_table(spark.createDataFrame([delivery("a", 1, "2024-01-01 10:00:00", "2024-01-02 00:00:00")], schemas.LANDING), root)
    assert zstd_only(root, "**", "*.parquet")


def test_rows_of_parts_that_a_batch_made_are_not_looked_up(spark, monkeypatch):
    store, schema = RunState(spark, scratch_path(spark, "test_state", new_run_id())), f"k long, v long, {PART} string"
    frame = lambda rows: spark.createDataFrame(rows, schema)
    store.begin()
    store.replace("t", frame([(1, 1, "a"), (2, 2, "a"), (3, 3, "b"), (None, 4, "b")]))
    assert store.born("t") == {"a", "b"}
    store.commit()
    store.begin()
    store.replace("t", frame([(1, 1, "a"), (2, 5, "a"), (2, 6, "c"), (7, 7, "c"), (None, 8, "c")]), ["a", "c"])
    assert store.born("t") == {"c"}
    keys, asked, located = spark.createDataFrame([(2,), (7,)], "k long"), [], store.located
    monkeypatch.setattr(store, "located", lambda table, k, on, parts=None, distinct=True: asked.append(parts) or located(table, k, on, parts, distinct))
    want = [(2, 5, "a"), (2, 6, "c"), (7, 7, "c")]
    assert content(store.rows_of("t", keys, ["k"], distinct=False, born=True, nulls=False), ["k", "v", PART]) == sorted(map(repr, want))
    assert content(store.rows_of("t", keys, ["k"]), ["k", "v", PART]) == sorted(map(repr, want))
    assert asked == [{"a", "b"}, None]
    with_null = spark.createDataFrame([(2,), (7,), (None,)], "k long")
    assert content(store.rows_of("t", with_null, ["k"], born=True), ["k", "v", PART]) == content(store.rows_of("t", with_null, ["k"]), ["k", "v", PART])


def test_merge_within_known_parts_writes_the_rows_once(spark):
    rng = random.Random(7)
    schema, state, store = "k long, d date, v long", None, RunState(spark, scratch_path(spark, "test_state", new_run_id()))
    scratched, scratch = [], store.scratch
    store.scratch = lambda name, rows: scratched.append(name) or scratch(name, rows)
    days = [dt.date(2024, 1, d) for d in range(1, 6)]
    for batch in range(3):
        store.begin()
        rows = [(rng.choice([None, *range(12)]), rng.choice(days), batch * 100 + i) for i in range(10)]
        rebuilt = spark.createDataFrame(rows, schema)
        touched = spark.createDataFrame([(k,) for k in {r[0] for r in rows} | {rng.randrange(12)}], "k long")
        state = inc.upsert(state, rebuilt, ["k"], touched=touched if batch else None)
        state = spark.createDataFrame(state.collect(), schema)
        store.merge("t", rebuilt, ["k"], F.col("d"), touched if batch else None, keep_old=False, within={str(d) for d in days} if batch else None)
        assert content(store.read("t").drop(PART)) == content(state)
        store.commit()
    assert scratched == []


def test_only_what_may_be_in_the_ledger_meets_it(spark, feeds):
    """Deliveries for dates that the ledger hasn't join nothing; the look-back's rows still do."""
    table = lambda rows: spark.createDataFrame(rows, schemas.LANDING).withColumn("payload_hash", landing.fingerprint("raw_payload_json"))
    old = [delivery("a", 1, "2024-01-01 10:00:00", "2024-01-02 00:00:00"), delivery("b", 2, "2024-01-01 11:00:00", "2024-01-02 00:00:01")]
    late = [delivery("b", 2, "2024-01-01 11:00:00", "2024-01-03 00:00:00"), delivery("c", 3, "2024-01-03 10:00:00", "2024-01-03 00:00:01"),
            delivery("d", None, "no time", "2024-01-03 00:00:02")]
    im = IncrementalModels(spark)
    im.run(table(old), feeds[1].limit(0))
    gone, forget = [], im.store.forget
    im.store.forget = lambda name: gone.append(name) or forget(name)
    im.run(table(old + late), feeds[1].limit(0))
    assert "stg_clickstream_events-slice" in gone
    assert same(im.state["stg_clickstream_events"], staging.stage_clickstream(table(old + late)))
    assert {(r.event_id, r.ingested_at.day) for r in im.state["stg_clickstream_events"].collect()} == {("a", 2), ("b", 3), ("c", 3), ("d", 3)}
