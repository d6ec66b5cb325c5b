"""Work of a task when landing tables and bucketed tables are made doesn't grow with the tables."""

from pyspark.sql import functions as F

from cartwheel.plans import registry
from cartwheel.sources import fixtures

SF = "/root/testdata/sf0.001"


def test_landing_rows_are_made_in_tasks_of_bounded_size(spark, monkeypatch):
    plain = fixtures.landing_tables(spark, SF)
    monkeypatch.setattr(fixtures, "EVENTS_A_TASK", 100)
    events = fixtures.read_table(spark, SF, "events").count()
    for whole, dealt, tasks in zip(plain, fixtures.landing_tables(spark, SF), (events // 100, events // 200)):
        sizes = [r[1] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) >= tasks and max(sizes) <= 400
        assert whole.exceptAll(dealt).isEmpty() and dealt.exceptAll(whole).isEmpty()


def test_buckets_follow_the_events():
    assert [registry._buckets(n) for n in (0, 1_000, 1_000_000, 1_000_001, 36_000_000)] == [8, 8, 8, 16, 288]


def test_models_are_written_as_zstd(spark):
    """Staged documents and hashes take a third fewer bytes than by the default codec."""
    import glob

    import pyarrow.parquet as pq
    from cartwheel.plans.warehouse import Warehouse
    wh = Warehouse(spark, SF)
    wh.payment_intents()
    for name in ("stg_payment_events", "payment_events_clean", "payment_intents"):
        files = [pq.ParquetFile(f).metadata for f in glob.glob(f"{wh.root.removeprefix('file:')}/{name}/*.parquet")]
        kinds = {m.row_group(g).column(c).compression for m in files for g in range(m.num_row_groups) for c in range(m.num_columns)}
        assert files and kinds == {"ZSTD"}


def own_events(spark):
    events = spark.range(2_000).select(
        F.col("id").alias("event_id"), F.timestamp_add("MINUTE", F.col("id") * 20, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).alias("ts"),
        (F.col("id") % 50).alias("user_id"), F.element_at(F.array(*[F.lit(t) for t in ("view", "click", "purchase")]), (F.col("id") % 3 + 1).cast("int")).alias("event_type"),
        (F.col("id") % 100 + 1.5).alias("value"), F.concat(F.lit('{"k": '), (F.col("id") % 10).cast("string"), F.lit("}")).alias("props"))
    part = spark.range(10).select(F.col("id").alias("p_partkey"), F.lit("b").alias("p_brand"), F.lit("t").alias("p_type"), F.lit(1).alias("p_size"))
    return events, part


def test_tasks_by_time_write_few_dates(spark):
    """Files of a table by date grow with the dates and the tasks, not with their product."""
    events, part = own_events(spark)
    for make, tasks in ((fixtures.clickstream_landing, 10), (fixtures.payments_landing, 5)):
        plain, timed = make(events, part, tasks), make(events, part, tasks, by_time=True)
        files = [df.select(F.spark_partition_id(), "dt").distinct().count() for df in (plain, timed)]
        assert files[1] * 2 < files[0], make.__name__
        sizes = [r[1] for r in timed.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == tasks and max(sizes) <= 2 * min(sizes)
        assert plain.exceptAll(timed).isEmpty() and timed.exceptAll(plain).isEmpty()
