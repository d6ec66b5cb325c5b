"""Bitmaps of active users: numbers, windows, retention, and days added later."""

import datetime as dt
import random

from cartwheel.operators import activity_bitmaps as B
from cartwheel.operators import metrics

DAILY = "user_id long, activity_date date, is_active boolean"
USERS = "user_id long, first_seen_date date"


def tables(spark, seed, users=60, days=50):
    rnd, rows, first = random.Random(seed), [], {}
    for u in [*range(users), None]:
        for day in rnd.sample(range(days), rnd.randint(0, 8)):
            date = dt.date(2024, 1, 1) + dt.timedelta(days=day)
            active = rnd.random() < 0.9
            rows.append((u, date, active))
            if u not in first or date < first[u]:
                first[u] = date
    return spark.createDataFrame(rows, DAILY), spark.createDataFrame(list(first.items()) + [(10 ** 12, None)], USERS)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_equal_the_metrics_and_grow_by_days(spark):
    for seed in (1, 2):
        daily, users = tables(spark, seed)
        cut = dt.date(2024, 1, 30)
        old_days, new_days = daily.where(f"activity_date < DATE'{cut}'"), daily.where(f"activity_date >= DATE'{cut}'")
        old_users = users.where(f"first_seen_date < DATE'{cut}'")
        numbers = B.number_users(old_users)
        bitmaps = B.day_bitmaps(old_days, numbers)
        assert sorted(r["number"] for r in numbers.collect()) == list(range(old_users.where("user_id IS NOT NULL").count()))
        assert rows(B.dau_wau_mau(bitmaps)) == rows(metrics.dau_wau_mau(old_days))
        grown, more = B.extend(bitmaps, numbers, new_days, users)
        held = {r["user_id"]: r["number"] for r in numbers.collect()}
        found = {r["user_id"]: r["number"] for r in more.collect()}
        assert sorted(found.values()) == list(range(len(found))) and held.items() <= found.items()
        assert rows(B.dau_wau_mau(grown)) == rows(metrics.dau_wau_mau(daily))
        assert rows(B.retention_cohorts(grown, B.cohort_bitmaps(users, more), users)) == rows(metrics.retention_cohorts(users, daily))


def test_a_new_day_reads_no_older_user_day(spark, tmp_path):
    daily, users = tables(spark, 3)
    daily.write.partitionBy("activity_date").parquet(f"{tmp_path}/daily")
    stored = spark.read.schema(DAILY).parquet(f"{tmp_path}/daily")
    last = stored.selectExpr("max(activity_date)").first()[0]
    numbers = B.number_users(users)
    numbers.write.parquet(f"{tmp_path}/numbers")
    numbers = spark.read.parquet(f"{tmp_path}/numbers")
    B.day_bitmaps(stored.where(f"activity_date < DATE'{last}'"), numbers).write.parquet(f"{tmp_path}/bitmaps")
    bitmaps = spark.read.parquet(f"{tmp_path}/bitmaps")
    grown, _ = B.extend(bitmaps, numbers, stored.where(f"activity_date = DATE'{last}'"), users)
    plan = grown._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and f"{tmp_path}/daily" in line]
    assert len(scans) == 1 and f"(activity_date#" in scans[0].split("PartitionFilters:")[1] and str(last) in scans[0]
    assert rows(B.dau_wau_mau(grown)) == rows(metrics.dau_wau_mau(daily))


def test_many_buckets_and_empty_tables(spark):
    users = spark.range(70_000).selectExpr("id * 1000003 AS user_id", "date_add(DATE'2024-01-01', CAST(id % 3 AS INT)) AS first_seen_date")
    daily = users.selectExpr("user_id", "first_seen_date AS activity_date", "true AS is_active").unionByName(
        users.where("user_id % 2 = 0").selectExpr("user_id", "DATE'2024-01-04' AS activity_date", "true AS is_active"))
    numbers = B.number_users(users)
    bitmaps = B.day_bitmaps(daily, numbers)
    assert bitmaps.select("bucket").distinct().count() == 3
    assert rows(B.dau_wau_mau(bitmaps)) == rows(metrics.dau_wau_mau(daily))
    assert rows(B.retention_cohorts(bitmaps, B.cohort_bitmaps(users, numbers), users)) == rows(metrics.retention_cohorts(users, daily))
    empty, nobody = spark.createDataFrame([], DAILY), spark.createDataFrame([], USERS)
    none = B.day_bitmaps(empty, B.number_users(nobody))
    assert rows(B.dau_wau_mau(none)) == [] and B.extend(none, B.number_users(nobody), daily, users)[1].count() == 70_000
