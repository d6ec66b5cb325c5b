"""Active users (M1) and retention (M4) from exact day bitmaps.

Users get dense numbers, in the order of their first day. A day's active users are
bits: one bitmap of 32,768 users a bucket, 4 KB. Distinct users over a window are
the bits of the days' bitmaps or-ed together; users of a cohort that are active on a
day are the bits that the cohort's and the day's bitmaps have in common. Numbers by
first day put a cohort into few buckets, so a day's bucket meets few cohorts.

Bitmaps are kept by day. A new day adds its own bitmaps and the numbers of its new
users; no older user-day is read again (``extend``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.columns import safe_ratio
from cartwheel.operators.metrics import _active_user_days, _cohort_sizes, _cohorts
from cartwheel.fixed_values import ROLLING_WINDOWS


def number_users(users: DataFrame, after: int = -1) -> DataFrame:
    """(user_id, number): numbers from ``after`` + 1 without gaps, by first day and id.

    A row's number is the rows in earlier range partitions plus its place in its own, so no task orders all users.
    """
    spread = users.select("user_id", "first_seen_date").where("user_id IS NOT NULL").distinct()
    ordered = spread.repartitionByRange("first_seen_date", "user_id").sortWithinPartitions("first_seen_date", "user_id")
    placed = ordered.withColumn("_row", F.monotonically_increasing_id())  # the partition's number, then the place in it
    part, place = F.shiftright("_row", 33), F.col("_row").bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return placed.join(starts, part == F.col("_part")).select(
        "user_id", (F.col("_start") + place + F.lit(after + 1)).alias("number"))


def _bits(numbered: DataFrame, *by: str) -> DataFrame:
    """(by, bucket, bits) of the users' numbers."""
    number = F.col("number") + 1  # Spark's bitmaps count from 1
    return (numbered.select(*by, F.bitmap_bucket_number(number).alias("bucket"), F.bitmap_bit_position(number).alias("_at"))
            .groupBy(*by, "bucket").agg(F.bitmap_construct_agg("_at").alias("bits")))


def day_bitmaps(user_daily: DataFrame, numbers: DataFrame) -> DataFrame:
    """(activity_date, bucket, bits): the active users of every day."""
    return _bits(_active_user_days(user_daily).join(numbers, "user_id"), "activity_date")


def cohort_bitmaps(users: DataFrame, numbers: DataFrame) -> DataFrame:
    """(cohort_date, bucket, bits): the users of every first day."""
    return _bits(_cohorts(users).join(numbers, "user_id"), "cohort_date")


def extend(bitmaps: DataFrame, numbers: DataFrame, new_days: DataFrame, users: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(bitmaps, numbers) with days added: ``new_days`` are their user-days, ``users`` the dimension after them.

    Users without a number get the next ones. The new days' own bitmaps are all that is built.
    """
    fresh = users.join(numbers.select("user_id"), "user_id", "left_anti")
    last = numbers.agg(F.max("number")).first()[0]
    numbers = numbers.unionByName(number_users(fresh, -1 if last is None else last))
    return bitmaps.unionByName(day_bitmaps(new_days, numbers)), numbers


def rolling_counts(bitmaps: DataFrame, windows: dict[str, int] | None = None) -> DataFrame:
    """(activity_date, dau and a count a window) for every day with active users.

    A day's bitmap is handed to the days whose window it lies in; what is summed is a bitmap's bits.
    """
    windows = windows or ROLLING_WINDOWS
    days = bitmaps.select("activity_date").distinct()
    counts = bitmaps.groupBy("activity_date").agg(F.sum(F.bitmap_count("bits")).alias("dau"))
    for name, length in windows.items():
        handed = bitmaps.select(F.explode(F.sequence("activity_date", F.date_add("activity_date", length - 1))).alias("activity_date"), "bucket", "bits")
        united = (handed.join(days, "activity_date", "left_semi").groupBy("activity_date", "bucket").agg(F.bitmap_or_agg("bits").alias("bits")))
        counts = counts.join(united.groupBy("activity_date").agg(F.sum(F.bitmap_count("bits")).alias(name)), "activity_date")
    return counts


def dau_wau_mau(bitmaps: DataFrame) -> DataFrame:
    """DAU, WAU and MAU of every day with active users (equals ``metrics.dau_wau_mau``)."""
    return rolling_counts(bitmaps).select("activity_date", "dau", "wau", "mau", safe_ratio("wau", "dau").alias("wau_dau_ratio"),
                                          safe_ratio("mau", "dau").alias("mau_dau_ratio"))


def retention_cohorts(bitmaps: DataFrame, cohorts: DataFrame, users: DataFrame) -> DataFrame:
    """Users of a cohort active at an age / cohort size, for ages with any (equals ``metrics.retention_cohorts``)."""
    mine = cohorts.select("cohort_date", "bucket", F.col("bits").alias("_c"))
    theirs = bitmaps.select("activity_date", "bucket", F.col("bits").alias("_d"))
    met = mine.join(theirs, "bucket").where("activity_date >= cohort_date")
    both = met.select("cohort_date", "activity_date", "bucket", F.explode(F.array("_c", "_d")).alias("bits"))
    common = (both.groupBy("cohort_date", "activity_date", "bucket")
              .agg(F.bitmap_count(F.bitmap_and_agg("bits")).alias("n")))  # of the two
    cells = (common.groupBy("cohort_date", F.datediff("activity_date", "cohort_date").cast("bigint").alias("cohort_age_days"))
             .agg(F.sum("n").alias("retained_users")).where("retained_users > 0"))
    return cells.join(_cohort_sizes(_cohorts(users), "cohort_sizes"), "cohort_date").select(
        "cohort_date", "cohort_age_days", "retained_users", "cohort_sizes", safe_ratio("retained_users", "cohort_sizes").alias("retention_rate"))
