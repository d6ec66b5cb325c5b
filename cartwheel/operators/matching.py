"""Payment -> click attribution: band joins (J4, J5), candidates (B1), best
event (B2) and session mapping (B3).

The band join ``|event_time - payment_time| <= w`` on an entity key is run
as an equi-join on ``(key, time bucket)`` with buckets of half of ``w``: each
event sits in one bucket, each payment probes the five buckets its window
touches, and the exact band is a residual filter. The join therefore stays a
hash/sort-merge join whose partitions are (key, half window) slices, so one
very active user or session is spread over many tasks instead of one. Time
alone spreads a key: salting the events too would cost a copy of every
payment for every salt. ``salts`` still does that where it is asked for; both
sides are plain shuffles, so AQE's skew-join splitting covers a slice that is
still too large. The join sorts by bucket first and reads the events in order,
so that pairs of one time and event come together and are written in few bytes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.columns import second_boundaries
from cartwheel.fixed_values import (
    PURCHASE, SESSION_MATCH, SESSION_MATCH_SCORES, USER_MATCH, USER_MATCH_SCORES,
)

CANDIDATE_COLUMNS = [
    "payment_intent_id", "payment_event_time", "last_received_ts", "event_id",
    "clickstream_time", "clickstream_received_ts", "event_type", "event_user_id",
    "event_user_session", "match_score", "matched_type", "time_diff_seconds",
]


# Attributes of the matched click that candidates and mapping carry for later jobs,
# which then need no second look at the event fact.
CARRIED = ["product_id", "brand"]


def _bucket(ts: F.Column, minutes: int) -> F.Column:
    """Number of the half window that a time lies in; grows with the time."""
    return F.floor(F.unix_micros(ts.cast("timestamp")) / F.lit(minutes * 30 * 1_000_000))


SALTS = 1   # parts of a (key, bucket) slice of the events; every payment is copied to each


def band_join(payments: DataFrame, events: DataFrame, pay_key: str, event_key: str,
              minutes: int, row_id: str = "event_id", salts: int = SALTS) -> DataFrame:
    """Pairs (payment, event) with equal keys and event time within ±minutes.

    An event lies in one bucket and one salt (by a hash of its id); a payment
    probes the buckets from its window's start to its end in every salt, so
    each pair is produced exactly once.
    """
    window = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))
    paid = F.col("payment_event_time")
    p = (payments.where(F.col(pay_key).isNotNull())
         .withColumn("_bucket", F.explode(F.sequence(_bucket(paid - window, minutes), _bucket(paid + window, minutes))))
         .withColumn("_salt", F.explode(F.array(*[F.lit(i) for i in range(salts)]))))
    e = (events.where(F.col(event_key).isNotNull() & F.col("event_time").isNotNull())
         .withColumn("_bucket", _bucket(F.col("event_time"), minutes))
         .withColumn("_salt", F.pmod(F.xxhash64(F.col(row_id)), F.lit(salts)).cast("int")))
    cond = [
        p["_bucket"] == e["_bucket"],
        p[pay_key] == e[event_key],
        p["_salt"] == e["_salt"],
        e["event_time"].between(p["payment_event_time"] - window, p["payment_event_time"] + window),
    ]
    return (e.join(p, cond, "inner").drop(p["_bucket"]).drop(e["_bucket"])
            .drop(p["_salt"]).drop(e["_salt"]))


def match_candidates(payments: DataFrame, events: DataFrame, minutes: int = 60,
                     prefilter: bool = True, salts: int = SALTS) -> DataFrame:
    """Session-key matches (score 120 purchase / 100 other) plus user-key
    matches (70 / 50) within ±``minutes`` of the payment."""
    pay = payments.select(
        "payment_intent_id",
        F.col("payment_intent_event_ts").alias("payment_event_time"),
        F.col("user_id").alias("payment_user_id"),
        F.col("user_session").alias("payment_user_session"),
        "last_received_ts")
    ev = events.select(
        F.col("event_pk").alias("event_id"), "user_id", "user_session", "event_type",
        "event_time", "received_ts", *CARRIED)
    if prefilter:
        # two scalars: the payment time range, widened by the window; as
        # literals they prune event files/row groups by min/max statistics
        lo, hi = pay.agg(F.min("payment_event_time"), F.max("payment_event_time")).first()
        if lo is None:
            ev = ev.limit(0)
        else:
            w = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))
            ev = ev.where(F.col("event_time").between(F.lit(lo).cast("timestamp_ntz") - w,
                                                      F.lit(hi).cast("timestamp_ntz") + w))

    def scored(pairs: DataFrame, hi: int, lo: int, kind: str) -> DataFrame:
        return pairs.select(
            "payment_intent_id", "payment_event_time", "last_received_ts",
            "event_id", F.col("event_time").alias("clickstream_time"),
            F.col("received_ts").alias("clickstream_received_ts"), "event_type",
            F.col("user_id").alias("event_user_id"),
            F.col("user_session").alias("event_user_session"),
            F.when(F.col("event_type") == PURCHASE, hi).otherwise(lo).alias("match_score"),
            F.lit(kind).alias("matched_type"),
            second_boundaries("event_time", "payment_event_time").alias("time_diff_seconds"), *CARRIED)

    by_session = scored(band_join(pay, ev, "payment_user_session", "user_session", minutes, salts=salts),
                        *SESSION_MATCH_SCORES, SESSION_MATCH)
    by_user = scored(band_join(pay, ev, "payment_user_id", "user_id", minutes, salts=salts),
                     *USER_MATCH_SCORES, USER_MATCH)
    return by_session.unionByName(by_user).select(*CANDIDATE_COLUMNS, *CARRIED)


def map_payment_to_event(candidates: DataFrame) -> DataFrame:
    """Best candidate per payment: score, then nearest in time, then latest click, then smallest event id.

    One ``min_by`` aggregate: each map task keeps one candidate of a payment.
    """
    latest = F.coalesce(-F.unix_micros(F.col("clickstream_received_ts").cast("timestamp")), F.lit(2 ** 63 - 1))
    rank = F.struct((-F.col("match_score")).alias("score"), F.abs("time_diff_seconds").alias("gap"),
                    latest.alias("latest"), "event_id")
    kept = ["event_id", "event_user_id", "event_user_session", "event_type", "matched_type", "match_score",
            "payment_event_time", "clickstream_time", "time_diff_seconds", "last_received_ts", *CARRIED]
    best = candidates.groupBy("payment_intent_id").agg(F.min_by(F.struct(*kept), rank).alias("best"))
    return best.select("payment_intent_id", "best.*")


def map_payment_to_session(mapping: DataFrame, sessions: DataFrame) -> DataFrame:
    """Attach the matched event's session; flag whether its user agrees."""
    s = sessions.select("session_id", F.col("user_id").alias("_session_user_id"))
    # rows without a session key cannot match; they bypass the join instead of
    # all hashing to one partition
    keyed = mapping.where(F.col("event_user_session").isNotNull())
    j = keyed.join(s, keyed["event_user_session"] == s["session_id"], "left").unionByName(
        mapping.where(F.col("event_user_session").isNull()).select(
            "*", F.lit(None).cast("string").alias("session_id"),
            F.lit(None).cast("bigint").alias("_session_user_id")))
    consistent = (F.when(F.col("_session_user_id").isNull() | F.col("event_user_id").isNull(),
                         F.lit(None).cast("boolean"))
                  .otherwise(F.col("event_user_id") == F.col("_session_user_id")))
    return j.select(
        "payment_intent_id", "session_id",
        F.col("session_id").isNotNull().alias("is_session_found"),
        consistent.alias("is_user_consistent"),
        "event_id", "event_type", "event_user_id", "event_user_session", "matched_type",
        "match_score", "payment_event_time", "clickstream_time", "time_diff_seconds",
        "last_received_ts")


# ------------------------------------------------------------------ best match by a sweep
def _seconds(ts: str | F.Column) -> F.Column:
    return F.unix_seconds((F.col(ts) if isinstance(ts, str) else ts).cast("timestamp"))


_KEPT = ["event_id", "event_user_id", "event_user_session", "event_type", "clickstream_time", *CARRIED]


def _clicks_by_second(clicks: DataFrame, key: str) -> DataFrame:
    """The click that wins among those of one key, class (purchase or not) and second: latest receipt, then smallest id."""
    latest = F.coalesce(-F.unix_micros(F.col("received_ts").cast("timestamp")), F.lit(2 ** 63 - 1))
    rank = F.struct(latest.alias("latest"), F.col("event_id").alias("id"))
    best = F.struct(rank.alias("rank"), F.struct(*_KEPT).alias("click"))
    return (clicks.where(F.col(key).isNotNull() & F.col("event_time").isNotNull())
            .groupBy(F.col(key).alias("key"), F.coalesce(F.col("event_type") == PURCHASE, F.lit(False)).alias("is_purchase"),
                     _seconds("event_time").alias("sec"))
            .agg(F.min_by(best, rank).alias("best")))


def _sweep(asked: DataFrame, by_second: DataFrame, width: int) -> DataFrame:
    """(key, sec, best): for every asked second and class the nearest clicks before and after it, less than ``width`` away.

    Seconds are cut into slices of ``width``. A slice is read in time order, forth and back, and each asked second takes
    the click seconds that were passed last. What lies beyond a slice's border can only be the last click second of the
    slice before or the first one of the slice after, so every slice hands these on: an asked second costs a row, not the
    clicks around it, and a slice has ``width`` rows a class at most, however hot its key.
    """
    at = F.floor(F.col("sec") / width)
    clicks = by_second.withColumn("slice", at)
    held = F.struct("sec", "best")
    edge = clicks.groupBy("key", "is_purchase", "slice").agg(F.min_by(held, "sec").alias("first"), F.max_by(held, "sec").alias("last"))
    border = edge.select("key", "is_purchase", F.explode(F.array(
        F.struct((F.col("slice") + 1).alias("slice"), F.col("last").alias("of")),
        F.struct((F.col("slice") - 1).alias("slice"), F.col("first").alias("of")))).alias("e"))
    columns = ["key", "slice", "sec", "asked", "is_purchase", "best"]
    none = F.lit(None).cast(by_second.schema["best"].dataType)
    rows = (clicks.withColumn("asked", F.lit(False)).select(*columns)
            .unionByName(border.select("key", "e.slice", "e.of.sec", F.lit(False).alias("asked"), "is_purchase", F.col("e.of.best").alias("best")))
            .unionByName(asked.withColumn("slice", at).select("key", "slice", "sec", F.lit(True).alias("asked"),
                                                              F.lit(None).cast("boolean").alias("is_purchase"), none.alias("best"))))
    found = []
    slice_ = Window.partitionBy("key", "slice")
    for way, order in (("before", F.asc("sec")), ("after", F.desc("sec"))):
        passed = slice_.orderBy(order, "asked").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        for purchase in (True, False):
            name = f"{way}_{purchase}"
            rows = rows.withColumn(name, F.last(F.when(F.col("is_purchase") == purchase, held), ignorenulls=True).over(passed))
            found.append(F.struct(F.lit(purchase).alias("is_purchase"), F.col(f"{name}.sec").alias("click_sec"), F.col(f"{name}.best").alias("best")))
    near = F.filter(F.array(*found), lambda x: x["best"].isNotNull() & (F.abs(x["click_sec"] - F.col("sec")) < width))
    return rows.where("asked").select("key", "sec", F.explode(near).alias("n")).select("key", "sec", "n.*")


def nearest_click(payments: DataFrame, events: DataFrame, minutes: int = 60) -> DataFrame:
    """The best match of every payment without its candidates: equals ``map_payment_to_event`` over ``match_candidates``.

    Best is: the session's purchase, the session's other clicks, the user's purchase, the user's others; then the least
    distance in whole seconds, the latest receipt, the smallest event id. All clicks less than ``minutes`` away in whole
    seconds lie in the window, and of these the nearest second before and after a payment decides (``_sweep``). Clicks of
    the two seconds exactly ``minutes`` away lie in it or not by their fractions; they meet the payment in an equi-join
    on that very second.
    """
    width = minutes * 60
    pay = payments.select("payment_intent_id", F.col("payment_intent_event_ts").alias("payment_event_time"),
                          F.col("user_id").alias("payment_user_id"), F.col("user_session").alias("payment_user_session"), "last_received_ts",
                          _seconds("payment_intent_event_ts").alias("sec"))
    clicks = events.select(F.col("event_pk").alias("event_id"), "user_id", "user_session", F.col("user_id").alias("event_user_id"),
                           F.col("user_session").alias("event_user_session"), "event_type", "event_time",
                           F.col("event_time").alias("clickstream_time"), "received_ts", *CARRIED)
    span = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))
    own = ["payment_intent_id", "payment_event_time", "last_received_ts"]  # carried along: ids may repeat or be NULL
    found = None
    for pay_key, key, kind, (high, low) in (("payment_user_session", "user_session", SESSION_MATCH, SESSION_MATCH_SCORES),
                                            ("payment_user_id", "user_id", USER_MATCH, USER_MATCH_SCORES)):
        mine = pay.where(F.col(pay_key).isNotNull() & F.col("sec").isNotNull()).withColumn("key", F.col(pay_key))
        near = _sweep(mine.select("key", "sec").distinct(), _clicks_by_second(clicks, key), width)
        inside = mine.join(near, ["key", "sec"]).select(*own, "is_purchase", "best")
        edges = mine.withColumn("click_sec", F.explode(F.array(F.col("sec") - width, F.col("sec") + width)))
        at_edge = (clicks.where(F.col(key).isNotNull()).withColumn("click_sec", _seconds("event_time"))
                   .withColumn("key", F.col(key)))
        latest = F.coalesce(-F.unix_micros(F.col("received_ts").cast("timestamp")), F.lit(2 ** 63 - 1))
        on_edge = (edges.join(at_edge, ["key", "click_sec"])
                   .where(F.col("event_time").between(F.col("payment_event_time") - span, F.col("payment_event_time") + span))
                   .select(*own, F.coalesce(F.col("event_type") == PURCHASE, F.lit(False)).alias("is_purchase"),
                           F.struct(F.struct(latest.alias("latest"), F.col("event_id").alias("id")).alias("rank"),
                                    F.struct(*_KEPT).alias("click")).alias("best")))
        scored = inside.unionByName(on_edge).select(
            *own, F.when(F.col("is_purchase"), high).otherwise(low).alias("match_score"), F.lit(kind).alias("matched_type"), "best")
        found = scored if found is None else found.unionByName(scored)
    timed = found.withColumn(
        "time_diff_seconds", second_boundaries(F.col("best.click.clickstream_time"), F.col("payment_event_time")))
    kept = F.struct("best.click.event_id", "best.click.event_user_id", "best.click.event_user_session", "best.click.event_type", "matched_type",
                    "match_score", "payment_event_time", "best.click.clickstream_time", "time_diff_seconds", "last_received_ts",
                    *[f"best.click.{c}" for c in CARRIED])
    order = F.struct((-F.col("match_score")).alias("score"), F.abs("time_diff_seconds").alias("gap"), F.col("best.rank").alias("rank"))
    return timed.groupBy("payment_intent_id").agg(F.min_by(kept, order).alias("best")).select("payment_intent_id", "best.*")
