"""Raw feeds derived from the driver's tables (see FIXTURES.md §3).

``events`` (clicks) and ``part`` (catalogue) are reshaped into the two raw
envelope feeds the warehouse ingests: clickstream messages and payment-
provider webhooks (intents, charges, refunds, plus rejects). The result has
the landing-table shape, as if earlier loads had already run. Everything is a
single scan of ``events`` per feed; variants (duplicates, degraded copies,
per-payment message kinds) come from ``explode`` rather than repeated scans,
so the derivation grows linearly with the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.functions.columns import second_boundaries

# Fixed values of the synthetic feeds (FIXTURES.md §3).
COHORT_SPREAD_DAYS = 14          # event time shifted by (user_id % 14) days
LATE_HOURS_MOD = 48              # received = occurred + (n % 48) hours
PRICE_MISSING_MOD = 50           # price text 'n/a'
TYPE_NOISE_MOD = 7               # ' View ' casing / padding
EXACT_DUP_MOD = 25               # same payload re-delivered 6 hours later
DEGRADED_DUP_MOD = 10            # same event id, blank session, one day later
PAY_DELAY_MOD = 90               # intent time = ts + (n % 90) minutes
NULL_USER_MOD = 20
NULL_SESSION_MOD = 5
UNPAID_MOD, UNPAID_REM = 10, 9   # status requires_payment_method
FAILED_ATTEMPT_MOD = 4           # extra failed charge 'ch_<n>_a'
FEE_DIVISOR = 30
REFUND_MOD = 12
HALF_REFUND_MOD = 24
NULL_REFUND_STATUS_MOD = 36
FAILED_REFUND_MOD = 60
REJECT_MOD = 97
# Rows that break rules or need an operator's rarer branch.
LATE_MONTH_MOD, LATE_MONTH_DAYS = 37, 45      # the user comes back after a month
LATE_QUARTER_MOD, LATE_QUARTER_DAYS = 53, 75  # ... after more than two
SHARED_SESSION_MOD = 9           # one session a day that many users' clicks carry
NO_SESSION_MOD = 14              # clicks without a session
NO_USER_MOD = 33                 # clicks without a user
TEXT_USER_MOD = 41               # clicks whose user id isn't a number
NEGATIVE_PRICE_MOD = 61
OVER_REFUND_MOD = 156            # refund of twice the charge
LOST_CHARGE_MOD = 132            # refund of a charge that was never delivered
LOST_INTENT_MOD = 95             # charge of an intent that was never delivered
ZERO_AMOUNT_MOD = 83
NEGATIVE_AMOUNT_MOD = 89
FAILED_CHARGE_MOD = 71           # intent succeeded, its charge did not
NO_CURRENCY_MOD = 101


def _text(c: Column) -> Column:
    return c.cast("string")


#: Events that one task makes landing rows of. A few bytes of an event become a KB of JSON, so the splits of the
#: compact event file say little about how large the rows of a task get.
EVENTS_A_TASK = 100_000


def spread(rows: DataFrame, tasks: int, by_time: bool = False) -> DataFrame:
    """The rows dealt evenly to so many tasks before they widen; one task's worth stays as it was read.

    ``by_time``: each task gets a stretch of time, so that one that writes by date writes few dates: files grow with the
    dates and the tasks, not with their product. Costs a second look at the rows for the borders.
    """
    if tasks <= 1:
        return rows
    return rows.repartitionByRange(tasks, "ts", "n") if by_time else rows.repartition(tasks)


def kept_events(events: DataFrame, part: DataFrame) -> DataFrame:
    """Every event, shifted by ``user_id % 14`` days so users start on different
    days (cohort spread), some by weeks more (late returns), joined to its
    catalogue row. No event is dropped."""
    n = F.col("event_id")
    shift = ((F.col("user_id") % COHORT_SPREAD_DAYS).cast("int")
             + F.when(n % LATE_MONTH_MOD == 0, LATE_MONTH_DAYS).when(n % LATE_QUARTER_MOD == 0, LATE_QUARTER_DAYS).otherwise(0))
    ev = (events
          .withColumn("ts", F.timestamp_add("DAY", shift, F.col("ts")))
          .withColumn("k", F.get_json_object("props", "$.k").try_cast("bigint")))
    cat = part.select(F.col("p_partkey").alias("k"), "p_brand", "p_type", "p_size")
    return (ev.join(cat, "k", "left")
              .withColumn("session_text", F.concat_ws(
                  "-", F.when(n % SHARED_SESSION_MOD == 0, F.lit("shared")).otherwise(_text(F.col("user_id"))),
                  _text(F.to_date("ts"))))
              .withColumn("n", n))


def clickstream_landing(events: DataFrame, part: DataFrame, tasks: int = 1, by_time: bool = False) -> DataFrame:
    """Landing rows of the clickstream feed (one per delivered message), made in so many tasks if more than one."""
    ev = spread(kept_events(events, part).drop("props"), tasks, by_time)
    n = F.col("n")
    typ = F.when(F.col("event_type") == "click", F.lit("cart")).otherwise(F.col("event_type"))
    noisy = F.concat(F.lit(" "), F.upper(F.substring(typ, 1, 1)), F.substring(typ, 2, 100),
                     F.lit(" "))
    typ = F.when(n % TYPE_NOISE_MOD == 0, noisy).otherwise(typ)
    price = (F.when(n % PRICE_MISSING_MOD == 0, F.lit("n/a"))
             .when(n % NEGATIVE_PRICE_MOD == 0, F.concat(F.lit("-"), _text(F.col("value"))))
             .otherwise(_text(F.col("value"))))
    user = (F.when(n % NO_USER_MOD == 0, F.lit(None).cast("string"))
            .when(n % TEXT_USER_MOD == 0, F.concat(F.lit("u-"), _text(F.col("user_id"))))
            .otherwise(_text(F.col("user_id"))))
    base_ingested = F.timestamp_add("HOUR", n % LATE_HOURS_MOD, F.col("ts"))

    # variant 0 = original, 1 = exact re-delivery, 2 = degraded copy
    variants = F.array(
        F.lit(0),
        F.when(n % EXACT_DUP_MOD == 0, F.lit(1)),
        F.when(n % DEGRADED_DUP_MOD == 0, F.lit(2)),
    )
    v = F.col("variant")
    ingested = (F.when(v == 1, F.timestamp_add("HOUR", F.lit(6), base_ingested))
                 .when(v == 2, F.timestamp_add("DAY", F.lit(1), base_ingested))
                 .otherwise(base_ingested))
    session = F.when((v == 2) | (n % NO_SESSION_MOD == 0), F.lit("")).otherwise(F.col("session_text"))

    rows = (ev.select("*", F.explode(variants).alias("variant"))
              .where(v.isNotNull())
              .withColumn("ingested", ingested))
    event_id = F.concat(F.lit("evt_"), _text(n))
    payload = F.struct(
        user.alias("user_id"),
        session.alias("user_session"),
        _text(F.col("ts")).alias("event_time"),
        typ.alias("event_type"),
        _text(F.col("k")).alias("product_id"),
        _text(F.col("p_size")).alias("category_id"),
        F.col("p_type").alias("category_code"),
        F.col("p_brand").alias("brand"),
        price.alias("price"),
    )
    metadata = F.struct(
        event_id.alias("event_id"),
        F.lit("web_tracker").alias("source_system"),
        F.lit("1.0").alias("schema_version"),
        F.concat(F.lit("cb_"), F.date_format("ingested", "yyyyMMddHH")).alias("batch_id"),
        _text(F.col("ingested")).alias("ingested_at"),
    )
    keys = F.struct(event_id.alias("event_id"), _text(F.col("user_id")).alias("user_id"))
    filename = F.concat(
        F.lit("landing/clickstream/dt="), _text(F.to_date("ingested")),
        F.lit("/part-0000"), _text(v), F.lit(".jsonl"))
    return _landing_columns(rows, event_id, metadata, keys, payload, filename)


def payments_landing(events: DataFrame, part: DataFrame, tasks: int = 1, by_time: bool = False) -> DataFrame:
    """Landing rows of the payment-provider feed (intents, charges, refunds), made in so many tasks if more than one."""
    ev = spread(kept_events(events, part).where(F.col("event_type") == "purchase").drop("props"), tasks, by_time)
    n = F.col("n")
    nt = _text(n)
    pay_ts = F.timestamp_add("MINUTE", n % PAY_DELAY_MOD, F.col("ts"))
    cents = F.round(F.col("value") * 100).cast("bigint")
    cents = F.when(n % ZERO_AMOUNT_MOD == 0, F.lit(0)).when(n % NEGATIVE_AMOUNT_MOD == 0, -cents).otherwise(cents)
    succeeded = (n % UNPAID_MOD) != UNPAID_REM

    kinds = F.array(
        F.lit("intent"), F.lit("charge"),
        F.when(n % FAILED_ATTEMPT_MOD == 0, F.lit("attempt")),
        F.when(n % REFUND_MOD == 0, F.lit("refund")),
        F.when(n % REJECT_MOD == 0, F.lit("reject_charge")),
        F.when(n % REJECT_MOD == 0, F.lit("reject_intent")),
    )
    rows = (ev.withColumn("pay_ts", pay_ts).withColumn("cents", cents)
              .select("*", F.explode(kinds).alias("kind"))
              .where(F.col("kind").isNotNull()))
    kind = F.col("kind")
    pay_ts = F.col("pay_ts")
    cents = F.col("cents")
    event_time = (
        F.when(kind == "charge", F.timestamp_add("MINUTE", F.lit(1), pay_ts))
         .when(kind == "attempt", F.timestamp_add("SECOND", F.lit(30), pay_ts))
         .when(kind == "refund", F.timestamp_add("DAY", n % 5 + 1, pay_ts))
         .when(kind == "reject_charge", F.timestamp_add("MINUTE", F.lit(2), pay_ts))
         .when(kind == "reject_intent", F.timestamp_add("MINUTE", F.lit(-1), pay_ts))
         .otherwise(pay_ts))
    rows = rows.withColumn("etime", event_time).withColumn(
        "ingested", F.timestamp_add("HOUR", n % LATE_HOURS_MOD, F.col("etime")))

    prefix = (F.when(kind == "intent", "evt_pi_").when(kind == "charge", "evt_ch_")
               .when(kind == "attempt", "evt_cha_").when(kind == "refund", "evt_re_")
               .when(kind == "reject_charge", "evt_chx_").otherwise("evt_pix_"))
    provider_id = F.concat(prefix, nt)
    charged = succeeded & (n % FAILED_CHARGE_MOD != 0)
    charge_type = F.when(charged, "charge.succeeded").otherwise("charge.failed")
    charge_type = F.when(n % TYPE_NOISE_MOD == 0, F.upper(charge_type)).otherwise(charge_type)
    etype = (F.when(kind == "intent",
                    F.when(succeeded, "payment_intent.succeeded")
                     .otherwise("payment_intent.requires_payment_method"))
              .when(kind == "charge", charge_type)
              .when(kind.isin("attempt", "reject_charge"), "charge.failed")
              .when(kind == "refund", "refund.created")
              .otherwise("payment_intent.created"))
    refund_cents = (F.when(n % OVER_REFUND_MOD == 0, cents * 2)
                    .when(n % HALF_REFUND_MOD == 0, F.floor(cents / 2).cast("bigint")).otherwise(cents))
    refund_status = (F.when(n % NULL_REFUND_STATUS_MOD == 0, F.lit(None).cast("string"))
                      .when(n % FAILED_REFUND_MOD == 0, "failed").otherwise("succeeded"))
    fee = F.floor(cents / FEE_DIVISOR).cast("bigint")
    is_charge = kind.isin("charge", "attempt", "reject_charge")
    obj = F.struct(
        (F.when(kind == "intent", F.concat(F.lit("pi_"), nt))
          .when(kind == "charge", F.concat(F.lit("ch_"), nt))
          .when(kind == "attempt", F.concat(F.lit("ch_"), nt, F.lit("_a")))
          .when(kind == "refund", F.concat(F.lit("re_"), nt))).alias("id"),
        (F.when(kind == "intent", F.when(succeeded, "succeeded").otherwise("requires_payment_method"))
          .when(kind == "charge", F.when(charged, "succeeded").otherwise("failed"))
          .when(kind.isin("attempt", "reject_charge"), "failed")
          .when(kind == "refund", refund_status)
          .otherwise("requires_payment_method")).alias("status"),
        _text(F.when(kind == "refund", refund_cents).otherwise(cents)).alias("amount"),
        F.when(n % NO_CURRENCY_MOD != 0, F.lit("usd")).alias("currency"),
        F.when(kind == "intent", F.concat(F.lit("ch_"), nt)).alias("latest_charge"),
        F.when(is_charge, F.concat(F.lit("pi_"), nt, F.when(n % LOST_INTENT_MOD == 0, "_lost").otherwise(""))).alias("payment_intent"),
        F.when(kind == "refund", F.concat(F.lit("ch_"), nt, F.when(n % LOST_CHARGE_MOD == 0, "_lost").otherwise(""))).alias("charge"),
        F.when(kind == "refund", F.lit("requested_by_customer")).alias("reason"),
        F.when(kind.isin("intent", "refund"), F.struct(
            F.concat(F.lit("ord_"), nt).alias("order_id"),
            F.when(kind == "intent", F.when(n % FAILED_ATTEMPT_MOD == 0, "2").otherwise("1")
                   ).alias("attempt_number"),
            F.when(kind == "intent", F.lit("card")).alias("payment_method"),
        )).alias("metadata"),
        F.when(kind.isin("charge", "attempt"), F.struct(
            _text(F.when(kind == "charge", fee).otherwise(F.lit(0))).alias("fee"),
            _text(F.when(kind == "charge", cents - fee).otherwise(F.lit(0))).alias("net"),
        )).alias("balance_transaction"),
    )
    epoch = second_boundaries(F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("etime"))
    payload = F.struct(
        provider_id.alias("id"),
        F.lit("2023-10-16").alias("api_version"),
        etype.alias("type"),
        epoch.alias("created"),
        F.struct(obj.alias("object")).alias("data"),
    )
    keys = F.struct(
        _text(F.col("etime")).alias("event_time"),
        _text(F.when(n % NULL_USER_MOD != 0, F.col("user_id"))).alias("user_id"),
        F.when(n % NULL_SESSION_MOD != 0, F.col("session_text")).alias("user_session"),
    )
    metadata = F.struct(
        F.concat(F.lit("env_"), provider_id).alias("event_id"),
        F.lit("payments_api").alias("source_system"),
        F.lit("1.0").alias("schema_version"),
        F.concat(F.lit("pb_"), F.date_format("ingested", "yyyyMMddHH")).alias("batch_id"),
        _text(F.col("ingested")).alias("ingestion_timestamp"),
    )
    folder = F.when(kind == "refund", F.lit("landing/payments/refunds/dt=")).otherwise(
        F.lit("landing/payments/dt="))
    filename = F.concat(folder, _text(F.to_date("ingested")), F.lit("/part-00000.jsonl"))
    return _landing_columns(rows, provider_id, metadata, keys, payload, filename)


def _landing_columns(rows: DataFrame, event_id: Column, metadata: Column, keys: Column,
                     payload: Column, filename: Column) -> DataFrame:
    """Project to the landing-table shape (FIXTURES.md §1.3)."""
    out = rows.select(
        event_id.alias("event_id"),
        F.to_json(metadata).alias("metadata_json"),
        F.to_json(keys).alias("keys_json"),
        F.to_json(payload).alias("raw_payload_json"),
        filename.alias("filename"),
        F.concat(F.lit("load_"), F.date_format("ingested", "yyyyMMddHH")).alias("load_id"),
        F.col("ingested").alias("ingested_at"),
    )
    return (out.withColumn("dt", F.to_date(F.regexp_extract("filename", r"dt=([^/]+)", 1)))
               .withColumn("payload_hash", F.sha2("raw_payload_json", 256))
               .select("event_id", "metadata_json", "keys_json", "raw_payload_json", "dt",
                       "filename", "load_id", "ingested_at", "payload_hash"))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def landing_tables(spark: SparkSession, sf_dir: str, by_time: bool = False) -> tuple[DataFrame, DataFrame]:
    """(clickstream landing, payments landing) derived from ``sf_dir`` tables; ``by_time`` to be written by date."""
    events = read_table(spark, sf_dir, "events")
    part = read_table(spark, sf_dir, "part")
    tasks = -(-events.count() // EVENTS_A_TASK)  # of the file's footers
    return clickstream_landing(events, part, tasks, by_time), payments_landing(events, part, -(-tasks // 2), by_time)
