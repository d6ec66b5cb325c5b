import datetime as dt

from pyspark.sql import types as T

TS = T.TimestampNTZType()


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


PAYMENTS_SCHEMA = T.StructType([
    T.StructField("payment_intent_id", T.StringType()),
    T.StructField("payment_intent_event_ts", TS),
    T.StructField("is_succeeded", T.BooleanType()),
    T.StructField("is_refunded", T.BooleanType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("user_session", T.StringType()),
    T.StructField("amount_cents", T.LongType()),
    T.StructField("refunded_cents", T.LongType()),
    T.StructField("last_received_ts", TS),
])


def payments(spark, rows):
    """rows: (id, ts, succeeded, user, session, cents, refunded_cents)"""
    full = [(i, ts(t), ok, (r or 0) > 0, u, s, c, r or 0, ts(t)) for i, t, ok, u, s, c, r in rows]
    return spark.createDataFrame(full, PAYMENTS_SCHEMA)


EVENTS_SCHEMA = T.StructType([
    T.StructField("event_pk", T.StringType()),
    T.StructField("event_time", TS),
    T.StructField("received_ts", TS),
    T.StructField("event_type", T.StringType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("user_session", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("brand", T.StringType()),
    T.StructField("category_id", T.StringType()),
    T.StructField("category_code", T.StringType()),
    T.StructField("price", T.DoubleType()),
])


def events(spark, rows):
    """rows: (pk, time, received, type, user, session, product)"""
    full = [(pk, ts(t), ts(r), typ, u, s, p, "b", "1", "c", 1.0)
            for pk, t, r, typ, u, s, p in rows]
    return spark.createDataFrame(full, EVENTS_SCHEMA)
