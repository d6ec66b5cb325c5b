"""Explicit schemas of the raw envelopes (no inference on the hot path).

Leaves are read as strings: ``from_json`` returns a number's text for a string
field and a nested object's JSON text, which is what a string extraction of
the same path yields. One parse per document replaces one parse per leaf.
"""

from pyspark.sql import types as T

S = T.StringType()


def _struct(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, S) for n in names])


LANDING = T.StructType([
    T.StructField("event_id", S),
    T.StructField("metadata_json", S),
    T.StructField("keys_json", S),
    T.StructField("raw_payload_json", S),
    T.StructField("dt", T.DateType()),
    T.StructField("filename", S),
    T.StructField("load_id", S),
    T.StructField("ingested_at", T.TimestampNTZType()),
    T.StructField("payload_hash", S),
])

CLICK_METADATA = _struct("event_id", "source_system", "schema_version", "batch_id", "ingested_at")
CLICK_PAYLOAD = _struct("user_id", "user_session", "event_time", "event_type", "product_id",
                        "category_id", "category_code", "brand", "price")

PAYMENT_METADATA = _struct("event_id", "source_system", "schema_version", "batch_id",
                           "ingestion_timestamp")
PAYMENT_KEYS = _struct("event_time", "user_id", "user_session")
PAYMENT_OBJECT = T.StructType([
    *[T.StructField(n, S) for n in ("id", "status", "amount", "currency", "latest_charge",
                                    "payment_intent", "charge", "reason")],
    T.StructField("metadata", _struct("order_id", "attempt_number", "payment_method")),
    T.StructField("balance_transaction", _struct("fee", "net")),
])
PAYMENT_PAYLOAD = T.StructType([
    T.StructField("id", S),
    T.StructField("api_version", S),
    T.StructField("type", S),
    T.StructField("created", S),
    T.StructField("data", T.StructType([T.StructField("object", PAYMENT_OBJECT)])),
])

# The raw JSONL envelope as delivered: three objects kept as JSON text.
ENVELOPE = T.StructType([
    T.StructField("metadata", S),
    T.StructField("keys", S),
    T.StructField("raw_payload", S),
])

# The same with the text of a line that can't be read as an envelope.
LINE = "_line"
ENVELOPE_OR_LINE = T.StructType([*ENVELOPE.fields, T.StructField(LINE, S)])

# Unreadable lines of a feed.
REJECTS = T.StructType([
    T.StructField("line", S),
    T.StructField("line_hash", S),
    T.StructField("dt", T.DateType()),
    T.StructField("filename", S),
    T.StructField("load_id", S),
    T.StructField("ingested_at", T.TimestampNTZType()),
])
