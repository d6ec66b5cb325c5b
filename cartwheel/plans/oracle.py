"""Independent DuckDB SQL for every registered query (the correctness oracle).

Each model is a named CTE over the driver's tables (``events``, ``part``),
jobs: rows are picked by arg_max over ordered structs, JSON is read through one
typed transform, daily facts add up stacked rows, and the metrics work on
lists. ``sql_for(query)`` assembles the CTEs a query needs, in dependency order.
"""

from __future__ import annotations

import re

# name -> SQL body. Dependencies are found by scanning for other CTE names.
CTES: dict[str, str] = {}


def cte(name: str, body: str) -> None:
    CTES[name] = body.strip()


# ---------------------------------------------------------------- fixtures
cte("kept", """
SELECT e.event_id AS n, e.ts,
       e.user_id, e.event_type, e.value,
       TRY_CAST(json_extract_string(e.props, '$.k') AS BIGINT) AS k,
       p.p_brand, p.p_type, p.p_size,
       CASE WHEN e.event_id % 9 = 0 THEN 'shared' ELSE CAST(e.user_id AS VARCHAR) END || '-' || CAST(CAST(e.ts AS DATE) AS VARCHAR) AS session_text
FROM (SELECT * REPLACE (ts + to_days(CAST(user_id % 14 + CASE WHEN event_id % 37 = 0 THEN 45 WHEN event_id % 53 = 0 THEN 75 ELSE 0 END AS INTEGER)) AS ts)
      FROM events) e
LEFT JOIN part p ON p.p_partkey = TRY_CAST(json_extract_string(e.props, '$.k') AS BIGINT)
""")

cte("click_rows", """
SELECT *, CASE variant WHEN 1 THEN base_ingested + INTERVAL 6 HOUR
                       WHEN 2 THEN base_ingested + INTERVAL 1 DAY
                       ELSE base_ingested END AS ingested
FROM (
    SELECT *, ts + to_hours(CAST(n % 48 AS BIGINT)) AS base_ingested,
           CASE WHEN event_type = 'click' THEN 'cart' ELSE event_type END AS typ0
    FROM (SELECT *, 0 AS variant FROM kept
          UNION ALL SELECT *, 1 FROM kept WHERE n % 25 = 0
          UNION ALL SELECT *, 2 FROM kept WHERE n % 10 = 0)
)
""")

cte("click_landing", """
SELECT event_id, metadata_json, keys_json, raw_payload_json,
       CAST(regexp_extract(filename, 'dt=([^/]+)', 1) AS DATE) AS dt,
       filename, load_id, ingested_at, sha256(raw_payload_json) AS payload_hash
FROM (
    SELECT 'evt_' || CAST(n AS VARCHAR) AS event_id,
           json_object('event_id', 'evt_' || CAST(n AS VARCHAR), 'source_system', 'web_tracker',
                       'schema_version', '1.0', 'batch_id', 'cb_' || strftime(ingested, '%Y%m%d%H'),
                       'ingested_at', CAST(ingested AS VARCHAR))::VARCHAR AS metadata_json,
           json_object('event_id', 'evt_' || CAST(n AS VARCHAR),
                       'user_id', CAST(user_id AS VARCHAR))::VARCHAR AS keys_json,
           json_object(
               'user_id', CASE WHEN n % 33 = 0 THEN NULL WHEN n % 41 = 0 THEN 'u-' || CAST(user_id AS VARCHAR)
                               ELSE CAST(user_id AS VARCHAR) END,
               'user_session', CASE WHEN variant = 2 OR n % 14 = 0 THEN '' ELSE session_text END,
               'event_time', CAST(ts AS VARCHAR),
               'event_type', CASE WHEN n % 7 = 0
                                  THEN ' ' || upper(substr(typ0, 1, 1)) || substr(typ0, 2) || ' '
                                  ELSE typ0 END,
               'product_id', CAST(k AS VARCHAR),
               'category_id', CAST(p_size AS VARCHAR),
               'category_code', p_type,
               'brand', p_brand,
               'price', CASE WHEN n % 50 = 0 THEN 'n/a' WHEN n % 61 = 0 THEN '-' || CAST(value AS VARCHAR)
                             ELSE CAST(value AS VARCHAR) END
           )::VARCHAR AS raw_payload_json,
           'landing/clickstream/dt=' || CAST(CAST(ingested AS DATE) AS VARCHAR) || '/part-0000'
               || CAST(variant AS VARCHAR) || '.jsonl' AS filename,
           'load_' || strftime(ingested, '%Y%m%d%H') AS load_id,
           ingested AS ingested_at
    FROM click_rows
)
""")

cte("pay_kinds", """
SELECT *, ts_e + to_hours(CAST(n % 48 AS BIGINT)) AS ingested
FROM (
    SELECT *, CASE kind WHEN 'charge' THEN pay_ts + INTERVAL 1 MINUTE
                        WHEN 'attempt' THEN pay_ts + INTERVAL 30 SECOND
                        WHEN 'refund' THEN pay_ts + to_days(CAST(n % 5 + 1 AS INTEGER))
                        WHEN 'reject_charge' THEN pay_ts + INTERVAL 2 MINUTE
                        WHEN 'reject_intent' THEN pay_ts - INTERVAL 1 MINUTE
                        ELSE pay_ts END AS ts_e
    FROM (
        SELECT *, 'intent' AS kind FROM purch
        UNION ALL SELECT *, 'charge' FROM purch
        UNION ALL SELECT *, 'attempt' FROM purch WHERE n % 4 = 0
        UNION ALL SELECT *, 'refund' FROM purch WHERE n % 12 = 0
        UNION ALL SELECT *, 'reject_charge' FROM purch WHERE n % 97 = 0
        UNION ALL SELECT *, 'reject_intent' FROM purch WHERE n % 97 = 0
    )
)
""")

cte("purch", """
SELECT *, ts + to_minutes(CAST(n % 90 AS BIGINT)) AS pay_ts,
       CASE WHEN n % 83 = 0 THEN 0 WHEN n % 89 = 0 THEN -1 ELSE 1 END * CAST(round(value * 100) AS BIGINT) AS cents,
       (n % 10) <> 9 AS ok, (n % 10) <> 9 AND n % 71 <> 0 AS charged,
       CAST(n AS VARCHAR) AS nt
FROM kept WHERE event_type = 'purchase'
""")

cte("pay_landing", """
SELECT event_id, metadata_json, keys_json, raw_payload_json,
       CAST(regexp_extract(filename, 'dt=([^/]+)', 1) AS DATE) AS dt,
       filename, load_id, ingested_at, sha256(raw_payload_json) AS payload_hash
FROM (
    SELECT pid AS event_id,
           json_object('event_id', 'env_' || pid, 'source_system', 'payments_api',
                       'schema_version', '1.0', 'batch_id', 'pb_' || strftime(ingested, '%Y%m%d%H'),
                       'ingestion_timestamp', CAST(ingested AS VARCHAR))::VARCHAR AS metadata_json,
           json_object('event_time', CAST(ts_e AS VARCHAR),
                       'user_id', CASE WHEN n % 20 <> 0 THEN CAST(user_id AS VARCHAR) END,
                       'user_session', CASE WHEN n % 5 <> 0 THEN session_text END)::VARCHAR AS keys_json,
           json_object(
               'id', pid, 'api_version', '2023-10-16', 'type', etype,
               'created', date_diff('second', TIMESTAMP '1970-01-01 00:00:00', ts_e),
               'data', json_object('object', json_object(
                   'id', CASE kind WHEN 'intent' THEN 'pi_' || nt WHEN 'charge' THEN 'ch_' || nt
                                   WHEN 'attempt' THEN 'ch_' || nt || '_a'
                                   WHEN 'refund' THEN 're_' || nt END,
                   'status', CASE WHEN kind = 'intent' THEN
                                      CASE WHEN ok THEN 'succeeded' ELSE 'requires_payment_method' END
                                  WHEN kind = 'charge' THEN CASE WHEN charged THEN 'succeeded' ELSE 'failed' END
                                  WHEN kind IN ('attempt', 'reject_charge') THEN 'failed'
                                  WHEN kind = 'refund' THEN
                                      CASE WHEN n % 36 = 0 THEN NULL WHEN n % 60 = 0 THEN 'failed'
                                           ELSE 'succeeded' END
                                  ELSE 'requires_payment_method' END,
                   'amount', CAST(CASE WHEN kind = 'refund' AND n % 156 = 0 THEN cents * 2
                                       WHEN kind = 'refund' AND n % 24 = 0
                                       THEN CAST(floor(cents / 2) AS BIGINT) ELSE cents END AS VARCHAR),
                   'currency', CASE WHEN n % 101 <> 0 THEN 'usd' END,
                   'latest_charge', CASE WHEN kind = 'intent' THEN 'ch_' || nt END,
                   'payment_intent', CASE WHEN kind IN ('charge', 'attempt', 'reject_charge')
                                          THEN 'pi_' || nt || CASE WHEN n % 95 = 0 THEN '_lost' ELSE '' END END,
                   'charge', CASE WHEN kind = 'refund' THEN 'ch_' || nt || CASE WHEN n % 132 = 0 THEN '_lost' ELSE '' END END,
                   'reason', CASE WHEN kind = 'refund' THEN 'requested_by_customer' END,
                   'metadata', CASE WHEN kind IN ('intent', 'refund') THEN json_object(
                       'order_id', 'ord_' || nt,
                       'attempt_number', CASE WHEN kind = 'intent' THEN
                                              CASE WHEN n % 4 = 0 THEN '2' ELSE '1' END END,
                       'payment_method', CASE WHEN kind = 'intent' THEN 'card' END) END,
                   'balance_transaction', CASE WHEN kind IN ('charge', 'attempt') THEN json_object(
                       'fee', CAST(CASE WHEN kind = 'charge' THEN CAST(floor(cents / 30) AS BIGINT)
                                        ELSE 0 END AS VARCHAR),
                       'net', CAST(CASE WHEN kind = 'charge' THEN cents - CAST(floor(cents / 30) AS BIGINT)
                                        ELSE 0 END AS VARCHAR)) END
               ))
           )::VARCHAR AS raw_payload_json,
           CASE WHEN kind = 'refund' THEN 'landing/payments/refunds/dt=' ELSE 'landing/payments/dt=' END
               || CAST(CAST(ingested AS DATE) AS VARCHAR) || '/part-00000.jsonl' AS filename,
           'load_' || strftime(ingested, '%Y%m%d%H') AS load_id,
           ingested AS ingested_at
    FROM (
        SELECT *,
               CASE kind WHEN 'intent' THEN 'evt_pi_' WHEN 'charge' THEN 'evt_ch_'
                         WHEN 'attempt' THEN 'evt_cha_' WHEN 'refund' THEN 'evt_re_'
                         WHEN 'reject_charge' THEN 'evt_chx_' ELSE 'evt_pix_' END || nt AS pid,
               CASE WHEN kind = 'intent' THEN
                        CASE WHEN ok THEN 'payment_intent.succeeded'
                             ELSE 'payment_intent.requires_payment_method' END
                    WHEN kind = 'charge' THEN
                        CASE WHEN n % 7 = 0 THEN upper(CASE WHEN charged THEN 'charge.succeeded' ELSE 'charge.failed' END)
                             ELSE CASE WHEN charged THEN 'charge.succeeded' ELSE 'charge.failed' END END
                    WHEN kind IN ('attempt', 'reject_charge') THEN 'charge.failed'
                    WHEN kind = 'refund' THEN 'refund.created'
                    ELSE 'payment_intent.created' END AS etype
        FROM pay_kinds
    )
)
""")

# ----------------------------------------------------------------- helpers
def _struct(**fields: str) -> str:
    """A json_transform specification: field -> type (or a nested specification)."""
    return "{" + ", ".join(f'"{k}": {v if v.startswith("{") else chr(34) + v + chr(34)}' for k, v in fields.items()) + "}"


def _text(*names: str) -> dict[str, str]:
    return {n: "VARCHAR" for n in names}


def _clean(expr: str) -> str:
    """Blank text counts as missing."""
    return f"CASE WHEN length(trim({expr})) > 0 THEN trim({expr}) END"


def _present(*columns: str) -> str:
    """How many of the columns hold a value."""
    return "len(list_filter([" + ", ".join(f"({c}) IS NOT NULL" for c in columns) + "], lambda held: held))"


def _best(source: str, key: str, *order: str) -> str:
    """One row a key: the greatest by ``order`` (an aggregate, not a numbering)."""
    return (f"SELECT unnest(winner) FROM (SELECT arg_max(x, ROW({', '.join(order)})) AS winner "
            f"FROM ({source}) x GROUP BY {key})")


def _ts(expr: str) -> str:
    """Timestamps as numbers, missing ones before all others."""
    return f"coalesce(epoch_us({expr}), -9000000000000000000)"


def _str(expr: str) -> str:
    """Texts in order, missing ones first."""
    return f"coalesce('+' || {expr}, '')"


# ----------------------------------------------------------------- staging
_CLICK_ENVELOPE = _struct(**_text("source_system", "schema_version", "batch_id", "ingested_at"))
_CLICK_BODY = _struct(**_text("user_id", "user_session", "event_time", "event_type", "product_id",
                              "category_id", "category_code", "brand", "price"))
_PAY_ENVELOPE = _struct(**_text("event_id", "source_system", "schema_version", "batch_id",
                                "ingestion_timestamp"))
_PAY_KEYS = _struct(**_text("event_time", "user_id", "user_session"))
_PAY_BODY = _struct(**_text("api_version", "type", "created"))
_LAST_DELIVERY = (_ts("ingested_at"), _str("filename"), _str("load_id"))

cte("stg_click", f"""
SELECT event_id, env.source_system, env.schema_version, env.batch_id,
       TRY_CAST(env.ingested_at AS TIMESTAMP) AS envelope_timestamp,
       TRY_CAST(body.user_id AS BIGINT) AS user_id, body.user_id AS user_id_raw, body.user_session,
       TRY_CAST(body.event_time AS TIMESTAMP) AS event_ts, body.event_type, body.product_id,
       body.category_id, body.category_code, body.brand, body.price,
       dt, filename, load_id, ingested_at, payload_hash, raw_payload_json
FROM (SELECT *, json_transform(metadata_json, '{_CLICK_ENVELOPE}') AS env,
             json_transform(raw_payload_json, '{_CLICK_BODY}') AS body
      FROM ({_best("SELECT * FROM click_landing", "payload_hash", *_LAST_DELIVERY)}))
""")

cte("stg_pay", f"""
SELECT env.event_id AS envelope_event_id, env.source_system, env.schema_version, env.batch_id,
       TRY_CAST(env.ingestion_timestamp AS TIMESTAMP) AS envelope_timestamp,
       event_id AS provider_event_id, body.api_version,
       TRY_CAST(k.event_time AS TIMESTAMP) AS event_time, TRY_CAST(k.user_id AS BIGINT) AS user_id, k.user_id AS user_id_raw,
       k.user_session, to_timestamp(TRY_CAST(body.created AS BIGINT)) AT TIME ZONE 'UTC' AS provider_created_ts,
       body.type AS event_type, dt, filename, load_id, ingested_at, payload_hash, raw_payload_json
FROM (SELECT *, json_transform(metadata_json, '{_PAY_ENVELOPE}') AS env,
             json_transform(keys_json, '{_PAY_KEYS}') AS k,
             json_transform(raw_payload_json, '{_PAY_BODY}') AS body
      FROM ({_best("SELECT * FROM pay_landing", "payload_hash", *_LAST_DELIVERY)}))
""")

_CLEANED = ", ".join(f"{_clean(c)} AS {c}" for c in (
    "user_session", "provider_event_id", "envelope_event_id", "api_version", "source_system",
    "schema_version", "batch_id"))
cte("pay_tidy", f"""
SELECT user_id, {_CLEANED}, coalesce(event_time, provider_created_ts) AS event_time,
       coalesce(ingested_at, envelope_timestamp) AS received_ts, lower(trim(event_type)) AS event_type,
       dt, filename, ingested_at, payload_hash, raw_payload_json
FROM stg_pay
""")
cte("pay_clean", f"""
SELECT *, CAST(event_time AS DATE) AS event_date
FROM ({_best("SELECT *, coalesce(provider_event_id, envelope_event_id, payload_hash) AS event_pk FROM pay_tidy", "event_pk",
             "CASE event_pk WHEN provider_event_id THEN 3 WHEN envelope_event_id THEN 2 ELSE 1 END",
             "(event_time IS NOT NULL)", "(event_type IS NOT NULL)", _ts("received_ts"),
             _str("schema_version"), _str("batch_id"), _str("payload_hash"))})
WHERE event_pk IS NOT NULL
""")

# ---------------------------------------------------- objects of the payment feed
_OBJECT = _struct(data=_struct(object=_struct(
    **_text("id", "status", "amount", "currency", "latest_charge", "payment_intent", "charge", "reason"),
    metadata=_struct(**_text("order_id", "attempt_number", "payment_method")),
    balance_transaction=_struct(**_text("fee", "net")))))


def _objects(source: str, family: str) -> str:
    """Rows of one event family with the delivered object as a struct ``o``."""
    return (f"SELECT *, json_transform(raw_payload_json, '{_OBJECT}').data.object AS o "
            f"FROM {source} WHERE starts_with(lower(event_type), '{family}.')")


def _family(source: str, family: str, fields: dict[str, str]) -> str:
    named = ", ".join(f"{expr} AS {name}" for name, expr in fields.items())
    return f"SELECT {named} FROM ({_objects(source, family)}) WHERE o.id IS NOT NULL"


_MONEY = {"status": _clean("o.status"), "amount_cents": "TRY_CAST(o.amount AS BIGINT)",
          "currency": _clean("o.currency")}
_ORIGIN = {"event_type": "nullif(lower(trim(event_type)), '')", "provider_event_id": _clean("provider_event_id")}
_WHEN = {"event_time": "coalesce(event_time, provider_created_ts)", "received_ts": "ingested_at"}

cte("intents", f"""
SELECT *, amount_cents / 100 AS amount_gross
FROM ({_best(_family("pay_clean", "payment_intent", {
    "payment_intent_id": _clean("o.id"), "event_time": "event_time", "received_ts": "received_ts", **_MONEY,
    "latest_charge_id": _clean("o.latest_charge"), "order_id": _clean("o.metadata.order_id"),
    "attempt_number": "TRY_CAST(o.metadata.attempt_number AS INTEGER)",
    "payment_method": _clean("o.metadata.payment_method"), **_ORIGIN, "user_id": "user_id",
    "user_session": "user_session"}), "payment_intent_id",
    _present("event_time", "status", "amount_cents", "currency"), _ts("received_ts"), _str("provider_event_id"))})
WHERE payment_intent_id IS NOT NULL
""")

cte("charges_t", f"""
SELECT *, amount_cents / 100 AS amount_gross, fee_cents / 100 AS fee, net_cents / 100 AS amount_net
FROM ({_best(_family("stg_pay", "charge", {
    "charge_id": _clean("o.id"), **_WHEN, **_MONEY, "payment_intent_id": _clean("o.payment_intent"),
    "fee_cents": "TRY_CAST(o.balance_transaction.fee AS BIGINT)",
    "net_cents": "TRY_CAST(o.balance_transaction.net AS BIGINT)", **_ORIGIN}), "charge_id",
    _present("event_time", "status", "amount_cents", "currency", "fee_cents", "net_cents"),
    _ts("received_ts"), _str("provider_event_id"))})
WHERE charge_id IS NOT NULL
""")

# The first delivery of a refund counts: negated times make it the greatest, missing ones the least.
_FIRST = [f"-coalesce(epoch_us({c}), 9000000000000000000)" for c in ("received_ts", "event_time")]
cte("refunds_t", f"""
SELECT *, amount_cents / 100 AS amount_refunded
FROM ({_best(_family("stg_pay", "refund", {
    "refund_id": _clean("o.id"), **_WHEN, **_MONEY, "reason": _clean("o.reason"),
    "charge_id": _clean("o.charge"), "order_id": _clean("o.metadata.order_id"), **_ORIGIN}), "refund_id", *_FIRST)})
""")

cte("charges_bad", f"""
SELECT provider_event_id, lower(trim(event_type)) AS event_type,
       coalesce(event_time, provider_created_ts) AS event_ts, ingested_at AS received_ts,
       o.id AS charge_id, 'charge_id is null' AS rejection_reason
FROM ({_objects("stg_pay", "charge")}) WHERE o.id IS NULL
""")

cte("intents_bad", f"""
SELECT provider_event_id, event_type, event_time, received_ts, o.id AS payment_intent_id,
       'payment_intent_id is null' AS rejection_reason
FROM ({_objects("pay_clean", "payment_intent")}) WHERE o.id IS NULL
""")

# ------------------------------------------------------------ payment fact
cte("charge_of_intent", f"""
SELECT payment_intent_id, min(event_time) FILTER (WHERE won) AS succeeded_at,
       arg_max({{'charge_id': charge_id, 'cents': amount_cents, 'currency': currency}},
               ROW(won, {_ts("event_time")}, {_ts("received_ts")}, {_str("charge_id")})) AS charge
FROM (SELECT *, coalesce(lower(status), '') = 'succeeded' AS won FROM charges_t)
WHERE payment_intent_id IS NOT NULL
GROUP BY payment_intent_id
""")

cte("refunded", """
SELECT c.payment_intent_id, CAST(sum(r.amount_cents) AS BIGINT) AS cents
FROM charges_t c JOIN refunds_t r USING (charge_id)
WHERE c.payment_intent_id IS NOT NULL AND coalesce(lower(r.status), 'succeeded') = 'succeeded'
GROUP BY c.payment_intent_id
""")

cte("payments", """
SELECT i.payment_intent_id, i.event_time AS payment_intent_event_ts, t.succeeded_at,
       t.succeeded_at IS NOT NULL OR coalesce(lower(i.status), '') = 'succeeded' AS is_succeeded,
       i.status, coalesce(i.amount_cents, t.charge.cents) AS amount_cents,
       coalesce(i.currency, t.charge.currency) AS currency, t.charge.charge_id AS charge_id,
       coalesce(f.cents, 0) AS refunded_cents, i.user_id, i.user_session, i.order_id, i.attempt_number,
       i.payment_method, i.received_ts AS last_received_ts
FROM intents i LEFT JOIN charge_of_intent t USING (payment_intent_id) LEFT JOIN refunded f USING (payment_intent_id)
""")

# ------------------------------------------------------------ click facts
_EVENT_TEXTS = ", ".join(f"{_clean(c)} AS {c}" for c in (
    "user_session", "product_id", "category_id", "category_code", "source_system", "schema_version", "batch_id"))
cte("fevents", f"""
SELECT *, CAST(event_time AS DATE) AS event_date
FROM ({_best(f'''SELECT coalesce({_clean("event_id")}, payload_hash) AS event_pk, event_ts AS event_time,
              ingested_at AS received_ts, nullif(lower(trim(event_type)), '') AS event_type, user_id, user_id_raw,
              {_EVENT_TEXTS}, brand, TRY_CAST(price AS DOUBLE) AS price, dt, filename, load_id, ingested_at, payload_hash
       FROM stg_click''', "event_pk", _present("event_time", "user_id_raw", "event_type", "user_session"),
       _ts("received_ts"), _str("payload_hash"))})
WHERE event_pk IS NOT NULL
""")

cte("sess_base", """
SELECT user_session AS session_id, max(user_id) AS user_id, min(event_time) AS session_start_at,
       max(event_time) AS session_end_at,
       date_diff('second', min(event_time), max(event_time)) AS session_duration_seconds,
       CAST(min(event_time) AS DATE) AS session_date, count(*) AS events_count,
       len(list_distinct(list(event_type))) AS distinct_event_types_count, count(*) = 1 AS is_bounce,
       coalesce(bool_or(event_type = 'view'), false) AS has_product_view,
       coalesce(bool_or(event_type = 'cart'), false) AS has_add_to_cart,
       coalesce(bool_or(event_type = 'purchase'), false) AS has_purchase_event,
       max(received_ts) AS last_received_ts
FROM fevents GROUP BY user_session HAVING user_session IS NOT NULL
""")

# ------------------------------------------------------------ attribution
cte("rules", """
SELECT * FROM (VALUES ('user_session', 100), ('user_id', 50)) AS r(matched_type, base_score)
""")
cte("cand", """
SELECT p.payment_intent_id, p.payment_intent_event_ts AS payment_event_time, p.last_received_ts,
       e.event_pk AS event_id, e.event_time AS clickstream_time, e.received_ts AS clickstream_received_ts,
       e.event_type, e.user_id AS event_user_id, e.user_session AS event_user_session,
       p.base_score + CASE e.event_type WHEN 'purchase' THEN 20 ELSE 0 END AS match_score, p.matched_type,
       date_diff('second', e.event_time, p.payment_intent_event_ts) AS time_diff_seconds
FROM (SELECT *, CASE matched_type WHEN 'user_id' THEN CAST(user_id AS VARCHAR) ELSE user_session END AS match_key
      FROM payments CROSS JOIN rules) p
JOIN (SELECT *, CASE matched_type WHEN 'user_id' THEN CAST(user_id AS VARCHAR) ELSE user_session END AS match_key
      FROM fevents CROSS JOIN rules) e
  ON p.matched_type = e.matched_type AND p.match_key = e.match_key
 AND abs(epoch_us(e.event_time) - epoch_us(p.payment_intent_event_ts)) <= 3600000000
""")

cte("map_event", """
SELECT unnest(winner) FROM (
    SELECT arg_min({'payment_intent_id': payment_intent_id, 'event_id': event_id, 'event_user_id': event_user_id,
                    'event_user_session': event_user_session, 'event_type': event_type, 'matched_type': matched_type,
                    'match_score': match_score, 'payment_event_time': payment_event_time,
                    'clickstream_time': clickstream_time, 'time_diff_seconds': time_diff_seconds,
                    'last_received_ts': last_received_ts},
                   ROW(-match_score, abs(time_diff_seconds),
                       -coalesce(epoch_us(clickstream_received_ts), -9000000000000000000), event_id)) AS winner
    FROM cand GROUP BY payment_intent_id)
""")

cte("map_session", """
SELECT m.*, s.session_id, s.session_id IS NOT NULL AS is_session_found, m.event_user_id = s.user_id AS is_user_consistent
FROM map_event m LEFT JOIN sess_base s ON m.event_user_session = s.session_id
""")

cte("paid_matches", """
SELECT m.session_id, p.payment_intent_id, p.amount_cents, p.refunded_cents
FROM payments p JOIN map_session m USING (payment_intent_id)
WHERE p.is_succeeded AND m.is_session_found
""")
cte("sess", """
SELECT s.*, coalesce(len(t.ids), 0) AS payments_count, t.ids IS NOT NULL AS has_purchase,
       coalesce(t.rev, 0) AS revenue_cents, coalesce(t.back, 0) AS refunded_cents
FROM sess_base s LEFT JOIN (
    SELECT session_id, list_distinct(list(payment_intent_id)) AS ids, CAST(sum(amount_cents) AS BIGINT) AS rev,
           CAST(sum(refunded_cents) AS BIGINT) AS back
    FROM paid_matches GROUP BY session_id) t USING (session_id)
""")

# ------------------------------------------------------------- daily facts
# Facts of a day are stacked and added up once. A missing key matches nothing,
# so its rows exist but their measures stay 0.
def _added(measure: str, key: str) -> str:
    return f"CAST(coalesce(sum({measure}) FILTER (WHERE {key} IS NOT NULL AND activity_date IS NOT NULL), 0) AS BIGINT)"


cte("user_daily", f"""
SELECT *, sessions_count > 0 AS is_active, payments_count > 0 AS is_payer_day,
       CAST(activity_date - CAST(isodow(activity_date) - 1 AS INTEGER) AS DATE) AS week
FROM (SELECT user_id, activity_date, {", ".join(f"{_added(c, 'user_id')} AS {c}" for c in (
        "sessions_count", "events_count", "payments_count", "revenue_cents", "refunded_cents"))}
      FROM (SELECT user_id, session_date AS activity_date, 1 AS sessions_count, events_count,
                   0 AS payments_count, 0 AS revenue_cents, 0 AS refunded_cents FROM sess
            UNION ALL BY NAME
            SELECT user_id, CAST(payment_intent_event_ts AS DATE) AS activity_date, CAST(is_succeeded AS INTEGER) AS payments_count,
                   CASE WHEN is_succeeded THEN amount_cents END AS revenue_cents, greatest(refunded_cents, 0) AS refunded_cents
            FROM payments)
      WHERE activity_date IS NOT NULL GROUP BY user_id, activity_date)
""")

cte("product_daily", f"""
SELECT *, views_count > 0 AS had_view, payments_count > 0 AS had_payment
FROM (SELECT product_id, activity_date, {", ".join(f"{_added(c, 'product_id')} AS {c}" for c in (
        "events_count", "views_count", "add_to_cart_count", "purchase_events_count", "payments_count",
        "revenue_cents", "refunded_cents"))}
      FROM (SELECT product_id, CAST(event_time AS DATE) AS activity_date, 1 AS events_count,
                   CAST(event_type = 'view' AS INTEGER) AS views_count, CAST(event_type = 'cart' AS INTEGER) AS add_to_cart_count,
                   CAST(event_type = 'purchase' AS INTEGER) AS purchase_events_count FROM fevents
            UNION ALL BY NAME
            SELECT e.product_id, CAST(e.event_time AS DATE) AS activity_date, CAST(p.is_succeeded AS INTEGER) AS payments_count,
                   CASE WHEN p.is_succeeded THEN p.amount_cents END AS revenue_cents, greatest(p.refunded_cents, 0) AS refunded_cents
            FROM fevents e JOIN map_event m ON e.event_pk = m.event_id JOIN payments p USING (payment_intent_id))
      WHERE product_id IS NOT NULL GROUP BY product_id, activity_date)
""")

cte("users_dim", """
SELECT *, CAST(first_session_at AS DATE) AS first_seen_date, first_purchase_at IS NOT NULL AS is_payer,
       first_purchase_at IS NOT NULL AS user_type
FROM (SELECT user_id, min(started) AS first_session_at, max(started) AS last_session_at,
             min(paid) FILTER (WHERE user_id IS NOT NULL) AS first_purchase_at,
             max(paid) FILTER (WHERE user_id IS NOT NULL) AS last_purchase_at,
             CAST(coalesce(sum(cents) FILTER (WHERE user_id IS NOT NULL), 0) AS BIGINT) AS lifetime_revenue_cents
      FROM (SELECT user_id, 1 AS visit, session_start_at AS started FROM sess
            UNION ALL BY NAME
            SELECT user_id, payment_intent_event_ts AS paid, CASE WHEN is_succeeded THEN amount_cents END AS cents FROM payments)
      GROUP BY user_id HAVING count(visit) > 0)
""")

cte("products_dim", f"""
SELECT product_id, attrs.*, first_seen_at, last_seen_at, events_count, last_received_ts
FROM (SELECT product_id, min(event_time) AS first_seen_at, max(event_time) AS last_seen_at, count(*) AS events_count,
             max(received_ts) AS last_received_ts,
             arg_max({{'brand': brand, 'category_id': category_id, 'category_code': category_code, 'price': price}},
                     ROW({_ts("event_time")}, {_ts("received_ts")}, {_str("event_pk")})) AS attrs
      FROM fevents GROUP BY product_id HAVING product_id IS NOT NULL)
""")

# ----------------------------------------------------------------- metrics
# A user's active day counts for the 30 days from it on; the lag says for which windows.
cte("m_dau", """
SELECT days.activity_date, count(DISTINCT user_id) FILTER (WHERE lag = 0) AS dau,
       count(DISTINCT user_id) FILTER (WHERE lag < 7) AS wau, count(DISTINCT user_id) AS mau
FROM (SELECT user_id, activity_date + lag AS activity_date, lag
      FROM (SELECT user_id, activity_date, unnest(range(30))::INTEGER AS lag FROM user_daily WHERE is_active)) spread
JOIN (SELECT DISTINCT activity_date FROM user_daily WHERE is_active) days USING (activity_date)
GROUP BY days.activity_date
""")

_FUNNEL = """
SELECT session_date, CAST(sum(weight) AS BIGINT) AS sessions,
       CAST(sum(weight * has_product_view::INTEGER) AS BIGINT) AS sessions_with_view,
       CAST(sum(weight * has_add_to_cart::INTEGER) AS BIGINT) AS sessions_with_cart,
       CAST(sum(weight * has_purchase_event::INTEGER) AS BIGINT) AS sessions_with_purchase_event,
       CAST(sum(paid) AS BIGINT) AS sessions_with_payment
FROM ({rows}) GROUP BY session_date
"""
# A session joined to its payments appears once for each of them, and once without any.
cte("m_funnel", _FUNNEL.format(rows="""
    SELECT s.*, coalesce(n, 0) AS paid, greatest(coalesce(n, 0), 1) AS weight
    FROM sess s LEFT JOIN (SELECT session_id, count(*) AS n FROM paid_matches GROUP BY session_id) USING (session_id)"""))
cte("m_funnel_distinct", _FUNNEL.format(rows="SELECT *, has_purchase::INTEGER AS paid, 1 AS weight FROM sess"))

cte("m_retention", """
SELECT cohort_date, cohort_age_days, count(*) AS retained_users, any_value(size) AS cohort_sizes,
       count(*) / any_value(size) AS retention_rate
FROM (SELECT u.first_seen_date AS cohort_date, count(u.user_id) OVER (PARTITION BY u.first_seen_date) AS size,
             list_distinct(a.days) AS days, u.first_seen_date AS born
      FROM users_dim u LEFT JOIN (SELECT user_id, list(activity_date) AS days FROM user_daily WHERE is_active GROUP BY user_id) a
        USING (user_id)) c,
     LATERAL (SELECT unnest(c.days) - c.born AS cohort_age_days) ages
WHERE cohort_age_days >= 0
GROUP BY cohort_date, cohort_age_days
""")

cte("m_repeat", """
WITH buyers AS (
    SELECT user_id, list_sort(list_distinct(list(payment_intent_event_ts))) AS times
    FROM payments WHERE is_succeeded GROUP BY user_id
), cohorts AS (
    SELECT CAST(date_trunc('week', times[1]) AS DATE) AS cohort_week, count(user_id) AS cohort_size,
           list(CASE WHEN user_id IS NOT NULL AND len(times) > 1
                     THEN CAST(times[2] AS DATE) - CAST(times[1] AS DATE) END) AS gaps
    FROM buyers GROUP BY 1
)
SELECT cohort_week, horizon AS cohort_age_days, len(list_filter(gaps, lambda g: g <= horizon)) AS retained_users, cohort_size,
       len(list_filter(gaps, lambda g: g <= horizon)) / nullif(cohort_size, 0) AS retention_rate
FROM (SELECT *, unnest([1, 7, 14, 21, 30, 60])::BIGINT AS horizon FROM cohorts)
""")

cte("cohort_net", """
SELECT u.first_seen_date AS cohort_date, d.activity_date - u.first_seen_date AS age,
       CAST(sum(d.revenue_cents - d.refunded_cents) AS BIGINT) AS net_cents
FROM user_daily d JOIN users_dim u USING (user_id)
WHERE d.activity_date >= u.first_seen_date GROUP BY ALL
""")
# `carried` says whether ages without revenue show the running total or 0.
_LTV = """
SELECT c.cohort_date, c.age AS cohort_age_days, c.cohort_size, coalesce(n.net_cents, 0) AS net_cents,
       CASE WHEN n.age IS NOT NULL OR {carried} THEN
           CAST(coalesce((SELECT sum(e.net_cents) FROM cohort_net e WHERE e.cohort_date = c.cohort_date AND e.age <= c.age), 0) AS BIGINT)
       ELSE 0 END AS cum_cents
FROM (SELECT first_seen_date AS cohort_date, count(user_id) AS cohort_size, unnest({ages}) AS age
      FROM users_dim GROUP BY first_seen_date) c
LEFT JOIN cohort_net n ON n.cohort_date = c.cohort_date AND n.age = c.age
"""
cte("m_ltv", _LTV.format(carried="false", ages="range(31)"))
cte("m_ltv_filled", _LTV.format(carried="true", ages="range(31)"))
cte("m_ltv_all60", _LTV.format(carried="true", ages="range(61)"))
# For each cohort as many ages as its users were seen at.
cte("m_ltv_observed", _LTV.format(
    carried="true", ages="range(coalesce((SELECT max(age) FROM cohort_net x WHERE x.cohort_date = first_seen_date), 0) + 1)"))

cte("m_unit", """
SELECT activity_date, len(list_distinct(list(CASE WHEN is_active THEN user_id END))) AS active_users,
       len(list_distinct(list(CASE WHEN is_payer_day THEN user_id END))) AS paying_users,
       CAST(sum(revenue_cents) AS BIGINT) AS revenue_cents
FROM user_daily GROUP BY activity_date
""")


_REF = re.compile(r"\b(?:FROM|JOIN)\s+([A-Za-z_][A-Za-z0-9_]*)", re.IGNORECASE)


def _deps(body: str) -> list[str]:
    return [n for n in dict.fromkeys(_REF.findall(body)) if n in CTES]


def sql_for(final: str, existing: frozenset[str] = frozenset()) -> str:
    """``WITH`` the CTEs ``final`` needs (transitively, in dependency order);
    names in ``existing`` are tables already present and are not expanded."""
    order: list[str] = []
    seen: set[str] = set(existing)

    def visit(name: str) -> None:
        if name in seen:
            return
        seen.add(name)
        for d in _deps(CTES[name]):
            visit(d)
        order.append(name)

    for d in _deps(final):
        visit(d)
    if not order:
        return final
    withs = ",\n".join(f"{n} AS (\n{CTES[n]}\n)" for n in order)
    body = final.lstrip()
    if body[:5].upper() == "WITH ":
        return f"WITH {withs},\n{body[5:]}"
    return f"WITH {withs}\n{final}"
