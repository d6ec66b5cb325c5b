"""Raw feed landing.

Feeds arrive as JSON-lines files under ``dt=YYYY-MM-DD/`` folders, one JSON
object per line with three sub-objects (``metadata``, ``keys``,
``raw_payload``). They are read with an explicit schema (each sub-object kept
as JSON text), the partition date comes from the file path, and ``land``
appends only payloads whose content hash the target does not hold yet. Lines
that are no envelope go to a quarantine table, once each.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.functions.dedup import keep_first
from cartwheel.sources import payload_filter, schemas

from cartwheel.fixed_values import DT_PATTERN  # noqa: E402

# Source declarations (S8): source name -> layout under a landing root.
SOURCES = {
    "landing.clickstream_events_raw": "clickstream",
    "landing.payment_events_raw": "payments",
}


def load_source(spark: SparkSession, name: str, root: str) -> DataFrame:
    """A declared landing table by name, read from ``<root>/<layout>``."""
    return read_landing_table(spark, f"{root.rstrip('/')}/{SOURCES[name]}")


def feed_lines(lines: DataFrame) -> DataFrame:
    """Parsed lines of a feed read as text: the envelope, the line itself and where it stands.

    ``line`` is set only if the line is no envelope (cut off, no JSON, no object): such
    lines go to quarantine (``quarantined``). Blank lines are no lines.
    """
    file_path = F.col("_metadata.file_path")
    parsed = F.from_json("value", schemas.ENVELOPE_OR_LINE, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": schemas.LINE})
    return (lines.select(parsed.alias("_e"), "value", file_path.alias("filename"),
                         F.to_date(F.regexp_extract(file_path, DT_PATTERN, 1)).alias("dt"))
            .where(F.trim("value") != "")
            .select("_e.metadata", "_e.keys", "_e.raw_payload", "dt", "filename",
                    F.when(F.col("_e").isNull() | F.col(f"_e.{schemas.LINE}").isNotNull(), F.col("value")).alias("line")))


def envelopes(parsed: DataFrame, id_source: str, id_path: str) -> DataFrame:
    """The readable lines as landing columns."""
    return parsed.where(F.col("line").isNull()).select(
        F.get_json_object(F.col(id_source), id_path).alias("event_id"),
        F.col("metadata").alias("metadata_json"),
        F.col("keys").alias("keys_json"),
        F.col("raw_payload").alias("raw_payload_json"),
        "dt", "filename")


def quarantined(parsed: DataFrame) -> DataFrame:
    """The unreadable lines with their text, its hash, and file and date."""
    return parsed.where(F.col("line").isNotNull()).select(
        "line", F.sha2("line", 256).alias("line_hash"), "dt", "filename")


#: Where a feed's event id stands: clicks in the envelope's metadata, payments in the provider's payload.
CLICK_ID, PAYMENT_ID = ("metadata", "$.event_id"), ("raw_payload", "$.id")


def read_clickstream(spark: SparkSession, path: str) -> DataFrame:
    """Clickstream feed (S1): event id from the envelope metadata."""
    return envelopes(feed_lines(spark.read.text(path)), *CLICK_ID)


def read_payments(spark: SparkSession, path: str, refunds_path: str | None = None) -> DataFrame:
    """Payment feed (S2): event id from the provider payload; refunds live in a
    separate sub-tree and are unioned by name."""
    df = envelopes(feed_lines(spark.read.text(path)), *PAYMENT_ID)
    if refunds_path:
        df = df.unionByName(envelopes(feed_lines(spark.read.text(refunds_path)), *PAYMENT_ID),
                            allowMissingColumns=True)
    return df


def read_quarantined(spark: SparkSession, *paths: str) -> DataFrame:
    """The unreadable lines of a feed's files."""
    return quarantined(feed_lines(spark.read.text(list(paths))))


def fingerprint(payload_json) -> F.Column:
    """Content hash of a payload (S6): hex SHA-256 of its JSON text."""
    c = F.col(payload_json) if isinstance(payload_json, str) else payload_json
    return F.sha2(c, 256)


def _stamp(load_id: str | None, now: dt.datetime | None) -> tuple[str, dt.datetime]:
    return load_id or str(uuid.uuid4()), now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def _or_own(hash_col: str) -> F.Column:
    """The hash, or for a row without one a text of its own that no hash equals."""
    return F.coalesce(hash_col, F.concat_ws(" ", F.lit("no payload"), "filename", "metadata_json", "keys_json"))


def land(raw: DataFrame, target: DataFrame | None = None, load_id: str | None = None,
         now: dt.datetime | None = None, filters: DataFrame | None = None) -> DataFrame:
    """Stamp a load (S5), fingerprint (S6) and keep payloads new to ``target``.

    The load id and time are one driver-side literal per run. Duplicates
    *within* the load are kept (staging removes them), as in the reference. Rows
    without a payload have no hash, are in no table and land with every delivery;
    they are spread by what else they hold instead of meeting in one task.
    Without ``filters`` the anti join is the only pass: one scan of the load, one
    of the target's hashes, both plain shuffles by hash, so AQE splits the copies
    of a payload that is delivered very often. With the target's filters
    (``payload_filter``) only hashes that a filter lets through are looked up, in
    the ``dt`` folders that it names; a load of new payloads reads no stored hash.
    """
    load_id, now = _stamp(load_id, now)
    stamped = raw.select(
        "event_id", "metadata_json", "keys_json", "raw_payload_json", "dt", "filename",
        F.lit(load_id).alias("load_id"),
        F.lit(now).cast("timestamp_ntz").alias("ingested_at"),
        fingerprint("raw_payload_json").alias("payload_hash"))
    if target is None:
        return stamped
    seen = target.select("payload_hash", "dt").where(F.col("payload_hash").isNotNull())
    if filters is not None:
        hits = payload_filter.possible(stamped.select("payload_hash").dropna().distinct(), filters)
        folders = [r[0] for r in hits.select("dt").distinct().collect()]  # at most one a dt folder
        if not folders:
            return stamped
        seen = (seen.where(F.col("dt").isin([d for d in folders if d is not None]) | (F.col("dt").isNull() if None in folders else F.lit(False)))
                .join(hits.select(F.col("payload_hash").alias("_h")).distinct(), F.col("payload_hash") == F.col("_h"), "left_semi"))
    seen = seen.select(F.col("payload_hash").alias("_seen"))
    return stamped.join(seen, _or_own("payload_hash") == F.col("_seen"), "left_anti")


def quarantine(bad: DataFrame, target: DataFrame | None = None, load_id: str | None = None,
               now: dt.datetime | None = None) -> DataFrame:
    """Unreadable lines new to the reject table: a line's text lands once, from the first file that has it."""
    load_id, now = _stamp(load_id, now)
    once = keep_first(bad, ["line_hash"], [F.col("filename"), F.col("dt")])
    stamped = once.select("line", "line_hash", "dt", "filename", F.lit(load_id).alias("load_id"),
                          F.lit(now).cast("timestamp_ntz").alias("ingested_at"))
    return stamped if target is None else stamped.join(target.select("line_hash"), "line_hash", "left_anti").select(*stamped.columns)


class LandingTable:
    """A landing table with the filters of its payload hashes and its quarantine.

    ``<root>/rows`` (Parquet by ``dt``), ``<root>/filters``, ``<root>/rejects``. A load first adds the filters of its
    hashes and then its rows: a stop in between leaves filters that let too much through, never too little.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _exists(self, part: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{part}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def rows(self) -> DataFrame:
        return read_landing_table(self.spark, f"{self.root}/rows") if self._exists("rows") else self.spark.createDataFrame([], schemas.LANDING)

    def rejects(self) -> DataFrame:
        path = f"{self.root}/rejects"
        return self.spark.read.schema(schemas.REJECTS).parquet(path) if self._exists("rejects") else self.spark.createDataFrame([], schemas.REJECTS)

    def filters(self) -> DataFrame:
        path = f"{self.root}/filters"
        return (self.spark.read.schema(payload_filter.SCHEMA).parquet(path) if self._exists("filters")
                else self.spark.createDataFrame([], payload_filter.SCHEMA))

    def load(self, parsed: DataFrame, id_source: str, id_path: str, load_id: str | None = None, now: dt.datetime | None = None) -> None:
        """Land a delivery (``feed_lines``): new payloads and new unreadable lines."""
        load_id, now = _stamp(load_id, now)
        target = self.rows() if self._exists("rows") else None
        new = land(envelopes(parsed, id_source, id_path), target, load_id, now, self.filters() if target is not None else None)
        payload_filter.build(new, load_id).write.mode("append").parquet(f"{self.root}/filters")
        append_landing_table(new, f"{self.root}/rows")
        quarantine(quarantined(parsed), self.rejects(), load_id, now).write.mode("append").parquet(f"{self.root}/rejects")


def envelope_lines(landing: DataFrame) -> DataFrame:
    """Landing rows back to raw JSON lines (``value``) plus their ``dt``."""
    line = F.concat(F.lit('{"metadata":'), F.col("metadata_json"), F.lit(',"keys":'),
                    F.col("keys_json"), F.lit(',"raw_payload":'), F.col("raw_payload_json"),
                    F.lit("}"))
    return landing.select(line.alias("value"), "dt")


def write_jsonl(lines: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write JSON lines partitioned into ``dt=`` folders (the raw feed layout)."""
    lines.write.mode(mode).partitionBy("dt").text(path)


def append_landing_table(rows: DataFrame, path: str) -> None:
    """Append landing rows to the landing table (S4): typed columns, Parquet,
    partitioned by ``dt`` so date-bounded reads prune whole folders; documents
    take a third less disk as zstd than by the default codec."""
    cols = [f.name for f in schemas.LANDING.fields]
    rows.select(*cols).write.mode("append").option("compression", "zstd").partitionBy("dt").parquet(path)


def read_landing_table(spark: SparkSession, path: str) -> DataFrame:
    """The landing table with its declared schema (``dt`` from the folders)."""
    return spark.read.schema(schemas.LANDING).parquet(path)
