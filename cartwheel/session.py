"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job assumes: timestamps are zone-less business times read in
# UTC, AQE re-plans shuffles at runtime (coalescing, skew-join splitting).
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the jobs depend on (idempotent)."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


# File sizes say little about how large the rows of a few columns are: with these, a side of a join is broadcast only by
# the size that its rows were found to have, which bounds what the driver holds however large the tables get.
MEASURED_BROADCASTS = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "1m"}


@contextmanager
def session_conf(spark: SparkSession, conf: Mapping[str, str]) -> Iterator[None]:
    """Settings of the session for a while; what was set before comes back."""
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "cartwheel") -> SparkSession:
    """A local session for tests and the bench (the UI stays off)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("CARTWHEEL_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - e.g. a Spark Connect session has no SparkContext
        return None


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for written tables and checkpoints.

    On a cluster this is whatever ``spark.checkpoint.dir`` names (a shared
    filesystem); a cluster without it is an error. Only a local master gets a
    folder of its own, registered so that ``DataFrame.checkpoint`` works too.
    """
    sc = _context(spark)
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current.rstrip("/")
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        if sc is not None:
            sc.setCheckpointDir(conf_dir)
        return conf_dir.rstrip("/")
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local_dir = tempfile.mkdtemp(prefix="cartwheel-ckpt-")
    if sc is None:
        return local_dir
    sc.setCheckpointDir(local_dir)
    # setCheckpointDir adds a per-application sub folder; reuse that path
    return (sc.getCheckpointDir() or local_dir).rstrip("/")


def session_key(spark: SparkSession) -> str:
    """Identity of the running application (for per-application caches)."""
    sc = _context(spark)
    if sc is not None:
        return sc.applicationId
    return spark.conf.get("spark.app.id", None) or str(id(spark))


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the checkpoint root for a written table."""
    root = checkpoint_root(spark)
    return "/".join([root, "tables", *parts])


def new_run_id() -> str:
    return uuid.uuid4().hex[:12]
