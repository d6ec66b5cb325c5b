"""Helpers shared by the operators: inputs, shipped code, written tables, Arrow text."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_shipped: set[str] = set()
#: Rows and bytes of an Arrow batch. Texts are long; a task holds a few batches on both sides.
BATCH_CONF = {"spark.sql.execution.arrow.maxRecordsPerBatch": 2000, "spark.sql.execution.arrow.maxBytesPerBatch": 8 << 20}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; the path may be in any store that Spark reads."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Give the executors this package (Spark's own file server carries one zip).

    Python tasks refer to the operators' functions by module, so a cluster whose
    machines don't hold the repository still finds them, and what a worker keeps
    in a module (token caches) outlives a task. Done once per application. Arrow
    batches of the session are kept small (a smaller setting stays).
    """
    for name, most in BATCH_CONF.items():
        now = spark.conf.get(name, None)
        if not (now or "").isdigit() or not 0 < int(now) <= most:
            spark.conf.set(name, str(most))
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
        parent = os.path.dirname(PACKAGE_ROOT)
        for folder, _, files in os.walk(PACKAGE_ROOT):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, parent))
    target = os.path.join(tempfile.mkdtemp(prefix="cartwheel-code-"), "cartwheel_code.zip")
    with open(target, "wb") as out:
        out.write(buffer.getvalue())
    sc.addPyFile(target)
    _shipped.add(sc.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, from ``spark.checkpoint.dir``.

    Only a local master without that setting gets a folder of its own (tests);
    a cluster without it is an error, because tables written to one machine's
    disk can't be read from the others.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="cartwheel-llm-"))
        named = sc.getCheckpointDir()
    return named.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder and read it back.

    The files survive lost executors and are compact (parquet); ``discard``
    removes them early, otherwise they stay until the folder is cleaned.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def discard(df: DataFrame) -> None:
    """Delete a table made by ``written`` that nothing will read again."""
    path = getattr(df, "_written_at", None)
    if path:
        spark = df.sparkSession
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string column in UTF-8 without copying; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0:
        return np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.uint8)
    off = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)
    off = off[column.offset:column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return off, raw


def small_batches(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about ``most_bytes`` of ``column`` at most.

    A single longer value stays whole in a batch of its own.
    """
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        off, _ = text_bytes(batch.column(batch.schema.get_field_index(column)))
        start = 0
        while start < n:
            end = int(np.searchsorted(off, off[start] + most_bytes, side="right")) - 1
            end = min(max(end, start + 1), n)
            yield batch.slice(start, end - start)
            start = end


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
