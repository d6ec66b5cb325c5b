"""Operator 4: exact deduplication by a tree merge of sorted digest runs.

Every partition starts with a run: its texts' SHA-256 digests in order, each
with the identifier that stays, the number of rows and a check value. Nodes
0..N-1 (N = RADIX ** rounds) then exchange runs in binomial rounds: in round j a
node sends each entry to the node that differs from it only in digit j, which
becomes digit j of the digest. Spark's external sort merges the RADIX runs a
node receives and one pass folds equal digests, so a digest that fills a third
of the table has shrunk to one entry a run before the first exchange and to one
entry altogether after the last. A node ends with all entries of 1/N of the
digest space; no round gathers more than that in a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import ship, shuffle_partitions, written

RADIX = 16
_RUN = "_node int, digest binary, check long, best long, rows long"


def text_digest(text: Column) -> Column:
    """SHA-256 (32 bytes) of the text in UTF-8; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text.cast("binary"), F.lit(b"")), 256))


def _fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Merge a sorted stream of entries: one entry per (node, digest, check).

    ``best`` keeps the identifier that stays (already signed so that the largest
    wins), ``rows`` adds up. The last entry of a batch waits for the next one.
    """
    held: pd.DataFrame | None = None
    for batch in batches:
        if held is not None:
            batch = pd.concat([held, batch], ignore_index=True)
        if batch.empty:
            continue
        node, check, digest = (batch[c].to_numpy() for c in ("_node", "check", "digest"))
        new = np.ones(len(batch), dtype=bool)
        new[1:] = (node[1:] != node[:-1]) | (check[1:] != check[:-1]) | (digest[1:] != digest[:-1])
        at = np.flatnonzero(new)
        folded = pd.DataFrame({
            "_node": node[at], "digest": digest[at], "check": check[at],
            "best": np.maximum.reduceat(batch["best"].to_numpy(), at),
            "rows": np.add.reduceat(batch["rows"].to_numpy(), at)})
        held = folded.iloc[-1:].reset_index(drop=True)
        if len(folded) > 1:
            yield folded.iloc[:-1]
    if held is not None:
        yield held


def merge_runs(entries: DataFrame, nodes: int, rounds: int) -> DataFrame:
    """Binomial exchange of runs: after round j an entry agrees with its digest in digits 0..j."""
    home = F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long") % F.lit(nodes)
    out = entries
    for j in range(rounds):
        step = RADIX ** j
        low = F.col("_node") % F.lit(step)
        high = F.floor(F.col("_node") / F.lit(step * RADIX)) * F.lit(step * RADIX)
        digit = F.floor(home / F.lit(step)) % F.lit(RADIX) * F.lit(step)
        out = (out.withColumn("_node", (low + digit + high).cast("int"))
               .repartitionById(nodes, F.col("_node"))  # node i is partition i
               .sortWithinPartitions("_node", "digest", "check")
               .mapInPandas(_fold, _RUN))
    return out


def exact_dedup(df: DataFrame, key: str = "doc_id", text: str = "text", keep: str = "largest",
                nodes: int | None = None) -> DataFrame:
    """One row per input row: (key, keep_id, group_size, kept, text_sha256).

    Texts are equal when their bytes are (null counts as empty). Equality is
    verified at every merge: two texts share an entry only if the SHA-256 and an
    independent 64-bit hash mixed with the length agree. ``keep`` says whether
    the largest or the smallest key of a group stays. Rows that repeat the kept
    key are all marked kept, as the same record. A null key never stays unless
    the whole group has none. Extra columns stay behind; an empty table gives no
    rows. ``nodes`` defaults to the session's shuffle partitions.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError("keep is 'largest' or 'smallest'")
    ship(df.sparkSession)
    sign = 1 if keep == "largest" else -1
    wanted = nodes or shuffle_partitions(df.sparkSession)
    rounds = 1
    while RADIX ** rounds < wanted:
        rounds += 1
    nodes = RADIX ** rounds
    least = -(2 ** 63) + 1
    body = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    digests = written(df.select(
        F.col(key).cast("long").alias("_key"), text_digest(F.col(text)).alias("digest"),
        F.xxhash64(F.octet_length(body), body).alias("check")), "digests")
    # The first run of a partition: its own entries, folded before anything moves.
    start = (digests.select(
        (F.spark_partition_id() % F.lit(nodes)).cast("int").alias("_node"), "digest", "check",
        F.coalesce(F.col("_key") * F.lit(sign), F.lit(least)).alias("best"), F.lit(1).cast("long").alias("rows"))
        .sortWithinPartitions("_node", "digest", "check").mapInPandas(_fold, _RUN))
    merged = merge_runs(start, nodes, rounds).select(
        "digest", "check", F.when(F.col("best") != least, F.col("best") * F.lit(sign)).alias("keep_id"),
        F.col("rows").alias("group_size"))
    out = digests.join(merged, ["digest", "check"]).select(
        F.col("_key").alias(key), "keep_id", "group_size",
        F.col("_key").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))
    return out


def drop_copies(df: DataFrame, key: str = "doc_id", text: str = "text", keep: str = "largest") -> DataFrame:
    """``df`` without the rows whose text stays under another key, in its own columns.

    Rows that repeat key and text fold into one.
    """
    decided = written(exact_dedup(df, key, text, keep).select(F.col(key).cast("long").alias("_gone"), "kept", "text_sha256"), "decided")
    gone = written(decided.where("not kept").select("_gone", "text_sha256").distinct(), "gone")
    body = F.sha2(F.coalesce(F.col(text).cast("binary"), F.lit(b"")), 256)
    same = F.col(key).cast("long").eqNullSafe(F.col("_gone")) & (body == F.col("text_sha256"))
    left = df.join(gone.hint("merge"), same, "left_anti")  # what goes grows with the table, so it isn't broadcast at any size
    # Rows that repeat key and text show in the digests; only a table with such rows has its texts dealt by them.
    repeats = decided.where("kept").groupBy("_gone", "text_sha256").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return left.dropDuplicates([key, text]) if repeats.limit(1).count() else left
