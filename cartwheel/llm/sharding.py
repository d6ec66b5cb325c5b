"""Operator 10: weighted rendezvous hashing of stable record keys (DataFrame functions only).

Every shard s draws a uniform number u from md5(key, s); its score is
-weight / ln(u) and the record goes to the shard with the highest score. A
shard's score doesn't depend on the other shards, so a new shard takes rows
only into itself and every other row stays where it is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import written

#: Parts of a shard's row order. A slot is the rows in earlier parts plus the
#: place in its own part, so no task ever sorts a whole shard.
SLOT_PARTS = 4096
_DRAWS = 2.0 ** 52


def _unit(key: Column, salt: str) -> Column:
    """Uniform number in (0, 1) from the first 13 hex digits of an md5."""
    digits = F.substring(F.md5(F.concat(key, F.lit(f"|{salt}")).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + F.lit(0.5)) / F.lit(_DRAWS)


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """Shard (from 0) of ``key`` among shards of the given positive weights; ties go to the lower shard."""
    if not weights or any(w <= 0 for w in weights):
        raise ValueError("give at least one shard, each of a positive weight")
    scored = [F.struct((F.lit(-float(w)) / F.log(_unit(key, str(s)))).alias("score"), F.lit(-s).alias("order"))
              for s, w in enumerate(weights)]
    best = F.greatest(*scored) if len(scored) > 1 else scored[0]
    return (-best["order"]).cast("int")


def shard_rows(df: DataFrame, key: str = "doc_id", text: str = "text", weights: Sequence[float] = (1.0,) * 8,
               added_weight: float = 1.0, parts: int = SLOT_PARTS) -> DataFrame:
    """Place every row; returns (key, size, text_crc32, law, shard, slot, grown_shard).

    ``size`` is the text's UTF-8 bytes (null: none) plus 1. ``slot`` numbers a
    shard's rows gaplessly from 0 in the order (part of the key's hash, key,
    crc, size). A null key counts as the empty key. Equal rows are
    interchangeable, each gets a slot of its own. Other columns are left behind,
    so clashing names can't matter; an empty table gives no rows.
    """
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    body = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    # texts are read once; their places are a few numbers a row
    placed = written(df.select(
        F.col(key),
        (F.octet_length(body) + F.lit(1)).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        rendezvous(name, weights).alias("shard"),
        rendezvous(name, [*weights, added_weight]).alias("grown_shard"),
        F.floor(_unit(name, "slot") * F.lit(float(parts))).cast("int").alias("_part"),
    ), "placed")
    # A hash part holds 1/parts of a shard whatever the keys are; only counts cross parts.
    counts = placed.groupBy("shard", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("shard", "_part").orderBy(key, "text_crc32", "size")
    ranked = placed.withColumn("_rank", F.row_number().over(inside) - 1)
    return ranked.join(starts, ["shard", "_part"]).select(
        F.col(key), "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("_before") + F.col("_rank")).cast("long").alias("slot"), "grown_shard")
