"""Bloom filters of a landing table's payload hashes, one a load and ``dt`` folder.

A filter is a table of blocks of 256 bits, four words each. A hash belongs to one
block and sets two bits in every word of it, so building a filter is one ``bit_or``
aggregate, looking hashes up is one equi-join by block number, and both run inside
Spark's generated code. A folder's blocks are a power of two with 8 to 16 hashes a
block (16 to 32 bits a hash): about one new hash in a thousand or fewer passes a
filter by chance, and none that was landed is held back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORDS, BITS_A_WORD, KEYS_A_BLOCK = 4, 2, 16
SCHEMA = T.StructType([
    T.StructField("dt", T.DateType()),
    T.StructField("load_id", T.StringType()),
    T.StructField("blocks", T.LongType()),
    T.StructField("block", T.LongType()),
    *[T.StructField(f"word{i}", T.LongType()) for i in range(WORDS)],
])


def _words(key: Column) -> list[Column]:
    """A hash's bits in the words of its block."""
    bits = F.xxhash64(key, F.lit("bits"))
    out = []
    for i in range(WORDS):
        word = None
        for j in range(BITS_A_WORD):
            at = F.shiftright(bits, 6 * (i * BITS_A_WORD + j)).bitwiseAND(63).cast("int")
            bit = F.call_function("shiftleft", F.lit(1).cast("long"), at)
            word = bit if word is None else word.bitwiseOR(bit)
        out.append(word)
    return out


def _block(key: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(key, F.lit("block")), blocks)


def build(rows: DataFrame, load_id: str, key: str = "payload_hash") -> DataFrame:
    """The filters of a load's rows (``SCHEMA``), by their ``dt``; rows without a hash are in none."""
    keys = rows.select("dt", F.col(key).alias("_key")).where(F.col("_key").isNotNull())
    sizes = keys.groupBy(F.col("dt").alias("_dt")).agg(F.count(F.lit(1)).alias("_n")).select(
        "_dt", F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(F.col("_n") / KEYS_A_BLOCK, F.lit(1.0))))).cast("long").alias("blocks"))
    sized = keys.join(sizes, F.col("dt").eqNullSafe(F.col("_dt")))
    return (sized.select("dt", "blocks", _block(F.col("_key"), F.col("blocks")).alias("block"),
                         *[w.alias(f"word{i}") for i, w in enumerate(_words(F.col("_key")))])
            .groupBy("dt", "blocks", "block").agg(*[F.bit_or(f"word{i}").alias(f"word{i}") for i in range(WORDS)])
            .select("dt", F.lit(load_id).alias("load_id"), "blocks", "block", *[f"word{i}" for i in range(WORDS)]))


def possible(keys: DataFrame, filters: DataFrame, key: str = "payload_hash") -> DataFrame:
    """(key, dt): which hashes may be stored in which folders; all that are stored, and a few by chance.

    A filter's size is a power of two, so a hash is looked up once for each size there is, in all filters of that size.
    """
    sizes = [r[0] for r in filters.select("blocks").distinct().collect()]  # powers of two: a few dozen at most
    if not sizes:
        return keys.select(key, F.lit(None).cast("date").alias("dt")).limit(0)
    asked = keys.select(key, F.explode(F.array(*[F.lit(s) for s in sizes])).alias("blocks"))
    asked = asked.withColumn("block", _block(F.col(key), F.col("blocks")))
    asked = asked.withColumns({f"_word{i}": w for i, w in enumerate(_words(F.col(key)))})
    passed = F.lit(True)
    for i in range(WORDS):
        passed = passed & (F.col(f"word{i}").bitwiseAND(F.col(f"_word{i}")) == F.col(f"_word{i}"))
    return asked.join(filters, ["blocks", "block"]).where(passed).select(key, "dt").distinct()
