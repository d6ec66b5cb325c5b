"""Operator 13: document fingerprints by consistent weighted sampling.

A text is a weighted set: its words (A-Z lower-cased, split at blanks) with their
counts. For every sample d a word of weight w draws, from its own hash alone,
r and c of Gamma(2, 1) and b of the unit interval, and takes

    t = floor(ln w / r + b),   a = c * exp(-r * (t + 1 - b)).

The word of the least a is the sample, together with its t. Two texts agree in a
sample with a probability of exactly their generalised Jaccard similarity, the sum
of the lesser weights over the sum of the greater ones, so the share of equal
samples estimates it (standard error sqrt(J (1 - J) / samples)).

A draw is one unsigned number: the bits of a, in whose last 16 the hash of
(word, t) stands. The least number of a text is the least a and brings its sample
along; equal draws are decided by the sample, whatever the order of words. A batch
draws once for every distinct (word, weight), in chunks, and keeps a least number a
text and sample; a text of any length needs no more than its words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import ship, small_batches, written
from cartwheel.llm.terms import WORDS, Terms, codes, pairs

SAMPLES = 128
#: Distinct (word, weight) that draw at once, and occurrences in texts that are looked up at once: few enough for a core's cache.
CHUNK = 512
BATCH_BYTES = 4 << 20
_LOW = np.uint64(0xFFFF)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of x."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _gamma(bits: np.ndarray) -> np.ndarray:
    """Gamma(2, 1) from 64 bits: the sum of two exponential variables."""
    first = ((bits >> np.uint64(32)).astype(np.float64) + 0.5) * 2.0 ** -32
    second = ((bits & np.uint64(0xFFFFFFFF)).astype(np.float64) + 0.5) * 2.0 ** -32
    return -np.log(first * second)


def draws(hashes: np.ndarray, weights: np.ndarray, samples: int) -> np.ndarray:
    """A number for every (word hash, weight) and sample: the bits of a, the last 16 those of (word, t), never 0."""
    seeds = _mixed(np.arange(1, samples + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    one = _mixed(hashes[:, None] ^ seeds[None])
    r = _gamma(one)
    two = _mixed(one + np.uint64(0x632BE59BD9B4E019))
    c = _gamma(two)
    b = (_mixed(two + np.uint64(0x632BE59BD9B4E019)) >> np.uint64(11)).astype(np.float64) * 2.0 ** -53
    t = np.floor(np.log(weights)[:, None] / r + b)
    a = c * np.exp(-r * (t + 1 - b))
    # a word's hash is random already, so the top bits of a product will do for (word, t)
    sample = (hashes[:, None] + t.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(48)
    return (a.view(np.uint64) & ~_LOW) | np.maximum(sample, np.uint64(1))


def signatures(texts: pa.Array, samples: int = SAMPLES) -> np.ndarray:
    """The samples (unsigned 16-bit, 1 and up) of every text; a text without words has 0 in all of them."""
    terms = Terms(texts, WORDS)
    code, names = codes(terms.strings())
    text, code, count = pairs(terms.text, code, len(names))
    width = int(count.max(initial=0)) + 1
    drawn, which = np.unique(code * width + count, return_inverse=True)
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in names.cast(pa.large_binary()).to_pylist()], np.uint64)[drawn // width]
    weights = (drawn % width).astype(np.float64)
    least = np.full((len(texts), samples), ~np.uint64(0), np.uint64)
    order = np.lexsort((text, which // CHUNK))
    which, text = which[order], text[order]
    bounds = np.searchsorted(which // CHUNK, np.arange(-(-len(drawn) // CHUNK) + 1))
    for i, (begin, end) in enumerate(zip(bounds[:-1], bounds[1:])):
        table = draws(hashes[i * CHUNK:(i + 1) * CHUNK], weights[i * CHUNK:(i + 1) * CHUNK], samples)
        for at in range(begin, end, CHUNK):
            mine = text[at:min(at + CHUNK, end)]
            first = np.flatnonzero(np.r_[True, mine[1:] != mine[:-1]])
            best = np.minimum.reduceat(table[which[at:at + len(mine)] - i * CHUNK], first, axis=0)
            least[mine[first]] = np.minimum(least[mine[first]], best)
    return np.where(least == ~np.uint64(0), np.uint64(0), least & _LOW).astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal samples, row by row."""
    return (a == b).mean(axis=1)


def _binary(found: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in found.astype(">u2")], pa.binary())


def _fingerprinted(batches: Iterator[pa.RecordBatch], samples: int) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "text", BATCH_BYTES):
        yield pa.RecordBatch.from_arrays([batch.column("key"), _binary(signatures(batch.column("text"), samples))], names=["key", "fingerprint"])


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text", samples: int = SAMPLES) -> DataFrame:
    """(key, fingerprint) of every row, without a shuffle: the samples as hex digits, four each.

    Null texts count as empty; texts without words have the digits 0. Equal texts, and texts of equal word counts, have
    equal fingerprints. Repeated rows and null keys are rows like others; an empty table gives no rows; other columns
    are left behind, whatever their names.
    """
    ship(df.sparkSession)
    plain = df.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = dict(plain.dtypes)["key"]
    found = plain.mapInArrow(lambda batches: _fingerprinted(batches, samples), f"key {kind}, fingerprint binary")
    return found.select(F.col("key").alias(key), F.lower(F.hex("fingerprint")).alias("fingerprint"))


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter (rounded down, in code points) replaced by as many first ones of ``following``, or all."""
    quarter = len(text) // 4
    return text[:len(text) - quarter] + following[:quarter]


_RESULT = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_TYPES = "n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"


def _compared(texts: list[str], following: list[str], mine: np.ndarray, theirs: np.ndarray, changed: list[str], other: np.ndarray) -> list[pa.Array]:
    """The result columns for texts with their next texts and all signatures."""
    return [pa.array([len(t) for t in texts], pa.int64()), pa.array([hashlib.sha256(c.encode()).hexdigest() for c in changed], pa.string()),
            _binary(mine), _binary(other), pa.array(likeness(mine, other), pa.float64()), pa.array(likeness(mine, theirs), pa.float64())]


def _in_order(batches: Iterator[pa.RecordBatch], samples: int) -> Iterator[pa.RecordBatch]:
    """Rows of a sorted partition against the row after each.

    The partition's last row waits for another partition's first: it comes out without a comparison, and both bring
    their texts along.
    """
    part = TaskContext.get().partitionId()
    held: tuple | None = None  # (key as Arrow, text, signature, whether it is the first) of the row before
    first = True

    def out(keys: pa.Array, columns: list[pa.Array], is_first: list[bool], is_last: list[bool], texts: list[str]) -> pa.RecordBatch:
        n = len(texts)
        return pa.RecordBatch.from_arrays(
            [keys, *columns, pa.array([part] * n, pa.int32()), pa.array(is_first, pa.bool_()), pa.array(is_last, pa.bool_()),
             pa.array([t if a or z else None for t, a, z in zip(texts, is_first, is_last)], pa.string())],
            names=["key", *_RESULT, "part", "is_first", "is_last", "text"])

    for batch in small_batches(batches, "text", BATCH_BYTES):
        keys, texts = batch.column("key"), batch.column("text").to_pylist()
        before = [] if held is None else [held[1]]
        whole = before + texts
        changed = [edited(t, f) for t, f in zip(whole[:-1], whole[1:])]
        found = signatures(pa.array(texts + changed, pa.large_string()), samples)
        mine, other = found[:len(texts)], found[len(texts):]
        if held is not None:
            mine = np.concatenate([held[2][None], mine])
            keys = pa.concat_arrays([held[0], keys])
        starts = [held[3] if held is not None else first] + [False] * (len(whole) - 1)
        if len(whole) > 1:
            yield out(keys.slice(0, len(whole) - 1), _compared(whole[:-1], whole[1:], mine[:-1], mine[1:], changed, other),
                      starts[:-1], [False] * (len(whole) - 1), whole[:-1])
        held = (keys.slice(len(whole) - 1), whole[-1], mine[-1], starts[-1])
        first = False
    if held is not None:
        none = [pa.nulls(1, t) for t in (pa.string(), pa.binary(), pa.float64(), pa.float64())]
        yield out(held[0], [pa.array([len(held[1])], pa.int64()), none[0], _binary(held[2][None]), *none[1:]], [held[3]], [True], [held[1]])


def _at_edges(batches: Iterator[pa.RecordBatch], samples: int) -> Iterator[pa.RecordBatch]:
    """Last rows of partitions against the first row of the partition after."""
    for batch in small_batches(batches, "text", BATCH_BYTES):
        texts, following = batch.column("text").to_pylist(), batch.column("next_text").to_pylist()
        changed = [edited(t, f) for t, f in zip(texts, following)]
        kept = [np.array([np.frombuffer(x, ">u2") for x in batch.column(c).to_pylist()]) for c in ("fingerprint", "next_fingerprint")]
        other = signatures(pa.array(changed, pa.large_string()), samples)
        yield pa.RecordBatch.from_arrays([batch.column("key"), *_compared(texts, following, kept[0], kept[1], changed, other)], names=["key", *_RESULT])


def compare_with_next(df: DataFrame, key: str = "doc_id", text: str = "text", samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of every row's text and of its edited text, and how alike they and the next row's are.

    Returns (key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next). The next row is the
    one with the next key, after the last the first; ``edited`` says what an edited text is. Rows of one key follow each
    other by their texts' hashes; whole equal rows are interchangeable; null keys come first. A single row is its own
    next. Null texts count as empty; two texts without words are fully alike. An empty table gives no rows; other
    columns are left behind, whatever their names.

    The texts are shuffled once, by ranges of the key; a partition reads its rows in order and holds one row back. Only
    the first and last row of every partition leave it with their texts.
    """
    ship(df.sparkSession)
    plain = df.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = dict(plain.dtypes)["key"]
    # a key that many rows share is cut by the text's hash, and equal rows by their place in the input
    cut = plain.withColumn("hash", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    in_order = cut.repartitionByRange("key", "hash", "row").sortWithinPartitions("key", "hash", "row").select("key", "text")
    found = written(in_order.mapInArrow(lambda batches: _in_order(batches, samples),
                                        f"key {kind}, {_TYPES}, part int, is_first boolean, is_last boolean, text string"), "fingerprints")
    firsts = found.where("is_first").select("part", F.col("text").alias("next_text"), F.col("fingerprint").alias("next_fingerprint"))
    whole = Window.orderBy("part")  # a row a partition
    follows = (found.where("is_first").select("part").withColumn("next", F.coalesce(F.lead("part").over(whole), F.first("part").over(whole))))
    lasts = found.where("is_last").select("key", "part", "text", "fingerprint")
    edges = (lasts.join(follows, "part").select("key", "text", "fingerprint", F.col("next").alias("part")).join(firsts, "part")
             .select("key", "text", "fingerprint", "next_text", "next_fingerprint")
             .mapInArrow(lambda batches: _at_edges(batches, samples), f"key {kind}, {_TYPES}"))
    return found.where("not is_last").select("key", *_RESULT).union(edges).select(
        F.col("key").alias(key), "n_chars", "edited_sha256", F.lower(F.hex("fingerprint")).alias("fingerprint"),
        F.lower(F.hex("edited_fingerprint")).alias("edited_fingerprint"), "near_edited", "near_next")
