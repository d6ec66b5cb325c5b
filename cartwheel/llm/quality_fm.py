"""Operator 5: quality classifier, a factorisation machine.

A document is a sparse vector of hashed words, structure statistics and
metadata (its size). The score adds, to a linear part, an interaction of every
two features through low-rank factors; the sum-of-squares identity

    sum_{i<j} <v_i, v_j> x_i x_j = 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2]

gives it in time linear in the features that a document has. The machine is
fitted on a bounded sample of labelled rows; scoring reads every whole text.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import ship, small_batches, text_bytes

#: Buckets of hashed words.
BUCKETS = 2048
#: Rank of the interactions.
RANK = 8
#: Labelled rows that the fit uses at most (those of the smallest key hashes): a bounded sample.
TRAIN_ROWS = 5000
EPOCHS = 8
#: Steps of the fit at least, so that a small sample gets more rounds.
LEAST_STEPS = 300
THRESHOLD = 0.3
HELD_OUT_FOLDS = 5
_REMEMBERED = 400_000

STATISTICS = ("size", "words", "word length", "distinct words", "top word", "repeats of the word before", "upper case",
              "digits", "white space", "full stops and commas", "other marks", "bars", "beyond ASCII",
              "lines", "distinct lines", "short lines")


class _Buckets(dict):
    """Word -> bucket, remembered by the worker."""

    def __missing__(self, word: str) -> int:
        if len(self) >= _REMEMBERED:
            self.clear()
        bucket = self[word] = zlib.crc32(word.encode()) % BUCKETS
        return bucket


@lru_cache(maxsize=1)
def _buckets() -> _Buckets:
    return _Buckets()


def _members(chars: bytes) -> np.ndarray:
    out = np.zeros(256)
    out[list(chars)] = 1
    return out


_CLASSES = np.stack([
    _members(bytes(range(65, 91))), _members(bytes(range(48, 58))), _members(b" \t\n\r\v\f"), _members(b".,"),
    _members(bytes(c for c in range(33, 127) if not chr(c).isalnum() and c not in b".,|")), _members(b"|"),
    _members(bytes(range(128, 256)))], axis=1)


def features(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word bucket weights of length 1, statistics) of one text in UTF-8; an empty text has none of either."""
    stats = np.zeros(len(STATISTICS), dtype=np.float32)
    weights = np.zeros(BUCKETS, dtype=np.float32)
    text = data.tobytes().decode()
    words = text.lower().split()
    stats[0] = math.log1p(len(text))
    if not words:
        return weights, stats
    n = len(words)
    known = _buckets()
    buckets = np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=n)
    counts = np.bincount(buckets, minlength=BUCKETS)
    weights[:] = np.sqrt(counts / n)
    lines = text.split("\n")
    bytes_ = np.bincount(data, minlength=256)
    stats[1] = math.log1p(n)
    stats[2] = math.log(len(text) / n)
    stats[3] = math.log(len(set(words))) / math.log(n) if n > 1 else 1
    stats[4] = math.sqrt(counts.max() / n)
    stats[5] = np.mean(buckets[1:] == buckets[:-1]) if n > 1 else 0
    stats[6:13] = np.sqrt(bytes_ @ _CLASSES / len(data))
    stats[13] = math.log1p(len(lines))
    stats[14] = len(set(lines)) / len(lines)
    stats[15] = sum(len(x) < 30 for x in lines) / len(lines)
    return weights, stats


@dataclass
class Machine:
    """A fitted factorisation machine over [hashed words, standardised statistics]."""

    mean: np.ndarray
    spread: np.ndarray
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def vector(self, words: np.ndarray, stats: np.ndarray) -> np.ndarray:
        """Feature vectors; statistics are standardised, and bounded so that odd texts stay in range."""
        scaled = np.clip((stats - self.mean) / self.spread, -4, 4) / 4
        return np.concatenate([words, scaled.astype(np.float32)], axis=-1)

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self.bias + x @ self.linear + 0.5 * ((x @ self.factors) ** 2 - (x ** 2) @ (self.factors ** 2)).sum(-1)

    def score(self, words: np.ndarray, stats: np.ndarray) -> np.ndarray:
        """Scores row by row: a matrix product may round a row differently in batches of different sizes."""
        squares = self.factors ** 2
        z = np.array([self.bias + x @ self.linear + 0.5 * ((x @ self.factors) ** 2 - (x ** 2) @ squares).sum()
                      for x in self.vector(words, stats)], dtype=np.float64)
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit(words: np.ndarray, stats: np.ndarray, labels: np.ndarray, rank: int = RANK, epochs: int = EPOCHS,
        rate: float = 0.02, decay: float = 1e-4, batch: int = 128, seed: int = 7) -> Machine:
    """Logistic loss by Adam in small batches. Without rows of both labels the score is their share (or 1/2)."""
    n, d = len(labels), BUCKETS + len(STATISTICS)
    share = (labels.sum() + 1) / (n + 2)
    mean = stats.mean(0) if n else np.zeros(len(STATISTICS))
    spread = (stats.std(0) if n else np.zeros(len(STATISTICS))) + 1e-3
    out = Machine(mean.astype(np.float32), spread.astype(np.float32), float(np.log(share / (1 - share))),
                  np.zeros(d, np.float32), np.zeros((d, rank), np.float32))
    if n == 0 or labels.min() == labels.max():
        return out
    random = np.random.default_rng(seed)
    x = out.vector(words, stats)
    out.factors = random.normal(0, 0.05, (d, rank)).astype(np.float32)
    state = [np.zeros((d, rank + 1), np.float32), np.zeros((d, rank + 1), np.float32)]
    step = 0
    for _ in range(max(epochs, -(-LEAST_STEPS * batch // n))):
        order = random.permutation(n)
        for at in range(0, n, batch):
            rows = order[at:at + batch]
            xb = x[rows]
            summed = xb @ out.factors
            z = out.bias + xb @ out.linear + 0.5 * (summed ** 2 - (xb ** 2) @ (out.factors ** 2)).sum(1)
            error = ((1 / (1 + np.exp(-np.clip(z, -30, 30)))) - labels[rows]).astype(np.float32) / len(rows)
            slope = np.empty((d, rank + 1), np.float32)
            slope[:, 0] = xb.T @ error + decay * out.linear
            slope[:, 1:] = xb.T @ (error[:, None] * summed) - ((xb ** 2).T @ error)[:, None] * out.factors + decay * out.factors
            step += 1
            state[0] = 0.9 * state[0] + 0.1 * slope
            state[1] = 0.999 * state[1] + 0.001 * slope ** 2
            move = rate * (state[0] / (1 - 0.9 ** step)) / (np.sqrt(state[1] / (1 - 0.999 ** step)) + 1e-8)
            out.linear = out.linear - move[:, 0]
            out.factors = out.factors - move[:, 1:]
            out.bias -= rate * float(error.sum())
    return out


def held_out(key: str):
    """Whether a row is kept from the fit: crc32 of the key as text, modulo 5, is 0 (a null key counts as empty)."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % F.lit(HELD_OUT_FOLDS) == 0


def _training_rows(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, train_rows: int) -> DataFrame:
    """Sparse features of the sample: (buckets, weights, stats as binary, label, key), one row a sampled key.

    Of documents that share a key the one of the least feature bytes stands.
    """
    clean = (labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull())
             .groupBy(F.col(key).alias("_key")).agg(F.min(label).alias("_label"), F.max(label).alias("_other"))
             .where("_label = _other and not " + f"crc32(cast(cast(_key as string) as binary)) % {HELD_OUT_FOLDS} = 0")
             .orderBy(F.xxhash64("_key"), "_key").limit(train_rows).select("_key", F.col("_label").cast("int").alias("_label")))
    # The sample has `train_rows` rows at most, so sending it to every task is safe.
    chosen = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(F.broadcast(clean), "_key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "_text"):
            off, raw = text_bytes(batch.column(0))
            at, weights, stats = [], [], []
            for i in range(batch.num_rows):
                w, s = features(raw[off[i]:off[i + 1]])
                used = np.flatnonzero(w)
                at.append(used.astype("<u2").tobytes())
                weights.append(w[used].tobytes())
                stats.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.binary()), pa.array(weights, pa.binary()), pa.array(stats, pa.binary()),
                                              batch.column(1), batch.column(2)], names=["at", "weights", "stats", "label", "key"])
    found = chosen.select("_text", "_label", F.col("_key").cast("string").alias("_key")).mapInArrow(
        run, "at binary, weights binary, stats binary, label int, key string")
    return found.groupBy("key").agg(F.min(F.struct("stats", "at", "weights", "label")).alias("r")).select("r.*", "key")


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
          train_rows: int = TRAIN_ROWS, **settings) -> Machine:
    """Fit on at most ``train_rows`` labelled documents that are not held out.

    Labels other than 0 and 1, contradicting labels of one key and labels
    without a document are left out. Labels, language, source and key are no
    features.
    """
    ship(docs.sparkSession)
    rows = sorted(_training_rows(docs, labels, key, text, label, train_rows).collect(), key=lambda r: (r["key"], r["stats"]))
    words = np.zeros((len(rows), BUCKETS), np.float32)
    for i, r in enumerate(rows):
        words[i, np.frombuffer(r["at"], "<u2")] = np.frombuffer(r["weights"], np.float32)
    stats = np.array([np.frombuffer(r["stats"], np.float32) for r in rows], np.float32).reshape(len(rows), len(STATISTICS))
    return fit(words, stats, np.array([r["label"] for r in rows], np.float32), **settings)


def score_rows(docs: DataFrame, machine: Machine, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: good likelier) for every row; null and empty texts have one, too.

    All columns stay; an existing column ``score`` is replaced.
    """
    ship(docs.sparkSession)
    docs = docs.drop("score")
    schema = docs.schema.simpleString()[len("struct<"):-1]
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, text, 1 << 20):
            off, raw = text_bytes(batch.column(at))
            parts = [features(raw[off[i]:off[i + 1]]) for i in range(batch.num_rows)]
            scores = machine.score(np.array([w for w, _ in parts]), np.array([s for _, s in parts]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, "score"])
    return docs.mapInArrow(run, f"{schema},score:double")


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(key, held_out, score, predicted) of every document."""
    machine = train(docs, labels, key, text)
    return score_rows(docs.select(key, text), machine, text).select(
        key, held_out(key).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, in their own columns."""
    scored = score_rows(docs.withColumnRenamed("score", "_own_score") if "score" in docs.columns else docs, train(docs, labels, key, text), text)
    return scored.where(F.col("score") >= threshold).select(*["_own_score" if c == "score" else c for c in docs.columns]).toDF(*docs.columns)
