"""Operator 12: hard-negative mining by slot-decomposed selection.

Every anchor has a few positives (its best rows of the same label), and every
positive a window of scores in which negatives are hard for it. The windows of
one anchor overlap, so they aren't searched one by one. The positives' upper
limits, in descending order, split the scores into disjoint slots: slot j holds
what lies under the limits 1 to j and over limit j + 1. A negative falls into one
slot, combiners keep the top k of every slot (in a tile of scores, in a part of
the rows, over all parts), and since slot j's scores are over those of slot
j + 1, merging the slots from the last one upwards gives the top k under every
limit in one pass. A window's lower limit then only cuts the end of its list.

All rows are dealt to parts by their identifier's hash and every anchor goes to
every part: a part is held in memory as one matrix (PART_ROWS rows at most, about)
and the anchors stream past it. Labels and keys deal nothing, so a hot label is as
wide as the table. What leaves a part is at most `positives` rows an anchor, then
at most `negatives` rows an anchor and slot.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import ship, shuffle_partitions, written

POSITIVES, NEGATIVES = 5, 3
#: Percent of the positive's score that a negative must reach, and may reach.
LOW, HIGH = 50, 95
SCALE = 256
#: Rows of a part (a matrix in a task's memory), about; and fewer, down to LEAST_ROWS, where that keeps more cores busy.
PART_ROWS, LEAST_ROWS = 65_536, 2_048
#: A tile of scores: so many anchors by so many rows.
TILE_ANCHORS, TILE_ROWS = 512, 4_096
_EXACT = 2.0 ** 53
_LONG = (-(2 ** 63), 2 ** 63 - 1)

_VECTORS = "vec_id long, label long, dim int, raw binary"
_FOUND = "anchor_id long, slot int, score long, other_id long"


def _scaled(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[pa.RecordBatch]:
    """(vec_id, label, dim, raw): floor(scale * x) of every component, as float32 where that is exact."""
    for batch in batches:
        ids, labels, dims, raws = [], [], [], []
        vectors = batch.column("vector").to_pylist()
        for vec_id, label, vector in zip(batch.column("vec_id").to_pylist(), batch.column("label").to_pylist(), vectors):
            if vec_id is None or label is None or vector is None or any(x is None for x in vector):
                continue
            x = np.array(vector, dtype=np.float64)
            if not np.isfinite(x).all():
                continue
            with np.errstate(over="ignore"):
                x = np.nan_to_num(np.floor(scale * x))  # beyond a double: the largest one
            short = np.abs(x).max(initial=0) <= 2 ** 24
            ids.append(vec_id)
            labels.append(label)
            dims.append(len(x))
            raws.append((x.astype(np.float32) if short else x).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(labels, pa.int64()), pa.array(dims, pa.int32()),
                                          pa.array(raws, pa.binary())], names=["vec_id", "label", "dim", "raw"])


def prepare(df: DataFrame, vec_id: str, vector: str, label: Column, scale: int = SCALE) -> DataFrame:
    """The rows that take part, one a vec_id, as a written table of integer vectors."""
    ship(df.sparkSession)
    plain = df.select(F.col(vec_id).cast("long").alias("vec_id"), label.cast("long").alias("label"), F.col(vector).alias("vector"))
    scaled = plain.where("vec_id is not null and label is not null and vector is not null").mapInArrow(
        lambda batches: _scaled(batches, scale), _VECTORS)
    one = scaled.groupBy("vec_id").agg(F.min(F.struct("label", "dim", "raw")).alias("r"))
    return written(one.select("vec_id", "r.label", "r.dim", "r.raw"), "vectors")


def _matrix(raws: list[bytes], dim: int) -> np.ndarray:
    out = np.empty((len(raws), dim))
    for i, raw in enumerate(raws):
        out[i] = np.frombuffer(raw, dtype=np.float32 if len(raw) == 4 * dim else np.float64)
    return out


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of integer-valued rows, as int64 (beyond a long: the nearest long)."""
    if a.shape[1] == 0:
        return np.zeros((len(a), len(b)), np.int64)
    # a sum's partial sums are bounded by the product of the norms, too
    with np.errstate(over="ignore"):
        most = math.sqrt(float((a * a).sum(1).max(initial=0))) * math.sqrt(float((b * b).sum(1).max(initial=0)))
    if most < _EXACT:
        return (a @ b.T).astype(np.int64)
    whole = [[int(x) for x in row] for row in a], [[int(x) for x in row] for row in b]
    return np.array([[min(max(sum(x * y for x, y in zip(p, q)), _LONG[0]), _LONG[1]) for q in whole[1]] for p in whole[0]],
                    dtype=np.int64).reshape(len(a), len(b))


class _Part:
    """The rows of one part, by dimension, sorted by (label, vec_id)."""

    def __init__(self) -> None:
        self.rows: dict[int, list[tuple[int, int, bytes]]] = {}
        self.built: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] | None = None

    def add(self, vec_id: int, label: int, dim: int, raw: bytes) -> None:
        self.rows.setdefault(dim, []).append((label, vec_id, raw))

    def of(self, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(labels, vec_ids, matrix) of the rows with ``dim`` components."""
        if self.built is None:
            self.built = {}
            for d, rows in self.rows.items():
                rows.sort(key=lambda r: r[:2])
                self.built[d] = (np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64),
                                 _matrix([r[2] for r in rows], d))
            self.rows = {}
        none = np.zeros(0, np.int64)
        return self.built.get(dim, (none, none, np.zeros((0, dim))))


def _top(owner: np.ndarray, score: np.ndarray, other: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k of every owner by (score descending, other ascending)."""
    order = np.lexsort((other, ~score, owner))  # ~x falls as x grows and, unlike -x, never overflows
    mine = owner[order]
    first = np.flatnonzero(np.r_[True, mine[1:] != mine[:-1]]) if len(mine) else np.zeros(0, np.int64)
    inside = np.arange(len(mine)) - np.repeat(first, np.diff(np.r_[first, len(mine)]))
    return order[inside < k]


def _positives(anchors: list[dict], part: _Part, k: int) -> tuple[list[np.ndarray], ...]:
    """Top k rows of the same label for every anchor (other than itself): (anchor, slot, score, other)."""
    out: tuple[list[np.ndarray], ...] = ([], [], [], [])
    groups: dict[tuple[int, int], list[dict]] = {}
    for a in anchors:
        groups.setdefault((a["dim"], a["label"]), []).append(a)
    for (dim, label), members in groups.items():
        labels, ids, matrix = part.of(dim)
        low, high = np.searchsorted(labels, [label, label + 1])
        for start in range(0, len(members), TILE_ANCHORS):
            some = members[start:start + TILE_ANCHORS]
            mine, vectors = np.array([a["vec_id"] for a in some], np.int64), _matrix([a["raw"] for a in some], dim)
            held = [np.zeros(0, np.int64)] * 3
            for at in range(low, high, TILE_ROWS):
                end = min(at + TILE_ROWS, high)
                s = scores(vectors, matrix[at:end])
                keep = ids[None, at:end] != mine[:, None]
                if end - at > 4 * k:
                    # no row under the k-th best of its anchor in this tile can be among the anchor's first k
                    floor = np.partition(np.where(keep, s, _LONG[0]), end - at - k, axis=1)[:, end - at - k]
                    keep &= s >= floor[:, None]
                row, col = np.nonzero(keep)
                held = [np.concatenate([h, x]) for h, x in zip(held, (row, s[row, col], ids[at:end][col]))]
                best = _top(*held, k)
                held = [h[best] for h in held]
            for column, values in zip(out, (mine[held[0]], np.zeros(len(held[0]), np.int64), held[1], held[2])):
                column.append(values)
    return out


def limits(positive_scores: list[int], low: int, high: int) -> tuple[list[int], int | None, int | None]:
    """(upper limits in descending order, least score, greatest score of any window); None where every window is empty."""
    uppers = [high * p // 100 for p in positive_scores]
    open_ = [(-(-low * p // 100), u) for p, u in zip(positive_scores, uppers) if -(-low * p // 100) <= u]
    if not open_:
        return uppers, None, None
    return uppers, min(o[0] for o in open_), max(o[1] for o in open_)


def _negatives(anchors: list[dict], part: _Part, k: int, low: int, high: int) -> tuple[list[np.ndarray], ...]:
    """Top k rows of other labels in every slot of every anchor: (anchor, slot, score, other)."""
    out: tuple[list[np.ndarray], ...] = ([], [], [], [])
    groups: dict[int, list[tuple[dict, list[int], int, int]]] = {}
    for a in anchors:
        uppers, least, most = limits(a["positive_scores"], low, high)
        if least is not None:
            groups.setdefault(a["dim"], []).append((a, uppers, least, most))
    for dim, members in groups.items():
        labels, ids, matrix = part.of(dim)
        for start in range(0, len(members), TILE_ANCHORS):
            some = members[start:start + TILE_ANCHORS]
            slots = max(len(m[1]) for m in some)
            mine = np.array([m[0]["vec_id"] for m in some], np.int64)
            label = np.array([m[0]["label"] for m in some], np.int64)
            vectors = _matrix([m[0]["raw"] for m in some], dim)
            upper = np.array([m[1] + [_LONG[0]] * (slots - len(m[1])) for m in some], np.int64)
            least, most = (np.array([m[i] for m in some], np.int64)[:, None] for i in (2, 3))
            held = [np.zeros(0, np.int64)] * 3
            for at in range(0, len(ids), TILE_ROWS):
                s = scores(vectors, matrix[at:at + TILE_ROWS])
                row, col = np.nonzero((s >= least) & (s <= most) & (labels[None, at:at + TILE_ROWS] != label[:, None]))
                score = s[row, col]
                slot = (score[:, None] <= upper[row]).sum(1)
                held = [np.concatenate([h, x]) for h, x in zip(held, (row * (slots + 1) + slot, score, ids[at:at + TILE_ROWS][col]))]
                best = _top(*held, k)
                held = [h[best] for h in held]
            row, slot = held[0] // (slots + 1), held[0] % (slots + 1)
            for column, values in zip(out, (mine[row], slot, held[1], held[2])):
                column.append(values)
    return out


def _stream(batches: Iterator[pa.RecordBatch], find) -> Iterator[pa.RecordBatch]:
    """Rows of a part come first and stay; the part's anchors stream past them."""
    part, number = _Part(), None
    for batch in batches:
        anchors: list[dict] = []

        def searched() -> pa.RecordBatch:
            columns = find(anchors, part)
            arrays = [pa.array(np.concatenate(c) if c else [], t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.int64()))]
            anchors.clear()
            return pa.RecordBatch.from_arrays([arrays[0], arrays[1].cast(pa.int32()), arrays[2], arrays[3]],
                                              names=["anchor_id", "slot", "score", "other_id"])

        for row in batch.to_pylist():
            if row["part"] != number:
                if anchors:
                    yield searched()
                part, number = _Part(), row["part"]
            if row["is_anchor"]:
                anchors.append(row)
            else:
                part.add(row["vec_id"], row["label"], row["dim"], row["raw"])
        if anchors:
            yield searched()


def _over_all_parts(vectors: DataFrame, anchors: DataFrame, parts: int, find) -> DataFrame:
    """What ``find`` gives for every anchor and every part of the rows."""
    none = F.lit(None).cast("array<bigint>")
    columns = ["part", "is_anchor", "vec_id", "label", "dim", "raw", "positive_scores"]
    rows = vectors.select(F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int").alias("part"), F.lit(False).alias("is_anchor"),
                          "vec_id", "label", "dim", "raw", none.alias("positive_scores"))
    asked = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(True).alias("is_anchor"),
                           "vec_id", "label", "dim", "raw", "positive_scores")
    dealt = rows.select(*columns).union(asked.select(*columns)).repartitionById(parts, F.col("part"))
    return dealt.sortWithinPartitions("part", "is_anchor").mapInArrow(lambda batches: _stream(batches, find), _FOUND)


def _first(found: DataFrame, by: list[str], k: int) -> DataFrame:
    """Top k rows of every group; Spark cuts to k before the shuffle as well."""
    best = Window.partitionBy(*by).orderBy(F.desc("score"), "other_id")
    return found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k)


def suffix_merged(by_slot: Column, slots: int, k: int) -> Column:
    """Array whose element j (from 1) is the top k of slots j and after; ``by_slot`` maps a slot to its sorted top k.

    Slots are disjoint and descending, so a merge is: the slot's own list, then the merged list of the slots after it.
    """
    empty = F.array().cast("array<struct<score:bigint,other_id:bigint>>")
    return F.reduce(
        F.array(*[F.lit(j) for j in range(slots, 0, -1)]), F.array(empty),
        lambda merged, j: F.concat(F.array(F.slice(F.concat(F.coalesce(F.try_element_at(by_slot, j), empty), merged[0]), 1, k)), merged))


def mine(df: DataFrame, anchor: Column, label: Column, vec_id: str = "vec_id", vector: str = "embedding", positives: int = POSITIVES,
         negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE, part_rows: int = PART_ROWS) -> DataFrame:
    """Hard negatives of every anchor and positive.

    Returns (anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for every row where ``anchor``
    (an expression over ``vec_id``) holds and each of its first ``positives`` other rows of the same label, the first
    ``negatives`` rows of another label with low * positive_score <= 100 * negative_score <= high * positive_score.
    Higher scores come first, ties by smaller vec_id.

    A component x counts as floor(scale * x); scores are exact integer inner products (beyond a long: the nearest
    long). Rows without an identifier, a label or a whole finite vector take no part. Of rows that share a vec_id the
    one with the smallest (label, components' bytes) stands, so repeated rows count once. Vectors of different lengths
    have no score. Anchors without positives, and positives whose window is empty (those of negative score, too),
    return nothing; an empty table returns no rows. Other columns are left behind, whatever their names.
    """
    spark = df.sparkSession
    vectors = prepare(df, vec_id, vector, label, scale)
    n = vectors.count()
    parts = max(math.ceil(n / part_rows), min(shuffle_partitions(spark), math.ceil(n / LEAST_ROWS)), 1)
    anchors = vectors.where(anchor)

    found = _over_all_parts(vectors, anchors.withColumn("positive_scores", F.lit(None).cast("array<bigint>")), parts,
                            lambda some, part: _positives(some, part, positives))
    chosen = written(_first(found, ["anchor_id"], positives).select(
        "anchor_id", F.col("place").alias("slot"), F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    lists = chosen.groupBy("anchor_id").agg(F.sort_array(F.collect_list("positive_score"), asc=False).alias("positive_scores"))
    limited = anchors.join(lists, anchors["vec_id"] == lists["anchor_id"])
    found = _over_all_parts(vectors, limited, parts, lambda some, part: _negatives(some, part, negatives, low, high))
    tops = (_first(found, ["anchor_id", "slot"], negatives).groupBy("anchor_id", "slot")
            .agg(F.sort_array(F.collect_list(F.struct("place", "score", "other_id"))).alias("top"))
            .select("anchor_id", "slot", F.transform("top", lambda x: F.struct(x["score"].alias("score"), x["other_id"].alias("other_id"))).alias("top")))
    merged = (tops.groupBy("anchor_id").agg(F.map_from_entries(F.collect_list(F.struct("slot", "top"))).alias("by_slot"))
              .select("anchor_id", suffix_merged(F.col("by_slot"), positives, negatives).alias("merged")))
    answers = chosen.join(merged, "anchor_id").select(
        "anchor_id", "positive_id", "positive_score",
        F.posexplode(F.filter(F.element_at("merged", F.col("slot")),
                              lambda x: x["score"].cast("decimal(20,0)") * 100 >= F.col("positive_score").cast("decimal(20,0)") * low)).alias("at", "negative"))
    return answers.select("anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("negative.other_id").alias("negative_id"),
                         "positive_score", F.col("negative.score").alias("negative_score"))
