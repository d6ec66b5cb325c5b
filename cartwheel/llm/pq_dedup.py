"""Operator 8: near-duplicate embeddings by product quantisation.

The index has coarse cells (k-means centroids) and, for every vector, a code of
its residual in a few subspaces; it is fitted on a bounded sample and holds
every row. A vector is a member of its nearest cell and visits each cell whose
border (the plane half-way between the two centroids) lies within PROBE_SLACK
of the link radius. The distances of two linked vectors to the border between
their cells add up to the radius at most, and a link is met if either visits the
other's cell, so half the radius misses none. In a cell, table look-ups give the distance from a visitor to the members'
codes; a member is skipped only if this distance less the member's exact coding
error still exceeds the radius, which loses nothing. What is left is compared by
exact cosine in double precision.

Cells are cut into blocks of members and slices of visitors, so a cell that
holds a third of all rows becomes many small tasks. A task returns link counts
and the links of a spanning forest, never all pairs.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import ship, written
from cartwheel.llm.components import connected_components

COSINE = 0.93
#: Vectors that the index is fitted on (those of the smallest identifier hashes): a bounded sample.
SAMPLE = 8192
#: Distinct vectors of a label in a cell, about, and most cells.
PER_CELL, MOST_CELLS = 512, 1024
SUBSPACES, CODEWORDS = 8, 32
#: Share of the link radius within which a border makes a vector visit the other cell (below 0.5 links are lost).
PROBE_SLACK = 0.5
MEMBERS, VISITORS = 512, 1024


@dataclass
class Index:
    """Centroids and residual codebooks for unit vectors of one dimension."""

    centroids: np.ndarray
    codebooks: list[np.ndarray]

    @property
    def dim(self) -> int:
        return self.centroids.shape[1]

    def _parts(self, x: np.ndarray) -> list[np.ndarray]:
        return np.array_split(x, len(self.codebooks), axis=1)

    def assign(self, x: np.ndarray, reach: float) -> tuple[np.ndarray, list[np.ndarray]]:
        """(home cell, cells visited besides it) of unit vectors."""
        c = self.centroids
        d = (x ** 2).sum(1)[:, None] + (c ** 2).sum(1)[None] - 2 * x @ c.T
        home = d.argmin(1)
        apart = np.sqrt(np.maximum((c ** 2).sum(1)[:, None] + (c ** 2).sum(1)[None] - 2 * c @ c.T, 1e-18))
        border = (d - d[np.arange(len(x)), home][:, None]) / (2 * apart[home])
        near = border <= reach + 1e-6
        near[np.arange(len(x)), home] = False
        return home, [np.flatnonzero(row) for row in near]

    def encode(self, x: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(residual codes, exact coding errors)."""
        codes = np.empty((len(x), len(self.codebooks)), np.uint8)
        error = np.zeros(len(x))
        for m, (part, book) in enumerate(zip(self._parts(x - self.centroids[home]), self.codebooks)):
            d = (part ** 2).sum(1)[:, None] + (book ** 2).sum(1)[None] - 2 * part @ book.T
            codes[:, m] = d.argmin(1)
            error += ((part - book[codes[:, m]]) ** 2).sum(1)
        return codes, np.sqrt(error)

    def distances(self, x: np.ndarray, cell: int, codes: np.ndarray) -> np.ndarray:
        """Asymmetric distances from vectors to the codes of a cell, summed from one table a subspace."""
        total = np.zeros((len(x), len(codes)))
        for m, (part, book) in enumerate(zip(self._parts(x - self.centroids[cell]), self.codebooks)):
            table = (part ** 2).sum(1)[:, None] + (book ** 2).sum(1)[None] - 2 * part @ book.T
            total += table[:, codes[:, m]]
        return np.sqrt(np.maximum(total, 0))


def _kmeans(x: np.ndarray, k: int, rounds: int, random: np.random.Generator) -> np.ndarray:
    k = min(k, len(x))
    c = x[random.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = ((c ** 2).sum(1)[None] - 2 * x @ c.T).argmin(1)
        counts = np.bincount(near, minlength=k)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        full = counts > 0
        c[full] = sums[full] / counts[full, None]
    return c


def fit(sample: np.ndarray, cells: int, subspaces: int = SUBSPACES, codewords: int = CODEWORDS, seed: int = 11) -> Index:
    random = np.random.default_rng(seed)
    centroids = _kmeans(sample, cells, 8, random)
    out = Index(centroids, [])
    home = ((centroids ** 2).sum(1)[None] - 2 * sample @ centroids.T).argmin(1)
    parts = np.array_split(sample - centroids[home], min(subspaces, sample.shape[1]), axis=1)
    out.codebooks = [_kmeans(np.ascontiguousarray(p), codewords, 6, random) for p in parts]
    return out


def unit(raw: bytes) -> np.ndarray:
    """The vector scaled to length 1 in double precision."""
    x = np.frombuffer(raw, dtype=np.float64)
    return x / math.sqrt(float(x @ x))


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, label, raw): the vector in double precision if it can link, else null."""
    for batch in batches:
        column = batch.column(2)
        values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        sizes = np.array([0 if not v.is_valid else len(v) for v in column])
        ends = np.cumsum(sizes)
        raw = []
        for a, b, label in zip(ends - sizes, ends, batch.column(1)):
            x = values[a:b]
            scale = np.abs(x).max() if len(x) and label.is_valid and np.isfinite(x).all() else 0
            raw.append((x / scale).tobytes() if scale else None)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(raw, pa.binary()),
                                          pa.array([r and hashlib.blake2b(r, digest_size=16).digest() for r in raw], pa.binary())],
                                         names=["id", "label", "raw", "digest"])


_PLACED = "label string, cell int, key bigint, weight bigint, raw binary, code binary, error double, probes array<int>"


def _place(index: Index | None, reach: float):
    """Home cell, code and visited cells of every class; other dimensions get a cell of their own without codes."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            dims = x["raw"].map(len).to_numpy() // 8
            out = x[["label", "key", "weight", "raw"]].assign(cell=-dims, code=b"", error=0.0, probes=[np.zeros(0, np.int32)] * len(x))
            mine = np.flatnonzero(dims == index.dim) if index else []
            if len(mine):
                v = np.stack([unit(r) for r in x["raw"].iloc[mine]])
                home, visits = index.assign(v, reach)
                codes, error = index.encode(v, home)
                for column, values in (("cell", home), ("code", [c.tobytes() for c in codes]), ("error", error),
                                       ("probes", [p.astype(np.int32) for p in visits])):
                    new = out[column].astype(object)
                    new.iloc[mine] = pd.Series(list(values), index=new.index[mine], dtype=object)
                    out[column] = new
            out["cell"], out["error"] = out["cell"].astype(np.int32), out["error"].astype(float)
            yield out[["label", "cell", "key", "weight", "raw", "code", "error", "probes"]]
    return run


class _Block:
    """The members of a block, and what linking visitors to them gives."""

    def __init__(self, rows: pd.DataFrame, index: Index | None, cosine: float):
        self.cell, self.cosine, self.index = int(rows["at_cell"].iloc[0]), cosine, index
        self.keys, self.weights = rows["key"].to_numpy(), rows["weight"].to_numpy()
        self.x = np.stack([unit(r) for r in rows["raw"]])
        self.codes = np.stack([np.frombuffer(c, np.uint8) for c in rows["code"]]) if self.cell >= 0 else None
        self.error = rows["error"].to_numpy()
        self.visits = np.zeros((len(rows), len(index.centroids) if index else 1), dtype=bool)
        for i, p in enumerate(rows["probes"]):
            self.visits[i, p] = True
        self.group = np.arange(len(rows))

    def links(self, x: np.ndarray) -> np.ndarray:
        """Boolean matrix: cosine of each row of ``x`` and each member reaches the threshold."""
        if self.codes is None:
            return x @ self.x.T >= self.cosine
        radius = math.sqrt(2 - 2 * self.cosine)
        maybe = self.index.distances(x, self.cell, self.codes) - self.error[None] <= radius + 1e-6
        out = np.zeros(maybe.shape, dtype=bool)
        rows, columns = np.nonzero(maybe)
        for at in range(0, len(rows), 65536):
            r, c = rows[at:at + 65536], columns[at:at + 65536]
            out[r, c] = np.einsum("ij,ij->i", x[r], self.x[c]) >= self.cosine
        return out

    def forest(self, hit: np.ndarray, keys: np.ndarray) -> tuple[list[int], list[int]]:
        """Links (a, b) that join all components that the hits join, at most a spanning forest of them and one a row."""
        a, b = [], []
        for row in np.flatnonzero(hit.any(1)):
            groups, first = np.unique(self.group[hit[row]], return_index=True)
            members = np.flatnonzero(hit[row])[first]
            a += [int(keys[row])] * len(members)
            b += self.keys[members].tolist()
            if len(groups) > 1:
                self.group[np.isin(self.group, groups)] = groups[0]
        return a, b

    def _out(self, hit: np.ndarray, keys: np.ndarray, weights: np.ndarray, both: bool) -> Iterator[pd.DataFrame]:
        gained = hit @ self.weights
        frames = [pd.DataFrame({"kind": 0, "a": keys, "b": gained})]
        if both:
            frames.append(pd.DataFrame({"kind": 0, "a": self.keys, "b": weights @ hit}))
        a, b = self.forest(hit, keys)
        frames.append(pd.DataFrame({"kind": 1, "a": a, "b": b}))
        out = pd.concat(frames).astype("int64")
        yield out[(out["kind"] == 1) | (out["b"] > 0)]

    def own(self) -> Iterator[pd.DataFrame]:
        hit = self.links(self.x)
        hit |= hit.T
        np.fill_diagonal(hit, False)
        yield from self._out(hit, self.keys, self.weights, both=False)

    def visited(self, rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        """A link of two cells is met in both if both rows visit; the lower cell reports it then."""
        home = rows["cell"].to_numpy()
        hit = self.links(np.stack([unit(r) for r in rows["raw"]]))
        if self.cell >= 0:
            other = (home != self.cell) & (self.cell > home)
            hit[other] &= ~self.visits[:, home[other]].T
        yield from self._out(hit, rows["key"].to_numpy(), rows["weight"].to_numpy(), both=True)


def _compare(index: Index | None, cosine: float):
    """Streams rows sorted by (task, guest): a task's members first, then its visitors, batch by batch."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, held, block = None, [], None

        def settle():
            nonlocal block
            if block is None and held:
                members = pd.concat(held)
                block = _Block(members, index, cosine)
                if members["slice"].iloc[0] == 0:  # the first slice also compares the members with each other
                    yield from block.own()
            held.clear()

        for batch in batches:
            ids = list(zip(batch["label"], batch["at_cell"], batch["block"], batch["slice"]))
            cuts = [0] + [i for i in range(1, len(ids)) if ids[i] != ids[i - 1]] + [len(ids)]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if lo == hi:
                    continue
                if ids[lo] != task:
                    yield from settle()
                    task, block = ids[lo], None
                part = batch.iloc[lo:hi]
                guests = part["guest"].to_numpy()
                if (~guests).any():
                    held.append(part[~guests])
                if guests.any():
                    yield from settle()
                    if block is not None:
                        rows = part[guests]
                        for at in range(0, len(rows), 256):
                            yield from block.visited(rows.iloc[at:at + 256])
        yield from settle()
    return run


def near_duplicates(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str | None = "label",
                    cosine: float = COSINE, slack: float = PROBE_SLACK, sample: int = SAMPLE,
                    per_cell: int = PER_CELL) -> DataFrame:
    """One row per vector: (key, n_links, component_id, kept).

    Vectors are compared within a label. A null label, a null or zero vector and
    one with null or non-finite components link with nothing (and stay). Vectors
    of different dimensions don't link. Equal vectors link with each other and
    are compared once. A null key has the component null. Repeated rows count as
    vectors of their own. Extra columns stay behind; an empty table gives no rows.
    """
    spark = df.sparkSession
    ship(spark)
    name = F.col(label).cast("string") if label else F.lit("")
    rows = written(df.select(F.col(key).cast("long").alias("id"), name.alias("label"),
                             F.col(vector).cast("array<double>").alias("v"))
                   .mapInArrow(_clean, "id bigint, label string, raw binary, digest binary"), "vectors")
    classes = written(rows.where("raw is not null and id is not null").groupBy("label", "digest").agg(
        F.min("id").alias("key"), F.count(F.lit(1)).alias("weight"), F.first("raw").alias("raw")), "vector-classes")
    chosen = [np.frombuffer(r["raw"]) for r in classes.orderBy(F.xxhash64("key"), "key").limit(sample).select("raw").collect()]
    index = None
    if chosen:
        dim = max(set(map(len, chosen)), key=lambda d: (sum(len(c) == d for c in chosen), d))
        fitted_on = np.stack([unit(c.tobytes()) for c in chosen if len(c) == dim])
        n, labels = classes.agg(F.count(F.lit(1)), F.count_distinct("label")).first()
        index = fit(fitted_on, max(1, min(MOST_CELLS, n // (per_cell * labels))))
    placed = written(classes.mapInPandas(_place(index, slack * math.sqrt(2 - 2 * cosine)), _PLACED), "placed")

    # Members of a cell are cut into blocks, visitors of a cell into slices. Every row visits
    # the later blocks of its own cell, too.
    cells = written(placed.groupBy("label", "cell").agg(F.ceil(F.count(F.lit(1)) / MEMBERS).cast("int").alias("blocks")), "cells")
    visits = placed.select("label", F.explode("probes").alias("cell")).groupBy("label", "cell").agg(F.count(F.lit(1)).alias("guests"))
    plan = written(cells.join(visits, ["label", "cell"], "left").select(
        F.col("label").alias("p_label"), F.col("cell").alias("at_cell"), "blocks",
        F.ceil((F.coalesce("guests", F.lit(0)) + F.col("blocks") * F.lit(MEMBERS)) / VISITORS).cast("int").alias("slices")), "cell-plan")
    base = ["label", "cell", "key", "weight", "raw", "code", "error", "probes"]
    homed = placed.join(plan, (F.col("label") == F.col("p_label")) & (F.col("cell") == F.col("at_cell"))).withColumn(
        "own_block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    hashed = F.pmod(F.xxhash64("key", F.lit("slice")), F.col("slices")).cast("int")
    members = homed.select(*base, "at_cell", F.col("own_block").alias("block"),
                           F.explode(F.expr("sequence(0, slices - 1)")).alias("slice"), F.lit(False).alias("guest"))
    siblings = homed.where("own_block < blocks - 1").select(
        *base, "at_cell", F.explode(F.expr("sequence(own_block + 1, blocks - 1)")).alias("block"), hashed.alias("slice"), F.lit(True).alias("guest"))
    abroad = placed.select(*base, F.explode("probes").alias("to")).join(
        plan, (F.col("label") == F.col("p_label")) & (F.col("to") == F.col("at_cell"))).select(
        *base, "at_cell", F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"), hashed.alias("slice"), F.lit(True).alias("guest"))
    order = ["label", "at_cell", "block", "slice"]
    found = written(members.union(siblings).union(abroad).repartition(*order).sortWithinPartitions(*order, "guest")
                    .mapInPandas(_compare(index, cosine), "kind int, a bigint, b bigint"), "vector-links")
    counts = found.where("kind = 0").groupBy(F.col("a").alias("key")).agg(F.sum("b").alias("gained"))
    reach = connected_components(found.where("kind = 1").select("a", "b"))
    named = written(classes.select("label", "digest", "key", "weight").join(counts, "key", "left")
                    .join(reach, F.col("key") == F.col("node"), "left").select(
        F.col("label").alias("c_label"), F.col("digest").alias("c_digest"),
        (F.coalesce("gained", F.lit(0)) + F.col("weight") - 1).cast("long").alias("n_links"),
        F.coalesce("component", "key").alias("component")), "vector-classes-named")
    out = rows.select("id", "label", "digest").join(named, (F.col("label") == F.col("c_label")) & (F.col("digest") == F.col("c_digest")), "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return out.select(F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
