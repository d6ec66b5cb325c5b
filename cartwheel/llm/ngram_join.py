"""Operator 7: exact n-gram Jaccard join with set-relation skipping.

Documents are sets of hashed word shingles. The result is the components of the
link graph (Jaccard >= 0.8), found without visiting every pair:

1. Equal sets fold into one class.
2. Every class files its prefix (the shingles of which a partner must share one)
   in inverted lists, shingles that recur in many documents last.
3. Answer level: classes that long lists connect are groups of similar sets. A
   group is compared in blocks that hold their sets' own index. A set's overlaps
   with all residents of a block are derived from those of a highly similar set
   computed before it, by the postings of the shingles in which the two differ.
4. Index level: lists outside groups hold their entries in blocks of set size
   with the shingle's position; a member skips the blocks whose size or
   remaining positions can't reach the overlap, and members of its own group.
   The pairs left pass a parity-bitmap bound, then an exact comparison.

Two sets that link share a list (prefix filter); if that makes them one group,
step 3 compares them, otherwise step 4. No link is lost, whatever counts as
frequent or long, so the result is exact (for 64-bit shingle hashes).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import discard, ship, small_batches, text_bytes, written
from cartwheel.llm.components import connected_components

SHINGLE = 5
#: Two sets link when UNION_SHARE[1] * intersection >= UNION_SHARE[0] * union.
SHARE = (80, 100)
#: A shingle that so many prefixes hold goes to the end of the order. Changes no result.
FREQUENT = 8
#: Frequent shingles that the order's bitmap takes at most; of more, the most frequent ones. Changes no result.
MOST_FREQUENT = 1 << 21
#: Lists of more entries make their members a group. Changes no result.
LONG = 8
#: Members of a block that a task holds, and visitors in a slice.
RESIDENTS, VISITORS = 512, 512
_BITS = 1 << 24

# ---------------------------------------------------------------- shingle sets of a batch

_U = np.uint64
_CHUNK_BYTES = 1 << 20


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, dtype=np.uint64)
    out[0] = 1
    done = 1
    while done < n:
        more = min(done, n - done)
        with np.errstate(over="ignore"):
            out[done:done + more] = out[:more] * _U(pow(base, done, 1 << 64))
        done += more
    return out


_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_letters = np.arange(256, dtype=np.uint64)
_letters[65:91] += _U(32)
_BYTE = _mix(_letters + _U(0x1234567))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_tables: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _tables or len(_tables["up"]) < n:
        size = max(n, _CHUNK_BYTES + 1)
        _tables["up"], _tables["down"] = _powers(_BASE, size), _powers(_BASE_INVERSE, size)
    return _tables["up"], _tables["down"]


def shingle_sets(off: np.ndarray, raw: np.ndarray, size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of every text of a batch.

    A-Z count as a-z, white space is space and 0x09-0x0D. A text of fewer words
    than a shingle is one shingle of all its words; without words it is empty.
    """
    n = len(off) - 1
    data = raw[off[0]:off[-1]]
    base = off - off[0]
    empty = np.zeros(0, dtype=np.uint64)
    if len(data) == 0:
        return [empty] * n
    with np.errstate(over="ignore"):
        up, down = _power_tables(len(data) + 1)
        word = ~_SPACE[data]
        first = word.copy()
        first[1:] &= ~word[:-1]
        edges = base[:-1][(base[:-1] < base[1:])]
        first[edges] = word[edges]
        start = np.flatnonzero(first)
        if len(start) == 0:
            return [empty] * n
        last = word.copy()
        last[:-1] &= ~word[1:]
        last[edges[1:] - 1] = word[edges[1:] - 1]
        end = np.flatnonzero(last) + 1
        total = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[data] * up[:len(data)], out=total[1:])
        hashed = _mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64) * _U(0xD6E8FEB86659FD93))
        bounds = np.searchsorted(start, base)
        rolled = hashed[:max(0, len(hashed) - size + 1)].copy()
        for k in range(1, size):
            rolled = _mix(rolled * _U(3) + hashed[k:len(hashed) - size + 1 + k])
        out = []
        for lo, hi in zip(bounds[:-1], bounds[1:]):
            if hi - lo >= size:
                own = np.sort(rolled[lo:hi - size + 1])
                keep = np.empty(len(own), dtype=bool)
                keep[0] = True
                np.not_equal(own[1:], own[:-1], out=keep[1:])
                out.append(own[keep])
            elif hi > lo:
                h = hashed[lo:lo + 1].copy()
                for k in range(lo + 1, hi):
                    h = _mix(h * _U(3) + hashed[k:k + 1])
                out.append(_mix(h + _U(hi - lo)))
            else:
                out.append(empty)
    return out


def _sets(batches: Iterator[pa.RecordBatch], text: str, size: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in small_batches(batches, text, _CHUNK_BYTES):
        yield batch, shingle_sets(*text_bytes(batch.column(batch.schema.get_field_index(text))), size)


def _digest(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


# ---------------------------------------------------------------- bounds

def needed(one, two, share: tuple[int, int] = SHARE):
    """Least intersection of linked sets of these sizes: ceil(p (a + b) / (p + q)) for p / q."""
    p, q = share
    return -(-p * (one + two) // (p + q))


def prefix_length(n: int, share: tuple[int, int] = SHARE) -> int:
    """Shingles of which a linked partner must share one."""
    p, q = share
    return n - -(-p * n // q) + 1


def linked(a: np.ndarray, b: np.ndarray, share: tuple[int, int] = SHARE) -> bool:
    """Exact test of two sorted sets."""
    if share[1] * min(len(a), len(b)) < share[0] * max(len(a), len(b)):
        return False
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = len(b) - 1
    return int((b[at] == a).sum()) >= needed(len(a), len(b), share)


def parity_bitmap(tokens: np.ndarray) -> bytes:
    """One bit a bucket of the shingles, set if an odd number fell into it; as many buckets as twice the set, about."""
    width = 1 << max(6, min(16, int(2 * len(tokens)).bit_length()))
    odd = np.bincount((tokens & _U(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def may_link(one: bytes, two: bytes, n_one: int, n_two: int, share: tuple[int, int] = SHARE) -> bool:
    """Whether the bitmaps allow the overlap: each differing bit is a shingle that only one of the sets has."""
    a, b = (np.unpackbits(np.frombuffer(x, dtype=np.uint8)) for x in (one, two))
    while len(a) > len(b):
        a = a[:len(a) // 2] ^ a[len(a) // 2:]
    while len(b) > len(a):
        b = b[:len(b) // 2] ^ b[len(b) // 2:]
    return (n_one + n_two - int(np.count_nonzero(a != b))) // 2 >= needed(n_one, n_two, share)


def key_bitmap(df: DataFrame, key: str) -> np.ndarray:
    """A bitmap of 2^24 bits (2 MB whatever the table holds) of the keys' low bits.

    A key that isn't in it is surely not in ``df``; it only spares work.
    """
    rows = (df.select(F.pmod(F.col(key), F.lit(_BITS)).alias("k"))
            .groupBy(F.expr("cast(k div 64 as int)").alias("word"))
            .agg(F.expr("bit_or(shiftleft(1L, cast(k % 64 as int)))").alias("bits")).collect())
    out = np.zeros(_BITS // 64, dtype=np.uint64)
    if rows:
        out[[r["word"] for r in rows]] = np.array([r["bits"] for r in rows], dtype=np.int64).view(np.uint64)
    return out


def in_bitmap(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    low = np.mod(keys, _BITS).astype(np.int64) if keys.dtype != np.uint64 else (keys & _U(_BITS - 1)).astype(np.int64)
    return (bitmap[low >> 6] >> (low & 63).astype(np.uint64) & _U(1)).astype(bool)


# ---------------------------------------------------------------- passes over the texts

_SEEN = "key bigint, n bigint, digest binary"


def _survey(size: int):
    """Per text: set size and digest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets in _sets(batches, "text", size):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([_digest(s) for s in sets], pa.binary())],
                names=["key", "n", "digest"])
    return run


def _prefix_counts(size: int, share: tuple[int, int]):
    """(token, seen): shingles of the prefixes by hash alone, half as long again, counted by the task in turn."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        total = 0

        def counted() -> pa.RecordBatch:
            tokens, counts = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64)), pa.array(counts.astype(np.int32))], names=["token", "seen"])

        for _, sets in _sets(batches, "text", size):
            held += [s[:prefix_length(len(s), share) * 3 // 2] for s in sets if len(s)]
            total += sum(map(len, held[-len(sets):]))
            if total > 500_000:
                yield counted()
                total = 0
        if held:
            yield counted()
    return run


def frequent_shingles(docs: DataFrame, size: int, share: tuple[int, int]) -> np.ndarray:
    """Bitmap of the shingles that many prefixes hold, counted over all documents."""
    often = written(docs.mapInArrow(_prefix_counts(size, share), "token bigint, seen int").groupBy("token").agg(
        F.sum("seen").alias("seen")).where(F.col("seen") >= FREQUENT), "frequent")
    levels = often.groupBy(F.floor(F.log2("seen")).cast("int").alias("level")).count().orderBy(F.desc("level")).collect()
    least, room = None, MOST_FREQUENT
    for row in levels:  # one row a power of two
        room -= row["count"]
        if room < 0:
            break
        least = 2 ** row["level"]
    out = key_bitmap(often.where(F.col("seen") >= (least or 1 << 62)), "token")
    discard(often)
    return out


def _fetch(size: int, wanted: np.ndarray):
    """(key, digest, tokens) of the texts whose key may be wanted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def chosen() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                mask = in_bitmap(wanted, batch.column(0).to_numpy(zero_copy_only=False))
                if mask.any():
                    yield batch.filter(pa.array(mask))
        for batch, sets in _sets(chosen(), "text", size):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([_digest(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())],
                names=["key", "digest", "tokens"])
    return run


def _profile(size: int, share: tuple[int, int], wanted: np.ndarray, frequent: np.ndarray):
    """(key, digest, n, prefix, bitmap): the prefix in the order of (frequent, hash)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def chosen() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                mask = in_bitmap(wanted, batch.column(0).to_numpy(zero_copy_only=False))
                if mask.any():
                    yield batch.filter(pa.array(mask))
        for batch, sets in _sets(chosen(), "text", size):
            prefixes = []
            for s in sets:
                late = in_bitmap(frequent, s)
                prefixes.append(np.concatenate([s[~late], s[late]])[:prefix_length(len(s), share) if len(s) else 0].view(np.int64))
            offsets = np.concatenate([[0], np.cumsum([len(p) for p in prefixes])]).astype(np.int32)
            values = np.concatenate(prefixes) if prefixes else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([_digest(s) for s in sets], pa.binary()), pa.array([len(s) for s in sets], pa.int64()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)),
                 pa.array([parity_bitmap(s) for s in sets], pa.binary())], names=["key", "digest", "n", "prefix", "bitmap"])
    return run


# ---------------------------------------------------------------- answer level: groups

class _Block:
    """Residents of a group's block with an index of their sets; answers for one set after the other."""

    def __init__(self, keys: list[int], sets: list[np.ndarray], share: tuple[int, int]):
        self.keys, self.share = np.array(keys, dtype=np.int64), share
        self.sizes = np.array([len(x) for x in sets])
        tokens = np.concatenate(sets)
        order = np.argsort(tokens, kind="stable")
        self.owner = np.repeat(np.arange(len(sets)), self.sizes)[order]
        self.tokens, first = np.unique(tokens[order], return_index=True)
        self.ends = np.append(first, len(tokens))
        self.group = np.arange(len(sets))
        self.known: tuple[np.ndarray, np.ndarray] | None = None  # a set answered before, and its overlaps

    def _postings(self, tokens: np.ndarray) -> np.ndarray:
        """How many of the shingles each resident has."""
        at = np.searchsorted(self.tokens, tokens)
        at[at == len(self.tokens)] = 0
        at = at[self.tokens[at] == tokens]
        if not len(at):
            return np.zeros(len(self.keys), dtype=np.int64)
        starts, counts = self.ends[at], self.ends[at + 1] - self.ends[at]
        places = np.repeat(starts - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
        return np.bincount(self.owner[places], minlength=len(self.keys))

    def overlaps(self, tokens: np.ndarray) -> np.ndarray:
        """Intersections of a set with every resident, from a similar set's where that is less work."""
        if self.known is not None:
            before, counts = self.known
            more, less = np.setdiff1d(tokens, before, assume_unique=True), np.setdiff1d(before, tokens, assume_unique=True)
            if len(more) + len(less) < len(tokens):
                return counts + self._postings(more) - self._postings(less)
        counts = self._postings(tokens)
        self.known = tokens, counts
        return counts

    def answer(self, key: int, tokens: np.ndarray, among: int) -> list[tuple[int, int]]:
        """Links of a set with the first ``among`` residents, one for each component that they are in so far."""
        hit = self.overlaps(tokens)[:among] >= needed(self.sizes[:among], len(tokens), self.share)
        linked_ = np.flatnonzero(hit)
        if not len(linked_):
            return []
        groups, first = np.unique(self.group[linked_], return_index=True)
        if len(groups) > 1:
            self.group[np.isin(self.group, groups)] = groups[0]
        return [(key, int(self.keys[i])) for i in linked_[first]]


def _compare(share: tuple[int, int]):
    """Streams rows sorted by (task, guest, n): the residents of a block, then its visitors."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, keys, sets, block = None, [], [], None
        links: list[tuple[int, int]] = []

        def settle(own: bool) -> None:
            nonlocal block
            if block is None and keys:
                block = _Block(keys, sets, share)
                if own:  # the first slice also compares the residents with each other
                    for i in range(1, len(keys)):
                        found = block.answer(keys[i], sets[i], i)
                        links.extend(found)
                        for _, other in found:
                            j = keys.index(other)
                            block.group[block.group == block.group[i]] = block.group[j]

        for batch in batches:
            for row in batch.itertuples(index=False):
                now = (row.group, row.block, row.slice)
                if now != task:
                    if task is not None:
                        settle(task[2] == 0)
                    task, keys, sets, block = now, [], [], None
                tokens = np.frombuffer(row.tokens, dtype=np.uint64)
                if not row.guest:
                    keys.append(row.key)
                    sets.append(tokens)
                else:
                    settle(row.slice == 0)
                    if block is not None:
                        links += block.answer(row.key, tokens, len(keys))
            yield pd.DataFrame(links, columns=["a", "b"], dtype="int64")
            links.clear()
        if task is not None:
            settle(task[2] == 0)
        yield pd.DataFrame(links, columns=["a", "b"], dtype="int64")
    return run


def _groups(shared: DataFrame) -> DataFrame:
    """(node, component): classes that lists of more than LONG entries connect."""
    long = written(shared.groupBy("token").agg(F.count(F.lit(1)).alias("entries"), F.min("key").alias("first"))
                   .where(F.col("entries") > LONG).select("token", "first"), "long-lists")
    return connected_components(shared.join(long, "token").select(F.col("key").alias("a"), F.col("first").alias("b")).distinct())


def _group_links(docs: DataFrame, classes: DataFrame, size: int, share: tuple[int, int]) -> DataFrame:
    """Links (a, b) inside groups: a spanning set for every block, by exact comparison of all members."""
    members = written(classes.where("grouped").select("key", "digest", F.col("component").alias("group")), "group-members")
    sizes = written(members.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / RESIDENTS).cast("int").alias("blocks")), "group-sizes")
    fetched = docs.mapInArrow(_fetch(size, key_bitmap(members, "key")), "key bigint, digest binary, tokens binary")
    # Rows that repeat a member repeat its links only, so they may stay.
    rows = written(fetched.join(members.join(sizes, "group"), ["key", "digest"]).select(
        "group", "key", "tokens", F.octet_length("tokens").alias("n"), "blocks",
        F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int").alias("own")), "group-sets")
    # A block's visitors are the members of the blocks before it, about `block` times RESIDENTS of them.
    slices = F.greatest(F.lit(1), F.ceil(F.col("block") * F.lit(RESIDENTS) / F.lit(VISITORS))).cast("int")
    residents = (rows.withColumn("block", F.col("own")).withColumn("slice", F.explode(F.sequence(F.lit(0), slices - 1)))
                 .select("group", "block", "slice", F.lit(False).alias("guest"), "n", "key", "tokens"))
    guests = (rows.where("own < blocks - 1").withColumn("block", F.explode(F.sequence(F.col("own") + 1, F.col("blocks") - 1)))
              .withColumn("slice", F.pmod(F.xxhash64("key", F.lit(1)), slices).cast("int"))
              .select("group", "block", "slice", F.lit(True).alias("guest"), "n", "key", "tokens"))
    order = ["group", "block", "slice"]
    return written(residents.unionByName(guests).repartition(*order).sortWithinPartitions(*order, "guest", "n", "key")
                   .mapInPandas(_compare(share), "a bigint, b bigint"), "group-links")


# ---------------------------------------------------------------- index level: inverted lists

def _whole_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Cut a stream sorted by its first column so that no list of equal values is split."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        token = batch.column(0).to_numpy()
        if held and held[-1].column(0)[0].as_py() != token[0]:
            yield pa.Table.from_batches(held)
            held = []
        at = int(np.searchsorted(token != token[-1], False)) if token[0] == token[-1] else int(np.flatnonzero(token != token[-1])[-1]) + 1
        if at:
            yield pa.Table.from_batches([*held, batch.slice(0, at)])
            held = []
        held.append(batch.slice(at))
    if held:
        yield pa.Table.from_batches(held)


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries of lists that hold more than one."""
    for table in _whole_lists(batches):
        token = table.column(0).to_numpy()
        same = np.zeros(len(token) + 1, dtype=bool)
        same[1:-1] = token[1:] == token[:-1]
        yield from table.filter(pa.array(same[1:] | same[:-1])).to_batches()


def _pairs(share: tuple[int, int]):
    """Candidate pairs of lists sorted by (token, n): a member against the later ones in step.

    A member leaves the race as soon as the next entry's block of sizes is out
    of reach (all later ones are larger still); entries of its own group and
    positions that leave too few shingles are skipped.
    """
    p, q = share

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_lists(batches):
            token, key, n, position, component = (table.column(c).to_numpy() for c in range(5))
            racing, step = np.arange(len(token) - 1), 1
            while len(racing):
                other = racing + step
                inside = other < len(token)
                racing, other = racing[inside], other[inside]
                fits = (token[racing] == token[other]) & (q * n[racing] >= p * n[other])
                racing, other = racing[fits], other[fits]
                reach = 1 + np.minimum(n[racing] - position[racing], n[other] - position[other]) - 1
                keep = (component[racing] != component[other]) & (reach >= needed(n[racing], n[other], share))
                if keep.any():
                    one, two = key[racing[keep]], key[other[keep]]
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(one, two)), pa.array(np.maximum(one, two))], names=["a", "b"])
                step += 1
    return run


def _sift(share: tuple[int, int]):
    """Pairs that their parity bitmaps allow."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            keep = [may_link(*row, share) for row in zip(x["bitmap_a"], x["bitmap_b"], x["n_a"], x["n_b"])]
            yield x.loc[np.array(keep, dtype=bool), ["a", "b"]]
    return run


def _verify(share: tuple[int, int]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            keep = [linked(np.frombuffer(a, dtype=np.uint64), np.frombuffer(b, dtype=np.uint64), share)
                    for a, b in zip(x["tokens_a"], x["tokens_b"])]
            yield x.loc[np.array(keep, dtype=bool), ["a", "b"]]
    return run


def _both_sides(pairs: DataFrame, values: DataFrame, columns: list[str]) -> DataFrame:
    """Pairs (a, b) with the named columns of both keys."""
    for side in ("a", "b"):
        named = values.select(F.col("key").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns])
        pairs = pairs.join(named, side)
    return pairs


def _list_links(known: DataFrame, shared: DataFrame, profiles: DataFrame, classes: DataFrame, size: int,
                share: tuple[int, int]) -> DataFrame:
    """Verified links (a, b) between classes that meet in a list but in no group."""
    listed = written(shared.join(classes.select("key", F.xxhash64("digest").alias("check"), "component"), ["key", "check"])
                     .select("token", "key", "n", "position", "component"), "listed")
    mixed = written(listed.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"))
                    .where("low < high").select("token"), "mixed")
    pairs = written(listed.join(mixed, "token").select("token", "key", "n", "position", "component")
                    .repartition("token").sortWithinPartitions("token", "n", "key")
                    .mapInArrow(_pairs(share), "a bigint, b bigint").distinct(), "pairs")
    sketches = profiles.join(classes.select("key", "digest"), ["key", "digest"], "left_semi").select("key", "n", "bitmap").distinct()
    sifted = written(_both_sides(pairs, sketches, ["n", "bitmap"]).select("a", "b", "n_a", "n_b", "bitmap_a", "bitmap_b")
                     .mapInPandas(_sift(share), "a bigint, b bigint").distinct(), "sifted")
    wanted = written(sifted.select(F.col("a").alias("key")).union(sifted.select(F.col("b").alias("key"))).distinct(), "wanted")
    sets = written(known.mapInArrow(_fetch(size, key_bitmap(wanted, "key")), "key bigint, digest binary, tokens binary")
                   .join(wanted, "key", "left_semi")
                   .join(classes.select("key", "digest"), ["key", "digest"], "left_semi").distinct(), "sets")
    verified = written(_both_sides(sifted, sets, ["tokens"]).select("a", "b", "tokens_a", "tokens_b")
                       .mapInPandas(_verify(share), "a bigint, b bigint").distinct(), "links")
    for table in (listed, mixed, pairs, sifted, wanted, sets):
        discard(table)
    return verified


def _label(classes: DataFrame, reach: DataFrame) -> DataFrame:
    """Classes with the component they are in (their own key where nothing reaches them)."""
    return written(classes.select("key", "digest").join(reach, classes["key"] == reach["node"], "left").select(
        "key", "digest", F.coalesce("component", "key").alias("component"), F.col("component").isNotNull().alias("grouped")), "labelled")


def jaccard_components(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE,
                       share: tuple[int, int] = SHARE) -> DataFrame:
    """One row per input row: (key, n_shingles, component_id).

    ``component_id`` is the smallest key that links reach. Null and empty texts
    and texts of white space have an empty set and link with nothing. Repeated
    rows link with each other as equal sets do; rows of one key are one node. A
    null key is given the component null. Extra columns stay behind, an empty
    table gives no rows.
    """
    ship(df.sparkSession)
    docs = df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    rows = written(docs.mapInArrow(_survey(size), _SEEN), "survey")
    known = docs.where("key is not null")
    classes = written(rows.where("n > 0 and key is not null").groupBy("digest").agg(F.min("key").alias("key")), "classes")
    profiles = written(known.mapInArrow(
        _profile(size, share, key_bitmap(classes, "key"), frequent_shingles(known, size, share)),
        "key bigint, digest binary, n bigint, prefix array<bigint>, bitmap binary"), "profiles")
    filed = profiles.join(classes, ["key", "digest"], "left_semi")  # of equal sets one class alone
    entries = filed.select(F.posexplode("prefix").alias("position", "token"), "key", "n", "digest").select(
        "token", "key", "n", "position", F.xxhash64("digest").alias("check"))
    shared = written(entries.repartition("token").sortWithinPartitions("token").mapInArrow(
        _shared, "token bigint, key bigint, n bigint, position int, check bigint"), "entries")
    grouped = _label(classes, _groups(shared))
    links = _group_links(known, grouped, size, share).union(_list_links(known, shared, profiles, grouped, size, share))
    labelled = _label(classes, connected_components(links))
    discard(profiles)
    discard(shared)
    return rows.join(labelled.select("digest", "component"), "digest", "left").select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"),
        F.when(F.col("key").isNotNull(), F.coalesce("component", "key")).alias("component_id"))


def keep_representatives(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE,
                         share: tuple[int, int] = SHARE) -> DataFrame:
    """``df`` with the row of the smallest key of every component, in its own columns; rows without a key stay."""
    gone = (jaccard_components(df, key, text, size, share).where(F.col(key) != F.col("component_id"))
            .select(F.col(key).alias("_gone")).distinct())
    return df.join(gone, F.col(key).cast("long") == F.col("_gone"), "left_anti")
