"""Operator 6: best-fit packing by bin-completion branch-and-bound.

Only lengths matter to a packing, and there are at most ``capacity`` of them.
Spark counts the pieces of each length; the driver plans on this histogram (its
size is bounded by the capacity, whatever the corpus holds), and every piece
then finds its place from its length and its rank among the pieces of that
length. The plan says how many sequences are filled by which lengths.

The search takes the largest length that is left, enumerates the undominated
fillings of the rest of its sequence, least waste first, and uses one for as
many sequences as the counts allow, or for half as many, and so on down to one. A
branch ends when its waste leaves no room for beating the incumbent. Incumbents
start as the best-fit decreasing packing and as completions without going back,
around the largest and around the smallest piece. Among fillings of equal waste
the order decides what is left for later sequences, so the search starts anew for
every order of lengths (``ORDERS``), each with its share of the effort.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import ship, small_batches, text_bytes, written
from cartwheel.llm.tokenizers import encoding_of, hf_tokenizer

CAPACITY = 1024
END_ID = 2
VOCABULARY = "byte_bpe_50k.json"
#: Search effort of the branch-and-bound, in fillings tried over all orders. The incumbent stands if it runs out.
NODES = 4_800
#: Orders in which fillings of equal waste take their lengths: longest or shortest first, nearest to half the room, or
#: nearest to the mean of what is left.
ORDERS = ("long", "even", "mean", "short")
#: Fillings kept for one largest length in one state (eight times as many are looked at).
WIDTH = 12
#: Parts of a length's pieces for ranking; a rank is the pieces in earlier parts plus the place in its own.
RANK_PARTS = 4096

Plan = list[tuple[tuple[int, ...], int]]


# ---------------------------------------------------------------- planning on the histogram

def lower_bound(counts: list[int], capacity: int) -> int:
    """Sequences that any packing needs: by volume, and with pieces too large to share for every small size."""
    best = -(-sum(n * c for n, c in enumerate(counts)) // capacity)
    for k in range(1, capacity // 2 + 1):
        alone = sum(counts[capacity - k + 1:])
        half = counts[capacity // 2 + 1:capacity - k + 1]
        room = sum((capacity - n) * c for n, c in enumerate(half, capacity // 2 + 1))
        small = sum(n * counts[n] for n in range(k, capacity // 2 + 1))
        best = max(best, alone + sum(half) + max(0, -(-(small - room) // capacity)))
    return best


def best_fit(counts: list[int], capacity: int) -> Plan:
    """Best-fit decreasing on counts: equal sequences are filled together."""
    open_: dict[int, list[list]] = {}
    for size in range(capacity, 0, -1):
        left = counts[size]
        while left:
            fits = [r for r in open_ if r >= size]
            if fits:
                room = min(fits)
                filling, times = open_[room].pop()
                if not open_[room]:
                    del open_[room]
                used = min(left, times)
                if used < times:
                    open_.setdefault(room, []).append([filling, times - used])
                open_.setdefault(room - size, []).append([filling + (size,), used])
                left -= used
            else:
                each = capacity // size
                times, rest = divmod(left, each)
                if times:
                    open_.setdefault(capacity - each * size, []).append([(size,) * each, times])
                if rest:
                    open_.setdefault(capacity - rest * size, []).append([(size,) * rest, 1])
                left = 0
    return [(filling, times) for groups in open_.values() for filling, times in groups]


def _reached(counts: list[int], sizes: list[int], room: int) -> list[int]:
    """For every i: the sums up to ``room`` of pieces from sizes[i:], a bit each."""
    mask = (1 << (room + 1)) - 1
    reach = [1] * (len(sizes) + 1)
    for i in range(len(sizes) - 1, -1, -1):
        bits, size = reach[i + 1], sizes[i]
        left, some = min(counts[size], room // size), 1
        while left:  # 1, 2, 4, ... copies make every number of copies
            some = min(some, left)
            bits |= bits << (size * some) & mask
            left -= some
            some *= 2
        reach[i] = bits
    return reach


def _ordered(counts: list[int], room: int, order: str) -> list[int]:
    """Lengths up to ``room`` that are there, in an order of ``ORDERS``."""
    sizes = [n for n in range(min(room, len(counts) - 1), 0, -1) if counts[n]]
    if order == "short":
        sizes.reverse()
    elif order == "even":
        sizes.sort(key=lambda n: abs(2 * n - room))
    elif order == "mean":
        pieces = sum(counts)
        total = sum(n * c for n, c in enumerate(counts))
        sizes.sort(key=lambda n: abs(n * pieces - total))
    return sizes


def _fullest(counts: list[int], room: int, order: str) -> tuple[int, ...]:
    """One filling of least waste, the first in its order."""
    sizes = _ordered(counts, room, order)
    reach = _reached(counts, sizes, room)
    total, used = reach[0].bit_length() - 1, []
    for i, size in enumerate(sizes):
        k = next((k for k in range(min(counts[size], total // size), 0, -1) if reach[i + 1] >> (total - k * size) & 1), 0)
        used += [size] * k
        total -= k * size
    return tuple(used)


def completed(counts: list[int], capacity: int, order: str, around_largest: bool) -> Plan:
    """A packing without going back: the fullest sequence around the largest (or smallest) piece that is left, again and again."""
    counts, plan = list(counts), []
    while any(counts):
        lengths = range(capacity, 0, -1) if around_largest else range(1, capacity + 1)
        one = next(n for n in lengths if counts[n])
        counts[one] -= 1
        filling = (one, *_fullest(counts, capacity - one, order))
        counts[one] += 1
        need = Counter(filling)
        times = min(counts[n] // k for n, k in need.items())
        for n, k in need.items():
            counts[n] -= k * times
        plan.append((filling, times))
    return plan


def fillings(counts: list[int], room: int, most: int = WIDTH, order: str = "long") -> Iterator[tuple[int, tuple[int, ...]]]:
    """Undominated fillings (waste, lengths) of ``room``, least waste first, those of equal waste by ``order``.

    A filling is dominated if a longer piece that is there could take the place
    of one of its pieces, or of two of them together, within the waste. A single
    piece that fills the room exactly dominates all others.
    """
    if room and counts[room]:
        yield 0, (room,)
        return
    sizes = _ordered(counts, room, order)
    reach = _reached(counts, sizes, room)
    found = 0

    def made(i: int, total: int, used: tuple[int, ...]) -> Iterator[tuple[int, ...]]:
        """Fillings of exactly ``total`` by sizes[i:], earlier lengths first."""
        if total == 0:
            yield used
            return
        while i < len(sizes) and reach[i] >> total & 1:
            size = sizes[i]
            for k in range(min(counts[size], total // size), 0, -1):
                if reach[i + 1] >> (total - k * size) & 1:  # so every step leads to a filling
                    yield from made(i + 1, total - k * size, used + (size,) * k)
            i += 1

    tried, spare = 0, None
    for total in range(room, -1, -1):
        if not reach[0] >> total & 1:
            continue
        waste = room - total
        for used in made(0, total, ()):
            tried += 1
            spare = spare or (waste, used)
            own = Counter(used)
            longer = lambda low, high: any(counts[n] > own.get(n, 0) for n in range(low, min(high, len(counts) - 1) + 1))
            kinds = sorted(own)
            pairs = {x + y for j, x in enumerate(kinds) for y in kinds[j:] if x != y or own[x] > 1}
            if not (waste and any(longer(n + 1, n + waste) for n in kinds)) and not any(longer(n, n + waste) for n in pairs):
                yield waste, used
                found += 1
            if found >= most or tried >= 8 * most:
                break
        if found >= most or tried >= 8 * most:
            break
    if not found and spare:
        yield spare


def _times(most: int) -> Iterator[int]:
    """How often a filling is used: as often as it can, half as often, ..., once."""
    while most > 0:
        yield most
        most //= 2


def bin_completion(counts: list[int], capacity: int = CAPACITY, nodes: int = NODES) -> tuple[Plan, int]:
    """(plan, lower bound): fillings with their number of sequences, as few in total as the search finds.

    The plan is as good as it can be if it meets the bound or the effort isn't used up; else the difference bounds
    what it may lose.
    """
    counts = list(counts) + [0] * (capacity + 1 - len(counts))
    lower = lower_bound(counts, capacity)
    plans = [best_fit(counts, capacity)]
    for order in ORDERS:
        plans += [completed(counts, capacity, order, around_largest) for around_largest in (True, False)]
    best = min(plans, key=lambda plan: sum(times for _, times in plan))
    for order in ORDERS:
        best, done = _searched(counts, capacity, order, best, lower, nodes // len(ORDERS))
        if done:
            break
    return best, lower


def _searched(counts: list[int], capacity: int, order: str, best: Plan, lower: int, nodes: int) -> tuple[Plan, bool]:
    """(best plan found, whether nothing better is left): branch and bound from one order of fillings."""
    counts = list(counts)
    total = sum(n * c for n, c in enumerate(counts))
    fewest = sum(times for _, times in best)
    path: list[tuple[tuple[int, ...], int, int, Iterator]] = []  # (filling, times, waste, alternatives)
    waste, tried = 0, 0

    def alternatives() -> Iterator[tuple[int, tuple[int, ...], int]]:
        top = next((n for n in range(capacity, 0, -1) if counts[n]), 0)
        counts[top] -= 1
        options = list(fillings(counts, capacity - top, order=order))
        counts[top] += 1
        for lost, used in options:
            filling = (top, *used)
            for times in _times(min(counts[n] // k for n, k in Counter(filling).items())):
                yield lost, filling, times

    options = alternatives() if total else iter(())
    while fewest > lower and tried < nodes:
        allowed = (fewest - 1) * capacity - total
        step = next(options, None)
        if step is not None:
            tried += 1
            lost, filling, times = step
            if waste + lost > allowed:
                options = iter(())  # all others waste at least as much
                continue
            if waste + lost * times > allowed:
                continue  # fewer times may do
            for n, k in Counter(filling).items():
                counts[n] -= k * times
            path.append((filling, times, lost * times, options))
            waste += lost * times
            if any(counts):
                options = alternatives()
                continue
            best, fewest = [(f, t) for f, t, _, _ in path], sum(t for _, t, _, _ in path)
        if not path:
            return best, True
        filling, times, lost, options = path.pop()
        waste -= lost
        for n, k in Counter(filling).items():
            counts[n] += k * times
    return best, fewest <= lower


def places(plan: Plan) -> np.ndarray:
    """Rows (length, first rank, sequences, first sequence, first offset) by length and rank."""
    rows, next_rank, sequence = [], Counter(), 0
    for filling, times in plan:
        offset = 0
        for size, k in Counter(filling).items():
            rows.append((size, next_rank[size], times, sequence, offset))
            next_rank[size] += k * times
            offset += k * size
        sequence += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


# ---------------------------------------------------------------- tokens and placement in Spark

def token_ids(text: str, name: str = VOCABULARY) -> np.ndarray:
    """A text's ids as the tokenizers library gives them (add_special_tokens=False), little-endian unsigned 32-bit.

    ``name`` is the library's file. tiktoken does the work with the ranks of the same vocabulary and its added tokens,
    whose strings in a text are ids of their own, in a fifth of the library's time (tests compare the two). Its pattern
    engine gives up on very long runs of white space; such texts go to the library itself.
    """
    try:
        return encoding_of(name).encode_to_numpy(text, allowed_special="all").astype("<u4")
    except ValueError:
        return np.array(hf_tokenizer(name).encode(text, add_special_tokens=False).ids, dtype="<u4")


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; of a longer one the first takes what full pieces leave."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def pieces(df: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID,
           name: str = VOCABULARY, with_ids: bool = False) -> DataFrame:
    """(key, piece, start, length, ids_crc32[, ids]): every document's tokens and ``end_id``, cut to the capacity.

    Null and empty texts are a piece with the end id alone.
    """
    ship(df.sparkSession)
    kind = df.schema[key].dataType.simpleString()
    end = np.array([end_id], dtype="<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, text):
            off, raw = text_bytes(batch.column(batch.schema.get_field_index(text)))
            row, number, start, length, crc, ids = [], [], [], [], [], []
            for i in range(batch.num_rows):
                data = np.append(token_ids(raw[off[i]:off[i + 1]].tobytes().decode(), name), end)
                for p, (s, n) in enumerate(cut(len(data), capacity)):
                    part = data[s:s + n]
                    row.append(i)
                    number.append(p)
                    start.append(s)
                    length.append(n)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(part.astype(np.int32))
            keys = batch.column(batch.schema.get_field_index(key)).take(pa.array(row, pa.int64()))
            arrays = [keys, pa.array(number, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = [key, "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names=names)
    return df.select(key, text).mapInArrow(
        run, f"`{key}` {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids array<int>" if with_ids else ""))


def pack(cut_pieces: DataFrame, key: str = "doc_id", capacity: int = CAPACITY, nodes: int = NODES) -> DataFrame:
    """``cut_pieces`` (a written table) with (sequence_id, offset) for each row; all its columns stay.

    Ranks come from counts by (length, hash part of the key), so a length that
    most pieces share is still ranked by many tasks.
    """
    ship(cut_pieces.sparkSession)
    histogram = [0] * (capacity + 1)
    for row in cut_pieces.groupBy("length").count().collect():  # at most `capacity` rows
        histogram[row["length"]] = row["count"]
    table = places(bin_completion(histogram, capacity, nodes)[0])
    starts = (table[:, 0] << 48) | table[:, 1]

    part = F.pmod(F.xxhash64(F.col(key), "piece"), F.lit(RANK_PARTS)).cast("int")
    dealt = cut_pieces.withColumn("_part", part)
    counts = dealt.groupBy("length", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("length", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("length", "_part").orderBy(key, "piece", "ids_crc32")
    ranked = (dealt.withColumn("_rank", F.row_number().over(inside) - 1)
              .join(first, ["length", "_part"])
              .withColumn("_rank", F.col("_before") + F.col("_rank"))
              .select(*cut_pieces.columns, "_rank"))
    schema = cut_pieces.schema.simpleString()[len("struct<"):-1]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            length, rank = batch["length"].to_numpy(), batch.pop("_rank").to_numpy()
            at = np.searchsorted(starts, (length << 48) | rank, side="right") - 1
            _, from_rank, times, sequence, offset = table[at].T
            copy, which = np.divmod(rank - from_rank, times)
            yield batch.assign(sequence_id=sequence + which, offset=offset + copy * length)
    return ranked.mapInPandas(run, f"{schema},sequence_id:bigint,offset:bigint")


def pack_documents(df: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
                   end_id: int = END_ID, name: str = VOCABULARY) -> DataFrame:
    """One row per piece: (key, piece, start, length, ids_crc32, sequence_id, offset).

    Null and empty texts give one piece of one id; a null key is a key like any
    other; rows that repeat are packed each; an empty table gives no rows; extra
    columns stay behind. Sequences hold no gaps and ``capacity`` ids at most.
    """
    return pack(written(pieces(df, key, text, capacity, end_id, name), "pieces"), key, capacity)


def sequences(placed: DataFrame, key: str = "doc_id") -> DataFrame:
    """(sequence_id, ids) from placed pieces that carry their ids; a sequence holds ``capacity`` ids at most."""
    return placed.groupBy("sequence_id").agg(
        F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])).alias("ids"))
