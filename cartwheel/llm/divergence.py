"""Operator 11: how far the sources of a language diverge in their words.

The terms that a language keeps (those in enough of its documents) get ordinals
in lexicographic order. The texts are then streamed, byte by byte, through a
minimal acyclic transducer of the kept terms (``transducer``), whose outputs are
the ordinals, and counted by (language, source, ordinal); ordinals also break
ties. All figures are integers.

The vocabulary grows with the corpus, so it isn't one automaton. The most frequent
terms, HEAD_TERMS at most and each of HEAD_BYTES at most, make the head, which
every task holds (a broadcast of a bounded size). What the head doesn't accept is
counted by its text, dealt by hash to buckets, and streamed there through the
transducer of the bucket's kept terms. Both ways are taken at every size.

Shares of a pair of sources are compared in units of (language, block of
ordinals, pair of source tiles): a unit is a matrix of at most 2 * TILE sources by
BLOCK terms, whatever the language or the source, and returns one sum a pair of
sources. Terms that none of a unit's sources has are counted, not listed.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm import transducer
from cartwheel.llm.common import discard, ship, small_batches, written
from cartwheel.llm.terms import LETTERS, Terms, codes, pairs

LEAST_DOCUMENTS = 3
SCALE = 1_000_000_000
TOP_TERMS = 200
#: Terms of the head and bytes of each: the head's table takes 8 MB at most in the broadcast's keys.
HEAD_TERMS, HEAD_BYTES = 131_072, 64
#: Kept terms, and counted ones, of a bucket, about.
BUCKET = 32_768
#: Terms and sources of a unit.
BLOCK, TILE = 4_096, 64
BATCH_BYTES = 4 << 20


def _document_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, term, n): documents of the batch that hold the term, by language."""
    for batch in small_batches(batches, "text", BATCH_BYTES):
        terms = Terms(batch.column("text"), LETTERS)
        code, names = codes(terms.strings())
        lang, langs = codes(batch.column("lang"))
        text, code, _ = pairs(terms.text, code, len(names))
        lang, code, n = pairs(lang[text], code, len(names))
        yield pa.RecordBatch.from_arrays([langs.take(pa.array(lang)).cast(pa.string()), names.take(pa.array(code)).cast(pa.string()),
                                          pa.array(n, pa.int64())], names=["lang", "term", "n"])


_heads: dict[str, tuple[transducer.Transducer, np.ndarray]] = {}


def _head(name: str, shared) -> tuple[transducer.Transducer, np.ndarray]:
    """The head of a broadcast, built once per worker."""
    if name not in _heads:
        _heads.clear()
        raw, ordinals = shared.value
        _heads[name] = transducer.Transducer.from_bytes(raw), np.frombuffer(ordinals, np.int64)
    return _heads[name]


def _recounted(batches: Iterator[pa.RecordBatch], name: str, shared) -> Iterator[pa.RecordBatch]:
    """(lang, source, ordinal or term, n) of the batch; and (lang, source, null, null, 0) of every group seen."""
    head, ordinals = _head(name, shared)
    for batch in small_batches(batches, "text", BATCH_BYTES):
        terms = Terms(batch.column("text"), LETTERS)
        (lang, langs), (source, sources) = codes(batch.column("lang")), codes(batch.column("source"))
        of_lang, of_source, _ = pairs(lang, source, len(sources))
        group = np.searchsorted(of_lang * len(sources) + of_source, lang * len(sources) + source)
        begun = [head.walk(value.as_py().encode() + b"\0") for value in langs]
        at = lang[terms.text]
        place = head.stream(terms.data, terms.starts, terms.ends, np.array([b[0] for b in begun], np.int64)[at],
                            np.array([b[1] for b in begun], np.int64)[at])
        mine = group[terms.text]
        known = place >= 0
        hit_group, hit, hit_n = pairs(mine[known], place[known], head.n)
        rest = np.flatnonzero(~known)
        code, names = codes(terms.strings(rest))
        rest_group, code, rest_n = pairs(mine[rest], code, len(names))
        which = pa.array(np.concatenate([np.arange(len(of_lang)), hit_group, rest_group]))
        seen, hits, others = len(of_lang), len(hit), len(code)
        lang_names, source_names = langs.take(pa.array(of_lang)).cast(pa.string()), sources.take(pa.array(of_source)).cast(pa.string())
        yield pa.RecordBatch.from_arrays([
            lang_names.take(which), source_names.take(which),
            pa.concat_arrays([pa.nulls(seen, pa.int64()), pa.array(ordinals[hit], pa.int64()), pa.nulls(others, pa.int64())]),
            pa.concat_arrays([pa.nulls(seen + hits, pa.string()), names.take(pa.array(code)).cast(pa.string())]),
            pa.array(np.concatenate([np.zeros(seen, np.int64), hit_n, rest_n]), pa.int64())],
            names=["lang", "source", "ordinal", "term", "n"])


def _keyed(lang: pa.ChunkedArray, term: pa.ChunkedArray) -> list[bytes]:
    return [a.encode() + b"\0" + b.encode() for a, b in zip(lang.to_pylist(), term.to_pylist())]


def _bucket(kept: pa.Table, counted: pa.Table) -> pa.Table:
    """Counts of the bucket's kept terms by ordinal: the counted terms streamed through the kept ones' transducer."""
    keys = _keyed(kept["lang"], kept["term"])
    order = sorted(range(len(keys)), key=keys.__getitem__)
    machine = transducer.build(keys[i] for i in order)
    ordinals = kept["ordinal"].to_numpy()[order] if order else np.zeros(0, np.int64)
    streamed = _keyed(counted["lang"], counted["term"])
    ends = np.cumsum([len(s) for s in streamed], dtype=np.int64) if streamed else np.zeros(0, np.int64)
    starts = np.r_[0, ends[:-1]] if streamed else ends
    place = machine.stream(np.frombuffer(b"".join(streamed), np.uint8), starts, ends)
    known = np.flatnonzero(place >= 0)
    rows = counted.take(pa.array(known))
    return pa.table({"lang": rows["lang"], "source": rows["source"], "ordinal": pa.array(ordinals[place[known]], pa.int64()), "n": rows["n"]})


def shares(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / q), exactly."""
    apart = p - q
    return apart * apart // q


def _pair_sums(unit: pa.Table) -> pa.Table:
    """Sum over a unit's terms for every ordered pair of different sources (of different tiles in a unit of two tiles)."""
    source, ordinal, p = (unit[c].to_numpy() for c in ("number", "ordinal", "p"))
    marks = np.flatnonzero(ordinal < 0)
    marks = marks[np.argsort(source[marks])]
    sources, plain = source[marks], p[marks]
    width = int(unit["width"].to_numpy()[marks[0]])
    cells = np.flatnonzero(ordinal >= 0)
    found, column = np.unique(ordinal[cells], return_inverse=True)
    matrix = np.repeat(plain[:, None], len(found), axis=1)
    matrix[np.searchsorted(sources, source[cells]), column] = p[cells]
    lower, upper = int(unit["low"][0].as_py()), int(unit["high"][0].as_py())
    tile = (sources - 1) // TILE
    a_out, b_out, sums = [], [], []
    for i in range(len(sources)):
        others = np.flatnonzero((tile != tile[i]) if lower != upper else (np.arange(len(sources)) != i))
        if len(others):
            total = shares(matrix[i][None], matrix[others]).sum(1) + (width - len(found)) * shares(plain[i], plain[others])
            a_out.append(np.full(len(others), sources[i]))
            b_out.append(sources[others])
            sums.append(total)
    join = (lambda x: np.concatenate(x) if x else np.zeros(0, np.int64))
    a = join(a_out)
    return pa.table({"lang": pa.array([unit["lang"][0].as_py()] * len(a), pa.string()), "number": pa.array(a, pa.int32()),
                     "other": pa.array(join(b_out), pa.int32()), "value": pa.array(join(sums), pa.int64())})


def _share(n: Column, total: Column, kept: Column, scale: int) -> Column:
    """1 + floor(scale * (n + 1) / (total + kept)); decimals, as the product may exceed a long."""
    whole = F.lit(scale).cast("decimal(10,0)") * (n + 1).cast("decimal(19,0)")
    return F.call_function("div", whole, (total + kept).cast("decimal(20,0)")) + 1


def _squared(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def vocabulary(docs: DataFrame, least: int) -> DataFrame:
    """(lang, term, documents, ordinal) of the kept terms; ordinals follow (lang, term) in UTF-8 order, gapless from 0."""
    held = docs.select("lang", "text").mapInArrow(_document_terms, "lang string, term string, n long")
    kept = written(held.groupBy("lang", "term").agg(F.sum("n").alias("documents")).where(F.col("documents") >= least), "kept")
    ordered = written(kept.repartitionByRange("lang", "term").sortWithinPartitions("lang", "term")
                      .withColumn("row", F.monotonically_increasing_id()), "ordered")
    discard(kept)
    # the id is the partition's number and the row's place in it
    part = F.shiftright("row", 33)
    counts = ordered.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    bases = counts.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("base"))
    return ordered.join(bases, part == bases["part"]).select(
        "lang", "term", "documents", (F.col("base") + F.col("row").bitwiseAND((1 << 33) - 1)).alias("ordinal"))


def _split(terms: DataFrame, most: int, longest: int) -> Column:
    """Whether a kept term is of the head: a bound on its documents such that at most ``most`` terms are."""
    short = (F.octet_length("term") <= longest) & (F.octet_length("lang") <= longest)
    level = F.floor(F.log2("documents") * 8).cast("int")
    room, bound = most, None
    levels = terms.where(short).groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n")).collect()  # under 512 rows
    for row in sorted(levels, key=lambda r: -r["level"]):
        room -= row["n"]
        if room < 0:
            break
        bound = row["level"]
    return F.lit(False) if bound is None else short & (level >= bound)


def recount(docs: DataFrame, terms: DataFrame, head_terms: int = HEAD_TERMS, bucket: int = BUCKET) -> tuple[DataFrame, DataFrame]:
    """((lang, source, ordinal, n) with n > 0, (lang, source) that occur): texts streamed through the kept terms."""
    spark = docs.sparkSession
    in_head = _split(terms, head_terms, HEAD_BYTES)
    head = sorted((r["lang"].encode() + b"\0" + r["term"].encode(), r["ordinal"]) for r in terms.where(in_head).select("lang", "term", "ordinal").collect())
    machine = transducer.build(key for key, _ in head)
    name = uuid.uuid4().hex
    shared = spark.sparkContext.broadcast((machine.to_bytes(), np.array([o for _, o in head], np.int64).tobytes()))
    streamed = docs.select("lang", "source", "text").mapInArrow(
        lambda batches: _recounted(batches, name, shared), "lang string, source string, ordinal long, term string, n long")
    counted = written(streamed.groupBy("lang", "source", "ordinal", "term").agg(F.sum("n").alias("n")), "counted")
    others = counted.where("term is not null").select("lang", "source", "term", "n")
    tail = terms.where(~in_head).select("lang", "term", "ordinal")
    buckets = max(1, math.ceil(max(others.count(), tail.count()) / bucket))
    dealt = F.pmod(F.xxhash64("lang", "term"), F.lit(buckets)).alias("bucket")
    found = (tail.withColumn("bucket", dealt).groupBy("bucket").cogroup(others.withColumn("bucket", dealt).groupBy("bucket"))
             .applyInArrow(_bucket, "lang string, source string, ordinal long, n long"))
    counts = written(counted.where("ordinal is not null").select("lang", "source", "ordinal", "n").unionByName(found), "counts")
    groups = counted.where("ordinal is null and term is null").select("lang", "source")
    return counts, groups


def pair_values(shared: DataFrame, groups: DataFrame, terms: DataFrame, scale: int) -> DataFrame:
    """(lang, number, other, value): the sum over all kept terms of a language for every ordered pair of its sources."""
    block = F.floor(F.col("ordinal") / BLOCK).alias("block")
    widths = terms.groupBy("lang", block).agg(F.count(F.lit(1)).alias("width"))
    marks = widths.join(groups, "lang").select(
        "lang", "block", "number", "tiles", F.lit(-1).cast("long").alias("ordinal"), _share(F.lit(0), F.col("total"), F.col("kept"), scale).alias("p"), "width")
    cells = shared.select("lang", block, "number", "tiles", "ordinal", "p", F.lit(0).cast("long").alias("width"))
    tile = F.floor((F.col("number") - 1) / TILE).cast("int")
    placed = cells.unionByName(marks).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    units = placed.select("lang", "block", F.least(tile, "with").alias("low"), F.greatest(tile, "with").alias("high"), "number", "ordinal", "p", "width")
    sums = units.groupBy("lang", "block", "low", "high").applyInArrow(_pair_sums, "lang string, number int, other int, value long")
    return sums.groupBy("lang", "number", "other").agg(F.sum("value").alias("value"))


def audit(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = LEAST_DOCUMENTS, top: int = TOP_TERMS,
          scale: int = SCALE, head_terms: int = HEAD_TERMS, bucket: int = BUCKET) -> DataFrame:
    """Divergence of the sources of every language; returns (lang, source, part, item, value, rank).

    A language keeps the V terms that at least ``least`` of its rows hold. A (lang, source) group, and a language, has
    for every kept term the share p = 1 + floor(scale * (count + 1) / (N + V)), N its count of kept terms. With
    f = floor((p - q)^2 / q), p the group's share: part ``pair`` has a row for every other source of the language, f
    summed over all kept terms with that source's shares as q; part ``term`` the first ``top`` kept terms that the group
    holds with p > q, q the language's share, and their f. Ranks go by falling value, then the item's UTF-8 order (for
    terms, the ordinals').

    Null text, lang and source count as empty strings; every row is a document, so repeated rows count each. Groups
    without terms have pair rows as well (0 if the language keeps no term); a language of one source has none. Very long
    texts and terms are counted whole. An empty table returns no rows. Other columns are left behind, whatever their names.
    Sums stay within a long while a language keeps fewer than two milliards of terms.
    """
    ship(df.sparkSession)
    docs = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for c, name in ((text, "text"), (lang, "lang"), (source, "source"))])
    terms = written(vocabulary(docs, least), "terms")
    counts, seen = recount(docs, terms, head_terms, bucket)

    by_lang = Window.partitionBy("lang")
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    kept = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"))
    groups = written(
        seen.join(totals, ["lang", "source"], "left").join(kept, "lang", "left")
        .select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("kept", F.lit(0)).alias("kept"),
                F.row_number().over(by_lang.orderBy("source")).alias("number"),
                F.ceil(F.count(F.lit(1)).over(by_lang) / TILE).cast("int").alias("tiles")), "groups")

    shared = written(counts.join(groups, ["lang", "source"]).select(
        "lang", "source", "number", "tiles", "ordinal", "n", _share(F.col("n"), F.col("total"), F.col("kept"), scale).alias("p")), "shares")

    values = pair_values(shared, groups, terms, scale)
    mine = groups.select("lang", "source", "number")
    others = groups.select("lang", F.col("source").alias("item"), F.col("number").alias("other"))
    of_pairs = (mine.join(others, "lang").where("number <> other").join(values, ["lang", "number", "other"], "left")
             .select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).cast("long").alias("value")))
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    of_pairs = of_pairs.withColumn("rank", F.row_number().over(ranked).cast("int"))

    whole = groups.groupBy("lang").agg(F.sum("total").alias("total"), F.max("kept").alias("kept"))
    in_lang = (shared.groupBy("lang", "ordinal").agg(F.sum("n").alias("n")).join(whole, "lang")
               .select("ordinal", _share(F.col("n"), F.col("total"), F.col("kept"), scale).alias("q")))
    over = shared.join(in_lang, "ordinal").where("p > q").select("lang", "source", "ordinal", _squared(F.col("p"), F.col("q")).alias("value"))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal")
    first = over.withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= top)
    named = first.join(terms.select("ordinal", "term"), "ordinal").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.col("value").cast("long").alias("value"), "rank")
    return of_pairs.unionByName(named)
