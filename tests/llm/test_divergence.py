import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cartwheel.llm import divergence as D
from cartwheel.llm import transducer as T
from cartwheel.llm.queries import QUERIES
from tests.llm.helpers import LONG, SF, odd_texts, rows

SCHEMA = "doc_id long, text string, lang string, source string"
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(table, least=3, top=200, scale=10 ** 9):
    """Straight from the definition, over every kept term of every group."""
    held, counts, out = {}, {}, []
    for text, lang, source in table:
        words = TERM.findall((text or "").translate(LOWER))
        held.setdefault(lang or "", Counter()).update(set(words))
        counts.setdefault(lang or "", {}).setdefault(source or "", Counter()).update(words)
    for lang, by_source in counts.items():
        kept = [t for t, n in held[lang].items() if n >= least]

        def shares(counted):
            total = sum(counted[t] for t in kept)
            return {t: 1 + scale * (counted[t] + 1) // (total + len(kept)) for t in kept}
        p = {s: shares(c) for s, c in by_source.items()}
        q = shares(sum(by_source.values(), Counter()))
        for s in by_source:
            pairs = [(-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in by_source if o != s]
            terms = [(-((p[s][t] - q[t]) ** 2 // q[t]), t) for t in kept if by_source[s][t] > 0 and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                ordered = sorted(found, key=lambda x: (x[0], x[1].encode()))[:most]
                out += [(lang, s, part, item, -v, i + 1) for i, (v, item) in enumerate(ordered)]
    return sorted(out, key=repr)


def audit(df, **settings):
    return rows(D.audit(df, **settings))


def corpus(seed, n=120, langs=3, sources=4, pool=40):
    rng = random.Random(seed)
    alphabet = ["a", "B", "é", "ß", "中", "🙂", "z", "Á", "\u0080"]
    words = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 4))) for _ in range(pool)]
    return [("".join(rng.choice(words) + rng.choice([" ", "-", "1", "\n", "_"]) for _ in range(rng.randint(0, 30))),
             f"l{rng.randrange(langs)}", f"s{rng.randrange(sources) ** 2}") for _ in range(n)]


def table(spark, data):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(data)], SCHEMA)


@settings(max_examples=150, deadline=None)
@given(st.sets(st.binary(max_size=6), max_size=40), st.lists(st.binary(max_size=7), max_size=30))
def test_transducer_gives_places_in_the_sorted_list(keys, asked):
    ordered = sorted(keys)
    machine = T.Transducer.from_bytes(T.build(ordered).to_bytes())
    asked = asked + ordered
    data = np.frombuffer(b"".join(asked) or b"\0", np.uint8)
    ends = np.cumsum([len(a) for a in asked], dtype=np.int64)
    starts = ends - np.array([len(a) for a in asked], np.int64)
    place = {k: i for i, k in enumerate(ordered)}
    assert machine.n == len(ordered)
    assert machine.stream(data, starts, ends).tolist() == [place.get(a, -1) for a in asked]
    begun = [machine.walk(a[:2]) for a in asked]
    rest = machine.stream(data, starts + np.minimum(2, ends - starts), ends, np.array([b[0] for b in begun]), np.array([b[1] for b in begun]))
    assert rest.tolist() == [place.get(a, -1) for a in asked]


def test_transducer_is_minimal():
    keys = sorted({"".join(w).encode() for n in range(6) for w in itertools.product("ab", repeat=n)})
    assert len(T.build(keys).final) == 6  # one state a length
    months = sorted(x.encode() for x in ("jan", "feb", "mar", "apr", "may", "jun", "jul"))
    rights = {frozenset(k[len(p):] for k in months if k.startswith(p)) for k in months for p in (k[:i] for i in range(len(k) + 1))}
    assert len(T.build(months).final) == len(rights)
    for wrong in ([b"b", b"a"], [b"a", b"a"]):
        with pytest.raises(ValueError):
            T.build(wrong)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    data = corpus(seed)
    assert audit(table(spark, data)) == brute(data)


def test_head_tail_blocks_and_tiles(spark, monkeypatch):
    data = corpus(3, n=200, sources=9)
    expected = brute(data, least=2, top=5)
    df = table(spark, data).repartition(3)
    assert audit(df, least=2, top=5, head_terms=7, bucket=5) == expected      # a small head, many buckets
    assert audit(df, least=2, top=5, head_terms=0) == expected                # no head at all
    monkeypatch.setattr(D, "BLOCK", 4)
    kept = D.written(D.vocabulary(df, 2), "t")
    assert [r["ordinal"] for r in kept.orderBy("lang", "term").collect()] == list(range(kept.count()))
    assert audit(df, least=2, top=5) == expected


def test_pair_sums_of_tiles(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(D, "TILE", 2)
    plain = {1: 10, 2: 20, 3: 30, 4: 40}
    cells = [(1, 5, 100), (2, 5, 7), (3, 6, 90), (4, 8, 11)]
    marks = [(s, -1, p) for s, p in plain.items()]
    width = 6

    def unit(low, high, of):
        r = [x for x in cells + marks if x[0] in of]
        return pa.table({"lang": ["l"] * len(r), "number": pa.array([x[0] for x in r], pa.int32()), "ordinal": pa.array([x[1] for x in r], pa.int64()),
                         "p": pa.array([x[2] for x in r], pa.int64()), "width": [width] * len(r), "low": [low] * len(r), "high": [high] * len(r)})
    found = {}
    for low, high, of in ((0, 0, (1, 2)), (0, 1, (1, 2, 3, 4)), (1, 1, (3, 4))):
        for r in D._pair_sums(unit(low, high, of)).to_pylist():
            assert (r["number"], r["other"]) not in found
            found[r["number"], r["other"]] = r["value"]
    share = {s: [dict((o, p) for t, o, p in cells if t == s).get(o, plain[s]) for o in range(5, 11)] for s in plain}
    assert found == {(a, b): sum((x - y) ** 2 // y for x, y in zip(share[a], share[b])) for a in plain for b in plain if a != b}


def test_odd_rows(spark):
    data = [(t, None if i % 3 == 0 else "", None if i % 2 else "s") for i, (_, t) in enumerate(odd_texts())]
    data += [("Word word\x00wordé", "l\x00m", "a")] * 4 + [("word wordé", "l", "a"), ("", "l", "b"), (None, "x", "only"), ("q " * 5, "l\x00", "b")]
    data += [("z" * 300_000, "long", s) for s in ("a", "b", "b")] + [(LONG, "long", "c")]
    df = table(spark, data)
    assert audit(df) == brute(data)
    clash = df
    for name in ("term", "n", "ordinal", "number", "part", "item", "value", "rank", "total", "kept", "tiles", "bucket"):
        clash = clash.withColumn(name, F.lit("clash"))
    assert audit(clash) == brute(data)
    assert audit(spark.createDataFrame([], SCHEMA)) == []
    assert audit(table(spark, [(None, None, None), ("a", None, "s")])) == brute([(None, None, None), ("a", None, "s")])


def test_large_counts_are_exact():
    big = 3 * 10 ** 9
    assert D.shares(np.array([10 ** 9]), np.array([1])).tolist() == [(10 ** 9 - 1) ** 2]
    assert (1 + 10 ** 9 * (big + 1) // (4 * big)) == 250_000_001


def test_share_beyond_a_long(spark):
    n, total, kept = 9 * 10 ** 12, 10 ** 13, 12_345
    df = spark.createDataFrame([(n, total, kept)], "n long, total long, kept long")
    assert df.select(D._share(F.col("n"), F.col("total"), F.col("kept"), D.SCALE)).first()[0] == 1 + 10 ** 9 * (n + 1) // (total + kept)


def test_registered_query(spark):
    data = [(r["text"], r["lang"], r["source"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert rows(QUERIES["op11_source_divergence"](spark, SF)) == brute(data)
