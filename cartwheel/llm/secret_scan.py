"""Operator 9: secrets by pattern and by token efficiency.

Named patterns (assignments, access keys, long hex) are the base. Beyond them a
random string gives itself away by its token efficiency: a public byte-level
vocabulary packs prose and names into long tokens, but needs a token for every
one or two characters of a key. Known digests and UUIDs are excluded before the
test, as are names and paths whose words pack into long tokens themselves; base
spans are reported anyway.

A batch's bytes are searched first as a whole (table look-ups and substring
search), and only texts with a possible hit are decoded and matched.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import ship, small_batches, text_bytes
from cartwheel.llm.tokenizers import tiktoken_encoding

# Fixed values of the contract: the base patterns and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_LEAST = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LEAST = 20
HEX = re.compile(r"[0-9a-f]+")
HEX_LEAST = 24
KINDS = ("assign", "access", "hex", "token")

_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_RUN = re.compile(r"[A-Za-z0-9_+/=-]+")
_DIGEST_LENGTHS = {32, 40, 56, 64, 96, 128}
_UUID = re.compile(r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
_SEPARATORS = re.compile(r"[-_/+=]+")
_PART = re.compile(r"[A-Z]?[a-z]*|[A-Z]*|[0-9]{1,12}")
_REPEATED = re.compile(r"(.{1,16}?)\1{2,}")

#: A candidate has this many characters at least; one of plain words and numbers (as _PART) needs more, since prose has such words.
LEAST_CHARS, LEAST_PLAIN = 16, 20
#: Characters a token below which a candidate counts as random.
MOST_RATIO = 2.0
VOCABULARY = "byte_bpe_50k.tiktoken"

_SCHEMA = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(chars)] = True
    return out


_DIGITS, _LOWER, _UPPER = b"0123456789", b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_IS_RUN = _table(_DIGITS + _LOWER + _UPPER + b"_+/=-")
_IS_HEX = _table(_DIGITS + b"abcdef")
_IS_DIGIT, _IS_LOWER, _IS_UPPER = _table(_DIGITS), _table(_LOWER), _table(_UPPER)
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def _runs(data: np.ndarray, member: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of at least ``least`` member bytes."""
    inside = np.empty(len(data) + 2, dtype=np.int8)
    inside[0] = inside[-1] = 0
    inside[1:-1] = member[data]
    edge = np.diff(inside)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long = end - start >= least
    return start[long], end[long]


def _mixed(digits: int, lower: int, upper: int) -> bool:
    """Random strings mix digits with letters, or many letters of both cases."""
    return (digits > 0 and lower + upper > 0) or (lower >= 4 and upper >= 4)


def _suspects(off: np.ndarray, raw: np.ndarray) -> set[int]:
    """Rows of a batch that may hold a span of any kind (never misses one)."""
    data = raw[off[0]:off[-1]]
    base = off - off[0]
    at: list[int] = []
    at += _runs(data, _IS_HEX, HEX_LEAST)[0].tolist()
    for s, e in zip(*_runs(data, _IS_RUN, LEAST_CHARS)):
        part = data[s:e]
        digits, lower, upper = _IS_DIGIT[part].sum(), _IS_LOWER[part].sum(), _IS_UPPER[part].sum()
        if _mixed(digits, lower, upper) or (lower + upper and e - s >= LEAST_PLAIN):
            # A run can join two texts of the buffer; both are looked at then.
            first, last = int(np.searchsorted(base, s, "right")) - 1, int(np.searchsorted(base, e - 1, "right")) - 1
            at += [int(max(base[k], s)) for k in range(first, last + 1)]
    whole = data.tobytes()
    folded = whole.translate(_FOLD)
    for text, words in ((whole, (b"AKIA",)), (folded, _WORDS)):
        for word in words:
            i = text.find(word)
            while i >= 0:
                at.append(i)
                row_end = int(base[int(np.searchsorted(base, i, "right"))])
                i = text.find(word, max(row_end, i + 1))  # the row is known now
    if not at:
        return set()
    return set((np.searchsorted(base, np.array(at), "right") - 1).tolist())


def _random(run: str, vocabulary: str, most_ratio: float) -> bool:
    """Whether a run is no known digest, UUID or number, and packs into short tokens only.

    In a run of separated words and numbers the separators and numbers cost
    tokens, too; there the words by themselves must pack into short tokens as well.
    What is repeated three times or more (fillers, rulers) counts once.
    """
    if _UUID.fullmatch(run) or len(run) in _DIGEST_LENGTHS and re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", run):
        return False
    run = _REPEATED.sub(r"\1", run)
    digits, lower, upper = (sum(map(f, run)) for f in (str.isdigit, str.islower, str.isupper))
    parts = [p for p in _SEPARATORS.split(run) if p]
    plain = all(_PART.fullmatch(p) for p in parts)
    if not lower + upper or len(run) < (LEAST_PLAIN if plain or not _mixed(digits, lower, upper) else LEAST_CHARS):
        return False

    def short(words: list[str]) -> bool:
        encode = tiktoken_encoding(vocabulary).encode_ordinary
        return sum(map(len, words)) < most_ratio * sum(len(encode(w)) for w in words)
    return short([run]) and not (plain and len(parts) > 1 and not short([p for p in parts if not p.isdigit()]))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The contract's base spans of one text, by start, then kind."""
    out = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    out += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    out += [("hex", *m.span()) for m in HEX.finditer(text) if len(m[0]) >= HEX_LEAST]
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def spans(text: str, vocabulary: str = VOCABULARY, most_ratio: float = MOST_RATIO) -> list[tuple[str, int, int]]:
    """Base spans plus ``token`` spans: random runs, and what base spans leave of a run, if it is random."""
    found = base_spans(text)
    covered: list[tuple[int, int]] = []  # by base spans, without overlaps
    for _, s, e in found:
        if covered and s <= covered[-1][1]:
            covered[-1] = covered[-1][0], max(covered[-1][1], e)
        else:
            covered.append((s, e))
    extra, at = [], 0
    for m in _RUN.finditer(text):
        s, e = m.span()
        if e - s < LEAST_CHARS:
            continue
        while at < len(covered) and covered[at][1] <= s:
            at += 1
        pieces = []
        while at < len(covered) and covered[at][0] < e:
            pieces.append((s, covered[at][0]))
            s = covered[at][1]
            if s >= e:
                break  # it may reach into the next run
            at += 1
        for s, e in (*pieces, (s, e)):
            run = text[s:e].strip("-_/+=")
            if len(run) >= LEAST_CHARS and _random(run, vocabulary, most_ratio):
                s = text.index(run, s)
                extra.append(("token", s, s + len(run)))
    return sorted(found + extra, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def _scan(key: str, text: str, vocabulary: str, most_ratio: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, text):
            column = batch.column(batch.schema.get_field_index(text))
            off, raw = text_bytes(column)
            hit = _suspects(off, raw)
            found = [[{"kind": k, "start": s, "end": e} for k, s, e in spans(raw[off[i]:off[i + 1]].tobytes().decode(), vocabulary, most_ratio)]
                     if i in hit else [] for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(key)), pa.array(found, _SCHEMA)], names=[key, "found"])
    return run


def scan(df: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY,
         most_ratio: float = MOST_RATIO) -> DataFrame:
    """(key, found) for every row; found lists {kind, start, end} in code points, end exclusive.

    Null and empty texts have no spans. Repeated rows are scanned each by
    itself, extra columns stay behind, an empty table gives no rows. A text of
    any length is matched whole.
    """
    ship(df.sparkSession)
    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInArrow(
        _scan(key, text, vocabulary, most_ratio),
        f"`{key}` {kind}, found array<struct<kind:string,start:bigint,end:bigint>>")


def joined(found: Column) -> Column:
    """kind:start:end, comma-joined in order."""
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def digest(scanned: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts, base digest and all spans of each scanned row."""
    count = lambda kind: F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long")
    base = F.filter("found", lambda x: x["kind"] != "token")
    return scanned.select(
        key, count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"))


def _cut(text: str, found: list[tuple[str, int, int]], mark: str) -> str:
    """The text with every span replaced; overlapping spans become one mark."""
    out, at = [], 0
    for _, s, e in sorted(found, key=lambda x: (x[1], -x[2])):
        if s >= at:
            out += [text[at:s], mark]
            at = e
        else:
            at = max(at, e)
    return "".join([*out, text[at:]])


def redact(df: DataFrame, text: str = "text", n_chars: str | None = "n_chars", mark: str = "[REDACTED]",
           vocabulary: str = VOCABULARY, most_ratio: float = MOST_RATIO) -> DataFrame:
    """``df`` with every span in ``text`` replaced by ``mark``; all other texts are untouched.

    All columns and rows stay; ``n_chars``, where the table has it, follows the
    new text of a changed row.
    """
    ship(df.sparkSession)
    at = df.columns.index(text)
    size_at = df.columns.index(n_chars) if n_chars and n_chars in df.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, text):
            off, raw = text_bytes(batch.column(at))
            new = {}
            for i in _suspects(off, raw):
                old = raw[off[i]:off[i + 1]].tobytes().decode()
                found = spans(old, vocabulary, most_ratio)
                if found:
                    new[i] = _cut(old, found, mark)
            if new:
                arrays = list(batch.columns)
                values = arrays[at].to_pylist()
                sizes = arrays[size_at].to_pylist() if size_at is not None else None
                for i, value in new.items():
                    values[i] = value
                    if sizes is not None:
                        sizes[i] = len(value)
                arrays[at] = pa.array(values, arrays[at].type)
                if sizes is not None:
                    arrays[size_at] = pa.array(sizes, arrays[size_at].type)
                batch = pa.RecordBatch.from_arrays(arrays, schema=batch.schema)
            yield batch
    return df.mapInArrow(run, df.schema)
