"""Operator 2: byte-level BPE by prefix dynamic programming.

For every byte prefix of a piece exactly one vocabulary token can be the last
token of the prefix's encoding: a token that ends there, whose predecessor is
the last token of the shorter prefix, and which that predecessor doesn't merge
into. Storing this token for each prefix gives the encoding of every prefix at
once, so bytes can be appended without touching what is there, and after an
edit only the prefixes from the edit up to where the old and new last tokens
agree again are worked out anew.

Text is cut into pieces by the vocabulary's pattern first. A space before a
visible character always starts a piece, so the words between such spaces
encode independently and a worker remembers their ids.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from cartwheel.llm.common import ship, small_batches, text_bytes
from cartwheel.llm.tokenizers import ranks

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Words and pieces that a worker remembers, twice this many of each at most. Bounds memory, changes no result.
REMEMBERED = 300_000
#: The pattern's white space is Unicode's, which this engine names by property.
_PIECES = regex.compile(public_tokenizers.PATTERN.replace(r"\s", r"\p{White_Space}"))
_WORD_START = re.compile(r" (?=\S)")
_ODD_SPACE = re.compile(r" \s")


_NONE = 1 << 60  # after every rank
_MOST_PAIRS = 1_000_000


class Vocabulary:
    """Ranks with the checks that the prefix table needs."""

    def __init__(self, by_bytes: dict[bytes, int]):
        self.ranks = by_bytes
        self.bytes = {rank: token for token, rank in by_bytes.items()}
        self.longest = max(map(len, by_bytes))
        self._pairs: dict[tuple[int, int], bool] = {}
        self._spines: dict[int, tuple[list[tuple[bytes, int]], list[tuple[bytes, int]]] | None] = {}

    def _merge(self, data: bytes) -> tuple[list[bytes], tuple[bytes, bytes] | None]:
        """Plain rank-ordered merging, leftmost first: the parts, and what the last merge joined."""
        parts, split = [data[i:i + 1] for i in range(len(data))], None
        while len(parts) > 1:
            rank, i = min((self.ranks.get(parts[i] + parts[i + 1], _NONE), i) for i in range(len(parts) - 1))
            if rank == _NONE:
                break
            split = parts[i], parts[i + 1]
            parts[i:i + 2] = [split[0] + split[1]]
        return parts, split

    def merged(self, data: bytes) -> list[int]:
        """Ids by plain merging, the definition that the prefix table must agree with."""
        return [self.ranks[p] for p in self._merge(data)[0]]

    def spines(self, token: int) -> tuple[list[tuple[bytes, int]], list[tuple[bytes, int]]] | None:
        """The token's left and right spine from a byte up to the token, as (bytes, rank).

        These are the parts at its left and right end while its bytes merge. None
        if merging its bytes doesn't give the token.
        """
        if token not in self._spines:
            data = self.bytes[token]
            parts, split = self._merge(data)
            out = None
            if len(parts) == 1:
                own = (data, token)
                out = ([own], [own])
                if split:
                    left, right = self.spines(self.ranks[split[0]]), self.spines(self.ranks[split[1]])
                    out = (left[0] + [own], right[1] + [own]) if left and right else None
            self._spines[token] = out
        return self._spines[token]

    def stands(self, token: int) -> bool:
        """Whether merging the token's own bytes gives the token."""
        return self.spines(token) is not None

    def follows(self, left: int, right: int) -> bool:
        """Whether merging both tokens' bytes leaves just this pair.

        Merges run in rank order, so only the parts that meet at the border matter:
        the left token's right spine against the right token's left spine. The pair
        stands if at no time the two parts there would join before either of them
        grows on its own side (of equal ranks the one further left goes first).
        """
        known = self._pairs.get((left, right))
        if known is None:
            known = self._stay_apart(left, right)
            if len(self._pairs) >= _MOST_PAIRS:
                self._pairs.clear()
            self._pairs[left, right] = known
        return known

    def _stay_apart(self, left: int, right: int) -> bool:
        one, two = self.spines(left), self.spines(right)
        if one is None or two is None:
            return False
        ends, starts, i, j, get = one[1], two[0], 0, 0, self.ranks.get
        while True:
            joined = get(ends[i][0] + starts[j][0], _NONE)
            grow_left = ends[i + 1][1] if i + 1 < len(ends) else _NONE
            grow_right = starts[j + 1][1] if j + 1 < len(starts) else _NONE
            if joined < grow_left and joined <= grow_right and joined != _NONE:
                return False
            if grow_left == grow_right == _NONE:
                return True
            if grow_left <= grow_right:
                i += 1
            else:
                j += 1

    def extend(self, data: bytes, last: list[int]) -> None:
        """Add to ``last`` the one valid last token of every prefix of ``data`` that it lacks."""
        get, pairs, follows, longest = self.ranks.get, self._pairs, self.follows, self.longest
        for end in range(len(last) + 1, len(data) + 1):
            # Only one token is valid, so the order doesn't matter; most are short.
            for start in range(end - 1, max(end - longest, 0) - 1, -1):
                token = get(data[start:end])
                if token is None:
                    continue
                if start:
                    before = last[start - 1]
                    stands = pairs.get((before, token))
                    if stands is None:
                        stands = follows(before, token)
                    if stands:
                        last.append(token)
                        break
                elif self.stands(token):
                    last.append(token)
                    break
            else:
                raise ValueError("the vocabulary lacks a single byte")


@lru_cache(maxsize=4)
def vocabulary(name: str) -> Vocabulary:
    return Vocabulary(ranks(name))


class PrefixTable:
    """The last token of every prefix of a byte string, kept right through appends and edits."""

    def __init__(self, vocab: Vocabulary, data: bytes = b""):
        self.vocab, self.data, self.last = vocab, data, []
        vocab.extend(data, self.last)

    def append(self, data: bytes) -> None:
        """Add bytes at the end; the entries that are there stay."""
        self.data += data
        self.vocab.extend(self.data, self.last)

    def replace(self, start: int, end: int, data: bytes) -> int:
        """Replace ``data[start:end]``; returns how many prefixes were worked out anew.

        Behind the edit a last token depends on the last tokens up to the longest
        token's length before it. Once that many in a row agree with the old ones,
        all later ones do, too.
        """
        old, longest = self.last, self.vocab.longest
        shift = len(data) - (end - start)
        self.data = self.data[:start] + data + self.data[end:]
        self.last = old[:start]
        agreed, settled = 0, start + len(data) + longest
        for at in range(start, len(self.data)):
            self.vocab.extend(self.data[:at + 1], self.last)
            agreed = agreed + 1 if at >= settled and old[at - shift] == self.last[at] else 0
            if agreed == longest:
                self.last += old[at - shift + 1:]
                return at + 1 - start
        return len(self.data) - start

    def tokens(self, end: int | None = None) -> list[int]:
        """The encoding of the first ``end`` bytes (all by default)."""
        at, out = len(self.data) if end is None else end, []
        while at:
            out.append(self.last[at - 1])
            at -= len(self.vocab.bytes[out[-1]])
        return out[::-1]


def encode_piece(vocab: Vocabulary, piece: bytes) -> list[int]:
    """Ids of one piece; a piece that is itself a token is that token."""
    whole = vocab.ranks.get(piece)
    if whole is not None:
        return [whole]
    last: list[int] = []
    vocab.extend(piece, last)
    at, out = len(piece), []
    while at:
        out.append(last[at - 1])
        at -= len(vocab.bytes[out[-1]])
    return out[::-1]


class _Remembered(dict):
    """Results by key in two generations: when the younger one is full, the older one is forgotten.

    What is used again moves back to the younger one, so frequent keys stay.
    """

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class _Encoder:
    """Ids of words with the space before them, by way of their pieces."""

    def __init__(self, name: str):
        self.vocab = vocabulary(name)
        self.pieces = _Remembered(lambda piece: tuple(encode_piece(self.vocab, piece.encode())), REMEMBERED)
        self.words = _Remembered(self.word, REMEMBERED)

    def word(self, word: str) -> tuple[int, ...]:
        """Ids of a word and the space before it. Letters alone, or before a full stop or comma, need no pattern."""
        if word.isalpha():
            return self.pieces[" " + word]
        if word[-1:] in (".", ",") and word[:-1].isalpha():
            return self.pieces[" " + word[:-1]] + self.pieces[word[-1]]
        return self.encode(" " + word)

    def encode(self, part: str) -> tuple[int, ...]:
        found = _PIECES.findall(part)
        if len(found) == 1:
            return self.pieces[part]
        return tuple(chain.from_iterable(map(self.pieces.__getitem__, found)))


@lru_cache(maxsize=4)
def _encoder(name: str) -> _Encoder:
    return _Encoder(name)


def words_of(text: str) -> list[str]:
    """The text cut before every space that a visible character follows, without those spaces."""
    return _WORD_START.split(text) if _ODD_SPACE.search(text) else text.split(" ")


def encode(text: str, name: str = VOCABULARY) -> list[int]:
    """Ids of a text, equal to tiktoken's ordinary encoding by the same ranks."""
    known = _encoder(name)
    first, *rest = words_of(text)
    return [*known.encode(first), *chain.from_iterable(map(known.words.__getitem__, rest))]


def decode(ids: Iterable[int], name: str = VOCABULARY) -> bytes:
    return b"".join(map(vocabulary(name).bytes.__getitem__, ids))


def _texts(batch: pa.RecordBatch, text: str) -> Iterator[str]:
    off, raw = text_bytes(batch.column(batch.schema.get_field_index(text)))
    for i in range(batch.num_rows):
        yield raw[off[i]:off[i + 1]].tobytes().decode()


def encode_rows(df: DataFrame, key: str = "doc_id", text: str = "text", name: str = VOCABULARY) -> DataFrame:
    """(key, ids) for every row: the ids of the whole text.

    Null and empty texts have no ids. Repeated rows are encoded each, extra
    columns stay behind, an empty table gives no rows.
    """
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, text):
            ids = pa.array([encode(t, name) for t in _texts(batch, text)], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(key)), ids], names=[key, "ids"])
    return df.select(key, text).mapInArrow(run, f"`{key}` {df.schema[key].dataType.simpleString()}, ids array<int>")


def decode_rows(df: DataFrame, key: str = "doc_id", ids: str = "ids", name: str = VOCABULARY) -> DataFrame:
    """(key, data) for every row: the bytes that the ids stand for; null ids give no bytes."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(batch.schema.get_field_index(ids))
            data = pa.array([decode(r.as_py() or (), name) for r in rows], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(key)), data], names=[key, "data"])
    return df.select(key, ids).mapInArrow(run, f"`{key}` {df.schema[key].dataType.simpleString()}, data binary")


def round_trip_digest(df: DataFrame, key: str = "doc_id", text: str = "text", name: str = VOCABULARY) -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256): each text encoded, its ids decoded, both digested.

    The ids stay in the task that made them, so nothing but digests leaves it.
    """
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = {i: str(i) for i in vocabulary(name).bytes}
        for batch in small_batches(batches, text):
            sizes, ids_sha, decoded_sha = [], [], []
            for t in _texts(batch, text):
                ids = encode(t, name)
                sizes.append(len(ids))
                ids_sha.append(hashlib.sha256(",".join(map(names.__getitem__, ids)).encode()).hexdigest())
                decoded_sha.append(hashlib.sha256(decode(ids, name)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(key)), pa.array(sizes, pa.int64()),
                 pa.array(ids_sha, pa.string()), pa.array(decoded_sha, pa.string())],
                names=[key, "n_tokens", "ids_sha256", "decoded_sha256"])
    return df.select(key, text).mapInArrow(
        run, f"`{key}` {df.schema[key].dataType.simpleString()}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
