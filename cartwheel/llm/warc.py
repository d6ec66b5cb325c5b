"""Operator 3: WARC archives with a two-level capture index.

Records are gzip members one after the other, written by Spark's text writer:
a row is a member, and the line separator is an empty gzip member, so the files
are plain .warc.gz content that any gzip reader concatenates. Of captures with
equal payloads one is stored in full, the others are revisit records that name
it.

The index has two levels. Captures are sorted by their URL key (host labels
reversed) and cut into compressed blocks; a sparse directory keeps the first and
last key of every block. A look-up searches the directory by bisection, reads
the few blocks that can hold the key, and then only the byte ranges of the
records it found. The whole archive is read back the same way, block by block.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import new_path, ship, small_batches, text_bytes, written

#: An archive is closed once it holds this many bytes.
ARCHIVE_BYTES = 16 << 20
#: Captures in an index block.
BLOCK_CAPTURES = 1024
DATE = "2024-01-01T00:00:00Z"
#: An empty gzip member: header, empty deflate stream, CRC and size of nothing.
EMPTY_MEMBER = bytes.fromhex("1f8b08000000000000ff03000000000000000000")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_URL = re.compile(r"(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#]*)(.*)", re.S)


def url_key(url: str | None) -> str:
    """Sort key of a URL: host labels reversed, then path and query; no scheme, user, leading www or fragment."""
    match = _URL.match(url or "")
    host, rest = match.groups() if match else ("", url or "")
    name, _, port = host.lower().partition(":")
    labels = [x for x in name.split(".") if x]
    if labels and re.fullmatch(r"www\d*", labels[0]):
        labels = labels[1:]
    return ",".join(reversed(labels)) + (":" + port if port else "") + ")" + (rest.split("#", 1)[0] or "/")


def sha1_base32(payload: Column) -> Column:
    """Upper-case base32 SHA-1 of a binary column: five hex digits are four base32 digits."""
    digits = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digits, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(key, digest: str, copy: int = 1) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{key}|{digest}|{copy}')}>"


def _header_value(text: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def record(key, url: str | None, payload: bytes, digest: str, copy: int = 1, refers_to=None, revisit: bool = False,
           date: str = DATE) -> bytes:
    """One WARC 1.1 record as a gzip member. A revisit keeps the HTTP header and leaves out the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _record_id(key, digest, copy)),
              ("WARC-Date", date), ("WARC-Target-URI", None if url is None else _header_value(url)),
              ("X-Page-ID", key), ("WARC-Payload-Digest", f"sha1:{digest}"),
              ("Content-Type", "application/http;msgtype=response"), ("Content-Length", len(block))]
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(refers_to, digest)), ("X-Refers-To-Page-ID", refers_to)]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()


def parse(member: bytes, most: int = 0) -> tuple[dict[str, str], bytes]:
    """(header fields, block) of a gzip member; with ``most`` only that many bytes are unpacked."""
    data = zlib.decompressobj(31).decompress(member, most) if most else zlib.decompress(member, 31)
    head, found, rest = data.partition(b"\r\n\r\n")
    if not found and most:
        return parse(member)
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    return fields, rest[:int(fields["Content-Length"])]


# ---------------------------------------------------------------- writing

def write_archives(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html",
                   least_revisit: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write one record a row under ``path``/archive=<name>/.

    A null payload is empty. Of captures with equal payloads of at least
    ``least_revisit`` bytes the smallest key is the response, the others revisit
    it; of rows that also repeat the key one is the response. A null key comes
    last and refers to no one by number.
    """
    ship(pages.sparkSession)
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    # The key as text without nulls, so that the window and the join below share one shuffle of the payloads.
    name = F.coalesce(F.col(key).cast("long").cast("string"), F.lit(""))
    rows = pages.select(name.alias("name"), F.col(key).cast("long").alias("key"), F.col(url).cast("string").alias("url"),
                        F.coalesce(F.col(payload).cast("string"), F.lit("")).alias("payload"), sha1_base32(body).alias("digest"))
    small = rows.select("name", "key", "digest", F.octet_length("payload").alias("size")).distinct()
    first = written(small.where(F.col("size") >= least_revisit).groupBy("digest").agg(F.min("key").alias("first")), "payloads")
    chosen = written(small.join(first, "digest", "left").select(
        "name", "digest", "first", (F.col("size") >= least_revisit).alias("shared")), "captures")
    copies = Window.partitionBy("name", "digest").orderBy("url")
    placed = rows.withColumn("copy", F.row_number().over(copies)).join(chosen, ["name", "digest"]).select(
        "key", "url", "payload", "digest", "copy", "first",
        (F.col("shared") & ((F.col("copy") > 1) | ~F.col("key").eqNullSafe(F.col("first")))).alias("revisit"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, size = uuid.uuid4().hex[:16], 0
        for batch in small_batches(batches, "payload"):
            off, raw = text_bytes(batch.column(2))
            keys, urls, digests, copy, refer, revisit = (batch.column(i).to_pylist() for i in (0, 1, 3, 4, 5, 6))
            names, members = [], []
            for i in range(batch.num_rows):
                members.append(record(keys[i], urls[i], raw[off[i]:off[i + 1]].tobytes(), digests[i], copy[i], refer[i], revisit[i]))
                names.append(name)
                size += len(members[-1]) + len(EMPTY_MEMBER)
                if size >= archive_bytes:
                    name, size = uuid.uuid4().hex[:16], 0
            yield pa.RecordBatch.from_arrays([pa.array(members, pa.binary()), pa.array(names)], names=["member", "archive"])
    (placed.mapInArrow(run, "member binary, archive string").select(F.col("member").cast("string").alias("value"), "archive")
     .write.partitionBy("archive").option("lineSep", EMPTY_MEMBER.decode("latin-1")).option("encoding", "ISO-8859-1").text(path))


# ---------------------------------------------------------------- index

def _captures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every record of every archive: its URL key and where it lies."""
    for batch in batches:
        for path, content in zip(batch.column(0), batch.column(1)):
            data, at, rows = content.as_buffer().to_pybytes(), 0, []
            while at < len(data):
                end = data.find(EMPTY_MEMBER, at)
                end = len(data) if end < 0 else end
                fields, _ = parse(data[at:end], 4096)
                rows.append((url_key(fields.get("WARC-Target-URI")), fields["WARC-Date"], fields["WARC-Record-ID"], path.as_py(), at, end - at))
                at = end + len(EMPTY_MEMBER)
            if rows:
                kinds = (pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)],
                                                 names=["url_key", "date", "record_id", "archive", "offset", "length"])


def _blocks(captures: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []

        def block(rows: list[tuple]) -> pd.DataFrame:
            text = "\n".join(json.dumps(r) for r in rows).encode()
            return pd.DataFrame({"block": [uuid.uuid4().hex], "first_key": rows[0][0], "last_key": rows[-1][0],
                                 "captures": len(rows), "data": [zlib.compress(text, 6)]})
        for batch in batches:
            held += list(batch.itertuples(index=False, name=None))
            while len(held) >= captures:
                yield block(held[:captures])
                held = held[captures:]
        if held:
            yield block(held)
    return run


def _unpack(data: bytes) -> list[list]:
    return [json.loads(line) for line in zlib.decompress(data).decode().split("\n")]


_BLOCK = "block string, first_key string, last_key string, captures int, data binary"
_CAPTURE = "url_key string, date string, record_id string, archive string, offset bigint, length bigint"


def build_index(spark: SparkSession, archives: str, path: str, block_captures: int = BLOCK_CAPTURES) -> None:
    """Read the archives once and write ``path``/blocks and the sparse ``path``/directory."""
    ship(spark)
    files = spark.read.format("binaryFile").load(archives).select("path", "content")
    captures = files.mapInArrow(_captures, _CAPTURE)
    order = ["url_key", "date", "record_id"]
    blocks = captures.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(_blocks(block_captures), _BLOCK)
    blocks.write.parquet(f"{path}/blocks")
    spark.read.schema(_BLOCK).parquet(f"{path}/blocks").drop("data").write.parquet(f"{path}/directory")


def read_ranges(captures: DataFrame) -> DataFrame:
    """(page_id, url, type, digest, payload_bytes, refers_to, payload) of captures, by byte ranges of their archives.

    Captures of an archive are read in order by one task. A response's payload
    is checked against its digest; a revisit has none.
    """
    ship(captures.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, opened = None, None
        for batch in batches:
            rows = []
            for archive, offset, length in zip(batch["archive"], batch["offset"], batch["length"]):
                if archive != name:
                    system, place = pafs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", archive))
                    name, opened = archive, system.open_input_file(place)
                opened.seek(offset)
                fields, block = parse(opened.read(length))
                http, _, payload = block.partition(b"\r\n\r\n")
                digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                kind = fields["WARC-Type"]
                size = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
                if kind == "response" and (_digest(payload) != digest or len(payload) != size):
                    raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
                key, refers = fields.get("X-Page-ID"), fields.get("X-Refers-To-Page-ID")
                rows.append((key and int(key), fields.get("WARC-Target-URI"), kind, digest, size, refers and int(refers),
                             payload if kind == "response" else None))
            yield pd.DataFrame(rows, columns=["page_id", "url", "record_type", "payload_digest", "payload_bytes", "refers_to", "payload"]).astype(
                {"page_id": "Int64", "refers_to": "Int64"})
    return captures.repartition("archive").sortWithinPartitions("archive", "offset").mapInPandas(
        run, "page_id bigint, url string, record_type string, payload_digest string, payload_bytes bigint, refers_to bigint, payload binary")


class CaptureIndex:
    """Look-ups in an index written by ``build_index``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._directory: list | None = None

    def blocks(self) -> DataFrame:
        return self.spark.read.schema(_BLOCK).parquet(f"{self.path}/blocks")

    @property
    def directory(self) -> list:
        """The sparse directory, one row a block, in key order (a thousandth of the captures)."""
        if self._directory is None:
            self._directory = sorted(self.spark.read.parquet(f"{self.path}/directory").collect(), key=lambda r: (r["first_key"], r["last_key"]))
        return self._directory

    def captures(self, blocks: DataFrame | None = None) -> DataFrame:
        """Every capture of the given blocks (all by default)."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for data in batch.column(0):
                    columns = zip(*_unpack(data.as_py()))
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["url_key", "date", "record_id", "archive", "offset", "length"])
        return (self.blocks() if blocks is None else blocks).select("data").mapInArrow(run, _CAPTURE)

    def lookup(self, url: str) -> DataFrame:
        """The records of a URL: bisect the directory, unpack the blocks between, read the records' ranges."""
        key = url_key(url)
        first = bisect_left([r["last_key"] for r in self.directory], key)
        last = bisect_right([r["first_key"] for r in self.directory], key)
        names = [r["block"] for r in self.directory[first:last]]
        return read_ranges(self.captures(self.blocks().where(F.col("block").isin(names))).where(F.col("url_key") == key))

    def read_all(self) -> DataFrame:
        return read_ranges(self.captures())


def archive_and_read_back(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html",
                          least_revisit: int = 0) -> DataFrame:
    """Write every row to archives in the shared folder, index them, and read all records back through the index.

    Null payloads are empty, null URLs have the empty host; an empty table gives
    no rows; extra columns stay behind.
    """
    spark = pages.sparkSession
    archives, index = new_path(spark, "archives"), new_path(spark, "capture-index")
    write_archives(pages, archives, key, url, payload, least_revisit)
    build_index(spark, archives, index)
    return CaptureIndex(spark, index).read_all()
