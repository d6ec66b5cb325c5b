import base64
import glob
import gzip
import hashlib
import random

import pytest

from cartwheel.llm import warc as W
from cartwheel.llm.common import new_path
from tests.llm.helpers import SF

SCHEMA = "page_id long, url string, html string"


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def brute(rows, least=0):
    first = {}
    for k, _, h in rows:
        if k is not None:
            first[h or ""] = min(k, first.get(h or "", k))
    seen, out = set(), []
    for k, _, h in rows:
        h = h or ""
        keep = first.get(h)
        revisit = len(h.encode()) >= least and (k != keep or (k, h) in seen)
        seen.add((k, h))
        out.append((k, len(h.encode()), digest(h), "revisit" if revisit else "response", keep if revisit else None))
    return sorted(out, key=repr)


def found(df, **settings):
    out = W.archive_and_read_back(df, **settings).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return sorted((tuple(r) for r in out.collect()), key=repr)


ODD = [(1, "http://a.example/x", "<p>one</p>"), (2, "http://a.example/x", "<p>one</p>"), (2, "http://a.example/x", "<p>one</p>"), (3, None, None),
       (4, "", ""), (5, "not a url\r\nX-Page-ID: 9", "é 中文 🙂\r\n\r\nWARC/1.1\r\n"), (6, "https://www.b.example:80/p?q#f", "y" * 300_000), (7, "http://b.example/", "z")]


def test_odd_rows(spark):
    assert found(spark.createDataFrame(ODD, SCHEMA)) == brute(ODD)
    assert found(spark.createDataFrame(ODD, SCHEMA), least_revisit=5) == brute(ODD, 5)
    from pyspark.sql import functions as F
    assert found(spark.createDataFrame(ODD, SCHEMA).withColumn("key", F.lit(1)).withColumn("digest", F.lit("d")).withColumn("archive", F.lit("x"))) == brute(ODD)
    assert found(spark.createDataFrame([], SCHEMA)) == []


def test_null_key(spark):
    rows = [(None, "http://a.example/", "same"), (3, "http://a.example/", "same"), (None, "http://a.example/1", "alone")]
    out = found(spark.createDataFrame(rows, SCHEMA))
    assert [r[3] for r in out if r[0] == 3] == ["response"]
    assert sorted((r[3], r[4]) for r in out if r[0] is None and r[1] == 4) == [("revisit", 3)]


def test_archives_are_plain_gzip_and_look_ups_read_ranges(spark):
    rng = random.Random(1)
    rows = [(i, f"http://h{i % 7}.example/{rng.randrange(40)}", f"page {rng.randrange(60)} " * rng.randint(1, 50)) for i in range(400)]
    archives, index = new_path(spark, "t-archives"), new_path(spark, "t-index")
    W.write_archives(spark.createDataFrame(rows, SCHEMA), archives, archive_bytes=4000)
    files = glob.glob(archives.removeprefix("file:") + "/archive=*/*.txt")
    assert len(files) > 4
    records = b"".join(gzip.open(f).read() for f in files)
    assert records.count(b"WARC/1.1\r\n") == 400
    W.build_index(spark, archives, index, block_captures=16)
    found = W.CaptureIndex(spark, index)
    assert len(found.directory) >= 25 and sum(r["captures"] for r in found.directory) == 400
    assert found.blocks().count() == len(found.directory)
    for url in {rows[i][1] for i in (0, 5, 77, 399)} | {"http://h1.example/none", "http://zzz.example/"}:
        got = sorted(r["page_id"] for r in found.lookup(url).collect())
        assert got == sorted(k for k, u, _ in rows if u == url)
    full = {r["page_id"]: r for r in found.read_all().collect()}
    for k, _, h in rows:
        r = full[k]
        payload = full[r["refers_to"]]["payload"] if r["record_type"] == "revisit" else r["payload"]
        assert bytes(payload).decode() == h


def test_damage_is_noticed():
    import zlib
    member = W.record(1, "http://a/", b"abc", W._digest(b"abc"))
    fields, block = W.parse(member)
    assert fields["WARC-Type"] == "response" and block.endswith(b"\r\n\r\nabc")
    with pytest.raises(zlib.error):
        W.parse(member[:-9] + b"\x00" * 9)


def test_url_keys():
    assert W.url_key("http://www.Example.com/a?b=1#c") == "com,example)/a?b=1"
    assert W.url_key("https://user@m.example.co.uk:8080") == "uk,co,example,m:8080)/"
    assert W.url_key(None) == ")/" and W.url_key("") == ")/"


def test_given_pages(spark):
    table = spark.read.parquet(f"{SF}/pages.parquet")
    assert found(table) == brute([tuple(r) for r in table.select("page_id", "url", "html").collect()])
