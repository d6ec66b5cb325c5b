"""Durable state of incremental runs: which folders are the current tables.

A table is laid out by one partition value a row (a date, as text):

    <root>/tables/<table>/batch=<n>/part=<value>/*.parquet

A batch writes only the parts it touches, into a folder of its own, and never
changes what an earlier batch wrote. The manifest of a batch
(``<root>/manifest/<n>.json``) says for every table which batch holds each of its
parts, with the table's schema and the run's watermarks. It is written beside its
place and renamed into it after all tables of the batch are there, so a run that
stops half-way leaves the batch before as the state, and the next run starts the
batch anew. Folders that the last manifest no longer names are deleted after it.
"""

from __future__ import annotations

import copy
import datetime as dt
import json
import threading
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.operators import incremental as inc

PART = "part"
#: Part of rows whose partition value is NULL, and the only part of tables without one.
NO_PART, ONE_PART = "none", "all"
# tasks may write into place: nothing reads a folder before its batch is committed or its writing job has ended
_WRITE = {"mapreduce.fileoutputcommitter.algorithm.version": "2", "compression": "zstd", "parquet.compression.codec.zstd.level": "1"}


def part_of(date: Column | None) -> Column:
    """A row's part: its date as text."""
    if date is None:
        return F.lit(ONE_PART)
    return F.coalesce(F.date_format(date.cast("date"), "yyyy-MM-dd"), F.lit(NO_PART))


class RunState:
    """Tables of committed batches, and those of the batch that is being made."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._lock = threading.RLock()
        self._readers: dict[str, DataFrame] = {}
        self.batch, self.tables, self.marks = 0, {}, {}
        found = [int(n[:-5]) for n in self._names(f"{self.root}/manifest") if n.endswith(".json")]
        if found:
            held = json.loads(self._text(f"{self.root}/manifest/{max(found)}.json"))
            self.batch, self.tables, self.marks = held["batch"], held["tables"], held["marks"]
        self.draft: dict[str, dict] = copy.deepcopy(self.tables)

    # -- file system (whatever store the root lies in) -----------------------
    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self):
        return self._path(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        fs, path = self._fs(), self._path(folder)
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []

    def _text(self, path: str) -> str:
        stream = self._fs().open(self._path(path))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _delete(self, path: str) -> None:
        self._fs().delete(self._path(path), True)

    # -- a batch -------------------------------------------------------------
    def begin(self) -> int:
        """Start the batch after the last committed one; what a stopped run left of it goes."""
        with self._lock:
            number = self.batch + 1
            for table in self._names(f"{self.root}/tables"):
                for folder in self._names(f"{self.root}/tables/{table}"):
                    if int(folder.split("=")[1]) >= number:
                        self._delete(f"{self.root}/tables/{table}/{folder}")
            self._delete(f"{self.root}/scratch")
            self.draft = copy.deepcopy(self.tables)
            self._readers.clear()
            return number

    def folder(self, table: str) -> str:
        return f"{self.root}/tables/{table}/batch={self.batch + 1}"

    def parts(self, table: str) -> set[str] | None:
        """The parts of a table; None if there is no such table."""
        held = self.draft.get(table)
        return None if held is None else set(held["parts"])

    def born(self, table: str) -> set[str]:
        """The parts of a table that the batch wrote and that weren't there before it."""
        before = self.tables.get(table, {"parts": {}})["parts"]
        return {p for p, number in self.draft.get(table, {"parts": {}})["parts"].items() if number == self.batch + 1 and p not in before}

    def read(self, table: str, parts: Iterable[str] | None = None) -> DataFrame | None:
        """The table (or some of its parts) with its part in a column; None if there is no such table.

        The files of a version are listed once; some of its parts are a filter on the part, which prunes folders.
        """
        with self._lock:
            held = self.draft.get(table)
            if held is None:
                return None
            schema = T.StructType.fromJson(held["schema"]).add(PART, T.StringType())
            where = held["parts"]
            chosen = sorted(where if parts is None else set(parts) & set(where))
            if not chosen:
                return self.spark.createDataFrame([], schema)
            if table not in self._readers:
                base = f"{self.root}/tables/{table}"
                paths = [f"{base}/batch={number}/{PART}={part}" for part, number in sorted(where.items())]
                self._readers[table] = self.spark.read.schema(schema).option("basePath", base).parquet(*paths).select(*schema.names)
            whole = self._readers[table]
        return whole if len(chosen) == len(where) else whole.where(F.col(PART).isin(chosen))

    def replace(self, table: str, rows: DataFrame, touched: Iterable[str] | None = None,
                order: Sequence[str] = ()) -> None:
        """Write the touched parts of a table anew; ``rows`` carry their part and are all rows of these parts.

        Without ``touched`` the whole table is replaced. Touched parts without rows go. Spark deals the rows to files by
        part, large parts in several.
        """
        target = self.folder(table)
        dealt = rows.hint("rebalance", PART)
        if order:
            dealt = dealt.sortWithinPartitions(PART, *order)
        dealt.write.options(**_WRITE).mode("overwrite").partitionBy(PART).parquet(target)
        written = {n.split("=", 1)[1] for n in self._names(target) if n.startswith(f"{PART}=")}
        with self._lock:
            before = self.draft.get(table, {"parts": {}})["parts"]
            gone = set(before) if touched is None else set(touched)
            if touched is not None and not written <= gone:
                raise ValueError(f"{table}: rows of parts that aren't touched: {sorted(written - gone)}")
            schema = T.StructType([f for f in rows.schema.fields if f.name != PART])
            self.draft[table] = {"schema": json.loads(schema.json()),
                                 "parts": {**{p: b for p, b in before.items() if p not in gone}, **dict.fromkeys(written, self.batch + 1)}}
            self._readers.pop(table, None)

    def scratch(self, name: str, rows: DataFrame) -> DataFrame:
        """Rows that several jobs of the batch read, written once; they don't outlive the batch."""
        path = f"{self.root}/scratch/{name}"
        rows.write.options(**_WRITE).mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def forget(self, name: str) -> None:
        """Delete scratch rows that no later job of the batch reads."""
        self._delete(f"{self.root}/scratch/{name}")

    def commit(self, marks: dict | None = None) -> None:
        """Make the batch's tables the state: one rename. Then delete what no table needs any more."""
        with self._lock:
            number = self.batch + 1
            self.marks = {**self.marks, **(marks or {})}
            text = json.dumps({"batch": number, "tables": self.draft, "marks": self.marks})
            fs, beside, place = self._fs(), self._path(f"{self.root}/manifest/{number}.json.new"), self._path(f"{self.root}/manifest/{number}.json")
            stream = fs.create(beside, True)
            try:
                stream.write(bytearray(text.encode()))
            finally:
                stream.close()
            if fs.exists(place) or not fs.rename(beside, place):
                raise RuntimeError(f"batch {number} has been committed by another run")
            self.batch, self.tables = number, copy.deepcopy(self.draft)
            self._clean()
            self._readers.clear()

    def _clean(self) -> None:
        for name in self._names(f"{self.root}/manifest"):
            if name != f"{self.batch}.json":
                self._delete(f"{self.root}/manifest/{name}")
        for table in self._names(f"{self.root}/tables"):
            parts = self.tables.get(table, {"parts": {}})["parts"]
            for folder in self._names(f"{self.root}/tables/{table}"):
                number = int(folder.split("=")[1])
                if number not in parts.values():
                    self._delete(f"{self.root}/tables/{table}/{folder}")
                    continue
                for name in self._names(f"{self.root}/tables/{table}/{folder}"):
                    if name.startswith(f"{PART}=") and parts.get(name.split("=", 1)[1]) != number:
                        self._delete(f"{self.root}/tables/{table}/{folder}/{name}")
        self._delete(f"{self.root}/scratch")

    # -- rows of some keys ---------------------------------------------------
    def located(self, table: str, keys_df: DataFrame, on: dict[str, Column], parts: Iterable[str] | None = None,
                distinct: bool = True) -> list[str]:
        """Parts (of ``parts``, if given) that hold rows of these keys: a scan of the key columns alone."""
        if parts is not None and not parts:
            return []
        narrow = self.read(table, parts).select(*[c.alias(k) for k, c in on.items()], PART)
        found = inc.semi_null_safe(narrow, keys_df, list(on), distinct).select(PART).distinct()
        return [r[0] for r in found.collect()]  # at most one a part

    def rows_of(self, table: str, keys_df: DataFrame, on: dict[str, Column] | Sequence[str], distinct: bool = True,
                born: bool = False, nulls: bool = True) -> DataFrame:
        """Rows of a table whose keys occur in ``keys_df`` (NULL matches NULL), read from the parts that hold some.

        ``distinct``: the keys may be there more than once. ``born``: the keys are those of all rows that the batch
        wrote, NULL ones only with ``nulls``; parts that were not there before then hold nothing but rows asked for,
        and are read without looking their keys up.
        """
        on = on if isinstance(on, dict) else {k: F.col(k) for k in on}
        fresh = self.born(table) if born else set()
        older = self.parts(table) - fresh if fresh else None
        some = self.read(table, self.located(table, keys_df, on, older, distinct))
        named = some.withColumns({f"_key_{k}": c for k, c in on.items()})
        keys = keys_df.select(*[F.col(k).alias(f"_key_{k}") for k in on])
        found = inc.semi_null_safe(named, keys, [f"_key_{k}" for k in on], distinct).drop(*[f"_key_{k}" for k in on])
        if not fresh:
            return found
        young = self.read(table, fresh)
        for c in [] if nulls else on.values():
            young = young.where(c.isNotNull())
        return found.unionByName(young)

    def merge(self, table: str, rebuilt: DataFrame, keys: Sequence[str], part: Column | None, touched: DataFrame | None = None,
              keep_old: bool = True, order: Sequence[str] = (), within: Iterable[str] | None = None) -> tuple[DataFrame | None, DataFrame]:
        """Rows of touched keys replaced by the rebuilt ones, in the parts that lose or gain rows and no others.

        Returns (old rows of the touched keys, rebuilt rows). ``touched`` defaults to the rebuilt rows' keys. A row
        whose key moves to another part leaves its old one. Old rows are given only on demand. ``within``: parts that
        all rebuilt rows lie in; with them (and ``touched``) the rebuilt rows are written once, into the table alone.
        """
        rebuilt = rebuilt.withColumn(PART, part_of(part))
        if self.parts(table) is None:
            self.replace(table, rebuilt, order=order)
            return None, self.read(table)
        on = {k: F.col(k) for k in keys}
        with ThreadPoolExecutor(1) as other:  # none of these pairs of jobs needs the other
            if touched is None:
                new = self.scratch(f"{table}-new", rebuilt)
                scope = new.select(*keys).distinct()
                left = self.located(table, scope, on)
            else:
                scope = touched.select(*keys)
                looked = other.submit(self.located, table, scope, on)
                new = rebuilt if within is not None else self.scratch(f"{table}-new", rebuilt)
                left = looked.result()
            gained = set(within) if within is not None else {r[0] for r in new.select(PART).distinct().collect()}
            parts, old = gained | set(left), None
            if keep_old and left:
                old = other.submit(self.scratch, f"{table}-old", inc.semi_null_safe(self.read(table, left), scope, keys, False))
            if parts:
                kept = self.read(table, gained - set(left))  # of these no row goes
                if left:
                    losing = self.read(table, left)
                    kept = kept.unionByName(losing.join(scope, inc._null_safe_on(losing, scope, keys), "left_anti"))
                self.replace(table, kept.unionByName(new), parts, order)
            return None if old is None else old.result(), new


def as_mark(value: dt.datetime | dt.date | None) -> str | None:
    return None if value is None else value.isoformat()
