"""Small tables that hold every odd case, and the given ones."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))


def words(rng: random.Random, n: int, pool: int = 60) -> list[str]:
    return [f"t{rng.randrange(pool)}" for _ in range(n)]


def odd_texts() -> list[tuple[int | None, str | None]]:
    """Nulls, empty and blank texts, ties, repeated rows, very long texts, odd characters."""
    return [(1, "same text here"), (2, "same text here"), (2, "same text here"), (3, None), (4, ""), (5, None), (6, " \t\n "),
            (7, LONG), (8, LONG), (9, "one"), (10, "one two three four"), (11, "É 中文 🙂\x1c\x85 <|endoftext|>  \n  x"),
            (None, "no key"), (12, "ONE"), (13, "a" * 5000)]


def docs(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    full = [(k, t, "en", "src0", None if t is None else len(t)) for k, t in rows]
    return spark.createDataFrame(full, DOCS)


def clashing(df: DataFrame) -> DataFrame:
    """The table with columns of its own that bear names operators use."""
    from pyspark.sql import functions as F
    for name in ("key", "digest", "n", "token", "score", "shard", "piece", "offset", "found", "component", "_part", "node", "label"):
        if name not in df.columns:
            df = df.withColumn(name, F.lit("clash"))
    return df


def rows(df: DataFrame) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


class Links:
    """Union-find for brute-force components."""

    def __init__(self, nodes):
        self.parent = {n: n for n in nodes}

    def find(self, x):
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)
