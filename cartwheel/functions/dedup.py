"""Top-1-per-key selection.

``row_number() = 1`` is planned by Catalyst as a partial ``WindowGroupLimit``
before the shuffle and a final one after it, so every map task forwards at
most one row per key: a key holding a third of all rows costs no more
shuffle than any other key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
               rank_col: str = "_rn") -> DataFrame:
    """Keep the first row per ``keys`` under ``order`` (give a unique last key)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn(rank_col, F.row_number().over(w))
              .where(F.col(rank_col) == 1)
              .drop(rank_col))
