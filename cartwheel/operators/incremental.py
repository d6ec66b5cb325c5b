"""Incremental load patterns.

* ``high_watermark`` + ``lookback``: the slice of a source newer than the
  target's watermark minus N days; the bound is one driver-side scalar, so it
  reaches the scan as a literal filter (file / row-group pruning).
* ``upsert``: keyed merge — target rows whose key the source carries are
  replaced by *all* source rows of that key; columns follow the source
  (schema sync). Parquet has no MERGE, so the result is a new snapshot.
* ``recompute_touched``: the correction of the reference's slice-only
  aggregation — keys touched by the slice are recomputed over their full
  history, so an incremental run equals a full refresh.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.fixed_values import WATERMARK_FLOOR as EPOCH_FLOOR  # noqa: E402


def high_watermark(target: DataFrame | None, col: str,
                   default: dt.datetime | dt.date = EPOCH_FLOOR):
    """``coalesce(max(col), default)`` of the target (None target -> default)."""
    if target is None:
        return default
    value = target.agg(F.max(col)).first()[0]
    return default if value is None else value


def lookback(df: DataFrame, ts_col: str, watermark, days: int = 3,
             inclusive: bool = True) -> DataFrame:
    """Rows with ``ts_col`` >= (or >) ``watermark - days``."""
    bound = watermark - dt.timedelta(days=days)
    lit = F.lit(bound)
    if isinstance(bound, dt.datetime):
        lit = lit.cast("timestamp_ntz")
    c = F.col(ts_col)
    return df.where(c >= lit if inclusive else c > lit)


def _null_safe_on(left: DataFrame, right: DataFrame, keys: Sequence[str]):
    cond = None
    for k in keys:
        term = left[k].eqNullSafe(right[k])
        cond = term if cond is None else cond & term
    return cond


def upsert(target: DataFrame | None, source: DataFrame, keys: Sequence[str],
           sync_columns: bool = True, touched: DataFrame | None = None) -> DataFrame:
    """Keyed merge of ``source`` into ``target`` (I2-I4); NULL keys match NULL.

    Target rows whose key is in ``touched`` (default: the source's keys) are
    replaced by the source rows of that key; a touched key absent from the
    source is deleted.
    """
    if target is None:
        return source
    src_keys = (touched if touched is not None else source).select(*keys).distinct()
    kept = target.join(src_keys, _null_safe_on(target, src_keys, keys), "left_anti")
    if sync_columns:
        kept = kept.select(*[c for c in source.columns if c in kept.columns])
    return kept.unionByName(source, allowMissingColumns=True)


def semi_null_safe(rows: DataFrame, keys_df: DataFrame, keys: Sequence[str], distinct: bool = True) -> DataFrame:
    """Rows of ``rows`` whose ``keys`` occur in ``keys_df`` (NULL matches NULL).

    Keys that are there once already need no ``distinct``, which is a shuffle of its own.
    """
    k = keys_df.select(*keys)
    k = k.distinct() if distinct else k
    return rows.join(k, _null_safe_on(rows, k, keys), "left_semi")


def touched_history(history: DataFrame, slice_keys: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full-history rows of the keys present in ``slice_keys``."""
    k = slice_keys.select(*keys).where(
        F.coalesce(*[F.col(c).isNotNull() for c in keys])).distinct()
    return history.join(k, list(keys), "left_semi")


def recompute_touched(target: DataFrame | None, history: DataFrame, slice_keys: DataFrame,
                      keys: Sequence[str], build: Callable[[DataFrame], DataFrame],
                      out_keys: Sequence[str] | None = None) -> DataFrame:
    """Rebuild the keys a slice touches from their full history and upsert them."""
    rebuilt = build(touched_history(history, slice_keys, keys))
    return upsert(target, rebuilt, out_keys or keys)
