"""Column-level helpers (all built-in Spark expressions, no UDFs)."""

from cartwheel.functions.columns import (  # noqa: F401
    blank_to_null,
    cents_to_amount,
    completeness,
    epoch_to_ntz,
    safe_ratio,
    second_boundaries,
    week_start,
)
from cartwheel.functions.dedup import keep_first  # noqa: F401
