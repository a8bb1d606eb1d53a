"""Join-side size guards.

A side is broadcast only after its row count is checked against a bound;
beyond the bound the join is left to the planner, which shuffles both sides
(and, with adaptive execution on, still switches to a broadcast at runtime
if the shuffled side turns out small).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows up to which a dimension-like side is broadcast.  Calendar and
# per-group tables hold a few thousand rows; the bound leaves room for
# multi-decade calendars times thousands of groups while staying far below
# executor memory (a million narrow rows is tens of MB).
DEFAULT_MAX_ROWS = 1_000_000


def checked_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS) -> DataFrame:
    """Return ``broadcast(df)`` when ``df`` has at most ``max_rows`` rows.

    The count reads at most ``max_rows + 1`` rows, so the check itself stays
    cheap when the side is large.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df
