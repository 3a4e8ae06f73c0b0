"""Join helpers of the star joins of the line view (J1 is
``cluster.models.attach_labels``, J2 ``forecast.evaluate.scaled_vs_unscaled``).

``broadcast_if_small`` is the only place a data-dependent side is
broadcast: the side is counted up to a bound first (a bounded action that
stops reading once the bound is passed). Within the bound it is broadcast;
beyond it the join carries no hint and shuffles, with sorting that can spill,
so nothing unbounded is ever sent whole to every executor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_ROWS = 1_000_000
#: Bytes that a broadcast dimension may have at most, by its rows and the width of its columns.
DEFAULT_MAX_BYTES = 64 << 20
#: Bytes counted for a string, whose length the schema does not tell.
STRING_BYTES = 64


def fits(df: DataFrame, max_rows: int) -> bool:
    return df.limit(max_rows + 1).count() <= max_rows


def row_bytes(df: DataFrame) -> int:
    """About how many bytes a row takes, by the types of its columns."""
    return sum(STRING_BYTES if f.dataType.simpleString() in ("string", "binary") else 16 for f in df.schema.fields)


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS, rows: int | None = None,
                       max_bytes: int = DEFAULT_MAX_BYTES) -> DataFrame:
    """``rows``: a known bound on the rows of ``df`` (e.g. those of the
    dimension before a key join that cannot add rows); without it the frame
    is counted up to the bound."""
    max_rows = min(max_rows, max_bytes // max(1, row_bytes(df)))
    ok = rows <= max_rows if rows is not None else fits(df, max_rows)
    return F.broadcast(df) if ok else df
