"""Canonical data model.

Long layout (one row per observation)::

    series_id STRING   -- which series (e.g. an event type, a user, a file)
    var       STRING   -- which variable of a multivariate series
    ts        TIMESTAMP_NTZ
    pos       BIGINT   -- dense 0-based row index inside (series_id, var)
    value     DOUBLE   -- NULL is the only missing marker (NaN is normalised)

``pos`` is what every ordered operator sorts by.  On a regular calendar it is
computed arithmetically from ``ts`` (no sort needed); for irregular input it
is assigned by :func:`tsforge.operators.scan.assign_positions` with a sample
sort (ranges, counts, offsets).
"""

from __future__ import annotations

from dataclasses import dataclass, field

KEYS = ["series_id", "var"]
LONG_COLUMNS = ["series_id", "var", "ts", "pos", "value"]

# Rows per scan chunk.  Windows and carries are evaluated per
# (series_id, var, chunk); a chunk is the unit of parallelism for one series.
DEFAULT_CHUNK_ROWS = 1 << 16

@dataclass(frozen=True)
class SeriesSpec:
    """Which columns of a wide/raw table form the series."""

    ts_col: str
    value_cols: tuple[str, ...]
    series_cols: tuple[str, ...] = ()
    freq: str | None = None
    order_cols: tuple[str, ...] = field(default_factory=tuple)

    @staticmethod
    def of(ts_col: str, value_cols, series_cols=(), freq=None, order_cols=()):
        if isinstance(value_cols, str):
            value_cols = (value_cols,)
        if isinstance(series_cols, str):
            series_cols = (series_cols,)
        if isinstance(order_cols, str):
            order_cols = (order_cols,)
        if not value_cols:
            raise ValueError("value_cols must name at least one column")
        return SeriesSpec(ts_col, tuple(value_cols), tuple(series_cols), freq, tuple(order_cols))


def require_columns(df, cols) -> None:
    """Plan-time column existence check (raises before any job runs)."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"unknown column(s) {missing}; available: {df.columns}")
