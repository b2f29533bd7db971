"""Time helpers shared by the window operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_seconds(ts) -> Column:
    """Whole seconds since the epoch (floor), as bigint.

    ``TIMESTAMP_NTZ`` values are read as UTC wall clock, ``TIMESTAMP`` values
    as instants, so the result does not depend on the session zone for either.
    """
    return F.unix_timestamp(_col(ts))


def from_epoch_seconds(sec) -> Column:
    """Inverse of :func:`epoch_seconds` as ``TIMESTAMP_NTZ`` (zone-free)."""
    return F.timestamp_seconds(_col(sec)).cast("timestamp_ntz")


def epoch_micros(ts, ntz: bool = True) -> Column:
    """Microseconds since the epoch; ``ntz`` tells how to read the column."""
    c = _col(ts)
    if not ntz:
        return F.unix_micros(c)
    frac = (F.date_part(F.lit("SECOND"), c) * 1_000_000).cast("bigint") % 1_000_000
    return F.unix_timestamp(c) * 1_000_000 + frac
