"""Column expressions (all JVM-side, codegen-friendly; no Python UDFs)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Part names of a month/day/year date string, in that order.
DATE_PART_NAMES = ("month", "day", "year")


def flag_to_int(col: str | Column) -> Column:
    """Boolean flag as 0/1 integer; null stays null."""
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("int")


def date_part(col: str | Column, position: int, sep: str = "/") -> Column:
    """Integer part ``position`` (0-based) of a delimited date string.

    Null-safe under ANSI mode: a missing part or a non-numeric part gives null
    instead of failing the job.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.get(F.split(c, sep), F.lit(position)).try_cast("int")


def date_parts(col: str, prefix: str, sep: str = "/") -> dict[str, Column]:
    """``{prefix}_month, {prefix}_day, {prefix}_year`` from an ``M/D/Y`` string."""
    return {f"{prefix}_{name}": date_part(col, i, sep) for i, name in enumerate(DATE_PART_NAMES)}


def row_key(key_cols: Sequence[str]) -> Column:
    """Canonical string of a composite row key: parts joined by '-'."""
    return F.concat_ws("-", *[F.col(k).cast("string") for k in key_cols])


#: Values of ``hash_value`` are below this.
HASH_RANGE = 1 << 32


def hash_value(key_cols: Sequence[str], lane: int = 0, seed: int | None = None) -> Column:
    """Deterministic value in ``[0, 2**32)`` from the md5 of the row key, or of the seed
    and the row key.

    ``lane`` picks which 8 hex digits of the digest are used (0..3), so that a
    split, a fold and a hold-out flag drawn from one key are independent. Pure
    per-row function: no shuffle, same answer on every executor, on any number of
    cores, and in SQL.
    """
    if not 0 <= lane <= 3:
        raise ValueError("lane must be in 0..3")
    key = row_key(key_cols)
    if seed is not None:
        key = F.concat_ws(":", F.lit(str(seed)), key)
    return F.conv(F.substring(F.md5(key), 1 + 8 * lane, 8), 16, 10).cast("long")


def epoch_seconds(col: str | Column) -> Column:
    """Seconds since 1970-01-01 of a zone-less timestamp, independent of session zone."""
    c = F.col(col) if isinstance(col, str) else col
    return (F.unix_date(F.to_date(c)).cast("long") * 86400
            + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)).cast("long")
