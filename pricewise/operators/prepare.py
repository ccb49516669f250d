"""Row preparation (P1-P4, F1-F4): projection, flag casts, renames and date parts.

Each step is a single narrow projection; Catalyst collapses the chain into one
Project over the scan, so only the named columns are read."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import date_parts, flag_to_int


def project(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep only ``cols`` in the given order."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    return df.select(*cols)


def cast_flags(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Replace boolean flag columns in place by 0/1 integers."""
    if not flags:
        return df
    return df.withColumns({c: flag_to_int(c) for c in flags})


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns (P4), keeping column order."""
    if not mapping:
        return df
    return df.withColumnsRenamed(dict(mapping))


def add_date_parts(df: DataFrame, dates: Mapping[str, str], sep: str = "/") -> DataFrame:
    """For each ``{date column: prefix}`` add ``prefix_month/day/year`` ints."""
    new = {}
    for col, prefix in dates.items():
        new.update(date_parts(col, prefix, sep))
    return df.withColumns(new) if new else df


@dataclass(frozen=True)
class PrepareSpec:
    """What the reference's "prepare the data" cell does, as data."""
    columns: tuple[str, ...]
    flags: tuple[str, ...] = ()
    dates: Mapping[str, str] = field(default_factory=dict)
    renames: Mapping[str, str] = field(default_factory=dict)


def prepare(df: DataFrame, spec: PrepareSpec) -> DataFrame:
    out = project(df, spec.columns)
    out = cast_flags(out, spec.flags)
    out = add_date_parts(out, spec.dates)
    return rename(out, spec.renames)


def prediction_projection(scored: DataFrame, label: str, keys: Sequence[str] = (),
                          features: bool = False) -> DataFrame:
    """``[keys], [features], prediction, trueLabel`` of a scored frame."""
    cols = [F.col(k) for k in keys]
    if features:
        cols.append(F.col("features"))
    if "prediction" in scored.columns:
        cols.append(F.col("prediction"))
    cols.append(F.col(label).alias("trueLabel"))
    return scored.select(*cols)
