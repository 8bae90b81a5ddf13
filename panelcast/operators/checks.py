"""Data checks: null profile, null assertion, schema report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_counts_wide(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """One row, one ``bigint`` null count per column (single pass)."""
    cols = cols or df.columns
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


def null_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Long form ``(column_name, null_count)``, one aggregate pass + unpivot."""
    cols = cols or df.columns
    wide = null_counts_wide(df, cols)
    return wide.unpivot([], cols, "column_name", "null_count")


def assert_no_nulls(df: DataFrame, cols: list[str] | None = None) -> None:
    """Raise with the offending columns when any column holds a null.
    NaN and infinity are values, not nulls (as in the reference)."""
    row = null_counts_wide(df, cols).first()
    bad = {k: v for k, v in row.asDict().items() if v}
    if bad:
        raise AssertionError(f"unexpected nulls: total {sum(bad.values())} in {bad}")


def schema_report(df: DataFrame) -> DataFrame:
    """(position, column_name, data_type, n_values): the columns in their order, with the non-null values of each (one pass)."""
    about = df.sparkSession.createDataFrame(
        [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)],
        "position int, column_name string, data_type string")
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]).unpivot([], df.columns, "column_name", "n_values")
    return about.join(F.broadcast(counts), "column_name").select("position", "column_name", "data_type", "n_values")  # one row per column
