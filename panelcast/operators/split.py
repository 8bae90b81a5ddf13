"""Chronological split and model-input projections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY, DATE, TARGET = "store_nbr", "date", "transactions"


def split_label(train_end: str, val_end: str, date_col=DATE):
    d = F.col(date_col)
    return (F.when(d <= F.lit(train_end).cast("date"), "train")
            .when(d <= F.lit(val_end).cast("date"), "val").otherwise("test"))


def chronological_split(df: DataFrame, train_end: str, val_end: str, date_col=DATE) -> DataFrame:
    """Adds ``split``: train <= train_end < val <= val_end < test."""
    return df.withColumn("split", split_label(train_end, val_end, date_col))


def split_views(df: DataFrame, train_end: str, val_end: str, date_col=DATE) -> dict[str, DataFrame]:
    """train / val / test / train_val as filtered views (filters reach the
    parquet scan as pushed date predicates)."""
    d = F.col(date_col)
    te, ve = F.lit(train_end).cast("date"), F.lit(val_end).cast("date")
    return {
        "train": df.where(d <= te),
        "val": df.where((d > te) & (d <= ve)),
        "test": df.where(d > ve),
        "train_val": df.where(d <= ve),
    }


def split_counts(df: DataFrame, train_end: str, val_end: str, key=KEY, date_col=DATE) -> DataFrame:
    """Rows, date range and series count per split (one aggregate)."""
    return chronological_split(df, train_end, val_end, date_col).groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(date_col).alias("min_date"), F.max(date_col).alias("max_date"),
        F.count_distinct(key).alias("n_series"))


def to_long_format(df: DataFrame, key=KEY, date_col=DATE, target=TARGET,
                   floats: Sequence[str] = ("store_type_enc", "cluster", "oil_price", "is_national_holiday",
                                            "is_day_before_holiday", "is_day_after_holiday")) -> DataFrame:
    """(unique_id string, ds, y, float32 exogenous columns)."""
    return df.select(F.col(key).cast("string").alias("unique_id"), F.col(date_col).alias("ds"),
                     F.col(target).alias("y"), *[F.col(c).cast("float").alias(c) for c in floats])


def static_table(df: DataFrame, key=KEY, cols: Sequence[str] = ("store_type_enc", "cluster")) -> DataFrame:
    """One row per series with its static columns as float32."""
    return df.select(key, *cols).dropDuplicates([key]).select(
        F.col(key).cast("string").alias("unique_id"), *[F.col(c).cast("float").alias(c) for c in cols])
