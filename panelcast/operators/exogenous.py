"""Dimension, exogenous and calendar enrichment.

All right-hand tables here are bounded by the number of stores or calendar
days; they are broadcast behind ``sized_broadcast`` and fall back to a
shuffle join above the bound.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions.core import (
    require_columns,
    series_window,
    sized_broadcast,
    store_type_code,
)
from panelcast.operators.features import guarded_mean

KEY, DATE = "store_nbr", "date"


def enrich_stores(df: DataFrame, stores_df: DataFrame, key=KEY) -> DataFrame:
    """Fact left join store dimension on the key."""
    return df.join(sized_broadcast(stores_df), on=key, how="left")


def add_store_features(df: DataFrame, stores_df: DataFrame, key=KEY) -> DataFrame:
    """``store_type_enc`` (A=5 .. E=1, byte) and ``cluster`` from the store table."""
    require_columns(stores_df, [key, "type", "cluster"], "add_store_features")
    feat = stores_df.select(key, store_type_code("type").alias("store_type_enc"), "cluster")
    return df.join(sized_broadcast(feat), on=key, how="left")


def add_oil_features(df: DataFrame, oil_df: DataFrame, group_col=KEY, date_col=DATE,
                     value_col="dcoilwtico") -> DataFrame:
    """Join the daily quote on date, forward fill it over the series' own rows
    (``oil_price``), and its 7-row mean including the current row
    (``oil_price_ma7``, null until 7 filled values exist).

    A quote on a day without a row of the series is never seen (fill after
    the join, not an as-of join); leading nulls stay null.
    """
    oil = oil_df.select(date_col, value_col)
    j = df.join(sized_broadcast(oil), on=date_col, how="left")
    w = series_window(group_col, date_col)
    filled = j.withColumn(
        "oil_price", F.last(value_col, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    ).drop(value_col)
    return filled.withColumn("oil_price_ma7", guarded_mean("oil_price", w, -6, 0, 7))


def national_holidays(hol_df: DataFrame, locale: str = "National") -> DataFrame:
    """Holiday rows of one locale that were not transferred away (null
    ``transferred`` is dropped, like ``x == False``)."""
    return hol_df.where((F.col("locale") == locale) & (F.col("transferred") == F.lit(False))).select(
        "date", F.col("type").alias("hol_type_national")
    )


def transferred_holidays(hol_df: DataFrame) -> DataFrame:
    """Holiday rows that were moved to another day (filter on the flag; null is not true)."""
    return hol_df.where(F.col("transferred"))


def holiday_rows(df: DataFrame, date_col=DATE, target: str = "transactions", key=KEY) -> DataFrame:
    """Rows of a holiday or of the day before or after one (OR of the flags of ``add_holiday_features``)."""
    return df.where(F.col("is_national_holiday") | F.col("is_holiday_window")).select(
        date_col, key, target, "is_national_holiday", "is_day_before_holiday", "is_day_after_holiday", "hol_type_national")


def add_holiday_features(df: DataFrame, hol_df: DataFrame, date_col=DATE, locale: str = "National",
                         dedupe: bool = False) -> DataFrame:
    """Holiday flags and the national holiday type.

    Left join on date: a date with several national rows repeats the fact
    row (reference behaviour; ``dedupe=True`` keeps one row per date with the
    smallest type). Day-before/after flags test membership of date +/- 1 in
    the holiday dates and never multiply rows. Types and flags are folded
    into one small calendar table, so the fact is joined once (broadcast).
    """
    nat = national_holidays(hol_df, locale).withColumnRenamed("date", date_col)
    if dedupe:
        nat = nat.groupBy(date_col).agg(F.min("hol_type_national").alias("hol_type_national"))
    # day-before / day-after flags per calendar date, from the holiday dates
    flags = nat.select(F.explode(F.array(
        F.struct(F.date_sub(F.col(date_col), 1).alias("d"), F.lit(True).alias("b"), F.lit(False).alias("a")),
        F.struct(F.date_add(F.col(date_col), 1).alias("d"), F.lit(False).alias("b"), F.lit(True).alias("a")),
    )).alias("_f")).groupBy(F.col("_f.d").alias(date_col)).agg(
        F.max("_f.b").alias("is_day_before_holiday"), F.max("_f.a").alias("is_day_after_holiday"))
    # one calendar table: a row per holiday row (fan-out kept) or per flag-only
    # date; built from a left join and an anti join (both broadcastable)
    cal = nat.join(sized_broadcast(flags), date_col, "left").unionByName(
        flags.join(sized_broadcast(nat.select(date_col).distinct()), date_col, "left_anti").withColumn(
            "hol_type_national", F.lit(None).cast("string")))
    out = df.join(sized_broadcast(cal), on=date_col, how="left").withColumns({
        "is_national_holiday": F.col("hol_type_national").isNotNull(),
        "hol_type_national": F.coalesce(F.col("hol_type_national"), F.lit("none")),
        "is_day_before_holiday": F.coalesce(F.col("is_day_before_holiday"), F.lit(False)),
        "is_day_after_holiday": F.coalesce(F.col("is_day_after_holiday"), F.lit(False)),
    })
    return out.withColumn("is_holiday_window", F.col("is_day_before_holiday") | F.col("is_day_after_holiday"))


def ffill_global(df: DataFrame, date_col=DATE, value_col="dcoilwtico", out_col="oil_filled") -> DataFrame:
    """Forward fill of a dated table without a key, in two levels so that no
    window runs over the whole table in one partition:

    1. per month, the last non-null value (one row per month);
    2. carry it across months (window over the month table, bounded by the
       number of months), join back by month (broadcast, size-checked);
    3. inside each month, fill from the month's own values, else the carry.
    """
    month = F.trunc(F.col(date_col), "month")
    base = df.withColumn("_m", month)
    per_month = base.where(F.col(value_col).isNotNull()).groupBy("_m").agg(
        F.max_by(value_col, date_col).alias("_last")
    )
    months = base.select("_m").distinct().join(per_month, "_m", "left")
    carry = months.select(
        "_m",
        F.last("_last", ignorenulls=True).over(
            Window.orderBy("_m").rowsBetween(Window.unboundedPreceding, -1)
        ).alias("_carry"),
    )
    in_month = F.last(value_col, ignorenulls=True).over(
        Window.partitionBy("_m").orderBy(date_col).rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        base.join(sized_broadcast(carry), "_m", "left")
        .withColumn(out_col, F.coalesce(in_month, F.col("_carry")))
        .drop("_m", "_carry")
    )
