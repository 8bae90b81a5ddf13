"""Correlation and autocorrelation.

All correlations use ``safe_corr`` (pairs where both values exist; null for
constant input instead of an ANSI error). ACF at several lags is one window
pass (one exchange on the key) plus one grouped aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.operators.quantiles import exact_quantiles
from panelcast.functions.core import as_list, safe_corr, series_window

KEY, DATE, TARGET = "store_nbr", "date", "transactions"

# Fixed values (must equal the reference): lags inspected for one series and
# across the panel.
ACF_LAGS = [1, 2, 3, 4, 5, 6, 7, 14, 21, 28, 30, 60, 90, 180, 365]
ACF_PANEL_LAGS = [1, 7, 14, 30, 365]


def correlation_with_target(df: DataFrame, cols: Sequence[str], target: str = TARGET) -> DataFrame:
    """(feature, r) for each column against the target, booleans as 0/1.

    Long form: each row is unpivoted to (feature, x, y) and one grouped
    aggregate runs per feature (partial aggregation on the map side, a
    shuffle of features x tasks rows).
    """
    long = df.select(F.col(target).cast("double").alias("_y"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("_x")) for c in cols])).alias("_s"))
    return long.groupBy(F.col("_s.feature").alias("feature")).agg(safe_corr("_s._x", "_y").alias("r"))


def ranked_by_strength(correlations: DataFrame) -> DataFrame:
    """(position, feature, r), strongest first by absolute value (to six places), ties by feature; null correlations come last.

    One row per feature, so the ranking window is bounded by the number of columns.
    """
    strongest = Window.orderBy(F.round(F.abs("r"), 6).desc_nulls_last(), "feature")
    return correlations.select(F.row_number().over(strongest).alias("position"), "feature", "r").orderBy("position")


def acf(df: DataFrame, lags: Sequence[int] = ACF_LAGS, key=KEY, date_col=DATE, target=TARGET) -> DataFrame:
    """Autocorrelation of each series at each lag: corr(y[t], y[t-lag]) over
    overlapping rows (row based). Returns (key, lag, n, acf); ``n`` is the
    series length. One window pass for all lags, then a long-form grouped
    aggregate per (key, lag)."""
    w = series_window(key, date_col)
    k = as_list(key)
    y = F.col(target).cast("double")
    lagged = df.select(*k, y.alias("_y"), *[F.lag(target, n).over(w).cast("double").alias(f"_l{n}") for n in lags])
    pairs = lagged.select(*k, "_y", F.explode(F.array(*[
        F.struct(F.lit(n).alias("lag"), F.col(f"_l{n}").alias("_l")) for n in lags])).alias("_s"))
    return pairs.groupBy(*k, F.col("_s.lag").alias("lag")).agg(
        F.count(F.lit(1)).alias("n"), safe_corr("_y", "_s._l").alias("acf")).select(*k, "n", "lag", "acf")


def acf_panel(df: DataFrame, lags: Sequence[int] = ACF_PANEL_LAGS, min_rows: int = 400, key=KEY,
              date_col=DATE, target=TARGET) -> DataFrame:
    """ACF per series for series with at least ``min_rows`` rows, and only
    for lags shorter than the series."""
    a = acf(df, lags, key, date_col, target)
    return a.where((F.col("n") >= min_rows) & (F.col("n") > F.col("lag"))).drop("n")


def acf_summary(panel_acf: DataFrame) -> DataFrame:
    """Median, min and max ACF over series per lag."""
    ends = panel_acf.groupBy("lag").agg(F.min("acf").alias("min"), F.max("acf").alias("max"))
    return ends.join(exact_quantiles(panel_acf, "lag", "acf", {"median": 0.5}), "lag", "left").select(
        "lag", "median", "min", "max")
