"""Per-series window features.

Every operator orders explicitly by date inside ``partitionBy(key)``; lags
are row based (a missing day shifts them in calendar terms, as in the
reference). All operators that share the key produce window expressions with
one partition/order spec, so Catalyst plans a single exchange on the key for
the whole feature chain.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions.core import (
    as_list,
    iso_weekday,
    require_columns,
    safe_div,
    series_window,
    sized_broadcast,
)

KEY, DATE, TARGET = "store_nbr", "date", "transactions"


def add_lag(df: DataFrame, lags: Sequence[int], group_col=KEY, target_col=TARGET, date_col=DATE) -> DataFrame:
    """``lag_<n>`` = target n rows earlier in the same series."""
    require_columns(df, as_list(group_col) + [target_col, date_col], "add_lag")
    w = series_window(group_col, date_col)
    return df.withColumns({f"lag_{n}": F.lag(target_col, n).over(w) for n in lags})


def guarded_mean(col: str, w, lo: int, hi: int, size: int):
    """Mean over rows [lo, hi] of ``w``; null unless all ``size`` rows are non-null."""
    f = w.rowsBetween(lo, hi)
    return F.when(F.count(col).over(f) == size, F.avg(col).over(f))


def add_rolling_mean(df: DataFrame, window_sizes: Sequence[int], group_col=KEY, target_col=TARGET,
                     date_col=DATE) -> DataFrame:
    """``rolling_mean_<w>_days``: mean of the previous w rows (current row excluded)."""
    require_columns(df, as_list(group_col) + [target_col, date_col], "add_rolling_mean")
    w = series_window(group_col, date_col)
    return df.withColumns({
        f"rolling_mean_{n}_days": guarded_mean(target_col, w, -n, -1, n) for n in window_sizes
    })


def add_momentum_features(df: DataFrame, over=KEY, target_col=TARGET, date_col=DATE) -> DataFrame:
    """``wow_growth`` = y / y[t-7] - 1, ``mom_growth`` = y / y[t-28] - 1 (null on zero)."""
    w = series_window(over, date_col)
    y = F.col(target_col)
    return df.withColumns({
        "wow_growth": safe_div(y, F.lag(target_col, 7).over(w)) - 1,
        "mom_growth": safe_div(y, F.lag(target_col, 28).over(w)) - 1,
    })


def add_cyclical_time_features(df: DataFrame, date_col=DATE) -> DataFrame:
    """month, ISO weekday (1..7), quarter, and sin/cos of weekday and month."""
    d = F.col(date_col)
    wd, mo = iso_weekday(d), F.month(d)
    k7, k12 = 2 * math.pi / 7, 2 * math.pi / 12
    return df.withColumns({
        "month": mo,
        "weekday": wd,
        "quarter": F.quarter(d),
        "weekday_sin": F.sin(wd * k7),
        "weekday_cos": F.cos(wd * k7),
        "month_sin": F.sin(mo * k12),
        "month_cos": F.cos(mo * k12),
    })


def add_historical_benchmarks(df: DataFrame, over_cols=(KEY,), target_col=TARGET, date_col=DATE) -> DataFrame:
    """year, month, same weekday one and four weeks earlier (lags 7 and 28)."""
    w = series_window(list(over_cols) if not isinstance(over_cols, str) else over_cols, date_col)
    return df.withColumns({
        "year": F.year(date_col),
        "month": F.month(date_col),
        "same_weekday_last_week": F.lag(target_col, 7).over(w),
        "same_weekday_4weeks_ago": F.lag(target_col, 28).over(w),
    })


def add_ratio_features(df: DataFrame, target_col=TARGET) -> DataFrame:
    """Current value vs. the weekly mean, and lag 7 vs. the 28-day mean."""
    require_columns(df, [target_col, "rolling_mean_7_days", "lag_7", "rolling_mean_28_days"], "add_ratio_features")
    return df.withColumns({
        "sales_vs_week_avg": safe_div(target_col, "rolling_mean_7_days"),
        "wow_vs_month_avg": safe_div("lag_7", "rolling_mean_28_days"),
    })


def add_difference_features(df: DataFrame, group_col=KEY, target_col=TARGET, date_col=DATE,
                            lags: Sequence[int] = (1, 7, 28)) -> DataFrame:
    """``diff_<n>`` = y - y[t-n]."""
    w = series_window(group_col, date_col)
    y = F.col(target_col)
    return df.withColumns({f"diff_{n}": y - F.lag(target_col, n).over(w) for n in lags})


def drop_warmup(df: DataFrame, n: int = 28, group_col=KEY, date_col=DATE, keep_rank: bool = False) -> DataFrame:
    """Keep rows whose *average* rank of date within the series exceeds ``n``.

    Average rank = min rank + (ties - 1) / 2; ties only arise from rows that a
    calendar join repeated. Same key partitioning as the features: no new
    exchange.
    """
    keys = as_list(group_col)
    w = series_window(keys, date_col)
    ties = F.count(F.lit(1)).over(Window.partitionBy(*keys, date_col))
    avg_rank = F.rank().over(w).cast("double") + (ties - 1) / 2.0
    out = df.withColumn("_day_rank", avg_rank).where(F.col("_day_rank") > n)
    return out.withColumnRenamed("_day_rank", "day_rank") if keep_rank else out.drop("_day_rank")


def normalise_by_mean(df: DataFrame, group_col=KEY, target_col=TARGET, out_col="tx_normalized") -> DataFrame:
    """Target divided by its series mean (per-series mean aggregated with
    map-side partial aggregation, then joined back; size-checked broadcast)."""
    keys = as_list(group_col)
    m = df.groupBy(*keys).agg(F.avg(target_col).alias("_m"))
    return df.join(sized_broadcast(m), keys, "inner").withColumn(
        out_col, safe_div(F.col(target_col), F.col("_m"))).drop("_m")


def keep_long_series(df: DataFrame, min_rows: int = 1000, group_col=KEY) -> DataFrame:
    """Keep series with more than ``min_rows`` rows (count per series, then a
    semi join; no UDF, no whole-series window)."""
    keys = as_list(group_col)
    long = df.groupBy(*keys).count().where(F.col("count") > min_rows).select(*keys)
    return df.join(sized_broadcast(long), keys, "left_semi")
