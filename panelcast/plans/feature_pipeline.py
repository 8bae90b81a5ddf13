"""The feature pipeline in the reference's step order.

    store features -> calendar -> lags -> rolling means -> momentum ->
    benchmarks -> ratios -> differences -> oil -> holidays -> warm-up trim

Physical plan: the fact is scanned once, all window expressions share
``partitionBy(key).orderBy(date)`` (one hash exchange on the key), and the
store / oil / holiday tables are size-checked broadcasts, so the joins after
the exchange keep its partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions.core import series_window, sized_broadcast
from panelcast.operators import hot_series as H
from panelcast.operators.checks import assert_no_nulls
from panelcast.operators.exogenous import add_holiday_features, add_oil_features, add_store_features
from panelcast.operators.features import (
    add_cyclical_time_features,
    add_difference_features,
    add_historical_benchmarks,
    add_lag,
    add_momentum_features,
    add_ratio_features,
    add_rolling_mean,
    drop_warmup,
    guarded_mean,
)
from panelcast.sources.io import staged

# Fixed values (must equal the reference): feature lists and windows.
LAGS = [1, 7, 14, 21, 28]
ROLLING_WINDOWS = [7, 14, 28]
WARMUP_ROWS = 28

FEATURE_COLS = [
    "store_type_enc", "cluster",
    "month", "weekday", "quarter",
    "weekday_sin", "weekday_cos", "month_sin", "month_cos", "year",
    "lag_1", "lag_7", "lag_14", "lag_21", "lag_28",
    "rolling_mean_7_days", "rolling_mean_14_days", "rolling_mean_28_days",
    "wow_growth", "mom_growth",
    "same_weekday_last_week", "same_weekday_4weeks_ago",
    "sales_vs_week_avg", "wow_vs_month_avg",
    "diff_1", "diff_7", "diff_28",
    "oil_price", "oil_price_ma7",
    "is_national_holiday", "is_day_before_holiday",
    "is_day_after_holiday", "is_holiday_window",
]
# Features that contain the current target (y = lag_1 + diff_1 etc.); the
# ex-ante list drops them and is the default input of the models.
LEAKY_COLS = ["wow_growth", "mom_growth", "sales_vs_week_avg", "diff_1", "diff_7", "diff_28"]
FEATURES_EX_ANTE = [c for c in FEATURE_COLS if c not in LEAKY_COLS]
STAT_EXOG = ["store_type_enc", "cluster"]
HIST_EXOG = ["oil_price", "is_national_holiday", "is_day_before_holiday", "is_day_after_holiday"]
EXOG_COLS = ["oil_price", "is_national_holiday", "is_day_before_holiday", "is_day_after_holiday"]
CAT_COLS = ["hol_type_national"]


def build_features(tx: DataFrame, stores: DataFrame, oil: DataFrame, holidays: DataFrame,
                   dedupe_holidays: bool = False) -> DataFrame:
    """All features, before the warm-up trim."""
    return (
        tx.transform(add_store_features, stores)
        .transform(add_cyclical_time_features)
        .transform(add_lag, lags=LAGS)
        .transform(add_rolling_mean, window_sizes=ROLLING_WINDOWS)
        .transform(add_momentum_features)
        .transform(add_historical_benchmarks)
        .transform(add_ratio_features)
        .transform(add_difference_features)
        .transform(add_oil_features, oil)
        .transform(add_holiday_features, holidays, dedupe=dedupe_holidays)
    )


LOOKBACK_ROWS = 28  # no feature reaches further back, but for the oil fill


def add_window_features(df: DataFrame, keys: list[str]) -> DataFrame:
    """The target's features that look back along the series."""
    return (
        df.transform(add_lag, lags=LAGS, group_col=keys)
        .transform(add_rolling_mean, window_sizes=ROLLING_WINDOWS, group_col=keys)
        .transform(add_momentum_features, over=keys)
        .transform(add_historical_benchmarks, over_cols=keys)
        .transform(add_ratio_features)
        .transform(add_difference_features, group_col=keys)
    )


def build_final_dataset_in_chunks(tx: DataFrame, stores: DataFrame, oil: DataFrame, holidays: DataFrame,
                                  warmup: int = WARMUP_ROWS, chunk_rows: int = H.CHUNK_ROWS, key: str = "store_nbr",
                                  date_col: str = "date") -> DataFrame:
    """``build_final_dataset`` with every series spread over tasks: the same rows, no task that grows with a series."""
    if warmup > chunk_rows:
        raise ValueError("the warm-up must end within the first chunk")
    numbers = H.row_numbers(staged(tx, "panel"), key, date_col, part=F.trunc(F.col(date_col), "year"))
    quotes = staged(numbers.join(sized_broadcast(oil.select(date_col, "dcoilwtico")), date_col, "left"), "quotes")
    filled = H.fill_in_chunks(quotes, "dcoilwtico", "oil_price", key, chunk_rows).drop("dcoilwtico")

    def build(df: DataFrame, keys: list[str]) -> DataFrame:
        return add_window_features(df, keys).withColumn(
            "oil_price_ma7", guarded_mean("oil_price", series_window(keys, date_col), -6, 0, 7))

    featured = H.in_chunks(
        filled.transform(add_store_features, stores).transform(add_cyclical_time_features), build, LOOKBACK_ROWS, key, date_col,
        chunk_rows, numbered=True, keep_chunk=True)
    ranked = drop_warmup(add_holiday_features(featured, holidays), n=0, group_col=[key, H.CHUNK], keep_rank=True)
    return ranked.where((F.col(H.CHUNK) > 0) | (F.col("day_rank") > warmup)).drop(H.CHUNK, "day_rank")


def build_final_dataset(tx: DataFrame, stores: DataFrame, oil: DataFrame, holidays: DataFrame,
                        warmup: int = WARMUP_ROWS, check_nulls: bool = False,
                        dedupe_holidays: bool = False) -> DataFrame:
    """Features, then drop the first ``warmup`` rows (average rank) of each
    series; optionally assert that no column holds a null."""
    df = drop_warmup(build_features(tx, stores, oil, holidays, dedupe_holidays), n=warmup)
    if check_nulls:
        assert_no_nulls(df)
    return df
