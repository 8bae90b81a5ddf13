"""Registered feature queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from panelcast.operators.checks import null_profile
from panelcast.operators.exogenous import add_holiday_features, add_oil_features, add_store_features, ffill_global
from panelcast.operators.features import (
    add_cyclical_time_features,
    add_difference_features,
    add_historical_benchmarks,
    add_lag,
    add_momentum_features,
    add_ratio_features,
    add_rolling_mean,
    drop_warmup,
)
from panelcast.plans.catalog import register
from panelcast.plans.feature_pipeline import (
    LAGS,
    ROLLING_WINDOWS,
    build_features,
    build_final_dataset,
    build_final_dataset_in_chunks,
)
from panelcast.plans.refresh import read_final_dataset, refresh_final_dataset
from panelcast.session import checkpoint_dir
from panelcast.sources.fixtures import TRAIN_END, VAL_END, panel, with_views
from panelcast.sources.io import staged

W = "WINDOW w AS (PARTITION BY store_nbr ORDER BY date)"


def _lags_sql(lags=LAGS):
    return ", ".join(f"lag(transactions, {n}) OVER w AS lag_{n}" for n in lags)


def _roll_sql(n, col="transactions", lo=None, hi=1, name=None):
    lo = n if lo is None else lo
    hi_s = "CURRENT ROW" if hi == 0 else f"{hi} PRECEDING"
    fr = f"(w ROWS BETWEEN {lo} PRECEDING AND {hi_s})"
    name = name or f"rolling_mean_{n}_days"
    return f"CASE WHEN count({col}) OVER {fr} = {n} THEN avg({col}) OVER {fr} END AS {name}"


CALENDAR_SQL = """CAST(month(date) AS INTEGER) AS month, CAST(isodow(date) AS INTEGER) AS weekday,
  CAST(quarter(date) AS INTEGER) AS quarter,
  sin(isodow(date) * (2 * pi() / 7)) AS weekday_sin, cos(isodow(date) * (2 * pi() / 7)) AS weekday_cos,
  sin(month(date) * (2 * pi() / 12)) AS month_sin, cos(month(date) * (2 * pi() / 12)) AS month_cos"""
CAL_DOUBLES = ["weekday_sin", "weekday_cos", "month_sin", "month_cos"]

STORE_FEAT_CTE = """sf AS (
  SELECT store_nbr, CAST(CASE type WHEN 'A' THEN 5 WHEN 'B' THEN 4 WHEN 'C' THEN 3 WHEN 'D' THEN 2
                               WHEN 'E' THEN 1 END AS INTEGER) AS store_type_enc, cluster
  FROM stores
)"""

NAT_CTE = """nat AS (
  SELECT date, type AS hol_type_national FROM holidays WHERE locale = 'National' AND transferred = false
)"""


def _tx(spark, d):
    return panel(spark, d).tx


def _final(spark, d):
    """Final feature dataset of a table folder (lazy plan)."""
    p = panel(spark, d)
    return build_final_dataset(p.tx, p.stores, p.oil, p.holidays)


@register("lag_features", with_views(f"SELECT store_nbr, date, transactions, {_lags_sql()} FROM tx {W}"))
def lag_features(spark, d):
    """Row-based lags 1, 7, 14, 21, 28 per series."""
    return add_lag(_tx(spark, d), LAGS)


@register(
    "rolling_mean_features",
    with_views("SELECT store_nbr, date, transactions, "
               + ", ".join(_roll_sql(n) for n in ROLLING_WINDOWS) + f" FROM tx {W}"),
    doubles=[f"rolling_mean_{n}_days" for n in ROLLING_WINDOWS],
)
def rolling_mean_features(spark, d):
    """Mean of the previous 7/14/28 rows, null until the window is full."""
    return add_rolling_mean(_tx(spark, d), ROLLING_WINDOWS)


@register(
    "momentum_features",
    with_views("SELECT store_nbr, date, transactions, "
               "transactions / nullif(lag(transactions, 7) OVER w, 0) - 1 AS wow_growth, "
               "transactions / nullif(lag(transactions, 28) OVER w, 0) - 1 AS mom_growth "
               f"FROM tx {W}"),
    doubles=["wow_growth", "mom_growth"],
)
def momentum_features(spark, d):
    return add_momentum_features(_tx(spark, d))


@register(
    "benchmark_features",
    with_views("SELECT store_nbr, date, transactions, CAST(year(date) AS INTEGER) AS year, "
               "CAST(month(date) AS INTEGER) AS month, "
               "lag(transactions, 7) OVER w AS same_weekday_last_week, "
               f"lag(transactions, 28) OVER w AS same_weekday_4weeks_ago FROM tx {W}"),
)
def benchmark_features(spark, d):
    return add_historical_benchmarks(_tx(spark, d))


@register(
    "ratio_features",
    with_views(
        "SELECT store_nbr, date, transactions, transactions / nullif(rolling_mean_7_days, 0) AS sales_vs_week_avg, "
        "lag_7 / nullif(rolling_mean_28_days, 0) AS wow_vs_month_avg FROM r",
        f"r AS (SELECT *, lag(transactions, 7) OVER w AS lag_7, {_roll_sql(7)}, {_roll_sql(28)} FROM tx {W})",
    ),
    doubles=["sales_vs_week_avg", "wow_vs_month_avg"],
)
def ratio_features(spark, d):
    df = add_rolling_mean(add_lag(_tx(spark, d), [7]), [7, 28])
    return add_ratio_features(df).select("store_nbr", "date", "transactions", "sales_vs_week_avg", "wow_vs_month_avg")


@register(
    "difference_features",
    with_views("SELECT store_nbr, date, transactions, "
               + ", ".join(f"transactions - lag(transactions, {n}) OVER w AS diff_{n}" for n in (1, 7, 28))
               + f" FROM tx {W}"),
)
def difference_features(spark, d):
    return add_difference_features(_tx(spark, d))


@register(
    "cyclical_time_features",
    with_views(f"SELECT store_nbr, date, transactions, {CALENDAR_SQL} FROM tx"),
    doubles=CAL_DOUBLES,
)
def cyclical_time_features(spark, d):
    return add_cyclical_time_features(_tx(spark, d))


OIL_SQL_CTES = (
    "o1 AS (SELECT tx.*, oil.dcoilwtico FROM tx LEFT JOIN oil USING (date))",
    "o2 AS (SELECT * EXCLUDE (dcoilwtico), last_value(dcoilwtico IGNORE NULLS) OVER "
    "(PARTITION BY store_nbr ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS oil_price FROM o1)",
)


@register(
    "oil_features",
    with_views(f"SELECT *, {_roll_sql(7, 'oil_price', 6, 0, 'oil_price_ma7')} FROM o2 {W}", *OIL_SQL_CTES),
    doubles=["oil_price", "oil_price_ma7"],
)
def oil_features(spark, d):
    """Oil quote joined on date, forward filled over the series' rows, 7-row mean."""
    p = panel(spark, d)
    return add_oil_features(p.tx, p.oil)


HOLIDAY_SELECT = """SELECT t.*, coalesce(n.hol_type_national, 'none') AS hol_type_national,
  n.hol_type_national IS NOT NULL AS is_national_holiday,
  coalesce((t.date + 1) IN (SELECT date FROM nat), false) AS is_day_before_holiday,
  coalesce((t.date - 1) IN (SELECT date FROM nat), false) AS is_day_after_holiday,
  coalesce((t.date + 1) IN (SELECT date FROM nat), false) OR coalesce((t.date - 1) IN (SELECT date FROM nat), false)
    AS is_holiday_window
FROM {src} t LEFT JOIN nat n ON t.date = n.date"""


@register("holiday_features", with_views(HOLIDAY_SELECT.format(src="tx"), NAT_CTE))
def holiday_features(spark, d):
    """National, not transferred holidays: flag, type, day before/after; rows
    repeat on dates with several national holidays."""
    p = panel(spark, d)
    return add_holiday_features(p.tx, p.holidays)


@register(
    "store_features",
    with_views("SELECT tx.*, sf.store_type_enc, sf.cluster FROM tx LEFT JOIN sf USING (store_nbr)", STORE_FEAT_CTE),
)
def store_features(spark, d):
    p = panel(spark, d)
    return add_store_features(p.tx, p.stores)


# Full pipeline in SQL, same step order as build_features.
FEATURES_CTES = (
    STORE_FEAT_CTE,
    NAT_CTE,
    "f0 AS (SELECT tx.*, sf.store_type_enc, sf.cluster FROM tx LEFT JOIN sf USING (store_nbr))",
    f"""f1 AS (SELECT *, {CALENDAR_SQL}, CAST(year(date) AS INTEGER) AS year, {_lags_sql()},
  {', '.join(_roll_sql(n) for n in ROLLING_WINDOWS)},
  transactions / nullif(lag(transactions, 7) OVER w, 0) - 1 AS wow_growth,
  transactions / nullif(lag(transactions, 28) OVER w, 0) - 1 AS mom_growth,
  lag(transactions, 7) OVER w AS same_weekday_last_week,
  lag(transactions, 28) OVER w AS same_weekday_4weeks_ago,
  transactions - lag(transactions, 1) OVER w AS diff_1,
  transactions - lag(transactions, 7) OVER w AS diff_7,
  transactions - lag(transactions, 28) OVER w AS diff_28
FROM f0 {W})""",
    """f2 AS (SELECT *, transactions / nullif(rolling_mean_7_days, 0) AS sales_vs_week_avg,
  lag_7 / nullif(rolling_mean_28_days, 0) AS wow_vs_month_avg FROM f1)""",
    "f3 AS (SELECT f2.*, oil.dcoilwtico FROM f2 LEFT JOIN oil USING (date))",
    "f4 AS (SELECT * EXCLUDE (dcoilwtico), last_value(dcoilwtico IGNORE NULLS) OVER "
    "(PARTITION BY store_nbr ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS oil_price FROM f3)",
    f"f5 AS (SELECT *, {_roll_sql(7, 'oil_price', 6, 0, 'oil_price_ma7')} FROM f4 {W})",
    "f6 AS (" + HOLIDAY_SELECT.format(src="f5") + ")",
)
FEATURE_DOUBLES = CAL_DOUBLES + [f"rolling_mean_{n}_days" for n in ROLLING_WINDOWS] + [
    "wow_growth", "mom_growth", "sales_vs_week_avg", "wow_vs_month_avg", "oil_price", "oil_price_ma7"]
AVG_RANK = ("rank() OVER (PARTITION BY store_nbr ORDER BY date) + "
            "(count(*) OVER (PARTITION BY store_nbr, date) - 1) / 2.0")
FINAL_CTES = FEATURES_CTES + (f"f7 AS (SELECT *, {AVG_RANK} AS _day_rank FROM f6)",)


@register(
    "final_dataset",
    with_views("SELECT * EXCLUDE (_day_rank) FROM f7 WHERE _day_rank > 28", *FINAL_CTES),
    doubles=FEATURE_DOUBLES,
)
def final_dataset(spark, d):
    """Whole feature pipeline with the 28-row warm-up trim (average rank)."""
    return _final(spark, d)


@register(
    "final_dataset_in_chunks",
    with_views("SELECT * EXCLUDE (_day_rank) FROM f7 WHERE _day_rank > 28", *FINAL_CTES),
    doubles=FEATURE_DOUBLES,
)
def final_dataset_in_chunks(spark, d):
    """The same dataset with series cut into chunks with halos (chunks of 256 rows, so every series has several)."""
    p = panel(spark, d)
    return build_final_dataset_in_chunks(p.tx, p.stores, p.oil, p.holidays, chunk_rows=256)


@register(
    "final_dataset_refreshed",
    with_views("SELECT * EXCLUDE (_day_rank) FROM f7 WHERE _day_rank > 28", *FINAL_CTES),
    doubles=FEATURE_DOUBLES,
)
def final_dataset_refreshed(spark, d):
    """The same dataset by refreshes: the training dates, the validation dates, the rest, and the rest once more."""
    p = panel(spark, d)
    path = f"{checkpoint_dir(spark)}/final-{uuid.uuid4().hex}"
    train, val = (F.lit(x).cast("date") for x in (TRAIN_END, VAL_END))
    tx, oil, holidays = (staged(x, t) for x, t in ((p.tx, "panel"), (p.oil, "oil"), (p.holidays, "holidays")))
    last = tx.where(F.col("date") > val)
    for part in (tx.where(F.col("date") <= train), tx.where((F.col("date") > train) & (F.col("date") <= val)), last, last):
        refresh_final_dataset(spark, path, part, p.stores, oil, holidays)
    return read_final_dataset(spark, path)


@register(
    "warmup_trim",
    with_views("SELECT store_nbr, date, hol_type_national, CAST(_day_rank AS DOUBLE) AS day_rank FROM h "
               "WHERE _day_rank > 28",
               NAT_CTE, "h0 AS (" + HOLIDAY_SELECT.format(src="tx") + ")",
               f"h AS (SELECT *, {AVG_RANK} AS _day_rank FROM h0)"),
    doubles=["day_rank"],
)
def warmup_trim(spark, d):
    """Average-rank warm-up trim on the holiday-expanded panel (ties present)."""
    p = panel(spark, d)
    h = add_holiday_features(p.tx, p.holidays)
    return drop_warmup(h, 28, keep_rank=True).select("store_nbr", "date", "hol_type_national", "day_rank")


def _feature_columns():
    return ["store_nbr", "date", "transactions", "store_type_enc", "cluster", "month", "weekday", "quarter",
            "weekday_sin", "weekday_cos", "month_sin", "month_cos", "lag_1", "lag_7", "lag_14", "lag_21",
            "lag_28", "rolling_mean_7_days", "rolling_mean_14_days", "rolling_mean_28_days", "wow_growth",
            "mom_growth", "year", "same_weekday_last_week", "same_weekday_4weeks_ago", "sales_vs_week_avg",
            "wow_vs_month_avg", "diff_1", "diff_7", "diff_28", "oil_price", "oil_price_ma7",
            "hol_type_national", "is_national_holiday", "is_day_before_holiday", "is_day_after_holiday",
            "is_holiday_window"]


@register(
    "null_profile",
    with_views(
        "SELECT column_name, null_count FROM ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, CAST(count(*) - count(\"{c}\") AS BIGINT) AS null_count FROM f6"
            for c in _feature_columns()
        )
        + ") u",
        *FEATURES_CTES,
    ),
)
def null_profile_q(spark, d):
    """Null count per column of the feature table before the warm-up trim."""
    p = panel(spark, d)
    return null_profile(build_features(p.tx, p.stores, p.oil, p.holidays), _feature_columns())


@register(
    "oil_ffill_global",
    with_views("SELECT date, dcoilwtico, last_value(dcoilwtico IGNORE NULLS) OVER "
               "(ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS oil_filled FROM oil"),
    doubles=["dcoilwtico", "oil_filled"],
)
def oil_ffill_global(spark, d):
    """Forward fill of the oil table itself (no key), two-level."""
    return ffill_global(panel(spark, d).oil)
