"""Profiling aggregates.

All are single-pass grouped aggregates (partial aggregation before the
shuffle) or aggregate + size-checked broadcast join back, which keeps a hot
key from landing whole in one window task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions.core import as_list, iso_weekday, safe_div, series_window, sized_broadcast
from panelcast.operators.quantiles import exact_quantiles

KEY, DATE, TARGET = "store_nbr", "date", "transactions"


# ---------------------------------------------------------------- counts, sums, means

def days_per_series(df: DataFrame, key=KEY) -> DataFrame:
    return df.groupBy(*as_list(key)).agg(F.count(F.lit(1)).alias("n_days"))


def short_series(df: DataFrame, max_days: int = 500, key=KEY) -> DataFrame:
    """Series with fewer than ``max_days`` rows (HAVING after the count)."""
    return days_per_series(df, key).where(F.col("n_days") < max_days)


def total_by(df: DataFrame, by, target=TARGET, alias="total_transactions") -> DataFrame:
    return df.groupBy(*as_list(by)).agg(F.sum(target).alias(alias))


def mean_by(df: DataFrame, by, target=TARGET, alias="avg", digits: int | None = None) -> DataFrame:
    m = F.avg(target)
    return df.groupBy(*as_list(by)).agg((F.round(m, digits) if digits is not None else m).alias(alias))


def with_calendar(df: DataFrame, date_col=DATE) -> DataFrame:
    """weekday (ISO), month, year columns used by the grouped means."""
    return df.withColumns({"weekday": iso_weekday(date_col), "month": F.month(date_col), "year": F.year(date_col)})


def month_start(date_col=DATE):
    return F.trunc(F.col(date_col), "month")


def monthly_mean(df: DataFrame, date_col=DATE, target=TARGET, alias="avg_transactions") -> DataFrame:
    return df.groupBy(month_start(date_col).alias("month")).agg(F.avg(target).alias(alias))


def monthly_count(df: DataFrame, date_col=DATE, alias="n_holidays") -> DataFrame:
    return df.groupBy(month_start(date_col).alias("month")).agg(F.count(F.lit(1)).alias(alias))


def monthly_mean_vs_holidays(tx: DataFrame, holidays: DataFrame, locale="National") -> DataFrame:
    """Monthly target mean with the month's count of holiday rows (0 if none)."""
    cnt = monthly_count(holidays.where(F.col("locale") == locale))
    return monthly_mean(tx).join(sized_broadcast(cnt), "month", "left").withColumn(
        "n_holidays", F.coalesce(F.col("n_holidays"), F.lit(0).cast("bigint"))
    )


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join on keys where null equals null; the key columns of ``left`` stay."""
    named = right.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *[c for c in right.columns if c not in keys])
    on = F.lit(True)
    for i, k in enumerate(keys):
        on &= F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return left.join(named, on, "left").drop(*[f"_k{i}" for i in range(len(keys))])


def stats_by(df: DataFrame, by, target=TARGET, digits: int = 1) -> DataFrame:
    """mean, sample std and exact median per group, rounded."""
    keys = as_list(by)
    basic = df.groupBy(*keys).agg(
        F.round(F.avg(target), digits).alias("mean"), F.round(F.stddev_samp(target), digits).alias("std"))
    median = exact_quantiles(df, keys, target, {"median": 0.5}).withColumn("median", F.round("median", digits))
    return _null_safe_join(basic, median, keys)


QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def describe(df: DataFrame, col=TARGET, method: str = "linear") -> DataFrame:
    """count, null count, mean, sample std, min, quartiles, max (one row).

    ``method``: ``"linear"`` exact interpolated quartiles; ``"nearest"`` the
    element at index round((n - 1) * p) of the sorted values (the reference's
    describe); ``"approx"`` one pass with ``percentile_approx``.
    """
    c = F.col(col)
    quick = [F.percentile_approx(c, F.lit(p), 10000).cast("double").alias(n) for n, p in QUARTILES.items()]
    basic = df.agg(
        F.count(c).alias("count"), F.count_if(c.isNull()).alias("null_count"), F.avg(c).alias("mean"),
        F.stddev_samp(c).alias("std"), F.min(c).cast("double").alias("min"), *(quick if method == "approx" else []),
        F.max(c).cast("double").alias("max"))
    if method != "approx":
        basic = basic.join(exact_quantiles(df, [], col, QUARTILES, method), F.lit(True), "left")  # one row each
    return basic.select("count", "null_count", "mean", "std", "min", *QUARTILES, "max")


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))


def top_k(df: DataFrame, k: int, *order) -> DataFrame:
    """Top-k with a total order (TakeOrderedAndProject: no global sort)."""
    return df.orderBy(*order).limit(k)


def date_range(df: DataFrame, date_col=DATE, key=KEY) -> DataFrame:
    return df.agg(
        F.min(date_col).alias("min_date"), F.max(date_col).alias("max_date"),
        F.count_distinct(*as_list(key)).alias("n_series"), F.count(F.lit(1)).alias("n_rows"),
    )


# ---------------------------------------------------------------- gaps

def missing_rows(df: DataFrame, key=KEY, date_col=DATE) -> DataFrame:
    """(date, key) cells of the grid "distinct dates x distinct keys" that
    have no row, enumerated from each series' own gaps: the calendar days
    between consecutive dates of a series (and after its last date) that are
    dates of the panel. No cross product and no global numbering: work and
    output are proportional to the rows plus the missing cells; the panel's
    distinct dates (bounded by the calendar span) are a size-checked
    broadcast."""
    k = as_list(key)
    dates = df.select(date_col).distinct()
    lo, hi = dates.agg(F.min(date_col), F.max(date_col)).first()
    if lo is None:
        return df.select(date_col, *k).limit(0)
    w = Window.partitionBy(*k).orderBy(date_col)
    s = df.select(*k, date_col).distinct().select(
        *k, date_col, F.lag(date_col).over(w).alias("_prev"), F.lead(date_col).over(w).alias("_next"))
    day = F.expr("INTERVAL 1 DAY")
    empty = F.array().cast("array<date>")

    def span(a, b):
        return F.when(a <= b, F.sequence(a, b, day)).otherwise(empty)

    # each row owns the days before it (back to the previous row or the first
    # panel date); the last row of a series also owns the days after it
    before = span(F.coalesce(F.date_add("_prev", 1), F.lit(lo)), F.date_sub(F.col(date_col), 1))
    after = F.when(F.col("_next").isNull(), span(F.date_add(F.col(date_col), 1), F.lit(hi))).otherwise(empty)
    cells = s.select(*k, F.explode(F.concat(before, after)).alias(date_col))
    return cells.join(sized_broadcast(dates), date_col, "left_semi").select(date_col, *k)


def missing_by_series(df: DataFrame, key=KEY, date_col=DATE) -> DataFrame:
    """Missing days per series = distinct dates overall - distinct dates of
    the series (series with at least one gap)."""
    n_dates = df.agg(F.count_distinct(date_col)).first()[0]
    per = df.groupBy(*as_list(key)).agg(F.count_distinct(date_col).alias("_d"))
    return per.select(*as_list(key), (F.lit(n_dates) - F.col("_d")).alias("missing_days")).where(
        F.col("missing_days") > 0)


def missing_rate(df: DataFrame, key=KEY, date_col=DATE) -> DataFrame:
    """Missing cells, grid size and missing share in percent (one row)."""
    k = as_list(key)
    # one distinct of the cells; dates and series are counted from per-series and per-date rows of it
    cells = df.select(*k, date_col).distinct()
    per_series = cells.groupBy(*k).agg(F.count(F.lit(1)).alias("_c")).agg(
        F.count(F.lit(1)).alias("n_series"), F.coalesce(F.sum("_c"), F.lit(0)).alias("n_present"))
    n_dates = cells.select(date_col).distinct().agg(F.count(F.lit(1)).alias("n_dates"))
    return per_series.crossJoin(n_dates).select(  # one row each
        (F.col("n_dates") * F.col("n_series")).alias("n_grid"),
        (F.col("n_dates") * F.col("n_series") - F.col("n_present")).alias("n_missing"),
    ).withColumn("missing_pct", F.col("n_missing") / F.col("n_grid") * 100)


# ---------------------------------------------------------------- outliers, index, pivots

def series_mean_std(df: DataFrame, key=KEY, target=TARGET) -> DataFrame:
    return df.groupBy(*as_list(key)).agg(F.avg(target).alias("mean"), F.stddev_samp(target).alias("std"))


def zscore_outliers(df: DataFrame, threshold: float = 3.0, key=KEY, target=TARGET) -> DataFrame:
    """Rows whose |z| against their series mean and sample std exceeds the
    threshold. Stats are aggregated (partial agg) and joined back."""
    st = series_mean_std(df, key, target)
    j = df.join(sized_broadcast(st), on=key, how="inner")
    z = safe_div(F.col(target) - F.col("mean"), F.col("std"))
    return j.withColumn("z_score", z).where(F.abs(F.col("z_score")) > threshold)


def seasonal_index(df: DataFrame, by="weekday", target=TARGET, digits: int = 1) -> DataFrame:
    """Group mean / mean of the group means x 100 (the grouped result has one
    row per calendar value, so the empty-partition window is bounded)."""
    m = mean_by(df, by, target, "avg")
    return m.withColumn("index", F.round(F.col("avg") / F.avg("avg").over(Window.partitionBy()) * 100, digits))


def pivot_mean(df: DataFrame, row, col, values: Sequence, target=TARGET) -> DataFrame:
    """Mean per (row, col) with one column per listed value (no job looks for the values)."""
    return df.groupBy(*as_list(row)).pivot(col, list(values)).agg(F.avg(target))


def box_stats(df: DataFrame, by, target=TARGET, whisker: float = 1.5, approx: bool = False) -> DataFrame:
    """Quartiles, whiskers (extreme values within 1.5 IQR) and outlier count
    per group: quartile aggregate, broadcast join back, second aggregate."""
    y = F.col(target).cast("double")
    keys, probs = as_list(by), {"q1": 0.25, "median": 0.5, "q3": 0.75}
    if approx:
        quart = df.groupBy(*keys).agg(*[F.percentile_approx(y, F.lit(p), 10000).alias(n) for n, p in probs.items()])
    else:
        quart = exact_quantiles(df, keys, y, probs)
    j = df.join(sized_broadcast(quart), on=by, how="inner")
    lo = F.col("q1") - whisker * (F.col("q3") - F.col("q1"))
    hi = F.col("q3") + whisker * (F.col("q3") - F.col("q1"))
    return j.groupBy(*as_list(by), "q1", "median", "q3").agg(
        F.min(F.when(y >= lo, y)).alias("whisker_lo"),
        F.max(F.when(y <= hi, y)).alias("whisker_hi"),
        F.count_if((y < lo) | (y > hi)).alias("n_outliers"),
        F.count(F.lit(1)).alias("n"),
    )


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Equal-width histogram over [min, max] with all ``bins`` bins (zero
    filled); the last bin is closed. The 1-row min/max is read first and the
    bucket is a literal-only expression."""
    st = df.agg(F.min(col).cast("double").alias("mn"), F.max(col).cast("double").alias("mx")).first()
    mn, mx = st["mn"], st["mx"]
    spark = df.sparkSession
    edges = spark.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    if mn is None:
        return edges.select("bin", F.lit(None).cast("double").alias("bin_lo"),
                            F.lit(None).cast("double").alias("bin_hi"), F.lit(0).cast("bigint").alias("count"))
    width = (mx - mn) / bins
    x = F.col(col).cast("double")
    b = (F.least(F.floor((x - F.lit(mn)) / F.lit(mx - mn) * bins) + 1, F.lit(bins)) if mx > mn
         else F.lit(1)).cast("int")
    cnt = df.where(x.isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    # every bin present: union zero-count bins with the counts and sum per bin
    # (no join; both inputs hold at most ``bins`` rows)
    zero = edges.select("bin", F.lit(0).cast("bigint").alias("count"))
    return cnt.unionByName(zero).groupBy("bin").agg(F.sum("count").alias("count")).select(
        "bin",
        (F.lit(mn) + (F.col("bin") - 1) * F.lit(width)).alias("bin_lo"),
        (F.lit(mn) + F.col("bin") * F.lit(width)).alias("bin_hi"),
        F.col("count").cast("bigint").alias("count"),
    )


# ---------------------------------------------------------------- heterogeneity

def normalised_monthly(df: DataFrame, min_rows: int = 1000, key=KEY, date_col=DATE, target=TARGET) -> DataFrame:
    """Target / series mean, for series with more than ``min_rows`` rows,
    averaged per month and series."""
    st = df.groupBy(*as_list(key)).agg(F.avg(target).alias("_m"), F.count(F.lit(1)).alias("_n"))
    monthly = df.groupBy(month_start(date_col).alias("month"), *as_list(key)).agg(F.avg(target).alias("_a"))
    # mean of (y / m) over a month equals (monthly mean of y) / m: one division per cell
    j = monthly.join(sized_broadcast(st.where(F.col("_n") > min_rows)), on=key, how="inner")
    return j.select("month", *as_list(key), safe_div(F.col("_a"), F.col("_m")).alias("tx_normalized"))


def lag_pairs(df: DataFrame, lag: int = 7, key=KEY, date_col=DATE, target=TARGET) -> DataFrame:
    """(y[t-lag], y[t]) pairs of a series (rows with a lag value)."""
    w = series_window(key, date_col)
    return df.select(date_col, F.lag(target, lag).over(w).alias(f"lag_{lag}"), target).where(
        F.col(f"lag_{lag}").isNotNull())
