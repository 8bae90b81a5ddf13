"""Registered profiling, gap, outlier, correlation and ACF queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.operators import profile as P
from panelcast.operators.correlation import (
    ACF_LAGS,
    ACF_PANEL_LAGS,
    acf,
    acf_panel,
    acf_summary,
    correlation_with_target,
    ranked_by_strength,
)
from panelcast.operators.checks import schema_report as schema_report_op
from panelcast.operators.exogenous import enrich_stores, holiday_rows as holiday_rows_op, transferred_holidays as transferred_op
from panelcast.functions.core import safe_corr
from panelcast.operators.split import split_counts as split_counts_op, static_table as static_table_op, to_long_format
from panelcast.plans.catalog import register
from panelcast.plans.q_features import FINAL_CTES, _final
from panelcast.sources.fixtures import TRAIN_END, VAL_END, panel, with_views

DOW = "CAST(isodow(date) AS INTEGER)"
MON = "CAST(month(date) AS INTEGER)"
YEAR = "CAST(year(date) AS INTEGER)"
TXS = "tx LEFT JOIN stores USING (store_nbr)"
FINAL = FINAL_CTES + ("final AS (SELECT * EXCLUDE (_day_rank) FROM f7 WHERE _day_rank > 28)",)
SINGLE_STORE = 1
YEARS = range(1995, 2002)  # the panel's years
# one-series examples: store 1 where present, else the smallest key
PICK_SQL = ("(SELECT CASE WHEN count(*) FILTER (WHERE store_nbr = 1) > 0 THEN 1 ELSE min(store_nbr) END "
            "FROM tx)")


def pick_series(tx):
    """Store 1 if the panel has it, else the smallest key (one scalar)."""
    return tx.agg(F.coalesce(F.max(F.when(F.col("store_nbr") == SINGLE_STORE, F.col("store_nbr"))),
                             F.min("store_nbr"))).first()[0]


def _tx(spark, d):
    return panel(spark, d).tx


def _txs(spark, d):
    p = panel(spark, d)
    return enrich_stores(p.tx, p.stores)


@register("tx_with_store_meta", with_views(f"SELECT * FROM {TXS}"))
def tx_with_store_meta(spark, d):
    """Fact left join store dimension."""
    return _txs(spark, d)


@register("panel_overview", with_views(
    "SELECT min(date) AS min_date, max(date) AS max_date, count(DISTINCT store_nbr) AS n_series, "
    "count(*) AS n_rows FROM tx"))
def panel_overview(spark, d):
    """Date range, distinct series, row count."""
    return P.date_range(_tx(spark, d))


@register("days_per_series", with_views("SELECT store_nbr, count(*) AS n_days FROM tx GROUP BY 1"))
def days_per_series(spark, d):
    return P.days_per_series(_tx(spark, d))


@register("short_series", with_views("SELECT store_nbr, count(*) AS n_days FROM tx GROUP BY 1 HAVING count(*) < 500"))
def short_series(spark, d):
    """Series with fewer than 500 days."""
    return P.short_series(_tx(spark, d), 500)


@register("daily_total", with_views(
    "SELECT date, CAST(sum(transactions) AS BIGINT) AS total_transactions FROM tx GROUP BY 1"))
def daily_total(spark, d):
    return P.total_by(_tx(spark, d), "date", alias="total_transactions")


@register("daily_mean", with_views("SELECT date, avg(transactions) AS avg_tx FROM tx GROUP BY 1"), doubles=["avg_tx"])
def daily_mean(spark, d):
    return P.mean_by(_tx(spark, d), "date", alias="avg_tx")


@register("mean_by_type", with_views(f"SELECT type, avg(transactions) AS avg_transactions FROM {TXS} GROUP BY 1"),
          doubles=["avg_transactions"])
def mean_by_type(spark, d):
    return P.mean_by(_txs(spark, d), "type", alias="avg_transactions")


@register("mean_by_weekday", with_views(f"SELECT {DOW} AS weekday, avg(transactions) AS avg FROM tx GROUP BY 1"),
          doubles=["avg"])
def mean_by_weekday(spark, d):
    return P.mean_by(P.with_calendar(_tx(spark, d)), "weekday")


@register("mean_by_month", with_views(f"SELECT {MON} AS month, avg(transactions) AS avg FROM tx GROUP BY 1"),
          doubles=["avg"])
def mean_by_month(spark, d):
    return P.mean_by(P.with_calendar(_tx(spark, d)), "month")


@register("mean_by_year", with_views(
    f"SELECT {YEAR} AS year, round(avg(transactions), 1) AS avg_transactions FROM tx GROUP BY 1"),
    doubles=["avg_transactions"])
def mean_by_year(spark, d):
    """Yearly mean rounded to one decimal."""
    return P.mean_by(P.with_calendar(_tx(spark, d)), "year", alias="avg_transactions", digits=1)


@register("mean_year_type", with_views(
    f"SELECT {YEAR} AS year, type, avg(transactions) AS avg FROM {TXS} GROUP BY 1, 2"), doubles=["avg"])
def mean_year_type(spark, d):
    return P.mean_by(P.with_calendar(_txs(spark, d)), ["year", "type"])


@register("mean_month_weekday", with_views(
    f"SELECT {MON} AS month, {DOW} AS weekday, avg(transactions) AS avg FROM tx GROUP BY 1, 2"), doubles=["avg"])
def mean_month_weekday(spark, d):
    return P.mean_by(P.with_calendar(_tx(spark, d)), ["month", "weekday"])


@register("mean_cluster_year", with_views(
    f"SELECT cluster, {YEAR} AS year, avg(transactions) AS avg FROM {TXS} GROUP BY 1, 2"), doubles=["avg"])
def mean_cluster_year(spark, d):
    return P.mean_by(P.with_calendar(_txs(spark, d)), ["cluster", "year"])


@register("monthly_mean_vs_holidays", with_views(
    "SELECT m.month, m.avg_transactions, coalesce(h.n_holidays, 0) AS n_holidays FROM m LEFT JOIN h USING (month)",
    "m AS (SELECT CAST(date_trunc('month', date) AS DATE) AS month, avg(transactions) AS avg_transactions "
    "FROM tx GROUP BY 1)",
    "h AS (SELECT CAST(date_trunc('month', date) AS DATE) AS month, count(*) AS n_holidays FROM holidays "
    "WHERE locale = 'National' GROUP BY 1)"), doubles=["avg_transactions"])
def monthly_mean_vs_holidays(spark, d):
    """Monthly mean target with the month's national holiday count (0 filled)."""
    p = panel(spark, d)
    return P.monthly_mean_vs_holidays(p.tx, p.holidays)


@register("describe_target", with_views(
    "SELECT count(transactions) AS count, count(*) - count(transactions) AS null_count, avg(transactions) AS mean, "
    "stddev_samp(transactions) AS std, CAST(min(transactions) AS DOUBLE) AS min, "
    "quantile_cont(transactions, 0.25) AS p25, quantile_cont(transactions, 0.5) AS p50, "
    "quantile_cont(transactions, 0.75) AS p75, CAST(max(transactions) AS DOUBLE) AS max FROM tx"),
    doubles=["mean", "std", "min", "p25", "p50", "p75", "max"])
def describe_target(spark, d):
    """count, nulls, mean, sample std, min, exact quartiles, max of the target."""
    return P.describe(_tx(spark, d), "transactions")


@register("value_counts_type", with_views("SELECT type, count(*) AS count FROM stores GROUP BY 1"))
def value_counts_type(spark, d):
    return P.value_counts(panel(spark, d).stores, "type")


@register("value_counts_cluster", with_views("SELECT cluster, count(*) AS count FROM stores GROUP BY 1"))
def value_counts_cluster(spark, d):
    return P.value_counts(panel(spark, d).stores, "cluster")


@register("top_cities", with_views(
    "SELECT city, count(*) AS count FROM stores GROUP BY 1 ORDER BY count DESC, city LIMIT 5"))
def top_cities(spark, d):
    """Five most frequent cities (count desc, then name)."""
    vc = P.value_counts(panel(spark, d).stores, "city")
    return P.top_k(vc, 5, F.desc("count"), F.asc("city"))


@register("stats_by_type", with_views(
    f"SELECT type, round(avg(transactions), 1) AS mean, round(stddev_samp(transactions), 1) AS std, "
    f"round(median(transactions), 1) AS median FROM {TXS} GROUP BY 1"), doubles=["mean", "std", "median"])
def stats_by_type(spark, d):
    return P.stats_by(_txs(spark, d), "type")


@register("holiday_type_effect", with_views(
    "SELECT hol_type, round(avg(avg_tx), 1) AS mean, count(*) AS count FROM j GROUP BY 1",
    "d AS (SELECT date, avg(transactions) AS avg_tx FROM tx GROUP BY 1)",
    "n AS (SELECT date, type AS hol_type FROM holidays WHERE locale = 'National')",
    "j AS (SELECT d.date, d.avg_tx, coalesce(n.hol_type, 'Normal') AS hol_type FROM d LEFT JOIN n USING (date))"),
    doubles=["mean"])
def holiday_type_effect(spark, d):
    """Daily mean target by national holiday type ('Normal' for other days)."""
    from panelcast.functions.core import sized_broadcast
    p = panel(spark, d)
    daily = P.mean_by(p.tx, "date", alias="avg_tx")
    nat = p.holidays.where(F.col("locale") == "National").select("date", F.col("type").alias("hol_type"))
    j = daily.join(sized_broadcast(nat), "date", "left").withColumn(
        "hol_type", F.coalesce(F.col("hol_type"), F.lit("Normal")))
    return j.groupBy("hol_type").agg(F.round(F.avg("avg_tx"), 1).alias("mean"), F.count(F.lit(1)).alias("count"))


@register("missing_rows", with_views(
    "SELECT g.date, g.store_nbr FROM g ANTI JOIN tx USING (date, store_nbr)",
    "g AS (SELECT * FROM (SELECT DISTINCT date FROM tx) a CROSS JOIN (SELECT DISTINCT store_nbr FROM tx) b)"))
def missing_rows(spark, d):
    """Grid cells (distinct dates x series) without a row, from series gaps."""
    return P.missing_rows(_tx(spark, d))


@register("missing_by_series", with_views(
    "SELECT store_nbr, missing_days FROM m ORDER BY missing_days DESC, store_nbr LIMIT 10",
    "m AS (SELECT store_nbr, (SELECT count(DISTINCT date) FROM tx) - count(DISTINCT date) AS missing_days "
    "FROM tx GROUP BY 1 HAVING (SELECT count(DISTINCT date) FROM tx) - count(DISTINCT date) > 0)"))
def missing_by_series(spark, d):
    """Ten series with the most missing days."""
    return P.top_k(P.missing_by_series(_tx(spark, d)), 10, F.desc("missing_days"), F.asc("store_nbr"))


@register("missing_rate", with_views(
    "SELECT nd * ns AS n_grid, nd * ns - np AS n_missing, (nd * ns - np) / (nd * ns) * 100 AS missing_pct FROM c",
    "c AS (SELECT count(DISTINCT date) AS nd, count(DISTINCT store_nbr) AS ns, "
    "count(DISTINCT (store_nbr, date)) AS np FROM tx)"), doubles=["missing_pct"])
def missing_rate(spark, d):
    return P.missing_rate(_tx(spark, d))


@register("outliers", with_views(
    "SELECT tx.store_nbr, tx.date, tx.transactions, st.mean, st.std, "
    "(tx.transactions - st.mean) / nullif(st.std, 0) AS z_score FROM tx JOIN st USING (store_nbr) "
    "WHERE abs((tx.transactions - st.mean) / nullif(st.std, 0)) > 3",
    "st AS (SELECT store_nbr, avg(transactions) AS mean, stddev_samp(transactions) AS std FROM tx GROUP BY 1)"),
    doubles=["mean", "std", "z_score"])
def outliers(spark, d):
    """Rows with |z| > 3 against their series mean / sample std."""
    return P.zscore_outliers(_tx(spark, d), 3.0)


@register("top_outliers", with_views(
    "SELECT tx.store_nbr, tx.date, tx.transactions, (tx.transactions - st.mean) / nullif(st.std, 0) AS z_score "
    "FROM tx JOIN st USING (store_nbr) WHERE abs((tx.transactions - st.mean) / nullif(st.std, 0)) > 3 "
    "ORDER BY z_score DESC, store_nbr, date LIMIT 15",
    "st AS (SELECT store_nbr, avg(transactions) AS mean, stddev_samp(transactions) AS std FROM tx GROUP BY 1)"),
    doubles=["z_score"])
def top_outliers(spark, d):
    """Fifteen largest z-scores."""
    o = P.zscore_outliers(_tx(spark, d), 3.0).select("store_nbr", "date", "transactions", "z_score")
    return P.top_k(o, 15, F.desc("z_score"), F.asc("store_nbr"), F.asc("date"))


@register("seasonal_index", with_views(
    "SELECT weekday, avg, round(avg / avg(avg) OVER () * 100, 1) AS index FROM m",
    f"m AS (SELECT {DOW} AS weekday, avg(transactions) AS avg FROM tx GROUP BY 1)"), doubles=["avg", "index"])
def seasonal_index(spark, d):
    """Weekday mean as a percentage of the mean of weekday means."""
    return P.seasonal_index(P.with_calendar(_tx(spark, d)), "weekday")


@register("pivot_weekday_month", with_views(
    f"SELECT {DOW} AS weekday, " + ", ".join(
        f'round(avg(transactions) FILTER (WHERE {MON} = {m}), 6) AS "{m}"' for m in range(1, 13)) + " FROM tx GROUP BY 1"))
def pivot_weekday_month(spark, d):
    """Mean target, weekday rows x month columns."""
    return P.pivot_mean(P.with_calendar(_tx(spark, d)), "weekday", "month", values=range(1, 13))


@register("pivot_series_year", with_views(
    "SELECT store_nbr, " + ", ".join(
        f'round(avg(transactions) FILTER (WHERE {YEAR} = {y}), 6) AS "{y}"' for y in YEARS) + " FROM tx GROUP BY 1"))
def pivot_series_year(spark, d):
    """Mean target, series rows x year columns."""
    return P.pivot_mean(P.with_calendar(_tx(spark, d)), "store_nbr", "year", values=YEARS)


@register("box_stats", with_views(
    "SELECT type, q1, median, q3, min(CASE WHEN y >= q1 - 1.5 * (q3 - q1) THEN y END) AS whisker_lo, "
    "max(CASE WHEN y <= q3 + 1.5 * (q3 - q1) THEN y END) AS whisker_hi, "
    "count(*) FILTER (WHERE y < q1 - 1.5 * (q3 - q1) OR y > q3 + 1.5 * (q3 - q1)) AS n_outliers, "
    "count(*) AS n FROM j JOIN q USING (type) GROUP BY type, q1, median, q3",
    "j AS (SELECT type, CAST(transactions AS DOUBLE) AS y FROM tx JOIN stores USING (store_nbr))",
    "q AS (SELECT type, quantile_cont(y, 0.25) AS q1, quantile_cont(y, 0.5) AS median, "
    "quantile_cont(y, 0.75) AS q3 FROM j GROUP BY 1)"),
    doubles=["q1", "median", "q3", "whisker_lo", "whisker_hi"])
def box_stats(spark, d):
    """Quartiles, whiskers and outlier counts of the target per store type."""
    return P.box_stats(_txs(spark, d), "type", "transactions")


def _hist_sql(src: str, col: str, bins: int, *ctes: str) -> str:
    return with_views(
        f"SELECT e.bin, st.mn + (e.bin - 1) * ((st.mx - st.mn) / {bins}) AS bin_lo, "
        f"st.mn + e.bin * ((st.mx - st.mn) / {bins}) AS bin_hi, coalesce(c.count, 0) AS count "
        "FROM e CROSS JOIN st LEFT JOIN c USING (bin)",
        *ctes,
        f"st AS (SELECT CAST(min({col}) AS DOUBLE) AS mn, CAST(max({col}) AS DOUBLE) AS mx FROM {src})",
        f"c AS (SELECT CAST(CASE WHEN st.mx > st.mn THEN least(floor((CAST({col} AS DOUBLE) - st.mn) / "
        f"(st.mx - st.mn) * {bins}) + 1, {bins}) ELSE 1 END AS INTEGER) AS bin, count(*) AS count "
        f"FROM {src}, st WHERE {col} IS NOT NULL GROUP BY 1)",
        f"e AS (SELECT CAST(range AS INTEGER) AS bin FROM range(1, {bins + 1}))",
    )


@register("histogram_target", _hist_sql("tx", "transactions", 80), doubles=["bin_lo", "bin_hi"])
def histogram_target(spark, d):
    """80-bin equal-width histogram of the target (all bins, zero filled)."""
    return P.histogram(_tx(spark, d), "transactions", 80)


@register("normalised_monthly", with_views(
    "SELECT month, store_nbr, a / nullif(m, 0) AS tx_normalized FROM mm JOIN st USING (store_nbr) WHERE n > 1000",
    "mm AS (SELECT CAST(date_trunc('month', date) AS DATE) AS month, store_nbr, avg(transactions) AS a "
    "FROM tx GROUP BY 1, 2)",
    "st AS (SELECT store_nbr, avg(transactions) AS m, count(*) AS n FROM tx GROUP BY 1)", by="nation"),
    doubles=["tx_normalized"])
def normalised_monthly(spark, d):
    """Target / series mean, monthly, for series longer than 1000 rows."""
    return P.normalised_monthly(panel(spark, d, "nation").tx, 1000)


@register("lag_pairs", with_views(
    "SELECT date, lag_7, transactions FROM s WHERE lag_7 IS NOT NULL",
    f"s AS (SELECT date, transactions, lag(transactions, 7) OVER (ORDER BY date) AS lag_7 FROM tx "
    f"WHERE store_nbr = {PICK_SQL})"))
def lag_pairs(spark, d):
    """(y[t-7], y[t]) of one series (filter pushed below the window)."""
    tx = _tx(spark, d)
    return P.lag_pairs(tx.where(F.col("store_nbr") == pick_series(tx)), 7)


@register("oil_correlation", with_views(
    "SELECT corr(o.dcoilwtico, d.total) AS r_total, corr(o.dcoilwtico, d.avg_tx) AS r_mean "
    "FROM d JOIN oil o USING (date) WHERE o.dcoilwtico IS NOT NULL",
    "d AS (SELECT date, sum(transactions) AS total, avg(transactions) AS avg_tx FROM tx GROUP BY 1)"),
    doubles=["r_total", "r_mean"])
def oil_correlation(spark, d):
    """Pearson r of the oil quote with the daily total and the daily mean."""
    from panelcast.functions.core import sized_broadcast
    p = panel(spark, d)
    daily = p.tx.groupBy("date").agg(F.sum("transactions").alias("total"), F.avg("transactions").alias("avg_tx"))
    j = daily.join(sized_broadcast(p.oil.where(F.col("dcoilwtico").isNotNull())), "date")
    return j.agg(safe_corr("dcoilwtico", "total").alias("r_total"), safe_corr("dcoilwtico", "avg_tx").alias("r_mean"))


# Fixed values (must equal the reference): the 26 columns correlated with the target.
CORR_COLS = [
    "lag_1", "lag_7", "lag_14", "lag_21", "lag_28",
    "rolling_mean_7_days", "rolling_mean_14_days", "rolling_mean_28_days",
    "wow_growth", "mom_growth",
    "same_weekday_last_week", "same_weekday_4weeks_ago",
    "diff_1", "diff_7", "diff_28",
    "oil_price", "oil_price_ma7",
    "weekday_sin", "weekday_cos", "month_sin", "month_cos",
    "store_type_enc", "cluster",
    "is_national_holiday", "is_day_before_holiday", "is_day_after_holiday",
]


@register("feature_correlations", with_views(
    "SELECT feature, r FROM u",
    *FINAL,
    "u AS (" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, corr(CAST(CAST({c} AS INTEGER) AS DOUBLE), CAST(transactions AS DOUBLE)) AS r "
        f"FROM final" if c.startswith("is_") else
        f"SELECT '{c}' AS feature, corr(CAST({c} AS DOUBLE), CAST(transactions AS DOUBLE)) AS r FROM final"
        for c in CORR_COLS) + ")"),
    doubles=["r"])
def feature_correlations(spark, d):
    """Pearson r of 26 features with the target on the final dataset."""
    return correlation_with_target(_final(spark, d), CORR_COLS)


def _acf_union(src: str, lags, with_key: bool) -> str:
    k = "store_nbr, n, " if with_key else ""
    return " UNION ALL ".join(f"SELECT {k}{n} AS lag, a{n} AS acf FROM {src}" for n in lags)


@register("feature_correlations_ranked", with_views(
    "SELECT CAST(row_number() OVER (ORDER BY round(abs(r), 6) DESC NULLS LAST, feature) AS INTEGER) AS position, feature, r FROM u",
    *FINAL,
    "u AS (" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, corr(CAST({'CAST(' + c + ' AS INTEGER)' if c.startswith('is_') else c} AS DOUBLE), "
        f"CAST(transactions AS DOUBLE)) AS r FROM final" for c in CORR_COLS) + ")"),
    doubles=["r"])
def feature_correlations_ranked(spark, d):
    """Correlations with the target, strongest first by absolute value."""
    return ranked_by_strength(correlation_with_target(_final(spark, d), CORR_COLS))


@register("transferred_holidays", with_views("SELECT * FROM holidays WHERE transferred"))
def transferred_holidays(spark, d):
    """Holidays that were moved to another day (filter on a flag)."""
    return transferred_op(panel(spark, d).holidays)


@register("holiday_rows", with_views(
    "SELECT date, store_nbr, transactions, is_national_holiday, is_day_before_holiday, is_day_after_holiday, hol_type_national "
    "FROM final WHERE is_national_holiday OR is_holiday_window", *FINAL))
def holiday_rows(spark, d):
    """Rows on a national holiday or next to one (OR of flags)."""
    return holiday_rows_op(_final(spark, d))


FINAL_TYPES = ["store_nbr", "date", "transactions", "oil_price", "is_national_holiday", "is_holiday_window", "hol_type_national", "month",
               "lag_7", "rolling_mean_7_days"]


@register("schema_report", with_views(
    " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS column_name, CASE any_value(typeof({c})) WHEN 'VARCHAR' THEN 'string' "
        f"WHEN 'INTEGER' THEN 'int' ELSE lower(any_value(typeof({c}))) END AS data_type, count({c}) AS n_values FROM final"
        for i, c in enumerate(FINAL_TYPES)), *FINAL))
def schema_report(spark, d):
    """Column names, types and values of the final dataset."""
    return schema_report_op(_final(spark, d).select(*FINAL_TYPES))


@register("acf_one", with_views(
    "SELECT lag, acf FROM u",
    f"s AS (SELECT date, CAST(transactions AS DOUBLE) AS y FROM tx WHERE store_nbr = {PICK_SQL})",
    "l AS (SELECT y, " + ", ".join(f"lag(y, {n}) OVER (ORDER BY date) AS l{n}" for n in ACF_LAGS) + " FROM s)",
    "a AS (SELECT " + ", ".join(f"corr(y, l{n}) AS a{n}" for n in ACF_LAGS) + " FROM l)",
    "u AS (" + _acf_union("a", ACF_LAGS, False) + ")"), doubles=["acf"])
def acf_one(spark, d):
    """ACF of one series at 15 lags."""
    tx = _tx(spark, d)
    a = acf(tx.where(F.col("store_nbr") == pick_series(tx)), ACF_LAGS)
    return a.select("lag", "acf")


ACF_PANEL_CTES = (
    "l AS (SELECT store_nbr, CAST(transactions AS DOUBLE) AS y, "
    + ", ".join(f"lag(transactions, {n}) OVER w AS l{n}" for n in ACF_PANEL_LAGS)
    + " FROM tx WINDOW w AS (PARTITION BY store_nbr ORDER BY date))",
    "a AS (SELECT store_nbr, count(*) AS n, " + ", ".join(f"corr(y, l{n}) AS a{n}" for n in ACF_PANEL_LAGS)
    + " FROM l GROUP BY 1)",
    "u AS (" + _acf_union("a", ACF_PANEL_LAGS, True) + ")",
    "p AS (SELECT store_nbr, lag, acf FROM u WHERE n >= 400 AND n > lag)",
)


@register("acf_panel", with_views("SELECT store_nbr, lag, acf FROM p", *ACF_PANEL_CTES), doubles=["acf"])
def acf_panel_q(spark, d):
    """ACF at lags 1, 7, 14, 30, 365 for every series with >= 400 rows."""
    return acf_panel(_tx(spark, d))


@register("acf_summary", with_views(
    "SELECT lag, median(acf) AS median, min(acf) AS min, max(acf) AS max FROM p GROUP BY 1", *ACF_PANEL_CTES),
    doubles=["median", "min", "max"])
def acf_summary_q(spark, d):
    """Median / min / max ACF over series per lag."""
    return acf_summary(acf_panel(_tx(spark, d)))


SPLIT_SQL = (f"CASE WHEN date <= DATE '{TRAIN_END}' THEN 'train' WHEN date <= DATE '{VAL_END}' THEN 'val' "
             "ELSE 'test' END")


@register("split_counts", with_views(
    f"SELECT {SPLIT_SQL} AS split, count(*) AS n_rows, min(date) AS min_date, max(date) AS max_date, "
    "count(DISTINCT store_nbr) AS n_series FROM final GROUP BY 1", *FINAL))
def split_counts(spark, d):
    """Rows, date range and series per chronological split of the final dataset."""
    return split_counts_op(_final(spark, d), TRAIN_END, VAL_END)


@register("long_format", with_views(
    "SELECT CAST(store_nbr AS VARCHAR) AS unique_id, date AS ds, transactions AS y, "
    "CAST(store_type_enc AS FLOAT) AS store_type_enc, CAST(cluster AS FLOAT) AS cluster, "
    "CAST(oil_price AS FLOAT) AS oil_price, CAST(is_national_holiday AS FLOAT) AS is_national_holiday, "
    "CAST(is_day_before_holiday AS FLOAT) AS is_day_before_holiday, "
    "CAST(is_day_after_holiday AS FLOAT) AS is_day_after_holiday FROM final", *FINAL))
def long_format(spark, d):
    """(unique_id, ds, y) plus float32 exogenous columns."""
    return to_long_format(_final(spark, d))


@register("static_table", with_views(
    "SELECT DISTINCT CAST(store_nbr AS VARCHAR) AS unique_id, CAST(store_type_enc AS FLOAT) AS store_type_enc, "
    "CAST(cluster AS FLOAT) AS cluster FROM final", *FINAL))
def static_table(spark, d):
    """One row per series with its static columns."""
    return static_table_op(_final(spark, d))


@register("describe_target_nearest", with_views(
    "SELECT st.count, st.null_count, st.mean, st.std, st.min, q.p25, q.p50, q.p75, st.mx AS max FROM st, q",
    "s AS (SELECT CAST(transactions AS DOUBLE) AS x, row_number() OVER (ORDER BY transactions) - 1 AS i, "
    "count(*) OVER () AS n FROM tx)",
    "q AS (SELECT " + ", ".join(
        f"max(x) FILTER (WHERE i = floor((n - 1) * {p} + 0.5)) AS p{int(p * 100)}" for p in (0.25, 0.5, 0.75))
    + " FROM s)",
    "st AS (SELECT count(transactions) AS count, count(*) - count(transactions) AS null_count, "
    "avg(transactions) AS mean, stddev_samp(transactions) AS std, CAST(min(transactions) AS DOUBLE) AS min, "
    "CAST(max(transactions) AS DOUBLE) AS mx FROM tx)"),
    doubles=["mean", "std", "min", "p25", "p50", "p75", "max"])
def describe_target_nearest(spark, d):
    """Describe with nearest-rank quartiles (element at round((n-1)p))."""
    return P.describe(_tx(spark, d), "transactions", method="nearest")


# Fixed values (must equal the reference): the sample of series drawn together.
SAMPLE_SERIES = [1, 10, 20, 30, 44, 50]


@register("series_sample", with_views(
    f"SELECT * FROM tx WHERE store_nbr IN ({', '.join(map(str, SAMPLE_SERIES))})"))
def series_sample(spark, d):
    """Rows of a fixed list of series (membership filter)."""
    return _tx(spark, d).where(F.col("store_nbr").isin(SAMPLE_SERIES))


@register("lag_demo_slice", with_views(
    "SELECT * FROM l ORDER BY date LIMIT 10 OFFSET 25",
    "l AS (SELECT date, transactions, " + ", ".join(
        f"lag(transactions, {n}) OVER (ORDER BY date) AS lag_{n}" for n in (1, 7, 14, 21, 28))
    + f" FROM tx WHERE store_nbr = {PICK_SQL})"))
def lag_demo_slice(spark, d):
    """Rows 26..35 (by date) of one series with its lags."""
    from panelcast.operators.features import add_lag
    tx = _tx(spark, d)
    one = add_lag(tx.where(F.col("store_nbr") == pick_series(tx)), [1, 7, 14, 21, 28])
    return one.select("date", "transactions", "lag_1", "lag_7", "lag_14", "lag_21", "lag_28").orderBy(
        "date").offset(25).limit(10)


def _box_sql(src: str, by: str, val: str, *ctes: str) -> str:
    return with_views(
        f"SELECT {by}, q1, median, q3, min(CASE WHEN y >= q1 - 1.5 * (q3 - q1) THEN y END) AS whisker_lo, "
        "max(CASE WHEN y <= q3 + 1.5 * (q3 - q1) THEN y END) AS whisker_hi, "
        "count(*) FILTER (WHERE y < q1 - 1.5 * (q3 - q1) OR y > q3 + 1.5 * (q3 - q1)) AS n_outliers, "
        f"count(*) AS n FROM bj JOIN bq USING ({by}) GROUP BY {by}, q1, median, q3",
        *ctes,
        f"bj AS (SELECT {by}, CAST({val} AS DOUBLE) AS y FROM {src} WHERE {val} IS NOT NULL)",
        f"bq AS (SELECT {by}, quantile_cont(y, 0.25) AS q1, quantile_cont(y, 0.5) AS median, "
        f"quantile_cont(y, 0.75) AS q3 FROM bj GROUP BY 1)",
    )


BOX_DOUBLES = ["q1", "median", "q3", "whisker_lo", "whisker_hi"]


@register("box_stats_acf", _box_sql("p", "lag", "acf", *ACF_PANEL_CTES), doubles=BOX_DOUBLES)
def box_stats_acf(spark, d):
    """Spread of the per-series ACF at each lag (quartiles, whiskers, outliers)."""
    return P.box_stats(acf_panel(_tx(spark, d)).where(F.col("acf").isNotNull()), "lag", "acf")


@register("box_stats_holiday", _box_sql(
    "j", "hol_type", "avg_tx",
    "dm AS (SELECT date, avg(transactions) AS avg_tx FROM tx GROUP BY 1)",
    "n AS (SELECT date, type AS hol_type FROM holidays WHERE locale = 'National')",
    "j AS (SELECT dm.date, dm.avg_tx, coalesce(n.hol_type, 'Normal') AS hol_type FROM dm LEFT JOIN n USING (date))"),
    doubles=BOX_DOUBLES)
def box_stats_holiday(spark, d):
    """Spread of the daily mean target per national holiday type ('Normal' otherwise)."""
    from panelcast.functions.core import sized_broadcast
    p = panel(spark, d)
    daily = P.mean_by(p.tx, "date", alias="avg_tx")
    nat = p.holidays.where(F.col("locale") == "National").select("date", F.col("type").alias("hol_type"))
    j = daily.join(sized_broadcast(nat), "date", "left").withColumn(
        "hol_type", F.coalesce(F.col("hol_type"), F.lit("Normal")))
    return P.box_stats(j, "hol_type", "avg_tx")


def _describe_sql(src: str, col: str, *ctes: str) -> str:
    return with_views(
        f"SELECT count({col}) AS count, count(*) - count({col}) AS null_count, avg({col}) AS mean, "
        f"stddev_samp({col}) AS std, CAST(min({col}) AS DOUBLE) AS min, quantile_cont({col}, 0.25) AS p25, "
        f"quantile_cont({col}, 0.5) AS p50, quantile_cont({col}, 0.75) AS p75, CAST(max({col}) AS DOUBLE) AS max "
        f"FROM {src}", *ctes)


DESCRIBE_DOUBLES = ["mean", "std", "min", "p25", "p50", "p75", "max"]


@register("describe_oil", _describe_sql("oil", "dcoilwtico"), doubles=DESCRIBE_DOUBLES)
def describe_oil(spark, d):
    """Describe of the daily oil quote (nulls counted, statistics over quotes)."""
    return P.describe(panel(spark, d).oil, "dcoilwtico")


@register("describe_days_per_series", _describe_sql(
    "dps", "n_days", "dps AS (SELECT store_nbr, count(*) AS n_days FROM tx GROUP BY 1)"), doubles=DESCRIBE_DOUBLES)
def describe_days_per_series(spark, d):
    """Describe of the number of days per series."""
    return P.describe(P.days_per_series(_tx(spark, d)), "n_days")
