"""Unit tests on hand-written frames for the window, calendar and
enrichment operators (FIXTURES.md part C, SURVEY 2.N rows S1-S9, Q1)."""

import datetime as dt
import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from panelcast.functions.core import safe_corr, safe_div, sized_broadcast
from panelcast.operators.checks import assert_no_nulls, null_profile
from panelcast.operators.exogenous import (
    add_holiday_features,
    add_oil_features,
    add_store_features,
    ffill_global,
)
from panelcast.operators.features import (
    add_cyclical_time_features,
    add_difference_features,
    add_lag,
    add_momentum_features,
    add_rolling_mean,
    drop_warmup,
)
from panelcast.plans.feature_pipeline import build_features, build_final_dataset

D0 = dt.date(2020, 1, 6)  # a Monday
TX = "store_nbr bigint, date date, transactions bigint"


def day(i):
    return D0 + dt.timedelta(days=i)


@pytest.fixture
def two_series_40d(spark):
    rows = [(k, day(i), 10 * k + i) for k in (1, 2) for i in range(40)]
    return spark.createDataFrame(rows, TX)


@pytest.fixture
def gap_series(spark):
    rows = [(1, day(i), i) for i in range(20) if i not in (5, 6, 12)]
    return spark.createDataFrame(rows, TX)


def by_key_date(df):
    return {(r["store_nbr"], r["date"]): r for r in df.collect()}


def test_lags_are_row_based_per_series(two_series_40d):
    out = by_key_date(add_lag(two_series_40d, [1, 7, 28]))
    assert out[(1, day(0))]["lag_1"] is None
    assert out[(1, day(7))]["lag_7"] == 10
    assert out[(2, day(28))]["lag_28"] == 20
    assert out[(2, day(27))]["lag_28"] is None  # never crosses into series 1


def test_lag_ignores_calendar_gaps(gap_series):
    out = by_key_date(add_lag(gap_series, [1]))
    assert out[(1, day(7))]["lag_1"] == 4  # previous *row* is day 4


def test_rolling_mean_needs_full_window_and_excludes_current(two_series_40d):
    out = by_key_date(add_rolling_mean(two_series_40d, [7]))
    assert out[(1, day(6))]["rolling_mean_7_days"] is None
    assert out[(1, day(7))]["rolling_mean_7_days"] == pytest.approx(sum(10 + i for i in range(7)) / 7)


def test_rolling_mean_null_inside_window(spark):
    rows = [(1, day(i), None if i == 3 else i) for i in range(12)]
    out = by_key_date(add_rolling_mean(spark.createDataFrame(rows, TX), [7]))
    assert out[(1, day(10))]["rolling_mean_7_days"] is None  # window 3..9 holds the null
    assert out[(1, day(11))]["rolling_mean_7_days"] == pytest.approx(sum(range(4, 11)) / 7)


def test_zero_denominator_is_null(spark):
    rows = [(1, day(i), 0 if i == 0 else 5) for i in range(10)]
    out = by_key_date(add_momentum_features(spark.createDataFrame(rows, TX)))
    assert out[(1, day(7))]["wow_growth"] is None  # y[t-7] == 0
    assert out[(1, day(8))]["wow_growth"] == 0.0


def test_safe_div_and_safe_corr(spark):
    df = spark.createDataFrame([(1.0, 0.0, 3.0), (2.0, 0.0, 3.0), (3.0, 1.0, 3.0)], "x double, z double, c double")
    r = df.agg(safe_corr("x", "c").alias("const"), safe_corr("x", "x").alias("same"),
               F.max(safe_div("x", "z")).alias("d")).first()
    assert r["const"] is None
    assert r["same"] == pytest.approx(1.0)
    assert r["d"] == 3.0


def test_differences(two_series_40d):
    out = by_key_date(add_difference_features(two_series_40d))
    assert out[(1, day(30))]["diff_28"] == 28
    assert out[(1, day(30))]["diff_1"] == 1


def test_calendar_iso_weekday_and_cycles(spark):
    df = spark.createDataFrame([(1, D0, 1), (1, day(6), 1)], TX)
    out = by_key_date(add_cyclical_time_features(df))
    assert out[(1, D0)]["weekday"] == 1 and out[(1, day(6))]["weekday"] == 7
    assert out[(1, D0)]["weekday_sin"] == pytest.approx(math.sin(2 * math.pi / 7))
    assert out[(1, D0)]["month"] == 1 and out[(1, D0)]["quarter"] == 1


def test_oil_fill_runs_on_series_rows_only(spark):
    tx = spark.createDataFrame([(1, day(i), 1) for i in (0, 1, 2, 4, 5, 6, 7, 8, 9, 10)], TX)
    oil = spark.createDataFrame(
        [(day(0), None), (day(1), 50.0), (day(2), None), (day(3), 70.0), (day(4), None)] +
        [(day(i), 60.0) for i in range(5, 11)], "date date, dcoilwtico double")
    out = by_key_date(add_oil_features(tx, oil))
    assert out[(1, day(0))]["oil_price"] is None  # leading null stays null
    assert out[(1, day(2))]["oil_price"] == 50.0
    assert out[(1, day(4))]["oil_price"] == 50.0  # the quote of day 3 has no series row
    # 7-row frames (the series has no day 3): the frame ending on day 7 holds day 0 (null)
    assert out[(1, day(7))]["oil_price_ma7"] is None
    assert out[(1, day(8))]["oil_price_ma7"] == pytest.approx((50 * 3 + 60 * 4) / 7)


HOL = "date date, type string, locale string, transferred boolean"


def test_holiday_fanout_flags_and_average_rank(spark):
    tx = spark.createDataFrame([(1, day(i), i) for i in range(6)], TX)
    hol = spark.createDataFrame([
        (day(2), "Holiday", "National", False), (day(2), "Additional", "National", False),
        (day(4), "Holiday", "National", True), (day(4), "Event", "Regional", False),
        (day(5), "Bridge", "National", None),
    ], HOL)
    out = add_holiday_features(tx, hol)
    assert out.count() == 7  # day 2 repeated
    rows = {(r["date"], r["hol_type_national"]): r for r in out.collect()}
    assert rows[(day(2), "Holiday")]["is_national_holiday"]
    assert rows[(day(4), "none")]["is_national_holiday"] is False  # transferred / regional dropped
    assert rows[(day(5), "none")]["is_national_holiday"] is False  # null transferred dropped
    assert rows[(day(1), "none")]["is_day_before_holiday"] and rows[(day(3), "none")]["is_day_after_holiday"]
    assert rows[(day(1), "none")]["is_holiday_window"]
    ranked = drop_warmup(out, n=2, keep_rank=True).collect()
    ranks = sorted({(r["date"], r["day_rank"]) for r in ranked})
    assert (day(2), 3.5) in ranks and (day(3), 5.0) in ranks
    assert add_holiday_features(tx, hol, dedupe=True).count() == 6


def test_store_type_code_and_unknown_type(spark):
    tx = spark.createDataFrame([(1, D0, 1), (2, D0, 1), (3, D0, 1)], TX)
    st = spark.createDataFrame([(1, "c", "A", 3), (2, "c", "E", 1), (3, "c", None, 2)],
                               "store_nbr bigint, city string, type string, cluster bigint")
    out = by_key_date(add_store_features(tx, st))
    assert out[(1, D0)]["store_type_enc"] == 5 and out[(2, D0)]["store_type_enc"] == 1
    assert out[(3, D0)]["store_type_enc"] is None
    bad = spark.createDataFrame([(1, "c", "Z", 3)], "store_nbr bigint, city string, type string, cluster bigint")
    with pytest.raises(PySparkException):
        add_store_features(tx, bad).collect()


def test_ffill_global_across_months(spark):
    rows = [(dt.date(2020, 1, 30), 1.0), (dt.date(2020, 1, 31), None), (dt.date(2020, 2, 1), None),
            (dt.date(2020, 3, 2), None), (dt.date(2020, 3, 3), 4.0), (dt.date(2020, 1, 1), None)]
    out = {r["date"]: r["oil_filled"] for r in ffill_global(spark.createDataFrame(rows, "date date, dcoilwtico double")).collect()}
    assert out[dt.date(2020, 1, 1)] is None
    assert out[dt.date(2020, 2, 1)] == 1.0 and out[dt.date(2020, 3, 2)] == 1.0 and out[dt.date(2020, 3, 3)] == 4.0


def test_pipeline_warmup_and_null_check(spark, two_series_40d):
    st = spark.createDataFrame([(1, "c", "A", 3), (2, "c", "B", 1)],
                               "store_nbr bigint, city string, type string, cluster bigint")
    oil = spark.createDataFrame([(day(i), 50.0 + i) for i in range(40)], "date date, dcoilwtico double")
    hol = spark.createDataFrame([(day(35), "Holiday", "National", False)], HOL)
    full = build_features(two_series_40d, st, oil, hol)
    prof = {r["column_name"]: r["null_count"] for r in null_profile(full).collect()}
    assert prof["lag_28"] == 56
    final = build_final_dataset(two_series_40d, st, oil, hol, check_nulls=True)
    assert final.count() == 2 * (40 - 28)
    with pytest.raises(AssertionError):
        assert_no_nulls(full)


def test_sized_broadcast_falls_back(spark):
    small = spark.range(5)
    big = spark.range(100)
    assert sized_broadcast(small, 100) is not small  # hinted copy
    assert sized_broadcast(big, 100) is big  # above the bound: unhinted, the planner decides


def test_normalise_and_long_series_filter(spark, two_series_40d):
    from panelcast.operators.features import keep_long_series, normalise_by_mean

    out = by_key_date(normalise_by_mean(two_series_40d))
    assert out[(1, day(0))]["tx_normalized"] == pytest.approx(10 / (10 + 19.5))
    kept = keep_long_series(two_series_40d.where((F.col("store_nbr") == 1) | (F.col("date") < F.lit(day(5)))), 10)
    assert {r["store_nbr"] for r in kept.collect()} == {1}


def test_describe_and_box_stats_approx_close_to_exact(spark):
    from panelcast.operators.profile import box_stats, describe

    df = spark.range(0, 2000).select((F.col("id") % 97).cast("double").alias("y"), (F.col("id") % 3).alias("g"))
    exact = describe(df, "y").first()
    approx = describe(df, "y", method="approx").first()
    for c in ("p25", "p50", "p75"):
        assert abs(exact[c] - approx[c]) <= 1.0
    ex = {r["g"]: r for r in box_stats(df, "g", "y").collect()}
    ap = {r["g"]: r for r in box_stats(df, "g", "y", approx=True).collect()}
    assert all(abs(ex[g]["median"] - ap[g]["median"]) <= 1.0 for g in ex)


def test_checkpoint_dir_respects_session_setting(spark):
    from panelcast.session import checkpoint_dir

    assert checkpoint_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_pooling_reads_elements_in_place(spark):
    """Pooling of odd lengths, short arrays and nulls as before, without a slice per pooled value."""
    from panelcast.plans.forecast.sequence import pool_sequence

    rows = [(1, [3.0, 1.0, 2.0, 5.0, 4.0]), (2, [1.0, None, float("nan")]), (3, None)]
    out = pool_sequence(spark.createDataFrame(rows, "store_nbr bigint, input array<double>"), kernels=[2, 1, 2], lookback=5)
    assert "slice(" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = {(r["store_nbr"], r["stack"]): (r["kernel"], [None if v is None else str(v) for v in r["pooled"]]) for r in out.collect()}
    pairs = {1: ["3.0", "5.0", "4.0"], 2: ["1.0", "nan", None], 3: [None] * 3}
    single = {1: ["3.0", "1.0", "2.0", "5.0", "4.0"], 2: ["1.0", None, "nan", None, None], 3: [None] * 5}
    assert got == {(k, s): (2, pairs[k]) if s != 1 else (1, single[k]) for k in (1, 2, 3) for s in (0, 1, 2)}
