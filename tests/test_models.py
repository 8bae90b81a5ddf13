"""Property tests for the forecasting jobs and the evaluation operators
(FIXTURES.md C: linear_weekly, too_short, pred_partial)."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.operators import evaluate as E
from panelcast.plans.forecast.decomposable import forecast_decomposable
from panelcast.plans.forecast.direct_linear import forecast_direct_linear
from panelcast.plans.forecast.grouped import marked
from panelcast.plans.forecast.seasonal_arx import forecast_seasonal_arx
from panelcast.plans.forecast.trees import feature_importance, fit_boosted_trees, learning_curve, predict_trees

D0 = dt.date(2019, 1, 7)
WEEK = [0, 5, 10, 5, 0, -10, -20]
SCHEMA = "store_nbr bigint, date date, transactions double, oil_price double, is_national_holiday boolean"


def linear_weekly(spark, n=420, keys=(1, 2)):
    rows = []
    for k in keys:
        for i in range(n):
            y = 100.0 * k + 0.5 * i + WEEK[i % 7]
            rows.append((k, D0 + dt.timedelta(days=i), y, 50.0 + (i % 3), i % 30 == 0))
    return spark.createDataFrame(rows, SCHEMA)


def truth(k, i):
    return 100.0 * k + 0.5 * i + WEEK[i % 7]


def split(df, n_hist):
    cut = D0 + dt.timedelta(days=n_hist - 1)
    return df.where(F.col("date") <= F.lit(cut)), df.where(F.col("date") > F.lit(cut))


def check_recovery(out, tol):
    rows = out.collect()
    assert rows and all(r["status"] == "ok" for r in rows)
    for r in rows:
        i = (r["date"] - D0).days
        assert abs(r["y_pred"] - truth(r["store_nbr"], i)) < tol, (r, truth(r["store_nbr"], i))


def test_seasonal_arx_recovers_trend_and_week(spark):
    hist, fut = split(linear_weekly(spark), 390)
    out = forecast_seasonal_arx(marked(hist, fut), "is_train", ["oil_price", "is_national_holiday"])
    assert out.count() == fut.count()
    check_recovery(out, 1e-3)


def test_decomposable_recovers_trend_and_week(spark):
    hist, fut = split(linear_weekly(spark), 390)
    out = forecast_decomposable(marked(hist, fut), "is_train", ["oil_price"])
    assert out.count() == fut.count()
    check_recovery(out, 1.0)


def test_skip_rules_report_status(spark):
    rows = [(1, D0 + dt.timedelta(days=i), float(i), 1.0, False) for i in range(5)]
    rows += [(2, D0 + dt.timedelta(days=i), 0.0, 1.0, False) for i in range(60)]
    rows += [(3, D0 + dt.timedelta(days=i), None if i == 3 else 1.0, 1.0, False) for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    hist, fut = df.where(F.col("date") < F.lit(D0 + dt.timedelta(days=3))), df.where(
        F.col("date") >= F.lit(D0 + dt.timedelta(days=3)))
    hist = hist.unionByName(df.where((F.col("store_nbr") != 1) & (F.col("date") >= F.lit(D0 + dt.timedelta(days=3)))
                                     & (F.col("date") < F.lit(D0 + dt.timedelta(days=50)))))
    fut = fut.where((F.col("store_nbr") == 1) | (F.col("date") >= F.lit(D0 + dt.timedelta(days=50))))
    st = {r["store_nbr"]: r["status"] for r in forecast_decomposable(marked(hist, fut), "is_train").collect()}
    assert st[2].startswith("skipped") and "zero" in st[2]
    assert st[3].startswith("skipped") and "missing" in st[3]
    arx = {r["store_nbr"]: (r["status"], r["y_pred"]) for r in forecast_seasonal_arx(marked(hist, fut), "is_train", []).collect()}
    assert arx[1][0].startswith("skipped") and arx[1][1] is None


def test_boosted_trees_deterministic_and_complete(spark):
    df = linear_weekly(spark, n=120).withColumn("weekday", F.weekday("date")).withColumn(
        "t", F.datediff("date", F.lit(D0)))
    hist, fut = split(df, 100)
    feats = ["weekday", "t", "oil_price", "is_national_holiday"]
    a = fit_boosted_trees(hist, feats, variant="early_stop", rounds=12, patience=3, depth=3)
    b = fit_boosted_trees(hist, feats, variant="early_stop", rounds=12, patience=3, depth=3)
    pa = {(r["store_nbr"], r["date"]): r["y_pred"] for r in predict_trees(a, fut).collect()}
    pb = {(r["store_nbr"], r["date"]): r["y_pred"] for r in predict_trees(b, fut).collect()}
    assert pa == pb and len(pa) == fut.count()
    assert all(math.isfinite(v) for v in pa.values())
    imp = feature_importance(spark, a).collect()
    assert sum(r["share"] for r in imp) == pytest.approx(1.0)
    # the curve runs to the round where the patience rule fired (or all rounds)
    assert learning_curve(spark, a).count() == len(a.curve) and 1 <= len(a.curve) <= 12
    full = fit_boosted_trees(hist, feats, variant="full_sample", rounds=5, depth=3)
    assert full.best_rounds == 5 and full.model.getNumTrees == 5


def test_direct_linear_recovers_weekly_cycle(spark):
    df = linear_weekly(spark, n=200).withColumn("transactions", F.col("transactions") - 0.5 * F.datediff(
        "date", F.lit(D0)))  # pure weekly cycle per series
    hist, fut = split(df, 150)
    out = forecast_direct_linear(spark, hist, fut, lookback=28, horizon=14, ridge=1e-6)
    rows = out.collect()
    assert len(rows) == 2 * 14
    for r in rows:
        i = (r["date"] - D0).days
        assert abs(r["y_pred"] - (100.0 * r["store_nbr"] + WEEK[i % 7])) < 1e-3
        assert r["y_true"] == pytest.approx(100.0 * r["store_nbr"] + WEEK[i % 7])


PRED = "split string, model string, store_nbr bigint, date date, y_true double, y_pred double"


def test_leaderboard_common_rows_and_both_mapes(spark):
    d = [D0 + dt.timedelta(days=i) for i in range(4)]
    rows = [("val", "a", 1, d[i], [0.0, 2.0, 4.0, 10.0][i], [1.0, 2.0, 5.0, 8.0][i]) for i in range(4)]
    rows += [("val", "b", 1, d[i], [0.0, 2.0, 4.0, 10.0][i], p) for i, p in ((0, 0.0), (1, None), (2, 4.0))]
    preds = spark.createDataFrame(rows, PRED)
    board = {r["model"]: r for r in E.leaderboard(preds, mape="zero_to_one").collect()}
    assert board["a"]["n"] == 4 and board["b"]["n"] == 2
    assert board["a"]["mae"] == pytest.approx((1 + 0 + 1 + 2) / 4)
    assert board["a"]["mape"] == pytest.approx((1 / 1 + 0 + 1 / 4 + 2 / 10) / 4 * 100)
    clip = {r["model"]: r for r in E.metrics(preds, ["model"], mape="clip").collect()}
    assert clip["a"]["mape"] == pytest.approx((1 / 1 + 0 + 1 / 4 + 2 / 10) / 4 * 100)
    common = {r["model"]: r for r in E.leaderboard(preds, common=True).collect()}
    assert common["a"]["n"] == common["b"]["n"] == 2
    assert E.best_model(E.leaderboard(preds).withColumn("split", F.lit("test"))).first()["model"] == "b"


def test_early_stop_fits_every_row_for_the_best_rounds(spark):
    df = linear_weekly(spark, n=120).withColumn("weekday", F.weekday("date")).withColumn(
        "t", F.datediff("date", F.lit(D0)))
    hist, fut = split(df, 100)
    feats = ["weekday", "t", "oil_price"]
    fit = fit_boosted_trees(hist, feats, variant="early_stop", rounds=16, patience=4, depth=3)
    assert fit.n_rows == hist.count()  # the model is fitted on every training row
    valid = [v for _, _, v in fit.curve]
    assert fit.best_rounds == valid.index(min(valid)) + 1 == fit.model.getNumTrees
    assert len(fit.curve) == min(16, fit.best_rounds + 4)
    longer = fit_boosted_trees(hist, feats, variant="early_stop", rounds=12, patience=12, depth=3)
    assert [v for _, _, v in longer.curve[:4]] == valid[:4]  # rounds depend on the rounds before only


def dense_likelihood(coefs, y, X, seen):
    """The diffuse likelihood from the full covariance matrix of the levels."""
    from panelcast.plans.forecast import seasonal_arx as S

    phi, Phi, th, Th = coefs
    n = len(y)
    T, _, R = S.state_space(*coefs)
    arma = slice(0, S.N_ARMA)
    P = S.stationary_covariance(T[arma, arma], np.outer(R[arma], R[arma]))
    gamma, A = [], np.eye(S.N_ARMA)
    for _ in range(n):
        gamma.append((A @ P)[0, 0])
        A = T[arma, arma] @ A
    toeplitz = np.array([[gamma[abs(i - j)] for j in range(n)] for i in range(n)])
    D = np.eye(n) - np.eye(n, k=-1) - np.eye(n, k=-7) + np.eye(n, k=-8)
    M = np.linalg.inv(D)
    V = (M @ toeplitz @ M.T)[np.ix_(seen, seen)]
    B = S.removed_functions(n)[seen]
    W = np.column_stack([X, S.removed_functions(n)])[seen]
    iv = np.linalg.inv(V)
    b = np.linalg.solve(W.T @ iv @ W, W.T @ iv @ y[seen])
    r = y[seen] - W @ b
    m = int(seen.sum()) - 8
    return -0.5 * (m * (np.log(2 * np.pi * (r @ iv @ r) / m) + 1) + np.linalg.slogdet(V)[1] + np.linalg.slogdet(B.T @ iv @ B)[1])


def test_filter_likelihood_equals_the_dense_one():
    from panelcast.plans.forecast import seasonal_arx as S

    rng = np.random.default_rng(0)
    y, X = np.cumsum(rng.normal(size=60)) + np.tile(WEEK, 9)[:60], rng.normal(size=(60, 2))
    for gaps in ([], [20, 21, 40], [0, 3, 59]):
        seen = np.ones(60, dtype=bool)
        seen[gaps] = False
        for coefs in ((0.5, -0.3, 0.2, -0.6), (-0.7, 0.1, -0.9, 0.4), (0.0, 0.0, 0.0, 0.0)):
            got = S.profile_likelihood(coefs, np.where(seen, y, np.nan), X, seen)[0]
            assert got == pytest.approx(dense_likelihood(coefs, y, X, seen), abs=1e-5)


def test_settled_filter_equals_the_unsettled_one(monkeypatch):
    from panelcast.plans.forecast import seasonal_arx as S

    rng = np.random.default_rng(3)
    y, seen = np.cumsum(rng.normal(size=700)) + np.tile(WEEK, 100), np.ones(700, dtype=bool)
    seen[[300, 301, 555]] = False
    coefs = (0.4, 0.2, -0.5, -0.7)
    quick = S.profile_likelihood(coefs, y, np.zeros((700, 0)), seen)
    monkeypatch.setattr(S, "SETTLED", 0.0)
    slow = S.profile_likelihood(coefs, y, np.zeros((700, 0)), seen)
    assert quick[0] == pytest.approx(slow[0], abs=0.02) and np.allclose(quick[1], slow[1], rtol=1e-2, atol=1e-2)


def test_seasonal_arx_skips_missing_targets():
    from panelcast.plans.forecast.seasonal_arx import fit_forecast

    t = np.arange(200.0)
    y = 3 + 0.2 * t + np.tile(WEEK, 30)[:200]
    holes = y.copy()
    holes[[30, 31, 77, 150, 199]] = np.nan
    future = 3 + 0.2 * np.arange(200, 214) + np.tile(WEEK, 31)[200:214]
    assert np.allclose(fit_forecast(holes, np.zeros((200, 0)), np.zeros((14, 0))), future, atol=1e-3)


def test_sparse_trend_recovers_two_breaks():
    from panelcast.plans.forecast.decomposable import sparse_fit

    rng = np.random.default_rng(2)
    t = np.linspace(0, 1, 500)
    knots = np.linspace(0, 0.8, 26)[1:]
    S = np.maximum(t[:, None] - knots, 0)
    A = np.column_stack([np.ones_like(t), t, np.sin(40 * t)])
    y = 0.3 + 0.5 * t + 0.1 * A[:, 2] + 1.5 * S[:, 6] - 2.0 * S[:, 18] + rng.normal(scale=1e-4, size=500)
    s, a = sparse_fit(S, A, y, np.zeros(3), 1e-2)
    assert np.flatnonzero(s).tolist() == [6, 18]
    assert s[6] == pytest.approx(1.5, abs=0.05) and s[18] == pytest.approx(-2.0, abs=0.05)
    plain, a = sparse_fit(S, A, y, np.zeros(3), 1e-2, reweights=0)  # optimality: no coefficient can move
    r = S.T @ (y - S @ plain - A @ a)
    assert np.all(np.abs(r) <= 1e-2 + 1e-6) and np.allclose(r[plain != 0], 1e-2 * np.sign(plain[plain != 0]), atol=1e-6)
    none, _ = sparse_fit(S, A, A @ [1.0, 2.0, 0.1] + rng.normal(scale=1e-4, size=500), np.zeros(3), 1e-2)
    assert not none.any()
