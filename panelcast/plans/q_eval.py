"""Registered evaluation queries over naive predictions of the final dataset."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.operators import evaluate as E
from panelcast.operators import profile as P
from panelcast.plans.catalog import register
from panelcast.plans.forecast.naive import NAIVE_MODELS, naive_predictions
from panelcast.plans.q_profile import FINAL, PICK_SQL, SPLIT_SQL, _final, _hist_sql, _tx, pick_series
from panelcast.sources.fixtures import TRAIN_END, VAL_END, with_views

PRED_CTES = FINAL + (
    f"fs AS (SELECT *, {SPLIT_SQL} AS split FROM final)",
    "pr AS (" + " UNION ALL ".join(
        f"SELECT split, '{m}' AS model, store_nbr, date, CAST(transactions AS DOUBLE) AS y_true, "
        f"CAST({c} AS DOUBLE) AS y_pred FROM fs WHERE split <> 'train'" for m, c in NAIVE_MODELS.items()) + ")",
    "cp AS (SELECT * FROM pr WHERE y_true IS NOT NULL AND y_pred IS NOT NULL)",
)
ERR = "(y_pred - y_true)"
MAPE_SQL = {
    "clip": f"avg(abs{ERR} / greatest(abs(y_true), 1.0)) * 100",
    "zero_to_one": f"avg(abs({ERR} / CASE WHEN y_true = 0 THEN 1.0 ELSE y_true END)) * 100",
}


def _metrics_sql(mape: str) -> str:
    return (f"count(*) AS n, avg(abs{ERR}) AS mae, sqrt(avg({ERR} * {ERR})) AS rmse, "
            f"{MAPE_SQL[mape]} AS mape")


MET = ["mae", "rmse", "mape"]
BOARD_CTE = f"lb AS (SELECT split, model, {_metrics_sql('zero_to_one')} FROM cp GROUP BY 1, 2)"
BEST_CTE = "best AS (SELECT model, mae FROM lb WHERE split = 'test' ORDER BY mae, model LIMIT 1)"
RES_CTE = ("res AS (SELECT pr.*, y_pred - y_true AS residual FROM pr SEMI JOIN best USING (model) "
           "WHERE split = 'test' AND y_pred - y_true IS NOT NULL)")


def _preds(spark, d):
    return naive_predictions(_final(spark, d), TRAIN_END, VAL_END)


def _board(spark, d):
    return E.leaderboard(_preds(spark, d), mape="zero_to_one")


@register("naive_predictions", with_views("SELECT * FROM pr", *PRED_CTES), doubles=["y_true", "y_pred"])
def naive_predictions_q(spark, d):
    """Long predictions table (seasonal naive lag 7, 7-day mean) for val and test."""
    return _preds(spark, d)


@register("naive_metrics_clip", with_views(f"SELECT split, model, {_metrics_sql('clip')} FROM cp GROUP BY 1, 2",
                                           *PRED_CTES), doubles=MET)
def naive_metrics_clip(spark, d):
    """MAE / RMSE / MAPE with denominator max(|y|, 1), per split and model."""
    return E.metrics(_preds(spark, d), ["split", "model"], mape="clip")


@register("naive_metrics_zero", with_views(
    f"SELECT split, model, {_metrics_sql('zero_to_one')} FROM cp GROUP BY 1, 2", *PRED_CTES), doubles=MET)
def naive_metrics_zero(spark, d):
    """MAE / RMSE / MAPE with denominator y (1 where y == 0), per split and model."""
    return E.metrics(_preds(spark, d), ["split", "model"], mape="zero_to_one")


@register("leaderboard", with_views("SELECT * FROM lb", *PRED_CTES, BOARD_CTE), doubles=MET)
def leaderboard(spark, d):
    """Metrics per split and model over rows where both values are present."""
    return _board(spark, d)


@register("leaderboard_common", with_views(
    f"SELECT split, model, {_metrics_sql('zero_to_one')} FROM cp SEMI JOIN cells USING (split, store_nbr, date) "
    "GROUP BY 1, 2", *PRED_CTES,
    "nm AS (SELECT split, count(DISTINCT model) AS nm FROM cp GROUP BY 1)",
    "cells AS (SELECT c.split, c.store_nbr, c.date FROM (SELECT split, store_nbr, date, count(DISTINCT model) AS c "
    "FROM cp GROUP BY 1, 2, 3) c JOIN nm USING (split) WHERE c.c = nm.nm)"), doubles=MET)
def leaderboard_common(spark, d):
    """Leaderboard restricted to the rows every model predicted."""
    return E.leaderboard(_preds(spark, d), mape="zero_to_one", common=True, models=list(NAIVE_MODELS))


@register("val_vs_test", with_views(
    "SELECT v.model, v.mae AS mae_val, v.rmse AS rmse_val, v.mape AS mape_val, t.mae AS mae_test, "
    "t.rmse AS rmse_test, t.mape AS mape_test FROM lb v JOIN lb t ON v.model = t.model "
    "WHERE v.split = 'val' AND t.split = 'test'", *PRED_CTES, BOARD_CTE),
    doubles=[f"{m}_{s}" for m in MET for s in ("val", "test")])
def val_vs_test(spark, d):
    """Validation and test metrics side by side, models present in both."""
    return E.val_vs_test(_board(spark, d))


@register("mae_per_series", with_views(
    f"SELECT model, store_nbr, avg(abs{ERR}) AS mae FROM pr WHERE split = 'test' GROUP BY 1, 2", *PRED_CTES),
    doubles=["mae"])
def mae_per_series(spark, d):
    """Test MAE per model and series."""
    return E.mae_per_series(_preds(spark, d).where(F.col("split") == "test"))


@register("worst_series", with_views(
    "SELECT store_nbr, avg(mae) AS mean_mae FROM m WHERE mae IS NOT NULL GROUP BY 1 "
    "HAVING count(*) = (SELECT count(DISTINCT model) FROM pr WHERE split = 'test') "
    "ORDER BY mean_mae DESC, store_nbr LIMIT 10",
    *PRED_CTES,
    f"m AS (SELECT model, store_nbr, avg(abs{ERR}) AS mae FROM pr WHERE split = 'test' GROUP BY 1, 2)"),
    doubles=["mean_mae"])
def worst_series(spark, d):
    """Ten series with the highest test MAE averaged over models."""
    return E.worst_series(_preds(spark, d).where(F.col("split") == "test"), list(NAIVE_MODELS), 10)


@register("series_model_table", with_views(
    "SELECT store_nbr, " + ", ".join(f"avg(abs{ERR}) FILTER (WHERE model = '{m}') AS mae_{m}" for m in NAIVE_MODELS)
    + " FROM pr WHERE split = 'test' GROUP BY 1 HAVING "
    + " AND ".join(f"avg(abs{ERR}) FILTER (WHERE model = '{m}') IS NOT NULL" for m in NAIVE_MODELS), *PRED_CTES),
    doubles=[f"mae_{m}" for m in NAIVE_MODELS])
def series_model_table(spark, d):
    """Test MAE per series, one column per model."""
    return E.series_model_table(_preds(spark, d).where(F.col("split") == "test"), list(NAIVE_MODELS))


@register("attach_actuals", with_views(
    "SELECT model, store_nbr, date, y_pred, CAST(transactions AS DOUBLE) AS y_true "
    "FROM (SELECT model, store_nbr, date, y_pred FROM pr WHERE split = 'val') p LEFT JOIN tx USING (store_nbr, date)",
    *PRED_CTES), doubles=["y_pred", "y_true"])
def attach_actuals_q(spark, d):
    """Validation predictions without their actuals, joined to the panel again."""
    p = _preds(spark, d).where(F.col("split") == "val").select("model", "store_nbr", "date", "y_pred")
    return E.attach_actuals(p, _tx(spark, d)).select("model", "store_nbr", "date", "y_pred", "y_true")


@register("best_model", with_views("SELECT model, mae FROM best", *PRED_CTES, BOARD_CTE, BEST_CTE), doubles=["mae"])
def best_model(spark, d):
    """Model with the smallest test MAE."""
    return E.best_model(_board(spark, d), "test")


@register("forecast_vs_actual", with_views(
    "SELECT date, y_true, " + ", ".join(f"avg(y_pred) FILTER (WHERE model = '{m}') AS pred_{m}" for m in NAIVE_MODELS)
    + f" FROM pr WHERE split = 'test' AND store_nbr = {PICK_SQL} GROUP BY date, y_true", *PRED_CTES),
    doubles=["y_true"] + [f"pred_{m}" for m in NAIVE_MODELS])
def forecast_vs_actual(spark, d):
    """One series on the test split: actual and each model's prediction by date."""
    p = _preds(spark, d).where(F.col("split") == "test")
    return E.forecast_vs_actual(p, pick_series(_tx(spark, d)), list(NAIVE_MODELS))


def _best_residuals(spark, d):
    p = _preds(spark, d)
    best = E.best_model(E.leaderboard(p, mape="zero_to_one"), "test").select("model")
    return E.residuals(p.where(F.col("split") == "test").join(best, "model", "left_semi"))


@register("residual_summary", with_views(
    "SELECT count(*) AS n, avg(residual) AS bias, stddev_samp(residual) AS std FROM res",
    *PRED_CTES, BOARD_CTE, BEST_CTE, RES_CTE), doubles=["bias", "std"])
def residual_summary(spark, d):
    """Bias and spread of the best model's test residuals."""
    return E.best_residual_summary(_preds(spark, d))


@register("residual_rows", with_views(
    "SELECT model, store_nbr, date, y_true, y_pred, residual FROM res", *PRED_CTES, BOARD_CTE, BEST_CTE, RES_CTE),
    doubles=["y_true", "y_pred", "residual"])
def residual_rows(spark, d):
    """Test rows of the best model with actual, prediction and residual."""
    return _best_residuals(spark, d).select("model", "store_nbr", "date", "y_true", "y_pred", "residual")


RES_HIST = _hist_sql("res", "residual", 60, *(PRED_CTES + (BOARD_CTE, BEST_CTE, RES_CTE)))


@register("residual_histogram", RES_HIST, doubles=["bin_lo", "bin_hi"])
def residual_histogram(spark, d):
    """60-bin histogram of the best model's test residuals."""
    return P.histogram(_best_residuals(spark, d), "residual", 60)


@register("metrics_report", with_views(
    "SELECT model, round(mae, 2) AS mae, round(rmse, 2) AS rmse, round(mape, 2) AS mape FROM lb "
    "WHERE split = 'val' ORDER BY mae, model", *PRED_CTES, BOARD_CTE), doubles=MET)
def metrics_report(spark, d):
    """Validation metrics per model rounded to 2 places, sorted by MAE."""
    b = _board(spark, d).where(F.col("split") == "val")
    return b.select("model", *[F.round(m, 2).alias(m) for m in MET]).orderBy("mae", "model")


@register("residual_series", with_views(
    f"SELECT date, residual FROM res WHERE store_nbr = {PICK_SQL}", *PRED_CTES, BOARD_CTE, BEST_CTE, RES_CTE),
    doubles=["residual"])
def residual_series(spark, d):
    """The best model's test residuals of one series by date."""
    return _best_residuals(spark, d).where(F.col("store_nbr") == pick_series(_tx(spark, d))).select(
        "date", "residual")
