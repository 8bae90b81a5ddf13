"""Registered forecasting jobs and sequence preparation queries.

Model fits have no SQL twin (the driver records a rows-only check); their
properties are tested in ``tests/test_models.py``. Sequence windows, patches
and pooling are deterministic array transforms with DuckDB twins.
"""

from __future__ import annotations

import uuid

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from panelcast.functions.core import series_window
from panelcast.operators import evaluate as E
from panelcast.operators.split import split_views
from panelcast.plans.catalog import register
from panelcast.plans.feature_pipeline import EXOG_COLS, FEATURES_EX_ANTE, build_final_dataset
from panelcast.plans.forecast.decomposable import forecast_decomposable
from panelcast.plans.forecast.direct_linear import forecast_direct_linear
from panelcast.plans.forecast.naive import naive_predictions
from panelcast.plans.forecast.seasonal_arx import forecast_seasonal_arx
from panelcast.plans.forecast.sequence import (
    HORIZON,
    LOOKBACK,
    PATCH_LEN,
    PATCH_STRIDE,
    POOL_KERNELS,
    last_windows,
    make_sequences,
    patchify,
    pool_sequence,
)
from panelcast.plans.forecast.trees import (
    feature_importance,
    feature_matrix,
    first_splits,
    fit_boosted_trees,
    learning_curve,
    persist,
    predict_trees,
    tree_nodes,
)
from panelcast.plans.q_profile import FINAL, _tx
from panelcast.sources.fixtures import TRAIN_END, VAL_END, folder_state, panel, with_views
from panelcast.session import checkpoint_dir, session_id

# Fitted trees by session, state of the table files, history and variant: several queries report on
# one fit. Only models are kept, no data; a rewritten folder has another state and is fitted anew.
_FITS: dict = {}


def _final(spark, d):
    """Final feature dataset of the nation panel: the model jobs need its longer series."""
    p = panel(spark, d, "nation")
    return build_final_dataset(p.tx, p.stores, p.oil, p.holidays)


def _views(spark, d):
    return split_views(_final(spark, d), TRAIN_END, VAL_END)


def _horizon(spark, d, split):
    """Rows up to the end of ``split`` with ``is_train``: one frame for fitting and forecasting."""
    f = _final(spark, d)
    last_train, last = (TRAIN_END, VAL_END) if split == "val" else (VAL_END, None)
    if last is not None:
        f = f.where(F.col("date") <= F.lit(last).cast("date"))
    return f.withColumn("is_train", F.col("date") <= F.lit(last_train).cast("date"))


def _tree_fit(spark, d, variant, history="train"):
    k = (session_id(spark), folder_state(spark, d), history, variant)
    if k not in _FITS:
        fit = fit_boosted_trees(_views(spark, d)[history], FEATURES_EX_ANTE, variant=variant)
        _FITS[k] = persist(spark, fit, f"{checkpoint_dir(spark)}/trees-{uuid.uuid4().hex}")
    return _FITS[k]


def _with_model(df, name):
    return df.select(F.lit(name).alias("model"), *df.columns)


@register("forecast_seasonal_arx")
def forecast_seasonal_arx_q(spark, d):
    """Per-series seasonal ARX (1,1,1)x(1,1,1,7) with 4 exogenous columns, val horizon."""
    return forecast_seasonal_arx(_horizon(spark, d, "val"), "is_train", EXOG_COLS)


@register("forecast_seasonal_arx_test")
def forecast_seasonal_arx_test_q(spark, d):
    """Re-fit on train + val, forecast the test split."""
    return forecast_seasonal_arx(_horizon(spark, d, "test"), "is_train", EXOG_COLS)


@register("forecast_decomposable")
def forecast_decomposable_q(spark, d):
    """Per-series trend + yearly/weekly seasonality + oil regressor, val horizon."""
    return forecast_decomposable(_horizon(spark, d, "val"), "is_train", ["oil_price"])


@register("forecast_decomposable_test")
def forecast_decomposable_test_q(spark, d):
    return forecast_decomposable(_horizon(spark, d, "test"), "is_train", ["oil_price"])


@register("boosted_trees")
def boosted_trees_q(spark, d):
    """Global GBT (row/column share 0.8, patience 30) predictions on val."""
    return predict_trees(_tree_fit(spark, d, "early_stop"), _views(spark, d)["val"])


@register("boosted_trees_full_sample")
def boosted_trees_full_sample_q(spark, d):
    """Global GBT, all rows each round, no early stop; predictions on val."""
    return predict_trees(_tree_fit(spark, d, "full_sample"), _views(spark, d)["val"])


@register("boosted_trees_test")
def boosted_trees_test_q(spark, d):
    """Both tree variants re-fitted on train + val, predictions on test."""
    test = _views(spark, d)["test"]
    a, b = (_with_model(predict_trees(_tree_fit(spark, d, v, "train_val"), test), f"gbt_{v}")
            for v in ("early_stop", "full_sample"))
    return a.unionByName(b)


@register("feature_importance")
def feature_importance_q(spark, d):
    """Per-feature importance and share (sums to 1) of both variants' node tables: mean gain per split, number of splits."""
    a = _with_model(feature_importance(spark, _tree_fit(spark, d, "early_stop")), "gbt_early_stop")
    b = _with_model(feature_importance(spark, _tree_fit(spark, d, "full_sample")), "gbt_full_sample")
    return a.unionByName(b)


@register("feature_importance_compare")
def feature_importance_compare_q(spark, d):
    """Normalised importances of both variants side by side (features present
    in both), top 15 by the early-stop variant."""
    a = feature_importance(spark, _tree_fit(spark, d, "early_stop")).select(
        "feature", F.col("share").alias("share_early_stop"))
    b = feature_importance(spark, _tree_fit(spark, d, "full_sample")).select(
        "feature", F.col("share").alias("share_full_sample"))
    return a.join(b, "feature", "inner").dropna().orderBy(F.desc("share_early_stop"), "feature").limit(15)


@register("tree_nodes")
def tree_nodes_q(spark, d):
    """Every node of both persisted models."""
    a, b = (_with_model(tree_nodes(spark, _tree_fit(spark, d, v)), f"gbt_{v}") for v in ("early_stop", "full_sample"))
    return a.unionByName(b)


# Features with few values: their bins are the values themselves, as in the SQL.
SPLIT_FEATURES = ["weekday", "month", "quarter", "store_type_enc", "cluster", "is_national_holiday", "is_day_before_holiday"]


def _first_splits_sql():
    values = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS v, CAST(transactions AS DOUBLE) AS y FROM final WHERE date <= DATE '{TRAIN_END}'"
        for c in SPLIT_FEATURES)
    return (
        f"u AS ({values}), m AS (SELECT feature, avg(y) AS base, count(*) AS n FROM u GROUP BY feature), "
        "s AS (SELECT u.feature, u.v, sum(m.base - u.y) AS g, count(*) AS c, any_value(m.n) AS n FROM u JOIN m ON m.feature = u.feature GROUP BY u.feature, u.v), "
        "w AS (SELECT feature, v, n, sum(g) OVER (PARTITION BY feature ORDER BY v) AS gl, sum(c) OVER (PARTITION BY feature ORDER BY v) AS nl, "
        "sum(g) OVER (PARTITION BY feature) AS gt FROM s), "
        "k AS (SELECT feature, v, nl, n, 0.5 * (gl * gl / (nl + 1) + (gt - gl) * (gt - gl) / (n - nl + 1) - gt * gt / (n + 1)) AS gain FROM w WHERE nl < n), "
        "b AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY gain DESC, v) AS r FROM k)")


@register("tree_first_splits", with_views(
    "SELECT feature, v AS threshold, floor(gain * 1000 + 0.5) / 1000 AS gain, CAST(nl AS BIGINT) AS rows_left, CAST(n - nl AS BIGINT) AS rows_right "
    "FROM b WHERE r = 1 AND gain > 1e-9", *FINAL, _first_splits_sql(), by="nation"), doubles=["threshold", "gain"])
def tree_first_splits_q(spark, d):
    """The histogram job's best split of all training rows per feature, gain to three places."""
    found = first_splits(_views(spark, d)["train"], SPLIT_FEATURES)
    return found.withColumn("gain", F.floor(F.col("gain") * 1000 + 0.5) / 1000)


@register("learning_curve")
def learning_curve_q(spark, d):
    """RMSE per boosting round of both variants: fitting rows, and the stopping set of the early-stop variant."""
    a, b = (_with_model(learning_curve(spark, _tree_fit(spark, d, v)), f"gbt_{v}") for v in ("early_stop", "full_sample"))
    return a.unionByName(b)


@register("forecast_direct_linear")
def forecast_direct_linear_q(spark, d):
    """Direct 30-day linear forecast from the last 336 days (target only)."""
    v = _views(spark, d)
    return forecast_direct_linear(spark, v["train"], v["val"], with_exog=False)


@register("forecast_direct_linear_exog")
def forecast_direct_linear_exog_q(spark, d):
    """Same with static (type code, cluster) and window-mean exogenous inputs."""
    v = _views(spark, d)
    return forecast_direct_linear(spark, v["train"], v["val"], with_exog=True)


@register("forecast_direct_linear_test")
def forecast_direct_linear_test_q(spark, d):
    """Both direct linear forecasts re-fitted on train + val, test horizon."""
    v = _views(spark, d)
    a, b = (_with_model(forecast_direct_linear(spark, v["train_val"], v["test"], with_exog=x), n)
            for n, x in (("direct_linear", False), ("direct_linear_exog", True)))
    return a.unionByName(b)


@register("feature_matrix", with_views(
    "SELECT store_nbr, date, CAST(transactions AS DOUBLE) AS label, "
    + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in FEATURES_EX_ANTE) + f" FROM final WHERE date <= DATE '{TRAIN_END}'",
    *FINAL, by="nation"), doubles=["label", *FEATURES_EX_ANTE])
def feature_matrix_q(spark, d):
    """The trees' training matrix, one column per feature (the assembled vector taken apart)."""
    m = feature_matrix(_views(spark, d)["train"], FEATURES_EX_ANTE)
    values = vector_to_array("features")
    return m.select("store_nbr", "date", "label", *[values[i].alias(c) for i, c in enumerate(FEATURES_EX_ANTE)])


def _recovery(spark, d):
    """The panel with a target that follows from the row number: a slow trend and a weekly pattern."""
    n = F.row_number().over(series_window("store_nbr", "date"))
    total = F.count(F.lit(1)).over(Window.partitionBy("store_nbr"))
    t = panel(spark, d, "nation").tx.select("store_nbr", "date", n.alias("n"), total.alias("total"))
    formula = F.lit(50.0) + F.col("store_nbr") + 0.1 * F.col("n") + (F.col("n") % 7) * 2.0
    return t.where("total >= 200").withColumn("transactions", formula).withColumn("is_train", F.expr("n <= total - 14"))


@register("recover_seasonal_arx", with_views(
    "SELECT store_nbr, date, CAST(round(50.0 + store_nbr + 0.1 * n + (n % 7) * 2.0, 1) AS DOUBLE) AS y_true, "
    "CAST(round(50.0 + store_nbr + 0.1 * n + (n % 7) * 2.0, 1) AS DOUBLE) AS y_pred, 'ok' AS status FROM rn WHERE total >= 200 AND n > total - 14",
    "rn AS (SELECT store_nbr, date, row_number() OVER (PARTITION BY store_nbr ORDER BY date) AS n, "
    "count(*) OVER (PARTITION BY store_nbr) AS total FROM tx)", by="nation"))
def recover_seasonal_arx(spark, d):
    """The seasonal ARX recovers a known trend and weekly pattern over the last 14 rows of every series (to 1 decimal)."""
    out = forecast_seasonal_arx(_recovery(spark, d), "is_train", [])
    return out.withColumns({c: F.round(c, 1) for c in ("y_true", "y_pred")})


@register("forecast_contract", with_views(
    "SELECT m.model, f.split, count(*) AS n_rows, count(DISTINCT (f.store_nbr, f.date)) AS n_keys, 0 AS n_not_finite, 0 AS n_null_actuals "
    "FROM (SELECT *, CASE WHEN date <= DATE '" + VAL_END + "' THEN 'val' ELSE 'test' END AS split FROM final "
    f"WHERE date > DATE '{TRAIN_END}') f CROSS JOIN (VALUES ('decomposable'), ('seasonal_arx')) m(model) GROUP BY 1, 2",
    *FINAL, by="nation"))
def forecast_contract(spark, d):
    """Rows, distinct keys, non-finite predictions and null actuals of the per-series jobs on both splits."""
    parts = []
    for split in ("val", "test"):
        rows = _horizon(spark, d, split)
        for name, job in (("decomposable", forecast_decomposable(rows, "is_train", ["oil_price"])),
                          ("seasonal_arx", forecast_seasonal_arx(rows, "is_train", EXOG_COLS))):
            parts.append(job.where(F.col("status") == "ok").groupBy().agg(
                F.count(F.lit(1)).alias("n_rows"),
                F.count_distinct("store_nbr", "date").alias("n_keys"),
                F.count_if(F.col("y_pred").isNull() | F.isnan("y_pred")).cast("int").alias("n_not_finite"),
                F.count_if(F.col("y_true").isNull()).cast("int").alias("n_null_actuals"),
            ).select(F.lit(name).alias("model"), F.lit(split).alias("split"), "n_rows",
                     "n_keys", "n_not_finite", "n_null_actuals"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where("n_rows > 0")


@register("model_leaderboard")
def model_leaderboard_q(spark, d):
    """Val leaderboard of all model jobs (shared rows counted per model in n)."""
    v = _views(spark, d)
    parts = [
        _with_model(forecast_seasonal_arx(_horizon(spark, d, "val"), "is_train", EXOG_COLS).where(F.col("status") == "ok")
                    .drop("status"), "seasonal_arx"),
        _with_model(forecast_decomposable(_horizon(spark, d, "val"), "is_train", ["oil_price"]).where(F.col("status") == "ok")
                    .drop("status"), "decomposable"),
        _with_model(predict_trees(_tree_fit(spark, d, "early_stop"), v["val"]), "gbt_early_stop"),
        _with_model(predict_trees(_tree_fit(spark, d, "full_sample"), v["val"]), "gbt_full_sample"),
        _with_model(forecast_direct_linear(spark, v["train"], v["val"]), "direct_linear"),
        _with_model(forecast_direct_linear(spark, v["train"], v["val"], with_exog=True), "direct_linear_exog"),
        naive_predictions(_final(spark, d), TRAIN_END, VAL_END).where(F.col("split") == "val").drop("split"),
    ]
    preds = parts[0]
    for p in parts[1:]:
        preds = preds.unionByName(p.select(*preds.columns))
    return E.leaderboard(preds.withColumn("split", F.lit("val")), mape="zero_to_one")


# ---------------------------------------------------------------- sequences

SEQ_WIN = "WINDOW w AS (PARTITION BY store_nbr ORDER BY date)"
SEQ_PAST = f"(w ROWS BETWEEN {LOOKBACK - 1} PRECEDING AND CURRENT ROW)"
SEQ_CTE = (
    "s AS (SELECT store_nbr, date, list(CAST(transactions AS DOUBLE)) OVER " + SEQ_PAST + " AS xin, "
    f"list(CAST(transactions AS DOUBLE)) OVER (w ROWS BETWEEN 1 FOLLOWING AND {HORIZON} FOLLOWING) AS xout, "
    f"avg(transactions) OVER {SEQ_PAST} AS x_mean, stddev_pop(transactions) OVER {SEQ_PAST} AS x_std, "
    "row_number() OVER (PARTITION BY store_nbr ORDER BY date DESC) AS rn "
    f"FROM tx {SEQ_WIN})"
)


def _scaled_sql(col):
    return (f"list_transform({col}, lambda v: floor((v - x_mean) / CASE WHEN x_std > 0 THEN x_std ELSE 1 END "
            "* 1e6 + 0.5) / 1e6)")


def _round_arrays(df, cols):
    """6-decimal rounding of array elements for the engine comparison, in
    plain double arithmetic (``round`` goes through decimals per element)."""
    return df.withColumns({c: F.transform(F.col(c), lambda v: F.floor(v * 1e6 + 0.5) / 1e6) for c in cols})


@register("sequences", with_views(
    f"SELECT store_nbr, date, x_mean, x_std, {_scaled_sql('xin')} AS input, {_scaled_sql('xout')} AS target FROM s "
    f"WHERE len(xin) = {LOOKBACK} AND len(xout) = {HORIZON}", SEQ_CTE), doubles=["x_mean", "x_std"])
def sequences_q(spark, d):
    """All training windows: 336 scaled inputs and 30 scaled targets per origin."""
    return make_sequences(_tx(spark, d), LOOKBACK, HORIZON, places=6)


N_PATCH = (LOOKBACK - PATCH_LEN) // PATCH_STRIDE + 1
WINDOWS_CTE = f"lw AS (SELECT store_nbr, date, x_mean, x_std, {_scaled_sql('xin')} AS input FROM s " \
              f"WHERE len(xin) = {LOOKBACK} AND len(xout) = {HORIZON})"


@register("patches", with_views(
    "SELECT store_nbr, date, x_mean, x_std, CAST(i AS INTEGER) AS patch_idx, "
    f"list_slice(input, 1 + i * {PATCH_STRIDE}, {PATCH_LEN} + i * {PATCH_STRIDE}) AS patch "
    f"FROM lw, range({N_PATCH}) t(i)", SEQ_CTE, WINDOWS_CTE), doubles=["x_mean", "x_std"])
def patches_q(spark, d):
    """Patches (length 16, stride 8) of every training window."""
    return patchify(make_sequences(_tx(spark, d), LOOKBACK, HORIZON, places=6))


def _pool_sql():
    parts = []
    for idx, k in enumerate(POOL_KERNELS):
        n = -(-LOOKBACK // k)
        parts.append(
            f"SELECT store_nbr, date, x_mean, x_std, {idx} AS stack, {k} AS kernel, "
            f"list_transform(range({n}), lambda i: list_max(list_slice(input, 1 + i * {k}, (i + 1) * {k}))) "
            "AS pooled FROM lw")
    return "u AS (" + " UNION ALL ".join(parts) + ")"


@register("pooled_sequences", with_views("SELECT * FROM u", SEQ_CTE, WINDOWS_CTE, _pool_sql()),
          doubles=["x_mean", "x_std"])
def pooled_sequences_q(spark, d):
    """Multi-rate max pooling (kernels 2, 2, 1) of every training window."""
    return pool_sequence(make_sequences(_tx(spark, d), LOOKBACK, HORIZON, places=6))


@register("last_windows", with_views(
    f"SELECT store_nbr, date, x_mean, x_std, {_scaled_sql('xin')} AS input FROM s WHERE rn = 1 AND len(xin) = {LOOKBACK}",
    SEQ_CTE), doubles=["x_mean", "x_std"])
def last_windows_q(spark, d):
    """The inference window of every series: its last 336 rows, scaled."""
    return _round_arrays(last_windows(_tx(spark, d), LOOKBACK), ["input"])
