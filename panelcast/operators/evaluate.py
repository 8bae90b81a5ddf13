"""Forecast evaluation on one long predictions table.

Predictions: ``(split, model, <key>, date, y_true, y_pred)``. All metrics are
grouped aggregates (partial aggregation before the shuffle); per-series and
per-model tables are bounded by series x models.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions.core import as_list, sized_broadcast

KEY, DATE = "store_nbr", "date"
PRED_SCHEMA = "split string, model string, store_nbr bigint, date date, y_true double, y_pred double"


def _err():
    return F.col("y_pred") - F.col("y_true")


def metric_exprs(mape: str = "clip"):
    """MAE, RMSE and MAPE (percent) as aggregate expressions.

    ``mape="clip"``: denominator max(|y|, 1); ``mape="zero_to_one"``:
    denominator y, replaced by 1 where y == 0.
    """
    e, y = _err(), F.col("y_true")
    if mape == "clip":
        ape = F.abs(e) / F.greatest(F.abs(y), F.lit(1.0))
    elif mape == "zero_to_one":
        ape = F.abs(e / F.when(y == 0, F.lit(1.0)).otherwise(y))
    else:
        raise ValueError(f"unknown mape form {mape!r}")
    return [
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        (F.avg(ape) * 100).alias("mape"),
    ]


def complete_rows(preds: DataFrame) -> DataFrame:
    """Rows where both the actual and the prediction are present."""
    return preds.where(F.col("y_true").isNotNull() & F.col("y_pred").isNotNull())


def metrics(preds: DataFrame, by: Sequence[str] = (), mape: str = "clip") -> DataFrame:
    return complete_rows(preds).groupBy(*by).agg(*metric_exprs(mape))


def common_rows(preds: DataFrame, key=KEY, date_col=DATE, models: Sequence[str] | None = None) -> DataFrame:
    """Restrict to (split, key, date) cells that every model of the split
    predicted, so that models are ranked on the same rows. ``models`` names
    them; without it they are counted per split, which runs the plan of
    ``preds`` a second time."""
    p = complete_rows(preds)
    if models is not None:
        cell = Window.partitionBy("split", *as_list(key), date_col)
        return p.withColumn("_c", F.size(F.collect_set("model").over(cell))).where(
            F.col("_c") == len(set(models))).drop("_c")
    # models per split: one row per split, broadcast
    n_models = sized_broadcast(p.groupBy("split").agg(F.count_distinct("model").alias("_nm")))
    # models per cell as a window over (split, key, date): one shuffle of the
    # predictions; the set per cell is bounded by the number of models
    cell = Window.partitionBy("split", *as_list(key), date_col)
    counted = p.withColumn("_c", F.size(F.collect_set("model").over(cell)))
    return counted.join(n_models, "split").where(F.col("_c") == F.col("_nm")).drop("_c", "_nm")


def leaderboard(preds: DataFrame, mape: str = "zero_to_one", common: bool = False, key=KEY,
                models: Sequence[str] | None = None) -> DataFrame:
    """Metrics per split and model, over complete rows (optionally the rows
    shared by all models). ``n`` shows how many rows each model was scored on."""
    p = common_rows(preds, key, models=models) if common else preds
    return metrics(p, ["split", "model"], mape)


def val_vs_test(board: DataFrame) -> DataFrame:
    """Models present in both splits with val and test metrics side by side."""
    mets = ("mae", "rmse", "mape")
    wide = board.where(F.col("split").isin("val", "test")).groupBy("model").agg(
        *[F.max(F.when(F.col("split") == s, F.col(m))).alias(f"{m}_{s}") for s in ("val", "test") for m in mets],
        F.count_distinct("split").alias("_n"))
    # conditional aggregation per model instead of a self-join
    return wide.where(F.col("_n") == 2).select("model", *[f"{m}_{s}" for s in ("val", "test") for m in mets])


def mae_per_series(preds: DataFrame, key=KEY) -> DataFrame:
    """Mean absolute error per model and series (null errors skipped)."""
    return preds.groupBy("model", *as_list(key)).agg(F.avg(F.abs(_err())).alias("mae"))


def series_model_table(preds: DataFrame, models: Sequence[str], key=KEY) -> DataFrame:
    """MAE per series, one column per model, series scored by all of them."""
    keys = as_list(key)
    wide = preds.groupBy(*keys).agg(*[F.avg(F.when(F.col("model") == m, F.abs(_err()))).alias(f"mae_{m}") for m in models])
    return wide.dropna(subset=[f"mae_{m}" for m in models])


def worst_series(preds: DataFrame, models: Sequence[str], k: int = 10, key=KEY) -> DataFrame:
    """Series with the highest MAE averaged over ``models``, among series
    scored by every model (inner-join semantics)."""
    per = mae_per_series(preds.where(F.col("model").isin(list(models))), key).where(F.col("mae").isNotNull())
    avg = per.groupBy(*as_list(key)).agg(F.avg("mae").alias("mean_mae"), F.count(F.lit(1)).alias("_m"))
    return avg.where(F.col("_m") == len(set(models))).drop("_m").orderBy(F.desc("mean_mae"), *as_list(key)).limit(k)


def best_model(board: DataFrame, split: str = "test") -> DataFrame:
    """Model with the smallest MAE on ``split`` (ties: model name)."""
    return board.where(F.col("split") == split).orderBy("mae", "model").limit(1).select("model", "mae")


def forecast_vs_actual(preds: DataFrame, key_value, models: Sequence[str], key=KEY, date_col=DATE) -> DataFrame:
    """Actual and every model's prediction for one series, one row per date."""
    one = preds.where(F.col(key) == key_value)
    wide = one.groupBy(date_col, "y_true").pivot("model", list(models)).agg(F.avg("y_pred"))
    return wide.select(date_col, "y_true", *[F.col(f"`{m}`").alias(f"pred_{m}") for m in models])


def residuals(preds: DataFrame) -> DataFrame:
    """``residual = y_pred - y_true`` with null residuals dropped."""
    return preds.withColumn("residual", _err()).where(F.col("residual").isNotNull())


def residual_summary(res: DataFrame) -> DataFrame:
    """Bias (mean residual), sample std and count."""
    return res.agg(F.count(F.lit(1)).alias("n"), F.avg("residual").alias("bias"),
                   F.stddev_samp("residual").alias("std"))


def best_residual_summary(preds: DataFrame, split: str = "test") -> DataFrame:
    """Bias, spread and count of the residuals of the model with the smallest
    MAE on ``split``: one pass over the predictions for all models, then the
    best row (ties: model name)."""
    p = preds.where(F.col("split") == split)
    both = F.col("y_true").isNotNull() & F.col("y_pred").isNotNull()
    per = p.where(both).groupBy("model").agg(
        F.avg(F.abs(_err())).alias("mae"), F.count(F.lit(1)).alias("n"), F.avg(_err()).alias("bias"),
        F.stddev_samp(_err()).alias("std"))
    return per.orderBy("mae", "model").limit(1).select("n", "bias", "std")


def attach_actuals(preds: DataFrame, actuals: DataFrame, target: str = "transactions", key=KEY,
                   date_col=DATE) -> DataFrame:
    """Left join the actual value onto predictions by (key, date)."""
    a = actuals.select(*as_list(key), date_col, F.col(target).cast("double").alias("y_true"))
    return preds.join(a, [*as_list(key), date_col], "left")
