"""End-to-end study: features -> split -> forecasting jobs -> evaluation,
with every intermediate written as a table (the reference's flow of files).

Outputs under ``out_dir`` (a shared folder on a cluster):

    final_dataset/   partitioned by year (date filters prune partitions)
    predictions/     long table partitioned by split and model; each job
                     replaces only its own partitions (dynamic overwrite)
    metrics/         leaderboard per split and model
    models/gbt_*     node and feature tables of the tree models

Writing the final dataset also cuts the lineage for the model jobs, which
read it back instead of re-deriving the features.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.operators import evaluate as E
from panelcast.operators.split import split_views
from panelcast.plans.feature_pipeline import EXOG_COLS, FEATURES_EX_ANTE, build_final_dataset
from panelcast.plans.forecast.decomposable import forecast_decomposable
from panelcast.plans.forecast.direct_linear import forecast_direct_linear
from panelcast.plans.forecast.grouped import marked
from panelcast.plans.forecast.naive import naive_predictions
from panelcast.plans.forecast.seasonal_arx import forecast_seasonal_arx
from panelcast.plans.forecast.trees import N_ROUNDS, fit_boosted_trees, predict_trees
from panelcast.sources.fixtures import Panel
from panelcast.sources.io import read_table, save_trees, write_table

PRED_COLS = ["store_nbr", "date", "y_true", "y_pred"]


def _tag(df: DataFrame, split: str, model: str) -> DataFrame:
    return df.select(F.lit(split).alias("split"), F.lit(model).alias("model"), *PRED_COLS)


def run_study(spark: SparkSession, p: Panel, out_dir: str, train_end: str, val_end: str,
              tree_rounds: int = N_ROUNDS) -> DataFrame:
    """Run every job for the val split (fit on train) and the test split
    (fit on train + val); return the metrics table."""
    write_table(build_final_dataset(p.tx, p.stores, p.oil, p.holidays).withColumn("year", F.year("date")),
                f"{out_dir}/final_dataset", ["year"])
    final = read_table(spark, f"{out_dir}/final_dataset")
    v = split_views(final, train_end, val_end)
    pred_path = f"{out_dir}/predictions"

    write_table(naive_predictions(final, train_end, val_end), pred_path, ["split", "model"], dynamic=True)
    for split, hist, fut in (("val", v["train"], v["val"]), ("test", v["train_val"], v["test"])):
        jobs = {
            "seasonal_arx": forecast_seasonal_arx(marked(hist, fut), "is_train", EXOG_COLS).where(F.col("status") == "ok"),
            "decomposable": forecast_decomposable(marked(hist, fut), "is_train", ["oil_price"]).where(F.col("status") == "ok"),
            "direct_linear": forecast_direct_linear(spark, hist, fut),
            "direct_linear_exog": forecast_direct_linear(spark, hist, fut, with_exog=True),
        }
        for variant in ("early_stop", "full_sample"):
            fit = fit_boosted_trees(hist, FEATURES_EX_ANTE, variant=variant, rounds=tree_rounds)
            save_trees(fit.model, spark, f"{out_dir}/models/gbt_{variant}_{split}")
            jobs[f"gbt_{variant}"] = predict_trees(fit, fut)
        for model, df in jobs.items():
            write_table(_tag(df, split, model), pred_path, ["split", "model"], dynamic=True)

    preds = read_table(spark, pred_path)
    board = E.leaderboard(preds, mape="zero_to_one")
    write_table(board, f"{out_dir}/metrics")
    return read_table(spark, f"{out_dir}/metrics")
