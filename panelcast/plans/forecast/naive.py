"""Naive predictors written straight from feature columns.

They are exact in SQL, so the evaluation operators get exact oracles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.operators.split import split_label

KEY, DATE, TARGET = "store_nbr", "date", "transactions"

# model name -> feature column used as the prediction
NAIVE_MODELS = {"naive_lag7": "lag_7", "naive_mean7": "rolling_mean_7_days"}


def naive_predictions(final: DataFrame, train_end: str, val_end: str, models: dict[str, str] = NAIVE_MODELS,
                      key=KEY, date_col=DATE, target=TARGET) -> DataFrame:
    """Long predictions table for the val and test splits: one row per model
    and feature row (stacked with ``explode`` over a literal array of
    (model, column) structs, no union of re-scans)."""
    base = final.withColumn("split", split_label(train_end, val_end, date_col)).where(F.col("split") != "train")
    pairs = F.array(*[F.struct(F.lit(m).alias("model"), F.col(c).cast("double").alias("y_pred"))
                      for m, c in models.items()])
    return base.select("split", F.explode(pairs).alias("_p"), F.col(key), F.col(date_col),
                       F.col(target).cast("double").alias("y_true")).select(
        "split", "_p.model", key, date_col, "y_true", "_p.y_pred")
