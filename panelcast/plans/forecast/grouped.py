"""Shared driver for per-series forecasting jobs.

One ``groupBy(key).applyInPandas`` pass: each group carries the series'
history (``is_train``) and the rows to forecast, so a single shuffle on the
key feeds every model fit and no co-grouping of two filtered views of one
frame is needed. A group is one series with one row per day (plus the few
rows a calendar join repeats), so its size is bounded by the calendar span,
not by the table. Numerical failures never raise: every requested row is returned,
with ``y_pred`` null and the reason in ``status``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.functions.core import as_list, by_key

KEY, DATE, TARGET = "store_nbr", "date", "transactions"
# Errors of the numerics that make a series' status; anything else is a coding error and raises.
MODEL_ERRORS = (np.linalg.LinAlgError, FloatingPointError, ValueError)

# fit_forecast(y_train, X_train, X_future, dates_train, dates_future) -> predictions (len(X_future))
FitForecast = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def run_grouped(rows: DataFrame, fit_forecast: FitForecast, exog: Sequence[str], is_train: Column | str = "is_train",
                key: str | Sequence[str] = KEY, date_col=DATE, target=TARGET) -> DataFrame:
    """Fit on the rows that ``is_train`` marks and forecast the others, for every series.

    One frame holds both, so its plan runs once. Keys keep their names and
    types. Forecasts are by position: the i-th future row (date order) is step i.
    """
    exog, keys = list(exog), as_list(key)
    train = F.col(is_train) if isinstance(is_train, str) else is_train
    both = rows.select(*keys, F.col(date_col), F.col(target).cast("double").alias("_y"), train.alias("_is_train"),
                       *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(exog)])
    inputs = [f"_x{i}" for i in range(len(exog))]
    schema = T.StructType([both.schema[c] for c in [*keys, date_col]]).add("y_true", "double").add("y_pred", "double").add(
        "status", "string")

    def per_series(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(date_col, kind="stable")
        tr, fu = pdf[pdf["_is_train"]], pdf[~pdf["_is_train"]]
        out = fu[[*keys, date_col]].reset_index(drop=True).assign(y_true=fu["_y"].to_numpy(dtype=float))
        if len(fu) == 0:
            return out.assign(y_pred=np.array([], dtype=float), status=np.array([], dtype=object))
        try:
            pred = np.asarray(fit_forecast(
                tr["_y"].to_numpy(dtype=float), tr[inputs].to_numpy(dtype=float),
                fu[inputs].to_numpy(dtype=float), tr[date_col].to_numpy(), fu[date_col].to_numpy()), dtype=float)
            if pred.shape != (len(fu),) or not np.all(np.isfinite(pred)):
                raise FloatingPointError("non-finite forecast")
            return out.assign(y_pred=pred, status="ok")
        except SkipSeries as e:
            return out.assign(y_pred=np.nan, status=f"skipped: {e}")
        except MODEL_ERRORS as e:
            return out.assign(y_pred=np.nan, status=f"failed: {type(e).__name__}: {str(e)[:120]}")

    return by_key(both, keys).groupBy(*keys).applyInPandas(per_series, schema)


def marked(history: DataFrame, future: DataFrame) -> DataFrame:
    """Two frames as one with ``is_train`` (for callers that hold them apart)."""
    return history.withColumn("is_train", F.lit(True)).unionByName(future.withColumn("is_train", F.lit(False)))


class SkipSeries(Exception):
    """Raised by a model for series that its input rules exclude."""


def lstsq(X: np.ndarray, y: np.ndarray, ridge: np.ndarray | float = 0.0) -> np.ndarray:
    """(Penalised) least squares via an augmented system; min-norm on rank loss."""
    if np.ndim(ridge) == 0 and ridge == 0:
        return np.linalg.lstsq(X, y, rcond=None)[0]
    lam = np.broadcast_to(np.asarray(ridge, dtype=float), (X.shape[1],))
    Xa = np.vstack([X, np.diag(np.sqrt(lam))])
    ya = np.concatenate([y, np.zeros(X.shape[1])])
    return np.linalg.lstsq(Xa, ya, rcond=None)[0]
