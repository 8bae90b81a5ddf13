"""Direct multi-horizon linear forecast over scaled sequence windows.

One global model, one output per horizon step (the direct strategy of
linear long-horizon forecasters, Zeng et al. 2023): the next ``H`` scaled
values are linear in the scaled last ``L`` values (plus optional static and
window-mean exogenous inputs). All horizons share one Gram matrix, so the
fit is a single distributed pass:

1. the history is windowed once; each partition folds its training windows
   into ``Z^T Z`` with ``Z = [X, 1, Y]`` (numpy inside ``mapInPandas``),
   emits the upper triangle as one array and passes each series' last
   window through; that small output is checkpointed;
2. the arrays are added up in two levels (one array per partition, then
   about sqrt(partitions) groups), independent of the number of windows;
3. the driver solves the ridge system of size (L + 1 + extras), bounded by
   the lookback, not by the data.

Prediction applies the small weight matrix to the last window of each
series (``mapInPandas``) and un-scales.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.functions.core import as_list
from panelcast.operators.evaluate import attach_actuals
from panelcast.plans.forecast.sequence import HORIZON, LOOKBACK, window_frames
from panelcast.session import checkpoint_dir

KEY, DATE, TARGET = "store_nbr", "date", "transactions"
FAN_IN = 64  # Gram arrays added up by one task


def _design(pdf: pd.DataFrame, extras: Sequence[str]) -> np.ndarray:
    X = np.vstack(pdf["input"].to_numpy()) if len(pdf) else np.zeros((0, 0))
    cols = [X, np.ones((len(pdf), 1))]
    if extras:
        cols.append(pdf[list(extras)].to_numpy(dtype=float))
    return np.hstack(cols)


def predict_direct_linear(windows: DataFrame, weights: np.ndarray, extras: Sequence[str] = (), key=KEY,
                          date_col=DATE) -> DataFrame:
    """Forecast H calendar days after each window's last date."""
    extras, keys = list(extras), as_list(key)
    W = weights
    H = W.shape[1]

    def apply(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            if len(pdf) == 0:
                continue
            yhat = _design(pdf, extras) @ W
            sd = pdf["x_std"].to_numpy(dtype=float)
            sd = np.where(sd > 0, sd, 1.0)
            y = yhat * sd[:, None] + pdf["x_mean"].to_numpy(dtype=float)[:, None]
            n = len(pdf)
            last = pd.to_datetime(pdf[date_col]).to_numpy().astype("datetime64[D]")
            yield pd.DataFrame({
                **{k: np.repeat(pdf[k].to_numpy(), H) for k in keys},
                date_col: (np.repeat(last, H) + np.tile(np.arange(1, H + 1), n).astype("timedelta64[D]")),
                "y_pred": y.reshape(-1),
            })

    schema = T.StructType([windows.schema[k] for k in keys]).add(date_col, "date").add("y_pred", "double")
    return windows.select(*keys, date_col, "x_mean", "x_std", "input", *extras).mapInPandas(apply, schema)


def _fit_one_pass(spark: SparkSession, frames: DataFrame, extras: Sequence[str], ridge: float, horizon: int,
                  lookback: int, key=KEY, date_col=DATE):
    """One pass over the windows: each partition folds its training windows
    into a Gram partial and passes its inference windows through. The small
    result is checkpointed (shared checkpoint folder), then reduced to the
    weights and reused for prediction without recomputing the windows."""
    extras, keys = list(extras), as_list(key)
    d = lookback + 1 + len(extras)
    size = d + horizon
    n_cells = size * (size + 1) // 2
    schema = T.StructType().add("kind", T.IntegerType()).add("gram", T.BinaryType())
    for k in keys:
        schema.add(k, frames.schema[k].dataType)
    schema.add(date_col, "date").add("x_mean", "double").add("x_std", "double").add("input", T.ArrayType(T.DoubleType()))
    for c in extras:
        schema.add(c, "double")
    inf_cols = [*keys, date_col, "x_mean", "x_std", "input"] + extras

    def scaled(pdf: pd.DataFrame, col: str) -> np.ndarray:
        # standard scaling by the input window's mean / population std, in bulk
        sd = pdf["x_std"].to_numpy(dtype=float)
        sd = np.where(sd > 0, sd, 1.0)
        return (np.vstack(pdf[col].to_numpy()) - pdf["x_mean"].to_numpy(dtype=float)[:, None]) / sd[:, None]

    def part(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        G = None
        for pdf in it:
            tr = pdf[pdf["_train"]]
            if len(tr):
                A = np.hstack([scaled(tr, "input"), np.ones((len(tr), 1))]
                              + ([tr[extras].to_numpy(dtype=float)] if extras else []))
                Z = np.hstack([A, scaled(tr, "target")])
                g = Z.T @ Z
                G = g if G is None else G + g
            lw = pdf[pdf["_last"]]
            if len(lw):
                out = lw[inf_cols].copy()
                out["input"] = list(scaled(lw, "input"))
                out.insert(0, "gram", None)
                out.insert(0, "kind", 1)
                yield out
        if G is not None:
            row = pd.DataFrame({"kind": [0], "gram": [G[np.triu_indices(size)].tobytes()]})
            for c in inf_cols:
                row[c] = None
            yield row

    def add_up(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for pdf in it:
            for g in pdf["gram"]:
                total = np.frombuffer(g) + (0.0 if total is None else total)
        if total is not None:
            yield pd.DataFrame({"gram": [total.tobytes()]})

    checkpoint_dir(spark)
    res = frames.mapInPandas(part, schema).checkpoint(eager=True)
    # One array per partition, added up in a tree of tasks of FAN_IN arrays each: one array reaches the driver.
    grams, parts = res.where(F.col("kind") == 0).select("gram"), res.rdd.getNumPartitions() + 1
    while parts > 1:
        parts = -(-parts // FAN_IN)
        grams = grams.repartition(parts).mapInPandas(add_up, "gram binary")
    sums = [np.frombuffer(r[0]) for r in grams.collect()]
    if not sums:
        return None, res
    assert len(sums) == 1 and len(sums[0]) == n_cells
    G = np.zeros((size, size))
    G[np.triu_indices(size)] = sums[0]
    G = G + np.triu(G, 1).T
    lam = np.full(d, ridge)
    lam[d - 1 - len(extras)] = 0.0  # no penalty on the intercept
    W = np.linalg.solve(G[:d, :d] + np.diag(lam), G[:d, d:])
    return W, res.where(F.col("kind") == 1).select(*inf_cols)


def forecast_direct_linear(spark: SparkSession, history: DataFrame, actuals: DataFrame, with_exog: bool = False,
                           static: Sequence[str] = ("store_type_enc", "cluster"),
                           hist_exog: Sequence[str] = ("oil_price", "is_national_holiday", "is_day_before_holiday",
                                                       "is_day_after_holiday"),
                           lookback: int = LOOKBACK, horizon: int = HORIZON, ridge: float = 1.0, key=KEY,
                           date_col=DATE, target=TARGET) -> DataFrame:
    """Fit on ``history`` windows, forecast ``horizon`` days after each
    series' last history date, attach actuals from ``actuals`` (left join).
    The history is windowed once (one exchange on the key)."""
    exog = list(hist_exog) if with_exog else []
    stat = list(static) if with_exog else []
    hist = history
    if stat:
        hist = hist.withColumns({c: F.col(c).cast("double") for c in stat})
    extras = [f"{c}_mean" for c in exog] + [f"{c}_mean" for c in stat]
    frames = window_frames(hist, lookback, horizon, key, date_col, target, exog=exog + stat, scale=False)
    W, inf = _fit_one_pass(spark, frames, extras, ridge, horizon, lookback, key, date_col)
    if W is None:  # no series has lookback + horizon rows of history
        warnings.warn("direct linear forecast: no complete training window")
        return attach_actuals(history.select(*as_list(key), date_col, F.lit(None).cast("double").alias("y_pred")).limit(0),
                              actuals, target, key, date_col).select(*as_list(key), date_col, "y_true", "y_pred")
    pred = predict_direct_linear(inf, W, extras, key, date_col)
    return attach_actuals(pred, actuals, target, key, date_col).select(*as_list(key), date_col, "y_true", "y_pred")
