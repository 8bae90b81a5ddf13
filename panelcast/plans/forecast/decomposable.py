"""Decomposable forecast per series: piecewise-linear trend + yearly and
weekly Fourier seasonality + extra regressors (the additive structure of
Taylor & Letham 2018). The most probable coefficients are computed, not
sampled: Laplace priors on the trend changes, so most of them are exactly
zero, Gaussian ones on seasonal terms and regressors. These are eliminated
first; the trend changes follow by coordinate descent on what is left.

Series rules: skipped when the training target has missing values, is all
zero, or has no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame

from panelcast.plans.forecast.grouped import SkipSeries, lstsq, run_grouped

# Fixed values (must equal the reference): prior scales and seasonalities.
CHANGEPOINT_PRIOR = 0.01
SEASONALITY_PRIOR = 1.0
YEARLY_ORDER, WEEKLY_ORDER = 10, 3
N_CHANGEPOINTS, CHANGEPOINT_RANGE = 25, 0.8
SPREAD = 0.05  # of the largest trend change: smaller ones are penalised up to 1 / SPREAD times as much


def _days(d: np.ndarray) -> np.ndarray:
    return d.astype("datetime64[D]").astype(np.int64).astype(float)


def _fourier(t_days: np.ndarray, period: float, order: int) -> np.ndarray:
    k = np.arange(1, order + 1)
    ang = 2 * np.pi * np.outer(t_days, k) / period
    return np.hstack([np.sin(ang), np.cos(ang)])


def sparse_fit(S: np.ndarray, A: np.ndarray, y: np.ndarray, ridge: np.ndarray, penalty: float,
               reweights: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """(sparse, other) coefficients that minimise |y - S s - A a|^2 / 2 + sum(penalty |s|) + sum(ridge a^2) / 2.

    The others have a closed form given s; put in, they leave a problem in s
    alone, solved by coordinate descent over the coefficients that are not zero, until no
    coefficient breaks the optimality condition. Neighbouring trend changes are nearly alike, so a
    single one is at first spread over neighbours: ``reweights`` times the problem is solved again with
    a penalty that grows where the last coefficient was small beside the largest one.
    """
    fitted = lambda t: lstsq(A, t, ridge=ridge)
    if not S.shape[1]:
        return np.zeros(0), fitted(y)
    G = S.T @ (S - A @ np.column_stack([fitted(c) for c in S.T]))
    c = S.T @ (y - A @ fitted(y))
    G = (G + G.T) / 2
    weights = np.full(len(c), penalty)
    s = _descend(G, c, weights)
    for _ in range(reweights):
        largest = float(np.abs(s).max())
        if largest == 0:
            break
        weights = penalty * (1 + SPREAD) / (np.abs(s) / largest + SPREAD)
        s = _descend(G, c, weights)
    return s, fitted(y - S @ s)


def _descend(G: np.ndarray, c: np.ndarray, penalty: np.ndarray, sweeps: int = 20_000) -> np.ndarray:
    """s that minimises s'Gs / 2 - c's + sum(penalty |s|)."""
    s, slack = np.zeros(len(c)), 1e-9 * max(float(np.abs(c).max()), float(penalty.max()))
    free = np.diag(G) > 1e-12 * max(float(np.diag(G).max()), 1e-300)
    for _ in range(sweeps):
        moved = 0.0
        for j in np.flatnonzero((s != 0) & free).tolist():
            z = c[j] - G[j] @ s + G[j, j] * s[j]
            new = np.sign(z) * max(abs(z) - penalty[j], 0.0) / G[j, j]
            moved, s[j] = max(moved, abs(new - s[j]) * G[j, j]), new
        if moved > slack:
            continue
        over = np.where((s == 0) & free, np.abs(c - G @ s) - penalty, -np.inf)
        worst = int(over.argmax())
        if over[worst] <= slack:
            break
        z = c[worst] - G[worst] @ s
        s[worst] = np.sign(z) * (abs(z) - penalty[worst]) / G[worst, worst]
    return s


def fit_forecast(y: np.ndarray, X: np.ndarray, X_future: np.ndarray, d_train: np.ndarray,
                 d_future: np.ndarray) -> np.ndarray:
    if len(y) == 0:
        raise SkipSeries("no rows")
    if not np.all(np.isfinite(y)):
        raise SkipSeries("target has missing values")
    if np.all(y == 0):
        raise SkipSeries("target is all zero")
    td, fd = _days(d_train), _days(d_future)
    t0, span = td.min(), max(td.max() - td.min(), 1.0)
    y_scale = max(np.abs(y).max(), 1e-12)
    ys = y / y_scale
    # changepoints on the first 80% of the history
    hist = np.sort(td)
    cp_idx = np.linspace(0, int(np.floor(len(hist) * CHANGEPOINT_RANGE)) - 1, N_CHANGEPOINTS + 1)[1:]
    cps = (hist[np.clip(cp_idx.round().astype(int), 0, len(hist) - 1)] - t0) / span if len(hist) > 2 else np.array([])
    # regressors standardised on the training rows
    mu = X.mean(axis=0) if X.size else np.zeros(X.shape[1])
    sd = X.std(axis=0) if X.size else np.ones(X.shape[1])
    sd = np.where(sd > 0, sd, 1.0)

    def design(days, Xr):
        t = (days - t0) / span
        cols = [np.ones_like(t), t, np.maximum(t[:, None] - cps[None, :], 0.0) if cps.size else np.zeros((len(t), 0)),
                _fourier(days, 365.25, YEARLY_ORDER), _fourier(days, 7.0, WEEKLY_ORDER),
                (np.nan_to_num(Xr) - mu) / sd if Xr.size else np.zeros((len(t), 0))]
        return np.hstack([c if c.ndim == 2 else c[:, None] for c in cols])

    A = design(td, X)
    n_cp = cps.size
    n_season = 2 * (YEARLY_ORDER + WEEKLY_ORDER)
    n_reg = X.shape[1]
    # noise scale from an unpenalised trend + season fit, then MAP penalties
    base = lstsq(A[:, [0, 1] + list(range(2 + n_cp, 2 + n_cp + n_season))], ys)
    resid = ys - A[:, [0, 1] + list(range(2 + n_cp, 2 + n_cp + n_season))] @ base
    sigma2 = max(float(np.mean(resid ** 2)), 1e-8)
    change = np.arange(2, 2 + n_cp)
    rest = np.setdiff1d(np.arange(A.shape[1]), change)
    ridge = np.concatenate([[0.0, 0.0], np.full(n_season, 1 / SEASONALITY_PRIOR ** 2), np.full(n_reg, 1 / 10.0 ** 2)])
    coef = np.zeros(A.shape[1])
    for _ in range(3):  # the noise scale of the base fit still holds the trend changes
        prior = np.where(ridge > 0, ridge * sigma2, 0.0)
        coef[change], coef[rest] = sparse_fit(A[:, change], A[:, rest], ys, prior, sigma2 / CHANGEPOINT_PRIOR)
        sigma2 = max(float(np.mean((ys - A @ coef) ** 2)), 1e-8)
    return design(fd, X_future) @ coef * y_scale


def forecast_decomposable(rows: DataFrame, is_train, regressors: Sequence[str] = ("oil_price",),
                          key="store_nbr") -> DataFrame:
    """Per-series forecast of every row that ``is_train`` does not mark."""
    return run_grouped(rows, fit_forecast, regressors, is_train, key)
