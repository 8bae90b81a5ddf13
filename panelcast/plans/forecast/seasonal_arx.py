"""Seasonal ARIMA-with-exogenous forecast per series, order (1,1,1)x(1,1,1,7).

Regression with seasonal ARIMA errors: y minus the regression part follows

    (1 - B)(1 - B^7) n_t = z_t,   (1 - phi B)(1 - Phi B^7) z_t = (1 + theta B)(1 + Theta B^7) e_t.

The likelihood is the exact Gaussian one of the state-space form: a Kalman
filter over the ARMA states (started in their stationary distribution) and the
last eight levels. The unknown starting levels are diffuse: they enter as
coefficients of the eight functions that both differences remove, next to the
exogenous columns, and are integrated out together with them by generalised
least squares on the filter's innovations. The innovation variance is concentrated out, so
the search is over the four ARMA coefficients (kept inside (-1, 1)): quasi-Newton steps from
the conditional least squares estimate. Missing targets are skipped by the filter.
The forecast continues the filtered states. Runs per series inside ``applyInPandas`` (numpy only).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame

from panelcast.functions.core import numeric_columns
from panelcast.plans.forecast.grouped import SkipSeries, lstsq, run_grouped

# Fixed values (must equal the reference): weekly season, orders (1,1,1)x(1,1,1,7).
SEASON = 7
LONG_AR = 2 * SEASON + 2
BOUND = 0.995


def _diff(a: np.ndarray) -> np.ndarray:
    """(1-B)(1-B^s) along axis 0; drops the first s+1 rows."""
    s = SEASON
    return a[s + 1:] - a[s:-1] - a[1:-s] + a[:-s - 1]


def _shift(a: np.ndarray, k: int) -> np.ndarray:
    out = np.zeros_like(a)
    out[k:] = a[:-k]
    return out


def _coefs(p: np.ndarray):
    phi, Phi, th, Th = (BOUND * np.tanh(p[:4])).tolist()
    return phi, Phi, th, Th, p[4:]


def _innovations(p: np.ndarray, w: np.ndarray, xw: np.ndarray) -> np.ndarray:
    phi, Phi, th, Th, beta = _coefs(p)
    z = w - xw @ beta if beta.size else w
    s = SEASON
    u = z - phi * _shift(z, 1) - Phi * _shift(z, s) + phi * Phi * _shift(z, s + 1)
    # MA inversion: (1 + Theta B^s) v = u, then (1 + theta B) e = v
    # (plain float lists: element access on numpy arrays is several times slower)
    v = u.tolist()
    for t in range(s, len(v)):
        v[t] -= Th * v[t - s]
    prev = 0.0
    for t in range(len(v)):
        prev = v[t] - th * prev
        v[t] = prev
    return np.asarray(v)


def _css_fit(p0: np.ndarray, w: np.ndarray, xw: np.ndarray, iters: int = 60) -> np.ndarray:
    burn = SEASON + 1
    resid = lambda p: _innovations(p, w, xw)[burn:]
    p, r = p0.copy(), resid(p0)
    f, lam = float(r @ r), 1e-2
    for _ in range(iters):
        J = np.empty((len(r), len(p)))
        for j in range(len(p)):
            h = 1e-6 * (1.0 + abs(p[j]))
            q = p.copy()
            q[j] += h
            J[:, j] = (resid(q) - r) / h
        H, g = J.T @ J, J.T @ r
        step = np.linalg.solve(H + lam * np.diag(np.diag(H) + 1e-9) + 1e-12 * np.eye(len(p)), -g)
        q = p + step
        rq = resid(q)
        fq = float(rq @ rq)
        if np.isfinite(fq) and fq < f:
            done = f - fq <= 1e-10 * max(f, 1e-300)
            p, r, f, lam = q, rq, fq, lam / 3
            if done:
                break
        else:
            lam *= 4
            if lam > 1e10:
                break
    return p


def _hannan_rissanen(w: np.ndarray, xw: np.ndarray) -> np.ndarray:
    """Starting values: long AR for innovations, then a regression on lags
    1 and 7 of w and of the innovations, plus the exogenous columns."""
    m, k = len(w), xw.shape[1]
    p = LONG_AR
    A = np.column_stack([w[p - j: m - j] for j in range(1, p + 1)] + [xw[p:]])
    e = np.zeros(m)
    e[p:] = w[p:] - A @ lstsq(A, w[p:])
    q = p + SEASON
    B = np.column_stack([w[q - 1: m - 1], w[q - SEASON: m - SEASON], e[q - 1: m - 1], e[q - SEASON: m - SEASON],
                         xw[q:]])
    b = lstsq(B, w[q:])
    arma = np.arctanh(np.clip(b[:4], -0.9, 0.9) / BOUND)
    return np.concatenate([arma, b[4:4 + k]])


# --- exact likelihood ---------------------------------------------------------------------------

N_LEVELS = SEASON + 1
N_ARMA = SEASON + 2
SETTLED = 1e-5
BLOCK = 64


def state_space(phi: float, Phi: float, th: float, Th: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(transition, observation row, loading of the innovation): ARMA states, then the levels n_{t-1} .. n_{t-8}."""
    ar, ma = np.zeros(N_ARMA), np.zeros(N_ARMA)
    ar[0], ar[SEASON - 1], ar[SEASON] = phi, Phi, -phi * Phi
    ma[0], ma[1], ma[SEASON], ma[SEASON + 1] = 1.0, th, Th, th * Th
    T = np.zeros((N_ARMA + N_LEVELS,) * 2)
    T[:N_ARMA, 0] = ar
    T[:N_ARMA - 1, 1:N_ARMA] = np.eye(N_ARMA - 1)
    Z = np.zeros(N_ARMA + N_LEVELS)
    Z[0], Z[N_ARMA], Z[N_ARMA + SEASON - 1], Z[N_ARMA + SEASON] = 1.0, 1.0, 1.0, -1.0
    T[N_ARMA] = Z  # the new level
    T[N_ARMA + 1:, N_ARMA:-1] = np.eye(N_LEVELS - 1)
    R = np.zeros(N_ARMA + N_LEVELS)
    R[:N_ARMA] = ma
    return T, Z, R


def stationary_covariance(A: np.ndarray, Q: np.ndarray) -> np.ndarray:
    """P = A P A' + Q by doubling."""
    P, A = Q.copy(), A.copy()
    for _ in range(60):
        step = A @ P @ A.T
        P = P + step
        if np.abs(step).max() <= 1e-14 * np.abs(P).max():
            break
        A = A @ A
    return P


def removed_functions(n: int) -> np.ndarray:
    """The eight functions of the row number that both differences remove: a line and a weekly pattern."""
    t = np.arange(n)
    week = np.zeros((n, SEASON - 1))
    for j in range(SEASON - 1):
        week[:, j] = (t % SEASON == j).astype(float) - (t % SEASON == SEASON - 1)
    return np.column_stack([np.ones(n), t / max(n, 1), week])


def filtered(coefs: tuple, data: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, tuple]:
    """(scaled innovations of the columns of ``data`` at the rows seen, their log variances, final states, system).

    All columns go through one filter; the gain is kept once it has changed by
    less than SETTLED a row for two seasons, until a row is missing.
    """
    T, Z, R = system = state_space(*coefs)
    P = np.zeros((N_ARMA + N_LEVELS,) * 2)
    arma = slice(0, N_ARMA)
    P[arma, arma] = stationary_covariance(T[arma, arma], np.outer(R[arma], R[arma]))
    Q = np.outer(R, R)
    a = np.zeros((len(Z), data.shape[1]))
    v, logs = np.zeros((int(seen.sum()), data.shape[1])), np.zeros(int(seen.sum()))
    settled, calm, gain, root, log_f, at = False, 0, None, 1.0, 0.0, 0
    t, n, block = 0, len(seen), None
    while t < n:
        if not seen[t]:
            settled, calm, block = False, 0, None
            a = T @ a
            P = T @ P @ T.T + Q
            t += 1
            continue
        if settled and t + BLOCK <= n and seen[t:t + BLOCK].all():  # a settled filter is one linear map of a block of rows
            if block is None:
                block = _block_map(T - np.outer(gain, Z), Z, gain)
            ahead, inside, onward, drive = block
            d = data[t:t + BLOCK]
            v[at:at + BLOCK], logs[at:at + BLOCK] = (d - ahead @ a - inside @ d) / root, log_f
            a = onward @ a + drive @ d
            t, at = t + BLOCK, at + BLOCK
            continue
        if not settled:
            PZ = P @ Z
            f = max(float(Z @ PZ), 1e-300)
            new = T @ (PZ / f)
            calm = calm + 1 if gain is not None and float(np.abs(new - gain).max()) < SETTLED else 0
            settled = calm > 2 * SEASON  # a season later the gain would show what is still under way
            gain, root, log_f = new, f**0.5, math.log(f)
            P = T @ P @ T.T - np.outer(gain, gain) * f + Q
        e = data[t] - Z @ a
        a = T @ a + gain[:, None] * e
        v[at], logs[at] = e / root, log_f
        t, at = t + 1, at + 1
    return v, logs, a, system


def _block_map(M: np.ndarray, Z: np.ndarray, gain: np.ndarray) -> tuple[np.ndarray, ...]:
    """What BLOCK steps of a settled filter with state map ``M`` do: (state to expected rows, rows to later expected rows,
    state to final state, rows to final state)."""
    ahead, response = np.empty((BLOCK, len(Z))), np.empty((len(Z), BLOCK))
    row, column = Z.copy(), gain.copy()
    for i in range(BLOCK):
        ahead[i], response[:, i] = row, column
        row, column = row @ M, M @ column
    impulse = Z @ response  # of a row on the expectation 1, 2, ... rows later
    lag = np.arange(BLOCK)[:, None] - np.arange(BLOCK)[None, :] - 1
    inside = np.where(lag >= 0, impulse[np.maximum(lag, 0)], 0.0)
    return ahead, inside, np.linalg.matrix_power(M, BLOCK), response[:, ::-1]


def profile_likelihood(coefs: tuple, y: np.ndarray, X: np.ndarray, seen: np.ndarray):
    """(diffuse log-likelihood with regression and variance concentrated out, coefficients, states, system)."""
    k = X.shape[1]
    data = np.column_stack([np.where(seen, y, 0.0), X, removed_functions(len(y))])
    v, logs, a, system = filtered(coefs, data, seen)
    q, r = np.linalg.qr(v[:, 1:])
    target = q.T @ v[:, 0]
    b = lstsq(r, target)
    m = len(v) - N_LEVELS
    rest = v[:, 0] - v[:, 1:] @ b
    s2 = max(float(rest @ rest) / m, 1e-300)
    # the diffuse part's information: what the level functions hold beyond the regressors
    levels = np.linalg.qr(v[:, 1 + k:])[1]
    info = 2 * float(np.log(np.maximum(np.abs(np.diag(levels)), 1e-300)).sum())
    return -0.5 * (m * (np.log(2 * np.pi * s2) + 1) + float(logs.sum()) + info), b, a, system


def _maximise(start: np.ndarray, value, rounds: int = 8) -> np.ndarray:
    """Quasi-Newton steps (BFGS) with forward differences and halved steps."""
    p, f = start.copy(), value(start)
    n = len(p)

    def slope(p, f):
        g = np.empty(n)
        for j in range(n):
            q = p.copy()
            q[j] += 1e-4
            g[j] = (value(q) - f) / 1e-4
        return g

    g = slope(p, f)
    H = np.eye(n) / max(np.abs(g).max(), 1.0)
    for _ in range(rounds):
        d, size = H @ g, 1.0
        if np.abs(d).max() > 1.0:
            d = d / np.abs(d).max()
        for _ in range(8):
            q = p + size * d
            fq = value(q)
            if np.isfinite(fq) and fq > f + 1e-4 * size * float(g @ d):
                break
            size /= 2
        else:
            break
        gq = slope(q, fq)
        s, u = q - p, g - gq
        gained = fq - f
        p, f, g = q, fq, gq
        if gained < 1e-5 * (1 + abs(f)):
            break
        if float(s @ u) > 1e-12:
            rho = 1.0 / float(s @ u)
            left = np.eye(n) - rho * np.outer(s, u)
            H = left @ H @ left.T + rho * np.outer(s, s)
    return p


def _start(y: np.ndarray, X: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """ARMA coefficients by conditional least squares, missing targets filled from a week before."""
    y = y.copy()
    for t in np.flatnonzero(~seen):
        y[t] = y[t - SEASON] if t >= SEASON else y[seen][0]
    w, xw = _diff(y), _diff(X)
    return _css_fit(_hannan_rissanen(w, xw), w, xw, iters=12)[:4]


def fit_forecast(y: np.ndarray, X: np.ndarray, X_future: np.ndarray, *_dates) -> np.ndarray:
    h, n, k = len(X_future), len(y), X.shape[1]
    seen = np.isfinite(y)
    if int(seen.sum()) < SEASON + 1 + LONG_AR + SEASON + k + 10:
        raise SkipSeries(f"too short ({int(seen.sum())} rows with a target)")
    X, X_future = np.nan_to_num(X).reshape(n, k), np.nan_to_num(X_future).reshape(h, k)
    scale = max(float(np.nanstd(y)), 1e-12)
    centre = float(np.nanmean(y))
    y = (y - centre) / scale
    varies = X.std(axis=0) > 0  # a constant column is a level
    X, X_future = X[:, varies], X_future[:, varies]
    coefs = lambda p: tuple((BOUND * np.tanh(p)).tolist())
    p = _maximise(_start(y, X, seen), lambda p: profile_likelihood(coefs(p), y, X, seen)[0])
    _, b, a, (T, Z, _) = profile_likelihood(coefs(p), y, X, seen)
    state = a[:, 0] - a[:, 1:] @ b
    levels = removed_functions(n + h)[n:]
    levels[:, 1] *= (n + h) / n  # the line as scaled for the n fitted rows
    out = np.column_stack([X_future, levels]) @ b
    for t in range(h):
        out[t] += Z @ state
        state = T @ state
    return centre + scale * out


def forecast_seasonal_arx(rows: DataFrame, is_train, exog: Sequence[str], key="store_nbr") -> DataFrame:
    """Per-series forecast of every row that ``is_train`` does not mark (by
    position); exogenous columns that are not numeric/boolean are left out."""
    return run_grouped(rows, fit_forecast, numeric_columns(rows, exog), is_train, key)
