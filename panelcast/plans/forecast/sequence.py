"""Sequence windows for multi-horizon models.

A whole series is never collected into one row. Training windows are cut from
the sorted stream of a task's rows; the other windows are bounded window
frames (``collect_list`` over ``rowsBetween(-(L-1), 0)`` and ``(1, H)``): memory
is bounded by the lookback, and a long series streams through the window operator (which spills).
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions.core import as_list, by_key, series_window

KEY, DATE, TARGET = "store_nbr", "date", "transactions"

# Fixed values (must equal the reference): lookback, horizon, patches, pooling.
LOOKBACK, HORIZON = 336, 30
PATCH_LEN, PATCH_STRIDE = 16, 8
POOL_KERNELS = [2, 2, 1]
WINDOWS_AT_A_TIME = 2048  # of a task, in memory


def _scaled(arr, mu, sd):
    safe = F.when(sd > 0, sd).otherwise(F.lit(1.0))
    return F.transform(arr, lambda v: (v - mu) / safe)


def make_sequences(df: DataFrame, lookback: int = LOOKBACK, horizon: int = HORIZON, key=KEY, date_col=DATE,
                   target=TARGET, exog: Sequence[str] = (), scale: bool = True, step: int = 1,
                   places: int | None = None) -> DataFrame:
    """Training windows (every ``step``-th origin of a series, counted from its first full one): for every row with ``lookback`` rows up to it and
    ``horizon`` rows after it, the input window and the target window, both
    standard-scaled by the input window's mean and population std. A window that holds a null target is left out.

    Columns: key, date (last input day), x_mean, x_std, input, target and
    ``<exog>_mean`` (window mean of each exogenous column). ``places``: decimals of the array elements.

    Spark deals the series to tasks and numbers and sorts their rows; a task cuts the windows from its stream of
    Arrow batches, so it holds one batch and the ``lookback + horizon - 1`` rows before it, however long a series is.
    """
    keys, span = as_list(key), lookback + horizon
    w = series_window(key, date_col)
    past = w.rowsBetween(-(lookback - 1), 0)
    means = [F.avg(F.col(c).cast("double")).over(past).alias(f"{c}_mean") for c in exog]
    rows = by_key(df, key).select(*keys, date_col, *means, F.col(target).cast("double").alias("_y"), F.row_number().over(w).alias("_n"))
    kept = rows.columns[:-2]
    arrays = pa.list_(pa.float64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            held = table.slice(max(0, len(table) - span + 1)).combine_chunks()
            if len(table) < span:
                continue
            y, n = table.column("_y"), table.column("_n").to_numpy().astype(np.int64)
            nulls = np.concatenate([[0], np.cumsum(y.is_null().to_numpy())])
            first = np.flatnonzero((n[span - 1:] - n[:len(n) - span + 1] == span - 1) & (nulls[span:] == nulls[:-span])
                                   & ((n[:len(n) - span + 1] - 1) % step == 0))
            windows = np.lib.stride_tricks.sliding_window_view(y.to_numpy().astype(np.float64), span)
            for a in range(0, len(first), WINDOWS_AT_A_TIME):
                at = first[a:a + WINDOWS_AT_A_TIME]
                values, mean, std = scaled_windows(windows[at], lookback, scale)
                if places is not None:
                    values = np.floor(values * 10.0**places + 0.5) / 10.0**places
                ends = np.arange(len(at) + 1, dtype=np.int32)
                lists = [pa.ListArray.from_arrays(ends * part.shape[1], np.ascontiguousarray(part).ravel())
                         for part in (values[:, :lookback], values[:, lookback:])]
                of_rows = table.select(kept).take(pa.array(at + lookback - 1)).combine_chunks().to_batches()[0].columns
                yield pa.RecordBatch.from_arrays([*of_rows, pa.array(mean), pa.array(std), *lists], names=[*kept, "x_mean", "x_std", "input", "target"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-2])
    found = rows.mapInArrow(run, f"{fields}, x_mean double, x_std double, input array<double>, target array<double>")
    return found.select(*keys, date_col, "x_mean", "x_std", "input", "target", *[f"{c}_mean" for c in exog])


def scaled_windows(windows: np.ndarray, lookback: int, scale: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values, mean, population std) of windows by rows, scaled by their first ``lookback`` values."""
    with np.errstate(all="ignore"):
        inputs = windows[:, :lookback]
        mean = inputs.sum(axis=1) / lookback
        apart = inputs - inputs[:, :1]  # all zero where a window is constant
        apart -= apart.mean(axis=1)[:, None]
        std = np.sqrt(np.einsum("ij,ij->i", apart, apart) / lookback)
        if scale:
            windows = (windows - mean[:, None]) / np.where(std == 0, 1.0, std)[:, None]
    return windows, mean, std


def window_frames(df: DataFrame, lookback: int = LOOKBACK, horizon: int = HORIZON, key=KEY, date_col=DATE,
                  target=TARGET, exog: Sequence[str] = (), scale: bool = True) -> DataFrame:
    """Training windows and inference windows from one windowed pass.

    Rows: every full training window (``_train``: lookback inputs and horizon
    targets) and the last window of each series (``_last``: its final
    ``lookback`` rows, ``target`` empty), both scaled like ``make_sequences``
    (``scale=False`` leaves the raw values with ``x_mean`` / ``x_std`` for a
    consumer that scales in bulk).
    """
    w = series_window(key, date_col)
    past, fut = w.rowsBetween(-(lookback - 1), 0), w.rowsBetween(1, horizon)
    y = F.col(target).cast("double")
    s = by_key(df, key).select(
        *as_list(key), date_col,
        F.collect_list(y).over(past).alias("_in"), F.collect_list(y).over(fut).alias("_out"),
        F.avg(y).over(past).alias("x_mean"), F.stddev_pop(y).over(past).alias("x_std"),
        F.lead(F.lit(1)).over(w).isNull().alias("_last"),
        *[F.avg(F.col(c).cast("double")).over(past).alias(f"{c}_mean") for c in exog],
    ).where(F.size("_in") == lookback)
    s = s.withColumn("_train", F.size("_out") == horizon).where(F.col("_train") | F.col("_last"))
    mu, sd = F.col("x_mean"), F.col("x_std")
    inp, out = F.col("_in"), F.col("_out")
    if scale:
        inp, out = _scaled(inp, mu, sd), _scaled(out, mu, sd)
    return s.select(*as_list(key), date_col, "x_mean", "x_std", "_train", "_last",
                    inp.alias("input"), out.alias("target"), *[f"{c}_mean" for c in exog])


def last_windows(df: DataFrame, lookback: int = LOOKBACK, key=KEY, date_col=DATE, target=TARGET,
                 exog: Sequence[str] = (), scale: bool = True) -> DataFrame:
    """The inference window of each series: its last ``lookback`` rows.

    The last rows are picked by rank first, so one window per series is
    collected and not one per row.
    """
    keys = as_list(key)
    y = F.col(target).cast("double")
    ranked = by_key(df, key).select(
        *keys, date_col, y.alias("_y"), *[F.col(c).cast("double").alias(f"_e{i}") for i, c in enumerate(exog)],
        F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(date_col))).alias("_n")).where(F.col("_n") <= lookback)
    s = ranked.groupBy(*keys).agg(
        F.max(date_col).alias(date_col), F.transform(F.sort_array(F.collect_list(F.struct(date_col, "_n", "_y"))), lambda r: r["_y"]).alias("_in"),
        F.avg("_y").alias("x_mean"), F.stddev_pop("_y").alias("x_std"),
        *[F.avg(f"_e{i}").alias(f"{c}_mean") for i, c in enumerate(exog)],
    ).where(F.size("_in") == lookback)
    return s.select(*keys, date_col, "x_mean", "x_std",
                    (_scaled(F.col("_in"), F.col("x_mean"), F.col("x_std")) if scale else F.col("_in")).alias("input"),
                    *[f"{c}_mean" for c in exog])


def patchify(windows: DataFrame, col: str = "input", patch_len: int = PATCH_LEN, stride: int = PATCH_STRIDE,
             lookback: int = LOOKBACK) -> DataFrame:
    """Overlapping patches of each window: one row per (window, patch)."""
    n = (lookback - patch_len) // stride + 1
    keep = [c for c in windows.columns if c not in (col, "target")]
    numbered = windows.select(*keep, col, F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("patch_idx"))
    # a slice per row is compiled; inside a transform it copied the whole window for every patch
    return numbered.select(*keep, "patch_idx", F.slice(F.col(col), F.col("patch_idx") * stride + 1, patch_len).alias("patch"))


def pool_sequence(windows: DataFrame, col: str = "input", kernels: Sequence[int] = POOL_KERNELS,
                  lookback: int = LOOKBACK) -> DataFrame:
    """Multi-rate max pooling (kernel k, stride k, last partial chunk kept):
    one row per (window, stack index) with the pooled array."""
    def chunk_max(k):
        def most(i):  # one parameter: a second one would receive the index. Past the end is null and passed over
            held = [F.get(F.col(col), i * k + j) for j in range(k)]
            return F.greatest(*held) if k > 1 else held[0]

        return F.transform(F.sequence(F.lit(0), F.lit(math.ceil(lookback / k) - 1)), most)

    keep = [c for c in windows.columns if c not in (col, "target")]
    once = windows.select(*keep, *[chunk_max(k).alias(f"__pool_{k}") for k in dict.fromkeys(kernels)])
    pooled = [F.struct(F.lit(idx).alias("stack"), F.lit(k).alias("kernel"), F.col(f"__pool_{k}").alias("pooled"))
              for idx, k in enumerate(kernels)]
    return once.select(*keep, F.explode(F.array(*pooled)).alias("_p")).select(*keep, "_p.stack", "_p.kernel",
                                                                                  "_p.pooled")
