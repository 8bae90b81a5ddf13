"""Scalar and aggregate building blocks.

All helpers return ``Column`` expressions so they stay inside whole-stage
codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Default size bound for tables that are broadcast.
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


def as_list(cols: str | Sequence[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def require_columns(df: DataFrame, cols: Iterable[str], op: str = "operator") -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"{op}: missing columns {missing}; have {df.columns}")


NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.BooleanType)


def numeric_columns(df: DataFrame, cols: Iterable[str]) -> list[str]:
    """The columns of ``cols`` whose type is a numeric or boolean whitelist
    member (model inputs); others are dropped silently, as in the reference."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return [c for c in cols if isinstance(types.get(c), NUMERIC_TYPES)]


def by_key(df: DataFrame, key: str | Sequence[str], n: int | None = None) -> DataFrame:
    """Hash-partition by the series key into ``n`` partitions (default: the
    session's shuffle partitions) before CPU-heavy per-series work.

    The per-key window / grouped map that follows reuses this partitioning
    (no second exchange). An explicit partition count is not coalesced by
    AQE, so small-but-expensive stages (model fits, long windows) keep their
    parallelism instead of collapsing into one task.
    """
    if n is None:
        n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *as_list(key))


def series_window(key: str | Sequence[str] = "store_nbr", order: str = "date"):
    """Window over one series in date order (the per-key row order)."""
    return Window.partitionBy(*as_list(key)).orderBy(order)


def safe_div(num: Column | str, den: Column | str) -> Column:
    """True division as double; null where the denominator is zero or null.

    Spark 4 (ANSI) raises on x/0; the reference engine would produce inf/NaN.
    Null is the documented choice here (oracles use ``nullif(den, 0)``).
    """
    n = F.col(num) if isinstance(num, str) else num
    d = F.col(den) if isinstance(den, str) else den
    return F.try_divide(n.cast("double"), d.cast("double"))


def safe_corr(x: Column | str, y: Column | str) -> Column:
    """Pearson correlation over pairs where both values are present.

    Null (not an error) for constant input or fewer than two pairs; equals
    ``corr`` otherwise. Built from covar_pop / stddev_pop so that the
    aggregate never divides by zero under ANSI mode.
    """
    xc = F.col(x) if isinstance(x, str) else x
    yc = F.col(y) if isinstance(y, str) else y
    xm = F.when(yc.isNotNull(), xc.cast("double"))
    ym = F.when(xc.isNotNull(), yc.cast("double"))
    den = F.stddev_pop(xm) * F.stddev_pop(ym)
    return F.when(den > 0, F.try_divide(F.covar_pop(xm, ym), den))


def iso_weekday(d: Column | str) -> Column:
    """ISO weekday 1 = Monday .. 7 = Sunday."""
    c = F.col(d) if isinstance(d, str) else d
    return F.weekday(c) + F.lit(1)


# Fixed values (must equal the reference): ordinal code per store type,
# A = largest store format down to E = smallest.
STORE_TYPE_CODES = {"A": 5, "B": 4, "C": 3, "D": 2, "E": 1}


def store_type_code(type_col: Column | str, codes: dict[str, int] = STORE_TYPE_CODES) -> Column:
    """Ordinal code as a byte; an unmapped non-null type raises, null stays null."""
    c = F.col(type_col) if isinstance(type_col, str) else type_col
    mapped = F.create_map(*[x for k, v in codes.items() for x in (F.lit(k), F.lit(v))])[c]
    return (
        F.when(c.isNull(), F.lit(None))
        .when(mapped.isNull(), F.raise_error(F.concat(F.lit("unmapped store type: "), c)))
        .otherwise(mapped)
        .cast(T.ByteType())
    )


def plan_bytes(df: DataFrame) -> int | None:
    """Optimizer's size estimate of ``df`` (file sizes carried through the plan); None without a local JVM plan."""
    try:
        return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    except AttributeError:
        return None


def sized_broadcast(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint if the plan's own size estimate is at most ``max_bytes``.

    No job runs, nothing is cached or remembered. The estimate of a derived
    table is that of its inputs or more, so the hint is only given to a side
    whose inputs are small; any other side stays unhinted and the planner
    decides (AQE turns the join into a broadcast once it has measured a small
    side, otherwise both sides are shuffled).
    """
    size = plan_bytes(df)
    return F.broadcast(df) if size is not None and size <= max_bytes else df
