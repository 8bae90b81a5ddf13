"""Window features of a series that is too long for one task.

A window over a series runs in one task, so a hot series stops scaling. Here a
series is cut into chunks of consecutive rows. Every chunk also carries the
``lookback`` rows before it (its halo), so windows that look back no further
give the same values inside a chunk as over the whole series; halo rows are dropped afterwards.
What reaches further back travels as one carried row per chunk: row counts (ranks) and
last known values (fills).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions.core import as_list, require_columns

KEY, DATE = "store_nbr", "date"
CHUNK_ROWS = 65_536
CHUNK, HALO, ROW = "_chunk", "_halo", "_row"


def row_numbers(df: DataFrame, key: str | Sequence[str] = KEY, date_col=DATE, part: Column | None = None, out: str = ROW) -> DataFrame:
    """Number of each row in its series, from 1 in date order, without a window over the series.

    Rows are numbered inside ``part`` (default: the month of the date), any
    expression that grows with the date; the rows before a part are summed over the small table of
    parts. Rows of one date in a series are numbered in no certain order.
    """
    keys = as_list(key)
    require_columns(df, [*keys, date_col], "row_numbers")
    marked = df.withColumn("_part", F.trunc(F.col(date_col), "month") if part is None else part)
    sizes = marked.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_held"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*keys, "_part", F.coalesce(F.sum("_held").over(before), F.lit(0)).alias("_before"))
    # a part's offset stands as one more row in front of its rows, number 0: no join of all rows
    together = marked.withColumn("_before", F.lit(None).cast("bigint")).unionByName(offsets, allowMissingColumns=True)
    w = Window.partitionBy(*keys, "_part").orderBy(F.col("_before").isNull(), date_col)
    numbered = together.withColumns({"_inside": F.row_number().over(w) - 1, "_offset": F.first("_before").over(w)}).where("_inside > 0")
    return numbered.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_inside") + F.col("_offset")).alias(out))


def in_chunks(df: DataFrame, build: Callable[[DataFrame, list[str]], DataFrame], lookback: int, key: str | Sequence[str] = KEY,
              date_col=DATE, chunk_rows: int = CHUNK_ROWS, numbered: bool = False, keep_chunk: bool = False) -> DataFrame:
    """``build(frame, keys)`` over chunks of at most ``chunk_rows`` rows and their halo.

    ``build`` adds columns with windows over ``keys`` (the series key and the
    chunk) that look back at most ``lookback`` rows, and must keep the helper columns.
    ``numbered``: ``df`` has ``row_numbers`` already. A chunk holds chunk_rows + lookback rows whatever the series holds.
    """
    if not 0 < lookback <= chunk_rows:
        raise ValueError("a halo must fit into one chunk")
    keys = as_list(key)
    rows = df if numbered else row_numbers(df, keys, date_col)
    chunk = F.floor((F.col(ROW) - 1) / chunk_rows).cast("bigint")
    inside = (F.col(ROW) - 1) % chunk_rows
    copies = F.when(inside >= chunk_rows - lookback, F.array(chunk, chunk + 1)).otherwise(F.array(chunk))
    spread = rows.select("*", F.posexplode(copies).alias("_copy", CHUNK)).withColumn(HALO, F.col("_copy") > 0).drop("_copy")
    built = build(spread, [*keys, CHUNK]).where(~F.col(HALO)).drop(HALO, ROW)
    return built if keep_chunk else built.drop(CHUNK)


def fill_in_chunks(numbered: DataFrame, value_col: str, out_col: str, key: str | Sequence[str] = KEY,
                   chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Forward fill of ``value_col`` over each series of ``row_numbers``: inside chunks, else the last value of the chunks before."""
    keys = as_list(key)
    placed = numbered.withColumn("_fill", F.floor((F.col(ROW) - 1) / chunk_rows))
    known = F.max_by(value_col, F.when(F.col(value_col).isNotNull(), F.col(ROW)))
    ends = placed.groupBy(*keys, "_fill").agg(known.alias("_last"))
    before = Window.partitionBy(*keys).orderBy("_fill").rowsBetween(Window.unboundedPreceding, -1)
    # the value carried into a chunk stands as one more row in front of its rows: no join of all rows
    carried = ends.select(*keys, "_fill", F.last("_last", ignorenulls=True).over(before).alias(value_col), F.lit(True).alias("_carried"))
    together = placed.withColumn("_carried", F.lit(False)).unionByName(carried, allowMissingColumns=True)
    inside = Window.partitionBy(*keys, "_fill").orderBy(F.desc("_carried"), ROW).rowsBetween(Window.unboundedPreceding, 0)
    filled = together.withColumn(out_col, F.last(value_col, ignorenulls=True).over(inside)).where(~F.col("_carried"))
    return filled.select(*[F.col(f"`{c}`") for c in numbered.columns], out_col)
