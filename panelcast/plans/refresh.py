"""Incremental refresh of the final dataset.

The table is partitioned by date. Beside it lies a state: the last
``LOOKBACK_ROWS`` rows of every series with their filled oil price, and how many rows the
series has had. A refresh reads the state and the new rows only, builds their
features, rewrites the partitions of the new dates, and writes the state as of
the last new date. A refresh that is repeated finds the state before its dates again, so it can be
run anew after a failure. The work follows the new rows and the number of series, not the history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelcast.functions.core import series_window, sized_broadcast
from panelcast.operators.exogenous import add_holiday_features, add_store_features
from panelcast.operators.features import add_cyclical_time_features, drop_warmup, guarded_mean
from panelcast.plans.feature_pipeline import LOOKBACK_ROWS, WARMUP_ROWS, add_window_features
from panelcast.sources.io import read_if_exists, staged, write_table

KEY, DATE, TARGET = "store_nbr", "date", "transactions"


def _state_before(spark: SparkSession, path: str, first) -> DataFrame | None:
    """The newest state older than the date ``first``; None before the first refresh."""
    import warnings

    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        states = read_if_exists(spark, f"{path}/state")
    if states is None:
        return None
    as_of = states.where(F.col("as_of") < F.lit(first)).agg(F.max("as_of")).first()[0]
    return None if as_of is None else states.where(F.col("as_of") == F.lit(as_of)).drop("as_of")


def refresh_final_dataset(spark: SparkSession, path: str, new_rows: DataFrame, stores: DataFrame, oil: DataFrame,
                          holidays: DataFrame, warmup: int = WARMUP_ROWS) -> None:
    """Add the rows of new dates (key, date, target) to the table at ``path``.

    The dates of ``new_rows`` must come after all dates of the state that is
    continued; their partitions are replaced, so a refresh names all rows of its dates. No rows: nothing is done.
    """
    if warmup > LOOKBACK_ROWS:
        raise ValueError("the state holds too few rows for this warm-up")
    span = new_rows.agg(F.min(DATE).alias("first"), F.max(DATE).alias("last")).first()
    if span["first"] is None:
        return
    fresh = new_rows.select(KEY, DATE, TARGET).withColumns({"_new": F.lit(True), "_oil": F.lit(None).cast("double"), "_had": F.lit(0).cast("bigint")})
    state = _state_before(spark, path, span["first"])
    rows = fresh if state is None else state.select(
        KEY, DATE, TARGET, F.lit(False).alias("_new"), F.col("oil_price").alias("_oil"), F.col("n_rows").alias("_had")).unionByName(fresh)
    w = series_window(KEY, DATE)
    whole = Window.partitionBy(KEY)
    quotes = rows.join(sized_broadcast(oil.select(DATE, "dcoilwtico")), DATE, "left")
    filled = staged(quotes.withColumn(
        "oil_price", F.last(F.coalesce("_oil", "dcoilwtico"), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    ).drop("dcoilwtico", "_oil").withColumns({
        "_had": F.max("_had").over(whole),  # rows of the series up to the state
        "_held": F.count_if(~F.col("_new")).over(whole),
    }), "refresh")  # read by the table and by the state
    featured = add_window_features(filled.transform(add_store_features, stores).transform(add_cyclical_time_features), [KEY]).withColumn(
        "oil_price_ma7", guarded_mean("oil_price", w, -6, 0, 7))
    ranked = drop_warmup(add_holiday_features(featured, holidays), n=0, keep_rank=True)
    # a series with rows before those of the state is past its warm-up
    done = ranked.where(F.col("_new") & ((F.col("_had") > F.col("_held")) | (F.col("day_rank") > warmup)))
    table = done.drop("_new", "_had", "_held", "day_rank").repartition(DATE)  # one file a date
    write_table(table, f"{path}/table", [DATE], dynamic=True)
    newest = F.row_number().over(Window.partitionBy(KEY).orderBy(F.desc(DATE)))
    total = F.col("_had") + F.count_if(F.col("_new")).over(whole)
    kept = filled.withColumns({"n_rows": total, "_age": newest}).where(F.col("_age") <= LOOKBACK_ROWS).select(
        KEY, DATE, TARGET, "oil_price", "n_rows").withColumn("as_of", F.lit(span["last"]))
    write_table(kept, f"{path}/state", ["as_of"], dynamic=True)


def read_final_dataset(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/table")
