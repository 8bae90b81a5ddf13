"""Exact quantiles without holding a group in one task.

Equal values are counted first, dealt by (group, value). The values of a
group fall into equal-width ranges; cumulative counts per range (a bounded
number per group) say which ranges hold the wanted ranks, and only the
values of those ranges are ordered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions.core import as_list

RANGES = 1024


def exact_quantiles(df: DataFrame, by: str | Sequence[str], col: Column | str, probs: dict[str, float],
                    method: str = "linear", ranges: int = RANGES) -> DataFrame:
    """(by..., one double column per entry of ``probs``) over the non-null values, NaN left out.

    ``linear`` interpolates between the two neighbours, ``nearest`` takes the
    value at index round((n - 1) p), halves away from zero. Null group keys are a group. No values: no row
    (without ``by`` as well).
    """
    keys = as_list(by)
    value = (F.col(col) if isinstance(col, str) else col).cast("double")
    group = F.struct(*[F.col(k) for k in keys]) if keys else F.struct(F.lit(0).alias("_all"))
    counted = df.select(group.alias("_g"), value.alias("_v")).where(
        F.col("_v").isNotNull() & ~F.isnan("_v")).groupBy("_g", "_v").agg(F.count(F.lit(1)).alias("_n"))
    bounds = counted.groupBy("_g").agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.sum("_n").alias("_total"))
    share = (F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))
    placed = counted.join(bounds, "_g").withColumn(
        "_b", F.when(F.col("_hi") > F.col("_lo"), F.least(F.floor(share * ranges), F.lit(ranges - 1))).otherwise(F.lit(0)))
    per_range = placed.groupBy("_g", "_b").agg(F.sum("_n").alias("_n"), F.max("_total").alias("_total"))
    over = Window.partitionBy("_g").orderBy("_b")
    per_range = per_range.withColumn("_before", F.sum("_n").over(over) - F.col("_n"))
    index = [(F.col("_total") - 1) * F.lit(float(p)) for p in probs.values()]
    if method == "linear":
        ranks = [r for h in index for r in (F.floor(h), F.ceil(h))]
    elif method == "nearest":
        ranks = [r for h in index for r in (F.floor(h + 0.5), F.floor(h + 0.5))]
    else:
        raise ValueError(f"unknown method {method!r}")
    wanted = per_range.select("_g", "_b", "_before", "_total", F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), r.cast("bigint").alias("rank")) for i, r in enumerate(ranks)])).alias("_w"), "_n").where(
        (F.col("_w.rank") >= F.col("_before")) & (F.col("_w.rank") < F.col("_before") + F.col("_n")))
    targets = wanted.groupBy("_g", "_b").agg(
        F.max("_before").alias("_before"), F.collect_list("_w").alias("_w"))  # at most two ranks per probability
    inside = Window.partitionBy("_g", "_b").orderBy("_v")
    chosen = placed.select("_g", "_b", "_v", "_n", "_total").join(targets, ["_g", "_b"])
    chosen = chosen.withColumn("_upto", F.col("_before") + F.sum("_n").over(inside))
    hit = F.filter("_w", lambda w: (w["rank"] >= F.col("_upto") - F.col("_n")) & (w["rank"] < F.col("_upto")))
    found = chosen.select("_g", "_v", "_total", F.explode(hit).alias("_w")).groupBy("_g").agg(
        F.max("_total").alias("_total"), *[F.max(F.when(F.col("_w.i") == i, F.col("_v"))).alias(f"_r{i}") for i in range(len(ranks))])
    out = []
    for i, (name, h) in enumerate(zip(probs, index)):
        low, high = F.col(f"_r{2 * i}"), F.col(f"_r{2 * i + 1}")
        out.append(F.when(low == high, low).otherwise(low + (high - low) * (h - F.floor(h))).alias(name))
    return found.select(*[F.col(f"_g.{k}").alias(k) for k in keys], *out)
