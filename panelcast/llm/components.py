"""Connected components of a large link table (alternating large-star / small-star)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import materialise, release


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (
        both.where("v > u").join(least, "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .where("u <> v").distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``links(u, v)``, root = smallest node of its component.

    Each round shuffles the links only; the result of a round is written to
    the shared folder, so a lost executor never replays earlier rounds. Hub
    nodes are pre-aggregated (min) and their join is split by AQE.
    """
    edges = materialise(links.where("u <> v").select("u", "v").distinct(), "links")
    state = _state(edges)
    for _ in range(max_rounds):
        if state[0] == 0:
            break
        nxt = materialise(_small_star(_large_star(edges)), "links")
        new = _state(nxt)
        release(edges)
        edges = nxt
        if new == state:
            break
        state = new
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
