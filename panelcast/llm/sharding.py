"""Sharding by a Feistel permutation with cycle walking over global row numbers.

Native: DataFrame expressions only.

1. Row numbers 0..N-1: rows are grouped by their identity (id, digest
   columns), dealt to hash buckets, numbered inside the bucket in id order and
   shifted by the bucket's offset. Equal rows are one group with a count, so
   a group of copies of any size never meets in one task.
2. The permutation: N rows live on the grid Z_a x Z_b with a*b >= N and
   a*b - N < a. Each round adds a keyed hash of one half to the other half
   modulo its size, which is a bijection of the grid.
3. Cycle walking: a position that falls outside 0..N-1 is permuted again. The
   longest walk is found exactly by following the fewer than sqrt(N)+1 points
   outside, so the plan holds as many walking steps as needed and no more.
4. position p -> shard p mod S, slot p div S: shard sizes differ by at most
   one row and slots are gapless from 0.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelcast.llm.common import materialise

ROUNDS = 6
ROWS_PER_BUCKET = 250_000
MIN_BUCKETS = 4096
COPIES_PER_CHUNK = 10_000


def grid(n: int) -> tuple[int, int]:
    """Sides (a, b) of the smallest near-square grid with a*b >= n and a*b - n < a."""
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    return a, max(1, -(-n // a))


def _round_value(half: Column, size: int, round_no: int, seed: int) -> Column:
    return F.pmod(F.xxhash64(half, F.lit(round_no), F.lit(seed)), F.lit(size))


def _permute_once(df: DataFrame, x: str, n: int, seed: int) -> DataFrame:
    """One pass of the permutation over column ``x``; rows already inside 0..n-1 that are marked done stay."""
    a, b = grid(n)
    cur = df.withColumn("__l", F.expr(f"{x} div {b}")).withColumn("__r", F.col(x) % b)
    for i in range(ROUNDS):
        if i % 2 == 0:
            cur = cur.withColumn("__l", (F.col("__l") + _round_value(F.col("__r"), a, i, seed)) % a)
        else:
            cur = cur.withColumn("__r", (F.col("__r") + _round_value(F.col("__l"), b, i, seed)) % b)
    return cur.withColumn("__y", F.col("__l") * b + F.col("__r"))


def walk_length(spark: SparkSession, n: int, seed: int) -> int:
    """Number of extra passes after which no walk can still be outside 0..n-1 (exact)."""
    a, b = grid(n)
    outside, steps = spark.range(n, a * b).withColumnRenamed("id", "x"), 0
    while True:
        points = [r[0] for r in outside.agg(F.count(F.lit(1))).collect()][0]
        if points == 0:
            return steps
        steps += 1
        outside = _permute_once(outside, "x", n, seed).where(F.col("__y") >= n).select(F.col("__y").alias("x"))


def feistel_position(df: DataFrame, row_col: str, out_col: str, n: int, seed: int) -> DataFrame:
    """Add the permuted position of the global row number ``row_col`` (0..n-1)."""
    keep = df.columns
    cur = _permute_once(df, row_col, n, seed).withColumn("__pos", F.col("__y"))
    for _ in range(walk_length(df.sparkSession, n, seed)):
        cur = _permute_once(cur, "__pos", n, seed)
        cur = cur.withColumn("__pos", F.when(F.col("__pos") >= n, F.col("__y")).otherwise(F.col("__pos")))
    return cur.select(*[F.col(f"`{c}`") for c in keep], F.col("__pos").alias(out_col))


def number_rows(df: DataFrame, order: list[str], out_col: str) -> tuple[DataFrame, int]:
    """Global row numbers 0..N-1 that depend on the rows alone, not on files or partitions.

    ``df`` must hold only small columns; rows equal in all of ``order`` are
    interchangeable. Nulls are a value like any other. Returns (rows, N).
    """
    spark = df.sparkSession
    names = [f"__o{i}" for i in range(len(order))]
    plain = df.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(order, names)])
    groups = materialise(plain.groupBy(*names).agg(F.count(F.lit(1)).alias("__n")), "rows")
    total, n_groups, most = groups.agg(
        F.coalesce(F.sum("__n"), F.lit(0)), F.count(F.lit(1)), F.coalesce(F.max("__n"), F.lit(0))
    ).first()
    buckets = max(MIN_BUCKETS, -(-n_groups // ROWS_PER_BUCKET))
    groups = groups.withColumn("__bucket", F.pmod(F.xxhash64(*names), F.lit(buckets)))
    # One row per bucket: bounded by `buckets`, so the sort in one task and the broadcast are small.
    offsets = groups.groupBy("__bucket").agg(F.sum("__n").alias("__size")).select(
        "__bucket",
        (F.sum("__size").over(Window.orderBy("__bucket")) - F.col("__size")).alias("__offset"),
    )
    inside = Window.partitionBy("__bucket").orderBy(*[F.asc_nulls_first(c) for c in names])
    first = groups.withColumn("__first", F.sum("__n").over(inside) - F.col("__n"))
    rows = first.join(F.broadcast(offsets), "__bucket").withColumn("__first", F.col("__first") + F.col("__offset"))
    if most > COPIES_PER_CHUNK:  # deal the copies of a large group to many tasks before they are written out
        step = F.lit(COPIES_PER_CHUNK).cast("bigint")
        rows = rows.withColumn("__c", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("__n") - 1, step)))
        rows = rows.repartition(spark.sparkContext.defaultParallelism * 4, *names, "__c")
        last = F.least(F.col("__n") - 1, F.col("__c") + (COPIES_PER_CHUNK - 1))
        rows = rows.withColumn("__i", F.explode(F.sequence(F.col("__c"), last)))
    elif most > 1:
        rows = rows.withColumn("__i", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("__n") - 1)))
    else:
        rows = rows.withColumn("__i", F.lit(0).cast("bigint"))
    out = rows.select(
        *[F.col(n).alias(c) for c, n in zip(order, names)], (F.col("__first") + F.col("__i")).alias(out_col)
    )
    return out, total


def shard_rows(df: DataFrame, order: list[str], shards: int = 16, seed: int = 20) -> DataFrame:
    """``order`` columns plus ``row_number``, ``position``, ``shard`` and ``slot``.

    * ``order`` names the columns that identify a row (the id first); select
      small columns, texts can be joined back by id.
    * law ``rows``: shard counts differ by at most one; slots run from 0.
    * null ids and repeated rows are rows like any other (equal rows get
      different slots, which of them is immaterial); an empty frame gives an
      empty result.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    numbered, n = number_rows(df, order, "row_number")
    placed = feistel_position(numbered, "row_number", "position", max(n, 1), seed)
    return placed.select(
        "*",
        (F.col("position") % shards).cast("int").alias("shard"),
        F.expr(f"position div {shards}").alias("slot"),
    )


def document_digest(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, size (UTF-8 bytes of the text, null: none, plus 1) and crc32 of the text (null: of no bytes)."""
    data = F.coalesce(F.col(f"`{text_col}`").cast("binary"), F.lit("").cast("binary"))
    return df.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        (F.octet_length(data) + 1).cast("bigint").alias("size"),
        F.crc32(data).alias("text_crc32"),
    )


def op10_query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    placed = shard_rows(document_digest(docs, "doc_id", "text"), ["doc_id", "size", "text_crc32"], shards=16)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
