"""Exact top-k search over binary codes by incremental multi-index hashing.

A code is cut into m segments; the index holds, per segment, the distinct
codes by segment value. Round r looks up all segment values at distance
exactly r from a query's segments and verifies the codes found on all bits.
After the rounds 0..r every code within R = m (r + 1) - 1 bits has been seen:
a code farther than r in each of m segments differs in at least m (r + 1)
bits. A query ends once its k-th verified distance is at most R, so its
result is exact; only unfinished queries grow on.

Equal codes are one entry with its row count and smallest ids, and equal
query codes are one search, so a code that a third of all rows share costs
nothing extra. Index and probes are dealt to parts by segment value as packed
arrays; a segment value with many codes is split over several parts, all of
which get its probes. A part returns at most k + 1 codes per query, in batches. A round whose
probes would exceed PROBES_PER_PART sends each query to every part once instead, which compares all its
segment values, so a part's memory follows its codes and the number of queries, not the radius.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelcast.llm.common import materialise, release

BITS = 64
CODES_PER_PART = 250_000
PROBES_PER_PART = 2_000_000  # of 17 bytes each
FLUSH = 200_000  # rows of a part's result held before they are returned
K = 10
QUERY_BATCH = 256


def sign_code(vector: Column) -> Column:
    """64-bit code of a vector: bit i is set if component i is positive; null without a vector."""
    bits = F.transform(F.slice(vector, 1, BITS), lambda x: F.when(x > 0, 1).otherwise(0).cast("bigint"))
    placed = F.aggregate(bits, F.struct(F.lit(0).cast("bigint").alias("code"), F.lit(0).alias("i")),
                         lambda acc, b: F.struct(acc["code"].bitwiseOR(F.call_function("shiftleft", b, acc["i"])).alias("code"),
                                                 (acc["i"] + 1).alias("i")))
    return placed["code"]


def segments_for(rows: int) -> int:
    """Number of segments: about log2(rows) bits each, a divisor of the code length."""
    return next((m for m in (32, 16, 8, 4, 2) if BITS // m >= math.log2(max(rows, 2)) - 1), 2)


def _segment(codes: np.ndarray, s: int, m: int) -> np.ndarray:
    width = BITS // m
    return (codes >> np.uint64(s * width)) & np.uint64((1 << width) - 1)


def _part(values: np.ndarray, s: int, parts: int) -> np.ndarray:
    x = (values + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return s * parts + ((x >> np.uint64(33)) % np.uint64(parts)).astype(np.int64)


def _spread(values: np.ndarray, part: np.ndarray, s: int, m: int, parts: int, hot: dict[int, int], salt: np.ndarray | None):
    """Parts of hot values: an index entry goes to one of the value's parts, a probe (no salt) to all of them."""
    if not hot:
        return np.arange(len(values)), part
    copies = np.ones(len(values), dtype=np.int64)
    for value, n in hot.items():
        copies[values == np.uint64(value)] = n
    if salt is not None:
        step = (salt % copies.astype(np.uint64)).astype(np.int64)
        return np.arange(len(values)), s * parts + (part - s * parts + step) % parts
    rows = np.repeat(np.arange(len(values)), copies)
    step = np.arange(len(rows)) - np.repeat(np.cumsum(copies) - copies, copies)
    return rows, s * parts + (part[rows] - s * parts + step) % parts


def _blobs(part: np.ndarray, *arrays: np.ndarray) -> Iterator[tuple]:
    order = np.argsort(part, kind="stable")
    cut = np.append(np.nonzero(np.diff(part[order], prepend=-1))[0], len(order))
    for a, b in zip(cut[:-1], cut[1:]):
        yield int(part[order[a]]), *[x[order[a:b]].tobytes() for x in arrays]


_PACKED = "part bigint, codes binary, least binary, rows binary, queries binary, values binary, reach binary"


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    names = ["part", "codes", "least", "rows", "queries", "values", "reach"]
    kinds = [pa.int64()] + [pa.binary()] * 6
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def _pack_index(codes: DataFrame, m: int, parts: int, hot: list[dict[int, int]]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            least, rows = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (1, 2))
            out = []
            for s in range(m):
                value = _segment(code, s, m)
                _, part = _spread(value, _part(value, s, parts), s, m, parts, hot[s], code >> np.uint64(7))
                out += [(p, c, i, n, None, None, None) for p, c, i, n in _blobs(part, code, least, rows)]
            yield _packed(out)

    return codes.select("code", "least", "rows").mapInArrow(run, _PACKED)


def _pack_probes(pending: DataFrame, m: int, parts: int, hot: list[dict[int, int]], radius: int, everywhere: bool) -> DataFrame:
    """Probes of a round: (query code, segment value, bits to beat); ``everywhere`` sends the queries to all parts instead."""
    width = BITS // m
    flips = np.array([sum(1 << b for b in c) for c in combinations(range(width), radius)], dtype=np.uint64) if not everywhere else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            reach = batch.column(1).to_numpy(zero_copy_only=False).astype(np.uint8)
            for a in range(0, len(code), QUERY_BATCH):
                some, far, out = code[a:a + QUERY_BATCH], reach[a:a + QUERY_BATCH], []
                for s in range(m):
                    if everywhere:
                        blob = (some.tobytes(), _segment(some, s, m).tobytes(), far.tobytes())
                        out += [(s * parts + p, None, None, None, *blob) for p in range(parts)]
                        continue
                    value = (_segment(some, s, m)[:, None] ^ flips[None, :]).ravel()
                    rows, part = _spread(value, _part(value, s, parts), s, m, parts, hot[s], None)
                    query = rows // len(flips)
                    out += [(p, None, None, None, q, v, d) for p, q, v, d in _blobs(part, some[query], value[rows], far[query])]
                yield _packed(out)

    return pending.select("query", "reach").mapInArrow(run, _PACKED)


def _join(parts: list[pd.DataFrame], column: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(x for part in parts for x in part[column] if x is not None), dtype=kind)


def _look_up(m: int, parts: int, radius: int, k: int, everywhere: bool):
    def table(found: list[tuple]) -> pd.DataFrame:
        cols = [np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0, t) for t in ("u8", "u8", "i4", "i8", "i8")]
        return pd.DataFrame({"query": cols[0].view(np.int64), "code": cols[1].view(np.int64), "distance": cols[2],
                             "least": cols[3], "rows": cols[4]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = list(batches)
        s = int(held[0]["part"].iloc[0]) // parts
        code, least, rows = _join(held, "codes", np.uint64), _join(held, "least", np.int64), _join(held, "rows", np.int64)
        query, wanted, reach = _join(held, "queries", np.uint64), _join(held, "values", np.uint64), _join(held, "reach", np.uint8)
        held.clear()
        found, size_found = [], 0
        if len(code) and len(query):
            value = _segment(code, s, m)
            order = np.argsort(value, kind="stable")
            code, least, rows, value = code[order], least[order], rows[order], value[order]
            kinds, first = np.unique(value, return_index=True)
            end = np.append(first[1:], len(value))
            by_query = np.argsort(query, kind="stable")
            query, wanted, reach = query[by_query], wanted[by_query], reach[by_query]
            cut = np.append(np.nonzero(np.diff(query, prepend=query[:1] + np.uint64(1)))[0], len(query))
            for a, b in zip(cut[:-1], cut[1:]):
                if everywhere:
                    at = np.nonzero(np.bitwise_count(kinds ^ wanted[a]) == radius)[0]
                else:
                    at = np.searchsorted(kinds, wanted[a:b])
                    at = at[at < len(kinds)] if len(kinds) == 0 else np.minimum(at, len(kinds) - 1)
                    at = at[kinds[at] == wanted[a:b]]
                if not len(at):
                    continue
                size = end[at] - first[at]
                pick = np.repeat(first[at] - (np.cumsum(size) - size), size) + np.arange(size.sum())
                distance = np.bitwise_count(code[pick] ^ query[a])
                near = distance <= reach[a]
                pick, distance = pick[near], distance[near]
                if len(pick) > k + 1:
                    best = np.lexsort((least[pick], distance))[:k + 1]
                    pick, distance = pick[best], distance[best]
                if len(pick):
                    found.append((np.full(len(pick), query[a]), code[pick], distance.astype(np.int32), least[pick], rows[pick]))
                    size_found += len(pick)
                    if size_found >= FLUSH:
                        yield table(found)
                        found, size_found = [], 0
        yield table(found)

    return run


def code_table(df: DataFrame, id_col: str, code_col: str, k: int) -> DataFrame:
    """(code, least, rows, ids): distinct codes, their row count and their k + 1 smallest ids."""
    plain = df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{code_col}`").alias("code")).where(
        "code is not null and id is not null")
    first = plain.withColumn("n", F.row_number().over(Window.partitionBy("code").orderBy("id"))).where(F.col("n") <= k + 1)
    return first.groupBy("code").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("rows"),
                                     F.array_sort(F.collect_list("id")).alias("ids"))


def search_codes(codes: DataFrame, queries: DataFrame, k: int, codes_per_part: int = CODES_PER_PART) -> DataFrame:
    """(query, code, distance): for every distinct code of ``queries(query)`` the k + 1 nearest codes that can hold its top k."""
    spark = codes.sparkSession
    total = codes.count()
    m = segments_for(total)
    width = BITS // m
    parts = max(1, -(-spark.sparkContext.defaultParallelism // m), -(-total // codes_per_part))
    # Segment values with more than a part's share of codes: fewer than m x parts of them.
    hot: list[dict[int, int]] = []
    for s in range(m):
        value = F.call_function("shiftrightunsigned", F.col("code"), F.lit(s * width)).bitwiseAND(F.lit((1 << width) - 1))
        many = codes.groupBy(value.alias("value")).count().where(F.col("count") > codes_per_part).collect()
        hot.append({r["value"]: min(parts, -(-r["count"] // codes_per_part)) for r in many})
    tasks = max(spark.sparkContext.defaultParallelism, total // 100_000)
    index = materialise(_pack_index(codes.repartition(tasks), m, parts, hot), "index")
    pending = materialise(queries.select("query").distinct().withColumn("reach", F.lit(BITS)), "pending")
    best = materialise(spark.createDataFrame([], "query bigint, code bigint, distance int, least bigint, rows bigint"), "best")
    finished = []
    for radius in range(width + 1):
        waiting = pending.count()
        if not waiting:
            break
        everywhere = math.comb(width, radius) > min(total, 1 << width, PROBES_PER_PART * parts // waiting)
        tasks = max(spark.sparkContext.defaultParallelism, waiting // 10_000)
        probes = _pack_probes(pending.repartition(tasks), m, parts, hot, radius, everywhere)
        found = index.union(probes).groupBy("part").applyInPandas(
            _look_up(m, parts, radius, k, everywhere), "query bigint, code bigint, distance int, least bigint, rows bigint")
        ranked = found.union(best).distinct().withColumn(
            "n", F.row_number().over(Window.partitionBy("query").orderBy("distance", "least"))).where(F.col("n") <= k + 1)
        upto = F.sum("rows").over(Window.partitionBy("query").orderBy("n"))
        merged = materialise(ranked.withColumn("upto", upto), "merged")
        # The k-th row besides the query's own row.
        reached = merged.where(F.col("upto") >= k + 1).groupBy("query").agg(F.min("distance").alias("kth"))
        covered = m * (radius + 1) - 1 if radius < width else BITS
        state = pending.select("query").join(reached, "query", "left").withColumn("kth", F.coalesce("kth", F.lit(BITS + 1)))
        done = state.where((F.col("kth") <= covered) | F.lit(radius == width))
        finished.append(materialise(merged.join(done, "query", "left_semi").select("query", "code", "distance"), "finished"))
        left = state.join(done.select("query"), "query", "left_anti")
        later = materialise(left.select("query", F.least("kth", F.lit(BITS)).cast("int").alias("reach")), "pending")
        kept = materialise(merged.join(later, "query", "left_semi").select(*best.columns), "best")
        for old in (pending, best, merged):
            release(old)
        pending, best = later, kept
    out = finished[0] if finished else best.select("query", "code", "distance")
    for more in finished[1:]:
        out = out.union(more)
    return out


def top_k(df: DataFrame, is_query: Column, id_col: str = "id", code_col: str = "code", k: int = K,
          codes_per_part: int = CODES_PER_PART) -> DataFrame:
    """(query_id, rank, neighbour_id, distance): the k nearest other rows of every query row.

    Order: Hamming distance, then id. Rows with a null id or code are neither queries nor neighbours; fewer
    than k other rows: all of them. Repeated ids count as one row per (id, code) pair.
    """
    plain = df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{code_col}`").alias("code"),
                      is_query.alias("asks")).where("id is not null and code is not null").distinct()
    codes = materialise(code_table(plain, "id", "code", k), "codes")
    asking = plain.where("asks").select(F.col("id").alias("query_id"), F.col("code").alias("query"))
    near = search_codes(codes, asking, k, codes_per_part)
    rows = near.join(codes.select("code", "ids"), "code").select("query", "distance", F.explode("ids").alias("id"))
    first = rows.withColumn("n", F.row_number().over(Window.partitionBy("query").orderBy("distance", "id"))).where(F.col("n") <= k + 1)
    lists = first.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("distance", "id"))).alias("near"))
    others = F.slice(F.filter("near", lambda x: x["id"] != F.col("query_id")), 1, k)
    return asking.join(lists, "query").select("query_id", F.posexplode(others).alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("hit.id").alias("neighbour_id"), F.col("hit.distance").alias("distance"))


def op4_query(spark: SparkSession, embeddings: DataFrame) -> DataFrame:
    coded = embeddings.select("vec_id", sign_code(F.col("embedding")).alias("code"))
    return top_k(coded, F.col("vec_id") % 20 == 0, "vec_id", "code", K)


def oracle_sql() -> str:
    """All query rows against all rows."""
    return f"""
WITH coded AS (
  SELECT vec_id AS id, embedding AS e FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
bits AS (
  SELECT id, list_sum([CASE WHEN e[i] > 0 THEN 1::HUGEINT << (i - 1) ELSE 0::HUGEINT END
                       FOR i IN range(1, least(len(e), {BITS}) + 1)])::HUGEINT AS code FROM coded),
pairs AS (
  SELECT q.id AS query_id, r.id AS neighbour_id, bit_count(xor(q.code, r.code))::INTEGER AS distance
  FROM bits q JOIN bits r ON q.id % 20 = 0 AND q.id <> r.id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id) AS n FROM pairs)
SELECT query_id, n::INTEGER AS rank, neighbour_id, distance FROM ranked WHERE n <= {K}"""
