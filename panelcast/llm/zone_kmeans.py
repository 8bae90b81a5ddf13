"""Centroid clustering (Lloyd's rounds in exact integers) over space-filling-curve zone maps.

Vectors become integers floor(scale * x). They are ordered along a Hilbert
curve through all their dimensions and cut into blocks of ``BLOCK`` vectors,
each with its box (least and greatest value per component). In a round the box
bounds every centroid's distance from below and above: a centroid whose lower
bound exceeds the least upper bound is nearest to no vector of the block and is
left out; the rest are compared exactly, a block at a time. Blocks are written
once and read by every round. A round sends one row per cluster and task to
the shuffle and one row per cluster to the driver.

Components of up to ``EXACT`` in size are compared in doubles, whose products
and sums then stay under 2^53; larger ones are worked off as Python integers. A
distance or sum beyond 64 bits is returned as null.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.common import materialise

DIM, CLUSTERS, ROUNDS, SCALE, SALT = 64, 40, 5, 256, 2
BLOCK = 256
CURVE_BITS = 4  # per component
EXACT = 2**20
ROWS_PER_TASK = 100_000


def floored(values, scale: int) -> list[int]:
    """floor(scale * x) of each component, exact for every finite double."""
    return [math.floor(x * scale) if math.isfinite(x * scale) else int(x) * scale for x in values]


def integers(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of a matrix: int64, or Python integers where one is too large for exact doubles."""
    y = np.floor(x * scale)
    if not y.size or np.abs(y).max() <= EXACT:
        return y.astype(np.int64)
    out = np.empty(x.shape, dtype=object)
    for i, row in enumerate(x.tolist()):
        out[i] = floored(row, scale)
    return out


def pack(vectors: np.ndarray) -> bytes:
    """A matrix as int32, or as decimal numbers if it holds large ones."""
    if vectors.dtype != object:
        return b"i" + vectors.astype("<i4").tobytes()
    return b"d" + ",".join(map(str, vectors.ravel().tolist())).encode()


def unpack(blob: bytes, dim: int) -> np.ndarray:
    if blob[:1] == b"i":
        return np.frombuffer(blob, dtype="<i4", offset=1).astype(np.int64).reshape(-1, dim)
    return as_matrix([int(v) for v in blob[1:].split(b",")], dim)


def as_matrix(values: list[int], dim: int) -> np.ndarray:
    large = any(abs(v) > EXACT for v in values)
    return np.array(values, dtype=object if large else np.int64).reshape(-1, dim)


def hilbert_keys(cells: np.ndarray, bits: int) -> list[bytes]:
    """Place of each row of ``cells`` (``bits`` bits per component) along the Hilbert curve, as bytes that sort alike."""
    x = cells.T.astype(np.int64).copy()
    dims, rows = x.shape
    for level in range(bits - 1, 0, -1):
        bit, below = 1 << level, (1 << level) - 1
        for i in range(dims):
            turned = (x[i] & bit) > 0
            moved = np.where(turned, 0, (x[0] ^ x[i]) & below)  # turned: mirror the first axis; else swap it with axis i
            x[0] ^= np.where(turned, below, moved)
            x[i] ^= moved
    for i in range(1, dims):  # Gray code across the axes
        x[i] ^= x[i - 1]
    mirror = np.zeros(rows, dtype=np.int64)
    for level in range(bits - 1, 0, -1):
        mirror ^= np.where((x[dims - 1] >> level) & 1, (1 << level) - 1, 0)
    x ^= mirror
    planes = (x[None] >> np.arange(bits - 1, -1, -1)[:, None, None]) & 1  # highest level first
    return [r.tobytes() for r in np.packbits(planes.reshape(bits * dims, rows).T.astype(np.uint8), axis=1)]


def curve_cells(x: np.ndarray, mean: np.ndarray, spread: np.ndarray, bits: int) -> np.ndarray:
    """Cells of about equal shares of a bell-shaped component; any monotone cut gives right results."""
    z = np.clip(1.7 * (x - mean) / spread, -40, 40)
    return np.minimum(((1 << bits) / (1 + np.exp(-z))).astype(np.int64), (1 << bits) - 1)


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that may be nearest to some vector of the box."""
    under = np.maximum(np.maximum(low - centroids, centroids - high), 0)
    over = np.maximum(abs(centroids - low), abs(centroids - high))
    least, most = (under * under).sum(axis=1), (over * over).sum(axis=1)
    return np.nonzero((least <= min(most.tolist())).astype(bool))[0]


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row of the nearest centroid, squared distance) per vector; ties go to the smaller row."""
    if vectors.dtype == object or centroids.dtype == object:
        v, c = vectors.astype(object), centroids.astype(object)
        at, best = np.zeros(len(v), dtype=np.int64), ((v - c[0]) ** 2).sum(axis=1)
        for k in range(1, len(c)):
            d = ((v - c[k]) ** 2).sum(axis=1)
            less = (d < best).astype(bool)
            at, best = np.where(less, k, at), np.where(less, d, best)
        return at, best
    v, c = vectors.astype(np.float64), centroids.astype(np.float64)
    d = (v * v).sum(axis=1)[:, None] - 2.0 * (v @ c.T) + (c * c).sum(axis=1)
    at = d.argmin(axis=1)
    return at, d[np.arange(len(v)), at].astype(np.int64)


def usable_vectors(df: DataFrame, id_col: str, vector_col: str, dim: int) -> DataFrame:
    """(id, vector array<double>) of the rows with exactly ``dim`` components, none null or non-finite."""
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vector")).where(
        F.coalesce((F.size("vector") == dim) & finite, F.lit(False)))


def zone_blocks(kept: DataFrame, dim: int, scale: int, bits: int = CURVE_BITS, block: int = BLOCK) -> DataFrame:
    """(ids, vectors, low, high): blocks of up to ``block`` vectors that lie together on the curve, with their boxes."""
    spark = kept.sparkSession
    stats = {r["pos"]: r for r in kept.select(F.posexplode("vector")).groupBy("pos").agg(  # one row per component
        F.avg("col").alias("mean"), F.stddev_pop("col").alias("spread"), F.count(F.lit(1)).alias("n")).collect()}
    usual = lambda v, other: v if v is not None and math.isfinite(v) and v != 0 else other
    mean = np.array([usual(stats[i]["mean"], 0.0) if i in stats else 0.0 for i in range(dim)])
    spread = np.array([usual(stats[i]["spread"], 1.0) if i in stats else 1.0 for i in range(dim)])
    rows = stats[0]["n"] if stats else 0
    kind = kept.schema["id"].dataType.simpleString()

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.asarray(batch.column(1).flatten(), dtype=np.float64).reshape(-1, dim)
            keys = hilbert_keys(curve_cells(x, mean, spread, bits), bits)
            packed = [pack(integers(x[i:i + 1], scale)) for i in range(len(x))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys, pa.binary()), pa.array(packed, pa.binary())], names=["id", "place", "vector"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), block):
                part = batch.slice(a, block)
                blobs = part.column(1).to_pylist()
                if all(b[:1] == b"i" for b in blobs):
                    v = np.frombuffer(b"".join(b[1:] for b in blobs), dtype="<i4").astype(np.int64).reshape(-1, dim)
                else:
                    v = np.concatenate([unpack(b, dim).astype(object) for b in blobs])
                low, high = (as_matrix(side.tolist(), dim) for side in (v.min(axis=0), v.max(axis=0)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.column(0).to_pylist()], pa.list_(part.column(0).type)),
                     *[pa.array([pack(m)], pa.binary()) for m in (v, low, high)]], names=["ids", "vectors", "low", "high"])

    placed = materialise(kept.mapInArrow(keyed, f"id {kind}, place binary, vector binary"), "places")
    tasks = max(spark.sparkContext.defaultParallelism, rows // ROWS_PER_TASK)
    ordered = placed.repartitionByRange(tasks, "place", F.xxhash64("id")).sortWithinPartitions("place")  # equal vectors spread by id
    return materialise(
        ordered.select("id", "vector").mapInArrow(cut, f"ids array<{kind}>, vectors binary, low binary, high binary"), "blocks")


def _assigned(batch: pa.RecordBatch, i: int, first: int, centroids: np.ndarray, dim: int):
    """(vectors, cluster, squared distance) of one block."""
    v, low, high = (unpack(batch.column(first + k)[i].as_py(), dim) for k in range(3))
    some = candidates(low, high, centroids)
    at, distance = nearest(v, centroids[some])
    return v, some[at], distance


def recentred(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: floor(sum / count) of the vectors nearest to each; those without vectors stay."""
    dim = centroids.shape[1]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(len(centroids), dtype=np.int64), np.zeros(centroids.shape, dtype=object)
        for batch in batches:
            for i in range(len(batch)):
                v, cluster, _ = _assigned(batch, i, 0, centroids, dim)
                for k in np.unique(cluster).tolist():
                    mine = v[cluster == k]
                    count[k] += len(mine)
                    total[k] += mine.sum(axis=0).astype(object)
        held = np.nonzero(count)[0].tolist()
        yield pa.RecordBatch.from_arrays(
            [pa.array(held, pa.int32()), pa.array(count[held]), pa.array([",".join(map(str, total[k])) for k in held], pa.string())],
            names=["cluster", "n", "total"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        n, total = int(pdf["n"].sum()), [0] * dim
        for text in pdf["total"]:
            total = [a + int(b) for a, b in zip(total, text.split(","))]
        return pd.DataFrame({"cluster": pdf["cluster"].iloc[:1], "centre": [",".join(str(t // n) for t in total)]})

    partial = blocks.select("vectors", "low", "high").mapInArrow(sums, "cluster int, n bigint, total string")
    rows = partial.groupBy("cluster").applyInPandas(add, "cluster int, centre string").collect()  # one per cluster
    out = centroids.astype(object)
    for r in rows:
        out[r["cluster"]] = [int(v) for v in r["centre"].split(",")]
    return as_matrix(out.ravel().tolist(), dim)


def assign(blocks: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(id, cluster, distance): every vector with its nearest centroid and the squared distance to it."""
    dim, kind = centroids.shape[1], blocks.schema["ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                _, cluster, distance = _assigned(batch, i, 1, centroids, dim)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 1).flatten(), pa.array(cluster.astype(np.int32)),
                     pa.array([d if d < 2**63 else None for d in distance.tolist()], pa.int64())], names=["id", "cluster", "distance"])

    return blocks.mapInArrow(run, f"id {kind}, cluster int, distance bigint")


def fit_clusters(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", clusters: int = CLUSTERS,
                 rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, salt: int = SALT) -> tuple[DataFrame, np.ndarray]:
    """(blocks, centroids after ``rounds`` rounds).

    The first centroids are the ``clusters`` vectors with the smallest SHA-256
    of ``salt:id`` (equal ids: by the vector; null ids come last); a table with fewer vectors has fewer centroids.
    """
    kept = usable_vectors(df, id_col, vector_col, dim)
    digest = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("id").cast("string")), 256)
    first = kept.orderBy(digest.asc_nulls_last(), "vector").limit(clusters).collect()
    centroids = as_matrix([v for r in first for v in floored(r["vector"], scale)], dim)
    blocks = zone_blocks(kept, dim, scale)
    for _ in range(rounds if len(centroids) else 0):
        centroids = recentred(blocks, centroids)
    return blocks, centroids


def cluster_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", clusters: int = CLUSTERS,
                    rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, salt: int = SALT) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256), one row per usable vector.

    Rows whose vector is null, of another length, or holds a null or
    non-finite component are left out. Ties go to the cluster of the smaller number; repeated rows are
    vectors of their own with equal results. An empty table gives an empty result.
    """
    blocks, centroids = fit_clusters(df, id_col, vector_col, clusters, rounds, dim, scale, salt)
    spark = df.sparkSession
    found = materialise(assign(blocks, centroids), "clusters")
    sums = found.groupBy("cluster").agg(
        F.when(F.count("distance") == F.count(F.lit(1)), F.sum(F.col("distance").cast("decimal(38,0)"))).alias("s"))
    whole = sums.agg(F.when(F.count("s") == F.count(F.lit(1)), F.sum("s")).alias("t"))
    names = spark.createDataFrame(
        [(k, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for k, c in enumerate(centroids.tolist())],
        "cluster int, centroid_sha256 string")
    per_cluster = sums.join(F.broadcast(names), "cluster").crossJoin(F.broadcast(whole)).select(  # ``clusters`` rows
        "cluster", F.expr("try_cast(s AS bigint)").alias("cluster_inertia"), F.expr("try_cast(t AS bigint)").alias("inertia"),
        "centroid_sha256")
    return found.join(F.broadcast(per_cluster), "cluster").select(
        "id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_query(spark: SparkSession, embeddings: DataFrame) -> DataFrame:
    return cluster_vectors(embeddings).withColumnRenamed("id", "vec_id")


def oracle_sql() -> str:
    """The rounds written out one after the other."""
    steps = [f"""kept AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings WHERE len(embedding) = {DIM} AND len(list_filter(embedding, lambda x: isfinite(x))) = {DIM}),
      c0 AS (SELECT CAST(row_number() OVER (ORDER BY sha256('{SALT}:' || CAST(vec_id AS VARCHAR)), v) - 1 AS INTEGER) AS k, v AS c
        FROM kept ORDER BY sha256('{SALT}:' || CAST(vec_id AS VARCHAR)), v LIMIT {CLUSTERS})"""]
    for r in range(ROUNDS + 1):
        steps.append(f"""d{r} AS MATERIALIZED (SELECT vec_id, v, k, list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
            FROM kept, c{r}),
          a{r} AS MATERIALIZED (SELECT vec_id, v, min(d) AS d, arg_min(k, (d, k)) AS k FROM d{r} GROUP BY vec_id, v)""")
        if r < ROUNDS:
            steps.append(f"""s{r} AS (SELECT k, i, sum(v[i]) AS s, count(*) AS n FROM a{r}, range(1, {DIM + 1}) t(i) GROUP BY k, i),
              c{r + 1} AS (SELECT c{r}.k, coalesce(m.c, c{r}.c) AS c FROM c{r} LEFT JOIN (
                SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM s{r} GROUP BY k) m ON m.k = c{r}.k)""")
    last = ROUNDS
    return "WITH " + ",\n".join(steps) + f"""
      SELECT vec_id, a{last}.k AS cluster, CAST(a{last}.d AS BIGINT) AS distance,
        CAST(sum(a{last}.d) OVER (PARTITION BY a{last}.k) AS BIGINT) AS cluster_inertia, CAST(sum(a{last}.d) OVER () AS BIGINT) AS inertia,
        sha256(array_to_string(c{last}.c, ',')) AS centroid_sha256
      FROM a{last} JOIN c{last} ON c{last}.k = a{last}.k"""
