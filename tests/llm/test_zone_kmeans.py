"""Centroid clustering against plain integer rounds, and its SQL."""

import hashlib
import math
import random

import duckdb
import numpy as np
import pytest

from conftest import SF_SMALL
from panelcast.llm import zone_kmeans as Z
from panelcast.llm.common import read_table

SCHEMA = "vec_id bigint, embedding array<double>, cluster string, distance double"


def plain(rows, clusters, rounds, dim, scale=256, salt=2):
    kept = [(d, [math.floor(x * scale) if abs(x) < 1e300 else int(x) * scale for x in v]) for d, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: ("g" if r[0] is None else hashlib.sha256(f"{salt}:{r[0]}".encode()).hexdigest(), r[1]))
    centres = [v for _, v in first[:clusters]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centres))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        centres = [[sum(x) // len(groups[k]) for x in zip(*groups[k])] if k in groups else c for k, c in enumerate(centres)]
    at = [near(v) for _, v in kept]
    fits = lambda d: d if d < 2**63 else None
    total = {k: sum(d for d, j in at if j == k) for _, k in at}
    return [(d, k, fits(dist), fits(total[k]), fits(sum(total.values())),
             hashlib.sha256(",".join(map(str, centres[k])).encode()).hexdigest()) for (d, _), (dist, k) in zip(kept, at)]


def check(spark, rows, clusters, rounds, dim):
    df = spark.createDataFrame([(d, v, "c", 1.0) for d, v in rows], SCHEMA).repartition(3)
    got = Z.cluster_vectors(df, clusters=clusters, rounds=rounds, dim=dim).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, plain(rows, clusters, rounds, dim)))


def test_rounds_with_ties_repeats_and_odd_rows(spark):
    rng = random.Random(3)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, 0.3, 1.0]) for _ in range(5)]) for i in range(300)]
    rows += [(i, [0.25] * 5) for i in range(300, 420)]  # one vector of a hot group
    rows += [(1, rows[1][1]), (1, [0.1] * 5), (None, [0.2] * 5), (None, [0.2] * 5), (500, None), (501, []), (502, [0.1] * 4), (503, [0.1] * 6),
             (504, [0.1, None, 0.1, 0.1, 0.1]), (505, [float("nan")] * 5), (506, [float("inf")] + [0.0] * 4), (507, [-1e-300] * 5)]
    check(spark, rows, clusters=7, rounds=3, dim=5)


def test_large_components_are_exact(spark):
    rng = random.Random(5)
    rows = [(i, [rng.choice([1e9, -3.5e15, 0.1, 2.0**60, 5.0]) for _ in range(3)]) for i in range(40)]
    rows += [(i, [rng.random() for _ in range(3)]) for i in range(40, 90)] + [(99, [1e308, 0.0, 0.0])]
    check(spark, rows, clusters=6, rounds=2, dim=3)


def test_fewer_vectors_than_clusters_and_nothing(spark):
    check(spark, [(1, [0.5, 1.0]), (2, [3.0, 3.0])], clusters=5, rounds=2, dim=2)
    empty = Z.cluster_vectors(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and empty.columns == ["id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_candidates_hold_the_nearest():
    rng = np.random.default_rng(0)
    for _ in range(50):
        c, v = rng.integers(-50, 50, (12, 6)), rng.integers(-50, 50) + rng.integers(-9, 9, (30, 6))
        some = Z.candidates(v.min(axis=0), v.max(axis=0), c)
        assert np.isin(Z.nearest(v, c)[0], some).all()


@pytest.mark.parametrize("dims, bits", [(2, 3), (3, 2), (4, 2)])
def test_hilbert_order_is_a_walk(dims, bits):
    """Neighbours along the curve differ by one step in one component."""
    cells = np.array(np.meshgrid(*[np.arange(1 << bits)] * dims)).reshape(dims, -1).T
    walk = cells[np.argsort(np.array([int.from_bytes(k, "big") for k in Z.hilbert_keys(cells, bits)]))]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF_SMALL}/embeddings.parquet'")
    want = con.execute(Z.oracle_sql())
    names = [d[0] for d in want.description]
    got = Z.op12_query(spark, read_table(spark, SF_SMALL, "embeddings"))
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(str, (tuple(r[n] for n in names) for r in got.collect()))) == sorted(map(str, want.fetchall()))
