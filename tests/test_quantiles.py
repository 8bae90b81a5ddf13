import math

import numpy as np
import pytest

from panelcast.operators.quantiles import exact_quantiles

PROBS = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}


@pytest.mark.parametrize("ranges", [1, 7, 1024])
def test_exact_quantiles_equal_numpy(spark, ranges):
    rng = np.random.default_rng(0)
    groups = {"x": rng.normal(size=301), "y": np.full(20, 3.0), None: rng.integers(0, 5, 50).astype(float), "z": np.array([7.0])}
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("x", None), ("empty", None), ("y", float("nan"))]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: r for r in exact_quantiles(df, "g", "v", PROBS, ranges=ranges).collect()}
    near = {r["g"]: r for r in exact_quantiles(df, "g", "v", PROBS, "nearest", ranges).collect()}
    assert set(got) == set(groups)
    for g, vs in groups.items():
        s = sorted(vs)
        for name, p in PROBS.items():
            assert got[g][name] == pytest.approx(np.quantile(vs, p), abs=1e-12)
            assert near[g][name] == s[math.floor((len(s) - 1) * p + 0.5)]
    whole = exact_quantiles(df, [], "v", {"m": 0.5}, ranges=ranges).first()
    assert whole["m"] == pytest.approx(np.median(np.concatenate(list(groups.values()))))
    assert exact_quantiles(df.limit(0), [], "v", PROBS).count() == 0
