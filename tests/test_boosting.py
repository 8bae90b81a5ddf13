"""The histogram booster against a plain second-order booster that sorts and scans every feature at every node."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.plans.forecast import boosting as B
from panelcast.plans.forecast import trees as T

D0 = dt.date(2020, 1, 1)
FEATURES = ["a", "b", "c", "d"]
SCHEMA = "store_nbr bigint, date date, a double, b int, c boolean, d double, transactions double"


def rows(n, seed=0):
    rng = np.random.default_rng(seed)
    a, b, c, d = rng.normal(size=n), rng.integers(0, 12, n), rng.random(n) < 0.3, np.round(rng.exponential(size=n), 1)
    y = 3 * np.sin(2 * a) + (b % 5) * 0.7 - 2 * c * d + rng.normal(scale=0.3, size=n)
    return [(int(i % 5), D0 + dt.timedelta(days=int(i // 5)), float(a[i]), int(b[i]), bool(c[i]), float(d[i]), float(y[i]))
            for i in range(n)]


def plain_best(x, g, cuts, settings):
    """(gain, feature, threshold) over all cuts of all features; the first of equal ones."""
    best = (B.LEAST_GAIN, -1, 0.0)
    lam, G, N = settings.ridge, g.sum(), len(g)
    for f in range(x.shape[1]):
        for t in cuts[f]:
            left = x[:, f] <= t
            n = int(left.sum())
            if n < max(settings.least_rows, 1) or N - n < max(settings.least_rows, 1):
                continue
            gl = g[left].sum()
            gain = 0.5 * (gl**2 / (n + lam) + (G - gl) ** 2 / (N - n + lam) - G**2 / (N + lam))
            if gain > best[0] + 1e-12:
                best = (gain, f, t)
    return best


def plain_tree(x, g, cuts, settings):
    """Prediction of one tree on its own rows, splits taken level by level or best leaf first."""
    out = np.zeros(len(g))
    leaves = [(np.arange(len(g)), 0)]
    best = {0: plain_best(x, g, cuts, settings)}
    n_leaves, splits = 1, 0
    while True:
        can = [i for i, (r, d) in enumerate(leaves) if r is not None and d < settings.depth and best[i][1] >= 0]
        if not can or (settings.leaves is not None and n_leaves >= settings.leaves):
            break
        at = max(can, key=lambda i: (best[i][0], -i)) if settings.leaves is not None else can[0]
        r, d = leaves[at]
        _, f, t = best[at]
        leaves[at] = (None, d)
        for part in (r[x[r, f] <= t], r[x[r, f] > t]):
            leaves.append((part, d + 1))
            best[len(leaves) - 1] = plain_best(x[part], g[part], cuts, settings) if d + 1 < settings.depth else (0.0, -1, 0.0)
        n_leaves, splits = n_leaves + 1, splits + 1
    for r, _ in leaves:
        if r is not None:
            out[r] = -settings.step * g[r].sum() / (len(r) + settings.ridge)
    return out, n_leaves


@pytest.mark.parametrize("settings", [
    B.TreeSettings(depth=4, ridge=1.0, least_rows=1, step=0.3),
    B.TreeSettings(depth=6, leaves=9, ridge=0.0, least_rows=20, step=0.3),
    B.TreeSettings(depth=3, leaves=31, ridge=0.5, least_rows=5, step=0.2, col_share=0.5),
])
def test_equals_a_plain_booster(spark, settings):
    data = rows(2000)
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    trainer = B.Trainer(df, FEATURES, "transactions", ["store_nbr", "date"])
    x, y = np.array([r[2:6] for r in data], dtype=float), np.array([r[6] for r in data])
    margin, curve = np.full(len(y), y.mean()), []
    for _ in range(6):
        columns = trainer.columns_of(settings)
        curve.append(trainer.grow(settings)[0])
        assert curve[-1] == pytest.approx(np.sqrt(((margin - y) ** 2).mean()), rel=1e-5)
        step, n_leaves = plain_tree(x[:, columns], margin - y, [trainer.cuts[c] for c in columns], settings)
        assert sum(f < 0 for f in trainer.trees[-1].feature) == n_leaves
        margin += step
    model = trainer.model()
    trainer.close()
    got = model.transform(df.select("store_nbr", "date", F.array(*[F.col(c).cast("double") for c in FEATURES]).alias("features")))
    want = {(r[0], r[1]): m for r, m in zip(data, margin)}
    assert all(r["prediction"] == pytest.approx(want[r["store_nbr"], r["date"]], abs=1e-5) for r in got.collect())


def test_cuts_keep_every_value_of_a_small_column(spark):
    df = spark.createDataFrame([(float(i % 7), float(i)) for i in range(3000)], "few double, many double")
    few, many = B.bin_cuts(df)
    assert few.tolist() == [0, 1, 2, 3, 4, 5] and 200 < len(many) <= 255


def test_rows_may_be_dealt_in_any_way(spark, monkeypatch):
    """Blocks, tasks, stored margins and lost worker tables change nothing, to the last bit."""
    df = spark.createDataFrame(rows(600), SCHEMA)
    fit = lambda d, v: T.fit_boosted_trees(d, FEATURES, variant=v, rounds=4, depth=3, patience=3).model.node_rows()
    first = {v: fit(df, v) for v in ("early_stop", "full_sample")}
    monkeypatch.setattr(B, "BLOCK_ROWS", 37)
    monkeypatch.setattr(B, "CHECKPOINT", 2)
    monkeypatch.setattr(B, "FAN_IN", 2)
    monkeypatch.setattr(B._MARGINS, "keep", 1)
    assert {v: fit(df.repartition(11), v) for v in first} == first


def test_curve_equals_full_evaluation(spark):
    data = spark.createDataFrame(rows(800), SCHEMA)
    fit = T.fit_boosted_trees(data, FEATURES, variant="full_sample", rounds=5, depth=3)
    for r, train, _ in fit.curve:
        model = B.BoostedTrees(fit.model.features, fit.model.cuts, fit.model.base, fit.model.trees[:r])
        part = T.TreeFit(model, FEATURES, "full_sample", r)
        rmse = T.predict_trees(part, data).agg(F.sqrt(F.avg(F.pow(F.col("y_true") - F.col("y_pred"), 2)))).first()[0]
        assert train == pytest.approx(rmse, rel=1e-5)
    assert len(fit.curve) == 5


def test_importances_from_the_persisted_nodes(spark, tmp_path):
    data = spark.createDataFrame(rows(800), SCHEMA)
    for variant in ("early_stop", "full_sample"):
        fit = T.persist(spark, T.fit_boosted_trees(data, FEATURES, variant=variant, rounds=6, depth=3), f"{tmp_path}/{variant}")
        gains = {f: [] for f in FEATURES}
        for tree in fit.model.trees:
            stack = [0]
            while stack:
                node = stack.pop()
                if tree.feature[node] >= 0:
                    gains[FEATURES[tree.feature[node]]].append(tree.gain[node])
                    stack += [tree.left[node], tree.right[node]]
        want = {f: (np.mean(g) if g else 0.0) if variant == "early_stop" else float(len(g)) for f, g in gains.items()}
        got = T.feature_importance(spark, fit).collect()
        assert {r["feature"]: r["importance"] for r in got} == pytest.approx(want)
        assert sum(r["share"] for r in got) == pytest.approx(1.0)
        again = B.BoostedTrees.load(spark, f"{tmp_path}/{variant}")
        assert again.node_rows() == fit.model.node_rows() and again.base == fit.model.base


def test_constant_target_and_nulls(spark):
    flat = spark.createDataFrame([(*r[:6], 2.5) for r in rows(50)], SCHEMA)
    fit = T.fit_boosted_trees(flat, FEATURES, variant="full_sample", rounds=2)
    assert all(t.feature == [-1] for t in fit.model.trees)
    assert {r["y_pred"] for r in T.predict_trees(fit, flat).collect()} == {2.5}
    with pytest.raises(Exception, match="null"):
        T.fit_boosted_trees(flat.withColumn("a", F.lit(None).cast("double")), FEATURES, variant="full_sample", rounds=1)


def test_nodes_finished_by_one_task(spark, monkeypatch):
    """Subtrees grown from dealt rows equal those of histogram jobs to the last bit; a round takes two jobs, not one a level."""
    df = spark.createDataFrame(rows(1500), SCHEMA)
    fit = lambda v: T.fit_boosted_trees(df, FEATURES, variant=v, rounds=4, patience=3).model.node_rows()
    calls = []
    plain = B.Trainer.sums
    monkeypatch.setattr(B.Trainer, "sums", lambda *a: calls.append(1) or plain(*a))
    monkeypatch.setattr(B, "LOCAL_ROWS", 0)
    first = {v: fit(v) for v in ("early_stop", "full_sample")}
    many = len(calls)
    for most in (60, 400, 32_768):
        monkeypatch.setattr(B, "LOCAL_ROWS", most)
        calls.clear()
        assert {v: fit(v) for v in first} == first
        assert len(calls) < many
    assert len(calls) <= 4 * 3 + 2  # the root of each tree of the three fits, and the last losses
