"""Training windows are cut from a stream of rows: any batch size gives the windows of the plain definition."""

import datetime as dt
import math
import random

import pytest

from panelcast.plans.forecast.sequence import make_sequences, patchify

D0 = dt.date(2021, 1, 1)


def series(spark):
    rng = random.Random(3)
    rows = [(k, D0 + dt.timedelta(days=2 * i), None if (k, i) == (2, 11) else 5 if k == 3 else rng.randrange(9), float(i))
            for k, n in ((1, 23), (2, 30), (3, 9), (None, 12), (4, 6), (5, 1)) for i in range(n)]
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "store_nbr bigint, date date, transactions bigint, rain double")


def plain(rows, lookback, horizon, step):
    out = {}
    for k in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == k), key=lambda r: r[1])
        for i in range(lookback - 1, len(mine) - horizon, step):
            part = [r[2] for r in mine[i - lookback + 1:i + horizon + 1]]
            if None in part:
                continue
            mean = sum(part[:lookback]) / lookback
            std = math.sqrt(sum((v - mean) ** 2 for v in part[:lookback]) / lookback)
            scaled = [round((v - mean) / (std or 1.0), 9) for v in part]
            x = sum(r[3] for r in mine[i - lookback + 1:i + 1]) / lookback
            out[k, mine[i][1]] = (round(mean, 9), round(std, 9), scaled[:lookback], scaled[lookback:], round(x, 9))
    return out


@pytest.mark.parametrize("records", [1, 7, 10_000])
@pytest.mark.parametrize("step", [1, 3])
def test_windows_equal_the_plain_definition(spark, records, step):
    rows, df = series(spark)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, records)
    try:
        got = make_sequences(df, 5, 2, exog=["rain"], step=step).collect()
    finally:
        spark.conf.set(name, before)
    found = {(r["store_nbr"], r["date"]): (round(r["x_mean"], 9), round(r["x_std"], 9), [round(v, 9) for v in r["input"]],
                                           [round(v, 9) for v in r["target"]], round(r["rain_mean"], 9)) for r in got}
    assert len(found) == len(got) and found == plain(rows, 5, 2, step)


def test_no_array_function_runs_per_element(spark):
    """Neither the windows nor the patches are built by lambdas or by a list per row."""
    _, df = series(spark)
    windows = make_sequences(df, 5, 2, places=6)
    patches = patchify(windows, patch_len=2, stride=1, lookback=5)
    for frame in (windows, patches):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert "lambda" not in plan and "collect_list" not in plan
    first = windows.collect()
    cut = {(r["store_nbr"], r["date"], r["patch_idx"]): r["patch"] for r in patches.collect()}
    assert cut == {(r["store_nbr"], r["date"], i): r["input"][i:i + 2] for r in first for i in range(4)}
    assert all(v == round(v, 6) for r in first for v in r["input"] + r["target"])
