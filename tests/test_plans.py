"""Physical-plan checks: the feature chain shuffles once on the key, the
dimension joins are broadcast, no window runs in a single partition, and
date filters reach the parquet scan."""

import datetime as dt

import pytest

from panelcast.plans.feature_pipeline import build_final_dataset
from panelcast.sources.fixtures import panel


def _explain(df):
    import io
    import contextlib

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def tx_parquet(spark, tmp_path_factory):
    p = panel(spark, "/root/testdata/sf0.001")
    out = str(tmp_path_factory.mktemp("panel"))
    for name in ("tx", "stores", "oil", "holidays"):
        getattr(p, name).write.mode("overwrite").parquet(f"{out}/{name}")
    return out


def test_feature_pipeline_single_key_exchange(spark, tx_parquet):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        t = {n: spark.read.parquet(f"{tx_parquet}/{n}") for n in ("tx", "stores", "oil", "holidays")}
        df = build_final_dataset(t["tx"], t["stores"], t["oil"], t["holidays"])
        text = _explain(df)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    args = [ln for ln in text.splitlines() if ln.startswith("Arguments:")]
    key_exchanges = [ln for ln in args if "hashpartitioning(store_nbr" in ln]
    assert len(key_exchanges) == 1, text  # every window of the chain reuses it
    assert not any("SinglePartition" in ln for ln in args), text
    assert "BroadcastHashJoin" in text


def test_date_filter_pushed_to_scan(spark, tx_parquet):
    df = spark.read.parquet(f"{tx_parquet}/tx").where(f"date <= DATE '{dt.date(1999, 12, 31)}'").select("store_nbr")
    text = _explain(df)
    assert "PushedFilters" in text and "LessThanOrEqual(date" in text
    assert "ReadSchema: struct<store_nbr:bigint,date:date>" in text


@pytest.mark.parametrize("name", ["final_dataset", "missing_rows", "acf_panel", "sequences", "leaderboard_common"])
def test_per_series_queries_never_gather_into_one_partition(spark, name):
    import __spark_entry__ as E

    text = _explain(E.queries()[name](spark, "/root/testdata/sf0.001"))
    args = [ln for ln in text.splitlines() if ln.startswith("Arguments:")]
    assert not any("SinglePartition" in ln for ln in args), text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, text
