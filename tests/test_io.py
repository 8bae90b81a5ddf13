"""Sources and sinks."""

import datetime as dt
import warnings

from pyspark.sql import functions as F

from panelcast.sources.io import (
    OIL_SCHEMA,
    list_tables,
    read_csv_table,
    read_if_exists,
    read_table,
    write_table,
)


def test_read_if_exists_missing_path_warns(spark, tmp_path):
    with warnings.catch_warnings(record=True) as w:
        warnings.simplefilter("always")
        assert read_if_exists(spark, str(tmp_path / "nope.parquet")) is None
    assert any("not found" in str(x.message) for x in w)


def test_csv_with_schema_and_dates(spark, tmp_path):
    p = tmp_path / "oil.csv"
    p.write_text("date,dcoilwtico\n2013-01-01,\n2013-01-02,93.14\n")
    df = read_csv_table(spark, str(p), OIL_SCHEMA)
    rows = sorted(df.collect())
    assert rows[0]["date"] == dt.date(2013, 1, 1) and rows[0]["dcoilwtico"] is None
    assert rows[1]["dcoilwtico"] == 93.14


def test_dynamic_partition_overwrite(spark, tmp_path):
    path = str(tmp_path / "preds")
    a = spark.createDataFrame([("val", "m1", 1.0), ("val", "m2", 2.0)], "split string, model string, y double")
    write_table(a, path, ["split", "model"], dynamic=True)
    b = spark.createDataFrame([("val", "m1", 9.0)], "split string, model string, y double")
    write_table(b, path, ["split", "model"], dynamic=True)
    got = {r["model"]: r["y"] for r in read_table(spark, path).collect()}
    assert got == {"m1": 9.0, "m2": 2.0}
    assert read_table(spark, path).where(F.col("model") == "m2").count() == 1


def test_list_tables(spark):
    spark.range(1).createOrReplaceTempView("zz_probe")
    assert "zz_probe" in list_tables(spark)


def test_study_writes_partitioned_tables(spark, tmp_path):
    import os

    from panelcast.plans.study import run_study
    from panelcast.sources.fixtures import TRAIN_END, VAL_END, panel

    out = str(tmp_path / "study")
    m = run_study(spark, panel(spark, "/root/testdata/sf0.001"), out, TRAIN_END, VAL_END, tree_rounds=3)
    got = {(r["split"], r["model"]) for r in m.collect()}
    for split in ("val", "test"):
        for model in ("naive_lag7", "seasonal_arx", "decomposable", "direct_linear", "gbt_early_stop",
                      "gbt_full_sample"):
            assert (split, model) in got
    assert any(d.startswith("year=") for d in os.listdir(f"{out}/final_dataset"))
    assert os.path.isdir(f"{out}/predictions/split=val/model=seasonal_arx")
    assert os.path.isdir(f"{out}/models/gbt_early_stop_val")
