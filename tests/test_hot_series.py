"""Chunked windows and the incremental refresh give the rows of the plain feature pipeline."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from panelcast.operators import hot_series as H
from panelcast.plans.feature_pipeline import build_final_dataset, build_final_dataset_in_chunks
from panelcast.plans.refresh import read_final_dataset, refresh_final_dataset

D0 = dt.date(2021, 1, 1)


def tables(spark, lengths):
    """Series of the given lengths with gaps, quotes with gaps, holidays (two on one date)."""
    rng = random.Random(1)
    tx = []
    for store, n in lengths.items():
        day = 0
        for _ in range(n):
            day += rng.choice([1, 1, 1, 2, 5])
            tx.append((store, D0 + dt.timedelta(days=day), rng.randrange(0, 50)))
    last = max((r[1] - D0).days for r in tx) + 1
    stores = [(s, "ABCDE"[s % 5], s % 3) for s in lengths]
    oil = [(D0 + dt.timedelta(days=i), None if i < 3 or rng.random() < 0.7 else 40 + rng.random()) for i in range(last)]
    hol = [(D0 + dt.timedelta(days=i), t, "National", False) for i in range(5, last, 37) for t in (("Holiday", "Event") if i % 2 else ("Holiday",))]
    return (spark.createDataFrame(tx, "store_nbr bigint, date date, transactions bigint"),
            spark.createDataFrame(stores, "store_nbr bigint, type string, cluster bigint"),
            spark.createDataFrame(oil, "date date, dcoilwtico double"),
            spark.createDataFrame(hol, "date date, type string, locale string, transferred boolean"))


def same(got, want):
    assert sorted(got.columns) == sorted(want.columns)
    names = sorted(want.columns)
    rows = lambda df: sorted(
        [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*names).collect()], key=str)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("chunk_rows", [28, 50, 10_000])
def test_chunks_equal_whole_series(spark, chunk_rows):
    t = tables(spark, {1: 900, 2: 40, 3: 28, 4: 5})
    same(build_final_dataset_in_chunks(*t, chunk_rows=chunk_rows), build_final_dataset(*t))


def test_a_hot_series_is_spread(spark):
    """Half of all rows in one series: no group of a window holds more than a chunk and its halo."""
    tx = tables(spark, {1: 1200, **{k: 60 for k in range(2, 22)}})[0]
    seen = H.in_chunks(tx, lambda df, keys: df.withColumn("group", F.concat_ws("/", *keys)).withColumn("held", F.col(H.ROW)), 28, chunk_rows=100)
    sizes = seen.groupBy("group").count().agg(F.max("count")).first()[0]
    assert seen.count() == tx.count() and sizes <= 100
    ranks = H.row_numbers(tx).groupBy("store_nbr").agg(F.max(H.ROW).alias("top"), F.countDistinct(H.ROW).alias("n"), F.count("*").alias("rows"))
    assert all(r["top"] == r["n"] == r["rows"] for r in ranks.collect())


def test_halo_must_fit(spark):
    with pytest.raises(ValueError):
        H.in_chunks(tables(spark, {1: 3})[0], lambda df, keys: df, 28, chunk_rows=20)


def test_day_by_day_equals_full(spark, tmp_path):
    tx, stores, oil, hol = tables(spark, {1: 60, 2: 33, 3: 10})
    late = tx.where("store_nbr = 2").withColumn("store_nbr", F.lit(4).cast("bigint")).withColumn("date", F.date_add("date", 45))
    tx = tx.unionByName(late)  # a series that begins later
    stores = stores.unionByName(spark.createDataFrame([(4, "A", 1)], stores.schema))
    days = sorted({r["date"] for r in tx.select("date").collect()})
    cuts = [days[:40], days[40:41], days[41:42], days[42:50], days[50:]]
    path = str(tmp_path / "final")
    for part in cuts:
        refresh_final_dataset(spark, path, tx.where(F.col("date").between(part[0], part[-1])), stores, oil, hol)
    want = build_final_dataset(tx, stores, oil, hol)
    same(read_final_dataset(spark, path), want)
    refresh_final_dataset(spark, path, tx.where(F.col("date") >= cuts[-1][0]), stores, oil, hol)  # once more
    refresh_final_dataset(spark, path, tx.limit(0), stores, oil, hol)
    same(read_final_dataset(spark, path), want)
    files = {d.name: {f.name for f in d.iterdir()} for d in (tmp_path / "final" / "table").iterdir() if d.is_dir()}
    refresh_final_dataset(spark, path, tx.where(F.col("date") == days[-1]), stores, oil, hol)
    after = {d.name: {f.name for f in d.iterdir()} for d in (tmp_path / "final" / "table").iterdir() if d.is_dir()}
    assert {k for k in files if files[k] != after[k]} <= {f"date={days[-1]}"}  # only the day's partition is rewritten


def test_offsets_and_fills_travel_without_a_join(spark):
    """Null keys and dates included: row numbers and fills are those of the plain windows, and no join meets all rows."""
    day = lambda i: None if i is None else D0 + dt.timedelta(days=i)
    rows = [(k, day(i), None if (i or 0) % 7 else float(i or 0) + (k or 0))
            for k, days in ((1, range(5, 130, 3)), (None, range(0, 90, 4)), (2, [None, 3, 40, 80])) for i in days]
    df = spark.createDataFrame(rows, "store_nbr bigint, date date, v double")
    numbered = H.row_numbers(df)
    filled = H.fill_in_chunks(numbered, "v", "filled", chunk_rows=4)
    assert "Join" not in filled._jdf.queryExecution().optimizedPlan().toString()
    want = []
    for k in (1, None, 2):
        last = None
        for n, r in enumerate(sorted((r for r in rows if r[0] == k), key=lambda r: (r[1] is not None, r[1] or D0)), 1):
            last = last if r[2] is None else r[2]
            want.append((*r, n, last))
    assert sorted(map(tuple, filled.collect()), key=str) == sorted(want, key=str)


def test_refresh_reads_the_new_rows_twice_at_most(spark, tmp_path):
    """Once for their dates and once for the work: the table and the state are written from one staged frame."""
    tx, stores, oil, hol = tables(spark, {1: 40, 2: 33})
    seen = tmp_path / "seen"
    seen.mkdir()
    folder = str(seen)

    def run(batches):
        import uuid

        open(f"{folder}/{uuid.uuid4().hex}", "w").close()
        yield from batches

    counted = tx.coalesce(1).mapInArrow(run, tx.schema)
    refresh_final_dataset(spark, str(tmp_path / "final"), counted, stores, oil, hol)
    assert len(list(seen.iterdir())) <= 2
