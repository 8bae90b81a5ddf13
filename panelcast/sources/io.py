"""Readers and writers (CSV with a declared schema, parquet, model persistence)."""

from __future__ import annotations

import uuid
import warnings

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from panelcast.session import checkpoint_dir

# Declared schemas of the reference's raw inputs (one read pass, stable types).
TRANSACTIONS_SCHEMA = T.StructType([
    T.StructField("date", T.DateType(), False),
    T.StructField("store_nbr", T.LongType(), False),
    T.StructField("transactions", T.LongType(), False),
])
STORES_SCHEMA = T.StructType([
    T.StructField("store_nbr", T.LongType(), False),
    T.StructField("city", T.StringType(), False),
    T.StructField("state", T.StringType(), True),
    T.StructField("type", T.StringType(), False),
    T.StructField("cluster", T.LongType(), False),
])
OIL_SCHEMA = T.StructType([
    T.StructField("date", T.DateType(), False),
    T.StructField("dcoilwtico", T.DoubleType(), True),
])
HOLIDAYS_SCHEMA = T.StructType([
    T.StructField("date", T.DateType(), False),
    T.StructField("type", T.StringType(), False),
    T.StructField("locale", T.StringType(), False),
    T.StructField("locale_name", T.StringType(), True),
    T.StructField("description", T.StringType(), True),
    T.StructField("transferred", T.BooleanType(), False),
])


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with header; dates parsed as yyyy-MM-dd. Without a schema the
    types are inferred (extra pass), as for the reference's plain reads."""
    r = spark.read.option("header", True).option("dateFormat", "yyyy-MM-dd")
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    return r.csv(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    """Parquet if present; a warning and ``None`` when the path does not exist.

    Only a missing path is swallowed; any other analysis error propagates.
    """
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in (e.getCondition() or "") or "PATH_NOT_FOUND" in str(e):
            warnings.warn(f"{path} not found - skipped")
            return None
        raise


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, dynamic: bool = False) -> None:
    """Overwrite a parquet table. With ``dynamic`` only the partitions present
    in ``df`` are replaced (predictions keyed by split and model)."""
    w = df.write.mode("overwrite")
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def staged(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written once to the shared folder of ``spark.checkpoint.dir`` and read back, for plans that read it several times."""
    path = f"{checkpoint_dir(df.sparkSession)}/{tag}-{uuid.uuid4().hex}"
    write_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def save_model(model, path: str) -> None:
    """Spark ML persistence (replaces pickling a fitted model)."""
    model.write().overwrite().save(path)


def save_trees(model, spark: SparkSession, path: str) -> None:
    """The tables of a boosted-tree model, in place of an earlier one."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)
    model.save(spark, path)


def list_tables(spark: SparkSession) -> list[str]:
    """Sorted names of the registered tables/views of the current catalog."""
    return sorted(t.name for t in spark.catalog.listTables())
