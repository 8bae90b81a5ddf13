"""Helpers shared by the operators: scratch tables, whole-text scans, hold-out rule."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.session import checkpoint_dir


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder of ``spark.checkpoint.dir`` and read it back.

    The lineage ends at the files, so a lost executor costs a re-read and
    never a recomputation, and a non-deterministic plan is evaluated once.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/llm-{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared storage."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)


def release(df: DataFrame) -> None:
    """Delete the files behind a frame of ``materialise`` that no later plan reads."""
    path = getattr(df, "_scratch_path", None)
    if path:
        delete(df.sparkSession, path)


def remainder_of_id(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id has remainder 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus, F.lit(0)).cast("int")


def scan_texts(
    df: DataFrame,
    columns: list[str],
    fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str,
) -> DataFrame:
    """Run ``fn`` over Arrow batches of the named columns only."""
    return df.select(*[F.col(f"`{c}`") for c in columns]).mapInArrow(fn, schema)


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as UTF-8 (``bytes.split`` splits at exactly these six characters)."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def lower_words_of(text: str | None) -> list[bytes]:
    """The same words with A-Z lower-cased (``bytes.lower`` touches ASCII letters only)."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
