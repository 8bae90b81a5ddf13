"""Training corpus from raw documents: five stages, each written as Parquet and read again by the next.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm import mixing, pieces, quality, simhash, toxicity
from panelcast.llm.common import delete, read_table
from panelcast.session import checkpoint_dir

# Target weights of the mix (toxic documents are gone by then). The token budget follows from keeping the good
# domain whole; the poor one is thinned to its weight, or stays as it is if it has fewer tokens.
MIX = {"good": 0.95, "poor": 0.05}


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the quality rules reject. Null and empty texts fail; equal id, text and language share one verdict; an empty frame stays empty."""
    return quality.drop_rejected(docs)


def toxic_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what is predicted toxic by a model of the labelled rows left. Null texts are scored as empty; without labels of both kinds
    every row has the share of toxic labels as its score."""
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(model, docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate component, that of the smallest id; null and wordless texts are one component."""
    return simhash.keep_one_per_group(docs, "doc_id", "text")


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows by the rates that give the target weights MIX; rows of equal id and text stay or go together, an empty frame stays empty."""
    return mixing.mix_documents(docs, read_table(spark, sf_dir, "labels"), MIX, tuple(MIX), budget=True)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every row; null and empty texts have none."""
    return pieces.encode(docs, other=("lang", "source")).select(
        F.col("id").alias("doc_id"), "lang", "source", F.size("ids").cast("bigint").alias("n_tokens"), "ids",
        F.element_at("scores", 1).alias("score"), "decoded_equal")


STAGES = [
    ("quality rules", quality_rules),
    ("toxicity", toxic_text),
    ("simhash near-dedup", near_duplicates),
    ("mixing to target weights", mix_to_targets),
    ("piece encoding", encode_pieces),
]

# Tokenisers, dictionaries and fitted rates have no SQL form; tests/llm holds the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's table. The tables of the stages before it are deleted when their successor is written."""
    docs = read_table(spark, sf_dir, "documents")
    base = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{base}/{k}")
        if k:
            delete(spark, f"{base}/{k - 1}")
        docs = spark.read.schema(out.schema).parquet(f"{base}/{k}")
    return docs
