"""Global gradient-boosted trees on the feature matrix.

Two variants with the reference's settings (500 rounds, rate 0.05, depth 6,
column share 0.8, seed 42):

* ``early_stop``: grown level by level, row share 0.8, leaf values damped by
  one row, early stopping with a patience of 30 rounds. The stopping set is
  the last ``valid_fraction`` of the training rows by date (not the scored
  split); it only chooses the round count. The model that is returned is
  fitted with that count on all training rows.
* ``full_sample``: grown leaf by leaf up to 31 leaves of at least 20 rows,
  every row in every round, no early stopping.

``boosting`` holds the histogram jobs. A persisted model is a node table;
importances are aggregates of it.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.plans.forecast.boosting import NODES, BoostedTrees, Trainer, TreeSettings, best_splits
from panelcast.session import checkpoint_dir

KEY, DATE, TARGET = "store_nbr", "date", "transactions"

# Fixed values (must equal the reference): tree settings.
N_ROUNDS, LEARNING_RATE, MAX_DEPTH, ROW_SHARE, COL_SHARE, SEED, PATIENCE = 500, 0.05, 6, 0.8, 0.8, 42, 30
MAX_LEAVES, LEAF_ROWS = 31, 20  # of the leaf-by-leaf trainer


@dataclass
class TreeFit:
    model: BoostedTrees
    features: list[str]
    variant: str
    best_rounds: int
    curve: list[tuple[int, float, float | None]] = field(default_factory=list)  # (round, train_rmse, valid_rmse)
    n_rows: int = 0  # rows of the final fit
    path: str | None = None  # where the model is persisted


def feature_matrix(df: DataFrame, features: Sequence[str], target: str = TARGET, out: str = "features") -> DataFrame:
    """Assemble the numeric features (booleans as 0/1) into one vector; a
    null feature raises (``handleInvalid="error"``)."""
    cast = [F.col(c).cast("double").alias(c) if isinstance(df.schema[c].dataType, (T.BooleanType, T.ByteType,
                                                                                      T.IntegerType, T.LongType))
            else F.col(c) for c in features]
    keep = [c for c in df.columns if c not in set(features)]
    base = df.select(*keep, *cast)
    if target in df.columns:
        base = base.withColumn("label", F.col(target).cast("double"))
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="error").transform(base)


def settings_of(variant: str, step: float = LEARNING_RATE, depth: int = MAX_DEPTH, seed: int = SEED) -> TreeSettings:
    if variant == "early_stop":
        return TreeSettings(depth, None, step, 1.0, 1, ROW_SHARE, COL_SHARE, seed)
    if variant == "full_sample":
        return TreeSettings(depth, MAX_LEAVES, step, 0.0, LEAF_ROWS, 1.0, COL_SHARE, seed)
    raise ValueError(variant)


def _stop_date(data: DataFrame, date_col: str, valid_fraction: float):
    """Last date of the fitting part: the first date by which 1 - valid_fraction of the rows are reached (exact; the
    counts per date are bounded by the calendar). None if that is the last date of all: nothing to stop on."""
    counts = sorted((r[0], r[1]) for r in data.groupBy(date_col).count().collect())
    wanted, upto = (1.0 - valid_fraction) * sum(n for _, n in counts), 0
    for date, n in counts:
        upto += n
        if upto >= wanted:
            return date if date != counts[-1][0] else None
    return None


def _rounds(trainer: Trainer, settings: TreeSettings, rounds: int, patience: int | None) -> tuple[int, list]:
    """Grow up to ``rounds`` trees; (best round count, curve). With a patience, end that many rounds after the best one."""
    curve, best, best_round = [], float("inf"), 0
    for r in range(rounds + 1):
        train, valid = trainer.grow(settings) if r < rounds else trainer.final_losses(settings)
        if r:  # the losses are those before this round's tree
            curve.append((r, train, valid))
            if patience is not None:
                if valid < best:
                    best, best_round = valid, r
                elif r - best_round >= patience:
                    break
    return best_round if patience is not None else rounds, curve


def fit_boosted_trees(train: DataFrame, features: Sequence[str], target: str = TARGET, variant: str = "early_stop",
                      rounds: int = N_ROUNDS, step: float = LEARNING_RATE, depth: int = MAX_DEPTH, seed: int = SEED,
                      patience: int = PATIENCE, valid_fraction: float = 0.1, date_col: str = DATE,
                      key: Sequence[str] = (KEY, DATE)) -> TreeFit:
    """Fit one variant. Rows are sampled by a hash of ``key``, so a fit depends on the rows and the seed only; a null
    feature or target raises."""
    settings = settings_of(variant, step, depth, seed)
    best, curve = rounds, []
    data, drop = _written(train, [*dict.fromkeys([*key, date_col]), *features, target])  # the features are computed once
    trainer = None
    try:
        last = _stop_date(data, date_col, valid_fraction) if variant == "early_stop" else None
        if last is not None:
            trainer = Trainer(data.withColumn("__valid", F.col(date_col) > F.lit(last)), features, target, key, "__valid")
            best, curve = _rounds(trainer, settings, rounds, patience)
            trainer.close()
        trainer = Trainer(data, features, target, key)  # every training row
        if curve:
            for _ in range(best):
                trainer.grow(settings, losses=False)
        else:
            _, curve = _rounds(trainer, settings, rounds, None)
        return TreeFit(trainer.model(), list(features), variant, best, curve, trainer.n)
    finally:
        if trainer is not None:
            trainer.close()
        drop()


def _written(df: DataFrame, columns: Sequence[str]):
    """The columns as a Parquet table in the shared folder, and a function that deletes it."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/trees-input-{uuid.uuid4().hex}"
    df.select(*[F.col(f"`{c}`") for c in dict.fromkeys(columns)]).write.parquet(path)

    def drop() -> None:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)

    return spark.read.parquet(path), drop


def persist(spark, fit: TreeFit, path: str) -> TreeFit:
    """Write the model's node table; importances read it from there."""
    fit.model.save(spark, path)
    fit.path = path
    return fit


def predict_trees(fit: TreeFit, df: DataFrame, key=KEY, date_col=DATE, target=TARGET) -> DataFrame:
    """Predictions keyed by (key, date): the row keeps its keys, no
    positional re-attachment."""
    rows = df.select(F.col(key), F.col(date_col), F.col(target).cast("double").alias("y_true"),
                     F.array(*[F.col(c).cast("double") for c in fit.features]).alias("features"))
    return fit.model.transform(rows, "features", "y_pred").drop("features")


def tree_nodes(spark, fit: TreeFit) -> DataFrame:
    """The model as a relation: one row per node of every tree (inner nodes have feature, threshold and gain)."""
    if fit.path is not None:
        return spark.read.schema(NODES).parquet(f"{fit.path}/nodes")
    return spark.createDataFrame(fit.model.node_rows(), NODES)


def importance_of(nodes: DataFrame, features: Sequence[str], measure: str) -> DataFrame:
    """(feature, importance, share) of a node table: mean ``gain`` per split, or number of ``splits``; 0 where never split on."""
    spark = nodes.sparkSession
    value = {"gain": F.avg("gain"), "splits": F.count(F.lit(1)).cast("double")}[measure]
    used = nodes.where(F.col("feature_number").isNotNull()).groupBy("feature_number").agg(value.alias("v"))
    named = spark.createDataFrame(list(enumerate(features)), "feature_number int, feature string")
    every = named.join(F.broadcast(used), "feature_number", "left").select(  # one row per feature
        "feature", F.coalesce("v", F.lit(0.0)).alias("importance"))
    total = every.agg(F.sum("importance").alias("total"))
    return every.join(F.broadcast(total)).select(
        "feature", "importance", F.when(F.col("total") > 0, F.col("importance") / F.col("total")).otherwise(F.lit(0.0)).alias("share"))


def feature_importance(spark, fit: TreeFit) -> DataFrame:
    """(feature, importance, share): mean gain of the level-wise model, split counts of the leaf-wise one; shares sum to 1."""
    return importance_of(tree_nodes(spark, fit), fit.features, "gain" if fit.variant == "early_stop" else "splits")


def learning_curve(spark, fit: TreeFit) -> DataFrame:
    """RMSE per boosting round on the fitting rows and the stopping set."""
    return spark.createDataFrame(fit.curve, "round int, train_rmse double, valid_rmse double")


def first_splits(train: DataFrame, features: Sequence[str], target: str = TARGET, key: Sequence[str] = (KEY, DATE)) -> DataFrame:
    """(feature, threshold, gain, rows_left, rows_right): each feature's best split of all rows, before any tree.

    Features without a split that gains are left out."""
    settings = TreeSettings(depth=1)
    trainer = Trainer(train, features, target, key)
    try:
        root = (np.array([-1]), *[np.zeros(1, dtype=np.int64)] * 3, np.zeros(1))
        hist, _ = trainer.sums(root, [0], np.arange(len(trainer.features)), settings, False)
        rows = []
        for i, name in enumerate(trainer.features):
            gain, f, cut = best_splits(hist[:, i:i + 1], trainer.unit, settings)[0]
            if f >= 0:
                left = int(hist[0, i, :cut + 1, 1].sum())
                rows.append((name, float(trainer.cuts[i][cut]), gain, left, trainer.n - left))
    finally:
        trainer.close()
    return train.sparkSession.createDataFrame(rows, "feature string, threshold double, gain double, rows_left bigint, rows_right bigint")
