"""Isolation forest (Liu, Ting and Zhou, 2008) as Spark jobs.

Fitting draws a bounded sample per tree by hashing ids and splits by hashing nodes, so neither depends on
partitioning, and grows all trees level by level. Scoring walks the trees over Arrow batches; the forest is
at most ``TREES`` complete binary trees of fixed height, whatever the size of the data.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logquarry.functions.quantiles import exact_quantiles
from logquarry.functions.trees import NODE_SCHEMA, SAMPLE_SIZE, combine, grow_tree, score_rows, uniform
from logquarry.operators.features import model_inputs
from logquarry.schema import ANALYSIS_COLUMNS, CATEGORICAL_FEATURES, NUMERIC_FEATURES

# Model settings.
TREES = 100
SEED = 42
CONTAMINATION = 0.05

POOL = TREES * SAMPLE_SIZE


def minimum_rows(contamination: float) -> int:
    """Fewest rows for which a model is fitted."""
    return max(2, int(1.0 / contamination) + 1) if contamination > 0 else 3


def tree_samples(inputs: DataFrame, total: int, seed: int = SEED) -> DataFrame:
    """The rows each tree grows from: ``inputs`` with ``tree`` and ``draw``, ``SAMPLE_SIZE`` a tree or all there are.

    Rows are thinned to a pool by a hash of the id, then each pool row enters each tree with a fixed
    probability, and a tree takes its smallest draws. The tests run in the scan, and no more than a
    tree's sample leaves any task, so what is shuffled does not grow with the data. The margin of two
    leaves no real chance of falling short of a full sample.
    """
    pool = inputs.where(uniform(F.col("id"), F.lit(str(seed))) < min(1.0, POOL / max(total, 1)))
    share = min(1.0, 2 * SAMPLE_SIZE / min(max(total, 1), POOL))
    trees = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")
    drawn = pool.select("*", trees).withColumn("draw", uniform(F.col("id"), F.col("tree"), F.lit(str(seed + 1))))
    order = F.row_number().over(Window.partitionBy("tree").orderBy("draw", "id"))
    return drawn.where(F.col("draw") < share).withColumn("taken", order).where(F.col("taken") <= SAMPLE_SIZE).drop("taken")


def forest_nodes(inputs: DataFrame, total: int, seed: int = SEED) -> DataFrame:
    """The nodes of the forest: tree, node, depth, rows, feature, threshold, category, path.

    A group is one tree's sample, ``SAMPLE_SIZE`` rows at most.
    """
    # a fixed number: the samples are small enough to be merged into one task otherwise
    samples = tree_samples(inputs, total, seed).repartition(TREES // 4, "tree")
    return samples.groupBy("tree").applyInPandas(lambda sample: grow_tree(sample, seed + 2), NODE_SCHEMA)


def fit(inputs: DataFrame, total: int, seed: int = SEED) -> dict:
    """Grow the trees and gather their nodes: at most 511 a tree."""
    return combine(forest_nodes(inputs, total, seed).collect(), min(total, SAMPLE_SIZE))


def with_scores(events: DataFrame, medians: dict[str, Column], model: dict) -> DataFrame:
    """The analysis columns, categories filled, plus ``model_score``, computed batch by batch."""
    shared = events.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        forest = shared.value
        for batch in batches:
            numbers = np.column_stack([s.to_numpy(dtype=float) for s in batch[: len(NUMERIC_FEATURES)]])
            yield pd.Series(score_rows(forest, numbers, list(batch[len(NUMERIC_FEATURES) :])))

    inputs = model_inputs(events, medians, keep=ANALYSIS_COLUMNS)
    named = [F.col(f"inputs.{c}") for c in (*NUMERIC_FEATURES, *CATEGORICAL_FEATURES)]
    filled = [F.col(f"inputs.{c}").alias(c) if c in CATEGORICAL_FEATURES else F.col(c) for c in ANALYSIS_COLUMNS]
    return inputs.select(*filled, score(*named).alias("model_score"))


def decide(scored: DataFrame, contamination: float) -> DataFrame:
    """From ``model_score`` to ``anomaly_score``, ``ml_prediction`` and ``is_anomaly``.

    The offset is the ``contamination`` quantile of all scores; rows strictly below it are anomalies.
    """
    offset = exact_quantiles(scored, {"model_score": [contamination]})["model_score"][0]
    score = F.col("model_score") - F.lit(offset)
    prediction = F.when(score < 0, -1).otherwise(1)
    return (
        scored.withColumn("anomaly_score", score)
        .withColumn("ml_prediction", prediction.cast("int"))
        .withColumn("is_anomaly", F.col("anomaly_score") < 0)
        .drop("model_score")
    )


def without_model(df: DataFrame) -> DataFrame:
    """Too few rows for a model: no score, no prediction, nothing anomalous."""
    return df.withColumns(
        {
            "anomaly_score": F.lit(None).cast("double"),
            "ml_prediction": F.lit(None).cast("int"),
            "is_anomaly": F.lit(False),
        }
    )
