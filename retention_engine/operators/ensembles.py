"""Boosting stopped by average precision (M-E) and ensembles of seeds and resamples (S7, M-N).

Boosting: rounds are fitted on one part, and every stage (the first 1, 2, … trees) is scored on a holdout at once: one
pass gives the leaf of each tree for each row, and running sums of the leaves' values are the margins of all stages. The
stopping round is the best one once ``patience`` further rounds bring nothing. Trees are grown in the same order from the
same seed, so the model fitted anew with that many rounds is the first part of the one that was watched, and it is an
ordinary Spark ML model that can be saved and loaded.

Ensembles: models that differ by a seed or by a bootstrap resample of the training rows score every row in one pass; a
row's variance over them is what the score owes to the draw and not to the row.
"""
from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import r6
from .metrics import average_precision
from .split import SEED

# Fixed values of the catalogue: learning rate, leaves a tree, rows a leaf, rounds at most, rounds without gain that end it
# (0: all rounds are kept). Spark's trees are grown by depth, so a number of leaves is the nearest depth.
BOOSTING = {"default": (0.1, 31, 20, 100, 0), "regularised": (0.05, 15, 40, 100, 0), "tuned, early stop": (0.12, 2, 80, 150, 20)}


def depth_for(leaves: int) -> int:
    return max(1, (leaves - 1).bit_length())


def boosting(setting: str, label: str = "label", rounds: int | None = None, seed: int = 42) -> GBTClassifier:
    """An unfitted classifier of the catalogue. Spark has no L2 term on leaf values; the rows a leaf needs and the learning
    rate stand in for it."""
    rate, leaves, rows, most, _ = BOOSTING[setting]
    return GBTClassifier(featuresCol="features", labelCol=label, maxIter=rounds or most, stepSize=rate, maxDepth=depth_for(leaves),
                         minInstancesPerNode=rows, seed=seed)


def leaf_values(model: GBTClassificationModel) -> list[list[float]]:
    """The predictions of each tree's leaves, in the order of ``leafCol`` (left before right), times the tree's weight."""
    out = []
    for tree, weight in zip(model.trees, model.treeWeights, strict=True):
        out.append([weight * float(v) for v in re.findall(r"Predict: (\S+)", tree.toDebugString)])
    return out


def staged_margins(model: GBTClassificationModel, rows: DataFrame) -> DataFrame:
    """``rows`` with ``margins``: the sum of the first 1, 2, … trees. The probability of a margin m is 1 / (1 + exp(−2m))."""
    values = F.array(*[F.array(*map(F.lit, v)) for v in leaf_values(model)])
    watched = model.copy().setLeafCol("_leaf").setRawPredictionCol("").setProbabilityCol("").setPredictionCol("")
    scored = watched.transform(rows).withColumn("_leaf", vector_to_array("_leaf"))
    each = F.transform("_leaf", lambda leaf, i: F.get(F.get(values, i), leaf.cast("int")))
    start = F.array().cast("array<double>")
    running = F.aggregate(each, start, lambda a, x: F.concat(a, F.array(F.coalesce(F.get(a, F.size(a) - 1), F.lit(0.0)) + x)))
    return scored.withColumn("margins", running).drop("_leaf")


def staged_precision(model: GBTClassificationModel, holdout: DataFrame, label: str = "label") -> list[float | None]:
    """Average precision on the holdout after each round: all stages in one grouped aggregate."""
    stages = staged_margins(model, holdout).select(label, F.posexplode("margins").alias("stage", "margin"))
    ap = average_precision(stages, "margin", label, ["stage"]).collect()           # a row a round
    return [r["ap"] for r in sorted(ap, key=lambda r: r["stage"])]


def stop_at(scores: Sequence[float | None], patience: int) -> int:
    """Rounds to keep: those up to the best one before ``patience`` rounds in a row brought no better score."""
    best, at = None, 0
    for i, s in enumerate(scores):
        if s is not None and (best is None or s > best):
            best, at = s, i
        elif patience and i - at >= patience:
            break
    return at + 1


@dataclass
class Stopped:
    model: GBTClassificationModel
    rounds: int
    scores: list[float | None]


def fit_boosting(setting: str, fit: DataFrame, holdout: DataFrame, label: str = "label", seed: int = 42) -> Stopped:
    """A setting of the catalogue fitted on ``fit``; with patience, stopped by the average precision on ``holdout``. ``fit``
    may be read twice, and several settings may be fitted on it at a time: it is left as the caller keeps it."""
    patience = BOOSTING[setting][4]
    model = boosting(setting, label, seed=seed).fit(fit)
    scores = staged_precision(model, holdout, label)
    rounds = stop_at(scores, patience) if patience else len(scores)
    return Stopped(model if rounds == len(scores) else boosting(setting, label, rounds, seed).fit(fit), rounds, scores)


def bootstrap_weight(id_col: str, replicate: int, seed: str = SEED) -> Column:
    """How often a row is drawn in a resample: Poisson(1) from a hash of its id and the replicate."""
    import math

    from ..functions.columns import hash_uniform
    u = hash_uniform(F.concat_ws("#", F.col(id_col).cast("string"), F.lit(str(replicate))), seed)
    total, w = 0.0, F.lit(0)
    for k in range(12):
        total += math.exp(-1) / math.factorial(k)
        w = w + (u >= F.lit(total)).cast("int")
    return w.cast("double")


def score_all(models: Sequence[Model], rows: DataFrame) -> DataFrame:
    """``rows`` with ``p``: the probability each model gives, in one pass over the rows."""
    out = rows
    for i, m in enumerate(models):
        if isinstance(m, PipelineModel):
            raise TypeError("encode the rows once and give the classifiers")
        out = m.copy().setRawPredictionCol("").setPredictionCol("").setProbabilityCol(f"_p{i}").transform(out)
    return out.withColumn("p", F.array(*[vector_to_array(f"_p{i}")[1] for i in range(len(models))])).drop(*[f"_p{i}" for i in range(len(models))])


def spread(scored: DataFrame, threshold: float) -> DataFrame:
    """Over all rows: mean and largest standard deviation of a row's scores over the models, and the share of rows that
    some models decide one way at the threshold and some the other."""
    n = F.size("p")
    mean = F.aggregate("p", F.lit(0.0), lambda a, x: a + x) / n
    var = F.aggregate(F.transform("p", lambda x: F.pow(x - F.col("_m"), F.lit(2.0))), F.lit(0.0), lambda a, x: a + x) / n
    rows = scored.withColumn("_m", mean).select(F.sqrt(var).alias("sd"), (F.array_min("p") < threshold).alias("lo"), (F.array_max("p") >= threshold).alias("hi"))
    return rows.agg(F.count(F.lit(1)).alias("n"), r6(F.avg("sd")).alias("mean_sd"), r6(F.max("sd")).alias("max_sd"),
                    r6(F.avg((F.col("lo") & F.col("hi")).cast("double"))).alias("decided_both_ways"))
