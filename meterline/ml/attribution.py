"""Shapley values of tree ensembles.

The value of a set of features is what a tree predicts when only those are
known: at a split on another feature both ways are taken, in the shares of the
training rows that went there. For one leaf this factors over the features on
its path, so a row's values need no sum over subsets: per leaf and feature it
is a product of what the row decides and what the shares decide, weighted by a
polynomial of at most the tree's depth.

Trees are small (their depth bounds them) and go to the tasks; rows stay in
Spark and are worked on in Arrow batches.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import factorial

import numpy as np
import pandas as pd
from pyspark.ml import Model, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Leaf:
    """Its prediction, and for each feature on its path the share of rows let through and the conditions."""

    value: float
    shares: tuple[float, ...]
    features: tuple[int, ...]
    conditions: tuple[tuple, ...]  # for each feature, (threshold or None, categories or None, whether the left side is taken)


def _leaves(node, path: tuple = ()) -> list[Leaf]:
    if not hasattr(node, "split") or node.getClass().getSimpleName() == "LeafNode":
        features = tuple(dict.fromkeys(f for f, _, _ in path))
        shares = tuple(float(np.prod([s for f, s, _ in path if f == one])) for one in features)
        conditions = tuple(tuple(c for f, _, c in path if f == one) for one in features)
        return [Leaf(float(node.prediction()), shares, features, conditions)]
    split, count = node.split(), float(node.impurityStats().count())
    continuous = split.getClass().getSimpleName() == "ContinuousSplit"
    threshold = float(split.threshold()) if continuous else None
    categories = None if continuous else tuple(float(c) for c in split.leftCategories())
    out = []
    for child, left in ((node.leftChild(), True), (node.rightChild(), False)):
        share = float(child.impurityStats().count()) / count
        out += _leaves(child, (*path, (int(split.featureIndex()), share, (threshold, categories, left))))
    return out


def _final(model: Model) -> Model:
    final = model.stages[-1] if isinstance(model, PipelineModel) else model
    if not hasattr(final, "featureImportances"):
        raise ValueError(f"{type(final).__name__} is no tree model")
    return final


def leaves(model: Model) -> list[tuple[float, list[Leaf]]]:
    """Weight and leaves of each tree of a fitted tree regressor, forest or booster."""
    final = _final(model)
    if not hasattr(final, "trees"):
        return [(1.0, _leaves(final._java_obj.rootNode()))]
    weights = list(final.treeWeights)
    total = sum(weights) if type(final).__name__.startswith("RandomForest") else 1.0
    return [(w / total, _leaves(t._java_obj.rootNode())) for w, t in zip(weights, final.trees)]


def expected(trees: list[tuple[float, list[Leaf]]]) -> float:
    """What the trees predict when no feature is known."""
    return sum(w * sum(leaf.value * float(np.prod(leaf.shares)) for leaf in own) for w, own in trees)


def shapley(x: np.ndarray, trees: list[tuple[float, list[Leaf]]]) -> np.ndarray:
    """Values of each row (of features) and feature."""
    out = np.zeros(x.shape)
    for weight, own in trees:
        for leaf in own:
            m = len(leaf.features)
            if not m:
                continue
            passes = np.ones((m, len(x)))
            for i, (f, conditions) in enumerate(zip(leaf.features, leaf.conditions)):
                for threshold, categories, left in conditions:
                    goes_left = x[:, f] <= threshold if categories is None else np.isin(x[:, f], categories)
                    passes[i] *= goes_left == left
            for i, f in enumerate(leaf.features):
                # Coefficient k: the sum over sets of k other known features.
                known = [np.ones(len(x))]
                for j in range(m):
                    if j != i:
                        share = leaf.shares[j]
                        known = [(known[k] * share if k < len(known) else 0) + (known[k - 1] * passes[j] if k else 0) for k in range(len(known) + 1)]
                sets = sum(c * (factorial(k) * factorial(m - 1 - k) / factorial(m)) for k, c in enumerate(known))
                out[:, f] += weight * leaf.value * (passes[i] - leaf.shares[i]) * sets
    return out


def attributions(model: Model, features: str = "features") -> Column:
    """The Shapley values of a row's features, as an array in the order of the vector.

    They add up to the prediction less ``expected``.
    """
    trees = leaves(model)

    @F.pandas_udf("array<double>")
    def values(rows: pd.Series) -> pd.Series:
        if not len(rows):
            return pd.Series([], dtype=object)
        return pd.Series(list(shapley(np.stack(rows.to_list()), trees)))

    return values(vector_to_array(features))


def attribution_ranking(model: Model, transformed: DataFrame, features: str = "features") -> DataFrame:
    """Features by mean absolute Shapley value over the rows, highest first, with the mean value.

    ``transformed`` holds the feature vector; slots are named from its metadata.
    Sums combine inside the tasks, one number for each feature.
    """
    attrs = transformed.schema[features].metadata["ml_attr"]["attrs"]
    names = {a["idx"]: a["name"] for group in attrs.values() for a in group}
    slots = F.create_map(*[F.lit(v) for pair in names.items() for v in pair]) if names else F.create_map()
    long = transformed.select(F.posexplode(attributions(model, features)).alias("slot", "value"))
    table = long.groupBy("slot").agg(F.avg(F.abs("value")).alias("mean_abs"), F.avg("value").alias("mean"))
    named = table.select(F.coalesce(slots[F.col("slot")], F.concat(F.lit("feature "), F.col("slot"))).alias("feature"), "mean_abs", "mean")
    return named.orderBy(F.desc("mean_abs"), "feature")
