"""Boosted trees as column expressions.

``GBTClassifier`` trains on rows with weights; its trees are then written out
as nested CASE expressions over struct fields, so they can score elements
inside arrays where the rows are read, with no join and no shuffle.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_IF = re.compile(r"If \(feature (\d+) <= (\S+)\)")
_PREDICT = re.compile(r"Predict: (\S+)")


def fit(
    rows: DataFrame, features: list[str], label: str, rounds: int, depth: int, seed: int = 7, weight: str | None = None
) -> GBTClassificationModel:
    """Trees on ``rows``, which should have few partitions; ``weight`` says how
    often each row counts."""
    assembled = VectorAssembler(inputCols=features, outputCol="_features").transform(rows)
    trainer = GBTClassifier(
        featuresCol="_features", labelCol=label, maxIter=rounds, maxDepth=depth, seed=seed, stepSize=0.3
    )
    columns = ["_features", F.col(label).cast("double").alias(label)]
    if weight:
        trainer.setWeightCol(weight)
        columns.append(F.col(weight).cast("double").alias(weight))
    return trainer.fit(assembled.select(*columns))


def _tree(lines: list[str], feature: Callable[[int], Column]) -> Column:
    """One tree from its printed form, read line by line."""
    line = lines.pop(0)
    if m := _PREDICT.search(line):
        return F.lit(float(m[1]))
    m = _IF.search(line)
    low = _tree(lines, feature)
    lines.pop(0)  # Else
    return F.when(feature(int(m[1])) <= float(m[2]), low).otherwise(_tree(lines, feature))


def probability(model: GBTClassificationModel, feature: Callable[[int], Column]) -> Column:
    """The model's probability of label 1, as one expression."""
    margin = F.lit(0.0)
    for tree, weight in zip(model.trees, model.treeWeights):
        lines = [x for x in tree.toDebugString.splitlines() if re.search("If|Else|Predict", x)]
        margin = margin + weight * _tree(lines, feature)
    return 1 / (1 + F.exp(-2 * margin))


def constant(share: float) -> Column:
    """Probability where there is nothing to learn from."""
    return F.lit(float(share) if math.isfinite(share) else 0.0)
