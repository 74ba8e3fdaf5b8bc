"""Random-forest training, scoring, decoding, persistence and evaluation.

Scoring is a narrow transformation: the fitted forest (at most
``num_trees * 2**max_depth`` nodes, a fixed bound) is shipped with the task
closure and every partition is scored independently -- no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import IndexToString
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from selfmend.operators.features import FEATURES, LABEL


def forest(num_trees: int = 100, max_depth: int = 8, subset: str = "onethird",
           seed: int = 10, impurity: str = "gini", bootstrap: bool = True,
           max_bins: int = 32) -> RandomForestClassifier:
    """M1/M2: the reference forest (100 trees, depth 8, ``onethird``, gini).
    The DataFrame-API variant used seed 10, the RDD-API one seed 20.

    Rows find their node by walking the trees grown so far. Keeping it between
    levels (``cacheNodeIds``) gives the same model, but holds ``num_trees``
    numbers a row in a further copy of the training set, two while a level
    ends."""
    return RandomForestClassifier(labelCol=LABEL, featuresCol=FEATURES, numTrees=num_trees,
                                  maxDepth=max_depth, featureSubsetStrategy=subset, seed=seed,
                                  impurity=impurity, bootstrap=bootstrap, maxBins=max_bins,
                                  cacheNodeIds=False)


def without_summary(stage):
    """A fitted stage as it is after save and load: a forest fresh from its
    fit holds its training summary, and with it the session and the training
    frame, which would go to every task that scores."""
    return stage.copy() if getattr(stage, "hasSummary", False) else stage


def probability_of(index: int = 1, col: str = "probability") -> Column:
    """M4: P(class ``index``) as a plain double."""
    return vector_to_array(F.col(col))[index]


def label_decoder(labels: Sequence[str]) -> IndexToString:
    """M5: class index -> original label string."""
    return IndexToString(inputCol="prediction", outputCol="predictedLabel", labels=list(labels))


def save_model(model: PipelineModel, path: str) -> None:
    """M6: persist (overwrite) to a shared path."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """M6: load a persisted pipeline."""
    return PipelineModel.load(path)


def confusion_matrix(scored: DataFrame) -> DataFrame:
    """(label, prediction, n) -- one partial/final aggregate."""
    return scored.groupBy(LABEL, "prediction").agg(F.count(F.lit(1)).alias("n"))
