"""Per-fold model fitting and averaged scoring.  Ids: M16 (with M9).

The reference fits third-party boosted trees per fold on the driver's GPU; here the
model is MLlib's distributed ``GBTClassifier``: categorical columns are indexed
(``handleInvalid='keep'`` puts unseen levels in an extra bucket, like the ``Unknown``
level), numeric columns go through ``VectorAssembler(handleInvalid='keep')`` (nulls
stay NaN for the trees).  Scores of the fold models are averaged (the voting model).
Numeric parity with the reference's boosters is not a goal.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .schema import _q, join_null_safe
from .windows import rank_within, running_sum_within


class FoldModel(NamedTuple):
    """A model and the fold it was not trained on."""

    fold: object
    model: PipelineModel

    @property
    def trees(self) -> int:
        """Trees that the model kept."""
        return self.model.stages[-1].getNumTrees


def _pipeline(numeric: Sequence[str], categorical: Sequence[str], label: str, max_iter: int, max_depth: int,
              seed: int, bins: int, held: str | None, tol: float) -> Pipeline:
    idx = [StringIndexer(inputCol=c, outputCol=f"__idx_{c}", handleInvalid="keep") for c in categorical]
    vec = VectorAssembler(inputCols=list(numeric) + [f"__idx_{c}" for c in categorical], outputCol="__features",
                          handleInvalid="keep")
    gbt = GBTClassifier(featuresCol="__features", labelCol=label, maxIter=max_iter, maxDepth=max_depth, seed=seed,
                        maxBins=bins, validationTol=tol)
    if held:
        gbt = gbt.setValidationIndicatorCol(held)
    return Pipeline(stages=[*idx, vec, gbt])


def fit_folds(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], label: str, fold: str,
              max_iter: int = 20, max_depth: int = 4, seed: int = 42, early_stop: bool = False,
              tol: float = 0.01) -> list[FoldModel]:
    """One model per fold value (any type), each trained on the rows outside the fold; rows without a fold train
    every model.  ``early_stop``: rounds end when the loss on the held-out fold falls by less than ``tol`` of itself, and
    the trees up to the least loss are kept."""
    folds = sorted(r[0] for r in df.select(fold).filter(F.col(fold).isNotNull()).distinct().collect())  # the k fold values
    data = df.withColumn(label, F.col(label).cast("double"))
    # trees need a bin per level (and one for unseen levels), however many the data has
    levels = df.agg(*[F.count_distinct(c).alias(c) for c in categorical]).first() if categorical else []
    bins = max([32, *(n + 2 for n in levels)])
    made = _pipeline(numeric, categorical, label, max_iter, max_depth, seed, bins, "__held" if early_stop else None, tol)
    held = lambda f: F.col(fold).eqNullSafe(F.lit(f))
    return [FoldModel(f, made.fit(data.withColumn("__held", held(f)) if early_stop else data.filter(~held(f)))) for f in folds]


def score_folds(models: Sequence[FoldModel], df: DataFrame, key: str, alias: str = "score",
                fold: str | None = None) -> DataFrame:
    """M16 + M9: positive-class probability, one row per input row (``key`` may repeat).

    Without ``fold``: the average over all fold models (the voting model, for rows none of them
    saw).  With ``fold``: out-of-fold, each row is scored by the model whose fold value is its own, the one that was not
    trained on it; a row of a fold that no model has (or of none) is an error.  One frame is transformed by each model in
    turn; there is no join."""
    out = df
    for i, m in enumerate(models):
        before = set(out.columns)
        scored = m.model.transform(out).withColumn(f"__p{i}", vector_to_array("probability")[1])
        out = scored.drop(*[c for c in scored.columns if c not in before and not c.startswith("__p")])
    cols = [F.col(f"__p{i}") for i in range(len(models))]
    if fold is None:
        total = cols[0]
        for c in cols[1:]:
            total = total + c
        result = total / len(models)
        return out.select(key, result.alias(alias))
    own = F.coalesce(*[F.when(F.col(fold) == F.lit(m.fold), c) for m, c in zip(models, cols)],
                     F.raise_error(F.concat(F.lit("no model for fold "), F.coalesce(F.col(fold).cast("string"), F.lit("null"))))
                     .cast("double"))
    return out.select(key, fold, own.alias(alias))


def ordered_target_stats(df: DataFrame, cols: Sequence[str], label: str, key: str, seed: int = 42, weight: float = 1.0,
                         suffix: str = "_ts") -> DataFrame:
    """M16, categorical levels for trees: ``<col><suffix>`` is ``(s + weight * prior) / (c + weight)`` over the c rows of
    the same level (null is a level) that come before the row in a seeded shuffle by ``key``, s the sum of their labels and
    prior the mean label, so no row sees its own label.  ``key`` must be unique."""
    prior = df.select(F.avg(F.col(_q(label)).cast("double"))).scalar()
    out = df.withColumn("__o", F.struct(F.md5(F.concat(F.lit(f"{seed}:"), F.col(_q(key)).cast("string"))).alias("h"),
                                        F.col(_q(key)).alias("k"))).withColumn("__y", F.col(_q(label)).cast("double"))
    for c in cols:
        out = rank_within(running_sum_within(out, [c], "__o", "__y", "__s"), c, ["__o"], alias="__c")
        out = out.withColumn(f"{c}{suffix}", (F.col("__s") + weight * prior) / (F.col("__c") + F.lit(weight))).drop("__s", "__c")
    return out.drop("__o", "__y")


def target_stats_of(train: DataFrame, df: DataFrame, cols: Sequence[str], label: str, weight: float = 1.0,
                    suffix: str = "_ts") -> DataFrame:
    """The same statistics for rows that train no model: from all training rows of the level (none: the prior)."""
    prior = train.select(F.avg(F.col(_q(label)).cast("double"))).scalar()
    for c in cols:
        per = train.groupBy(_q(c)).agg(F.sum(F.col(_q(label)).cast("double")).alias("__s"), F.count(_q(label)).alias("__c"))
        df = join_null_safe(df, per, [c], "left").withColumn(
            f"{c}{suffix}", (F.coalesce("__s", F.lit(0.0)) + weight * prior) / (F.coalesce("__c", F.lit(0)) + F.lit(weight))).drop("__s", "__c")
    return df
