"""Evaluation and ensembling.  Ids: M5-M9 (A11, A12, A17 live in ``aggregate``).

Every metric is a grouped aggregate over the data: no per-row Python and no collect.
AUC first collapses rows to one per (group, score) with positive / negative counts, then
needs the number of rows below each score; that running sum is computed skew-safe with
:func:`running_sum_within` (range partitions + per-partition offsets), so a group
holding most of the rows is still spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .schema import _q
from .windows import rank_within, running_sum_within


def _c(x) -> Column:
    return F.col(_q(x)) if isinstance(x, str) else x


# ---------------------------------------------------------------- M5


def apk(actual, predicted, k: int = 25) -> Column:
    """M5: average precision at k of one ranked list.  A hit is a predicted id that is in
    ``actual`` and not earlier in the list; AP = sum(hits so far / position) over hits,
    divided by min(|actual|, k); an empty ``actual`` gives 0."""
    a, p = _c(actual), F.slice(_c(predicted), 1, k)
    init = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("s"))

    def step(acc, i):
        x = F.element_at(p, i)
        hit = F.array_contains(a, x) & ~F.array_contains(F.slice(p, 1, i - 1), x)
        return F.when(hit, F.struct((acc["n"] + 1).alias("n"), (acc["s"] + (acc["n"] + 1) / i).alias("s"))) \
            .otherwise(acc)

    total = F.aggregate(F.sequence(F.lit(1), F.greatest(F.size(p), F.lit(1))), init,
                        lambda acc, i: F.when(i <= F.size(p), step(acc, i)).otherwise(acc))
    return F.when((F.size(a) == 0) | a.isNull(), F.lit(0.0)).otherwise(total["s"] / F.least(F.size(a), F.lit(k)))


def map_at_k(df: DataFrame, actual: str, predicted: str, k: int = 25, by: Sequence[str] = ()) -> DataFrame:
    """M5: mean AP@k over rows (optionally per group)."""
    return df.groupBy(*[_q(b) for b in by]).agg(F.avg(apk(actual, predicted, k)).alias(f"map_at_{k}"),
                                                F.count(F.lit(1)).alias("n_queries"))


# ---------------------------------------------------------------- M6


def weighted_log_loss(df: DataFrame, label: str, logits: Sequence[str], weights: Sequence[float] = (1, 2, 4),
                      ignore: int = -100, eps: float = 1e-15, by: Sequence[str] = ()) -> DataFrame:
    """M6: softmax over the logits; each row weighs ``weights[label]`` (0 for the ignored
    sentinel); result sum(w * -ln p_label) / sum(w) (null when every row is ignored), p clipped to [eps, 1 - eps]."""
    ls = [F.col(_q(c)).cast("double") for c in logits]
    m = F.greatest(*ls) if len(ls) > 1 else ls[0]
    exps = [F.exp(x - m) for x in ls]
    z = exps[0]
    for e in exps[1:]:
        z = z + e
    y = F.col(_q(label))
    p = None
    w = None
    for i, e in enumerate(exps):
        p = F.when(y == i, e / z) if p is None else p.when(y == i, e / z)
        w = F.when(y == i, F.lit(float(weights[i]))) if w is None else w.when(y == i, F.lit(float(weights[i])))
    w = w.otherwise(F.lit(0.0))
    pc = F.least(F.greatest(p, F.lit(eps)), F.lit(1 - eps))
    loss = F.when(w > 0, w * -F.log(pc)).otherwise(F.lit(0.0))
    return df.groupBy(*[_q(b) for b in by]).agg(F.try_divide(F.sum(loss), F.sum(w)).alias("log_loss"),
                                                F.sum((w > 0).cast("long")).alias("n_used"))


def constant_baseline(df: DataFrame, label: str, n_classes: int = 3, **kw) -> DataFrame:
    """M6: the same loss for the constant 1/n prediction (ln 3 = 1.0986 for 3 classes)."""
    zero = [F.lit(0.0).alias(f"__l{i}") for i in range(n_classes)]
    return weighted_log_loss(df.select(_q(label), *zero), label, [f"__l{i}" for i in range(n_classes)], **kw)


# ---------------------------------------------------------------- M7 M8


def auc_by(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """M7: ROC AUC per group with average ranks on ties:
    (sum of positive average ranks - P(P+1)/2) / (P N); null when P or N is 0."""
    by = list(by)
    y = F.col(_q(label)).cast("int")
    coll = df.groupBy(*[_q(b) for b in by], F.col(_q(score)).alias("__s")).agg(
        F.sum(y).cast("long").alias("__pos"), F.sum(1 - y).cast("long").alias("__neg"))
    coll = coll.withColumn("__cnt", F.col("__pos") + F.col("__neg"))
    ranked = running_sum_within(coll, by, "__s", "__cnt", "__below")
    contrib = F.col("__pos") * (F.col("__below") + (F.col("__cnt") + 1) / 2.0)
    g = ranked.groupBy(*[_q(b) for b in by]).agg(F.sum(contrib).alias("__r"), F.sum("__pos").alias("n_pos"),
                                                 F.sum("__neg").alias("n_neg"))
    p, nn = F.col("n_pos").cast("double"), F.col("n_neg").cast("double")  # products beyond 64 bits
    auc = F.when((p > 0) & (nn > 0), (F.col("__r") - p * (p + 1) / 2.0) / (p * nn))
    return g.select(*[_q(b) for b in by], auc.alias("auc"), "n_pos", "n_neg")


def gini_stability(df: DataFrame, week: str, label: str, score: str, w_fall: float = 88.0,
                   w_resstd: float = -0.5) -> DataFrame:
    """M8: per week gini = 2 AUC - 1 (weeks where AUC is defined, ascending, x = 0..n-1);
    least-squares line; mean + w_fall * min(0, slope) + w_resstd * std(residuals, over n).

    One aggregate over the per-week table: the residuals of a least-squares line with
    intercept have mean 0, so their population std is
    ``sqrt(var_pop(gini) - slope^2 * var_pop(x))`` (clipped at 0 against rounding)."""
    g = auc_by(df, label, score, [week]).filter(F.col("auc").isNotNull()) \
        .select(_q(week), (2 * F.col("auc") - 1).alias("gini"))
    x = rank_within(g, None, [week], alias="__x").withColumn("x", F.col("__x").cast("double"))
    out = x.agg(F.avg("gini").alias("mean_gini"), F.regr_slope("gini", "x").alias("slope"),
                F.var_pop("gini").alias("__vy"), F.var_pop("x").alias("__vx"), F.count(F.lit(1)).alias("n_weeks"))
    slope = F.coalesce(F.col("slope"), F.lit(0.0))
    res_std = F.sqrt(F.greatest(F.col("__vy") - slope * slope * F.col("__vx"), F.lit(0.0)))
    out = out.withColumn("res_std", res_std)
    score_col = F.col("mean_gini") + F.lit(w_fall) * F.least(F.lit(0.0), F.col("slope")) + F.lit(w_resstd) * F.col("res_std")
    return out.select(score_col.alias("stability"), "mean_gini", "slope", "res_std", "n_weeks")


# ---------------------------------------------------------------- M9


def blend(df: DataFrame, weights: Mapping[str, float], alias: str = "score") -> DataFrame:
    """M9: weighted mean of score columns; the weights must sum to 1."""
    if abs(sum(weights.values()) - 1.0) > 1e-9:
        raise ValueError("blend weights must sum to 1")
    expr = None
    for c, w in weights.items():
        term = F.col(_q(c)) * F.lit(float(w))
        expr = term if expr is None else expr + term
    return df.withColumn(alias, expr)


def mean_blend(df: DataFrame, cols: Sequence[str], alias: str = "score") -> DataFrame:
    """M9: plain average of model scores (the voting model)."""
    return blend(df, {c: 1.0 / len(cols) for c in cols}, alias)
