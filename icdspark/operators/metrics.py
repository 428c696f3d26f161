"""Multilabel evaluation on the long prediction table.

Input: one row per (instance, label) cell with ``score`` (probability) and
``y`` (0/1); ``yhat`` is the binarised score (c17).  The table must be dense
(every instance x label cell present) for micro and instance metrics; macro
metrics ignore all-zero cells anyway.  Every metric is an algebraic
aggregation (partial aggregation map-side), grouped by label or instance
first and averaged after, so no step holds more than one group's sums.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from icdspark.functions.maths import binarize, safe_ratio

# The epsilon of the macro ratios and the default precision@k cut-offs.
MACRO_EPS = 1e-10
TOP_KS = (5, 8, 15)


def with_yhat(pred: DataFrame) -> DataFrame:
    return pred if "yhat" in pred.columns else pred.withColumn("yhat", binarize("score"))


def _sums() -> list[Column]:
    y, yh = F.col("y"), F.col("yhat")
    return [
        F.sum(y * yh).cast("double").alias("intersect"),
        F.sum(F.greatest(y, yh)).cast("double").alias("union"),
        F.sum(yh).cast("double").alias("predicted"),
        F.sum(y).cast("double").alias("actual"),
        F.count(F.lit(1)).alias("cells"),
    ]


def set_sizes(pred: DataFrame, axis: str) -> DataFrame:
    """f01: union and intersection sizes per ``axis`` ('label' or 'instance')."""
    return with_yhat(pred).groupBy(axis).agg(*_sums()).select(axis, "union", "intersect")


def label_counts(pred: DataFrame) -> DataFrame:
    return with_yhat(pred).groupBy("label").agg(*_sums())


def instance_counts(pred: DataFrame) -> DataFrame:
    return with_yhat(pred).groupBy("instance").agg(*_sums())


def _f1(p: Column, r: Column) -> Column:
    return F.when(p + r == 0, F.lit(0.0)).otherwise(F.lit(2.0) * p * r / (p + r))


def _macro_columns() -> list[Column]:
    eps = F.lit(MACRO_EPS)
    return [
        F.avg(F.col("intersect") / (F.col("union") + eps)).alias("macro_accuracy"),
        F.avg(F.col("intersect") / (F.col("predicted") + eps)).alias("macro_precision"),
        F.avg(F.col("intersect") / (F.col("actual") + eps)).alias("macro_recall"),
    ]


def macro_scores(pred: DataFrame) -> DataFrame:
    """f02-f05: macro accuracy/precision/recall (mean of per-label ratios) and F1.

    F1 is the harmonic mean of macro precision and macro recall (not the mean
    of per-label F1s); 0 when both are 0.
    """
    m = label_counts(pred).agg(*_macro_columns())
    return m.withColumn("macro_f1", _f1(F.col("macro_precision"), F.col("macro_recall")))


def _micro_columns() -> list[Column]:
    return [
        safe_ratio("intersect", "union", None).alias("micro_accuracy"),
        safe_ratio("intersect", "predicted", None).alias("micro_precision"),
        safe_ratio("intersect", "actual", None).alias("micro_recall"),
    ]


def micro_scores(pred: DataFrame) -> DataFrame:
    """f06-f09: ratios of global sums (no epsilon; 0/0 -> null) and micro F1."""
    m = with_yhat(pred).agg(*_sums()).select(*_micro_columns())
    return m.withColumn("micro_f1", _f1(F.col("micro_precision"), F.col("micro_recall")))


def instance_scores(pred: DataFrame) -> DataFrame:
    """f10-f12: mean per-instance precision and recall (0/0 -> 0) and their F1.

    The F1 has no guard in the original (0/0 gives NaN); here it is null.
    """
    per = instance_counts(pred)
    m = per.agg(
        F.avg(safe_ratio("intersect", "predicted", 0.0)).alias("inst_precision"),
        F.avg(safe_ratio("intersect", "actual", 0.0)).alias("inst_recall"),
    )
    p, r = F.col("inst_precision"), F.col("inst_recall")
    return m.withColumn("inst_f1", F.try_divide(F.lit(2.0) * p * r, p + r))


def top_k(pred: DataFrame, k: int) -> DataFrame:
    """g07: the k highest-scored labels per instance (score desc, label desc)."""
    w = Window.partitionBy("instance").orderBy(F.col("score").desc(), F.col("label").desc())
    return pred.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def precision_at_k(pred: DataFrame, ks: Sequence[int] = TOP_KS) -> DataFrame:
    """f13: mean over instances of (true labels among the top k) / min(k, labels).

    One ranked pass serves every k: the ``row_number <= max(k)`` filter is
    planned as a per-partition group limit before the window's sort completes.
    """
    ranked = top_k(pred, max(ks))
    per = ranked.groupBy("instance").agg(
        *[
            (F.sum(F.when(F.col("rank") <= k, F.col("y")).otherwise(0)) / F.sum(F.when(F.col("rank") <= k, 1).otherwise(0)))
            .alias(f"p_at_{k}")
            for k in ks
        ]
    )
    return per.agg(*[F.avg(f"p_at_{k}").alias(f"p_at_{k}") for k in ks])


def _cell_loss(logit: str) -> Column:
    x, y = F.col(logit), F.col("y").cast("double")
    return F.greatest(x, F.lit(0.0)) - x * y + F.log1p(F.exp(-F.abs(x)))


def bce_with_logits(pred: DataFrame, logit: str = "logit") -> DataFrame:
    """e09: mean binary cross-entropy with logits over all cells (numerically stable form)."""
    return pred.agg(F.avg(_cell_loss(logit)).alias("loss"))


def weighted_mean(df: DataFrame, value: str, weight: str, by: Sequence[str] = ()) -> DataFrame:
    """e08: running-mean meter result: sum(value * n) / sum(n)."""
    agg = (F.sum(F.col(value) * F.col(weight)) / F.sum(weight)).alias("weighted_mean")
    return df.groupBy(*by).agg(agg, F.sum(weight).alias("weight"))


def confusion_matrix(pairs: DataFrame, true_col: str = "y_true", pred_col: str = "y_pred") -> DataFrame:
    """e11: counts per (true, predicted) class pair."""
    return pairs.groupBy(F.col(true_col).alias("y_true"), F.col(pred_col).alias("y_pred")).agg(
        F.count(F.lit(1)).alias("n")
    )


def normalized_confusion(matrix: DataFrame) -> DataFrame:
    """e12: each row (true class) divided by its total; the window is per true class."""
    w = Window.partitionBy("y_true")
    return matrix.withColumn("share", F.col("n") / F.sum("n").over(w))


def evaluation_report(pred: DataFrame, with_top_k: bool = True, logit: str | None = "logit") -> DataFrame:
    """f20: one-row report: loss, macro and micro scores, macro/micro AUC, P@5/8/15.

    Three passes over the predictions: sums by label give the loss and the
    macro and micro scores, counts by (label, score) give both AUCs (the micro
    curve pools them), and the ranking gives precision at k.  The one-row
    results are combined with one-row cross joins.
    """
    from icdspark.operators import roc

    has_loss = bool(logit) and logit in pred.columns
    cells = with_yhat(pred)
    loss = [F.sum(_cell_loss(logit)).alias("loss_sum")] if has_loss else []
    sums = ["intersect", "union", "predicted", "actual", "cells"] + ["loss_sum"] * has_loss
    per_label = cells.groupBy("label").agg(*_sums(), *loss)
    pooled = per_label.agg(*_macro_columns(), *[F.sum(c).alias(c) for c in sums])
    scores = pooled.select(
        *([(F.col("loss_sum") / F.col("cells")).alias("loss")] if has_loss else []),
        "macro_accuracy", "macro_precision", "macro_recall",
        _f1(F.col("macro_precision"), F.col("macro_recall")).alias("macro_f1"), *_micro_columns(),
    ).withColumn("micro_f1", _f1(F.col("micro_precision"), F.col("micro_recall")))
    counts = roc.score_counts(pred)
    out = scores.crossJoin(roc.macro_auc_of(roc.cumulative(counts))).crossJoin(
        roc.micro_auc_of(roc.cumulative(roc.micro_counts(counts), per_label=False)))
    return out.crossJoin(precision_at_k(pred, TOP_KS)) if with_top_k else out
