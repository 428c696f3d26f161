"""ROC curves and AUC from the long prediction table, without pairwise joins.

Scores are first aggregated to one row per distinct (label, score) with the
number of positives and negatives at that score; curve points and areas come
from running sums over the ascending scores (``running_sum`` with equal-depth
buckets, so neither a label nor the micro curve is pulled into one task, however
close its scores lie together).

AUC uses the rank form  sum_s pos_s * (neg_below(s) + neg_s / 2) / (P * N),
which equals the trapezoid area under the curve through every threshold.
A label needs P > 0 and N > 0 to have an AUC (b09).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icdspark.operators.running import SLICES, depth_bucket, previous_value, running_sum

#: Buckets of the false positive rate.  Its distinct values are counts over a label's negatives, so they
#: lie as evenly as these do, however the scores lie.
FPR_BUCKETS = 1 << 16


def score_counts(pred: DataFrame) -> DataFrame:
    """Positives and negatives at each distinct (label, score)."""
    return pred.groupBy("label", "score").agg(
        F.sum("y").cast("long").alias("pos"), F.sum(F.lit(1) - F.col("y")).cast("long").alias("neg"))


def micro_counts(counts: DataFrame) -> DataFrame:
    """``score_counts`` of all labels pooled; ``counts`` may be summed up by label already."""
    return counts.groupBy("score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def cumulative(counts: DataFrame, per_label: bool = True) -> DataFrame:
    """Add pos_below / neg_below (strictly lower scores) and the totals P, N."""
    bucket = depth_bucket("score", slices=1 if per_label else SLICES)
    return running_sum(
        counts, ["score"], {"pos_below": "pos", "neg_below": "neg"}, bucket,
        partition_cols=["label"] if per_label else [], exclusive=True, totals={"pos_below": "P", "neg_below": "N"})


def eligible_labels(pred: DataFrame) -> DataFrame:
    """b09: labels with at least one positive and one negative (AUC defined)."""
    t = pred.groupBy("label").agg(F.sum("y").alias("P"), F.sum(F.lit(1) - F.col("y")).alias("N"))
    return t.filter((F.col("P") > 0) & (F.col("N") > 0)).select("label", "P", "N")


def _curve(pred: DataFrame, per_label: bool) -> DataFrame:
    counts = score_counts(pred)
    return cumulative(counts if per_label else micro_counts(counts), per_label)


def roc_points(pred: DataFrame, per_label: bool = True) -> DataFrame:
    """f14 / f18: one point per distinct score: threshold, fpr, tpr (score >= threshold).

    The (0, 0) start point is implicit.  Labels without positives (or without
    negatives) get null tpr (fpr).
    """
    tp = F.col("P") - F.col("pos_below")
    fp = F.col("N") - F.col("neg_below")
    return _curve(pred, per_label).select(
        *(["label"] if per_label else []),
        F.col("score").alias("threshold"),
        F.try_divide(fp.cast("double"), F.col("N").cast("double")).alias("fpr"),
        F.try_divide(tp.cast("double"), F.col("P").cast("double")).alias("tpr"),
    )


def _area() -> Column:
    """A row's share of its curve's area; null without positives or negatives."""
    pairs = F.col("P").cast("double") * F.col("N")
    return F.when(pairs > 0, F.col("pos") * (F.col("neg_below") + F.col("neg") / F.lit(2.0)) / pairs)


def label_auc(pred: DataFrame) -> DataFrame:
    """f15: AUC per eligible label."""
    return _curve(pred, True).groupBy("label").agg(F.sum(_area()).alias("auc")).filter(F.col("auc").isNotNull())


def macro_auc_of(cum: DataFrame) -> DataFrame:
    """f16 from cumulative counts: the label's rows are summed up in one step.

    A label's lowest score is the one row with nothing below, so such rows
    count the labels.
    """
    first = (F.col("pos_below") + F.col("neg_below") == 0) & (F.col("P") > 0) & (F.col("N") > 0)
    labels = F.sum(F.when(first, 1))
    return cum.agg((F.sum(_area()) / labels).alias("auc_macro"))


def macro_auc(pred: DataFrame) -> DataFrame:
    """f16: mean of the per-label AUCs (eligible labels only)."""
    return macro_auc_of(_curve(pred, True))


def micro_auc_of(cum: DataFrame) -> DataFrame:
    return cum.agg(F.sum(_area()).alias("auc_micro"))


def micro_auc(pred: DataFrame) -> DataFrame:
    """f17: AUC of all cells pooled into one curve."""
    return micro_auc_of(_curve(pred, False))


def _fpr() -> Column:
    return F.try_divide((F.col("N") - F.col("neg_below")).cast("double"), F.col("N").cast("double"))


def fpr_grid(pred: DataFrame) -> DataFrame:
    """h04: the union of every label's FPR values (plus 0), distinct."""
    zero = pred.sparkSession.range(1).select(F.lit(0.0).alias("fpr"))
    return _curve(pred, True).select(_fpr().alias("fpr")).unionByName(zero).distinct()


def macro_roc_curve(pred: DataFrame) -> DataFrame:
    """f19: the macro-average ROC curve: ``fpr, tpr`` at every value of ``fpr_grid``, tpr the labels' mean.

    An event sweep instead of labels x grid points.  A score's row is a stretch
    of its label's polyline, from the point before it to its own.  With
    negatives it adds its slope and intercept where it begins and takes them
    back, leaving its rise, where it ends; without negatives it is a jump.  The
    changes are summed up by FPR and once along the grid: at g, the labels' sum
    is slope * g + intercept.  Null when a label has no positive or no negative.
    """
    cum = _curve(pred, True)
    start = F.try_divide((F.col("N") - F.col("neg_below") - F.col("neg")).cast("double"), F.col("N").cast("double"))
    rise = F.coalesce(F.try_divide(F.col("pos").cast("double"), F.col("P").cast("double")), F.lit(0.0))
    slope = F.coalesce(F.try_divide(rise * F.col("N"), F.col("neg").cast("double")), F.lit(0.0))
    # a label's lowest score is the one row with nothing below
    lowest = F.when(F.col("pos_below") + F.col("neg_below") == 0, 1).otherwise(0)
    event = lambda at, up, level, n: F.struct(
        at.alias("fpr"), up.alias("slope"), level.alias("level"), n.alias("labels"), F.least("P", "N").alias("class"))
    begins = event(start, slope, -slope * start, F.lit(0))
    ends = event(_fpr(), -slope, slope * start + rise, lowest)
    zero = pred.sparkSession.range(1).select(
        F.lit(0.0).alias("fpr"), F.lit(0.0).alias("slope"), F.lit(0.0).alias("level"), F.lit(0).alias("labels"),
        F.lit(None).cast("bigint").alias("class"))
    events = cum.select(F.inline(F.when(F.col("neg") > 0, F.array(begins, ends)).otherwise(F.array(ends)))).unionByName(zero)
    grid = events.groupBy("fpr").agg(
        F.sum("slope").alias("slope"), F.sum("level").alias("level"), F.sum("labels").alias("labels"), F.min("class").alias("class"))
    shape = grid.agg(F.struct(F.sum("labels").alias("labels"), F.min("class").alias("class")).alias("shape")).scalar()
    swept = running_sum(grid, ["fpr"], {"slope_": "slope", "level_": "level"}, F.floor(F.col("fpr") * FPR_BUCKETS))
    mean = (F.col("slope_") * F.col("fpr") + F.col("level_")) / shape["labels"]
    return swept.select("fpr", F.when(shape["class"] > 0, mean).alias("tpr"))


def macro_roc_area(pred: DataFrame) -> DataFrame:
    """f19: area under the macro-average ROC curve (mean of the labels' TPRs
    interpolated on the union of all FPR values, then trapezoids).

    Computed without evaluating every label on every grid point.  On the grid,
    label l's interpolated curve is its own ROC polyline except that at each of
    its FPR values it takes the *top* of the vertical run there; trapezoids on
    the grid therefore give  AUC_l + sum_a V_l(a) * (a - prev(a)) / 2, where
    V_l(a) is the TPR gained at FPR a by scores with no negatives and prev(a)
    is the next lower grid value.  The labels' V are summed up with the grid
    itself, so one pass over its distinct values is enough.  Null when a label
    has no positive or no negative (the original fails there).
    """
    cum = _curve(pred, True)
    rise = F.when(F.col("neg") == 0, F.try_divide(F.col("pos").cast("double"), F.col("P").cast("double"))).otherwise(0.0)
    points = cum.select(
        _fpr().alias("fpr"), rise.alias("rise"), _area().alias("area"),
        # a label's lowest score is the one row with nothing below
        F.when(F.col("pos_below") + F.col("neg_below") == 0, 1).otherwise(0).alias("labels"),
        F.least("P", "N").alias("class"))
    zero = pred.sparkSession.range(1).select(
        F.lit(0.0).alias("fpr"), F.lit(0.0).alias("rise"), F.lit(0.0).alias("area"), F.lit(0).alias("labels"),
        F.lit(None).cast("long").alias("class"))
    grid = points.unionByName(zero).groupBy("fpr").agg(
        F.sum("rise").alias("rise"), F.sum("area").alias("area"), F.sum("labels").alias("labels"),
        F.min("class").alias("class"))
    steps = previous_value(grid, "fpr", F.floor(F.col("fpr") * FPR_BUCKETS), "prev")
    extra = F.coalesce(F.sum(F.col("rise") * (F.col("fpr") - F.col("prev")) / 2.0), F.lit(0.0))
    area = (F.sum("area") + extra) / F.sum("labels")
    return steps.agg(F.when(F.min("class") > 0, area).alias("auc_macro_curve"))


__all__ = [
    "eligible_labels", "roc_points", "label_auc", "macro_auc", "micro_auc", "score_counts", "micro_counts",
    "cumulative", "fpr_grid", "macro_roc_curve", "macro_roc_area",
]
