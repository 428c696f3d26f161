"""Metric values on the prediction proxy; AUC and ROC against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from icdspark.operators import metrics as me
from icdspark.operators import roc
from icdspark.sources.proxy import ProxyTables

SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="module", params=["pred", "pred_tied"])
def pred(spark, request):
    return getattr(ProxyTables(spark, SF01), request.param)().cache()


@pytest.fixture(scope="module")
def dense(pred):
    pdf = pred.toPandas()
    n, L = pdf.instance.max() + 1, pdf.label.max() + 1
    score = np.zeros((n, L))
    y = np.zeros((n, L))
    score[pdf.instance, pdf.label] = pdf.score
    y[pdf.instance, pdf.label] = pdf.y
    return score, y


def test_scores_equal_the_dense_form(pred, dense):
    score, y = dense
    hat = (score > 0.5).astype(float)
    both, either = hat * y, np.maximum(hat, y)
    ma = me.macro_scores(pred).first()
    assert abs(ma.macro_accuracy - np.mean(both.sum(0) / (either.sum(0) + 1e-10))) < 1e-12
    assert abs(ma.macro_precision - np.mean(both.sum(0) / (hat.sum(0) + 1e-10))) < 1e-12
    assert abs(ma.macro_recall - np.mean(both.sum(0) / (y.sum(0) + 1e-10))) < 1e-12
    assert abs(me.micro_scores(pred).first().micro_accuracy - both.sum() / either.sum()) < 1e-12
    share = lambda a, b: np.mean(np.divide(a, b, out=np.zeros_like(a), where=b > 0))
    inst = me.instance_scores(pred).first()
    assert abs(inst.inst_precision - share(both.sum(1), hat.sum(1))) < 1e-12
    assert abs(inst.inst_recall - share(both.sum(1), y.sum(1))) < 1e-12
    report = me.evaluation_report(pred).first()
    assert abs(report.macro_accuracy - ma.macro_accuracy) < 1e-12
    assert abs(report.auc_micro - roc.micro_auc(pred).first().auc_micro) < 1e-12


def test_auc_equals_pairwise(pred, dense):
    score, y = dense
    got = {r.label: r.auc for r in roc.label_auc(pred).collect()}
    for j in range(y.shape[1]):
        pos, neg = score[y[:, j] == 1, j], score[y[:, j] == 0, j]
        cmp = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
        assert abs(got[j] - cmp / (len(pos) * len(neg))) < 1e-12
    assert all(0.0 <= v <= 1.0 for v in got.values())


def test_micro_auc_equals_pairwise(pred, dense):
    score, y = dense
    s, t = score.ravel(), y.ravel()
    pos, neg = np.sort(s[t == 1]), np.sort(s[t == 0])
    below = np.searchsorted(neg, pos, side="left")
    ties = np.searchsorted(neg, pos, side="right") - below
    want = (below + 0.5 * ties).sum() / (len(pos) * len(neg))
    assert abs(roc.micro_auc(pred).first().auc_micro - want) < 1e-12


def test_macro_roc_area_equals_interpolated_mean(pred, dense):
    score, y = dense
    fprs, tprs = [], []
    for j in range(y.shape[1]):
        order = np.argsort(-score[:, j], kind="stable")
        s, t = score[order, j], y[order, j]
        last = np.r_[np.nonzero(np.diff(s))[0], len(s) - 1]
        tp = np.r_[0, np.cumsum(t)[last]]
        fp = np.r_[0, (last + 1) - np.cumsum(t)[last]]
        fprs.append(fp / fp[-1])
        tprs.append(tp / tp[-1])
    grid = np.unique(np.concatenate(fprs))
    mean = sum(np.interp(grid, f, t) for f, t in zip(fprs, tprs)) / len(fprs)
    want = float(np.sum((grid[1:] - grid[:-1]) * (mean[1:] + mean[:-1]) / 2))
    got = roc.macro_roc_area(pred).first()[0]
    assert abs(got - want) < 1e-12


def test_precision_at_k_matches_numpy(pred, dense):
    score, y = dense
    lab = np.arange(score.shape[1])
    vals = {}
    for k in (5, 8, 15):
        per = []
        for i in range(score.shape[0]):
            order = sorted(lab, key=lambda j: (-score[i, j], -j))[:k]
            per.append(y[i, order].sum() / len(order))
        vals[k] = np.mean(per)
    got = me.precision_at_k(pred).first()
    for k in (5, 8, 15):
        assert abs(got[f"p_at_{k}"] - vals[k]) < 1e-12


def test_binarize_half_is_zero(spark):
    from icdspark.functions.maths import binarize

    df = spark.createDataFrame([(0.5,), (0.5000001,), (0.4999,)], "s double")
    assert [r[0] for r in df.select(binarize("s")).collect()] == [0, 1, 0]


def test_bce_matches_numpy(pred):
    pdf = pred.toPandas()
    x, t = pdf.logit.values, pdf.y.values
    want = np.mean(np.maximum(x, 0) - x * t + np.log1p(np.exp(-np.abs(x))))
    assert abs(me.bce_with_logits(pred).first().loss - want) < 1e-9


def test_report_row(pred):
    row = me.evaluation_report(pred).first().asDict()
    for key in ("loss", "macro_f1", "micro_f1", "auc_macro", "auc_micro", "p_at_15"):
        assert row[key] is not None


def _mean_curve(score, y):
    """Every label's curve interpolated at every value of the joint grid."""
    fprs, tprs = [], []
    for j in range(y.shape[1]):
        order = np.argsort(-score[:, j], kind="stable")
        s, t = score[order, j], y[order, j]
        last = np.r_[np.nonzero(np.diff(s))[0], len(s) - 1]
        tp, fp = np.r_[0, np.cumsum(t)[last]], np.r_[0, (last + 1) - np.cumsum(t)[last]]
        fprs.append(fp / fp[-1])
        tprs.append(tp / tp[-1])
    grid = np.unique(np.concatenate(fprs))
    return grid, sum(np.interp(grid, f, t) for f, t in zip(fprs, tprs, strict=True)) / len(fprs)


def test_macro_roc_curve_equals_interpolated_mean(pred, dense):
    grid, mean = _mean_curve(*dense)
    got = sorted((r.fpr, r.tpr) for r in roc.macro_roc_curve(pred).collect())
    assert [g for g, _ in got] == grid.tolist()
    assert np.abs(np.array([t for _, t in got]) - mean).max() < 1e-12
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(got, got[1:], strict=False))
    assert abs(roc.macro_roc_area(pred).first()[0] - area) < 1e-12


def test_macro_roc_curve_without_a_class_is_null(spark):
    rows = [(0, 0, 0.2, 1), (1, 0, 0.4, 0), (0, 1, 0.3, 0), (1, 1, 0.6, 0)]
    df = spark.createDataFrame(rows, "instance long, label long, score double, y int")
    curve = roc.macro_roc_curve(df).collect()
    assert curve and all(r.tpr is None for r in curve)
    kept = df.filter("label = 0")
    assert sorted(map(tuple, roc.macro_roc_curve(kept).collect())) == [(0.0, 0.0), (1.0, 1.0)]


def test_curves_of_close_scores(spark):
    """All logits within 0.01 of each other: the same areas, and no bucket with much more than its share."""
    from icdspark.operators import running as ru

    rng = np.random.RandomState(2)
    logit = 3.0 + 0.01 * rng.rand(20_000)
    y = (rng.rand(20_000) < 0.3).astype(int)
    rows = [(i, i % 5, float(1 / (1 + np.exp(-x))), int(t)) for i, (x, t) in enumerate(zip(logit, y, strict=True))]
    df = spark.createDataFrame(rows, "instance long, label long, score double, y int")
    counts = roc.micro_counts(roc.score_counts(df))
    for slices in (1, ru.SLICES):
        sizes = [r["count"] for r in ru.depth_bucket("score", slices=slices)(counts).groupBy(
            F.floor(F.col(ru.BUCKET) / slices)).count().collect()]
        assert len(sizes) == ru.DEPTHS and max(sizes) <= 2 * sum(sizes) / ru.DEPTHS
    s = np.array([r[2] for r in rows])
    pos, neg = np.sort(s[y == 1]), np.sort(s[y == 0])
    want = np.searchsorted(neg, pos).sum() / (len(pos) * len(neg))
    assert abs(roc.micro_auc(df).first().auc_micro - want) < 1e-12


def test_train_report_is_the_report_without_top_k(pred):
    whole, train = me.evaluation_report(pred).first().asDict(), me.evaluation_report(pred, with_top_k=False).first().asDict()
    assert set(whole) - set(train) == {"p_at_5", "p_at_8", "p_at_15"}
    assert all(abs(train[k] - whole[k]) < 1e-12 for k in train)
