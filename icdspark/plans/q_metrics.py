"""Registered queries: multilabel metrics, ROC/AUC, loss, meters, confusion matrices."""

from __future__ import annotations

from pyspark.sql import functions as F

from icdspark.functions.maths import binarize, safe_ratio, sigmoid
from icdspark.operators import metrics as me
from icdspark.operators import roc
from icdspark.plans.registry import register
from icdspark.plans.sql import r9, tied, with_ctes
from icdspark.sources.proxy import ProxyTables


def _pred(spark, sf):
    return ProxyTables(spark, sf).pred()


def _round(df, *keep):
    """Round every double column to 9 decimals (summation order moves the last digits)."""
    return df.select(
        *[
            F.round(F.col(c), 9).alias(c) if t == "double" and c not in keep else F.col(c)
            for c, t in df.dtypes
        ]
    )


# ------------------------------------------------------------- scalar helpers


@register(
    "c16_sigmoid",
    with_ctes(f"SELECT instance, label, {r9('1.0 / (1.0 + exp(-logit))')} AS prob FROM pred", "pred"),
)
def c16(spark, sf):
    return _round(_pred(spark, sf).select("instance", "label", sigmoid("logit").alias("prob")))


@register(
    "c17_binarize",
    with_ctes("SELECT instance, label, CASE WHEN score > 0.5 THEN 1 ELSE 0 END AS yhat FROM pred", "pred"),
)
def c17(spark, sf):
    return _pred(spark, sf).select("instance", "label", binarize("score").alias("yhat"))


@register(
    "c20_safe_ratio",
    with_ctes(f"SELECT instance, {r9('coalesce(i / nullif(h, 0), 0.0)')} AS precision FROM per_instance", "per_instance"),
)
def c20(spark, sf):
    per = me.instance_counts(_pred(spark, sf))
    return _round(per.select("instance", safe_ratio("intersect", "predicted", 0.0).alias("precision")))


# ------------------------------------------------------------------ metrics


@register(
    "f01_set_sizes_label",
    with_ctes("SELECT label, u AS \"union\", i AS intersect FROM per_label", "per_label"),
)
def f01_label(spark, sf):
    return me.set_sizes(_pred(spark, sf), "label")


@register(
    "f01_set_sizes_instance",
    with_ctes("SELECT instance, u AS \"union\", i AS intersect FROM per_instance", "per_instance"),
)
def f01_instance(spark, sf):
    return me.set_sizes(_pred(spark, sf), "instance")


_MACRO_SQL = with_ctes(
    f"""SELECT {r9('ma')} AS macro_accuracy, {r9('mp')} AS macro_precision, {r9('mr')} AS macro_recall,
       {r9('CASE WHEN mp + mr = 0 THEN 0.0 ELSE 2 * mp * mr / (mp + mr) END')} AS macro_f1
FROM (SELECT avg(i / (u + 1e-10)) AS ma, avg(i / (h + 1e-10)) AS mp, avg(i / (t + 1e-10)) AS mr FROM per_label)""",
    "per_label",
)


@register("f02_f05_macro", _MACRO_SQL)
def f02_f05(spark, sf):
    return _round(me.macro_scores(_pred(spark, sf)))


_MICRO_SQL = with_ctes(
    f"""SELECT {r9('a')} AS micro_accuracy, {r9('p')} AS micro_precision, {r9('r')} AS micro_recall,
       {r9('CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END')} AS micro_f1
FROM (SELECT sum(i) / nullif(sum(u), 0) AS a, sum(i) / nullif(sum(h), 0) AS p, sum(i) / nullif(sum(t), 0) AS r
      FROM per_label)""",
    "per_label",
)


@register("f06_f09_micro", _MICRO_SQL)
def f06_f09(spark, sf):
    return _round(me.micro_scores(_pred(spark, sf)))


_INST_SQL = with_ctes(
    f"""SELECT {r9('p')} AS inst_precision, {r9('r')} AS inst_recall, {r9('2 * p * r / nullif(p + r, 0)')} AS inst_f1
FROM (SELECT avg(coalesce(i / nullif(h, 0), 0.0)) AS p, avg(coalesce(i / nullif(t, 0), 0.0)) AS r FROM per_instance)""",
    "per_instance",
)


@register("f10_f12_instance", _INST_SQL)
def f10_f12(spark, sf):
    return _round(me.instance_scores(_pred(spark, sf)))


_PAK_SQL = with_ctes(
    f"""SELECT {r9('avg(p5)')} AS p_at_5, {r9('avg(p8)')} AS p_at_8, {r9('avg(p15)')} AS p_at_15 FROM (
  SELECT instance,
         sum(CASE WHEN rk <= 5 THEN y ELSE 0 END) / sum(CASE WHEN rk <= 5 THEN 1 ELSE 0 END) AS p5,
         sum(CASE WHEN rk <= 8 THEN y ELSE 0 END) / sum(CASE WHEN rk <= 8 THEN 1 ELSE 0 END) AS p8,
         sum(CASE WHEN rk <= 15 THEN y ELSE 0 END) / sum(CASE WHEN rk <= 15 THEN 1 ELSE 0 END) AS p15
  FROM (SELECT instance, y, row_number() OVER (PARTITION BY instance ORDER BY score DESC, label DESC) AS rk FROM pred)
  GROUP BY instance)""",
    "pred",
)


@register("f13_precision_at_k", _PAK_SQL)
def f13(spark, sf):
    return _round(me.precision_at_k(_pred(spark, sf), (5, 8, 15)))


_TOP_SQL = with_ctes(
        """SELECT instance, label, rk AS rank FROM (
  SELECT instance, label, row_number() OVER (PARTITION BY instance ORDER BY score DESC, label DESC) AS rk FROM pred)
WHERE rk <= 5""",
        "pred",
    )


@register("g07_top_k_labels", _TOP_SQL)
def g07(spark, sf):
    return me.top_k(_pred(spark, sf), 5).select("instance", "label", F.col("rank").cast("bigint").alias("rank"))


@register(
    "b09_auc_eligible_labels",
    with_ctes(
        "SELECT label, CAST(sum(y) AS BIGINT) AS P, CAST(sum(1 - y) AS BIGINT) AS N FROM pred GROUP BY label HAVING sum(y) > 0 AND sum(1 - y) > 0",
        "pred",
    ),
)
def b09(spark, sf):
    out = roc.eligible_labels(_pred(spark, sf))
    return out.select("label", out["P"].cast("bigint").alias("P"), out["N"].cast("bigint").alias("N"))


# ---------------------------------------------------------------- ROC / AUC


_ROC_SQL = with_ctes(
        f"""SELECT label, {r9('score')} AS threshold, {r9('CAST(n - neg_below AS DOUBLE) / nullif(n, 0)')} AS fpr,
       {r9('CAST(p - pos_below AS DOUBLE) / nullif(p, 0)')} AS tpr FROM score_cum""",
        "score_cum",
    )


@register("f14_roc_curve", _ROC_SQL)
def f14(spark, sf):
    return _round(roc.roc_points(_pred(spark, sf), per_label=True))


_AUC_SQL = with_ctes(f"SELECT label, {r9('auc')} AS auc FROM label_auc", "label_auc")


@register("f15_label_auc", _AUC_SQL)
def f15(spark, sf):
    return _round(roc.label_auc(_pred(spark, sf)))


@register("f16_macro_auc", with_ctes(f"SELECT {r9('avg(auc)')} AS auc_macro FROM label_auc", "label_auc"))
def f16(spark, sf):
    return _round(roc.macro_auc(_pred(spark, sf)))


_MICRO_AUC_SQL = with_ctes(
        f"SELECT {r9('sum(pos * (neg_below + neg / 2.0)) / (CAST(max(p) AS DOUBLE) * max(n))')} AS auc_micro FROM micro_cum",
        "micro_cum",
    )


@register("f17_micro_auc", _MICRO_AUC_SQL)
def f17(spark, sf):
    return _round(roc.micro_auc(_pred(spark, sf)))


_MICRO_ROC_SQL = with_ctes(
        f"""SELECT {r9('score')} AS threshold, {r9('CAST(n - neg_below AS DOUBLE) / nullif(n, 0)')} AS fpr,
       {r9('CAST(p - pos_below AS DOUBLE) / nullif(p, 0)')} AS tpr FROM micro_cum""",
        "micro_cum",
    )


@register("f18_micro_roc_curve", _MICRO_ROC_SQL)
def f18(spark, sf):
    return _round(roc.roc_points(_pred(spark, sf), per_label=False))


# ------------------------------------------------------- loss, meters, confusion


@register(
    "e09_bce_loss",
    with_ctes(
        f"SELECT {r9('avg(greatest(logit, 0.0) - logit * y + ln(1 + exp(-abs(logit))))')} AS loss FROM pred",
        "pred",
    ),
)
def e09(spark, sf):
    return _round(me.bce_with_logits(_pred(spark, sf)))


@register(
    "e08_weighted_mean",
    f"""SELECT l_returnflag, {r9('sum(l_extendedprice * l_quantity) / sum(l_quantity)')} AS weighted_mean,
       {r9('sum(l_quantity)')} AS weight FROM lineitem GROUP BY l_returnflag""",
)
def e08(spark, sf):
    li = ProxyTables(spark, sf).table("lineitem").select("l_returnflag", "l_extendedprice", "l_quantity")
    return _round(me.weighted_mean(li, "l_extendedprice", "l_quantity", ["l_returnflag"]))


@register(
    "e11_confusion_matrix",
    "SELECT quality AS y_true, toxic AS y_pred, count(*) AS n FROM labels GROUP BY quality, toxic",
)
def e11(spark, sf):
    return me.confusion_matrix(ProxyTables(spark, sf).class_pairs())


@register(
    "e12_confusion_normalized",
    f"""SELECT y_true, y_pred, n, {r9('n / sum(n) OVER (PARTITION BY y_true)')} AS share FROM (
  SELECT quality AS y_true, toxic AS y_pred, count(*) AS n FROM labels GROUP BY quality, toxic)""",
)
def e12(spark, sf):
    return _round(me.normalized_confusion(me.confusion_matrix(ProxyTables(spark, sf).class_pairs())))


_CURVE_CTES = {
    "pts": (
        """SELECT label, CAST(n - neg_below AS DOUBLE) / n AS fpr, CAST(p - pos_below AS DOUBLE) / p AS tpr FROM score_cum
UNION ALL SELECT DISTINCT label, 0.0, 0.0 FROM score_cum""",
        ("score_cum",),
    ),
    "tops": ("SELECT label, fpr, max(tpr) AS top, min(tpr) AS bot FROM pts GROUP BY label, fpr", ("pts",)),
    "grid": ("SELECT DISTINCT fpr AS g FROM pts", ("pts",)),
    "ev": (
        """SELECT l.label, grid.g,
       (SELECT max(fpr) FROM tops t WHERE t.label = l.label AND t.fpr <= grid.g) AS a,
       (SELECT min(fpr) FROM tops t WHERE t.label = l.label AND t.fpr > grid.g) AS b
FROM (SELECT DISTINCT label FROM pts) l, grid""",
        ("tops", "grid"),
    ),
    "interp": (
        """SELECT ev.label, ev.g,
       CASE WHEN ev.b IS NULL OR ev.a = ev.g THEN ta.top
        ELSE ta.top + (ev.g - ev.a) * (tb.bot - ta.top) / (ev.b - ev.a) END AS v
FROM ev JOIN tops ta ON ta.label = ev.label AND ta.fpr = ev.a
LEFT JOIN tops tb ON tb.label = ev.label AND tb.fpr = ev.b""",
        ("ev",),
    ),
    "mean_tpr": ("SELECT g, avg(v) AS m FROM interp GROUP BY g", ("interp",)),
}

_F19_SQL = with_ctes(
    f"""SELECT {r9('sum((g - pg) * (m + pm) / 2)')} AS auc_macro_curve FROM (
  SELECT g, m, lag(g) OVER (ORDER BY g) AS pg, lag(m) OVER (ORDER BY g) AS pm FROM mean_tpr)""",
    "mean_tpr", extra=_CURVE_CTES)
_F19_CURVE_SQL = with_ctes(f"SELECT {r9('g')} AS fpr, {r9('m')} AS tpr FROM mean_tpr", "mean_tpr", extra=_CURVE_CTES)


@register("f19_macro_roc_area", _F19_SQL)
def f19(spark, sf):
    return _round(roc.macro_roc_area(_pred(spark, sf)))


@register("f19_macro_roc_curve", _F19_CURVE_SQL)
def f19_curve(spark, sf):
    return _round(roc.macro_roc_curve(_pred(spark, sf)))


def _report_sql(with_top_k: bool = True) -> str:
    body = f"""SELECT lo.loss, ma.*, mi.*, {r9('am.auc_macro')} AS auc_macro, {r9('ai.auc_micro')} AS auc_micro{', pk.*' if with_top_k else ''} FROM
  (SELECT {r9('avg(greatest(logit, 0.0) - logit * y + ln(1 + exp(-abs(logit))))')} AS loss FROM pred) lo,
  (SELECT {r9('ma')} AS macro_accuracy, {r9('mp')} AS macro_precision, {r9('mr')} AS macro_recall,
          {r9('CASE WHEN mp + mr = 0 THEN 0.0 ELSE 2 * mp * mr / (mp + mr) END')} AS macro_f1
   FROM (SELECT avg(i / (u + 1e-10)) AS ma, avg(i / (h + 1e-10)) AS mp, avg(i / (t + 1e-10)) AS mr FROM per_label)) ma,
  (SELECT {r9('a')} AS micro_accuracy, {r9('p')} AS micro_precision, {r9('r')} AS micro_recall,
          {r9('CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END')} AS micro_f1
   FROM (SELECT sum(i) / nullif(sum(u), 0) AS a, sum(i) / nullif(sum(h), 0) AS p, sum(i) / nullif(sum(t), 0) AS r
         FROM per_label)) mi,
  (SELECT avg(auc) AS auc_macro FROM label_auc) am,
  (SELECT sum(pos * (neg_below + neg / 2.0)) / (CAST(max(p) AS DOUBLE) * max(n)) AS auc_micro FROM micro_cum) ai"""
    if with_top_k:
        body += f""",
  (SELECT {r9('avg(p5)')} AS p_at_5, {r9('avg(p8)')} AS p_at_8, {r9('avg(p15)')} AS p_at_15 FROM (
     SELECT instance,
            sum(CASE WHEN rk <= 5 THEN y ELSE 0 END) / sum(CASE WHEN rk <= 5 THEN 1 ELSE 0 END) AS p5,
            sum(CASE WHEN rk <= 8 THEN y ELSE 0 END) / sum(CASE WHEN rk <= 8 THEN 1 ELSE 0 END) AS p8,
            sum(CASE WHEN rk <= 15 THEN y ELSE 0 END) / sum(CASE WHEN rk <= 15 THEN 1 ELSE 0 END) AS p15
     FROM (SELECT instance, y, row_number() OVER (PARTITION BY instance ORDER BY score DESC, label DESC) AS rk FROM pred)
     GROUP BY instance)) pk"""
    return with_ctes(body, "pred", "per_label", "label_auc", "micro_cum")


@register("f20_evaluation_report", _report_sql())
def f20(spark, sf):
    return _round(me.evaluation_report(_pred(spark, sf)))


@register("f20_train_report", _report_sql(with_top_k=False))
def f20_train(spark, sf):
    """The report of a training epoch: no precision at k."""
    return _round(me.evaluation_report(_pred(spark, sf), with_top_k=False))


# ------------------------------------------- the tie rules, on scores of which many are equal


def _tied(spark, sf):
    return ProxyTables(spark, sf).pred_tied()


@register("f13_precision_at_k_tied", tied(_PAK_SQL))
def f13_tied(spark, sf):
    return _round(me.precision_at_k(_tied(spark, sf), (5, 8, 15)))


@register("g07_top_k_labels_tied", tied(_TOP_SQL))
def g07_tied(spark, sf):
    return me.top_k(_tied(spark, sf), 5).select("instance", "label", F.col("rank").cast("bigint").alias("rank"))


@register("f14_roc_curve_tied", tied(_ROC_SQL))
def f14_tied(spark, sf):
    return _round(roc.roc_points(_tied(spark, sf), per_label=True))


@register("f15_label_auc_tied", tied(_AUC_SQL))
def f15_tied(spark, sf):
    return _round(roc.label_auc(_tied(spark, sf)))


@register("f17_micro_auc_tied", tied(_MICRO_AUC_SQL))
def f17_tied(spark, sf):
    return _round(roc.micro_auc(_tied(spark, sf)))


@register("f18_micro_roc_curve_tied", tied(_MICRO_ROC_SQL))
def f18_tied(spark, sf):
    return _round(roc.roc_points(_tied(spark, sf), per_label=False))


@register("f19_macro_roc_curve_tied", tied(_F19_CURVE_SQL))
def f19_curve_tied(spark, sf):
    return _round(roc.macro_roc_curve(_tied(spark, sf)))


@register("f20_evaluation_report_tied", tied(_report_sql()))
def f20_tied(spark, sf):
    return _round(me.evaluation_report(_tied(spark, sf)))
