"""Registered queries: patient-disjoint split and in-split ordering."""

from __future__ import annotations

from icdspark.operators import split as sp
from icdspark.plans.etl import proxy_etl
from icdspark.plans.prepare import prepared
from icdspark.plans.registry import register
from icdspark.plans.sql import with_ctes

_SPLIT_CTES = {
    "per_patient": ("SELECT subject_id, count(*) AS n_admissions FROM labelled GROUP BY subject_id", ("labelled",)),
    "total": ("SELECT CAST(count(*) AS DOUBLE) AS total FROM labelled", ("labelled",)),
    "ran": (
        """SELECT subject_id, n_admissions,
       coalesce(sum(n_admissions) OVER (ORDER BY subject_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
FROM per_patient""",
        ("per_patient",),
    ),
    "train_total": (
        "SELECT coalesce(sum(n_admissions), 0) AS train FROM ran, total WHERE before / total <= 0.8",
        ("ran", "total"),
    ),
    "assignment": (
        """SELECT subject_id, n_admissions,
       CASE WHEN before / total <= 0.8 THEN 'train' WHEN (before - train) / total <= 0.1 THEN 'val' ELSE 'test' END AS split
FROM ran, total, train_total""",
        ("ran", "total", "train_total"),
    ),
    "split_adm": (
        """SELECT l.subject_id, l.hadm_id, l.text, l.labels, a.split FROM labelled l JOIN assignment a
ON l.subject_id = a.subject_id""",
        ("labelled", "assignment"),
    ),
}


def split_sql(body: str, *names: str) -> str:
    return with_ctes(body, *names, extra=_SPLIT_CTES)


@register("g01_group_split", split_sql("SELECT subject_id, n_admissions, split FROM assignment", "assignment"))
def g01(spark, sf):
    return proxy_etl(spark, sf).assignment()


@register(
    "d04_split_membership",
    split_sql("SELECT subject_id, hadm_id, text, labels, split FROM split_adm", "split_adm"),
)
def d04(spark, sf):
    p = prepared(spark, sf)
    return p.etl.split(p.admission_splits).select("subject_id", "hadm_id", "text", "labels", "split")


@register(
    "g02_sort_by_length",
    split_sql(
        """SELECT split, subject_id, hadm_id, len(string_split(text, ' ')) AS length,
       row_number() OVER (PARTITION BY split ORDER BY len(string_split(text, ' ')), hadm_id, subject_id) AS pos FROM split_adm""",
        "split_adm",
    ),
)
def g02(spark, sf):
    ordered = sp.order_within_split(prepared(spark, sf).split_adm.drop("tlen"))
    return ordered.select("split", "subject_id", "hadm_id", ordered["length"].cast("bigint").alias("length"), "pos")


@register(
    "g01_split_sizes",
    split_sql(
        "SELECT split, CAST(sum(n_admissions) AS BIGINT) AS n_admissions, count(*) AS n_patients FROM assignment GROUP BY split",
        "assignment",
    ),
)
def g01_sizes(spark, sf):
    return sp.split_sizes(proxy_etl(spark, sf).assignment())
