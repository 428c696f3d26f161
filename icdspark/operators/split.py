"""Patient-disjoint train/validation/test split by running admission totals.

Patients are taken in ``subject_id`` order.  With S = admissions of all earlier
patients (exclusive running sum), N = all admissions and T = admissions of
train patients: a patient is *train* while S/N <= p_train, else *val* while
(S - T)/N <= p_val, else *test*.  Both tests are made before the patient is
added, so train and val may overshoot their share; the test share is what is
left.  The running sum is the bucketed ``running_sum`` (no global window).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from icdspark.functions.text import text_length
from icdspark.operators.running import ID_WIDTH, grouped_row_number, range_bucket, running_sum

# Split shares and split names.
TRAIN_SHARE = 0.8
VAL_SHARE = 0.1
TEST_SHARE = 0.1
SPLITS = ("train", "val", "test")


def assign_splits(
    admissions: DataFrame, p_train: float = TRAIN_SHARE, p_val: float = VAL_SHARE, bucket_width: int = ID_WIDTH
) -> DataFrame:
    """g01: one row per patient: subject_id, n_admissions, split.

    ``admissions`` has one row per admission; only its ``subject_id`` is read.
    Running sums are taken in ranges of ``bucket_width`` patient ids, so a
    bucket has at most that many patients and their number follows the ids.
    """
    per_patient = admissions.groupBy("subject_id").agg(F.count(F.lit(1)).alias("n_admissions"))
    total = per_patient.agg(F.sum("n_admissions").cast("double").alias("__total"))
    ranked = running_sum(
        per_patient, ["subject_id"], {"__before": "n_admissions"}, range_bucket("subject_id", bucket_width), exclusive=True)
    # one-row frames: the total and the train total T (both 1 x 1)
    ranked = ranked.crossJoin(total)
    is_train = F.col("__before") / F.col("__total") <= F.lit(p_train)
    train_total = ranked.filter(is_train).agg(F.coalesce(F.sum("n_admissions"), F.lit(0)).alias("__train"))
    out = ranked.crossJoin(train_total).withColumn(
        "split",
        F.when(is_train, F.lit(SPLITS[0]))
        .when((F.col("__before") - F.col("__train")) / F.col("__total") <= F.lit(p_val), F.lit(SPLITS[1]))
        .otherwise(F.lit(SPLITS[2])),
    )
    return out.select("subject_id", "n_admissions", "split")


def admission_splits(keys: DataFrame, assignment: DataFrame) -> DataFrame:
    """The patients' splits expanded to admissions: subject_id, hadm_id, split; only key columns move."""
    return keys.select("subject_id", "hadm_id").join(assignment.select("subject_id", "split"), "subject_id").select(
        "subject_id", "hadm_id", "split")


def split_admissions(labelled: DataFrame, assignment: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """d04: attach each admission's split via its patient.

    The patient -> split assignment is first expanded to admission keys, then
    joined on (subject_id, hadm_id): the labelled side is already partitioned on
    those keys by its grouping, so the texts are not shuffled again whatever the
    size of the assignment.  ``keys`` may give the admissions' ids more cheaply
    than ``labelled`` does.
    """
    return labelled.join(admission_splits(labelled if keys is None else keys, assignment), ["subject_id", "hadm_id"])


def order_within_split(split_df: DataFrame) -> DataFrame:
    """g02: ``length`` (tokens, c09) and ``pos`` = 1-based rank by (length, hadm_id, subject_id) per split.

    The rank is that of the key within its length plus the number of shorter
    rows; only keys and lengths are ranked, and joined back once.
    """
    with_len = split_df.withColumn("length", text_length("text"))
    ranked = grouped_row_number(
        with_len.select("subject_id", "hadm_id", "split", "length"), F.col("length"), ["hadm_id", "subject_id"],
        range_bucket("hadm_id"), "pos", ["split"])
    return with_len.join(ranked.select("subject_id", "hadm_id", "pos"), ["subject_id", "hadm_id"])


def split_sizes(assignment: DataFrame) -> DataFrame:
    """Admissions and patients per split (sanity report)."""
    return assignment.groupBy("split").agg(
        F.sum("n_admissions").alias("n_admissions"), F.count(F.lit(1)).alias("n_patients")
    )
