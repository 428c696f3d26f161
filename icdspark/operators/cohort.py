"""Loading codes and notes, the admission cohort and labelled admissions.

Column conventions (lower-case, typed): ``subject_id``/``hadm_id``/``row_id``
bigint, ``seq_num`` string (as in the source files), ``icd9_code`` string.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from icdspark.functions.codes import dot_diagnosis, dot_procedure
from icdspark.functions.text import clean_note, tokenized_text
from icdspark.operators.grouping import ordered_concat

# The kept note category (exact, case-sensitive), code/text separators.
DISCHARGE_CATEGORY = "Discharge summary"
LABEL_SEP = ";"
TEXT_SEP = " "
SRC_DIAG = 0
SRC_PROC = 1


def _id(c: str, on_bad: str) -> Column:
    """Cast an id column to bigint.

    ``raise``: a null or non-integer id fails the job (whatever the session's
    ANSI setting); ``quarantine``: such rows get a null id and are left out
    (``split_rejects`` keeps them).
    """
    col = F.col(c)
    parsed = F.expr(f"try_cast(`{c}` as bigint)")
    if on_bad == "quarantine":
        return parsed
    return (
        F.when(col.isNull(), F.raise_error(F.lit(f"null {c}")))
        .when(parsed.isNull(), F.raise_error(F.concat(F.lit(f"bad {c}: "), col.cast("string"))))
        .otherwise(parsed)
    )


def split_rejects(
    raw: DataFrame, ids: Sequence[str], needed: Sequence[str] = (), write: Callable[[DataFrame], DataFrame] | None = None
) -> tuple[DataFrame, DataFrame]:
    """b04, quarantine: the rows of ``raw`` that load, and a table of those that don't.

    A row is rejected for the first column of ``ids`` that is null or no
    integer, or of ``needed`` that is null.  The reject table keeps the whole
    source row as a VARIANT, whatever its columns, with ``column`` and
    ``reason``.  Kept and rejected rows together are the input.  ``write``
    stores the checked rows as a table, so both parts come out of one pass.
    """
    def fault(c: str, why: str) -> Column:
        return F.struct(F.lit(c).alias("column"), F.lit(why).alias("reason"))

    found = [
        F.when(F.col(c).isNull(), fault(c, "null")).when(F.expr(f"try_cast(`{c}` as bigint)").isNull(), fault(c, "not an integer"))
        for c in ids
    ] + [F.when(F.col(c).isNull(), fault(c, "null")) for c in needed if c not in ids]
    checked = raw.withColumn("__fault", F.coalesce(*found))
    if write:
        checked = write(checked)
    kept = checked.filter(F.col("__fault").isNull()).drop("__fault")
    bad = checked.filter(F.col("__fault").isNotNull())
    return kept, bad.select(F.to_variant_object(F.struct(*raw.columns)).alias("source"), "__fault.column", "__fault.reason")


def typed_codes(raw: DataFrame, src: int, drop_subset=None, on_bad: str = "raise") -> DataFrame:
    """Codes with typed ids and the raw (un-dotted) code: subject_id, hadm_id, seq_num, raw_code, src."""
    df = raw.na.drop(how="any", subset=drop_subset)
    out = df.select(
        _id("subject_id", on_bad).alias("subject_id"),
        _id("hadm_id", on_bad).alias("hadm_id"),
        F.col("seq_num").cast("string").alias("seq_num"),
        F.col("icd9_code").alias("raw_code"),
        F.lit(src).alias("src"),
    )
    if on_bad == "quarantine":
        out = out.filter(F.col("subject_id").isNotNull() & F.col("hadm_id").isNotNull())
    return out


def normalize_codes(typed: DataFrame, strip_zeros: bool = True) -> DataFrame:
    """c02/c03 by source: diagnosis rule for ``src = 0``, procedure rule otherwise."""
    code = F.when(F.col("src") == SRC_DIAG, dot_diagnosis("raw_code", strip_zeros)).otherwise(
        dot_procedure("raw_code", strip_zeros)
    )
    return typed.select("subject_id", "hadm_id", "seq_num", code.alias("icd9_code"), "src")


def load_diagnoses(raw: DataFrame, strip_zeros: bool = True, drop_subset=None, on_bad: str = "raise") -> DataFrame:
    """a04: drop rows with any null, cast ids, dot diagnosis codes (c02).

    ``drop_subset=None`` drops on every column of ``raw`` like the source loader;
    naming the four used columns lets the scan prune the rest.
    """
    return normalize_codes(typed_codes(raw, SRC_DIAG, drop_subset, on_bad), strip_zeros).drop("src")


def load_procedures(raw: DataFrame, strip_zeros: bool = True, drop_subset=None, on_bad: str = "raise") -> DataFrame:
    """a05: as a04 with the procedure rule (c03)."""
    return normalize_codes(typed_codes(raw, SRC_PROC, drop_subset, on_bad), strip_zeros).drop("src")


def load_notes(raw: DataFrame, on_bad: str = "raise") -> DataFrame:
    """a06: keep 'Discharge summary' notes; row_id, subject_id, hadm_id, text.

    The category filter is a plain Column predicate, so it is pushed to the scan.
    """
    out = raw.filter(F.col("category") == F.lit(DISCHARGE_CATEGORY)).select(
        _id("row_id", on_bad).alias("row_id"),
        _id("subject_id", on_bad).alias("subject_id"),
        _id("hadm_id", on_bad).alias("hadm_id"),
        F.col("text"),
    )
    if on_bad == "quarantine":
        out = out.filter(F.col("subject_id").isNotNull() & F.col("hadm_id").isNotNull())
    return out


def all_codes(diagnoses: DataFrame, procedures: DataFrame) -> DataFrame:
    """h01: union all of diagnoses and procedures, tagged with ``src`` (0 = diag, 1 = proc)."""
    return diagnoses.withColumn("src", F.lit(SRC_DIAG)).unionByName(
        procedures.withColumn("src", F.lit(SRC_PROC))
    )


def tokenize_notes(notes: DataFrame) -> DataFrame:
    """c01 + c05 + c06: clean, tokenise and re-join each note's text."""
    return notes.withColumn("text", tokenized_text(clean_note("text")))


def filter_cohort(codes: DataFrame, notes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """d01 + d02: keep codes of admissions with notes and notes of admissions with codes.

    Both are left-semi joins on ``hadm_id`` (no driver-side key sets).  The second
    one uses ``codes`` directly: a note's admission is in (codes ⋉ notes) exactly
    when it is in ``codes``, so the result is identical with one join fewer.
    """
    kept_codes = codes.join(notes.select("hadm_id"), "hadm_id", "left_semi")
    kept_notes = notes.join(codes.select("hadm_id"), "hadm_id", "left_semi")
    return kept_codes, kept_notes


def code_order() -> list[Column]:
    """Total order of codes inside an admission: source, numeric seq, seq text, code."""
    return [F.col("src"), F.expr("try_cast(seq_num as bigint)"), F.col("seq_num"), F.col("icd9_code")]


def admission_labels(codes: DataFrame) -> DataFrame:
    """e04: ``;``-joined codes per admission (duplicates kept, ordered by ``code_order``)."""
    return codes.groupBy("subject_id", "hadm_id").agg(
        ordered_concat("icd9_code", code_order(), LABEL_SEP).alias("labels")
    )


def admission_texts(notes: DataFrame) -> DataFrame:
    """e05: space-joined note texts per admission, ordered by ``row_id``."""
    return notes.groupBy("subject_id", "hadm_id").agg(ordered_concat("text", ["row_id"], TEXT_SEP).alias("text"))


def join_texts_labels(texts: DataFrame, labels: DataFrame) -> DataFrame:
    """d03: inner join of per-admission texts and labels on (subject_id, hadm_id).

    Both sides come out of aggregations grouped by the same keys, so they are
    already hash-partitioned on them and the join adds no shuffle.
    """
    return texts.join(labels, ["subject_id", "hadm_id"]).select("subject_id", "hadm_id", "text", "labels")


class MissingKeys(ValueError):
    """Admissions that stand on one side of a strict join only."""

    def __init__(self, counts: dict[str, int]):
        super().__init__(", ".join(f"{n} admissions {what.replace('_', ' ')}" for what, n in counts.items() if n))
        self.counts = counts


def observed_join(texts: DataFrame, labels: DataFrame) -> tuple[DataFrame, Observation]:
    """d03 that counts what it leaves out: the joined rows, and the numbers of keys without a partner on either side.

    The counts are taken while the join runs and are there after its first
    action; the join's shuffles are those of the lenient form.
    """
    keys = ["subject_id", "hadm_id"]
    both = texts.withColumn("__t", F.lit(True)).join(labels.withColumn("__l", F.lit(True)), keys, "full_outer")
    counts = Observation()
    seen = both.observe(
        counts, F.count(F.when(F.col("__l").isNull(), 1)).alias("without_labels"),
        F.count(F.when(F.col("__t").isNull(), 1)).alias("without_text"))
    return seen.filter(F.col("__t") & F.col("__l")).select(*keys, "text", "labels"), counts


def strict_labelled_admissions(codes: DataFrame, notes: DataFrame, write: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """d03, strict: raises ``MissingKeys`` if the cohort's texts and labels don't pair up.

    The semi-joins go by admission alone, so a pair can still be missing where a
    note and a code of one admission name different patients.  ``write`` stores
    the joined rows as a table; that one job also counts, and the check follows it.
    """
    kept_codes, kept_notes = filter_cohort(codes, notes)
    joined, counts = observed_join(admission_texts(tokenize_notes(kept_notes)), admission_labels(kept_codes))
    out = write(joined)
    if any(counts.get.values()):
        raise MissingKeys(counts.get)
    return out


def labelled_admissions(codes: DataFrame, notes: DataFrame) -> DataFrame:
    """The ETL result: subject_id, hadm_id, text, labels for admissions with notes and codes.

    Same rows as  group(notes ⋉ codes) ⋈ group(codes ⋉ notes): a pair
    (subject, admission) present on both sides has its admission in both
    inputs, so the two semi-joins remove nothing the inner join keeps.  Written
    this way the notes are shuffled once and the codes once (the groupings).

    Notes are cleaned where they are read, before the shuffle: cleaning makes
    them shorter, and a hot admission's notes are cleaned by many tasks.
    """
    return join_texts_labels(admission_texts(tokenize_notes(notes)), admission_labels(codes))


# -- counts and frequencies -------------------------------------------------

def input_counts(notes: DataFrame, procedures: DataFrame, diagnoses: DataFrame) -> DataFrame:
    """e01: one row with the three input row counts."""
    n = notes.agg(F.count(F.lit(1)).alias("n_notes"))
    p = procedures.agg(F.count(F.lit(1)).alias("n_procedures"))
    d = diagnoses.agg(F.count(F.lit(1)).alias("n_diagnoses"))
    return n.crossJoin(p).crossJoin(d)  # three one-row frames


def distinct_codes(codes: DataFrame) -> DataFrame:
    """e02: number of distinct (normalised) codes."""
    return codes.agg(F.count_distinct("icd9_code").alias("n_codes"))


def admission_counts(notes: DataFrame, codes: DataFrame) -> DataFrame:
    """e03: distinct admissions in notes and codes, before and after the cohort filter.

    Exact, from bitmaps of the ids (32,768 ids each): either input is read once
    and becomes one small row for each range of ids it touches.  An admission
    survives the filter when it is in both, so both figures after it are
    |notes| + |codes| - |notes or codes|.  Null ids count nowhere.
    """
    def bits(df: DataFrame, name: str) -> DataFrame:
        ids = df.select(F.col("hadm_id").cast("bigint").alias("id")).filter(F.col("id").isNotNull())
        return ids.groupBy(F.bitmap_bucket_number("id").alias("range")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits")).withColumn("src", F.lit(name))

    def of(name: str) -> Column:
        return F.sum(F.when(F.col("src") == name, F.bitmap_count("bits")).otherwise(0))

    ranges = bits(notes, "notes").unionByName(bits(codes, "codes")).groupBy("range").agg(
        of("notes").alias("notes"), of("codes").alias("codes"), F.bitmap_count(F.bitmap_or_agg("bits")).alias("either"))
    totals = ranges.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in ("notes", "codes", "either")])
    both = F.col("notes") + F.col("codes") - F.col("either")
    return totals.select(
        F.col("notes").alias("notes_admissions"), F.col("codes").alias("codes_admissions"),
        both.alias("kept_notes_admissions"), both.alias("kept_codes_admissions"))


def admissions_per_patient(labelled: DataFrame) -> DataFrame:
    """e06: number of labelled admissions per patient."""
    return labelled.groupBy("subject_id").agg(F.count(F.lit(1)).alias("n_admissions"))


def explode_labels(labelled: DataFrame, keep_empty: bool = False) -> DataFrame:
    """c12: one row per (admission, label) from the ``;``-joined label string."""
    out = labelled.select("subject_id", "hadm_id", F.explode(F.split("labels", LABEL_SEP)).alias("label"))
    return out if keep_empty else out.filter(F.col("label") != F.lit(""))


def label_frequency(codes: DataFrame) -> DataFrame:
    """e07: admissions carrying each code (codes already restricted to the cohort)."""
    return codes.groupBy(F.col("icd9_code").alias("label")).agg(F.count_distinct("hadm_id").alias("frequency"))


def top_labels(frequency: DataFrame, k: int = 50) -> DataFrame:
    """g08: the k most frequent codes (frequency desc, code asc); a bounded top-k."""
    return frequency.orderBy(F.col("frequency").desc(), F.col("label")).limit(k)
