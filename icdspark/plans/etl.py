"""The note/code ETL composed from the operators, on any three raw tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from icdspark.operators import cohort as co
from icdspark.operators import split as sp
from icdspark.sources.files import read_csv_table
from icdspark.sources.proxy import ProxyTables


@dataclass
class Etl:
    """Raw notes, diagnosis and procedure codes (all columns strings, as CSV readers give them)."""

    notes_raw: DataFrame
    diag_raw: DataFrame
    proc_raw: DataFrame
    strip_zeros: bool = True
    #: For sources that can leave out other admissions' codes where they are read: no filter passes the strict casts.
    narrowed: Callable[[DataFrame], "Etl"] | None = None

    def diagnoses(self) -> DataFrame:
        return co.load_diagnoses(self.diag_raw, self.strip_zeros)

    def procedures(self) -> DataFrame:
        return co.load_procedures(self.proc_raw, self.strip_zeros)

    def notes(self) -> DataFrame:
        return co.load_notes(self.notes_raw)

    def codes(self) -> DataFrame:
        return co.all_codes(self.diagnoses(), self.procedures())

    def tokenized_notes(self) -> DataFrame:
        return co.tokenize_notes(self.notes())

    def cohort(self) -> tuple[DataFrame, DataFrame]:
        return co.filter_cohort(self.codes(), self.tokenized_notes())

    def kept_codes(self, admissions: DataFrame) -> DataFrame:
        """d01 with the notes' ``admissions(hadm_id)`` as a table; a narrower source reads less for the same rows."""
        source = self.narrowed(admissions) if self.narrowed else self
        return co.filter_cohort(source.codes(), admissions)[0]

    def admission_keys(self, codes: DataFrame | None = None) -> DataFrame:
        """(subject_id, hadm_id) of the labelled admissions, without touching a text; ``codes`` as in ``labelled``."""
        keys, codes = ["subject_id", "hadm_id"], self.codes() if codes is None else codes
        return self.notes().select(*keys).distinct().join(codes.select(*keys).distinct(), keys)

    def labelled(self, codes: DataFrame | None = None) -> DataFrame:
        """The labelled admissions; ``codes``: the cohort's codes, where they have been written."""
        return co.labelled_admissions(self.codes() if codes is None else codes, self.notes())

    def strict_labelled(self, write: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """``labelled``, or an error if a text or a label of the cohort is without its partner; ``write`` makes a table."""
        return co.strict_labelled_admissions(self.codes(), self.notes(), write)

    def quarantined(self, write: Callable[[DataFrame, str], DataFrame] | None = None) -> tuple["Etl", dict[str, DataFrame]]:
        """The ETL over the rows that load, and the reject tables of the three inputs.

        ``write(df, name)`` stores a table, so that each input is read once for both.
        """
        kept, rejects = {}, {}
        for name, raw, ids in (
            ("notes_raw", self.notes_raw.filter(F.col("category") == F.lit(co.DISCHARGE_CATEGORY)), ("row_id", "subject_id", "hadm_id")),
            ("diag_raw", self.diag_raw, ("subject_id", "hadm_id")), ("proc_raw", self.proc_raw, ("subject_id", "hadm_id")),
        ):
            needed = () if name == "notes_raw" else raw.columns
            store = (lambda df, name=name: write(df, f"checked_{name}")) if write else None
            kept[name], rejects[name] = co.split_rejects(raw, ids, needed, store)
        return replace(self, narrowed=None, **kept), rejects

    def assignment(self, keys: DataFrame | None = None) -> DataFrame:
        return sp.assign_splits(self.admission_keys() if keys is None else keys)

    def split(self, splits: DataFrame | None = None, codes: DataFrame | None = None) -> DataFrame:
        """Labelled admissions with their patient-disjoint split (g01 + d04).

        ``splits``: the ``admission_splits`` as a table, where they have been written; ``codes`` as in ``labelled``.
        """
        if splits is not None:
            return self.labelled(codes).join(splits, ["subject_id", "hadm_id"])
        return sp.split_admissions(self.labelled(codes), self.assignment(), self.admission_keys())


def proxy_etl(spark: SparkSession, sf_dir: str) -> Etl:
    """The ETL over the proxy views of the given tables."""
    px = ProxyTables(spark, sf_dir)

    def etl(admissions: DataFrame | None = None) -> Etl:
        return Etl(
            px.bronze(px.notes_raw()), px.bronze(px.diag_raw(admissions)), px.bronze(px.proc_raw(admissions)), narrowed=etl)

    return etl()


def csv_etl(spark: SparkSession, folder: str) -> Etl:
    """The ETL over a folder with NOTEEVENTS.csv, DIAGNOSES_ICD.csv and PROCEDURES_ICD.csv.

    Quoted multi-line fields make a CSV file one task; convert large files to
    Parquet once and give their tables to ``Etl``.
    """
    tables = (read_csv_table(spark, f"{folder}/{name}.csv", register=False)
              for name in ("NOTEEVENTS", "DIAGNOSES_ICD", "PROCEDURES_ICD"))
    notes, diag, proc = (t.toDF(*[c.lower() for c in t.columns]) for t in tables)
    return Etl(notes.select("row_id", "subject_id", "hadm_id", "category", "text"), diag, proc)
