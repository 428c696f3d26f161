"""Proxy views: the clinical inputs re-derived from the given Parquet tables.

The clinical tables themselves (notes, diagnosis and procedure codes, code
dictionaries, model predictions) are not available, so every operator is run on
views that Spark derives from the test tables.  Each view grows with its source
tables; nothing is sampled or capped.  The same definitions exist as SQL CTEs in
``icdspark.plans.sql`` for the DuckDB cross-check.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from icdspark.functions.codes import reformat_code
from icdspark.functions.maths import sigmoid

# Fixed values of the proxy definitions.
NOTE_GROUP = 3              # three documents per admission: hadm_id = doc_id - doc_id % 3
DISCHARGE = "Discharge summary"
OTHER_CATEGORY = "Nursing"
DISCHARGE_LANG = "en"
PRED_LOGIT_SCALE = 8.0
TIED_LOGIT_STEP = 0.5       # the tied predictions have logits rounded down to this step


def pad_left(c: Column, n: int) -> Column:
    """Zeros in front up to ``n`` characters; longer keys stay whole (``lpad`` alone would cut them)."""
    return F.when(F.length(c) < n, F.lpad(c, n, "0")).otherwise(c)


@dataclass
class ProxyTables:
    spark: SparkSession
    sf_dir: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @staticmethod
    def bronze(df: DataFrame) -> DataFrame:
        """All columns as strings, as a header CSV read without inference yields."""
        return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])

    # -- clinical inputs -------------------------------------------------
    def notes_raw(self) -> DataFrame:
        """NOTEEVENTS stand-in: row_id, subject_id, hadm_id, category, text.

        The patient is the customer of the admission's order; an admission
        without an order is a patient of its own, so no document is lost.
        """
        docs = self.table("documents").select("doc_id", "text", "lang")
        orders = self.table("orders").select("o_orderkey", "o_custkey")
        hadm = F.col("doc_id") - F.col("doc_id") % NOTE_GROUP
        return docs.join(orders, hadm == F.col("o_orderkey"), "left").select(
            F.col("doc_id").alias("row_id"),
            F.coalesce("o_custkey", hadm).alias("subject_id"),
            hadm.alias("hadm_id"),
            F.when(F.col("lang") == DISCHARGE_LANG, F.lit(DISCHARGE))
            .otherwise(F.lit(OTHER_CATEGORY))
            .alias("category"),
            F.col("text"),
        )

    def _codes_base(self, admissions: DataFrame | None = None) -> DataFrame:
        items = self.table("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
        if admissions is not None:
            items = items.join(admissions.select(F.col("hadm_id").alias("l_orderkey")), "l_orderkey", "left_semi")
        orders = self.table("orders").select("o_orderkey", "o_custkey")
        return items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))

    def diag_raw(self, admissions: DataFrame | None = None) -> DataFrame:
        """DIAGNOSES_ICD stand-in: subject_id, hadm_id, seq_num, icd9_code (raw); of all or of some ``admissions(hadm_id)``."""
        part = F.col("l_partkey").cast("string")
        raw = (
            F.when(F.col("l_suppkey") % 10 == 0, F.concat(F.lit("E"), pad_left(part, 4)))
            .when(F.col("l_suppkey") % 10 == 1, F.concat(F.lit("V"), pad_left(part, 4)))
            .otherwise(pad_left(part, 5))
        )
        return self._codes_base(admissions).select(
            F.col("o_custkey").alias("subject_id"),
            F.col("l_orderkey").alias("hadm_id"),
            F.col("l_linenumber").alias("seq_num"),
            raw.alias("icd9_code"),
        )

    def diag_damaged(self) -> DataFrame:
        """The diagnoses as strings, with ids that don't load: sixth codes have no patient, seventh ones no integer admission."""
        return self.bronze(self.diag_raw()).withColumn(
            "subject_id", F.when(F.col("seq_num") != "6", F.col("subject_id"))).withColumn(
            "hadm_id", F.when(F.col("seq_num") == "7", F.concat(F.lit("A"), "hadm_id")).otherwise(F.col("hadm_id")))

    def proc_raw(self, admissions: DataFrame | None = None) -> DataFrame:
        """PROCEDURES_ICD stand-in: code = zero-padded supplier key; ``admissions`` as in ``diag_raw``."""
        return self._codes_base(admissions).select(
            F.col("o_custkey").alias("subject_id"),
            F.col("l_orderkey").alias("hadm_id"),
            F.col("l_linenumber").alias("seq_num"),
            pad_left(F.col("l_suppkey").cast("string"), 4).alias("icd9_code"),
        )

    # -- predictions -----------------------------------------------------
    def pred(self) -> DataFrame:
        """Dense long predictions: instance, label, logit, score, y.

        instance = vec_id, one label j for each embedding dimension,
        logit = 8 * embedding[j], y = 1 when the row's class equals j or
        (vec_id + class) modulo the number of dimensions equals j.
        """
        emb = self.table("embeddings").select(
            "vec_id", "label", F.size("embedding").alias("n"), F.posexplode("embedding").alias("j", "x")
        )
        logit = F.lit(PRED_LOGIT_SCALE) * F.col("x").cast("double")
        y = (F.col("label") == F.col("j")) | ((F.col("vec_id") + F.col("label")) % F.col("n") == F.col("j"))
        return emb.select(
            F.col("vec_id").alias("instance"),
            F.col("j").cast("bigint").alias("label"),
            logit.alias("logit"),
            sigmoid(logit).alias("score"),
            y.cast("int").alias("y"),
        )

    def pred_tied(self) -> DataFrame:
        """The predictions with logits rounded down to half units, so that many scores are equal."""
        logit = F.floor(F.col("logit") / F.lit(TIED_LOGIT_STEP)) * F.lit(TIED_LOGIT_STEP)
        return self.pred().withColumn("logit", logit).withColumn("score", sigmoid("logit"))

    def vectors(self) -> DataFrame:
        """``idx = vec_id, vector``: the embeddings as doubles."""
        return self.table("embeddings").select(
            F.col("vec_id").alias("idx"), F.col("embedding").cast("array<double>").alias("vector")
        )

    def index_vectors(self, indexes: DataFrame) -> DataFrame:
        """A vector for every ``idx`` of ``indexes``: that of row ``idx`` modulo the number of embeddings."""
        emb = self.vectors()
        n = emb.agg(F.count(F.lit(1)).alias("n"))  # one row
        rows = indexes.select("idx").crossJoin(n).withColumn("vec", F.col("idx") % F.col("n"))
        return rows.join(emb.withColumnRenamed("idx", "vec"), "vec").select("idx", "vector")

    # -- code description dictionaries ------------------------------------
    def diag_dictionary(self) -> DataFrame:
        """D_ICD_DIAGNOSES stand-in: pos (file order), code (undotted), description.

        The three dictionaries' codes are the part key divided by 2, 3 and 3/2:
        overlapping ranges that grow with the table, each code more than once.
        """
        return self.table("part").select(
            F.col("p_partkey").alias("pos"),
            F.floor(F.col("p_partkey") / 2).cast("string").alias("code"),
            F.col("p_name").alias("description"),
        )

    def proc_dictionary(self) -> DataFrame:
        """D_ICD_PROCEDURES stand-in."""
        return self.table("part").select(
            F.col("p_partkey").alias("pos"),
            F.floor(F.col("p_partkey") / 3).cast("string").alias("code"),
            F.col("p_type").alias("description"),
        )

    def text_dictionary_lines(self) -> DataFrame:
        """ICD9_descriptions stand-in: pos, line = '  <dotted code>   <brand>  <type>'."""
        code = reformat_code(F.floor(F.col("p_partkey") * 2 / 3).cast("string"), True)
        return self.table("part").select(
            F.col("p_partkey").alias("pos"),
            F.concat(F.lit("  "), code, F.lit("   "), F.col("p_brand"), F.lit("  "), F.col("p_type")).alias("line"),
        )

    def class_pairs(self) -> DataFrame:
        """Two-class (y_true, y_pred) pairs for confusion matrices: quality vs toxic."""
        return self.table("labels").select(
            F.col("doc_id"), F.col("quality").alias("y_true"), F.col("toxic").alias("y_pred")
        )
