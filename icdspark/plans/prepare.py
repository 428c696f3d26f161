"""Materialised stage boundaries for the model-input jobs.

The original application hands its stages CSV files (labelled admissions,
splits, word vectors).  Here the same boundaries are Parquet tables in the
shared folder named by ``spark.checkpoint.dir`` (or a folder of the caller's):
later stages read them instead of recomputing the ETL, lineage is cut, and
Spark knows the lookup tables' sizes when it plans a join.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from icdspark.functions.arrays import multi_hot
from icdspark.operators import cohort as co
from icdspark.operators import embeddings as em
from icdspark.operators import features as fe
from icdspark.operators import split as sp
from icdspark.plans.etl import Etl, proxy_etl
from icdspark.session import delete_path, shared_path


#: Tokens in a part of the encoding (its rows per token take some 100 bytes each there) and in a task of the Word2Vec training.
PART_TOKENS, TRAIN_TOKENS = 1_000_000, 4_000_000
#: Characters of wide rows in a task: a Parquet writer looks at a page's bytes only every hundred rows, and holds them several times.
ROW_CHARS = 1 << 26


class Prepared:
    """Labelled admissions with split, label index, word index and vectors, each written once.

    ``folder`` is where the tables go; a new one in the shared folder by
    default, which ``close`` deletes.
    """

    def __init__(self, spark: SparkSession, etl: Etl | None, folder: str | None = None):
        self.spark = spark
        self.etl = etl
        self._own = folder is None
        self.folder = folder or shared_path(spark, "tables", uuid.uuid4().hex)

    @classmethod
    def from_split_table(cls, spark: SparkSession, split_adm: DataFrame, folder: str | None = None) -> "Prepared":
        """Continue from an already written split table (later runs skip the ETL)."""
        out = cls(spark, None, folder)
        out.__dict__["split_adm"] = split_adm
        return out

    def written(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` as a Parquet table of this folder.

        The write is the lineage cut: later stages (and recomputed tasks after
        an executor loss) read the table, never the upstream plan.
        """
        path = f"{self.folder}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def written_anew(self, df: DataFrame, name: str) -> DataFrame:
        """``written`` under a name of its own, for tables that several queries make."""
        return self.written(df, f"{name}-{uuid.uuid4().hex}")

    def close(self) -> None:
        """Delete the tables, if their folder is this object's own."""
        if self._own:
            delete_path(self.spark, self.folder)

    @cached_property
    def admission_keys(self) -> DataFrame:
        """The labelled admissions' ids, which the split needs more than once."""
        return self.written(self.etl.admission_keys(self.kept_codes), "admission_keys")

    @cached_property
    def admission_splits(self) -> DataFrame:
        keys = self.admission_keys
        return self.written(sp.admission_splits(keys, self.etl.assignment(keys)), "admission_splits")

    @cached_property
    def kept_codes(self) -> DataFrame:
        """d01: the codes of admissions with notes, by a table of their ids; most codes' admissions have no note."""
        admissions = self.written(self.etl.notes().select("hadm_id").distinct(), "note_admissions")
        return self.written(self.etl.kept_codes(admissions), "kept_codes")

    @cached_property
    def label_frequency(self) -> DataFrame:
        """e07 over the kept codes."""
        return self.written(co.label_frequency(self.kept_codes), "label_frequency")

    @cached_property
    def split_adm(self) -> DataFrame:
        out = self.etl.split(self.admission_splits, self.kept_codes).withColumn("tlen", F.size(F.split("text", " ")))
        return self.written(out, "split_admissions")

    @property
    def labelled(self) -> DataFrame:
        return self.split_adm.select("subject_id", "hadm_id", "text", "labels")

    @property
    def train(self) -> DataFrame:
        return self.split_adm.filter(F.col("split") == "train")

    @cached_property
    def label_index(self) -> DataFrame:
        return self.written(fe.label_index(self.labelled), "label_index")

    @cached_property
    def word_index(self) -> DataFrame:
        # the count of all texts is made once; the ranks read it several times
        return self.written(fe.word_index(self.written(fe.vocabulary(self.train), "vocabulary")), "word_index")

    @cached_property
    def num_labels(self) -> int:
        return self.label_index.count()

    @cached_property
    def num_documents(self) -> int:
        return self.split_adm.count()

    @cached_property
    def num_words(self) -> int:
        return self.word_index.count()

    @cached_property
    def num_tokens(self) -> dict[str, int]:
        """Tokens of each split."""
        return {r["split"]: r["n"] or 0 for r in self.split_adm.groupBy("split").agg(F.sum("tlen").alias("n")).collect()}

    @property
    def text_parts(self) -> int:
        """In how many parts the texts are encoded."""
        return max(2, -(-sum(self.num_tokens.values()) // PART_TOKENS))

    @property
    def wide_parts(self) -> int:
        """In how many parts rows of a character for each label are made: a task's rows are few where they are long."""
        return max(2, -(-self.num_documents * self.num_labels // ROW_CHARS))

    def multi_hot(self) -> DataFrame:
        """c15 on every split: subject_id, hadm_id, multi_hot (a string of a digit for each label).

        The lists of ids are dealt out, the long rows made behind that.
        """
        ids = fe.doc_label_ids(self.labelled, self.label_index).repartition(self.wide_parts)
        return ids.select(*fe.KEYS, multi_hot("label_ids", self.num_labels, text=True).alias("multi_hot"))

    def encoded(self) -> DataFrame:
        """i05 on every split: subject_id, hadm_id, split, tlen, word_ids, label_ids."""
        return fe.encode_documents(
            self.split_adm, self.label_index, self.word_index, self.num_words, carry=("split", "tlen"),
            partitions=self.text_parts)

    @cached_property
    def encoded_table(self) -> DataFrame:
        return self.written(self.encoded(), "encoded")

    def batched(self, batch_size: int = fe.EVAL_BATCH) -> DataFrame:
        """i06 per split in file order (length, id): batch, position, slot, padded."""
        return fe.batch_and_pad(self.encoded_table, batch_size, "tlen", partition_cols=["split"])

    @cached_property
    def word2vec(self):
        """The model of the training split, saved (a10) and loaded again; fitted once.

        Tasks follow the number of tokens, so a larger split isn't left to the same few.
        """
        path = f"{self.folder}/word2vec"
        tasks = max(em.NUM_PARTITIONS, -(-self.num_tokens.get("train", 0) // TRAIN_TOKENS))
        em.save_model(em.fit_word2vec(self.train, seed=7, num_partitions=tasks), path)
        return em.load_model(path)

    @cached_property
    def word_vectors(self) -> DataFrame:
        """The model's vectors as a table of their own (i03, i04)."""
        return self.written(em.word_vectors(self.word2vec), "word_vectors")


_PREPARED: dict[tuple[str, str], Prepared] = {}


def prepared(spark: SparkSession, sf_dir: str) -> Prepared:
    """The stages over the proxy views of ``sf_dir``; written once in a Spark application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _PREPARED:
        _PREPARED[key] = Prepared(spark, proxy_etl(spark, sf_dir))
    return _PREPARED[key]


def close_all() -> None:
    """Delete the tables of all prepared inputs."""
    while _PREPARED:
        _PREPARED.popitem()[1].close()
