"""From raw documents to token ids: five operators, each stage written and read again.

    quality rules -> line dedup -> SimHash near-dedup -> benchmark decontamination -> SentencePiece

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns what it keeps of ``docs``, all but the last with the same columns.
``run`` applies them to the table ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from icdspark.llm import decontaminate, line_dedup, quality_rules, sentencepiece_codec, simhash_dedup
from icdspark.llm.common import read_table, stored, work_folder
from icdspark.llm.queries import piece_model


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects.

    Null and empty texts have too few words and go; repeated rows are judged
    one by one; an empty table stays empty.
    """
    return quality_rules.keep_good(docs)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages of 50 words or more that occur earlier (by id).

    A document that repeats earlier ones as a whole has an empty text from here
    on; the next stage keeps one of these.  Null texts stay null; rows with one id
    and text are one document; other columns are carried along.
    """
    return line_dedup.dedup_lines(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates.

    Null, empty and blank texts are one group; of rows with one id and text one
    stays; null ids come first.
    """
    return simhash_dedup.keep_first(docs)


def unleaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Each row is judged by its own text, null and empty ones hold none; null and
    empty items match nothing; an empty benchmark keeps every row.
    """
    return decontaminate.keep_clean(docs, read_table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, the scores of the best segmentations, and whether decoding gives the text back.

    Null and empty texts have no ids; repeated rows get a row each.
    """
    return sentencepiece_codec.encode(docs, piece_model())


STAGES = [
    ("quality_rules", good),
    ("line_dedup", without_repeated_lines),
    ("simhash_dedup", one_of_each),
    ("decontaminate", unleaked),
    ("sentencepiece", encoded),
]

#: SQL expresses none of SimHash groups, edit matching and segmentation; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = read_table(spark, sf_dir, "documents"), work_folder(spark)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), folder, name)
    return docs
