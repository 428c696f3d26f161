"""Word embeddings: Word2Vec fit, vector tables, document vectors, pooling."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial

import numpy as np
from pyspark.ml.feature import Word2Vec, Word2VecModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from icdspark.functions.arrays import l2_normalize
from icdspark.functions.text import split_on_space
from icdspark.operators.features import KEYS
from icdspark.operators.running import row_number, word_bucket
from icdspark.operators.shards import meet, pooled_lists, spread_lists

# The embedding training parameters.
VECTOR_SIZE = 100
MIN_COUNT = 3
WINDOW_SIZE = 5
MAX_SENTENCE_LENGTH = 2500
MAX_ITER = 2
#: Tasks that train at once in an iteration; Spark's own default of 1 puts the whole training split into one.
NUM_PARTITIONS = 8


def fit_word2vec(
    train: DataFrame,
    text_col: str = "text",
    vector_size: int = VECTOR_SIZE,
    min_count: int = MIN_COUNT,
    window_size: int = WINDOW_SIZE,
    max_sentence_length: int = MAX_SENTENCE_LENGTH,
    max_iter: int = MAX_ITER,
    seed: int = 42,
    num_partitions: int = NUM_PARTITIONS,
) -> Word2VecModel:
    """i01: Word2Vec on the training texts split on one space (c10).

    The vectors depend on ``num_partitions``, so it is a parameter with a fixed
    default and never taken from the cluster's size.  More partitions
    spread the skip-gram training, but merge more partial vectors per iteration
    (a shuffle of vocabulary x dims per partition).  The library keeps the
    vocabulary and all vectors on the driver, and ships them to every task that
    uses the model: words x dims x 4 bytes must fit there.
    """
    tokens = train.select(split_on_space(text_col).alias("tokens"))
    w2v = Word2Vec(
        vectorSize=vector_size, minCount=min_count, windowSize=window_size, maxSentenceLength=max_sentence_length,
        maxIter=max_iter, seed=seed, numPartitions=num_partitions, inputCol="tokens", outputCol="doc_vector",
    )
    return w2v.fit(tokens)


def word_vectors(model: Word2VecModel) -> DataFrame:
    """``word, vector array<double>`` of a fitted model (i02's vocabulary)."""
    return model.getVectors().select("word", vector_to_array("vector").alias("vector"))


def document_vectors(
    model: Word2VecModel, docs: DataFrame, text_col: str = "text", keys: Sequence[str] = KEYS
) -> DataFrame:
    """i03: mean word vector per document; unknown words count in the denominator."""
    toks = docs.select(*keys, split_on_space(text_col).alias("tokens"))
    out = model.transform(toks)
    return out.select(*keys, vector_to_array("doc_vector").alias("doc_vector"))


def mean_vectors(docs: DataFrame, vectors: DataFrame, dim: int, text_col: str = "text", keys: Sequence[str] = KEYS) -> DataFrame:
    """i03 without the model: ``document_vectors`` from the written table ``vectors`` (word, vector).

    The words are numbered, a document's distinct words are looked up with
    their counts, and its list of numbers meets the vectors in shards; no task
    holds all vectors, and none is shipped for each document that uses it.
    """
    numbers = row_number(vectors.select("word").distinct(), ["word"], word_bucket("word"), "idx")
    tokens = docs.select(*keys, split_on_space(text_col).alias("tokens"))
    terms = tokens.select(*keys, F.explode("tokens").alias("word")).groupBy(*keys, "word").agg(F.count(F.lit(1)).alias("n"))
    found = terms.join(numbers, "word").groupBy(*keys).agg(
        F.flatten(F.collect_list(F.array_repeat("idx", F.col("n").cast("int")))).alias("ids"))
    sums = sum_pool(found, vectors.join(numbers, "word").select("idx", "vector"), keys, "ids")
    total = F.coalesce("sums", F.array_repeat(F.lit(0.0), dim))
    return tokens.select(*keys, F.size("tokens").alias("n_tokens")).join(sums.drop("n_tokens"), list(keys), "left").select(
        *keys, F.transform(total, lambda x: x / F.greatest(F.col("n_tokens"), F.lit(1))).alias("doc_vector"))


def save_model(model: Word2VecModel, path: str) -> None:
    """a10: persist a fitted model (overwrite)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> Word2VecModel:
    """a10: reload a persisted model."""
    return Word2VecModel.load(path)


def embedding_table(word_index: DataFrame, vectors: DataFrame, dim: int, seed: int = 1) -> DataFrame:
    """i04: ``idx, vector`` with row 0 = zeros (padding), rows 1..V the words by
    index, row V+1 a seeded Gaussian (unknown word); every row L2-normalised (c18)."""
    spark = word_index.sparkSession
    words = word_index.join(vectors, "word").select("idx", F.col("vector").cast("array<double>").alias("vector"))
    n = word_index.agg(F.count(F.lit(1)).alias("__v"))  # one row
    unk = np.random.RandomState(seed).randn(dim).tolist()
    extra = spark.createDataFrame([(0, [0.0] * dim), (-1, unk)], "idx long, vector array<double>")
    extra = extra.crossJoin(n).select(
        F.when(F.col("idx") < 0, F.col("__v") + 1).otherwise(F.col("idx")).alias("idx"), "vector"
    )
    return words.unionByName(extra).select("idx", l2_normalize("vector").alias("vector"))


def token_vectors(
    doc_ids: DataFrame, embedding: DataFrame, keys: Sequence[str] = KEYS, ids_col: str = "word_ids"
) -> DataFrame:
    """d07: one row per document token with its vector; an id without a vector is an error.

    A token is shipped as its place and id; its vector is added where its shard is.
    """
    out = meet(doc_ids, embedding, keys, ids_col, spread_lists, "pos int, idx bigint, vector array<double>")
    return out.select(*keys, "pos", "idx", "vector")


def _pool(doc_ids: DataFrame, embedding: DataFrame, keys: Sequence[str], ids_col: str, reduce: np.ufunc, merge: Callable) -> DataFrame:
    """Keys, ``n_tokens`` and ``pooled``: the lists are reduced shard by shard, then a document's few parts are merged."""
    use = partial(pooled_lists, reduce=reduce)
    parts = meet(doc_ids, embedding, keys, ids_col, use, "n bigint, part array<double>", reduce)
    whole = parts.groupBy(*keys).agg(F.sum("n").alias("n_tokens"), F.collect_list("part").alias("parts"))
    merged = F.reduce(F.slice("parts", 2, 1 << 30), F.get("parts", F.lit(0)), lambda a, v: F.zip_with(a, v, merge))
    return whole.select(*keys, "n_tokens", merged.alias("pooled"))


def sum_pool(
    doc_ids: DataFrame, embedding: DataFrame, keys: Sequence[str] = KEYS, ids_col: str = "word_ids"
) -> DataFrame:
    """Sum of the document's token vectors (``sums``) and their number; an id without a vector is an error."""
    return _pool(doc_ids, embedding, keys, ids_col, np.add, lambda a, b: a + b).withColumnRenamed("pooled", "sums")


def max_pool(
    doc_ids: DataFrame, embedding: DataFrame, keys: Sequence[str] = KEYS, ids_col: str = "word_ids"
) -> DataFrame:
    """i07: element-wise max of the document's token vectors (real tokens only).

    A repeated token changes no maximum, so only a document's distinct ids are
    shipped; documents are never exploded into dimensions.  A document without
    tokens has no row.
    """
    distinct = doc_ids.select(*keys, F.array_distinct(ids_col).alias(ids_col))
    return _pool(distinct, embedding, keys, ids_col, np.maximum, lambda a, b: F.greatest(a, b)).drop("n_tokens")
