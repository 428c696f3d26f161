"""Multilabel linear model on pooled document vectors.

All labels are fitted together: one Spark job per iteration sums every label's
gradient over the documents.  What the driver holds is the model itself
(labels x dims), as Spark's own linear models do; documents and labels stay in
their partitions.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from icdspark.functions.maths import sigmoid
from icdspark.operators.features import KEYS
from icdspark.session import delete_path, shared_path

#: Weights (labels x dims) in one block of the scoring join, and cells (documents x labels) of one gradient step.
BLOCK_CELLS = 1_000_000
#: Documents in a block of features, and tasks that sum gradients in an iteration (each sends a row for each label).
BLOCK_ROWS, PARTIALS = 1024, 64
#: Labels that a task compares with its documents at a time in ``top_k_scores``.
LABEL_STEP = 256

_BLOCK = "x array<double>, starts array<int>, ids array<bigint>"


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of documents: vectors one after another, label ids in compressed rows."""
    for whole in batches:
        for start in range(0, whole.num_rows, BLOCK_ROWS):
            x, ids = (c.slice(start, BLOCK_ROWS) for c in whole.columns)
            starts = np.concatenate([[0], np.cumsum(np.diff(ids.offsets.to_numpy()))])
            yield pa.RecordBatch.from_arrays(
                [pa.array([x.flatten().to_numpy(zero_copy_only=False)], pa.list_(pa.float64())),
                 pa.array([starts], pa.list_(pa.int32())),
                 pa.array([ids.flatten().to_numpy(zero_copy_only=False)], pa.list_(pa.int64()))], names=["x", "starts", "ids"])


def _gradients(sent: Broadcast):
    """Per task and label: its documents' gradient, followed by their loss and positives."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = sent.value
        labels, width = weights.shape
        total = np.zeros((labels, width + 2))
        rows = max(1, BLOCK_CELLS // max(1, labels))  # documents x labels held at a time
        for batch in batches:
            for flat, starts, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                starts, ids = np.asarray(starts), np.asarray(ids, np.int64)
                n = len(starts) - 1
                block = np.column_stack([np.asarray(flat).reshape(n, width - 1), np.ones(n)])
                for start in range(0, n, rows):
                    x = block[start : start + rows]
                    bounds = starts[start : start + len(x) + 1]
                    own = ids[bounds[0] : bounds[-1]]
                    doc = np.repeat(np.arange(len(x)), np.diff(bounds))
                    z = x @ weights.T
                    total[:, :-2] += (1.0 / (1.0 + np.exp(-z))).T @ x
                    total[:, -2] += np.logaddexp(0.0, z).sum(0)
                    # the labels a document has, cell by cell
                    np.subtract.at(total[:, :-2], own, x[doc])
                    np.subtract.at(total[:, -2], own, z[doc, own])
                    np.add.at(total[:, -1], own, 1.0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(labels)), pa.array(list(total), pa.list_(pa.float64()))], names=["label", "sums"])

    return summed


def fit_label_models(
    features: DataFrame, num_labels: int, feature_col: str = "pooled", ids_col: str = "label_ids",
    iterations: int = 20, reg_param: float = 0.0, partials: int = PARTIALS,
) -> DataFrame:
    """i08: one logistic regression per label, all labels in one job per iteration.

    Accelerated gradient steps on the mean loss with a step that suits the
    data's largest squared length.  Returns ``label, weights array<double>, bias,
    skipped, first_loss, first_gradient, loss``: the loss and the gradient's length
    at zero weights, and the loss at the last step's point.  Labels with a
    single class in the data are skipped (null weights).

    The documents are packed once into blocks, a table in the shared folder:
    vectors as one array, label ids in compressed rows.  An iteration reads it in
    at most ``partials`` tasks, so it shuffles at most ``partials`` x labels rows,
    however many tasks made the features.
    """
    data = features.select(F.col(feature_col).cast("array<double>").alias("x"), F.col(ids_col).cast("array<bigint>").alias("label_ids"))
    square = F.aggregate("x", F.lit(1.0), lambda a, v: a + v * v)
    shape = data.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("d"), F.max(square).alias("s")).first()
    n, dims = shape["n"], shape["d"] or 0
    schema = "label long, weights array<double>, bias double, skipped boolean, first_loss double, first_gradient double, loss double"
    spark = features.sparkSession
    if not n:
        return spark.createDataFrame([], schema)
    folder = shared_path(spark, "label-blocks", uuid.uuid4().hex)
    data.mapInArrow(_packed, _BLOCK).write.parquet(folder)
    blocks = spark.read.schema(_BLOCK).parquet(folder).coalesce(partials)
    step = 1.0 / (0.25 * shape["s"] + reg_param)
    weights = ahead = np.zeros((num_labels, dims + 1))
    first = None
    for k in range(iterations):
        sent = spark.sparkContext.broadcast(ahead)
        sums = blocks.mapInArrow(_gradients(sent), "label long, sums array<double>").groupBy("label").agg(
            vector_to_array(Summarizer.sum(array_to_vector("sums"))).alias("sums"))
        total = np.zeros((num_labels, dims + 3))
        for row in sums.toLocalIterator():
            total[row["label"]] = row["sums"]
        sent.unpersist()
        gradient, loss, positives = total[:, :-2] / n, total[:, -2] / n, total[:, -1]
        if first is None:
            first = loss, np.sqrt((gradient * gradient).sum(1))
        moved = ahead - step * (gradient + reg_param * ahead)
        ahead = moved + k / (k + 3.0) * (moved - weights)
        weights = moved
    delete_path(spark, folder)
    rows = []
    for j in range(num_labels):
        skipped = bool(positives[j] in (0, n))
        fitted = (None, None) if skipped else (weights[j, :-1].tolist(), float(weights[j, -1]))
        rows.append((j, *fitted, skipped, float(first[0][j]), float(first[1][j]), float(loss[j])))
    return spark.createDataFrame(rows, schema)


def _best(sent: Broadcast, k: int, n_keep: int, first: bool):
    """A block of labels against batches of documents: the k best so far, kept up to date.

    The block's labels come with falling weight lengths.  A document leaves as
    soon as its length times the longest weights left, plus the largest bias
    left, can't reach its k-th score (Cauchy-Schwarz); rounding gets some room.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, weights, bias, norms, most_bias = sent.value
        for batch in batches:
            n = batch.num_rows
            x = batch.column(n_keep).flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, weights.shape[1]))
            if first:
                found, scores = np.full((n, k), -1, np.int64), np.full((n, k), -np.inf)
            else:
                found, scores = (batch.column(n_keep + i).flatten().to_numpy(zero_copy_only=False).reshape(n, k).copy() for i in (1, 2))
            length = np.sqrt((x * x).sum(1))
            for at in range(0, len(labels), LABEL_STEP):
                reach = length * norms[at]
                reach = reach + most_bias[at] + 1e-9 * (1.0 + reach + abs(most_bias[at]))
                open_ = np.flatnonzero(scores[:, -1] <= reach)
                if not len(open_):
                    break
                z = x[open_] @ weights[at : at + LABEL_STEP].T + bias[at : at + LABEL_STEP]
                all_scores = np.hstack([scores[open_], z])
                all_labels = np.hstack([found[open_], np.broadcast_to(labels[at : at + LABEL_STEP], z.shape)])
                order = np.lexsort((-all_labels, -all_scores))[:, :k]
                scores[open_] = np.take_along_axis(all_scores, order, 1)
                found[open_] = np.take_along_axis(all_labels, order, 1)
            ends = pa.array(np.arange(n + 1) * k, pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(v.reshape(-1))) for v in (found, scores)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: n_keep + 1], *lists], names=[*batch.schema.names[: n_keep + 1], "labels_", "logits_"])

    return run


def top_k_scores(
    features: DataFrame, weights: DataFrame, k: int, keys: Sequence[str] = KEYS, feature_col: str = "pooled",
    block_cells: int = BLOCK_CELLS,
) -> DataFrame:
    """i09 + g07: the k highest-scored labels of each document: ``keys, label, logit, score, rank``.

    Exact, and without the documents x labels rows of ``linear_scores``: labels
    are taken by falling weight length, in blocks of at most ``block_cells``
    weights, each a broadcast of that size which the documents pass through in
    one stage; a document skips what can't reach its k-th score.  Ties go to the
    higher label.  Only one block is on the driver at a time.
    """
    w = weights.filter(~F.coalesce(F.col("skipped"), F.lit(False))) if "skipped" in weights.columns else weights
    norm = F.sqrt(F.aggregate("weights", F.lit(0.0), lambda a, v: a + v * v))
    w = w.select(F.col("label").cast("bigint").alias("label"), F.col("weights").cast("array<double>").alias("weights"),
                 F.col("bias").cast("double").alias("bias"), norm.alias("norm"))
    top_bias = w.agg(F.max("bias").alias("b")).first()["b"]
    out = features.select(*keys, F.col(feature_col).cast("array<double>").alias("__x"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema.fields)
    schema, spark, first, block, cells = f"{kept}, labels_ array<bigint>, logits_ array<double>", features.sparkSession, True, [], 0

    def against(df: DataFrame, rows: list) -> DataFrame:
        bias = np.array([r["bias"] for r in rows])
        # biases of later blocks count too: the largest of all bounds them
        sent = spark.sparkContext.broadcast((
            np.array([r["label"] for r in rows], np.int64), np.array([r["weights"] for r in rows]), bias,
            np.array([r["norm"] for r in rows]), np.full(len(rows), top_bias)))
        return df.mapInArrow(_best(sent, k, len(keys), first), schema)

    for row in w.orderBy(F.col("norm").desc(), "label").toLocalIterator():
        block.append(row)
        cells += len(row["weights"])
        if cells >= block_cells:
            out, first, block, cells = against(out, block), False, [], 0
    if block or first:
        out = against(out, block) if block else out.withColumn("labels_", F.array().cast("array<bigint>")).withColumn(
            "logits_", F.array().cast("array<double>"))
    found = out.select(*keys, F.posexplode(F.arrays_zip("labels_", "logits_")).alias("at", "s")).select(
        *keys, F.col("s.labels_").alias("label"), F.col("s.logits_").alias("logit"), (F.col("at") + 1).alias("rank"))
    return found.filter(F.col("label") >= 0).withColumn("score", sigmoid("logit"))


def linear_scores(
    features: DataFrame, weights: DataFrame, keys: Sequence[str] = KEYS, feature_col: str = "pooled",
    min_score: float | None = None, block_cells: int = BLOCK_CELLS,
) -> DataFrame:
    """i09 + c16: long scores ``keys, label, logit, score`` with logit = w_label . x + b.

    The weights are packed into blocks of at most ``block_cells`` cells, each a
    row that meets every document (every label needs every document); a model
    of any size is scored block by block.  ``min_score`` keeps only cells with at
    least that probability, before they are exploded.
    """
    w = weights.filter(~F.coalesce(F.col("skipped"), F.lit(False))) if "skipped" in weights.columns else weights
    per_block = F.greatest(F.lit(1), F.floor(F.lit(block_cells) / F.greatest(F.size("weights"), F.lit(1))))
    blocks = w.groupBy(F.floor(F.col("label") / per_block).alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("label", "weights", "bias"))).alias("__w")).drop("block")
    x = F.col(feature_col)
    cells = F.transform(
        "__w",
        lambda s: F.struct(
            s["label"].alias("label"),
            (F.aggregate(F.zip_with(s["weights"], x, lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)
             + s["bias"]).alias("logit"),
        ),
    )
    if min_score is not None:
        cells = F.filter(cells, lambda s: sigmoid(s["logit"]) >= min_score)
    scored = features.crossJoin(blocks).select(*keys, F.explode(cells).alias("__s"))
    out = scored.select(*keys, F.col("__s.label").alias("label"), F.col("__s.logit").alias("logit"))
    return out.withColumn("score", sigmoid("logit"))
