"""Quality classifier: hashed word n-grams, logistic regression by FTRL-proximal.

Words are runs of letters or digits and runs of signs.  Their hashes, and those
of neighbouring pairs, index ``2 ** BITS`` weights; a text's feature value is
the count over the square root of the number of features, so a score is the
logistic of a sparse dot product.

The model is fitted on a bounded sample of labelled rows (``SAMPLE_ROWS``).
The sample is dealt into ``SHARDS`` groups by id; each group runs FTRL on its
own rows as one Spark task, and the mean of the shards' weights is the start
of the next round, and the model after the last one.  Nothing depends on the
partitioning, so the fit is the same on any cluster.
"""

from __future__ import annotations

import re
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icdspark.llm.common import map_rows, need_columns, stored, work_folder

BITS = 18
#: Labelled rows that the model is fitted on, at most.
SAMPLE_ROWS = 20_000
SHARDS = 8
ROUNDS = 2
EPOCHS = 4
FOLDS = 5
THRESHOLD = 0.3
#: FTRL-proximal: learning rate, its smoothing, L1 and L2 strength.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 1.0

_WORD = re.compile(r"\w+|[^\w\s]+")
_MASK = (1 << BITS) - 1
_PAIR = np.uint64(0x9E3779B97F4A7C15)
_SAME = np.uint64(12345)
_KEPT_WORDS = 400_000
_codes: dict[str, int] = {}


def _codes_of(words: list[str]) -> np.ndarray:
    known = _codes
    try:
        codes = [known[w] for w in words]
    except KeyError:
        if len(known) > _KEPT_WORDS:
            known.clear()
        codes = []
        for w in words:
            c = known.get(w)
            if c is None:
                c = known[w] = crc32(w.encode("utf-8", "surrogatepass"))
            codes.append(c)
    return np.array(codes, np.uint64)


def features(text: str | None) -> np.ndarray:
    """Indices of a text's words and word pairs, repeats included.

    All pairs of a word with itself are one feature, whatever the word.
    """
    codes = _codes_of(_WORD.findall(text or ""))
    pairs = np.where(codes[:-1] == codes[1:], _SAME, (codes[:-1] * _PAIR + codes[1:]) * _PAIR >> np.uint64(40))
    return np.concatenate([codes * _PAIR >> np.uint64(40), pairs + np.uint64(1)]).astype(np.int64) & _MASK


def score(weights: np.ndarray, text: str | None) -> float:
    """Logistic of the dot product; the last weight is the constant, all that an empty text has."""
    at = features(text)
    total = float(weights[-1])
    if len(at):
        total += float(weights[at].sum()) / len(at) ** 0.5
    return float(1.0 / (1.0 + np.exp(-max(-35.0, min(35.0, total)))))


def fit_shard(texts: list[str], targets: list[int], start: np.ndarray, epochs: int = EPOCHS) -> np.ndarray:
    """FTRL-proximal over the rows in order, from the weights ``start``."""
    n = np.zeros(len(start))
    # a state whose proximal step gives the weights back
    z = -start * (BETA / ALPHA + L2) - np.sign(start) * L1
    rows = []
    for text in texts:
        at, counts = np.unique(features(text), return_counts=True)
        values = counts / max(1, counts.sum()) ** 0.5
        rows.append((np.append(at, len(start) - 1), np.append(values, 1.0)))
    for _ in range(epochs):
        for (at, values), target in zip(rows, targets, strict=True):
            zs, ns = z[at], n[at]
            w = -(zs - np.sign(zs) * L1) / ((BETA + np.sqrt(ns)) / ALPHA + L2)
            w[np.abs(zs) <= L1] = 0.0
            p = 1.0 / (1.0 + np.exp(-np.clip(w @ values, -35.0, 35.0)))
            g = (p - target) * values
            sigma = (np.sqrt(ns + g * g) - np.sqrt(ns)) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
    w[np.abs(z) <= L1] = 0.0
    return w


def held_out(id_col: str) -> Column:
    """Whether the row's fold (CRC-32 of the id as text, by ``FOLDS``) is kept from learning; no id: not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
          text_col: str = "text", sample_rows: int = SAMPLE_ROWS, shards: int = SHARDS, rounds: int = ROUNDS) -> np.ndarray:
    """Weights (``2 ** BITS`` and the constant) learnt from labelled rows that aren't held out.

    Of more than ``sample_rows`` such labels, those with the smallest id hashes
    are taken.  Null labels and ids teach nothing; repeated ones teach again.
    Without any label all weights are 0.
    """
    need_columns(docs, id_col, text_col)
    need_columns(labels, id_col, label_col)
    chosen = (
        labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col))
        .select(F.col(id_col).alias("id"), (F.col(label_col) > 0).cast("int").alias("target"))
        .orderBy(F.xxhash64("id"), "id", "target").limit(sample_rows)
    )
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id").select(
        "id", "target", "text", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard"))
    rows = stored(rows, work_folder(docs.sparkSession), "sample")
    weights = np.zeros((1 << BITS) + 1)
    for _ in range(rounds):
        fitted = rows.groupBy("shard").applyInPandas(
            _shard_fit(docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))), "n long, weights binary"
        ).collect()  # one row of fixed size for each of the fixed shards
        if not fitted:
            break
        total = sum(r["n"] for r in fitted)
        weights = sum(np.frombuffer(r["weights"], np.float32).astype(np.float64) * (r["n"] / total) for r in fitted)
    return weights.astype(np.float32)


def _shard_fit(start: Broadcast):
    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["id", "target", "text"], kind="stable")
        # ids may follow the source or the label: learn in the order of a hash
        order = np.argsort([crc32(str(i).encode()) for i in group["id"]], kind="stable")
        group = group.iloc[order]
        w = fit_shard(list(group["text"]), list(group["target"]), start.value.astype(np.float64))
        return pd.DataFrame({"n": [len(group)], "weights": [w.astype(np.float32).tobytes()]})

    return fit


def classify(docs: DataFrame, weights: np.ndarray, threshold: float = THRESHOLD, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, held_out, score, predicted``.

    ``score`` is the chance of label 1.  Null texts count as empty; an empty
    one has the model's constant as its score.  Repeated rows and null ids get
    a row each; an empty table gives an empty one; other columns are ignored.
    """
    need_columns(docs, id_col, text_col)
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    def scored(texts: list[str | None]) -> list[tuple]:
        return [(s, int(s >= threshold)) for s in (score(sent.value, t) for t in texts)]

    keep = {"doc_id": F.col(id_col), "held_out": held_out(id_col)}
    return map_rows(docs, keep, [F.col(text_col)], {"score": pa.float64(), "predicted": pa.int32()}, scored)
