"""SimHash near-duplicates by deletion-variant signatures.

Two 64-bit fingerprints that differ in at most three bits agree, in one of
their two 32-bit segments, up to one bit.  So each segment is indexed under its
32 variants with one bit masked; equal variants propose a pair and the bit
distance verifies it.  Only distinct fingerprints are indexed, so exact copies
cost nothing more.

A bucket of at most ``BUCKET_ROWS`` fingerprints is collected and linked by a
breadth-first search, which gives a spanning forest instead of all pairs.  A
larger bucket (many near copies of one text) is cut again: its members agree on
one segment, so the same rule, applied to the halves of the other one, splits
it into smaller buckets without losing a pair.  After the third cut a bucket
has 11 free bits, so 2048 members at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icdspark.llm.common import free_name, map_rows, need_columns, stored, work_folder
from icdspark.llm.components import connected

WORDS = 3
MAX_BITS = 3
SEED = 42
#: Buckets up to this many fingerprints are compared inside one row.
BUCKET_ROWS = 4096
#: Widths of what is cut into two segments, level by level.
LEVEL_BITS = (64, 32, 16)

_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))


def simhash(text: str | None, words: int = WORDS) -> int:
    """The fingerprint as a signed 64-bit number; 0 for a text without words.

    A bit is 1 if it is set in over half of the shingles' hashes; a text with
    fewer words than a shingle takes is one shingle.
    """
    tokens = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not tokens:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(tokens) < words:
        hashes = [digest(b" ".join(tokens), SEED)]
    elif words == 3:
        hashes = [digest(b"%b %b %b" % three, SEED) for three in zip(tokens, tokens[1:], tokens[2:])]
    else:
        hashes = [digest(b" ".join(tokens[i : i + words]), SEED) for i in range(len(tokens) - words + 1)]
    values = np.array(hashes, np.uint64)
    counts = np.zeros(64, np.int64)
    for start in range(0, len(values), 65536):  # bounded memory for very long texts
        block = values[start : start + 65536]
        counts += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = 2 * counts > len(values)
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])


def forest(values: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between fingerprints: verified pairs only, fewer than there are members."""
    if len(values) == 2:
        a, b = values
        return [(int(a), int(b))] if int(np.bitwise_count((a ^ b).view(np.uint64))) <= max_bits else []
    left = np.sort(values)
    links, queue = [], []
    while len(left):
        if not queue:
            queue.append(left[0])
            left = left[1:]
            continue
        at = queue.pop()
        near = np.bitwise_count((left ^ at).view(np.uint64)) <= max_bits
        if near.any():
            found = left[near]
            links += [(int(at), int(x)) for x in found]
            queue += list(found)
            left = left[~near]
    return links


def _variants(level: int, rest: Column) -> Column:
    """For each half and each of its bits: the masked half, where it is, and what remains for a next cut."""
    half = LEVEL_BITS[level] // 2
    mask = F.lit((1 << half) - 1).cast("long")
    out = []
    for low in (0, 1):
        segment = F.shiftrightunsigned(rest, half * low).bitwiseAND(mask)
        other = F.shiftrightunsigned(rest, half * (1 - low)).bitwiseAND(mask)
        for bit in range(half):
            place = low * half + bit
            key = F.shiftleft(segment.bitwiseAND(F.lit(~(1 << bit)).cast("long")), 6) + F.lit(place)
            out.append(F.struct(key.alias("key"), other.alias("rest")))
    return F.array(*out)


def links(prints: DataFrame, folder: str, max_bits: int = MAX_BITS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``a, b``: pairs of distinct fingerprints ``f`` within ``max_bits`` that connect all that are linked.

    Every linked pair is connected by a path of returned pairs.  ``max_bits``
    is 3 at most: the halves then differ by one bit at most in one of them.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("two segments find up to three differing bits")
    spark = prints.sparkSession
    found = spark.createDataFrame([], "a long, b long")
    rows = prints.select("f", F.col("f").alias("rest"))
    keys: list[str] = []

    def joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            pairs = [p for members in batch.iloc[:, 0] for p in forest(np.asarray(members, np.int64), max_bits)]
            yield pd.DataFrame(pairs, columns=["a", "b"], dtype="int64")

    for level in range(len(LEVEL_BITS)):
        key = f"k{level}"
        rows = rows.select(*keys, "f", F.explode(_variants(level, F.col("rest"))).alias("v")).select(
            *keys, F.col("v.key").alias(key), "f", F.col("v.rest").alias("rest"))
        keys.append(key)
        sizes = rows.groupBy(*keys).count().filter("count > 1")
        sizes = stored(sizes, folder, f"buckets{level}")
        last = level + 1 == len(LEVEL_BITS)  # here the free bits bound the size
        small = rows.join(sizes.filter(F.lit(last) | (F.col("count") <= bucket_rows)).drop("count"), keys, "left_semi")
        members = small.groupBy(*keys).agg(F.collect_list("f").alias("members")).select("members")
        found = found.unionByName(members.mapInPandas(joined, "a long, b long"))
        large = sizes.filter(F.col("count") > bucket_rows).drop("count")
        if last or large.isEmpty():
            break
        rows = stored(rows.join(large, keys, "left_semi"), folder, f"large{level}")
    return found.distinct()


def fingerprints(docs: DataFrame, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, f, h``: one row per input row; ``h`` is a hash of the exact text."""
    need_columns(docs, id_col, text_col)

    keep = {"doc_id": F.col(id_col), "h": F.xxhash64(text_col)}
    return map_rows(docs, keep, [F.col(text_col)], {"f": pa.int64()}, lambda texts: [(simhash(t, words),) for t in texts])


def _grouped(docs: DataFrame, folder: str, words: int, max_bits: int, id_col: str, text_col: str,
             bucket_rows: int) -> DataFrame:
    """``doc_id, h, f, node, component_id``; ``node`` is one of the component's fingerprints, the same for all its rows.

    Two components have the same smallest id where an id is repeated over
    unrelated texts; their nodes differ.
    """
    rows = stored(fingerprints(docs, words, id_col, text_col), folder, "prints")
    prints = stored(rows.groupBy("f").agg(F.min("doc_id").alias("first")), folder, "distinct")
    pairs = links(prints, folder, max_bits, bucket_rows)
    least = F.struct(F.col("first").isNull().alias("none"), "first", "f")  # a missing id is the last, as in min()
    label = connected(pairs, prints.select(F.col("f").alias("node"), least.alias("label")), folder)
    label = stored(
        label.select(F.col("node").alias("f"), F.col("label.f").alias("node"), F.col("label.first").alias("component_id")),
        folder, "labels")
    return rows.join(label, "f")


def near_duplicates(docs: DataFrame, words: int = WORDS, max_bits: int = MAX_BITS, id_col: str = "doc_id",
                    text_col: str = "text", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per input row: ``doc_id, f, component_id`` (the smallest id reachable by links).

    Null and empty texts have fingerprint 0 and are linked like any other.
    Rows with a null id take part in the links; they get the smallest id of
    their component, null if it has none.  Repeated rows get a row each; an
    empty table gives an empty one; other columns are ignored.
    """
    folder = work_folder(docs.sparkSession)
    return _grouped(docs, folder, words, max_bits, id_col, text_col, bucket_rows).select(
        "doc_id", "f", "component_id")


def keep_first(docs: DataFrame, words: int = WORDS, max_bits: int = MAX_BITS, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component, the one with its smallest id; columns stay as they were.

    If the kept id is repeated within its component, the row whose text has
    the smallest hash stays, and one of those that repeat it exactly.  An id
    that is repeated over several components has a row in each where it is the
    smallest.  A component without any id keeps all its rows: nothing tells
    which is first.
    """
    need_columns(docs, id_col, text_col)
    folder = work_folder(docs.sparkSession)
    groups = _grouped(docs, folder, words, max_bits, id_col, text_col, BUCKET_ROWS)
    of_first = groups.filter(F.col("doc_id") == F.col("component_id")).groupBy("node", "doc_id", "h").count()
    firsts = stored(of_first.groupBy("node", "doc_id").agg(F.min(F.struct("h", "count")).alias("m")).select(
        "doc_id", F.col("m.h").alias("h"), (F.col("m.count") > 1).alias("repeated"))
        .unionByName(groups.filter("doc_id is null and component_id is null").select("doc_id", "h").distinct()
                     .withColumn("repeated", F.lit(False))), folder, "firsts")
    key, text_hash, again = (free_name(docs, n) for n in ("key", "text_hash", "repeated"))
    kept = docs.join(
        firsts.select(F.col("doc_id").alias(key), F.col("h").alias(text_hash), F.col("repeated").alias(again)).hint("merge"),
        F.col(id_col).eqNullSafe(F.col(key)) & (F.xxhash64(text_col) == F.col(text_hash)))
    if firsts.filter("repeated").isEmpty():
        return kept.select(*docs.columns)
    return kept.filter(~F.col(again)).unionByName(kept.filter(again).dropDuplicates([id_col, text_hash])).select(*docs.columns)
