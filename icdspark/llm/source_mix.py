"""Mixing sources to target weights by systematic sampling, with DataFrame functions only.

A source's target share of words decides its rate, the expected copies of each
of its documents (at most ``max_rate``).  The documents of a source stand in
order of size; the prefix sum of expected copies starts at one random offset,
and a document is taken once for each integer that its own stretch crosses.
In order of size, what a source takes is off its target by less than its
longest document.

The order is made by a range shuffle of narrow rows, written once: a row's
number is its place in its task plus the rows of earlier tasks, which are counted
by task and source.  So a source of any size is spread over as many tasks as
its rows fill, and equal rows are spread too.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from icdspark.llm.common import columns_of, need_columns, stored, work_folder

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in code-point order (nulls last), repeating.
WEIGHTS = (1, 2, 3)
#: A document is taken so many times at most, so a source's target stops at so many times its size.
MAX_RATE = 3
SEED = "mix-1"
#: ``monotonically_increasing_id`` holds a row's place in its task in so many low bits, the task's number above them.
PLACE_BITS = 33
#: Hex digits of the digest that make an offset.
OFFSET_DIGITS = 12


def size_of(text: Column | str) -> Column:
    """Words of a text (null: 0)."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("bigint"), F.lit(0).cast("bigint"))


def offset(source: Column, seed: str) -> Column:
    """The source's random offset in [0, 1): a digest of seed and source, the same in every run."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(source.cast("string"), F.lit("")))), 1, OFFSET_DIGITS)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(16**OFFSET_DIGITS))


def numbered(df: DataFrame, order: Sequence[Column], folder: str, name: str, within: Sequence[str] = ()) -> DataFrame:
    """Add ``number``: a row's 1-based number along ``order`` inside each ``within`` (which must lead ``order``).

    The sorted rows are written as a table; ``order`` must be total but for rows that are alike.
    """
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place_", F.monotonically_increasing_id())
    placed = stored(placed, folder, name).withColumn("task_", F.shiftright("place_", PLACE_BITS))
    # a task holds at most one stretch of each source, so these are few rows more than tasks and sources together
    counts = placed.groupBy(*within, "task_").agg(F.count(F.lit(1)).alias("rows_"), F.min("place_").alias("first_"))
    before = Window.partitionBy(*within).orderBy("task_").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(counts.select(
        *(F.col(c).alias(f"{c}_of") for c in within), F.col("task_").alias("task_of"), "first_",
        F.coalesce(F.sum("rows_").over(before), F.lit(0)).alias("earlier_")), folder, f"{name}_starts")
    same = F.col("task_") == F.col("task_of")
    for c in within:
        same = same & F.col(c).eqNullSafe(F.col(f"{c}_of"))
    return placed.join(starts, same).select(
        *df.columns, (F.col("earlier_") + F.col("place_") - F.col("first_") + 1).alias("number"))


def source_weights(sources: DataFrame, weights: Sequence[float], folder: str) -> DataFrame:
    """``sources`` with ``weight``: ``weights`` repeating over the sources by code point, null last."""
    ranked = numbered(sources, [F.col("source").asc_nulls_last()], folder, "ranked")
    at = ((F.col("number") - 1) % len(weights)).cast("int")
    return ranked.withColumn("weight", F.element_at(F.lit([float(w) for w in weights]), at + 1)).drop("number")


def targets(weighted: DataFrame, max_rate: float) -> DataFrame:
    """Add ``target``: all words shared out by ``weight``, none above ``max_rate`` times its source's size.

    What a source can't take is shared out again by weight among the rest until
    none is above; each time, only three sums over the sources reach the driver.
    """
    cap = F.lit(float(max_rate)) * F.col("source_size")
    total = weighted.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("n")).first()["n"]
    level, capped = None, -1  # words per unit of weight
    while True:
        above = F.lit(False) if level is None else cap <= F.col("weight") * F.lit(level[0]) / F.lit(level[1])
        sums = weighted.agg(
            F.coalesce(F.sum(F.when(above, cap)), F.lit(0.0)).alias("held"), F.sum(F.when(above, 1).otherwise(0)).alias("n"),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0)).alias("weight")).first()
        if not sums["weight"] or sums["n"] == capped:
            break
        level, capped = (float(total - sums["held"]), sums["weight"]), sums["n"]
    share = F.lit(0.0) if level is None else F.least(cap, F.col("weight") * F.lit(level[0]) / F.lit(level[1]))
    return weighted.withColumn("target", share)


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: Sequence[float] | Mapping[str | None, float] = WEIGHTS, max_rate: int = MAX_RATE, seed: str = SEED,
    carry: Sequence[str] = (),
) -> DataFrame:
    """How many copies of each document the mix takes: id, ``carry`` columns, source, ``size``, ``source_size``, ``target``, ``copies``.

    ``weights`` is a sequence, repeated over the sources by code point (null
    last), or a mapping of sources (others weigh 0).  Defined results: a null
    text has size 0; null sources are one source; a source without words has
    target 0 and none of its documents is taken; documents without words are
    taken like any other of their source; repeated rows are documents of their
    own, and of rows that are alike any may get the extra copy; an empty table
    gives no rows.  Carried columns may have any names.
    """
    need_columns(docs, id_col, text_col, source_col, *carry)
    folder, kept = work_folder(docs.sparkSession), list(columns_of(docs.select(*carry))) if carry else []
    narrow = stored(docs.select(
        F.col(id_col).alias("id_"), F.col(source_col).cast("string").alias("source"), size_of(text_col).alias("size"),
        F.xxhash64(text_col).alias("text_"), *([F.struct(*kept).alias("kept_")] if kept else []),
        F.monotonically_increasing_id().alias("row_")), folder, "sizes")
    sizes = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    if isinstance(weights, Mapping):
        named = docs.sparkSession.createDataFrame(
            [(k, float(w)) for k, w in weights.items()], "source_ string, weight double")
        weighted = sizes.join(named, F.col("source").eqNullSafe(F.col("source_")), "left").drop("source_").fillna(0.0, ["weight"])
    else:
        weighted = source_weights(sizes, weights, folder)
    shares = stored(targets(stored(weighted, folder, "weighted"), max_rate), folder, "targets")
    shares = shares.select(F.col("source").alias("source_"), "source_size", "target")
    order = [F.col(c).asc_nulls_first() for c in ("source", "size", "id_", "text_", "row_")]
    ranked = numbered(narrow, order, folder, "ordered", ["source"])
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    u = offset(F.col("source"), seed)
    crossed = F.floor(F.col("number") * rate + u) - F.floor((F.col("number") - 1) * rate + u)
    return ranked.join(shares, F.col("source").eqNullSafe(F.col("source_"))).select(
        F.col("id_").alias(id_col), "source", "size", "source_size", "target",
        F.least(crossed, F.lit(max_rate)).cast("bigint").alias("copies"), *(["kept_"] if kept else []))


def emit(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus itself: every column of ``docs``, each document as often as the mix takes it."""
    mixed = mix(docs, carry=docs.columns, **options).filter(F.col("copies") > 0)
    return mixed.select("kept_.*", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")).alias("copy_")).drop("copy_")


def report(docs: DataFrame) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` with the standard weights."""
    return mix(docs).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
