"""Running totals and global row numbers without a single-partition window.

A window with no ``partitionBy`` moves every row into one task.  Here the order
is cut into *buckets* (a column that is monotone in the order), so the work is:

1. one shuffle on ``(partition_cols, bucket)`` and one window for the running
   sum inside each bucket;
2. the bucket totals, a grouped sum that is combined before its shuffle (the
   input is not windowed for it);
3. offsets by a window over the totals of each partition key, joined back on
   ``(partition_cols, bucket)``; the windowed side is already partitioned so.

A bucket is a pure expression of the row, so it is the same for a recomputed
task, and building a query runs no job.  ``range_bucket`` bounds the rows of a
bucket by its width; ``depth_bucket`` and ``word_bucket`` hold equal shares of
the rows wherever their values lie: their boundaries come from a small summary
of the same rows (a scalar subquery), in which each row searches its place.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from icdspark.functions._util import as_col

BUCKET = "__bucket"
#: Ids in one range bucket.
ID_WIDTH = 1 << 16
#: Equal-depth buckets and, where asked for, slices of equal width in each.
DEPTHS, SLICES = 1 << 8, 1 << 6
#: Boundaries of the equal-depth buckets are off by at most this share of the rows (the sketch's accuracy).
RANK_ERROR = 1 / 20_000
#: Values drawn for each boundary of ``word_bucket``.
DRAWS = 16
#: Score buckets in one unit of the logit.
BUCKETS_PER_LOGIT = 64
#: Logits beyond this share the outermost buckets (a double's sigmoid is 0 or 1 there).
MAX_LOGIT = 745


def range_bucket(col: str | Column, width: int = ID_WIDTH) -> Column:
    """Bucket of an integer key: ``floor(key / width)``; at most ``width`` keys each."""
    return F.floor(as_col(col) / F.lit(width))


def score_bucket(col: str | Column) -> Column:
    """Bucket of a probability, equally wide on the logit scale.

    Monotone in the score, and as fine near 0 and 1 as in the middle, where
    most scores of a sparse multilabel model lie.
    """
    p = as_col(col)
    logit = F.when(p <= 0, F.lit(-MAX_LOGIT)).when(p >= 1, F.lit(MAX_LOGIT)).otherwise(F.log(p / (F.lit(1.0) - p)))
    return F.floor(logit * F.lit(BUCKETS_PER_LOGIT))


#: A bucket is an expression of the row, or a function that adds it as the column ``BUCKET``.
Bucket = Column | Callable[[DataFrame], DataFrame]


def _searched(df: DataFrame, bounds: Column, value: Column, depths: int) -> DataFrame:
    """Add ``BUCKET``: how many of the ``depths - 1`` sorted ``bounds`` are at most ``value``, by halving steps.

    A column for each step, as an expression with a lambda isn't compiled; the
    planner spells them out, so a step names the last one as rarely as it can.
    Never null, or a join on it would filter only one of its sides below the
    input's aggregation, and the sides could no longer share its shuffle.
    """
    d = df.withColumn("__bounds", bounds).withColumn(BUCKET, F.lit(0))
    for k in reversed(range((depths - 1).bit_length())):
        more = F.get("__bounds", F.col(BUCKET) + F.lit((1 << k) - 1)) <= value
        d = d.withColumn(BUCKET, F.col(BUCKET) + F.when(more, F.lit(1 << k)).otherwise(F.lit(0)))
    return d.withColumn(BUCKET, F.coalesce(BUCKET, F.lit(0)))


def depth_bucket(col: str, depths: int = DEPTHS, slices: int = 1) -> Bucket:
    """Buckets of a numeric column: ``depths`` (a power of two) with nearly equal numbers of rows.

    The boundaries are quantiles from a mergeable sketch of all rows.  Equal
    values share a bucket.  ``slices`` cuts each bucket evenly between its
    boundaries, so that many rows get many buckets.
    """

    def add(df: DataFrame) -> DataFrame:
        # one literal, which the planner's rules needn't walk
        ranks = F.split(F.lit(",".join(str(k / depths) for k in range(1, depths))), ",").cast("array<double>")
        sketch = F.percentile_approx(F.col(col).cast("double"), ranks, int(1 / RANK_ERROR))
        # the other columns are aggregated beside it: the sketch then reads the very rows that are
        # numbered, and Spark makes and shuffles them once for both
        rest = [F.max(c).alias(f"max_{i}") for i, c in enumerate(df.columns)]
        bounds = df.agg(F.struct(sketch.alias("bounds"), *rest).alias("summary")).scalar()["bounds"]
        value = F.col(col).cast("double")
        d = _searched(df, bounds, value, depths)
        if slices > 1:
            low, high = F.get("__bounds", F.col(BUCKET) - 1), F.get("__bounds", F.col(BUCKET))
            slice_ = F.coalesce(F.least(F.floor((value - low) / (high - low) * slices), F.lit(slices - 1)), F.lit(0))
            d = d.withColumn(BUCKET, F.coalesce(F.col(BUCKET) * F.lit(slices) + slice_, F.lit(0)))
        return d.drop("__bounds")

    return add


def word_bucket(col: str, depths: int = DEPTHS) -> Bucket:
    """Buckets of a string column of distinct values: ``depths`` ranges of whole words with nearly equal numbers of rows.

    The boundaries are every ``DRAWS``-th of the words with the smallest hashes,
    a uniform draw whose size depends on ``depths`` alone.
    """

    def add(df: DataFrame) -> DataFrame:
        drawn = df.select(F.col(col).alias("word")).orderBy(F.xxhash64("word"), "word").limit(depths * DRAWS)
        bounds = drawn.agg(F.array_sort(F.collect_list("word")).alias("words")).select(F.transform(
            F.sequence(F.lit(1), F.lit(depths - 1)),
            lambda k: F.get("words", F.floor(k * F.size("words") / depths).cast("int"))).alias("bounds")).scalar()
        return _searched(df, bounds, F.col(col), depths).drop("__bounds")

    return add


def _bucketed(df: DataFrame, bucket: Bucket) -> DataFrame:
    return df.withColumn(BUCKET, _never_null(df, bucket)) if isinstance(bucket, Column) else bucket(df)


def _never_null(df: DataFrame, bucket: Column) -> Column:
    """The bucket with nulls as the smallest one (where null keys are sorted).

    A join on a nullable bucket would filter only one of its sides below the
    input's aggregation, and the sides could no longer share its shuffle.
    """
    kind = df.select(bucket.alias(BUCKET)).schema[BUCKET].dataType
    return F.coalesce(bucket, F.lit("" if kind.simpleString() == "string" else -(1 << 62)).cast(kind))


def running_sum(
    df: DataFrame,
    order_cols: Sequence[str | Column],
    values: dict[str, Column | str],
    bucket: Bucket,
    partition_cols: Sequence[str] = (),
    exclusive: bool = False,
    totals: dict[str, str] | None = None,
) -> DataFrame:
    """Add running sums of ``values`` along ``order_cols`` (ascending) per ``partition_cols``.

    ``order_cols`` must be a total order inside each partition key (ties would
    make the running sums depend on row arrival order).  ``exclusive`` sums
    the rows strictly before the current one.  ``totals`` names columns for the
    whole sum of a value over its partition key, which the offsets know anyway.
    """
    pcols, totals = list(partition_cols), totals or {}
    vals = {name: as_col(v) for name, v in values.items()}
    d = _bucketed(df, bucket)
    sums = d.groupBy(*pcols, BUCKET).agg(*[F.sum(v).alias(f"__tot_{n}") for n, v in vals.items()])
    whole = Window.partitionBy(*pcols)
    before = whole.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        *pcols, BUCKET, *[F.coalesce(F.sum(f"__tot_{n}").over(before), F.lit(0)).alias(f"__off_{n}") for n in vals],
        *[F.sum(f"__tot_{n}").over(whole).alias(out) for n, out in totals.items()],
    )
    run = Window.partitionBy(*pcols, BUCKET).orderBy(*order_cols).rowsBetween(
        Window.unboundedPreceding, -1 if exclusive else Window.currentRow)
    local = d.select("*", *[F.coalesce(F.sum(v).over(run), F.lit(0)).alias(f"__loc_{n}") for n, v in vals.items()])
    out = local.join(offsets, [*pcols, BUCKET])
    return out.select(
        *df.columns, *totals.values(), *[(F.col(f"__off_{n}") + F.col(f"__loc_{n}")).alias(n) for n in vals])


def row_number(
    df: DataFrame,
    order_cols: Sequence[str | Column],
    bucket: Bucket,
    name: str = "row_number",
    partition_cols: Sequence[str] = (),
) -> DataFrame:
    """1-based row number along a total order, computed with ``running_sum``."""
    return running_sum(df, order_cols, {name: F.lit(1)}, bucket, partition_cols)


def grouped_row_number(
    df: DataFrame,
    group: Column,
    order_cols: Sequence[str | Column],
    bucket: Bucket,
    name: str = "row_number",
    partition_cols: Sequence[str] = (),
) -> DataFrame:
    """1-based row number by (``group``, ``order_cols``), for a group column with few distinct values.

    The number is the count of smaller groups plus the row number inside the
    group, so neither depends on a packed key that could overflow.
    """
    pcols = list(partition_cols)
    d = df.withColumn("__group", group)
    within = row_number(d, order_cols, bucket, "__within", [*pcols, "__group"])
    sizes = d.groupBy(*pcols, "__group").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*pcols).orderBy("__group").rowsBetween(Window.unboundedPreceding, -1)
    smaller = sizes.select(*pcols, "__group", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__smaller"))
    return within.join(smaller, [*pcols, "__group"]).select(
        *df.columns, (F.col("__smaller") + F.col("__within")).alias(name))


def previous_value(df: DataFrame, col: str, bucket: Bucket, name: str) -> DataFrame:
    """Add the next smaller value of a column of distinct values (null for the smallest one)."""
    d = _bucketed(df, bucket)
    # the largest value with its row: a branch that needs the value alone would be made and shuffled by itself
    largest = d.groupBy(BUCKET).agg(F.max(F.struct(col, *[c for c in df.columns if c != col]))[col].alias("__max"))
    below = largest.select(BUCKET, F.max("__max").over(
        Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)).alias("__below"))
    local = d.withColumn("__prev", F.lag(col).over(Window.partitionBy(BUCKET).orderBy(col)))
    return local.join(below, BUCKET).select(*df.columns, F.coalesce("__prev", "__below").alias(name))
