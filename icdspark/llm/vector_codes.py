"""Vector code compression: product codes from active-entry Lloyd rounds over written state.

Each vector is scaled to integers and cut into equal parts; each part position
has a codebook of a few entries.  A round updates the codebooks from the parts
that each entry holds and assigns the parts again.  A part whose entry didn't
move still has its exact distance, so it meets only the entries that did move;
the other parts rescan their whole codebook.  Ties go to the lower index, in
either case, so the result is the plain algorithm's, to the last digit.

Spark holds the vectors: a round is one scan of the state table (integers,
codes, distances) that writes the next one, each task adding one row with the
sums of its parts.  The driver sees only such sums and the codebooks, whose size
depends on the number of entries and dimensions alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from icdspark.llm.common import need_columns, stored, work_folder
from icdspark.session import delete_path

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Differences (rows x entries x dimensions of a part) that a task holds at a time.
SLICE_CELLS = 1 << 21
#: The largest value of a long, which a label's summed error saturates at.
LONG_MAX = (1 << 63) - 1

_STATE = "vec_id {id}, label {label}, q array<int>, codes binary, distances array<bigint>, sums array<bigint>"
_FINAL = "vec_id {id}, label {label}, codes binary, error bigint"


def largest_component(width: int, parts: int) -> int:
    """Integers saturate here, so that no distance or error of a vector overflows a long."""
    return isqrt((1 << 62) // max(1, width * parts)) // 2


def to_integers(values: np.ndarray, scale: int, limit: int) -> np.ndarray:
    """floor(scale * x), saturated at +-limit."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(values * scale), -limit, limit).astype(np.int64)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """A list column as a matrix, short rows filled up with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == dims).all():
        return flat.reshape(len(column), dims)
    out = np.zeros((len(column), dims), flat.dtype)
    out[np.arange(dims) < sizes[:, None]] = flat
    return out


def _nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each part the nearest of ``entries`` (the first of equals) and its squared distance."""
    gaps = parts[:, None, :] - entries[None]
    squares = np.einsum("nkw,nkw->nk", gaps, gaps)
    best = squares.argmin(1)
    return best, squares[np.arange(len(parts)), best]


def assign(q: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes and exact distances by a whole scan of each part's codebook.  ``q``: rows x parts x width."""
    codes, distances = np.zeros(q.shape[:2], np.int64), np.zeros(q.shape[:2], np.int64)
    for p, book in enumerate(books):
        codes[:, p], distances[:, p] = _nearest(q[:, p], book)
    return codes, distances


def reassign(q: np.ndarray, books: np.ndarray, moved: np.ndarray, codes: np.ndarray, distances: np.ndarray) -> None:
    """Bring codes and distances up to date, in place, after the entries ``moved`` (parts x entries) have moved.

    An entry that stayed is as far as it was, and lost then against the part's
    own entry by distance or by index; only moved ones can beat the stored distance.
    """
    for p, book in enumerate(books):
        active = np.flatnonzero(moved[p])
        if not len(active):
            continue
        rescan = moved[p][codes[:, p]]
        if rescan.any():
            codes[rescan, p], distances[rescan, p] = _nearest(q[rescan, p], book)
        stay = np.flatnonzero(~rescan)
        if len(stay):
            found, squares = _nearest(q[stay, p], book[active])
            entry, old, own = active[found], distances[stay, p], codes[stay, p]
            better = (squares < old) | ((squares == old) & (entry < own))
            codes[stay[better], p], distances[stay[better], p] = entry[better], squares[better]


def _add_up(total: np.ndarray, q: np.ndarray, codes: np.ndarray) -> None:
    """Add counts (first) and sums of the parts that each entry holds to ``total``: parts x entries x (1 + width)."""
    held = np.arange(total.shape[1])
    for p in range(q.shape[1]):
        one = (codes[:, p, None] == held).astype(np.int64)
        total[p, :, 0] += one.sum(0)
        total[p, :, 1:] += one.T @ q[:, p]


def moved_entries(books: np.ndarray, total: np.ndarray) -> np.ndarray:
    """The next codebooks: componentwise floor(sum / count); unused entries stay."""
    counts = total[:, :, :1]
    return np.where(counts > 0, total[:, :, 1:] // np.maximum(counts, 1), books)


def _codes_array(codes: np.ndarray) -> pa.Array:
    """Codes as one byte each, a binary value a row."""
    rows, parts = codes.shape
    ends = np.arange(rows + 1, dtype=np.int32) * parts
    return pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer(ends), pa.py_buffer(codes.astype(np.uint8).tobytes())])


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    rows, size = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1) * size, pa.int32()), pa.array(values.reshape(-1), kind))


def _round(books: np.ndarray, moved: np.ndarray | None, first: tuple[int, int] | None, last: bool):
    """One round over Arrow batches of vectors (``first``: scale and limit) or of the state."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, entries, 1 + width), np.int64)
        rows, schema = max(1, SLICE_CELLS // max(1, entries * width)), None
        for whole in batches:
            for start in range(0, whole.num_rows, rows):
                batch = whole.slice(start, rows)
                schema, n = batch.schema, batch.num_rows
                q = _matrix(batch.column(2), parts * width)
                q = (to_integers(q, *first) if first else q.astype(np.int64)).reshape(n, parts, width)
                if first:
                    codes, distances = assign(q, books)
                else:
                    codes = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8).reshape(n, parts).astype(np.int64)
                    distances = _matrix(batch.column(4), parts).copy()
                    reassign(q, books, moved, codes, distances)
                if last:
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0), batch.column(1), _codes_array(codes), pa.array(distances.sum(1))],
                        names=["vec_id", "label", "codes", "error"])
                    continue
                _add_up(total, q, codes)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), _lists(q.reshape(n, -1), pa.int32()), _codes_array(codes),
                     _lists(distances, pa.int64()), pa.nulls(n, pa.list_(pa.int64()))],
                    names=["vec_id", "label", "q", "codes", "distances", "sums"])
        if not last and schema is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, schema.field(0).type), pa.nulls(1, schema.field(1).type), pa.nulls(1, pa.list_(pa.int32())),
                 pa.nulls(1, pa.binary()), pa.nulls(1, pa.list_(pa.int64())), _lists(total.reshape(1, -1), pa.int64())],
                names=["vec_id", "label", "q", "codes", "distances", "sums"])

    return run


def _summed(state: DataFrame, shape: tuple[int, int, int]) -> np.ndarray:
    """The tasks' rows of sums added up: parts x entries x (1 + width) numbers, whatever the rows of the table."""
    cells = state.filter(F.col("sums").isNotNull()).select(F.posexplode("sums").alias("at", "x"))
    total = np.zeros(np.prod(shape, dtype=np.int64), np.int64)
    for row in cells.groupBy("at").agg(F.sum("x").alias("x")).collect():
        total[row["at"]] = row["x"]
    return total.reshape(shape)


def usable(vectors: DataFrame, vector_col: str = "embedding") -> DataFrame:
    """Rows whose vector is there and holds finite numbers only."""
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.filter(F.coalesce(F.col(vector_col).isNotNull() & finite, F.lit(False)))


def compress(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, label, codes binary, error`` of each usable vector, and the final codebooks.

    The codebooks (parts x entries x width integers) start as the parts of the
    ``entries`` vectors with the smallest ids (nulls last, equal ids by their
    vectors).  Defined results: rows with a null vector, or a null, NaN or
    infinite component, are dropped; vectors shorter than the longest, and
    lengths that don't divide, are filled up with zeros at the end; repeated rows
    count as often as they occur; fewer vectors than entries give fewer
    entries; an empty table gives no rows and empty codebooks; integers saturate
    where a long couldn't hold the error of a vector (at 2^27 for 64 dimensions).
    """
    need_columns(vectors, id_col, vector_col, label_col)
    spark = vectors.sparkSession
    given = usable(vectors.select(
        F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("vector")), "vector")
    kinds = {"id": given.schema["vec_id"].dataType.simpleString(), "label": given.schema["label"].dataType.simpleString()}
    starts = [r["vector"] for r in given.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).collect()]
    if not starts:
        return spark.createDataFrame([], _FINAL.format(**kinds)), np.zeros((parts, 0, 0), np.int64)
    longest = given.agg(F.max(F.size("vector")).alias("n")).first()["n"]
    width = -(-longest // parts)
    limit = largest_component(width, parts)
    first = np.zeros((len(starts), parts * width))
    for row, vector in enumerate(starts):
        first[row, : len(vector)] = vector
    books = to_integers(first, scale, limit).reshape(-1, parts, width).transpose(1, 0, 2).copy()
    folder, state, moved = work_folder(spark), None, np.ones(books.shape[:2], bool)
    for k in range(rounds):
        if moved.any():  # else the codebooks stand still, and so do all later rounds
            work = _round(books, moved, None if k else (scale, limit), False)
            done = (given if state is None else _held(state)).mapInArrow(work, _STATE.format(**kinds))
            state = stored(done, folder, f"round{k}")
            if k:
                delete_path(spark, f"{folder}/round{k - 1}")
            new = moved_entries(books, _summed(state, (parts, books.shape[1], 1 + width)))
            moved, books = (new != books).any(2), new
    if state is None:
        work, source = _round(books, None, (scale, limit), True), given
    else:
        work, source = _round(books, moved, None, True), _held(state)
    return stored(source.mapInArrow(work, _FINAL.format(**kinds)), folder, "codes"), books


def _held(state: DataFrame) -> DataFrame:
    return state.filter(F.col("sums").isNull()).drop("sums")


def label_errors(coded: DataFrame) -> DataFrame:
    """``label, label_error``: the error summed over equal labels (nulls together), saturated at a long's largest value."""
    total = F.sum(F.col("error").cast("decimal(19,0)")).cast("decimal(38,0)")
    return coded.groupBy("label").agg(F.least(total, F.lit(LONG_MAX).cast("decimal(38,0)")).cast("bigint").alias("label_error"))


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of all entries' integers by part, entry and position, comma-joined, in hex."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def decompress(coded: DataFrame, books: np.ndarray, scale: int = SCALE) -> DataFrame:
    """Add ``vector array<double>``: what the codes stand for (entry / scale, part after part; filled-up zeros included)."""
    table = F.lit([[(entry / scale).tolist() for entry in book] for book in books]) if books.size else F.lit(None).cast("array<array<array<double>>>")
    byte = lambda p: F.conv(F.hex(F.substring("codes", p + 1, 1)), 16, 10).cast("int")
    return coded.withColumn("vector", F.concat(*(F.get(F.get(table, F.lit(p)), byte(p)) for p in range(len(books)))))


def report(vectors: DataFrame) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` with the standard parameters."""
    coded, books = compress(vectors)
    sums = stored(label_errors(coded), work_folder(coded.sparkSession), "labels").withColumnRenamed("label", "label_")
    return coded.join(sums, F.col("label").eqNullSafe(F.col("label_"))).select(
        "vec_id", F.lower(F.hex("codes")).alias("code"), "error", "label_error",
        F.lit(books_digest(books)).alias("codebooks_sha256"))
