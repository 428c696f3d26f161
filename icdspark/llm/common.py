"""Helpers shared by the operators: tables, the shared work folder, checks."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from icdspark.session import shared_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_folder(spark: SparkSession) -> str:
    """A new folder under the shared ``spark.checkpoint.dir`` of the session.

    Only a ``local`` session may leave the setting out; it then gets a private
    folder (the setting stays as it is).  On a cluster a machine-local folder
    would be invisible to the other machines, so that is an error.
    """
    return shared_path(spark, f"llm-{uuid.uuid4().hex}")


def stored(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation.
    """
    path = f"{folder}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _let_workers_import(spark: SparkSession) -> None:
    """Put the folder that the driver has this package from on the Python workers' path.

    Enough where machines share that folder (a local session among them);
    elsewhere the package is given to the cluster as usual (``--py-files``).
    """
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if root not in known.split(":"):
        environment["PYTHONPATH"] = f"{root}:{known}".rstrip(":")


def need_columns(df: DataFrame, *names: str) -> None:
    """Raise if ``df`` lacks a column.  Every operator starts here, before any of its functions is sent to workers."""
    _let_workers_import(df.sparkSession)
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; the table has {df.columns}")


def free_name(df: DataFrame, stem: str) -> str:
    """A column name starting with ``stem`` that ``df`` doesn't use (any case)."""
    used = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in used:
        name += "_"
    return name


#: Rows that a task holds as Python objects at a time; texts can be long.
SLICE_ROWS = 512
#: Rows that Spark sends to a Python worker at once, where the session leaves this at Spark's own default.
BATCH_CONF, BATCH_DEFAULT, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "1024"


def struct_of(**fields: pa.DataType) -> pa.DataType:
    return pa.struct(list(fields.items()))


def _ddl(kind: pa.DataType) -> str:
    if pa.types.is_list(kind):
        return f"array<{_ddl(kind.value_type)}>"
    if pa.types.is_struct(kind):
        return "struct<" + ",".join(f"{f.name}:{_ddl(f.type)}" for f in kind) + ">"
    return {"int64": "bigint", "int32": "int", "double": "double", "string": "string", "bool": "boolean"}[str(kind)]


def map_rows(df: DataFrame, keep: Mapping[str, Column], inputs: Sequence[Column | str], fields: Mapping[str, pa.DataType],
             compute: Callable[..., list[tuple]], slice_rows: int = SLICE_ROWS,
             done: Callable[[], None] | None = None) -> DataFrame:
    """One row per row of ``df``: the columns ``keep`` as they are, then what ``compute`` makes of ``inputs``.

    ``compute`` gets one list for each input (a column, or the name of one in
    ``keep``), for a slice of the rows, and returns a tuple of ``fields`` for
    each row.  Only slices of the inputs are turned into Python objects, so a
    task's memory doesn't grow with Spark's batch size, and a session that has
    the default batch size gets a smaller one: whole texts are large rows.
    ``done`` is called after a task's last row, to let go of what it has kept.
    """
    if df.sparkSession.conf.get(BATCH_CONF) == BATCH_DEFAULT:
        df.sparkSession.conf.set(BATCH_CONF, BATCH_ROWS)
    n_keep, names = len(keep), [*keep, *fields]
    own = [c for c in inputs if not isinstance(c, str)]
    numbers = iter(range(n_keep, n_keep + len(own)))
    places = [names.index(c) if isinstance(c, str) else next(numbers) for c in inputs]

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, slice_rows):
                batch = whole.slice(start, slice_rows)
                given = [batch.column(i).to_pylist() for i in places]
                made = zip(*compute(*given), strict=True)
                arrays = [pa.array(v, kind) for v, kind in zip(made, fields.values(), strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:n_keep], *arrays], names=names)
        if done:
            done()

    chosen = df.select(*(c.alias(n) for n, c in keep.items()), *(c.alias(f"input_{i}_") for i, c in enumerate(own)))
    kept = [T.StructField(f.name, f.dataType) for f in chosen.schema.fields[:n_keep]]
    made = T.StructType.fromDDL(", ".join(f"`{n}` {_ddl(k)}" for n, k in fields.items()))
    return chosen.mapInArrow(mapped, T.StructType(kept + made.fields))


def columns_of(df: DataFrame, *without: str) -> dict[str, Column]:
    """All columns of ``df`` by name, but for some: what ``map_rows`` is to keep."""
    return {c: df[f"`{c}`"] for c in df.columns if c not in without}
