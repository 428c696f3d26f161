"""File sources and sinks (CSV bronze ingest, Parquet, word-vector files)."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from icdspark.functions.text import join_vector, split_whitespace

# Fixed value: a view name is the last word-character run of the path, before an
# optional ".csv" suffix; without one the whole path is the name.
_VIEW_NAME = re.compile(r"(\w+)(\.csv)?$")


def infer_view_name(path: str) -> str:
    """a03: view name from a path ('data/DIAGNOSES_ICD.csv' -> 'DIAGNOSES_ICD')."""
    m = _VIEW_NAME.search(path)
    return m.group(1) if m else path


def read_csv_table(
    spark: SparkSession,
    path: str,
    view_name: str | None = None,
    schema: T.StructType | str | None = None,
    register: bool = True,
) -> DataFrame:
    """a01/a02/a03: CSV with header, quoted multi-line fields, ``"`` escaping ``"``.

    Without a schema every column is read as string (no inference pass over the
    data); pass an explicit schema to skip header-driven typing entirely.
    """
    reader = (
        spark.read.option("header", "true")
        .option("multiLine", "true")
        .option("escape", '"')
        .option("sep", ",")
    )
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.csv(path)
    if register:
        df.createOrReplaceTempView(view_name or infer_view_name(path))
    return df


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: list[str] | None = None,
    single_file: bool = False,
    mode: str = "overwrite",
) -> None:
    """a07/a15: write a table; Parquet by default, CSV with header on request.

    ``single_file=True`` reproduces one-part CSV exports via ``coalesce(1)``;
    it funnels the data through one task, so use it only for small outputs.
    """
    out = df.coalesce(1) if single_file else df
    writer = out.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        # spaces at either end belong to the value
        spaces = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
        writer.options(header="true", escape='"', **spaces).csv(path)
    else:
        writer.format(fmt).save(path)


def write_word_vectors(vectors: DataFrame, path: str, single_file: bool = False) -> None:
    """a08: ``word,vector`` CSV with the vector as space-joined numbers."""
    vec = F.col("vector")
    if isinstance(vectors.schema["vector"].dataType, T.ArrayType):
        arr = vec.cast("array<double>")
    else:
        from pyspark.ml.functions import vector_to_array

        arr = vector_to_array(vec)
    write_table(
        vectors.select("word", join_vector(arr).alias("vector")), path, fmt="csv", single_file=single_file
    )


def read_word_vectors(spark: SparkSession, path: str) -> DataFrame:
    """a09: read a ``word,vector`` CSV back to ``(word, vector array<double>)``."""
    df = read_csv_table(spark, path, schema="word string, vector string", register=False)
    return df.select("word", F.split("vector", " ").cast("array<double>").alias("vector"))


def read_label_list(spark: SparkSession, path: str, with_frequency: bool = False) -> DataFrame:
    """a12: headerless code list (CRLF tolerated); codes stay strings ('250.00')."""
    schema = "label string, frequency long" if with_frequency else "label string"
    df = spark.read.schema(schema).option("header", "false").csv(path)
    df = df.withColumn("label", F.regexp_replace("label", r"\r$", ""))
    return df.filter(F.col("label").isNotNull())


def read_code_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """a13: description CSV with header: pos (file order), code = 2nd field, description = last field.

    A multi-line CSV file is read by one task in file order, so the rising ids
    are its row order; files of a folder follow each other by name.
    """
    df = read_csv_table(spark, path, register=False)
    cols = df.columns
    return df.select(file_position().alias("pos"), F.col(cols[1]).alias("code"), F.col(cols[-1]).alias("description"))


def file_position() -> Column:
    """Where a row stands in a folder of files: ``file`` (its path), then ``row``, which rises along the file.

    Spark deals files out by size, so rising ids alone would follow that.
    """
    return F.struct(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("row"))


def read_text_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """a14: whitespace text dictionary: pos, first token = code, rest joined by one space."""
    lines = spark.read.text(path)
    return parse_text_dictionary(lines.select(file_position().alias("pos"), F.col("value").alias("line")))


def parse_text_dictionary(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """``pos, code, description`` of lines with at least one token; ``pos`` is passed through."""
    parts = split_whitespace(line_col)
    return lines.select("pos", parts.alias("_p")).filter(F.size("_p") > 0).select(
        "pos", F.col("_p")[0].alias("code"), F.array_join(F.slice("_p", 2, 1 << 30), " ").alias("description"))


def write_splits(split_df: DataFrame, path: str, splits: Sequence[str] = ("train", "val", "test")) -> None:
    """a07: one CSV table ``<split>_split.csv`` per split with the labelled columns."""
    for name in splits:
        rows = split_df.filter(F.col("split") == name).select("subject_id", "hadm_id", "text", "labels")
        write_table(rows, f"{path}/{name}_split.csv", fmt="csv")


def read_splits(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """a11: read the labelled splits back.

    Parquet: one table partitioned by ``split`` (a filter on ``split`` prunes
    partitions).  CSV: a folder with one ``<split>_split.csv`` per split, read
    with the labelled schema; the split name comes from the file name.
    """
    if fmt == "parquet":
        return spark.read.parquet(path)
    from icdspark.sources.schemas import LABELLED

    df = read_csv_table(spark, f"{path}/*_split.csv", schema=LABELLED, register=False)
    name = F.regexp_extract(F.col("_metadata.file_path"), r"([A-Za-z]+)_split\.csv", 1)
    return df.withColumn("split", name)
