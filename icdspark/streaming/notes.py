"""Incremental note cleaning: new note files in, tokenised notes out."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from icdspark.operators.cohort import load_notes, tokenize_notes
from icdspark.session import checkpoint_dir


def stream_tokenized_notes(
    spark: SparkSession, path: str, schema: str, fmt: str = "parquet", max_files_per_trigger: int | None = None
) -> DataFrame:
    """A streaming DataFrame of discharge notes, cleaned and tokenised (a06 + c01 + c05 + c06).

    Every operator involved is stateless, so the stream needs no watermark and
    keeps no state between micro-batches.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return tokenize_notes(load_notes(reader.load(path)))


def write_stream(df: DataFrame, out_path: str, name: str, fmt: str = "parquet", once: bool = True) -> StreamingQuery:
    """Append the stream to ``out_path``; the query checkpoint lives in the shared folder."""
    ckpt = os.path.join(checkpoint_dir(df.sparkSession), "streams", name)
    writer = df.writeStream.format(fmt).option("checkpointLocation", ckpt).outputMode("append")
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start(out_path)
