"""Incremental file ingest with Structured Streaming.

``readStream`` over a folder of files -> append to a table folder, with a
checkpoint that records which files were taken, so a rerun only picks up new
files (exactly-once into the file sink). ``availableNow`` processes what is
there and stops, which is how a scheduled raw-to-table job runs. CSV files are
taken by their headers (``by_name``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .by_name import RESCUE_COL, ingest_csv, stream_source


def ingest_stream(spark: SparkSession, source: str, schema: StructType | None, target: str, checkpoint: str,
                  fmt: str = "csv", options: dict | None = None, glob: str | None = None,
                  rescue: bool = False, with_file_name: bool = False) -> DataFrame:
    """Append every not-yet-seen file under ``source`` (a folder, or one file) to the table at ``target``.

    CSV fields go to the column that their file's header names; without a ``schema``
    its types are inferred (``ingest_csv``). ``rescue=True`` (CSV) adds
    ``_rescued_data``: the fields that don't parse or have no column, as a JSON
    object of name and text; NULL for rows without any. ``with_file_name`` adds
    ``source_file`` (the input file name). Returns the target table read back (batch).
    """
    if fmt == "csv":
        return ingest_csv(spark, source, target, checkpoint, schema, options, glob, rescue=rescue, with_file_name=with_file_name)
    folder, name = stream_source(spark, source)
    reader = spark.readStream.format(fmt).options(**(options or {}))
    if glob or name:
        reader = reader.option("pathGlobFilter", glob or name)
    stream = reader.schema(schema).load(folder)
    if with_file_name:
        stream = stream.withColumn("source_file", F.col("_metadata.file_name"))
    query = (
        stream.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.parquet(target)


def rescued_by_file(table: DataFrame, file_col: str = "source_file") -> DataFrame:
    """Rows carrying a rescued record, per source file."""
    return table.groupBy(file_col).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(RESCUE_COL).alias("rescued_rows"),
    )
