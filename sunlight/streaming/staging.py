from __future__ import annotations

import os
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from sunlight.plans.columns import RAW, DeclarationColumns
from sunlight.plans.declarations import stg_declarations

_BAD = "_rejected_record"


def declaration_schema(columns: Sequence[str]) -> T.StructType:
    """All-text schema for the declaration files (streams need it up front)."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def _records(spark: SparkSession, source_dir: str, columns: Sequence[str], sep: str, encoding: str, multi_line: bool,
             max_files_per_trigger: int | None) -> DataFrame:
    """The batch reader's rules on a file stream: RFC 4180 quoting, line breaks in fields, records that do not
    fit in a column of their own; a file with another header stops the stream."""
    reader = (spark.readStream
              .schema(declaration_schema([*columns, _BAD]))
              .option("header", True).option("enforceSchema", False)
              .option("sep", sep).option("encoding", encoding)
              .option("quote", '"').option("escape", '"').option("multiLine", multi_line)
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _BAD)
              .option("columnPruning", False))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(source_dir)


def _bad(columns: Sequence[str]) -> Column:
    """Not null for a rejected record. Names a data column too: a scan of the record column alone is refused."""
    return F.concat(F.col(_BAD), F.coalesce(F.col(f"`{columns[0]}`"), F.lit("")))


def _start(df: DataFrame, out_dir: str, checkpoint: str | None, available_now: bool) -> StreamingQuery:
    if checkpoint is None:
        checkpoint = os.path.join(out_dir, "_checkpoint")
    writer = (df.writeStream.format("parquet").option("path", out_dir)
              .option("checkpointLocation", checkpoint).outputMode("append"))
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")).start()


def start_staging_stream(spark: SparkSession, source_dir: str, out_dir: str,
                         columns: Sequence[str], sep: str = ",",
                         cols: DeclarationColumns = RAW, available_now: bool = True,
                         checkpoint: str | None = None,
                         max_files_per_trigger: int | None = None, encoding: str = "UTF-8",
                         multi_line: bool = True) -> StreamingQuery:
    """Stream CSV declaration files from ``source_dir`` into a Parquet
    staging table at ``out_dir``: the rows that the batch reader and the staging step give.

    ``columns`` must be the header of every file: a file with another one stops the stream
    rather than shift its columns. Records with another number of fields are left
    out here; ``start_rejected_stream`` stores them.

    Progress (which files were consumed) lives in ``checkpoint``, by default
    ``_checkpoint`` inside ``out_dir`` (readers skip names with an underscore), so
    each output has its own and a restarted job - or one whose executors were
    lost - resumes without duplicating rows (the file sink commits each batch
    atomically). ``available_now``
    processes what is there and stops; otherwise it keeps polling.
    """
    read = _records(spark, source_dir, columns, sep, encoding, multi_line, max_files_per_trigger)
    return _start(stg_declarations(read.where(_bad(columns).isNull()).drop(_BAD), cols), out_dir, checkpoint, available_now)


def start_rejected_stream(spark: SparkSession, source_dir: str, out_dir: str, columns: Sequence[str], sep: str = ",",
                          available_now: bool = True, checkpoint: str | None = None,
                          max_files_per_trigger: int | None = None, encoding: str = "UTF-8",
                          multi_line: bool = True) -> StreamingQuery:
    """Stream the records that do not fit the header, with their file, to a Parquet table at ``out_dir``."""
    read = _records(spark, source_dir, columns, sep, encoding, multi_line, max_files_per_trigger)
    bad = read.where(_bad(columns).isNotNull()).select(F.col("_metadata.file_path").alias("file"), F.col(_BAD).alias("record"))
    return _start(bad, out_dir, checkpoint, available_now)
