"""Chunked ingest: land new extract files into the raw table as they arrive."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from farelens.schemas import EXTRACT_COLUMNS, text_schema
from farelens.sources.extracts import BLANK, CORRUPT, FILE, as_landing


def land_new_files(
    spark: SparkSession,
    folder: str,
    raw_table: str,
    checkpoint: str,
    files_per_chunk: int = 1000,
    columns: list[str] = EXTRACT_COLUMNS,
) -> StreamingQuery:
    """Append every file not landed before, chunk by chunk, then stop.

    The checkpoint records the files done and the sink commits each chunk once, so a job that
    lost its executors, or is started again, neither skips nor repeats a file. A malformed line is kept
    whole in ``corrupt_record``. Extracts without an id are landed one folder per chunk, which a chunk
    that runs again overwrites: their ids need all records of a file together.
    """
    arriving = (
        spark.readStream.schema(text_schema(columns).add(CORRUPT, T.StringType()))
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("nullValue", BLANK)
        .option("escape", '"')
        .option("columnPruning", False)
        .option("maxFilesPerTrigger", files_per_chunk)
        .csv(folder)
        .withColumn(FILE, F.col("_metadata.file_path"))
    )
    if "transaction_id" in columns:
        writer = as_landing(arriving).writeStream.format("parquet").option("path", raw_table)
    else:
        writer = arriving.writeStream.foreachBatch(
            lambda chunk, number: as_landing(chunk).write.mode("overwrite").parquet(f"{raw_table}/chunk={number}")
        )
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
