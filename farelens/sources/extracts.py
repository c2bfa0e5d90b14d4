"""Readers for the text extracts. Every schema is declared; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelens.functions import text
from farelens.schemas import EXTRACT_COLUMNS, LINE_FILE_SCHEMA, RAW_COLUMNS, STATION_FILE_SCHEMA, text_schema

CORRUPT = "corrupt_record"
BLANK = "\u0000"  # stands for an unquoted empty field while a line is parsed

# Spark's CSV reader knows Latin-1 but not windows-1252. Both are one byte per character and differ
# only in these control characters, of which windows-1252 leaves five undefined.
_CONTROLS = "".join(
    chr(code) for code in range(0x80, 0xA0) if bytes([code]).decode("windows-1252", "ignore")
)
_WINDOWS = _CONTROLS.encode("latin-1").decode("windows-1252")


def read_raw_text(spark: SparkSession, path: str, columns: list[str] = EXTRACT_COLUMNS) -> DataFrame:
    """Extract files as text columns; a malformed line is kept whole in ``corrupt_record``.

    Column pruning stays off, because a pruned reader does not notice missing fields.

    The header must match ``columns``: mapping by position would silently swap fields. An unquoted
    empty field is blank and a quoted one is empty text; the marker keeps the reader from merging them.
    """
    schema = text_schema(columns).add(CORRUPT, T.StringType())
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("nullValue", BLANK)
        .option("escape", '"')
        .option("columnPruning", False)
        .csv(path)
    )


FILE = "source_file"


def as_landing(df: DataFrame) -> DataFrame:
    """Raw landing columns: row id, the payload verbatim, and the ingestion stamp.

    The extract's own id is carried when it has one; text that is no number leaves the id blank. Without
    an id column the id is a hash of the file, the record and, for records that repeat in a file, their
    number in it: the same file gives the same ids however often and in whatever splits it is read.
    """
    extra = [CORRUPT] if CORRUPT in df.columns else []
    if "transaction_id" in df.columns:
        numbered = df.withColumn("trx_id", F.col("transaction_id").try_cast("bigint"))
    else:
        # Rows alike are interchangeable: they are counted where they are read and numbered from the count, so a
        # record that repeats a million times is one row on its way.
        alike = df.groupBy(FILE, *RAW_COLUMNS, *extra).agg(F.count("*").cast("int").alias("copies"))
        record = [F.coalesce(F.col(name), F.lit(BLANK)) for name in [*RAW_COLUMNS, *extra]]
        digest = F.sha2(F.concat_ws("\u0001", F.col(FILE), *record), 256)
        numbered = alike.withColumns({"record": digest, "copy": F.explode(F.sequence(F.lit(1), F.col("copies")))})
        numbered = numbered.withColumn("trx_id", F.xxhash64("record", "copy"))
    return numbered.select("trx_id", *RAW_COLUMNS, *extra, F.current_timestamp().alias("ingested_at"))


def land_raw(spark: SparkSession, path: str, columns: list[str] = EXTRACT_COLUMNS) -> DataFrame:
    return as_landing(read_raw_text(spark, path, columns).withColumn(FILE, F.col("_metadata.file_path")))


def import_flat_extract(spark: SparkSession, path: str) -> DataFrame:
    """Typed import of the flat extract: date only, unquoted fields, two columns renamed."""
    rows = (
        spark.read.schema(text_schema(EXTRACT_COLUMNS))
        .option("header", True)
        .option("enforceSchema", False)
        .option("encoding", "iso-8859-1")
        .option("quote", "")
        .csv(path)
    )
    rows = rows.select(*[F.translate(name, _CONTROLS, _WINDOWS).alias(name) for name in EXTRACT_COLUMNS])
    return rows.withColumns(
        {
            "transaction_id": F.col("transaction_id").try_cast("bigint"),
            "Sta": F.col("Sta").try_cast("bigint"),
            "Dest": F.col("Dest").try_cast("bigint"),
            "Value": F.col("Value").try_cast("decimal(10,2)"),
            "InsertionDateTime": text.date_part("InsertionDateTime"),
        }
    ).withColumnsRenamed({"PrType": "Ticket Type", "station_name": "Station"})


def _dimension_file(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Line file with its target share of revenue."""
    return _dimension_file(spark, path, LINE_FILE_SCHEMA)


def read_stations(spark: SparkSession, path: str) -> DataFrame:
    """Station file: number, name, line and interchange flag."""
    return _dimension_file(spark, path, STATION_FILE_SCHEMA)
