"""Raw CSV exports, read as they are."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lakemart.sources.schemas import BRONZE, limit_text

# A field without quotes and without characters is NULL, a quoted empty one is empty text.
# The marker is a character that text fields cannot hold, so no value reads as NULL.
_NO_NULL_TEXT = "\u0000"


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, delimiter: str = ",",
    multi_line: bool = False, null_text: str = _NO_NULL_TEXT,
) -> DataFrame:
    """Read one export strictly: header skipped, any bad row fails the job, whichever columns are read.

    Files stay splittable unless ``multi_line`` is needed for quoted line breaks.
    ``null_text`` is what stands for NULL besides an empty field without quotes.
    """
    rows = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", True)
        .option("sep", delimiter)
        .option("quote", '"')
        .option("escape", '"')
        .option("nullValue", null_text)
        .option("mode", "FAILFAST")
        .option("multiLine", multi_line)
        .option("columnPruning", False)
        .csv(path)
    )
    return limit_text(rows)


def write_csv(df: DataFrame, path: str, delimiter: str = ",") -> None:
    """Write in the form ``read_csv`` reads: header, blanks kept, NULL bare, empty text quoted."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("sep", delimiter)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def default_file(table: str) -> str:
    """``<system>_<entity>`` lies in ``source_<system>``; ERP exports have upper-case names."""
    system, entity = table.split("_", 1)
    return f"source_{system}/{entity.upper() if system == 'erp' else entity}.csv"


def read_exports(
    spark: SparkSession, base: str, files: Mapping[str, str] | None = None,
    tables: tuple[str, ...] = tuple(BRONZE), **options: str | bool,
) -> dict[str, DataFrame]:
    """The raw tables below ``base`` (any file system Spark reads); ``options`` are those of ``read_csv``."""
    files = files or {}
    return {
        table: read_csv(spark, f"{base.rstrip('/')}/{files.get(table, default_file(table))}", BRONZE[table], **options)
        for table in tables
    }
