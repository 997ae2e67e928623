"""Landing files in, and files out. Bronze text is never typed by inference."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from govlake.functions.values import as_time

RESCUED = "_rescued_data"


def read_csv_all_string(spark: SparkSession, path: str, columns: Sequence[str],
                        ingested_at: str | None = None, multi_line: bool = False) -> DataFrame:
    """CSV with a header: every column a string, an empty field NULL. A quote inside a quoted field
    is doubled, and a backslash is a character like any other.

    `multi_line` reads quoted line breaks; a file is then one task, so land many files. Without it
    files are split and each line is a record.

    A line that does not fit the columns keeps its good prefix and puts the whole raw line in
    `_rescued_data`. Names come from the caller and are checked against the header.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*columns, RESCUED)])
    return (spark.read.schema(schema)
            .option("header", True).option("mode", "PERMISSIVE").option("enforceSchema", False)
            .option("columnNameOfCorruptRecord", RESCUED)
            # a reader of few columns would not notice a line with too many fields
            .option("columnPruning", False)
            .option("quote", '"').option("escape", '"').option("multiLine", multi_line)
            .csv(path)
            .withColumn("_ingested_at", as_time(ingested_at)))


def header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV, from its first line."""
    return spark.read.option("header", True).csv(path).columns


def list_landing(spark: SparkSession, path: str) -> DataFrame:
    """Files of a landing folder with their byte counts; contents are not read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
            .select(F.col("path"), F.col("length").alias("bytes"),
                    F.col("modificationTime").alias("modified_at")))


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, one file per partition; blanks around a value are kept. An empty text
    and a NULL are both read back as NULL."""
    (df.write.mode("overwrite").option("header", True)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .option("quote", '"').option("escape", '"').option("escapeQuotes", True)
     .csv(path))
