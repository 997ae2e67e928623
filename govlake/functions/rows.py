"""Literal relations: a few driver-side rows as a local relation the optimizer can fold."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_TYPES = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}


def literal(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """Rows with a `name type, ...` schema. For design constants, never for data."""
    fields = [part.split() for part in schema.split(",")]
    columns = list(zip(*rows)) or [()] * len(fields)
    return spark.createDataFrame(pa.table(
        {name: pa.array(column, _TYPES[kind]) for (name, kind), column in zip(fields, columns)}))
