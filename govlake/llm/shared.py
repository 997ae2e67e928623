"""Helpers the operators share: tables, the shared folder, names that clash with nothing."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from govlake.session import prepare_checkpoints, shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage: the rows are written once to the folder named in spark.checkpoint.dir, so
    a lost executor costs a reread instead of a recomputation."""
    prepare_checkpoints(df.sparkSession)
    return df.checkpoint()


def folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder that driver and executors both reach."""
    return shared_folder(spark, purpose)


def partitions(spark: SparkSession) -> int:
    """How many parts explicit range partitionings make: the session's shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def unused(taken: Iterable[str], base: str) -> str:
    """A column name that none of `taken` equals, whatever their case."""
    low = {c.lower() for c in taken}
    return base if base.lower() not in low else f"{base}_{uuid.uuid4().hex[:8]}"


def ship(spark: SparkSession) -> None:
    """Send this package's source to the Python workers, once per context, for sessions that were
    started without it in their path."""
    sc = spark.sparkContext
    if getattr(sc, "_govlake_shipped", False):
        return
    source = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="govlake-src-")) / "govlake-source.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted(source.rglob("*.py")):
            z.write(p, p.relative_to(source.parent))
    sc.addPyFile(str(archive))
    sc._govlake_shipped = True
