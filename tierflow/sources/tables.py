"""Tables and folders in parquet and ORC, and the catalog statements on them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tierflow.schemas import raw_schema
from tierflow.specs import CleanSpec

#: Rows of a file, as a file of one row group is one task to its readers, whatever the split size.
FILE_ROWS = 250_000

#: How raw tables are written: text of which no one asks for a range, so without minima and maxima, and in a
#: codec that is smaller by a quarter than the default one and no slower here.
RAW_OPTIONS = {
    "compression": "zstd",
    "parquet.compression.codec.zstd.level": "1",
    "parquet.column.statistics.enabled": "false",
}


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_raw(spark: SparkSession, category: str, path: str) -> DataFrame:
    """Raw parquet with its fixed schema: an absent column reads as NULL, others are ignored."""
    return spark.read.schema(raw_schema(category)).parquet(path)


def read_silver(spark: SparkSession, spec: CleanSpec, path: str) -> DataFrame:
    return spark.read.schema(spec.silver_schema()).parquet(path)


def write_silver(df: DataFrame, path: str) -> None:
    """Files have ``FILE_ROWS`` rows at most."""
    df.write.mode("overwrite").option("maxRecordsPerFile", FILE_ROWS).parquet(path)


def write_raw(df: DataFrame, path: str) -> None:
    """A table of text, in files like those of ``write_silver``."""
    df.write.mode("overwrite").options(maxRecordsPerFile=FILE_ROWS, **RAW_OPTIONS).parquet(path)


def external_table(
    spark: SparkSession, name: str, schema: T.StructType, path: str, fmt: str = "parquet"
) -> DataFrame:
    """Register files at ``path`` under a name; an existing table of that name stays."""
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=path, source=fmt, schema=schema)
    return spark.table(name)


def save_table(
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    fmt: str = "orc",
    location: str | None = None,
) -> DataFrame:
    """Write a table and return it; without ``location`` it is managed by the warehouse."""
    writer = df.write.mode(mode).format(fmt)
    if location is not None:
        writer = writer.option("path", location)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def rename_table(spark: SparkSession, old: str, new: str, comment: str | None = None) -> DataFrame:
    spark.sql(f"ALTER TABLE {old} RENAME TO {new}")
    if comment is not None:
        text = comment.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"ALTER TABLE {new} SET TBLPROPERTIES ('comment' = '{text}')")
    return spark.table(new)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def use_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    spark.catalog.setCurrentDatabase(name)


def publish(tables: Mapping[str, DataFrame], folder: str, mode: str = "overwrite") -> None:
    """Write each table as ORC below ``folder``: ``append`` on the first load, then ``overwrite``."""
    if mode not in ("append", "overwrite"):
        raise ValueError(f"mode={mode!r}")
    for name, df in tables.items():
        df.write.mode(mode).orc(f"{folder.rstrip('/')}/{name}")
