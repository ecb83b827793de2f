"""Tables in one folder per value of a column, of which only the changed ones are written again."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.functions.text import quoted
from tierflow.operators.changes import changed_keys
from tierflow.sources.paths import delete, exists


def write_partitions(df: DataFrame, path: str, column: str = "year") -> None:
    """Write ``df`` over the folders of the values it has; folders of other values stay.

    Rows are dealt by value, so a value is a few files, and one with a large part of all rows is split
    by adaptive execution.
    """
    (
        df.hint("rebalance", F.col(column))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )


def read_partitions(
    spark: SparkSession, schema: T.StructType, path: str, column: str = "year"
) -> DataFrame:
    """The table with its columns in the order of ``schema``; filters on ``column`` skip folders."""
    return spark.read.schema(schema).parquet(path).select(*map(quoted, schema.names))


def refresh_partitions(
    df: DataFrame, path: str, schema: T.StructType, column: str = "year"
) -> dict[str, list[str | None]]:
    """Make the table at ``path`` equal to ``df``; the values that were written and those deleted.

    Parts are compared by fingerprint: a value whose rows are the same isn't touched. ``df`` must not
    read from ``path``. The lists are as long as there are folders to change. Folders are replaced one
    after the other: readers that need all of them at once use versioned tables.
    """
    spark = df.sparkSession
    if not exists(spark, path):
        write_partitions(df, path, column)
        return {"written": [r[0] for r in df.select(column).distinct().collect()], "deleted": []}
    stored = read_partitions(spark, schema, path, column)
    changes = changed_keys(stored, df.select(*map(quoted, schema.names)), column).collect()
    written = [r[column] for r in changes if r.in_new]
    deleted = [r[column] for r in changes if not r.in_new]
    one = T.StructType([T.StructField("_value", schema[column].dataType)])
    by_value, gone = (spark.createDataFrame([(v,) for v in x], one) for x in (written, deleted))
    if deleted:
        files = stored.select(column, F.col("_metadata.file_path").alias("_file"))
        old = files.join(F.broadcast(gone), F.col(column).eqNullSafe(F.col("_value")), "left_semi")
        folders = old.select(F.regexp_replace("_file", "/[^/]*$", "")).distinct().collect()
        for row in folders:  # one for each value that is gone
            delete(spark, unquote(row[0]))  # file paths are given as URIs
    if written:
        # a value for each folder to write, so this side is small
        own = df.join(F.broadcast(by_value), F.col(column).eqNullSafe(F.col("_value")), "left_semi")
        write_partitions(own, path, column)
    spark.catalog.refreshByPath(path)
    return {"written": sorted(written, key=str), "deleted": sorted(deleted, key=str)}
