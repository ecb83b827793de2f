"""Import of database tables over JDBC. Connection properties are always arguments."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    *,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    num_partitions: int = 1,
    predicates: Sequence[str] | None = None,
) -> DataFrame:
    """Read a table, split by the ranges of a numeric column or by ``predicates``.

    All-text tables have no numeric column: give ``remainder_predicates``. Without either,
    one task reads the table.
    """
    options = dict(properties)
    if predicates:
        if partition_column:
            raise ValueError("give partition_column or predicates, not both")
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=options)
    if partition_column is None:
        return spark.read.jdbc(url, table, properties=options)
    if bounds is None:
        limits = f"(select min({partition_column}) as lo, max({partition_column}) as hi from {table}) b"
        lo, hi = spark.read.jdbc(url, limits, properties=options).first()
        if lo is None:
            return spark.read.jdbc(url, table, properties=options)
        bounds = (int(lo), int(hi) + 1)
    return spark.read.jdbc(
        url,
        table,
        column=partition_column,
        lowerBound=bounds[0],
        upperBound=bounds[1],
        numPartitions=num_partitions,
        properties=options,
    )


def remainder_predicates(hashed: str, parts: int) -> list[str]:
    """Predicates that split a table by the remainder of a whole-number hash.

    ``hashed`` is an expression of the database; one over several columns also splits the
    rows of a key that occurs often. Databases give a negative number a negative remainder,
    so that is shifted: every row is in exactly one part. Rows for which the hash is NULL join
    the first one.
    """
    remainder = f"mod(mod({hashed}, {parts}) + {parts}, {parts})"
    return [
        f"({remainder} = {i}" + (f" OR ({hashed}) IS NULL)" if i == 0 else ")")
        for i in range(parts)
    ]


def import_tables(
    spark: SparkSession,
    url: str,
    properties: Mapping[str, str],
    tables: Mapping[str, str],
    mode: str = "error",
    splits: Mapping[str, Mapping] | None = None,
) -> None:
    """Copy database tables to parquet folders, one per table.

    ``tables`` maps table to folder. ``mode="error"`` is the first import,
    ``mode="overwrite"`` a newer snapshot. ``splits`` holds the ``read_jdbc`` keyword
    arguments of tables that several tasks shall read.
    """
    for table, folder in tables.items():
        how = dict((splits or {}).get(table, {}))
        read_jdbc(spark, url, table, properties, **how).write.mode(mode).parquet(folder)
