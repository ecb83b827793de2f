"""Session settings that cleaning needs to run fast and within its memory."""

from __future__ import annotations

from pyspark.sql import SparkSession

_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
_SPARK_DEFAULT = "65535"
_JIT_LIMIT = "8000"
_SPLIT = "spark.sql.files.maxPartitionBytes"
_SPLIT_DEFAULT = f"{128 << 20}b"
_SPLIT_BYTES = f"{8 << 20}b"
_SHUFFLES = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_SHUFFLE_TASKS = "1000"
_MERGED = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
_MERGED_BYTES = f"{16 << 20}b"


def tune(spark: SparkSession) -> None:
    """Keep generated methods below the size that the JVM's compiler accepts, and tasks small.

    Parsing some 30 columns in one whole-stage method passes 8000 bytes of bytecode, which
    the JVM then only interprets, at a quarter of the speed. With the limit set, Spark runs
    such a stage in smaller methods.

    A text table takes some 20 bytes a row in a file and some 400 in memory: a split of the default
    128 MB is several million rows, which the map side of the deduplication spills. With splits of
    8 MB the memory of a task doesn't depend on the table's size.

    Adaptive execution only merges the partitions of a shuffle, so with a fixed number of them the part of
    a task that deduplicates or sums grows with the table, and spills. It begins with a thousand
    here and merges them up to ``spark.sql.adaptive.advisoryPartitionSizeInBytes``: 16 MB, as compressed
    rows take some ten times that in a sort or hash table. Values that the user has set stay.
    """
    if spark.conf.get(_METHOD_LIMIT, _SPARK_DEFAULT) == _SPARK_DEFAULT:
        spark.conf.set(_METHOD_LIMIT, _JIT_LIMIT)
    if spark.conf.get(_SPLIT, _SPLIT_DEFAULT) == _SPLIT_DEFAULT:
        spark.conf.set(_SPLIT, _SPLIT_BYTES)
    if spark.conf.get(_SHUFFLES, None) is None:
        spark.conf.set(_SHUFFLES, _SHUFFLE_TASKS)
    if _MERGED not in spark.conf.getAll:
        spark.conf.set(_MERGED, _MERGED_BYTES)
