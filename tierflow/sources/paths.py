"""Folders: which one to use for intermediate tables, and how to replace one whole."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the cluster's ``spark.checkpoint.dir`` (or the context's checkpoint folder).

    There is no other place that all executors see, so without one this is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{base.rstrip('/')}/tierflow-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A shared folder for intermediate tables, deleted at the end, also after a failure.

    What is read from it must be written elsewhere before.
    """
    folder = shared_folder(spark)
    try:
        yield folder
    finally:
        delete(spark, folder)


def settled(df: DataFrame, folder: str) -> DataFrame:
    """``df`` written to ``folder`` and read back: computed once, its lineage cut."""
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _file_system(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    return hadoop.Path, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def hadoop_path(spark: SparkSession, path: str):
    """The path and its file system, as Hadoop's objects."""
    make, fs = _file_system(spark, path)
    return make(path), fs


def delete(spark: SparkSession, path: str) -> None:
    make, fs = _file_system(spark, path)
    fs.delete(make(path), True)


def exists(spark: SparkSession, path: str) -> bool:
    make, fs = _file_system(spark, path)
    return fs.exists(make(path))


def _move(fs, make, source: str, target: str) -> None:
    if not fs.rename(make(source), make(target)):
        raise OSError(f"cannot rename {source} to {target}")


def recover(spark: SparkSession, path: str) -> None:
    """Bring back the folder that an interrupted ``replace_folder`` had set aside."""
    make, fs = _file_system(spark, path)
    aside = f"{path}__old"
    if fs.exists(make(aside)) and not fs.exists(make(path)):
        _move(fs, make, aside, path)


def replace_folder(df: DataFrame, path: str, fmt: str = "parquet", **options: str) -> None:
    """Write ``df`` over ``path``, which ``df`` itself may read; ``options`` are those of the format.

    The rows are written in full beside the folder, and only then take its place. A
    failure before that leaves the old folder; one between the two renames leaves it as
    ``<path>__old``, from where ``recover`` brings it back.
    """
    spark = df.sparkSession
    path = path.rstrip("/")
    make, fs = _file_system(spark, path)
    fresh, aside = f"{path}__new", f"{path}__old"
    df.write.mode("overwrite").format(fmt).options(**options).save(fresh)
    if fs.exists(make(path)):
        fs.delete(make(aside), True)
        _move(fs, make, path, aside)
    _move(fs, make, fresh, path)
    fs.delete(make(aside), True)
    spark.catalog.refreshByPath(path)
