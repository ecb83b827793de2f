"""Tables under one root whose new versions become visible together, in one step.

Rows are written to folders of their own, which no reader looks at; then a record that names the
folders of every table takes the next number. A reader uses the record with the greatest number, so
it sees all tables of a commit or none of them, and a plan made earlier goes on reading the folders
of its version. What an interrupted writer leaves behind is never named, and ``vacuum`` deletes it.

Folders of a root: ``_commits`` holds a small JSON file per version, ``data`` the rows. A record is
written beside its place and renamed to it; the rename fails if the number is taken, so of two
writers that began from one version the second gets ``CommitConflict``. That needs a file system
whose rename does not replace (HDFS, local); on object stores only one writer may run at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tierflow.sources.paths import delete, exists, hadoop_path


class CommitConflict(RuntimeError):
    """Another writer has committed since this one began."""


@dataclass(frozen=True)
class Commit:
    """What a version consists of: folders by table, and notes of the writer."""

    version: int = 0
    tables: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    notes: Mapping[str, object] = field(default_factory=dict)


def _commits(root: str) -> str:
    return f"{root.rstrip('/')}/_commits"


def _record(root: str, version: int) -> str:
    return f"{_commits(root)}/{version:012d}.json"


def committed_versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the records that are there, in order."""
    folder = _commits(root)
    if not exists(spark, folder):
        return []
    path, fs = hadoop_path(spark, folder)
    names = [status.getPath().getName() for status in fs.listStatus(path)]
    return sorted(int(n.removesuffix(".json")) for n in names if n[0] != "_" and n.endswith(".json"))


def load_commit(spark: SparkSession, root: str, version: int | None = None) -> Commit:
    """The record of a version, by default the latest; an empty one before the first commit."""
    if version is None:
        found = committed_versions(spark, root)
        if not found:
            return Commit()
        version = found[-1]
    path, fs = hadoop_path(spark, _record(root, version))
    stream = fs.open(path)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return _parsed(text)


def _parsed(text: str) -> Commit:
    content = json.loads(text)
    tables = {name: tuple(folders) for name, folders in content["tables"].items()}
    return Commit(content["version"], tables, content["notes"])


def new_data_folder(root: str, name: str) -> str:
    """A folder that no commit names yet, relative to the root."""
    return f"data/{name}/{uuid.uuid4().hex}"


def write_data(root: str, name: str, df: DataFrame, fmt: str = "parquet", **options: str) -> str:
    """Write rows where no reader looks; the folder, to be named by a commit."""
    folder = new_data_folder(root, name)
    df.write.format(fmt).options(**options).save(f"{root.rstrip('/')}/{folder}")
    return folder


def commit(
    spark: SparkSession,
    root: str,
    base: Commit,
    tables: Mapping[str, str | Iterable[str]],
    notes: Mapping[str, object] | None = None,
    append: Iterable[str] = (),
) -> Commit:
    """Publish a version that has ``base``'s tables, those in ``tables`` with their new folders.

    Tables in ``append`` keep their folders and get the new ones beside them. Notes that are not
    given are those of ``base``.
    """
    appended = set(append)
    merged = dict(base.tables)
    for name, folders in tables.items():
        new = (folders,) if isinstance(folders, str) else tuple(folders)
        merged[name] = (*base.tables.get(name, ()), *new) if name in appended else new
    record = {
        "version": base.version + 1,
        "tables": merged,
        "notes": base.notes if notes is None else notes,
    }
    content = json.dumps(record, indent=1)
    path, fs = hadoop_path(spark, _record(root, record["version"]))
    fs.mkdirs(path.getParent())
    beside, _ = hadoop_path(spark, f"{_commits(root)}/_{uuid.uuid4().hex}")
    stream = fs.create(beside, False)
    try:
        stream.write(bytearray(content.encode()))
    finally:
        stream.close()
    _take_number(spark, fs, beside, path)
    return _parsed(content)


def _take_number(spark: SparkSession, fs, beside, path) -> None:
    """Rename that fails where the target is there already."""
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        path.toUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )
    plain = spark.sparkContext._gateway.new_array(
        getattr(jvm, "org.apache.hadoop.fs.Options$Rename"), 0
    )
    try:
        context.rename(fs.makeQualified(beside), fs.makeQualified(path), plain)
    except Py4JJavaError as error:
        fs.delete(beside, False)
        if fs.exists(path):
            raise CommitConflict(f"{path.getName()} is there already") from error
        raise


def commit_tables(
    spark: SparkSession,
    root: str,
    tables: Mapping[str, DataFrame],
    notes: Mapping[str, object] | None = None,
    append: Iterable[str] = (),
    fmt: str = "parquet",
) -> Commit:
    """Write several tables and publish them together. They may read their own older versions."""
    base = load_commit(spark, root)
    folders = {name: write_data(root, name, df, fmt) for name, df in tables.items()}
    return commit(spark, root, base, folders, notes, append)


def read_version(
    spark: SparkSession,
    root: str,
    name: str,
    schema: T.StructType | None = None,
    version: int | Commit | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """A table as a version has it. Reading two tables of one moment needs the same ``Commit``."""
    found = version if isinstance(version, Commit) else load_commit(spark, root, version)
    if name not in found.tables:
        raise KeyError(f"{name} is not in version {found.version} of {root}")
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load([f"{root.rstrip('/')}/{folder}" for folder in found.tables[name]])


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete all but the last ``keep`` records, and data that none of these names; what was deleted.

    No writer may be at work: folders that it has written and not yet named would go too.
    """
    if keep < 1:
        raise ValueError(f"keep={keep}")
    found = committed_versions(spark, root)
    for version in found[:-keep]:
        delete(spark, _record(root, version))
    named = {
        folder
        for version in found[-keep:]
        for folders in load_commit(spark, root, version).tables.values()
        for folder in folders
    }
    gone = []
    base = f"{root.rstrip('/')}/data"
    if exists(spark, base):
        path, fs = hadoop_path(spark, base)
        for table in fs.listStatus(path):
            for status in fs.listStatus(table.getPath()):
                folder = f"data/{table.getPath().getName()}/{status.getPath().getName()}"
                if folder not in named:
                    fs.delete(status.getPath(), True)
                    gone.append(folder)
    return sorted(gone)
