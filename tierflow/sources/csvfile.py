"""CSV files as all-text tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.functions.text import clean_column_name
from tierflow.operators.clean import check_header, map_columns
from tierflow.schemas import text_schema
from tierflow.sources.tables import save_table


# Stands for a quoted empty value while reading, as Spark would take it for NULL too.
_EMPTY = "\ue000" * 3


def _reader(spark: SparkSession, multiline: bool):
    return spark.read.options(
        quote='"', escape='"', multiLine=multiline, mode="FAILFAST", emptyValue=_EMPTY
    )


def _odd_quotes():
    return F.regexp_count("value", F.lit('"')) % 2 == 1


def spans_lines(spark: SparkSession, path: str) -> bool:
    """Whether a quoted value may hold a line break: some line has an odd number of quotes."""
    return bool(multiline_files(spark, path))


def multiline_files(spark: SparkSession, path: str) -> list[str]:
    """The files of ``path`` in which some line has an odd number of quotes."""
    lines = spark.read.text(path).select("value", F.input_file_name().alias("file"))
    marked = lines.filter(F.contains("value", F.lit(_EMPTY))).take(1)
    if marked:
        raise ValueError(f"{marked[0].file} holds the characters that stand for empty values")
    return [r.file for r in lines.filter(_odd_quotes()).select("file").distinct().collect()]


def _typed(spark: SparkSession, path, header: list[str], multiline: bool) -> DataFrame:
    """Rows under the header's own names, with which every file's header is compared."""
    return (
        _reader(spark, multiline)
        .schema(text_schema(header))
        .csv(path, header=True, enforceSchema=False)
    )


def read_csv(spark: SparkSession, path: str, multiline: bool | None = None) -> DataFrame:
    """Read CSV with a header line; every column is text, unquoted empty values are NULL.

    Column names are cleaned. A row with more or fewer values than the header is an error, and
    so is a file whose header differs from that of another. Values with line breaks force a
    whole file into one task, so by default the files are first scanned for them, and those
    without are split among tasks.
    """
    found = multiline_files(spark, path) if multiline is None else []
    any_lines = multiline if multiline is not None else bool(found)
    first = _reader(spark, any_lines).csv(path, header=False, enforceSchema=False).first()
    if first is None:
        raise ValueError(f"{path} has no header line")
    header = [value or "" for value in first]
    names = [clean_column_name(value) for value in header]
    check_header(names)
    rows = _typed(spark, path, header, any_lines)
    if found:
        every = {r.file for r in spark.read.text(path).select(F.input_file_name().alias("file")).distinct().collect()}
        others = sorted(every - set(found))
        if others:
            rows = _typed(spark, sorted(found), header, True).union(
                _typed(spark, others, header, False)
            )
    rows = rows.toDF(*names)
    return map_columns(rows, names, lambda v: f"CASE WHEN {v} = '{_EMPTY}' THEN '' ELSE {v} END")


def load_csv(
    spark: SparkSession,
    path: str,
    table: str,
    multiline: bool | None = None,
    location: str | None = None,
) -> DataFrame:
    """Append a CSV file to a table, which is made with all-text columns if absent.

    ``location`` is the folder of a new table outside the warehouse.
    """
    return save_table(read_csv(spark, path, multiline), table, "append", "parquet", location)
