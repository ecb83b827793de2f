"""Raw text table -> typed silver table, as its ``CleanSpec`` says."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tierflow.functions import text
from tierflow.specs import ALL, ROW, CleanSpec


def first_per_key(
    df: DataFrame,
    keys: Iterable[str],
    order: Iterable[str] | None = None,
    nulls_last: bool = False,
) -> DataFrame:
    """One row per key: the first in the order of ``order`` (default: all other columns).

    The order is total, so a rerun keeps the same row. Spark limits each key to one row
    before the shuffle (WindowGroupLimit), so a hot key does not gather in one task.
    """
    keys = list(keys)
    order = [c for c in df.columns if c not in keys] if order is None else list(order)
    by = ", ".join(map(text.quoted, keys))
    nulls = " NULLS LAST" if nulls_last else ""
    sort = ", ".join(text.quoted(c) + nulls for c in order or keys)
    window = f"PARTITION BY {by} ORDER BY {sort}"
    ranked = df.selectExpr("*", f"row_number() OVER ({window}) AS _rank")
    return ranked.filter("_rank = 1").drop("_rank")


def _normalise(df: DataFrame, spec: CleanSpec) -> DataFrame:
    early = () if spec.zero_marks_after_dedup else spec.zero_marks
    return df.selectExpr(
        *[
            f"{text.normalise(name, early == ALL or name in early)} AS {name}"
            if kind == "string"
            else name
            for name, kind in df.dtypes
        ]
    )


def _parse(df: DataFrame, columns: list[str], spec: CleanSpec, also: Iterable[str] = ()) -> DataFrame:
    parsers = spec.parsers()
    late = spec.zero_marks if spec.zero_marks_after_dedup else ()

    def parse(name: str) -> str:
        value = text.placeholder_to_zero(name) if late == ALL or name in late else name
        return f"{parsers[name][0](value) if name in parsers else value} AS {name}"

    parts = []
    for pair in spec.pairs:
        if pair.source in columns:
            first, second = text.split_pair(pair.source, pair.separator)
            parts += [f"{first} AS {pair.first}", f"{second} AS {pair.second}"]
    return df.selectExpr(*also, *[parse(c) for c in columns], *parts)


def row_tests(columns: list[str], spec: CleanSpec, keep_null: bool = False) -> dict[str, str]:
    """SQL texts of the spec's tests by name, over parsed rows, the cheap and selective ones first."""
    tests = {"keep": spec.keep.condition(columns, keep_null) if spec.keep is not None else None}
    if spec.year_floor is not None and "year" in columns:
        tests["year"] = f"{text.lenient_int('year')} >= {spec.year_floor}"
    seconds = {pair.second: pair for pair in spec.pairs if pair.source in columns}
    for name in spec.required:
        if name in seconds:
            tests[name] = text.has_pair(seconds[name].source, seconds[name].separator)
        elif name in columns:
            tests[name] = f"{name} IS NOT NULL"
    return {name: test for name, test in tests.items() if test}


def _condition(columns: list[str], spec: CleanSpec, keep_null: bool) -> str | None:
    return " AND ".join(row_tests(columns, spec, keep_null).values()) or None


def refine(
    df: DataFrame,
    spec: CleanSpec,
    missing: str = "error",
    keep_null_measures: bool = False,
) -> DataFrame:
    """Clean, type and filter a raw table.

    ``missing`` says what to do when a column of the raw table is absent: ``"error"``,
    ``"skip"`` (no parsing or test that needs it) or ``"null"`` (as skip, and the absent
    column is then NULL in the result). ``keep_null_measures`` keeps rows whose tested
    measure is NULL.
    """
    if missing not in ("error", "skip", "null"):
        raise ValueError(f"missing={missing!r}")
    columns = df.columns
    absent = [c for c in spec.raw_columns if c not in columns]
    if absent and missing == "error":
        raise ValueError(f"{spec.name}: columns are missing: {', '.join(absent)}")
    rows = _normalise(df, spec)
    condition = _condition(columns, spec, keep_null_measures)
    if spec.dedup == ROW and condition is not None:
        # equal rows pass alike, so those that don't are dropped before the shuffle
        whole = rows.select("*", F.struct("*").alias("_row"))
        rows = _parse(whole, columns, spec, ["_row"]).filter(condition).select("_row.*")
        condition = None
    rows = _parse(_deduplicated(rows, spec), columns, spec)
    return _finished(rows if condition is None else rows.filter(condition), spec, absent, missing)


def distinct_texts(rows: DataFrame) -> DataFrame:
    """Distinct rows of a table of text columns, each of which travels as one text.

    A row of many short texts takes 16 bytes a column and more before its compression, the joined one
    a byte more than they hold. NULL is a mark of its own, and mark and separator are escaped where a
    value holds them, so rows are equal exactly if their texts are. Splitting a text decodes it: rows with
    bytes that aren't UTF-8 travel as hexadecimal digits behind a mark that no other row begins with.
    """
    separator, null, escape = "'\\u0001'", "'\\u0002'", "'\\u0003'"
    marks = ((escape, "'\\u0003c'"), (separator, "'\\u0003a'"), (null, "'\\u0003b'"))

    def replaced(value: str, pairs) -> str:
        for old, new in pairs:
            value = f"replace({value}, {old}, {new})"
        return value

    names = [text.quoted(c) for c in rows.columns]
    values = ", ".join(f"coalesce({replaced(c, marks)}, {null})" for c in names)
    digits = ", ".join(f"coalesce(hex({c}), {null})" for c in names)
    coded = "'\\u0003x'"
    texts = (
        "CASE WHEN is_valid_utf8(_plain) THEN _plain "
        f"ELSE concat({coded}, concat_ws({separator}, {digits})) END AS _texts"
    )
    body = "CASE WHEN _coded THEN substr(_texts, 3) ELSE _texts END AS _body"
    parts = [f"split_part(_body, {separator}, {i}) AS {c}" for i, c in enumerate(names, 1)]
    back = [(new, old) for old, new in reversed(marks)]
    whole = [
        f"CASE WHEN {c} = {null} THEN NULL WHEN _coded THEN CAST(unhex({c}) AS STRING) "
        f"ELSE {replaced(c, back)} END AS {c}"
        for c in names
    ]
    return (
        rows.selectExpr(f"concat_ws({separator}, {values}) AS _plain", *names)
        .selectExpr(texts)
        .distinct()
        .selectExpr("_texts", f"startswith(_texts, {coded}) AS _coded")
        .selectExpr(body, "_coded")
        .selectExpr("_coded", *parts)
        .selectExpr(*whole)
    )


def _deduplicated(rows: DataFrame, spec: CleanSpec) -> DataFrame:
    if spec.dedup == ROW:
        only_text = all(kind == "string" for _, kind in rows.dtypes)
        return distinct_texts(rows) if only_text else rows.dropDuplicates()
    if spec.dedup and all(c in rows.columns for c in spec.dedup):
        return first_per_key(rows, spec.dedup)
    return rows


def _finished(rows: DataFrame, spec: CleanSpec, absent: list[str], missing: str) -> DataFrame:
    """Without the columns that are dropped, and with absent ones if asked for."""
    rows = rows.drop(*spec.dropped)
    if absent and missing == "null":
        present = set(rows.columns)
        rows = rows.selectExpr(
            *[
                f.name if f.name in present else f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}"
                for f in spec.silver_schema()
            ]
        )
    return rows


def refine_observed(df: DataFrame, spec: CleanSpec, seen: Observation, parsed: Observation) -> DataFrame:
    """``refine`` whose action also counts what it reads and drops, without another pass.

    ``seen`` gets ``rows_in``. ``parsed`` gets ``rows_distinct`` (after deduplication), ``fails_<test>`` (rows
    that don't pass a test, each counted at every test it fails), ``kept``, and ``unparsed_<column>``
    (texts of kept columns that are there but can't be read). Counts of a stage that is run again after a lost
    executor may include its rows twice.
    """
    columns = df.columns
    absent = [c for c in spec.raw_columns if c not in columns]
    if absent:
        raise ValueError(f"{spec.name}: columns are missing: {', '.join(absent)}")
    rows = _normalise(df.observe(seen, F.expr("count(*) AS rows_in")), spec)
    sources = {f"_text_{c}": c for c in spec.parsers() if c not in spec.dropped}
    rows = _deduplicated(rows, spec).selectExpr("*", *[f"{c} AS {t}" for t, c in sources.items()])
    rows = _parse(rows, [*columns, *sources], spec)
    tests = row_tests(columns, spec)
    passed = " AND ".join(f"({t})" for t in tests.values()) or "TRUE"
    counts = [
        "count(*) AS rows_distinct",
        *[f"count_if(NOT coalesce({t}, FALSE)) AS fails_{name}" for name, t in tests.items()],
        f"count_if({passed}) AS kept",
        *[f"count_if({c} IS NULL AND {t} IS NOT NULL) AS unparsed_{c}" for t, c in sources.items()],
    ]
    rows = rows.observe(parsed, *map(F.expr, counts)).drop(*sources)
    return _finished(rows.filter(passed), spec, [], "error")
