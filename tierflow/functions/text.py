"""Parsing of messy text, as Spark SQL expressions.

Each function takes a SQL expression (often just a column name) and returns one, for
``selectExpr``, ``filter`` or ``F.expr``: a whole table's cleaning is then one call to
the JVM instead of dozens per column. The expressions give the same result whether
``spark.sql.ansi.enabled`` is on or off: text that cannot be parsed becomes NULL
instead of failing the job.
"""

from __future__ import annotations

import re

# Placeholder text, patterns and formats of the data model.
PLACEHOLDER = "--"
KEY_PREFIX = ".*?/"
STRICT_PAIR = ", "
LENIENT_PAIR = r",\s*"
DATE_SHAPE = r"^\d{1,2}/\d{1,2}/\d{2,4}$"
DATE_FORMAT = "M/d/yyyy"

# Shapes that are tested before a cast: a failing try_cast raises and drops an exception
# inside the JVM for each value, which costs far more than a pattern test.
_BLANKS = r"[\x00-\x20]*"
_INTEGER = rf"^{_BLANKS}[+-]?\d+{_BLANKS}$"
_FRACTION = rf"^({_BLANKS}[+-]?)(\d*)\.\d*{_BLANKS}$"
_FLOAT = (
    rf"^{_BLANKS}[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?[fFdD]?|(?i:inf|infinity|nan)|0[xX].*)"
    rf"{_BLANKS}$"
)


def quoted(column: str) -> str:
    """Column name as a SQL expression, whatever characters it holds."""
    return "`" + column.replace("`", "``") + "`"


def clean_column_name(name: str) -> str:
    """Header text as a column name: lower case, blanks to ``_``, ``[a-z0-9_]`` only."""
    return re.sub("[^a-z0-9_]", "", name.strip().lower().replace(" ", "_"))


def normalise(value: str, zero: bool = False) -> str:
    """Trimmed text, blank as NULL and, if asked for, ``--`` as ``0``."""
    zeroed = f"WHEN trim({value}) = '{PLACEHOLDER}' THEN '0' " if zero else ""
    return f"CASE WHEN trim({value}) = '' THEN NULL {zeroed}ELSE trim({value}) END"


def placeholder_to_zero(value: str) -> str:
    """``--`` becomes ``0``; any other text stays."""
    return f"CASE WHEN {value} = '{PLACEHOLDER}' THEN '0' ELSE {value} END"


def blank_to_null(value: str) -> str:
    return f"nullif({value}, '')"


def lenient_int(value: str) -> str:
    """Text as int; a fraction is cut off (``12.7`` gives 12), other text gives NULL."""
    whole = f"regexp_replace({value}, r'{_FRACTION}', '$10$2')"
    return (
        f"CASE WHEN {value} RLIKE r'{_INTEGER}' THEN try_cast({value} AS int) "
        f"WHEN {value} RLIKE r'{_FRACTION}' THEN try_cast({whole} AS int) END"
    )


def comma_int(value: str) -> str:
    """``1,234`` gives 1234."""
    return lenient_int(f"replace({value}, ',', '')")


def marker_int(value: str, marker: str = "T") -> str:
    """Integer with a marker letter anywhere in it: ``85T`` gives 85."""
    return lenient_int(f"replace({value}, '{marker}', '')")


def digits_int(value: str) -> str:
    """Integer from the digits and dashes alone: ``45*`` gives 45, ``12.5`` gives 125."""
    digits = f"regexp_replace({value}, '[^0-9-]', '')"
    return (
        f"CASE WHEN {value} RLIKE r'{_INTEGER}' THEN try_cast({value} AS int) "
        f"WHEN {digits} RLIKE r'{_INTEGER}' THEN try_cast({digits} AS int) END"
    )


def lenient_float(value: str) -> str:
    """Text as float; commas are not accepted (``1,234.5`` gives NULL)."""
    return f"CASE WHEN {value} RLIKE r'{_FLOAT}' THEN try_cast({value} AS float) END"


def extract_key(value: str) -> str:
    """Integer key behind any number of ``prefix/`` parts."""
    return lenient_int(f"regexp_replace({value}, r'{KEY_PREFIX}', '')")


def split_pair(value: str, separator: str = STRICT_PAIR) -> tuple[str, str]:
    """First and second part of separated text; a missing part is NULL."""
    parts = f"split({value}, r'{separator}')"
    return f"get({parts}, 0)", f"get({parts}, 1)"


def has_pair(value: str, separator: str = STRICT_PAIR) -> str:
    """Whether the second part is there; for the strict separator without splitting."""
    if separator == STRICT_PAIR:
        return f"contains({value}, '{separator}')"
    return f"{split_pair(value, separator)[1]} IS NOT NULL"


def parse_date(value: str) -> str:
    """``M/d/yyyy`` text as a date; anything else, also a 2-digit year, gives NULL."""
    return (
        f"CASE WHEN {value} RLIKE r'{DATE_SHAPE}' "
        f"THEN try_to_date({value}, '{DATE_FORMAT}') END"
    )
