"""DataFrame -> DataFrame operators."""

from tierflow.operators.clean import (
    blanks_to_null,
    normalise_header,
    replace_dashes,
    safe_float,
    safe_int,
    trim_all,
)
from tierflow.operators.derive import (
    argmax_class,
    count_copies,
    dense_rank_by,
    merge_copies,
    modal_value,
    modal_value_rows,
    repeat_rows,
    with_fallback,
)
from tierflow.operators.fuse import career_totals, careers_with_team, fuse_outer, fuse_union
from tierflow.operators.join import salted_left_join
from tierflow.operators.refine import first_per_key, refine
from tierflow.operators.rollup import (
    distinct_rows,
    max_per_key,
    pair_counts,
    rollup,
    row_counts,
    union_columns,
    year_span,
)

__all__ = [
    "argmax_class",
    "blanks_to_null",
    "career_totals",
    "careers_with_team",
    "count_copies",
    "dense_rank_by",
    "distinct_rows",
    "first_per_key",
    "fuse_outer",
    "fuse_union",
    "max_per_key",
    "merge_copies",
    "modal_value",
    "modal_value_rows",
    "normalise_header",
    "pair_counts",
    "refine",
    "repeat_rows",
    "replace_dashes",
    "rollup",
    "row_counts",
    "safe_float",
    "safe_int",
    "salted_left_join",
    "trim_all",
    "union_columns",
    "with_fallback",
    "year_span",
]
