"""Quality rules: counts of each text, and outliers by a robust covariance per language and source.

Each text gives a vector of transformed statistics. For each (language, source) a minimum
covariance determinant estimate is found by concentration steps: start at medians and scaled
median deviations, keep the share of the rows that lies nearest, take mean and covariance of
those, and repeat. Rows whose Mahalanobis distance to the estimate is beyond a chi-square quantile
are rejected. Every step is an aggregation over the statistics; only one small row per group
comes back to them. Groups with few rows use the estimate of their language, or of all rows.

Defined results: a null or empty text has no words and fails the base rule; a null language or
source is a group of its own; repeated rows are judged each, alike; ties at the kept share are all
kept; an empty table gives no rows. Columns of the input other than the named ones pass by.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, let, small, stored, words_of

SYMBOLS = "#*$%&|<>"
MARKS = "!?"
#: A text fails with fewer words, or with more than this share of words in repeated windows.
LEAST_WORDS, MOST_REPEATED = 50, 0.5
#: Statistics by name, with the least deviation that an estimate may have: counts that are zero in
#: nearly all texts have no spread of their own.
STATS = {"word_chars": 0.08, "symbols": 0.04, "marks": 0.05, "upper": 0.06, "dup_lines": 0.12,
         "repeats": 0.12}
#: Share of a group that an estimate is made of, concentration steps, least rows of a group, and
#: the probability of a Gaussian vector to lie farther than the threshold.
KEPT_SHARE, STEPS, LEAST_ROWS, TAIL = 0.75, 4, 50, 1e-8


def _window_words(words: Column) -> Column:
    """Words in windows of three words that are found more than once in the text."""

    def covered(grams: Column) -> Column:
        order = F.array_sort(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = let(
            order,
            lambda s: F.filter(
                s,
                lambda x, i: x["h"].eqNullSafe(F.get(s, i - 1)["h"])
                | x["h"].eqNullSafe(F.get(s, i + 1)["h"]),
            ),
        )
        places = F.array_sort(F.transform(twice, lambda x: x["i"]))
        start = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
        return F.aggregate(
            places,
            start,
            lambda a, x: F.struct(
                (a["n"] + F.least(F.lit(3), x - a["last"])).alias("n"), x.alias("last")
            ),
            lambda a: a["n"],
        )

    def counted(w: Column) -> Column:
        grams = F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)),
        )
        found = let(
            grams,
            lambda g: F.when(F.size(F.array_distinct(g)) < F.size(g), covered(g)).otherwise(0),
        )
        return F.when(F.size(w) >= 3, found).otherwise(0)

    return let(words, counted)


def text_counts(text: Column) -> dict[str, Column]:
    """Counts of a text by name; see the module for nulls."""
    text = F.coalesce(text, F.lit(""))
    without = lambda chars: F.length(F.translate(text, chars, ""))
    lines = F.filter(
        F.split(text, "\n"), lambda line: F.length(F.translate(line, SPACES, "")) > 0
    )
    words = words_of(text)
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": without(SPACES).cast("long"),
        "n_symbols": (F.length(text) - without(SYMBOLS)).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": _window_words(words).cast("long"),
        "n_marks": (F.length(text) - without(MARKS)).cast("long"),
        "n_upper": (F.length(text) - F.length(F.regexp_replace(text, r"\p{Lu}+", ""))).cast("long"),
        "n_lines": F.size(lines).cast("long"),
    }


def _statistics() -> dict[str, Column]:
    share = lambda a, b: F.sqrt(F.col(a) / F.greatest(F.col(b), F.lit(1)))
    return {
        "word_chars": F.log(F.greatest(F.col("word_chars"), F.lit(1)) / F.greatest(F.col("n_words"), F.lit(1))),
        "symbols": share("n_symbols", "word_chars"),
        "marks": share("n_marks", "word_chars"),
        "upper": share("n_upper", "word_chars"),
        "dup_lines": share("n_dup_lines", "n_lines"),
        "repeats": share("n_repeat_words", "n_words"),
    }


def _chi_square(x: float, degrees: int) -> float:
    """Probability below ``x`` for an even number of degrees of freedom."""
    half = x / 2
    return 1 - math.exp(-half) * sum(half**k / math.factorial(k) for k in range(degrees // 2))


def _chi_quantile(p: float, degrees: int) -> float:
    low, high = 0.0, 1e4
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if _chi_square(middle, degrees) < p else (low, middle)
    return high


def _distance(names: list[str]) -> Column:
    """Squared Mahalanobis distance; the columns ``w_i_j`` are the inverse Cholesky factor."""
    rows = [
        " + ".join(f"w_{i}_{j} * (s_{names[j]} - m_{names[j]})" for j in range(i + 1))
        for i in range(len(names))
    ]
    return F.expr(" + ".join(f"({z}) * ({z})" for z in rows))


def _factors(moments: DataFrame, names: list[str], scale: float) -> DataFrame:
    """Mean and inverse Cholesky factor by group, from means and covariances ``c_i_j``.

    ``scale`` makes the covariance of the nearest share that of all rows; the least deviation is
    added on the diagonal, so a statistic without spread can't make the matrix singular.
    """
    p = len(names)
    for j in range(p):  # the factor by columns: the diagonal first, then what lies below it
        less = lambda i, j=j: "".join(f" - l_{i}_{k} * l_{j}_{k}" for k in range(j))
        floor = STATS[names[j]] ** 2
        top = f"sqrt(greatest(c_{j}_{j} * {scale!r}D + {floor!r}D{less(j)}, 1e-9D)) as l_{j}_{j}"
        moments = moments.selectExpr("*", top)
        below = [
            f"(c_{i}_{j} * {scale!r}D{less(i)}) / l_{j}_{j} as l_{i}_{j}" for i in range(j + 1, p)
        ]
        moments = moments.selectExpr("*", *below)
    for gap in range(p):  # its inverse by diagonals
        moments = moments.selectExpr(
            "*",
            *[
                f"({1.0 if not gap else 0.0}D"
                + "".join(f" - l_{j + gap}_{k} * w_{k}_{j}" for k in range(j, j + gap))
                + f") / l_{j + gap}_{j + gap} as w_{j + gap}_{j}"
                for j in range(p - gap)
            ],
        )
    weights = [f"w_{i}_{j}" for i in range(p) for j in range(i + 1)]
    return moments.select("cell", *[f"m_{n}" for n in names], *weights)


def _moments(rows: DataFrame, names: list[str]) -> DataFrame:
    means = [F.expr(f"avg(s_{n}) as m_{n}") for n in names]
    products = [
        F.expr(f"covar_pop(s_{names[i]}, s_{names[j]}) as c_{i}_{j}")
        for i in range(len(names))
        for j in range(i + 1)
    ]
    return rows.groupBy("cell").agg(*means, *products)


def robust_estimates(rows: DataFrame, names: list[str]) -> DataFrame:
    """Estimate for each ``cell`` of rows with statistics ``s_<name>``: ``m_<name>``, ``w_i_j``."""
    p = len(names)
    middle = small(
        rows.groupBy("cell").agg(
            *[F.percentile_approx(f"s_{n}", 0.5, 1000).alias(f"m_{n}") for n in names]
        )
    )
    spread = (
        rows.join(middle, "cell")
        .groupBy("cell")
        .agg(
            *[F.expr(f"first(m_{n}) as m_{n}") for n in names],
            *[
                F.expr(f"percentile_approx(abs(s_{n} - m_{n}), 0.5, 1000) as d_{n}")
                for n in names
            ],
        )
    )
    start = spread.selectExpr(
        "cell",
        *[f"m_{n}" for n in names],
        *[
            f"pow(d_{names[i]} * 1.4826, 2) as c_{i}_{j}" if i == j else f"0D as c_{i}_{j}"
            for i in range(p)
            for j in range(i + 1)
        ],
    )
    estimates = small(_factors(start, names, 1.0))
    inner = KEPT_SHARE / _chi_square(_chi_quantile(KEPT_SHARE, p), p + 2)
    for step in range(STEPS + 1):
        near = rows.join(estimates, "cell").withColumn("d", _distance(names))
        if step < STEPS:  # concentration: the nearest share of the rows
            limits = near.groupBy("cell").agg(F.percentile_approx("d", KEPT_SHARE, 1000).alias("q"))
            near, scale = near.join(small(limits), "cell").where("d <= q"), inner
        else:  # reweighting: all rows that are no outliers by the estimate
            most = _chi_quantile(0.975, p)
            near = near.where(F.col("d") <= most)
            scale = 0.975 / _chi_square(most, p + 2)
        estimates = small(_factors(_moments(near, names), names, scale))
    return estimates


def _key(column: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(column)), F.lit("-"))


def quality_rules(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` but its ``text``, then the counts, ``base_failed``, ``distance``

    (null where the base rule fails) and ``kept``. ``docs`` has ``text``, ``lang`` and ``source``;
    ``packed`` rows bring the text back.
    """
    names = list(STATS)
    counts = text_counts(F.col("text"))
    given = [c for c in docs.columns if c != "text"]
    failed = (F.col("n_words") < LEAST_WORDS) | (
        F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    )
    rows = stored(
        docs.select(*given, *[c.alias(n) for n, c in counts.items()])
        .withColumn("base_failed", failed)
        .withColumns({f"s_{n}": c for n, c in _statistics().items()})
        .withColumns({"k_lang": _key("lang"), "k_source": _key("source")})
        .withColumn("k_group", F.concat_ws("\n", "k_lang", "k_source"))
    )
    sizes = rows.where("not base_failed").groupBy("k_group", "k_lang").agg(F.count("*").alias("n"))
    cells = small(
        sizes.join(sizes.groupBy("k_lang").agg(F.sum("n").alias("n_lang")), "k_lang").select(
            "k_group",
            F.when(F.col("n") >= LEAST_ROWS, F.col("k_group"))
            .when(F.col("n_lang") >= LEAST_ROWS, F.col("k_lang"))
            .otherwise("")
            .alias("cell"),
        )
    )
    # a cell is a group, a language or everything, and is estimated from all of its rows
    levels = F.array("k_group", "k_lang", F.lit(""))
    vectors = (
        rows.where("not base_failed")
        .select(*[f"s_{n}" for n in names], F.explode(levels).alias("cell"))
        .join(cells.select("cell").distinct(), "cell", "left_semi")
    )
    estimates = robust_estimates(stored(vectors), names)
    most = _chi_quantile(1 - TAIL, len(names))
    judged = rows.join(cells, "k_group", "left").join(estimates, "cell", "left")
    return judged.withColumn("distance", F.when(~F.col("base_failed"), _distance(names))).select(
        *given,
        *counts,
        "base_failed",
        "distance",
        (~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= most)).alias("kept"),
    )
