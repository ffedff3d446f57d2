"""Column expressions shared by the operators.

All of them are built from `pyspark.sql.functions`, so they stay inside
whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the original system's configuration:
# rating scale 0.5 .. 5.0 in steps of 0.5, tolerance 0.001 for the step check,
# top-n default 10 and maximum 50, "liked" threshold 4.0, test ratio 0.2,
# at least 5 ratings per user for the split.
MIN_RATING = 0.5
MAX_RATING = 5.0
RATING_STEP = 0.5
STEP_TOLERANCE = 0.001
DEFAULT_TOP_N = 10
MAX_TOP_N = 50
LIKED_RATING = 4.0
TEST_RATIO = 0.2
MIN_USER_RATINGS = 5

# MovieLens age codes, in their published order.
AGE_CODES = (1, 18, 25, 35, 45, 50, 56)

# Patterns for the release year at the end of a title ("Name (YYYY)").
YEAR_AT_END = r"\((\d{4})\)$"
YEAR_SUFFIX = r"\s*\(\d{4}\)$"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c: str | Column, scale: int) -> Column:
    """Round like SQL NUMERIC ROUND (half away from zero) and return a double.

    The value is rounded once: the decimal between keeps 15 places, as many as a
    double near 1 holds, so it is no rounding step of its own.
    """
    return F.round(col(c).cast("decimal(38,15)"), scale).cast("double")


def is_close(a: str | Column, b: str | Column, rtol: float = 1e-5,
             atol: float = 1e-8) -> Column:
    """numpy.isclose(a, b): |a - b| <= atol + rtol * |b|."""
    return F.abs(col(a) - col(b)) <= F.lit(atol) + F.lit(rtol) * F.abs(col(b))


def strip_text(c: str | Column) -> Column:
    """Python str.strip(): drop leading and trailing whitespace."""
    return F.regexp_replace(col(c), r"^\s+|\s+$", "")


def release_year(title: str | Column) -> Column:
    """Year in a trailing "(YYYY)" of the stripped title, else null."""
    raw = F.regexp_extract(strip_text(title), YEAR_AT_END, 1)
    return F.when(raw != "", raw.cast("int"))


def title_without_year(title: str | Column) -> Column:
    """Stripped title without its trailing "(YYYY)"."""
    return F.regexp_replace(strip_text(title), YEAR_SUFFIX, "")


def rating_step_check(value: str | Column) -> Column:
    """True when the value parses as a number inside the rating range and lies
    within 0.001 of a step of the scale (Python's half-even round -> bround)."""
    x = col(value).try_cast("double")
    steps = F.bround((x - F.lit(MIN_RATING)) / F.lit(RATING_STEP), 0)
    nearest = F.lit(MIN_RATING) + steps * F.lit(RATING_STEP)
    ok = (x.between(MIN_RATING, MAX_RATING)
          & (F.abs(x - nearest) <= F.lit(STEP_TOLERANCE)))
    return F.coalesce(ok, F.lit(False))


def clamp_top_n(n) -> int:
    """Top-n argument rule: null, non-integer or < 1 -> 10; > 50 -> 50."""
    if n is None or isinstance(n, bool) or not isinstance(n, int) or n < 1:
        return DEFAULT_TOP_N
    return min(n, MAX_TOP_N)


def weighted_rating(v: Column, r: Column, m: int, c: Column) -> Column:
    """Bayesian average v/(v+m)*R + m/(v+m)*C, in double precision."""
    v = v.cast("double")
    denom = v + F.lit(float(m))
    return (v / denom) * r + (F.lit(float(m)) / denom) * c


def genre_string(genre_names: Column) -> Column:
    """'|'-joined distinct genre names in binary order; null when none.
    Takes the result of `collect_set(genre_name)`."""
    return F.when(F.size(genre_names) > 0, F.array_join(F.array_sort(genre_names), "|"))
