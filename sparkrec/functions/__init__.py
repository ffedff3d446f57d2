"""Shared column expressions and fixed values (built-in functions only)."""

from sparkrec.functions.columns import (  # noqa: F401
    DEFAULT_TOP_N, LIKED_RATING, MAX_RATING, MAX_TOP_N, MIN_RATING, MIN_USER_RATINGS,
    RATING_STEP, TEST_RATIO, clamp_top_n, genre_string, is_close, rating_step_check,
    release_year, round_half_up, title_without_year, weighted_rating,
)
