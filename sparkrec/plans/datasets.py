"""The rating datasets the registered queries run on.

`load(spark, sf_dir, "r1" | "r2")` bundles users, items, the genre dictionary,
bridge and strings, the cleaned ratings and the train/test split. The split
is the original system's offline build step whose results are tables; here it
is written once per session as Parquet under `spark.checkpoint.dir` (a shared
folder on a cluster), which also cuts the lineage so a lost executor does not
re-run the split for every later query.
"""

from __future__ import annotations

import hashlib
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from sparkrec.operators.cleaning import (
    genre_dictionary, item_genre_bridge, item_genre_strings, rating_range_filter, title_year,
)
from sparkrec.operators.split import label_split
from sparkrec.session import app_id, materialize
from sparkrec.sources.fixtures import (
    items_raw_view, ratings_r1_view, ratings_r2_view, users_view,
)

_VIEWS = {"r1": ratings_r1_view, "r2": ratings_r2_view}
_CACHE: dict[tuple[str, str, str], "RatingData"] = {}


@dataclass
class RatingData:
    users: DataFrame
    items_raw: DataFrame
    items: DataFrame          # item_id, title, release_year
    genres: DataFrame         # genre_id, genre_name
    item_genres: DataFrame    # item_id, genre_id (repeats kept)
    genre_strings: DataFrame  # item_id, genres
    ratings: DataFrame        # rating_id, user_id, item_id, rating, ts
    train: DataFrame
    test: DataFrame
    folder: str = ""
    kind: str = ""


_DIMS: dict[tuple[str, str], tuple[DataFrame, ...]] = {}


def _dimensions(spark: SparkSession, sf_dir: str, materialized: bool) -> tuple[DataFrame, ...]:
    """(items_raw, items, genres, item_genres, genre_strings); the same for every
    rating dataset of a folder, so written once per session and folder."""
    key = (app_id(spark), sf_dir)
    if materialized and key in _DIMS:
        return _DIMS[key]
    items_raw = items_raw_view(spark, sf_dir)
    genres = genre_dictionary(items_raw)
    item_genres = item_genre_bridge(items_raw, genres)
    items = title_year(items_raw)
    if materialized:
        tag = hashlib.sha1(sf_dir.encode()).hexdigest()[:10]
        # genres is already read back from the written, range-numbered table
        item_genres = materialize(item_genres, f"item_genres_{tag}")
        items = materialize(items, f"items_{tag}")
    genre_strings = item_genre_strings(item_genres, genres)
    if materialized:
        genre_strings = materialize(genre_strings, f"genre_strings_{tag}")
    dims = (items_raw, items, genres, item_genres, genre_strings)
    if materialized:
        _DIMS[key] = dims
    return dims


def load(spark: SparkSession, sf_dir: str, kind: str = "r1",
         materialized: bool = True) -> RatingData:
    key = (app_id(spark), sf_dir, kind)
    if materialized and key in _CACHE:
        return _CACHE[key]
    ratings = rating_range_filter(_VIEWS[kind](spark, sf_dir))
    tag = hashlib.sha1(sf_dir.encode()).hexdigest()[:10]
    if materialized:
        # ratings and split are written once and read by every job; the item tables,
        # which don't depend on them, are written at the same time
        with ThreadPoolExecutor(1) as beside:
            dims = beside.submit(_dimensions, spark, sf_dir, True)
            ratings = materialize(ratings, f"ratings_{kind}_{tag}")
            labelled = materialize(label_split(ratings), f"split_{kind}_{tag}")
            items_raw, items, genres, item_genres, genre_strings = dims.result()
    else:
        items_raw, items, genres, item_genres, genre_strings = _dimensions(spark, sf_dir, False)
        labelled = label_split(ratings)
    train = labelled.filter("not is_test").drop("is_test")
    test = labelled.filter("is_test").drop("is_test")
    data = RatingData(
        users=users_view(spark, sf_dir), items_raw=items_raw, items=items, genres=genres,
        item_genres=item_genres, genre_strings=genre_strings, ratings=ratings,
        train=train, test=test, folder=sf_dir, kind=kind)
    if materialized:
        _CACHE[key] = data
    return data
