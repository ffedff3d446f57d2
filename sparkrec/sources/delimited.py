"""`::`-separated text files without a header (the MovieLens .dat layout)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.utils import AnalysisException

# The three input files and their column layouts.
LAYOUTS = {
    "users": "user_id bigint, gender string, age int, occupation int, zip_code string",
    "movies": "item_id bigint, title string, genres string",
    "ratings": "user_id bigint, item_id bigint, rating double, timestamp bigint",
}
SEPARATOR = "::"
ENCODING = "ISO-8859-1"


def read_delimited(spark: SparkSession, path: str, layout: str) -> DataFrame:
    """A1: one `::` file (or folder of part files) with a fixed schema, Latin-1.
    Schema is given, never inferred; zip codes stay strings."""
    return (spark.read.schema(LAYOUTS[layout]).option("sep", SEPARATOR)
            .option("encoding", ENCODING).option("header", False).option("mode", "FAILFAST")
            .csv(path))


def read_all(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """A1: users, movies and ratings from `folder`; all three must exist."""
    tables, missing = {}, []
    for n in LAYOUTS:  # the reader looks the path up on whatever file system it names
        try:
            tables[n] = read_delimited(spark, f"{folder.rstrip('/')}/{n}.dat", n)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            missing.append(f"{n}.dat")
    if missing:
        raise FileNotFoundError(f"missing input files in {folder}: {missing}")
    return tables


def write_delimited(df: DataFrame, path: str) -> None:
    """Write rows as `::`-separated Latin-1 text without a header."""
    (df.write.mode("overwrite").option("sep", SEPARATOR).option("encoding", ENCODING)
       .option("header", False).csv(path))
