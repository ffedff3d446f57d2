"""Sinks: whole-table snapshots and the append-only similarity table, both in folders
with versions (`versions.py`), so a reader never sees half of a write."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkrec.operators.ranking import global_rank
from sparkrec.session import materialize
from sparkrec.sources import versions

#: The table's name in the folder of `append_similarities`.
SIMILARITIES = "item_similarities"


def snapshot_write(tables: dict[str, DataFrame], folder: str, csv: bool = False) -> dict[str, str]:
    """Replace each table as a whole (Parquet, or headed CSV for exports), all of
    them at once: until the last one is written, readers see the former version.
    Other tables of the folder stay. Returns the written paths; `versions.read` gives
    a table of the newest version or of an earlier one. Row chunking of the original
    is not needed: every partition writes its own file."""
    if not tables:
        return {}
    spark = next(iter(tables.values())).sparkSession
    staged = {name: versions.stage(df, folder, name, "csv" if csv else "parquet") for name, df in tables.items()}
    versions.commit(spark, folder, lambda base: base.tables | staged)
    return {name: f"{folder.rstrip('/')}/{entry['parts'][0]}" for name, entry in staged.items()}


def append_similarities(spark: SparkSession, sims: DataFrame, path: str, strict: bool = False,
                        created_at: Column | None = None) -> DataFrame:
    """Append (item_id_1, item_id_2, ...) pairs to the table at `path`,
    creating it if missing. The pair is a unique key, within the batch and
    against the table: of equal pairs in a batch the smallest row is kept, pairs
    already stored are skipped (anti-join on the key); in `strict` mode either is
    rejected with an error, like the original's UNIQUE constraint. A null in the key
    is an error. Stored rows get `similarity_id`, numbered on from the table's last one
    in the order of the key, and `created_at` (the time of the write if not given).

    Several writers may append at once: a batch is published as a whole, and a writer
    that finds another one's batch before its own checks its pairs against that one
    too. Returns the stored rows with the columns of `sims`; `similarity_table` has
    all columns."""
    key = ["item_id_1", "item_id_2"]
    rest = [c for c in sims.columns if c not in key]
    if strict and not sims.groupBy(*key).count().where("count > 1").isEmpty():
        raise ValueError("duplicate (item_id_1, item_id_2) pairs within the batch")
    # one row per pair, the first in the order of all columns
    batch = sims.groupBy(*key).agg(F.min(F.struct(*rest)).alias("_r")).select(*key, "_r.*").select(*sims.columns) if rest \
        else sims.dropDuplicates(key)
    batch = materialize(batch.withColumn("created_at", F.current_timestamp() if created_at is None else created_at), "similarity_batch")
    if not batch.where("item_id_1 is null or item_id_2 is null").isEmpty():
        raise ValueError("null in (item_id_1, item_id_2)")

    def change(base: versions.Version) -> dict[str, dict] | None:
        entry, new = base.tables.get(SIMILARITIES), batch
        if entry:
            stored = versions.read(spark, path, SIMILARITIES, base)
            if strict and not batch.join(stored.select(*key), key, "left_semi").isEmpty():
                raise ValueError("duplicate (item_id_1, item_id_2) pairs: the table already holds them")
            new = batch.join(stored.select(*key), key, "left_anti").select(*[c for c in stored.columns if c != "similarity_id"])
            if new.isEmpty():
                return None
        last = entry["last_id"] if entry else 0
        numbered = global_rank(new, key, "similarity_id").select((F.col("similarity_id") + last).alias("similarity_id"), *new.columns)
        own = versions.stage(numbered, path, SIMILARITIES)
        top = versions.read(spark, path, SIMILARITIES, versions.Version(0, {SIMILARITIES: own})).agg(F.max("similarity_id")).first()[0]
        return base.tables | {SIMILARITIES: own | {"parts": (entry["parts"] if entry else []) + own["parts"], "last_id": top or last}}

    done = versions.commit(spark, path, change)
    return versions.read(spark, path, SIMILARITIES, done).select(*sims.columns)


def similarity_table(spark: SparkSession, path: str) -> DataFrame:
    """The table of `append_similarities`: similarity_id, its pairs' columns, created_at."""
    return versions.read(spark, path, SIMILARITIES)
