"""Ranking building blocks.

* `top_n_per` - the first n rows of each group. Spark plans `row_number() <= n`
  with a partial WindowGroupLimit before the shuffle, so a hot group sends at
  most n rows per map task across the network.
* `global_rank` and `rank_within_groups` - exact 1-based row numbers when the
  wanted rank is not small (e.g. "newest 20% of a user's ratings"). A plain
  window would put a hot group into one task; here the rows are range-
  partitioned on (group, order), which splits a hot group over many tasks,
  and each row's number is its position in the sorted partition plus the
  number of rows of its group in earlier partitions. The positioned rows are
  written once (so the count table and the rows see the same sampled range
  bounds) and joined to the (partition, group) count table on that pair of
  keys, which keeps a hot group spread exactly as the range partitioning did.
* `join_on_rank` - join rank-bounded candidates to a ranked list: the hot low
  ranks through a size-bounded broadcast, the rest through a shuffle join.

Order columns must form a total order (end with a unique key), so that row
numbers are deterministic and survive task retries.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkrec.session import materialize

_MID = "_sr_mid"
_PID = "_sr_pid"
_FIRST = "_sr_first"
_CNT = "_sr_cnt"
_BEFORE = "_sr_before"


def _cols(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def _num_partitions(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return num_partitions
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def number_rows(df: DataFrame, order_cols: Sequence[str | Column],
                rank_col: str = "rank") -> DataFrame:
    """1-based row number over a frame already cut to a small, bounded size
    (a LIMIT result): one ordered window in a single task."""
    return df.withColumn(rank_col,
                         F.row_number().over(Window.orderBy(*_cols(order_cols))).cast("bigint"))


def top_n_per(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str | Column],
              n: int, rank_col: str = "rank") -> DataFrame:
    """Keep the first n rows per group under `order_cols`, numbered 1..n."""
    w = Window.partitionBy(*group_cols).orderBy(*_cols(order_cols))
    # filter on the bare row_number so Spark infers the partial WindowGroupLimit
    return (df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)
              .withColumn(rank_col, F.col(rank_col).cast("bigint")))


def _sorted_with_position(df: DataFrame, keys: list[Column], num_partitions: int) -> DataFrame:
    """Range-partition and sort on `keys`, tag each row with its position, and
    write the result once. The count table and the rows must see the same
    partitioning; range bounds come from sampling, so the positioned rows are
    materialised rather than computed twice."""
    keyed = (df.repartitionByRange(num_partitions, *keys)
               .sortWithinPartitions(*keys)
               .withColumn(_MID, F.monotonically_increasing_id()))
    keyed = materialize(keyed, "ranked")
    return keyed.withColumn(_PID, F.shiftrightunsigned(F.col(_MID), 33))


def global_rank(df: DataFrame, order_cols: Sequence[str | Column], rank_col: str = "rank",
                num_partitions: int | None = None) -> DataFrame:
    """Distributed 1-based row number over a total order (no single-task window).

    The per-partition count table has one row per partition, so broadcasting it
    is bounded by the partition count, not by the data.
    """
    p = _num_partitions(df, num_partitions)
    keyed = _sorted_with_position(df, _cols(order_cols), p)
    stats = keyed.groupBy(_PID).agg(F.min(_MID).alias(_FIRST), F.count(F.lit(1)).alias(_CNT))
    w = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.withColumn(_BEFORE, F.coalesce(F.sum(_CNT).over(w), F.lit(0)))
    out = keyed.join(F.broadcast(stats.select(_PID, _FIRST, _BEFORE)), _PID)
    return (out.withColumn(rank_col, F.col(_MID) - F.col(_FIRST) + F.col(_BEFORE) + 1)
               .drop(_MID, _PID, _FIRST, _BEFORE))


def rank_within_groups(df: DataFrame, group_cols: Sequence[str],
                       order_cols: Sequence[str | Column], rank_col: str = "rn",
                       size_col: str | None = None,
                       num_partitions: int | None = None) -> DataFrame:
    """Exact row number (and optionally group size) per group, skew-safe.

    Rows are range-partitioned on (group, order) - a hot group is split over
    many partitions - and written with their position. A window over
    (partition, group) numbers the rows of each partition. Only groups that cross a partition boundary need the counts of their earlier
    partitions; such a group is the first or last group of some partition, so
    at most 2 x #partitions groups qualify and their (partition, group) counts
    form a table bounded by the partition count, which is broadcast.
    Group keys must be non-null.
    """
    p = _num_partitions(df, num_partitions)
    keyed = _sorted_with_position(df, _cols(list(group_cols)) + _cols(order_cols), p)
    g = list(group_cols)
    ends = keyed.groupBy(_PID).agg(
        F.min_by(F.struct(*g), F.col(_MID)).alias("_f"),
        F.max_by(F.struct(*g), F.col(_MID)).alias("_l"))            # one row per partition
    edge_groups = (ends.select(F.explode(F.array("_f", "_l")).alias("_e"))
                   .select("_e.*").distinct())                      # <= 2 x partitions
    counts = (keyed.join(F.broadcast(edge_groups), g, "left_semi")
              .groupBy(_PID, *g).agg(F.count(F.lit(1)).alias(_CNT)))
    by_group = Window.partitionBy(*g)
    span = (counts.withColumn("_parts", F.count(F.lit(1)).over(by_group))
            .filter(F.col("_parts") > 1)
            .withColumn(_BEFORE, F.coalesce(F.sum(_CNT).over(
                by_group.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
            .withColumn("_total", F.sum(_CNT).over(by_group))
            .select(_PID, *g, _BEFORE, "_total"))
    w = Window.partitionBy(_PID, *g).orderBy(_MID)
    local = keyed.withColumn("_lrn", F.row_number().over(w))
    if size_col:
        local = local.withColumn("_lcnt", F.count(F.lit(1)).over(
            w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    out = local.join(F.broadcast(span), [_PID, *g], "left")
    out = out.withColumn(rank_col, F.col("_lrn") + F.coalesce(F.col(_BEFORE), F.lit(0)))
    if size_col:
        out = out.withColumn(size_col, F.coalesce(F.col("_total"), F.col("_lcnt")))
    return out.drop(_MID, _PID, _BEFORE, "_total", "_lrn", "_lcnt")


def join_on_rank(cand: DataFrame, ranked: DataFrame, keys: Sequence[str], rank_col: str,
                 low_ranks: int) -> DataFrame:
    """Join rank-bounded candidates to a ranked list on (keys, rank).

    Low ranks are wanted by every user (rank 1 once per user), so they are hot
    keys: they go through a broadcast of the ranked rows with rank <= low_ranks
    (at most low_ranks rows per key value - a proven bound). Higher ranks are
    reached only by users with many rated items and use a shuffle join, whose
    ranked side has one row per key, so AQE can split a hot one. With
    `low_ranks` 0 that join takes all ranks."""
    on = [*keys, rank_col]
    if low_ranks < 1:
        return cand.join(ranked, on)
    low = cand.filter(F.col(rank_col) <= low_ranks).join(
        F.broadcast(ranked.filter(F.col(rank_col) <= low_ranks)), on)
    high = cand.filter(F.col(rank_col) > low_ranks).join(
        ranked.filter(F.col(rank_col) > low_ranks), on)
    return low.unionByName(high)
