"""Best-fit packing into bins of several permitted lengths.

Lengths are whole numbers up to the largest capacity, so the corpus is described
by its histogram: at most that many rows, whatever its size. The plan is made on
the histogram, with all items of a length (and all bins of equal content)
handled at once: longest first, each into the open bin with the least room that
suffices; where none does, a bin of the capacity with the least cost per byte,
judged by what the remaining lengths could fill it with; at the end every bin is
cut down to the smallest capacity that holds its contents. Plans for the
capacities together and for each alone are compared by cost, and the best is
taken.

Spark then numbers the items of each length (frequent lengths are split over
many tasks first) and every item looks its number up in the plan.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkrec.llm.common import materialize

#: Items of one length that are numbered in one task.
NUMBERED = 100_000
#: Bits for an item's number beside its length in a lookup key.
NUMBER_BITS = 40


def default_cost(capacity: int, largest: int) -> float:
    """A share per byte, and one for attention, which grows with the square."""
    return capacity * (1 + 0.25 * capacity / largest)


@dataclass
class Plan:
    """Runs of items (by length and first number): first bin, items per bin and
    offset in the bin; and runs of equal bins (by first bin): their capacity."""

    run_keys: np.ndarray
    run_first: np.ndarray
    run_bin: np.ndarray
    run_per_bin: np.ndarray
    run_offset: np.ndarray
    bin_first: np.ndarray
    bin_count: np.ndarray
    bin_used: np.ndarray
    bin_capacity: np.ndarray
    cost: float

    def locate(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bin, capacity and offset of the items with these lengths and numbers."""
        at = np.searchsorted(self.run_keys, (length << NUMBER_BITS) + number, side="right") - 1
        inside = number - self.run_first[at]
        bins = self.run_bin[at] + inside // self.run_per_bin[at]
        return bins, self.bin_capacity[np.searchsorted(self.bin_first, bins, side="right") - 1], self.run_offset[at] + inside % self.run_per_bin[at] * length


def best_plan(counts: dict[int, int], capacities: Sequence[int], cost: Callable[[int, int], float] = default_cost) -> Plan:
    """The cheapest of the joint plan and the plans for the largest capacity
    with each smaller one, and alone; all are downsized to any permitted length."""
    sizes = sorted(set(capacities))
    choices = [sizes, [sizes[-1]], *([c, sizes[-1]] for c in sizes[:-1] if len(sizes) > 2)]
    return min((make_plan(counts, own, sizes, cost) for own in choices), key=lambda p: p.cost)


def make_plan(counts: dict[int, int], opened: Sequence[int], permitted: Sequence[int], cost: Callable[[int, int], float]) -> Plan:
    lengths = sorted(counts)
    left = dict(counts)
    largest = permitted[-1]
    rooms: list[int] = []  # distinct rooms of open bins, rising
    open_: dict[int, list[tuple[int, int, int]]] = {}  # room: runs of bins (first bin, count, used)
    closed: list[tuple[int, int, int]] = []
    runs: list[tuple[int, int, int, int, int]] = []
    next_bin = 0

    def put(room: int, bins: tuple[int, int, int]) -> None:
        if not room:
            closed.append(bins)
        elif room in open_:
            open_[room].append(bins)
        else:
            open_[room] = [bins]
            insort(rooms, room)

    def filled(capacity: int, top: int) -> int:
        """Bytes in a new bin when the longest remaining items that fit go in, in turn."""
        room, hi = capacity, top + 1
        while room:
            i = bisect_right(lengths, room, 0, hi) - 1
            if i < 0:
                break
            room -= min(left[lengths[i]], room // lengths[i]) * lengths[i]
            hi = i
        return capacity - room

    for top in range(len(lengths) - 1, -1, -1):
        length, number = lengths[top], 0
        while left[length]:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, count, used = open_[room].pop()
                if not open_[room]:
                    del open_[room]
                    del rooms[at]
            else:
                room = min((c for c in opened if c >= length), key=lambda c: (cost(c, largest) / filled(c, top), c))
                per = room // length
                first, count, used = next_bin, max(1, left[length] // per), 0
                next_bin += count
            per = min(room // length, left[length])
            bins = min(count, left[length] // per)
            runs.append((length, number, first, per, used))
            number += bins * per
            left[length] -= bins * per
            put(room - per * length, (first, bins, used + per * length))
            if bins < count:
                put(room, (first + bins, count - bins, used))
    groups = sorted([*closed, *(b for own in open_.values() for b in own)])
    runs.sort()
    columns = [np.array(c, np.int64) for c in zip(*runs)] or [np.zeros(0, np.int64)] * 5
    first, count, used = [np.array(c, np.int64) for c in zip(*groups)] or [np.zeros(0, np.int64)] * 3
    capacity = np.array(permitted, np.int64)[np.searchsorted(permitted, used)]
    total = float(sum(n * cost(int(c), largest) for n, c in zip(count, capacity)))
    return Plan((columns[0] << NUMBER_BITS) + columns[1], columns[1], columns[2], columns[3], columns[4], first, count, used, capacity, total)


def pack(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", capacities: Sequence[int] = (2048, 4096, 8192, 16384),
         cost: Callable[[int, int], float] = default_cost) -> DataFrame:
    """doc_id, piece, start, n_bytes, bin_id, capacity, bin_offset: one row per piece.

    The length of a text is its number of UTF-8 bytes (the tokens of a byte-level
    model). Texts above the largest capacity are cut into pieces of that length
    and a rest. Null and empty texts take no room: they have one piece of no
    bytes, without a bin. Ids may be null or repeated; every row is packed.
    """
    largest = max(capacities)
    if largest >= 1 << (62 - NUMBER_BITS):
        raise ValueError("capacities are too large for the lookup keys")
    id_type = docs.schema[id_col].dataType.simpleString()
    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long")
    sized = docs.select(F.col(id_col).alias("doc_id"), size.alias("size"), F.xxhash64(text_col).alias("digest"))
    pieces = sized.select("doc_id", "size", "digest", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0), F.ceil(F.col("size") / largest) - 1))).alias("piece"))
    pieces = materialize(pieces.select(
        "doc_id", "digest", "piece", (F.col("piece") * largest).alias("start"), F.least(F.lit(largest), F.col("size") - F.col("piece") * largest).alias("n_bytes")), "pieces")
    items = pieces.where("n_bytes > 0")
    histogram = items.groupBy("n_bytes").count()  # at most `largest` rows
    plan = best_plan({r["n_bytes"]: r["count"] for r in histogram.collect()}, capacities, cost)

    split = histogram.select("n_bytes", F.ceil(F.col("count") / NUMBERED).alias("parts"))
    dealt = items.join(F.broadcast(split), "n_bytes").withColumn("salt", F.pmod(F.xxhash64("doc_id", "digest", "piece"), "parts"))
    order = Window.partitionBy("n_bytes", "salt").orderBy("doc_id", "digest", "piece")
    before = Window.partitionBy("n_bytes").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy("n_bytes", "salt").count().select("n_bytes", "salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    numbered = dealt.withColumn("own", F.row_number().over(order) - 1).join(offsets, ["n_bytes", "salt"]).select(
        "doc_id", "piece", "start", "n_bytes", (F.col("own") + F.col("before")).alias("number"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bins, capacity, offset = plan.locate(b.column("n_bytes").to_numpy(), b.column("number").to_numpy())
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(bins), pa.array(capacity), pa.array(offset)],
                                             ["doc_id", "piece", "start", "n_bytes", "bin_id", "capacity", "bin_offset"])

    packed = numbered.mapInArrow(place, f"doc_id {id_type}, piece long, start long, n_bytes long, bin_id long, capacity long, bin_offset long")
    empty = pieces.where("n_bytes <= 0").select("doc_id", "piece", "start", "n_bytes", *(F.lit(None).cast("long").alias(c) for c in ("bin_id", "capacity", "bin_offset")))
    return packed.union(empty)
