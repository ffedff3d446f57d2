"""Sharding by jump consistent hashing.

A row's shard follows from its key and the number of shards alone: a 64-bit
value of the key seeds a linear congruential sequence, and the key jumps from
shard to shard along it until the next jump would pass the last shard. There is
no ring and no table of shards, nothing is gathered, and a shard appended to n
others takes one row in n + 1, while all other rows stay where they are.

Rows are numbered within their shard over sorted ranges of (shard, key value), so
neither a shard nor a key that many rows share is sorted or numbered in one task.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkrec.operators.ranking import rank_within_groups
from sparkrec.session import materialize

#: The multiplier of the jump sequence and the bits of its draws.
MULTIPLIER = 2862933555777941757
DRAW_BITS = 31
#: Bytes that each row costs beside its text.
ROW_BYTES = 8


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard in 0..shards-1 of each 64-bit key."""
    if shards < 1:
        raise ValueError("there must be a shard")
    state = keys.astype(np.uint64)
    shard = np.zeros(len(state), np.int64)
    live = np.arange(len(state))
    while len(live):
        state[live] = state[live] * np.uint64(MULTIPLIER) + np.uint64(1)
        draw = (state[live] >> np.uint64(64 - DRAW_BITS)).astype(np.float64) + 1.0
        target = np.floor((shard[live] + 1) * (float(1 << DRAW_BITS) / draw))
        inside = target < shards
        live = live[inside]
        shard[live] = target[inside].astype(np.int64)
    return shard


def key_value(key: Column) -> Column:
    """64 evenly spread bits of a key's decimal or text form (null: of the empty text), as 8 bytes."""
    return F.unhex(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 16))


def _with_shards(df: DataFrame, value: str, counts: dict[str, int]) -> DataFrame:
    """`df` with one more column for each entry of `counts`: the shard among so many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = np.frombuffer(b"".join(b.column(value).to_pylist()), ">u8").astype(np.uint64)
            more = [pa.array(jump(keys, n).astype(np.int32)) for n in counts.values()]
            yield pa.RecordBatch.from_arrays([*b.columns, *more], [*b.schema.names, *counts])

    fields = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema), *(f"{c} int" for c in counts)])
    return df.mapInArrow(run, fields)


def shard(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shards: int = 24) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard: one row per row of `docs`.

    The shard follows from the id and the number of shards; ``grown_shard`` is the
    one with one shard more. ``size`` is the text's UTF-8 bytes and 8 for the row,
    ``text_crc32`` its checksum (null texts: as empty ones). ``slot`` numbers the
    rows of a shard from 0 without gaps, by key value, then id, checksum and size;
    equal rows take neighbouring slots. Rows that share an id share its shard, rows
    without id are keyed as the empty text. An empty table gives no rows.
    """
    raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    sized = docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(raw) + ROW_BYTES).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"),
        key_value(F.col(id_col)).alias("value"),
        F.monotonically_increasing_id().alias("tie"))  # splits rows equal in all else over ranges
    # written, as finding the ranges and dealing them out would else read every text twice
    sized = materialize(_with_shards(sized, "value", {"shard": shards, "grown_shard": shards + 1}), "shards")
    ranked = rank_within_groups(sized, ["shard"], ["value", "doc_id", "text_crc32", "size", "tie"], "slot")
    return ranked.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("slot") - 1).alias("slot"), "grown_shard")


def write_shards(docs: DataFrame, path: str, *, id_col: str = "doc_id", shards: int = 24, files: int = 1) -> None:
    """Write `docs` as Parquet under ``path/shard_no=K``, in `files` files a shard.

    All columns are kept, whatever their names. A shard's rows are dealt over its
    files by a hash of the whole row, so one id with many rows is split as well; choose
    `files` so that a file is written by one task.
    """
    own = {n: f"{n}_{uuid.uuid4().hex[:8]}" for n in ("value", "shard", "file")}
    if "shard_no" in docs.columns:
        raise ValueError("docs has a column shard_no, the name of the folders")
    placed = _with_shards(docs.withColumn(own["value"], key_value(F.col(id_col))), own["value"], {own["shard"]: shards})
    dealt = placed.withColumn(own["file"], F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]), F.lit(files)))
    (dealt.repartition(shards * files, own["shard"], own["file"])
     .select(*[F.col(f"`{c}`") for c in docs.columns], F.col(own["shard"]).alias("shard_no"))
     .write.partitionBy("shard_no").parquet(path))
