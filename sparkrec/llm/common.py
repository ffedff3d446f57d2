"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkrec.session import materialize

#: Bytes that separate words: the space and the controls 0x09-0x0D.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def pick(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The id and the text (null: empty) as ``doc_id`` and ``text``.

    Every operator starts from this projection, so further columns of `docs`,
    whatever their names, neither clash with result columns nor are read.
    """
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def rewrite_texts(docs: DataFrame, rewrite: Callable[[str], str | None], text_col: str = "text") -> DataFrame:
    """`docs` with each text (null: empty) replaced; rows whose new text is None go.

    All other columns pass through; ``n_chars``, where there is such a column of
    whole numbers, becomes the length of the new text.
    """
    chars = docs.schema["n_chars"].dataType.simpleString() if "n_chars" in docs.columns else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                b = batch.slice(at, 500)
                new = [rewrite(t.as_py() or "") for t in b.column(b.schema.get_field_index(text_col))]
                b = b.filter(pa.array([t is not None for t in new], pa.bool_()))
                new = [t for t in new if t is not None]
                fresh = {text_col: new} | ({"n_chars": [len(t) for t in new]} if chars in ("int", "bigint") else {})
                yield pa.RecordBatch.from_arrays(
                    [pa.array(fresh[f.name], f.type) if f.name in fresh else b.column(i) for i, f in enumerate(b.schema)], schema=b.schema)

    return docs.mapInArrow(run, docs.schema)


def free_name(name: str, docs: DataFrame) -> str:
    """`name`, or with more underscores, so that no column of `docs` has it in any case."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def all_columns(docs: DataFrame) -> list[Column]:
    """The columns of `docs`, whatever characters their names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]


def text_blocks(batches: Iterable[pa.RecordBatch], block_bytes: int) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """Cut Arrow batches of (doc_id, text) into blocks of whole documents.

    Yields (doc_ids, bytes, starts): one uint8 array with the documents laid end
    to end, and the start of each (one more entry for the end). A block holds
    at most `block_bytes`, or a single longer document.
    """
    ids: list = []
    parts: list[bytes] = []
    held = 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            raw = text.as_py().encode()
            if ids and held + len(raw) > block_bytes:
                yield _block(ids, parts)
                ids, parts, held = [], [], 0
            ids.append(doc_id)
            parts.append(raw)
            held += len(raw)
    if ids:
        yield _block(ids, parts)


def _block(ids: list, parts: list[bytes]) -> tuple[list, np.ndarray, np.ndarray]:
    starts = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) for p in parts], out=starts[1:])
    return ids, np.frombuffer(b"".join(parts), np.uint8), starts


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads the bits of each value (a bijection)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def components(edges: DataFrame, left: str = "src", right: str = "dst") -> DataFrame:
    """Connected components of undirected `edges` as (node, component).

    ``component`` is the smallest node that can be reached; nodes without an
    edge to another node do not appear. Alternating star contraction: each node
    hangs its larger neighbours, then its smaller ones, on the smallest it
    knows, until every component is one star. The number of rounds grows with
    the logarithm of the size of a component; edges stay distributed and each
    round is written to the shared checkpoint folder. A hub is split by AQE's
    skew join, since the joined minima have one row per node.
    """
    a, b = F.col(left), F.col(right)
    stars = materialize(
        edges.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    state = _fingerprint(stars)
    while True:
        both = stars.union(stars.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v != m")
                 .select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))).distinct())
        stars = materialize(small, "edges")
        last, state = state, _fingerprint(stars)
        if state == last:
            return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _fingerprint(edges: DataFrame) -> tuple:
    """Row count and a sum of row hashes: equal for equal edge sets."""
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)
