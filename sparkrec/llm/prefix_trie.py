"""Prefix trie of conversations by truncation peeling.

A node is a distinct sequence of first turns. Peeling starts at the deepest turn:
the conversations that end there and the nodes that have come up from below are
merged where their sequences are equal, which makes the nodes of that depth
with all their figures; then the last turn is stripped, and what is left is
grouped again one level up. A node's subtree is complete when it is made, so the
nodes are found and aggregated in the same pass.

Texts do not travel: a turn is a 16-byte hash, and a conversation's path is the
chain of hashes of its first 1, 2, ... turns with the words of each turn. Equal
conversations are one path from the start.

A round of Spark peels a band of levels. Paths that share their first `lo`
turns, the band's upper end, lie in one sorted group and are peeled to it in a
task. A group of more than `most_cells` turns in the band never goes into a task: its band
is halved and the lower half peeled first, by longer common beginnings; a band of a
single level is a plain aggregation with partial sums. So the number of rounds is
the logarithm of the longest conversation, and more only where very many different
conversations share a beginning.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkrec.llm.common import SPACES
from sparkrec.session import materialize

#: Bytes of a hash in a path, and of a count of words.
HASH, COUNT = 16, 8
#: Turns of a band that one group may bring into a task.
MOST_CELLS = 200_000
#: Bytes of joined ids that one row of a list of ended conversations holds, about.
PIECE = 1 << 13
NO_ONE = hashlib.sha256(b"").hexdigest()

PATHS = "conv_id long, depth long, path binary, words binary"
#: What lies at a depth before it is merged, and a merged node.
ITEM = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), ("path", pa.binary()), ("words", pa.binary()), ("n_convs", pa.int64()),
                  ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved", pa.int64()), ("ends", pa.string())])
NODE = pa.schema([("node", pa.binary()), ("parent", pa.binary()), *((f.name, f.type) for f in ITEM if f.name not in ("path", "words"))])
SQL_TYPES = {pa.int64(): "bigint", pa.binary(): "binary", pa.string(): "string"}


def n_words(text: Column) -> Column:
    """Words of a text: maximal runs without the six blanks."""
    blanks = "".join(f"\\x{{{c:02x}}}" for c in SPACES)
    return F.regexp_count(text, F.lit(f"[^{blanks}]+")).cast("long")


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id and its turns in order, each a hash of (role, text) and a number of words.

    Order: turn (null first), then the hash, so that turns of one number always come alike.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    said = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    return (conversations.where("conv_id IS NOT NULL")
            .select(F.col("conv_id").cast("long").alias("conv_id"), F.struct("turn", F.unhex(F.md5(said.cast("binary"))).alias("hash"), n_words(text).alias("words")).alias("turn"))
            .groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns")))


def rebuilt(turns: DataFrame, every: int = 20, heads: int = 4) -> DataFrame:
    """Each conversation behind the first turns of the one its block begins with.

    Block: conv_id - conv_id % every (as in SQL, the remainder has the id's sign). The number of turns taken, and left out of the
    conversation's own, is crc32 of its decimal id modulo `heads`.
    """
    took = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    first = turns.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("block"), F.slice("turns", 1, max(heads - 1, 1)).alias("head"))
    own = turns.select("conv_id", "turns", took.cast("int").alias("took"), (F.col("conv_id") - F.col("conv_id") % every).alias("block"))
    nothing = F.array().cast(turns.schema["turns"].dataType)
    rest = F.filter("turns", lambda _, i: i >= F.col("took"))
    head = F.filter(F.coalesce("head", nothing), lambda _, i: i < F.col("took"))
    return own.join(first, "block", "left").select("conv_id", F.concat(head, rest).alias("turns"))


def paths_of(turns: DataFrame) -> DataFrame:
    """conv_id, depth, path, words: the chain of hashes of each conversation's beginnings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            turn = b.column(1).flatten()
            hashes, words = turn.field("hash").to_pylist(), turn.field("words").to_numpy(zero_copy_only=False).astype(">i8")
            ends = np.cumsum([0, *b.column(1).value_lengths().to_pylist()])
            paths, counts = [], []
            for lo, hi in zip(ends[:-1], ends[1:]):
                chain, last = [], b""
                for h in hashes[lo:hi]:
                    last = hashlib.blake2b(last + h, digest_size=HASH).digest()
                    chain.append(last)
                paths.append(b"".join(chain))
                counts.append(words[lo:hi].tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.diff(ends)), pa.array(paths, pa.binary()), pa.array(counts, pa.binary())],
                ["conv_id", "depth", "path", "words"])

    return turns.mapInArrow(run, PATHS)


def at_depth(path: Column, depth: Column | int) -> Column:
    """The hash of a path's first `depth` turns (depth 0: no bytes)."""
    depth = F.lit(depth) if isinstance(depth, int) else depth
    return F.when(depth > 0, F.substring(path, ((depth - 1) * HASH + 1).cast("int"), F.lit(HASH))).otherwise(F.lit(b""))


def ended(paths: DataFrame) -> DataFrame:
    """One row per distinct conversation: conv_id (the smallest), n_convs, ends.

    ``ends`` is the SHA-256 of the ids that end in the node, ascending. Ids are put
    in order by ranges of (node, id), so the ids of a node with very many are
    joined to text by many tasks; one task takes those pieces in order through
    the hash, holding one piece at a time.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, low, ids, held = None, None, [], 0
        for b in batches:
            out = []
            for end, conv in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if ids and (end != node or held > PIECE):
                    out.append((node, low, len(ids), ",".join(ids)))
                    ids, held = [], 0
                if not ids:
                    node, low = end, conv
                ids.append(str(conv))
                held += len(ids[-1]) + 1
            if out:
                yield _batch(out, ["node", "conv_id", "n", "ids"])
        if ids:
            yield _batch([(node, low, len(ids), ",".join(ids))], ["node", "conv_id", "n", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, low, total, sha = None, None, 0, None
        for b in batches:
            out = []
            for end, conv, n, ids in zip(*(c.to_pylist() for c in b.columns)):
                if sha is not None and end != node:
                    out.append((low, total, sha.hexdigest()))
                    sha = None
                if sha is None:
                    node, low, total, sha = end, conv, n, hashlib.sha256(ids.encode())
                else:
                    total += n
                    sha.update(b"," + ids.encode())
            if out:
                yield _batch(out, ["conv_id", "n_convs", "ends"])
        if sha is not None:
            yield _batch([(low, total, sha.hexdigest())], ["conv_id", "n_convs", "ends"])

    ends = paths.select(at_depth(F.col("path"), F.col("depth")).alias("node"), "conv_id")
    parts = int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    joined = (ends.repartitionByRange(parts, "node", "conv_id").sortWithinPartitions("node", "conv_id")
              .mapInArrow(pieces, "node binary, conv_id long, n long, ids string"))
    return (joined.repartition(parts, "node").sortWithinPartitions("node", "conv_id")
            .mapInArrow(hashed, "conv_id long, n_convs long, ends string"))


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names)


def peel_block(rows: list[tuple], lo: int) -> tuple[list[tuple], list[tuple]]:
    """Peel `rows` (ITEMS tuples of whole groups, deeper than `lo`) down to depth `lo`.

    Returns the nodes (NODES tuples) and, for each group, one item at depth `lo`.
    """
    levels: dict[int, dict[bytes, list]] = defaultdict(dict)

    def put(depth: int, path: bytes, words: bytes, conv, convs: int, children: int, leaves: int, saved: int, ends) -> None:
        key = path[(depth - 1) * HASH:depth * HASH] if depth else b""
        node = levels[depth].get(key)
        if node is None:
            levels[depth][key] = [conv, path, words, convs, children, leaves, saved, ends]
        else:
            node[0] = min(node[0], conv)
            node[3] += convs
            node[4] += children
            node[5] += leaves
            node[6] += saved
            node[7] = node[7] or ends

    for conv, depth, path, words, convs, children, leaves, saved, ends in rows:
        put(depth, path, words, conv, convs, children, leaves, saved, ends)
    nodes = []
    for depth in range(max(levels, default=lo), lo, -1):
        for key, (conv, path, words, convs, children, leaves, saved, ends) in levels.pop(depth, {}).items():
            saved += (convs - 1) * int.from_bytes(words[(depth - 1) * COUNT:depth * COUNT], "big")
            leaves = leaves or 1
            nodes.append((key, path[(depth - 2) * HASH:(depth - 1) * HASH] if depth > 1 else b"", conv, depth, convs, children, leaves, saved, ends or NO_ONE))
            put(depth - 1, path, words, conv, convs, 1, leaves, saved, None)
    up = [(conv, lo, path[:lo * HASH], words[:lo * COUNT], convs, children, leaves, saved, ends)
          for conv, path, words, convs, children, leaves, saved, ends in levels.get(lo, {}).values()]
    return nodes, up


def _struct(schema: pa.Schema) -> str:
    return f"struct<{', '.join(f'{f.name}: {SQL_TYPES[f.type]}' for f in schema)}>"


def _peel_in_tasks(items: DataFrame, lo: int, most_cells: int) -> tuple[DataFrame, DataFrame]:
    """Nodes and rising items of groups that each fit in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, cells, last = [], 0, None

        def peel() -> pa.RecordBatch:
            nodes, up = peel_block(held, lo)
            nodes = [dict(zip(NODE.names, n)) for n in nodes] + [None] * len(up)
            up = [None] * (len(nodes) - len(up)) + [dict(zip(ITEM.names, u)) for u in up]
            return pa.RecordBatch.from_arrays([pa.array(nodes, pa.struct(list(NODE))), pa.array(up, pa.struct(list(ITEM)))], ["node", "item"])

        for b in batches:
            for key, *row in zip(*(c.to_pylist() for c in b.columns)):
                if key != last and cells >= most_cells:
                    yield peel()
                    held, cells = [], 0
                last = key
                held.append(tuple(row))
                cells += row[1] - lo
        if held:
            yield peel()

    done = materialize(
        items.withColumn("key", at_depth(F.col("path"), lo)).select("key", *ITEM.names)
        .repartition("key").sortWithinPartitions("key").mapInArrow(run, f"node {_struct(NODE)}, item {_struct(ITEM)}"), "trie")
    return done.where("node IS NOT NULL").select("node.*"), done.where("item IS NOT NULL").select("item.*")


def _peel_level(items: DataFrame, depth: int) -> tuple[DataFrame, DataFrame]:
    """Nodes of one depth and the items they send up, by one aggregation."""
    words = F.conv(F.hex(F.substring("words", (depth - 1) * COUNT + 1, COUNT)), 16, 10).cast("long")
    merged = (items.groupBy(at_depth(F.col("path"), depth).alias("node")).agg(
        F.min("conv_id").alias("conv_id"), F.first("path").alias("path"), F.first("words").alias("words"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"), F.max("ends").alias("ends")))
    own = (F.col("n_convs") - 1) * words if depth else F.lit(0)
    whole = materialize(merged.select(
        "node", at_depth(F.col("path"), max(depth - 1, 0)).alias("parent"), "conv_id", F.lit(depth).cast("long").alias("depth"), "n_convs", "n_children",
        F.greatest("n_leaves", F.lit(1)).cast("long").alias("n_leaves"), (F.col("saved") + own).cast("long").alias("saved"),
        F.coalesce("ends", F.lit(NO_ONE)).alias("ends"), "path", "words"), "trie")
    up = whole.select(
        "conv_id", (F.col("depth") - 1).alias("depth"), F.substring("path", 1, max(depth - 1, 0) * HASH).alias("path"),
        F.substring("words", 1, max(depth - 1, 0) * COUNT).alias("words"), "n_convs", F.lit(1).cast("long").alias("n_children"), "n_leaves", "saved",
        F.lit(None).cast("string").alias("ends"))
    return whole.drop("path", "words"), up


def peel(items: DataFrame, lo: int, hi: int, most_cells: int, emit: Callable[[DataFrame], None]) -> DataFrame:
    """Peel `items` of depths lo+1..hi to depth `lo`; their nodes go to `emit`."""
    if hi - lo == 1:
        nodes, up = _peel_level(items, hi)
        emit(nodes)
        return up
    key = at_depth(F.col("path"), lo)
    sizes = items.groupBy(key.alias("key")).agg(F.sum(F.col("depth") - lo).alias("cells"), F.count("*").alias("paths"))
    # a single path is one row, whatever its length
    hot = materialize(sizes.where((F.col("cells") > most_cells) & (F.col("paths") > 1)).select("key"), "trie-hot")
    n_hot = hot.count()
    if n_hot:  # at most one key for each `most_cells` turns of the input
        crowded = items.withColumn("key", key).join(hot, "key", "left_semi").drop("key")
        items = items.withColumn("key", key).join(hot, "key", "left_anti").drop("key")
    nodes, up = _peel_in_tasks(items, lo, most_cells)
    emit(nodes)
    if not n_hot:
        return up
    mid = (lo + hi) // 2
    rising = peel(crowded.where(F.col("depth") > mid), mid, hi, most_cells, emit)
    return up.unionByName(peel(crowded.where(F.col("depth") <= mid).unionByName(rising), lo, mid, most_cells, emit))


def trie(conversations: DataFrame, *, rebuild: bool = True, most_cells: int = MOST_CELLS) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256: one row per node.

    `conversations` has conv_id, turn, role and text. Turns are ordered by turn, null
    first, and those of one number by a hash of role and text; null roles and texts
    count as empty; repeated rows are repeated turns. Ids are whole numbers; rows without one belong to no
    conversation and are left out. With `rebuild`, conversations are those of `rebuilt`. A table
    without conversations has no node, not even a root. A conversation's path
    (24 bytes a turn) is one row.
    """
    ordered = turns_of(conversations.select("conv_id", "turn", "role", "text"))
    paths = materialize(paths_of(rebuilt(ordered) if rebuild else ordered), "trie-paths")
    items = materialize(paths.join(ended(paths), "conv_id").select(
        "conv_id", "depth", "path", "words", "n_convs", *(F.lit(0).cast("long").alias(c) for c in ("n_children", "n_leaves", "saved")), "ends"), "trie-ends")

    found: list[DataFrame] = []
    deepest = items.agg(F.max("depth")).first()[0] or 0
    hi = 1
    while hi < deepest:
        hi *= 2
    rising = None
    while hi >= 1:  # bands (hi/2, hi], the last one (0, 1]
        lo = hi // 2
        band = items.where((F.col("depth") > lo) & (F.col("depth") <= hi))
        band = band if rising is None else band.unionByName(rising)
        rising = peel(band, lo, hi, most_cells, found.append)
        hi = lo
    root, _ = _peel_level(items.where("depth = 0").unionByName(rising), 0)
    nodes = root
    for part in found:
        nodes = nodes.unionByName(part)
    parents = nodes.where("n_children > 0").select(
        F.col("node").alias("parent"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("parent_conv_id"))
    return nodes.join(parents, ["parent", "depth"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"))
