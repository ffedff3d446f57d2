"""Near-duplicate documents by one-permutation MinHash.

A text's set of word shingles is hashed once; the hash space is split into bins,
each bin keeps its smallest value, and empty bins borrow one by optimal
densification (a sequence of bins that depends only on the empty bin and the
attempt, so equal sets borrow alike). Bands of bins make the bucket keys.

Small sets fill few bins, and bands that borrow from the same few are not
independent. Up to SMALL shingles a set therefore has one sketch per band, each
under its own hash and with just the bins of that band; sets around the bound
have both kinds, so a pair on either side of it still meets.

Candidates are star-shaped: in a bucket, every set is paired with the smallest
document only. Links are confirmed on full sets. Where the Jaccard distances from
the centre leave room, by the triangle inequality, for links between other
members, those that the star leaves open meet the members of other components
within their bucket, in blocks of bounded size: exact bounds rule out nearly all
pairs there, and only links leave a block. So no link is lost to the shape of
the stars, and the pairs of a group of copies are never written.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrec.llm.common import SPACES, all_columns, components, free_name, materialize, mix64, text_blocks

ROWS = 5
BANDS = 40
#: Shingles up to which a set has one sketch per band.
SMALL = 150
BLOCK = 1 << 20
#: Members of a bucket in one side of a block, and hash values that bound their overlaps.
MEMBERS = 2000
SLOTS = 512
#: Shingles of the members of one side, about (a single longer set is one member).
MEMBER_SHINGLES = 2_000_000

_BASE = 0xC2B2AE3D27D4EB4F
_BYTE_VALUES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9FB21C651E98DF25))
_IS_SPACE = np.isin(np.arange(256), SPACES)
_LOWER = np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), np.arange(256) + 32, np.arange(256)).astype(np.uint8)


def shingle_sets(data: np.ndarray, bounds: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of the texts of a block: (text index, hash), sorted.

    Words are maximal runs of other bytes than the six spaces, A-Z lower-cased;
    a text with fewer words than `words` has the sequence of its words as its
    only shingle, one without words has none.
    """
    data = _LOWER[data]
    inner = ~_IS_SPACE[data]
    begins = inner.copy()
    begins[1:] &= ~inner[:-1]
    edge = bounds[1:-1]
    edge = edge[edge < len(data)]
    begins[edge] = inner[edge]
    ends = inner.copy()
    ends[:-1] &= ~inner[1:]
    ends[edge - 1] = inner[edge - 1]
    lo, hi = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    factors = np.full(len(data) + 1, _BASE, np.uint64)
    factors[:1] = 1
    up = np.cumprod(factors)
    factors[1:] = pow(_BASE, -1, 1 << 64)
    down = np.cumprod(factors)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * up[:-1], out=sums[1:])
    word = mix64((sums[hi] - sums[lo]) * down[lo] + (hi - lo).astype(np.uint64))
    text = np.searchsorted(bounds, lo, side="right") - 1
    count = np.bincount(text, minlength=len(bounds) - 1)
    first = np.cumsum(count) - count

    whole = (count > 0) & (count < words)
    n = np.where(count >= words, count - words + 1, whole.astype(np.int64))
    owner = np.repeat(np.arange(len(count)), n)
    at = first[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    shingle = np.zeros(len(owner), np.uint64)
    for k in range(words):  # a short text's shingle ends with its last word
        own = at + k < (first + count)[owner]
        shingle[own] = mix64(shingle[own] * np.uint64(0x9E3779B97F4A7C15) + word[at[own] + k] + np.uint64(k))
    order = np.lexsort((shingle, owner))
    owner, shingle = owner[order], shingle[order]
    fresh = np.ones(len(owner), bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (shingle[1:] != shingle[:-1])
    return owner[fresh], shingle[fresh]


def densified(owner: np.ndarray, shingle: np.ndarray, texts: int, bins: int) -> np.ndarray:
    """texts x bins sketch: smallest hash per bin, empty bins densified.

    `owner` is sorted and holds every text.
    """
    none = np.uint64(0xFFFFFFFFFFFFFFFF)
    sketch = np.full(texts * bins, none)
    place = (((shingle >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)).astype(np.int64)
    if bins <= 8:
        begins = np.searchsorted(owner, np.arange(texts))
        for k in range(bins):
            sketch[k::bins] = np.minimum.reduceat(np.where(place == k, shingle, none), begins)
    else:  # the hashes of a text are sorted, so the first of a bin is its smallest
        at = owner * bins + place
        first = np.ones(len(at), bool)
        first[1:] = at[1:] != at[:-1]
        sketch[at[first]] = shingle[first]
    sketch = sketch.reshape(texts, bins)
    filled = sketch != none
    row, empty = np.nonzero(~filled)
    attempt = 0
    while len(row):
        attempt += 1
        source = (mix64(empty.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25) + np.uint64(attempt)) % np.uint64(bins)).astype(np.int64)
        hit = filled[row, source]
        sketch[row[hit], empty[hit]] = sketch[row[hit], source[hit]]
        row, empty = row[~hit], empty[~hit]
    return sketch


def band_keys(sketch: np.ndarray, first_band: int) -> np.ndarray:
    """One 64-bit key per text and band of ROWS bins."""
    texts, bins = sketch.shape
    rows = sketch.reshape(texts, bins // ROWS, ROWS)
    key = np.zeros(rows.shape[:2], np.uint64) + np.arange(first_band, first_band + rows.shape[1], dtype=np.uint64)
    for k in range(ROWS):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, :, k])
    return key


def keys_of(owner: np.ndarray, shingle: np.ndarray, texts: int, percent: int) -> list[np.ndarray]:
    """Bucket keys of every text (none for one without shingles).

    Two similar sets of which one has at most SMALL shingles both have at most
    SMALL * 100 / percent; all other pairs are above SMALL.
    """
    size = np.bincount(owner, minlength=texts)
    out = [np.zeros(0, np.uint64)] * texts
    for who, small in ((np.flatnonzero(size > SMALL), False), (np.flatnonzero((size > 0) & (size * percent <= SMALL * 100)), True)):
        if not len(who):
            continue
        chosen = np.zeros(texts, bool)
        chosen[who] = True
        own, hashes = np.searchsorted(who, owner[chosen[owner]]), shingle[chosen[owner]]
        if small:
            keys = np.concatenate([band_keys(densified(own, mix64(hashes ^ mix64(np.array([band + 1], np.uint64))), len(who), ROWS), BANDS + band)
                                   for band in range(BANDS)], axis=1)
        else:
            keys = band_keys(densified(own, hashes, len(who), ROWS * BANDS), 0)
        for i, k in zip(who, keys):
            out[i] = np.concatenate([out[i], k])
    return out


def set_hashes(owner: np.ndarray, shingle: np.ndarray, texts: int, k: int) -> np.ndarray:
    """The k-th 64-bit hash of every text's set (0 for an empty one)."""
    size = np.bincount(owner, minlength=texts)
    total = np.zeros(texts, np.uint64)
    has = np.flatnonzero(size)
    if len(has):
        total[has] = np.add.reduceat(mix64(shingle + np.uint64(k)), (np.cumsum(size) - size)[has])
    return total.view(np.int64)


def _sign(words: int, percent: int):
    """Texts to (doc_id, n_shingles, h1, h2, keys); h1 and h2 identify the set."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, data, bounds in text_blocks(batches, BLOCK):
            owner, shingle = shingle_sets(data, bounds, words)
            size = np.bincount(owner, minlength=len(ids))
            keys = [k.view(np.int64) for k in keys_of(owner, shingle, len(ids), percent)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(size), *(pa.array(set_hashes(owner, shingle, len(ids), k)) for k in range(2)), pa.array(keys, pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "h1", "h2", "keys"])

    return run


def _sets(words: int):
    """Texts to (doc, shingles): the first hash of the set, which names it, and the
    full set as sorted 64-bit hashes; a task gives equal sets once."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: set[int] = set()
        for ids, data, bounds in text_blocks(batches, BLOCK):
            owner, shingle = shingle_sets(data, bounds, words)
            cut = np.searchsorted(owner, np.arange(len(ids) + 1))
            docs, sets = [], []
            for doc, a, b in zip(set_hashes(owner, shingle, len(ids), 0).tolist(), cut, cut[1:]):
                if doc not in given:
                    given.add(doc)
                    docs.append(doc)
                    sets.append(shingle[a:b].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(sets, pa.binary())], ["doc", "shingles"])

    return run


def _overlaps(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, left, right) to (a, b, shared, united)."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 1000):
            b = batch.slice(lo, 1000)
            shared, united = [], []
            for x, y in zip(b.column(2), b.column(3)):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                at = np.searchsorted(x, y)
                same = int((x[np.minimum(at, len(x) - 1)] == y).sum()) if len(x) and len(y) else 0
                shared.append(same)
                united.append(len(x) + len(y) - same)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(shared, pa.int64()), pa.array(united, pa.int64())], ["a", "b", "shared", "united"])


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) with their Jaccard distance and whether they link, on full sets."""
    sided = pairs.join(sets.select(F.col("doc").alias("b"), F.col("shingles").alias("right")), "b")
    both = sided.join(sets.select(F.col("doc").alias("a"), F.col("shingles").alias("left")), "a").select("a", "b", "left", "right")
    found = both.mapInArrow(_overlaps, "a long, b long, shared long, united long")
    return materialize(found.select("a", "b", (1 - F.col("shared") / F.col("united")).alias("d"), (100 * F.col("shared") >= percent * F.col("united")).alias("link")), "verified")


def _pair(x: str, y: str) -> list[F.Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _alike(m: str, n: str, percent: int) -> F.Column:
    """Sets of sizes m and n can reach the similarity at all."""
    return 100 * F.least(m, n) >= percent * F.greatest(m, n)


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per input row.

    Texts link if their sets of `words`-word shingles have a Jaccard similarity
    of at least `percent` per cent; a component is what links connect and is
    named by its smallest id. Null and empty texts, and texts without words,
    link with nothing. Ids are whole numbers; a row without id is kept, links
    nothing and has at most the component of an equal set, and rows that repeat an id
    are judged by their own texts: sets link, and ids only name their components.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    signed = materialize(texts.mapInArrow(_sign(words, percent), "doc_id long, n_shingles long, h1 long, h2 long, keys array<long>"), "signatures")
    leads = _leads(signed)
    member = _components(texts, signed, words, percent).withColumnRenamed("node", "h1")
    names = member.join(leads, "h1").groupBy("component").agg(F.min("lead").alias("name"))
    named = member.join(names, "component").select("h1", "name")
    rows = (signed.where("n_shingles > 0").select("doc_id", "n_shingles", "h1", "h2").join(leads, ["h1", "h2"], "left")
            .join(named, "h1", "left").select("doc_id", "n_shingles", F.coalesce("name", "lead", "doc_id").alias("component_id")))
    alone = signed.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return rows.union(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _leads(signed: DataFrame) -> DataFrame:
    """The smallest id of every distinct set."""
    return signed.where("n_shingles > 0 and doc_id is not null").groupBy("h1", "h2").agg(F.min("doc_id").alias("lead"))


def _components(texts: DataFrame, signed: DataFrame, words: int, percent: int) -> DataFrame:
    """(node, component) of the confirmed links between different sets, named by their
    first hash; enough links to connect every pair that shares a bucket and links."""
    reach = 1 - percent / 100
    own = signed.join(_leads(signed).withColumnRenamed("lead", "doc_id"), ["h1", "h2", "doc_id"], "left_semi")
    bands = own.select(F.explode("keys").alias("key"), F.col("h1").alias("doc"), F.col("n_shingles").alias("n"))
    centres = bands.groupBy("key").agg(F.min(F.struct("doc", "n")).alias("c"), F.max("doc").alias("last")).where("c.doc < last").select(
        "key", F.col("c.doc").alias("centre"), F.col("c.n").alias("centre_n"))
    stars = materialize(bands.join(centres, "key").where("doc != centre"), "stars")
    needed = stars.select("doc").union(stars.select("centre")).distinct()
    where = own.join(needed, own["h1"] == needed["doc"], "left_semi").select("doc_id").distinct()
    # further texts under these ids give sets that no pair asks for
    sets = materialize(texts.join(where, "doc_id", "left_semi").mapInArrow(_sets(words), "doc long, shingles binary"), "sets")

    def rays(rows: DataFrame) -> DataFrame:
        return rows.where(_alike("n", "centre_n", percent)).select(*_pair("centre", "doc")).distinct()

    tested = _verify(rays(stars), sets, percent)
    # what a bucket still leaves open: members that the centre doesn't link, if they may link with another one
    seen = stars.join(tested.select(F.col("a").alias("centre"), F.col("b").alias("doc"), "d", "link"), ["centre", "doc"], "left")
    open_ = ~F.coalesce("link", F.lit(False))
    state = seen.groupBy("key").agg(
        F.count_if(open_).alias("n_open"), F.max(F.when(F.col("link"), F.col("d"))).alias("rim"), F.min(F.when(open_, F.coalesce("d", F.lit(reach)))).alias("nearest"))
    state = state.where((F.col("n_open") > 1) | (F.col("nearest") <= F.col("rim") + reach))
    rest = materialize(seen.join(state.select("key"), "key").select("key", "doc", "n", "d", open_.alias("open")), "open")
    named = components(tested.where("link"), "a", "b")
    if rest.isEmpty():
        return named
    # members that still lie in another component than a member of their bucket, in blocks: open ones against all
    rest = rest.join(named.withColumnRenamed("node", "doc"), "doc", "left").withColumn("part", F.coalesce("component", "doc")).drop("component")
    mixed = rest.groupBy("key").agg(
        F.min("part").alias("low"), F.max("part").alias("high"),
        F.ceil(F.greatest(F.count_if("open") / MEMBERS, F.sum(F.when(F.col("open"), F.col("n")).otherwise(0)) / MEMBER_SHINGLES)).cast("int").alias("n_x"),
        F.ceil(F.greatest(F.count("*") / MEMBERS, F.sum("n") / MEMBER_SHINGLES)).cast("int").alias("n_y")).where("low < high and n_x > 0").select("key", "n_x", "n_y")
    rows = rest.join(mixed, "key").join(sets, "doc").withColumn("salt", F.xxhash64("doc"))
    x, y = F.pmod("salt", "n_x").cast("int"), F.pmod(F.shiftright("salt", 20), "n_y").cast("int")
    as_x = rows.where("open").select("*", F.lit(True).alias("is_x"), x.alias("x"), F.explode(F.sequence(F.lit(0), F.col("n_y") - 1)).alias("y"))
    as_y = rows.select("*", F.lit(False).alias("is_x"), F.explode(F.sequence(F.lit(0), F.col("n_x") - 1)).alias("x"), y.alias("y"))
    columns = ["key", "x", "y", "is_x", "doc", "n", "d", "part", "shingles"]
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = as_x.select(columns).union(as_y.select(columns)).repartition(parts, "key", "x", "y").sortWithinPartitions("key", "x", "y")
    last = materialize(blocks.mapInArrow(_cross(percent), "a long, b long").distinct(), "cross")
    if last.isEmpty():
        return named
    return components(last.union(named.select(F.col("node").alias("a"), F.col("component").alias("b"))), "a", "b")


def _cross(percent: int):
    """Blocks of bucket members, sorted by (key, x, y), to links between components."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        out: list[tuple[int, int]] = []
        for b in batches:
            for row in zip(*(b.column(k).to_pylist() for k in range(b.num_columns))):
                if held and row[:3] != held[-1][:3]:
                    out += cross_links(held, percent)
                    held = []
                held.append(row)
        out += cross_links(held, percent)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)] or [pa.array([], pa.int64())] * 2, ["a", "b"])

    return run


def cross_links(rows: list[tuple], percent: int) -> list[tuple[int, int]]:
    """Links between the open members and the members of a block that lie in
    different components, one for each open member and component.

    Exact: pairs are ruled out by size, by the triangle inequality over the
    distances to the bucket's centre, and by an upper bound on the overlap (the
    overlap of the sets' histograms over SLOTS hash values); the rest is
    compared on full sets.
    """
    sides = [[r for r in rows if r[3] == flag] for flag in (True, False)]
    if not sides[0] or not sides[1]:
        return []
    doc, n, part = ([np.array([r[k] for r in side], np.int64) for side in sides] for k in (4, 5, 7))
    d = [np.array([np.nan if r[6] is None else r[6] for r in side]) for side in sides]
    sets = [[np.frombuffer(r[8], np.uint64) for r in side] for side in sides]
    counts = []
    for side in sets:
        owner = np.repeat(np.arange(len(side)), [len(x) for x in side])
        slot = (np.concatenate(side) % np.uint64(SLOTS)).astype(np.int64)
        counts.append(np.minimum(np.bincount(owner * SLOTS + slot, minlength=len(side) * SLOTS), 0xFFFF).astype(np.uint16).reshape(-1, SLOTS))
    links = []
    for i in range(len(doc[0])):
        least, most = np.minimum(n[0][i], n[1]), np.maximum(n[0][i], n[1])
        fit = (part[1] != part[0][i]) & (100 * least >= percent * most) & ~(np.abs(d[1] - d[0][i]) > 1 - percent / 100 + 1e-9)
        who = np.flatnonzero(fit)
        if not len(who):
            continue
        bound = np.minimum(counts[0][i], counts[1][who]).sum(axis=1, dtype=np.int64)
        who = who[100 * bound >= percent * (n[0][i] + n[1][who] - bound)]
        found: set[int] = set()
        for j in who:
            if part[1][j] in found:
                continue
            a, b = sets[0][i], sets[1][j]
            at = np.minimum(np.searchsorted(a, b), len(a) - 1)
            shared = int((a[at] == b).sum())
            if 100 * shared >= percent * (len(a) + len(b) - shared):
                found.add(part[1][j])
                links.append((int(min(doc[0][i], doc[1][j])), int(max(doc[0][i], doc[1][j]))))
    return links


def drop_near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """`docs` with one row of each component, all columns kept.

    Rows are told apart by a number of their own, so ids may be null or repeated.
    The row with the smallest id stays (null last, then by a hash of the text);
    rows without words link with nothing and stay.
    """
    row = free_name("row_no", docs)
    numbered = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    judged = near_duplicates(numbered, id_col=row, text_col=text_col, words=words, percent=percent)
    who = numbered.select(F.col(row).alias("row"), F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text_col)).alias("hash"))
    rows = judged.select(F.col("doc_id").alias("row"), "component_id").join(who, "row")
    first = rows.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "hash", "row")).alias("first")).select("first.row")
    gone = rows.select("row").join(first, "row", "left_anti").select(F.col("row").alias(row))
    return numbered.join(gone, row, "left_anti").select(all_columns(docs))
