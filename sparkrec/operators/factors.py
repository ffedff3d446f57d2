"""Truncated-SVD matrix factorisation.

Model: mu = mean stored rating; A = ratings - mu on stored cells (missing
cells stay 0); A ~ U S V^T of rank k; prediction = mu + (U S)_u . V_i,
clipped to [1, 5]; an unseen user or item gets mu.

* G2 finds the leading eigenvectors of A^T A and ends when the residual
  |A^T A v - s^2 v| of every one of the k vectors is at most `tolerance` x s_1^2; it
  raises if it doesn't get there.
  While a basis of vectors over the items is within `local_bytes`, block Lanczos
  with thick restarts keeps it on the driver, and one product is one pass over the
  ratings, packed by user: each task multiplies a block of vectors by its users'
  rows and their transpose at once, and the results are summed by slices of items.
  Beyond, Chebyshev-filtered subspace iteration needs no basis. Its vectors are tables
  of dense blocks. A filter treats every column alone: while a column of each side is
  within `local_bytes`, the driver sends a few columns at a time to tasks that hold
  whole rows of the ratings (packed by user and by item), so no product is shuffled.
  Beyond that, blocks are joined with packed cells on the block number; tasks add up
  what they can and send only rows that aren't zero.
  U S is A V, never formed from U.
* G4 scores users in Arrow batches with `mapInPandas`, against one slice of V
  after another where V is larger than the broadcast bound, and keeps
  n + (#rated) candidates per user before the anti-join of rated items.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkrec.operators.ranking import global_rank, top_n_per
from sparkrec.session import materialize

# Predictions are clipped to the 1..5 star range.
CLIP_MIN, CLIP_MAX = 1.0, 5.0
SLICE_BYTES = 1 << 28               # item factors that scoring broadcasts at once
SCORE_PLACES = 10
SCORE_BLOCK_CELLS = 4_000_000       # user x item scores held at once in a Python worker
BLOCK = 1024                        # users or items of a block
RCOND = 1e-7                        # singular values below this x s_1 are noise
LOCAL_BYTES = 1 << 28               # doubles over the items that the driver may hold; a task holds a few hundredths
BASIS_BLOCKS = 48                   # blocks of Lanczos vectors before a restart, at most; at least 4
CELLS_PER_TASK = 16_000_000         # ratings that one task multiplies, about
CHUNK_CELLS = 100_000               # ratings of a packed row
LONG_ROW = 512                      # a user's or item's ratings that are multiplied alone
SLICES = 16                         # parts of a product, by items
CHECK_EVERY = 3                     # products between two tests of the residuals
DEGREE = 32                         # of the filter between two rotations, at most
PROBES = 8                          # residual vectors that show where the filter has to begin, at most
TOLERANCE = 1e-6                    # residual over s_1^2 at which a vector counts as found
MOST_PRODUCTS = 2000                # not converged by then: an error
HELD_BLOCKS = 32                    # dense blocks that a task adds up before it sends them


@dataclass
class SVDModel:
    global_mean: float
    singular_values: list[float]
    item_factors: DataFrame   # item_id, item_idx, factors array<double> (rows of V)
    user_factors: DataFrame   # user_id, factors array<double> (rows of U S = A V)
    residual: float = 0.0     # largest |A^T A v - s^2 v| / s_1^2 when training ended
    products: int = 0         # multiplications by A^T A that it took

    @property
    def k(self) -> int:
        return len(self.singular_values)


def item_index(train: DataFrame) -> DataFrame:
    """G1 index table: item_id -> dense 0-based item_idx in item_id order
    (distributed rank, no single-task window)."""
    items = train.select("item_id").distinct()
    return global_rank(items, ["item_id"], "item_idx").withColumn(
        "item_idx", F.col("item_idx") - 1)


def rating_matrix(train: DataFrame) -> tuple[DataFrame, DataFrame, float, int, int]:
    """G1: COO entries (user_id, item_id, item_idx, value = rating - mu), the item
    index, and on the driver mu and the numbers of items (columns) and ratings."""
    idx = materialize(item_index(train), "svd_items")
    mu, n = train.agg((F.sum("rating") / F.count("rating")).alias("mu"), F.count("rating").alias("n")).first()
    n_items = idx.count()
    entries = (train.select("user_id", "item_id", "rating").join(idx, "item_id")
               .select("user_id", "item_id", "item_idx",
                       (F.col("rating") - F.lit(mu)).alias("value")))
    return entries, idx, mu, n_items, n


def _rows_times(rows: np.ndarray, cols: np.ndarray, v: np.ndarray, x: np.ndarray, out: np.ndarray) -> None:
    """out[rows] += v x[cols], for `rows` in order; in slices that stay in the cache."""
    for lo in range(0, len(v), 20_000):
        r = rows[lo:lo + 20_000]
        first = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]]))
        out[r[first]] += np.add.reduceat(v[lo:lo + 20_000, None] * x[cols[lo:lo + 20_000]], first, axis=0)


def _packer(rows):
    """For mapInArrow over cells (key, other, value) in the order of their keys: the rows
    of about CHUNK_CELLS cells at a time, all cells of a key together."""
    def pack(batches):
        keys, others, values = [], [], []
        for b in batches:
            k, o, v = (b.column(c).to_numpy() for c in range(3))
            keys.append(k), others.append(o), values.append(v)
            if sum(map(len, keys)) >= CHUNK_CELLS:
                k, o, v = (np.concatenate(x) for x in (keys, others, values))
                end = int(np.searchsorted(k, k[-1]))  # the last key may go on in the next batch
                if end:
                    yield from rows(k[:end], o[:end], v[:end])
                keys, others, values = [k[end:]], [o[end:]], [v[end:]]
        if keys and sum(map(len, keys)):
            yield from rows(*(np.concatenate(x) for x in (keys, others, values)))

    return pack


def _jagged(key: np.ndarray, other: np.ndarray, v: np.ndarray):
    """Packed rows of cells in the order of their keys: the first cell of every key, then
    the second of those that have one, and so on, keys with most cells first. So a product
    adds up whole columns. A key of very many cells gets a row of its own."""
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    counts = np.diff(np.append(first, len(key)))
    nth = np.arange(len(key)) - np.repeat(first, counts)
    place = np.empty(len(first), np.int64)
    for own in [counts <= LONG_ROW] + [np.arange(len(first)) == k for k in np.flatnonzero(counts > LONG_ROW)]:
        keys = np.flatnonzero(own)
        if len(keys):
            keys = keys[np.argsort(-counts[keys], kind="stable")]
            place[keys] = np.arange(len(keys))
            cells = np.flatnonzero(np.repeat(own, counts))
            cells = cells[np.lexsort((np.repeat(place, counts)[cells], nth[cells]))]
            values, code = np.unique(v[cells], return_inverse=True)  # ratings have few values: a byte each
            if len(values) > 256:
                values, code = v[cells], code[:0]
            cols = [key[first[keys]].astype(np.int32), counts[keys].astype(np.int32), other[cells].astype(np.int32), values.astype(np.float64), code.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in cols], ["ids", "counts", "other", "v", "code"])


def _jagged_times(counts: np.ndarray, other: np.ndarray, v: np.ndarray, code: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Each key's sum of v x[other]."""
    if len(code):
        v = v[code]
    y, at = np.zeros((len(counts), x.shape[1])), 0
    if len(counts) == 1:
        for lo in range(0, len(v), 20_000):
            y[0] += v[lo:lo + 20_000] @ x.take(other[lo:lo + 20_000], axis=0)
        return y
    for n in np.searchsorted(-counts, -np.arange(counts[0])).tolist():  # keys with more cells than the loop has passed
        part = x.take(other[at:at + n], axis=0)
        part *= v[at:at + n, None]
        y[:n] += part
        at += n
    return y


class _Whole:
    """A^T A times vectors that fit in a task: one pass over ratings packed by user.

    A user rates an item once, so a user's row is no longer than the items that a
    task may hold: no user is too large for a task either."""

    def __init__(self, entries: DataFrame, n_ratings: int, n_items: int, seed: int, local_bytes: int):
        self.spark, self.n_items, self.seed, self.local_bytes = entries.sparkSession, n_items, seed, local_bytes
        self.parts = parts = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), -(-n_ratings // CELLS_PER_TASK))

        def rows(u, i, v):
            ids, place = np.unique(u, return_inverse=True)
            by_item = np.lexsort((place, i))
            cols = [ids.astype(np.int64), place.astype(np.int32), i.astype(np.int32), v.astype(np.float64), by_item.astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in cols], ["ids", "place", "item", "v", "by_item"])

        self.rows = materialize(
            entries.select("user_id", F.col("item_idx").cast("int"), "value").repartition(parts, "user_id").sortWithinPartitions("user_id", "item_idx")
            .mapInArrow(_packer(rows), "ids binary, place binary, item binary, v binary, by_item binary"), "svd_rows")

    @staticmethod
    def _unpacked(batch):
        kinds = (np.int64, np.int32, np.int32, np.float64, np.int32)
        for r in zip(*(c.to_pylist() for c in batch.columns)):
            yield [np.frombuffer(x, t) for x, t in zip(r, kinds)]

    def step(self, x: np.ndarray) -> np.ndarray:
        """A^T A x."""
        n_items, unpacked = self.n_items, self._unpacked
        sent = self.spark.sparkContext.broadcast(x)
        per_slice = -(-n_items // SLICES)

        def multiply(batches):
            vectors = sent.value
            total = np.zeros_like(vectors)
            for b in batches:
                for ids, place, item, v, by_item in unpacked(b):
                    y = np.zeros((len(ids), vectors.shape[1]))
                    _rows_times(place, item, v, vectors, y)
                    _rows_times(item[by_item], place[by_item], v[by_item], y, total)
            for k in range(SLICES):
                part = total[k * per_slice:(k + 1) * per_slice]
                if part.any():
                    yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([part.tobytes()], pa.binary())], ["block", "x"])

        def add(batches):
            held = {}
            for b in batches:
                for k, part in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    part = np.frombuffer(part)
                    held[k] = held[k] + part if k in held else part
            for k, part in held.items():
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([part.tobytes()], pa.binary())], ["block", "x"])

        sums = self.rows.mapInArrow(multiply, _BLOCKS)
        if self.parts * x.nbytes > self.local_bytes:  # more than the driver may hold at once: added up by tasks first
            sums = sums.repartition(SLICES, "block").mapInArrow(add, _BLOCKS)
        out = np.zeros_like(x)
        for k, x_ in zip(*(c.to_pylist() for c in sums.toArrow().columns)):
            part = out[k * per_slice:(k + 1) * per_slice]
            part += np.frombuffer(x_).reshape(part.shape)
        sent.destroy()
        return out

    def leading(self, k: int, tolerance: float) -> tuple[np.ndarray, np.ndarray, float, int]:
        """The k leading vectors of A^T A, their eigenvalues, the largest residual
        over the largest eigenvalue, and the number of products, by block Lanczos."""
        width = min(self.n_items, k + 4)
        most = min(self.n_items, max(4 * width, min(BASIS_BLOCKS * width, self.local_bytes // (8 * self.n_items))))
        basis = np.zeros((self.n_items, most))
        small = np.zeros((most, most))  # basis^T A^T A basis
        basis[:, :width] = np.linalg.qr(np.random.default_rng(self.seed).standard_normal((self.n_items, width)))[0]
        done, new, products = 0, width, 0
        while True:
            own = slice(done, done + new)
            rest = self.step(np.ascontiguousarray(basis[:, own]))
            products += 1
            done += new
            known = basis[:, :done]
            for _ in range(2):  # the second time for what rounding left
                inside = known.T @ rest
                rest -= known @ inside
                small[:done, own] += inside
            small[own, :done] = small[:done, own].T
            fresh, sizes, mix = np.linalg.svd(rest, full_matrices=False)
            good = (sizes > 1e-12 * np.abs(small[:done, :done]).max()) & (np.arange(len(sizes)) < self.n_items - done)
            full = done + good.sum() > most
            if products % CHECK_EVERY == 0 or full or not good.any():
                values, vectors = np.linalg.eigh(_symmetric(small[:done, :done]))
                values, vectors = np.maximum(values[::-1], 0), vectors[:, ::-1]
                left = sizes[:, None] * (mix @ vectors[own])  # A^T A y - w y, on `fresh`
                residual = float(np.linalg.norm(left[:, :k], axis=0).max() / values[0]) if k and values[0] > 0 else 0.0
                if residual <= tolerance or not good.any():
                    return known @ vectors[:, :k], values[:k], residual, products
                if products >= MOST_PRODUCTS:
                    raise RuntimeError(f"no convergence: residual {residual:.1e} after {products} products")
                if full:  # go on from the best vectors found
                    done = max(1, min(2 * k, most - width))
                    basis[:, :done] = known @ vectors[:, :done]
                    small[:] = 0
                    small[:done, :done] = np.diag(values[:done])
            fresh = fresh[:, good]
            fresh = np.linalg.qr(fresh - basis[:, :done] @ (basis[:, :done].T @ fresh))[0]
            new = fresh.shape[1]
            basis[:, done:done + new] = fresh


    def times(self, x: np.ndarray, r: np.ndarray) -> np.ndarray:
        return x @ r

    def item_rows(self, x: np.ndarray, index: DataFrame, width: int) -> DataFrame:
        blocks = self.spark.createDataFrame(
            [(k, x[k * BLOCK:(k + 1) * BLOCK].tobytes()) for k in range(-(-self.n_items // BLOCK))], _BLOCKS)
        return _factor_rows(blocks, index, "item_idx", width)

    def user_rows(self, x: np.ndarray, width: int) -> DataFrame:
        sent, unpacked = self.spark.sparkContext.broadcast(x), self._unpacked

        def rows(batches):
            for b in batches:
                for ids, place, item, v, _ in unpacked(b):
                    y = np.zeros((len(ids), width))
                    _rows_times(place, item, v, sent.value, y)
                    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(list(y), pa.list_(pa.float64()))], ["user_id", "factors"])

        out = materialize(self.rows.mapInArrow(rows, "user_id long, factors array<double>"), "svd_user_factors")
        sent.destroy()
        return out


def _packed(entries: DataFrame, users: DataFrame) -> DataFrame:
    """Cells by (user block ub, item block ib): local row and column numbers
    and values as binary arrays. A pair of blocks has BLOCK^2 cells at most."""
    cells = entries.join(users, "user_id").select(
        F.floor(F.col("user_idx") / BLOCK).cast("int").alias("ub"), F.floor(F.col("item_idx") / BLOCK).cast("int").alias("ib"),
        (F.col("user_idx") % BLOCK).cast("int").alias("u"), (F.col("item_idx") % BLOCK).cast("int").alias("i"), "value")

    def pack(t: pa.Table) -> pa.Table:
        u, i, v = (t.column(c).to_numpy() for c in ("u", "i", "value"))
        order = np.lexsort((i, u))
        return pa.table({"ub": [t["ub"][0].as_py()], "ib": [t["ib"][0].as_py()], "u": [u[order].astype(np.int32).tobytes()],
                         "i": [i[order].astype(np.int32).tobytes()], "v": [v[order].tobytes()]},
                        schema=pa.schema([("ub", pa.int32()), ("ib", pa.int32()), ("u", pa.binary()), ("i", pa.binary()), ("v", pa.binary())]))

    return materialize(cells.groupBy("ub", "ib").applyInArrow(pack, "ub int, ib int, u binary, i binary, v binary"), "svd_cells")


_BLOCKS = "block int, x binary"
_PARTS = "block int, at binary, x binary"
_BLOCK_SCHEMA = pa.schema([("block", pa.int32()), ("x", pa.binary())])
_PART_SCHEMA = pa.schema([("block", pa.int32()), ("at", pa.binary()), ("x", pa.binary())])


def _dense(x: bytes, width: int) -> np.ndarray:
    return np.frombuffer(x).reshape(-1, width)


def _sum_parts(parts: DataFrame, width: int) -> DataFrame:
    """Dense blocks from rows of blocks: a task meets a block's parts one after
    another and holds the sum alone."""
    def total(batches):
        block, out = None, None
        for b in batches:
            for k, at, x in zip(*(c.to_pylist() for c in b.columns)):
                if k != block:
                    if out is not None:
                        yield done(block, out)
                    block, out = k, np.zeros((BLOCK, width))
                out[np.frombuffer(at, np.int32)] += _dense(x, width)
        if out is not None:
            yield done(block, out)

    def done(block, out):
        return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([out.tobytes()], pa.binary())], schema=_BLOCK_SCHEMA)

    return parts.repartition("block").sortWithinPartitions("block").mapInArrow(total, _BLOCKS)


def _part(block: int, out: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(out.any(axis=1)).astype(np.int32)
    return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([at.tobytes()], pa.binary()), pa.array([out[at].tobytes()], pa.binary())], schema=_PART_SCHEMA)


def _product_parts(cells: DataFrame, x: DataFrame, width: int, transposed: bool, by: float = 1.0) -> DataFrame:
    """Rows of by A X (or by A^T X), added up over the blocks that a task holds."""
    own, other = ("ib", "ub") if transposed else ("ub", "ib")
    joined = cells.join(x.withColumnRenamed("block", other), other).select(F.col(own).alias("block"), "u", "i", "v", "x")

    def multiply(batches):
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for block, u, i, v, x_ in zip(*(b.column(k) for k in range(5))):
                u, i = np.frombuffer(u.as_py(), np.int32), np.frombuffer(i.as_py(), np.int32)
                v, dense = np.frombuffer(v.as_py()), _dense(x_.as_py(), width)
                if transposed:
                    order = np.lexsort((u, i))
                    rows, cols, v = i[order], u[order], v[order]
                else:
                    rows, cols = u, i
                k = block.as_py()
                if k not in held and len(held) >= HELD_BLOCKS:
                    yield from (_part(n, out * by) for n, out in held.items())
                    held.clear()
                _rows_times(rows, cols, v, dense, held.setdefault(k, np.zeros((BLOCK, width))))
        yield from (_part(n, out * by) for n, out in held.items())

    return joined.mapInArrow(multiply, _PARTS)


def _scaled(x: DataFrame, width: int, by: float) -> DataFrame:
    def scale(batches):
        for b in batches:
            for k, x_ in zip(b.column(0).to_pylist(), b.column(1)):
                yield _part(k, _dense(x_.as_py(), width) * by)

    return x.mapInArrow(scale, _PARTS)


class _Blocked:
    """A^T A times vectors that are a table of dense blocks."""

    def __init__(self, entries: DataFrame, n_items: int, seed: int, users: DataFrame | None = None):
        self.spark, self.n_items, self.seed = entries.sparkSession, n_items, seed
        self.users = _user_index(entries) if users is None else users
        self._pack(entries)

    def _pack(self, entries: DataFrame) -> None:
        self.cells = _packed(entries, self.users)

    def start(self, width: int) -> DataFrame:
        n_items, seed = self.n_items, self.seed

        def random_block(batches):
            for b in batches:
                for block in b.column(0).to_pylist():
                    x = np.random.default_rng([seed, block]).standard_normal((BLOCK, width))
                    x[max(0, n_items - block * BLOCK):] = 0
                    yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([x.tobytes()], pa.binary())], schema=_BLOCK_SCHEMA)

        blocks = self.spark.range(-(-n_items // BLOCK)).select(F.col("id").cast("int").alias("block"))
        return materialize(blocks.mapInArrow(random_block, _BLOCKS), "svd_start")

    def step(self, x: DataFrame, width: int, by: float = 1.0, plus: float = 0.0, last: DataFrame | None = None) -> DataFrame:
        """by A^T A x + plus x - last."""
        y = materialize(_sum_parts(_product_parts(self.cells, x, width, False), width), "svd_product")
        parts = _product_parts(self.cells, y, width, True, by).unionByName(_scaled(x, width, plus))
        if last is not None:
            parts = parts.unionByName(_scaled(last, width, -1.0))
        return materialize(_sum_parts(parts, width), "svd_product")

    def times(self, x: DataFrame, r: np.ndarray) -> DataFrame:
        return materialize(_rotated(x, r), "svd_basis")

    def with_product(self, x: DataFrame, width: int) -> DataFrame:
        """x beside A^T A x."""
        return _beside([x, self.step(x, width)])

    def filtered(self, t: DataFrame, first: np.ndarray, second: np.ndarray, half: float, degree: int) -> DataFrame:
        """The Chebyshev polynomial of `degree` beside its product, from the vectors of
        degree 0 and 1: the columns `first` and `second` of `t`."""
        width = first.shape[1]
        before, x = self.times(t, first), self.times(t, second)
        for _ in range(degree - 1):
            before, x = x, self.step(x, width, 2 / half, -2.0, before)
        return self.with_product(x, width)

    def largest(self, t: DataFrame, columns: np.ndarray) -> float:
        """The largest Ritz value of A^T A in these columns of `t`."""
        width = columns.shape[1]
        g = _gram(self.with_product(self.times(t, columns), width), 2 * width)
        return float(_ritz(g[:width, width:], g[:width, :width])[0][0])

    def leading(self, k: int, tolerance: float) -> tuple[DataFrame, np.ndarray, float, int]:
        """As `_Whole.leading`, by subspace iteration under a Chebyshev filter.

        The filter is between -1 and 1 on [0, bound] and grows beyond. The least Ritz
        value would be a bad bound where an eigenvalue is as frequent as the block is
        wide: it tends to the wanted ones, and the filter to nothing. What is still to be
        removed is in the residuals, so the bound is their largest Ritz value if that is less."""
        width = min(self.n_items, max(k + 7, 4 * k // 3))
        zero, one = np.zeros((width, width)), np.eye(width)
        t = self.with_product(self.start(width), width)
        products = 1
        while True:
            g = _gram(t, 2 * width)
            values, vectors = _ritz(g[:width, width:], g[:width, :width])
            t = self.times(t, np.block([[vectors, -vectors * values], [zero, vectors]]))  # x beside A^T A x - x w
            g = _gram(t, 2 * width)
            off = np.sqrt(np.maximum(np.diag(g)[width:], 0))
            residual = float(off[:k].max() / values[0]) if k and values[0] > 0 else 0.0
            if residual <= tolerance:
                sizes, turn = np.linalg.eigh(_symmetric(g[:k, :k]))  # what rounding left between them
                turn = turn * np.where(sizes > 0.5, 1 / np.sqrt(np.maximum(sizes, 0.5)), 0) @ turn.T
                return self.times(t, np.vstack([turn, np.zeros((2 * width - k, k))])), values[:k], residual, products
            if products >= MOST_PRODUCTS:
                raise RuntimeError(f"no convergence: residual {residual:.1e} after {products} products")
            probes = [width + j for j in range(k) if off[j] > 0][-PROBES:]
            bound = self.largest(t, np.eye(2 * width)[:, probes] / off[[j - width for j in probes]])
            half = max(min(bound, values[-1]), 1e-13 * values[0]) / 2
            # no more than is missing, and so that no direction is lost beside the largest in floating point
            most = np.arccosh(1e6) / _growth(values[0] if bound < values[0] else 2 * bound, half)  # the latter before the first filter
            missing = np.arccosh(max(2, 4 * residual / tolerance)) / _growth(values[k - 1], half) + 1
            degree = max(2, int(min(DEGREE, most, missing)))
            t = self.filtered(t, np.vstack([one, zero]), np.vstack([np.diag(values / half - 1), one / half]), half, degree)
            products += degree + 1

    def item_rows(self, x: DataFrame, index: DataFrame, width: int) -> DataFrame:
        return _factor_rows(x, index, "item_idx", width)

    def user_rows(self, x: DataFrame, width: int) -> DataFrame:
        y = _sum_parts(_product_parts(self.cells, x, width, False), width)
        return materialize(_factor_rows(y, self.users, "user_idx", width).select("user_id", "factors"), "svd_user_factors")


class _Relayed(_Blocked):
    """The same with products of a few columns at a time, which the driver sends to the
    tasks and collects from them. The ratings lie packed by user and by item, so every
    task has whole rows: nothing is added up between tasks, and no product is shuffled."""

    def __init__(self, entries: DataFrame, n_items: int, n_ratings: int, seed: int, users: DataFrame, n_users: int, local_bytes: int):
        self.n_users, self.columns = n_users, _relayed_columns(n_items, n_users, local_bytes)
        self.parts = max(int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n_ratings // CELLS_PER_TASK))
        super().__init__(entries, n_items, seed, users)

    def _pack(self, entries: DataFrame) -> None:
        cells = materialize(entries.join(self.users, "user_id").select(
            F.col("user_idx").cast("int"), F.col("item_idx").cast("int"), "value"), "svd_cells")

        self.by_user, self.by_item = (materialize(
            cells.select(key, other, "value").repartition(self.parts, key).sortWithinPartitions(key, other)
            .mapInArrow(_packer(_jagged), "ids binary, counts binary, other binary, v binary, code binary"), "svd_rows")
            for key, other in (("user_idx", "item_idx"), ("item_idx", "user_idx")))

    def _times(self, rows: DataFrame, x: np.ndarray, n: int) -> np.ndarray:
        """`n` rows: the packed ratings times x."""
        sent = self.spark.sparkContext.broadcast(x)

        def multiply(batches):
            vectors = sent.value
            for b in batches:
                for ids, *packed in zip(*b.columns):
                    y = _jagged_times(*(np.frombuffer(c.as_buffer(), t) for c, t in zip(packed, (np.int32, np.int32, np.float64, np.uint8))), vectors)
                    yield pa.RecordBatch.from_arrays([pa.array([ids.as_py()], pa.binary()), pa.array([y.tobytes()], pa.binary())], ["at", "x"])

        out = np.zeros((n, x.shape[1]))
        for b in rows.mapInArrow(multiply, "at binary, x binary").toArrow().to_batches():
            for at, y in zip(b.column(0), b.column(1)):
                out[np.frombuffer(at.as_buffer(), np.int32)] = _dense(y.as_buffer(), x.shape[1])
        sent.destroy()
        return out

    def _product(self, x: np.ndarray) -> np.ndarray:
        return self._times(self.by_item, self._times(self.by_user, x, self.n_users), self.n_items)

    def _groups(self, width: int):
        """Ranges of columns, none wider than the driver may hold."""
        n = -(-width // self.columns)
        at = [width * j // n for j in range(n + 1)]
        return list(zip(at, at[1:]))

    def _collected(self, t: DataFrame, r: np.ndarray) -> np.ndarray:
        """T R on the driver."""
        out = np.zeros((self.n_items, r.shape[1]))
        for b in _rotated(t, r).toArrow().to_batches():
            for block, x in zip(b.column(0).to_pylist(), b.column(1)):
                part = out[block * BLOCK:(block + 1) * BLOCK]
                part[:] = _dense(x.as_buffer(), r.shape[1])[:len(part)]
        return out

    def _table(self, x: np.ndarray) -> DataFrame:
        sent = self.spark.sparkContext.broadcast(x)

        def blocks(batches):
            for b in batches:
                for k in b.column(0).to_pylist():
                    part = np.zeros((BLOCK, sent.value.shape[1]))
                    rows = sent.value[k * BLOCK:(k + 1) * BLOCK]
                    part[:len(rows)] = rows
                    yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([part.tobytes()], pa.binary())], schema=_BLOCK_SCHEMA)

        numbers = self.spark.range(-(-len(x) // BLOCK)).select(F.col("id").cast("int").alias("block"))
        out = materialize(numbers.mapInArrow(blocks, _BLOCKS), "svd_product")
        sent.destroy()
        return out

    def with_product(self, x: DataFrame, width: int) -> DataFrame:
        return _beside([x] + [self._table(self._product(self._collected(x, np.eye(width)[:, lo:hi]))) for lo, hi in self._groups(width)])

    def filtered(self, t: DataFrame, first: np.ndarray, second: np.ndarray, half: float, degree: int) -> DataFrame:
        xs, zs = [], []
        for lo, hi in self._groups(first.shape[1]):
            before, x = self._collected(t, first[:, lo:hi]), self._collected(t, second[:, lo:hi])
            for _ in range(degree - 1):
                z = self._product(x)
                z *= 2 / half
                z -= 2 * x
                z -= before
                before, x = x, z
            del before
            xs.append(self._table(x))
            zs.append(self._table(self._product(x)))
        return _beside(xs + zs)

    def largest(self, t: DataFrame, columns: np.ndarray) -> float:
        q = self._collected(t, columns[:, -self.columns:])
        return float(_ritz(q.T @ self._product(q), q.T @ q)[0][0])

    def user_rows(self, x: DataFrame, width: int) -> DataFrame:
        y = _beside([self._table(self._times(self.by_user, self._collected(x, np.eye(width)[:, lo:hi]), self.n_users)) for lo, hi in self._groups(width)])
        return materialize(_factor_rows(y, self.users, "user_idx", width).select("user_id", "factors"), "svd_user_factors")


def _relayed_columns(n_items: int, n_users: int, local_bytes: int) -> int:
    """How many columns the driver may hold at once: three of a filter, or what it sends and collects."""
    return local_bytes // (24 * max(1, n_items, n_users))


def _user_index(entries: DataFrame) -> DataFrame:
    return materialize(global_rank(entries.select("user_id").distinct(), ["user_id"], "user_idx").withColumn(
        "user_idx", F.col("user_idx") - 1), "svd_users")


def _beside(tables: list[DataFrame]) -> DataFrame:
    """The tables' columns side by side."""
    def paste(batches):
        block, parts = None, []
        for b in batches:
            for k, x in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                if k != block:
                    if parts:
                        yield pasted(block, parts)
                    block, parts = k, []
                parts.append(np.frombuffer(x).reshape(BLOCK, -1))
        if parts:
            yield pasted(block, parts)

    def pasted(block, parts):
        return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([np.hstack(parts).tobytes()], pa.binary())], schema=_BLOCK_SCHEMA)

    rows = None
    for part, t in enumerate(tables):
        t = t.select("block", F.lit(part).alias("part"), "x")
        rows = t if rows is None else rows.unionByName(t)
    return materialize(rows.repartition("block").sortWithinPartitions("block", "part").mapInArrow(paste, _BLOCKS), "svd_basis")


def _gram(x: DataFrame, width: int) -> np.ndarray:
    """X^T X: one width x width matrix per task, summed to a few, then on the driver."""
    def own(batches):
        total = np.zeros((width, width))
        block = 0
        for b in batches:
            for k, x_ in zip(b.column(0), b.column(1)):
                total += _dense(x_.as_py(), width).T @ _dense(x_.as_py(), width)
                block = k.as_py() % 16
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([total.tobytes()], pa.binary())], schema=_BLOCK_SCHEMA)

    def add(t: pa.Table) -> pa.Table:
        total = sum(_dense(b, width) for b in t.column("x").to_pylist())
        return pa.table({"block": [t["block"][0].as_py()], "x": [total.tobytes()]}, schema=_BLOCK_SCHEMA)

    return sum(_dense(r["x"], width) for r in x.mapInArrow(own, _BLOCKS).groupBy("block").applyInArrow(add, _BLOCKS).collect())


def _growth(value: float, half: float) -> float:
    """What a degree adds to the filter's logarithm at `value`, if it begins at 2 half."""
    return float(np.arccosh(max((value - half) / half, 1 + 1e-9)))


def _ritz(h: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ritz values, falling, and vectors from H = X^T A^T A X and G = X^T X; zeros for
    directions that X doesn't have."""
    sizes = np.sqrt(np.maximum(np.diag(g), 0))
    unit = np.where(sizes > 0, 1 / np.where(sizes > 0, sizes, 1), 0)
    d, u = np.linalg.eigh(_symmetric(g * unit[:, None] * unit))
    good = d > 1e-13 * max(d[-1], 0)
    u = unit[:, None] * u[:, good] / np.sqrt(d[good])
    w, r = np.linalg.eigh(_symmetric(u.T @ h @ u))
    values, vectors = np.zeros(len(g)), np.zeros(g.shape)
    values[:len(w)], vectors[:, :len(w)] = np.maximum(w[::-1], 0), (u @ r)[:, ::-1]
    return values, vectors


def _rotated(x: DataFrame, r: np.ndarray) -> DataFrame:
    """X R, block by block."""
    def rotate(batches):
        for b in batches:
            for block, x_ in zip(b.column(0), b.column(1)):
                out = np.ascontiguousarray(_dense(x_.as_py(), r.shape[0]) @ r)
                yield pa.RecordBatch.from_arrays([pa.array([block.as_py()], pa.int32()), pa.array([out.tobytes()], pa.binary())], schema=_BLOCK_SCHEMA)

    return x.mapInArrow(rotate, _BLOCKS)


def _factor_rows(x: DataFrame, index: DataFrame, idx_col: str, width: int) -> DataFrame:
    """One row per indexed user or item with its factors."""
    def rows(batches):
        for b in batches:
            for block, x_ in zip(b.column(0), b.column(1)):
                d = _dense(x_.as_py(), width)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block.as_py() * BLOCK + np.arange(len(d))), pa.array(d.tolist(), pa.list_(pa.float64()))], [idx_col, "factors"])

    return index.join(x.mapInArrow(rows, f"{idx_col} long, factors array<double>"), idx_col)


def _symmetric(h: np.ndarray) -> np.ndarray:
    return (h + h.T) / 2


def svd_train(train: DataFrame, k: int = 50, seed: int = 11, tolerance: float = TOLERANCE, local_bytes: int = LOCAL_BYTES) -> SVDModel:
    """Rank-k truncated SVD of the centred rating matrix, to `tolerance`."""
    entries, idx, mu, n_items, n_ratings = rating_matrix(train)
    k = min(k, n_items)
    if 8 * n_items * min(n_items, 4 * (k + 4)) <= local_bytes:
        op = _Whole(entries, n_ratings, n_items, seed, local_bytes)
    else:
        users = _user_index(entries)
        n_users = users.count()
        if _relayed_columns(n_items, n_users, local_bytes):
            op = _Relayed(entries, n_items, n_ratings, seed, users, n_users, local_bytes)
        else:
            op = _Blocked(entries, n_items, seed, users)
    x, values, residual, products = op.leading(k, tolerance)
    singular = np.sqrt(values)
    kept = int((singular > RCOND * (singular[0] if len(singular) else 0)).sum())
    x = op.times(x, np.eye(k)[:, :kept])
    item_factors = materialize(op.item_rows(x, idx, kept).select("item_id", "item_idx", "factors"), "svd_item_factors")
    return SVDModel(mu, [float(v) for v in singular[:kept]], item_factors, op.user_rows(x, kept), residual, products)


def _dot(a, b):
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def svd_residuals(model: SVDModel, train: DataFrame) -> DataFrame:
    """How well the stored factors solve A v = p and A^T p = s^2 v, from the ratings
    alone: factor, singular_value, length of v, and both residuals over s_1 and s_1^2."""
    spark = train.sparkSession
    cells = (train.select("user_id", "item_id", (F.col("rating") - F.lit(model.global_mean)).alias("value")))

    def product(factors: DataFrame, by: str, key: str, x: str) -> DataFrame:
        """`key`'s sums of value times factors: one row with `k` sums, not a row per factor."""
        rows = cells.join(factors.select(by, "factors"), by)
        sums = [F.sum(F.col("value") * F.col("factors")[i]) for i in range(model.k)]
        return rows.groupBy(key).agg(F.array(*sums).alias(x))

    def beside(factors: DataFrame, key: str, own: str, x: str, product: DataFrame) -> DataFrame:
        both = factors.select(key, F.col("factors").alias(own)).join(product, key)
        return both.select(F.posexplode(F.arrays_zip(own, x)).alias("factor", "c")).select("factor", f"c.{own}", f"c.{x}")

    s1 = model.singular_values[0]
    s = F.broadcast(spark.createDataFrame(list(enumerate(model.singular_values)), "factor int, singular_value double"))  # k rows
    users = beside(model.user_factors, "user_id", "p", "av", product(model.item_factors, "item_id", "user_id", "av")).groupBy("factor").agg(
        F.sqrt(F.sum((F.col("av") - F.col("p")) ** 2)).alias("users_off"))
    items = beside(model.item_factors, "item_id", "v", "atp", product(model.user_factors, "user_id", "item_id", "atp")).join(s, "factor").groupBy(
        "factor", "singular_value").agg(
        F.sqrt(F.sum(F.col("v") ** 2)).alias("length"), F.sqrt(F.sum((F.col("atp") - F.col("singular_value") ** 2 * F.col("v")) ** 2)).alias("items_off"))
    return items.join(users, "factor").select(
        "factor", "singular_value", "length", (F.col("users_off") / s1).alias("user_residual"), (F.col("items_off") / s1 ** 2).alias("item_residual"))


def svd_predict(model: SVDModel, pairs: DataFrame) -> DataFrame:
    """predicted_rating for (user_id, item_id) pairs: mu + p_u . v_i
    clipped to [1, 5]; mu (unclipped) when the user or item is unseen."""
    p = (pairs.join(model.user_factors.withColumnRenamed("factors", "_pu"), "user_id", "left")
         .join(model.item_factors.select("item_id", F.col("factors").alias("_vi")), "item_id", "left"))
    raw = F.lit(model.global_mean) + _dot(F.col("_pu"), F.col("_vi"))
    pred = F.when(F.col("_pu").isNull() | F.col("_vi").isNull(), F.lit(model.global_mean)) \
            .otherwise(F.least(F.lit(CLIP_MAX), F.greatest(F.lit(CLIP_MIN), raw)))
    return p.withColumn("predicted_rating", pred).drop("_pu", "_vi")


def svd_scores_topl(model: SVDModel, budget: DataFrame, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """For each (user_id, _l) the _l best items by clipped score (ties: lower
    item_idx = lower item_id first). Users are scored in Arrow batches. V goes
    out in slices of `slice_bytes`; each keeps a user's _l best, so the best of
    all slices are among them."""
    per_slice = max(1, slice_bytes // (8 * max(1, model.k)))
    top = model.item_factors.agg(F.max("item_idx")).first()[0]
    parts = [_slice_scores(model, budget, lo, lo + per_slice) for lo in range(0, (-1 if top is None else top) + 1, per_slice)]
    if not parts:
        return budget.sparkSession.createDataFrame([], "user_id long, item_idx long, predicted_rating double")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _slice_scores(model: SVDModel, budget: DataFrame, first: int, end: int) -> DataFrame:
    spark = budget.sparkSession
    pdf = model.item_factors.where(F.col("item_idx").between(first, end - 1)).select("item_idx", "factors").toPandas().sort_values("item_idx")
    bv = spark.sparkContext.broadcast(np.vstack(pdf["factors"].to_numpy()))
    mu = model.global_mean
    src = budget.join(model.user_factors, "user_id")

    def score(batches):
        vt = bv.value.T
        n_items = vt.shape[1]
        # users per numpy block, so one block of scores stays near 4M cells
        block = max(1, SCORE_BLOCK_CELLS // max(1, n_items))
        for pdf in batches:
            users = pdf["user_id"].to_numpy()
            limits = pdf["_l"].to_numpy()
            factors = pdf["factors"].to_numpy()
            for lo in range(0, len(pdf), block):
                hi = min(lo + block, len(pdf))
                pu = np.vstack(factors[lo:hi])
                # ranked on 10 places: block size and partitioning change the last bits
                s = np.round(np.clip(mu + pu @ vt, CLIP_MIN, CLIP_MAX), SCORE_PLACES)
                out_u, out_i, out_s = [], [], []
                for row in range(hi - lo):
                    lim = int(min(limits[lo + row], n_items))
                    sr = s[row]
                    if lim < n_items:
                        cut = np.partition(sr, n_items - lim)[n_items - lim]
                        cand = np.nonzero(sr >= cut)[0]
                    else:
                        cand = np.arange(n_items)
                    order = cand[np.lexsort((cand, -sr[cand]))][:lim]
                    out_u.append(np.full(len(order), users[lo + row], dtype="int64"))
                    out_i.append(first + order.astype("int64"))
                    out_s.append(sr[order])
                yield pd.DataFrame({"user_id": np.concatenate(out_u),
                                    "item_idx": np.concatenate(out_i),
                                    "predicted_rating": np.concatenate(out_s)})
    schema = T.StructType([T.StructField("user_id", T.LongType()),
                           T.StructField("item_idx", T.LongType()),
                           T.StructField("predicted_rating", T.DoubleType())])
    return src.select("user_id", "_l", "factors").mapInPandas(score, schema)


def svd_pool(model: SVDModel, train: DataFrame, users: DataFrame | None = None, n: int = 10,
             exclude_watched: bool = True) -> DataFrame:
    """G4 without the item's details: user_id, rank, item_id, predicted_rating."""
    watched = train.select("user_id", "item_id")
    uf = model.user_factors.select("user_id")
    if users is not None:
        uf = uf.join(users.select("user_id"), "user_id", "left_semi")
        watched = watched.join(users.select("user_id").distinct(), "user_id", "left_semi")
    if exclude_watched:
        w = watched.groupBy("user_id").agg(F.count(F.lit(1)).alias("_w"))
        budget = uf.join(w, "user_id", "left").select(
            "user_id", (F.lit(n) + F.coalesce(F.col("_w"), F.lit(0))).alias("_l"))
    else:
        budget = uf.select("user_id", F.lit(n).cast("bigint").alias("_l"))
    cand = svd_scores_topl(model, budget).join(
        model.item_factors.select("item_id", "item_idx"), "item_idx")
    if exclude_watched:
        cand = cand.join(watched, ["user_id", "item_id"], "left_anti")
    top = top_n_per(cand, ["user_id"], [F.col("predicted_rating").desc(), F.col("item_id")], n)
    return top.select("user_id", "rank", "item_id", "predicted_rating")


def svd_recommendations(model: SVDModel, train: DataFrame, items: DataFrame,
                        genre_strings: DataFrame, users: DataFrame | None = None,
                        n: int = 10, exclude_watched: bool = True) -> DataFrame:
    """Each user's top n items by clipped prediction, rated items removed;
    users unseen in train get no rows."""
    return (svd_pool(model, train, users, n, exclude_watched).join(items.select("item_id", "title"), "item_id")
            .join(genre_strings, "item_id", "left")
            .select("user_id", "rank", "item_id", "title", "genres", "predicted_rating"))


def model_save(model: SVDModel, path: str) -> None:
    """The model as Parquet tables under `path`."""
    spark = model.item_factors.sparkSession
    model.item_factors.write.mode("overwrite").parquet(f"{path}/item_factors")
    model.user_factors.write.mode("overwrite").parquet(f"{path}/user_factors")
    spark.createDataFrame(
        [(i, float(s)) for i, s in enumerate(model.singular_values)],
        "factor int, singular_value double").write.mode("overwrite").parquet(
        f"{path}/singular_values")
    spark.createDataFrame([(model.global_mean, model.k)], "global_mean double, k int") \
        .write.mode("overwrite").parquet(f"{path}/model_meta")


def model_load(spark: SparkSession, path: str) -> SVDModel:
    """Read a model written by `model_save`."""
    meta = spark.read.parquet(f"{path}/model_meta").first()
    sv = spark.read.parquet(f"{path}/singular_values").orderBy("factor").collect()
    return SVDModel(float(meta["global_mean"]), [float(r["singular_value"]) for r in sv],
                    spark.read.parquet(f"{path}/item_factors"),
                    spark.read.parquet(f"{path}/user_factors"))
