"""Toxicity: a convolutional text classifier over hashed word embeddings.

Words are hashed into a fixed table of embeddings. For each of several filter
widths a bank of filters slides over the words; rectified outputs are max-pooled
over the whole text, and a logistic layer on the pooled features gives the score.
Training (Adam, numpy) runs on the driver over a documented, bounded sample of
labelled rows; scoring runs where the texts are read, over whole texts.

A filter's output at a word is a sum of embedding-times-weight products, one per
word under the filter, so scoring folds embeddings and filters into one table
per filter position, and a text costs one gather and one addition per position.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkrec.llm.common import materialize, pick

WORD = re.compile(r"[^\W\d_]+")
#: Lengths of the word beginnings that are hashed beside the whole word, so that inflected forms share an embedding.
PREFIXES = (4, 5, 6)
#: Words scored at once; texts of any length go through in such steps.
STEP = 4096


def word_hashes(word: str) -> list[int]:
    """Hashes of the whole word and of its beginnings (equal in every process)."""
    return [zlib.crc32(b"=" + word.encode())] + [zlib.crc32(b"^" + word[:k].encode()) if len(word) >= k else 0 for k in PREFIXES]


def indexed(texts: Iterable[str]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Hashes of the distinct lower-cased words (one row each), and per text the rows of its words."""
    ids: dict[str, int] = {}
    rows = []
    for text in texts:
        words = WORD.findall(text.lower())
        rows.append(np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words)))
    hashes = np.array([word_hashes(w) for w in ids] or np.zeros((0, 1 + len(PREFIXES))), np.int64)
    return hashes, rows


def known_hashes(hashes: np.ndarray, rows: list[np.ndarray], min_texts: int) -> np.ndarray:
    """Sorted hashes that occur in `min_texts` texts or more; only these get an embedding."""
    seen = np.concatenate([np.unique(hashes[np.unique(r)]) for r in rows])
    values, times = np.unique(seen, return_counts=True)
    return values[(times >= min_texts) & (values != 0)]


def slots_of(hashes: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Embedding rows of the hashes; 0, whose embedding is zero, for unknown ones."""
    at = np.searchsorted(known, hashes)
    hit = at < len(known)
    hit[hit] = known[at[hit]] == hashes[hit]
    return np.where(hit, at + 1, 0)


@dataclass
class ConvNet:
    """Known hashes and their embeddings, filters by width (width x dims x filters), biases, output layer."""

    known: np.ndarray
    emb: np.ndarray
    filters: dict[int, np.ndarray]
    bias: dict[int, np.ndarray]
    out: np.ndarray
    out_bias: float

    @staticmethod
    def fresh(known: np.ndarray, dims: int, widths: tuple[int, ...], n_filters: int, seed: int) -> ConvNet:
        rng = np.random.default_rng(seed)
        emb = (rng.standard_normal((len(known) + 1, dims)) * 0.02).astype(np.float32)
        emb[0] = 0
        return ConvNet(
            known, emb,
            {w: (rng.standard_normal((w, dims, n_filters)) * (2 / (w * dims)) ** 0.5).astype(np.float32) for w in widths},
            {w: np.zeros(n_filters, np.float32) for w in widths},
            (rng.standard_normal(len(widths) * n_filters) * 0.1).astype(np.float32), 0.0)

    def tables(self) -> dict[int, list[np.ndarray]]:
        """Per width and position, embeddings times filters: slots x filters."""
        return {w: [np.ascontiguousarray(self.emb @ f[j]) for j in range(w)] for w, f in self.filters.items()}

    def score_texts(self, texts: list[str], tables: dict[int, list[np.ndarray]]) -> list[float]:
        """Scores of whole texts; long ones are convolved in steps of bounded memory."""
        hashes, rows = indexed(texts)
        slots = slots_of(hashes, self.known)
        by_word = {w: [np.concatenate([t[slots].sum(axis=1), np.zeros((1, t.shape[1]), np.float32)]) for t in own]
                   for w, own in tables.items()}
        pad = np.full(max(tables) - 1, len(hashes), np.int64)  # the row of zeros
        scores = []
        for own in rows:
            x = np.concatenate([own if len(own) else pad[:1], pad])
            n_all, feats = len(x) - len(pad), []
            for w, by_position in by_word.items():
                best = np.full(by_position[0].shape[1], -np.inf, np.float32)
                for lo in range(0, n_all, STEP):
                    n = min(STEP, n_all - lo)
                    act = by_position[0][x[lo:lo + n]]
                    for j in range(1, w):
                        act += by_position[j][x[lo + j:lo + j + n]]
                    np.maximum(best, act.max(axis=0), out=best)
                feats.append(np.maximum(best + self.bias[w], 0))
            z = float(np.concatenate(feats) @ self.out) + self.out_bias
            scores.append(float(1 / (1 + np.exp(-np.clip(z, -30, 30)))))
        return scores


def train(texts: list[str], labels: np.ndarray, *, min_texts: int = 4, dims: int = 16, widths: tuple[int, ...] = (1, 2, 3),
          n_filters: int = 8, epochs: int = 6, min_steps: int = 400, rate: float = 0.01, batch: int = 32, decay: float = 1e-3, seed: int = 7) -> ConvNet:
    """Fit by Adam on the cross entropy, each class with equal weight in all:
    `epochs` passes, or more on a small sample until `min_steps` steps are done."""
    hashes, rows = indexed(texts)
    net = ConvNet.fresh(known_hashes(hashes, rows, min_texts), dims, widths, n_filters, seed)
    slots = np.concatenate([slots_of(hashes, net.known), np.zeros((1, hashes.shape[1]), np.int64)])
    pad = np.full(max(widths) - 1, len(hashes), np.int64)
    rng = np.random.default_rng(seed)
    y = labels.astype(np.float32)
    weight = np.where(y > 0, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1)).astype(np.float32) * len(y)
    params = {"out": net.out, "ob": np.zeros(1, np.float32)} | {("f", w): net.filters[w] for w in widths} | {("b", w): net.bias[w] for w in widths}
    first, second = ({k: np.zeros_like(v) for k, v in (params | {"emb": net.emb}).items()} for _ in range(2))
    step = 0
    for _ in range(max(epochs, -(-min_steps * batch // len(rows)))):
        order = rng.permutation(len(rows))
        for lo in range(0, len(order), batch):
            take = order[lo:lo + batch]
            grads = {k: np.zeros_like(p) for k, p in params.items()}
            touched, parts = [], []
            for i in take:
                x = slots[np.concatenate([rows[i] if len(rows[i]) else pad[:1], pad])]
                e = net.emb[x].sum(axis=1)
                n = len(x) - len(pad)
                tops, feats = [], []
                for w in widths:
                    act = sum(e[j:j + n] @ net.filters[w][j] for j in range(w))
                    tops.append(act.argmax(axis=0))
                    feats.append(np.maximum(act[tops[-1], np.arange(n_filters)] + net.bias[w], 0))
                h = np.concatenate(feats)
                p = 1 / (1 + np.exp(-np.clip(h @ net.out + params["ob"][0], -30, 30)))
                d = np.float32((p - y[i]) * weight[i] / len(take))
                grads["out"] += d * h
                grads["ob"] += d
                dh = d * net.out * (h > 0)
                for k, w in enumerate(widths):
                    g, top = dh[k * n_filters:(k + 1) * n_filters], tops[k]
                    grads["b", w] += g
                    for j in range(w):  # only the windows that won the pooling learn
                        grads["f", w][j] += (e[top + j] * g[:, None]).T
                        touched.append(x[top + j].ravel())
                        parts.append(np.repeat(net.filters[w][j].T * g[:, None], x.shape[1], axis=0))
            step += 1
            scale = rate * (1 - 0.999 ** step) ** 0.5 / (1 - 0.9 ** step)
            own, inverse = np.unique(np.concatenate(touched), return_inverse=True)
            g = np.zeros((len(own), dims), np.float32)
            np.add.at(g, inverse, np.concatenate(parts))
            for k, g, at in [*((k, g, slice(None)) for k, g in grads.items()), ("emb", g, own)]:
                p = net.emb if k == "emb" else params[k]
                first[k][at] += 0.1 * (g - first[k][at])
                second[k][at] += 0.001 * (g * g - second[k][at])
                p[at] -= scale * first[k][at] / (np.sqrt(second[k][at]) + 1e-8) + rate * decay * p[at]
            net.emb[0] = 0
    net.out_bias = float(params["ob"][0])
    return net


def held_out(id_col: str = "doc_id") -> F.Column:
    """Rows that are never learned from: crc32 of the id's text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, max_rows: int, max_chars: int) -> DataFrame:
    """At most `max_rows` labelled texts of each class, none held out.

    The rows with the smallest hash of their id, so the sample does not depend
    on partitioning. `max_chars` leaves out longer texts as a whole (none is
    cut), which bounds what the driver holds to 2 * max_rows * max_chars.
    """
    labelled = (labels.select(F.col("doc_id"), F.col("toxic").cast("int").alias("label")).where("label is not null and doc_id is not null")
                .where(~held_out()).groupBy("doc_id").agg(F.max("label").alias("label")))
    picked = [labelled.where(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows) for k in (0, 1)]
    few = picked[0].union(picked[1])  # at most 2 * max_rows ids
    texts = docs.where((F.length("text") <= max_chars) & F.col("doc_id").isNotNull())
    return (texts.join(F.broadcast(few), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text")).orderBy("doc_id"))


def thresholds(scored: DataFrame, labels: DataFrame, bins: int = 200, prior: float = 0.7) -> DataFrame:
    """Per language, the score from which on flagging gains the best F1 on the
    labelled rows that are not held out; `prior` for a language without toxic rows.

    Scores are counted into `bins` steps first, so the window over one language
    has at most `bins` rows.
    """
    seen = scored.where(~F.col("held_out")).join(labels.select("doc_id", F.col("toxic").cast("int").alias("label")), "doc_id")
    by_bin = seen.groupBy("lang", F.least(F.floor(F.col("score") * bins), F.lit(bins - 1)).alias("bin")).agg(
        F.sum("label").alias("pos"), F.count("*").alias("n"))
    above = Window.partitionBy("lang").orderBy(F.desc("bin"))
    whole = Window.partitionBy("lang")
    f1 = 2 * F.sum("pos").over(above) / (F.sum("n").over(above) + F.sum("pos").over(whole))
    best = by_bin.withColumn("f1", f1).groupBy("lang").agg(
        F.max(F.struct("f1", F.abs(F.col("bin") - prior * bins) * -1, "bin")).alias("b"), F.sum("pos").alias("pos"))
    return best.select("lang", F.when(F.col("pos") > 0, F.col("b.bin") / bins).otherwise(prior).alias("threshold"))


def toxicity(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             max_rows: int = 1500, max_chars: int = 20_000, cut: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from `cut` on), flagged; one row per input row.

    ``flagged`` compares the score with its language's own threshold (see
    `thresholds`); ``predicted`` with `cut`.

    Null texts count as empty; they too get a score. Labels are used only to
    fit, and only those not held out; language, source and id never reach a
    score. Without labelled rows of both classes every score is 0.
    """
    texts = pick(docs, id_col, text_col)
    id_type = texts.schema["doc_id"].dataType.simpleString()
    sample = training_sample(texts, labels, max_rows, max_chars).collect()  # bounded, see training_sample
    y = np.array([r["label"] for r in sample])
    net = train([r["text"] for r in sample], y) if len(set(y.tolist())) == 2 else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = net.tables() if net else None
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                scores = net.score_texts([t.as_py() for t in part.column(1)], tables) if net else [0.0] * part.num_rows
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(scores, pa.float64())], ["doc_id", "lang", "score"])

    lang = F.col(lang_col).cast("string") if lang_col in docs.columns else F.lit(None).cast("string")
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.coalesce(lang, F.lit("")).alias("lang"))
    scored = texts.mapInArrow(run, f"doc_id {id_type}, lang string, score double").withColumn("held_out", held_out())
    scored = materialize(scored, "toxicity")  # read twice: for the thresholds and for the result
    return scored.join(thresholds(scored, labels, prior=cut), "lang", "left").select(
        "doc_id", "held_out", "score", (F.col("score") >= cut).cast("int").alias("predicted"),
        (F.col("score") >= F.coalesce(F.col("threshold"), F.lit(cut))).alias("flagged"))
