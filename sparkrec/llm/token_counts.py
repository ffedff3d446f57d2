"""Token counts with overlap resynchronisation.

Texts up to `chunk_bytes` are encoded whole where they are read. Longer ones are
cut into chunks that overlap; the chunks are dealt over the cluster, encoded on
their own, and spliced where both neighbours have a token boundary that is
proven to be one of the whole text too. Where a seam has none, its documents are
encoded again with wider chunks and overlaps.

Why a splice is exact: the vocabulary is byte-level BPE behind a splitting
pattern under which no match runs from a non-space into a following white
space, no match looks back, and the one look-ahead concerns white space that is
followed by more text. So wherever a visible character is followed by a space
or line end, a match ends before that space whatever stands left or right, and
merges never cross matches: tokens(a + b) = tokens(a) + tokens(b). No special
token holds a space. Both encodings must also agree on the tokens either side.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrec.llm.common import materialize, pick

#: The splitting pattern of the byte-level pre-tokenizer.
SPLIT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

CHUNK_SCHEMA = "doc_id {id}, digest string, i int, n int, start long, piece string"
SEAM_SCHEMA = "doc_id {id}, digest string, i int, n int, total long, left_keys array<long>, left_counts array<long>, right_keys array<long>, right_counts array<long>"


def _byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for:
    printable Latin-1 stands for itself, the others for 256 and up in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


class Encoder:
    """Token ids and byte lengths of texts under a byte-level BPE ``.json`` file.

    If the file's merges come in the order of the ids that they make, and its
    special tokens are plain strings, the same merges run in tiktoken (measured
    five times faster than the tokenizers library, equal ids); any other file is
    left to the tokenizers library.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split = spec.get("pre_tokenizer") or {}
        if spec["model"]["type"] != "BPE" or split.get("type") != "ByteLevel" or spec.get("normalizer"):
            raise ValueError(f"{path}: not a byte-level BPE tokenizer without normaliser")
        vocab = spec["model"]["vocab"]
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        if any(any(c.isspace() for c in s) for s in special):
            raise ValueError(f"{path}: a special token holds white space")
        alphabet = _byte_alphabet()
        as_bytes = {t: bytes(alphabet[c] for c in t) for t in vocab if t not in special}
        self.lengths = np.zeros(max([*vocab.values(), *special.values()]) + 1, np.int64)
        for t, raw in as_bytes.items():
            self.lengths[vocab[t]] = len(raw)
        for s, k in special.items():
            self.lengths[k] = len(s.encode())
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        made = [vocab["".join(m)] for m in merges]
        plain = (made == sorted(set(made)) and len(as_bytes) == 256 + len(made) and split.get("use_regex", True)
                 and not split.get("add_prefix_space") and not spec["model"].get("ignore_merges")
                 and not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in spec.get("added_tokens", [])))
        if plain:
            import tiktoken
            ranks = {raw: vocab[t] for t, raw in as_bytes.items()}
            own = tiktoken.Encoding("own", pat_str=SPLIT_PATTERN, mergeable_ranks=ranks, special_tokens=special)
            self.ids = lambda text: own.encode(text, allowed_special="all")
        else:
            from tokenizers import Tokenizer
            own = Tokenizer.from_file(path)
            own.no_truncation()
            own.no_padding()
            self.ids = lambda text: own.encode(text, add_special_tokens=False).ids


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def stable_keys(raw: bytes, ids: np.ndarray, ends: np.ndarray, lo: int, hi: int, base: int) -> tuple[list, list]:
    """Provably stable boundaries p, lo < p < hi, of one encoded chunk.

    Returns keys (position in the whole text, then the tokens before and after,
    so that equal keys mean agreement) and the number of tokens before each.
    """
    k = np.flatnonzero((ends[:-1] > lo) & (ends[:-1] < hi))
    at = ends[k]
    data = np.frombuffer(raw, np.uint8)
    ok = (data[at] == 0x20) | (data[at] == 0x0A)
    ok &= (data[at - 1] > 0x20) & (data[at - 1] < 0x7F)
    k, at = k[ok], at[ok]
    keys = ((base + at) << 34) | (ids[k].astype(np.int64) << 17) | ids[k + 1].astype(np.int64)
    return keys.tolist(), (k + 1).tolist()


def count_tokens(docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 512, chunk_bytes: int = 32768, overlap_bytes: int = 512, widen: int = 8) -> DataFrame:
    """Tokens of every whole text: doc_id, n_bytes, n_tokens, over_limit.

    Null texts count as empty (0 tokens), ids may be null or repeated: one
    result row per input row. Special strings inside texts are special tokens,
    as the library does by default. `chunk_bytes` and `overlap_bytes` bound what
    a task encodes at once; both are multiplied by `widen` for documents with a
    seam that has no common stable boundary, until the text is a single chunk.
    """
    texts = pick(docs, id_col, text_col)
    id_type = texts.schema["doc_id"].dataType.simpleString()
    size = F.octet_length("text").cast("long")

    def encode_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        for b in batches:
            n = [len(enc.ids(t.as_py())) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    short = (texts.where(size <= chunk_bytes).select("doc_id", size.alias("n_bytes"), "text")
             .mapInArrow(encode_whole, f"doc_id {id_type}, n_bytes long, n_tokens long"))

    long_texts = texts.where(size > chunk_bytes).select("doc_id", F.sha2("text", 256).alias("digest"), "text")
    long_sizes = long_texts.select("doc_id", "digest", size.alias("n_bytes"))
    counted, todo, chunk, overlap = None, long_texts, chunk_bytes, overlap_bytes
    while True:
        done = materialize(_splice(_encode_chunks(todo, id_type, tokenizer_path, chunk, overlap)), "tokens")
        counted = done if counted is None else counted.union(done)
        failed = done.where("n_tokens is null").select("doc_id", "digest")
        if failed.isEmpty():
            break
        chunk, overlap = chunk * widen, overlap * widen
        todo = long_texts.join(failed, (long_texts.digest == failed.digest) & long_texts.doc_id.eqNullSafe(failed.doc_id), "left_semi")
    counted = counted.where("n_tokens is not null").alias("c")
    s = long_sizes.alias("s")
    spliced = s.join(counted, (F.col("s.digest") == F.col("c.digest")) & F.col("s.doc_id").eqNullSafe(F.col("c.doc_id"))).select(
        "s.doc_id", "s.n_bytes", "c.n_tokens")
    return short.union(spliced).withColumn("over_limit", F.col("n_tokens") > limit)


def _encode_chunks(texts: DataFrame, id_type: str, path: str, chunk: int, overlap: int) -> DataFrame:
    """One row per chunk: its token count and the stable boundaries of its overlaps."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc_id, digest, text in zip(b.column(0), b.column(1), b.column(2)):
                raw = text.as_py().encode()
                n = max(1, -(-(len(raw) - overlap) // chunk))
                for i in range(n):  # a chunk begins and ends between characters
                    lo, hi = _at_char(raw, i * chunk), _at_char(raw, len(raw) if i == n - 1 else (i + 1) * chunk + overlap)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([doc_id.as_py()], doc_id.type), pa.array([digest.as_py()], pa.string()), pa.array([i], pa.int32()), pa.array([n], pa.int32()),
                         pa.array([lo], pa.int64()), pa.array([raw[lo:hi].decode()], pa.string())],
                        ["doc_id", "digest", "i", "n", "start", "piece"])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            out = []
            for r in b.to_pylist():
                ids = np.asarray(enc.ids(r["piece"]), np.int64)
                ends, raw = np.cumsum(enc.lengths[ids]), r["piece"].encode()
                left = right = ([], [])
                if r["i"] > 0:
                    left = stable_keys(raw, ids, ends, 0, r["i"] * chunk + overlap - r["start"], r["start"])
                if r["i"] < r["n"] - 1:
                    right = stable_keys(raw, ids, ends, (r["i"] + 1) * chunk - r["start"], len(raw), r["start"])
                out.append({"doc_id": r["doc_id"], "digest": r["digest"], "i": r["i"], "n": r["n"], "total": len(ids),
                            "left_keys": left[0], "left_counts": left[1], "right_keys": right[0], "right_counts": right[1]})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema(
                [("doc_id", b.schema.field("doc_id").type), ("digest", pa.string()), ("i", pa.int32()), ("n", pa.int32()), ("total", pa.int64()),
                 *[(c, pa.list_(pa.int64())) for c in ("left_keys", "left_counts", "right_keys", "right_counts")]]))

    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = texts.mapInArrow(cut, CHUNK_SCHEMA.format(id=id_type))
    return chunks.repartition(parts, "digest", "i").mapInArrow(encode, SEAM_SCHEMA.format(id=id_type))


def _at_char(raw: bytes, p: int) -> int:
    """`p`, or the begin of the character that `p` lies in."""
    while 0 < p < len(raw) and raw[p] & 0xC0 == 0x80:
        p -= 1
    return min(p, len(raw))


def _splice(chunks: DataFrame) -> DataFrame:
    """Tokens per document; null where a seam has no common stable boundary.

    A seam belongs to two chunks only, so no group grows with a document; the
    sum over the seams of a document is aggregated before it is shuffled.
    """
    one = chunks.dropDuplicates(["doc_id", "digest", "i"])  # equal rows make equal chunks
    sides = one.select("doc_id", "digest", F.inline(F.array(
        F.struct(F.col("i").alias("seam"), F.when(F.col("i") > 0, F.map_from_arrays("left_keys", "left_counts")).alias("l"),
                 F.lit(None).cast("map<bigint,bigint>").alias("r"), F.lit(0).cast("long").alias("total")),
        F.struct((F.col("i") + 1).alias("seam"), F.lit(None).cast("map<bigint,bigint>").alias("l"),
                 F.when(F.col("i") < F.col("n") - 1, F.map_from_arrays("right_keys", "right_counts")).alias("r"),
                 F.when(F.col("i") == F.col("n") - 1, F.col("total")).otherwise(0).alias("total")))))
    seams = sides.groupBy("doc_id", "digest", "seam").agg(
        F.first("l", ignorenulls=True).alias("l"), F.first("r", ignorenulls=True).alias("r"), F.sum("total").alias("total"))
    at = F.array_min(F.array_intersect(F.map_keys("l"), F.map_keys("r")))
    inner = F.col("l").isNotNull() & F.col("r").isNotNull()
    seams = seams.withColumn("at", at).select(
        "doc_id", "digest", "total", (inner & F.col("at").isNull()).alias("open"),
        F.when(inner, F.element_at("r", F.col("at")) - F.element_at("l", F.col("at"))).otherwise(0).alias("before"))
    total = F.sum("total") + F.sum("before")
    return seams.groupBy("doc_id", "digest").agg(F.when(~F.bool_or("open"), total).alias("n_tokens"))
