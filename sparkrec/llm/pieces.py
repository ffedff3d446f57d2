"""N-best segmentation over a SentencePiece vocabulary, and decoding.

The lattice of a text has an edge for every piece of the vocabulary that matches
at a position, and byte pieces for characters without a piece. A segmentation's
score is the sum of its pieces' scores. A forward Viterbi pass gives the best
score up to each position; backward A* search from the end uses it as its
heuristic, which is exact, so partial paths leave the queue in the order of the
full segmentations that they lead to, and the first N that arrive are the best.

No piece reaches over the begin of a space mark or over a line end, so the
lattice of a text is a chain of small ones, one per word. A text's N best
segmentations follow exactly from the N - 1 words whose second best is closest
to their best; A* runs for these. The Viterbi pass takes all distinct words of
a block of texts at once, by length, in numpy.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sparkrec.llm.common import mix64, pick

MARK = "▁"
#: Longer words, and those with a character that has no piece, go one by one.
VECTOR_CHARS = 32
#: Texts whose words are handled together.
BLOCK_ROWS = 500
#: Piece ids from which a batch of segmentations is handed on.
BLOCK_IDS = 1 << 21
#: Scores up to this are no scores.
PLACEHOLDER = -1e8
#: Taken off the lowest piece score for each byte of a character without piece.
BYTE_PENALTY = 10.0


class Vocabulary:
    """Pieces, scores and byte pieces of a SentencePiece model."""

    def __init__(self, path: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids: dict[str, int] = {}
        self.scores: list[float] = []
        self.bytes_of: list[bytes] = []
        self.byte_ids: dict[int, int] = {}
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            self.scores.append(model.get_score(i))
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.bytes_of.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.bytes_of.append(b"")
            else:
                self.ids[piece] = i
                self.bytes_of.append(piece.replace(MARK, " ").encode())
        if any(MARK in p[1:] and p.strip(MARK) for p in self.ids):
            raise ValueError(f"{path}: a piece reaches over the begin of a word")
        if len(self.byte_ids) != 256:
            raise ValueError(f"{path}: byte pieces are missing")
        #: Every beginning of a piece: its id if it is a piece itself, else -1.
        self.starts = {p[:k]: -1 for p in self.ids for k in range(1, len(p))} | self.ids
        # runs of space marks have a placeholder for a score; they count as the rarest piece
        lowest = min(self.scores[i] for i in self.ids.values() if self.scores[i] > PLACEHOLDER)
        self.scores = [s if s > PLACEHOLDER else lowest for s in self.scores]
        self.byte_score = lowest - BYTE_PENALTY
        lone = "".join(c for c in "\n\r\t" if not any(c in p for p in self.ids))
        rest = f"[^{MARK}{lone}]" if lone else f"[^{MARK}]"
        self.words = re.compile(f"{MARK}+{rest}*|{rest}+" + (f"|[{lone}]" if lone else ""))
        self.score_of = np.array(self.scores)
        self.alphabet = frozenset(p for p in self.ids if len(p) == 1)
        self.odd = re.compile("[^" + re.escape("".join(sorted(self.alphabet))) + "]")
        # beginnings of pieces by a hash of their code points, and where each range of hashes begins
        by_length: dict[int, list[str]] = {}
        for start in self.starts:
            by_length.setdefault(len(start), []).append(start)
        hashes = [_hashes(_code_points(own, n))(0, n) for n, own in by_length.items()]
        ids = [np.array([self.starts[p] for p in own]) for own in by_length.values()]
        hashes, ids = np.concatenate(hashes), np.concatenate(ids)
        order = np.argsort(hashes)
        self.hashes = np.concatenate([hashes[order], np.zeros(8, np.uint64)])
        self.hash_ids = np.concatenate([ids[order], np.full(8, -2)])
        self.ranges = np.searchsorted(hashes[order], np.arange(1 << 18, dtype=np.uint64) << np.uint64(46))
        self.crowd = int(np.bincount((hashes >> np.uint64(46)).astype(np.int64)).max())
        self.n_best = lru_cache(maxsize=20_000)(self._n_best)

    def split(self, text: str) -> list[str]:
        """Words of a text, each with its own lattice."""
        return self.words.findall(MARK + text.replace(" ", MARK)) if text else []

    def lattice(self, word: str) -> list[list[tuple[int, tuple[int, ...], float]]]:
        """Per position, the edges that end there: (begin, piece ids, score)."""
        get, scores, n = self.starts.get, self.scores, len(word)
        edges: list[list[tuple[int, tuple[int, ...], float]]] = [[] for _ in range(n + 1)]
        for i in range(n):
            for j in range(i + 1, n + 1):
                k = get(word[i:j])
                if k is None:
                    break
                if k >= 0:
                    edges[j].append((i, (k,), scores[k]))
            if word[i] not in self.ids:
                raw = tuple(self.byte_ids[b] for b in word[i].encode())
                edges[i + 1].append((i, raw, self.byte_score * len(raw)))
        return edges

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Piece ids of hashes; -1 for the mere beginning of a piece, -2 for none."""
        at = self.ranges[(hashes >> np.uint64(46)).astype(np.int64)]
        found = np.full(len(hashes), -2)
        for k in range(self.crowd):
            hit = self.hashes[at + k] == hashes
            found[hit] = self.hash_ids[at[hit] + k]
        return found

    def best(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Forward Viterbi over all `words`: ids of the best segmentations end to
        end, their bounds, their scores, and how far the second best is below
        (infinite if there is none)."""
        size, score, gap = np.zeros(len(words), np.int64), np.zeros(len(words)), np.zeros(len(words))
        chunks: list[tuple[np.ndarray, np.ndarray]] = []  # (word numbers, their ids one word after the other)
        groups: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            if len(w) > VECTOR_CHARS or self.odd.search(w):
                ids, score[i], gap[i] = self._best(w)
                size[i] = len(ids)
                chunks.append((np.array([i]), ids))
            else:
                groups.setdefault(len(w), []).append(i)
        for n, own in groups.items():
            at = np.array(own)
            ids, size[at], score[at], gap[at] = self._best_of_length([words[i] for i in own], n)
            chunks.append((at, ids))
        bounds = np.zeros(len(words) + 1, np.int64)
        np.cumsum(size, out=bounds[1:])
        flat = np.zeros(bounds[-1], np.int32)
        for at, ids in chunks:
            flat[spread(bounds[at], size[at])] = ids
        return flat, bounds, score, gap

    def _best_of_length(self, words: list[str], n: int) -> tuple[np.ndarray, ...]:
        part = _hashes(_code_points(words, n))
        first, second = np.full((n + 1, len(words)), -np.inf), np.full((n + 1, len(words)), -np.inf)
        first[0] = 0
        came, piece = np.zeros((n + 1, len(words)), np.int8), np.zeros((n + 1, len(words)), np.int32)
        for i in range(n):
            alive = np.arange(len(words))  # whose characters from i on begin a piece
            for j in range(i + 1, n + 1):
                ids = self.find(part(i, j, alive))
                alive, ids = alive[ids > -2], ids[ids > -2]
                if not len(alive):
                    break
                w, ids = alive[ids >= 0], ids[ids >= 0]
                s, s2 = first[i, w] + self.score_of[ids], second[i, w] + self.score_of[ids]
                old = first[j, w]
                better = s > old
                second[j, w] = np.where(better, np.maximum(old, s2), np.maximum(second[j, w], s))
                w, ids = w[better], ids[better]
                first[j, w], came[j, w], piece[j, w] = s[better], i, ids
        every = np.arange(len(words))
        at, size = np.full(len(words), n), np.zeros(len(words), np.int64)
        steps = []
        while (open_ := at > 0).any():
            steps.append(np.where(open_, piece[at, every], -1))
            size += open_
            at = np.where(open_, came[at, every], 0)
        back = np.array(steps[::-1]).T
        return back[back >= 0], size, first[n], first[n] - second[n]

    def _best(self, word: str) -> tuple[np.ndarray, float, float]:
        get, scores, n, none = self.starts.get, self.scores, len(word), float("-inf")
        first, second, back = [0.0] + [none] * n, [none] * (n + 1), [None] * (n + 1)
        for i in range(n):
            here, next_ = first[i], second[i]
            for j in range(i + 1, n + 1):
                k = get(word[i:j])
                if k is None:
                    break
                if k < 0:
                    continue
                s = here + scores[k]
                if s > first[j]:
                    second[j], first[j], back[j] = max(first[j], next_ + scores[k]), s, (i, (k,))
                elif s > second[j]:
                    second[j] = s
            if word[i] not in self.ids:
                raw = tuple(self.byte_ids[b] for b in word[i].encode())
                s, s2 = here + self.byte_score * len(raw), next_ + self.byte_score * len(raw)
                if s > first[i + 1]:
                    second[i + 1], first[i + 1], back[i + 1] = max(first[i + 1], s2), s, (i, raw)
                else:
                    second[i + 1] = max(second[i + 1], s)
        ids: list[int] = []
        j = n
        while j:
            i, own = back[j]
            ids[:0] = own
            j = i
        return np.array(ids, np.int32), first[n], first[n] - second[n]

    def _n_best(self, word: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The n best segmentations of one word, by backward A* search."""
        edges = self.lattice(word)
        ahead = [0.0] + [float("-inf")] * len(word)
        for j in range(1, len(word) + 1):
            ahead[j] = max((ahead[i] + s for i, _, s in edges[j]), default=float("-inf"))
        queue: list[tuple] = [(-ahead[-1], 0, len(word), 0.0, None)]
        found: list[tuple[float, tuple[int, ...]]] = []
        pushed = 0
        while queue and len(found) < n:
            _, _, j, behind, path = heapq.heappop(queue)
            if j == 0:
                ids: list[int] = []
                while path:
                    ids += path[0]
                    path = path[1]
                found.append((behind, tuple(ids)))
                continue
            for i, own, s in edges[j]:
                if ahead[i] > float("-inf"):
                    pushed += 1
                    heapq.heappush(queue, (-(ahead[i] + s + behind), pushed, i, s + behind, (own, path)))
        return found

    def text_scores(self, words: list[str], total: float, gaps: np.ndarray, n: int) -> list[float]:
        """Scores of the n best segmentations of a whole text, best first."""
        return [score for score, _ in self.text_best(words, total, gaps, n)]

    def text_best(self, words: list[str], total: float, gaps: np.ndarray, n: int, best: Callable[[int], tuple[int, ...]] = lambda at: ()) -> list[tuple[float, dict[int, tuple[int, ...]]]]:
        """The n best segmentations of a whole text, best first: score, and by
        place the ids of the words that aren't segmented as in the best one,
        whose ids `best` gives."""
        few = np.argsort(gaps, kind="stable")[:n - 1] if len(gaps) <= 4 * n else np.argpartition(gaps, n - 1)[:n - 1]
        losses: list[tuple[float, tuple]] = [(0.0, ())]
        for at in few[np.isfinite(gaps[few])].tolist():
            own, first = self.n_best(words[at], n), best(at)
            # of equal ones the Viterbi pass may have taken another than A*
            others = [ids for _, ids in own if ids != first] if any(ids == first for _, ids in own) else [ids for _, ids in own[1:]]
            ways = [(0.0, ()), *((own[0][0] - s, ((at, ids),)) for (s, _), ids in zip(own[1:], others))]
            losses = heapq.nsmallest(n, ((x + y, p + q) for x, p in losses for y, q in ways))
        return [(total - x, dict(p)) for x, p in losses]

    def decode(self, ids: np.ndarray) -> str:
        """The text of piece ids: pieces joined, marks to spaces, the leading one dropped."""
        raw = b"".join(map(self.bytes_of.__getitem__, ids.tolist()))
        return (raw[1:] if raw[:1] == b" " else raw).decode(errors="replace")


def _code_points(words: list[str], n: int) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(-1, n)


def _hashes(codes: np.ndarray):
    """A function (i, j, rows) to the hashes of the substrings i..j of rows."""
    n = codes.shape[1]
    base = 0x9E3779B97F4A7C15
    up = np.array([pow(base, k, 1 << 64) for k in range(n)], np.uint64)
    down = np.array([pow(base, -k, 1 << 64) for k in range(n)], np.uint64)
    sums = np.zeros((n + 1, len(codes)), np.uint64)
    np.cumsum((mix64(codes.astype(np.uint64) + np.uint64(1)) * up).T, axis=0, out=sums[1:])
    return lambda i, j, rows=slice(None): mix64((sums[j, rows] - sums[i, rows]) * down[i] + np.uint64(j - i))


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places starts[k] .. starts[k] + sizes[k] - 1 of all k, one after the other."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _segmentations(parts: list[list[tuple[float, np.ndarray]]]) -> pa.Array:
    """Rows of (score, ids) as array<struct<score, ids>>."""
    flat = [x for own in parts for x in own]
    ends = np.cumsum([0, *(len(ids) for _, ids in flat)]).astype(np.int32)
    ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int32), *(ids for _, ids in flat)])))
    rows = pa.StructArray.from_arrays([pa.array([s for s, _ in flat], pa.float64()), ids], ["score", "ids"])
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, parts)]).astype(np.int32)), rows)


def _segment(model_path: str, n_best: int):
    """Texts to (doc_id, text, segmentations)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(model_path)
        for b in batches:
            for at in range(0, b.num_rows, BLOCK_ROWS):
                part, out, held, begin = b.slice(at, BLOCK_ROWS), [], 0, 0
                split = [vocab.split(t) for t in part.column(1).to_pylist()]
                known = {w: k for k, w in enumerate(dict.fromkeys(chain.from_iterable(split)))}
                rows = [np.fromiter(map(known.__getitem__, words), np.int64, len(words)) for words in split]
                flat, bounds, score, gap = vocab.best(list(known))
                for row, (words, own) in enumerate(zip(split, rows)):
                    ends = np.cumsum(bounds[own + 1] - bounds[own])
                    ids = flat[spread(bounds[own], bounds[own + 1] - bounds[own])]
                    ways = []
                    for s, changed in vocab.text_best(words, float(score[own].sum()), gap[own], n_best, lambda w: tuple(flat[bounds[own[w]]:bounds[own[w] + 1]].tolist())):
                        pieces, done = [], 0
                        for w, other in sorted(changed.items()):
                            pieces += [ids[done:ends[w - 1] if w else 0], np.array(other, np.int32)]
                            done = ends[w]
                        ways.append((s, np.concatenate([*pieces, ids[done:]])))
                    out.append(ways)
                    held += sum(len(x) for _, x in ways)
                    if held >= BLOCK_IDS or row == len(rows) - 1:
                        yield pa.RecordBatch.from_arrays([*(c.slice(begin, len(out)) for c in part.columns), _segmentations(out)], ["doc_id", "text", "segmentations"])
                        out, held, begin = [], 0, row + 1

    return run


def _digest(model_path: str):
    """(doc_id, text, segmentations) to the columns of `segment_texts`."""
    names = ["doc_id", "n_pieces", "best_score", "scores", "ids_sha256", "round_trip"]
    kinds = [pa.int64(), pa.float64(), pa.list_(pa.float64()), pa.string(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(model_path)
        for b in batches:
            each, bounds = b.column(2).values, b.column(2).offsets.to_numpy()
            ids, ends = each.field("ids").values.to_numpy(), each.field("ids").offsets.to_numpy()
            scores, out = each.field("score").to_pylist(), []
            for text, lo, hi in zip(b.column(1).to_pylist(), bounds, bounds[1:]):
                best = ids[ends[lo]:ends[lo + 1]]
                out.append((len(best), scores[lo], scores[lo:hi], hashlib.sha256(best.tobytes()).hexdigest(), vocab.decode(best) == text))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(zip(*out), kinds))], names)

    return run


def n_best_segmentations(docs: DataFrame, model_path: str, *, id_col: str = "doc_id", text_col: str = "text", n_best: int = 4) -> DataFrame:
    """doc_id, text, segmentations; one row per input row.

    ``segmentations`` are the `n_best` best ones of the whole text (fewer if
    there are fewer), best first, each with its ``score`` and piece ``ids``.
    Scores are sums over pieces; under a BPE model, whose scores are merge
    ranks, the best one is not the model's own encoding (`model_segmentations`).
    Null texts count as empty: one segmentation without ids, of score 0. Ids may
    be null or repeated.
    """
    texts = pick(docs, id_col, text_col)
    id_type = texts.schema["doc_id"].dataType.simpleString()

    return texts.mapInArrow(_segment(model_path, n_best), f"doc_id {id_type}, text string, segmentations array<struct<score: double, ids: array<int>>>")


@lru_cache(maxsize=2)
def library(path: str):
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=path)


def segment_texts(docs: DataFrame, model_path: str, *, id_col: str = "doc_id", text_col: str = "text", n_best: int = 4) -> DataFrame:
    """doc_id, n_pieces, best_score, scores, ids_sha256, round_trip; one row per input row.

    Digests of the rows of `n_best_segmentations`, taken in the same pass: ``scores`` are those of all its
    segmentations, ``ids_sha256`` hashes the best one's ids (little-endian
    32-bit), and ``round_trip`` tells whether decoding them, as `decode_ids` does, gives the text back
    (only texts with the space mark itself don't).
    """
    texts = pick(docs, id_col, text_col)
    id_type = texts.schema["doc_id"].dataType.simpleString()
    segment, digest = _segment(model_path, n_best), _digest(model_path)
    return texts.mapInArrow(lambda batches: digest(segment(batches)),
                            f"doc_id {id_type}, n_pieces long, best_score double, scores array<double>, ids_sha256 string, round_trip boolean")


def model_segmentations(docs: DataFrame, model_path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the ids of the model's own encoding, by the library; one row per
    input row. Null texts count as empty; ids may be null or repeated."""
    texts = pick(docs, id_col, text_col)
    id_type = texts.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = library(model_path)
        for b in batches:
            for at in range(0, b.num_rows, BLOCK_ROWS):
                part = b.slice(at, BLOCK_ROWS)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(model.encode(part.column(1).to_pylist()), pa.list_(pa.int32()))], ["doc_id", "ids"])

    return texts.mapInArrow(run, f"doc_id {id_type}, ids array<int>")


def decode_ids(pieces: DataFrame, model_path: str, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and the text of each array of piece ids (null: empty)."""
    rows = pieces.selectExpr(f"`{id_col}` AS doc_id", f"coalesce(cast(`{ids_col}` AS array<int>), array()) AS ids")
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(model_path)
        for b in batches:
            texts = [vocab.decode(np.array(i.as_py(), np.int32)) for i in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return rows.mapInArrow(run, f"doc_id {id_type}, text string")
