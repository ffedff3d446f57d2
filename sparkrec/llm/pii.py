"""Personal data by weak supervision.

Four kinds (email, ip, card, phone) have exact definitions and are always
reported. Beyond them, what touches no such span is a candidate for a secret (a
key, a password, an identifier) if it is a whitespace-delimited token that holds
a digit, has the form of a key or is the value of a secret word (`password: x`,
`api_key=x`), or a run of short tokens that is written like an IBAN or follows
an account word. Labelers built on patterns, gazetteers and context vote on each
candidate; expectation-maximisation over the counts of vote patterns estimates
how reliable every labeler is, and its posteriors train the final classifier, a
logistic regression on the candidate's shape and votes, which accepts or drops
the span.

Votes and shapes take few values, so Spark sends one row per combination to the
driver (COMBINATIONS at most), however large the corpus. Texts are judged on
their own, in two passes of Arrow batches: one to count, one to report.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrec.llm.common import pick, rewrite_texts

#: The kinds in the order of reports.
KINDS = ("email", "ip", "card", "phone", "secret")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DIGIT = re.compile(r"[0-9]")
#: A match takes all of a digit run, so none begins behind another digit.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
SPACE = re.compile(r"\s")
TOKEN = re.compile(r"(?<!\S)(?=\S*[0-9])\S+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses, found from the @ outwards: the name is
    the run of its characters before the @, back to the last match at most."""
    out, behind, at = [], 0, text.find("@")
    while at >= 0:
        domain = DOMAIN.match(text, at + 1)
        if domain:
            start = at
            while start > behind and text[start - 1] in LOCAL:
                start -= 1
            if start < at:
                behind = domain.end()
                out.append((start, behind))
        at = text.find("@", max(at + 1, behind))
    return out


def base_spans(text: str) -> list[list[tuple[int, int]]]:
    """Spans (code points, end exclusive) of each base kind, in the order of KINDS."""
    found: list[list[tuple[int, int]]] = [emails(text) if "@" in text else [], [], [], []]
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
                found[1].append(m.span())
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                found[2].append(m.span())
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= sum(map(str.isdigit, m[0])) <= 15:
                    found[3].append(m.span())
    return found


#: Gazetteers: words that announce a secret, and words that announce a plain number.
SECRET_WORDS = frozenset("account apikey code credential id iban key konto kennwort login mot-de-passe pass passport password passwd pin pwd secret ssn token".split())
NUMBER_WORDS = frozenset("article by-nc by-sa chapter fig figure no page part section table version vol volume".split())

KEY = re.compile(r"(?:AKIA|ASIA)[A-Z0-9]{12,}|(?:sk|pk|ghp|gho|xox[abp])[-_]\w{8,}")
ASSIGNED = re.compile(r"(?i)(?:api_?key|key|pass(?:word|wd)?|pwd|secret|token)[=:]\S{4,}")
#: A secret word and its value; account words and grouped identifiers; IBANs in groups.
VALUE = re.compile(r"(?i)(?<![^\W_])(?:api_key|" + "|".join(sorted(map(re.escape, SECRET_WORDS))) + r")[\"']?[ \t]*[:=][ \t]*(?=\S*\w)(\S+)")
KEYLIKE = re.compile(r"(?<!\w)(?:" + KEY.pattern + ")")
GROUPS = re.compile(r"(?<!\w)(?:(?i:iban|account|passport|konto|ssn)(?:[ \t]+(?i:no|nr|number|is))?[.:=#]*[ \t]+)?"
                    r"((?<!\S)[A-Z]{2}[0-9]{2}(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?(?!\w))|"
                    r"(?<!\w)(?i:iban|account|passport|konto|ssn)(?:[ \t]+(?i:no|nr|number|is))?[.:=#]*[ \t]+((?=[A-Z]*[0-9])[A-Z0-9]{1,8}(?:[ -](?:[A-Z]{1,4}[ -])?(?=[A-Z]*[0-9])[A-Z0-9]{1,8})+(?!\w))")
PLAIN_NUMBER = re.compile(r"[(\[]?[v$€£]?[0-9]{1,5}(?:[.,:/][0-9]{1,4})*(?:%|st|nd|rd|th)?[)\].,;:!?]*")
MARKS = ".,;:!?()[]\"'"


def iban(core: str) -> bool:
    """Whether the check digits of an account number hold."""
    return bool(re.fullmatch(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", core)) and int("".join(str(int(c, 36)) for c in core[4:] + core[:4])) % 97 == 1


def votes(token: str, before: list[str], value: bool = False) -> str:
    """One character per labeler: + secret, - no secret, 0 no vote; `value`: the
    token is the value of a secret word."""
    core = token.strip(MARKS)
    letters, digits = sum(map(str.isalpha, core)), sum(map(str.isdigit, core))
    near = {w.strip(MARKS).lower() for w in before}
    last = before[-1].strip(MARKS).lower() if before else ""
    changes = sum(a.isdigit() != b.isdigit() for a, b in zip(core, core[1:]))
    return "".join((
        "+" if KEY.fullmatch(core) or iban(core) else "0",
        "+" if value or ASSIGNED.fullmatch(core) else "0",
        "+" if len(core) >= 12 and digits >= 3 and letters >= 3 else "-" if len(core) < 6 else "0",
        "-" if PLAIN_NUMBER.fullmatch(token) else "0",
        "+" if near & SECRET_WORDS or core.split("=")[0].split(":")[0].lower() in SECRET_WORDS else "0",
        "-" if last in NUMBER_WORDS else "0",
        "+" if changes >= 4 else "-" if changes == 0 and digits else "0",
    ))


def shape(token: str) -> str:
    """Coarse form of a candidate: a few values for each of five traits."""
    core = token.strip(MARKS)
    digits = sum(map(str.isdigit, core))
    counts = Counter(core).values()
    entropy = -sum(c / len(core) * math.log2(c / len(core)) for c in counts) if core else 0
    return "".join((
        str(min(4, len(core) // 5)), str(min(3, 4 * digits // max(1, len(core)))), str(min(4, int(entropy))),
        "u" if any(map(str.isupper, core)) else "n", "l" if any(map(str.islower, core)) else "n",
        "=" if "=" in core or ":" in core else "n"))


N_LABELERS = 7
#: Bound on the rows that training gets: vote patterns times shapes.
COMBINATIONS = 3 ** N_LABELERS * 5 * 4 * 5 * 8


def tokens_at(text: str, places: Iterator[int]) -> dict[int, int]:
    """start -> end of the whitespace-delimited tokens that hold ascending places."""
    out: dict[int, int] = {}
    end = -1
    for at in places:
        if at < end:
            continue
        start = at
        while start and not text[start - 1].isspace():
            start -= 1
        gap = SPACE.search(text, at)
        end = out[start] = gap.start() if gap else len(text)
    return out


def candidates(text: str, taken: list[tuple[int, int]]) -> Iterator[tuple[int, int, str, str]]:
    """(start, end, votes, shape) of every candidate that touches no base span."""
    values = tokens_at(text, (m.start(1) for m in VALUE.finditer(text))) if ":" in text or "=" in text else {}
    tokens = values | tokens_at(text, (m.start() for m in KEYLIKE.finditer(text)))
    grouped: list[tuple[int, int]] = []
    if DIGIT.search(text):
        tokens |= (m.span() for m in TOKEN.finditer(text))
        for m in GROUPS.finditer(text):
            lo, hi = m.span(m.lastindex)
            if DIGIT.search(text, lo, hi) and not any(a < hi and lo < b for a, b in taken):
                grouped.append((lo, hi))
    if not tokens and not grouped:
        return
    taken = sorted([*taken, *grouped])
    out = [(lo, hi, re.sub("[ -]", "", text[lo:hi]), False) for lo, hi in grouped]
    k = 0
    for start, end in sorted(tokens.items()):
        while k < len(taken) and taken[k][1] <= start:
            k += 1
        if k < len(taken) and taken[k][0] < end:
            continue
        token = text[start:end]
        left = len(token) - len(token.lstrip(MARKS))
        right = len(token.rstrip(MARKS))
        if left < right:
            out.append((start, end, token, start in values))
    for start, end, token, value in sorted(out):
        before = text[max(0, start - 60):start].split()[-3:]
        own = text[start:end]
        yield (start + len(own) - len(own.lstrip(MARKS)), start + len(own.rstrip(MARKS)), votes(token, before, value), shape(token))


def reliabilities(patterns: list[str], counts: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray, float]:
    """Expectation-maximisation: posterior of "secret" for each vote pattern,
    P(vote | class) of every labeler (labeler x class x vote), and the prior.

    Starts from the majority of the votes; votes are independent given the class.
    """
    v = np.array([["-0+".index(c) for c in p] for p in patterns])
    post = np.clip(0.5 + 0.25 * (v - 1).sum(axis=1), 0.05, 0.95)
    table, prior = np.zeros((v.shape[1], 2, 3)), 0.5
    for _ in range(rounds):
        weight = np.stack([(1 - post) * counts, post * counts])
        prior = float(np.clip(weight[1].sum() / counts.sum(), 0.01, 0.99))
        for j in range(v.shape[1]):
            for c in (0, 1):
                seen = np.bincount(v[:, j], weights=weight[c], minlength=3) + 0.5
                table[j, c] = seen / seen.sum()
        odds = np.log(prior / (1 - prior)) + sum(np.log(table[j, 1, v[:, j]] / table[j, 0, v[:, j]]) for j in range(v.shape[1]))
        post = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return post, table, prior


@dataclass
class SpanClassifier:
    """Logistic regression over one-hot votes and shape traits."""

    weights: dict[tuple[int, str], float]
    bias: float

    def accepts(self, votes_: str, shape_: str) -> bool:
        return self.bias + sum(self.weights.get((i, c), 0.0) for i, c in enumerate(votes_ + shape_)) >= 0


def fit(counted: list[tuple[str, str, int]], steps: int = 400, rate: float = 0.5, decay: float = 1e-3) -> SpanClassifier:
    """Train on the posteriors of (votes, shape, count) combinations."""
    if not counted:
        return SpanClassifier({}, -1.0)
    counted = sorted(counted)
    by_votes = Counter()
    for v, _, n in counted:
        by_votes[v] += n
    patterns = sorted(by_votes)
    post, _, _ = reliabilities(patterns, np.array([by_votes[p] for p in patterns], float))
    soft = dict(zip(patterns, post))
    features = sorted({(i, c) for v, s, _ in counted for i, c in enumerate(v + s)})
    column = {f: k for k, f in enumerate(features)}
    x = np.zeros((len(counted), len(features)))
    for row, (v, s, _) in enumerate(counted):
        x[row, [column[i, c] for i, c in enumerate(v + s)]] = 1
    y = np.array([soft[v] for v, _, _ in counted])
    n = np.sqrt(np.array([c for _, _, c in counted], float))  # damped, so frequent forms don't drown rare ones
    n /= n.sum()
    w, b = np.zeros(len(features)), 0.0
    for _ in range(steps):
        error = n * (1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30))) - y)
        w -= rate * (x.T @ error + decay * w)
        b -= rate * error.sum()
    return SpanClassifier({f: float(w[k]) for f, k in column.items()}, float(b))


def all_spans(text: str, model: SpanClassifier) -> list[list[tuple[int, int]]]:
    """Base spans and accepted candidates, in the order of KINDS."""
    found = base_spans(text)
    taken = [s for kind in found for s in kind]
    return [*found, [(a, b) for a, b, v, s in candidates(text, taken) if model.accepts(v, s)]]


def learn(docs: DataFrame, *, text_col: str = "text") -> SpanClassifier:
    """Count vote patterns over all texts and train the span classifier."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for b in batches:
            for t in b.column(0):
                text = t.as_py()
                taken = [s for kind in base_spans(text) for s in kind]
                seen.update((v, s) for _, _, v, s in candidates(text, taken))
        if seen:
            rows = [(v, s, n) for (v, s), n in sorted(seen.items())]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["votes", "shape", "n"])

    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    counted = texts.mapInArrow(run, "votes string, shape string, n long").groupBy("votes", "shape").agg(F.sum("n").alias("n"))
    return fit([(r["votes"], r["shape"], r["n"]) for r in counted.limit(COMBINATIONS).collect()])


def personal_data(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, a count for each base kind, base_sha256, spans, n_secret; one row per input row.

    ``spans`` is kind:start:end (code points, end exclusive) by kind and then
    start, joined by commas; ``base_sha256`` the hash of the same string of the
    base kinds alone. Null texts count as empty; ids may be null or repeated.
    """
    model = learn(docs, text_col=text_col)
    texts = pick(docs, id_col, text_col)
    id_type = texts.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_secret"]
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for t in b.column(1):
                found = all_spans(t.as_py(), model)
                listed = [[f"{k}:{lo}:{hi}" for lo, hi in spans] for k, spans in zip(KINDS, found)]
                base = ",".join(x for own in listed[:4] for x in own)
                out.append((*map(len, found[:4]), hashlib.sha256(base.encode()).hexdigest(), ",".join(x for own in listed for x in own), len(found[4])))
            cols = list(zip(*out)) or [()] * 7
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))], names)

    return texts.mapInArrow(run, f"doc_id {id_type}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_secret long")


def mask(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """`docs` with every span replaced by its kind in brackets; all columns and rows stay."""
    model = learn(docs, text_col=text_col)

    def hide(text: str) -> str:
        spans = sorted((lo, hi, k) for k, own in zip(KINDS, all_spans(text, model)) for lo, hi in own)
        out, at = [], 0
        for lo, hi, kind in spans:
            if lo >= at:  # of overlapping spans the first names the mask
                out += [text[at:lo], f"[{kind.upper()}]"]
            at = max(at, hi)
        return "".join([*out, text[at:]]) if spans else text

    return rewrite_texts(docs, hide, text_col)
