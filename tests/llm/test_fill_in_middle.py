"""op12 against plain list cuts, and exact round trips."""

import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rows import ODD
from sparkrec.llm.fill_in_middle import Blocks, Plan, digests, fill_in_middle, restored, transform


def plain(doc_id, text, rate=100):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, text
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 50:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


texts = st.text(st.sampled_from(["a", "\n", "é", "日", "😀", "<", ">", "S", "P", " ", "\r", "\x00", " "]), max_size=60)


@settings(max_examples=300, deadline=None)
@given(st.integers(-5, 10**12), texts, st.integers(1, 9))
def test_transform_equals_plain_cuts(doc_id, text, block):
    assert transform(doc_id, text, block=block) == plain(doc_id, text)


@settings(max_examples=200, deadline=None)
@given(texts, st.integers(1, 9))
def test_every_cut(text, block):
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    blocks = Blocks(text.encode(), block)
    assert (blocks.n, blocks.chars) == (len(units), len(text))
    for k in range(len(units) + 1):
        before = "".join(units[:k])
        assert blocks.cut(k) == (len(before.encode()), len(before))


def test_rate_leaves_texts_plain():
    forms = [transform(i, "a\nb\nc", Plan(rate=30))[1] for i in range(300)]
    assert forms == [plain(i, "a\nb\nc", 30)[1] for i in range(300)] and 150 < forms.count("plain") < 250


def check(docs, rows):
    out = fill_in_middle(docs)
    got = out.withColumn("back", restored(F.col("output"), F.col("form"))).collect()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"], r["back"]) for r in got), key=key) == sorted(
        ((i, *plain(i, t), t or "") for i, t in rows), key=key)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert sorted(((r["doc_id"], r["output_sha256"], r["restored_sha256"]) for r in digests(out).collect()), key=key) == sorted(
        ((i, sha(plain(i, t)[4]), sha(t or "")) for i, t in rows), key=key)


def test_odd_rows_and_marks(make_docs):
    rows = [*ODD, (20, "with <P> inside\nand more"), (21, "<S>"), (22, "near < P> <"), (23, "ends with <"), (24, "\n\n\n"), (25, "<S\n>P\n<M\n" * 50),
            (26, "long\nlines " * 50_000)]
    check(make_docs(rows), rows)


def test_given_documents(sf_docs):
    check(*sf_docs)


def test_empty_table(empty_docs):
    assert digests(fill_in_middle(empty_docs)).collect() == []
