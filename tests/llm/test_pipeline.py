"""The pipeline against a plain run of its stages' definitions on a small corpus."""

import random

import corpus_pipeline
from test_minhash import brute as near_groups
from test_packing import check_bins
from test_quality import brute as base_figures
from test_suffix_dedup import corpus as passages

from sparkrec.llm.pii import all_spans, base_spans, candidates, fit
from sparkrec.llm.quality import judge
from sparkrec.llm.suffix_dedup import merged, whole_characters, without


def plain_run(rows):
    """(doc_id, text) after the first four stages."""
    rows = [(i, judge(t or "", 10, 20, 0.3)[9]) for i, t in rows if not base_figures(t)[5] and judge(t or "", 10, 20, 0.3)[6]]
    kept = {i for i, _, _, k in near_groups(rows, words=5) if k}
    rows = sorted((i, t) for i, t in rows if i in kept)
    seen, out = set(), []
    for i, t in rows:
        raw, spans = t.encode(), []
        for p in range(len(raw) - 99):
            if raw[p:p + 100] in seen:
                spans.append((p, p + 100))
            seen.add(raw[p:p + 100])
        runs = [whole_characters(raw, lo, hi) for lo, hi in merged(spans)]
        out.append((i, without(raw, [r for r in runs if r[0] < r[1]]).decode()))
    counted = {}
    for _, t in out:
        for _, _, v, s in candidates(t, [x for own in base_spans(t) for x in own]):
            counted[v, s] = counted.get((v, s), 0) + 1
    model = fit([(v, s, n) for (v, s), n in counted.items()])
    masked = []
    for i, t in out:
        for lo, hi, kind in sorted(((lo, hi, k) for k, own in zip(("EMAIL", "IP", "CARD", "PHONE", "SECRET"), all_spans(t, model)) for lo, hi in own), reverse=True):
            t = f"{t[:lo]}[{kind}]{t[hi:]}"
        masked.append((i, t))
    return masked


def make_corpus():
    rng = random.Random(9)
    extra = [f"mail me{k}@x{k}.org or +1 (555) 010-{1000 + k} password={rng.getrandbits(64):016x}" for k in range(10)]
    rows = [(i, t + " " + " ".join(f"u{i}w{k}" for k in range(25)) + (" " + extra[i % 10] if i % 4 == 0 else "")) for i, t in passages(4)]
    return [*rows, (5000, rows[3][1] + " tail"), (5001, rows[3][1]), (5002, None), (5003, "a | b | c | d\n" * 5), (5004, rows[8][1])]


def test_stages_and_run(spark, make_docs, tmp_path):
    rows = make_corpus()
    docs = make_docs(rows)
    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    got = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, got, folder)
        assert got.columns == docs.columns
    want = plain_run(rows)
    assert sorted((r["doc_id"], r["text"]) for r in got.collect()) == sorted(want)
    packed = corpus_pipeline.run(spark, folder).collect()
    check_bins(packed, (2048, 4096, 8192, 16384))
    assert sorted((r["doc_id"], r["n_bytes"]) for r in packed) == sorted((i, len(t.encode())) for i, t in want)


def test_empty_documents(spark, empty_docs, tmp_path):
    empty_docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_stage_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "MinHash near-dedup", "suffix-array dedup", "PII", "best-fit packing"]
