"""op4 against a plain reading of its rules."""

import re

from rows import ODD

from sparkrec.llm.quality import clean, judge, line_fault, quality


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    inside = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    lines, seen, dups = text.split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dups += line in seen
            seen.add(line)
    failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(inside), failed


def test_base_figures(make_docs, empty_docs, sf_docs):
    rows = [(i, t) for i, t in sf_docs[1] if len(t) < 8000] + [r for r in ODD if r[0] != 7]
    got = quality(make_docs(rows)).collect()
    mine = sorted((str(r["doc_id"]), tuple(r)[1:7], r["kept"]) for r in got)
    assert [m[:2] for m in mine] == sorted((str(i), brute(t)) for i, t in rows)
    assert not any(kept and base[5] for _, base, kept in mine)
    assert quality(empty_docs).collect() == []


def test_long_text():
    assert judge("word " * 30_000, 10, 20, 0.3)[4:7] == (30_000, True, False)


def test_line_rules():
    fault = lambda line: line_fault(line, line.encode().split())
    assert fault("home | about | news | contact") == "navigation"
    assert fault("buy$$$ now*** or### never%%%") == "punctuation"
    assert fault("NOW!! OR!! NEVER!!") == "punctuation"
    assert fault("very " * 15) == "repetition"
    assert fault("Please read our Privacy Policy.") == "boilerplate"
    assert fault("home | about | contact") == fault("start » hilfe » suche") == "navigation"
    assert fault("of the three signs | and > used here in a long plain line, two are bars") is None
    assert fault("~ @ ^ _ = + / : ; ? ( ) - ~ @ ^") == "punctuation"
    assert fault("Alle Rechte vorbehalten.") == fault("TOUS DROITS RÉSERVÉS") == fault("Todos los derechos reservados") == "boilerplate"
    assert fault("Lire la suite") == fault("Leer más »") == fault("Zum Inhalt springen") == "boilerplate"
    assert fault("Der Tag, an dem alles begann, war ein Montag.") is None
    assert fault("A plain sentence, with a comma & a mark.") is None
    assert fault("x") is None


def test_clean_drops_and_cuts(make_docs):
    good = "This is a plain line of ten words, no more here.\n"
    rows = [(1, good * 1 + "a | b | c | d"), (2, "a | b | c | d\n" * 4), (3, None), (4, good)]
    out = {r["doc_id"]: r for r in clean(make_docs(rows)).collect()}
    assert set(out) == {1, 4} and out[1]["text"] == good.rstrip("\n") and out[1]["n_chars"] == len(good) - 1
    assert out[4]["text"] == good and out[4]["kept"] == "x"


def test_labelled_documents(spark, sf_docs):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.001/labels.parquet").collect()}
    rows = [(labels[r["doc_id"]], r["kept"], r["base_failed"]) for r in quality(sf_docs[0]).collect() if r["doc_id"] in labels]
    assert all(not kept for good, kept, _ in rows if not good)
    assert all(kept or failed for good, kept, failed in rows if good)
