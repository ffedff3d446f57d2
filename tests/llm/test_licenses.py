"""op6: wordings that must and must not be confirmed."""

import random
import textwrap

from rows import ODD

from sparkrec.llm.licenses import BSD_ADVERTISING, BSD_KEEP, BSD_NAMES, BSD_USE, TEMPLATES, WORDS, blocks, confirm, differences, rank, scan, windows


def test_every_template_confirms_itself():
    for name, text in TEMPLATES:
        assert confirm(text)[0][::2] == (name, 0), text
        words = WORDS.findall(text.lower())
        best = rank(words, list(range(len(words))))[0]
        assert TEMPLATES[best[1]][0] == name and best[0] > 0.9


def test_small_changes_of_wording():
    assert confirm("This work is licenced under the GNU General Public License, version 3")[0][0] == "GPL-3.0"
    assert confirm("Released under the terms of the MIT License.")[0][0] == "MIT"
    assert [c[0] for c in confirm("Copyright 2020 by the authors. All rights reserved.")] == ["all-rights-reserved"]


def test_other_versions_and_plain_talk_are_not_confirmed():
    for text in ("This work is licensed under the GNU General Public License, version 7.", "Licensed under the Apache License, Version 1.1.",
                 "The license of poets is to lie.", "Licensed under CC BY-ND 3.0."):
        assert confirm(text) == [], text


def test_differences():
    assert differences("Released under the new MIT License.", "Released under the MIT License.") == (1.0, [], ["new"])


def test_scan(make_docs, empty_docs):
    text = "Some prose.\nReleased under the MIT License.\nMore prose here.\nAll rights reserved.\n"
    assert [text[a:b] for a, b in blocks(text)] == ["Released under the MIT License.", "All rights reserved."]
    rows = [*ODD, (50, text), (51, "no such thing\n" * 3)]
    got = {r["doc_id"]: r for r in scan(make_docs(rows)).collect()}
    assert got[50]["n_blocks"] == 2 and got[50]["licenses"] == "MIT,all-rights-reserved" and got[50]["best_license"] == "MIT"
    assert got[50]["n_differences"] == 0 and got[51]["licenses"] == "" and got[1]["n_blocks"] == 0
    assert scan(make_docs(rows)).count() == len(rows) and scan(empty_docs).collect() == []


def test_given_documents(sf_docs):
    df, rows = sf_docs
    lines = {"Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Licensed under the Apache License, Version 2.0.": "Apache-2.0", "All rights reserved.": "all-rights-reserved",
             "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0", "Released under the MIT License.": "MIT"}
    want = {i: ",".join(sorted({v for k, v in lines.items() if k in t.split("\n")})) for i, t in rows}
    assert {r["doc_id"]: r["licenses"] for r in scan(df).collect()} == want


def changed(draw):
    """A template's wording with words lost and put in, broken into lines or not, inside prose."""
    words = draw.choice(TEMPLATES)[1].split()
    lost = set(draw.sample(range(len(words)), draw.randrange(0, max(1, len(words) // 5) + 1)))
    words = [w for i, w in enumerate(words) if i not in lost]
    for _ in range(draw.randrange(4)):
        words.insert(draw.randrange(len(words) + 1), draw.choice(["the", "this", "above", "software", "und", "following"]))
    text, lead = " ".join(words), draw.choice(["", " * ", "# "])
    if draw.random() < 0.5:
        text = textwrap.fill(text, draw.choice([30, 60, 80]), initial_indent=lead, subsequent_indent=lead)
    return f"{PROSE[:draw.randrange(300)]} {text} {PROSE[:draw.randrange(300)]}"


def test_ranked_candidates_equal_every_window_and_template(sf_docs):
    """The cut of the ranking loses nothing that the exact wordings would confirm."""
    draw = random.Random(8)
    texts = [changed(draw) for _ in range(150)] + [t or "" for _, t in sf_docs[1]] + ["İstanbul " * 40 + "Released under the MIT License. " + "ı" * 300]
    names = lambda text, **o: sorted(c[0] for c in confirm(text, **o))
    got, want = [names(t) for t in texts], [names(t, saved=-9.0) for t in texts]
    assert got == want and sum(map(bool, got)) >= 100


def test_every_place_around_a_cue_lies_in_a_window():
    for step, cue, n in ((8, 0, 5), (8, 37, 100), (64, 500, 1000)):
        own = windows([cue], n, step)
        for begin in range(max(0, cue - 2 * step + 1), cue + 1):
            assert any(a <= begin and min(n, begin + 2 * step) <= b for a, b in own)


PROSE = "The river rose over the meadows while the farmers moved their cattle up to the old mill and waited for the rain to end. " * 9


def licenses_of(make_docs, *texts):
    got = {r["doc_id"]: r["licenses"] for r in scan(make_docs(list(enumerate(texts)))).collect()}
    return [got[i] for i in range(len(texts))]


def test_wordings_inside_long_lines(make_docs):
    """What stands before or behind on the line doesn't matter, whatever its length."""
    for name, text in TEMPLATES:
        assert [c[0] for c in confirm(text)] == [name]
    short = [(n, t) for n, t in TEMPLATES if len(t) < 100]
    for chars in (0, 50, 100, 200, 400, 1000):
        assert licenses_of(make_docs, *(f"{PROSE[:chars]} {t} {PROSE[:chars]}" for _, t in short)) == [n for n, _ in short]


def test_wrapped_wordings(make_docs):
    """Licenses broken at the usual width, as comments too."""
    for width in (40, 70, 80):
        for lead in ("", " * ", "# "):
            texts = [f"int x;\n\n{textwrap.fill(t, width, initial_indent=lead, subsequent_indent=lead)}\n\nint y;" for _, t in TEMPLATES]
            assert licenses_of(make_docs, *texts) == [n for n, _ in TEMPLATES]


def test_bsd_clauses_and_gpl_versions(make_docs):
    clauses = lambda *own: BSD_USE + "\n\n" + "\n".join(f"{k}. {textwrap.fill(c, 70)}" for k, c in enumerate(own, 1)) + "\n\nTHIS SOFTWARE IS PROVIDED AS IS"
    first, second = BSD_KEEP.split(". ", 1)
    names = BSD_NAMES.replace("copyright holder", "Apache Club of MIT")
    notice = next(t for n, t in TEMPLATES if n == "GPL-2.0" and "later" in t)
    texts = [clauses(first + ".", second), clauses(first + ".", second, names), clauses(first + ".", second, BSD_ADVERTISING, names), BSD_USE,
             textwrap.fill(notice, 72), textwrap.fill(notice.replace("General", "Lesser General"), 72), textwrap.fill(notice.replace("General", "Affero General"), 72)]
    assert licenses_of(make_docs, *texts) == ["BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause", "BSD", "GPL-2.0", "", ""]


def test_letters_that_grow_in_lower_case(make_docs):
    text = "İstanbul'da yazıldı.\nReleased under the MIT License.\nLicensed under the Apache License, Version 2.0."
    assert licenses_of(make_docs, text) == ["Apache-2.0,MIT"]
    assert [text[a:b] for a, b in blocks(text)] == [text.split("\n", 1)[1]]
