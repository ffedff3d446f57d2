"""License scans by conditional compression.

Around the words that speak of licensing, over line ends, the text is cut into
overlapping windows, for every template as long as its wording may run. Each window
is compressed with the template as a raw zstandard dictionary and without one. What
the template saves there, as a share of what it saves on its own wording, ranks all
pairs of window and template; a window that holds the wording is near 1, any other
is left with the bytes that all English shares. The pairs from SAVED on are
confirmed in the order of their rank by the exact words in which window and template
differ: a template is accepted only if a place of the window holds nearly all of
its words in order, and all of its telling ones (names, numbers). Pairs below SAVED
are not looked at; the tests compare with looking at all of them.

A wording counts wherever it stands: "not released under the MIT License" names
that license as well.

Texts are judged on their own where they are read; the templates are a fixed
short list, so the work is one pass without a shuffle.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from sparkrec.llm.common import pick

#: The parts of the BSD licenses; the first alone doesn't tell which one it is.
BSD_USE = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
BSD_KEEP = ("Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
            "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
            "in the documentation and/or other materials provided with the distribution.")
BSD_ADVERTISING = ("All advertising materials mentioning features or use of this software must display the following acknowledgement: "
                   "This product includes software developed by the organization.")
BSD_NAMES = ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
             "derived from this software without specific prior written permission.")

#: Wordings of licenses, by SPDX id (BSD: which one is open); several per license where forms differ much.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
                   "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD", BSD_USE),
    ("BSD-2-Clause", f"{BSD_USE} {BSD_KEEP}"),
    ("BSD-3-Clause", f"{BSD_USE} {BSD_KEEP} {BSD_NAMES}"),
    ("BSD-4-Clause", f"{BSD_USE} {BSD_KEEP} {BSD_ADVERTISING} {BSD_NAMES}"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
                "the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
                "the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
            '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
            "publish, distribute, sublicense, and/or sell copies of the Software"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("all-rights-reserved", "All rights reserved."),
)

#: Every template holds one of these; a block is a run of lines that do.
CUES = re.compile(r"licen[cs]|copyright|rights reserved|permission is hereby|redistribution|free software|general public|apache\.org|sublicense", re.IGNORECASE)
#: Names, versions and clause marks: a template that holds any isn't confirmed if one lacks or is added.
TELLING = re.compile(r"\d|^(affero|apache|by|cc|gnu|lesser|library|mit|mozilla|nc|reserved|sa)$")
#: Words of the clauses that tell the BSD licenses apart; only their lack counts.
CLAUSES = frozenset(("advertising", "endorse"))
WORDS = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*", re.IGNORECASE)
#: The share of a template's words that a place must hold in order.
COVERED = 0.8
#: The words of every template, and where each stands.
WORDS_OF = [WORDS.findall(t.lower()) for _, t in TEMPLATES]
PLACES_OF = [{w: [i for i, x in enumerate(own) if x == w] for w in own} for own in WORDS_OF]
#: Words of a step: a wording of a template with up to so many, and what may stand between, runs over two.
STEPS_OF = [next(c for c in (8, 16, 32, 64, 128, 256) if c >= len(w)) for w in WORDS_OF]
#: Compression level for the ranking; lower ones miss matches in short windows.
LEVEL = 13
#: The least share of its own saving that a template must save in a window. Of 2,351 wordings
#: confirmed among 3,000 that were changed and set into prose, none saved less (6 saved less than 0.2).
SAVED = 0.02


@lru_cache(maxsize=1)
def compressors() -> tuple:
    """The plain compressor, and one with each template's words as raw dictionary."""
    import zstandard as zstd
    plain = zstd.ZstdCompressor(level=LEVEL, write_content_size=False, write_checksum=False)
    primed = []
    for own in WORDS_OF:
        words = zstd.ZstdCompressionDict(" ".join(own).encode(), dict_type=zstd.DICT_TYPE_RAWCONTENT)
        words.precompute_compress(level=LEVEL)
        primed.append(zstd.ZstdCompressor(level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False, dict_data=words))
    return plain, primed


@lru_cache(maxsize=1)
def own_savings() -> list[int]:
    """Bytes that each template saves on its own wording."""
    plain, primed = compressors()
    raw = [" ".join(own).encode() for own in WORDS_OF]
    return [len(plain.compress(r)) - len(c.compress(r)) for r, c in zip(raw, primed)]


def blocks(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of the runs of lines with a cue."""
    if not CUES.search(text):
        return
    begin, at = None, 0
    for line in text.split("\n"):
        if CUES.search(line):
            begin = at if begin is None else begin
            end = at + len(line)
        elif begin is not None:
            yield begin, end
            begin = None
        at += len(line) + 1
    if begin is not None:
        yield begin, end


def windows(cues: list[int], n_words: int, step: int) -> list[tuple[int, int]]:
    """(begin, end) in words: three steps each, at every step from which a wording of up
    to two steps can begin that holds one of the words `cues`."""
    first = sorted({k for cue in cues for k in range(max(0, cue // step - 2), cue // step + 1)})
    return [(k * step, min(n_words, (k + 3) * step)) for k in first]


def rank(words: list[str], cues: list[int], saved: float = SAVED) -> list[tuple[float, int, int, int]]:
    """(share saved, template, begin, end) of the windows around the words `cues`, best first."""
    plain, primed = compressors()
    out = []
    for step in sorted(set(STEPS_OF)):
        own = [k for k, s in enumerate(STEPS_OF) if s == step]
        for a, b in windows(cues, len(words), step):
            raw = " ".join(words[a:b]).encode()
            size = len(plain.compress(raw))
            for k in own:
                share = (size - len(primed[k].compress(raw))) / own_savings()[k]
                if share >= saved:
                    out.append((-share, k, a, b))
    return [(-share, k, a, b) for share, k, a, b in sorted(out)]


def differences(block: str, template: str) -> tuple[float, list[str], list[str]]:
    """Share of the template's words that the block holds in order, the words that
    it lacks, and the words of the block between them that the template hasn't."""
    ours, theirs = WORDS.findall(block.lower()), WORDS.findall(template.lower())
    same = [m for m in SequenceMatcher(None, theirs, ours, autojunk=False).get_matching_blocks() if m.size]
    if not same:
        return 0.0, theirs, []
    held = {i for m in same for i in range(m.a, m.a + m.size)}
    hit = {i for m in same for i in range(m.b, m.b + m.size)}
    inner = range(same[0].b, same[-1].b + same[-1].size)
    return len(held) / len(theirs), [w for i, w in enumerate(theirs) if i not in held], [ours[i] for i in inner if i not in hit]


def reduction(part: str, k: int) -> float:
    """How much smaller a text's words get by template `k` as dictionary."""
    plain, primed = compressors()
    raw = " ".join(WORDS.findall(part.lower())).encode()
    return 1 - len(primed[k].compress(raw)) / len(plain.compress(raw))


def places(words: list[str], k: int) -> list[tuple[int, int]]:
    """(begin, end) of the runs of `words` that hold the share COVERED of template
    `k`'s words, most of them and shortest first; up to half of the template's
    length and four words may stand between."""
    n, at = len(WORDS_OF[k]), PLACES_OF[k]
    pairs = sorted((j - i, i) for j, w in enumerate(words) if w in at for i in at[w])
    seen: Counter = Counter()
    found, hi = [], 0
    for lo, (first, i) in enumerate(pairs):
        while hi < len(pairs) and pairs[hi][0] <= first + n // 2 + 4:
            seen[pairs[hi][1]] += 1
            hi += 1
        if len(seen) >= COVERED * n:
            held: set[int] = set()
            for last, own in pairs[lo:hi]:
                held.add(own)
                if len(held) == len(seen):
                    break
            found.append((-len(seen), last - first, max(0, first), min(len(words), last + n)))
        seen[i] -= 1
        if not seen[i]:
            del seen[i]
    return [(a, b) for _, _, a, b in sorted(set(found))]


def confirm(text: str, saved: float = SAVED) -> list[tuple[str, float, int]]:
    """(license, reduction, differing words) of the templates confirmed in a text: in the
    order of their reductions at the place, the first for each license, and none whose
    words another license explains better at the same place."""
    cues = [m.start() for m in CUES.finditer(text)]
    if not cues:
        return []
    spans = [m.span() for m in WORDS.finditer(text)]
    starts = [a for a, _ in spans]
    words = [text[a:b].lower() for a, b in spans]
    found: list[tuple[float, int, int, int, int]] = []
    taken: dict[int, list[tuple[int, int]]] = {k: [] for k in range(len(TEMPLATES))}
    for _, k, lo, hi in rank(words, [max(0, bisect_right(starts, at) - 1) for at in cues], saved):
        template, theirs = TEMPLATES[k][1], WORDS_OF[k]
        held = set(words[lo:hi])
        if sum(w in held for w in theirs) < COVERED * len(theirs):
            continue
        named = any(TELLING.search(w) and w != "by" for w in theirs)
        for a, b in places(words[lo:hi], k):
            a, b = lo + a, lo + b
            if any(a < d and c < b for c, d in taken[k]):
                continue
            part = text[spans[a][0]:spans[b - 1][1]]
            covered, lacking, added = differences(part, template)
            if covered < COVERED or not CLAUSES.isdisjoint(lacking) or named and any(map(TELLING.search, lacking + added)):
                continue
            taken[k].append((a, b))
            found.append((-reduction(part, k), k, len(lacking) + len(added), a, b))
    out: dict[str, tuple[str, float, int]] = {}
    for less, k, n, a, b in sorted(found):
        name = TEMPLATES[k][0]
        if name not in out and not any(set(WORDS_OF[k]) < set(WORDS_OF[m]) and name != TEMPLATES[m][0] and a < d and c < b for _, m, _, c, d in found):
            out[name] = (name, -less, n)
    return list(out.values())


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_blocks, licenses, best_license, best_reduction, n_differences; one row per input row.

    ``licenses`` are the confirmed ids, sorted and joined by commas;
    ``best_license`` is the one with the largest size reduction at any place
    (first in the text among equal ones), null if none is confirmed; ``n_blocks``
    counts the runs of lines with a cue. Null texts count as empty; ids may be
    null or repeated.
    """
    texts = pick(docs, id_col, text_col)
    id_type = texts.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_blocks", "licenses", "best_license", "best_reduction", "n_differences"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.float64(), pa.int64()]

    def judge(text: str) -> tuple:
        own = list(blocks(text))
        found = confirm(text)
        best = max(found, key=lambda c: c[1], default=(None, None, None))
        return len(own), ",".join(sorted({c[0] for c in found})), *best

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = list(zip(*(judge(t.as_py()) for t in b.column(1)))) or [()] * 5
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))], names)

    return texts.mapInArrow(run, f"doc_id {id_type}, n_blocks long, licenses string, best_license string, best_reduction double, n_differences long")
