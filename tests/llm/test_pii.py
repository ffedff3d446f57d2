"""op5: base spans against the plain patterns, and what the labelers add."""

import hashlib
import random
import re

from rows import ODD

from sparkrec.llm.pii import base_spans, fit, luhn, mask, personal_data, reliabilities

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    return [[m.span() for m in EMAIL.finditer(text)],
            [m.span() for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))],
            [m.span() for m in CARD.finditer(text) if 13 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))],
            [m.span() for m in PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15]]


def test_base_spans_equal_the_patterns(sf_docs):
    rng = random.Random(3)
    texts = [t for _, t in sf_docs[1]]
    texts += ["".join(rng.choice("a@.1+ -2(3%9é") for _ in range(rng.randint(0, 40))) for _ in range(20_000)]
    for t in texts:
        assert base_spans(t) == plain(t), t


def test_query_rows(make_docs, empty_docs):
    text = "é mail me@x.org, 10.0.0.256 1.2.3.4 or 4111 1111 1111 1111 and +1 (555) 010-9999"
    rows = [*ODD, (50, text), (50, text)]
    got = personal_data(make_docs(rows)).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    listed = ",".join(f"{k}:{a}:{b}" for k, own in zip(("email", "ip", "card", "phone"), plain(text)) for a, b in own)
    r = by[50]
    assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) == (1, 1, 1, 1)
    assert r["spans"].startswith(listed) and r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
    assert by[1]["spans"] == by[2]["spans"] == "" and by[1]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert personal_data(empty_docs).collect() == []


def corpus():
    rng = random.Random(7)
    hexes = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    rows, secrets = [], {}
    for i in range(300):
        t = f"Chapter {rng.randint(1, 99)} has {rng.randint(1, 999)} lines. Version 2.0, page {rng.randint(1, 400)}. "
        if i % 3 == 0:
            s = rng.choice([f"password={hexes(18)}", "AKIA" + "".join(rng.choice("ABCDEFGHIJ234567") for _ in range(16)), f'token = "{hexes(40)}"'])
            secrets[i] = s.split('"')[1] if '"' in s else s
            t += s
        rows.append((i, t + " and more."))
    return rows, secrets


def test_secrets_are_found_and_plain_numbers_left(make_docs):
    rows, secrets = corpus()
    texts = dict(rows)
    for r in personal_data(make_docs(rows)).collect():
        found = [texts[r["doc_id"]][int(a):int(b)] for k, a, b in (s.split(":") for s in r["spans"].split(",") if s) if k == "secret"]
        assert found == ([secrets[r["doc_id"]]] if r["doc_id"] in secrets else []), texts[r["doc_id"]]


def test_mask(make_docs):
    rows, secrets = corpus()
    out = {r["doc_id"]: r for r in mask(make_docs([*rows, (900, "to a@b.co now"), (901, None)])).collect()}
    assert out[900]["text"] == "to [EMAIL] now" and out[900]["n_chars"] == 14 and out[901]["text"] == ""
    for i, t in rows:
        assert out[i]["text"] == (t.replace(secrets[i], "[SECRET]") if i in secrets else t)


def test_em_recovers_labeler_reliability():
    """Votes drawn from three labelers of known quality and one of chance."""
    import numpy as np
    rng = np.random.default_rng(1)
    truth = rng.random(20_000) < 0.4
    good, fair, poor = [np.where(rng.random(20_000) < p, truth, ~truth) for p in (0.95, 0.85, 0.75)]
    noise = rng.random(20_000) < 0.5
    votes = ["".join("+" if x else "-" for x in v) for v in zip(good, fair, poor, noise)]
    patterns = sorted(set(votes))
    counts = np.array([votes.count(p) for p in patterns], float)
    _, table, _ = reliabilities(patterns, counts)
    right = [(table[j, 1, 2] + table[j, 0, 0]) / 2 for j in range(4)]
    assert right[0] > right[1] > right[2] > right[3] and abs(right[3] - 0.5) < 0.1


def test_training_without_candidates():
    assert not fit([]).accepts("0000000", "000nnn")


def test_values_and_groups_without_digits_in_every_token(make_docs):
    """Values of secret words, with or without a digit, and identifiers in groups."""
    rows, _ = corpus()
    more = {1000: ("My password: correcthorse is old.", "correcthorse"), 1001: ("Set api_key=AbCdEfGhIjKlMn here.", "api_key=AbCdEfGhIjKlMn"),
            1002: ("Pay to GB29 NWBK 6016 1331 9268 19 today.", "GB29 NWBK 6016 1331 9268 19"),
            1003: ("The iban: DE89 3704 0044 0532 0130 00, thanks.", "DE89 3704 0044 0532 0130 00"),
            1004: ("passport no C01X 00T4 7K is mine.", "C01X 00T4 7K"), 1005: ("It has no such thing, and the river is wide.", None)}
    texts = {i: t for i, (t, _) in more.items()}
    got = {r["doc_id"]: r["spans"] for r in personal_data(make_docs([*rows, *texts.items()])).collect() if r["doc_id"] in more}
    found = {i: [texts[i][int(a):int(b)] for k, a, b in (s.split(":") for s in spans.split(",") if s)] for i, spans in got.items()}
    assert found == {i: [want] if want else [] for i, (_, want) in more.items()}
