import random
import re

import pytest

from activlake.llm.pii import LABELERS, estimate, find, fit, candidates, redact

KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(x) <= 255 for x in value.split("."))
    if kind == "phone":
        return 10 <= len(digits) <= 15
    if kind == "card":
        luhn = sum(
            int(d) if i % 2 == 0 else sum(map(int, str(2 * int(d))))
            for i, d in enumerate(reversed(digits))
        )
        return 14 <= len(digits) <= 19 and luhn % 10 == 0
    return True


def brute(text):
    found = [
        (m.start(), i, kind, m.end())
        for i, (kind, pattern) in enumerate(KINDS.items())
        for m in re.finditer(pattern, text or "")
        if valid(kind, m.group())
    ]
    return [(k, s, e) for s, _, k, e in sorted(found)]


TEXTS = [
    None,
    "",
    "nothing here",
    "a@b.c+d@e.f.g, x@@y.z @a.b c@d c@d. e@f..g 🙂a.b@c-d.e🙂h@i.j",
    "1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.255 1.2.3 99999999999999999999999.1.1.1 1.1.1.000000000255",
    "4111 1111 1111 1111 and 4111-1111-1111-1112 or 4111111111111111 4111  1111",
    "+1 (017) 555-7713 +12 +44.20.7946.0958 ++49 30 1234567 +1234567890123456 +1-( 2",
    "card 5500 0000 0000 0004. 6011000990139424-1 +5500000000000004",
    'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" mail me@x.org 🙂 ssn: 123-45-6789',
    "1" * 5000 + " " + "a" * 20000 + "@b.c " + "1.2" * 3000 + " x@" + "y." * 3000 + "z",
]


def spans(rows):
    return {r.doc_id: [tuple(s) for s in r.base] for r in rows}


def test_base_kinds_against_plain_patterns(spark):
    df = spark.createDataFrame([(i, t, 3) for i, t in enumerate(TEXTS)], "doc_id long, text string, base int")
    assert spans(find(df).collect()) == {i: brute(t) for i, t in enumerate(TEXTS)}


def test_random_texts_against_plain_patterns(spark):
    rng = random.Random(5)
    parts = ["a", "B9", ".", "@", "-", "+", " ", "(", ")", "1", "25", "4111111111111111", "\n", "é", "🙂"]
    texts = ["".join(rng.choice(parts) for _ in range(60)) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert spans(find(df).collect()) == {i: brute(t) for i, t in enumerate(texts)}


def secrets(spark):
    rng = random.Random(2)

    def key():
        return "".join(rng.choice("0123456789abcdef") for _ in range(40))

    rows = [(i, f'some words token = "{key()}" more words') for i in range(40)]
    rows += [(100 + i, f"built from commit {key()[:20]}0000 as version0000000000{i:02d}") for i in range(20)]
    rows += [(200, f'password: "{key()}"'), (201, f'TOKEN = "{key().upper()}"!!'), (202, None)]
    rows += [(203, "order 4111111111111112 failed its check")]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_model_adds_secrets_and_leaves_lookalikes(spark):
    got = {r.doc_id: [s.kind for s in r.spans] for r in find(secrets(spark)).collect()}
    assert all(got[i] == ["secret"] for i in (*range(40), 200, 201))
    assert all(got[i] == [] for i in (*range(100, 120), 202, 203))


def test_estimation_finds_the_reliable_labelers(spark):
    rng = random.Random(9)
    true, patterns = {0: 0.9, 1: 0.8, 2: 0.55}, {}
    for _ in range(20_000):
        label = int(rng.random() < 0.3)
        votes = tuple(label if rng.random() < p else 1 - label for p in true.values())
        patterns[votes] = patterns.get(votes, 0) + 1
    got = estimate(patterns)
    assert got.share == pytest.approx(0.3, abs=0.12)
    right = [v[1][2] for v in got.votes]
    assert right[0] > right[1] > right[2]
    assert got.posterior((1, 1, 1)) > 0.8 > 0.2 > got.posterior((0, 0, 0))


def test_estimation_equals_a_row_wise_run(spark):
    """Counting by pattern changes nothing against one row for each candidate."""
    found = candidates(secrets(spark))
    reliability, _ = fit(found)
    counted = {}
    for r in found.collect():
        for c in r.candidates:
            counted[tuple(c.votes)] = counted.get(tuple(c.votes), 0) + 1
    again = estimate(counted)
    assert reliability.share == pytest.approx(again.share)
    for (a, b), (c, d) in zip(reliability.votes, again.votes, strict=True):
        assert (*a, *b) == pytest.approx((*c, *d))
    assert len(reliability.votes) == len(LABELERS)


def test_redaction_keeps_rows_and_columns(spark):
    rows = [(1, "mail a@b.c now", 14, "x"), (None, None, 0, "y"), (3, "clean", 5, None), (3, "clean", 5, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, own_0 int, base string")
    got = redact(df)
    assert got.columns == df.columns
    want = sorted([(1, "mail <EMAIL> now", 14, "x"), *rows[1:]], key=str)
    assert sorted(map(tuple, got.collect()), key=str) == want
    # The digits are a phone number and, one character later, a card number.
    overlapping = spark.createDataFrame([(1, "+378282246310005 end")], "doc_id long, text string")
    assert redact(overlapping).first().text == "<PHONE> end"


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert find(df).count() == redact(df).count() == 0


def test_failed_numbers_are_candidates_whatever_else_the_text_holds(spark):
    texts = ["phone: 5551234567", "phone: 5551234567 and 12345678901234", "n 1234567890123", "n 123456789", "1 2 3 4 5 6"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: [(c.kind, c.start, c.end) for c in r.candidates] for r in candidates(df).collect()}
    assert got[0] == [("failed", 7, 17)] and got[0][0] in got[1]
    assert got[2] == [("failed", 2, 15)] and got[3] == got[4] == []
