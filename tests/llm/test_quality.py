import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from activlake.llm.quality import BASE, MEASURES, POLICIES, RULES, ablations, ledger, mask, passes

WORD = re.compile("[^\x20\x09-\x0d]+")


def measured(text):
    text = text or ""
    w = WORD.findall(text)
    windows = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = set()
    for i in range(len(w) - 2):
        if windows[tuple(w[i : i + 3])] > 1:
            covered.update((i, i + 1, i + 2))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines),
            len(lines) - len(set(lines)), len(covered))


TEXTS = [
    None,
    "",
    " \t\n\x0b\f\r ",
    "one",
    "one two",
    "a b c a b c",
    "a a a a a",
    "x y z\nx y z\n\n  \nq <|> #",
    " lead and trail \n",
    "é\u00a0ü\u2003ß 🙂🙂 🙂🙂 🙂🙂 🙂🙂",
    "the cat sat " * 40,
    "WORD!! " * 60,
    " ".join(f"w{i}" for i in range(60)) + " " + " ".join(f"w{i}" for i in range(30)),
    " ".join(f"long{i % 977}" for i in range(20_000)),
]


def test_measurements_against_brute_force(spark):
    rows = [(i, t, 1, 0) for i, t in enumerate(TEXTS)]
    rows += [(None, "one two three", 1, 0), (3, "one", 1, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, w int, bits int")
    got = sorted(
        (tuple(r[m] for m in MEASURES[:6]) for r in ledger(df).collect())
    )
    assert got == sorted(measured(t) for _, t, *_ in rows)


def test_same_hash_of_different_windows_is_settled_by_the_words(spark, monkeypatch):
    from activlake.llm import quality

    seen = F.expr

    def colliding(sql):
        return seen(sql.replace("xxhash64(x, w[i + 1], w[i + 2])", "CAST(length(x) AS BIGINT)"))

    monkeypatch.setattr(quality.F, "expr", colliding)
    texts = ["a b c d e f g", "a b c a b c d", "p q r s p q r t", "a a a a", "aa b cc b aa b cc"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_repeat_words for r in quality.ledger(df).collect()}
    assert got == {i: measured(t)[5] for i, t in enumerate(texts)}


def test_bits_policies_and_kept_columns(spark):
    clean = " ".join(f"word{i}" for i in range(60))
    df = spark.createDataFrame(
        [(1, clean, "s"), (2, clean + " $$$$$$$", "s"), (3, "few", "s"), (4, None, None)],
        "doc_id long, text string, source string",
    )
    got = {r.doc_id: r for r in ledger(df, keep=("source",)).collect()}
    assert (got[1].failed_bits, got[1].source) == (0, "s")
    assert got[2].failed_bits == mask("symbols")
    assert got[3].failed_bits == got[4].failed_bits == mask("too_few_words")
    kept = {p: ledger(df).where(passes(p)).count() for p in POLICIES}
    assert kept == {"base": 2, "v1": 1, "v2": 1}
    assert ledger(df).where(passes(BASE)).count() == 2


def test_ablations_count_by_bits(spark):
    bits = [0, 0, mask("symbols"), mask("symbols", "capitals"), mask("too_few_words")]
    rows = spark.createDataFrame([(b,) for b in bits], "failed_bits long")
    got = {(r.policy, r.rule): r for r in ablations(rows).collect()}
    assert {r for p, r in got if p == "v2"} == {r.name for r in RULES}
    one = got["v1", "symbols"]
    assert (one.documents, one.kept, one.kept_without, one.removed_alone) == (5, 2, 3, 1)
    assert not got["v2", "letters"].ever_failed and got["v2", "capitals"].removed_alone == 0


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert ledger(df).count() == 0 and ablations(ledger(df)).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5])
def test_short_repeats(spark, n):
    df = spark.createDataFrame([(1, "a b c " * n)], "doc_id long, text string")
    assert ledger(df).first().n_repeat_words == measured("a b c " * n)[5]
