import re

import pytest

from activlake.llm.decontamination import contamination, decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items, window=10):
    """Hit word ranges (merged) and items by comparing every run of words."""
    w, hit, named = words(text), set(), set()
    for item, given in items:
        v = words(given)
        n = min(window, len(v))
        runs = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if n else set()
        for i in range(len(w) - n + 1):
            if n and tuple(w[i : i + n]) in runs:
                hit.update(range(i, i + n))
                if item is not None:
                    named.add(str(item))
    return len(w), hit, sorted(named)


ITEMS = [
    (1, "The quick brown fox jumps over the lazy dog and then it sleeps all day long"),
    (2, "the of and"),
    (3, "Solo"),
    (4, "two words"),
    (10, "the the the the the the the the the the the the"),
    (11, None),
    (12, " ... "),
    (1, "another text of item one that has more than ten words in it"),
    (None, "an item without any id that is long enough for its own window"),
]
DOCS = [
    "He said: THE QUICK brown-fox jumps over the lazy dog, and then it sleeps all day!",
    "quick brown fox jumps over the lazy dog and then it sleeps",
    "quick brown fox jumps over the lazy cat and then it sleeps",
    "the of and the of and solo two words",
    "the " * 30,
    "the quick brown fox jumps over the lazy dog and",
    None,
    "",
    "an item without any id that is long enough for its own window",
    "Àé ñ solo " + "filler " * 50_000 + "two words",
    "another text of item one that has more than ten words in it another text of item one that has "
    "more than ten words in it",
]


def frames(spark):
    docs = [(i, t, 7, "w") for i, t in enumerate(DOCS)] + [(None, "solo", 7, "w"), (3, DOCS[3], 7, "w")]
    docs.append((3, "clean", 7, "w"))
    return (
        spark.createDataFrame(docs, "doc_id long, text string, n_words int, bad_id string"),
        spark.createDataFrame([(*i, "z") for i in ITEMS], "item_id long, text string, items string"),
        docs,
    )


def described(rows):
    return sorted(
        (str(r.doc_id), r.n_words, [(s.start, s.end) for s in r.spans], r.items) for r in rows
    )


def ranges(hit):
    out = []
    for i in sorted(hit):
        if out and out[-1][1] == i:
            out[-1][1] = i + 1
        else:
            out.append([i, i + 1])
    return [tuple(x) for x in out]


@pytest.mark.parametrize("block", [500_000, 7])
def test_against_all_runs(spark, block):
    documents, benchmark, docs = frames(spark)
    got = contamination(documents, benchmark, block=block).collect()
    want = []
    for i, t, *_ in docs:
        n, hit, named = brute(t, ITEMS)
        want.append((str(i), n, ranges(hit), named))
    assert described(got) == sorted(want)


def test_filter_keeps_clean_rows(spark):
    documents, benchmark, docs = frames(spark)
    kept = decontaminate(documents, benchmark)
    assert kept.columns == documents.columns
    want = sorted((str(i), t or "") for i, t, *_ in docs if not brute(t, ITEMS)[1])
    assert sorted((str(r.doc_id), r.text or "") for r in kept.collect()) == want


def test_empty_tables(spark):
    documents, benchmark, docs = frames(spark)
    assert contamination(documents.limit(0), benchmark).count() == 0
    clean = contamination(documents, benchmark.limit(0)).collect()
    assert len(clean) == len(docs) and all(r.spans == r.items == [] for r in clean)
    assert decontaminate(documents, benchmark.limit(0)).count() == len(docs)
