"""Repeated passages against all windows counted by brute force."""

import hashlib
import random
import re
from collections import Counter

import pytest
from conftest import plan_of

from activlake.llm.substrings import (
    RUN,
    SLAB,
    deduplicate,
    kept_texts,
    op12_substring_dedup,
    packed,
    repeated,
    repeats,
    super_kmers,
)

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(texts, k):
    """Words and kept words of every text."""
    split = [WORD.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i : i + k]) for w in split for i in range(len(w) - k + 1))
    out = []
    for w in split:
        gone = set()
        for i in range(len(w) - k + 1):
            if seen[tuple(w[i : i + k])] > 1:
                gone.update(range(i, i + k))
        out.append((w, [x for i, x in enumerate(w) if i not in gone]))
    return out


def passages(seed, n):
    """Texts that share passages, hold copies of themselves, or are copies."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["É", "🙂", "x" * 100, "x" * 100 + "y"]
    shared = [rng.choices(vocabulary, k=rng.randint(3, 25)) for _ in range(5)]
    texts = []
    for _ in range(n):
        parts = [
            rng.choice(shared) if rng.random() < 0.5 else rng.choices(vocabulary, k=rng.randint(0, 12))
            for _ in range(rng.randint(0, 6))
        ]
        texts.append(rng.choice([" ", "\n", "\t \x0b"]).join(w for p in parts for w in p))
    return texts + [rng.choice(texts) for _ in range(n // 3)] + ["a " * 50, "b a " * 30, "a " * 9]


@pytest.mark.parametrize("full,distinct", [(1, 1), (1, 4), (3, 100), (1_024, 1_024)])
@pytest.mark.parametrize("k,m", [(6, 2), (9, 9), (5, 1)])
def test_against_all_windows(spark, k, m, full, distinct):
    texts = passages(k, 60)
    rows = [(i, t, "row", 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string, t1 int").repartition(5)
    got = {
        r.doc_id: r
        for r in deduplicate(docs, window=k, minimiser=m, full=full, distinct=distinct).collect()
    }
    assert len(got) == len(texts)
    for i, (_, kept) in enumerate(brute(texts, k)):
        assert got[i].text == " ".join(kept), i
        assert (got[i].kept, got[i].t1) == ("row", 1)


def test_super_kmers_hold_every_window_once(monkeypatch):
    from activlake.llm import substrings

    monkeypatch.setattr(substrings, "SLAB", 50)
    monkeypatch.setattr(substrings, "RUN", 4)
    texts = [t.encode() for t in passages(7, 30)] + [None]
    k, m = 7, 3
    found, keys = Counter(), {}
    for part in super_kmers(texts, k, m):
        assert part.windows.max() <= 4
        for text, place, n, h in zip(part.text, part.place, part.windows, part.minimiser, strict=True):
            for j in range(place, place + n):
                window = tuple(packed(texts[text])[j : j + k])
                found[text, j] += 1
                assert keys.setdefault(window, h) == h  # equal windows, equal bucket
    want = {(i, j) for i, t in enumerate(texts) for j in range(len((t or b"").split()) - k + 1)}
    assert set(found) == want and set(found.values()) == {1}


def test_counting_in_a_bucket():
    assert repeated([(b"a b c d", 1), (b"x b c y", 1), (b"b c", 1)], 2) == [[1], [1], [0]]
    assert repeated([(b"a b c", 2), (b"q r", 1)], 2) == [[0, 1], []]
    assert repeated([(b"a a a a", 1)], 2) == [[0, 1, 2]]


def test_long_words_stay_apart():
    words = packed(("x" * 64 + " " + "x" * 65 + " " + "x" * 66 + " \x00").encode())
    assert words[0] == b"x" * 64 and words[1] != words[2] and words[3] == b"\x00"
    assert all(len(w) == 65 and w[:1] == b"\t" for w in words[1:3])


def test_a_long_text_and_one_word_again_and_again(spark):
    n = SLAB + 5 * RUN
    long = " ".join(f"w{i}" for i in range(n))
    tail = " ".join(f"w{i}" for i in range(n - 40, n))
    docs = spark.createDataFrame([(1, long), (2, "z " * n), (3, tail)], "doc_id long, text string")
    got = {r.n_words: r for r in kept_texts(docs).collect()}
    assert got[n].n_removed in (40, n) and got[40].n_removed == 40
    kept = [r for r in kept_texts(docs.where("doc_id <> 2")).collect() if r.n_words == n][0]
    assert kept.kept.decode() == " ".join(f"w{i}" for i in range(n - 40))


def test_nulls_repeats_and_empty_tables(spark):
    passage = " ".join(f"p{i}" for i in range(40))
    docs = spark.createDataFrame(
        [(None, passage, 1), (1, None, 1), (2, "", 1), (3, " \n", 1), (1, "x " + passage + " y", 1)]
        + [(7, "few words", 1)] * 2,
        "doc_id long, text string, ranges int",
    )
    got = sorted((str(r.doc_id), r.text) for r in deduplicate(docs).collect())
    assert got == [
        ("1", ""), ("1", "x y"), ("2", ""), ("3", ""), ("7", "few words"), ("7", "few words"),
        ("None", ""),
    ]
    assert deduplicate(docs).columns == docs.columns
    assert deduplicate(docs.limit(0)).collect() == []


def test_texts_are_not_shuffled_again(spark):
    docs = spark.createDataFrame([(i, "a b c " * i) for i in range(40)], "doc_id long, text string")
    plan = plan_of(repeats(docs, window=5, minimiser=2))
    joined = plan[plan.index("ShuffledHashJoin") :]
    # Both joins read the bucketed table as it is: only minimisers and ranges are exchanged.
    assert plan.count("Bucketed: true") >= 1, joined
    exchanges = [x for x in plan.split("\n\n") if x.lstrip().startswith("(") and ") Exchange" in x]
    assert not any("text" in x for x in exchanges)


def test_the_query_over_the_whole_table(spark, small):
    rows = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in op12_substring_dedup(spark, small).collect()}
    assert len(got) == len(rows)
    for row, (words, kept) in zip(rows, brute([r.text for r in rows], 35), strict=True):
        mine = got[row.doc_id]
        assert (mine.n_words, mine.n_removed) == (len(words), len(words) - len(kept))
        assert mine.kept_sha256 == hashlib.sha256(" ".join(kept).encode()).hexdigest()
