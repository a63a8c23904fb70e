import math
import time
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from activlake.llm import lm_scoring
from activlake.llm.common import RELEASE, shuffles_released
from activlake.llm.lm_scoring import (
    ORDER,
    Held,
    coded,
    often_used,
    score_in_context,
    tokens,
    windows,
)


class Brute:
    """The model by dictionaries: method D escapes with symbol exclusion."""

    def __init__(self, texts, order=ORDER):
        self.order, self.words = order, Counter()
        self.seen = defaultdict(Counter)
        for t in texts:
            self.words.update(tokens(t))
            b = coded(tokens(t))
            for i in range(1, len(b)):
                for j in range(max(0, i - order), i + 1):
                    self.seen[b[j:i]][b[i]] += 1

    def symbol(self, context, x):
        lp, excluded = 0.0, set()
        for j in range(len(context) + 1):
            counts = self.seen.get(context[j:])
            if not counts:
                continue
            left = {s: n for s, n in counts.items() if s not in excluded}
            if left:
                total = 2 * sum(left.values())
                if x in left:
                    return lp + math.log10((2 * left[x] - 1) / total)
                lp += math.log10(len(left) / total)
            excluded |= counts.keys()
        return lp - math.log10(256 - len(excluded))

    def row(self, text):
        n, v = sum(self.words.values()), len(self.words)
        own, b = tokens(text), coded(tokens(text))
        base = sum(math.log10((self.words[w] + 1) / (n + v + 1)) for w in own)
        lp = sum(self.symbol(b[max(0, i - self.order) : i], b[i]) for i in range(1, len(b)))
        return len(own), sum(w in self.words for w in own), n, base, lp


TRAIN = ["the cat sat on the mat", "The dog\tsat\n\non a log", "", None, "é café naïve 🙂 the", "a" * 3000]
OTHER = ["the cat barks", "zebra Ünder the\x0bmats", "", "🙂  x", "logs logs logs", "the " * 5000]


def frame(spark):
    rows = [(i, t, True, 1) for i, t in enumerate(TRAIN)]
    rows += [(100 + i, t, False, 1) for i, t in enumerate(OTHER)]
    rows += [(100, OTHER[0], False, 1), (None, OTHER[1], False, 1), (2**60 + 1, OTHER[2], False, 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, learn boolean, n_tokens int"), rows


def test_symbols_of_a_context_sum_to_one():
    model = Brute(TRAIN)
    for context in (b" ", b" t", b" th", b" zz", b"at", b""):
        assert sum(10 ** model.symbol(context, x) for x in range(256)) == pytest.approx(1)


@pytest.mark.parametrize(
    "order,head,window_head", [(ORDER, 400_000, 2_000_000), (ORDER, 3, 20), (2, 0, 0), (0, 5, 5)]
)
def test_contexts_across_tokens_against_dictionaries(spark, order, head, window_head):
    df, rows = frame(spark)
    model = Brute(TRAIN, order)
    got = score_in_context(df, F.col("learn"), order=order, head=head, window_head=window_head)
    key = lambda r: (str(r[0]), r[1])
    want = sorted(((i, *model.row(t)) for i, t, *_ in rows), key=key)
    have = sorted(
        (
            (r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score)
            for r in got.collect()
        ),
        key=key,
    )
    assert [w[:4] for w in want] == [h[:4] for h in have]
    for w, h in zip(want, have, strict=True):
        assert h[4:] == pytest.approx(w[4:], rel=1e-9)


def test_order_of_words_counts(spark):
    rows = [(i, "the cat sat on the mat", True) for i in range(5)]
    rows += [(10, "the cat sat on the mat", False), (11, "mat the on sat cat the", False)]
    df = spark.createDataFrame(rows, "doc_id long, text string, learn boolean")
    got = {r.doc_id: r.score for r in score_in_context(df, F.col("learn")).collect()}
    assert got[10] > got[11] + 1


@pytest.mark.parametrize("most", [1, 50, 1 << 21])
def test_counts_merged_in_the_tasks(spark, monkeypatch, most):
    from activlake.llm import lm_scoring

    df, rows = frame(spark)
    monkeypatch.setattr(lm_scoring, "MOST_WINDOWS", most)
    monkeypatch.setattr(lm_scoring, "SLAB", 64)
    got = lm_scoring.window_counts(df.coalesce(1), "text", F.col("learn"), 6, 40_000).collect()
    want = defaultdict(lambda: [0, 0])
    for _, text, learn, *_ in rows:
        for _, key in windows([coded(tokens(text))], 6):
            for g in key.tolist():
                want[g][0] += learn
                want[g][1] += 1
    assert {r.g: [r.c, r.n] for r in got} == dict(want)


def test_windows_in_slices(monkeypatch):
    texts = [coded(tokens(t)) for t in TRAIN + OTHER]
    want = [
        (k, b[max(0, i - 6) : i + 1]) for k, b in enumerate(texts) for i in range(1, len(b))
    ]
    for size in (1, 5, 7, 1000, 1 << 20):
        monkeypatch.setattr("activlake.llm.lm_scoring.SLICE", size)
        got = []
        for text, key in windows(texts if size > 7 else texts[:6], 6):
            for k, g in zip(text.tolist(), key.tolist(), strict=True):
                got.append((k, g.to_bytes(8, "big")[8 - (g >> 56) :]))
        assert got == want[: len(got)] and len(got) == sum(
            len(b) - 1 for b in (texts if size > 7 else texts[:6])
        )


def test_in_context_without_training_rows_and_without_rows(spark):
    df, _ = frame(spark)
    got = score_in_context(df, F.lit(False)).where("doc_id = 102").collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got] == [(1, 0, 0, 0.0)]
    assert got[0].score == pytest.approx(-math.log10(256))
    assert score_in_context(df.limit(0), F.lit(True)).count() == 0


def test_long_tokens_do_not_travel_with_the_tasks(spark):
    rows = [(b"a" * 64, 9), (b"b" * 65, 9), (b"c", 1)]
    df = spark.createDataFrame(rows, "word binary, n long")
    got = df.where(often_used(10, 60)).collect()
    assert [bytes(r.word) for r in got] == [b"a" * 64]


def shuffle_files(spark):
    held = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    names = [held.apply(i).getName() for i in range(held.size())]
    return {x for x in names if x.startswith("shuffle_")}


def test_jobs_leave_no_shuffle_files(spark):
    df, rows = frame(spark)
    before = shuffle_files(spark)
    got = score_in_context(df, F.col("learn"))
    end = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < end:  # deleted in the background
        time.sleep(0.1)
    assert not left
    assert spark.conf.get(RELEASE, None) is None
    # The frame that the caller gets keeps its shuffles: it may run more than once.
    assert len(got.collect()) == len(rows)
    assert shuffle_files(spark) - before
    assert len(got.collect()) == len(rows)


@pytest.mark.parametrize("own", [None, "true", "false"])
def test_the_setting_of_the_session_is_put_back(spark, own):
    if own:
        spark.conf.set(RELEASE, own)
    try:
        with pytest.raises(ValueError, match="inside"), shuffles_released(spark):
            assert spark.conf.get(RELEASE) == "true"
            raise ValueError("inside")
        assert spark.conf.get(RELEASE, None) == own
    finally:
        spark.conf.unset(RELEASE)


def test_a_table_of_windows_takes_little_more_than_itself():
    keys = np.arange(1, 1_000_001, dtype=np.uint64) * np.uint64(2**40 + 12_345)
    values = np.arange(1_000_000) / 7
    tracemalloc.start()
    try:
        held = Held(keys, values)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 1.4 * (held.keys.nbytes + held.values.nbytes)
    found, absent = held.find(np.concatenate([keys, keys + np.uint64(1)]))
    assert (found[:1_000_000] == values).all() and not absent[:1_000_000].any()
    assert absent[1_000_000:].all() and not found[1_000_000:].any()


def test_the_most_frequent_tokens_travel_with_the_tasks(spark):
    # One token makes up nearly all of the text: of the others, none is a twentieth of it.
    rows = [(b"the", 100_000), (b"x" * 65, 5_000)] + [(b"w%d" % i, 1000 - 9 * i) for i in range(100)]
    df = spark.createDataFrame(rows, "word binary, n long")
    total = sum(n for _, n in rows)
    got = {bytes(r.word) for r in df.where(lm_scoring.frequent_tokens(df, 20, total)).collect()}
    assert b"the" in got and b"x" * 65 not in got
    assert 10 < len(got) <= 20
    assert got == {w for w, _ in sorted((r for r in rows if len(r[0]) < 65), key=lambda r: -r[1])[: len(got)]}
    # Of equal counts all or none travel by number, and still those that make up their share.
    even = spark.createDataFrame([(b"%d" % i, 2) for i in range(20)], "word binary, n long")
    assert even.where(lm_scoring.frequent_tokens(even, 19, 40)).count() == 0
    assert even.where(lm_scoring.frequent_tokens(even, 20, 40)).count() == 20


ODD = [" \t a\x0b\x0cB\r\nb  ", "", None, "  ", "\x1c\x85\xa0\u2003É é", "Z[@`{z", "🙂 " * 9, "\x00 \x00"]


def test_words_of_many_texts_at_once_are_those_of_each():
    texts = TRAIN + OTHER + ODD
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
    lists, words, at = lm_scoring._words(batch.slice(1).column("text"))
    got = [[] for _ in texts[1:]]
    for i, word in zip(at.tolist(), words.to_pylist(), strict=True):
        got[i].append(word.encode())
    assert [[*words, b"\n"] for words in got] == [tokens(t) for t in texts[1:]]
    assert [[w.encode() for w in x if w] for x in lists.to_pylist()] == got


@pytest.mark.parametrize("most,part", [(1, 1), (5, 20), (500_000, 1 << 23)])
def test_tokens_are_counted_by_parts(spark, monkeypatch, most, part):
    df, rows = frame(spark)
    rows += [(200 + i, t, i % 3 == 0, 1) for i, t in enumerate(ODD)]
    rows += [(300, "learned or not is not known", None, 1)]
    monkeypatch.setattr(lm_scoring, "MOST_COUNTED", most)
    monkeypatch.setattr(lm_scoring, "PART", part)
    df = spark.createDataFrame(rows, df.schema).coalesce(1)
    got = lm_scoring.vocabulary(df, "text", F.col("learn")).collect()
    want = defaultdict(lambda: [0, 0])
    for _, text, learn, *_ in rows:
        for word in tokens(text):
            want[word][0] += bool(learn)
            want[word][1] += 1
    assert {bytes(r.word): [r.c, r.n] for r in got} == dict(want)


def test_texts_are_scored_by_parts(spark, monkeypatch):
    df, rows = frame(spark)
    monkeypatch.setattr(lm_scoring, "PART", 30)
    monkeypatch.setattr(lm_scoring, "SLICE", 64)
    model = Brute(TRAIN)
    got = score_in_context(df.coalesce(1), F.col("learn"), head=2, window_head=10).collect()
    have = sorted((r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got)
    for w, h in zip(sorted(model.row(t) for _, t, *_ in rows), have, strict=True):
        assert h == pytest.approx(w, rel=1e-9)
