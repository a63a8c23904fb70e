import random

import pytest
import xxhash
from pyspark.sql import functions as F

from activlake.llm.components import components
from activlake.llm.simhash import (
    _signed,
    deduplicate,
    fingerprint,
    links,
    near_duplicates,
    ring_masks,
)

FULL = (1 << 64) - 1


def groups(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def off(a, b):
    return ((a ^ b) & FULL).bit_count()


def test_fingerprint_against_bit_counts():
    text = "The quick BROWN fox\njumps over É the lazy dog " * 5
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text).split()
    hashes = [
        xxhash.xxh64(" ".join(words[i : i + 3]).encode(), seed=42).intdigest()
        for i in range(len(words) - 2)
    ]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert fingerprint(text) & FULL == want
    assert fingerprint(None) == fingerprint(" \n") == 0
    assert fingerprint("A b") & FULL == xxhash.xxh64(b"a b", seed=42).intdigest()
    assert fingerprint("word " * 200_000) == fingerprint("word word word")


@pytest.mark.parametrize("distance,segments", [(1, 4), (2, 7), (2, 5), (3, 8)])
def test_every_close_pair_has_a_chain(distance, segments):
    rng = random.Random(distance)
    chains = ring_masks(segments)
    for _ in range(300):
        x = sum(1 << b for b in rng.sample(range(64), distance))
        assert any(
            all((x & m & FULL).bit_count() * segments <= (n + 1) * distance for n, m in enumerate(c))
            for c in chains
        )


@pytest.mark.parametrize("distance,segments", [(1, 4), (2, 7), (3, 8)])
@pytest.mark.parametrize("dense", [0, 4, 1000])
def test_links_connect_as_all_pairs_do(spark, distance, segments, dense):
    rng = random.Random(dense + distance)
    values = {0, FULL}
    for _ in range(12):
        base = rng.getrandbits(64)
        values |= {base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for _ in range(12)}
    values = sorted(_signed(v) for v in values)
    df = spark.createDataFrame([(v,) for v in values], "fp long")
    got = [(r.a, r.b) for r in links(df, distance, segments, dense).collect()]
    close = [(a, b) for i, a in enumerate(values) for b in values[:i] if off(a, b) <= distance]
    assert groups(values, got) == groups(values, close)
    assert dense or all(off(a, b) <= 2 * distance for a, b in got)


def test_components_of_chains_and_stars(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 200)] + [(1000, 1000 + i) for i in range(1, 100)]
    edges += [(i, i) for i in range(3)] + [(5, 4), (5, 4)]
    rng.shuffle(edges)
    df = spark.createDataFrame(edges, "a long, b long")
    want = groups({x for e in edges for x in e}, edges)
    for block in (200_000, 40, 7):  # one block, and blocks that need rounds of joins
        assert {r.node: r.root for r in components(df, block=block).collect()} == want
    assert components(df.limit(0)).count() == 0


def corpus(spark):
    rng = random.Random(3)
    words = [f"word{i}" for i in range(400)]
    rows = []
    for g in range(15):
        base = [rng.choice(words) for _ in range(250)]
        for _ in range(6):
            copy = list(base)
            copy[rng.randrange(250)] = "changed"
            rows.append(" ".join(copy if rng.random() < 0.7 else base))
    rows += ["", None, "  ", "tiny", "TINY"]
    return [(i * 7 % 1000, t, i, "x") for i, t in enumerate(rows)]


SCHEMA = "doc_id long, text string, fp long, kept_id string"


def test_near_duplicates_against_all_pairs(spark):
    rows = corpus(spark)
    df = spark.createDataFrame(rows, SCHEMA)
    prints = {i: fingerprint(t) for i, t, *_ in rows}
    close = [(a, b) for a in prints for b in prints if a < b and off(prints[a], prints[b]) <= 2]
    want = groups(prints, close)
    for dense in (2, 64):
        got = near_duplicates(df, dense=dense).collect()
        assert {r.doc_id: r.component_id for r in got} == want
    kept = deduplicate(df)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))
    assert kept.columns == df.columns


def test_nulls_repeats_and_empty_tables(spark):
    rows = [(None, "a b c d", 1, "x"), (None, "a b c d", 1, "x"), (None, "other words here", 1, "x")]
    rows += [(4, "a b c d", 1, "x"), (4, "a b c d", 1, "x"), (9, "a b c d", 1, "x"), (5, None, 1, "y")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = near_duplicates(df)
    assert got.count() == len(rows)
    ids = {(r.doc_id, r.component_id) for r in got.collect()}
    assert ids == {(None, 4), (None, None), (4, 4), (9, 4), (5, 5)}
    kept = sorted((str(r.doc_id), r.text) for r in deduplicate(df).collect())
    assert kept == [("4", "a b c d"), ("5", None), ("None", "a b c d"), ("None", "other words here")]
    assert near_duplicates(df.limit(0)).count() == deduplicate(df.limit(0)).count() == 0
    assert got.where(F.col("fp") == 0).count() == 1


def test_rows_of_one_id_with_different_texts(spark):
    texts = ["one two three four", "five six seven eight", "nine ten eleven twelve", "alpha beta gamma delta"]
    rows = [(1, texts[0], 1, "x"), (2, texts[1], 1, "x"), (1, texts[2], 1, "x"), (3, texts[0], 1, "x"),
            (1, texts[3], 1, "x"), (4, texts[1], 1, "y"), (1, texts[3], 1, "x")]
    kept = deduplicate(spark.createDataFrame(rows, SCHEMA))
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted(
        [(1, texts[0]), (2, texts[1]), (1, texts[2]), (1, texts[3])]
    )


def test_an_id_on_a_third_of_the_rows(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choices("abcdefghijklmnop", k=30)) for _ in range(40)]
    rows = [(7 if i % 3 == 0 else 100 + i, texts[i % 40], i, "x") for i in range(240)]
    kept = deduplicate(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    prints = {t: fingerprint(t) for t in texts}
    linked = [(a, b) for a in texts for b in texts if a < b and off(prints[a], prints[b]) <= 2]
    group = groups(texts, linked)
    assert sorted(group[r.text] for r in kept) == sorted(set(group.values()))
    assert {r.doc_id for r in kept} == {min(r[0] for r in rows if group[r[1]] == g) for g in set(group.values())}


def test_columns_that_have_no_order_stay(spark):
    schema = "doc_id long, text string, h1 map<string,int>, kept_id array<int>"
    df = spark.createDataFrame([(1, "a b c", {"x": 1}, [1]), (2, "a b c", {"x": 1}, None)] * 2, schema)
    assert [(r.doc_id, r.h1, r.kept_id) for r in deduplicate(df).collect()] == [(1, {"x": 1}, [1])]
