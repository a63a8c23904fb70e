"""The prefix trie against a dictionary of all prefixes."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from oracle_check import connect, difference

from activlake.llm import prefix_trie as trie
from activlake.llm.prefix_trie import Node, insert, op13_prefix_trie, rebuilt, turns

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(sequences):
    """Nodes of ``{conv_id: [(role, text), ...]}`` as sorted tuples."""
    members = defaultdict(list)
    for conv, turns_ in sequences.items():
        for d in range(len(turns_) + 1):
            members[tuple(turns_[:d])].append(conv)
    children = defaultdict(list)
    for prefix in members:
        if prefix:
            children[prefix[:-1]].append(prefix)
    leaves, saved = {}, {}
    for prefix in sorted(members, key=len, reverse=True):
        below = children[prefix]
        leaves[prefix] = sum(leaves[c] for c in below) or 1
        own = (len(members[prefix]) - 1) * len(prefix[-1][1].encode()) if prefix else 0
        saved[prefix] = own + sum(saved[c] for c in below)
    out = []
    for prefix, who in members.items():
        ends = ",".join(str(c) for c in sorted(who) if len(sequences[c]) == len(prefix))
        out.append((
            min(who), len(prefix), min(members[prefix[:-1]]) if prefix else None, len(who),
            len(children[prefix]), leaves[prefix], saved[prefix],
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def rebuild(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [x[1:] for x in sorted(v)] for c, v in own.items()}
    out = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = abs(c) // 5 * 5 * (1 if c >= 0 else -1)
        out[c] = own.get(base, [])[:h] + mine[h:]
    return out


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def conversations(seed, n):
    """Conversations that share beginnings, a third of them the same one."""
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        length = 5 if c % 3 == 0 else rng.randint(1, 7)
        for t in range(length):
            text = f"turn {t}" if c % 3 == 0 or rng.random() < 0.6 else rng.choice(["é", "", "ok", "🙂 x"])
            rows.append((c if c % 7 else -c, t, "user" if t % 2 == 0 else "assistant", text))
    return rows


@pytest.mark.parametrize("slab", [1, 3, 10, 65_536])
def test_against_all_prefixes(spark, slab):
    rows = conversations(1, 90)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(6)
    assert found(trie.prefix_trie(rebuilt(docs), slab)) == brute(rebuild(rows))


def test_plain_sequences_and_ends_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(trie, "BLOCK", 4)
    rows = [(c, t, "user", "same") for c in range(40) for t in range(3)]
    rows += [(100, t, "user", "same") for t in range(6)] + [(101, 0, "user", "other")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = defaultdict(list)
    for conv, _, role, text in rows:
        want[conv].append((role, text))
    assert found(trie.prefix_trie(turns(docs))) == brute(want)


def test_layouts_grow_and_paths_split():
    rng = random.Random(5)
    keys = {bytes(rng.randrange(256) for _ in range(rng.choice([2, 3]))) for _ in range(3000)}
    keys |= {b"", b"abcdefgh", b"abcdefgi", b"abcd", b"abcdefgh" * 9}
    root = Node(b"")
    for n, key in enumerate(rng.sample(sorted(keys), len(keys))):
        insert(root, key, (n,))
    seen, layouts, stack = {}, set(), [(root, b"")]
    while stack:
        node, above = stack.pop()
        whole = above + node.path
        layouts.add(node.layout)
        children = node.each()
        assert len(children) <= node.layout
        assert node is root or node.end is not None or len(children) > 1  # paths are compressed
        assert len({c.path[0] for c in children}) == len(children)
        if node.end is not None:
            seen[whole] = node.end
        stack += [(c, whole) for c in children]
    assert set(seen) == keys and layouts == {4, 16, 48, 256}
    narrow = Node(b"")
    for n in range(40):
        assert narrow.layout == (4 if n <= 4 else 16 if n <= 16 else 48)
        narrow.put(n * 5 % 256, Node(bytes([n * 5 % 256])))
        assert narrow.child(n * 5 % 256) is not None and narrow.child(255) is None


def test_a_long_conversation(spark):
    rows = [(c, t, "user", f"t{t}") for c in (1, 2) for t in range(400 if c == 1 else 390)]
    got = found(trie.prefix_trie(turns(spark.createDataFrame(rows, SCHEMA))))
    assert got == brute({c: [("user", f"t{t}") for t in range(n)] for c, n in ((1, 400), (2, 390))})


def test_nulls_ties_repeats_and_empty_tables(spark):
    rows = [
        (1, 0, "user", None), (1, None, "user", "first"), (1, 1, None, "x"), (1, 1, None, "x"),
        (2, 5, "b", "tie"), (2, 5, "a", "tie"), (None, 0, "user", "lost"), (5, 3, "user", ""),
        (2**62, 0, "user", "w" * 100_000), (-3, 0, "user", None),
    ]
    docs = spark.createDataFrame([(*r, 1, "n") for r in rows], SCHEMA + ", depth int, ends string")
    assert found(trie.prefix_trie(rebuilt(docs))) == brute(rebuild(rows))
    assert found(trie.prefix_trie(rebuilt(docs.limit(0)))) == []
    silent = spark.createDataFrame([(8, []), (9, [])], "conv_id long, ids array<binary>")
    assert found(trie.prefix_trie(silent)) == brute({8: [], 9: []})


def test_role_and_text_do_not_run_together(spark):
    rows = [(1, 0, "a", "bc"), (2, 0, "ab", "c")]
    assert len(found(trie.prefix_trie(turns(spark.createDataFrame(rows, SCHEMA))))) == 3


def test_sql_agrees_with_brute_force_on_odd_rows(spark, tmp_path, small):
    rows = conversations(2, 60) + [(7, None, None, None), (None, 1, "user", "x")]
    con = connect(small)
    docs = spark.createDataFrame(rows, SCHEMA)
    docs.write.parquet(str(tmp_path / "c.parquet"))
    con.execute(f"CREATE OR REPLACE VIEW conversations AS SELECT * FROM '{tmp_path}/c.parquet/*.parquet'")
    assert difference(con, "op13", trie.prefix_trie(rebuilt(docs)), trie.OP13_SQL) is None


def test_the_query_over_the_whole_table(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    assert found(op13_prefix_trie(spark, small)) == brute(rebuild(rows))
