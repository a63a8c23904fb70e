"""Conversation prefix trie from adaptive radix trees.

A turn (role and text) becomes a fixed-width big-endian id: 16 bytes of the SHA-256 of both and 8 bytes
of the length of its text. A conversation is the string of its turns' ids, so two conversations share
a prefix of ``d`` turns if and only if their strings share ``d * 24`` bytes (up to collisions of 128
bits).

1. Equal strings become one row with its number of conversations, before anything is sorted, so that
   a conversation that a third of all rows repeat is one key. The ids of the conversations that end
   there are hashed apart: sorted over all tasks, packed into blocks of ids, and the blocks of a key
   fed to SHA-256 in order.
2. The strings are dealt out by range and sorted. A task puts slabs of ``SLAB`` neighbouring strings
   into an adaptive radix tree each: inner nodes hold 4, 16, 48 or 256 children and grow as needed,
   and a chain of single children is one compressed path. Walking it gives one trie node for each
   byte depth that is a multiple of the id's width, whether it lies at a node or within a path.
3. A trie node whose strings all lie within one slab is final. Only prefixes of a slab's first or last
   string can go on in a neighbouring slab: they stay open, with what their closed children amount
   to. Spark adds the open parts up by prefix and rolls them up to their ancestors. There are at most
   two open nodes for each turn of depth and slab.

Memory: a slab of strings (also bounded in bytes) and its tree, whatever the size of the table or of a subtree. A conversation
is one row of 24 bytes a turn.

Edge cases: null roles and texts are empty; a null turn comes first; equal turn numbers are ordered by
role and then by the hash of the text, and repeated rows are turns each; a row without conversation id
belongs to no conversation; conversations without turns end at the root; a trie without conversations
has no nodes, so an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from activlake.llm.common import by_name, stored, table

HASH, LENGTH = 16, 8
WIDTH = HASH + LENGTH
#: Strings of a tree and bytes of them, and conversation ids of a block.
SLAB, SLAB_BYTES, BLOCK = 65_536, 16 << 20, 4_096
NO_END = hashlib.sha256(b"").hexdigest()

# --- the tree ---------------------------------------------------------------------------


class Node:
    """A node of an adaptive radix tree: a compressed path and children by their first byte.

    ``path`` holds the bytes between the parent's branch and this node's own, first byte included.
    The layout is sorted bytes beside their children (4, then 16), an index of 256 into 48 children,
    or 256 children.
    """

    __slots__ = ("path", "layout", "bytes", "children", "end", "sub")

    def __init__(self, path: bytes, end: tuple | None = None):
        self.path, self.end = path, end
        self.layout, self.bytes, self.children = 4, bytearray(), []
        self.sub = None

    def child(self, byte: int) -> Node | None:
        if self.layout <= 16:
            at = bisect_left(self.bytes, byte)
            return self.children[at] if at < len(self.bytes) and self.bytes[at] == byte else None
        if self.layout == 48:
            at = self.bytes[byte]
            return self.children[at] if at < 48 else None
        return self.children[byte]

    def put(self, byte: int, node: Node) -> None:
        """Add a child, or replace the one with this byte."""
        if self.layout <= 16:
            at = bisect_left(self.bytes, byte)
            if at < len(self.bytes) and self.bytes[at] == byte:
                self.children[at] = node
                return
            if len(self.bytes) < self.layout:
                self.bytes.insert(at, byte)
                self.children.insert(at, node)
                return
            self._grow()
            self.put(byte, node)
        elif self.layout == 48:
            at = self.bytes[byte]
            if at < 48:
                self.children[at] = node
            elif len(self.children) < 48:
                self.bytes[byte] = len(self.children)
                self.children.append(node)
            else:
                self._grow()
                self.put(byte, node)
        else:
            self.children[byte] = node

    def _grow(self) -> None:
        if self.layout == 4:
            self.layout = 16
        elif self.layout == 16:
            index = bytearray([48]) * 256
            for at, byte in enumerate(self.bytes):
                index[byte] = at
            self.layout, self.bytes = 48, index
        else:
            wide = [None] * 256
            for byte in range(256):
                if self.bytes[byte] < 48:
                    wide[byte] = self.children[self.bytes[byte]]
            self.layout, self.bytes, self.children = 256, bytearray(), wide

    def each(self) -> list[Node]:
        return [c for c in self.children if c is not None]


def _common(a: bytes, b: bytes, start: int) -> int:
    """Length of the common beginning of ``a`` and ``b[start:]``."""
    n = min(len(a), len(b) - start)
    if a[:n] == b[start : start + n]:
        return n
    low, high = 0, n  # the first difference, by halving
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[start + low : start + middle]:
            low = middle
        else:
            high = middle
    return low


def insert(root: Node, key: bytes, end: tuple) -> None:
    """Put a key into the tree; ``end`` is what it carries."""
    node, at = root, 0
    while at < len(key):
        child = node.child(key[at])
        if child is None:
            node.put(key[at], Node(key[at:], end))
            return
        n = _common(child.path, key, at)
        if n < len(child.path):  # the key leaves the path: split it
            fork = Node(child.path[:n])
            child.path = child.path[n:]
            fork.put(child.path[0], child)
            node.put(key[at], fork)
            child = fork
        node, at = child, at + n
    node.end = end


def _preorder(root: Node) -> list[tuple[Node, int, Node | None]]:
    """Nodes with the byte depth at which their path begins and their parents, parents first."""
    order, stack = [], [(root, 0, None)]
    while stack:
        node, top, parent = stack.pop()
        order.append((node, top, parent))
        below = top + len(node.path)
        stack += [(c, below, node) for c in node.each()]
    return order


def _last_length(key: bytes, depth: int) -> int:
    return int.from_bytes(key[depth - LENGTH : depth], "big")


def trie_rows(keys: list[tuple[bytes, int, int, str]]) -> tuple[list[tuple], list[tuple]]:
    """Closed and open trie nodes of sorted strings ``(key, conversations, smallest id, ends)``.

    Closed: ``depth, conv_id, n, children, leaves, saved, ends`` and the parent, as its smallest
    member or, where it is open, as the hash of its prefix. Open: the hashes of the prefixes down to
    it, ``depth, conv_id, n, bytes of its last text, ends``, and its closed children, their leaves
    and their savings.
    """
    root = Node(b"")
    for key, n, least, ends in keys:
        insert(root, key, (n, least, ends))
    first, last = keys[0][0], keys[-1][0]
    order = _preorder(root)
    # Bottom up: members, smallest id, leaves, savings and children as the depth above the path sees them.
    whole: dict[int, bytes] = {}
    for node, top, parent in order:
        whole[id(node)] = (whole[id(parent)] if parent is not None else b"") + node.path
    for node, top, _ in reversed(order):
        n, least, ends = node.end or (0, None, None)
        leaves = saved = below = 0
        for child in node.each():
            n += child.sub[0]
            least = child.sub[1] if least is None else min(least, child.sub[1])
            leaves, saved, below = leaves + child.sub[2], saved + child.sub[3], below + child.sub[4]
        bottom = (leaves, saved, below)
        bottom_depth = top + len(node.path)
        key = whole[id(node)]
        for depth in range(bottom_depth - bottom_depth % WIDTH, top, -WIDTH):
            leaves = leaves or 1
            saved, below = saved + (n - 1) * _last_length(key, depth), 1
        node.sub = (n, least, leaves, saved, below, bottom)

    closed: list[tuple] = []
    opened: dict[bytes, list] = {}
    hashes: dict[tuple[int, int], bytes] = {}  # (which string, turns) of the two open paths
    for which, key in enumerate((first, last)):
        running = hashlib.sha256()
        hashes[which, 0] = running.digest()[:HASH]
        for depth in range(WIDTH, len(key) + 1, WIDTH):
            running.update(key[depth - WIDTH : depth])
            hashes[which, depth // WIDTH] = running.digest()[:HASH]

    def open_at(key: bytes, depth: int) -> int | None:
        """On which of the two open paths a prefix lies."""
        prefix = key[:depth]
        return 0 if first.startswith(prefix) else 1 if last.startswith(prefix) else None

    # Top down: what is above a node is its smallest member or the hash of an open prefix.
    above: dict[int, tuple[int | None, bytes | None]] = {}
    for node, top, parent in order:
        n, least, _, _, _, (leaves, saved, below) = node.sub
        key, bottom_depth = whole[id(node)], top + len(node.path)
        up_id, up_hash = above[id(parent)] if parent is not None else (None, None)
        start = -(-top // WIDTH) * WIDTH if parent is None else top - top % WIDTH + WIDTH
        lowest = bottom_depth - bottom_depth % WIDTH
        depths = list(range(start, lowest + 1, WIDTH))
        cost = [(n - 1) * _last_length(key, d) if d else 0 for d in depths]
        rest = sum(cost)
        for depth, own in zip(depths, cost, strict=True):
            at_bottom = depth == bottom_depth
            children = below if depth == lowest else 1
            ends = node.end[2] if at_bottom and node.end else NO_END
            which = open_at(key, depth) if parent is None or up_hash is not None else None
            if which is None:
                row = (depth // WIDTH, least, n, children, leaves or 1, saved + rest, ends)
                closed.append((*row, up_id, up_hash))
                if up_hash is not None:
                    part = opened[up_hash]
                    part[6] += 1
                    part[7] += leaves or 1
                    part[8] += saved + rest
                up_id, up_hash = least, None
            else:
                turns = depth // WIDTH
                path = [hashes[which, d] for d in range(turns + 1)]
                last_bytes = _last_length(key, depth) if depth else 0
                opened[path[-1]] = [path, turns, least, n, last_bytes, ends, 0, 0, 0]
                up_id, up_hash = None, path[-1]
            rest -= own
        above[id(node)] = (up_id, up_hash)
    return closed, [tuple(x) for x in opened.values()]


# --- Spark ------------------------------------------------------------------------------

_COUNTS = "depth long, conv_id long, n long, n_children long, n_leaves long, saved long, ends string"
_SLABS = (
    f"{_COUNTS}, parent_conv_id long, parent binary, path array<binary>, last_bytes long"
)
_TYPES = [
    *[pa.int64()] * 6, pa.string(), pa.int64(), pa.binary(), pa.list_(pa.binary()), pa.int64(),
]
_NAMES = [part.split()[0] for part in _SLABS.split(", ")]


def turn_id(role: Column, text: Column) -> Column:
    """The fixed-width id of a turn, as bytes. A null role or text is empty."""
    role, text = (F.coalesce(c, F.lit("")).cast("binary") for c in (role, text))
    length = F.octet_length(role).cast("long")  # parts the role from the text
    mark = F.unhex(F.lpad(F.hex(length), 16, "0"))
    hashed = F.unhex(F.substring(F.sha2(F.concat(mark, role, text), 256), 1, 2 * HASH))
    size = F.unhex(F.lpad(F.hex(F.octet_length(text).cast("long")), 2 * LENGTH, "0"))
    return F.concat(hashed, size)


def turns(
    conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``conv_id`` and ``ids``, the ids of its turns in order, of every conversation."""
    names = dict(conv_id=key, turn=turn, role=role, text=text)
    rows = conversations.select(*(by_name(conversations, c).alias(n) for n, c in names.items()))
    ids = rows.where("conv_id IS NOT NULL").select(
        "conv_id",
        F.struct(
            "turn",
            F.coalesce("role", F.lit("")).alias("role"),
            turn_id(F.col("role"), F.col("text")).alias("id"),
        ).alias("turn"),
    )
    ordered = ids.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return ordered.select("conv_id", F.col("turns.id").alias("ids"))


def _joined(ids: Column) -> Column:
    """The ids as one string of bytes."""
    text = F.concat_ws("", F.transform(ids, F.hex))
    return F.unhex(text)


def _ends(sequences: DataFrame) -> DataFrame:
    """``key`` and the SHA-256 of the ids that end there, in numeric order, for each string."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids = None, []

        def block() -> pa.RecordBatch:
            text = ",".join(map(str, ids))
            return pa.RecordBatch.from_arrays(
                [pa.array([key], pa.binary()), pa.array([ids[0]]), pa.array([text])],
                names=["hash", "least", "block"],
            )

        for batch in batches:
            for own, conv in zip(*(batch.column(c).to_pylist() for c in ("hash", "conv_id")), strict=True):
                if ids and (own != key or len(ids) == BLOCK):
                    yield block()
                    ids = []
                key = own
                ids.append(conv)
        if ids:
            yield block()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, running = None, None

        def done(found: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.binary(), pa.string())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*found, strict=True), kinds, strict=True)],
                names=["hash", "ends"],
            )

        for batch in batches:
            found = []
            for own, text in zip(*(batch.column(c).to_pylist() for c in ("hash", "block")), strict=True):
                if own == key:
                    running.update(b"," + text.encode())
                    continue
                if running is not None:
                    found.append((key, running.hexdigest()))
                key, running = own, hashlib.sha256(text.encode())
            if found:
                yield done(found)
        if running is not None:
            yield done([(key, running.hexdigest())])

    packed = (
        sequences.select("hash", "conv_id")
        .repartitionByRange("hash", "conv_id")
        .sortWithinPartitions("hash", "conv_id")
        .mapInArrow(blocks, "hash binary, least long, block string")
    )
    return (
        packed.repartition("hash")
        .sortWithinPartitions("hash", "least")
        .mapInArrow(digests, "hash binary, ends string")
    )


def _slabs(slab: int) -> Callable:
    """Closed and open nodes of each slab of sorted strings."""

    def rows_of(keys: list[tuple]) -> pa.RecordBatch:
        closed, opened = trie_rows(keys)
        rows = [(*c, None, None) for c in closed]
        for path, depth, least, n, last_bytes, ends, children, leaves, saved in opened:
            parent = path[-2] if len(path) > 1 else None
            row = (depth, least, n, children, leaves, saved, ends, None, parent, path, last_bytes)
            rows.append(row)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)],
            names=_NAMES,
        )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[tuple] = []
        size = 0
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("key", "n", "least", "ends"))
            for row in zip(*columns, strict=True):
                keys.append(row)
                size += len(row[0])
                if len(keys) == slab or size > SLAB_BYTES:
                    yield rows_of(keys)
                    keys, size = [], 0
        if keys:
            yield rows_of(keys)

    return build


def prefix_trie(sequences: DataFrame, slab: int = SLAB) -> DataFrame:
    """The nodes of all prefixes of ``conv_id, ids``, one row for each conversation.

    Columns: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens`` and ``ends_sha256``.
    """
    keyed = sequences.select("conv_id", _joined(F.col("ids")).alias("key"))
    rows = stored(
        keyed.select("conv_id", "key", F.unhex(F.md5("key")).alias("hash")), "trie_sequences"
    )
    distinct = rows.groupBy("key", "hash").agg(
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least")
    )
    keys = stored(distinct.join(_ends(rows), "hash").select("key", "n", "least", "ends"), "trie_keys")
    nodes = stored(
        keys.repartitionByRange("key").sortWithinPartitions("key").mapInArrow(_slabs(slab), _SLABS),
        "trie_nodes",
    )
    opened = nodes.where("path IS NOT NULL").withColumn("hash", F.element_at("path", -1))
    merged = stored(
        opened.groupBy("hash").agg(
            F.first("path").alias("path"),
            F.first("parent").alias("parent"),
            *(F.first(c).alias(c) for c in ("depth", "last_bytes")),
            *(F.sum(c).alias(c) for c in ("n", "n_children", "n_leaves", "saved")),
            F.min("conv_id").alias("conv_id"),
            # At most one slab holds the string that ends here; the others say that none does.
            F.coalesce(F.max(F.when(F.col("ends") != NO_END, F.col("ends"))), F.lit(NO_END)).alias("ends"),
        ),
        "trie_open",
    )
    children = merged.groupBy(F.col("parent").alias("hash")).agg(F.count(F.lit(1)).alias("more"))
    zero = F.lit(0).cast("long")
    settled = merged.join(children, "hash", "left").withColumns(
        {"n_children": F.col("n_children") + F.coalesce("more", zero)}
    )
    rolled = (
        settled.select(
            F.explode("path").alias("hash"),
            (F.col("n_leaves") + F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("leaves"),
            (F.col("saved") + (F.col("n") - 1) * F.col("last_bytes")).alias("tokens"),
        )
        .groupBy("hash")
        .agg(F.sum("leaves").alias("n_leaves"), F.sum("tokens").alias("saved"))
    )
    whole = settled.drop("n_leaves", "saved", "more").join(rolled, "hash")
    finished = nodes.where("path IS NULL AND parent IS NULL")
    hanging = nodes.where("path IS NULL AND parent IS NOT NULL")
    counts = ["depth", "conv_id", "n", "n_children", "n_leaves", "saved", "ends"]
    below_open = hanging.select(*counts, "parent").union(whole.select(*counts, "parent"))
    parents = merged.select(F.col("hash").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    placed = below_open.join(parents, "parent", "left").select(*counts, "parent_conv_id")
    return finished.select(*counts, "parent_conv_id").union(placed).select(
        "conv_id",
        "depth",
        "parent_conv_id",
        F.col("n").alias("n_convs"),
        "n_children",
        "n_leaves",
        F.col("saved").alias("saved_tokens"),
        F.col("ends").alias("ends_sha256"),
    )


def rebuilt(conversations: DataFrame) -> DataFrame:
    """``conv_id, ids`` of the contract's conversations, which begin with turns of another one."""
    own = stored(turns(conversations), "trie_turns")
    heads = own.select(F.col("conv_id").alias("base"), F.slice("ids", 1, 8).alias("head"))
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    wide = own.select(
        "conv_id", "ids", taken.cast("int").alias("h"), (F.col("conv_id") - F.col("conv_id") % 5).alias("base")
    ).join(heads, "base", "left")
    none = F.array().cast("array<binary>")
    head = F.when(F.col("h") > 0, F.slice(F.coalesce("head", none), F.lit(1), F.col("h"))).otherwise(none)
    size = F.greatest(F.size("ids") - F.col("h"), F.lit(0))
    rest = F.slice("ids", F.col("h") + 1, size)
    return wide.select("conv_id", F.concat(head, rest).alias("ids"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of all rebuilt conversations."""
    return prefix_trie(rebuilt(table(spark, sf_dir, "conversations")))


#: crc32 of a decimal number, bit by bit.
_CRC32 = """xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, flatten(list_transform(
        string_split(conv_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
    lambda a, s: CASE WHEN xor(a, s) & 1 = 1 THEN xor(xor(a, s) >> 1, 3988292384::BIGINT)
                      ELSE xor(a, s) >> 1 END))"""

OP13_SQL = f"""
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
                              sha256(coalesce(text, ''))) - 1 AS i
    FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
    SELECT conv_id, conv_id - conv_id % 5 AS base, {_CRC32} % 9 AS h
    FROM (SELECT DISTINCT conv_id FROM turns)),
rebuilt AS (
    SELECT c.conv_id, 0 AS part, i, role, text
    FROM convs AS c JOIN turns AS t ON t.conv_id = base AND i < h
    UNION ALL
    SELECT c.conv_id, 1, i, role, text FROM convs AS c JOIN turns AS t ON t.conv_id = c.conv_id AND i >= h),
sequences AS (
    SELECT c.conv_id,
           coalesce(list(sha256(strlen(role) || ':' || role || text) ORDER BY part, i)
                    FILTER (part IS NOT NULL), []) AS ids,
           coalesce(list(strlen(text) ORDER BY part, i) FILTER (part IS NOT NULL), []) AS sizes
    FROM convs AS c LEFT JOIN rebuilt USING (conv_id) GROUP BY c.conv_id),
members AS (
    SELECT conv_id, depth, len(ids) = depth AS ended, coalesce(sizes[depth], 0) AS size,
           sha256(array_to_string(ids[1:depth], ',')) AS node,
           CASE WHEN depth > 0 THEN sha256(array_to_string(ids[1:depth - 1], ',')) END AS parent
    FROM sequences, unnest(range(0, len(ids) + 1)) AS r(depth)),
nodes AS (
    SELECT node, any_value(parent) AS parent, any_value(depth) AS depth, min(conv_id) AS conv_id,
           count(*) AS n, any_value(size) AS size,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ended), '')) AS ends
    FROM members GROUP BY node),
children AS (SELECT parent AS node, count(*) AS k FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
rolled AS (
    SELECT m.node, sum(CASE WHEN k IS NULL THEN 1 ELSE 0 END)::BIGINT AS n_leaves,
           sum((x.n - 1) * x.size)::BIGINT AS saved
    FROM nodes AS x LEFT JOIN children USING (node)
    JOIN members AS m ON m.conv_id = x.conv_id AND m.depth <= x.depth GROUP BY m.node)
SELECT x.conv_id, x.depth, p.conv_id AS parent_conv_id, x.n AS n_convs,
       coalesce(k, 0) AS n_children, n_leaves, saved AS saved_tokens, x.ends AS ends_sha256
FROM nodes AS x JOIN rolled USING (node) LEFT JOIN children USING (node)
LEFT JOIN nodes AS p ON p.node = x.parent"""
