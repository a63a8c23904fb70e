"""Best-fit packing of documents into training sequences by bin completion.

Documents are encoded, closed with an end id and, if longer than a sequence, cut into full
sequences with the shorter piece first. Pieces of one length are interchangeable, hence the plan
needs only the number of pieces of each length: at most ``capacity`` numbers, whatever the corpus.

The plan takes the largest length left and completes its sequence: a branch-and-bound over
fillings with the lengths left, larger ones first, whose incumbent is the best-fit filling. A
branch is pruned when all lengths left cannot bring its waste below the incumbent's, and a filling
that swaps one piece for several of the same sum is dominated and not visited, as the single piece
comes first. The search of one sequence ends at a filling without waste or after ``max_nodes``
steps with the best found. A filling is repeated while its lengths last, so that every step uses
up a length.

Where that plan misses the lower bound, its sequences are searched again, those that waste most first,
in groups that hold ``DEEPEST`` lengths at most (a plan with no more lengths is one group). A group
is worth it if it wastes a sequence's room and lies above its own lower bound. The search branches over
the fillings of the largest length, repeated as often as they go or taken once, with the group's
sequences as incumbent, and prunes by the lower bound of the pieces left. It ends at the bound; after
``max_plans`` states in all, or when no group can be bettered, the best plan found stands. ``Plan.gap``
tells how many sequences it lies above the bound of any packing.

Pieces then get numbers within their length (counted in chunks, so that a length with a third of
all pieces is spread over all tasks) and look up their place in the plan.

Edge cases: a null or empty text is one piece with the end id alone; repeated rows are packed each;
a null id is kept; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from activlake.llm.common import by_name, checkpointed, table
from activlake.llm.tokens import encode, vocabulary_path

CAPACITY = 2048
END_ID = 0
#: Lengths of a group of sequences that is searched as a whole.
DEEPEST = 64


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """Start and length of the pieces of ``n`` ids; only the first may be short."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def lower_bound(counts: dict[int, int], capacity: int = CAPACITY) -> int:
    """Sequences that any packing needs: for each small size, pieces too large to share with it
    need their own sequence, and the rest of the volume fills what those leave."""
    lengths = sorted(counts)
    best = -(-sum(n * c for n, c in counts.items()) // capacity)
    for small in [0, *(x for x in lengths if 2 * x <= capacity)]:
        alone = sum(counts[x] for x in lengths if x > capacity - small)
        large = [x for x in lengths if capacity - small >= x and 2 * x > capacity]
        middle = [x for x in lengths if small <= x and 2 * x <= capacity]
        room = sum((capacity - x) * counts[x] for x in large)
        volume = sum(x * counts[x] for x in middle)
        need = alone + sum(counts[x] for x in large) + max(0, -(-(volume - room) // capacity))
        best = max(best, need)
    return best


def _filling(room: int, left: dict[int, int], lengths: list[int], max_nodes: int) -> list[int]:
    """Lengths that fill ``room`` with the least waste found; larger lengths first."""
    best: list[int] = []
    at, rest = bisect_left(lengths, room + 1) - 1, room
    used: dict[int, int] = {}
    while at >= 0 and rest:  # the incumbent: always the best-fitting piece
        x = lengths[at]
        n = min(left[x], rest // x)
        best += [x] * n
        rest -= n * x
        at = min(at - 1, bisect_left(lengths, rest + 1) - 1)
    waste = rest
    below = np.cumsum([x * left[x] for x in lengths]).tolist()
    dead: set[tuple[int, int, int]] = set()
    nodes = 0
    chosen: list[int] = []

    def branch(at: int, rest: int) -> bool:
        """Visit fillings with the lengths up to number ``at``; true ends the search."""
        nonlocal best, waste, nodes
        if rest < waste:
            best, waste = list(chosen), rest
        at = min(at, bisect_left(lengths, rest + 1) - 1)
        if not waste or at < 0 or rest - below[at] >= waste:
            return not waste
        state = at, rest, used.get(lengths[at], 0)  # shorter lengths are not used yet
        if state in dead:
            return False
        while at >= 0 and nodes < max_nodes and rest - below[at] < waste:
            nodes += 1
            x = lengths[at]
            if used.get(x, 0) < left[x]:
                used[x] = used.get(x, 0) + 1
                chosen.append(x)
                if branch(at, rest - x):
                    return True
                chosen.pop()
                used[x] -= 1
            at -= 1
        dead.add(state)
        return nodes >= max_nodes

    if waste and lengths:
        branch(len(lengths) - 1, room)
    return best


@dataclass(frozen=True)
class Plan:
    """Slots by length and by number of the piece within its length."""

    first_rank: np.ndarray
    length: np.ndarray
    first_sequence: np.ndarray
    offset: np.ndarray
    sequences: int
    bound: int

    @property
    def gap(self) -> int:
        """Sequences above the lower bound; with 0 the plan is known to be the best."""
        return self.sequences - self.bound

    def place(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(_key(self.length, self.first_rank), _key(lengths, ranks), "right") - 1
        return self.first_sequence[at] + ranks - self.first_rank[at], self.offset[at]


def _key(lengths: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    return (np.asarray(lengths, dtype=np.int64) << 40) + np.asarray(ranks, dtype=np.int64)


def _fillings(room: int, left: dict[int, int], lengths: list[int], steps: int) -> list[list[int]]:
    """Fillings of ``room`` that no further piece fits in, the least waste first, as far as
    ``steps`` lead; larger lengths first in each."""
    found: list[tuple[int, list[int]]] = []

    def extend(at: int, rest: int, chosen: list[int], skipped: int) -> None:
        nonlocal steps
        steps -= 1
        at = min(at, bisect_left(lengths, rest + 1) - 1)
        if at < 0:
            if skipped > rest:  # the smallest piece that is left out
                found.append((rest, chosen))
            return
        x = lengths[at]
        for n in range(min(left[x], rest // x), -1, -1):
            if steps <= 0:
                return
            out = min(skipped, x) if n < left[x] else skipped
            extend(at - 1, rest - n * x, chosen + [x] * n, out)

    extend(len(lengths) - 1, room, [], room + 1)
    return [chosen for _, chosen in sorted(found, key=lambda f: f[0])]


def _complete(
    left: dict[int, int], capacity: int, max_nodes: int
) -> list[tuple[list[int], int]]:
    """Patterns and how often, by the best filling found for the largest length left."""
    left = dict(left)
    lengths = sorted(left)
    patterns = []
    while lengths:
        largest = lengths[-1]
        left[largest] -= 1
        usable = [x for x in lengths[: bisect_left(lengths, capacity - largest + 1)] if left[x]]
        inner = _filling(capacity - largest, left, usable, max_nodes)
        left[largest] += 1
        pattern = [largest, *inner]
        times = min(left[x] // n for x, n in Counter(pattern).items())
        for x in pattern:
            left[x] -= times
        patterns.append((pattern, times))
        lengths = [x for x in lengths if left[x]]
    return patterns


def _search(
    counts: dict[int, int], capacity: int, best: list[tuple[list[int], int]], max_plans: int
) -> tuple[list[tuple[list[int], int]], int]:
    """Branch over the fillings of the largest length, each as often as it goes and once, with
    ``best`` as incumbent; ends at the bound or after ``max_plans`` states. Also returns how many
    of these are left."""
    fewest, bound = sum(n for _, n in best), lower_bound(counts, capacity)
    seen: dict[tuple, int] = {}

    def children(left: dict[int, int]) -> Iterator[tuple[list[int], int]]:
        largest = max(left)
        rest = dict(left)
        rest[largest] -= 1
        usable = sorted(x for x, n in rest.items() if n and x <= capacity - largest)
        for inner in _fillings(capacity - largest, rest, usable, 2_000):
            pattern = [largest, *inner]
            times = min(left[x] // n for x, n in Counter(pattern).items())
            yield from ((pattern, n) for n in dict.fromkeys((times, 1)))

    stack, path, used = [(counts, children(counts))], [], 0
    while stack and fewest > bound and max_plans > 0:
        left, options = stack[-1]
        option = next(options, None)
        if option is None:
            stack.pop()
            if path:
                used -= path.pop()[1]
            continue
        max_plans -= 1
        pattern, times = option
        after = {x: n - times * pattern.count(x) for x, n in left.items()}
        after = {x: n for x, n in after.items() if n}
        total, state = used + times, tuple(sorted(after.items()))
        if total + lower_bound(after, capacity) >= fewest or seen.get(state, total + 1) <= total:
            continue
        seen[state] = total
        if not after:
            best, fewest = [*path, option], total
            continue
        path.append(option)
        used = total
        stack.append((after, children(after)))
    return best, max_plans


def _improve(
    patterns: list[tuple[list[int], int]], capacity: int, bound: int, max_plans: int
) -> list[tuple[list[int], int]]:
    """Search groups of sequences anew, the most wasteful first, while the plan misses its bound."""

    def waste(pattern: tuple[list[int], int]) -> int:
        return capacity - sum(pattern[0])

    # A piece beside which not even the smallest fits is alone in any packing.
    least = min(x for pattern, _ in patterns for x in pattern)
    fixed = [p for p in patterns if len(p[0]) == 1 and p[0][0] + least > capacity]
    bound -= sum(n for _, n in fixed)
    best = [p for p in patterns if len(p[0]) > 1 or p[0][0] + least <= capacity]
    best.sort(key=waste, reverse=True)
    start = 0
    while start < len(best) and max_plans > 0 and sum(n for _, n in best) > bound:
        lengths: set[int] = set()
        stop = start
        while stop < len(best) and len(lengths | set(best[stop][0])) <= max(DEEPEST, len(best[start][0])):
            lengths |= set(best[stop][0])
            stop += 1
        group = best[start:stop]
        if sum(waste(p) * p[1] for p in group) < capacity and start == 0 and stop == len(best):
            break
        counts: Counter = Counter()
        for pattern, times in group:
            for x in pattern:
                counts[x] += times
        found, max_plans = _search(dict(counts), capacity, group, max_plans)
        if sum(n for _, n in found) < sum(n for _, n in group):
            best = sorted([*best[:start], *found, *best[stop:]], key=waste, reverse=True)
            start = 0
        elif stop == len(best):
            break
        else:
            start += max(1, (stop - start) // 2)
    return fixed + best


def make_plan(
    counts: dict[int, int],
    capacity: int = CAPACITY,
    max_nodes: int = 4_000,
    max_plans: int = 5_000,
) -> Plan:
    """The completion of the largest lengths in turn and, where it misses the bound, what a branch and
    bound over the fillings makes of its sequences."""
    left = {int(x): int(c) for x, c in counts.items() if c > 0}
    patterns, bound = _complete(left, capacity, max_nodes), lower_bound(left, capacity)
    if sum(n for _, n in patterns) > bound:
        patterns = _improve(patterns, capacity, bound, max_plans)
    ranks = dict.fromkeys(left, 0)
    slots, sequences = [], 0
    for pattern, times in patterns:
        offset = 0
        for x in pattern:
            slots.append((x, ranks[x], sequences, offset))
            ranks[x] += times
            offset += x
        sequences += times
    slots.sort()
    columns = np.array(slots, dtype=np.int64).reshape(-1, 4).T
    return Plan(columns[1], columns[0], columns[2], columns[3], sequences, bound)


def pieces(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    vocabulary: str | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of all documents: ``doc_id, piece, start, length, ids_crc32`` and, if asked for,
    the ``ids``."""
    path = vocabulary or vocabulary_path()

    given = documents.select(
        by_name(documents, key).alias("doc_id"), by_name(documents, text).alias("text")
    )
    fields = [
        T.StructField("doc_id", given.schema["doc_id"].dataType),
        T.StructField("piece", T.IntegerType()),
        *(T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32")),
    ]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    schema = T.StructType(fields)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, rows, held = [], [], []
            for place, given_text in enumerate(batch.column(1).to_pylist()):
                found = encode(given_text, path) if given_text else np.zeros(0)
                ids = np.append(found, END_ID).astype("<u4")
                for number, (start, length) in enumerate(cut(len(ids), capacity)):
                    own = ids[start : start + length]
                    places.append(place)
                    rows.append((number, start, length, zlib.crc32(own.tobytes())))
                    if with_ids:
                        held.append(own.astype(np.int32))
            numbers = np.array(rows, dtype=np.int64).reshape(-1, 4)
            columns = [
                batch.column(0).take(pa.array(places, pa.int64())),  # ids never leave Arrow
                pa.array(numbers[:, 0].astype(np.int32)),
                *(pa.array(numbers[:, i]) for i in (1, 2, 3)),
            ]
            if with_ids:
                columns.append(pa.array(held, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return given.mapInArrow(split, schema)


def numbered(rows: DataFrame) -> DataFrame:
    """Add ``rank``: the number of a piece among those of its length, from 0 without gaps.

    Pieces are numbered inside chunks by hash, and a chunk starts where the chunks before it end;
    the numbers of chunks are small tables of counts.
    """
    shuffle = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunk = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(max(16, shuffle)))
    rows = rows.withColumn("chunk", chunk)
    counted = rows.groupBy("length", "chunk").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("chunk")
    starts = counted.select(
        "length", "chunk", (F.sum("n").over(before) - F.col("n")).alias("before")
    )
    within = Window.partitionBy("length", "chunk").orderBy("doc_id", "piece", "ids_crc32")
    return (
        rows.withColumn("own", F.row_number().over(within) - 1)
        .join(starts, ["length", "chunk"])
        .withColumn("rank", (F.col("own") + F.col("before")).cast("long"))
        .drop("own", "before", "chunk")
    )


def pack(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    vocabulary: str | None = None,
    max_nodes: int = 4_000,
) -> DataFrame:
    """Pieces with their ``sequence_id`` and ``offset``; every sequence is gapless from 0."""
    rows = checkpointed(pieces(documents, key, text, capacity, vocabulary))
    counts = {r.length: r["count"] for r in rows.groupBy("length").count().collect()}
    plan = make_plan(counts, capacity, max_nodes)

    @F.pandas_udf("sequence_id long, offset long")
    def placed(lengths: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        sequence, offset = plan.place(lengths.to_numpy(), ranks.to_numpy())
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    return (
        numbered(rows)
        .withColumn("at", placed("length", "rank"))
        .select("doc_id", "piece", "start", "length", "ids_crc32", "at.*")
    )


def sequences(placed: DataFrame, documents: DataFrame, **encoding) -> DataFrame:
    """The packed sequences themselves: ``sequence_id``, ``ids`` and the ``starts`` of the pieces.

    A sequence holds at most ``capacity`` ids, so its group is bounded.
    """
    keys = ["doc_id", "piece", "ids_crc32"]
    held = pieces(documents, with_ids=True, **encoding).dropDuplicates(keys)
    same = [F.col(f"p.{c}").eqNullSafe(F.col(f"h.{c}")) for c in keys]
    return (
        placed.alias("p")
        .join(held.alias("h"), same[0] & same[1] & same[2])
        .groupBy("sequence_id")
        .agg(F.sort_array(F.collect_list(F.struct("p.offset", "h.ids"))).alias("s"))
        .select(
            "sequence_id", F.flatten("s.ids").alias("ids"), F.col("s.offset").alias("starts")
        )
    )


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 ids at most."""
    return pack(table(spark, sf_dir, "documents"))
