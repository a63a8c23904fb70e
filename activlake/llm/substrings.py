"""Exact removal of repeated passages by super-k-mer partitioning.

A window is ``window`` consecutive words of a text. Its minimiser is the run of ``minimiser`` words in
it with the smallest hash (the leftmost of equal ones), so equal windows have equal minimisers.
Consecutive windows with the same minimiser form a super-k-mer: they travel as one string of packed
words to the bucket of the minimiser. There the windows are cut out, sorted as bytes and counted, so
hashes choose buckets and nothing else.

1. Equal texts become one row with its number of ``copies``, before any other shuffle. The rows are
   stored as a table bucketed by two hashes of the text, so that no later join shuffles texts.
2. The minimisers of all super-k-mers are counted. One that occurs once cannot hold a repeated window:
   its super-k-mers never travel.
3. The other super-k-mers travel to their buckets and are counted there, weighted by copies.
4. The places of repeated windows go back to their texts, which drop the covered words.

A bucket of more than ``full`` super-k-mers (a passage that very many texts share) first makes equal
strings one, with partial sums in the tasks; what is found for a string goes back to all its places. If
more than ``distinct`` strings are left, the bucket is split by its windows: each window is a key of its
own. The counts are the same on every way.

Memory: a task holds one batch of texts, slabs of ``SLAB`` words, and in step 3 one bucket of at most
``distinct`` strings of at most ``RUN + window`` words. Packed words have at most 65 bytes: a longer one
stands as a tab, which no word holds, and its SHA-256.

Edge cases: null, empty and blank texts have no words and keep none; a text of fewer words than a
window has none and stays; windows that overlap themselves count (``a a a ...``); copies of a text, and
repeated rows and ids, are occurrences like any others; a null id is kept; very long texts are cut into
overlapping slabs; an empty table gives an empty result; ``deduplicate`` keeps other columns whatever
their names.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from activlake.llm.common import by_name, checkpointed, free_name, shared_folder, table

WINDOW, MINIMISER = 35, 8
LONGEST_WORD = 64
#: Words that are hashed at once, and the windows of a super-k-mer at most.
SLAB, RUN = 100_000, 64
#: Low bits of an order key that hold the place within a slab.
PLACE = 18
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_TABLE = np.random.default_rng(2024).integers(1, 2**63, 256, dtype=np.uint64)


def packed(text: bytes) -> list[bytes]:
    """The words of a text in the form in which they travel."""
    words = text.split()
    if max(map(len, words), default=0) > LONGEST_WORD:
        words = [
            w if len(w) <= LONGEST_WORD else b"\t" + hashlib.sha256(w).hexdigest().encode()
            for w in words
        ]
    return words


class _Powers:
    """Powers of a base and of its inverse modulo 2**64, as long as the longest slab so far."""

    forth = np.ones(1, dtype=np.uint64)
    back = np.ones(1, dtype=np.uint64)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.forth) < n:
            for name, base in (("forth", _BASE), ("back", _INVERSE)):
                powers = np.full(n, base, dtype=np.uint64)
                powers[0] = 1
                setattr(cls, name, np.multiply.accumulate(powers))
        return cls.forth[:n], cls.back[:n]


class Pieces(NamedTuple):
    """Super-k-mers of a slab: text, first window in it, number of windows, minimiser; the slab's
    packed words, where each of them begins and ends, and the first word of each super-k-mer."""

    text: np.ndarray
    place: np.ndarray
    windows: np.ndarray
    minimiser: np.ndarray
    occurrences: np.ndarray
    buffer: bytes
    begins: np.ndarray
    ends: np.ndarray
    first: np.ndarray


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values."""
    have = 1
    found = values
    while have * 2 <= width:
        found = np.minimum(found[:-have], found[have:])
        have *= 2
    n = len(values) - width + 1
    return np.minimum(found[:n], found[width - have : width - have + n])


def _slab(segments: list[tuple[int, int, int]], words: list[bytes], k: int, m: int) -> Pieces:
    """Super-k-mers of several segments (text, place of the first word, number of words)."""
    buffer = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    begins = ends - lengths
    forth, back = _Powers.upto(len(buffer) + 1)
    sums = np.zeros(len(buffer) + 1, dtype=np.uint64)
    np.cumsum(_TABLE[np.frombuffer(buffer, dtype=np.uint8)] * forth[: len(buffer)], out=sums[1:])
    last = len(words) - m + 1
    hashes = (sums[ends[m - 1 :]] - sums[begins[:last]]) * back[begins[:last]]
    hashes ^= hashes >> np.uint64(31)
    hashes *= np.uint64(0xBF58476D1CE4E5B9)
    hashes ^= hashes >> np.uint64(29)
    order = (hashes >> np.uint64(PLACE) << np.uint64(PLACE)) | np.arange(last, dtype=np.uint64)
    at = (_least(order, k - m + 1) & np.uint64((1 << PLACE) - 1)).astype(np.int64)
    minimiser = hashes[at].view(np.int64)

    n = len(words) - k + 1
    edges = np.cumsum([0] + [s[2] for s in segments])
    valid = np.ones(n, dtype=bool)
    for edge in edges[1:-1]:
        valid[max(0, edge - k + 1) : edge] = False
    breaks = np.ones(n + 1, dtype=bool)
    breaks[1:n] = minimiser[1:] != minimiser[:-1]
    breaks[:n] |= ~valid
    starts_of = edges[:-1]
    breaks[starts_of[starts_of < n]] = True
    place = np.flatnonzero(breaks)
    starts, stops = place[:-1], place[1:]
    own = valid[starts]
    starts, stops = starts[own], stops[own]
    cuts = -(-(stops - starts) // RUN)
    within = np.arange(cuts.sum()) - np.repeat(np.cumsum(cuts) - cuts, cuts)
    first = np.repeat(starts, cuts) + within * RUN
    stop = np.minimum(first + RUN, np.repeat(stops, cuts))
    # Places of the minimiser within a super-k-mer: more than one, and windows in it may be equal.
    moved = np.concatenate([[0], np.cumsum(at[1:] != at[:-1])])
    segment = np.searchsorted(edges, first, side="right") - 1
    text, offset = (np.array([s[i] for s in segments], dtype=np.int64) for i in (0, 1))
    return Pieces(
        text[segment],
        first - edges[segment] + offset[segment],
        stop - first,
        minimiser[first],
        moved[stop - 1] - moved[first] + 1,
        buffer,
        begins,
        ends,
        first,
    )


def super_kmers(texts: list[bytes | None], k: int = WINDOW, m: int = MINIMISER) -> Iterator[Pieces]:
    """Super-k-mers of several texts, slab by slab."""
    segments: list[tuple[int, int, int]] = []
    words: list[bytes] = []
    for number, text in enumerate(texts):
        own = packed(text or b"")
        for at in range(0, len(own) - k + 1, SLAB):
            part = own[at : at + SLAB + k - 1]
            if len(words) + len(part) > SLAB + k - 1 and words:
                yield _slab(segments, words, k, m)
                segments, words = [], []
            segments.append((number, at, len(part)))
            words += part
    if words:
        yield _slab(segments, words, k, m)


# --- texts ------------------------------------------------------------------------------


def _hashes(text: Column) -> tuple[Column, Column]:
    """Two independent hashes that stand for a text."""
    return F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(7), text).alias("t2")


def _texts(documents: DataFrame, text: str) -> DataFrame:
    """Distinct texts with their number of copies, in a table bucketed by ``t1, t2``."""
    spark = documents.sparkSession
    own = F.coalesce(by_name(documents, text), F.lit(""))
    rows = (
        documents.select(*_hashes(own), own.alias("text"))
        .groupBy("t1", "t2")
        .agg(F.first("text").cast("binary").alias("text"), F.count(F.lit(1)).alias("copies"))
    )
    name = f"texts_{uuid.uuid4().hex}"
    (
        rows.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "t1", "t2")
        .option("path", f"{shared_folder(spark).rstrip('/')}/{name}")
        .saveAsTable(name)
    )
    return spark.table(name)


def _arrays(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], list(columns)
    )


def _numbers(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def _minimisers(k: int, m: int) -> Callable:
    """``t1, t2, h`` of every super-k-mer; twice where windows within it may be equal."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t1, t2 = _numbers(batch, "t1"), _numbers(batch, "t2")
            for found in super_kmers(batch.column("text").to_pylist(), k, m):
                times = np.minimum(found.occurrences, 2)
                text = np.repeat(found.text, times)
                yield _arrays(t1=t1[text], t2=t2[text], h=np.repeat(found.minimiser, times))

    return keys


def _marked(texts: DataFrame, k: int, m: int, full: int) -> DataFrame:
    """For each text its minimisers that occur elsewhere too, apart those of full buckets."""
    keys = texts.select("t1", "t2", "text").mapInArrow(_minimisers(k, m), "t1 long, t2 long, h long")
    # Stored, so that the join below reads two plain shuffles, of which Spark splits hot keys.
    counted = checkpointed(keys.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    return (
        keys.join(counted, "h")
        .groupBy("t1", "t2")
        .agg(
            F.collect_set(F.when(F.col("n") <= full, F.col("h"))).alias("some"),
            F.collect_set(F.when(F.col("n") > full, F.col("h"))).alias("many"),
        )
    )


def _chosen(
    batch: pa.RecordBatch, column: str, k: int, m: int
) -> Iterator[tuple[Pieces, np.ndarray]]:
    """Slabs of a batch of texts and which of their super-k-mers have a minimiser in ``column``."""
    wanted = np.unique(pc.list_flatten(batch.column(column)).to_numpy(zero_copy_only=False))
    if not len(wanted):
        return
    for found in super_kmers(batch.column("text").to_pylist(), k, m):
        near = np.minimum(np.searchsorted(wanted, found.minimiser), len(wanted) - 1)
        yield found, np.flatnonzero(wanted[near] == found.minimiser)


def _strings(k: int, m: int, column: str) -> Callable:
    """The super-k-mers that travel: those with a minimiser in ``column``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t1, t2, copies = (_numbers(batch, c) for c in ("t1", "t2", "copies"))
            for found, at in _chosen(batch, column, k, m):
                text, first = found.text[at], found.first[at]
                low = found.begins[first].tolist()
                high = found.ends[first + found.windows[at] + k - 2].tolist()
                held = [found.buffer[a:b] for a, b in zip(low, high, strict=True)]
                yield _arrays(
                    h=found.minimiser[at], t1=t1[text], t2=t2[text], copies=copies[text],
                    place=found.place[at].astype(np.int32), words=pa.array(held, pa.binary()),
                )

    return cut


def _cut(words: bytes, k: int) -> list[bytes]:
    """The windows of a packed string."""
    spaces = np.flatnonzero(np.frombuffer(words, dtype=np.uint8) == 32)
    begins, ends = [0, *(spaces + 1).tolist()], [*spaces.tolist(), len(words)]
    return [words[begins[j] : ends[j + k - 1]] for j in range(len(begins) - k + 1)]


def _windows(k: int) -> Callable:
    """Every window of packed strings, with its place."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [_cut(w, k) for w in batch.column("words").to_pylist()]
            own = np.repeat(np.arange(len(held)), [len(x) for x in held])
            yield _arrays(
                **{c: _numbers(batch, c)[own] for c in ("t1", "t2", "copies")},
                place=np.array([j for x in held for j in range(len(x))], dtype=np.int32),
                words=pa.array([w for x in held for w in x], pa.binary()),
            )

    return cut


def repeated(rows: list[tuple[bytes, int]], k: int = WINDOW) -> list[list[int]]:
    """For each packed string of a bucket (with its copies) the windows that occur twice or more."""
    windows, owners = [], []
    for number, (words, _) in enumerate(rows):
        own = _cut(words, k)
        windows += own
        owners += [(number, j) for j in range(len(own))]
    found: list[list[int]] = [[] for _ in rows]
    order = sorted(range(len(windows)), key=windows.__getitem__)
    for _, same in groupby(order, key=windows.__getitem__):
        run = [owners[i] for i in same]
        if len(run) > 1 or rows[run[0][0]][1] > 1:
            for number, j in run:
                found[number].append(j)
    return [sorted(x) for x in found]


def _counted(k: int) -> Callable:
    """Ranges of words that repeated windows cover, from super-k-mers in the order of their buckets."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket: list[tuple] = []

        def ranges(rows: list[tuple]) -> Iterator[tuple]:
            for (_, t1, t2, _, place, _), own in zip(
                rows, repeated([(r[5], r[3]) for r in rows], k), strict=True
            ):
                start = before = None
                for j in own:
                    if before is not None and j != before + 1:
                        yield t1, t2, place + start, place + before + k
                        start = None
                    start = j if start is None else start
                    before = j
                if start is not None:
                    yield t1, t2, place + start, place + before + k

        def packed_up(found: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
            columns = zip(*found, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                names=["t1", "t2", "start", "end"],
            )

        for batch in batches:
            found: list[tuple] = []
            columns = ("h", "t1", "t2", "copies", "place", "words")
            for row in zip(*(batch.column(c).to_pylist() for c in columns), strict=True):
                if bucket and bucket[0][0] != row[0]:
                    found += ranges(bucket)
                    bucket = []
                bucket.append(row)
            if found:
                yield packed_up(found)
        found = list(ranges(bucket))
        if found:
            yield packed_up(found)

    return count


_ROW = "t1 long, t2 long, copies long, place int, words binary"
_RANGE = "t1 long, t2 long, start int, end int"


def _in_buckets(strings: DataFrame, k: int) -> DataFrame:
    """``t1, t2, start, end`` of what repeated windows cover in ``h, t1, t2, copies, place, words``."""
    dealt = strings.repartition("h").sortWithinPartitions("h")
    return dealt.mapInArrow(_counted(k), _RANGE)


def _in_full_buckets(pieces: DataFrame, k: int, distinct: int) -> DataFrame:
    """The same, with each distinct string counted once and windows apart where many are left."""
    name = [F.xxhash64("words").alias("w1"), F.xxhash64(F.lit(7), "words").alias("w2")]
    strings = checkpointed(pieces.groupBy("h", "words").agg(F.sum("copies").alias("copies")))
    sizes = checkpointed(strings.groupBy("h").agg(F.count(F.lit(1)).alias("n")))
    sized = strings.join(sizes, "h").select(
        "h", *(c.alias(t) for c, t in zip(name, ("t1", "t2"), strict=True)), "copies",
        F.lit(0).alias("place"), "words", "n",
    )
    found = _in_buckets(sized.where(F.col("n") <= distinct).drop("n"), k)
    if not sizes.where(F.col("n") > distinct).isEmpty():
        # Counted as bytes; two hashes then name the repeated ones to the places.
        windows = sized.where(F.col("n") > distinct).mapInArrow(_windows(k), _ROW)
        twice = windows.groupBy("words").agg(F.sum("copies").alias("n")).where("n > 1")
        places = windows.select(*name, "t1", "t2", "place").join(
            twice.select(*name), ["w1", "w2"], "left_semi"
        )
        start = F.col("place").alias("start")
        found = found.union(places.select("t1", "t2", start, (start + k).alias("end")))
    by_string = (
        found.groupBy(F.col("t1").alias("w1"), F.col("t2").alias("w2"))
        .agg(F.collect_list(F.struct("start", "end")).alias("ranges"))  # of one string
    )
    place = F.col("place")
    return (
        pieces.select("t1", "t2", "place", *name)
        .join(checkpointed(by_string), ["w1", "w2"])
        .select("t1", "t2", "place", F.inline("ranges"))
        .select("t1", "t2", (place + F.col("start")).alias("start"), (place + F.col("end")).alias("end"))
    )


def repeats(
    documents: DataFrame,
    text: str = "text",
    window: int = WINDOW,
    minimiser: int = MINIMISER,
    full: int = 1_024,
    distinct: int = 4_096,
) -> DataFrame:
    """Each distinct text (``t1, t2, text, copies``) with the ``ranges`` of words that its repeated
    windows cover; for a text with copies that is all of it, without ranges."""
    if not 1 <= minimiser <= window:
        raise ValueError("a minimiser has one word at least and a window at most")
    texts = _texts(documents, text)
    marked = checkpointed(_marked(texts, window, minimiser, full))

    def travelling(column: str) -> DataFrame:
        some = marked.where(F.size(column) > 0).hint("shuffle_hash")
        return texts.join(some, ["t1", "t2"]).mapInArrow(
            _strings(window, minimiser, column), f"h long, {_ROW}"
        )

    found = _in_buckets(travelling("some"), window)
    if not marked.where(F.size("many") > 0).isEmpty():
        found = found.union(_in_full_buckets(travelling("many"), window, distinct))
    ranges = found.groupBy("t1", "t2").agg(F.collect_list(F.struct("start", "end")).alias("ranges"))
    return texts.join(ranges.hint("shuffle_hash"), ["t1", "t2"], "left")


def _kept(k: int) -> Callable:
    """Number of words, of removed words, and the others joined by one space."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, gone, kept = [], [], []
            rows = zip(*(batch.column(c).to_pylist() for c in ("text", "copies", "ranges")), strict=True)
            for text, copies, ranges in rows:
                words = text.split()
                total.append(len(words))
                if copies > 1 and len(words) >= k:
                    words = []
                elif ranges:
                    stays = np.ones(len(words), dtype=bool)
                    for r in ranges:
                        stays[r["start"] : r["end"]] = False
                    words = [words[i] for i in np.flatnonzero(stays).tolist()]
                gone.append(total[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("t1"),
                    batch.column("t2"),
                    pa.array(total, pa.int64()),
                    pa.array(gone, pa.int64()),
                    pa.array(kept, pa.binary()),
                ],
                names=["t1", "t2", "n_words", "n_removed", "kept"],
            )

    return keep


def kept_texts(documents: DataFrame, text: str = "text", **options) -> DataFrame:
    """``t1, t2, n_words, n_removed, kept`` (bytes) of each distinct text."""
    return repeats(documents, text, **options).mapInArrow(
        _kept(options.get("window", WINDOW)),
        "t1 long, t2 long, n_words long, n_removed long, kept binary",
    )


def _joined(documents: DataFrame, text: str, kept: DataFrame, *carried: Column) -> DataFrame:
    t1, t2 = _hashes(F.coalesce(by_name(documents, text), F.lit("")))
    return documents.select(*carried, t1, t2).join(kept, ["t1", "t2"]).drop("t1", "t2")


def deduplicate(documents: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents with their repeated passages removed from the text, words joined by a space."""
    rest = [c for c in documents.columns if c != text]
    row = F.struct(*(by_name(documents, c) for c in rest)).alias("row")
    # The other columns travel in one struct, so that their names cannot clash.
    kept = kept_texts(documents, text, **options).select(
        "t1", "t2", F.col("kept").cast("string").alias("kept")
    )
    found = _joined(documents, text, kept, row)
    mark = free_name(documents, "kept")
    wide = found.select("row.*", F.col("kept").alias(mark))
    return wide.select(*(by_name(wide, mark if c == text else c).alias(c) for c in documents.columns))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document, how many repeated windows of 35 words cover, and what is left."""
    documents = table(spark, sf_dir, "documents")
    kept = kept_texts(documents).select(
        "t1", "t2", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )
    return _joined(documents, "text", kept, F.col("doc_id"))


OP12_SQL = r"""
WITH split AS (
    SELECT row_number() OVER () AS r, doc_id,
           list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
    FROM documents),
starts AS (
    SELECT r, i, sha256(array_to_string(words[i:i + 34], ' ')) AS h
    FROM split, unnest(range(1, len(words) - 33)) AS s(i)),
twice AS (SELECT h FROM starts GROUP BY h HAVING count(*) > 1),
gone AS (
    SELECT r, list(DISTINCT i + o) AS places
    FROM starts JOIN twice USING (h), unnest(range(35)) AS o(o) GROUP BY r),
kept AS (
    SELECT doc_id, words,
           list_filter(words, lambda w, i: NOT coalesce(list_contains(places, i), false)) AS rest
    FROM split LEFT JOIN gone USING (r))
SELECT doc_id, len(words) AS n_words, len(words) - len(rest) AS n_removed,
       sha256(array_to_string(rest, ' ')) AS kept_sha256
FROM kept"""
