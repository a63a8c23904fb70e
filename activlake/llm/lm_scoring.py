"""Language-model scoring by prediction by partial matching over bytes.

A text is its lower-cased tokens (A to Z; words between white space) and one end. A token is coded
as its bytes and a closing space, the end as a line feed. A context is the last ``order`` bytes of the
text whatever tokens they belong to; a text starts in the context of one space.

The trie is a table: the count of every byte string of up to ``order + 1`` bytes in the training
texts. A symbol with count n in a context with T symbols in all and D distinct ones has
probability (2n - 1) / 2T, the escape D / 2T (method D). After an escape the context loses its
first byte, and the symbols seen in the longer context are excluded from the counts of the shorter
one; as the seen sets are nested, these remainders are two numbers for each context. Below the empty context
all bytes not yet seen are equally likely. The probabilities of the texts sum to one.

Jobs: count tokens (for the base score) and windows, which are a context and its symbol (a window of
up to seven bytes and its length are one 64-bit key; a task sorts slabs of windows, merges their
counts and hands them on packed by bucket of the key, so that one row holds many); count the suffixes of the windows; join the table with itself for
totals and remainders; walk the escape chain for windows that training never saw; and sum over each
document. The most frequent windows (``window_head`` at most) and tokens (``head`` at most, among them
what makes up at least one part in ``head`` of all) travel with the tasks, and only rarer ones are shuffled:
most rows never move, and no frequent key is hot. Tasks split, count and look up the tokens of many
texts at once as Arrow arrays. All tables grow with the corpus, stay in Spark and
are written to the shared folder between the jobs.

Edge cases: a null, empty or blank text is the end alone; rows with a null id are training rows;
repeated rows are scored each; with no training rows all bytes are equally likely and the base
score is zero; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from activlake.llm.common import by_name, crc32_mod, shuffles_released, stored, table

ORDER = 6
HEAD = 400_000
END = b"\n"
#: Distinct tokens that a task holds before it hands them on, and rows between two merges of them.
MOST_COUNTED = 500_000
#: Bytes of texts whose tokens are split at once.
PART = 1 << 23
#: Bytes of a token that may travel with the tasks.
LONGEST = 64
#: Windows that travel with the tasks, 16 bytes each.
WINDOW_HEAD = 2_000_000
#: Bytes of text whose windows are made at once, windows that are sorted at once, and rows of a batch
#: that are held as Python objects at once.
SLICE, SLAB, ROWS = 1 << 18, 1 << 21, 512
#: Windows that a task enters at once in the table of those that travel with it.
PORTION = 1 << 17
#: Counts of windows that a task holds before it merges them and, if most are distinct, hands them on.
MOST_WINDOWS = 3 << 20
#: Windows of the corpus for each bucket in which their counts are added up.
PLACES = 1 << 20
#: The odd number whose multiples fill buckets evenly (a fixed value), and its inverse.
SPREAD = np.uint64(0x9E3779B97F4A7C15)
GATHER = np.uint64(pow(int(SPREAD), -1, 1 << 64))
#: Columns of packed counts.
PARTS = ("packed_keys", "packed_c", "packed_n")


def tokens(text: str | None) -> list[bytes]:
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    found.append(END)
    return found


def _parts(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The batches, cut where their texts pass a multiple of ``most`` bytes."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        passed = np.cumsum(sizes, dtype=np.int64) // most
        cuts = [0, *(np.flatnonzero(np.diff(passed)) + 1).tolist(), batch.num_rows]
        yield from (batch.slice(a, b - a) for a, b in pairwise(cuts) if b > a)


def _words(texts: pa.Array) -> tuple[pa.ListArray, pa.DictionaryArray, np.ndarray]:
    """What ``tokens`` finds before the end: lists of the words of texts, of which a blank text has an
    empty one; all words but those, as codes; and the number of the text of each."""
    lists = pc.ascii_split_whitespace(
        pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    )
    words, at = lists.flatten(), pc.list_parent_indices(lists).to_numpy()
    filled = pc.binary_length(words).to_numpy() > 0
    if not filled.all():
        words, at = words.filter(pa.array(filled)), at[filled]
    return lists, words.dictionary_encode(), at


def _counts(words: pa.Array, c: np.ndarray, n: np.ndarray) -> pa.Table:
    return pa.table({"word": words, "c": c.astype(np.int64), "n": n.astype(np.int64)})


def _added_up(runs: list[pa.Table]) -> pa.Table:
    """One row for each token of the runs."""
    sums = pa.concat_tables(runs).group_by("word", use_threads=False)
    found = sums.aggregate([("c", "sum"), ("n", "sum")]).select(["word", "c_sum", "n_sum"])
    return found.rename_columns(["word", "c", "n"])


def vocabulary(documents: DataFrame, text: str, training: Column) -> DataFrame:
    """``word``, ``c`` (count in training rows) and ``n`` (count in all rows)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: list[pa.Table] = []
        fresh = 0  # rows since the last merge
        for part in _parts(batches, PART):
            _, words, at = _words(part.column("text"))
            own = pc.fill_null(part.column("training"), False).to_numpy(zero_copy_only=False)
            codes, distinct = words.indices.to_numpy(), len(words.dictionary)
            c = np.bincount(codes[own[at]], minlength=distinct)
            n = np.bincount(codes, minlength=distinct)
            runs.append(_counts(words.dictionary.cast(pa.binary()), c, n))
            runs.append(_counts(pa.array([END]), np.array([own.sum()]), np.array([len(own)])))
            fresh += distinct + 1
            if fresh > MOST_COUNTED:
                runs, fresh = [_added_up(runs)], 0
                if runs[0].num_rows > MOST_COUNTED:
                    yield from runs.pop().to_batches()
        if runs:
            yield from _added_up(runs).to_batches()

    given = documents.select(by_name(documents, text).alias("text"), training.alias("training"))
    return (
        given.mapInArrow(count, "word binary, c long, n long")
        .groupBy("word")
        .agg(F.sum("c").alias("c"), F.sum("n").alias("n"))
    )


def often_used(head: int, total: int) -> Column:
    """Tokens that travel with the tasks: at most ``head`` can be that frequent, and long ones,
    which would make their bytes unbounded, are joined."""
    return (F.col("n") * head >= total) & (F.octet_length("word") <= LONGEST)


def frequent_tokens(vocab: DataFrame, head: int, total: int) -> Column:
    """Tokens of ``vocab`` that travel with the tasks: the most frequent ones that are not long. Either
    condition marks all short tokens from some count on, ``head`` at most, and so does the wider one."""
    short = F.octet_length("word") <= LONGEST
    return often_used(head, total) | (_most_frequent(vocab.where(short), head) & short)


def _walked(links: DataFrame) -> DataFrame:
    """``g`` and ``lp`` from the strings and contexts along the escape chain of each ``whole``."""
    chain = links.groupBy("whole").agg(
        F.sort_array(F.collect_list(F.struct("j", "n", "t", "d", "tx", "dx"))).alias("chain")
    )
    # The state: the log so far, whether the symbol was found, the totals left by the context
    # before (negative: no context yet, the own totals hold), and how many symbols are excluded.
    walk = """
        aggregate(chain,
          named_struct('lp', 0D, 'found', false, 't', -1L, 'd', -1L, 'out', 0L),
          (s, x) -> CASE
            WHEN s.found OR x.t IS NULL THEN s
            WHEN x.n IS NOT NULL THEN named_struct(
              'lp', s.lp + log10(CAST(2 * x.n - 1 AS DOUBLE))
                - log10(CAST(2 * IF(s.t < 0, x.t, s.t) AS DOUBLE)),
              'found', true, 't', s.t, 'd', s.d, 'out', s.out)
            ELSE named_struct(
              'lp', s.lp + CASE
                WHEN s.t < 0 THEN log10(CAST(x.d AS DOUBLE)) - log10(CAST(2 * x.t AS DOUBLE))
                WHEN s.d > 0 THEN log10(CAST(s.d AS DOUBLE)) - log10(CAST(2 * s.t AS DOUBLE))
                ELSE 0D END,
              'found', false, 't', x.tx, 'd', x.dx, 'out', x.d)
          END,
          s -> IF(s.found, s.lp, s.lp - log10(CAST(greatest(256L - s.out, 1L) AS DOUBLE))))
    """
    return chain.select(F.col("whole").alias("g"), F.expr(walk).alias("lp"))


def coded(found: list[bytes]) -> bytes:
    """The bytes of a text of these tokens, with the space before it."""
    return b" " + b" ".join(found)


def windows(texts: list[bytes], order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Number of the text and key of every place of coded texts but their first, in slices.

    The low bytes of a key are the symbol and, above it, the context; the highest is their number.
    """
    data = np.frombuffer(b"".join(texts), np.uint8)
    edges = np.cumsum([0, *map(len, texts)])
    whole = np.uint64((1 << (8 * (order + 1))) - 1)
    for a in range(0, len(data), SLICE):
        b = min(a + SLICE, len(data))
        first, last = np.searchsorted(edges, a, "right") - 1, np.searchsorted(edges, b, "left")
        held = np.diff(np.clip(edges[first : last + 1], a, b))
        text = np.repeat(np.arange(first, last, dtype=np.int32), held)
        lead = min(a, 7)
        raw = np.zeros(7 + b - a, np.uint8)
        raw[7 - lead :] = data[a - lead : b]
        # Two, four and seven bytes that end at a place, the last one lowest.
        two = raw[1:].astype(np.uint16) | raw[:-1].astype(np.uint16) << np.uint16(8)
        four = two[2:].astype(np.uint32) | two[:-2].astype(np.uint32) << np.uint32(16)
        key = four[4:].astype(np.uint64) | four[:-4].astype(np.uint64) << np.uint64(32)
        key &= whole
        key |= np.uint64((order + 1) << 56)
        begins, ends = edges[first:last], np.minimum(edges[first + 1 : last + 1], b)
        for place in range(order):  # fewer bytes come before the first places of a text
            at = begins + place
            at = at[(at >= a) & (at < ends)] - a
            key[at] &= np.uint64((1 << (8 * (place + 1))) - 1)
            key[at] |= np.uint64((place + 1) << 56)
        coded_places = np.ones(b - a, dtype=bool)
        coded_places[begins[begins >= a] - a] = False
        yield text[coded_places], key[coded_places]


def _merged(runs: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """One run of sorted distinct keys, with their counts, out of several."""
    if len(runs) == 1:
        return runs[0]
    keys = np.concatenate([r[0] for r in runs])
    by = np.argsort(keys, kind="stable")  # merges sorted runs
    keys = keys[by]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    keys = keys[starts]
    sums = (
        np.add.reduceat(np.concatenate([r[x] for r in runs])[by], starts, dtype=runs[0][x].dtype)
        for x in (1, 2)
    )
    return keys, *sums


def _packed(run: tuple[np.ndarray, ...], bits: int) -> pa.RecordBatch:
    """A row for each bucket of a run, with its part of each array as bytes."""
    bucket = (run[0] >> np.uint64(64 - bits)).astype(np.int64)
    starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    edges = pa.py_buffer((np.append(starts, len(bucket)) * 8).astype(np.int32))
    parts = [
        pa.Array.from_buffers(pa.binary(), len(starts), [None, edges, pa.py_buffer(x)])
        for x in (run[0], run[1].astype(np.int64), run[2].astype(np.int64))
    ]
    return pa.RecordBatch.from_arrays([pa.array(bucket[starts]), *parts], names=["bucket", *PARTS])


def _bucket_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The counts of a bucket, however many runs it comes in: merged whenever new rows are as many
    as the distinct keys so far, and at the end."""
    runs: list[tuple[np.ndarray, ...]] = []
    most = MOST_WINDOWS // 8
    for batch in batches:
        for packed in zip(*(batch.column(x) for x in PARTS), strict=True):
            keys, c, n = (np.frombuffer(x.as_buffer(), np.int64) for x in packed)
            runs.append((keys.view(np.uint64), c, n))
            if sum(len(r[0]) for r in runs) > most:
                runs = [_merged(runs)]
                most = max(MOST_WINDOWS // 8, 2 * len(runs[0][0]))
    keys, c, n = _merged(runs)
    columns = [(keys * GATHER).view(np.int64), c, n]
    yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["g", "c", "n"])


def window_counts(
    documents: DataFrame, text: str, training: Column, order: int, places: int
) -> DataFrame:
    """``g`` (key of a window), ``c`` (count in training rows) and ``n`` (count in all rows).

    ``places``, about the number of windows in all rows, sets the number of buckets, so that a
    bucket's distinct windows stay few. Counts travel as one row for each run and bucket."""
    bits = min(32, max(6, math.ceil(math.log2(max(places, 1) / PLACES))))

    def counted(texts: list[bytes], own: bool) -> Iterator[tuple[np.ndarray, ...]]:
        """Sorted keys, spread, of slabs of windows with their counts."""

        def slab(keys: np.ndarray) -> tuple[np.ndarray, ...]:
            keys *= SPREAD
            keys.sort()
            starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            n = np.diff(np.append(starts, len(keys))).astype(np.uint32)
            return keys[starts], n if own else np.zeros_like(n), n

        held = np.empty(min(SLAB + SLICE, sum(map(len, texts))), np.uint64)
        used = 0
        for _, key in windows(texts, order):
            held[used : used + len(key)] = key
            used += len(key)
            if used >= SLAB:
                yield slab(held[:used])
                used = 0
        if used:
            yield slab(held[:used])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: dict[bool, list[bytes]] = {True: [], False: []}
        sizes = {True: 0, False: 0}
        runs: list[tuple[np.ndarray, ...]] = []
        added = 0  # the counts of a run are of 32 bits

        def add(own: bool) -> Iterator[pa.RecordBatch]:
            nonlocal added
            added += sizes[own]
            for run in counted(texts[own], own):
                runs.append(run)
                if sum(len(r[0]) for r in runs) > MOST_WINDOWS:
                    runs[:] = [_merged(runs)]
                    if len(runs[0][0]) > MOST_WINDOWS * 3 // 4:
                        yield _packed(runs.pop(), bits)
                        added = sizes[own]
            texts[own], sizes[own] = [], 0

        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            for text, own in zip(*(batch.column(i).to_pylist() for i in (0, 1)), strict=True):
                own = bool(own)
                coded_text = coded(tokens(text))
                if runs and added + sizes[True] + sizes[False] + len(coded_text) >= 1 << 32:
                    yield _packed(_merged(runs), bits)
                    runs.clear()
                    added = 0
                texts[own].append(coded_text)
                sizes[own] += len(coded_text)
                if sizes[own] >= SLAB:
                    yield from add(own)
        for own in (True, False):
            yield from add(own)
        if runs:
            yield _packed(_merged(runs), bits)

    given = documents.select(by_name(documents, text).alias("text"), training.alias("training"))
    packed = ", ".join(f"{x} binary" for x in PARTS)
    return (
        given.mapInArrow(count, f"bucket long, {packed}")
        .groupBy("bucket")
        .applyInArrow(_bucket_sums, "g long, c long, n long")
    )


def _length(g: str) -> str:
    return f"CAST(shiftright({g}, 56) AS INT)"


def _last(g: str, m: str) -> str:
    """The key of the last ``m`` bytes."""
    return f"(shiftleft(CAST({m} AS BIGINT), 56) | ({g} & (shiftleft(1L, 8 * ({m})) - 1L)))"


def _context(g: str) -> str:
    """The key without the last byte."""
    below = f"shiftright({g} & (shiftleft(1L, 56) - 1L), 8)"
    return f"(shiftleft(CAST({_length(g)} - 1 AS BIGINT), 56) | {below})"


#: Keys of all suffixes of ``g``, the longest first.
SUFFIXES = (
    f"transform(sequence(0, {_length('g')} - 1), j -> {_last('g', _length('g') + ' - j')})"
)


def window_strings(counts: DataFrame, order: int) -> DataFrame:
    """Every context followed by a symbol, ``g``, of all lengths, with its count ``n``, its context
    ``ctx`` and the totals of that: ``t`` symbols, ``d`` distinct ones, and ``s``, the count of these
    in the next shorter context. A context has 256 strings at most; ``first`` marks one of them."""
    # From the longest strings down: each length adds up the distinct strings of the length above.
    trained = counts.where("c > 0").select("g", F.col("c").alias("n"))
    grams = above = trained.where(f"{_length('g')} = {order + 1}")
    for m in range(order, 0, -1):
        shorter = above.select(F.expr(_last("g", str(m))).alias("g"), "n")
        own = trained.where(f"{_length('g')} = {m}")  # at the starts of texts
        level = own.union(shorter).groupBy("g").agg(F.sum("n").alias("n"))
        above = stored(level, f"lm_trie_{m}")
        grams = grams.union(above)
    split = grams.select(
        "g",
        "n",
        F.expr(_context("g")).alias("ctx"),
        F.expr(_last("g", _length("g") + " - 1")).alias("shorter"),
    )
    below = grams.select(F.col("g").alias("shorter"), F.col("n").alias("n_shorter"))
    of = Window.partitionBy("ctx")
    # Keys are distinct on the hinted sides, so that neither side of these joins is sorted.
    return split.join(below.hint("shuffle_hash"), "shorter", "left").select(
        "g",
        "n",
        "ctx",
        F.sum("n").over(of).alias("t"),
        F.count(F.lit(1)).over(of).alias("d"),
        F.coalesce(F.sum("n_shorter").over(of), F.lit(0)).alias("s"),
        (F.row_number().over(of.orderBy("g")) == 1).alias("first"),
    )


def window_contexts(strings: DataFrame) -> DataFrame:
    """``ctx`` with its totals ``t`` and ``d``, and ``tx`` and ``dx``: what the next shorter
    context holds besides the symbols seen in this one."""
    own = strings.where("first").select("ctx", "t", "d", "s")
    shorter = own.select(
        F.col("ctx").alias("shorter"), F.col("t").alias("t_below"), F.col("d").alias("d_below")
    )
    remainders = (
        own.where("ctx != 0")
        .withColumn("shorter", F.expr(_last("ctx", _length("ctx") + " - 1")))
        .join(shorter.hint("shuffle_hash"), "shorter", "left")
        .select(
            "ctx",
            "t",
            "d",
            (F.col("t_below") - F.col("s")).alias("tx"),
            (F.col("d_below") - F.col("d")).alias("dx"),
        )
    )
    zero = F.lit(0).cast("long")
    return remainders.union(own.where("ctx = 0").select("ctx", "t", "d", zero, zero))


def window_scores(counts: DataFrame, order: int) -> DataFrame:
    """``g``, ``n`` and ``lp``, the log10 probability of the symbol in its context."""
    strings = stored(window_strings(counts, order), "lm_strings")
    known = strings.select("g", (F.log10(2 * F.col("n") - 1) - F.log10(2 * F.col("t"))).alias("lp"))
    unseen = counts.where("c = 0").select("g").join(strings.select("g"), "g", "left_anti")
    links = unseen.select(
        F.col("g").alias("whole"), F.posexplode(F.expr(SUFFIXES)).alias("j", "g")
    ).withColumn("ctx", F.expr(_context("g")))
    grams, held = strings.select("g", "n"), window_contexts(strings)
    # All chains end in the same few short strings (65,792 at most): these are not shuffled.
    short = [f"{_length(c)} <= {n}" for c, n in (("g", 2), ("ctx", 1))]
    chain = (
        links.where(short[0])
        .join(F.broadcast(grams.where(short[0])), "g", "left")
        .join(F.broadcast(held.where(short[1])), "ctx", "left")
        .unionByName(
            links.where(f"NOT {short[0]}")
            .join(grams.hint("shuffle_hash"), "g", "left")
            .join(held.hint("shuffle_hash"), "ctx", "left")
        )
    )
    novel = _walked(chain)
    return counts.select("g", "n").join(known.union(novel).hint("shuffle_hash"), "g")


class Held:
    """Numbers by key, in a table that looks up whole arrays (open addressing; no key is zero). Of
    keys that want the same slot the last one gets it, so the most frequent ones should come last."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, (2 * len(keys)).bit_length())
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.values = np.zeros(1 << self.bits)
        # A part at a time: arrays of slots for all keys would be larger than the table.
        for end in range(len(keys), 0, -PORTION):
            part = slice(max(0, end - PORTION), end)
            self._add(keys[part], values[part])

    def _add(self, keys: np.ndarray, values: np.ndarray) -> None:
        at, left = self._slots(keys), np.arange(len(keys))
        while len(left):
            free = left[self.keys[at[left]] == 0]
            self.keys[at[free]] = keys[free]
            placed = self.keys[at[left]] == keys[left]
            self.values[at[left[placed]]] = values[left[placed]]
            left = left[~placed]
            at[left] = (at[left] + 1) & ((1 << self.bits) - 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys * SPREAD >> np.uint64(64 - self.bits)).view(np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers, zero for absent keys, and which keys are absent."""
        at = self._slots(keys)
        seen = self.keys.take(at)
        absent = seen != keys
        found = self.values.take(at)
        found[absent] = 0.0
        left = np.flatnonzero(absent & (seen != 0))
        while len(left):
            at[left] = (at[left] + 1) & ((1 << self.bits) - 1)
            seen = self.keys[at[left]]
            hit = seen == keys[left]
            found[left[hit]] = self.values[at[left[hit]]]
            absent[left[hit]] = False
            left = left[~hit & (seen != 0)]
        return found, absent


def _most_frequent(scored: DataFrame, head: int) -> Column:
    """Marks rows of ``scored`` with the largest ``n``, at most ``head``, by steps of a ninth."""
    step = F.floor(F.log2("n") * 8)
    least, taken = 1 << 20, 0
    for r in sorted(scored.groupBy(step.alias("step")).count().collect(), reverse=True):
        taken += r["count"]
        if taken > head:
            break
        least = r.step
    return step >= least


def score_in_context(
    documents: DataFrame,
    training: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    order: int = ORDER,
    head: int = HEAD,
    window_head: int = WINDOW_HEAD,
) -> DataFrame:
    """For each document ``doc_id, training, n_tokens, n_known, train_tokens, base_score, score``;
    ``training`` marks the rows to learn from, and ``order`` is at most 6."""
    if not 0 <= order <= 6:
        raise ValueError("a window of order + 1 bytes and its length must fit in 64 bits")
    with shuffles_released(documents.sparkSession):
        vocab = stored(vocabulary(documents, text, training), "lm_vocabulary")
        totals = vocab.agg(
            F.coalesce(F.sum("c"), F.lit(0)).alias("c"),
            F.coalesce(F.sum((F.col("c") > 0).cast("long")), F.lit(0)).alias("v"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
            F.coalesce(F.sum(F.col("n") * (F.octet_length("word") + 1)), F.lit(0)).alias("places"),
        ).first()
        below = totals.c + totals.v + 1
        counts = stored(window_counts(documents, text, training, order, totals.places), "lm_windows")
        scored = stored(window_scores(counts, order), "lm_scores")
        frequent = frequent_tokens(vocab, head, totals.n)
        top = vocab.where(frequent).select("word", "c").toArrow()
        often_words, often_c = top["word"].combine_chunks(), top["c"].to_numpy()
        often = _most_frequent(scored, window_head)
        # By number, so that the most frequent ones get their first slots; as rows it would fill the driver.
        top = scored.where(often).orderBy("n").select("g", "lp").toArrow()
        # A variable of its own is one copy in a worker; within the function it would be two in each task.
        of_frequent = documents.sparkSession.sparkContext.broadcast(
            (top["g"].to_numpy().astype(np.uint64), top["lp"].to_numpy(), often_words, often_c)
        )
        del top, often_words, often_c
    # A row is numbered by its place in the scan, which a repeated task finds again.
    own = F.struct(by_name(documents, doc_id).alias("doc_id"), training.alias("training"))
    given = documents.select(
        F.monotonically_increasing_id().alias("row"),
        by_name(documents, text).alias("text"),
        F.to_json(own).alias("own"),
    )
    kind = documents.schema[doc_id].dataType.simpleString()

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top_keys, top_lps, often_words, often_c = of_frequent.value
        held = Held(top_keys, top_lps)
        # What a token adds to its text; the last place is that of the rare ones, which add nothing yet.
        bases = np.append(np.log10((often_c + 1) / below), 0.0)
        learned = np.append(often_c > 0, False)
        end = pc.index(often_words, pa.scalar(END)).as_py()
        for part in _parts(batches, PART):
            numbers = part.column("row").to_numpy()
            lists, words, at = _words(part.column("text"))
            known_words = pc.index_in(words.dictionary.cast(pa.binary()), value_set=often_words)
            codes = words.indices.to_numpy()
            place = pc.fill_null(known_words, -1).to_numpy()[codes]
            n_tokens = np.bincount(at, minlength=len(numbers)) + 1
            known = np.bincount(at[learned[place]], minlength=len(numbers)) + learned[end]
            base = np.bincount(at, bases[place], len(numbers)) + bases[end]
            rare = place < 0
            yield _rare_words(numbers, at[rare], codes[rare], words.dictionary)
            if end < 0:
                yield _rare_words(numbers, np.arange(len(numbers)), np.zeros_like(numbers), pa.array([END]))
            lp = np.zeros(len(numbers))
            group: list[bytes] = []  # coded texts from row ``first`` on
            first = size = 0
            joined = pc.binary_join(lists, " ").cast(pa.binary())
            for i, text in enumerate(joined.to_pylist()):
                group.append(coded([text, END] if text else [END]))
                size += len(group[-1])
                if size < SLICE and i + 1 < len(numbers):
                    continue
                for row, key in windows(group, order):
                    found, absent = held.find(key)
                    lp[first : i + 1] += np.bincount(row, found, len(group))
                    yield _rare_windows(numbers[first:], row[absent], key[absent])
                group, first, size = [], i + 1, 0
            told = (x.tolist() for x in (n_tokens, known, base, lp))
            yield _heads(numbers, zip(*told, strict=True), part.column("own").to_pylist())

    rare_words = vocab.where(~frequent).select(
        F.xxhash64("word").alias("key"),
        "word",
        (F.col("c") > 0).cast("long").alias("w_known"),
        (F.log10(F.col("c") + 1) - math.log10(below)).alias("w_base"),
        F.lit(0.0).alias("w_lp"),
    )
    rare_windows = scored.where(~often).select(
        F.col("g").alias("key"),
        F.expr("X''").alias("word"),
        F.lit(0).cast("long").alias("w_known"),
        F.lit(0.0).alias("w_base"),
        F.col("lp").alias("w_lp"),
    )
    rare = rare_words.union(rare_windows)

    # A document's own row tells its sums as text, numbers to the last digit.
    told = F.split(F.when(F.startswith("word", F.lit(HEAD_MARK)), F.col("word").cast("string")), " ", 5)
    doc = F.from_json(told[4], f"doc_id {kind}, training boolean")

    def total(name: str, own: Column) -> Column:
        return F.sum(F.coalesce(own, F.col("n") * F.col(f"w_{name}"))).alias(name)

    return (
        given.mapInArrow(sums, "row long, key long, word binary, n int")
        .withColumn("key", F.coalesce("key", F.xxhash64("word")))
        .join(rare.hint("shuffle_hash"), ["key", "word"], "left")  # distinct keys: no sort
        .groupBy("row")
        .agg(
            F.max(doc.doc_id).alias("doc_id"),
            F.max(doc.training).alias("training"),
            F.max(told[0].substr(3, 20).cast("long")).alias("n_tokens"),
            total("known", told[1].cast("long")),
            total("base", told[2].cast("double")),
            total("lp", told[3].cast("double")),
        )
        .select(
            "doc_id",
            "training",
            "n_tokens",
            F.col("known").alias("n_known"),
            F.lit(totals.c).cast("long").alias("train_tokens"),
            F.col("base").alias("base_score"),
            F.col("lp").alias("score"),
        )
    )


def _summands(
    row: np.ndarray, key: np.ndarray | pa.Array, word: pa.Array, n: np.ndarray
) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(row), key if isinstance(key, pa.Array) else pa.array(key), word, pa.array(n.astype(np.int32))],
        names=["row", "key", "word", "n"],
    )


def _no_words(n: int) -> pa.Array:
    """Empty byte strings."""
    edges = pa.py_buffer(np.zeros(n + 1, np.int32))
    return pa.Array.from_buffers(pa.binary(), n, [None, edges, pa.py_buffer(b"")])


def _rare_windows(rows: np.ndarray, at: np.ndarray, key: np.ndarray) -> pa.RecordBatch:
    """A row for each text and window, under the window's key."""
    # One sort by text and most bits of the key: what these bits mix up is only not added up here.
    by = np.argsort((at.astype(np.uint64) << np.uint64(48)) | (key * SPREAD >> np.uint64(16)))
    at, key = at[by], key[by]
    new = (at[1:] != at[:-1]) | (key[1:] != key[:-1])
    starts = np.flatnonzero(np.append(True, new)) if len(at) else at
    n = np.diff(np.append(starts, len(at)))
    return _summands(rows[at[starts]], key[starts].astype(np.int64), _no_words(len(n)), n)


def _rare_words(
    rows: np.ndarray, at: np.ndarray, codes: np.ndarray, words: pa.Array
) -> pa.RecordBatch:
    """A row for each text and rare token, whose hash Spark makes its key."""
    found, n = np.unique(at.astype(np.int64) * len(words) + codes, return_counts=True)
    at, codes = np.divmod(found, max(len(words), 1))
    word = words.take(pa.array(codes)).cast(pa.binary())
    return _summands(rows[at], pa.nulls(len(at), pa.int64()), word, n)


#: Begins what a document's own row tells; no token has a line feed and more.
HEAD_MARK = b"\n\n"


def _heads(rows: np.ndarray, heads: Iterable[tuple], own: list[str]) -> pa.RecordBatch:
    """A row for each document with what its frequent tokens and windows add up to. Its key, the
    row's number, spreads well, and it joins nothing."""
    told = [
        HEAD_MARK + f"{n} {known} {base!r} {lp!r} {doc}".encode()
        for (n, known, base, lp), doc in zip(heads, own, strict=True)
    ]
    return _summands(rows, rows, pa.array(told, pa.binary()), np.zeros(len(rows), dtype=np.int64))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and byte-context scores of every document, learned from the training share."""
    held_out = F.coalesce(crc32_mod(F.col("doc_id"), 7) == 2, F.lit(False))
    found = score_in_context(table(spark, sf_dir, "documents"), ~held_out)
    return found.select(
        "doc_id",
        (~F.col("training")).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )
