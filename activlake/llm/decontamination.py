"""Benchmark decontamination by a prefix-filtered set join.

An item's windows are its runs of ``window`` consecutive words (a shorter item is one window). A
window is a set of placed shingles of three words. A document contains a window exactly if it has
all of its shingles at consecutive places, so a single shingle is a necessary prefix, and the
rarest one is the best: shingles are ordered by how often they occur in the documents.

1. Words and shingles of every document are built inside its row and looked up among the
   benchmark's shingles. This is the only pass over the texts. The benchmark's shingles are
   broadcast in blocks of at most ``block`` (one pass each), so their size is bounded.
2. The matches are counted by shingle. Windows with a shingle that no document has are out. The
   prefix of the others is their rarest shingle; its matches propose window starts, of which those
   outside the document (positional bound) or longer than it (length bound) are dropped.
3. Proposed windows are verified: all their shingles, compared as words, must be matched at their
   places. Hit words are the union of the verified windows.

Only DataFrame functions are used. What is shuffled are matches, which grow with the shared
passages and not with the texts; frequent words alone propose nothing.

Edge cases: null and empty texts have no words and no hits; a null or empty item has no windows;
repeated documents get a row each; an item id that occurs on several texts counts once; null item
ids are left out of the list; empty tables give no hits or no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from activlake.llm.common import by_name, checkpointed, free_name, lower_ascii, once, table

WINDOW = 10
SHINGLE = 3
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def content_words(text: Column) -> Column:
    """Words of digits, letters a to z and everything beyond ASCII, in lower case."""
    # Lower-casing by table is slow; texts without any other letter that has a lower case need none.
    plain = ~text.rlike(r"[\p{Lu}\p{Lt}\p{Nl}\p{So}&&[^A-Z]]")
    lower = F.when(plain, F.lower(text)).otherwise(lower_ascii(text))
    return F.filter(F.split(F.coalesce(lower, F.lit("")), SEPARATORS), lambda w: w != "")


def shingles(words: str, size: int) -> str:
    """SQL for the shingles of an array of words, as texts."""
    parts = ", ".join(["x", *(f"{words}[i + {j}]" for j in range(1, size))])
    return (
        f"transform(slice({words}, 1, greatest(size({words}) - {size - 1}, 0)),"
        f" (x, i) -> concat_ws(' ', {parts}))"
    )


def item_windows(benchmark: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """Distinct windows: ``window_id``, their number of words ``n``, ``s`` shingles, ``items``."""
    items = once(
        benchmark.select(
            by_name(benchmark, item_id).cast("string").alias("item"),
            by_name(benchmark, text).alias("text"),
        ),
        w=content_words(F.col("text")),
    ).where(F.size("w") > 0)
    run = f"least({window}, size(w))"
    windows = items.select(
        "item", F.explode(F.expr(f"transform(sequence(0, size(w) - {run}), i -> slice(w, i + 1, {run}))")).alias("w")
    )
    windows = windows.groupBy("w").agg(F.collect_set("item").alias("items"))
    sized = F.expr(
        f"CASE WHEN size(w) >= {SHINGLE} THEN {shingles('w', SHINGLE)}"
        " ELSE array(array_join(w, ' ')) END"
    )
    windows = once(windows, s=sized).withColumn("window_id", F.monotonically_increasing_id())
    return checkpointed(windows.select("window_id", F.size("w").alias("n"), "s", "items"))


def _document_words(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    own = by_name(documents, doc_id)
    df = documents.select(own.alias("doc_id"), by_name(documents, text).alias("text"))
    return once(
        df.withColumn("t", F.xxhash64("doc_id", "text")), w=content_words(F.col("text"))
    ).select("doc_id", "t", "w")


#: The shingle number of the one row that every document has among its matches.
ROW = -1


def contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block: int = 500_000,
) -> DataFrame:
    """For each document ``doc_id``, its row hash ``t``, ``n_words``, ``spans`` (hit word ranges,
    end exclusive, merged) and ``items`` (ids of items with a window in it, sorted as texts)."""
    windows = item_windows(benchmark, item_id, item_text, window)
    placed = windows.select("window_id", "n", F.posexplode("s").alias("off", "s"))
    numbered = checkpointed(
        placed.select("s").distinct().withColumn("sid", F.monotonically_increasing_id())
    )
    placed = placed.join(numbered, "s").select("window_id", "n", "off", "sid")
    sizes = [
        r.k
        for r in windows.select(F.least("n", F.lit(SHINGLE)).alias("k")).distinct().collect()
    ]
    df = _document_words(documents, doc_id, text)
    blocks = max(1, -(-numbered.count() // block))
    found = None
    for number in range(blocks):
        part = numbered.where(F.pmod(F.xxhash64("sid"), F.lit(blocks)) == number)
        own = _lookup(df, part, sizes, with_rows=number == 0)
        found = own if found is None else found.union(own)
    found = checkpointed(found)
    rows = found.where(F.col("sid") == ROW).select("doc_id", "t", "n_words")
    hits = _verified(found.where(F.col("sid") != ROW), placed)
    described = _described(hits, windows)
    return (
        rows.alias("r")
        .join(
            described.alias("h"),
            (F.col("r.t") == F.col("h.t")) & F.col("r.doc_id").eqNullSafe(F.col("h.doc_id")),
            "left",
        )
        .select(
            "r.doc_id",
            "r.t",
            F.col("n_words").cast("long").alias("n_words"),
            F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
    )


def _lookup(df: DataFrame, part: DataFrame, sizes: list[int], with_rows: bool) -> DataFrame:
    """Benchmark shingles of one block with their places in documents.

    With ``with_rows`` every document adds one row of its own, so that its number of words comes
    from the same pass.
    """
    entries = [
        F.transform(
            F.expr(shingles("w", n)), lambda x, i: F.struct(x.alias("s"), i.cast("int").alias("at"))
        )
        for n in sizes
    ]
    if with_rows:
        entries.append(F.array(F.struct(F.lit("").alias("s"), F.lit(0).alias("at"))))
        part = part.union(part.sparkSession.range(1).select(F.lit(""), F.lit(ROW).cast("long")))
    elif not entries:
        entries.append(F.array().cast("array<struct<s:string,at:int>>"))
    return (
        df.select("doc_id", "t", F.size("w").alias("n_words"), F.inline(F.concat(*entries)))
        .join(F.broadcast(part), "s")  # at most one block of rows
        .select("doc_id", "t", "n_words", "at", "sid")
    )


def _verified(matches: DataFrame, placed: DataFrame) -> DataFrame:
    """Windows that documents contain: ``doc_id, t, start, n, window_id``."""
    matches = matches.distinct()  # repeated documents have equal matches
    counted = matches.groupBy("sid").agg(F.count(F.lit(1)).alias("seen"))
    ranked = placed.join(counted, "sid", "left").groupBy("window_id", "n").agg(
        F.count(F.lit(1)).alias("parts"),
        F.count("seen").alias("present"),
        F.min(F.struct("seen", "sid", "off")).alias("rarest"),
    )
    prefixes = ranked.where("present = parts").select(
        "window_id", "n", "parts", F.col("rarest.sid").alias("sid"), F.col("rarest.off").alias("off")
    )
    proposed = (
        matches.join(prefixes, "sid")
        .withColumn("start", F.col("at") - F.col("off"))
        .where("start >= 0 AND start + n <= n_words")
        .select("doc_id", "t", "start", "n", "window_id", "parts")
    )
    wanted = proposed.join(placed.select("window_id", "off", "sid"), "window_id").withColumn(
        "at", F.col("start") + F.col("off")
    )
    return (
        wanted.alias("p")
        .join(
            matches.alias("m"),
            (F.col("p.t") == F.col("m.t"))
            & F.col("p.doc_id").eqNullSafe(F.col("m.doc_id"))
            & (F.col("p.at") == F.col("m.at"))
            & (F.col("p.sid") == F.col("m.sid")),
            "left_semi",
        )
        .groupBy("doc_id", "t", "start", "n", "window_id", "parts")
        .agg(F.count(F.lit(1)).alias("matched"))
        .where("matched = parts")
        .select("doc_id", "t", "start", "n", "window_id")
    )


def _described(hits: DataFrame, windows: DataFrame) -> DataFrame:
    """Merged word ranges and the items of each document with hits."""
    items = hits.join(windows.select("window_id", F.explode("items").alias("item")), "window_id")
    merged = F.expr(
        "aggregate(array_sort(spans), CAST(array() AS array<struct<start:int,end:int>>), (m, x) ->"
        " CASE WHEN size(m) > 0 AND element_at(m, -1).end >= x.start"
        " THEN concat(slice(m, 1, size(m) - 1), array(named_struct('start', element_at(m, -1).start,"
        " 'end', greatest(element_at(m, -1).end, x.end))))"
        " ELSE concat(m, array(x)) END)"
    )
    spans = (
        hits.select("doc_id", "t", "start", (F.col("start") + F.col("n")).alias("end"))
        .groupBy("doc_id", "t")
        .agg(F.collect_set(F.struct("start", "end")).alias("spans"))
        .select("doc_id", "t", merged.alias("spans"))
    )
    named = (
        items.groupBy("doc_id", "t").agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    return (
        spans.alias("a")
        .join(
            named.alias("b"),
            (F.col("a.t") == F.col("b.t")) & F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")),
            "left",
        )
        .select("a.doc_id", "a.t", "spans", "items")
    )


def decontaminate(
    documents: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    **options,
) -> DataFrame:
    """The documents without those that hold a benchmark window."""
    found = contamination(documents, benchmark, doc_id=key, text=text, **options)
    bad_id, bad_row = free_name(documents, "bad_id"), free_name(documents, "bad_row")
    bad = found.where(F.size("spans") > 0).select(
        F.col("doc_id").alias(bad_id), F.col("t").alias(bad_row)
    )
    own = by_name(documents, key)
    row = F.xxhash64(own, by_name(documents, text))
    same = (row == F.col(bad_row)) & own.eqNullSafe(F.col(bad_id))
    return documents.join(bad.distinct(), same, "left_anti")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hit words and items of every document, over whole texts."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate(
        "spans", F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["start"]).cast("long")
    )
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


OP2_SQL = r"""
WITH words AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), item_words AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS x
  FROM (SELECT item, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
        FROM item_words WHERE len(w) > 0)
), grams AS (
  SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS x
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM words, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)
), hits AS (
  SELECT r, grams.n, i, item FROM grams JOIN windows ON grams.x = windows.x AND grams.n = windows.n
), places AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r
), named AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, item FROM hits WHERE item IS NOT NULL) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN places USING (r) LEFT JOIN named USING (r)
"""
