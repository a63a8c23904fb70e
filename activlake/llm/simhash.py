"""SimHash near-duplicates with pigeonring candidate filtering.

A text's fingerprint has the bits that more than half of its shingle hashes have. Documents with
equal fingerprints are one node, so that a group of copies costs one row from there on.

The 64 bits form a ring of ``segments``. If two fingerprints differ in at most ``t`` bits, there is
a segment from which every chain of ``l`` consecutive segments differs in at most ``l * t /
segments`` bits. The first chains must then be equal, which gives the join keys (one for each start
of the ring); the longer chains prune the pairs before the full Hamming distance is taken.

Buckets with up to ``dense`` fingerprints join their pairs. Fuller buckets, as groups of near
copies make them, are never expanded into pairs: their fingerprints are linked exactly through
shared points. Two fingerprints within ``t`` bits have a point within ``t // 2`` bits of one and
``t - t // 2`` of the other, and fingerprints that share such a point are within ``t`` bits.

Components of the links are found in rounds of joins; nothing is collected.

Edge cases: a null, empty or blank text has fingerprint zero and links like any other; texts with
fewer words than a shingle hash their whole word sequence; repeated rows and ids give repeated
results; a component whose ids are all null has a null id; an empty table gives an empty result;
other columns are ignored by ``fingerprints`` and kept by ``deduplicate``, which names a row by its id
and two hashes of all its columns, so that rows of one id with different texts stay apart.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from activlake.llm.common import all_of, by_name, checkpointed, free_name, table
from activlake.llm.components import components

BITS = 64
SEED = 42


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The fingerprint of a text as a signed 64-bit number."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A to Z only
    if not words:
        return 0
    if len(words) < shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False)))
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(shingles), 32_768):
        hashes = [xxhash.xxh64_intdigest(s, SEED) for s in shingles[at : at + 32_768]]
        octets = np.array(hashes, dtype=">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(shingles))
    return int(bits.view(">i8")[0])


def fingerprints(
    documents: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3
) -> DataFrame:
    """``doc_id`` and ``fp`` of every document."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return documents.select(
        by_name(documents, key).alias("doc_id"), of(by_name(documents, text)).alias("fp")
    )


def _signed(bits: int) -> int:
    return bits - (1 << BITS) if bits >> (BITS - 1) else bits


def ring_masks(segments: int) -> list[list[int]]:
    """For each start, the bits of its chains of 1, 2, ... segments."""
    edges = [BITS * i // segments for i in range(segments + 1)]
    own = [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(edges, edges[1:], strict=False)]
    chains = []
    for start in range(segments):
        masks, held = [], 0
        for i in range(segments):
            held |= own[(start + i) % segments]
            masks.append(_signed(held))
        chains.append(masks)
    return chains


def links(fps: DataFrame, distance: int = 2, segments: int = 7, dense: int = 64) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints ``fp`` that connect all within ``distance``.

    Pairs of sparse buckets are linked directly, fingerprints of dense ones through the smallest
    fingerprint at each shared point.
    """
    if not 1 <= distance < segments:
        raise ValueError("the ring needs more segments than differing bits")
    chains = ring_masks(segments)
    equal = -(-segments // distance) - 1  # chains of so many segments may not differ at all
    fp = F.col("fp")
    keys = fps.select(
        "fp",
        F.inline(
            F.array(
                *(
                    F.struct(
                        F.lit(start).alias("start"),
                        fp.bitwiseAND(F.lit(masks[equal - 1])).alias("key"),
                    )
                    for start, masks in enumerate(chains)
                )
            )
        ),
    )
    filled = keys.groupBy("start", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = checkpointed(keys.join(filled, ["start", "key"]))
    sparse, full = members.where(F.col("n") <= dense), members.where(F.col("n") > dense)

    differing = F.col("a").bitwiseXOR(F.col("b"))
    within = F.lit(False)
    for start, masks in enumerate(chains):
        budget = [
            F.bit_count(differing.bitwiseAND(F.lit(masks[n - 1]))) <= n * distance // segments
            for n in range(equal + 1, segments)
        ]
        within = within | ((F.col("start") == start) & all_of(budget))
    side = sparse.select("start", "key", F.col("fp").alias("a"))
    other = sparse.select("start", "key", F.col("fp").alias("b"))
    pairs = (
        side.join(other, ["start", "key"])
        .where((F.col("a") < F.col("b")) & within & (F.bit_count(differing) <= distance))
        .select("a", "b")
    )
    return pairs.union(_dense_links(full.select("fp").distinct(), distance)).distinct()


def _dense_links(fps: DataFrame, distance: int) -> DataFrame:
    """Link fingerprints through points of the space that lie between them."""
    near, far = distance // 2, distance - distance // 2
    points = fps.select("fp", F.col("fp").alias("point"))
    flips = [F.lit(0).cast("long"), *(F.lit(_signed(1 << b)) for b in range(BITS))]
    for _ in range(far):
        points = points.select(
            "fp", F.explode(F.array(*(F.col("point").bitwiseXOR(x) for x in flips))).alias("point")
        )
    if far > 1:
        points = points.distinct()
    off: Column = F.bit_count(F.col("fp").bitwiseXOR(F.col("point")))
    shared = (
        points.groupBy("point")
        .agg(
            F.min("fp").alias("a"),
            F.max("fp").alias("most"),
            F.max(off <= near).alias("linked"),
        )
        .where("linked AND a < most")
    )
    return (
        points.join(shared, "point").select("a", F.col("fp").alias("b")).where("a < b").distinct()
    )


def _rooted(nodes: DataFrame, distance: int, segments: int, dense: int) -> DataFrame:
    """The rows of ``nodes`` (one for each ``fp``) with the ``root`` of their component."""
    roots = components(links(nodes.select("fp"), distance, segments, dense))
    rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left")
    return rooted.select(*(nodes[c] for c in nodes.columns), F.coalesce("root", "fp").alias("root"))


def near_duplicates(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = 3,
    distance: int = 2,
    segments: int = 7,
    dense: int = 64,
) -> DataFrame:
    """``doc_id, fp, component_id`` of every document."""
    rows = checkpointed(fingerprints(documents, key, text, shingle))
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    rooted = _rooted(nodes, distance, segments, dense)
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def _row_hashes(df: DataFrame) -> tuple[Column, Column]:
    """Two hashes of a whole row; maps, which have no order, are hashed as text."""
    columns = [
        by_name(df, f.name).cast("string") if "map<" in f.dataType.simpleString() else by_name(df, f.name)
        for f in df.schema
    ]
    return F.xxhash64(*columns), F.xxhash64(F.lit(7), *columns)


def deduplicate(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = 3,
    distance: int = 2,
    segments: int = 7,
    dense: int = 64,
) -> DataFrame:
    """One document of each component of near-duplicates: the one with the smallest id.

    Of several rows with that id the one with the smallest row hashes stays, and of rows that are
    equal in every column a single one. A row without id cannot be named as a survivor: such rows
    stay, their exact repeats go.
    """
    names = {n: free_name(documents, n) for n in ("kept_id", "h1", "h2", "row_copies")}
    h1, h2 = _row_hashes(documents)

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    rows = checkpointed(
        documents.select(
            by_name(documents, key).alias("id"),
            h1.alias("h1"),
            h2.alias("h2"),
            of(by_name(documents, text)).alias("fp"),
        )
        .groupBy("id", "h1", "h2", "fp")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    named = F.when(F.col("id").isNotNull(), F.struct("id", "h1", "h2", "n"))
    rooted = _rooted(rows.groupBy("fp").agg(F.min(named).alias("best")), distance, segments, dense)
    best = rooted.groupBy("root").agg(F.min("best").alias("best")).where("best IS NOT NULL")
    survivors = checkpointed(
        best.select("best.*").union(rows.where("id IS NULL").select("id", "h1", "h2", "n"))
    )
    kept = survivors.select(
        F.col("id").alias(names["kept_id"]),
        F.col("h1").alias(names["h1"]),
        F.col("h2").alias(names["h2"]),
        F.col("n").alias(names["row_copies"]),
    )
    found = documents.join(
        kept,
        (h1 == F.col(names["h1"]))
        & (h2 == F.col(names["h2"]))
        & by_name(documents, key).eqNullSafe(F.col(names["kept_id"])),
    )
    copies = F.col(names["row_copies"])
    single = found.where(copies == 1).drop(*names.values())
    if survivors.where("n > 1").isEmpty():
        return single
    # Survivors that stand more than once are rare; of them one row each is numbered and kept.
    repeated = found.where(copies > 1).drop(names["row_copies"], names["kept_id"])
    row = F.struct(*(by_name(repeated, c) for c in documents.columns)).alias("row")
    one = repeated.groupBy(names["h1"], names["h2"]).agg(F.first(row).alias("row"))
    return single.unionByName(one.select("row.*"))


def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document, at two differing bits or fewer."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
