"""Connected components of a link table, as Spark joins and groupings."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from activlake.llm.common import checkpointed

#: Links that a task contracts at once.
BLOCK = 200_000


def contract(links: list[tuple[int, int]]) -> dict[int, int]:
    """For every node of some links but the smallest of its component, that smallest node."""
    above: dict[int, int] = {}

    def root(node: int) -> int:
        while (up := above.get(node, node)) != node:
            above[node] = node = above.get(up, up)  # halve the path
        return node

    for a, b in links:
        a, b = root(a), root(b)
        if a != b:
            above[max(a, b)] = min(a, b)
    return {node: root(node) for node in list(above)}


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    links: list[tuple[int, int]] = []
    for batch in batches:
        links += zip(batch.column("v").to_pylist(), batch.column("u").to_pylist(), strict=True)
    found = contract(links)
    if found:
        columns = [pa.array(found.keys(), pa.int64()), pa.array(found.values(), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["v", "u"])


def components(links: DataFrame, max_rounds: int = 100, block: int = BLOCK) -> DataFrame:
    """``node, root`` for every node of the links ``a, b``; the root is the smallest node.

    Each round deals the links out in blocks of at most about ``block`` and contracts each to stars
    within its task. Where there are several blocks, it then hangs the neighbours of every node on
    the smallest of them, first the larger ones and then the smaller ones, until the links are stars:
    every node is linked to one smaller node, which is linked to no smaller one. Minima are combined
    before the shuffle, so a node with very many links sends one row per task; the round's links are
    checkpointed.
    """
    links = checkpointed(
        links.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u"))
        .where("u < v")
        .distinct()
    )
    for _ in range(max_rounds):
        blocks = math.ceil(links.count() / block)
        if blocks > 1:
            both = links.select("v", "u").union(links.select(F.col("u"), F.col("v"))).toDF("x", "y")
            node = both.groupBy("x").agg(
                F.count_if(F.col("y") < F.col("x")).alias("smaller"),
                F.count_if(F.col("y") > F.col("x")).alias("larger"),
            )
            tangled = node.agg(F.count_if(F.expr("smaller > 1 OR smaller = 1 AND larger > 0"))).first()[0]
        else:
            tangled = blocks
        if not tangled:
            break
        links = links.repartition(blocks).mapInArrow(_contracted, "v long, u long")
        if blocks == 1:
            links = checkpointed(links)
            break
        links = checkpointed(links.distinct())
        both = links.select("v", "u").union(links.select(F.col("u"), F.col("v"))).toDF("x", "y")
        least = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"))
        large = (
            both.where("y > x").join(least, "x").select(F.col("y").alias("v"), F.col("m").alias("u"))
        ).where("u < v")
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        links = checkpointed(
            large.join(least, "v")
            .select(F.explode(F.array("v", "u")).alias("v"), F.col("m").alias("u"))
            .where("u < v")
            .distinct()
        )
    else:
        raise RuntimeError(f"links did not settle within {max_rounds} rounds")
    return links.select(F.col("v").alias("node"), F.col("u").alias("root")).union(
        links.select(F.col("u"), F.col("u")).distinct()
    )
