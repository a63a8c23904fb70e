"""Token counts of fields and sections by offset mapping.

The fields of a document are joined into one text and encoded once, as a model would read it.
Every token has a character span; the spans are joined to the sections' ranges, which tile the
text. A token inside one section counts for it. A token that crosses a boundary is allocated by an
explicit rule:

* ``majority``: to the section with most of its characters, the earlier one of equals;
* ``start``: to the section where it begins;
* ``split``: to all its sections, by their shares of its characters.

Under each rule the sections of a document add up to the document's tokens.

Both sides of the interval join belong to one document and are sorted, so the join is a merge
inside the row's task: nothing is shuffled, and a source with a third of all rows changes nothing.

Edge cases: a null or empty field has no characters and keeps its section, with zero tokens;
repeated rows are counted each; an empty table gives an empty result; columns that are not asked
for are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from activlake.llm.common import by_name, table
from activlake.llm.tokens import char_spans, encode, vocabulary_path

RULES = ("majority", "start", "split")
#: Sections that a task holds before it hands them on.
MOST_HELD = 200_000


def allocate(
    starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray, rule: str = "majority"
) -> np.ndarray:
    """Tokens of each section; section i is ``bounds[i]`` to ``bounds[i + 1]``.

    Sections without characters get none.
    """
    n = len(bounds) - 1
    first = np.searchsorted(bounds, starts, side="right") - 1
    last = np.searchsorted(bounds, ends - 1, side="right") - 1
    if rule == "start":
        return np.bincount(first, minlength=n).astype(float)
    whole = first == last
    counts = np.bincount(first[whole], minlength=n).astype(float)
    for t in np.flatnonzero(~whole):
        at = np.arange(first[t], last[t] + 1)
        inside = np.minimum(bounds[at + 1], ends[t]) - np.maximum(bounds[at], starts[t])
        if rule == "split":
            counts[at] += inside / (ends[t] - starts[t])
        else:
            counts[at[np.argmax(inside)]] += 1
    return counts


def section_bounds(texts: Sequence[str], by_line: bool) -> tuple[list[int], list[int]]:
    """Bounds of the sections of joined fields and the field of each section.

    A field is one section, or each of its lines is; a line feed belongs to the line before it.
    """
    bounds, owner, at = [0], [], 0
    for number, text in enumerate(texts):
        lines = text.split("\n") if by_line else [text]
        for i, line in enumerate(lines):
            at += len(line) + (by_line and i < len(lines) - 1)
            bounds.append(at)
            owner.append(number)
    return bounds, owner


def count_tokens(
    documents: DataFrame,
    key: str = "doc_id",
    fields: Sequence[str] = ("text",),
    by_line: bool = True,
    rule: str = "majority",
    vocabulary: str | None = None,
) -> DataFrame:
    """One row for each section: ``doc_id``, ``field``, ``section`` (from 0 within the document),
    ``start`` and ``end`` (characters of the joined fields) and ``n_tokens``."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    path = vocabulary or vocabulary_path()
    names = list(fields)
    number = T.DoubleType() if rule == "split" else T.LongType()

    given = documents.select(
        by_name(documents, key).alias("doc_id"),
        *(by_name(documents, f).cast("string").alias(f"f{i}") for i, f in enumerate(names)),
    )
    schema = T.StructType(
        [
            T.StructField("doc_id", given.schema["doc_id"].dataType),
            T.StructField("field", T.StringType()),
            T.StructField("section", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
            T.StructField("n_tokens", T.DoubleType()),
        ]
    )

    def rows_of(ids: pa.Array, rows: list[tuple]) -> pa.RecordBatch:
        sizes = [len(owner) for _, owner, _, _ in rows]
        places = np.repeat(np.array([r[0] for r in rows], dtype=np.int64), sizes)
        columns = [
            ids.take(pa.array(places)),  # ids never leave Arrow: nulls and wide numbers stay exact
            pa.array([names[i] for r in rows for i in r[1]], pa.string()),
            pa.array([i for n in sizes for i in range(n)], pa.int32()),
            pa.array([b for r in rows for b in r[2][:-1]], pa.int64()),
            pa.array([b for r in rows for b in r[2][1:]], pa.int64()),
            pa.array(np.concatenate([np.zeros(0), *(r[3] for r in rows)])),
        ]
        return pa.RecordBatch.from_arrays(columns, names=schema.names)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            columns = (batch.column(1 + i).to_pylist() for i in range(len(names)))
            for place, given_texts in enumerate(zip(*columns, strict=True)):
                texts = [t or "" for t in given_texts]
                text = "".join(texts)
                bounds, owner = section_bounds(texts, by_line)
                counts = np.zeros(len(owner))
                if text:
                    starts, ends = char_spans(text, encode(text, path), path)
                    counts = allocate(starts, ends, np.array(bounds), rule)
                rows.append((place, owner, bounds, counts))
                held += len(owner)
                if held > MOST_HELD:
                    yield rows_of(batch.column(0), rows)
                    rows, held = [], 0
            yield rows_of(batch.column(0), rows)

    counted = given.mapInArrow(count, schema)
    return counted.withColumn("n_tokens", F.col("n_tokens").cast(number))


def totals(sections: DataFrame, *by: str) -> DataFrame:
    """Tokens and sections by the given columns; partial sums are made before the shuffle."""
    return sections.groupBy(*by).agg(
        F.sum("n_tokens").alias("n_tokens"), F.count(F.lit(1)).alias("n_sections")
    )


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document."""
    return count_tokens(table(spark, sf_dir, "documents"))
