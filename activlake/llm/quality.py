"""Quality rules as a bitmask ledger.

Every rule is evaluated once for each document. The ledger stores the measurements and one integer
whose bits are the failed rules; policies are masks over these bits, so that a new policy version
or an ablation reads the ledger alone and never the texts.

Only DataFrame and SQL functions are used. All work on a text stays in its row, nothing is
shuffled: repeated 3-word windows are found by sorting, inside the row, one number per window
that joins the window's hash with its position. Windows with equal hashes are compared word by
word; if two of them differ (a hash collision), the row sorts the windows themselves instead.

Edge cases: a null, empty or blank text has no words and fails the base; repeated rows are measured
each; other columns are kept out of the ledger unless asked for in ``keep``; an empty table gives
an empty ledger.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from activlake.llm.common import SPACE_CLASS, by_name, once, table, words


@dataclass(frozen=True)
class Rule:
    """A named failure condition over the measurements."""

    name: str
    fails: Callable[[Mapping[str, Column]], Column]


#: The position of a rule is its bit; append new rules, never reorder.
RULES = (
    Rule("too_few_words", lambda m: m["n_words"] < 50),
    Rule("repeated_words", lambda m: 100 * m["n_repeat_words"] > 50 * m["n_words"]),
    Rule("symbols", lambda m: 10 * m["n_symbols"] > m["n_words"]),
    Rule("capitals", lambda m: 10 * m["n_capitals"] > 4 * m["n_letters"]),
    Rule("repeated_lines", lambda m: 2 * m["n_dup_lines"] > m["n_lines"]),
    Rule(
        "word_length",
        lambda m: (m["word_chars"] < 2 * m["n_words"]) | (m["word_chars"] > 20 * m["n_words"]),
    ),
    Rule("letters", lambda m: 2 * m["n_letters"] < m["word_chars"]),
)
MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_lines",
    "n_dup_lines",
    "n_repeat_words",
    "n_letters",
    "n_capitals",
)


def mask(*names: str) -> int:
    """Bits of the named rules."""
    order = [r.name for r in RULES]
    return sum(1 << order.index(n) for n in names)


BASE = mask("too_few_words", "repeated_words")
#: Policy versions: a document is kept if none of the policy's rules failed.
POLICIES = {
    "base": BASE,
    "v1": BASE | mask("symbols", "capitals", "repeated_lines"),
    "v2": (1 << len(RULES)) - 1,
}


def _pieces_removed(text: Column, pattern: str) -> Column:
    """How many characters of the text the pattern covers."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _repeat_words(df: DataFrame) -> DataFrame:
    """Add ``n_repeat_words`` to a table with the array column ``w``."""
    df = once(
        df,
        bits=F.expr("CAST(ceil(log2(size(w) + 1)) AS INT)"),
        m=F.expr("greatest(size(w) - 2, 0)"),
    )
    keys = "transform(slice(w, 1, m), (x, i) -> shiftleft(xxhash64(x, w[i + 1], w[i + 2]), bits) | i)"
    df = once(df, k=F.expr(f"sort_array({keys})"))
    same = "shiftright(x, bits) = shiftright(get(k, i {}), bits)"
    df = once(
        df.withColumn("low", F.expr("shiftleft(1L, bits) - 1")),
        hits=F.expr(f"filter(k, (x, i) -> {same.format('- 1')} OR {same.format('+ 1')})"),
    )
    at, before = "CAST(x & low AS INT)", "CAST(hits[i - 1] & low AS INT)"
    differ = " OR ".join(f"w[{at} + {j}] != w[{before} + {j}]" for j in range(3))
    df = once(
        df,
        collided=F.expr(
            "exists(transform(hits, (x, i) -> i > 0 AND"
            f" shiftright(x, bits) = shiftright(hits[i - 1], bits) AND ({differ})), b -> b)"
        ),
    )
    exact = (
        "sort_array(transform(slice(w, 1, m), (x, i) ->"
        " struct(concat_ws(' ', x, w[i + 1], w[i + 2]) AS s, CAST(i AS BIGINT) AS p)))"
    )
    df = once(df, e=F.when(F.col("collided"), F.expr(exact)))
    df = once(
        df,
        places=F.when(
            F.col("collided"),
            F.expr(
                "sort_array(transform(filter(e, (x, i) ->"
                " x.s <=> get(e, i - 1).s OR x.s <=> get(e, i + 1).s), x -> x.p))"
            ),
        ).otherwise(F.expr("sort_array(transform(hits, x -> x & low))")),
    )
    reach = "transform(places, (x, i) -> coalesce(least(get(places, i + 1) - x, 3L), 3L))"
    return df.withColumn("n_repeat_words", F.expr(f"aggregate({reach}, 0L, (a, b) -> a + b)"))


def ledger(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: Iterable[str] = ()
) -> DataFrame:
    """One row for each document: ``doc_id``, the measurements, ``failed_bits`` and ``keep``."""
    df = documents.select(
        by_name(documents, doc_id).alias("doc_id"),
        F.coalesce(by_name(documents, text), F.lit("")).alias("t"),
        F.struct(F.lit(0).alias("_"), *(by_name(documents, c) for c in keep)).alias("kept"),
    )
    df = once(
        df,
        w=words(F.col("t")),
        lines=F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
    )
    df = once(
        _repeat_words(df).select("doc_id", "t", "kept", "w", "lines", "n_repeat_words"),
        letters=F.regexp_replace("t", r"\P{L}+", ""),
    )
    long = {
        "n_words": F.size("w"),
        "word_chars": F.length(F.array_join("w", "")),
        "n_symbols": _pieces_removed(F.col("t"), r"[#*$%&|<>]+"),
        "n_lines": F.size("lines"),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_letters": F.length("letters"),
        "n_capitals": _pieces_removed(F.col("letters"), r"\p{Lu}+"),
    }
    df = df.select(
        "doc_id",
        *(
            (long[m] if m in long else F.col(m)).cast("long").alias(m)
            for m in MEASURES
        ),
        *(F.col(f"kept.`{c}`").alias(c) for c in keep),
    )
    measured = {m: F.col(m) for m in MEASURES}
    bits = sum(
        (F.when(r.fails(measured), 1 << i).otherwise(0) for i, r in enumerate(RULES)), F.lit(0)
    )
    return df.withColumn("failed_bits", bits.cast("long"))


def passes(policy: str | int, bits: Column | None = None) -> Column:
    """Whether a ledger row passes a policy, given by name or as a mask."""
    rules = POLICIES[policy] if isinstance(policy, str) else policy
    return (F.col("failed_bits") if bits is None else bits).bitwiseAND(F.lit(rules)) == 0


def ablations(rows: DataFrame, policies: Mapping[str, int] = POLICIES) -> DataFrame:
    """For each policy and each of its rules, documents kept with and without the rule.

    The ledger is first counted by ``failed_bits`` (at most 2 to the number of rules), so that the
    shuffle carries counts only. ``removed_alone`` counts documents that only this rule removes;
    ``ever_failed`` tells whether the rule failed at all.
    """
    cases = [
        F.struct(
            F.lit(p).alias("policy"),
            F.lit(m).cast("long").alias("mask"),
            F.lit(r.name).alias("rule"),
            F.lit(1 << i).cast("long").alias("bit"),
        )
        for p, m in policies.items()
        for i, r in enumerate(RULES)
        if m >> i & 1
    ]
    bits, without = F.col("failed_bits"), F.col("mask").bitwiseXOR(F.col("bit"))
    counted = rows.groupBy("failed_bits").agg(F.count(F.lit(1)).alias("n"))
    return (
        counted.select("failed_bits", "n", F.inline(F.array(*cases)))
        .groupBy("policy", "rule")
        .agg(
            F.sum("n").alias("documents"),
            F.sum(F.when(bits.bitwiseAND(F.col("mask")) == 0, F.col("n")).otherwise(0)).alias(
                "kept"
            ),
            F.sum(F.when(bits.bitwiseAND(without) == 0, F.col("n")).otherwise(0)).alias(
                "kept_without"
            ),
            F.bit_or(bits.bitwiseAND(F.col("bit"))).alias("seen"),
        )
        .select(
            "policy",
            "rule",
            "documents",
            "kept",
            "kept_without",
            (F.col("kept_without") - F.col("kept")).alias("removed_alone"),
            (F.col("seen") != 0).alias("ever_failed"),
        )
    )


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of all documents with the verdicts of the base and of the newest policy."""
    base, kept = ~passes("base"), passes("v2")
    return ledger(table(spark, sf_dir, "documents")).select(
        "*", base.alias("base_failed"), (~base & kept).alias("kept")
    )


OP5_SQL = r"""
WITH given AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), cut AS (
  SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
    length(regexp_replace(t, '\P{L}', '', 'g')) AS n_letters,
    length(regexp_replace(t, '\P{Lu}', '', 'g')) AS n_capitals
  FROM given
), windows AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS x
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM cut)
), repeated AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, x) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT r, count(DISTINCT i + j) AS n FROM repeated, (SELECT unnest([0, 1, 2]) AS j) GROUP BY r
), measured AS (
  SELECT doc_id, len(w) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(covered.n, 0) AS n_repeat_words, n_letters, n_capitals
  FROM cut LEFT JOIN covered USING (r)
), judged AS (
  SELECT *, CAST((n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT
    + 4 * (10 * n_symbols > n_words)::INT + 8 * (10 * n_capitals > 4 * n_letters)::INT
    + 16 * (2 * n_dup_lines > n_lines)::INT
    + 32 * (word_chars < 2 * n_words OR word_chars > 20 * n_words)::INT
    + 64 * (2 * n_letters < word_chars)::INT AS BIGINT) AS failed_bits
  FROM measured
)
SELECT *, failed_bits & 3 != 0 AS base_failed, failed_bits = 0 AS kept FROM judged
"""
