"""Rules kept as a table with validity dates, in place of literals in a plan.

A rule table has a key, ``valid_from`` (inclusive; null: since ever), ``valid_to`` (exclusive; null:
open) and any other columns, which are what the rule says. Of the rules of a key the one that began
last by a row's day counts, and it replaces all earlier ones for good: once it has ended, the key has no
rule until the next one begins. Rules of one key that begin together: the one that ends last, then the
largest in its other columns. A row whose key has no rule that day takes the default key's.

What a rule says depends on key and day alone, so rules meet the distinct pairs of the rows (combined in
the map tasks, one row a task for a hot key) in one ordered pass per key, and not the rows in a range join.
The rows then join the pairs by equality; Spark broadcasts them while its size check allows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_KEY = "DEFAULT"
OWN, DEFAULT = "own", "default"


def rules_by_day(pairs: DataFrame, rules: DataFrame, key: str) -> DataFrame:
    """``key, day, said``: what the key's own rule says for each distinct pair that has one."""
    says = [c for c in rules.columns if c not in (key, "valid_from", "valid_to")]
    versions = (
        rules.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("key"), F.col("valid_from").alias("day"))
        .agg(
            F.max(
                F.struct(
                    F.col("valid_to").isNull().alias("open"),
                    F.col("valid_to").alias("ends"),
                    F.struct(*says).alias("said"),
                )
            ).alias("rule")
        )
    )
    marks = versions.withColumn("asked", F.lit(False)).unionByName(
        pairs.withColumn("asked", F.lit(True)), allowMissingColumns=True
    )
    # A rule precedes the questions of its first day; one since ever precedes all.
    until_now = Window.partitionBy("key").orderBy(F.col("day").asc_nulls_first(), "asked")
    last = F.last("rule", ignorenulls=True).over(until_now.rowsBetween(Window.unboundedPreceding, 0))
    return (
        marks.withColumn("rule", last)
        .where(F.col("asked") & (F.col("rule.open") | (F.col("day") < F.col("rule.ends"))))
        .select("key", "day", F.col("rule.said").alias("said"))
    )


def with_dated_rule(
    rows: DataFrame,
    rules: DataFrame,
    key: Column,
    day: Column,
    rule_key: str = "key",
    default_key: str = DEFAULT_KEY,
    name: str = "rule",
) -> DataFrame:
    """Rows with ``name``, the other columns of their rule as a struct, and ``<name>_level``, which is
    ``own``, ``default`` or null. A null key has the default rule; a null day has none. No row is lost
    or multiplied, whatever repeats in either table."""
    asked = [f"{name}_asked_key", f"{name}_asked_day"]
    given = rows.withColumns({asked[0]: key.cast("string"), asked[1]: day.cast("date")})
    pairs = given.select(F.col(asked[0]).alias("key"), F.col(asked[1]).alias("day")).distinct()
    dated = pairs.where("day IS NOT NULL")
    wanted = (
        dated.where("key IS NOT NULL")
        .union(dated.select(F.lit(default_key).alias("key"), "day"))
        .distinct()
    )
    found = rules_by_day(wanted, rules.withColumn(rule_key, F.col(rule_key).cast("string")), rule_key)
    own = found.withColumn("level", F.when(F.col("key") == default_key, DEFAULT).otherwise(OWN))
    default = found.where(F.col("key") == default_key).select("day", F.col("said").alias("otherwise"))
    table = (
        pairs.join(own, ["key", "day"], "left")
        .join(default, "day", "left")
        .select(
            F.col("key").alias("of_key"),
            F.col("day").alias("of_day"),
            F.coalesce("said", "otherwise").alias(name),
            F.coalesce(
                F.col("level"), F.when(F.col("otherwise").isNotNull(), DEFAULT)
            ).alias(f"{name}_level"),
        )
    )
    same = F.col(asked[0]).eqNullSafe(F.col("of_key")) & F.col(asked[1]).eqNullSafe(F.col("of_day"))
    return given.join(table, same, "left").drop(*asked, "of_key", "of_day")
