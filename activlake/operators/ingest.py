"""Validation and storage form of posted activities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from activlake.functions.casting import bigint, integer, number
from activlake.schemas import ACTIVITES, INGEST_BODY, INGEST_REQUIRED

# The answers of the endpoint, here and in the checks below.
STORED = "activity stored"
REPEATED = "Duplicate key: id"


def _first_missing() -> Column:
    """First required key, in order, that the body lacks. A key with a null value is present."""
    keys = F.col("_keys")
    return F.coalesce(
        F.when(keys.isNull(), F.lit("Invalid body")),
        *[
            F.when(~F.array_contains(keys, name), F.lit(f"Missing field: {name}"))
            for name in INGEST_REQUIRED
        ],
    )


def _typed(name: str) -> Column:
    """The value of a key in the type of the activity table."""
    text, wanted = F.col(f"_body.{name}"), ACTIVITES[name].dataType.simpleString()
    readers = {"int": integer, "bigint": bigint, "double": number}
    return readers[wanted](text) if wanted in readers else text.try_cast(wanted)


def _first_refused() -> Column:
    """First value the activity table cannot hold."""
    nulls = [
        F.when(F.col(f"_body.{name}").isNull(), F.lit(f"Null value: {name}"))
        for name in INGEST_REQUIRED
        if not ACTIVITES[name].nullable
    ]
    unreadable = [
        F.when(
            F.col(f"_body.{name}").isNotNull() & _typed(name).isNull(),
            F.lit(f"Invalid value: {name}"),
        )
        for name in INGEST_REQUIRED
        if ACTIVITES[name].dataType.simpleString() != "string"
    ]
    return F.coalesce(*nulls, *unreadable)


def _judged(bodies: DataFrame) -> DataFrame:
    """Bodies with their keys, decoded values and the first problem, each JSON text read once."""
    parts = F.struct(
        F.json_object_keys("body").alias("_keys"),
        F.from_json("body", INGEST_BODY).alias("_body"),
    )
    decoded = bodies.select("*", F.inline(F.array(parts)))
    return decoded.withColumn("_problem", F.coalesce(_first_missing(), _first_refused()))


def validate(bodies: DataFrame) -> DataFrame:
    """Add ``status`` and ``message`` to JSON ``body`` rows."""
    problem = F.col("_problem")
    answers = {
        "status": F.when(problem.isNull(), F.lit("ok")).otherwise(F.lit("error")),
        "message": F.coalesce(problem, F.lit(STORED)),
    }
    return _judged(bodies).withColumns(answers).drop("_keys", "_body", "_problem")


def _activity() -> list[Column]:
    """Columns of the activity table, from the decoded body."""

    def given(name: str, value: Column, default: str | float) -> Column:
        return F.when(F.array_contains("_keys", name), value).otherwise(F.lit(default))

    return [
        F.col("id").try_cast("bigint").alias("id"),
        _typed("id_salarie").alias("id_salarie"),
        _typed("type_sport").alias("type_sport"),
        given("distance", _typed("distance"), 0.0).alias("distance"),
        F.lit(None).cast("int").alias("duration_sec"),
        _typed("date_debut").alias("date_debut"),
        _typed("date_fin").alias("date_fin"),
        given("commentaire", F.col("_body.commentaire"), "").alias("commentaire"),
        F.current_timestamp().alias("created_at"),
    ]


def stored_rows(bodies: DataFrame) -> DataFrame:
    """Accepted bodies as activity-table rows.

    ``id`` comes with the input (its offset or sequence number): a gap-free
    counter would need a single writer. The duration is not stored; Bronze
    derives it from the dates.
    """
    return _judged(bodies).filter(F.col("_problem").isNull()).select(*_activity())


def judged(bodies: DataFrame) -> DataFrame:
    """Bodies with ``status``, ``message``, their activity ``row`` and a unique ``arrival`` number.

    Everything a later step needs, so that a stored copy is read instead of parsing again. A body
    without a usable id has no key and is refused.
    """
    rows = _judged(bodies)
    keyless = F.when(F.col("id").try_cast("bigint").isNull(), F.lit("Null value: id"))
    problem = F.coalesce("_problem", keyless)
    return rows.withColumns(
        {
            "status": F.when(problem.isNull(), F.lit("ok")).otherwise(F.lit("error")),
            "message": F.coalesce(problem, F.lit(STORED)),
            "row": F.when(problem.isNull(), F.struct(*_activity())),
            "arrival": F.monotonically_increasing_id(),
        }
    ).drop("_keys", "_body", "_problem")
