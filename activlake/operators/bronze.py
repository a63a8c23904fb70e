"""Change envelopes to Bronze rows. The same transform serves batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from activlake.functions.casting import micros_timestamp
from activlake.functions.json import decode
from activlake.functions.timing import duration_seconds
from activlake.schemas import CDC_ENVELOPE

DAY = "jour_debut"


def decode_envelopes(messages: DataFrame) -> DataFrame:
    """Row images after the change. Deletes, tombstones and broken JSON have no id and drop out."""
    envelopes = decode(messages, F.col("value").cast("string"), CDC_ENVELOPE)
    return envelopes.select("payload.after.*").filter(F.col("id").isNotNull())


def to_bronze(messages: DataFrame) -> DataFrame:
    """Inserts, updates and snapshots alike are appended as rows, with their duration."""
    return decode_envelopes(messages).withColumn(
        "duration_sec", duration_seconds(F.col("date_debut"), F.col("date_fin"))
    )


def with_start_day(bronze: DataFrame) -> DataFrame:
    """Add the start day, the partition column of large Bronze and Silver tables."""
    return bronze.withColumn(DAY, F.to_date(micros_timestamp(F.col("date_debut"))))
