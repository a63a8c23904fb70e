"""Change envelopes to notification rows. The same transform serves batch and stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from activlake.functions.distance import metres_to_km
from activlake.functions.json import decode
from activlake.functions.messages import pick_template, render
from activlake.functions.text import label, name_from_comment
from activlake.functions.timing import minutes_between, parse_event_date
from activlake.schemas import NOTIFY_AFTER, NOTIFY_ENVELOPE


def _first_given(*columns: str, default: str, missing: tuple[str, ...] = ("",)) -> Column:
    """First value that is neither null nor one of the ``missing`` texts."""
    given = [F.when(~F.col(f"`{c}`").isin(*missing), F.col(f"`{c}`")) for c in columns]
    return F.coalesce(*given, F.lit(default))


def row_images(messages: DataFrame) -> DataFrame:
    """Non-empty row images after the change; deletes, tombstones and broken JSON drop out.

    An image with no field this table knows may still have others, so only then
    is the text looked at again.
    """
    text = F.col("value").cast("string")
    envelopes = decode(messages, text, NOTIFY_ENVELOPE, "value")
    known = F.coalesce(*[F.col(f"payload.after.`{f.name}`").cast("string") for f in NOTIFY_AFTER])
    other = F.get_json_object(text, "$.payload.after") != "{}"
    present = F.col("payload.after").isNotNull() & (known.isNotNull() | other)
    return envelopes.filter(present).select("payload.after.*")


def to_notifications(messages: DataFrame) -> DataFrame:
    """One message per change event."""
    rows = row_images(messages)
    start = parse_event_date(
        _first_given("Date de début de l'activité", "date_debut", default="")
    )
    end = parse_event_date(_first_given("Date de fin de l'activité", "date_fin", default=""))
    employee = _first_given(
        "id salarié", "id_salarie", default="inconnu", missing=("", "0")
    )
    facts = rows.select(
        "id",
        employee.alias("id_salarie"),
        label(_first_given("type", "type_sport", default="UNKNOWN")).alias("type_sport"),
        "commentaire",
        metres_to_km(F.col("distance")).alias("distance_km"),
        minutes_between(start, end).alias("duration_min"),
    )
    named = facts.withColumn(
        "nom", name_from_comment(F.col("commentaire"), F.col("id_salarie"))
    ).drop("commentaire")
    template = pick_template(F.col("type_sport"), F.col("id"))
    message = render(
        template, F.col("nom"), F.col("type_sport"), F.col("distance_km"), F.col("duration_min")
    )
    return named.select(
        "id", "id_salarie", "type_sport", "nom", "distance_km", "duration_min",
        message.alias("message"),
    )
