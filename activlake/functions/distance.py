"""Distances: provider responses and unit conversion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from activlake.functions.casting import number
from activlake.schemas import DISTANCE_RESPONSE


def provider_distance_km(response: Column) -> Column:
    """Kilometres in a stored distance-matrix response; null unless both statuses are OK."""
    body = F.from_json(response, DISTANCE_RESPONSE)
    element = F.get(F.get(body["rows"], F.lit(0))["elements"], F.lit(0))
    usable = (body["status"] == "OK") & (element["status"] == "OK")
    return F.when(usable, element["distance"]["value"] / F.lit(1000))


def metres_to_km(metres: Column) -> Column:
    """Metres as text or number to kilometres; unreadable amounts are 0."""
    return F.coalesce(number(metres) / F.lit(1000), F.lit(0.0))
