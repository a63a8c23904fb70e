"""Business rules as CASE expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from activlake.rules import STATIONARY_SPORTS, BusinessRules


def travel_mode(transport: Column, rules: BusinessRules) -> Column:
    """Travel mode of a transport label, or the default mode."""
    pairs = [F.lit(text) for pair in rules.travel_modes.items() for text in pair]
    known = F.try_element_at(F.create_map(*pairs), transport) if pairs else F.lit(None)
    return F.coalesce(known, F.lit(rules.default_travel_mode))


def transport_anomaly(transport: Column, km: Column, rules: BusinessRules) -> Column:
    """True when the home is too far for the declared soft-mobility mode.

    An unknown distance never raises the flag; NaN counts as unknown because
    Spark would order it above every limit.
    """
    known = km.isNotNull() & ~F.isnan(km)
    too_far = (transport.isin(*rules.walk_modes) & (km > rules.walk_limit_km)) | (
        transport.isin(*rules.bike_modes) & (km > rules.bike_limit_km)
    )
    return F.coalesce(known & too_far, F.lit(False))


def transport_alert(flag: Column) -> Column:
    return F.when(flag, F.lit("FRAUDE")).otherwise(F.lit("OK"))


def sport_bonus(transport: Column, salary: Column, rules: BusinessRules) -> Column:
    """Share of the salary for the rewarded labels (null salary gives null), else 0."""
    return F.when(transport.isin(*rules.bonus_modes), salary * F.lit(rules.bonus_rate)).otherwise(
        F.lit(0.0)
    )


def wellbeing_eligible(activities: Column, rules: BusinessRules) -> Column:
    return F.coalesce(activities >= rules.wellbeing_min_activities, F.lit(False))


def activity_distance(sport: Column, metres: Column) -> Column:
    """Distance of an activity: sports done on the spot have none."""
    return F.when(sport.isin(*STATIONARY_SPORTS), F.lit(0.0)).otherwise(metres)
