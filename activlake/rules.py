"""Business parameters. Every rule that reads a label or a limit takes it from here."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

# The default labels and limits of the business rules.
WALK_MODES = ("MARCHE", "COURSE À PIED", "RUNNING")
BIKE_MODES = ("VÉLO", "TROTTINETTE")
BONUS_MODES = ("VÉLO/TROTTINETTE/AUTRES", "MARCHE/RUNNING")
TRAVEL_MODES = {
    "VÉLO": "bicycling",
    "TROTTINETTE": "bicycling",
    "MARCHE": "walking",
    "COURSE À PIED": "walking",
    "RUNNING": "walking",
}
STATIONARY_SPORTS = ("YOGA", "MUSCULATION")
NO_SPORT = "AUCUN"


@dataclass(frozen=True)
class BusinessRules:
    """Limits and label sets used from the reference build up to the Gold layer.

    The anomaly labels (``walk_modes``, ``bike_modes``) and the bonus labels
    (``bonus_modes``) are separate on purpose: a table that only carries the
    combined bonus labels is never flagged unless they are added here as well.
    """

    walk_modes: tuple[str, ...] = WALK_MODES
    walk_limit_km: float = 15.0
    bike_modes: tuple[str, ...] = BIKE_MODES
    bike_limit_km: float = 25.0
    bonus_modes: tuple[str, ...] = BONUS_MODES
    bonus_rate: float = 0.05
    wellbeing_min_activities: int = 15
    default_distance_km: float = 12.5
    travel_modes: dict[str, str] = field(default_factory=lambda: dict(TRAVEL_MODES))
    default_travel_mode: str = "driving"


@dataclass(frozen=True)
class GeneratorBounds:
    """Value ranges that a well-formed activity respects (inclusive)."""

    min_duration_sec: int = 20 * 60
    max_duration_sec: int = 120 * 60
    min_distance_m: float = 2000.0
    max_distance_m: float = 15000.0
    stationary_sports: tuple[str, ...] = STATIONARY_SPORTS
    first_start: datetime = datetime(2025, 1, 1)
    last_start: datetime = datetime(2025, 12, 31)
