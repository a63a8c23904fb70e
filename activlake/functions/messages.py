"""Notification texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from activlake.functions.text import one_decimal

# The message templates of each sport.
DEFAULT_KEY = "DEFAULT"
TEMPLATES: dict[str, list[str]] = {
    "RUNNING": [
        "🏃‍♂️ Incroyable {name} ! Tu viens de courir {distance:.1f} km en {duration} min ! Quelle énergie ! 🔥🏅",
        "🔥 Bravo {name} ! {distance:.1f} km de running validés ! 💪",
    ],
    "RUNING": ["🏃‍♂️ Bravo {name} ! {distance:.1f} km de course validés ! 🔥"],
    "JUDO": [
        "🥋 Magnifique {name} ! Séance de judo intense ! 💪",
        "🥋 Bravo {name} ! Super progression en judo 👊",
    ],
    "NATATION": [
        "🏊 Super {name} ! Tu viens de nager {distance:.1f} km en {duration} min ! 🔥🏅",
        "🌊 Excellent {name} ! Belle séance de natation 💪",
    ],
    "FOOTBALL": [
        "⚽ Bravo {name} ! Session football intense 🔥",
        "⚽ Excellent {name} ! Très belle énergie sur le terrain 💪",
    ],
    "BASKETBALL": [
        "🏀 Bravo {name} ! Match intense 🔥",
        "🏀 Super {name} ! Très grosse énergie 💪",
    ],
    "TENNIS": [
        "🎾 Excellent {name} ! Belle session de tennis 🔥",
        "🎾 Bravo {name} ! Très bon match 💪",
    ],
    "TENNIS DE TABLE": ["🏓 Bravo {name} ! Session rapide et technique 🔥"],
    "BADMINTON": ["🏸 Super {name} ! Match dynamique 🔥"],
    "RUGBY": ["🏉 Bravo {name} ! Séance intense 💪🔥"],
    "RANDONNÉE": [
        "🌄 Magnifique {name} ! {distance:.1f} km de randonnée 🌿",
        "🥾 Bravo {name} ! Super randonnée terminée 🌄",
    ],
    "ESCALADE": ["🧗 Bravo {name} ! Très belle session d’escalade 🔥"],
    "BOXE": ["🥊 Bravo {name} ! Session intense 💪🔥"],
    "ÉQUITATION": ["🐎 Magnifique {name} ! Belle séance 🌿"],
    "VOILE": ["⛵ Super {name} ! Belle navigation 🔥"],
    "TRIATHLON": ["🔥 Incroyable {name} ! Triathlon terminé 💪🏅"],
    DEFAULT_KEY: ["🔥 Bravo {name} ! Activité {sport} réalisée avec succès 💪"],
}
FALLBACK = "🔥 Bravo {name} ! Activité {sport} réalisée 💪"


def pick_template(
    sport: Column, pick: Column, templates: dict[str, list[str]] | None = None
) -> Column:
    """Template of a sport, chosen by ``pick`` so that a replayed event gives the same text."""
    table = templates or TEMPLATES
    entries = [
        part
        for key, texts in table.items()
        for part in (F.lit(key), F.array(*[F.lit(t) for t in texts]))
    ]
    by_sport = F.create_map(*entries)
    choices = F.coalesce(
        F.try_element_at(by_sport, sport), F.try_element_at(by_sport, F.lit(DEFAULT_KEY))
    )
    index = F.pmod(F.coalesce(pick, F.lit(0)).cast("bigint"), F.size(choices)).cast("int")
    return F.coalesce(F.get(choices, index), F.lit(FALLBACK))


def render(
    template: Column, name: Column, sport: Column, distance_km: Column, minutes: Column
) -> Column:
    """Fill the placeholders. The name goes last so that braces typed by a person stay text."""
    values = [
        ("{sport}", sport),
        ("{distance:.1f}", one_decimal(distance_km)),
        ("{duration}", minutes.cast("string")),
        ("{name}", name),
    ]
    text = template
    for placeholder, value in values:
        text = F.replace(text, F.lit(placeholder), value)
    return text
