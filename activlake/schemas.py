"""Explicit schemas of every layer; nothing in the package infers types from data."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType], required: tuple[str, ...] = ()) -> T.StructType:
    return T.StructType([T.StructField(n, t, n not in required) for n, t in fields])


INT, LONG, DOUBLE = T.IntegerType(), T.LongType(), T.DoubleType()
TEXT, BOOL, TS = T.StringType(), T.BooleanType(), T.TimestampType()

# The headers of the two source sheets and their working names.
HR_RENAMES = {
    "ID salarié": "employee_id",
    "Salaire brut": "salaire_brut",
    "Adresse du domicile": "domicile_address",
    "Moyen de déplacement": "moyen_transport",
}
SPORT_RENAMES = {
    "ID salarié": "employee_id",
    "Pratique d'un sport": "pratique_sport",
}

# The known columns of the employee reference; other columns pass through as text.
REFERENCE = _struct(
    ("employee_id", LONG),
    ("Nom", TEXT),
    ("Prénom", TEXT),
    ("salaire_brut", DOUBLE),
    ("domicile_address", TEXT),
    ("moyen_transport", TEXT),
    ("pratique_sport", TEXT),
    ("distance_domicile_entreprise_km", DOUBLE),
    ("erreur_declaration_transport", BOOL),
)

DISTANCE_CACHE = _struct(
    ("employee_id", LONG),
    ("distance_domicile_entreprise_km", DOUBLE),
)

# ``value`` is a double so that both integer and fractional metres decode.
DISTANCE_RESPONSE = _struct(
    ("status", TEXT),
    (
        "rows",
        T.ArrayType(
            _struct(
                (
                    "elements",
                    T.ArrayType(
                        _struct(("status", TEXT), ("distance", _struct(("value", DOUBLE))))
                    ),
                )
            )
        ),
    ),
)

# The operational tables. Primary keys and NOT NULL columns are the non-nullable fields,
# and the quality rules check them because no Spark file format enforces them.
EMPLOYES = _struct(
    ("employee_id", LONG),
    ("nom", TEXT),
    ("prenom", TEXT),
    ("salaire_brut", DOUBLE),
    ("domicile_address", TEXT),
    ("moyen_transport", TEXT),
    ("pratique_sport", TEXT),
    ("distance_domicile_entreprise_km", DOUBLE),
    required=("employee_id",),
)
ACTIVITES = _struct(
    ("id", LONG),
    ("id_salarie", LONG),
    ("type_sport", TEXT),
    ("distance", DOUBLE),
    ("duration_sec", INT),
    ("date_debut", TS),
    ("date_fin", TS),
    ("commentaire", TEXT),
    ("created_at", TS),
    required=("id", "id_salarie", "type_sport"),
)

# The required keys of an ingest body. Every value stays text until it is validated.
INGEST_REQUIRED = ("id_salarie", "type_sport", "distance", "date_debut", "date_fin")
INGEST_BODY = _struct(*[(name, TEXT) for name in (*INGEST_REQUIRED, "commentaire")])

# The row image of a change. Identifiers are 64 bits wide in every layer.
CDC_AFTER = _struct(
    ("id", LONG),
    ("id_salarie", LONG),
    ("type_sport", TEXT),
    ("distance", DOUBLE),
    ("date_debut", TEXT),
    ("date_fin", TEXT),
    ("commentaire", TEXT),
)
CDC_ENVELOPE = _struct(("payload", _struct(("after", CDC_AFTER))))

BRONZE = T.StructType([*CDC_AFTER.fields, T.StructField("duration_sec", LONG)])

SILVER = _struct(
    ("id_evenement", LONG),
    ("id_salarie", LONG),
    ("type_sport", TEXT),
    ("distance_metres", DOUBLE),
    ("duration_min", INT),
    ("date_debut", TS),
    ("date_fin", TS),
    ("mode_transport_declare", TEXT),
    ("distance_domicile_travail_km", DOUBLE),
    ("alerte_transport", TEXT),
    ("commentaire", TEXT),
)

DAILY = _struct(
    ("id_salarie", LONG),
    ("activities", LONG),
    ("metres", DOUBLE),
    ("jour_debut", T.DateType()),
)

# The row image a notification reads. Two spellings exist for sport, employee and
# dates; ``distance`` is text because the amount may be unreadable.
NOTIFY_AFTER = _struct(
    ("id", LONG),
    ("type", TEXT),
    ("type_sport", TEXT),
    ("distance", TEXT),
    ("id salarié", TEXT),
    ("id_salarie", TEXT),
    ("commentaire", TEXT),
    ("Date de début de l'activité", TEXT),
    ("Date de fin de l'activité", TEXT),
    ("date_debut", TEXT),
    ("date_fin", TEXT),
)
NOTIFY_ENVELOPE = _struct(("payload", _struct(("after", NOTIFY_AFTER))))
NOTIFICATION = _struct(
    ("id", LONG),
    ("id_salarie", TEXT),
    ("type_sport", TEXT),
    ("nom", TEXT),
    ("distance_km", DOUBLE),
    ("duration_min", LONG),
    ("message", TEXT),
)

# Columns of the stream source whichever connector feeds it.
STREAM_VALUE = _struct(("value", T.BinaryType()))
