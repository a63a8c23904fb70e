"""Driver tables in the shape of the pipeline's inputs. Every view reads its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from activlake.schemas import BRONZE

# Raw transport label of each market segment or region, as a person would type it.
SEGMENT_TRANSPORT = {
    "AUTOMOBILE": "Voiture",
    "BUILDING": " marche ",
    "FURNITURE": "Marche/Running",
    "HOUSEHOLD": "vélo/trottinette/autres ",
    "MACHINERY": "Vélo",
}
REGION_TRANSPORT = {
    "AFRICA": "Voiture",
    "AMERICA": "Marche",
    "ASIA": " Vélo",
    "EUROPE": "Marche/Running",
    "MIDDLE EAST": "Vélo/Trottinette/Autres",
}
EVENT_SPORT = {
    "click": "Running ",
    "error": "",
    "purchase": "natation",
    "signup": "Yoga",
    "view": "RANDONNÉE",
}


#: Added to identifiers of messages and bodies, which have to fit whatever their size.
WIDE = 3_000_000_000

_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. Its footer is read the first time only."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _lookup(key: Column, pairs: dict[str, str]) -> Column:
    entries = [F.lit(text) for pair in pairs.items() for text in pair]
    return F.try_element_at(F.create_map(*entries), key)


def _micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def with_k(events: DataFrame) -> DataFrame:
    """Events with ``k``, the integer carried by their JSON properties."""
    return events.withColumn("k", F.get_json_object("props", "$.k").cast("int"))


# --- employees -----------------------------------------------------------------------


def hr_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HR sheet: one row per customer."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("ID salarié"),
        F.substring_index("c_name", "#", -1).alias("Nom"),
        F.substring_index("c_name", "#", 1).alias("Prénom"),
        F.col("c_acctbal").alias("Salaire brut"),
        F.concat(F.lit("rue "), F.col("c_nationkey").cast("string"), F.lit(', "Bât. A"')).alias(
            "Adresse du domicile"
        ),
        _lookup(F.col("c_mktsegment"), SEGMENT_TRANSPORT).alias("Moyen de déplacement"),
        F.col("c_nationkey").alias("Code (secteur)"),
    )


def hr_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HR sheet: one row per supplier. A third of the event users are not in it."""
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return (
        table(spark, sf_dir, "supplier")
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("s_suppkey").alias("ID salarié"),
            F.col("s_name").alias("Nom"),
            F.col("n_name").alias("Prénom"),
            F.col("s_acctbal").alias("Salaire brut"),
            F.col("n_name").alias("Adresse du domicile"),
            _lookup(F.col("r_name"), REGION_TRANSPORT).alias("Moyen de déplacement"),
        )
    )


def sport_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sport sheet: fewer employees than the HR sheet of customers, some without a sport."""
    nation = F.col("s_nationkey")
    sport = (
        F.when(nation < 5, F.lit(None).cast("string"))
        .when(nation < 10, F.lit(" running"))
        .when(nation < 15, F.lit("Yoga"))
        .when(nation < 20, F.lit("Tennis de table "))
        .otherwise(F.lit("randonnée"))
    )
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("ID salarié"), sport.alias("Pratique d'un sport")
    )


def cache_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distance cache with many entries per employee: one per event of the user."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("employee_id"),
        (F.col("value") / 10).alias("distance_domicile_entreprise_km"),
    )


def cache_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distance cache with gaps: none for a negative balance."""
    km = F.when(F.col("s_acctbal") >= 0, F.col("s_nationkey") * 1.5)
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("employee_id"), km.alias("distance_domicile_entreprise_km")
    )


def provider_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored distance-provider responses, one per customer, usable or not by segment."""
    segment, metres = F.col("c_mktsegment"), F.floor(F.col("c_acctbal")).cast("bigint")
    element = F.struct(
        F.when(segment == "BUILDING", "ZERO_RESULTS").otherwise("OK").alias("status"),
        F.struct(F.when(segment != "HOUSEHOLD", metres).alias("value")).alias("distance"),
    )
    body = F.struct(
        F.when(segment == "FURNITURE", "REQUEST_DENIED").otherwise("OK").alias("status"),
        F.array(F.struct(F.array(element).alias("elements"))).alias("rows"),
    )
    empty = F.lit('{"status": "OK", "rows": []}')
    response = F.when((segment == "MACHINERY") & (F.col("c_nationkey") < 5), empty).otherwise(
        F.to_json(body)
    )
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("employee_id"), response.alias("response")
    )


# --- activities ----------------------------------------------------------------------


def bronze_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows: one activity per order of a customer."""
    start = _micros(F.col("o_orderdate"))
    seconds = (F.floor(F.col("o_totalprice")) % 7200).cast("bigint")
    return (
        table(spark, sf_dir, "orders")
        .select(
            F.col("o_orderkey").alias("id"),
            F.col("o_custkey").alias("id_salarie"),
            F.col("o_orderstatus").alias("type_sport"),
            (F.col("o_totalprice") / 10).alias("distance"),
            start.cast("string").alias("date_debut"),
            (start + seconds * 1_000_000).cast("string").alias("date_fin"),
            F.col("o_orderpriority").alias("commentaire"),
            seconds.alias("duration_sec"),
        )
        .select(*BRONZE.fieldNames())
    )


def hot_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows of orders, a third of them of one employee."""
    who = F.when(F.col("id") % 3 == 0, F.lit(1).cast("bigint")).otherwise(F.col("id_salarie"))
    return bronze_orders(spark, sf_dir).withColumn("id_salarie", who)


def dated_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule of a sport for each supplier: some since ever, some open, many that replace others;
    one sport has none."""
    n = F.col("s_suppkey").cast("int")
    sport = F.element_at(F.array(*map(F.lit, ("F", "O", "DEFAULT", "X"))), n % 4 + 1)
    begins = F.date_add(F.lit("1992-01-01").cast("date"), n * 37 % 2400)
    return table(spark, sf_dir, "supplier").select(
        sport.alias("key"),
        F.when(n % 50 != 0, begins).alias("valid_from"),
        F.when(n % 9 != 0, F.date_add(begins, n % 90 + 1)).alias("valid_to"),
        F.col("s_name").alias("label"),
        F.col("s_acctbal").alias("rate"),
    )


def distance_answers(requests: DataFrame) -> DataFrame:
    """Provider answers to distance requests; none for bicycles, and metres told by the address."""
    metres = F.length("domicile_address").cast("bigint") * 1000
    status = F.when(F.col("mode_trajet") == "bicycling", "ZERO_RESULTS").otherwise("OK")
    element = F.struct(status.alias("status"), F.struct(metres.alias("value")).alias("distance"))
    body = F.struct(
        F.lit("OK").alias("status"),
        F.array(F.struct(F.array(element).alias("elements"))).alias("rows"),
    )
    return requests.select("domicile_address", "mode_trajet", F.to_json(body).alias("response"))


def faulty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows of orders, of which some end at another time than they say, some have an
    unreadable start and some have no duration."""
    end = F.col("date_fin").cast("bigint")
    return bronze_orders(spark, sf_dir).withColumns(
        {
            "date_fin": F.when(F.col("id") % 11 == 0, end + 1).otherwise(end).cast("string"),
            "date_debut": F.when(F.col("id") % 13 != 0, F.col("date_debut")).otherwise("soon"),
            "duration_sec": F.when(F.col("id") % 17 != 0, F.col("duration_sec")),
        }
    )


def bronze_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows: one activity per event, starting at the event's day so that some repeat.

    Some distances are negative, some ends precede their start, some sports are null.
    """
    start = _micros(F.date_trunc("day", F.col("ts").cast("timestamp")))
    seconds = ((F.col("k") - 5) * 61).cast("bigint")
    return with_k(table(spark, sf_dir, "events")).select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("id_salarie"),
        F.upper(F.nullif(F.col("event_type"), F.lit("error"))).alias("type_sport"),
        (F.col("value") - 5).alias("distance"),
        start.cast("string").alias("date_debut"),
        (start + seconds * 1_000_000).cast("string").alias("date_fin"),
        F.col("props").alias("commentaire"),
        seconds.alias("duration_sec"),
    )


# --- messages ------------------------------------------------------------------------


def cdc_messages(events: DataFrame) -> DataFrame:
    """Change envelopes of an event table.

    Error events carry no row image: deletes, tombstones or broken text. Some
    click events have a date that is not a number.
    """
    start = _micros(F.col("ts"))
    end = (start + F.col("k").cast("bigint") * 61_500_000).cast("string")
    after = F.struct(
        (F.col("event_id") + WIDE).alias("id"),
        (F.col("user_id") + WIDE).alias("id_salarie"),
        F.upper("event_type").alias("type_sport"),
        F.col("value").alias("distance"),
        start.alias("date_debut"),
        F.when((F.col("event_type") == "click") & (F.col("k") < 10), F.lit("soon"))
        .otherwise(end)
        .alias("date_fin"),
        F.concat(F.lit("U"), F.col("user_id"), F.lit(" - "), F.upper("event_type")).alias(
            "commentaire"
        ),
    )
    op = _lookup(F.col("event_type"), {"signup": "r", "view": "c", "purchase": "c", "click": "u"})
    envelope = F.to_json(
        F.struct(F.struct(after.alias("after"), op.alias("op")).alias("payload"))
    )
    deleted = F.lit('{"payload": {"before": {"id": 1}, "after": null, "op": "d"}}')
    error = (
        F.when(F.col("k") < 40, deleted).when(F.col("k") < 70, F.lit("garbage")).otherwise(F.lit(None))
    )
    text = F.when(F.col("event_type") == "error", error).otherwise(envelope)
    return with_k(events).select(text.cast("binary").alias("value"))


def notification_messages(events: DataFrame) -> DataFrame:
    """Change envelopes with the spellings and gaps a notification has to cope with."""
    kind, when = F.col("event_type"), F.col("ts").cast("timestamp")
    later = when + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("k") - 9) * 31)
    layout = {"click": "yyyy-MM-dd HH:mm:ss", "purchase": "dd/MM/yyyy HH:mm"}

    def shown(c: Column) -> Column:
        micros = F.unix_micros(c).cast("string")
        return (
            F.when(kind == "click", F.date_format(c, layout["click"]))
            .when(kind == "purchase", F.date_format(c, layout["purchase"]))
            .when(kind == "error", F.lit("hier"))
            .otherwise(micros)
        )

    user = F.concat(F.lit("U"), F.col("user_id").cast("string"))
    comment = (
        F.when(kind == "signup", F.lit(""))
        .when(kind == "view", user)
        .when(kind == "purchase", F.lit(None))
        .otherwise(F.concat(user, F.lit(" - "), F.upper(kind), F.lit(" - x")))
    )
    # Some dates are as far apart as numbers can be.
    def placed(c: Column, extreme: int) -> Column:
        far = (kind == "view") & (F.col("k") == 50)
        return F.when(far, F.lit(str(extreme))).otherwise(shown(c))

    after = F.struct(
        (F.col("event_id") + WIDE).alias("id"),
        F.col("user_id").alias("id_salarie"),
        _lookup(kind, EVENT_SPORT).alias("type_sport"),
        F.when(kind == "error", F.lit("abc"))
        .otherwise((F.col("value") * 1000).cast("string"))
        .alias("distance"),
        comment.alias("commentaire"),
        placed(when, -(2**63) + 1).alias("date_debut"),
        placed(later, 2**63 - 1).alias("date_fin"),
    )
    deleted = F.lit('{"payload": {"before": null, "after": {}}}')
    text = F.when((kind == "error") & (F.col("k") < 20), deleted).otherwise(
        F.to_json(F.struct(F.struct(after.alias("after")).alias("payload")))
    )
    return with_k(events).select(text.cast("binary").alias("value"))


def keyed_bodies(spark: SparkSession, sf_dir: str, shift: int = 0) -> DataFrame:
    """Posted bodies of which some have no id, all click events have the same one, and the ids of
    view events are ``shift`` further on."""
    kind, own = F.col("event_type"), F.col("event_id") + WIDE
    key = (
        F.when(F.col("k") == 5, F.lit(None).cast("bigint"))
        .when(kind == "click", F.lit(7).cast("bigint"))
        .when(kind == "view", own + shift)
        .otherwise(own)
    )
    return ingest_bodies(spark, sf_dir, key)


def ingest_bodies(spark: SparkSession, sf_dir: str, key: Column | None = None) -> DataFrame:
    """Posted JSON bodies: complete, with missing keys, null values or unreadable ones."""
    kind = F.col("event_type")
    start = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ss")
    body = F.struct(
        F.when((kind != "signup") | (F.col("k") >= 30), F.col("user_id") + WIDE).alias(
            "id_salarie"
        ),
        F.when((kind != "error") | (F.col("k") >= 30), F.upper(kind)).alias("type_sport"),
        F.when(kind != "error", F.col("value")).alias("distance"),
        F.when((kind == "click") & (F.col("k") < 20), F.lit("demain")).otherwise(start).alias(
            "date_debut"
        ),
        F.when(kind != "signup", start).alias("date_fin"),
        F.when(kind != "purchase", F.concat(F.lit("U"), F.col("user_id"))).alias("commentaire"),
    )
    # View events send explicit nulls, the others leave the key out.
    with_nulls = F.to_json(
        body.withField("distance", F.when(F.col("k") >= 50, F.col("value"))).withField(
            "id_salarie", F.when(F.col("k") != 77, F.col("user_id") + WIDE)
        ),
        {"ignoreNullFields": "false"},
    )
    text = F.when(kind == "view", with_nulls).when(
        (kind == "purchase") & (F.col("k") == 13), F.lit("not json")
    )
    own = F.col("event_id") + WIDE if key is None else key
    return with_k(table(spark, sf_dir, "events")).select(
        own.alias("id"), F.coalesce(text, F.to_json(body)).alias("body")
    )
