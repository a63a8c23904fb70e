"""The registered queries as plain SQL over the driver tables."""

from __future__ import annotations

K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"

# Employee references ------------------------------------------------------------------

_FLAG = """
    coalesce(
        (moyen_transport IN ('MARCHE', 'COURSE À PIED', 'RUNNING') AND km > 15)
        OR (moyen_transport IN ('VÉLO', 'TROTTINETTE') AND km > 25), false)"""

_SPORT = """
sport AS (
    SELECT s_suppkey::BIGINT AS employee_id,
           CASE WHEN s_nationkey < 5 THEN 'AUCUN' WHEN s_nationkey < 10 THEN 'RUNNING'
                WHEN s_nationkey < 15 THEN 'YOGA' WHEN s_nationkey < 20 THEN 'TENNIS DE TABLE'
                ELSE 'RANDONNÉE' END AS pratique_sport
    FROM supplier)"""

_HR_CUSTOMERS = """
hr AS (
    SELECT c_custkey::BIGINT AS employee_id, split_part(c_name, '#', 2) AS nom,
           split_part(c_name, '#', 1) AS prenom, c_acctbal AS salaire_brut,
           'rue ' || c_nationkey || ', "Bât. A"' AS domicile_address,
           CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'VOITURE' WHEN 'BUILDING' THEN 'MARCHE'
                WHEN 'FURNITURE' THEN 'MARCHE/RUNNING'
                WHEN 'HOUSEHOLD' THEN 'VÉLO/TROTTINETTE/AUTRES'
                WHEN 'MACHINERY' THEN 'VÉLO' END AS moyen_transport,
           c_nationkey AS code_secteur
    FROM customer),
cache AS (
    SELECT user_id::BIGINT AS employee_id, max(value / 10) AS cached FROM events GROUP BY 1)"""

_RESPONSES = """
responses AS (
    SELECT c_custkey::BIGINT AS employee_id,
           CASE WHEN c_mktsegment = 'AUTOMOBILE' OR (c_mktsegment = 'MACHINERY' AND c_nationkey >= 5)
                THEN floor(c_acctbal) / 1000 END AS decoded
    FROM customer)"""

_CUSTOMERS = f"""{_SPORT}, {_HR_CUSTOMERS},
merged AS (
    SELECT hr.*, coalesce(pratique_sport, 'AUCUN') AS pratique_sport, coalesce(cached, 12.5) AS km
    FROM hr LEFT JOIN sport USING (employee_id) LEFT JOIN cache USING (employee_id)),
ref AS (
    SELECT * EXCLUDE (km), km AS distance_domicile_entreprise_km,
           {_FLAG} AS erreur_declaration_transport
    FROM merged)"""

_SUPPLIERS = f"""{_SPORT},
merged AS (
    SELECT s_suppkey::BIGINT AS employee_id, s_name AS nom, n_name AS prenom,
           s_acctbal AS salaire_brut,
           CASE r_name WHEN 'AFRICA' THEN 'VOITURE' WHEN 'AMERICA' THEN 'MARCHE'
                WHEN 'ASIA' THEN 'VÉLO' WHEN 'EUROPE' THEN 'MARCHE/RUNNING'
                WHEN 'MIDDLE EAST' THEN 'VÉLO/TROTTINETTE/AUTRES' END AS moyen_transport,
           pratique_sport,
           CASE WHEN s_acctbal >= 0 THEN s_nationkey * 1.5::DOUBLE ELSE 12.5::DOUBLE END AS km
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
    LEFT JOIN sport ON sport.employee_id = s_suppkey),
ref AS (
    SELECT * EXCLUDE (km), km AS distance_domicile_entreprise_km,
           {_FLAG} AS erreur_declaration_transport
    FROM merged)"""

# Activities ---------------------------------------------------------------------------

_ORDERS = """
bronze AS (
    SELECT o_orderkey::BIGINT AS id, o_custkey::BIGINT AS id_salarie,
           o_orderstatus AS type_sport, o_totalprice / 10 AS distance, o_orderdate AS debut,
           floor(o_totalprice)::BIGINT % 7200 AS duration_sec, o_orderpriority AS commentaire
    FROM orders)"""

_HOT_ORDERS = _ORDERS.replace(
    "o_custkey::BIGINT AS", "CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey::BIGINT END AS"
)

_ASKED = """
asked AS (
    SELECT hr.employee_id, domicile_address, cached, CASE
           WHEN moyen_transport IN ('VÉLO', 'TROTTINETTE') THEN 'bicycling'
           WHEN moyen_transport IN ('MARCHE', 'COURSE À PIED', 'RUNNING') THEN 'walking'
           ELSE 'driving' END AS mode_trajet
    FROM hr LEFT JOIN cache USING (employee_id))"""

_EVENTS = f"""
bronze AS (
    SELECT event_id::BIGINT AS id, user_id::BIGINT AS id_salarie,
           upper(nullif(event_type, 'error')) AS type_sport, value - 5 AS distance,
           date_trunc('day', ts)::TIMESTAMP AS debut, (({K} - 5) * 61)::BIGINT AS duration_sec,
           props AS commentaire
    FROM events)"""

_SILVER = """
uniq AS (
    SELECT * FROM bronze
    QUALIFY row_number() OVER (PARTITION BY id_salarie, type_sport, debut ORDER BY id) = 1),
lookup AS (
    SELECT DISTINCT employee_id AS id_salarie_rh, moyen_transport AS mode_transport_declare,
           distance_domicile_entreprise_km AS distance_domicile_travail_km,
           CASE WHEN erreur_declaration_transport THEN 'FRAUDE' ELSE 'OK' END AS alerte_transport
    FROM ref),
silver AS (
    SELECT id AS id_evenement, id_salarie, type_sport, coalesce(distance, 0.0) AS distance_metres,
           coalesce(trunc(duration_sec / 60.0), 0)::INTEGER AS duration_min, debut AS date_debut,
           debut + to_seconds(duration_sec) AS date_fin, mode_transport_declare,
           distance_domicile_travail_km,
           coalesce(alerte_transport, 'INCONNU') AS alerte_transport, commentaire
    FROM uniq LEFT JOIN lookup ON id_salarie = id_salarie_rh)"""

_SILVER_ORDERS = f"WITH {_CUSTOMERS}, {_ORDERS}, {_SILVER}"
_SILVER_HOT = f"WITH {_CUSTOMERS}, {_HOT_ORDERS}, {_SILVER}"
_SILVER_EVENTS = f"WITH {_SUPPLIERS}, {_EVENTS}, {_SILVER}"


def _gold(condition: str = "true") -> str:
    return f"""{_SILVER_ORDERS},
counts AS (
    SELECT id_salarie, count(id_evenement) AS nb_total_activites,
           count_if(alerte_transport = 'OK')::BIGINT AS nb_activites_valides
    FROM silver WHERE {condition} GROUP BY id_salarie),
gold AS (
    SELECT counts.*, ref.*,
           CASE WHEN moyen_transport IN ('VÉLO/TROTTINETTE/AUTRES', 'MARCHE/RUNNING')
                THEN salaire_brut * 0.05::DOUBLE ELSE 0.0::DOUBLE END AS montant_prime_sportive,
           nb_total_activites >= 15 AS eligible_jours_bien_etre
    FROM counts JOIN ref ON id_salarie = employee_id)"""


_REPORT_SILVER = f"""{_SILVER_EVENTS},
report AS (
    SELECT 'distance_negative' AS rule, count_if(distance_metres < 0)::BIGINT AS n_bad FROM silver
    UNION ALL SELECT 'date_fin_avant_debut', count_if(date_fin < date_debut)::BIGINT FROM silver
    UNION ALL SELECT 'salarie_absent_du_referentiel', count_if(alerte_transport = 'INCONNU')::BIGINT
    FROM silver)"""

# Messages -----------------------------------------------------------------------------

_CDC_BRONZE = f"""
SELECT event_id + 3000000000 AS id, user_id + 3000000000 AS id_salarie,
       upper(event_type) AS type_sport, value AS distance, epoch_us(ts)::VARCHAR AS date_debut,
       CASE WHEN event_type = 'click' AND {K} < 10 THEN 'soon'
            ELSE (epoch_us(ts) + {K}::BIGINT * 61500000)::VARCHAR END AS date_fin,
       'U' || user_id || ' - ' || upper(event_type) AS commentaire,
       CASE WHEN event_type = 'click' AND {K} < 10 THEN NULL
            ELSE (({K}::BIGINT * 61500000) // 1000000)::VARCHAR END AS duration_sec
FROM events WHERE event_type <> 'error'"""

_NOTIFY = f"""
WITH base AS (
    SELECT *, {K} AS k, ts + to_seconds(({K} - 9) * 31) AS later FROM events
    WHERE NOT (event_type = 'error' AND {K} < 20)),
facts AS (
    SELECT event_id + 3000000000 AS id,
           CASE WHEN user_id = 0 THEN 'inconnu' ELSE user_id::VARCHAR END AS id_salarie,
           CASE event_type WHEN 'click' THEN 'RUNNING' WHEN 'error' THEN 'UNKNOWN'
                WHEN 'purchase' THEN 'NATATION' WHEN 'signup' THEN 'YOGA'
                ELSE 'RANDONNÉE' END AS type_sport,
           CASE WHEN event_type IN ('signup', 'purchase') THEN 'salarié ' ||
                CASE WHEN user_id = 0 THEN 'inconnu' ELSE user_id::VARCHAR END
                ELSE 'U' || user_id END AS nom,
           CASE WHEN event_type = 'error' THEN 0.0::DOUBLE
                ELSE (value * 1000) / 1000 END AS distance_km,
           CASE WHEN event_type = 'view' AND k = 50 THEN 0 ELSE CASE event_type WHEN 'error' THEN 0
                WHEN 'purchase' THEN (epoch_us(date_trunc('minute', later))
                    - epoch_us(date_trunc('minute', ts))) // 60000000
                ELSE floor((k - 9) * 31 / 60.0) END END::BIGINT AS duration_min
    FROM base)
SELECT *,
    CASE type_sport
        WHEN 'RUNNING' THEN CASE id % 2
            WHEN 0 THEN '🏃‍♂️ Incroyable ' || nom || ' ! Tu viens de courir '
                || format('{{:.1f}}', distance_km) || ' km en ' || duration_min
                || ' min ! Quelle énergie ! 🔥🏅'
            ELSE '🔥 Bravo ' || nom || ' ! ' || format('{{:.1f}}', distance_km)
                || ' km de running validés ! 💪' END
        WHEN 'NATATION' THEN CASE id % 2
            WHEN 0 THEN '🏊 Super ' || nom || ' ! Tu viens de nager '
                || format('{{:.1f}}', distance_km) || ' km en ' || duration_min || ' min ! 🔥🏅'
            ELSE '🌊 Excellent ' || nom || ' ! Belle séance de natation 💪' END
        WHEN 'RANDONNÉE' THEN CASE id % 2
            WHEN 0 THEN '🌄 Magnifique ' || nom || ' ! ' || format('{{:.1f}}', distance_km)
                || ' km de randonnée 🌿'
            ELSE '🥾 Bravo ' || nom || ' ! Super randonnée terminée 🌄' END
        ELSE '🔥 Bravo ' || nom || ' ! Activité ' || type_sport || ' réalisée avec succès 💪'
    END AS message
FROM facts"""

_VALIDATED = f"""
WITH validated AS (
    SELECT *, {K} AS k, CASE
        WHEN event_type = 'purchase' AND {K} = 13 THEN 'Invalid body'
        WHEN event_type = 'signup' AND {K} < 30 THEN 'Missing field: id_salarie'
        WHEN event_type = 'error' AND {K} < 30 THEN 'Missing field: type_sport'
        WHEN event_type = 'error' THEN 'Missing field: distance'
        WHEN event_type = 'signup' THEN 'Missing field: date_fin'
        WHEN event_type = 'view' AND {K} = 77 THEN 'Null value: id_salarie'
        WHEN event_type = 'click' AND {K} < 20 THEN 'Invalid value: date_debut' END AS problem
    FROM events)"""

ORACLE: dict[str, str] = {
    "gold_kpi": f"{_gold()} SELECT * FROM gold",
    "gold_kpi_from_silver": f"{_gold()} SELECT * FROM gold",
    "gold_export": f"{_gold()} SELECT * FROM gold",
    "gold_kpi_rolling": f"""{_gold("date_debut >= TIMESTAMP '2000-08-01'")}
        SELECT id_salarie, nb_total_activites, nb_activites_valides, eligible_jours_bien_etre
        FROM gold""",
    "gold_distance": f"""{_SILVER_ORDERS}
        SELECT id_salarie, round(sum(distance_metres), 3) AS distance_totale_metres
        FROM silver GROUP BY id_salarie""",
    "gold_bilan": f"""{_gold()}
        SELECT count(*) AS nb_salaries,
               count_if(montant_prime_sportive > 0)::BIGINT AS nb_primes,
               count_if(eligible_jours_bien_etre)::BIGINT AS nb_bien_etre,
               round(coalesce(sum(montant_prime_sportive), 0.0), 2) AS total_primes
        FROM gold""",
    "gold_top10": f"""{_gold()}
        SELECT id_salarie, nb_total_activites, montant_prime_sportive, eligible_jours_bien_etre
        FROM gold ORDER BY nb_total_activites DESC, id_salarie LIMIT 10""",
    "silver_activities": f"{_SILVER_EVENTS} SELECT * FROM silver",
    "silver_table": f"{_SILVER_EVENTS} SELECT * FROM silver",
    "silver_refresh": f"{_SILVER_EVENTS} SELECT * FROM silver",
    "silver_lookup": f"{_SILVER_ORDERS} SELECT * FROM lookup",
    "silver_dedup": f"""{_SILVER_EVENTS}
        SELECT id, id_salarie, type_sport, epoch_us(debut)::VARCHAR AS date_debut, duration_sec
        FROM uniq""",
    "reference_build": f"WITH {_CUSTOMERS} SELECT * FROM ref",
    "reference_csv": f"WITH {_CUSTOMERS} SELECT * FROM ref",
    "reference_from_sheets": f"""WITH {_SPORT}, {_HR_CUSTOMERS}, {_RESPONSES},
        merged AS (
            SELECT employee_id, nom, moyen_transport,
                   coalesce(pratique_sport, 'AUCUN') AS pratique_sport,
                   coalesce(decoded, 12.5) AS km
            FROM hr LEFT JOIN sport USING (employee_id) LEFT JOIN responses USING (employee_id))
        SELECT employee_id, nom, moyen_transport, pratique_sport,
               km AS distance_domicile_entreprise_km, {_FLAG} AS erreur_declaration_transport
        FROM merged""",
    "reference_provider": f"""WITH {_HR_CUSTOMERS}, {_RESPONSES},
        merged AS (
            SELECT employee_id, moyen_transport, coalesce(cached, decoded) AS km
            FROM hr LEFT JOIN cache USING (employee_id) LEFT JOIN responses USING (employee_id))
        SELECT employee_id, km AS distance_domicile_entreprise_km,
               {_FLAG} AS erreur_declaration_transport
        FROM merged""",
    "reference_anomaly": f"""WITH {_SUPPLIERS}
        SELECT count(*) AS nb_salaries,
               count_if(erreur_declaration_transport)::BIGINT AS nb_anomalies FROM ref""",
    "reference_modes": f"""WITH {_HR_CUSTOMERS}
        SELECT DISTINCT moyen_transport, CASE
            WHEN moyen_transport IN ('VÉLO', 'TROTTINETTE') THEN 'bicycling'
            WHEN moyen_transport IN ('MARCHE', 'COURSE À PIED', 'RUNNING') THEN 'walking'
            ELSE 'driving' END AS mode_trajet
        FROM hr""",
    "reference_athletes": f"""WITH {_SUPPLIERS}
        SELECT employee_id, prenom || ' ' || nom || ' - ' || pratique_sport AS commentaire,
               CASE WHEN pratique_sport IN ('YOGA', 'MUSCULATION') THEN 0.0::DOUBLE
                    ELSE salaire_brut END AS distance
        FROM ref WHERE pratique_sport <> 'AUCUN'""",
    "distance_decode": f"WITH {_RESPONSES} SELECT employee_id, decoded AS km FROM responses",
    "cdc_bronze": _CDC_BRONZE,
    "stream_bronze": _CDC_BRONZE,
    "ingest_validate": f"""{_VALIDATED}
        SELECT event_id + 3000000000 AS id, CASE WHEN problem IS NULL THEN 'ok' ELSE 'error' END AS status,
               coalesce(problem, 'activity stored') AS message
        FROM validated""",
    "ingest_store": f"""{_VALIDATED}
        SELECT event_id + 3000000000 AS id, user_id + 3000000000 AS id_salarie,
               upper(event_type) AS type_sport,
               CASE WHEN event_type = 'view' AND k < 50 THEN NULL ELSE value END AS distance,
               date_trunc('second', ts)::TIMESTAMP AS date_debut,
               date_trunc('second', ts)::TIMESTAMP AS date_fin,
               CASE WHEN event_type = 'purchase' THEN '' ELSE 'U' || user_id END AS commentaire
        FROM validated WHERE problem IS NULL""",
    "ingest_pipeline": f"""{_VALIDATED}
        SELECT event_id + 3000000000 AS id,
               CASE WHEN problem IS NULL THEN 'ok' ELSE 'error' END AS status,
               coalesce(problem, 'activity stored') AS message
        FROM validated
        UNION ALL SELECT event_id + 3000000000, 'error', coalesce(problem, 'Duplicate key: id')
        FROM validated""",
    "ingest_keyed": f"""{_VALIDATED},
        keyed AS (
            SELECT lot, problem, event_type, CASE WHEN k = 5 THEN NULL
                   WHEN event_type = 'click' THEN 7 WHEN event_type = 'view' AND lot = 'b'
                   THEN event_id + 1003000000000 ELSE event_id + 3000000000 END AS id
            FROM validated, (VALUES ('a'), ('b')) AS lots(lot)),
        judged AS (
            SELECT *, CASE WHEN problem IS NOT NULL THEN problem WHEN id IS NULL THEN 'Null value: id'
                   WHEN row_number() OVER (PARTITION BY id, problem IS NULL ORDER BY lot) > 1
                   THEN 'Duplicate key: id' END AS reason
            FROM keyed)
        SELECT lot, id::VARCHAR AS id, CASE WHEN reason IS NULL THEN 'ok' ELSE 'error' END AS status,
               coalesce(reason, 'activity stored') AS message
        FROM judged""",
    "gold_daily": f"""{_SILVER_EVENTS},
        counts AS (
            SELECT id_salarie, count(id_evenement) AS nb_total_activites,
                   count_if(alerte_transport = 'OK')::BIGINT AS nb_activites_valides,
                   round(sum(distance_metres), 3) AS distance_totale_metres
            FROM silver WHERE date_debut >= TIMESTAMP '2024-01-15' GROUP BY id_salarie)
        SELECT id_salarie, nb_total_activites, nb_activites_valides,
               CASE WHEN moyen_transport IN ('VÉLO/TROTTINETTE/AUTRES', 'MARCHE/RUNNING')
                    THEN salaire_brut * 0.05::DOUBLE ELSE 0.0::DOUBLE END AS montant_prime_sportive,
               nb_total_activites >= 15 AS eligible_jours_bien_etre, distance_totale_metres
        FROM counts JOIN ref ON id_salarie = employee_id""",
    "gold_colocated": f"""{_SILVER_HOT}
        SELECT id_salarie, count(id_evenement) AS nb_total_activites,
               count_if(alerte_transport = 'OK')::BIGINT AS nb_activites_valides
        FROM silver GROUP BY id_salarie""",
    "silver_colocated": f"{_SILVER_HOT} SELECT * FROM silver",
    "dq_observed": f"""{_REPORT_SILVER}
        SELECT * FROM report
        UNION ALL SELECT 'id_salarie_null', count_if(id_salarie IS NULL)::BIGINT FROM silver
        UNION ALL SELECT 'type_sport_null', count_if(type_sport IS NULL)::BIGINT FROM silver""",
    "table_evolution": """
        WITH days AS (SELECT *, ts::DATE AS day, max(ts::DATE) OVER () AS last FROM events)
        SELECT CASE WHEN day = last THEN event_id + 3000000000 ELSE event_id END AS id, value,
               CASE WHEN day = last THEN event_type END AS note, day::VARCHAR AS day
        FROM days""",
    "distance_worklist": f"""WITH {_HR_CUSTOMERS}, {_ASKED}
        SELECT domicile_address, mode_trajet, count(*) AS nb_salaries
        FROM asked WHERE cached IS NULL GROUP BY ALL""",
    "distance_answered": f"""WITH {_HR_CUSTOMERS}, {_ASKED},
        asked_for AS (
            SELECT DISTINCT domicile_address, mode_trajet FROM asked WHERE cached IS NULL)
        SELECT employee_id, coalesce(cached, CASE WHEN f.mode_trajet <> 'bicycling'
               THEN length(domicile_address)::DOUBLE END) AS distance_domicile_entreprise_km
        FROM asked LEFT JOIN asked_for AS f USING (domicile_address, mode_trajet)""",
    "join_multiplicity": f"""WITH {_HOT_ORDERS},
        l AS (SELECT id_salarie AS key, count(*) AS left_rows FROM bronze GROUP BY 1),
        r AS (SELECT user_id::BIGINT AS key, count(*) AS right_rows FROM events GROUP BY 1)
        SELECT key, left_rows, coalesce(right_rows, 0) AS right_rows,
               left_rows * greatest(coalesce(right_rows, 0), 1) AS joined_rows,
               left_rows * greatest(coalesce(right_rows, 0), 1) - left_rows AS added_rows
        FROM l LEFT JOIN r USING (key)""",
    "rules_dated": f"""WITH {_ORDERS},
        n AS (SELECT *, s_suppkey::INT AS n, DATE '1992-01-01' + n * 37 % 2400 AS begins FROM supplier),
        rules AS (
            SELECT ['F', 'O', 'DEFAULT', 'X'][n % 4 + 1] AS key, s_name AS label, s_acctbal AS rate,
                   CASE WHEN n % 50 <> 0 THEN begins ELSE DATE '0001-01-01' END AS valid_from,
                   CASE WHEN n % 9 <> 0 THEN begins + (n % 90 + 1) END AS valid_to
            FROM n),
        versions AS (
            SELECT * FROM rules QUALIFY row_number() OVER (PARTITION BY key, valid_from
                ORDER BY valid_to DESC NULLS FIRST, label DESC, rate DESC) = 1),
        own AS (
            SELECT b.id, b.type_sport, b.debut::DATE AS day, v.label, v.rate,
                   v.key IS NOT NULL AND (v.valid_to IS NULL OR b.debut::DATE < v.valid_to) AS holds
            FROM bronze b ASOF LEFT JOIN versions v
                ON b.type_sport = v.key AND b.debut::DATE >= v.valid_from)
        SELECT id, type_sport,
               CASE WHEN holds THEN own.label WHEN fits THEN d.label END AS label,
               CASE WHEN holds THEN own.rate WHEN fits THEN d.rate END AS rate,
               CASE WHEN holds THEN 'own' WHEN fits THEN 'default' END AS level
        FROM (SELECT own.*, d.label AS l2, d.valid_from AS since FROM own
              ASOF LEFT JOIN (SELECT * FROM versions WHERE key = 'DEFAULT') d
              ON own.day >= d.valid_from) AS own
        LEFT JOIN (SELECT * FROM versions WHERE key = 'DEFAULT') d ON d.valid_from = own.since,
        LATERAL (SELECT d.key IS NOT NULL AND (d.valid_to IS NULL OR own.day < d.valid_to) AS fits)""",
    "stream_lots": _CDC_BRONZE,
    "stream_observed": f"""
        WITH facts AS (
            SELECT {K} AS k, value, ts, event_type,
                   CASE WHEN event_type = 'click' AND {K} < 10 THEN NULL
                        ELSE ({K}::BIGINT * 61500000) // 1000000 END AS seconds
            FROM events WHERE event_type <> 'error')
        SELECT 'duree_hors_bornes' AS rule,
               count_if(coalesce(seconds NOT BETWEEN 1200 AND 7200, true))::BIGINT AS n_bad FROM facts
        UNION ALL SELECT 'distance_hors_bornes', count_if(value NOT BETWEEN 20 AND 80)::BIGINT FROM facts
        UNION ALL SELECT 'debut_hors_periode', count_if(ts NOT BETWEEN
            TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-20')::BIGINT FROM facts
        UNION ALL SELECT 'fin_differente_du_debut_plus_duree',
            count_if(coalesce(k::BIGINT * 61500000 <> seconds * 1000000, true))::BIGINT FROM facts""",
    "dq_silver": f"""{_REPORT_SILVER}
        SELECT * FROM report
        UNION ALL SELECT 'id_salarie_null', count_if(id_salarie IS NULL)::BIGINT FROM silver
        UNION ALL SELECT 'type_sport_null', count_if(type_sport IS NULL)::BIGINT FROM silver""",
    "dq_issue_total": f"""{_REPORT_SILVER}
        SELECT count_if(n_bad > 0)::BIGINT AS nb_regles_en_echec,
               CASE WHEN count_if(n_bad > 0) = 0 THEN 'OK' ELSE 'ALERTE' END AS statut
        FROM report""",
    "dq_bronze_bounds": f"""WITH {_ORDERS},
        faulty AS (
            SELECT type_sport, distance, CASE WHEN id % 13 <> 0 THEN debut END AS debut,
                   CASE WHEN id % 17 <> 0 THEN duration_sec END AS seconds,
                   epoch_us(debut) + duration_sec * 1000000
                       + CASE WHEN id % 11 = 0 THEN 1 ELSE 0 END AS fin
            FROM bronze)
        SELECT 'duree_hors_bornes' AS rule,
               count_if(coalesce(seconds NOT BETWEEN 1200 AND 7200, true))::BIGINT AS n_bad
        FROM faulty
        UNION ALL SELECT 'distance_hors_bornes', count_if(CASE WHEN type_sport = 'F'
            THEN distance <> 0 ELSE distance NOT BETWEEN 2000 AND 15000 END)::BIGINT FROM faulty
        UNION ALL SELECT 'debut_hors_periode', count_if(coalesce(debut NOT BETWEEN
            TIMESTAMP '1996-01-01' AND TIMESTAMP '2000-12-31', true))::BIGINT FROM faulty
        UNION ALL SELECT 'fin_differente_du_debut_plus_duree',
            count_if(coalesce(fin - epoch_us(debut) <> seconds * 1000000, true))::BIGINT
        FROM faulty""",
    "dq_unique": f"""WITH {_EVENTS}
        SELECT id_salarie, type_sport, epoch_us(debut)::VARCHAR AS date_debut, count(*) AS n
        FROM bronze GROUP BY ALL HAVING count(*) > 1""",
    "dq_gold": f"""{_gold()}
        SELECT 'id_salarie_null' AS rule, count_if(id_salarie % 7 = 0)::BIGINT AS n_bad
        FROM gold""",
    "alert_split": f"""{_SILVER_EVENTS}
        SELECT alerte_transport, count(*) AS nb_activites FROM silver GROUP BY alerte_transport""",
    "fraud_list": f"""{_SILVER_EVENTS}
        SELECT id_evenement, id_salarie, type_sport, distance_domicile_travail_km, alerte_transport
        FROM silver WHERE alerte_transport = 'FRAUDE'""",
    "notify_messages": _NOTIFY,
    "stream_notifications": _NOTIFY,
    "time_rules": f"""
        WITH ended AS (
            SELECT *, date_trunc('second', ts) + to_seconds(({K} - 50) * 7) AS fin FROM events)
        SELECT event_id, strftime(fin, '%Y-%m-%d %H:%M:%S') AS date_fin,
               floor((epoch_us(fin) - epoch_us(ts)) / 60000000.0)::BIGINT AS minutes,
               value / 1000 AS km
        FROM ended""",
    "casts": """
        SELECT event_id, CASE WHEN event_type <> 'error' THEN user_id::VARCHAR END AS id_salarie,
               CASE WHEN event_type <> 'view' THEN value END AS km,
               upper(event_type) AS categorie
        FROM events""",
    "preview_limit": f"""WITH {_ORDERS}
        SELECT id, id_salarie, type_sport, distance, epoch_us(debut)::VARCHAR AS date_debut,
               (epoch_us(debut) + duration_sec * 1000000)::VARCHAR AS date_fin, commentaire,
               duration_sec
        FROM bronze ORDER BY id LIMIT 20""",
}
