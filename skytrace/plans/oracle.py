"""The registered queries as DuckDB SQL, written independently with one window per series."""

from __future__ import annotations

import re

ZONE = "America/Denver"

# Named steps; a statement takes along the ones it needs.
STEPS = {
    "ev": """
        SELECT user_id AS u, event_id AS e, event_type = 'error' AS status,
               row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn,
               count(*) OVER (PARTITION BY user_id) AS n
        FROM events""",
    "climbing": """
        SELECT *, (n * 6) // 10 AS up,
               CASE u % 4 WHEN 0 THEN 1500 WHEN 1 THEN 2100 WHEN 2 THEN 1500 ELSE 2100 END AS g1,
               CASE u % 4 WHEN 0 THEN 1500 WHEN 1 THEN 2100 WHEN 2 THEN 2400 ELSE 1200 END AS g2,
               CASE u % 4 WHEN 0 THEN 2100 WHEN 1 THEN 1500 WHEN 2 THEN 1500 ELSE 2100 END AS g3
        FROM ev""",
    "topped": """
        SELECT *, 5200 + g1 * least(greatest(up - 8, 0), 7) + g2 * least(greatest(up - 15, 0), 8)
                  + g3 * greatest(up - 23, 0) AS top
        FROM climbing""",
    "flown": """
        SELECT *,
               CASE u % 50 WHEN 47 THEN 0 WHEN 45 THEN 5200 + rn * 20000 WHEN 44 THEN 6000 - rn * 5
                    WHEN 43 THEN 60000 - rn * 500 WHEN 42 THEN 5200 + rn * 1500 ELSE
               CASE WHEN rn <= up THEN
                        5200 + g1 * least(greatest(rn - 8, 0), 7)
                        + g2 * least(greatest(rn - 15, 0), 8) + g3 * greatest(rn - 23, 0)
                        + (e % 11) * 10 + CASE WHEN e % 53 = 0 AND rn > 10 THEN 9000 ELSE 0 END
                    WHEN rn <= n - 6 THEN
                        top - ((top - 5200) * (rn - up)) // greatest(n - 5 - up, 1) + (e % 11) * 5
                    ELSE 5200 + e % 3 END END AS alt,
               DATE '2024-01-01' + CAST(u % 300 AS INTEGER) AS day,
               rn * 120 + (e % 7) * 2
               + CASE WHEN u % 4 = 0 AND rn >= n - 2 THEN 1500 ELSE 0 END AS sec
        FROM topped""",
    "sent": """
        SELECT *, CAST(day AS TIMESTAMP)
                  + to_seconds(46800 + sec + CASE WHEN u % 50 = 49 THEN 86400 ELSE 0 END)
                   AS sent_at,
               'B' || u || '-' || CASE WHEN u % 50 = 46 THEN 0 ELSE e % 2 END AS own,
               CASE WHEN e % 17 = 0 THEN '>AP12P1' ELSE '>APZ001' END AS address,
               CASE WHEN status THEN
                        CASE WHEN rn > up AND u % 5 <> 0 THEN ':>DETECTED BURST at ' || top || 'ft'
                             ELSE ':>STATUS OK ' || e END
                    ELSE ',WIDE2-1:/'
                         || strftime(CAST(day AS TIMESTAMP) + to_seconds(46800 + sec), '%H%M%S')
                         || 'h /A=' || lpad(CAST(alt AS VARCHAR), 6, '0') || ' '
                         || (150 - floor(alt / 100.0))::BIGINT || 'T'
                         || greatest(8400 - rn * 100, 50) || 'P'
               END AS body
        FROM flown""",
    "copies": """
        SELECT *, 0 AS delay, '' AS path, '' AS suffix, NULL AS clock, '' AS sender, false AS silent
        FROM sent
        UNION ALL SELECT *, 3, '', '', NULL, '', false FROM sent WHERE e % 9 = 0
        UNION ALL SELECT *, 4, '', ' r', NULL, '', false FROM sent WHERE e % 13 = 0
        UNION ALL SELECT *, 5, ',WA0GEH-10', '', NULL, '', false FROM sent WHERE e % 37 = 0
        UNION ALL SELECT *, 0, '', '', '02:59:59', '', false FROM sent WHERE e % 29 = 0
        UNION ALL SELECT *, 0, '', '', '03:00:00', '', false FROM sent WHERE e % 31 = 0
        UNION ALL SELECT *, 0, '', ' z', '23:59:59', '', false FROM sent WHERE e % 41 = 0
        UNION ALL SELECT *, 6, '', ' x', NULL, 'X', false FROM sent WHERE e % 43 = 0
        UNION ALL SELECT *, 7, '', '', NULL, '', true FROM sent WHERE e % 47 = 0""",
    "pk": f"""
        SELECT coalesce((CAST(strftime(day, '%Y-%m-%d') || ' ' || clock AS TIMESTAMP)
                         AT TIME ZONE '{ZONE}') AT TIME ZONE 'UTC',
                        sent_at + to_seconds(e % 5 + delay)) AS tm,
               sender || own AS callsign, 20 + e % 40 AS speed_mph, e % 360 AS bearing,
               CASE WHEN NOT status AND NOT (u % 50 = 46 AND rn > 2) THEN alt END AS altitude,
               CASE WHEN NOT status AND u % 50 <> 48 THEN (39600 + rn * 4)::DOUBLE / 1000.0 END
                   AS latitude,
               CASE WHEN NOT status AND u % 50 <> 48 THEN (-104000 + rn * 9)::DOUBLE / 1000.0 END
                   AS longitude,
               CASE WHEN NOT silent THEN own || address || path || body || suffix END AS raw
        FROM copies""",
    "users": "SELECT DISTINCT user_id AS u FROM events",
    "fl": """
        SELECT 'FL-' || u AS flight, u,
               CASE WHEN u % 10 = 3 THEN ['B' || u || '-0', 'B' || u || '-1', 'B' || (u - 1) || '-0']
                    ELSE ['B' || u || '-0', 'B' || u || '-1'] END AS beacons,
               DATE '2024-01-01' + CAST(u % 300 AS INTEGER) AS date,
               CASE WHEN u % 7 = 0
                    THEN year(date) || '-' || month(date) || '-' || day(date)
                    ELSE strftime(date, '%Y-%m-%d') END AS day,
               ['1500gm', '2000gm', '3000gm'][u % 3 + 1] AS balloonsize,
               'Dome' AS description, CAST(u % 5 + 8 AS VARCHAR) AS size,
               ['client', 'vehicle', 'parachute', 'neckload', 'balloon', 'gross', 'necklift']
                   AS names,
               [CASE WHEN i = 0 AND u % 6 = 0 THEN 'x' ELSE
                   (u % 20 + i) || '.' || lpad(CAST(u % 100 AS VARCHAR), 2, '0') END
                for i in range(7)] AS amounts,
               '1.' || lpad(CAST(u % 60 AS VARCHAR), 2, '0') AS liftfactor,
               CAST(u % 300 + 100 AS VARCHAR) AS h2fill
        FROM users""",
    "beacon": "SELECT flight, date, unnest(beacons) AS callsign FROM fl",
    "matched": f"""
        SELECT b.flight, p.*
        FROM pk p JOIN beacon b ON p.callsign = b.callsign
         AND p.tm > ((CAST(b.date AS TIMESTAMP) + INTERVAL 3 HOUR)
                     AT TIME ZONE '{ZONE}') AT TIME ZONE 'UTC'
         AND p.tm < ((CAST(b.date AS TIMESTAMP) + INTERVAL 86399 SECOND)
                     AT TIME ZONE '{ZONE}') AT TIME ZONE 'UTC'
        WHERE p.raw NOT LIKE '%WA0GEH-10%'""",
    "earliest": """
        SELECT *, substring(raw, position(':' IN raw) + 1) AS info FROM matched
        QUALIFY row_number() OVER (PARTITION BY flight, substring(raw, position(':' IN raw) + 1)
                                   ORDER BY tm, callsign, raw) = 1""",
    "parse_in": "SELECT * FROM earliest",
    "ex": "PARSE(parse_in)",
    "complete": """
        SELECT *, altitude_ft > 0 AS position_packet FROM ex
        WHERE altitude_ft IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL
          AND packettime IS NOT NULL""",
    "positions": """
        SELECT * FROM complete WHERE position_packet
        QUALIFY row_number() OVER (PARTITION BY flight, callsign, packettime
                                   ORDER BY receivetime, info) = 1""",
    "steps": """
        SELECT *, count(*) OVER (PARTITION BY flight, callsign) AS beacon_rows,
               (epoch_ms(packettime) - epoch_ms(lag(packettime) OVER b)) / 1000.0::DOUBLE
                   AS timedelta_s,
               longitude - lag(longitude) OVER b AS dx, latitude - lag(latitude) OVER b AS dy,
               altitude_ft - lag(altitude_ft) OVER b AS dz,
               altitude_m - lag(altitude_m) OVER b AS dm
        FROM positions WINDOW b AS (PARTITION BY flight, callsign ORDER BY packettime)""",
    "deltas": """
        SELECT *, round(velocity_z_fts * 60.0::DOUBLE, 1) + 0 AS vert_rate_ftmin FROM (
            SELECT *,
                   CASE WHEN timedelta_s > 0 THEN round(dx / timedelta_s, 8) + 0 END
                       AS velocity_x_degs,
                   CASE WHEN timedelta_s > 0 THEN round(dy / timedelta_s, 8) + 0 END
                       AS velocity_y_degs,
                   CASE WHEN timedelta_s > 0 THEN round(dz / timedelta_s, 8) + 0 END
                       AS velocity_z_fts,
                   CASE WHEN timedelta_s > 0 THEN round(dm / timedelta_s, 8) + 0 END
                       AS velocity_z_ms
            FROM steps WHERE beacon_rows >= 2)""",
    "ranked": """
        SELECT *, row_number() OVER (PARTITION BY flight ORDER BY packettime, callsign) - 1
                   AS row_no,
               max(altitude_ft) OVER (PARTITION BY flight) AS apex_ft
        FROM deltas""",
    "apexed": """
        SELECT *, row_no <= apex_row AS ascending,
               max(CASE WHEN row_no = apex_row THEN altitude_m END) OVER (PARTITION BY flight)
                   AS apex_m
        FROM (SELECT *, min(CASE WHEN altitude_ft = apex_ft THEN row_no END)
                        OVER (PARTITION BY flight) AS apex_row FROM ranked)""",
    "no_stragglers": """
        SELECT * FROM (
            SELECT *, min(CASE WHEN timedelta_s > 500 AND altitude_ft < 8000 AND NOT ascending
                               THEN row_no END) OVER (PARTITION BY flight) AS cut FROM apexed)
        WHERE cut IS NULL OR row_no <= cut""",
    "no_outliers": """
        SELECT * FROM no_stragglers
        WHERE velocity_z_fts IS NULL
           OR CASE WHEN ascending THEN velocity_z_fts < 50 AND velocity_z_fts > -5
                   ELSE velocity_z_fts < 5 END""",
    "renumbered": """
        SELECT * REPLACE (row_number() OVER (PARTITION BY flight
                                             ORDER BY packettime, callsign) - 1 AS row_no),
               count(*) OVER (PARTITION BY flight) AS flight_rows,
               CAST(round(coalesce(velocity_z_fts, 0) * 1e8) AS BIGINT) AS units
        FROM no_outliers""",
    "averaged": """
        SELECT *,
               CASE WHEN flight_rows - row_no >= 3 THEN round(
                   sum(units) OVER (PARTITION BY flight ORDER BY row_no
                                    ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING)::DOUBLE / 3e8, 2) + 0
               END AS forward_avg,
               CASE WHEN flight_rows - row_no >= 10 THEN round(
                   sum(units) OVER (PARTITION BY flight ORDER BY row_no
                                    ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING)::DOUBLE / 1e9, 2) + 0
               END AS long_forward_avg
        FROM renumbered""",
    "launched": """
        SELECT *, coalesce(min(CASE
                   WHEN coalesce(velocity_z_fts, 0) > 0 AND coalesce(forward_avg, 0) > 5
                    AND coalesce(long_forward_avg, 0) > 5 AND ascending AND altitude_ft < 8000
                   THEN greatest(row_no - 1, 0) END) OVER (PARTITION BY flight), 0) AS first_row
        FROM averaged""",
    "landed": """
        SELECT *, coalesce(min(CASE
                   WHEN coalesce(velocity_z_fts, 0) > -5 AND coalesce(forward_avg, 0) > -5
                    AND coalesce(long_forward_avg, 0) > -5 AND NOT ascending
                    AND altitude_ft < 8000 AND row_no > first_row
                   THEN least(row_no + 1, flight_rows - 1) END) OVER (PARTITION BY flight),
               flight_rows - 1) AS end_row
        FROM launched""",
    "trimmed": """
        SELECT * REPLACE (row_no - first_row AS row_no,
                          CASE WHEN first_row > 0 OR end_row < flight_rows - 1
                               THEN end_row - first_row ELSE flight_rows END AS flight_rows)
        FROM landed
        WHERE (first_row = 0 AND end_row >= flight_rows - 1)
           OR (row_no >= first_row AND row_no < end_row)""",
    "topmost": """
        SELECT *, min(CASE WHEN altitude_ft = best THEN row_no END) OVER (PARTITION BY flight) + 1
                   AS ascent_rows
        FROM (SELECT *, max(altitude_ft) OVER (PARTITION BY flight) AS best FROM trimmed)""",
    "phased": """
        SELECT *, CASE WHEN row_no < ascent_rows THEN 'ascending' ELSE 'descending' END
                   AS flight_phase,
               CASE WHEN row_no < ascent_rows THEN row_no ELSE row_no - ascent_rows END
                   AS phase_row,
               CASE WHEN row_no < ascent_rows THEN ascent_rows ELSE flight_rows - ascent_rows END
                   AS phase_rows,
               radians(first_value(latitude) OVER f) AS lat1,
               radians(first_value(longitude) OVER f) AS lon1,
               radians(latitude) AS lat2, radians(longitude) AS lon2
        FROM topmost WHERE ascent_rows > 2
        WINDOW f AS (PARTITION BY flight ORDER BY row_no)""",
    "ranged": """
        SELECT *, round(distance_from_launch_mi * 1.609344::DOUBLE, 2) + 0
                   AS distance_from_launch_km
        FROM (SELECT *, round(2 * asin(sqrt(
                 sin((lat2 - lat1) / 2) * sin((lat2 - lat1) / 2)
                 + cos(lat1) * cos(lat2) * sin((lon2 - lon1) / 2) * sin((lon2 - lon1) / 2)))
                 * 3956, 2) + 0 AS distance_from_launch_mi FROM phased)""",
    "lined": """
        SELECT *, CASE WHEN abs(span) > 1e-10 THEN (a1 - a0) / span ELSE 0 END AS slope
        FROM (SELECT *,
                 (epoch_ms(packettime) - epoch_ms(first_value(packettime) OVER p))
                     / 1000.0::DOUBLE AS x,
                 (epoch_ms(last_value(packettime) OVER p) - epoch_ms(first_value(packettime) OVER p))
                     / 1000.0::DOUBLE AS span,
                 first_value(altitude_ft) OVER p AS a0, last_value(altitude_ft) OVER p AS a1,
                 velocity_z_fts - lag(velocity_z_fts) OVER q AS df,
                 velocity_z_ms - lag(velocity_z_ms) OVER q AS dmm
              FROM ranged
              WINDOW q AS (PARTITION BY flight, flight_phase ORDER BY row_no),
                     p AS (PARTITION BY flight, flight_phase ORDER BY row_no
                           ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))""",
    "moving": """
        SELECT *, CASE WHEN phase_rows > 2 THEN x END AS elapsed_secs,
               CASE WHEN phase_rows > 2 THEN
                   round((slope * x - altitude_ft + a0) / sqrt(slope * slope + 1), 6) + 0 END
                   AS distance_to_line,
               CASE WHEN phase_rows > 2 AND timedelta_s > 0 THEN round(df / timedelta_s, 6) + 0 END
                   AS acceleration_fts2,
               CASE WHEN phase_rows > 2 AND timedelta_s > 0 THEN round(dmm / timedelta_s, 6) + 0 END
                   AS acceleration_ms2
        FROM lined""",
    "farthest": """
        SELECT *, max(CASE WHEN far AND distance_to_line > 30 THEN distance_to_line END)
                   OVER (PARTITION BY flight) AS highest,
               min(CASE WHEN far AND distance_to_line < -30 THEN distance_to_line END)
                   OVER (PARTITION BY flight) AS lowest
        FROM (SELECT *, flight_phase = 'ascending' AND altitude_ft > 10000 AS far FROM moving)""",
    "turning": """
        SELECT *, min(CASE WHEN far AND distance_to_line = highest THEN row_no END)
                   OVER (PARTITION BY flight) AS mx,
               min(CASE WHEN far AND distance_to_line = lowest THEN row_no END)
                   OVER (PARTITION BY flight) AS mn
        FROM farthest""",
    "labelled": """
        SELECT *, CASE
            WHEN flight_phase = 'descending' OR (mx IS NULL AND mn IS NULL) THEN 'n/a'
            WHEN mn IS NULL THEN CASE WHEN row_no < mx THEN 'low Re' ELSE 'high Re' END
            WHEN mx IS NULL THEN CASE WHEN row_no < mn THEN 'high Re' ELSE 'low Re' END
            WHEN mx > mn THEN CASE WHEN row_no < mn THEN 'high Re' WHEN row_no < mx THEN 'low Re'
                                   ELSE 'high Re' END
            ELSE CASE WHEN row_no < mx THEN 'low Re' WHEN row_no < mn THEN 'high Re'
                      ELSE 'low Re' END END AS airflow
        FROM turning""",
    "regime": """
        SELECT *, CASE WHEN flight_phase = 'ascending' AND before <> airflow AND before <> 'n/a'
                            AND airflow <> 'n/a'
                       THEN split_part(before, ' ', 1) || '_to_' || split_part(airflow, ' ', 1)
                       ELSE '' END AS reynolds_transition
        FROM (SELECT *, lag(airflow) OVER (PARTITION BY flight, flight_phase ORDER BY row_no)
                        AS before FROM labelled)""",
    "tracked": """
        SELECT *,
               CASE WHEN temperature_k > 0 THEN
                   round(pressure_pa / (287.05::DOUBLE * temperature_k)
                         / 515.3788199999872::DOUBLE, 8) + 0 END AS airdensity_slugs,
               CASE WHEN temperature_k > 0 THEN
                   round(pressure_pa / (287.05::DOUBLE * temperature_k), 8) + 0 END
                   AS airdensity_kgm3
        FROM regime""",
    "burst": """
        SELECT flight, max(CASE WHEN regexp_matches(raw,
                   '(?i)DETECTED.*BURST|DETECTED COMMANDED RELEASE') THEN TRY_CAST(nullif(
                   regexp_extract(raw, '(?i)([0-9]+)\\s*ft', 1), '') AS BIGINT) END) AS feet
        FROM ex GROUP BY flight""",
    "summary": """
        SELECT flight, max(apex_ft) AS maxaltitude_ft, max(apex_m) AS maxaltitude_m,
               count(*) AS numpoints,
               (epoch_ms(max(packettime)) - epoch_ms(min(packettime))) / 1000.0::DOUBLE
                   AS flighttime_secs,
               (epoch_ms(max(packettime)) - epoch_ms(min(packettime))) // 3600000 || 'hrs '
               || (epoch_ms(max(packettime)) - epoch_ms(min(packettime))) % 3600000 // 60000
               || 'mins '
               || (epoch_ms(max(packettime)) - epoch_ms(min(packettime))) % 60000 // 1000
               || 'secs' AS flighttime,
               arg_max(distance_from_launch_mi, row_no) AS range_distance_traveled_mi,
               arg_max(distance_from_launch_km, row_no) AS range_distance_traveled_km,
               arg_min(latitude, row_no) AS "launch_location.latitude",
               arg_min(longitude, row_no) AS "launch_location.longitude",
               arg_min(altitude_ft, row_no) AS "launch_location.altitude_ft",
               arg_min(altitude_m, row_no) AS "launch_location.altitude_m",
               arg_max(latitude, row_no) AS "landing_location.latitude",
               arg_max(longitude, row_no) AS "landing_location.longitude",
               arg_max(altitude_ft, row_no) AS "landing_location.altitude_ft",
               arg_max(altitude_m, row_no) AS "landing_location.altitude_m",
               arg_max(distance_from_launch_mi, row_no)
                   AS "landing_location.distance_from_launch_mi",
               arg_max(distance_from_launch_km, row_no)
                   AS "landing_location.distance_from_launch_km"
        FROM ranged GROUP BY flight""",
    "weighed": """
        SELECT flight, size::DOUBLE AS size_ft, round(size::DOUBLE * 0.3048::DOUBLE, 2) AS size_m,
               unnest(names) AS name, coalesce(TRY_CAST(unnest(amounts) AS DOUBLE), 0) AS lb
        FROM fl""",
    "both_units": """
        SELECT flight, name || '_lb' AS weight, lb AS amount FROM weighed
        UNION ALL
        SELECT flight, name || '_kg', round(lb * 0.4535924::DOUBLE, 2) FROM weighed""",
    "chute": """
        SELECT flight, size_ft, size_m, lb AS weight_lb,
               round(lb * 0.4535924::DOUBLE, 2) AS weight_kg
        FROM weighed WHERE name = 'parachute'""",
    "status": """
        SELECT *, CASE WHEN extracted_rows = 0 THEN 'no_rows'
                       WHEN complete_rows = 0 THEN 'no_complete_rows'
                       WHEN position_rows = 0 THEN 'no_positions'
                       WHEN position_rows < 3 THEN 'too_few_rows'
                       WHEN filtered_rows < 3 THEN 'too_few_after_filter'
                       WHEN trimmed_rows < 3 THEN 'too_few_after_trim'
                       WHEN ascent_rows < 3 THEN 'short_ascent' ELSE 'ok' END AS status,
               CASE WHEN ascent_rows >= 3 THEN trimmed_rows - ascent_rows < 3 END AS short_descent
        FROM (SELECT fl.flight,
                     (SELECT count(*) FROM ex WHERE ex.flight = fl.flight) AS extracted_rows,
                     (SELECT count(*) FROM complete c WHERE c.flight = fl.flight) AS complete_rows,
                     (SELECT count(*) FROM deltas d WHERE d.flight = fl.flight) AS position_rows,
                     (SELECT count(*) FROM no_outliers o WHERE o.flight = fl.flight)
                         AS filtered_rows,
                     (SELECT count(*) FROM trimmed t WHERE t.flight = fl.flight) AS trimmed_rows,
                     coalesce((SELECT max(ascent_rows) FROM topmost m
                               WHERE m.flight = fl.flight), 0) AS ascent_rows
              FROM fl)""",
    "two_phase": "SELECT * FROM tracked WHERE flight_rows > ascent_rows",
    "vertices": """
        SELECT flight, flight_phase,
               CASE WHEN flight_phase = 'ascending' THEN row_no ELSE row_no - ascent_rows + 1 END
                   AS vertex, longitude, latitude, altitude_m
        FROM two_phase
        UNION ALL
        SELECT flight, 'descending', 0, longitude, latitude, altitude_m
        FROM two_phase WHERE row_no = ascent_rows - 1""",
    "targets": """
        SELECT flight, flight_phase, unnest(range(
                   CAST(ceil(min(altitude_ft) / 10000) * 10000 AS BIGINT),
                   greatest(CAST(trunc(max(altitude_ft)) AS BIGINT),
                            CAST(ceil(min(altitude_ft) / 10000) * 10000 AS BIGINT)), 10000))
                   AS target_ft
        FROM two_phase GROUP BY flight, flight_phase""",
    "nearest": """
        SELECT t.target_ft, r.* FROM targets t
        JOIN two_phase r ON r.flight = t.flight AND r.flight_phase = t.flight_phase
        QUALIFY row_number() OVER (PARTITION BY t.flight, t.flight_phase, t.target_ft
                                   ORDER BY abs(r.altitude_ft - t.target_ft), r.row_no) = 1""",
}

PARSE = f"""
        SELECT * EXCLUDE (digits, t, p),
               coalesce(TRY_STRPTIME(strftime(receivetime, '%Y-%m-%d') || ' ' || digits,
                                     '%Y-%m-%d %H%M%S'), receivetime) AS packettime,
               CAST(32.0 + 0.18 * t AS DOUBLE) AS temperature_f,
               CAST(0.1 * t AS DOUBLE) AS temperature_c,
               CAST(273.15 + 0.1 * t AS DOUBLE) AS temperature_k,
               CASE WHEN t IS NOT NULL THEN round(p / 10132.5::DOUBLE, 2) END AS pressure_atm,
               CASE WHEN t IS NOT NULL THEN CAST(p * 10 AS DOUBLE) END AS pressure_pa
        FROM (SELECT {{keys}}substring(raw, position(':' IN raw) + 1) AS info, callsign, raw,
                     date_trunc('milliseconds', (tm AT TIME ZONE 'UTC') AT TIME ZONE '{ZONE}')
                         AS receivetime,
                     CAST(bearing AS DOUBLE) AS bearing, CAST(speed_mph AS DOUBLE) AS speed_mph,
                     CAST(round(CAST(speed_mph AS DECIMAL(18, 6)) * 1.609344, 1) AS DOUBLE)
                         AS speed_kph,
                     CAST(altitude AS DOUBLE) AS altitude_ft,
                     CAST(round(CAST(altitude AS DECIMAL(18, 6)) * 0.3048, 2) AS DOUBLE)
                         AS altitude_m,
                     latitude, longitude,
                     nullif(regexp_extract(raw, '([0-9]{{{{6}}}})h', 1), '') AS digits,
                     CAST(nullif(regexp_extract(raw,
                          ' (-?[0-9]{{{{1,6}}}})T-?[0-9]{{{{1,6}}}}P', 1), '') AS INTEGER) AS t,
                     CAST(nullif(regexp_extract(raw, '([0-9]{{{{1,6}}}})P', 1), '') AS INTEGER)
                         AS p
              FROM {{table}})"""

STEPS["ex"] = PARSE.format(keys="flight, ", table="parse_in")
STEPS["parsed_pk"] = PARSE.format(keys="", table="pk")


def _expanding() -> None:
    """Running sums of whole units and the statistics taken from them."""
    sums, stats, norms = [], [], []
    for value, mean, std, norm, unit in (
        ("velocity_z_fts", "velocity_mean_fts", "velocity_std_fts", "velocity_norm_fts", "1e8"),
        ("velocity_z_ms", "velocity_mean_ms", "velocity_std_ms", "velocity_norm_ms", "1e8"),
        ("acceleration_fts2", "acceleration_mean_fts2", "acceleration_std_fts2",
         "acceleration_norm_fts2", "1e6"),
        ("acceleration_ms2", "acceleration_mean_ms2", "acceleration_std_ms2",
         "acceleration_norm_ms2", "1e6"),
    ):
        whole = f"CAST(round({value} * {unit}) AS HUGEINT)"
        sums += [f"count({value}) OVER w AS n_{mean}", f"sum({whole}) OVER w AS s_{mean}",
                 f"sum({whole} * {whole}) OVER w AS q_{mean}"]
        known = f"CASE WHEN {value} IS NOT NULL AND phase_rows > 2"
        n, s, q = f"n_{mean}", f"s_{mean}", f"q_{mean}"
        stats += [
            f"{known} THEN round({s}::DOUBLE / {n}::DOUBLE / {unit}, 6) + 0 END AS {mean}",
            f"{known} AND {n} > 1 THEN round(sqrt(({n} * {q} - {s} * {s})::DOUBLE"
            f" / ({n} * ({n} - 1))::DOUBLE / ({unit} * {unit})), 6) + 0 END AS {std}",
        ]
        norms.append(f"CASE WHEN {std} > 0 THEN round(({value} - {mean}) / {std}, 6) + 0 END"
                     f" AS {norm}")
    frame = ("(PARTITION BY flight, flight_phase ORDER BY row_no"
             " ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
    STEPS["summed"] = f"SELECT *, {', '.join(sums)} FROM tracked WINDOW w AS {frame}"
    STEPS["stats"] = f"SELECT *, {', '.join(stats)} FROM summed"
    STEPS["expanding"] = f"SELECT *, {', '.join(norms)} FROM stats"


def _spread(unit: str, column: str) -> str:
    whole = f"CAST(round({column} * 1e8) AS HUGEINT)"
    return (f"count({column}) AS {unit}_n, sum({whole}) AS {unit}_s,"
            f" sum({whole} * {whole}) AS {unit}_q")


def _moments(unit: str) -> str:
    n, s, q = f"{unit}_n", f"{unit}_s", f"{unit}_q"
    return (f"{s}::DOUBLE / {n}::DOUBLE / 1e8 AS {unit}_m, CASE WHEN {n} > 1 THEN"
            f" ({n} * {q} - {s} * {s})::DOUBLE / ({n} * ({n} - 1))::DOUBLE / 1e16 END AS {unit}_v")


def _degree(vmr: str) -> str:
    return (
        f"greatest(CASE WHEN {vmr} > 1.75 THEN CAST(trunc((13 + {vmr}) / {vmr}) AS INTEGER)"
        f" WHEN {vmr} >= 1 THEN CAST(trunc(13 / {vmr}) AS INTEGER) ELSE 13 END, 1)"
    )


_expanding()
STEPS["spread"] = f"""
        SELECT *, CASE WHEN abs(fts_m) > 1e-10 THEN fts_v / fts_m ELSE 0 END AS fts_r,
               CASE WHEN abs(ms_m) > 1e-10 THEN ms_v / ms_m ELSE 0 END AS ms_r
        FROM (SELECT *, {_moments('fts')}, {_moments('ms')}
              FROM (SELECT flight, flight_phase, {_spread('fts', 'velocity_z_fts')},
                           {_spread('ms', 'velocity_z_ms')}
                    FROM ranged GROUP BY flight, flight_phase))"""



def _curves(degree: int = 13) -> None:
    """Least-squares polynomials by orthogonal polynomials of the points themselves.

    Each next one is orthogonal to the two before it, so the fitted value of a degree is the sum of
    the projections up to it. Where a polynomial vanishes the points admit no higher degree.
    """
    parts = []
    gate = "count(velocity_z_fts) OVER p = count(*) OVER p AND count(*) OVER p > 2"
    for unit, x, y in (("fts", "altitude_ft", "velocity_z_fts"),
                       ("ms", "altitude_m", "velocity_z_ms")):
        parts.append(f"""
        SELECT r.flight, r.callsign, r.packettime, r.flight_phase, '{unit}' AS unit,
               {y} AS y, {gate} AS fit,
               least({_degree(unit + '_r')}, {unit}_n - 1) AS degree,
               CASE WHEN max({x}) OVER p - min({x}) OVER p < 2e-15 THEN 0 ELSE
                   ({x} - (max({x}) OVER p + min({x}) OVER p) / 2)
                   / ((max({x}) OVER p - min({x}) OVER p) / 2) END AS u
        FROM ranged r JOIN spread s ON s.flight = r.flight AND s.flight_phase = r.flight_phase
        WINDOW p AS (PARTITION BY r.flight, r.flight_phase)""")
    STEPS["points"] = " UNION ALL ".join(parts)
    sums = ("sum(p{0} * p{0}) OVER g AS s{0}, sum(u * p{0} * p{0}) OVER g AS t{0}, "
            "sum(y * p{0}) OVER g AS c{0}")
    group = "WINDOW g AS (PARTITION BY unit, flight, flight_phase)"
    STEPS["poly0"] = f"""
        SELECT *, {sums.format(0)} FROM (SELECT *, 1.0::DOUBLE AS p0 FROM points WHERE fit) {group}"""
    for k in range(1, degree + 1):
        earlier = f" - s{k - 1} / s{k - 2} * p{k - 2}" if k > 1 else ""
        before = f"s{k - 2}" if k > 1 else "1"
        STEPS[f"poly{k}"] = f"""
        SELECT *, {sums.format(k)} FROM (
            SELECT *, CASE WHEN s{k - 1} > 1e-24 * {before}
                           THEN (u - t{k - 1} / s{k - 1}) * p{k - 1}{earlier} END AS p{k}
            FROM poly{k - 1}) {group}"""
    used = [f"{k} <= degree AND s{k} > 1e-24 * {f's{k - 1}' if k else '1'}"
            for k in range(degree + 1)]
    terms = " + ".join(
        f"CASE WHEN {u} THEN c{k} / s{k} * p{k} ELSE 0 END" for k, u in enumerate(used))
    # The residuals are projected once more, and noise goes before the rounding to six decimals.
    more = " + ".join(
        f"CASE WHEN {u} THEN sum(more * p{k}) OVER g / s{k} * p{k} ELSE 0 END"
        for k, u in enumerate(used))
    STEPS["once"] = f"SELECT *, {terms} AS part, y - ({terms}) AS more FROM poly{degree}"
    STEPS["fitted"] = f"SELECT *, round(round(part + {more}, 9), 6) + 0 AS curve FROM once {group}"
    both = ", ".join(
        f"""(SELECT curve FROM fitted f WHERE f.unit = '{unit}' AND f.flight = r.flight
             AND f.callsign = r.callsign AND f.packettime = r.packettime)
             AS velocity_curvefit_{unit}""" for unit in ("fts", "ms"))
    STEPS["curved"] = f"SELECT r.flight, r.callsign, r.packettime, {both} FROM ranged r"


_curves()

TRACKED_COLUMNS = (
    "flight AS flightid, callsign, receivetime, packettime, altitude_ft, altitude_m, "
    "vert_rate_ftmin, elapsed_secs, flight_phase, position_packet, info, raw, bearing, speed_mph, "
    "speed_kph, latitude, longitude, distance_from_launch_mi, distance_from_launch_km, "
    "temperature_f, temperature_c, temperature_k, pressure_pa, pressure_atm, airdensity_slugs, "
    "airdensity_kgm3, velocity_x_degs, velocity_y_degs, velocity_z_fts, velocity_z_ms, airflow, "
    "acceleration_fts2, velocity_mean_fts, acceleration_mean_fts2, velocity_std_fts, "
    "acceleration_std_fts2, velocity_norm_fts, acceleration_norm_fts2, acceleration_ms2, "
    "velocity_mean_ms, acceleration_mean_ms2, velocity_std_ms, acceleration_std_ms2, "
    "velocity_norm_ms, acceleration_norm_ms2, reynolds_transition, velocity_curvefit_fts, "
    "velocity_curvefit_ms"
)
PUBLISHED = f"SELECT flight, {TRACKED_COLUMNS} FROM expanding JOIN curved USING (flight, callsign, packettime)"
KEY = "flight, callsign, packettime"
COLOUR = "CASE WHEN flight_phase = 'ascending' THEN 'ff0000ff' ELSE 'ffff0000' END AS colour"
WEIGHT_NAMES = ["client", "vehicle", "parachute", "neckload", "balloon", "gross", "necklift"]
NUMBER = r"regexp_replace(CAST({} AS VARCHAR), '\.0$', '')"


def _point(kind: str, name: str, colour: str, where: str) -> str:
    return (
        f"SELECT flight, '{kind}' AS kind, {name} AS name, '{colour}' AS colour, row_no, latitude,"
        f" longitude, altitude_ft, altitude_m, strftime(packettime, '%H:%M:%S') AS time"
        f" FROM two_phase WHERE {where}"
    )


FINAL = {
    "telemetry_extract": "SELECT * FROM parsed_pk",
    "beacon_window_join": "SELECT * FROM matched",
    "distinct_on_earliest": "SELECT flight, info, tm, callsign, raw FROM earliest",
    "position_filter": f"""SELECT {KEY}, info, altitude_ft, latitude, longitude, position_packet
        FROM complete""",
    "dedupe_packettime": f"SELECT {KEY}, receivetime, info FROM positions",
    "flight_callsigns": "SELECT DISTINCT flight, callsign FROM complete WHERE callsign IS NOT NULL",
    "beacon_velocity": f"""SELECT {KEY}, timedelta_s, velocity_x_degs, velocity_y_degs,
        velocity_z_fts, velocity_z_ms, vert_rate_ftmin FROM deltas""",
    "air_density": """SELECT flight, info, pressure_pa, temperature_k,
        CASE WHEN temperature_k > 0 THEN round(pressure_pa / (287.05::DOUBLE * temperature_k)
            / 515.3788199999872::DOUBLE, 8) + 0 END AS airdensity_slugs,
        CASE WHEN temperature_k > 0 THEN
            round(pressure_pa / (287.05::DOUBLE * temperature_k), 8) + 0 END AS airdensity_kgm3
        FROM ex""",
    "apex_flag": f"SELECT {KEY}, row_no, apex_ft, apex_m, ascending FROM apexed",
    "straggler_trim": f"SELECT {KEY}, row_no, timedelta_s, altitude_ft FROM no_stragglers",
    "outlier_eject": f"SELECT {KEY}, row_no, velocity_z_fts, ascending FROM no_outliers",
    "forward_avg": f"SELECT {KEY}, row_no, forward_avg, long_forward_avg FROM averaged",
    "forward_avg_events": """
        SELECT user_id, event_id,
               CASE WHEN count(*) OVER a = 3 THEN round(sum(units) OVER a::DOUBLE / 3e8, 2) END
                   AS mean_3,
               CASE WHEN count(*) OVER b = 10 THEN round(sum(units) OVER b::DOUBLE / 1e9, 2) END
                   AS mean_10
        FROM (SELECT *, CAST(round(coalesce(value, 0) * 1e8) AS BIGINT) AS units FROM events)
        WINDOW a AS (PARTITION BY user_id ORDER BY ts, event_id
                     ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING),
               b AS (PARTITION BY user_id ORDER BY ts, event_id
                     ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING)""",
    "launch_landing": f"SELECT {KEY}, row_no, flight_rows, altitude_ft FROM trimmed",
    "flight_status": "SELECT * FROM status",
    "outcome_counts": "SELECT status, count(*) AS flights FROM status GROUP BY status",
    "phase_elapsed_distance": f"""SELECT {KEY}, flight_phase, phase_row, elapsed_secs,
        distance_to_line, distance_from_launch_mi, distance_from_launch_km FROM moving""",
    "acceleration": f"SELECT {KEY}, flight_phase, acceleration_fts2, acceleration_ms2 FROM moving",
    "expanding_stats": f"""SELECT {KEY}, velocity_mean_fts, velocity_std_fts, velocity_norm_fts,
        velocity_mean_ms, velocity_std_ms, velocity_norm_ms, acceleration_mean_fts2,
        acceleration_std_fts2, acceleration_norm_fts2, acceleration_mean_ms2,
        acceleration_std_ms2, acceleration_norm_ms2 FROM expanding""",
    "expanding_stats_events": """
        SELECT user_id, event_id, running_mean, running_std,
               CASE WHEN running_std > 0 THEN round((value - running_mean) / running_std, 6) + 0
               END AS running_norm
        FROM (SELECT *, round(s::DOUBLE / n::DOUBLE / 1e8, 6) AS running_mean,
                     CASE WHEN n > 1 THEN round(sqrt((n * q - s * s)::DOUBLE
                         / (n * (n - 1))::DOUBLE / 1e16), 6) END AS running_std
              FROM (SELECT *, count(*) OVER w AS n,
                           sum(CAST(round(value * 1e8) AS HUGEINT)) OVER w AS s,
                           sum(CAST(round(value * 1e8) AS HUGEINT)
                               * CAST(round(value * 1e8) AS HUGEINT)) OVER w AS q
                    FROM events
                    WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)))""",
    "reynolds_regimes": f"""SELECT {KEY}, flight_phase, phase_row, airflow, reynolds_transition
        FROM regime""",
    "transition_list": """
        SELECT f.flight, t.pos, t.transition, t.altitude_ft, t.altitude_m
        FROM (SELECT DISTINCT flight FROM regime) f LEFT JOIN (
            SELECT flight, row_number() OVER (PARTITION BY flight ORDER BY row_no) - 1 AS pos,
                   reynolds_transition AS transition, altitude_ft, altitude_m
            FROM regime WHERE reynolds_transition <> '') t ON f.flight = t.flight""",
    "vmr_degree": f"""
        SELECT flight, flight_phase, round(fts_m, 9) AS fts_mean, round(fts_v, 9) AS fts_variance,
               round(fts_r, 9) AS fts_vmr, round(ms_m, 9) AS ms_mean, round(ms_v, 9) AS ms_variance,
               round(ms_r, 9) AS ms_vmr, fts_n, {_degree('fts_r')} AS fts_degree,
               {_degree('ms_r')} AS ms_degree
        FROM spread""",
    "polyfit_line": """
        SELECT flight, flight_phase,
               CASE WHEN count(velocity_z_fts) = count(*) AND count(*) > 2
                    THEN round(regr_slope(velocity_z_fts, altitude_ft), 9) END AS slope,
               CASE WHEN count(velocity_z_fts) = count(*) AND count(*) > 2
                    THEN round(regr_intercept(velocity_z_fts, altitude_ft), 6) END AS intercept
        FROM ranged GROUP BY flight, flight_phase""",
    "burst_altitude": """
        SELECT flight, feet IS NOT NULL AS detected, coalesce(feet, 0)::DOUBLE AS burst_ft,
               round(coalesce(feet, 0)::DOUBLE * 0.3048::DOUBLE, 2) AS burst_m FROM burst""",
    "flight_summary": "SELECT * FROM summary",
    "metadata_flatten": """
        SELECT s.*, fl.balloonsize, fl.day, fl.h2fill, fl.liftfactor,
               '["' || list_aggregate(fl.beacons, 'string_agg', '","') || '"]' AS beacons,
               coalesce(b.feet, 0)::DOUBLE AS "detected_burst.burst_ft",
               round(coalesce(b.feet, 0)::DOUBLE * 0.3048::DOUBLE, 2) AS "detected_burst.burst_m",
               b.feet IS NOT NULL AS "detected_burst.detected",
               fl.description AS "parachute.description", c.size_ft AS "parachute.size_ft",
               c.size_m AS "parachute.size_m", c.weight_kg AS "parachute.weight_kg",
               c.weight_lb AS "parachute.weight_lb",
               coalesce((SELECT '[' || string_agg('{"altitude_ft":' || altitude_ft
                          || ',"altitude_m":' || altitude_m || ',"transition":"'
                          || reynolds_transition || '"}', ',' ORDER BY row_no) || ']'
                         FROM regime r WHERE r.flight = fl.flight
                          AND r.reynolds_transition <> ''), '[]') AS reynolds_transitions, """
        + ", ".join(
            f'(SELECT amount FROM both_units w WHERE w.flight = fl.flight'
            f" AND w.weight = '{name}_{unit}') AS \"weights.{name}_{unit}\""
            for name in WEIGHT_NAMES for unit in ("lb", "kg"))
        + """
        FROM summary s JOIN fl ON s.flight = fl.flight JOIN chute c ON c.flight = fl.flight
        LEFT JOIN burst b ON b.flight = fl.flight""",
    "unit_weights": """
        SELECT c.flight, 'Dome' AS description, c.size_ft, c.size_m, c.weight_lb, c.weight_kg,
               w.weight, w.amount
        FROM chute c JOIN both_units w ON w.flight = c.flight""",
    "flight_list_flat": """
        SELECT flight, '["' || list_aggregate(beacons, 'string_agg', '","') || '"]' AS beacons, day,
               balloonsize, liftfactor, h2fill, description AS "parachute.description",
               size AS "parachute.size", """
        + ", ".join(f'amounts[{i + 1}] AS "weights.{name}"' for i, name in enumerate(WEIGHT_NAMES))
        + " FROM fl",
    "diagonal_union": """
        SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase'
        UNION ALL BY NAME
        SELECT event_id, ts, user_id FROM events WHERE event_type = 'click'
        UNION ALL BY NAME
        SELECT event_id, event_type FROM events
        WHERE event_type IS NULL OR event_type NOT IN ('purchase', 'click')""",
    "waypoints_nearest": f"""
        SELECT flight, flight_phase, (target_ft // 1000) || 'k' AS name, target_ft, row_no,
               latitude, longitude, altitude_ft, altitude_m,
               strftime(packettime, '%H:%M:%S') AS time, {COLOUR} FROM nearest""",
    "flight_paths": "SELECT * FROM vertices",
    "path_texts": f"""
        SELECT flight, flight_phase, CAST(0 AS BIGINT) AS part, upper(flight) || CASE
                   WHEN flight_phase = 'ascending' THEN ' Ascent' ELSE ' Descent' END AS name,
               {COLOUR}, CAST(count(*) AS INTEGER) AS vertices,
               string_agg({NUMBER.format('longitude')} || ',' || {NUMBER.format('latitude')} || ','
                          || {NUMBER.format('altitude_m')}, ' ' ORDER BY vertex) AS coordinates
        FROM vertices GROUP BY flight, flight_phase""",
    "points_of_interest": " UNION ALL ".join([
        _point("launch", "'Launch'", "ff00aaff", "row_no = 0"),
        _point("landing", "'Landing'", "ff00aaff", "row_no = flight_rows - 1"),
        _point("burst", "'Burst ' || CAST(round_even(altitude_ft, 0) AS BIGINT) || 'ft'",
               "ff00ffff", "row_no = ascent_rows - 1"),
        _point("transition", "CAST(round(altitude_ft / 1000) AS BIGINT) || 'k, ' || CASE"
               " WHEN reynolds_transition = 'high_to_low' THEN 'Turbulent-to-Laminar'"
               " ELSE 'Laminar-to-Turbulent' END", "ff006400", "reynolds_transition <> ''"),
    ]),
    "flight_captions": """
        SELECT s.flight, upper(s.flight) AS name, t.launch_time, s.flighttime AS duration,
               s.range_distance_traveled_mi AS range_mi, s.range_distance_traveled_km AS range_km,
               t.burst_ft, t.burst_m
        FROM summary s JOIN (
            SELECT flight, strftime(min(packettime), '%Y-%m-%d %H:%M:%S') AS launch_time,
                   max(CASE WHEN row_no = ascent_rows - 1 THEN altitude_ft END) AS burst_ft,
                   max(CASE WHEN row_no = ascent_rows - 1 THEN altitude_m END) AS burst_m
            FROM two_phase GROUP BY flight) t ON s.flight = t.flight""",
    "column_order": PUBLISHED,
    "column_order_sliced": PUBLISHED,
    "polyfit_curve": f"""SELECT {KEY}, flight_phase, velocity_curvefit_fts, velocity_curvefit_ms
        FROM ranged JOIN curved USING ({KEY})""",
    "dst_offset": f"""
        SELECT strftime(day, '%Y-%m-%d') AS day,
               epoch(wall) - epoch((wall AT TIME ZONE '{ZONE}') AT TIME ZONE 'UTC') = -21600
                   AS daylight_time
        FROM (SELECT day, CAST(day AS TIMESTAMP) + INTERVAL 3 HOUR AS wall
              FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders))""",
    "sink_roundtrip_parquet": PUBLISHED.replace("SELECT flight, ", "SELECT "),
    "sink_roundtrip_csv": PUBLISHED.replace("SELECT flight, ", "SELECT "),
    "sink_roundtrip_json": PUBLISHED.replace("SELECT flight, ", "SELECT "),
}


_RECORDS = FINAL["metadata_flatten"]
_TABLES = {
    "csv": {"csv/packets": "expanding", "csv/metadata": "summary"},
    "json": {"json/flights": "summary"},
    "parquet": {"parquet": "expanding"},
    "xlsx": {"xlsx/metadata": "pairs", "xlsx/phases": "expanding"},
    "kml": {"kml/captions": "captioned", "kml/paths": "phases", "kml/waypoints": "nearest",
            "kml/points": "points_found"},
}
_MERGED = [f"{kind}/flights_metadata" for kind in ("json", "csv", "xlsx")]
STEPS["records"] = _RECORDS
STEPS["pairs"] = """
        SELECT flight_id, name, value
        FROM (SELECT flight AS flight_id, COLUMNS(*)::VARCHAR FROM records)
        UNPIVOT INCLUDE NULLS (value FOR name IN (COLUMNS(* EXCLUDE flight_id)))"""
STEPS["phases"] = "SELECT DISTINCT flight, flight_phase FROM vertices"
STEPS["captioned"] = FINAL["flight_captions"]
STEPS["points_found"] = FINAL["points_of_interest"]
FINAL |= {
    "metadata_documents": _RECORDS,
    "declared_inputs": PUBLISHED,
    "packet_table_scan": FINAL["beacon_window_join"],
    "flight_list_read": FINAL["flight_list_flat"],
    "named_flight": f"""SELECT * FROM ({FINAL['beacon_window_join']})
        WHERE flight = (SELECT min(flight) FROM fl)""",
    "sink_metadata_csv": _RECORDS,
    "sink_workbook": "SELECT lower(flight_id) AS flight, name, value FROM pairs",
    "sink_workbook_phases": PUBLISHED.replace("SELECT flight, ", "SELECT "),
    "consolidated_array": """
        SELECT *, row_number() OVER (ORDER BY lower(flight)) - 1 AS place FROM records""",
    "output_tables": " UNION ALL ".join(
        f"""SELECT '{kind}' AS kind, '{table}' AS "table", count(*) AS "rows" FROM {step}"""
        for kind in ("all",) for table, step in (
            *(pair for tables in _TABLES.values() for pair in tables.items()),
            *((m, "summary") for m in _MERGED))),
}


def _needed(sql: str) -> list[str]:
    """Steps a statement rests on, in order."""
    names = list(STEPS)
    todo, needed = [sql], set()
    while todo:
        text = todo.pop()
        for name in names:
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                needed.add(name)
                todo.append(STEPS[name])
    return _ordered(needed)


def _ordered(needed: set[str]) -> list[str]:
    """Each step behind those it reads."""
    done: list[str] = []

    def visit(name: str) -> None:
        if name in done:
            return
        for other in needed - {name}:
            if re.search(rf"\b(FROM|JOIN)\s+{other}\b", STEPS[name]):
                visit(other)
        done.append(name)

    for name in sorted(needed):
        visit(name)
    return done


def statements() -> dict[str, str]:
    """Query name to a complete statement."""
    out = {}
    finals = dict(FINAL)
    for name in ("forward_avg_events", "expanding_stats_events", "flight_status"):
        finals[f"{name}_sliced"] = FINAL[name]
    for name, final in finals.items():
        steps = ",\n".join(f"{step} AS ({STEPS[step]})" for step in _needed(final))
        out[name] = f"WITH {steps}\n{final}" if steps else final
    return out
