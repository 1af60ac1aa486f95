"""DuckDB oracle SQL for the registered queries (same names, same columns).

Written independently of the Spark code, straight from the semantics, so a
match is evidence both are right. Floating-point expressions use the same
operation order as the Spark side so results agree to the last bit.
"""

from __future__ import annotations

from kestrel.plans import params as P


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


TRAFFIC_CTE = """
flows AS (
  SELECT s.s_nationkey AS o_nat, c.c_nationkey AS d_nat,
         CAST(year(o.o_orderdate) AS INTEGER) AS "YEAR", COUNT(*) AS cnt
  FROM lineitem l
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  GROUP BY 1, 2, 3),
traffic AS (
  SELECT no.n_name AS ORIGIN_COUNTRY_NAME, nd.n_name AS DEST_COUNTRY_NAME,
         CAST(cnt AS BIGINT) AS "COUNT", "YEAR"
  FROM flows JOIN nation no ON no.n_nationkey = o_nat
             JOIN nation nd ON nd.n_nationkey = d_nat)
"""


def _outwardness(how: str) -> str:
    home = _q(P.HOME)
    return f"""
WITH {TRAFFIC_CTE},
dst AS (SELECT DEST_COUNTRY_NAME AS COUNTRY_NAME, SUM("COUNT") AS n FROM traffic
        WHERE ORIGIN_COUNTRY_NAME = {home} AND DEST_COUNTRY_NAME <> {home} GROUP BY 1),
org AS (SELECT ORIGIN_COUNTRY_NAME AS COUNTRY_NAME, SUM("COUNT") AS n FROM traffic
        WHERE DEST_COUNTRY_NAME = {home} AND ORIGIN_COUNTRY_NAME <> {home} GROUP BY 1),
d AS (SELECT COUNTRY_NAME, CAST(n AS DOUBLE) / CAST(SUM(n) OVER () AS DOUBLE) * 100.0
             AS DEST_FREQUENCY FROM dst),
o AS (SELECT COUNTRY_NAME, CAST(n AS DOUBLE) / CAST(SUM(n) OVER () AS DOUBLE) * 100.0
             AS ORIGIN_FREQUENCY FROM org)
SELECT COALESCE(d.COUNTRY_NAME, o.COUNTRY_NAME) AS COUNTRY_NAME, DEST_FREQUENCY,
       ORIGIN_FREQUENCY, DEST_FREQUENCY - ORIGIN_FREQUENCY AS OUTWARDNESS
FROM d {how} JOIN o ON d.COUNTRY_NAME = o.COUNTRY_NAME
ORDER BY DEST_FREQUENCY DESC
"""


def _pivot() -> str:
    home = _q(P.HOME)
    cols = ",\n  ".join(
        f'SUM(CASE WHEN DEST_COUNTRY_NAME = {_q(c)} THEN "COUNT" END) AS "{c}"'
        for c in P.KEY_ZONES)
    zones = ", ".join(_q(c) for c in P.KEY_ZONES)
    return f"""
WITH {TRAFFIC_CTE}
SELECT "YEAR",
  {cols}
FROM traffic
WHERE ORIGIN_COUNTRY_NAME = {home} AND DEST_COUNTRY_NAME IN ({zones})
GROUP BY "YEAR" ORDER BY "YEAR"
"""


def _list(values) -> str:
    return "[" + ", ".join(_q(v) for v in values) + "]"


def _events_cte() -> str:
    from kestrel.sources.derived import COMPONENT_OF_EVENT
    comp = " ".join(f"WHEN {_q(e)} THEN {_q(c)}" for e, c in COMPONENT_OF_EVENT.items())
    return f"""
ev AS (
  SELECT *, CAST(regexp_extract(props, '"k":\\s*(\\d+)', 1) AS INTEGER) AS k,
         CASE event_type {comp} END AS comp
  FROM events)"""


def _logs_cte() -> str:
    from kestrel.sources.derived import INCOMPLETE_BELOW_K, LOG_LEVELS, LOG_MESSAGES
    iso = "'%Y-%m-%dT%H:%M:%S'"

    moment = r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}"
    form = _q(rf"^({moment})\|({moment})? - ([A-Z]) ([A-Z]+) - (.*?) - (.*)$")

    def ext(group):
        return f"regexp_extract(log, {form}, {group})"

    return f"""{_events_cte()},
lines AS (
  SELECT strftime(ts, {iso}) || '|' ||
         CASE WHEN k < {INCOMPLETE_BELOW_K} THEN '' ELSE strftime(ts + to_minutes(k), {iso}) END
         || ' - ' || comp || ' ' || ({_list(LOG_LEVELS)})[event_id % {len(LOG_LEVELS)} + 1]
         || ' - ' || regexp_replace(md5(CAST(event_id AS VARCHAR)),
                                    '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', '\\1-\\2-\\3-\\4-\\5')
         || ' - ' || ({_list(LOG_MESSAGES)})[user_id % {len(LOG_MESSAGES)} + 1] AS log
  FROM ev),
parsed AS (
  SELECT left({ext(1)}, 10) AS day, TRY_CAST(NULLIF({ext(1)}, '') AS TIMESTAMP) AS date_start,
         TRY_CAST(NULLIF({ext(2)}, '') AS TIMESTAMP) AS date_end,
         {ext(3)} AS composante, {ext(4)} AS niveau_log, {ext(5)} AS correlation_id,
         {ext(6)} AS message,
         CASE WHEN NOT regexp_matches(log, {form}) THEN 'bad_line' END AS reject_reason
  FROM lines)"""


def _activity(width: str) -> str:
    return f"""WITH {_logs_cte()}
SELECT day, time_bucket(INTERVAL '{width}', date_start) AS period_start,
       time_bucket(INTERVAL '{width}', date_start) + INTERVAL '{width}' AS period_end,
       COUNT(*) AS processed_requests_count
FROM parsed WHERE date_start IS NOT NULL GROUP BY 1, 2"""


def _gaps() -> str:
    m = P.SLOT_MINUTES
    return f"""WITH {_logs_cte()},
active AS (SELECT DISTINCT composante, time_bucket(INTERVAL '{m} minutes', date_start) AS slot
           FROM parsed WHERE date_start IS NOT NULL),
bounds AS (SELECT date_trunc('day', min(slot)) AS lo, date_trunc('day', max(slot)) AS hi FROM active),
calendar AS (SELECT composante, unnest(generate_series(lo, hi + INTERVAL '1 day' - INTERVAL '{m} minutes',
                                                       INTERVAL '{m} minutes')) AS slot
             FROM (SELECT DISTINCT composante FROM active), bounds),
empty AS (SELECT c.composante, c.slot FROM calendar c
          WHERE NOT EXISTS (SELECT 1 FROM active a WHERE a.composante = c.composante AND a.slot = c.slot)),
isl AS (SELECT composante, strftime(slot, '%Y-%m-%d') AS day, slot,
               CAST(epoch(slot) AS BIGINT) // {m * 60}
               - row_number() OVER (PARTITION BY composante, strftime(slot, '%Y-%m-%d') ORDER BY slot) AS grp
        FROM empty)
SELECT composante, day, min(slot) AS inactive_start, max(slot) + INTERVAL '{m} minutes' AS inactive_end
FROM isl GROUP BY composante, day, grp"""


def _incomplete() -> str:
    return f"""WITH {_logs_cte()}
SELECT day, time_bucket(INTERVAL '30 minutes', date_start) AS window_start,
       time_bucket(INTERVAL '30 minutes', date_start) + INTERVAL '30 minutes' AS window_end,
       CAST(COUNT(*) FILTER (WHERE date_end IS NULL) AS BIGINT) AS incomplete_requests_count
FROM parsed WHERE composante = {_q(P.INCOMPLETE_COMPONENT)} AND date_start IS NOT NULL
GROUP BY 1, 2"""


def _metrics() -> str:
    return f"""WITH {_events_cte()},
m AS (SELECT ts AS ts_, comp AS component, 10 + CAST(floor(value) AS INTEGER) % 80 AS ram_usage,
             20 + k % 60 AS cpu_usage FROM ev)
SELECT time_bucket(INTERVAL '1 minute', ts_) AS datetime_timestamp, component,
       COUNT(*) AS requests_count, max(ram_usage) AS max_used_ram, max(cpu_usage) AS max_used_cpu,
       avg(ram_usage) AS avg_used_ram, avg(cpu_usage) AS avg_used_cpu,
       quantile_disc(ram_usage, 0.7) AS percentile_70_used_ram,
       quantile_disc(cpu_usage, 0.7) AS percentile_70_used_cpu
FROM m WHERE ts_ IS NOT NULL GROUP BY 1, 2"""


def _metrics_by_day() -> str:
    cols = ", ".join(f"COUNT({m}) AS n_{m}, min({m}) AS min_{m}, max({m}) AS max_{m}, avg({m}) AS avg_{m}"
                     for m in ("ram_usage", "cpu_usage"))
    return f"""WITH {_events_cte()},
m AS (SELECT ts AS ts_, comp AS component, 10 + CAST(floor(value) AS INTEGER) % 80 AS ram_usage,
             20 + k % 60 AS cpu_usage FROM ev)
SELECT date_trunc('day', ts_) AS period, component, COUNT(*) AS samples, {cols}
FROM m WHERE ts_ IS NOT NULL GROUP BY 1, 2"""


def _gps_cte() -> str:
    """Normalized GPS text (dots), typed good rows, acceleration, nearest POI."""
    deg = "0.017453292519943295"

    def dist(lat1, lng1, alt1, lat2, lng2, alt2):
        sl = f"sin((({lat2}) - ({lat1})) * {deg} / 2.0)"
        sg = f"sin((({lng2}) - ({lng1})) * {deg} / 2.0)"
        a = f"(({sl} * {sl}) + (((cos(({lat1}) * {deg}) * cos(({lat2}) * {deg})) * {sg}) * {sg}))"
        c = f"(atan2(sqrt({a}), sqrt(1.0 - {a})) * 2.0)"
        d = f"((6371.0 * {c}) * 1000.0)"
        h = f"COALESCE(CAST({alt1} AS DOUBLE) - CAST({alt2} AS DOUBLE), 0.0)"
        return f"sqrt(({d} * {d}) + ({h} * {h}))"

    return f"""{_events_cte()},
ev2 AS (SELECT *, CAST(round(value * 100.0) AS BIGINT) AS v FROM ev),
raw AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS vin, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS dt,
         CASE WHEN k = 0 THEN '' ELSE '48.' || lpad(CAST(k AS VARCHAR), 2, '0') END AS lat,
         '2.' || lpad(CAST(v AS VARCHAR), 5, '0') AS lng, CAST(k AS VARCHAR) AS altitude,
         CASE WHEN k = 1 THEN 'n/a' ELSE CAST(v AS VARCHAR) END AS speed,
         event_type <> 'view' AS motion,
         CAST(v // 100 AS VARCHAR) || '.' || lpad(CAST(v % 100 AS VARCHAR), 2, '0') AS power,
         CAST(v // 50 AS VARCHAR) || '.5' AS distance, CAST(k AS VARCHAR) AS engineHours
  FROM ev2),
typed AS (
  SELECT *, TRY_CAST(dt AS TIMESTAMP) AS t_dt, TRY_CAST(lat AS DOUBLE) AS t_lat,
         TRY_CAST(lng AS DOUBLE) AS t_lng, CAST(TRY_CAST(altitude AS DOUBLE) AS INTEGER) AS t_alt,
         CAST(TRY_CAST(speed AS DOUBLE) AS INTEGER) AS t_speed, TRY_CAST(power AS DOUBLE) AS t_power,
         TRY_CAST(distance AS DOUBLE) AS t_distance,
         CAST(TRY_CAST(engineHours AS DOUBLE) AS INTEGER) AS t_eh
  FROM raw),
judged AS (
  SELECT *, CASE
    WHEN vin IS NULL OR COALESCE(trim(dt), '') = '' OR COALESCE(trim(lat), '') = ''
         OR COALESCE(trim(lng), '') = '' THEN 'missing_key'
    WHEN t_dt IS NULL THEN 'bad_dt' WHEN t_lat IS NULL THEN 'bad_lat' WHEN t_lng IS NULL THEN 'bad_lng'
    WHEN altitude <> '' AND t_alt IS NULL THEN 'bad_altitude'
    WHEN speed <> '' AND t_speed IS NULL THEN 'bad_speed'
    WHEN power <> '' AND t_power IS NULL THEN 'bad_power'
    WHEN distance <> '' AND t_distance IS NULL THEN 'bad_distance'
    WHEN engineHours <> '' AND t_eh IS NULL THEN 'bad_engineHours'
    WHEN COALESCE(t_speed > 0, false) AND COALESCE(NOT motion, false) THEN 'moving_while_parked'
  END AS reject_reason
  FROM typed),
good AS (
  SELECT event_id, vin, t_dt AS dt, t_lat AS lat, t_lng AS lng, t_alt AS altitude, t_speed AS speed,
         motion, t_power AS power, t_distance AS distance, t_eh AS engineHours
  FROM judged WHERE reject_reason IS NULL),
lagged AS (
  SELECT *, lag(dt) OVER w AS pdt, lag(speed) OVER w AS ps FROM good
  WINDOW w AS (PARTITION BY vin ORDER BY dt NULLS FIRST, speed NULLS FIRST, lat NULLS FIRST,
                                         lng NULLS FIRST)),
accel AS (
  SELECT * EXCLUDE (pdt, ps, dts), acceleration - 4.0 AS accelerationHarshness,
         -1.0 * (acceleration + 6.0) AS breakingHarshness
  FROM (SELECT *, CASE WHEN dts IS NOT NULL AND ps IS NOT NULL AND dts <> 0
                       THEN CAST(speed - ps AS DOUBLE) * 0.44704 / CAST(dts AS DOUBLE) END AS acceleration
        FROM (SELECT *, epoch_us(dt) // 1000000 - epoch_us(pdt) // 1000000 AS dts FROM lagged))),
poi AS (
  SELECT n_name AS name, 48.0 + CAST(n_nationkey AS DOUBLE) * 0.04 AS plat, 2.05 AS plng,
         CAST(NULL AS DOUBLE) AS palt, CAST(1 + n_regionkey AS DOUBLE) AS radius FROM nation),
nearest AS (
  SELECT event_id, CASE WHEN d <= radius * 1000.0 THEN name END AS poi FROM (
    SELECT g.event_id, p.name, p.radius,
           {dist("g.lat", "g.lng", "g.altitude", "p.plat", "p.plng", "p.palt")} AS d,
           row_number() OVER (PARTITION BY g.event_id ORDER BY
             {dist("g.lat", "g.lng", "g.altitude", "p.plat", "p.plng", "p.palt")}, p.name) AS rn
    FROM good g, poi p) WHERE rn = 1),
enriched AS (
  SELECT a.*, n.poi FROM accel a LEFT JOIN nearest n USING (event_id))"""


GPS_COLS = "vin, dt, lat, lng, altitude, speed, motion, power, distance, engineHours"


def spark_round(expr: str, n: int) -> str:
    """Spark's round of a double: HALF_UP on the digits of its shortest decimal
    string (0.058499999999999996 -> 0.058), not on x * 10^n in floating point."""
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38, 18)), {n}) AS DOUBLE)"


FIX_ORDER = "dt NULLS FIRST, speed NULLS FIRST, lat NULLS FIRST, lng NULLS FIRST"


def _trips() -> str:
    return f"""WITH {_gps_cte()},
begun AS (SELECT *, CASE WHEN dt - lag(dt) OVER w <= INTERVAL 6 HOURS THEN 0 ELSE 1 END AS begins FROM good
          WINDOW w AS (PARTITION BY vin ORDER BY {FIX_ORDER})),
numbered AS (SELECT *, sum(begins) OVER (PARTITION BY vin ORDER BY {FIX_ORDER} ROWS UNBOUNDED PRECEDING) AS trip FROM begun)
SELECT vin, min(dt) AS trip_start, max(dt) AS trip_end, count(*) AS fixes, sum(distance) AS distance
FROM numbered GROUP BY vin, trip"""


def _journeys() -> dict[str, str]:
    cte = f"WITH {_gps_cte()}"
    pieces = P.FEED_PIECES
    return {
        "gps_trips": _trips(),
        "stream_trips": _trips(),
        "gps_odometer": f"""{cte}
SELECT vin, dt, speed, distance, row_number() OVER w AS fix_number, sum(distance) OVER w AS odometer FROM good
WINDOW w AS (PARTITION BY vin ORDER BY {FIX_ORDER}, distance NULLS FIRST ROWS UNBOUNDED PRECEDING)""",
        "gps_moving_speed": f"""{cte}
SELECT vin, dt, speed, avg(speed) OVER w AS mean_speed, max(speed) OVER w AS max_speed, count(*) OVER w AS fixes_in_frame
FROM good WINDOW w AS (PARTITION BY vin ORDER BY dt RANGE BETWEEN INTERVAL {P.FRAME_SECONDS} SECONDS PRECEDING
                       AND CURRENT ROW)""",
        "driver_at_fix": f"""{cte},
signed AS (SELECT CAST(user_id AS VARCHAR) AS vehicle, ts AS valid_from, max(CAST(event_id % 97 AS VARCHAR)) AS driverId
           FROM events WHERE event_type = 'signup' GROUP BY 1, 2)
SELECT g.vin, g.dt, g.speed, s.driverId FROM good g ASOF LEFT JOIN signed s ON g.vin = s.vehicle AND g.dt >= s.valid_from""",
        "speed_rank": f"""{cte}
SELECT vin, dt, speed, lat, lng, row_number() OVER (ORDER BY speed DESC NULLS LAST, vin, dt, lat, lng) AS speed_rank
FROM good""",
        "stream_repeated_fixes": f"""{cte},
span AS (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM events),
placed AS (SELECT good.*, (epoch_us(dt) - lo) * {pieces} // (hi - lo + 1) AS piece FROM good, span),
delivered AS (SELECT {GPS_COLS} FROM placed
              UNION ALL SELECT {GPS_COLS} FROM placed WHERE event_id % {P.REPEATED_EVENT} = 0 AND piece + 2 < {pieces})
SELECT {GPS_COLS} FROM delivered QUALIFY row_number() OVER (PARTITION BY {GPS_COLS}) > 1""",
    }


def _kpis() -> str:
    return f"""WITH {_gps_cte()}
SELECT time_bucket(INTERVAL '1 hour', e.dt) AS hour, c.c_name AS driverName,
       {spark_round("sum(distance)", 2)} AS distance,
       {spark_round("sum(distance) * 0.00039", 3)} AS fuelConsumption,
       count(*) FILTER (WHERE accelerationHarshness > 0) AS harshAccelerationsCount,
       count(*) FILTER (WHERE breakingHarshness > 0) AS harshBreakingsCount,
       {spark_round("max(acceleration)", 3)} AS maxAcceleration,
       {spark_round("min(acceleration)", 3)} AS maxBreaking,
       count(DISTINCT poi) AS visitedPOIsCount
FROM enriched e JOIN customer c ON e.vin = CAST(c.c_custkey AS VARCHAR)
GROUP BY 1, 2"""


def _maint_cte(censor_last: bool = False) -> str:
    last = "WHERE w2.nxt IS NOT NULL" if censor_last else ""
    return f"""
iv AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS numero_intervention, o_orderpriority AS code_operation,
         CAST(o_custkey AS VARCHAR) AS id_materiel, o_orderdate AS date_debut_intervention,
         o_orderdate + to_days(CAST(1 + o_orderkey % 3 AS INTEGER)) AS date_fin_intervention,
         CAST(date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) * 40
              + o_orderkey % 40 AS INTEGER) AS releve_km
  FROM orders),
tr AS (
  SELECT CAST(o.o_custkey AS VARCHAR) AS id_materiel,
         CASE l.l_returnflag WHEN 'R' THEN 'RC' WHEN 'N' THEN 'NC' WHEN 'A' THEN 'C' END AS etat_organe,
         l.l_shipdate AS date_echeance, l.l_orderkey * 100 + l.l_linenumber AS trace_id
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
w AS (
  SELECT *, lead(date_debut_intervention) OVER (PARTITION BY id_materiel
              ORDER BY date_debut_intervention, numero_intervention) AS nxt
  FROM iv),
w2 AS (SELECT *, (nxt - date_debut_intervention) * 0.2 AS delta FROM w),
j13 AS (
  SELECT w2.id_materiel, COALESCE(t.etat_organe, 'TM') AS etat_organe, w2.date_debut_intervention,
         w2.date_fin_intervention, w2.releve_km, w2.numero_intervention, t.date_echeance, t.trace_id
  FROM w2 LEFT JOIN tr t ON w2.id_materiel = t.id_materiel
       AND t.date_echeance > w2.date_debut_intervention - w2.delta
       AND t.date_echeance <= w2.nxt - w2.delta
  {last}),
h AS (
  SELECT *, row_number() OVER (PARTITION BY id_materiel ORDER BY date_debut_intervention,
            numero_intervention, date_echeance NULLS FIRST, etat_organe NULLS FIRST,
            trace_id NULLS FIRST) AS rn
  FROM j13),
facts AS (
  SELECT id_materiel,
         arg_min(etat_organe, rn) AS f_state,
         min(rn) FILTER (WHERE rn > 1 AND etat_organe IN ('RC', 'NC', 'TM')) AS n_rn,
         min(rn) FILTER (WHERE rn > 1 AND etat_organe = 'C') AS c1_rn,
         max(rn) FILTER (WHERE rn > 1 AND etat_organe = 'C') AS cl_rn,
         max(CASE WHEN rn > 1 AND etat_organe = 'RC' THEN 1 ELSE 0 END) AS next_rc
  FROM h GROUP BY 1),
facts2 AS (
  SELECT f.*, n.etat_organe AS n_state FROM facts f
  LEFT JOIN h n ON n.id_materiel = f.id_materiel AND n.rn = f.n_rn)
"""


MAINT_CTE = _maint_cte()


def _operations() -> str:
    return f"""WITH {MAINT_CTE},
ops AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS numero_intervention, 'OP' || l_linenumber AS code_operation,
         CAST(o_custkey AS VARCHAR) AS id_materiel, o_orderdate AS date_debut_intervention,
         o_orderdate + to_days(CAST(1 + l_linenumber % 3 AS INTEGER)) AS date_fin_intervention,
         CAST(l_linenumber * 10 AS INTEGER) AS releve_km
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
ow AS (SELECT *, lead(date_debut_intervention) OVER (PARTITION BY id_materiel
         ORDER BY date_debut_intervention, numero_intervention, code_operation) AS nxt FROM ops),
od AS (SELECT *, (nxt - date_debut_intervention) * 0.2 AS delta FROM ow)
SELECT od.id_materiel, COALESCE(t.etat_organe, 'TM') AS etat_organe, od.date_debut_intervention,
       od.date_fin_intervention, od.releve_km, od.numero_intervention, od.code_operation, t.date_echeance
FROM od LEFT JOIN tr t ON od.id_materiel = t.id_materiel
     AND t.date_echeance > od.date_debut_intervention - od.delta
     AND t.date_echeance <= od.nxt - od.delta"""


def _lifetime(censor_last: bool = False) -> str:
    return f"""WITH {_maint_cte(censor_last)},
ruled AS (
  SELECT *, CASE
    WHEN f_state = 'RC' AND n_state = 'RC' THEN 1
    WHEN f_state = 'RC' AND n_state = 'NC' THEN 2
    WHEN f_state = 'RC' AND n_rn IS NULL AND c1_rn IS NOT NULL THEN 3
    WHEN f_state = 'NC' AND n_state = 'RC' AND c1_rn < n_rn THEN 4
    WHEN f_state = 'NC' AND n_state = 'NC' AND c1_rn < n_rn THEN 5
    WHEN f_state = 'NC' AND n_state = 'TM' AND c1_rn < n_rn THEN 6
    WHEN f_state = 'TM' AND n_state = 'RC' AND c1_rn < n_rn THEN 7
    WHEN f_state = 'TM' AND n_state = 'NC' AND c1_rn < n_rn THEN 8
    WHEN f_state = 'TM' AND n_state = 'TM' AND c1_rn < n_rn THEN 9 END AS rule
  FROM facts2),
plan AS (
  SELECT id_materiel,
         CASE WHEN rule IN (1, 2) THEN 'defaillant' WHEN rule IN (3, 6) THEN 'censure_droite'
              WHEN rule IN (4, 5, 7, 8) THEN 'censure_gauche' WHEN rule = 9 THEN 'censure' END AS cls,
         CASE WHEN rule IN (1, 2, 3) THEN 1 ELSE c1_rn END AS from_rn,
         CASE WHEN rule = 3 THEN cl_rn ELSE n_rn END AS to_rn,
         CASE WHEN rule IN (1, 2, 3, 4, 6) THEN 1 ELSE c1_rn END AS row_rn
  FROM ruled WHERE rule IS NOT NULL),
res AS (
  SELECT p.id_materiel, p.row_rn, p.cls,
         date_diff('day', CAST(fr.date_fin_intervention AS DATE),
                   CAST(tt.date_debut_intervention AS DATE)) AS jour,
         tt.releve_km - fr.releve_km AS km
  FROM plan p JOIN h fr ON fr.id_materiel = p.id_materiel AND fr.rn = p.from_rn
              JOIN h tt ON tt.id_materiel = p.id_materiel AND tt.rn = p.to_rn)
SELECT h.id_materiel, h.etat_organe, h.date_debut_intervention, h.date_fin_intervention, h.releve_km,
       CAST(r.jour AS INTEGER) AS duree_vie_jour, r.km AS duree_vie_km, r.cls AS type_individu
FROM h LEFT JOIN res r ON r.id_materiel = h.id_materiel AND r.row_rn = h.rn"""


def soundex_sql(x: str) -> str:
    """American Soundex as Spark computes it, in DuckDB SQL (DuckDB has none).

    First letter kept (upper-cased); H/W after it are skipped; other
    letters map to digit classes, vowels and non-letters to 0 (a separator);
    adjacent equal digits collapse; the first letter's own digit and the
    zeros are dropped; 3 digits, zero-padded. A string not starting with an
    ASCII letter is returned unchanged.
    """
    u = f"upper({x})"
    tail = f"regexp_replace(regexp_replace(substr({u}, 2), '[HW]', '', 'g'), '[^A-Z]', '0', 'g')"
    codes = f"translate(substr({u}, 1, 1) || {tail}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', " \
            f"'01230127022455012623017202')"
    for d in "01234567":
        codes = f"regexp_replace({codes}, '{d}+', '{d}', 'g')"
    digits = f"rpad(substr(replace(substr({codes}, 2), '0', ''), 1, 3), 3, '0')"
    return (f"CASE WHEN {x} = '' THEN '' WHEN NOT regexp_matches(substr({x}, 1, 1), '^[A-Za-z]$') "
            f"THEN {x} ELSE substr({u}, 1, 1) || {digits} END")


def _match_pairs(block=P.MATCH_BLOCK) -> str:
    on = " AND ".join(f"a.{c} = b.{c}" for c in block)
    cols = ", ".join(f"a.{c}" for c in block)
    return f"""pairs AS (
  SELECT a.p_partkey AS a_partkey, b.p_partkey AS b_partkey, a.p_name AS a_name, b.p_name AS b_name,
         {cols},
         1 - CAST(levenshtein(a.p_name, b.p_name) AS DOUBLE)
             / NULLIF(CAST(greatest(length(a.p_name), length(b.p_name)) AS DOUBLE), 0) AS score
  FROM part a JOIN part b ON {on} AND a.p_partkey < b.p_partkey)"""


def _matching(kind: str, block=P.MATCH_BLOCK) -> str:
    t = P.MATCH_THRESHOLD
    cols = "a_partkey, b_partkey, a_name, b_name, " + ", ".join(block) + ", score"
    snd = f"{soundex_sql('a_name')} AS sound_emetteur, {soundex_sql('b_name')} AS sound_client"
    same = f"{soundex_sql('a_name')} = {soundex_sql('b_name')}"
    where = {"fuzzy": f"score >= {t}", "phonetic": f"score >= {t}",
             "and": f"score >= {t} AND {same}", "or": f"(score >= {t} OR {same})"}[kind]
    extra = "" if kind == "fuzzy" else ", " + snd
    return f"WITH {_match_pairs(block)} SELECT {cols}{extra} FROM pairs WHERE {where}"


def _name_pairs() -> str:
    block = ", ".join(P.MATCH_BLOCK_COARSE)
    return f"""WITH n AS (SELECT {block}, p_name, COUNT(*) AS k FROM part GROUP BY ALL),
s AS (SELECT {", ".join("a." + c for c in P.MATCH_BLOCK_COARSE)}, a.p_name AS a_name, b.p_name AS b_name,
             1 - CAST(levenshtein(a.p_name, b.p_name) AS DOUBLE)
                 / NULLIF(CAST(greatest(length(a.p_name), length(b.p_name)) AS DOUBLE), 0) AS score,
             a.k AS n_left, b.k AS n_right
      FROM n a JOIN n b USING ({block}))
SELECT * FROM s WHERE score >= {P.MATCH_THRESHOLD}"""


def _compound_names() -> str:
    def side(name, prefix):
        return f"""(SELECT p_brand, codes, COUNT(*) AS {prefix}_names, SUM(k) AS n_{prefix} FROM (
  SELECT p_brand, k, (SELECT string_agg({soundex_sql("w")}, ' ' ORDER BY i) FROM (
           SELECT unnest(words) AS w, generate_subscripts(words, 1) AS i)) AS codes
  FROM (SELECT p_brand, COUNT(*) AS k, regexp_extract_all(strip_accents({name}), '[A-Za-z]+') AS words
        FROM part GROUP BY p_brand, {name})) WHERE codes IS NOT NULL GROUP BY 1, 2)"""

    other = "replace(translate(p_name, 'aeiou', 'àéîôü'), ' ', '-')"
    return f"""SELECT p_brand, codes, left_names, CAST(n_left AS BIGINT) AS n_left, right_names,
       CAST(n_right AS BIGINT) AS n_right
FROM {side("p_name", "left")} JOIN {side(other, "right")} USING (p_brand, codes)"""


def _field_match() -> str:
    def sim(c):
        return (f"COALESCE(1 - CAST(levenshtein(a.{c}, b.{c}) AS DOUBLE) / "
                f"NULLIF(CAST(greatest(length(a.{c}), length(b.{c})) AS DOUBLE), 0), 0.0)")

    def same(c):
        a, b = soundex_sql(f"a.{c}"), soundex_sql(f"b.{c}")
        return f"COALESCE(({a}) = ({b}), false)"

    t = P.MATCH_THRESHOLD
    return f"""WITH n AS (SELECT p_brand, p_size, p_name, p_type, COUNT(*) AS k FROM part GROUP BY ALL),
s AS (SELECT a.p_brand, a.p_size, a.p_name AS a_name, a.p_type AS a_type, a.k AS n_left,
             b.p_name AS b_name, b.p_type AS b_type, b.k AS n_right,
             {sim("p_name")} AS score_a_name, {sim("p_type")} AS score_a_type,
             {same("p_name")} AS s1, {same("p_type")} AS s2
      FROM n a JOIN n b ON a.p_brand = b.p_brand AND a.p_size = b.p_size),
m AS (SELECT *, (0.0 + score_a_name + score_a_type) / 2.0 AS score FROM s
      WHERE score_a_name >= {t} OR score_a_type >= {t} OR s1 OR s2)
SELECT p_brand, p_size, a_name, a_type, n_left, b_name, b_type, n_right, score_a_name, score_a_type,
       s1 AND s2 AS same_sound, score
FROM m WHERE score >= {t} OR (s1 AND s2)"""


def oracles() -> dict[str, str]:
    home = _q(P.HOME)
    out = {
        "traffic_table": f"WITH {TRAFFIC_CTE} SELECT * FROM traffic",
        "traffic_rows_per_year":
            f'WITH {TRAFFIC_CTE} SELECT "YEAR", COUNT(*) AS "count" FROM traffic GROUP BY 1',
        "domestic_routes": f"WITH {TRAFFIC_CTE} SELECT * FROM traffic "
                           f"WHERE ORIGIN_COUNTRY_NAME = {home} AND DEST_COUNTRY_NAME = {home}",
        "outwardness": _outwardness("INNER"),
        "outwardness_full": _outwardness("FULL OUTER"),
        "key_zone_pivot": _pivot(),
        "log_lines": f"WITH {_logs_cte()} SELECT log FROM lines",
        "parse_logs": f"WITH {_logs_cte()} SELECT * FROM parsed",
        "activity_30min": _activity("30 minutes"),
        "activity_hourly": _activity("1 hour"),
        "inactivity_gaps": _gaps(),
        "incomplete_requests": _incomplete(),
        "component_metrics": _metrics(),
        "gps_clean": f"WITH {_gps_cte()} SELECT {GPS_COLS} FROM good",
        "gps_rejects": f"WITH {_gps_cte()} SELECT vin, dt, replace(lat, '.', ',') AS lat, "
                       "replace(lng, '.', ',') AS lng, altitude, speed, "
                       "CASE WHEN motion THEN '1' ELSE '0' END AS motion, "
                       "replace(power, '.', ',') AS power, replace(distance, '.', ',') AS distance, "
                       "engineHours, reject_reason FROM judged WHERE reject_reason IS NOT NULL",
        "gps_acceleration": f"WITH {_gps_cte()} SELECT {GPS_COLS}, acceleration, "
                            "accelerationHarshness, breakingHarshness FROM accel",
        "gps_nearest_poi": f"WITH {_gps_cte()} SELECT {GPS_COLS}, poi FROM good "
                           "LEFT JOIN nearest USING (event_id)",
        "gps_enriched": f"WITH {_gps_cte()} SELECT {GPS_COLS}, acceleration, "
                        "accelerationHarshness, breakingHarshness, poi FROM enriched",
        "driver_kpis": _kpis(),
        "assign_state": f"WITH {MAINT_CTE} SELECT id_materiel, etat_organe, date_debut_intervention, "
                        "date_fin_intervention, releve_km FROM j13",
        "next_state": f"""WITH {MAINT_CTE}
SELECT h.id_materiel, h.etat_organe, h.date_debut_intervention, h.date_fin_intervention, h.releve_km,
       f.f_state AS first_element, f.n_state AS element_trouve, CAST(f.next_rc AS INTEGER) AS next_rc
FROM h JOIN facts2 f USING (id_materiel)""",
        "lifetime": _lifetime(),
        "lifetime_censored": _lifetime(censor_last=True),
        "fuzzy_match": _matching("fuzzy"),
        "fuzzy_match_brand": _matching("fuzzy", P.MATCH_BLOCK_COARSE),
        "fuzzy_name_pairs": _name_pairs(),
        "field_match": _field_match(),
        "phonetic_match": _matching("phonetic"),
        "combined_match_and": _matching("and"),
        "combined_match_or": _matching("or"),
    }
    # the streaming job must give exactly the batch answer
    out["stream_enriched"] = out["gps_enriched"]
    out["stream_rejects"] = out["gps_rejects"]
    out["stream_enriched_batches"] = out["gps_enriched"]
    messages = _gps_cte().replace("FROM judged WHERE reject_reason IS NULL",
                                  "FROM judged WHERE engineHours NOT IN ('0', '1')")
    out["stream_messages"] = (f"WITH {messages} SELECT vin, dt, lat, lng, CAST(speed AS DOUBLE) AS speed, "
                              "acceleration, poi FROM enriched")
    out["stream_poi_messages"] = f"WITH {messages} SELECT vin, dt, poi FROM enriched WHERE poi IS NOT NULL"
    out["assign_state_operations"] = _operations()
    out["driver_kpis_from_files"] = out["driver_kpis"]
    out |= _journeys()
    out["assign_state_dyadic"] = out["assign_state"]
    out["metrics_by_day"] = _metrics_by_day()
    out["compound_names"] = _compound_names()
    out["stream_keyed_enriched"] = out["gps_enriched"]
    out["stream_component_metrics"] = out["component_metrics"]
    out["stream_activity_30min"] = out["activity_30min"]
    return out
