"""DuckDB SQL for every query with a SQL form. Views ``events``, ``nation`` ... are the driver's tables.

The common prefix rebuilds the stand-in readings exactly as the Spark plan does: snapshot element
fields from events + nation, synop-like weather from events, calendar features, bins, the per-day
weather join and the full-row distinct.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------------------------
# Shared CTEs
# ---------------------------------------------------------------------------------------------

_ELEMENTS = """
el AS (
  SELECT e.user_id AS id,
         CAST(e.user_id AS VARCHAR) || ' - ' || n.n_name AS name,
         date_trunc('second', e.ts) AS ts,
         CAST(json_extract_string(e.props, '$.k') AS INTEGER) % 20 AS places,
         CAST(floor(e.value) AS INTEGER) % 20 AS bikes,
         CAST(48800 + e.user_id % 100 AS DOUBLE) / 1000.0 AS lt,
         CAST(2300 + n.n_nationkey AS DOUBLE) / 1000.0 AS lg,
         CASE WHEN e.event_type = 'error' THEN 'CLOSED' ELSE 'OPEN' END AS status
  FROM events e JOIN nation n ON n.n_nationkey = e.user_id % 25
)"""

_WEATHER = """
wobs AS (
  SELECT CASE WHEN user_id % 3 = 0 AND day(ts) % 10 <> 7 THEN '07190'
              ELSE lpad(CAST(user_id % 1000 AS VARCHAR), 5, '0') END AS numer_sta,
         strftime(ts, '%Y%m%d%H%M%S') AS date,
         CAST(268.15 AS DOUBLE) + value % 30 AS t
  FROM events
),
wday AS (
  SELECT obs_day, temperature,
         CAST(CASE WHEN temperature < 15 THEN 0 WHEN temperature >= 15 THEN 1 END AS DOUBLE) AS soleil
  FROM (SELECT substr(date, 1, 8) AS obs_day,
               struct_extract(min({'d': date, 't': t}), 't') - CAST(273.15 AS DOUBLE) AS temperature
        FROM wobs WHERE numer_sta = '07190' AND t IS NOT NULL GROUP BY 1) q
)"""


def _rd(name_filter: str | None) -> str:
    flt = "" if name_filter is None else f" AND contains(lower(name), lower('{name_filter}'))"
    return f"""
rd AS (
  SELECT id, name, places, bikes, lt, lg, epoch_ms(ts) AS dtUpdate,
         CAST(dayofweek(ts) AS INTEGER) AS day, CAST(hour(ts) AS INTEGER) AS hour,
         CAST(minute(ts) - minute(ts) % 5 AS INTEGER) AS minute,
         strftime(ts, '%Y%m%d') AS obs_day,
         CAST(CASE WHEN places > 9 THEN 2 WHEN places > 3 THEN 1 ELSE 0 END AS DOUBLE) AS nPlace,
         CAST(CASE WHEN bikes > 9 THEN 2 WHEN bikes > 3 THEN 1 ELSE 0 END AS DOUBLE) AS nBike
  FROM el WHERE status = 'OPEN'{flt}
)"""


_READINGS = """
readings AS (
  SELECT DISTINCT r.bikes, r.day, r.dtUpdate, r.hour, r.id, r.nBike * 3 + r.nPlace AS label, r.lg, r.lt,
         r.minute, r.nBike, r.nPlace, r.name, r.places, w.soleil,
         CAST(r.day * 24 + r.hour * 60 + r.minute AS INTEGER) AS x,
         CAST(r.day * 1440 + r.hour * 60 + r.minute AS INTEGER) AS minute_of_week
  FROM rd r LEFT JOIN wday w ON w.obs_day = r.obs_day
)"""


def with_readings(body: str, name_filter: str | None = None, extra: str = "") -> str:
    """``WITH el, wobs, wday, rd, readings[, extra] <body>``."""
    ctes = [_ELEMENTS, _WEATHER, _rd(name_filter), _READINGS]
    if extra:
        ctes.append(extra)
    return "WITH " + ",".join(ctes) + "\n" + body


READING_COLS = ("bikes, day, dtUpdate, hour, id, label, lg, lt, minute, nBike, nPlace, name, places, "
                "soleil, x, minute_of_week")

# ---------------------------------------------------------------------------------------------
# Per-query SQL
# ---------------------------------------------------------------------------------------------

SQL: dict[str, str] = {}

SQL["curate_readings"] = with_readings(f"SELECT {READING_COLS} FROM readings")

_LATEST = """
st AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY dtUpdate DESC, bikes DESC, places DESC, name DESC) AS rn
    FROM readings) q WHERE rn = 1
)"""

_REQUESTS = """
req AS (
  SELECT c_custkey AS req_id, CAST(c_custkey % 200 AS VARCHAR) || ' - NATION_' AS station,
         CAST(c_custkey % 7 AS INTEGER) AS req_day, CAST((c_custkey * 5) % 24 AS INTEGER) AS req_hour,
         CAST((c_custkey * 7) % 60 AS INTEGER) AS req_minute, CAST(c_custkey % 2 AS DOUBLE) AS req_soleil,
         CAST(c_custkey * 37 % 20160 AS BIGINT) AS delay
  FROM customer
),
res AS (
  SELECT q.*, s.id, s.name AS station_name, s.nBike, s.nPlace, s.label
  FROM st s JOIN req q ON contains(s.name, q.station)
)"""

_BASELINE = """
spl AS (
  SELECT *, CAST(CAST(('0x' || substr(md5(CAST(id AS VARCHAR) || ':' || CAST(dtUpdate AS VARCHAR)), 1, 8)) AS BIGINT)
                 % 100 AS INTEGER) AS bucket
  FROM readings
),
tr AS (SELECT * FROM spl WHERE bucket < 60),
te AS (SELECT * FROM spl WHERE bucket >= 60),
mt AS (
  SELECT id, hour, label AS prediction FROM (
    SELECT id, hour, label, row_number() OVER (PARTITION BY id, hour ORDER BY n DESC, label ASC) AS rn
    FROM (SELECT id, hour, label, count(*) AS n FROM tr GROUP BY id, hour, label) a) b
  WHERE rn = 1
),
gm AS (SELECT label AS g FROM (SELECT label, count(*) AS n FROM tr GROUP BY label) c ORDER BY n DESC, label ASC LIMIT 1),
pred AS (
  SELECT te.label, COALESCE(mt.prediction, (SELECT g FROM gm)) AS prediction
  FROM te LEFT JOIN mt ON mt.id = te.id AND mt.hour = te.hour
),
cc AS (SELECT label, prediction, count(*) AS n FROM pred GROUP BY label, prediction),
act AS (SELECT label AS cls, CAST(sum(n) AS BIGINT) AS n_actual,
               CAST(sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS BIGINT) AS tp FROM cc GROUP BY label),
prd AS (SELECT prediction AS cls, CAST(sum(n) AS BIGINT) AS n_predicted FROM cc GROUP BY prediction),
per AS (
  SELECT COALESCE(a.cls, p.cls) AS cls, COALESCE(a.tp, 0) AS tp, COALESCE(a.n_actual, 0) AS n_actual,
         COALESCE(p.n_predicted, 0) AS n_predicted
  FROM act a FULL OUTER JOIN prd p ON a.cls = p.cls
),
pc0 AS (
  SELECT cls AS label, tp, n_actual, n_predicted, CAST(sum(n_actual) OVER () AS BIGINT) AS n_total FROM per
),
pc1 AS (
  SELECT *,
    CASE WHEN n_predicted = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(tp AS DOUBLE) / CAST(n_predicted AS DOUBLE) END AS precision,
    CASE WHEN n_actual = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(tp AS DOUBLE) / CAST(n_actual AS DOUBLE) END AS recall,
    CASE WHEN n_total - n_actual = 0 THEN CAST(0 AS DOUBLE)
         ELSE CAST(n_predicted - tp AS DOUBLE) / CAST(n_total - n_actual AS DOUBLE) END AS false_positive_rate
  FROM pc0
),
pc AS (
  SELECT *, CASE WHEN precision + recall = 0 THEN CAST(0 AS DOUBLE)
                 ELSE CAST(2 AS DOUBLE) * precision * recall / (precision + recall) END AS f1
  FROM pc1
)"""

_IDX = """
ix AS (
  SELECT id, n, CAST(row_number() OVER (ORDER BY n DESC, CAST(id AS VARCHAR)) - 1 AS DOUBLE) AS id_index
  FROM (SELECT id, count(*) AS n FROM readings WHERE soleil IS NOT NULL GROUP BY id) c
)"""

_RAW = """
raw AS (
  SELECT r.bikes, r.day, r.dtUpdate, r.hour, r.id, r.nBike * 3 + r.nPlace AS label, r.lg, r.lt,
         r.minute, r.nBike, r.nPlace, r.name, r.places, w.soleil,
         CAST(r.day * 24 + r.hour * 60 + r.minute AS INTEGER) AS x,
         CAST(r.day * 1440 + r.hour * 60 + r.minute AS INTEGER) AS minute_of_week
  FROM rd r LEFT JOIN wday w ON w.obs_day = r.obs_day
)"""

_LATEST_DAY = """
lday AS (
  SELECT * FROM readings
  WHERE strftime(make_timestamp(dtUpdate * 1000), '%Y%m%d') =
        (SELECT max(strftime(ts, '%Y%m%d')) FROM el)
)"""

_LABEL_TEXT = ("'bikes ' || ['0-3', '4-9', '10+'][CAST(floor(label / 3) AS INTEGER) + 1] || ', places ' || "
               "['0-3', '4-9', '10+'][CAST(label AS INTEGER) % 3 + 1]")


def _ctes(*extra: str) -> str:
    return ",".join(x.strip("\n") for x in extra)


SQL["scan_snapshots"] = SQL["curate_readings"]
SQL["export_ordered"] = SQL["curate_readings"]
SQL["load_latest"] = with_readings(f"SELECT {READING_COLS} FROM lday", extra=_LATEST_DAY)
SQL["append_readings"] = SQL["curate_readings"]
SQL["scan_array_files"] = SQL["curate_readings"]
SQL["weather_backfill"] = SQL["curate_readings"]

SQL["open_stations"] = with_readings("""
SELECT CAST(id AS VARCHAR) AS number, name, strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS last_update,
       CAST(places AS VARCHAR) AS available_bike_stands, CAST(bikes AS VARCHAR) AS available_bikes,
       lt, lg, status
FROM el WHERE status = 'OPEN'""")

SQL["name_filter"] = with_readings(f"SELECT {READING_COLS} FROM readings", name_filter="TION_1")

SQL["station_lookup"] = with_readings(f"""
SELECT {READING_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY dtUpdate DESC, bikes DESC, places DESC, name DESC) AS rn
  FROM readings WHERE contains(name, 'NATION_1')) q
WHERE rn = 1""")

SQL["drop_columns"] = with_readings(
    "SELECT bikes, day, hour, id, label, minute, name, places, soleil, x, minute_of_week FROM readings")

SQL["distinct_readings"] = with_readings(
    f"SELECT DISTINCT * FROM (SELECT {READING_COLS} FROM raw UNION ALL SELECT {READING_COLS} FROM raw) u",
    extra=_RAW)

SQL["dedup_identity"] = with_readings(f"""
SELECT {READING_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY nBike, id, soleil, minute, day, hour, nPlace
                               ORDER BY dtUpdate DESC, bikes DESC, places DESC, name DESC) AS rn
  FROM readings) q
WHERE rn = 1""")

SQL["reading_count"] = with_readings("SELECT count(*) AS n_readings FROM readings")

SQL["natural_order"] = with_readings("SELECT id, dtUpdate, label FROM readings ORDER BY id, dtUpdate")

SQL["preview"] = with_readings(f"""
SELECT bikes, day, dtUpdate, hour, id, label, lg, lt, minute, nBike, nPlace,
       CASE WHEN length(name) > 100 THEN substr(name, 1, 97) || '...' ELSE name END AS name,
       places, soleil, x, minute_of_week
FROM readings ORDER BY id, dtUpdate, bikes, places, name LIMIT 1000""")

SQL["station_list"] = with_readings(f"""
SELECT id, name, day, hour, minute, strftime(make_timestamp(dtUpdate * 1000), '%d/%m %H:%M') AS at_text,
       {_LABEL_TEXT} AS label_text, nPlace, nBike
FROM (SELECT * FROM readings ORDER BY name, x, dtUpdate, bikes, places LIMIT 2000) q""")

SQL["split_train_test"] = with_readings("""
SELECT id, dtUpdate, bucket, CASE WHEN bucket < 60 THEN 'train' ELSE 'test' END AS part FROM spl""",
                                        extra=_BASELINE)

SQL["weather_enrich"] = with_readings("""
SELECT r.id, r.dtUpdate, r.obs_day, w.temperature, w.soleil FROM rd r LEFT JOIN wday w ON w.obs_day = r.obs_day""")

SQL["request_resolve"] = with_readings("SELECT req_id, station, id, station_name FROM res",
                                       extra=_ctes(_LATEST, _REQUESTS))

SQL["scenario_delay"] = with_readings("""
SELECT req_id, id, name, day, hour, minute,
       CAST(day * 24 + hour * 60 + minute AS INTEGER) AS x,
       CAST(day * 1440 + hour * 60 + minute AS INTEGER) AS minute_of_week, soleil
FROM (
  SELECT req_id, id, station_name AS name, req_soleil AS soleil,
         CAST(dayofweek(t) AS INTEGER) AS day, CAST(hour(t) AS INTEGER) AS hour,
         CAST(minute(t) - minute(t) % 5 AS INTEGER) AS minute
  FROM (SELECT *, TIMESTAMP '2024-01-31 08:00:00' + to_minutes(delay) AS t FROM res) a) b""",
                                      extra=_ctes(_LATEST, _REQUESTS))

SQL["scenario_explicit"] = with_readings("""
SELECT req_id, id, station_name AS name, req_day AS day, req_hour AS hour,
       CAST(req_minute - req_minute % 5 AS INTEGER) AS minute,
       CAST(req_day * 24 + req_hour * 60 + (req_minute - req_minute % 5) AS INTEGER) AS x,
       CAST(req_day * 1440 + req_hour * 60 + (req_minute - req_minute % 5) AS INTEGER) AS minute_of_week,
       req_soleil AS soleil, nBike, nPlace, label
FROM res""", extra=_ctes(_LATEST, _REQUESTS))

SQL["parse_update_time"] = with_readings("""
SELECT CAST(id AS VARCHAR) AS number, strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS last_update,
       epoch_ms(ts) AS dtUpdate
FROM el WHERE status = 'OPEN'""")

SQL["time_features"] = with_readings("""
SELECT id, dtUpdate, day, hour, minute, CAST(day * 24 + hour * 60 + minute AS INTEGER) AS x,
       CAST(day * 1440 + hour * 60 + minute AS INTEGER) AS minute_of_week FROM rd""")

SQL["availability_bins"] = with_readings(
    "SELECT id, dtUpdate, bikes, places, nBike, nPlace, nBike * 3 + nPlace AS label FROM rd")

SQL["on_poll_minute"] = with_readings(
    "SELECT id, epoch_ms(ts) AS dtUpdate, minute(ts) % 5 = 0 AS on_poll FROM el WHERE status = 'OPEN'")

SQL["label_text"] = with_readings(f"SELECT id, dtUpdate, label, {_LABEL_TEXT} AS label_text FROM readings")

SQL["clamp"] = with_readings("""
SELECT id, dtUpdate, bikes, places,
       CASE WHEN CAST(bikes AS DOUBLE) > 9 THEN CAST(10 AS DOUBLE) ELSE CAST(bikes AS DOUBLE) END AS bikes_clamped,
       CASE WHEN CAST(places AS DOUBLE) > 9 THEN CAST(10 AS DOUBLE) ELSE CAST(places AS DOUBLE) END AS places_clamped
FROM readings""")

SQL["date_text"] = with_readings("""
SELECT id, dtUpdate, strftime(make_timestamp(dtUpdate * 1000), '%Y%m%d') AS day_text,
       strftime(make_timestamp(dtUpdate * 1000), '%d/%m %H:%M') AS short_text
FROM readings""")

SQL["confusion_matrix"] = with_readings("SELECT label, prediction, n FROM cc", extra=_BASELINE)

SQL["accuracy"] = with_readings("""
SELECT n_rows, n_correct, CAST(n_correct AS DOUBLE) / CAST(n_rows AS DOUBLE) AS accuracy,
       CAST(n_correct AS DOUBLE) / CAST(n_rows AS DOUBLE) AS recall
FROM (SELECT CAST(sum(n) AS BIGINT) AS n_rows,
             CAST(sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS BIGINT) AS n_correct FROM cc) q""",
                                extra=_BASELINE)

SQL["class_metrics"] = with_readings("""
SELECT label, tp, n_actual, n_predicted, n_total, precision, recall, false_positive_rate, f1 FROM pc""",
                                     extra=_BASELINE)

SQL["weighted_metrics"] = with_readings("""
SELECT list_reduce(list(p ORDER BY label), lambda a, b: a + b) AS weighted_precision,
       list_reduce(list(r ORDER BY label), lambda a, b: a + b) AS weighted_recall,
       list_reduce(list(f ORDER BY label), lambda a, b: a + b) AS weighted_f1,
       list_reduce(list(fpr ORDER BY label), lambda a, b: a + b) AS weighted_false_positive_rate
FROM (SELECT label,
             precision * (CAST(n_actual AS DOUBLE) / CAST(n_total AS DOUBLE)) AS p,
             recall * (CAST(n_actual AS DOUBLE) / CAST(n_total AS DOUBLE)) AS r,
             f1 * (CAST(n_actual AS DOUBLE) / CAST(n_total AS DOUBLE)) AS f,
             false_positive_rate * (CAST(n_actual AS DOUBLE) / CAST(n_total AS DOUBLE)) AS fpr
      FROM pc WHERE n_actual > 0) q""", extra=_BASELINE)

SQL["id_index"] = with_readings("SELECT id, n, id_index FROM ix", extra=_IDX)

SQL["features_l2"] = with_readings("""
SELECT id, dtUpdate, label, id_index,
       CASE WHEN nrm = 0 THEN h ELSE h / nrm END AS f0, CASE WHEN nrm = 0 THEN m ELSE m / nrm END AS f1,
       CASE WHEN nrm = 0 THEN i ELSE i / nrm END AS f2, CASE WHEN nrm = 0 THEN s ELSE s / nrm END AS f3,
       CASE WHEN nrm = 0 THEN d ELSE d / nrm END AS f4
FROM (SELECT *, sqrt(h * h + m * m + i * i + s * s + d * d) AS nrm
      FROM (SELECT r.id, r.dtUpdate, r.label, ix.id_index, CAST(r.hour AS DOUBLE) AS h, CAST(r.minute AS DOUBLE) AS m,
                   ix.id_index AS i, r.soleil AS s, CAST(r.day AS DOUBLE) AS d
            FROM readings r JOIN ix ON ix.id = r.id WHERE r.soleil IS NOT NULL) a) b""", extra=_IDX)

SQL["features_l1"] = with_readings("""
SELECT id, dtUpdate, label,
       CASE WHEN nrm = 0 THEN a ELSE a / nrm END AS g0, CASE WHEN nrm = 0 THEN b ELSE b / nrm END AS g1,
       CASE WHEN nrm = 0 THEN c ELSE c / nrm END AS g2, CASE WHEN nrm = 0 THEN s ELSE s / nrm END AS g3,
       CASE WHEN nrm = 0 THEN e ELSE e / nrm END AS g4
FROM (SELECT *, abs(a) + abs(b) + abs(c) + abs(s) + abs(e) AS nrm
      FROM (SELECT id, dtUpdate, label, CAST(id AS DOUBLE) AS a, CAST(day AS DOUBLE) AS b, CAST(hour AS DOUBLE) AS c,
                   soleil AS s, CAST(minute AS DOUBLE) AS e
            FROM readings WHERE soleil IS NOT NULL) x) y""")

# The stream keeps every open reading (no distinct; that is T2).
SQL["stream_ingest"] = with_readings(f"SELECT {READING_COLS} FROM raw", extra=_RAW)

SQL["weather_daily"] = with_readings("SELECT obs_day, temperature, soleil FROM wday")

SQL["input_vector"] = with_readings("""
SELECT id, dtUpdate, CAST(id AS DOUBLE) AS i0, CAST(day AS DOUBLE) AS i1, CAST(hour AS DOUBLE) AS i2,
       CAST(minute AS DOUBLE) AS i3, soleil AS i4
FROM readings WHERE soleil IS NOT NULL""")

SQL["confusion_pivot"] = with_readings("SELECT label, " + ", ".join(
    f"CAST(sum(CASE WHEN prediction = {c} THEN n ELSE 0 END) AS BIGINT) AS \"{c}.0\"" for c in range(9))
    + " FROM cc GROUP BY label", extra=_BASELINE)

# T2 (table-backed): one row per (id, dtUpdate); within a batch the greatest row by the remaining
# columns in reading order survives (a max over a struct, NULL smallest).
SQL["stream_dedup"] = with_readings(f"""
SELECT {READING_COLS} FROM (
  SELECT *, row_number() OVER (
    PARTITION BY id, dtUpdate
    ORDER BY bikes DESC, day DESC, hour DESC, label DESC, lg DESC, lt DESC, minute DESC, nBike DESC,
             nPlace DESC, name DESC, places DESC, soleil DESC NULLS LAST, x DESC, minute_of_week DESC) AS rn
  FROM raw) q
WHERE rn = 1""", extra=_RAW)

# T2 with a state store: landings by day of the month, one batch each; late is what is older than the newest event of the
# batches before, less two days; the first batch with a key wins, in it the greatest row.
_BATCHES = """
dm AS (SELECT *, day(make_timestamp(dtUpdate * 1000)) AS dom FROM raw),
bt AS (SELECT 0 AS batch, * FROM dm WHERE dom <= 10 UNION ALL SELECT 1, * FROM dm WHERE dom > 20
       UNION ALL SELECT 2, * FROM dm WHERE dom BETWEEN 11 AND 20 UNION ALL SELECT 3, * FROM dm WHERE dom >= 28),
mx AS (SELECT batch, max(dtUpdate) AS newest FROM bt GROUP BY batch),
wm AS (SELECT b.batch, max(a.newest) - 2 * 86400000 AS w FROM mx b LEFT JOIN mx a ON a.batch < b.batch GROUP BY b.batch),
jd AS (SELECT bt.*, coalesce(dtUpdate < w, FALSE) AS late FROM bt JOIN wm USING (batch))"""
SQL["stream_dedup_state"] = with_readings(f"""
SELECT {READING_COLS} FROM (
  SELECT *, row_number() OVER (
    PARTITION BY id, dtUpdate
    ORDER BY batch, bikes DESC, day DESC, hour DESC, label DESC, lg DESC, lt DESC, minute DESC, nBike DESC,
             nPlace DESC, name DESC, places DESC, soleil DESC NULLS LAST, x DESC, minute_of_week DESC) AS rn
  FROM jd WHERE NOT late) q
WHERE rn = 1""", extra=_ctes(_RAW, _BATCHES))
SQL["stream_late_rows"] = with_readings("""
SELECT batch, strftime(make_timestamp(dtUpdate * 1000), '%Y%m%d') AS day, count(*) AS n_late FROM jd WHERE late GROUP BY ALL""",
                                        extra=_ctes(_RAW, _BATCHES))

# F5 in the stream: files of days ending in 3 are cut short, of days ending in 6 they hold something else.
SQL["stream_quarantine"] = with_readings(f"""
SELECT {READING_COLS} FROM raw WHERE day(make_timestamp(dtUpdate * 1000)) % 10 NOT IN (3, 6)""", extra=_RAW)
SQL["stream_dead_letters"] = """
SELECT poll, CASE WHEN poll LIKE '%3' THEN 'not JSON' ELSE 'no elements' END AS reason, count(*) AS n_files, count(*) AS n_names FROM (
  SELECT DISTINCT strftime(ts, '%Y%m%d') AS poll, user_id // 1000 AS chunk FROM events) q
WHERE poll LIKE '%3' OR poll LIKE '%6' GROUP BY poll"""

# One file for each day and thousand stations.
SQL["landed_files"] = """
SELECT poll, count(*) AS n_files FROM (
  SELECT DISTINCT strftime(ts, '%Y%m%d') AS poll, user_id // 1000 AS chunk FROM events) q
GROUP BY poll"""

# Overlapping loads leave every reading once; the three newest polls were landed twice, each time whole.
SQL["load_append"] = SQL["curate_readings"]
SQL["load_backfill"] = SQL["curate_readings"]
SQL["load_ledger"] = f"""
SELECT poll, n_files * n_loads AS n_files, n_loads FROM (
  SELECT *, CAST(CASE WHEN row_number() OVER (ORDER BY poll DESC) <= 3 THEN 2 ELSE 1 END AS BIGINT) AS n_loads
  FROM ({SQL["landed_files"]}) f) q"""
SQL["stream_compact"] = SQL["stream_ingest"]
# days of the stations whose landings were compacted
SQL["stream_compact_files"] = with_readings("""
SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS day, TRUE AS within FROM el WHERE status = 'OPEN' AND id % 3 < 2""")

# Faults of the landed lines, by event: 1 truncated, 2 text position, 3 none, 4 junk, 5 junk id, 6 junk time.
_FAULTS = """
fl AS (
  SELECT e.event_id % 50 AS fault, e.user_id AS id, date_trunc('second', e.ts) AS ts,
         CAST(json_extract_string(e.props, '$.k') AS INTEGER) % 20 AS places,
         CAST(floor(e.value) AS INTEGER) % 20 AS bikes,
         CAST(48800 + e.user_id % 100 AS DOUBLE) / 1000.0 AS lt,
         CAST(2300 + n.n_nationkey AS DOUBLE) / 1000.0 AS lg,
         e.event_type <> 'error' AS open
  FROM events e JOIN nation n ON n.n_nationkey = e.user_id % 25
)"""

SQL["scan_faulty"] = f"""WITH {_FAULTS}
SELECT id, epoch_ms(ts) AS dtUpdate, bikes, places, CASE WHEN fault IN (3, 4) THEN NULL ELSE lt END AS lt,
       CASE WHEN fault IN (3, 4) THEN NULL ELSE lg END AS lg
FROM fl WHERE open AND fault NOT IN (1, 5, 6)"""

SQL["rejected_files"] = f"""WITH {_FAULTS}
SELECT strftime(ts, '%Y%m%d') AS poll, count(*) AS bad_records FROM fl WHERE fault = 1 GROUP BY 1"""

SQL["dropped_counts"] = f"""WITH {_FAULTS}, {_WEATHER}
SELECT CASE WHEN NOT open THEN 'not_open' WHEN fault = 5 THEN 'bad_id' WHEN fault = 6 THEN 'bad_time'
            WHEN w.soleil IS NULL THEN 'no_weather' ELSE 'complete' END AS rule, count(*) AS n
FROM fl LEFT JOIN wday w ON w.obs_day = strftime(fl.ts, '%Y%m%d') WHERE fault <> 1 GROUP BY 1"""

SQL["parse_topology"] = """
SELECT event_id, 4 AS n_layers, k + 1 AS first_hidden, CAST(5 + k + 1 + user_id % 7 + 1 + 9 AS INTEGER) AS n_units
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) q"""

SQL["parse_weights"] = """
SELECT event_id, 3 AS n_weights, value AS w0, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS w1, CAST(event_id AS DOUBLE) AS w2
FROM events"""

# --- model: what must hold of a fit -------------------------------------------------------------

_PARTS = """
utr AS (SELECT * FROM tr WHERE soleil IS NOT NULL),
ute AS (SELECT * FROM te WHERE soleil IS NOT NULL)"""


def _fit(layers: str, n_weights: int, more: str = "") -> str:
    return with_readings(f"SELECT '{layers}' AS layers, {n_weights} AS n_weights, (SELECT count(*) FROM utr) AS train_rows, "
                         f"TRUE AS loss_ok{more}", extra=_ctes(_BASELINE, _PARTS))


SQL["train_model"] = _fit("5-20-20-9", 729)
SQL["warm_start"] = _fit("5-20-20-9", 729, ", TRUE AS starts_there, TRUE AS not_worse")
SQL["retrain"] = _fit("5-20-20-9", 729, ", (SELECT count(*) FROM ute) AS test_rows")
SQL["train_stepwise"] = """
SELECT CAST(chunk AS INTEGER) AS chunk, 20 AS iterations, 729 AS n_weights, TRUE AS within, TRUE AS not_worse
FROM range(5) t(chunk)"""
SQL["persist_training"] = with_readings("SELECT id, dtUpdate, label, TRUE AS spills FROM utr", extra=_ctes(_BASELINE, _PARTS))
SQL["model_weights"] = "SELECT CAST(idx AS INTEGER) AS idx, TRUE AS finite FROM range(729) t(idx)"


def _scored(columns: str, rows: str = "ute") -> str:
    return with_readings(f"SELECT {columns} FROM {rows}", extra=_ctes(_BASELINE, _PARTS, _IDX))


SQL["predict_batch"] = _scored("id, dtUpdate, label, TRUE AS valid")
SQL["model_roundtrip"] = _scored("id, dtUpdate, TRUE AS same_prediction, TRUE AS same_weights, TRUE AS same_settings")
# the index is that of the training rows; a station seen in none of them has the extra index
SQL["export_predictions"] = with_readings("""
SELECT e.id, e.dtUpdate, e.name, e.label, COALESCE(t.id_index, (SELECT CAST(count(*) AS DOUBLE) FROM tix)) AS id_index, TRUE AS valid,
       TRUE AS likeliest, 9 AS n_probabilities, 9 AS n_raw, 5 AS n_features
FROM ute e LEFT JOIN tix t ON t.id = e.id""", extra=_ctes(_BASELINE, _PARTS, """
tix AS (
  SELECT id, CAST(row_number() OVER (ORDER BY n DESC, CAST(id AS VARCHAR)) - 1 AS DOUBLE) AS id_index
  FROM (SELECT id, count(*) AS n FROM utr GROUP BY id) c
)"""))
SQL["evaluate_model"] = with_readings("""
SELECT label, count(*) AS n_actual, (SELECT count(*) FROM ute) AS n_total, TRUE AS row_ok, TRUE AS class_ok, TRUE AS overall_ok
FROM ute GROUP BY label""", extra=_ctes(_BASELINE, _PARTS))
SQL["stream_predict"] = with_readings("SELECT id, dtUpdate, label, TRUE AS valid FROM raw WHERE soleil IS NOT NULL", extra=_RAW)
for _key, _scenario in (("forecast", "scenario_delay"), ("forecast_explicit", "scenario_explicit")):
    SQL[_key] = f"SELECT req_id, id, name, day, hour, minute, soleil, TRUE AS valid, TRUE AS described FROM ({SQL[_scenario]}) s"

_TOPOLOGIES = [("20-20", 729), ("50-50", 3309), ("100-100", 11609), ("300-300", 94809), ("50-50-50", 5859), ("10-10-10-10", 489),
               ("20-20-20-20", 1569), ("60", 909), ("500", 7509), ("5000", 75009)]
SQL["search_topology"] = with_readings("""
SELECT hidden, '5-' || hidden || '-9' AS layers, n_weights, f.fold0, f.fold1, f.fold2, TRUE AS f1_valid, TRUE AS best_kept,
       (SELECT count(*) FROM ute) AS held_out_rows
FROM (VALUES """ + ", ".join(f"('{h}', {n})" for h, n in _TOPOLOGIES) + """) v(hidden, n_weights),
     (SELECT count(*) FILTER (bucket % 3 = 0) AS fold0, count(*) FILTER (bucket % 3 = 1) AS fold1, count(*) FILTER (bucket % 3 = 2) AS fold2
      FROM utr) f""", extra=_ctes(_BASELINE, _PARTS))
SQL["search_trials"] = with_readings("""
SELECT hidden, CAST(f.fold AS INTEGER) AS fold, 100 AS iterations, (SELECT count(*) FROM utr) - f.n AS train_rows, f.n AS held_rows, TRUE AS f1_valid
FROM (VALUES """ + ", ".join(f"('{h}')" for h, _ in _TOPOLOGIES) + """) v(hidden),
     (SELECT bucket % 3 AS fold, count(*) AS n FROM utr GROUP BY 1) f""", extra=_ctes(_BASELINE, _PARTS))
SQL["train_resumable"] = with_readings("""
SELECT CAST(chunk AS INTEGER) AS chunk, 20 AS iterations, (SELECT count(*) FROM ute) AS test_rows, TRUE AS within, TRUE AS not_worse,
       TRUE AS as_unbroken, TRUE AS evaluated
FROM range(5) t(chunk)""", extra=_ctes(_BASELINE, _PARTS))
# the first three days' stations by frequency, then those that came later by theirs
SQL["retrain_grown"] = with_readings("""
SELECT id, CAST(row_number() OVER (ORDER BY NOT known, n DESC, CAST(id AS VARCHAR)) - 1 AS DOUBLE) AS id_index, known, TRUE AS kept
FROM (SELECT id, e.n IS NOT NULL AS known, coalesce(e.n, a.n) AS n
      FROM (SELECT id, count(*) AS n FROM utr GROUP BY id) a
      LEFT JOIN (SELECT id, count(*) AS n FROM utr WHERE strftime(make_timestamp(dtUpdate * 1000), '%Y%m%d') IN (
                   SELECT DISTINCT obs_day FROM rd ORDER BY obs_day LIMIT 3) GROUP BY id) e USING (id)) q""", extra=_ctes(_BASELINE, _PARTS))

# What the drifting files hold, by the day of the month.
_DRIFT = """
dp AS (SELECT strftime(ts, '%Y%m%d') AS poll, day(ts) AS dom, count(*) AS n FROM events GROUP BY ALL),
dt AS (
  SELECT poll, dom, n, field, kind FROM dp, (VALUES ('number', 'STRING'), ('name', 'STRING'), ('available_bikes', 'BIGINT'),
         ('available_bikes', 'STRING'), ('position', 'ARRAY'), ('banking', 'BOOLEAN')) f(field, kind)
  WHERE CASE WHEN field = 'name' THEN dom <= 24 WHEN field = 'banking' THEN dom >= 11
             WHEN field = 'available_bikes' THEN (kind = 'STRING') = (dom BETWEEN 16 AND 20) ELSE TRUE END
),
dg AS (
  SELECT p.poll, f.field, t.kind, lag(t.kind) OVER w AS was, row_number() OVER w AS no
  FROM dp p CROSS JOIN (SELECT DISTINCT field FROM dt) f LEFT JOIN dt t ON t.poll = p.poll AND t.field = f.field
  WINDOW w AS (PARTITION BY f.field ORDER BY p.poll)
)"""
SQL["schema_by_poll"] = f"WITH {_DRIFT} SELECT poll, field, n, kind FROM dt"
SQL["schema_drift"] = f"""WITH {_DRIFT}
SELECT poll, field, CASE WHEN was IS NULL THEN 'appears' WHEN kind IS NULL THEN 'vanishes' ELSE 'changes type' END AS change,
       was AS before, kind AS after
FROM dg WHERE no > 1 AND was IS DISTINCT FROM kind"""
# positions of hour, minute, the station's slot, soleil and day in the assembled vector
SQL["features_station"] = with_readings("""
SELECT r.id, r.dtUpdate, r.label, CAST(c.n + 5 AS INTEGER) AS size,
       concat_ws(',', CASE WHEN hour <> 0 THEN '0' END, CASE WHEN minute <> 0 THEN '1' END, CAST(CAST(2 + ix.id_index AS BIGINT) AS VARCHAR),
                 CASE WHEN soleil <> 0 THEN CAST(c.n + 3 AS VARCHAR) END, CASE WHEN day <> 0 THEN CAST(c.n + 4 AS VARCHAR) END) AS positions
FROM readings r JOIN ix ON ix.id = r.id, (SELECT count(*) AS n FROM ix) c WHERE r.soleil IS NOT NULL""", extra=_IDX)
