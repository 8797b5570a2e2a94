"""Common table expressions of the check SQL, each after those it uses (DuckDB)."""

from __future__ import annotations

from tunemill.sources import given_tables as given

_FILL = {"events": "events", "part": "part", "nation": "nation", "raw_events": "raw_events"}


def _key(*cols: str) -> str:
    parts = ", ".join(f"COALESCE(CAST({c} AS VARCHAR), '')" for c in cols)
    return f"md5(concat_ws('-', {parts}))"


def _clean(col: str) -> str:
    return f"replace(replace({col}, chr(34), ''), chr(92), '')"


def _text(col: str) -> str:
    return f"COALESCE({col}, 'NA') AS {col}"


_USER_TAIL = f"""{_text('city')}, {_text('state')}, {_text('userAgent')},
  COALESCE(lon, 0.0) AS lon, COALESCE(lat, 0.0) AS lat, COALESCE(userId, 0) AS userId,
  {_text('lastName')}, {_text('firstName')}, {_text('gender')},
  COALESCE(registration, 9999999999999) AS registration"""

_USER = "userId, firstName, lastName, gender"
_PLACE = f"row_number() OVER (PARTITION BY {_USER} ORDER BY date, level, registration) AS place"


def _same_user(a: str, b: str) -> str:
    return " AND ".join(f"{a}.{c} = {b}.{c}" for c in _USER.split(", "))


CTES: dict[str, str] = {
    "songs": given.SONGS_SQL.format(**_FILL),
    "state_codes": given.STATE_CODES_SQL.format(**_FILL),
    "raw_events": given.RAW_EVENTS_SQL.format(**_FILL),
    "listen_raw": given.LISTEN_RAW_SQL.format(**_FILL),
    "page_raw": given.PAGE_RAW_SQL.format(**_FILL),
    "auth_raw": given.AUTH_RAW_SQL.format(**_FILL),
    "stg_listen": f"""
SELECT {_text('artist')}, {_text('song')}, COALESCE(duration, -1.0) AS duration, ts,
  {_text('auth')}, {_text('level')}, {_USER_TAIL}
FROM listen_raw""",
    "stg_page": f"""
SELECT ts, {_text('page')}, {_text('auth')}, {_text('method')},
  CAST(COALESCE(status, 0) AS BIGINT) AS status, {_text('level')}, {_USER_TAIL},
  {_text('artist')}, {_text('song')}, COALESCE(duration, -1.0) AS duration
FROM page_raw""",
    "stg_auth": f"""
SELECT ts, {_text('level')}, {_text('city')}, {_text('state')}, {_text('userAgent')},
  CAST(COALESCE(CAST(lon AS DECIMAL(38,9)), 0.0) AS DOUBLE) AS lon,
  CAST(COALESCE(CAST(lat AS DECIMAL(38,9)), 0.0) AS DOUBLE) AS lat,
  COALESCE(userId, 0) AS userId, {_text('lastName')}, {_text('firstName')}, {_text('gender')},
  COALESCE(registration, 9999999999999) AS registration, COALESCE(success, FALSE) AS success
FROM auth_raw""",
    "slots": """
SELECT *, strftime(time_bucket(INTERVAL '5 minutes', ts), '%Y-%m-%d %H-%M') AS slot,
  strftime(ts, '%Y-%m-%d %H') AS ts_hour FROM stg_listen""",
    "user_states": f"""
SELECT DISTINCT {_USER}, registration, level, ts AS date FROM stg_listen WHERE userId <> 0""",
    # the history told by places and joins, without a lag, a running sum or a lead
    "flagged": f"""
SELECT s.* EXCLUDE (place), CAST(s.level IS DISTINCT FROM COALESCE(p.level, 'NA') AS INT) AS changed
FROM (SELECT *, {_PLACE} FROM user_states) s
LEFT JOIN (SELECT *, {_PLACE} FROM user_states) p
  ON {_same_user("s", "p")} AND p.place = s.place - 1""",
    "numbered": f"""
SELECT s.*, COALESCE(c.run, 0) AS run FROM flagged s ASOF LEFT JOIN (
  SELECT {_USER}, date, max(place) AS run
  FROM (SELECT *, {_PLACE} FROM flagged WHERE changed = 1) GROUP BY ALL) c
ON {_same_user("s", "c")} AND s.date >= c.date""",
    "runs": f"""
SELECT {_USER}, registration, level, run, CAST(MIN(date) AS DATE) AS firstDay
FROM numbered GROUP BY ALL""",
    "placed_runs": f"""
SELECT *, row_number() OVER (PARTITION BY {_USER}
  ORDER BY run, firstDay, registration, level) AS place FROM runs""",
    "dated": f"""
SELECT r.* EXCLUDE (place), COALESCE(n.firstDay, DATE '9999-12-31') AS rowExpirationDate,
  CASE WHEN r.run = t.run THEN 1 ELSE 0 END AS currentRow
FROM placed_runs r LEFT JOIN placed_runs n ON {_same_user("r", "n")} AND n.place = r.place + 1
JOIN (SELECT {_USER}, max(run) AS run FROM runs GROUP BY ALL) t ON {_same_user("r", "t")}""",
    "history": f"""
SELECT {_USER}, level, registration, firstDay AS rowActivationDate, rowExpirationDate, currentRow
FROM dated""",
    "special_rows": f"""
SELECT {_USER}, level, registration, CAST(MIN(ts) AS DATE) AS rowActivationDate,
  DATE '9999-12-31' AS rowExpirationDate, 1 AS currentRow
FROM stg_listen WHERE userId = 0 OR userId = 1 GROUP BY {_USER}, level, registration""",
    "all_users": "SELECT * FROM history UNION ALL SELECT * FROM special_rows",
    "dim_users": f"""
SELECT {_key('userId', 'rowActivationDate', 'level')} AS userKey, * FROM all_users""",
    "artist_rows": f"""
SELECT MAX(artist_id) AS artistId, MAX(artist_latitude) AS latitude,
  MAX(artist_longitude) AS longitude, MAX(artist_location) AS location,
  {_clean('artist_name')} AS name
FROM songs GROUP BY artist_name""",
    "all_artists": """
SELECT * FROM artist_rows UNION ALL SELECT 'NNNNNNNNNNNNNNN', 0.0, 0.0, 'NA', 'NA'""",
    "dim_artists": f"SELECT {_key('artistId')} AS artistKey, * FROM all_artists",
    "all_songs": f"""
SELECT song_id AS songId, {_clean('artist_name')} AS artistName, duration, key,
  key_confidence AS keyConfidence, loudness, song_hotttnesss AS songHotness, tempo, title, year
FROM songs
UNION ALL SELECT 'NNNNNNNNNNNNNNNNNNN', 'NA', 0, -1, -1, -1, -1, -1, 'NA', 0""",
    "dim_songs": f"SELECT {_key('songId')} AS songKey, * FROM all_songs",
    "places": """
SELECT DISTINCT city, COALESCE(s.stateCode, 'NA') AS stateCode,
  COALESCE(s.stateName, 'NA') AS stateName, lat AS latitude, lon AS longitude
FROM stg_listen l LEFT JOIN state_codes s ON l.state = s.stateCode""",
    "all_places": "SELECT * FROM places UNION ALL SELECT 'NA', 'NA', 'NA', 0.0, 0.0",
    "dim_location": f"""
SELECT {_key('latitude', 'longitude', 'city', 'stateName')} AS locationKey, * FROM all_places""",
    "hours": """
SELECT unnest(generate_series(date_trunc('hour', MIN(ts)), date_trunc('hour', MAX(ts)),
  INTERVAL 1 HOUR)) AS date FROM stg_listen""",
    "dim_datetime": """
SELECT CAST(epoch(date) AS BIGINT) AS dateKey, date,
  CAST(dayofweek(date) + 1 AS INT) AS dayOfWeek, CAST(day(date) AS INT) AS dayOfMonth,
  CAST(strftime(date, '%U') AS INT) AS weekOfYear, CAST(month(date) AS INT) AS month,
  CAST(year(date) AS INT) AS year, dayofweek(date) + 1 IN (6, 7) AS weekendFlag
FROM hours""",
    "fact_streams": f"""
SELECT u.userKey, a.artistKey, s.songKey, d.dateKey, l.locationKey, e.ts
FROM stg_listen e
LEFT JOIN dim_users u ON e.userId = u.userId AND CAST(e.ts AS DATE) >= u.rowActivationDate
  AND CAST(e.ts AS DATE) < u.rowExpirationDate
LEFT JOIN dim_artists a ON {_clean('e.artist')} = a.name
LEFT JOIN dim_songs s ON {_clean('e.artist')} = s.artistName AND e.song = s.title
LEFT JOIN dim_location l ON e.city = l.city AND e.state = l.stateCode
  AND e.lat = l.latitude AND e.lon = l.longitude
LEFT JOIN dim_datetime d ON d.date = date_trunc('hour', e.ts)""",
    "wide_streams": """
SELECT f.userKey, f.artistKey, f.songKey, f.dateKey, f.locationKey, f.ts AS "timestamp",
  u.firstName, u.lastName, u.gender, u.level, u.userId, u.currentRow AS currentUserRow,
  s.duration AS songDuration, s.tempo, s.title AS songName,
  l.city, l.stateName AS state, l.latitude, l.longitude,
  d.date AS dateHour, d.dayOfMonth, d.dayOfWeek,
  a.latitude AS artistLatitude, a.longitude AS artistLongitude, a.name AS artistName
FROM fact_streams f JOIN dim_users u ON f.userKey = u.userKey
JOIN dim_songs s ON f.songKey = s.songKey JOIN dim_location l ON f.locationKey = l.locationKey
JOIN dim_datetime d ON f.dateKey = d.dateKey JOIN dim_artists a ON f.artistKey = a.artistKey""",
    "vocab": """
SELECT CAST(row_number() OVER (ORDER BY song) - 1 AS BIGINT) AS label, song
FROM (SELECT DISTINCT song FROM stg_listen WHERE song IS NOT NULL)""",
    "ordered": """
SELECT userId, song, row_number() OVER (PARTITION BY userId ORDER BY ts, song) AS place
FROM stg_listen""",
    "coded_all": """
SELECT userId, list(song ORDER BY ts, song) AS names,
  list(label ORDER BY ts, song) AS items, CAST(count(*) AS INT) AS n
FROM stg_listen JOIN vocab USING (song) GROUP BY userId""",
    "coded": "SELECT * FROM coded_all WHERE n BETWEEN 4 AND 20",
    "split": """
SELECT *, row_number() OVER (PARTITION BY n
    ORDER BY md5(concat_ws('-', CAST(userId AS VARCHAR), '42')), userId)
  <= round(count(*) OVER (PARTITION BY n) * CAST(0.2 AS DOUBLE)) AS is_test FROM coded""",
    "kept": """
SELECT userId, names, items, n FROM (
  SELECT *, row_number() OVER (ORDER BY md5(concat_ws('-', CAST(userId AS VARCHAR), '42')), userId)
    AS rn, floor(count(*) OVER () * CAST(0.95 AS DOUBLE)) AS taken FROM split WHERE NOT is_test)
WHERE rn <= taken""",
    "train_pairs": """
SELECT userId, pos, list_slice(items, 1, pos) AS prefix, items[pos + 1] AS target
FROM (SELECT userId, items, CAST(unnest(range(3, n)) AS INT) AS pos FROM kept)""",
    "test_pairs": """
SELECT userId, pos, list_slice(items, 1, pos) AS prefix, items[pos + 1] AS target
FROM (SELECT userId, items, CAST(unnest(range(3, n)) AS INT) AS pos FROM split WHERE is_test)""",
    "transitions": """
SELECT k, list_slice(prefix, len(prefix) - k + 1, len(prefix)) AS context, target,
  count(*) AS n
FROM train_pairs, (VALUES (0), (1), (2), (3)) orders(k) WHERE len(prefix) >= k GROUP BY ALL""",
    "model": """
SELECT k, context, predicted, support FROM (
  SELECT k, context, target AS predicted, row_number() OVER best AS rn,
    CAST(SUM(n) OVER (PARTITION BY k, context) AS BIGINT) AS support
  FROM transitions WINDOW best AS (PARTITION BY k, context ORDER BY n DESC, target))
WHERE rn = 1""",
    "predictions": """
SELECT p.userId, p.pos, p.target, COALESCE(m3.predicted, m2.predicted, m1.predicted,
  (SELECT predicted FROM model WHERE k = 0)) AS predicted,
  COALESCE(m2.predicted, m1.predicted, (SELECT predicted FROM model WHERE k = 0)) AS predicted2,
  COALESCE(m1.predicted, (SELECT predicted FROM model WHERE k = 0)) AS predicted1
FROM test_pairs p
LEFT JOIN model m3 ON m3.k = 3 AND m3.context = list_slice(prefix, len(prefix) - 2, len(prefix))
LEFT JOIN model m2 ON m2.k = 2 AND m2.context = list_slice(prefix, len(prefix) - 1, len(prefix))
LEFT JOIN model m1 ON m1.k = 1 AND m1.context = list_slice(prefix, len(prefix), len(prefix))""",
    "histories": """
SELECT userId, CAST(count(*) AS INT) AS n_recent, list(label ORDER BY rn DESC) AS h
FROM (SELECT userId, song, row_number() OVER (PARTITION BY userId ORDER BY ts DESC, song DESC) AS rn
      FROM stg_listen) JOIN vocab USING (song) WHERE rn <= 19 GROUP BY userId""",
    "drawn": """
SELECT userId, CAST(CAST('0x' || substr(md5(concat_ws('-', CAST(userId AS VARCHAR), '42')), 1, 15)
  AS BIGINT) % (SELECT count(*) FROM vocab) AS BIGINT) AS label FROM histories""",
    "chosen": """
SELECT h.userId, h.n_recent, h.n_recent < 3 AS cold,
  CASE WHEN h.n_recent < 3 THEN d.label ELSE COALESCE(m3.predicted, m2.predicted, m1.predicted,
    (SELECT predicted FROM model WHERE k = 0)) END AS label
FROM histories h JOIN drawn d USING (userId)
LEFT JOIN model m3 ON m3.k = 3 AND m3.context = list_slice(h, len(h) - 2, len(h))
LEFT JOIN model m2 ON m2.k = 2 AND m2.context = list_slice(h, len(h) - 1, len(h))
LEFT JOIN model m1 ON m1.k = 1 AND m1.context = list_slice(h, len(h), len(h))""",
}
