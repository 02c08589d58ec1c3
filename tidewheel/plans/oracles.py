"""The catalogue in DuckDB SQL over the same base tables.

Shared parts are common table expressions named after the frames in `testbed`.
"""

from __future__ import annotations

from tidewheel.plans import catalogue as q

_EP = "CAST(floor(epoch(ts)) AS BIGINT)"
_SLOT = f"CAST({_EP} - {_EP} % 900 AS BIGINT)"

_EV = f"ev AS (SELECT *, {_EP} AS ep FROM events)"

_E = f"""{_EV},
e0 AS (SELECT *, unnest(CASE WHEN event_id % 20 = 0 THEN [0, 1] ELSE [0] END) AS replay FROM ev),
e AS (SELECT event_id AS n, CAST(replay AS BIGINT) AS replay,
  CAST(replay AS BIGINT) * 17592186044416 + event_id AS arrival,
  'evt-' || event_id AS event_id,
  CASE WHEN event_id % 211 = 0 THEN '' ELSE 'st-' || (user_id % 50) END AS station_id,
  ep AS source_updated_at, ep + 5 AS ingested_at,
  ep - CASE event_type WHEN 'view' THEN event_id % 900 WHEN 'error' THEN 900 + event_id % 1200
       WHEN 'signup' THEN -(event_id % 120) ELSE event_id % 60 END AS last_reported,
  CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 97 = 0 THEN -1
       ELSE event_id % (11 + user_id % 31) END AS canonical,
  CASE WHEN event_id % 7 = 0 THEN event_id % (11 + user_id % 31) END AS alias,
  10 + user_id % 31 - event_id % (11 + user_id % 31) AS docks,
  CASE WHEN event_id % 13 = 0 THEN 0 ELSE 1 END AS is_installed,
  CASE WHEN event_id % 53 <> 0 THEN 10 + user_id % 31 END AS capacity,
  'Station ' || (user_id % 50) AS name, user_id % 50 AS spot
  FROM e0)"""

_PROBLEMS = """concat_ws('; ',
  CASE WHEN station_id = '' THEN 'station_id:too_short' END,
  CASE WHEN {bikes} IS NULL THEN 'num_bikes_available:missing'
       WHEN {bikes} < 0 THEN 'num_bikes_available:too_small' END,
  CASE WHEN docks < 0 THEN 'num_docks_available:too_small' END,
  CASE WHEN capacity IS NULL THEN 'capacity:missing' END)"""

_J = f"""{_E},
j0 AS (SELECT *, coalesce(canonical, alias) AS bikes,
  canonical IS NULL AND alias IS NOT NULL AS used_alias,
  source_updated_at - last_reported AS age,
  {_PROBLEMS.format(bikes="coalesce(canonical, alias)")} AS problems FROM e),
j1 AS (SELECT *, CASE WHEN problems <> '' THEN 'invalid: ' || problems
  WHEN is_installed = 0 THEN 'Station is not operational'
  WHEN age > 1800 THEN 'Stale station observation'
  WHEN last_reported > source_updated_at + 60 THEN 'Station timestamp is in the future' END AS reason
  FROM j0),
j AS (SELECT *, reason IS NULL AND age > 900 AS used_grace,
  CASE WHEN reason IS NOT NULL THEN 'quarantined'
       WHEN row_number() OVER (PARTITION BY event_id, reason IS NULL ORDER BY arrival) = 1
       THEN 'accepted' ELSE 'duplicate' END AS outcome FROM j1)"""

_PROFILE = f"""{_E},
p AS (SELECT count(*) AS rows, count(DISTINCT station_id) AS unique_stations,
  min(source_updated_at) AS timestamp_min, max(source_updated_at) AS timestamp_max,
  count(*) FILTER (canonical IS NULL AND alias IS NOT NULL) AS alias_candidates,
  count(*) FILTER (age BETWEEN -60 AND 900) AS within_freshness_limit,
  count(*) FILTER (age > 900 AND age <= 1800) AS within_freshness_grace,
  count(*) FILTER (age > 1800) AS too_old,
  count(*) FILTER (age < -60) AS future_timestamps,
  count(*) FILTER (station_id IS NULL) AS missing_station_id, count(*) FILTER (last_reported IS NULL) AS missing_status,
  count(*) FILTER (detailed = 0) AS missing_metadata
  FROM (SELECT *, source_updated_at - last_reported AS age FROM {{source}}))"""
_LOST = """(SELECT * REPLACE (CASE WHEN n % 23 <> 0 THEN station_id END AS station_id,
  CASE WHEN n % 29 <> 0 THEN last_reported END AS last_reported, CASE WHEN n % 29 <> 0 THEN alias END AS alias),
  CASE WHEN n % 19 = 0 THEN 0 ELSE 1 END AS detailed FROM e)"""
_BROKEN_PROFILE = _PROFILE.format(source=_LOST)
_PROFILE = _PROFILE.format(source="(SELECT *, 1 AS detailed FROM e)")

_H = f"""{_EV},
h AS (SELECT 'st-' || (user_id % 5) AS station_id, ep - ep % 900 AS slot,
  CAST(floor(max(value)) AS BIGINT) % 31 AS bikes FROM ev GROUP BY ALL),
f AS (SELECT *, 30 - bikes AS docks, CAST(30 AS BIGINT) AS capacity,
  CAST(slot % 86400 // 3600 AS BIGINT) AS hour_utc,
  CAST((slot // 86400 + 3) % 7 AS BIGINT) AS day_of_week,
  bikes / 30::DOUBLE AS ratio FROM h),
g AS (SELECT *, bikes * 0.9::DOUBLE + hour_utc * 0.25::DOUBLE + 0.5::DOUBLE AS raw FROM f),
t AS (SELECT *, CASE WHEN lead(slot) OVER w = slot + 900
  THEN CAST(lead(bikes) OVER w AS DOUBLE) END AS target FROM g
  WINDOW w AS (PARTITION BY station_id ORDER BY slot))"""

_U = f"""{_H},
u AS (SELECT station_id || '-' || slot AS event_id, station_id, slot,
  slot + 60 + (slot // 900 % 3) * 600 AS served, slot + 900 AS due,
  CASE WHEN slot // 900 % 10 = 0 THEN '2' ELSE '3' END AS model_version,
  raw, CAST(greatest(0, least(30, round_even(raw, 0))) AS BIGINT) AS predicted,
  hour_utc, day_of_week, bikes, docks,
  CASE WHEN slot // 900 % 97 <> 0 THEN capacity END AS capacity, ratio FROM g),
a AS (SELECT 'st-' || (user_id % 5) AS station_id, ep AS seen,
  CAST(floor(value) AS BIGINT) % 31 AS actual, event_id AS n FROM ev)"""


def _labeled(tolerance: int) -> str:
    return f"""{_U},
l AS (SELECT * FROM (SELECT u.*, a.seen, a.actual, row_number() OVER (PARTITION BY u.event_id
  ORDER BY abs(a.seen - u.due), a.seen, a.n DESC) AS rn
  FROM u LEFT JOIN a ON a.station_id = u.station_id
  AND a.seen BETWEEN u.due - {tolerance} AND u.due + {tolerance}) WHERE rn = 1)"""


_WINDOW = (
    f"served >= {q.WINDOW_START} AND served < {q.WINDOW_END} AND due <= {q.WINDOW_END}"
    f" AND model_version = '{q.CHAMPION}'"
)
_FLAGS = """CASE WHEN capacity IS NULL OR capacity <= 0 OR bikes < 0 OR bikes > capacity OR docks < 0
  OR docks > capacity OR ratio < 0 OR ratio > 1 THEN 1 ELSE 0 END AS invalid_features,
  CASE WHEN served - slot > 900 THEN 1 ELSE 0 END AS stale_features"""


def _r(expression: str, name: str) -> str:
    return f"round(CAST({expression} AS DOUBLE), 6) AS {name}"


_MEASURES = f"""{_r("count(*)", "sample_count")}, {_r("count(actual)", "labeled_count")},
  {_r("count(actual) / count(*)::DOUBLE", "label_coverage")},
  {_r("avg(invalid_features)", "invalid_feature_rate")},
  {_r("avg(stale_features)", "stale_feature_rate")},
  {_r("avg(abs(predicted - actual))", "production_mae")},
  {_r("sqrt(avg((predicted - actual) * (predicted - actual)))", "production_rmse")},
  {_r("avg(abs(bikes - actual))", "persistence_baseline_mae")}"""

# The measures with zeros for windows without rows.
_FILLED = ", ".join(
    f"coalesce({c}, 0) AS {c}" if c.endswith(("count", "coverage", "rate")) else c
    for c in (
        "sample_count", "labeled_count", "label_coverage", "invalid_feature_rate", "stale_feature_rate",
        "production_mae", "production_rmse", "persistence_baseline_mae",
    )
)


def _every(key: str) -> str:
    return f"""found_rows AS (SELECT {key}, {_MEASURES} FROM w GROUP BY {key}),
hours AS (SELECT unnest(range(min({key}), max({key}) + 1, 3600)) AS {key} FROM w)"""


_DRIFT = {
    "hour_utc": "hour_utc",
    "day_of_week": "day_of_week",
    "available_bikes": "bikes",
    "available_docks": "docks",
    "capacity": "capacity",
    "availability_ratio": "ratio",
    "raw_prediction": "raw",
}
_FRACTIONS = "[" + ", ".join(f"{1.0 if i == 10 else i * 0.1!r}::DOUBLE" for i in range(11)) + "]"


def _long(relation: str, extra: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {extra}'{name}' AS feature, CAST({column} AS DOUBLE) AS v FROM {relation}"
        for name, column in _DRIFT.items()
    )


_VERDICT = f"""named AS (SELECT win, CASE feature WHEN 'raw_prediction' THEN 'psi_prediction'
    ELSE 'psi_' || feature END AS name, psi, list_position({list(_DRIFT)!r}, feature) AS k FROM scored),
found AS (SELECT win, string_agg(name || ' exceeded the failure threshold', '; ' ORDER BY k)
    FILTER (psi >= 0.25) AS over_failure,
  string_agg(name || ' exceeded the warning threshold', '; ' ORDER BY k)
    FILTER (psi >= 0.1 AND psi < 0.25) AS over_warning,
  max(psi) FILTER (name = 'psi_prediction') AS psi_prediction FROM named GROUP BY win),
texts AS (SELECT win, sample_count, psi_prediction, concat_ws('; ',
  CASE WHEN label_coverage < 0.9 THEN 'Delayed-label coverage is below the configured minimum' END,
  CASE WHEN stale_feature_rate > 0 THEN 'Some predictions used stale online features' END, over_warning,
  CASE WHEN labeled_count < 100
    THEN 'Not enough delayed labels to evaluate production model quality' END) AS warnings,
  concat_ws('; ', CASE WHEN invalid_feature_rate > 0
    THEN 'Production feature rows violated model input constraints' END, over_failure,
  CASE WHEN labeled_count >= 100 AND production_mae >= persistence_baseline_mae
    THEN 'Production MAE no longer beats the persistence baseline' END) AS failures
  FROM m JOIN found USING (win)),
verdict AS (SELECT win, psi_prediction, CASE WHEN sample_count < 100 THEN 'insufficient_data'
  WHEN failures <> '' THEN 'failed' WHEN warnings <> '' THEN 'warning' ELSE 'passed' END AS status,
  CASE WHEN sample_count < 100 THEN '' ELSE warnings END AS warnings,
  CASE WHEN sample_count < 100 THEN '' ELSE failures END AS failures FROM texts)"""


def _psi(reference: str, current: str) -> str:
    """CTEs from two relations to ``scores(feature, psi)``."""
    values = f"{_long(f'({reference})', '0 AS side, ')} UNION ALL {_long(f'({current})', '1 AS side, ')}"
    return f"""vals AS (SELECT * FROM ({values}) WHERE v IS NOT NULL),
shape AS (SELECT feature, count(*) FILTER (side = 0) AS nr, count(*) FILTER (side = 1) AS nc,
  min(v) FILTER (side = 0) AS r0, max(v) FILTER (side = 0) AS r1,
  min(v) FILTER (side = 1) AS c0, max(v) FILTER (side = 1) AS c1,
  list_sort(list_distinct(quantile_cont(v, {_FRACTIONS}) FILTER (side = 0))) AS edges
  FROM vals GROUP BY feature),
bins AS (SELECT feature, side, v, nr, nc,
  len(list_filter(edges[2:len(edges) - 1], lambda k: k <= v)) AS bin FROM vals JOIN shape USING (feature)),
shares AS (SELECT feature, bin, greatest(count(*) FILTER (side = 0) / any_value(nr)::DOUBLE, 1e-6) AS r,
  greatest(count(*) FILTER (side = 1) / any_value(nc)::DOUBLE, 1e-6) AS c FROM bins GROUP BY feature, bin),
scores AS (SELECT feature, CASE WHEN any_value(nr) = 0 OR any_value(nc) = 0 THEN 0
  WHEN any_value(r1 - r0) <= 1e-8 + 1e-5 * abs(any_value(r0))
  THEN CASE WHEN any_value(greatest(abs(c0 - r0), abs(c1 - r0))) <= 1e-8 + 1e-5 * abs(any_value(r0))
       THEN 0 ELSE 1 END
  ELSE sum((c - r) * ln(c / r)) END AS psi
  FROM shape LEFT JOIN shares USING (feature) GROUP BY feature)"""


_SPLIT = """ranked AS (SELECT slot, row_number() OVER (ORDER BY slot) - 1 AS k, count(*) OVER () AS n
  FROM (SELECT DISTINCT slot FROM {source})),
cuts AS (SELECT slot, CASE WHEN k < greatest(1, floor(n * 0.70::DOUBLE)) THEN 'train'
  WHEN k < greatest(greatest(1, floor(n * 0.70::DOUBLE)) + 1, floor(n * 0.85::DOUBLE)) THEN 'validation'
  ELSE 'test' END AS split FROM ranked),
s AS (SELECT x.*, split FROM {source} x JOIN cuts USING (slot))"""

_SCORES = f"""{_H}, tl AS (SELECT * FROM t WHERE target IS NOT NULL), {_SPLIT.format(source="tl")},
r AS (SELECT split, count(*) AS samples, avg(abs(target - raw)) AS mae,
  sqrt(avg((target - raw) ** 2)) AS rmse,
  1 - sum((target - raw) ** 2) / (var_pop(target) * count(*)) AS r2,
  avg(abs(target - bikes)) AS baseline_mae FROM s GROUP BY split)"""

_HISTORY_OUT = f"""station_id, slot AS feature_observed_at, hour_utc, day_of_week,
  bikes AS available_bikes, docks AS available_docks, capacity,
  {_r("ratio", "availability_ratio")}, target AS target_available_bikes_15m,
  'collected' AS source_name"""

_HALVES = f"""{_H}, tg AS (SELECT station_id, slot, bikes FROM h WHERE slot < {q.UPSERT_TO}),
sr AS (SELECT station_id, slot, bikes + 100 AS bikes FROM h WHERE slot >= {q.UPSERT_FROM})"""

_DOCS = f"""{_E}, d AS (SELECT *, n // 500 AS poll FROM e),
du AS (SELECT poll, max(source_updated_at) AS last_updated FROM d GROUP BY poll),
di AS (SELECT poll, station_id, arg_max(capacity, arrival) AS capacity, arg_max(name, arrival) AS name,
  arg_max(spot, arrival) AS spot, max(arrival) AS listed
  FROM d WHERE capacity IS NOT NULL GROUP BY poll, station_id)"""

# The JSON text of an event: keys in order, no spaces, missing values as null.
_DIGEST = """sha256('{"metadata":' || CASE WHEN listed IS NULL THEN '{}' ELSE '{"arrival":' || listed
  || ',"capacity":' || di.capacity || ',"lat":' || (40.0::DOUBLE + di.spot) || ',"lon":' || (-74.0::DOUBLE + di.spot)
  || ',"name":"' || di.name || '","station_id":"' || station_id || '"}' END
  || ',"schema_version":1,"source_updated_at":' || last_updated || ',"station_id":"' || station_id
  || '","status":{"arrival":' || arrival || ',"bikes_available":' || coalesce(d.alias::VARCHAR, 'null')
  || ',"is_installed":' || is_installed || ',"is_renting":1,"is_returning":1,"last_reported":' || last_reported
  || ',"num_bikes_available":' || coalesce(d.canonical::VARCHAR, 'null') || ',"num_docks_available":' || docks
  || ',"station_id":"' || station_id || '"},"system_id":"testbed"}') AS event_id"""

_CHAMPIONS = f"(SELECT * FROM l WHERE model_version = '{q.CHAMPION}')"

_TICK = "slot // 900"

ORACLES: dict[str, str] = {
    "profile_batch": f"WITH {_BROKEN_PROFILE} SELECT * FROM p",
    "distinct_estimate": f"""WITH {_E} SELECT strftime(make_timestamp(ingested_at * 1000000), '%Y-%m-%d') AS event_date,
  field, count(DISTINCT v) AS exact, CAST(1 AS INTEGER) AS near
  FROM (SELECT ingested_at, 'station_id' AS field, station_id AS v FROM e
    UNION ALL SELECT ingested_at, 'event_id', event_id FROM e) GROUP BY 1, 2""",
    "freshness_bands": f"""WITH {_E} SELECT CASE WHEN age < -60 THEN 'future'
  WHEN age <= 900 THEN 'within_limit' WHEN age <= 1800 THEN 'within_grace' ELSE 'too_old' END AS band,
  count(*) AS rows FROM (SELECT source_updated_at - last_reported AS age FROM e) GROUP BY 1""",
    "plan_issues": f"""WITH {_PROFILE}, policy AS (SELECT * FROM (VALUES (0, 0), (0, 900), (1, 0), (1, 900))
  AS v(alias, grace))
SELECT alias, grace, concat_ws('; ',
  CASE WHEN alias = 1 AND alias_candidates = 0
    THEN 'Alias enabled but no alias-only bike counts were profiled' END,
  CASE WHEN grace > 0 AND within_freshness_grace = 0
    THEN 'Freshness grace enabled but no observations qualify' END) AS issues FROM p, policy""",
    "choose_plan": f"""WITH {_PROFILE} SELECT CAST(alias_candidates > 0 AS INTEGER) AS allow_bikes_available_alias,
  CASE WHEN within_freshness_grace > 0 THEN 900 ELSE 0 END AS freshness_grace_seconds,
  'Apply the profiled, allowlisted station policies' AS rationale FROM p""",
    "clean_batch": f"""WITH {_J} SELECT n, replay, station_id, bikes AS num_bikes_available, capacity,
  CAST(used_alias AS INTEGER) AS used_alias, CAST(used_grace AS INTEGER) AS used_grace, reason, outcome
  FROM j""",
    "outcome_counts": f"""WITH {_J} SELECT outcome, reason, count(*) AS rows,
  count(*) FILTER (used_alias) AS with_alias FROM j GROUP BY outcome, reason""",
    "quarantine": f"""WITH {_J} SELECT event_id, station_id, reason,
  CAST(len(string_split(problems, '; ')) - CASE WHEN problems = '' THEN 1 ELSE 0 END AS INTEGER) AS problems
  FROM j WHERE reason IS NOT NULL""",
    "dedup_first": f"""WITH {_J} SELECT event_id, arrival, station_id, bikes AS num_bikes_available
  FROM j WHERE outcome = 'accepted'""",
    "alias_resolve": f"""WITH {_J} SELECT n, replay, bikes AS num_bikes_available,
  CAST(used_alias AS INTEGER) AS used_alias FROM j""",
    "lift_fields": f"""WITH {_E} SELECT n, replay, CAST(1 AS INTEGER) AS schema_version, event_id,
  'testbed' AS system_id, station_id, source_updated_at, last_reported, ingested_at,
  canonical AS num_bikes_available, docks AS num_docks_available, is_installed,
  CAST(1 AS INTEGER) AS is_renting, CAST(1 AS INTEGER) AS is_returning, capacity,
  name AS station_name, 40.0::DOUBLE + spot AS lat, -74.0::DOUBLE + spot AS lon FROM e""",
    "validate_rows": f"""WITH {_E} SELECT n, replay, {_PROBLEMS.format(bikes="canonical")} AS problems FROM e""",
    "quality_report": f"""WITH {_J} SELECT count(*) AS input_rows,
  count(*) FILTER (outcome = 'accepted') AS accepted_rows,
  count(*) FILTER (outcome = 'quarantined') AS quarantined_rows,
  count(*) FILTER (outcome = 'duplicate') AS duplicate_rows,
  count(*) FILTER (outcome = 'accepted' AND used_alias) AS alias_recovered_rows,
  count(*) FILTER (outcome = 'accepted' AND used_grace) AS grace_accepted_rows, '' AS issues,
  CASE WHEN count(*) FILTER (outcome = 'accepted' AND used_grace) > 0
    THEN 'Some observations were accepted under freshness grace' ELSE '' END AS warnings,
  0 AS repairable FROM j""",
    "enrich_rows": f"""WITH {_J} SELECT event_id, last_reported, 'batch-1' AS batch_id,
  strftime(make_timestamp(last_reported * 1000000), '%Y-%m-%d') AS event_date
  FROM j WHERE outcome = 'accepted'""",
    "event_digest": f"""WITH {_DOCS} SELECT {_DIGEST}, station_id, last_updated AS source_updated_at
  FROM d JOIN du USING (poll) LEFT JOIN di USING (poll, station_id)""",
    "flatten_snapshot": f"""WITH {_DOCS} SELECT {_DIGEST}, CAST(1 AS INTEGER) AS schema_version, 'testbed' AS system_id,
  station_id, last_updated AS source_updated_at, last_updated + 10 AS ingested_at, last_reported, docks,
  di.capacity, di.name FROM d JOIN du USING (poll) LEFT JOIN di USING (poll, station_id)""",
    "raw_landing": f"""WITH {_DOCS} SELECT 'testbed' AS system_id,
  strftime(make_timestamp((last_updated + 10) * 1000000), '%Y-%m-%d') AS event_date,
  count(*) AS objects, min(CAST(last_updated + 10 AS VARCHAR)) AS first_poll FROM du GROUP BY ALL""",
    "json_decode": """WITH m AS (SELECT event_id AS "offset", CAST(user_id % 4 AS INTEGER) AS partition,
  CASE WHEN event_id % 17 = 0 THEN left(props, len(props) - 2)
       WHEN event_id % 19 = 0 THEN '[' || props || ']' ELSE props END AS value FROM events),
c AS (SELECT *, CASE WHEN json_valid(value) THEN json_type(value) = 'OBJECT' ELSE false END AS good FROM m)
SELECT "offset", partition, CASE WHEN good THEN CAST(json_extract(value, '$.k') AS BIGINT) END AS k,
  CASE WHEN NOT good THEN value END AS raw,
  CASE WHEN good THEN NULL WHEN json_valid(value) THEN 'Event must be a JSON object'
       ELSE 'Value is not valid JSON' END AS decode_error FROM c""",
    "topic_frame": f"""WITH {_E} SELECT station_id AS key, event_id, last_reported, name FROM e""",
    "validate_audit": f"""WITH {_U} SELECT station_id, slot, due AS target_at,
  predicted AS predicted_available_bikes_15m, nullif(concat_ws('; ',
    CASE WHEN capacity IS NULL THEN 'capacity:missing' END,
    CASE WHEN ratio + CASE WHEN slot // 900 % 11 = 0 THEN 1.5 ELSE 0 END > 1
      THEN 'availability_ratio:too_large' END,
    CASE WHEN slot // 900 % 23 = 0 THEN 'note:unknown' END), '') AS error FROM u""",
    "upsert": f"""WITH {_HALVES} SELECT station_id, slot AS last_reported,
  coalesce(sr.bikes, tg.bikes) AS num_bikes_available FROM tg FULL JOIN sr USING (station_id, slot)""",
    "inspect_lake": f"""WITH {_HALVES} SELECT 'observations' AS name,
  CAST(max(v) AS BIGINT) AS version, count(DISTINCT station_id || '/' || slot) AS rows,
  CAST(NULL AS VARCHAR) AS status
  FROM (SELECT *, 1 AS v FROM tg UNION ALL SELECT *, 2 AS v FROM sr)
  UNION ALL SELECT 'prediction_audits', NULL, NULL, 'missing'""",
    "stage_observations": f"""WITH {_H} SELECT station_id, slot AS event_epoch, bikes AS available_bikes,
  docks AS available_docks, capacity, 'collected' AS source_name FROM f""",
    "feature_history": f"WITH {_H} SELECT {_HISTORY_OUT} FROM t",
    "sort_history": f"""WITH {_H} SELECT station_id, slot AS last_reported, bikes AS num_bikes_available,
  capacity, docks AS num_docks_available FROM f ORDER BY slot, station_id""",
    "dedup_history": f"""WITH {_EV} SELECT 'st-' || (user_id % 5) AS station_id, ep - ep % 900 AS last_reported,
  max(ep) AS source_updated_at, arg_max(event_id, (ep, event_id)) AS event_id FROM ev GROUP BY 1, 2""",
    "dq_unique": f"""WITH {_EV} SELECT user_id % 5 AS station, ep - ep % 900 AS slot, count(*) AS copies
  FROM ev GROUP BY 1, 2 HAVING count(*) > 1""",
    "dq_not_null": f"""WITH {_H}, n AS (SELECT * REPLACE (CASE WHEN {_TICK} % 97 <> 0 THEN capacity END AS capacity,
  CASE WHEN {_TICK} % 97 <> 0 THEN ratio END AS ratio) FROM f),
c AS (SELECT count(*) AS n, count(station_id) AS a, count(slot) AS b, count(bikes) AS c, count(docks) AS d,
  count(capacity) AS e, count(hour_utc) AS f, count(day_of_week) AS g, count(ratio) AS h FROM n)
SELECT 'not_null_' || name AS "check", c.n - present AS failing_rows FROM c, LATERAL (VALUES
  ('staged_station_id', a), ('staged_event_timestamp', b), ('staged_available_bikes', c),
  ('staged_available_docks', d), ('staged_capacity', e), ('history_station_id', a),
  ('history_event_timestamp', b), ('history_feature_observed_at', b), ('history_hour_utc', f),
  ('history_day_of_week', g), ('history_available_bikes', c), ('history_available_docks', d),
  ('history_capacity', e), ('history_availability_ratio', h)) AS x(name, present)""",
    "dq_bounds": f"""WITH {_H} SELECT station_id, slot AS feature_observed_at, bikes AS available_bikes,
  docks AS available_docks FROM f WHERE bikes < 0 OR docks < 0 OR bikes > 25 OR docks > 25
  OR ratio < 0 OR ratio > 1""",
    "test_summary": f"""WITH {_H}, tight AS (SELECT * REPLACE (
  CASE WHEN {_TICK} % 41 = 0 THEN 25 ELSE capacity END AS capacity) FROM f),
tt AS (SELECT * REPLACE (bikes / capacity::DOUBLE AS ratio) FROM tight
  UNION ALL SELECT * REPLACE (bikes / capacity::DOUBLE AS ratio) FROM tight WHERE {_TICK} % 50 = 0),
failing AS (
  SELECT count(*) AS n FROM (SELECT station_id, slot FROM tt GROUP BY ALL HAVING count(*) > 1)
  UNION ALL SELECT count(*) FROM tt WHERE bikes < 0 OR docks < 0 OR bikes > capacity OR docks > capacity
  OR ratio < 0 OR ratio > 1
  UNION ALL SELECT unnest([count(*) - count(station_id), count(*) - count(slot), count(*) - count(bikes),
    count(*) - count(docks), count(*) - count(capacity), count(*) - count(station_id),
    count(*) - count(slot), count(*) - count(slot), count(*) - count(hour_utc),
    count(*) - count(day_of_week), count(*) - count(bikes), count(*) - count(docks),
    count(*) - count(capacity), count(*) - count(ratio)]) FROM tt)
SELECT CASE WHEN n > 0 THEN 'fail' ELSE 'pass' END AS status, count(*) AS checks FROM failing GROUP BY 1""",
    "latest_features": f"""WITH {_H} SELECT {_HISTORY_OUT} FROM t
  QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY slot DESC) = 1""",
    "history_extent": f"WITH {_H} SELECT min(slot) - 60 AS start_at, max(slot) + 60 AS end_at FROM h",
    "point_in_time": f"""WITH {_U} SELECT n AS event_id, a.station_id, seen AS asked_at,
  CASE WHEN seen - slot <= 172800 THEN slot END AS feature_observed_at,
  CASE WHEN seen - slot <= 172800 THEN bikes END AS available_bikes,
  CASE WHEN seen - slot <= 172800 THEN hour_utc END AS hour_utc
  FROM a ASOF LEFT JOIN f ON a.station_id = f.station_id AND a.seen >= f.slot""",
    "nearest_asof": f"""WITH {_labeled(600)} SELECT event_id, station_id, seen AS actual_at,
  actual AS actual_available_bikes FROM l""",
    "monitor_select": f"WITH {_U} SELECT event_id, served AS served_at, model_version FROM u WHERE {_WINDOW}",
    "validity_flags": f"WITH {_U} SELECT event_id, {_FLAGS} FROM u WHERE {_WINDOW}",
    "monitor_metrics": f"""WITH {_labeled(120)} SELECT {_MEASURES}, 2.5::DOUBLE AS training_test_mae,
  {_r("avg(abs(predicted - actual)) / 2.5", "production_to_training_mae_ratio")}
  FROM (SELECT *, {_FLAGS} FROM l WHERE {_WINDOW})""",
    "error_metrics": f"""WITH {_labeled(120)} SELECT {_r("count(actual)", "labeled_count")},
  {_r("avg(abs(predicted - actual))", "production_mae")},
  {_r("sqrt(avg((predicted - actual) * (predicted - actual)))", "production_rmse")},
  {_r("avg(abs(bikes - actual))", "persistence_baseline_mae")}
  FROM l WHERE {_WINDOW} AND actual IS NOT NULL""",
    "station_breakdown": f"""WITH {_labeled(120)} SELECT station_id, count(*) AS samples,
  {_r("avg(abs(predicted - actual))", "mae")} FROM l WHERE {_WINDOW} AND actual IS NOT NULL
  GROUP BY station_id""",
    "psi": f"""WITH {_H}, {_psi(f"SELECT * FROM g WHERE slot < {q.DRIFT_CUT}",
                              f"SELECT * FROM g WHERE slot >= {q.DRIFT_CUT}")}
SELECT feature, {_r("psi", "psi")} FROM scores""",
    "monitor_decision": f"""WITH {_labeled(120)},
w AS (SELECT *, {_FLAGS} FROM l WHERE {_WINDOW}),
{_psi("SELECT * FROM g", "SELECT * FROM w")},
m AS (SELECT 0 AS win, {_MEASURES} FROM w),
scored AS (SELECT 0 AS win, feature, psi FROM scores), {_VERDICT}
SELECT status, warnings, failures, CAST((SELECT count(*) FROM scored) + (SELECT count(sample_count) + count(labeled_count)
  + count(label_coverage) + count(invalid_feature_rate) + count(stale_feature_rate) + 2 * count(production_mae)
  + count(production_rmse) + count(persistence_baseline_mae) + 1 FROM m) AS INTEGER) AS metrics FROM verdict""",
    "monitor_backfill": f"""WITH {_labeled(120)},
w AS (SELECT *, unnest(range(greatest(served // 3600 + 1, (due + 3599) // 3600),
  served // 3600 + 25)) * 3600 AS window_end, {_FLAGS} FROM {_CHAMPIONS}),
{_every("window_end")}
SELECT window_end, {_FILLED} FROM hours LEFT JOIN found_rows USING (window_end)""",
    "backfill_decisions": f"""WITH {_labeled(120)},
w AS (SELECT *, unnest(range(greatest(served // 3600 + 1, (due + 3599) // 3600),
  served // 3600 + 25)) * 3600 AS win, {_FLAGS} FROM {_CHAMPIONS}),
{_psi("SELECT * FROM g", "SELECT * FROM w WHERE false")},
cur AS (SELECT * FROM ({_long("w", "win, ")}) WHERE v IS NOT NULL),
cb AS (SELECT win, feature, v, origin, len(list_filter(inner_edges, lambda k: k <= v)) AS bin
  FROM cur JOIN (SELECT feature, r0 AS origin, edges[2:len(edges) - 1] AS inner_edges FROM shape) USING (feature)),
cn AS (SELECT win, feature, count(*) AS n, min(v) AS lo, max(v) AS hi, any_value(origin) AS origin
  FROM cb GROUP BY win, feature),
cc AS (SELECT win, feature, bin, count(*) AS k FROM cb GROUP BY win, feature, bin),
grid AS (SELECT win, feature, bin, n FROM cn JOIN (SELECT DISTINCT feature, bin FROM shares) USING (feature)
  UNION SELECT win, feature, bin, n FROM cc JOIN cn USING (win, feature)),
terms AS (SELECT win, feature, greatest(coalesce(k, 0) / n::DOUBLE, 1e-6) AS c, coalesce(r, 1e-6) AS r
  FROM grid LEFT JOIN cc USING (win, feature, bin) LEFT JOIN shares USING (feature, bin)),
drifted AS (SELECT win, feature, CASE WHEN any_value(r1 - r0) <= 1e-8 + 1e-5 * abs(any_value(r0))
  THEN CASE WHEN any_value(greatest(abs(lo - r0), abs(hi - r0))) <= 1e-8 + 1e-5 * abs(any_value(r0))
       THEN 0 ELSE 1 END ELSE sum((c - terms.r) * ln(c / terms.r)) END AS psi
  FROM terms JOIN cn USING (win, feature) JOIN shape USING (feature) GROUP BY win, feature),
{_every("win")}, m AS (SELECT win, {_FILLED} FROM hours LEFT JOIN found_rows USING (win)),
scored AS (SELECT win, feature, coalesce(psi, 0) AS psi FROM hours
  CROSS JOIN (SELECT unnest({list(_DRIFT)!r}) AS feature) LEFT JOIN drifted USING (win, feature)), {_VERDICT}
SELECT win AS window_end, status, warnings, failures, {_r("psi_prediction", "psi_prediction")} FROM verdict""",
    "chrono_split": f"""WITH {_H}, {_SPLIT.format(source="f")}
SELECT station_id, slot AS feature_observed_at, split FROM s""",
    "regression_scores": f"""WITH {_SCORES} SELECT split, samples, {_r("mae", "mae")}, {_r("rmse", "rmse")},
  {_r("r2", "r2")}, {_r("baseline_mae", "baseline_mae")} FROM r""",
    "promotion_gate": f"""WITH {_SCORES} SELECT {_r("v.mae", "validation_mae")},
  {_r("v.baseline_mae", "baseline_validation_mae")}, {_r("x.mae", "test_mae")},
  {_r("x.rmse", "test_rmse")}, {_r("x.r2", "test_r2")},
  CAST(v.mae < v.baseline_mae AS INTEGER) AS promoted
  FROM r v, r x WHERE v.split = 'validation' AND x.split = 'test'""",
    "champion_lookup": f"""WITH {_H}, v AS (SELECT CAST(CAST(substr(station_id, 4) AS INTEGER) + 8 AS VARCHAR) AS version,
  'run-' || CAST(substr(station_id, 4) AS INTEGER) % 2 AS run_id, avg(abs(bikes - 15)) AS mae FROM f GROUP BY station_id),
al AS (SELECT 'champion' AS alias, arg_min(version, (mae, version)) AS version FROM v
  UNION ALL SELECT 'candidate', CAST(max(CAST(version AS BIGINT)) AS VARCHAR) FROM v WHERE run_id = 'run-0')
SELECT 'bikes' AS name, alias, version, run_id, {_r("mae", "training_test_mae")} FROM al JOIN v USING (version)""",
    "fit_model": f"""WITH {_SCORES} SELECT split, samples, {_r("baseline_mae", "baseline_mae")},
  CAST(1 AS INTEGER) AS in_range, CAST(1 AS INTEGER) AS beats_baseline FROM r WHERE split <> 'train'""",
    "score_requests": f"""WITH {_H}, latest AS (SELECT * FROM g
  QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY slot DESC) = 1),
rq AS (SELECT 'req-' || event_id AS request_id, 'st-' || (user_id % 7) AS station_id FROM ev)
SELECT request_id, station_id, slot + 900 AS target_at, {_r("raw", "raw_prediction")},
  CAST(CASE WHEN raw IS NOT NULL THEN greatest(0, least(30, round_even(raw, 0))) END AS BIGINT)
    AS predicted_available_bikes_15m,
  hour_utc, day_of_week, bikes AS available_bikes, docks AS available_docks, capacity,
  CASE WHEN slot IS NULL THEN 0 ELSE 1 END AS found FROM rq LEFT JOIN latest USING (station_id)""",
}
