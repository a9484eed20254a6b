"""ANSI SQL for every query that SQL can state, over the same tables."""

from __future__ import annotations

from itertools import combinations

from hourloom.plans import standins as V

HOUR = "hourly_range"


def _mean(condition: str = "true") -> str:
    return (
        f"CAST(sum(CAST(value AS DECIMAL(18,2))) FILTER (WHERE {condition}) AS DOUBLE)"
        f" / count(value) FILTER (WHERE {condition})"
    )


def _kind(*kinds: str) -> str:
    return f"event_type IN ({', '.join(repr(k) for k in kinds)})"


def _listed(times: list[str], flag: str, kind: str = "TIMESTAMP") -> str:
    rows = ", ".join(f"({kind} '{t}', 1)" for t in times)
    return f"(SELECT * FROM (VALUES {rows}) AS t({HOUR}, {flag}))"


HOURLY = f"""
ev AS (SELECT *, date_trunc('hour', ts) AS {HOUR} FROM events),
patients AS (
  SELECT {HOUR},
    count(*) AS total_patient_count,
    count(*) FILTER (WHERE {_kind('error', 'purchase')}) AS patient_count_ESI_1_2,
    count(*) FILTER (WHERE {_kind('click')}) AS patient_count_ESI_3,
    count(*) FILTER (WHERE {_kind('view', 'signup')}) AS patient_count_ESI_4_5,
    {_mean()} AS cumulative_total_average_waiting_time,
    coalesce({_mean(_kind('error', 'purchase'))}, 0.0) AS cumulative_average_waiting_ESI_1_2,
    coalesce({_mean(_kind('click'))}, 0.0) AS cumulative_average_waiting_ESI_3,
    coalesce({_mean(_kind('view', 'signup'))}, 0.0) AS cumulative_average_waiting_ESI_4_5,
    min(value) AS temp, max(value) AS humidity, max(value) - min(value) AS wind_speed,
    CASE first(event_type ORDER BY ts, event_id)
      WHEN 'click' THEN 'Clouds' WHEN 'error' THEN 'Drizzle' WHEN 'purchase' THEN 'Clear'
      WHEN 'signup' THEN 'Thunderstorm' ELSE 'Snow' END AS weather_main
  FROM ev GROUP BY 1),
census AS (SELECT {HOUR}, count(DISTINCT user_id) AS UED_Hospital_Census FROM ev GROUP BY 1),
boarding AS (
  SELECT {HOUR}, count(*) AS boarding_count, {_mean()} AS average_boarding_times_minute
  FROM ev WHERE event_type = 'purchase' GROUP BY 1),
treatment AS (
  SELECT {HOUR}, count(*) AS treatment_count, {_mean()} AS average_waiting_times_treatment_minute
  FROM ev WHERE event_type = 'click' GROUP BY 1)"""

CATEGORY = (
    "CASE WHEN weather_main IN ('Clouds', 'Mist') THEN 'Clouds'"
    " WHEN weather_main IN ('Rain', 'Drizzle') THEN 'Rain'"
    " WHEN weather_main IN ('Thunderstorm', 'Clear') THEN weather_main ELSE 'Others' END"
)
ONE_HOT = ", ".join(
    f"CAST(weather_type = '{w}' AS INTEGER) AS weather_{w}"
    for w in ("Clear", "Clouds", "Others", "Rain", "Thunderstorm")
)
CALENDAR = (
    f"CAST(year({HOUR}) AS INTEGER) AS year, CAST(month({HOUR}) AS INTEGER) AS month,"
    f" CAST(day({HOUR}) AS INTEGER) AS day_of_month, CAST(hour({HOUR}) AS INTEGER) AS hour,"
    f" CAST(isodow({HOUR}) - 1 AS INTEGER) AS day_of_week"
)
ROUNDED_PATIENTS = ", ".join(
    f"round_even({c}, 0) + 0.0 AS {c}"
    for c in (
        "cumulative_total_average_waiting_time", "cumulative_average_waiting_ESI_1_2",
        "cumulative_average_waiting_ESI_3", "cumulative_average_waiting_ESI_4_5",
        "temp", "humidity", "wind_speed",
    )
)
IN_RANGE = f"{HOUR} BETWEEN TIMESTAMP '{V.RANGE[0]}' AND TIMESTAMP '{V.RANGE[1]}'"
MERGED_HOURS = f"""{HOURLY},
merged AS (
  SELECT c.{HOUR}, c.UED_Hospital_Census, p.* EXCLUDE ({HOUR}), b.* EXCLUDE ({HOUR}), t.* EXCLUDE ({HOUR})
  FROM (SELECT * FROM census WHERE {IN_RANGE}) c
  JOIN (SELECT * REPLACE ({ROUNDED_PATIENTS}) FROM patients) p ON p.{HOUR} = c.{HOUR}
  JOIN (SELECT * REPLACE (round_even(average_boarding_times_minute, 0) + 0.0
                          AS average_boarding_times_minute) FROM boarding) b ON b.{HOUR} = c.{HOUR}
  JOIN treatment t ON t.{HOUR} = c.{HOUR})"""

HOME, AWAY, HOLIDAY = (
    "Alabama_Football_Game_Actual_Time", "Auburn_Football_Game_Actual_Time", "Federal_Holiday"
)
HOME_LIST = _listed(V.HOME_GAME_HOURS, HOME)
AWAY_LIST = _listed(V.AWAY_GAME_HOURS, AWAY)
HOLIDAY_LIST = _listed(V.HOLIDAY_DATES, HOLIDAY, "DATE")


def _lags(column: str, count: int, window: str = "w") -> list[str]:
    return [f"lag({column}, {i}) OVER {window} AS lag_{i}_{column}" for i in range(1, count + 1)]


def _leads(column: str, count: int, window: str = "w") -> list[str]:
    return [f"lead({column}, {i}) OVER {window} AS future_{i}_{column}" for i in range(1, count + 1)]


def supervised(
    source: str, carry: list[str], order: list[str], features: list[str], lags: dict[str, int],
    target: str, horizon: int, keys: list[str] = (),
) -> str:
    """CTEs ``shifted`` (all shifts) and ``frame`` (complete rows with idx and series_rows)."""
    part = f"PARTITION BY {', '.join(keys)} " if keys else ""
    shifts = [s for c, n in lags.items() for s in _lags(c, n)] + _leads(target, horizon)
    names = [s.rsplit(" ", 1)[1] for s in shifts]
    label = names[-1]
    kept = [*features, *[n for n in names if n.startswith("lag_")], label]
    complete = " AND ".join(f"{n} IS NOT NULL" for n in [*features, *names])
    return f"""
shifted AS (
  SELECT {', '.join([*carry, *features, *shifts])} FROM {source}
  WINDOW w AS ({part}ORDER BY {', '.join(order)})),
frame AS (
  SELECT {', '.join([*carry, *kept])},
    CAST(row_number() OVER ({part}ORDER BY {', '.join(order)}) - 1 AS BIGINT) AS idx,
    count(*) OVER ({part}) AS series_rows
  FROM shifted WHERE {complete})"""


def _split_of(rows: str = "series_rows") -> str:
    train = f"floor(CAST({rows} AS DOUBLE) * CAST(0.7 AS DOUBLE))"
    val = f"floor(CAST({rows} AS DOUBLE) * CAST(0.15 AS DOUBLE))"
    return f"CASE WHEN idx < {train} THEN 'train' WHEN idx < {train} + {val} THEN 'val' ELSE 'test' END"


SPLIT = f"split_frame AS (SELECT *, {_split_of()} AS split FROM frame)"

FLAGSHIP = f"""{MERGED_HOURS},
flagged AS (
  SELECT m.*, coalesce(g.{HOME}, 0) AS {HOME}, coalesce(a.{AWAY}, 0) AS {AWAY},
    coalesce(h.{HOLIDAY}, 0) AS {HOLIDAY}, {CATEGORY} AS weather_type,
    {CALENDAR.replace(HOUR, 'm.' + HOUR)}
  FROM merged m
  LEFT JOIN {HOME_LIST} g ON g.{HOUR} = m.{HOUR}
  LEFT JOIN {AWAY_LIST} a ON a.{HOUR} = m.{HOUR}
  LEFT JOIN {HOLIDAY_LIST} h ON h.{HOUR} = CAST(m.{HOUR} AS DATE)),
full_table AS (
  SELECT *, {ONE_HOT},
    CASE WHEN total_patient_count >=
      (SELECT avg(total_patient_count) + stddev_samp(total_patient_count) FROM flagged)
      THEN 1 ELSE 0 END AS extreme_indicator
  FROM flagged),
{supervised('full_table', [HOUR], [HOUR], V.FEATURES, V.CONFIG.lag_features, 'total_patient_count', 6)}"""

ORDER_MEASURES = """count(*) AS order_count,
    CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_value,
    count(*) FILTER (WHERE substr(o_orderpriority, 1, 1) IN ('1', '2')) AS urgent_count,
    count(*) FILTER (WHERE substr(o_orderpriority, 1, 1) = '3') AS medium_count,
    count(*) FILTER (WHERE substr(o_orderpriority, 1, 1) IN ('4', '5')) AS low_count"""
DAILY = f"daily AS (SELECT o_orderdate AS day, {ORDER_MEASURES} FROM orders GROUP BY 1)"
DAILY_BY_NATION = f"""
daily_by_nation AS (
  SELECT c_nationkey AS nation, o_orderdate AS day, {ORDER_MEASURES}
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"""
DAILY_FRAME = f"""{DAILY_BY_NATION},
{supervised('daily_by_nation', ['nation', 'day'], ['day'], V.DAILY_FEATURES, V.DAILY_LAGS,
            'order_count', V.HORIZON, ['nation'])}"""
DAILY_SPLIT = f"{DAILY_FRAME}, {SPLIT}"
PREDICTIONS = f"""{DAILY_BY_NATION},
ahead AS (
  SELECT nation, day, order_count, {', '.join(_leads('order_count', 6))}
  FROM daily_by_nation WINDOW w AS (PARTITION BY nation ORDER BY day)),
predictions AS (
  SELECT nation, CAST(row_number() OVER (PARTITION BY nation ORDER BY day) - 1 AS BIGINT) AS row_id,
    CAST(future_6_order_count AS DOUBLE) AS y_true, CAST(order_count AS DOUBLE) AS y_pred
  FROM ahead WHERE {' AND '.join(f'future_{i}_order_count IS NOT NULL' for i in range(1, 7))})"""

EVENT_ROWS = """
event_rows AS (
  SELECT ts, event_id, user_id, value,
    CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS is_click,
    CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS is_purchase,
    CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week
  FROM events)"""
EVENT_FRAME = f"""{EVENT_ROWS},
{supervised('event_rows', ['ts', 'event_id'], ['ts', 'event_id'], V.EVENT_FEATURES, V.EVENT_LAGS,
            'value', V.EVENT_HORIZON)}"""
EVENT_SPLIT = f"{EVENT_FRAME}, {SPLIT}"
EVENT_LABEL = "future_2_value"
EVENT_INPUTS = [*V.EVENT_FEATURES, "lag_1_value", "lag_2_value", "lag_3_value"]
DAILY_LABEL = "future_6_order_count"
DAILY_INPUTS = [
    *V.DAILY_FEATURES, *[f"lag_{i}_{c}" for c, n in V.DAILY_LAGS.items() for i in range(1, n + 1)]
]


def _params(inputs: list[str], label: str, keys: list[str] = ()) -> str:
    """CTE ``params``: one row per scaled column (and series)."""
    by = "".join(f"{k}, " for k in keys)
    group = f" GROUP BY {', '.join(keys)}" if keys else ""
    rows = [
        f"SELECT {by}'{'target' if c == label else 'feature'}' AS role, '{c}' AS \"column\","
        f" avg(CAST({c} AS DOUBLE)) AS mean,"
        f" CASE WHEN min({c}) = max({c}) THEN 1.0 ELSE stddev_pop(CAST({c} AS DOUBLE)) END AS std,"
        f" count(DISTINCT {c}) > 2 AS non_binary"
        f" FROM split_frame WHERE split = 'train'{group}"
        for c in [*inputs, label]
    ]
    union = " UNION ALL ".join(rows)
    return f"""profile AS ({union}),
params AS (SELECT {by}role, "column", mean, std FROM profile WHERE non_binary OR role = 'target')"""


def _scaled(column: str, keys: list[str] = ()) -> str:
    same = "".join(f" AND p.{k} = s.{k}" for k in keys)
    pick = f"FROM params p WHERE p.\"column\" = '{column}'{same}"
    x = f"CAST(s.{column} AS DOUBLE)"
    return f"coalesce(({x} - (SELECT mean {pick})) / (SELECT std {pick}), {x})"


METRICS = """round(avg(abs(y_true - y_pred)), 6) AS mae,
  round(avg((y_true - y_pred) * (y_true - y_pred)), 6) AS mse,
  round(sqrt(avg((y_true - y_pred) * (y_true - y_pred))), 6) AS rmse,
  round(CASE WHEN min(y_true) <> max(y_true)
    THEN 1 - sum((y_true - y_pred) * (y_true - y_pred)) / (var_pop(y_true) * count(y_true))
    WHEN sum((y_true - y_pred) * (y_true - y_pred)) = 0 THEN 1.0 ELSE 0.0 END, 6) AS r2"""

DAMAGED = """CASE WHEN row_id % 97 = 13 THEN CAST('NaN' AS DOUBLE)
  WHEN row_id % 101 = 17 THEN CAST('Infinity' AS DOUBLE) ELSE y_pred - 2 END"""

TRIALS = """
trial_rows AS (
  SELECT CASE l_returnflag WHEN 'A' THEN 'RF' WHEN 'N' THEN 'GBT' ELSE 'TSTPlus' END AS model,
    CASE WHEN l_partkey % 2 = 0 THEN 'total_patient_count' ELSE 'boarding_count' END AS target,
    l_linenumber AS horizon, 'dataset' || CAST(1 + l_suppkey % 15 AS VARCHAR) AS dataset,
    l_orderkey AS trial_num,
    CASE WHEN l_linestatus = 'O' THEN 'completed' ELSE 'pruned' END AS status,
    CASE WHEN l_quantity >= 2 THEN l_extendedprice / 1000 END AS mae, l_shipdate AS started,
    l_linenumber, l_partkey, l_suppkey, l_quantity, l_discount, l_tax
  FROM lineitem),
keyed AS (
  SELECT *, CAST(horizon AS VARCHAR) || 'hours_' || target || '_' || dataset AS dataset_key
  FROM trial_rows),
trials AS (
  SELECT *, 'reg_' || model || '_' || dataset_key || CASE WHEN mae IS NULL THEN '_unscored'
    ELSE '_trial' || CAST(trial_num AS VARCHAR) || '_mae' || printf('%.4f', mae) END AS run_id
  FROM keyed)"""

def _stump_fit(*splits: str) -> str:
    """CTEs ``priced`` and ``best``: the split of least squared error over the quantities, and its two means."""
    chosen = ", ".join(f"'{s}'" for s in splits)
    return f"""
priced AS (
  SELECT CASE WHEN l_orderkey % 10 < 7 THEN 'train' WHEN l_orderkey % 10 = 7 THEN 'val' ELSE 'test' END AS split,
    l_quantity AS q, l_extendedprice AS p FROM lineitem),
fitted AS (SELECT q, count(*) AS n, sum(p) AS s FROM priced WHERE split IN ({chosen}) GROUP BY q),
cuts AS (
  SELECT q, sum(n) OVER (ORDER BY q) AS n, sum(s) OVER (ORDER BY q) AS s,
    sum(n) OVER () AS all_n, sum(s) OVER () AS all_s FROM fitted),
best AS (
  SELECT q, s / n AS low, (all_s - s) / (all_n - n) AS high FROM cuts WHERE n < all_n
  ORDER BY s * s / n + (all_s - s) * (all_s - s) / (all_n - n) DESC LIMIT 1)"""


def _stump(*splits: str) -> str:
    return f"""WITH {_stump_fit(*splits)}
        SELECT split, round(CASE WHEN priced.q <= best.q THEN low ELSE high END, 2) AS y_pred,
          count(*) AS rows, round(sum(p), 1) AS total
        FROM priced, best WHERE split <> 'train' GROUP BY ALL"""


def _rewritten(split: str) -> str:
    return f"""WITH {EVENT_SPLIT}
        SELECT 'value' AS target, 2 AS horizon, 'dataset1' AS dataset, {split} AS split, count(*) AS rows,
          CAST(sum(idx) AS BIGINT) AS positions, CAST(sum(idx) AS BIGINT) AS written_positions
        FROM split_frame GROUP BY ALL"""


FLAGSHIP_LABEL = "future_6_total_patient_count"
FLAGSHIP_INPUTS = [
    *V.FEATURES, *[f"lag_{i}_{c}" for c, n in V.CONFIG.lag_features.items() for i in range(1, n + 1)]
]
_daily_scaled = [*V.DAILY_FEATURES, DAILY_LABEL]

ORACLES = {
    "range_filter": f"""WITH {HOURLY} SELECT {HOUR}, total_patient_count, temp, humidity FROM patients
        WHERE {HOUR} BETWEEN TIMESTAMP '2024-01-05 06:00:00' AND TIMESTAMP '2024-01-20 18:00:00'""",
    "range_filter_events": """SELECT event_id, ts, value FROM events
        WHERE ts BETWEEN TIMESTAMP '2024-01-05 06:00:00' AND TIMESTAMP '2024-01-20 00:00:00'""",
    "exclusion_filter": f"""WITH {HOURLY} SELECT {HOUR}, total_patient_count FROM patients
        WHERE NOT ({HOUR} BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-12 00:00:00')""",
    "round_half_even": """SELECT source, id, round_even(x, 0) + 0.0 AS x, round_even(half, 0) + 0.0 AS half
        FROM (SELECT 'order' AS source, o_orderkey AS id, o_totalprice AS x, floor(o_totalprice) / 2 AS half
              FROM orders
              UNION ALL SELECT 'event', event_id, value, -floor(value) / 2 FROM events)""",
    "merge_inner_hourly": f"""WITH {MERGED_HOURS.replace(IN_RANGE, "true")} SELECT * REPLACE (
        round(average_waiting_times_treatment_minute, 6) AS average_waiting_times_treatment_minute) FROM merged""",
    "enrich_games": f"""WITH {HOURLY} SELECT p.{HOUR}, total_patient_count,
        coalesce(a.{AWAY}, 0) AS {AWAY}, coalesce(g.{HOME}, 0) AS {HOME} FROM patients p
        LEFT JOIN {HOME_LIST} g ON g.{HOUR} = p.{HOUR} LEFT JOIN {AWAY_LIST} a ON a.{HOUR} = p.{HOUR}""",
    "enrich_holiday": f"""WITH {HOURLY} SELECT p.{HOUR}, total_patient_count,
        coalesce(h.{HOLIDAY}, 0) AS {HOLIDAY} FROM patients p
        LEFT JOIN {HOLIDAY_LIST} h ON h.{HOUR} = CAST(p.{HOUR} AS DATE)""",
    "enrich_holiday_events": f"""SELECT event_id, ts AS {HOUR}, coalesce(h.{HOLIDAY}, 0) AS {HOLIDAY}
        FROM events LEFT JOIN {HOLIDAY_LIST} h ON h.{HOUR} = CAST(ts AS DATE)""",
    "calendar_features": f"WITH {HOURLY} SELECT {HOUR}, {CALENDAR} FROM patients",
    "weather_category": f"WITH {HOURLY} SELECT {HOUR}, {CATEGORY} AS weather_type FROM patients",
    "weather_onehot": f"""WITH {HOURLY} SELECT *, {ONE_HOT}
        FROM (SELECT {HOUR}, {CATEGORY} AS weather_type FROM patients)""",
    "extreme_flag": f"""WITH {HOURLY} SELECT {HOUR}, total_patient_count, CASE WHEN total_patient_count >=
        (SELECT avg(total_patient_count) + stddev_samp(total_patient_count) FROM patients)
        THEN 1 ELSE 0 END AS extreme_indicator FROM patients""",
    "extreme_flag_by_series": """SELECT event_id, user_id, value, CASE WHEN value >= threshold
        THEN 1 ELSE 0 END AS extreme_indicator FROM events JOIN (SELECT user_id, avg(value) + stddev_samp(value)
        AS threshold FROM events GROUP BY 1) USING (user_id)""",
    "regular_grid": f"""WITH {HOURLY}, span AS (SELECT min({HOUR}) AS lo, max({HOUR}) AS hi FROM boarding)
        SELECT g.{HOUR}, boarding_count, round(average_boarding_times_minute, 6) AS average_boarding_times_minute
        FROM (SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS {HOUR} FROM span) g
        LEFT JOIN boarding b ON b.{HOUR} = g.{HOUR}""",
    "regular_grid_half_hours": f"""WITH {HOURLY}, span AS (SELECT min({HOUR}) AS lo, max({HOUR}) AS hi FROM boarding)
        SELECT g.h + INTERVAL 30 MINUTE AS {HOUR}, boarding_count,
          round(average_boarding_times_minute, 6) + 0.0 AS average_boarding_times_minute
        FROM (SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS h FROM span) g
        LEFT JOIN boarding b ON b.{HOUR} = g.h""",
    "csv_inputs": f"""WITH {MERGED_HOURS} SELECT {HOUR}, UED_Hospital_Census, boarding_count,
        average_boarding_times_minute, treatment_count,
        round(average_waiting_times_treatment_minute, 6) + 0.0 AS average_waiting_times_treatment_minute FROM merged""",
    "prepared_dataset": f"""WITH {FLAGSHIP}, {SPLIT}
        SELECT 'total_patient_count' AS target, 6 AS horizon, 'dataset15' AS dataset,
          '6hours_total_patient_count_dataset15' AS dataset_key,
          count(*) FILTER (WHERE split = 'train') AS train_rows, count(*) FILTER (WHERE split = 'val') AS val_rows,
          count(*) FILTER (WHERE split = 'test') AS test_rows, CAST({len(V.FEATURES)} AS BIGINT) AS original_features,
          CAST({sum(V.CONFIG.lag_features.values())} AS BIGINT) AS lag_features,
          count(*) AS read_rows, CAST(sum(idx) AS BIGINT) AS read_positions FROM split_frame""",
    "dataset_rewrite": _rewritten("CASE WHEN split = 'train' THEN 'train' ELSE 'test' END"),
    "dataset_kept_when_a_rewrite_fails": _rewritten("split"),
    "written_merged": f"""WITH {FLAGSHIP} SELECT {HOUR}, day_of_week, extreme_indicator, {HOLIDAY},
        weather_Clear, weather_Clouds, weather_Others, weather_Rain, weather_Thunderstorm FROM full_table""",
    "written_scalers": f"""WITH {FLAGSHIP}, {SPLIT}, {_params(FLAGSHIP_INPUTS, FLAGSHIP_LABEL)}
        SELECT role, "column", round(mean + 1e-7, 4) AS mean, round(std + 1e-7, 4) AS std FROM params""",
    "written_tensors": f"""WITH {FLAGSHIP}, {SPLIT}, {_params(FLAGSHIP_INPUTS, FLAGSHIP_LABEL)}
        SELECT idx, split, {len(FLAGSHIP_INPUTS)} AS n_features,
          round(CAST(CAST({_scaled('total_patient_count')} AS FLOAT) AS DOUBLE), 3) + 0.0 AS x,
          round(CAST(CAST({_scaled(FLAGSHIP_LABEL)} AS FLOAT) AS DOUBLE), 3) + 0.0 AS y FROM split_frame s""",
    "logged_trials": """SELECT o_orderpriority AS search_id, count(*) AS trials,
          round(sum(o_custkey / 60.0 + CASE WHEN o_orderkey % 3 = 1 THEN 1 ELSE 0 END), 2) AS minutes,
          min(o_totalprice / 1000) AS mae FROM orders GROUP BY 1""",
    "logged_evaluations": f"""WITH {_stump_fit('train', 'val')},
        missed AS (SELECT split, p - CASE WHEN priced.q <= best.q THEN low ELSE high END AS miss FROM priced, best)
        SELECT split, count(*) AS predictions_count, count(*) AS test_set_size, round(avg(abs(miss)), 2) AS mae,
          round(sqrt(avg(miss * miss)), 2) AS rmse FROM missed WHERE split <> 'train' GROUP BY split""",
    "scored_table": f"""WITH {_stump_fit('train', 'val')}
        SELECT l_returnflag, round(CASE WHEN l_quantity <= best.q THEN low ELSE high END, 2) AS y_pred, count(*) AS rows
        FROM lineitem, best GROUP BY ALL""",
    "supervised_frame_known_lags": f"""WITH events_with AS (SELECT ts, event_id, value FROM events),
        {supervised('events_with', ['ts', 'event_id'], ['ts', 'event_id'], ['value'], {'value': 1}, 'value', 1)}
        SELECT * FROM frame""",
    "scoring_inputs": """SELECT 'reordered' AS input, count(*) AS rows, sum(l_quantity) AS quantity,
          'l_orderkey,l_quantity,l_tax' AS verdict FROM lineitem
        UNION ALL SELECT 'too few', 0, NULL, 'refused' UNION ALL SELECT 'renamed', 0, NULL, 'refused'""",
    "supervised_frame_missing": f"""WITH events_with AS (
          SELECT ts, event_id, CASE WHEN event_id % 53 <> 7 THEN value END AS value FROM events),
        {supervised('events_with', ['ts', 'event_id'], ['ts', 'event_id'], ['value'], {'value': 1}, 'value', 1)}
        SELECT * FROM frame""",
    "validation_by_series": f"""WITH {DAILY_SPLIT},
        means AS (SELECT nation, avg({DAILY_LABEL}) AS y_pred FROM split_frame WHERE split = 'train' GROUP BY 1),
        judged AS (SELECT nation, CAST({DAILY_LABEL} AS DOUBLE) - y_pred AS miss
          FROM split_frame JOIN means USING (nation) WHERE split = 'test')
        SELECT nation, true AS success, round(avg(abs(miss)), 4) AS mae, round(sqrt(avg(miss * miss)), 4) AS rmse,
          CAST(NULL AS DOUBLE) AS expected_mae, CAST(0 AS DOUBLE) AS max_std, false AS inconsistent
        FROM judged GROUP BY GROUPING SETS ((nation), ())""",
    "test_file_datasets": f"""WITH {TRIALS} SELECT CASE WHEN status = 'completed' THEN dataset ELSE 'unknown' END AS found,
        count(*) AS files FROM trials GROUP BY 1""",
    "rf_stump_forecast": _stump("train", "val"),
    "gbt_stump_forecast": _stump("train"),
    "registered_model_verdict": f"""WITH {_stump_fit('train', 'val')}
        SELECT 'price' AS target, 1 AS horizon, 'dataset1' AS dataset,
          (SELECT round(avg(p), 2) FROM priced WHERE split = 'train') AS mean,
          (SELECT round(stddev_pop(p), 2) FROM priced WHERE split = 'train') AS std, true AS success,
          round(avg(abs(p - CASE WHEN priced.q <= best.q THEN low ELSE high END)), 2) AS mae,
          true AS mae_matches, CAST(0 AS DOUBLE) AS max_std, false AS inconsistent
        FROM priced, best WHERE split = 'test'""",
    "trial_outcomes": f"""WITH {PREDICTIONS}
        SELECT 'sound' AS trial, 'completed' AS status, count(*) AS rows, round(avg(abs(y_true - y_pred)), 6) AS mae,
          NULL AS reason FROM predictions
        UNION ALL SELECT 'damaged', 'pruned', count(*), NULL, 'not finite' FROM predictions
        UNION ALL SELECT 'empty', 'pruned', 0, NULL, 'no rows to score'
        UNION ALL SELECT 'failing', 'error', NULL, NULL, 'given'""",
    "row_index_events": """SELECT ts, event_id,
        CAST(row_number() OVER (ORDER BY ts, event_id) - 1 AS BIGINT) AS idx FROM events""",
    "row_index_by_series": """SELECT user_id, ts, event_id, CAST(row_number() OVER
        (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS BIGINT) AS idx FROM events""",
    "lag_features": f"""SELECT ts, event_id, value, {', '.join(_lags('value', 4))}
        FROM events WINDOW w AS (ORDER BY ts, event_id)""",
    "lead_features": f"""SELECT ts, event_id, value, {', '.join(_leads('value', 4))}
        FROM events WINDOW w AS (ORDER BY ts, event_id)""",
    "merge_bucketed_hourly": f"""WITH {MERGED_HOURS.replace(IN_RANGE, "true")} SELECT * REPLACE (
        round(average_waiting_times_treatment_minute, 6) AS average_waiting_times_treatment_minute) FROM merged""",
    "rolling_mean_wide": """WITH holed AS (SELECT ts, event_id, CASE WHEN event_id % 1009 <> 7 THEN value END AS value FROM events)
        SELECT ts, event_id, value, round(CASE WHEN count(value) OVER f = 700
          THEN CAST(sum(CAST(value AS DECIMAL(18,6))) OVER f AS DOUBLE) / 700 END, 6) + 0.0 AS rolling_mean_value_window_size_700
        FROM holed WINDOW f AS (ORDER BY ts, event_id ROWS 699 PRECEDING)""",
    "rolling_mean_wide_by_series": """SELECT user_id, ts, event_id, value, round(CASE WHEN count(value) OVER f = 3
          THEN CAST(sum(CAST(value AS DECIMAL(18,6))) OVER f AS DOUBLE) / 3 END, 6) + 0.0 AS rolling_mean_value_window_size_3
        FROM events WINDOW f AS (PARTITION BY user_id ORDER BY ts, event_id ROWS 2 PRECEDING)""",
    "scaler_params_by_month": f"""WITH lines AS (
          SELECT * REPLACE (CASE WHEN l_tax > 0.04 THEN l_tax END AS l_tax) FROM lineitem),
        profile AS ({' UNION ALL '.join(
          f"""SELECT l_linestatus, '{c}' AS "column", avg(CAST({c} AS DOUBLE)) AS mean,
            stddev_pop(CAST({c} AS DOUBLE)) AS std,
            count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) > 2 AS non_binary
            FROM lines GROUP BY l_linestatus"""
          for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"))})
        SELECT l_linestatus, CASE WHEN "column" = 'l_extendedprice' THEN 'target' ELSE 'feature' END AS role, "column",
          round(mean, 6) AS mean, round(std, 6) AS std FROM profile WHERE non_binary OR "column" = 'l_extendedprice'""",
    "category_frequencies": f"""WITH counted AS ({' UNION ALL '.join(
          f"""SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS category, count(*) AS frequency
            FROM lineitem WHERE {c} IS NOT NULL GROUP BY ALL"""
          for c in ("l_returnflag", "l_linestatus", "l_linenumber"))})
        SELECT *, CAST(row_number() OVER (PARTITION BY "column" ORDER BY category) - 1 AS INTEGER) AS position FROM counted""",
    "onehot_fitted": """SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS "status_F",
          CAST(o_orderstatus = 'O' AS INTEGER) AS "status_O",
          CAST(o_orderstatus NOT IN (SELECT l_linestatus FROM lineitem) AS INTEGER) AS status_unseen,
          CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 END AS position FROM orders""",
    "covering_pairs": f"""{' UNION ALL '.join(
          f"""SELECT '{a}' AS "first", '{b}' AS "second", count(DISTINCT {a}) * count(DISTINCT {b}) AS pairs,
            true AS few_maps FROM lineitem"""
          for a, b in combinations(("l_returnflag", "l_linestatus", "l_linenumber", "l_discount", "l_tax"), 2))}""",
    "rolling_mean": f"""WITH {DAILY} SELECT day, total_value,
        round(CASE WHEN count(total_value) OVER f = 4 THEN avg(total_value) OVER f END, 4)
        AS rolling_mean_total_value_window_size_4
        FROM daily WINDOW f AS (ORDER BY day ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)""",
    "lagged_and_rolling": f"""SELECT user_id, ts, event_id, value, {', '.join(_lags('value', 2))},
        {', '.join(_leads('value', 2))},
        round(CASE WHEN count(value) OVER f = 3 THEN avg(value) OVER f END, 4) AS rolling_mean_value_window_size_3
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id),
        f AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
    "supervised_frame": f"""WITH {FLAGSHIP} SELECT * EXCLUDE (series_rows) REPLACE (
        CAST(idx AS BIGINT) AS idx, round(average_waiting_times_treatment_minute, 6)
        AS average_waiting_times_treatment_minute), {_split_of()} AS split FROM frame""",
    "supervised_frame_by_series": f"WITH {DAILY_FRAME} SELECT * FROM frame",
    "supervised_frame_events": f"WITH {EVENT_FRAME} SELECT * FROM frame",
    "supervised_frame_bounded_series": f"""WITH ev AS (SELECT *, date_trunc('hour', ts) AS {HOUR} FROM events),
        by_type AS (SELECT event_type, {HOUR}, count(*) AS events, max(value) AS peak FROM ev GROUP BY 1, 2),
        {supervised('by_type', ['event_type', HOUR], [HOUR], ['events', 'peak'],
                    {'events': 3, 'peak': 2}, 'events', 2, ['event_type'])}
        SELECT * FROM frame""",
    "chronological_split_frame": f"WITH {EVENT_SPLIT} SELECT event_id, idx, split FROM split_frame",
    "chronological_split_by_series": f"WITH {DAILY_SPLIT} SELECT nation, day, idx, split FROM split_frame",
    "split_row_counts": f"WITH {FLAGSHIP}, {SPLIT} SELECT split, count(*) AS rows FROM split_frame GROUP BY 1",
    "split_row_counts_by_series": f"""WITH {DAILY_SPLIT}
        SELECT nation, split, count(*) AS rows FROM split_frame GROUP BY 1, 2""",
    "train_val_concat": f"""WITH {EVENT_SPLIT}
        SELECT idx, split, value, {EVENT_LABEL} FROM split_frame WHERE split = 'train'
        UNION ALL SELECT idx, split, value, {EVENT_LABEL} FROM split_frame WHERE split = 'val'""",
    "nonbinary_columns": f"""WITH {EVENT_SPLIT}, {_params(EVENT_INPUTS, EVENT_LABEL)}
        SELECT "column", non_binary FROM profile WHERE role = 'feature'""",
    "scaler_params": f"""WITH {EVENT_SPLIT}, {_params(EVENT_INPUTS, EVENT_LABEL)}
        SELECT role, "column", round(mean, 6) AS mean, round(std, 6) AS std FROM params""",
    "scaler_params_by_series": f"""WITH {DAILY_SPLIT}, {_params(DAILY_INPUTS, DAILY_LABEL, ['nation'])}
        SELECT nation, role, "column", round(mean + 1e-7, 4) AS mean, round(std + 1e-7, 4) AS std FROM params""",
    "scaled_frame": f"""WITH {EVENT_SPLIT}, {_params(EVENT_INPUTS, EVENT_LABEL)}
        SELECT idx, split, {', '.join(f'round({_scaled(c)}, 6) + 0.0 AS {c}_scaled'
                                      for c in [*EVENT_INPUTS, EVENT_LABEL])} FROM split_frame s""",
    "scaled_frame_by_series": f"""WITH {DAILY_SPLIT}, {_params(DAILY_INPUTS, DAILY_LABEL, ['nation'])}
        SELECT nation, idx, split, {', '.join(f'round({_scaled(c, ["nation"])}, 6) + 0.0 AS {c}_scaled'
                                              for c in _daily_scaled)} FROM split_frame s""",
    "unscaled_frame": f"""WITH {DAILY_SPLIT} SELECT nation, idx, {DAILY_LABEL},
        round(CAST({DAILY_LABEL} AS DOUBLE), 6) AS restored FROM split_frame""",
    "feature_arrays": f"""WITH {EVENT_SPLIT}, {_params(EVENT_INPUTS, EVENT_LABEL)},
        arrays AS (SELECT idx, split, {_scaled(EVENT_LABEL)} AS y,
          [{', '.join(_scaled(c) for c in EVENT_INPUTS)}] AS x FROM split_frame s)
        SELECT idx, split, CAST(position - 1 AS INTEGER) AS position,
          round(CAST(CAST(x[position] AS FLOAT) AS DOUBLE), 3) + 0.0 AS x,
          round(CAST(CAST(y AS FLOAT) AS DOUBLE), 3) + 0.0 AS y
        FROM arrays, range(1, {len(EVENT_INPUTS) + 1}) r(position)""",
    "aligned_predictions": f"""WITH {PREDICTIONS} SELECT t.nation, t.row_id, t.y_true, p.y_pred
        FROM predictions t JOIN predictions p ON p.nation = t.nation AND p.row_id - 3 = t.row_id""",
    "regression_metrics": f"WITH {PREDICTIONS} SELECT count(*) AS rows, {METRICS} FROM predictions",
    "regression_metrics_by_run": f"""WITH {PREDICTIONS}
        SELECT nation, count(*) AS rows, {METRICS} FROM predictions GROUP BY 1""",
    "array_mean_prediction": """SELECT vec_id, round(list_avg(CAST(embedding AS DOUBLE[])), 6) AS y_pred
        FROM embeddings""",
    "residual_profile": f"""WITH {PREDICTIONS} SELECT nation,
        round(avg(y_true - y_pred), 6) + 0.0 AS residual_mean,
        round(stddev_pop(y_true - y_pred), 6) AS residual_std,
        abs(avg(y_true - y_pred)) > 0.1 * stddev_pop(y_true - y_pred) AS biased FROM predictions GROUP BY 1""",
    "range_check": f"""WITH {PREDICTIONS}, ranges AS (SELECT nation,
          max(y_pred * (nation % 3 + 0.25)) - min(y_pred * (nation % 3 + 0.25)) AS pred_range,
          max(y_true) - min(y_true) AS true_range FROM predictions GROUP BY 1)
        SELECT *, pred_range > 2 * true_range AS too_wide,
          NOT pred_range > 2 * true_range AND pred_range < 0.5 * true_range AS too_narrow FROM ranges""",
    "prediction_issue_counts": f"""WITH {PREDICTIONS}, damaged AS (SELECT nation, {DAMAGED} AS y_pred FROM predictions)
        SELECT nation, count(*) AS rows, count(*) FILTER (WHERE isnan(y_pred)) AS nan_count,
          count(*) FILTER (WHERE isinf(y_pred)) AS inf_count,
          count(*) FILTER (WHERE y_pred < 0) AS negative_count FROM damaged GROUP BY 1""",
    "finite_counts": """WITH damaged AS (SELECT l_returnflag, CASE WHEN l_quantity = 1 THEN CAST('NaN' AS DOUBLE)
            WHEN l_quantity = 2 THEN CAST('-Infinity' AS DOUBLE) WHEN l_quantity <> 3 THEN l_quantity END AS quantity,
            l_extendedprice AS price FROM lineitem),
        long AS (SELECT l_returnflag, 'quantity' AS "column", quantity AS v FROM damaged
            UNION ALL SELECT l_returnflag, 'price', price FROM damaged)
        SELECT l_returnflag, "column", count(*) FILTER (WHERE isnan(v)) AS nan_count,
          count(*) FILTER (WHERE isinf(v)) AS inf_count, count(*) FILTER (WHERE v IS NULL) AS null_count
        FROM long GROUP BY 1, 2""",
    "nan_to_null_mean": """SELECT l_returnflag, count(*) FILTER (WHERE l_quantity <> 1) AS present,
        round(avg(l_quantity) FILTER (WHERE l_quantity <> 1), 6) AS mean_quantity FROM lineitem GROUP BY 1""",
    "repeatability": f"""WITH {PREDICTIONS}, runs AS (SELECT nation, row_id,
          y_pred + (row_id % 3) * (nation % 5) * 0.0004 * n AS y_pred FROM predictions, range(5) r(n)),
        spread AS (SELECT nation, row_id, stddev_pop(y_pred) AS std FROM runs GROUP BY 1, 2)
        SELECT nation, round(max(std), 6) + 0.0 AS max_std, max(std) > 0.001 AS inconsistent FROM spread GROUP BY 1""",
    "validation": f"""WITH {PREDICTIONS},
        mixed AS (SELECT nation, row_id, y_true, CASE WHEN nation % 4 = 3 THEN {DAMAGED} ELSE y_pred END AS y_pred
          FROM predictions),
        claimed AS (SELECT nation, CASE WHEN nation % 7 <> 6 THEN CAST(printf('%.4f',
            avg(abs(y_true - y_pred)) + (nation % 2) * 0.5) AS DOUBLE) END AS expected_mae
          FROM predictions GROUP BY 1),
        sound AS (SELECT nation, bool_and(isfinite(y_true) AND isfinite(y_pred)) AS success FROM mixed GROUP BY 1),
        finite AS (SELECT * FROM mixed JOIN sound USING (nation) WHERE success),
        checked AS (SELECT nation, avg(abs(y_true - y_pred)) AS raw_mae, {METRICS},
            nullif(concat_ws('; ',
              CASE WHEN count(*) FILTER (WHERE y_pred < 0) > 0 THEN 'Negative predictions ('
                || count(*) FILTER (WHERE y_pred < 0) || '/' || count(*) || ')' END,
              CASE WHEN max(y_pred) - min(y_pred) > 2 * (max(y_true) - min(y_true))
                THEN 'Prediction range much larger than true range'
              WHEN max(y_pred) - min(y_pred) < 0.5 * (max(y_true) - min(y_true))
                THEN 'Prediction range much smaller than true range' END,
              CASE WHEN abs(avg(y_true - y_pred)) > 0.1 * stddev_pop(y_true - y_pred)
                THEN 'Systematic bias detected (mean residual: ' || printf('%.4f', avg(y_true - y_pred)) || ')' END
            ), '') AS found FROM finite GROUP BY 1)
        SELECT s.nation, s.success, mae, mse, rmse, r2, round(expected_mae, 6) AS expected_mae,
          coalesce(s.success AND expected_mae <> 0 AND abs(raw_mae - expected_mae) < 0.01, false) AS mae_matches,
          coalesce(found, '') AS issues, CASE WHEN NOT s.success THEN 'UNKNOWN'
            WHEN found IS NULL THEN 'SAFE FOR PRODUCTION' ELSE 'USE WITH CAUTION' END AS recommendation
        FROM sound s LEFT JOIN checked USING (nation) LEFT JOIN claimed USING (nation)""",
    "trial_run_ids": f"""WITH {TRIALS}, found AS (SELECT run_id, dataset_key, mae,
            CAST(nullif(regexp_extract(lower(run_id), 'mae[_]?(\\d+\\.?\\d*)', 1), '') AS DOUBLE) AS found_mae,
            nullif(regexp_extract(run_id, '(dataset\\d+)', 1), '') AS found_dataset,
            regexp_extract(run_id, '(\\d+)hours_(.+?)_dataset\\d+', 1) AS h,
            regexp_extract(run_id, '(\\d+)hours_(.+?)_dataset\\d+', 2) AS found_target FROM trials)
        SELECT run_id, dataset_key, found_mae, found_dataset, CAST(h AS INTEGER) AS found_horizon, found_target,
          coalesce(abs(mae - found_mae) < 0.01, false) AS matches FROM found""",
    "grid_run_ids": f"""WITH {TRIALS} SELECT trial_num, l_partkey, l_suppkey,
        concat_ws('_', strftime(started, '%Y%m%d_%H%M%S'), replace(printf('%.4f', mae), '.', '_'), 'RF',
          CAST(horizon AS VARCHAR), 'depth', CAST(CAST(l_quantity AS INTEGER) AS VARCHAR), 'leaf', dataset)
          AS grid_run_id, coalesce(printf('%.4f', mae), 'N/A') AS mae_text FROM trials""",
    "trial_minutes": f"""WITH {TRIALS} SELECT model, status, count(*) AS trials,
        CAST(sum(CAST(l_quantity AS INTEGER) * 60 + trunc(l_discount * 100)) AS BIGINT) AS seconds
        FROM trials GROUP BY 1, 2""",
    "best_trial": f"""WITH {TRIALS}, ranked AS (SELECT *, row_number() OVER (PARTITION BY model, dataset
            ORDER BY mae, trial_num, l_linenumber, l_partkey, l_suppkey) AS place
          FROM trials WHERE status = 'completed' AND mae IS NOT NULL)
        SELECT g.model, g.dataset, g.completed_trials, r.mae, r.trial_num, r.l_linenumber, r.l_partkey,
          r.l_suppkey, r.run_id
        FROM (SELECT model, dataset, count(*) FILTER (WHERE status = 'completed' AND mae IS NOT NULL)
                AS completed_trials FROM trials GROUP BY 1, 2) g
        LEFT JOIN ranked r ON r.model = g.model AND r.dataset = g.dataset AND r.place = 1""",
    "dataset_catalog": f"""WITH {TRIALS} SELECT target, horizon, dataset, count(*) AS trials,
        count(*) FILTER (WHERE status = 'completed') AS completed,
        count(*) FILTER (WHERE status = 'pruned') AS pruned FROM trials GROUP BY 1, 2, 3""",
    "model_dataset_location": f"""WITH {TRIALS} SELECT target, horizon, dataset, count(*) AS models,
        nullif(count(*) FILTER (WHERE status = 'completed'), 0) AS trials FROM trials GROUP BY 1, 2, 3""",
    "scaler_lookup": f"""WITH {DAILY_SPLIT}, {_params(DAILY_INPUTS, DAILY_LABEL, ['nation'])},
        {PREDICTIONS.replace(DAILY_BY_NATION + ',', '')},
        named AS (SELECT nation, 'dataset' || nation AS dataset, mean, std, role, "column",
            CASE WHEN role = 'target' THEN 'target_scaler_dataset' || nation
            WHEN "column" LIKE 'lag@_%' ESCAPE '@' THEN 'scaler_' || "column"
            ELSE 'scaler_dataset' || nation || '_' || "column" END AS scaler FROM params),
        scalers AS (SELECT 'full' AS catalogue, * FROM named
            UNION ALL SELECT 'features', * FROM named WHERE role = 'feature'
            UNION ALL SELECT 'lags', * FROM named WHERE "column" LIKE 'lag@_%' ESCAPE '@'),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY catalogue, nation ORDER BY CASE
            WHEN lower(scaler) LIKE '%target%' THEN 0 WHEN contains(scaler, dataset) THEN 1 ELSE 2 END, scaler)
            AS place FROM scalers)
        SELECT catalogue, p.nation, dataset, scaler, row_id, round(y_pred * std + mean, 3) AS y_pred
        FROM predictions p JOIN ranked r ON r.nation = p.nation AND place = 1""",
}
