"""DuckDB SQL for the registered queries, written apart from the Spark code."""

from __future__ import annotations


def rnd(x: str, n: int) -> str:
    """Half-up rounding of the shortest decimal form, as Spark's round on doubles."""
    return f"round(({x})::VARCHAR::DECIMAL(38,20), {n})::DOUBLE"


NOW = "TIMESTAMP '2024-02-01 12:00:00'"

READINGS = """
SELECT 'EVT-' || lpad(event_id::VARCHAR, 8, '0') AS event_id, event_id AS num,
       'TRK-' || lpad((user_id % 25)::VARCHAR, 3, '0') AS truck_id, (user_id % 25)::INTEGER AS truck_num,
       make_timestamp(1706659200000000 + (epoch_us(ts) - 1704067200000000) // 20) AS event_time,
       8::DOUBLE + (event_id * 11 % 2900) / 100::DOUBLE AS gps_lat,
       68::DOUBLE + (event_id * 13 % 2900) / 100::DOUBLE AS gps_lon,
       (['Apple','Beef','Bread','Cheese','Chicken','Eggs','Fish','Milk','Mushroom','Orange','Potato','Spinach','Strawberry','Tomato','Yogurt'])[user_id % 15 + 1] AS food_name,
       CASE WHEN event_id % 200 = 0 THEN NULL WHEN event_id % 997 = 0 THEN 99::DOUBLE
            ELSE (event_id * 37 % 3191) / 100::DOUBLE - 1.28::DOUBLE END AS temperature,
       CASE WHEN event_id % 201 = 0 THEN NULL ELSE 32::DOUBLE + (event_id * 53 % 6801) / 100::DOUBLE END AS humidity,
       CASE WHEN event_id % 203 = 0 THEN NULL ELSE value END AS methane,
       CASE WHEN event_id % 207 = 0 THEN NULL ELSE 304.68::DOUBLE + (props->>'k')::INT * 20::DOUBLE END AS co2,
       CASE WHEN event_id % 209 = 0 THEN NULL ELSE (event_id * 7 % 1501) / 100::DOUBLE END AS storage_days,
       (CASE event_type WHEN 'error' THEN NULL WHEN 'purchase' THEN 2 WHEN 'view' THEN 1 ELSE 0 END)::INTEGER AS spoiled
FROM events"""

FOODS = """
SELECT food_name, safe::DOUBLE AS safe, m_stream::DOUBLE AS m_stream, m_batch::DOUBLE AS m_batch, shelf::DOUBLE AS shelf
FROM (VALUES ('Apple',7,12.0,9.74,720), ('Beef',4,11.2,8.92,120), ('Bread',23,21.0,21.03,168),
 ('Cheese',6,10.6,9.14,504), ('Chicken',4,11.0,8.83,48), ('Eggs',6,11.0,10.08,504), ('Fish',3,10.8,7.96,48),
 ('Milk',5,10.5,8.37,168), ('Mushroom',6,11.3,10.55,168), ('Orange',8,12.4,12.07,504), ('Potato',10,13.5,14.01,720),
 ('Spinach',5,11.1,9.10,120), ('Strawberry',5,10.9,8.64,72), ('Tomato',10,13.8,14.10,168), ('Yogurt',5,10.7,9.35,336))
 t(food_name, safe, m_stream, m_batch, shelf)"""


def clip(x: str, low: float, high: float) -> str:
    return f"greatest({low}::DOUBLE, least({high}::DOUBLE, {x}))"


def clean(source: str, median: str, humidity: float, methane: float, co2: float, days: float) -> str:
    return f"""
SELECT r.* EXCLUDE (temperature, humidity, methane, co2, storage_days),
       {clip(f"coalesce(r.temperature, f.{median}, 11::DOUBLE)", -5, 35)} AS temperature,
       {clip(f"coalesce(r.humidity, {humidity}::DOUBLE)", 20, 100)} AS humidity,
       {clip(f"coalesce(r.methane, {methane}::DOUBLE)", 0, 180)} AS methane,
       {clip(f"coalesce(r.co2, {co2}::DOUBLE)", 300, 2400)} AS co2,
       {clip(f"coalesce(r.storage_days, {days}::DOUBLE)", 0, 15)} AS storage_days,
       coalesce(f.safe, 6::DOUBLE) AS safe, coalesce(f.shelf, 168::DOUBLE) AS shelf
FROM {source} r LEFT JOIN foods f ON r.food_name = f.food_name"""


def core(source: str, t: str, h: str, ch4: str, co2: str, peak: str) -> str:
    gas = rnd(f"least(1::DOUBLE, ({ch4} / 175::DOUBLE + {co2} / 2400::DOUBLE) / 2::DOUBLE)", 4)
    risk = (
        "0.40::DOUBLE * least(1::DOUBLE, temp_deviation / 25::DOUBLE) + 0.35::DOUBLE * gas_spoilage_score"
        " + 0.25::DOUBLE * least(1::DOUBLE, storage_days / 15::DOUBLE)"
    )
    return f"""
SELECT *, {rnd(risk, 4)} AS storage_risk_score FROM (
  SELECT *, {rnd(f"{t} * {h} / 100::DOUBLE", 4)} AS temp_humidity_index, {gas} AS gas_spoilage_score,
         {rnd(f"CASE WHEN {co2} > 0 THEN {ch4} / {co2} ELSE 0::DOUBLE END", 6)} AS methane_co2_ratio,
         {rnd(f"greatest(0::DOUBLE, {peak} - safe)", 2)} AS temp_deviation
  FROM {source})"""


def scored(source: str) -> str:
    return f"""
SELECT *, CASE ml_predicted_class WHEN 2 THEN 'CRITICAL' WHEN 1 THEN 'WARNING' ELSE 'SAFE' END AS risk_level,
       year(event_time)::INTEGER AS year, month(event_time)::INTEGER AS month,
       day(event_time)::INTEGER AS day, hour(event_time)::INTEGER AS hour
FROM (SELECT *, (CASE WHEN temperature > safe THEN 1 ELSE 0 END)::INTEGER AS temp_breach_flag,
        (CASE WHEN storage_risk_score >= 0.65 THEN 2 WHEN storage_risk_score >= 0.20 THEN 1 ELSE 0 END)::INTEGER AS ml_predicted_class,
        CASE WHEN storage_risk_score >= 0.65 THEN 0.80::DOUBLE WHEN storage_risk_score >= 0.40 THEN 0.20::DOUBLE
             WHEN storage_risk_score >= 0.20 THEN 0.15::DOUBLE ELSE 0.05::DOUBLE END AS prob_spoiled
      FROM {source})"""


HOURLY = """
SELECT truck_id, food_name, date_trunc('hour', event_time)::TIMESTAMP AS hour_window,
       year(event_time)::INTEGER AS year, month(event_time)::INTEGER AS month, day(event_time)::INTEGER AS day, hour(event_time)::INTEGER AS hour,
       avg(temperature) AS temp_avg, max(temperature) AS temp_max, min(temperature) AS temp_min,
       coalesce(stddev_samp(temperature), 0::DOUBLE) AS temp_std,
       avg(humidity) AS humidity_avg, max(humidity) AS humidity_max, avg(methane) AS methane_avg, max(methane) AS methane_max,
       avg(co2) AS co2_avg, max(co2) AS co2_max, max(storage_days) AS storage_days, count(*)::BIGINT AS readings_count,
       sum(CASE WHEN temperature > safe THEN 1 ELSE 0 END)::BIGINT AS breach_count,
       arg_max(gps_lat, event_time) AS last_lat, arg_max(gps_lon, event_time) AS last_lon, max(spoiled) AS spoiled, max(safe) AS safe
FROM clean_batch GROUP BY 1, 2, 3, 4, 5, 6, 7"""

HOURLY_LABELLED = f"""
SELECT *, CASE spoilage_label WHEN 0 THEN 'Fresh' WHEN 1 THEN 'At Risk' ELSE 'Spoiled' END AS spoilage_label_name
FROM (SELECT *, {rnd("breach_rate * storage_days * 24::DOUBLE", 2)} AS cumulative_breach_hours,
  (CASE WHEN spoiled IN (0, 1, 2) THEN spoiled
        WHEN storage_risk_score >= 0.65 OR methane_avg >= 80 OR co2_avg >= 1200 THEN 2
        WHEN storage_risk_score >= 0.35 OR breach_rate > 0.2 OR methane_avg > 20 THEN 1 ELSE 0 END)::INTEGER AS spoilage_label,
  CASE WHEN storage_risk_score >= 0.65 THEN 'CRITICAL' WHEN storage_risk_score >= 0.40 THEN 'WARNING'
       WHEN storage_risk_score >= 0.20 THEN 'WATCH' ELSE 'SAFE' END AS risk_level
 FROM (SELECT *, {rnd("breach_count / readings_count::DOUBLE", 4)} AS breach_rate, {rnd("temp_std", 4)} AS temp_volatility,
              {rnd("(temp_humidity_index / 30::DOUBLE + gas_spoilage_score) / 2::DOUBLE", 4)} AS heat_gas_stress
       FROM hourly_core))"""

LATEST = """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY truck_id ORDER BY event_time DESC, event_id DESC) AS rn FROM {source}) WHERE rn = 1"""

REGISTRY = """
SELECT 'model-' || lpad((user_id % 60)::VARCHAR, 2, '0') AS model, event_id::INTEGER AS version,
       CASE WHEN user_id % 60 % 6 = 5 THEN 'None' WHEN event_id % 11 = 0 THEN 'Production' WHEN event_id % 5 = 0 THEN 'Archived' ELSE 'None' END AS stage,
       CASE WHEN event_id % 4 = 0 THEN NULL ELSE """ + rnd("value / 50::DOUBLE", 0) + """ END AS metric,
       user_id % 2 = 0 AS higher FROM events"""

PREDICTIONS = """
SELECT event_id, y, (y + CASE WHEN num % 7 = 0 THEN 1 ELSE 0 END) % 3 AS p
FROM (SELECT event_id, num, coalesce(spoiled, ml_predicted_class) AS y FROM processed)"""

CLASS_SCORES = """
SELECT class, CASE WHEN predicted > 0 THEN tp / predicted::DOUBLE ELSE 0 END AS precision,
       CASE WHEN actual > 0 THEN tp / actual::DOUBLE ELSE 0 END AS recall,
       CASE WHEN actual + predicted > 0 THEN 2 * tp / (actual + predicted)::DOUBLE ELSE 0 END AS f1, actual AS support, tp
FROM (SELECT c.class, (SELECT count(*) FROM predictions WHERE y = c.class AND p = c.class) AS tp,
             (SELECT count(*) FROM predictions WHERE y = c.class) AS actual,
             (SELECT count(*) FROM predictions WHERE p = c.class) AS predicted
      FROM (SELECT y AS class FROM predictions UNION SELECT p FROM predictions) c)"""

TABLES = {
    "readings": READINGS,
    "foods": FOODS,
    "clean_stream": clean("readings", "m_stream", 63, 38, 870, 3),
    "clean_batch": clean("readings", "m_batch", 63.16, 44.25, 882.52, 4.54),
    "rated_stream": core("clean_stream", "temperature", "humidity", "methane", "co2", "temperature"),
    "rated_batch": core("clean_batch", "temperature", "humidity", "methane", "co2", "temperature"),
    "processed": scored("rated_stream"),
    "dirty": """
SELECT * REPLACE (CASE WHEN num % 301 = 0 THEN NULL ELSE truck_id END AS truck_id,
  CASE WHEN num % 307 = 0 THEN NULL ELSE food_name END AS food_name,
  CASE WHEN num % 311 = 0 THEN NULL ELSE temperature END AS temperature,
  CASE WHEN num % 311 = 0 THEN NULL ELSE methane END AS methane,
  CASE WHEN num % 311 = 0 THEN NULL ELSE co2 END AS co2) FROM readings""",
    "valid": """
SELECT * FROM dirty WHERE truck_id IS NOT NULL AND food_name IS NOT NULL AND event_time IS NOT NULL
 AND (temperature IS NOT NULL OR methane IS NOT NULL OR co2 IS NOT NULL)""",
    "zone_input": "SELECT * REPLACE (date_trunc('second', event_time)::TIMESTAMP AS event_time) FROM valid WHERE num % 313 <> 0",
    "zone_clean": clean("zone_input", "m_stream", 63, 38, 870, 3),
    "zone_core": core("zone_clean", "temperature", "humidity", "methane", "co2", "temperature"),
    "zone": scored("zone_core"),
    "alerts": """
SELECT *, CASE WHEN ml_predicted_class = 2 THEN 'ML_SPOILED' WHEN prob_spoiled >= 0.70 THEN 'ML_HIGH_RISK' ELSE 'TEMP_BREACH' END AS alert_type
FROM processed WHERE prob_spoiled >= 0.70 OR ml_predicted_class = 2 OR temp_breach_flag = 1""",
    "alert_rows": """
SELECT event_id, truck_id, food_name, temperature, methane, storage_risk_score AS spoilage_prob,
       (CASE risk_level WHEN 'CRITICAL' THEN 2 WHEN 'WARNING' THEN 1 ELSE 0 END)::INTEGER AS predicted_class,
       risk_level, event_time AS created_at FROM alerts""",
    "hourly": HOURLY,
    "hourly_core": core("hourly", "temp_avg", "humidity_avg", "methane_avg", "co2_avg", "temp_max"),
    "features": HOURLY_LABELLED,
    "fleet": LATEST.format(source="processed"),
    "fleet_view": """
SELECT truck_id, food_name, temperature, methane, co2, storage_days, storage_risk_score AS risk_score, spoiled_class,
       CASE spoiled_class WHEN 0 THEN 'Fresh' WHEN 1 THEN 'At Risk' ELSE 'Spoiled' END AS risk_label,
       strftime(event_time, '%H:%M:%S') AS last_update
FROM (SELECT *, (CASE risk_level WHEN 'CRITICAL' THEN 2 WHEN 'WARNING' THEN 1 ELSE 0 END)::INTEGER AS spoiled_class FROM fleet)""",
    "before18": "SELECT * FROM processed WHERE event_time < TIMESTAMP '2024-01-31 18:00:00'",
    "fleet_before": "SELECT * FROM (" + LATEST.format(source="before18") + ") WHERE truck_num % 7 <> 0",
    "fleet_updates": """
SELECT * FROM (SELECT * FROM fleet WHERE truck_num % 4 <> 1 UNION ALL SELECT * FROM fleet_before WHERE truck_num % 4 = 1)
WHERE truck_num % 5 <> 0""",
    "registry": REGISTRY,
    "predictions": PREDICTIONS,
    "class_scores": CLASS_SCORES,
}


def _needed(body: str) -> list[str]:
    """Names of the helper tables that a query uses, in definition order."""
    import re

    found: set[str] = set()
    todo = [body]
    while todo:
        text = todo.pop()
        for name in TABLES:
            if name not in found and re.search(rf"\b{name}\b", text):
                found.add(name)
                todo.append(TABLES[name])
    return [name for name in TABLES if name in found]


def query(body: str) -> str:
    """A self-contained statement: the helper tables as CTEs, then the body."""
    head = ",\n".join(f"{name} AS ({TABLES[name]})" for name in _needed(body))
    return f"WITH {head}\n{body}" if head else body
