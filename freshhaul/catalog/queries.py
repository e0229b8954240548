"""Every registered query: name, Spark callable and oracle SQL."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freshhaul.catalog import fixtures as fx
from freshhaul.catalog.fixtures import NOW
from freshhaul.catalog.oracle import NOW as SQL_NOW
from freshhaul.catalog.oracle import query, rnd
from freshhaul.functions.times import moment
from freshhaul.models import classifier, explain, shelf_life
from freshhaul.operators import (
    alerts,
    cleaning,
    enrich,
    featurize,
    gate,
    merge,
    metrics,
    quality,
    recent,
    rollup,
    sampling,
    serving,
    windows,
)
from freshhaul.plans import features as feature_plan
from freshhaul.plans import readings as reading_plan
from freshhaul.plans import report, sync
from freshhaul.plans.recovery import late_rows, read_processed, recover
from freshhaul.plans.serving import latest_alerts, truck_views
from freshhaul.plans.training import (
    CLASSIFIER,
    REGRESSOR,
    production_classifier,
    production_shelf_life,
    train_and_gate,
)
from freshhaul.reference import FOOD_NAMES, HOLDOUT_TRUCKS, food_ref
from freshhaul.schemas import CORE_FEATURES, PARTITIONS, PROCESSED, SENSORS, duplicate_keys
from freshhaul.session import scratch_path
from freshhaul.sinks import files as file_sinks
from freshhaul.sinks import tables
from freshhaul.sources import files as file_sources
from freshhaul.sources import kafka
from freshhaul.streaming import one_read
from freshhaul.streaming import pipeline as streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable:
    """Register a query over the readings fixture."""

    def add(fn: Callable[[DataFrame], DataFrame]) -> Callable:
        return register_raw(name, sql)(lambda spark, sf_dir: fn(fx.readings(spark, sf_dir)))

    return add


def register_raw(name: str, sql: str | None = None) -> Callable:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = query(sql)
        return fn

    return add


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Round sums and averages of doubles, whose last digits depend on the order of rows."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


def ntz(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


SENSOR_SQL = ", ".join(SENSORS)
CORE_SQL = ", ".join(CORE_FEATURES)

# --- sources -----------------------------------------------------------------


@register(
    "src2_decode_envelope",
    "SELECT event_id || '|' || truck_id || '|' || food_name AS json_str, (num % 8)::INTEGER AS kafka_partition,"
    " num AS kafka_offset, event_time AS kafka_timestamp FROM readings",
)
def _(df: DataFrame) -> DataFrame:
    text = F.concat_ws("|", "event_id", "truck_id", "food_name").cast("binary")
    return kafka.decode_envelope(
        df.select(
            text.alias("value"),
            (fx.number() % 8).cast("int").alias("partition"),
            fx.number().alias("offset"),
            F.col("event_time").alias("timestamp"),
        )
    )


def _gone(column: str) -> str:
    return f"CASE WHEN num % 313 = 0 THEN NULL ELSE {column} END AS {column}"


_JSON_FIELDS = ["event_id", "truck_id", "food_name", "gps_lat", "gps_lon", *SENSORS, "spoiled"]


@register(
    "src3_snk12_json_round_trip",
    f"SELECT {', '.join(map(_gone, _JSON_FIELDS))}, CASE WHEN num % 313 = 0 THEN NULL"
    " ELSE date_trunc('second', event_time)::TIMESTAMP END AS event_time,"
    " (num % 8)::INTEGER AS kafka_partition, num AS kafka_offset FROM readings",
)
def _(df: DataFrame) -> DataFrame:
    parsed = kafka.parse_readings(kafka.decode_envelope(fx.envelopes(df)))
    timed = cleaning.with_event_time(parsed)
    return ntz(timed, "event_time").select(
        *_JSON_FIELDS, "event_time", "kafka_partition", "kafka_offset"
    )


_CSV_SQL = (
    f"SELECT event_id, truck_id, food_name, {SENSOR_SQL}, spoiled, date_trunc('second', event_time)::TIMESTAMP"
    " AS event_time, day(event_time)::INTEGER AS day, hour(event_time)::INTEGER AS hour FROM readings"
)


@register("src5_readings_csv", _CSV_SQL)
def _(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, "csv")
    names = {v: k for k, v in file_sources.CSV_RENAMES.items()}
    out = df.withColumns(
        {
            "timestamp": F.date_format("event_time", "yyyy-MM-dd HH:mm:ss"),
            "source": F.lit("sensor"),
            **{c: F.lit(None).cast("double") for c in CORE_FEATURES},
        }
    ).withColumnsRenamed(names)
    schema = file_sources.SENSOR_CSV
    out.select(*schema.fieldNames()).write.option("header", "true").csv(path)
    read = file_sources.read_readings_csv(spark, path)
    return ntz(read, "event_time").select(
        "event_id", "truck_id", "food_name", *SENSORS, "spoiled", "event_time", "day", "hour"
    )


@register("src6_or_else", "SELECT event_id, temperature FROM readings")
def _(df: DataFrame) -> DataFrame:
    empty = df.filter(F.col("event_time") > moment(NOW + timedelta(days=9), "timestamp_ntz"))
    return file_sources.or_else(empty, df).select("event_id", "temperature")


# --- projections and filters ---------------------------------------------------


@register(
    "pf1_event_time",
    "SELECT event_id, CASE WHEN num % 303 = 0 THEN NULL ELSE date_trunc('second', event_time)::TIMESTAMP END"
    " AS event_time FROM readings",
)
def _(df: DataFrame) -> DataFrame:
    text = F.when(fx.number() % 303 == 0, "31/01/2024 late").otherwise(
        F.date_format("event_time", cleaning.TIME_FORMAT)
    )
    timed = cleaning.with_event_time(df.select("event_id", text.alias("timestamp")))
    return ntz(timed, "event_time").select("event_id", "event_time")


@register("pf2_valid_rows", f"SELECT event_id, truck_id, food_name, {SENSOR_SQL} FROM valid")
def _(df: DataFrame) -> DataFrame:
    return cleaning.valid_rows(fx.dirty(df)).select("event_id", "truck_id", "food_name", *SENSORS)


@register("pf3_default_food", "SELECT event_id, coalesce(food_name, 'Chicken') AS food_name FROM dirty")
def _(df: DataFrame) -> DataFrame:
    return cleaning.default_food(fx.dirty(df)).select("event_id", "food_name")


def _lookback(hours: int, mode: str) -> Callable[[DataFrame], DataFrame]:
    return lambda df: cleaning.lookback(cleaning.with_partitions(df), NOW, hours, mode).select(
        "event_id", "event_time"
    )


register(
    "pf4_lookback_feature_job",
    "SELECT event_id, event_time FROM readings WHERE year(event_time) >= 2024 AND month(event_time) >= 1"
    " AND day(event_time) >= 31",
)(_lookback(24, "partition_ge"))
register(
    "pf5_lookback_sync_jobs",
    "SELECT event_id, event_time FROM readings WHERE year(event_time) = 2024 AND month(event_time) = 2"
    " AND day(event_time) >= 1",
)(_lookback(3, "partition_eq"))
register(
    "pf5b_lookback_exact",
    f"SELECT event_id, event_time FROM readings WHERE event_time >= {SQL_NOW} - INTERVAL 20 HOURS",
)(_lookback(20, "event_time"))


@register(
    "pf6_partition_columns",
    f"SELECT event_id, year(t)::INTEGER AS year, month(t)::INTEGER AS month, day(t)::INTEGER AS day,"
    f" hour(t)::INTEGER AS hour FROM (SELECT event_id, CASE WHEN num % 5 <> 0 THEN event_time"
    f" WHEN num % 2 = 0 THEN event_time + INTERVAL 40 DAYS ELSE {SQL_NOW} END AS t FROM readings)",
)
def _(df: DataFrame) -> DataFrame:
    late = F.expr("event_time + INTERVAL 40 DAYS")
    partial = df.withColumns(
        {
            "kafka_timestamp": F.when(fx.number() % 2 == 0, late),
            "event_time": F.when(fx.number() % 5 != 0, F.col("event_time")),
        }
    )
    out = cleaning.with_partitions(partial, moment(NOW, "timestamp_ntz"))
    return out.select("event_id", "year", "month", "day", "hour")


@register("pf9_ensure_column", "SELECT event_id, 'TRK-DEMO' AS truck_id FROM readings")
def _(df: DataFrame) -> DataFrame:
    return cleaning.ensure_column(df.drop("truck_id"), "truck_id", "TRK-DEMO").select(
        "event_id", "truck_id"
    )


_ALERT_ROWS = (
    "SELECT event_id, truck_id, food_name, temperature, methane, co2, storage_days,"
    " storage_risk_score AS spoilage_prob,"
    " (CASE risk_level WHEN 'CRITICAL' THEN 2 WHEN 'WARNING' THEN 1 ELSE 0 END)::INTEGER AS predicted_class,"
    " risk_level, NULL::VARCHAR AS nearest_city, gps_lat, gps_lon FROM alerts"
)


@register("pf10_alert_rows", _ALERT_ROWS)
def _(df: DataFrame) -> DataFrame:
    return alerts.to_alert_rows(fx.alert_zone(df)).drop("alert_message", "created_at")


_VIEW = (
    "truck_id, food_name, temperature, methane, co2, storage_days, risk_score, spoiled_class,"
    " risk_label, last_update"
)


@register(
    "pf11_filter_fleet",
    f"SELECT {_VIEW} FROM fleet_view WHERE risk_label IN ('At Risk', 'Spoiled')"
    " AND food_name IN ('Apple', 'Beef', 'Milk', 'Orange', 'Yogurt', 'Chicken', 'Potato')",
)
def _(df: DataFrame) -> DataFrame:
    foods = ["Apple", "Beef", "Milk", "Orange", "Yogurt", "Chicken", "Potato"]
    view = serving.fleet_view(fx.fleet(df))
    return serving.filter_fleet(view, ["At Risk", "Spoiled"], foods).select(*_VIEW.split(", "))


@register("pf12_drop_seed_rows", "SELECT event_id, truck_id FROM readings WHERE truck_id <> 'TRK-000'")
def _(df: DataFrame) -> DataFrame:
    return serving.drop_seed_rows(df).select("event_id", "truck_id")


@register(
    "pf13_truck_history",
    "SELECT event_time AS timestamp, temperature, humidity, methane, co2 FROM readings"
    f" WHERE truck_id = 'TRK-007' AND event_time >= {SQL_NOW} - INTERVAL 24 HOURS",
)
def _(df: DataFrame) -> DataFrame:
    return serving.truck_history(df, "TRK-007", NOW)


# --- cleaning and quality --------------------------------------------------------

_FILL_SQL = (
    "SELECT r.event_id, coalesce(r.temperature, f.{m}, 11::DOUBLE) AS temperature,"
    " coalesce(r.humidity, {h}::DOUBLE) AS humidity, coalesce(r.methane, {c}::DOUBLE) AS methane,"
    " coalesce(r.co2, {o}::DOUBLE) AS co2, coalesce(r.storage_days, {d}::DOUBLE) AS storage_days"
    " FROM (SELECT * REPLACE (CASE WHEN num % 101 = 0 THEN 'Durian' ELSE food_name END AS food_name)"
    " FROM readings) r LEFT JOIN foods f ON r.food_name = f.food_name"
)


def _imputed(profile: str) -> Callable[[DataFrame], DataFrame]:
    return lambda df: cleaning.impute(fx.unknown_food(df), profile).select("event_id", *SENSORS)


register("cl1_cl2_impute_stream", _FILL_SQL.format(m="m_stream", h=63, c=38, o=870, d=3))(
    _imputed("stream")
)
register("cl1_cl2_impute_batch", _FILL_SQL.format(m="m_batch", h=63.16, c=44.25, o=882.52, d=4.54))(
    _imputed("batch")
)


@register("cl3_clip_ranges", f"SELECT event_id, {SENSOR_SQL} FROM clean_stream")
def _(df: DataFrame) -> DataFrame:
    return cleaning.clip_ranges(cleaning.impute(df, "stream")).select("event_id", *SENSORS)


_PROFILED = ["temperature", "humidity", "methane", "co2", "food_name", "truck_id"]


@register(
    "cl4_quality",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_count,"
        f" {rnd(f'count(*) FILTER ({c} IS NULL) / count(*)::DOUBLE * 100::DOUBLE', 1)} AS null_pct,"
        f" count(*) AS total_rows FROM dirty"
        for c in _PROFILED
    ),
)
def _(df: DataFrame) -> DataFrame:
    return quality.quality(fx.dirty(df))


@register("cl5_dedupe", "SELECT event_id, event_time, temperature FROM readings")
def _(df: DataFrame) -> DataFrame:
    return cleaning.dedupe(fx.deliveries(df)).select("event_id", "event_time", "temperature")


@register(
    "cl6_learn_profile",
    f"SELECT food_name, {rnd('median(temperature)', 6)} AS temperature_median, count(temperature) AS n"
    " FROM readings GROUP BY food_name",
)
def _(df: DataFrame) -> DataFrame:
    return rounded(quality.learn_profile(df), "temperature_median")


@register(
    "cl6_learn_global",
    " UNION ALL ".join(
        f"SELECT '{c}' AS reading, min({c}) AS min, max({c}) AS max, {rnd(f'avg({c})', 6)} AS mean,"
        f" {rnd(f'stddev_samp({c})', 6)} AS std, {rnd(f'median({c})', 6)} AS median, count({c}) AS n"
        f" FROM readings"
        for c in SENSORS
    ),
)
def _(df: DataFrame) -> DataFrame:
    return rounded(quality.learn_global(df), "mean", "std", "median")


# --- features and rules --------------------------------------------------------------


def _rated(df: DataFrame) -> DataFrame:
    return featurize.core_features(reading_plan.cleaned(df, "stream"))


_FE = {
    "fe1_temp_humidity_index": "temp_humidity_index",
    "fe2_gas_spoilage_score": "gas_spoilage_score",
    "fe3_methane_co2_ratio": "methane_co2_ratio",
    "fe4_temp_deviation": "temp_deviation",
    "fe5_storage_risk_score": "storage_risk_score",
}
for _name, _column in _FE.items():
    register(_name, f"SELECT event_id, {_column} FROM rated_stream")(
        lambda df, c=_column: _rated(df).select("event_id", c)
    )


@register("fe6_temp_breach_flag", "SELECT event_id, temp_breach_flag FROM processed")
def _(df: DataFrame) -> DataFrame:
    cleaned = reading_plan.cleaned(df, "stream")
    return featurize.breach_flag(cleaned).select("event_id", "temp_breach_flag")


HOUR = ["truck_id", "food_name", "hour_window"]
_HOUR_SQL = ", ".join(HOUR)


def _hour_query(*columns: str) -> Callable[[DataFrame], DataFrame]:
    return lambda df: fx.features(df).select(*HOUR, *columns)


register("fe1_fe5_hourly_core", f"SELECT {_HOUR_SQL}, {CORE_SQL} FROM features")(
    _hour_query(*CORE_FEATURES)
)
for _name, _column in {
    "fe7_breach_rate": "breach_rate",
    "fe8_temp_volatility": "temp_volatility",
    "fe9_heat_gas_stress": "heat_gas_stress",
    "fe10_cumulative_breach_hours": "cumulative_breach_hours",
    "ru1_hour_label": "spoilage_label",
    "ru3_risk_level": "risk_level",
}.items():
    register(_name, f"SELECT {_HOUR_SQL}, {_column} FROM features")(_hour_query(_column))
register("ru2_label_name", f"SELECT {_HOUR_SQL}, spoilage_label, spoilage_label_name FROM features")(
    _hour_query("spoilage_label", "spoilage_label_name")
)


@register(
    "ru4_rule_score",
    "SELECT event_id, ml_predicted_class AS cls,"
    " CASE WHEN r >= 0.65 THEN 0.05 WHEN r >= 0.40 THEN 0.15 WHEN r >= 0.20 THEN 0.40 ELSE 0.85 END::DOUBLE AS p_fresh,"
    " CASE WHEN r >= 0.65 THEN 0.15 WHEN r >= 0.40 THEN 0.65 WHEN r >= 0.20 THEN 0.45 ELSE 0.10 END::DOUBLE AS p_at_risk,"
    " prob_spoiled AS p_spoiled FROM (SELECT *, storage_risk_score AS r FROM processed)",
)
def _(df: DataFrame) -> DataFrame:
    return featurize.rule_score(_rated(df)).select("event_id", "prediction.*")


@register("ru5_stream_level", "SELECT event_id, ml_predicted_class, risk_level FROM processed")
def _(df: DataFrame) -> DataFrame:
    return fx.processed(df).select("event_id", "ml_predicted_class", "risk_level")


@register("ru6_alert_predicate", "SELECT event_id FROM alerts")
def _(df: DataFrame) -> DataFrame:
    return fx.alert_zone(df).select("event_id")


@register("ru7_alert_type", "SELECT event_id, alert_type FROM alerts")
def _(df: DataFrame) -> DataFrame:
    return fx.alert_zone(df).select("event_id", "alert_type")


@register(
    "ru8_alert_message",
    "SELECT event_id, 'ALERT: ' || truck_id || ' | ' || food_name || ' | Temp=#°C | ML_class=#"
    " | Prob_Spoiled=# | Level=' || risk_level AS alert_message FROM alerts",
)
def _(df: DataFrame) -> DataFrame:
    # Numbers are masked: engines print doubles with different digits.
    masked = F.regexp_replace("alert_message", "=-?[0-9.]+(E-?[0-9]+)?", "=#")
    return fx.alert_zone(df).select("event_id", masked.alias("alert_message"))


@register(
    "ru9_level_to_class",
    f"SELECT {_HOUR_SQL}, (CASE risk_level WHEN 'CRITICAL' THEN 2 WHEN 'WARNING' THEN 1 ELSE 0 END)::INTEGER"
    " AS cls FROM features",
)
def _(df: DataFrame) -> DataFrame:
    cls = featurize.rules.level_to_class(F.col("risk_level"))
    return fx.features(df).select(*HOUR, cls.alias("cls"))


@register(
    "ru10_what_if",
    f"""SELECT event_id, (CASE WHEN p0 >= p1 AND p0 >= p2 THEN 0 WHEN p1 >= p2 THEN 1 ELSE 2 END)::INTEGER AS what_if_class,
 {rnd('p0', 3)} AS p_fresh, {rnd('p1', 3)} AS p_at_risk, {rnd('p2', 3)} AS p_spoiled
FROM (SELECT event_id, p0 / s AS p0, p1 / s AS p1, p2 / s AS p2
 FROM (SELECT *, CASE WHEN p0 + p1 + p2 = 0 THEN 1::DOUBLE ELSE p0 + p1 + p2 END AS s
  FROM (SELECT *, greatest(0::DOUBLE, 1::DOUBLE - p0 - p2) AS p1
   FROM (SELECT event_id, greatest(0::DOUBLE, 1::DOUBLE - raw * 2.2::DOUBLE) AS p0,
         CASE WHEN raw > 0.5 THEN greatest(0::DOUBLE, raw * 1.8::DOUBLE - 0.3::DOUBLE) ELSE 0::DOUBLE END AS p2
    FROM (SELECT event_id, CASE WHEN temperature > safe + 8 OR methane > 80 OR co2 > 1400 THEN greatest(raw, 0.72::DOUBLE) ELSE raw END AS raw
     FROM (SELECT event_id, temperature, methane, co2, safe,
            CASE WHEN temperature <= safe AND methane < 10 AND co2 < 500 AND storage_days < 3 THEN least(raw, 0.18::DOUBLE) ELSE raw END AS raw
      FROM (SELECT *, 0.38::DOUBLE * least(1::DOUBLE, greatest(0::DOUBLE, temperature - safe) / 22::DOUBLE)
             + 0.35::DOUBLE * least(1::DOUBLE, (methane / 175::DOUBLE + co2 / 2400::DOUBLE) / 2::DOUBLE)
             + 0.27::DOUBLE * least(1::DOUBLE, storage_days / 15::DOUBLE) AS raw FROM clean_stream)))))))""",
)
def _(df: DataFrame) -> DataFrame:
    out = featurize.what_if(reading_plan.cleaned(df, "stream"))
    return out.select("event_id", "what_if_class", "p_fresh", "p_at_risk", "p_spoiled")


_LEFT_SQL = "greatest(0::DOUBLE, shelf * (1::DOUBLE - storage_risk_score) - storage_days * 24::DOUBLE)"


@register("ru11_shelf_life", f"SELECT event_id, {rnd(_LEFT_SQL, 6)} AS remaining_hours FROM rated_stream")
def _(df: DataFrame) -> DataFrame:
    out = featurize.shelf_life(_rated(df)).select("event_id", "remaining_hours")
    return rounded(out, "remaining_hours")


@register(
    "ru12_urgency",
    f"SELECT event_id, {rnd('h / 24::DOUBLE', 6)} AS days_left, CASE WHEN h < 12 THEN 'critical' WHEN h < 48 THEN 'low'"
    f" ELSE 'ok' END AS urgency FROM (SELECT event_id, {_LEFT_SQL} AS h FROM rated_stream)",
)
def _(df: DataFrame) -> DataFrame:
    out = featurize.urgency(featurize.shelf_life(_rated(df)))
    return rounded(out.select("event_id", "days_left", "urgency"), "days_left")


_PARTS_SQL = f"""SELECT event_id, {rnd('greatest(0::DOUBLE, temperature - safe) / 22::DOUBLE * 0.38::DOUBLE', 4)} AS a,
 {rnd('least(1::DOUBLE, (methane / 175::DOUBLE + co2 / 2400::DOUBLE) / 2::DOUBLE) * 0.35::DOUBLE', 4)} AS b,
 {rnd('storage_days / 15::DOUBLE * 0.27::DOUBLE', 4)} AS c FROM clean_stream"""


@register(
    "ru13_contributions",
    " UNION ALL ".join(
        f"SELECT event_id, '{label}' AS factor, {x} AS contribution,"
        f" (CASE WHEN {x} = greatest(a, b, c) THEN 1 ELSE 0 END)::INTEGER AS is_largest FROM ({_PARTS_SQL})"
        for x, label in (("a", "Temperature deviation"), ("b", "Gas spoilage score"), ("c", "Storage days"))
    ),
)
def _(df: DataFrame) -> DataFrame:
    return featurize.contributions(reading_plan.cleaned(df, "stream"))


def _band_sql(x: str, high: str, low: str, name: str) -> str:
    return f"CASE WHEN {x} > {high} THEN 'high' WHEN {x} > {low} THEN 'raised' ELSE 'normal' END AS {name}"


_BANDS = ["temp_band", "temp_vs_safe_band", "methane_band", "co2_band", "risk_band"]


@register(
    "ru14_severity_bands",
    "SELECT event_id, "
    + ", ".join(
        [
            _band_sql("temperature", "15", "8", "temp_band"),
            _band_sql("temperature", "safe + 5", "safe", "temp_vs_safe_band"),
            _band_sql("methane", "80", "20", "methane_band"),
            _band_sql("co2", "1400", "700", "co2_band"),
            _band_sql("storage_risk_score", "0.65", "0.35", "risk_band"),
        ]
    )
    + " FROM rated_stream",
)
def _(df: DataFrame) -> DataFrame:
    return featurize.severity_bands(_rated(df)).select("event_id", *_BANDS)


def _alert_table(df: DataFrame) -> DataFrame:
    """Stored alerts, created at their event time."""
    return fx.alert_zone(df).withColumns(
        {"created_at": F.col("event_time"), "spoilage_prob": F.col("storage_risk_score")}
    )


_DISPLAY_SQL = f"""SELECT strftime(created_at, '%Y-%m-%d %H:%M') AS time, truck_id AS truck, food_name AS food, temperature AS temp, methane,
 CASE WHEN risk_level = 'CRITICAL' THEN '🔴 CRITICAL' ELSE '🟠 WARNING' END AS risk,
 CASE WHEN spoilage_prob IS NULL THEN '—' ELSE printf('%.1f%%', {rnd('spoilage_prob * 100::DOUBLE', 1)}) END AS probability,
 CASE WHEN risk_level = 'CRITICAL' THEN 'Reroute dispatched' ELSE 'Alert sent' END AS action FROM """


@register("ru15_alert_display", _DISPLAY_SQL + "alert_rows")
def _(df: DataFrame) -> DataFrame:
    return alerts.alert_display(_alert_table(df))


@register(
    "en1_one_hot",
    "SELECT event_id, "
    + ", ".join(
        f"(CASE WHEN num % 101 <> 0 AND food_name = '{f}' THEN 1 ELSE 0 END)::INTEGER AS food_{f.lower()}"
        for f in FOOD_NAMES
    )
    + " FROM readings",
)
def _(df: DataFrame) -> DataFrame:
    return featurize.one_hot(fx.unknown_food(df).select("event_id", "food_name")).drop("food_name")


# --- joins and keyed tables -------------------------------------------------------------


@register(
    "jn1_new_only",
    "SELECT event_id, event_time, temperature FROM readings WHERE num % 3 <> 0",
)
def _(df: DataFrame) -> DataFrame:
    fresh = merge.new_only(fx.deliveries(df), fx.known(df))
    return fresh.select("event_id", "event_time", "temperature")


@register(
    "jn1_known_among",
    f"SELECT event_id FROM readings WHERE num % 3 = 0 AND event_time >= {SQL_NOW} - INTERVAL 20 HOURS",
)
def _(df: DataFrame) -> DataFrame:
    recent = cleaning.lookback(cleaning.with_partitions(df), NOW, 20)
    return merge.known_among(fx.known(df), recent)


@register(
    "snk11_duplicate_keys",
    "SELECT event_id, 2::BIGINT AS copies FROM readings WHERE num % 2 = 1",
)
def _(df: DataFrame) -> DataFrame:
    return duplicate_keys(fx.deliveries(df), "event_id")


@register(
    "jn2_lookup",
    "SELECT r.event_id, coalesce(f.safe, 6::DOUBLE) AS safe_max_c, coalesce(f.shelf, 168::DOUBLE) AS max_shelf_h"
    " FROM (SELECT event_id, CASE WHEN num % 101 = 0 THEN 'Durian' ELSE food_name END AS food_name FROM readings) r"
    " LEFT JOIN foods f ON r.food_name = f.food_name",
)
def _(df: DataFrame) -> DataFrame:
    dim = food_ref(df.sparkSession)
    rows = fx.unknown_food(df).select("event_id", "food_name")
    return enrich.lookup(rows, dim, "food_name", {"safe_max_c": 6.0, "max_shelf_h": 168.0}).drop(
        "food_name"
    )


_UPSERT_COLUMNS = "truck_id, food_name, event_time, temperature, storage_risk_score, risk_level"
_UPSERT_SQL = f"""SELECT coalesce(o.truck_id, n.truck_id) AS truck_id,
 {', '.join(f"CASE WHEN take THEN n.{c} ELSE o.{c} END AS {c}" for c in _UPSERT_COLUMNS.split(', ')[1:])},
 CASE WHEN take THEN {SQL_NOW} ELSE o.event_time END AS updated_at
FROM (SELECT o, n, n IS NOT NULL AND (o IS NULL OR o.event_time IS DISTINCT FROM n.event_time) AS take
      FROM (SELECT struct_pack({', '.join(f'{c} := {c}' for c in _UPSERT_COLUMNS.split(', '))}) AS o, truck_id FROM fleet_before) a
      FULL OUTER JOIN (SELECT struct_pack({', '.join(f'{c} := {c}' for c in _UPSERT_COLUMNS.split(', '))}) AS n, truck_id FROM fleet_updates) b
      ON a.truck_id = b.truck_id)"""


@register("snk9_jn3_upsert", _UPSERT_SQL)
def _(df: DataFrame) -> DataFrame:
    merged = merge.upsert(fx.fleet_before(df), fx.fleet_updates(df), "truck_id", "event_time", NOW)
    return merged.select(*_UPSERT_COLUMNS.split(", "), "updated_at")


@register(
    "snk10_prune",
    f"SELECT event_id, event_time FROM readings WHERE NOT (event_time < {SQL_NOW} - INTERVAL 18 HOURS)",
)
def _(df: DataFrame) -> DataFrame:
    return merge.prune(df, NOW, 18).select("event_id", "event_time")


@register("snk10_rows_on_disk", f"SELECT * FROM ({ORACLES['snk10_prune']})")
def _(df: DataFrame) -> DataFrame:
    """What is left of a history by day: whole days go, the day of the bound is rewritten."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "history")
    tables.append_rows(df.select("event_id", "event_time"), path, "event_time")
    tables.drop_expired_days(spark, path, NOW, 18)
    tables.drop_expired_rows(spark, path, NOW, 18)
    return file_sources.read_zone(spark, path).select("event_id", "event_time")


# --- roll-up and reports -------------------------------------------------------------------

_AVERAGES = ["temp_avg", "temp_std", "humidity_avg", "methane_avg", "co2_avg"]
_EXACT = [
    "year", "month", "day", "hour", "temp_max", "temp_min", "humidity_max", "methane_max",
    "co2_max", "storage_days", "readings_count", "breach_count", "last_lat", "last_lon", "spoiled",
]


@register(
    "ag1_ag2_hourly",
    f"SELECT {_HOUR_SQL}, {', '.join(_EXACT)}, {', '.join(f'{rnd(c, 6)} AS {c}' for c in _AVERAGES)} FROM hourly",
)
def _(df: DataFrame) -> DataFrame:
    hours = rollup.hourly(cleaning.with_partitions(reading_plan.cleaned(df, "batch")))
    return rounded(hours, *_AVERAGES).select(*HOUR, *_EXACT, *_AVERAGES)


@register(
    "ag3_label_distribution",
    "SELECT spoilage_label_name, count(*) AS row_count FROM features GROUP BY 1",
)
def _(df: DataFrame) -> DataFrame:
    return rollup.distribution(fx.features(df), "spoilage_label_name")


@register("ag4_risk_distribution", "SELECT risk_level, count(*) AS row_count FROM features GROUP BY 1")
def _(df: DataFrame) -> DataFrame:
    return rollup.distribution(fx.features(df), "risk_level")


_FOOD_RISK = (
    f"SELECT food_name, {rnd('avg(storage_risk_score)', 4)} AS avg_risk_score,"
    f" {rnd('avg(temp_deviation)', 2)} AS avg_temp_deviation, count(*) AS records FROM features GROUP BY food_name"
)


@register("ag5_food_risk", _FOOD_RISK)
def _(df: DataFrame) -> DataFrame:
    return rollup.food_risk(fx.features(df))


_LABEL_SUMMARY = (
    f"SELECT spoilage_label_name, count(*) AS row_count, {rnd('avg(storage_risk_score)', 4)} AS avg_risk,"
    f" {rnd('avg(temp_deviation)', 2)} AS avg_temp_dev FROM features GROUP BY spoilage_label_name"
)


@register("ag6_label_summary", _LABEL_SUMMARY)
def _(df: DataFrame) -> DataFrame:
    return rollup.label_summary(fx.features(df))


def _view(df: DataFrame) -> DataFrame:
    return serving.fleet_view(fx.fleet(df))


@register(
    "ag7_fleet_kpis",
    "SELECT count(*) AS total, "
    + ", ".join(
        f"count(*) FILTER (spoiled_class = {i}) AS n_{n}, {rnd(f'count(*) FILTER (spoiled_class = {i}) / count(*)::DOUBLE', 6)} AS share_{n}"
        for i, n in enumerate(("fresh", "at_risk", "spoiled"))
    )
    + f", {rnd('avg(risk_score)', 6)} AS avg_risk FROM fleet_view",
)
def _(df: DataFrame) -> DataFrame:
    return rounded(
        serving.fleet_kpis(_view(df)), "share_fresh", "share_at_risk", "share_spoiled", "avg_risk"
    )


@register("ag8_fleet_risk", "SELECT risk_label, count(*) AS row_count FROM fleet_view GROUP BY 1")
def _(df: DataFrame) -> DataFrame:
    return rollup.distribution(_view(df), "risk_label")


@register(
    "ag9_mean_risk_by_food",
    f"SELECT food_name, {rnd('avg(risk_score)', 6)} AS risk_score FROM fleet_view GROUP BY 1",
)
def _(df: DataFrame) -> DataFrame:
    return rounded(serving.mean_risk_by_food(_view(df)), "risk_score")


@register(
    "ag10_alerts_over_time",
    "SELECT time_bucket(INTERVAL '30 minutes', created_at) AS bucket, risk_level, count(*) AS alert_count"
    " FROM alert_rows GROUP BY 1, 2",
)
def _(df: DataFrame) -> DataFrame:
    table = fx.alert_zone(df).withColumnRenamed("event_time", "created_at")
    return ntz(serving.alerts_over_time(table), "bucket")


@register(
    "ag11_temperature_histogram",
    f"""SELECT bin::INTEGER AS bin, risk_level, count(*) AS row_count, {rnd('any_value(lo + bin * w)', 6)} AS bin_from,
 {rnd('any_value(lo + (bin + 1) * w)', 6)} AS bin_to
FROM (SELECT risk_level, lo, w, least(19, floor((temperature - lo) / w)) AS bin
 FROM (SELECT risk_level, temperature, min(temperature) OVER () AS lo,
  (max(temperature) OVER () - min(temperature) OVER ()) / 20::DOUBLE AS w FROM processed)) GROUP BY 1, 2""",
)
def _(df: DataFrame) -> DataFrame:
    bins = serving.histogram(fx.processed(df), "temperature", 20, "risk_level")
    return rounded(bins, "bin_from", "bin_to")


@register(
    "ag12_alert_counts",
    "SELECT count(*) AS total, count(*) FILTER (risk_level = 'CRITICAL') AS critical,"
    " count(*) FILTER (risk_level <> 'CRITICAL') AS warning FROM alert_rows",
)
def _(df: DataFrame) -> DataFrame:
    return serving.alert_counts(fx.alert_zone(df))


@register(
    "ag13_freshness",
    f"SELECT *, minutes_behind <= 20 AS is_fresh FROM (SELECT max(event_time) AS last_update, count(*) AS row_count,"
    f" (epoch_us({SQL_NOW}) - epoch_us(max(event_time))) / 60000000::DOUBLE AS minutes_behind FROM readings)",
)
def _(df: DataFrame) -> DataFrame:
    return serving.freshness(df, "event_time", NOW)


@register("ag14_known_ids", "SELECT DISTINCT event_id FROM readings")
def _(df: DataFrame) -> DataFrame:
    return merge.known_ids(fx.deliveries(df))


@register(
    "ag15_dataset_shape",
    "SELECT count(*) AS row_count, count(DISTINCT truck_id) AS key_count FROM readings",
)
def _(df: DataFrame) -> DataFrame:
    return metrics.dataset_shape(df)


# --- model metrics ------------------------------------------------------------------------------


@register(
    "ag16_confusion",
    "SELECT y AS label, "
    + ", ".join(f"count(*) FILTER (p = {c}) AS pred_{c}" for c in range(3))
    + " FROM predictions GROUP BY y",
)
def _(df: DataFrame) -> DataFrame:
    return metrics.confusion(fx.predictions(df), "y", "p")


_MACRO = ["accuracy", "f1_macro", "precision_macro", "recall_macro"]


@register(
    "ag17_macro_metrics",
    f"SELECT {rnd('sum(tp) / sum(support)::DOUBLE', 9)} AS accuracy, {rnd('avg(f1)', 9)} AS f1_macro,"
    f" {rnd('avg(precision)', 9)} AS precision_macro, {rnd('avg(recall)', 9)} AS recall_macro FROM class_scores",
)
def _(df: DataFrame) -> DataFrame:
    return rounded(metrics.macro_metrics(fx.predictions(df), "y", "p"), *_MACRO, digits=9)


_PRF = ["precision", "recall", "f1"]


@register(
    "ag18_class_report",
    f"SELECT class::VARCHAR AS class, {', '.join(f'{rnd(c, 9)} AS {c}' for c in _PRF)}, support FROM class_scores"
    f" UNION ALL SELECT 'accuracy', a, a, a, s FROM (SELECT {rnd('sum(tp) / sum(support)::DOUBLE', 9)} AS a,"
    " sum(support)::BIGINT AS s FROM class_scores)"
    f" UNION ALL SELECT 'macro avg', {', '.join(rnd(f'avg({c})', 9) for c in _PRF)}, sum(support)::BIGINT FROM class_scores"
    f" UNION ALL SELECT 'weighted avg', {', '.join(rnd(f'sum({c} * support) / sum(support)::DOUBLE', 9) for c in _PRF)},"
    " sum(support)::BIGINT FROM class_scores",
)
def _(df: DataFrame) -> DataFrame:
    return rounded(metrics.class_report(fx.predictions(df), "y", "p"), *_PRF, digits=9)


@register(
    "ag19_regression_metrics",
    f"SELECT {rnd('avg(abs(temp_deviation - storage_days))', 6)} AS mae,"
    f" {rnd('sqrt(avg((temp_deviation - storage_days) * (temp_deviation - storage_days)))', 6)} AS rmse FROM processed",
)
def _(df: DataFrame) -> DataFrame:
    out = metrics.regression_metrics(fx.processed(df), "storage_days", "temp_deviation")
    return rounded(out, "mae", "rmse")


@register(
    "ag20_fit_scaler",
    "SELECT "
    + ", ".join(
        f"{rnd(f'avg({c})', 6)} AS {c}_mean, {rnd(f'stddev_pop({c})', 6)} AS {c}_std"
        for c in shelf_life.STEP_INPUTS
    )
    + " FROM rated_batch",
)
def _(df: DataFrame) -> DataFrame:
    stats = metrics.fit_scaler(fx.rated(df), shelf_life.STEP_INPUTS)
    return rounded(stats, *stats.columns)


@register(
    "ag20_apply_scaler",
    "SELECT event_id, "
    + ", ".join(
        f"{rnd(f'({c} - (SELECT avg({c}) FROM rated_batch)) / (SELECT stddev_pop({c}) FROM rated_batch)', 6)} AS {c}"
        for c in ("temperature", "methane", "storage_risk_score")
    )
    + " FROM rated_batch",
)
def _(df: DataFrame) -> DataFrame:
    rows, columns = fx.rated(df), ["temperature", "methane", "storage_risk_score"]
    out = metrics.apply_scaler(rows, metrics.fit_scaler(rows, columns), columns)
    return rounded(out.select("event_id", *columns), *columns)


@register(
    "ag21_row_counts",
    "SELECT 'readings' AS name, count(*) AS row_count FROM readings UNION ALL SELECT 'alerts', count(*) FROM alerts"
    " UNION ALL SELECT 'features', count(*) FROM features",
)
def _(df: DataFrame) -> DataFrame:
    return metrics.row_counts(
        {"readings": df, "alerts": fx.alert_zone(df), "features": fx.features(df)}
    )


# --- windows ----------------------------------------------------------------------------------------


@register(
    "wn1_latest_per_truck",
    "SELECT truck_id, food_name, event_time, temperature, storage_risk_score, risk_level FROM fleet",
)
def _(df: DataFrame) -> DataFrame:
    return sync.fleet_snapshot(fx.processed(df)).select(
        "truck_id", "food_name", "event_time", "temperature", "storage_risk_score", "risk_level"
    )


@register(
    "wn2_latest_metrics",
    "SELECT 'model-' || truck_id AS model_name, 'run-' || event_id AS run_id, gps_lat AS f1_score, event_time AS trained_at"
    " FROM (SELECT *, row_number() OVER (PARTITION BY truck_id ORDER BY event_time DESC, event_id DESC) AS rn FROM readings)"
    " WHERE rn = 1",
)
def _(df: DataFrame) -> DataFrame:
    latest = windows.latest_by(fx.model_metrics(df), "model_name", ["trained_at", "run_id"])
    return latest.select("model_name", "run_id", "f1_score", "trained_at")


def _digits(column: str, field: str, scale: int) -> Column:
    """One field of the steps as integers, joined to text."""
    steps = F.transform(
        column, lambda s: F.round(s[field] * scale).cast("long").cast("string")
    )
    return F.array_join(steps, ",")


def _digits_sql(field: str, scale: int, over: str) -> str:
    return f"array_to_string(list(round({field} * {scale})::BIGINT) OVER ({over}), ',')"


_STEPS = {"temperature": 100, "humidity": 100, "temp_deviation": 100, "storage_risk_score": 10_000}
_FRAME = "PARTITION BY truck_id ORDER BY event_time, event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW"


@register(
    "wn3_sequences",
    f"SELECT truck_id, event_id, event_time, {', '.join(f'{c}_steps' for c in _STEPS)}, remaining_hours FROM (SELECT *,"
    f" {', '.join(f'{_digits_sql(c, s, _FRAME)} AS {c}_steps' for c, s in _STEPS.items())},"
    f" {rnd(_LEFT_SQL, 6)} AS remaining_hours, row_number() OVER (PARTITION BY truck_id ORDER BY event_time, event_id) AS rn,"
    " count(*) OVER (PARTITION BY truck_id) AS n FROM rated_batch) WHERE rn >= 10 AND rn < n",
)
def _(df: DataFrame) -> DataFrame:
    rows = shelf_life.training_sequences(fx.rated(df))
    texts = [_digits("sequence", c, s).alias(f"{c}_steps") for c, s in _STEPS.items()]
    return rounded(
        rows.select("truck_id", "event_id", "event_time", *texts, "remaining_hours"),
        "remaining_hours",
    )


@register(
    "wn4_last_ten",
    "SELECT truck_id, string_agg(event_id, ',' ORDER BY event_time, event_id) AS ids FROM (SELECT *, row_number() OVER"
    " (PARTITION BY truck_id ORDER BY event_time DESC, event_id DESC) AS rn FROM readings) WHERE rn <= 10 GROUP BY truck_id"
    " HAVING count(*) = 10",
)
def _(df: DataFrame) -> DataFrame:
    last = windows.last_n(df, "truck_id", ["event_time", "event_id"], 10, ["event_id"])
    return last.select("truck_id", F.array_join("readings.event_id", ",").alias("ids"))


_HEADS_SQL = """SELECT model, max(version) AS latest_version, arg_max_null(metric, version) AS latest_metric,
 max(version) FILTER (stage = 'Production') AS production_version,
 arg_max_null(metric, version) FILTER (stage = 'Production') AS production_metric, bool_or(higher) AS higher_is_better
FROM registry GROUP BY model"""


@register_raw("wn5_registry_heads", _HEADS_SQL)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.registry_heads(fx.registry(spark, sf_dir))


# --- sort, limit, split -------------------------------------------------------------------------------


@register("sl1_riskiest_foods", _FOOD_RISK + " ORDER BY avg_risk_score DESC, food_name LIMIT 5")
def _(df: DataFrame) -> DataFrame:
    order = [F.desc("avg_risk_score"), "food_name"]
    return sampling.top_n(rollup.food_risk(fx.features(df)), order, 5)


@register(
    "sl2_latest_alerts",
    "SELECT event_id, truck_id, risk_level, spoilage_prob, created_at FROM alert_rows WHERE truck_id <> 'TRK-000'"
    " ORDER BY created_at DESC, event_id DESC LIMIT 40",
)
def _(df: DataFrame) -> DataFrame:
    return latest_alerts(_alert_table(df)).select(
        "event_id", "truck_id", "risk_level", "spoilage_prob", "created_at"
    )


@register("sl3_fleet_table", f"SELECT {_VIEW} FROM fleet_view ORDER BY spoiled_class DESC, truck_id")
def _(df: DataFrame) -> DataFrame:
    ordered = _view(df).orderBy(F.desc("spoiled_class"), "truck_id")
    return ordered.select(*_VIEW.split(", "))


@register(
    "sl4_holdout_trucks",
    "SELECT event_id, CASE WHEN truck_id IN (SELECT DISTINCT truck_id FROM readings ORDER BY truck_id DESC LIMIT 5)"
    " THEN 'test' ELSE 'train' END AS part FROM readings",
)
def _(df: DataFrame) -> DataFrame:
    train, test = sampling.holdout_keys(df, "truck_id", 5)
    parts = [p.select("event_id", F.lit(n).alias("part")) for n, p in (("train", train), ("test", test))]
    return parts[0].unionAll(parts[1])


@register(
    "sl5_stratified_split",
    """SELECT l.event_id, l.spoiled, CASE WHEN l.rn <= q.quota THEN 'test' ELSE 'train' END AS split
FROM (SELECT event_id, spoiled, row_number() OVER (PARTITION BY spoiled ORDER BY md5(event_id || ':42'), event_id) AS rn
      FROM readings WHERE spoiled IS NOT NULL) l
JOIN (SELECT spoiled, base + CASE WHEN row_number() OVER (ORDER BY ideal - base DESC, spoiled) <= w - sum(base) OVER () THEN 1 ELSE 0 END AS quota
      FROM (SELECT spoiled, w, w * n / t AS ideal, floor(w * n / t) AS base
            FROM (SELECT spoiled, count(*) AS n, sum(count(*)) OVER () AS t, ceil(sum(count(*)) OVER () * 0.2::DOUBLE) AS w
                  FROM readings WHERE spoiled IS NOT NULL GROUP BY spoiled))) q ON l.spoiled = q.spoiled""",
)
def _(df: DataFrame) -> DataFrame:
    return sampling.stratified_split(df.select("event_id", "spoiled"), "spoiled", "event_id")


@register(
    "sl6_seeded_sample",
    "SELECT event_id, temperature FROM readings ORDER BY md5(event_id || ':42'), event_id LIMIT 500",
)
def _(df: DataFrame) -> DataFrame:
    return sampling.seeded_sample(df, 500).select("event_id", "temperature")


# --- models -----------------------------------------------------------------------------------------------


@register(
    "ud3_model_inputs",
    f"SELECT event_id, {', '.join(f'CASE WHEN {c} IS NULL OR {c} = 0 THEN {d}::DOUBLE ELSE {c} END AS {c}' for c, d in (('temperature', 0), ('humidity', 63), ('methane', 0), ('co2', 400), ('storage_days', 0)))},"
    " lower(coalesce(food_name, 'chicken')) AS food_key FROM dirty",
)
def _(df: DataFrame) -> DataFrame:
    blank = {c: F.lit(None).cast("double") for c in CORE_FEATURES}
    out = featurize.fill_model_inputs(fx.dirty(df).withColumns(blank))
    return out.select("event_id", *SENSORS, "food_key")


@register("ud1_ud2_rule_fallback", "SELECT event_id, ml_predicted_class, prob_spoiled FROM processed")
def _(df: DataFrame) -> DataFrame:
    return featurize.scored(_rated(df)).select("event_id", "ml_predicted_class", "prob_spoiled")


def _food_label() -> Column:
    turn = F.array_position(F.array(*[F.lit(name.lower()) for name in FOOD_NAMES]), F.lower("food_name"))
    return (F.coalesce(turn, F.lit(0)) % 3).cast("int")


def _by_food(df: DataFrame) -> DataFrame:
    """Readings whose label is a function of the food alone, so that SQL knows each class."""
    return fx.rated(df).withColumn("spoiled", _food_label())


_BY_FOOD_SQL = (
    f"(coalesce(list_position([{', '.join(repr(name.lower()) for name in FOOD_NAMES)}], lower(food_name)), 0) % 3)::INTEGER"
)


@register(
    "ml1_ml2_classifier_scores",
    f"SELECT event_id, {_BY_FOOD_SQL} AS predicted_class,"
    f" ['Fresh', 'At Risk', 'Spoiled'][{_BY_FOOD_SQL} + 1] AS predicted_label, true AS sums_to_one FROM rated_batch",
)
def _(df: DataFrame) -> DataFrame:
    rows = _by_food(df)
    scored = classifier.score(rows, classifier.train_classifier(rows))
    total = F.col("p_fresh") + F.col("p_at_risk") + F.col("p_spoiled")
    return scored.select(
        "event_id", "predicted_class", "predicted_label", (F.abs(total - 1) < 0.001).alias("sums_to_one")
    )


_SCORES = ["event_id", "predicted_class", "predicted_label", "p_fresh", "p_at_risk", "p_spoiled"]


@register("ml1_ml2_probabilities")
def _(df: DataFrame) -> DataFrame:
    """The scores themselves, which SQL cannot give: classes with their probabilities."""
    rows = _by_food(df)
    return classifier.score(rows, classifier.train_classifier(rows)).select(*_SCORES)


@register("ml2_production_scores")
def _(df: DataFrame) -> DataFrame:
    """Scores by the version that is in production, read back from the registry's folder."""
    spark, root = df.sparkSession, scratch_path(df.sparkSession, "production")
    train_and_gate(spark, df.withColumn("spoiled", _food_label()), root, NOW)
    return classifier.score(fx.rated(df), production_classifier(spark, root)).select(*_SCORES)


def _shelf_life_fit(rows: DataFrame) -> tuple:
    stats = enrich.settled(metrics.fit_scaler(rows, shelf_life.STEP_INPUTS))
    return shelf_life.train_shelf_life(metrics.apply_scaler(rows, stats, shelf_life.STEP_INPUTS)), stats


@register("ml3_shelf_life_hours")
def _(df: DataFrame) -> DataFrame:
    """Hours by the model for each truck; beside them its error on trucks that it was not
    fitted on, and that of the mean of the others."""
    rows = fx.rated(df)
    train, test = sampling.holdout_keys(rows, "truck_id", HOLDOUT_TRUCKS)
    model, stats = _shelf_life_fit(train)
    scaled = metrics.apply_scaler(rows, stats, shelf_life.STEP_INPUTS)
    guesses = shelf_life.predict_sequences(
        shelf_life.training_sequences(metrics.apply_scaler(test, stats, shelf_life.STEP_INPUTS)), model
    )
    mean = shelf_life.training_sequences(train).agg(F.avg(shelf_life.TARGET)).first()[0]
    tested = enrich.settled(
        guesses.select(shelf_life.TARGET, "predicted_hours", F.lit(mean).alias("mean_hours"))
    )
    errors = metrics.regression_metrics(tested, shelf_life.TARGET, "predicted_hours").first()
    naive = metrics.regression_metrics(tested, shelf_life.TARGET, "mean_hours").first()
    return shelf_life.predict_latest(scaled, model).select(
        "truck_id",
        "predicted_hours",
        F.lit(errors["mae"]).alias("model_mae"),
        F.lit(naive["mae"]).alias("mean_mae"),
    )


@register("ml3_latest_model_or_rule")
def _(df: DataFrame) -> DataFrame:
    """Hours by the model, and by the formula for every seventh truck, which has nine readings."""
    rows = fx.rated(df)
    order = Window.partitionBy("truck_id").orderBy(F.desc("event_time"), F.desc("event_id"))
    few = rows.filter(fx.truck_number() % 7 == 0).withColumn("_rn", F.row_number().over(order))
    some = rows.filter(fx.truck_number() % 7 != 0).unionByName(few.filter("_rn <= 9").drop("_rn"))
    return shelf_life.latest_or_rule(some, _shelf_life_fit(some))


@register(
    "ml3_shelf_life_latest",
    "SELECT truck_id, true AS not_negative, true AS in_tenths FROM rated_batch GROUP BY truck_id HAVING count(*) >= 10",
)
def _(df: DataFrame) -> DataFrame:
    rows = fx.rated(df)
    stats = metrics.fit_scaler(rows, shelf_life.STEP_INPUTS)
    scaled = metrics.apply_scaler(rows, stats, shelf_life.STEP_INPUTS)
    model = shelf_life.train_shelf_life(scaled)
    latest = shelf_life.predict_latest(scaled, model)
    hours = F.col("predicted_hours")
    tenths = F.abs(hours * 10 - F.round(hours * 10)) < 1e-6
    return latest.select("truck_id", (hours >= 0).alias("not_negative"), tenths.alias("in_tenths"))


@register(
    "ml3_latest_or_rule",
    f"SELECT truck_id, round(greatest({_LEFT_SQL}, 0), 1) AS hours, 'rule' AS source FROM rated_batch"
    " QUALIFY row_number() OVER (PARTITION BY truck_id ORDER BY event_time DESC, event_id DESC) = 1",
)
def _(df: DataFrame) -> DataFrame:
    return shelf_life.latest_or_rule(fx.rated(df), None)


@register(
    "ml4_importance",
    "SELECT feature, feature LIKE 'food_%' AS carries_label FROM (VALUES "
    + ", ".join(f"('{name}')" for name in classifier.INPUTS)
    + ") t(feature)",
)
def _(df: DataFrame) -> DataFrame:
    """The inputs that the label is made of are those that rank first in the splits."""
    rows = _by_food(df)
    both = classifier.importance(classifier.train_classifier(rows), rows)
    place = F.row_number().over(Window.orderBy(F.desc("importance"), "feature"))  # a row per input
    return both.select("feature", (place <= len(FOOD_NAMES)).alias("carries_label"))


@register(
    "ml4_row_explanations",
    f"SELECT event_id, {_BY_FOOD_SQL} AS explained_class, ['p_fresh', 'p_at_risk', 'p_spoiled'][{_BY_FOOD_SQL} + 1] AS explained_by,"
    f" 0.0::DOUBLE AS gap, {len(classifier.INPUTS)}::BIGINT AS inputs FROM rated_batch",
)
def _(df: DataFrame) -> DataFrame:
    """The class that the parts of all inputs add up to, and how far their sum is from the score."""
    rows = _by_food(df)
    model = classifier.train_classifier(rows, numTrees=60)
    spread = rows.repartition(df.sparkSession.sparkContext.defaultParallelism)  # a row takes milliseconds
    sums = explain.explain(spread, model).groupBy("event_id").agg(
        *[F.sum(name).alias(f"sum_{name}") for name in explain.CLASSES],
        F.count(F.when(F.col("feature") != explain.BASE, 1)).alias("inputs"),
    )
    added = [F.col(f"sum_{name}") for name in explain.CLASSES]
    place = F.array_position(F.array(*added), F.greatest(*added)).cast("int")
    off = F.greatest(*[F.abs(a - F.col(name)) for a, name in zip(added, explain.CLASSES)])
    return classifier.score(rows, model).join(sums, "event_id").select(
        "event_id",
        (place - 1).alias("explained_class"),
        F.get(F.array(*[F.lit(name) for name in explain.CLASSES]), place - 1).alias("explained_by"),
        F.round(off, 3).alias("gap"),
        "inputs",
    )


@register_raw(
    "ml5_promotion_gate",
    f"""SELECT r.model, r.version, r.stage, decision,
 CASE WHEN decision = 'promote' AND r.version = latest_version THEN 'Production'
      WHEN decision = 'promote' AND r.stage = 'Production' THEN 'Archived' ELSE r.stage END AS new_stage
FROM registry r JOIN (SELECT *, CASE WHEN latest_metric IS NULL THEN 'skip' WHEN production_version IS NULL OR production_metric IS NULL THEN 'promote'
  WHEN latest_version = production_version THEN 'none'
  WHEN CASE WHEN higher_is_better THEN latest_metric >= production_metric ELSE latest_metric <= production_metric END THEN 'promote'
  ELSE 'keep' END AS decision FROM ({_HEADS_SQL})) g ON r.model = g.model""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.promote(fx.registry(spark, sf_dir)).select(
        "model", "version", "stage", "decision", "new_stage"
    )


@register(
    "ml6_class_weights",
    f"SELECT spoiled, count(*) AS n, {rnd('sum(count(*)) OVER () / (count(*) OVER () * count(*))::DOUBLE', 9)} AS class_weight"
    " FROM readings WHERE spoiled IS NOT NULL GROUP BY spoiled",
)
def _(df: DataFrame) -> DataFrame:
    weights = metrics.class_weights(df.filter(F.col("spoiled").isNotNull()), "spoiled")
    return rounded(weights, "class_weight", digits=9)


# --- composite jobs ---------------------------------------------------------------------------------------------

_ZONE = [
    c for c in PROCESSED.fieldNames() if c not in ("ingested_at", "kafka_partition", "kafka_offset")
]
_ZONE_SQL = f"SELECT {', '.join(_ZONE)} FROM zone"


@register("jb1_reading_logic", _ZONE_SQL)
def _(df: DataFrame) -> DataFrame:
    messages = fx.envelopes(fx.deliveries(fx.dirty(df)))
    return ntz(reading_plan.process_messages(messages), "event_time").select(*_ZONE)


@register("jb1_reprocess_raw", _ZONE_SQL)
def _(df: DataFrame) -> DataFrame:
    raw = kafka.raw_rows(fx.envelopes(fx.deliveries(fx.dirty(df))))
    return ntz(reading_plan.reprocess(raw), "event_time").select(*_ZONE)


def _stream_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream of messages, with duplicates, gaps and junk."""
    table = fx.events(spark, sf_dir)
    stream = (
        spark.readStream.schema(table.schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf_dir)
    )
    rows = spark.sql(fx.READINGS, events=stream)
    return fx.envelopes(fx.deliveries(fx.dirty(rows)))


def _run_streams(spark: SparkSession, sf_dir: str, chain_alerts: bool) -> dict[str, str]:
    root = scratch_path(spark, "stream")
    paths = {name: f"{root}/{name}" for name in ("raw", "processed", "alerts", "checkpoints")}
    started = streams.stream_pipeline(
        _stream_of(spark, sf_dir),
        paths,
        watermark="3 days",  # wider than the data, so that no row is late
        trigger={"availableNow": True},
        chain_alerts=chain_alerts,
    )
    for running in started.values():
        running.awaitTermination()
    return paths


@register_raw("jb1_stream_processed_zone", _ZONE_SQL)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = _run_streams(spark, sf_dir, chain_alerts=False)
    zone = file_sources.read_zone(spark, paths["processed"], PROCESSED)
    return ntz(zone, "event_time").select(*_ZONE)


@register_raw(
    "jb1_stream_alert_zone",
    "SELECT event_id, event_time, risk_level, CASE WHEN ml_predicted_class = 2 THEN 'ML_SPOILED' WHEN prob_spoiled >= 0.70"
    " THEN 'ML_HIGH_RISK' ELSE 'TEMP_BREACH' END AS alert_type FROM zone WHERE prob_spoiled >= 0.70 OR ml_predicted_class = 2"
    " OR temp_breach_flag = 1",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = _run_streams(spark, sf_dir, chain_alerts=True)
    zone = file_sources.read_zone(spark, paths["alerts"])
    return ntz(zone, "event_time").select("event_id", "event_time", "risk_level", "alert_type")


@register_raw(
    "snk1_raw_zone",
    "SELECT num AS offset, (num % 8)::INTEGER AS partition FROM readings UNION ALL SELECT num, (num % 8)::INTEGER"
    " FROM readings WHERE num % 2 = 1",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "raw")
    running = streams.start_raw(
        _stream_of(spark, sf_dir), f"{root}/zone", f"{root}/ckpt", {"availableNow": True}
    )
    running.awaitTermination()
    return spark.read.parquet(f"{root}/zone").select("offset", "partition")


_FEATURE_SQL = (
    f"SELECT {_HOUR_SQL}, {CORE_SQL}, breach_count, readings_count, breach_rate, temp_volatility, heat_gas_stress,"
    " cumulative_breach_hours, spoilage_label, spoilage_label_name, risk_level, year, month, day, hour FROM features"
)
_FEATURE_OUT = [
    *HOUR, *CORE_FEATURES, "breach_count", "readings_count", "breach_rate", "temp_volatility",
    "heat_gas_stress", "cumulative_breach_hours", "spoilage_label", "spoilage_label_name",
    "risk_level", "year", "month", "day", "hour",
]


@register("jb2_hourly_features", _FEATURE_SQL)
def _(df: DataFrame) -> DataFrame:
    return fx.features(df).select(*_FEATURE_OUT)


@register("jb2_feature_build_job", _FEATURE_SQL)
def _(df: DataFrame) -> DataFrame:
    spark, root = df.sparkSession, scratch_path(df.sparkSession, "build")
    cleaning.with_partitions(df).write.partitionBy("year", "month", "day").parquet(f"{root}/zone")
    feature_plan.feature_build(
        spark, f"{root}/zone", f"{root}/features", f"{root}/reports", NOW, hours=36
    )
    return file_sources.read_zone(spark, f"{root}/features").select(*_FEATURE_OUT)


@register("pf7_ingest_time", "SELECT event_id, true AS stamped FROM readings")
def _(df: DataFrame) -> DataFrame:
    stamped = F.col("ingested_at").isNotNull() & (F.col("ingested_at") <= F.current_timestamp())
    return cleaning.with_ingest_time(df).select("event_id", stamped.alias("stamped"))


@register(
    "src4_read_zone",
    f"SELECT event_id, event_time, year, month, day, hour FROM processed WHERE event_time >= {SQL_NOW} - INTERVAL 15 HOURS",
)
def _(df: DataFrame) -> DataFrame:
    zone = file_sources.read_zone(df.sparkSession, _zone(df, scratch_path(df.sparkSession, "zone")))
    recent = cleaning.lookback(zone, NOW, 15)
    return ntz(recent, "event_time").select("event_id", "event_time", *PARTITIONS)


@register(
    "jb5_daily_report",
    "SELECT 'label' AS kind, spoilage_label_name AS name, count(*) AS row_count FROM features GROUP BY 2"
    " UNION ALL SELECT 'risk', risk_level, count(*) FROM features GROUP BY 2",
)
def _(df: DataFrame) -> DataFrame:
    spark, root = df.sparkSession, scratch_path(df.sparkSession, "daily")
    file_sinks.write_features(fx.features(df), f"{root}/features")
    out = report.daily_report(spark, f"{root}/features", f"{root}/runs", NOW)
    rows = [("label", k, n) for k, n in out["labels"].items()]
    rows += [("risk", k, n) for k, n in out["risks"].items()]
    return spark.createDataFrame(rows, "kind string, name string, row_count bigint")


@register(
    "jb6_train_and_gate",
    "SELECT model, 1 AS version, 'Production' AS stage, true AS measured, true AS complete"
    " FROM (VALUES ('spoilage-classifier'), ('shelf-life-regressor')) t(model)",
)
def _(df: DataFrame) -> DataFrame:
    spark, root = df.sparkSession, scratch_path(df.sparkSession, "training")
    train_and_gate(spark, df, root, NOW)
    complete = {
        CLASSIFIER: production_classifier(spark, root) is not None,
        REGRESSOR: production_shelf_life(spark, root) is not None,
    }
    return tables.read_snapshot(spark, f"{root}/registry", "registry").select(
        "model",
        "version",
        "stage",
        F.col("metric").isNotNull().alias("measured"),
        F.when(F.col("model") == CLASSIFIER, complete[CLASSIFIER]).otherwise(complete[REGRESSOR]).alias("complete"),
    )


@register("jb6_two_runs")
def _(df: DataFrame) -> DataFrame:
    """The registry after two runs, with the metric, decision and split sizes of each version."""
    spark, root = df.sparkSession, scratch_path(df.sparkSession, "runs")
    rows = []
    for day in range(2):
        result = train_and_gate(spark, df, root, NOW + timedelta(days=day))
        for model in (CLASSIFIER, REGRESSOR):
            sizes = result["split"][model]
            rows.append((model, result[model]["version"], result[model]["decision"], sizes["train"], sizes["test"]))
    runs = spark.createDataFrame(
        rows, "model string, version int, decision string, train_rows bigint, test_rows bigint"
    )
    registry = tables.read_snapshot(spark, f"{root}/registry", "registry")
    return registry.join(runs, ["model", "version"], "left").select(
        "model", "version", "stage", "metric", "decision", "train_rows", "test_rows"
    )


@register("snk5_snk15_verify_features", _LABEL_SUMMARY)
def _(df: DataFrame) -> DataFrame:
    path = scratch_path(df.sparkSession, "features")
    file_sinks.write_features(fx.features(df), path)
    return file_sinks.verify_features(df.sparkSession, path)


@register("snk6_csv_report", _FOOD_RISK)
def _(df: DataFrame) -> DataFrame:
    path = scratch_path(df.sparkSession, "report")
    file_sinks.write_report(rollup.food_risk(fx.features(df)), path)
    schema = "food_name string, avg_risk_score double, avg_temp_deviation double, records bigint"
    return df.sparkSession.read.schema(schema).option("header", "true").csv(path)


def _zone(df: DataFrame, root: str) -> str:
    """The scored readings as a processed zone on disk."""
    ntz_free = fx.processed(df).withColumn("event_time", F.col("event_time").cast("timestamp"))
    ntz_free.write.partitionBy("year", "month", "day").parquet(f"{root}/zone")
    return f"{root}/zone"


@register(
    "jb3_sync_alerts",
    "SELECT event_id, truck_id, risk_level, storage_risk_score AS spoilage_prob FROM alerts"
    f" WHERE event_time >= {SQL_NOW} - INTERVAL 20 HOURS",
)
def _(df: DataFrame) -> DataFrame:
    spark, root = df.sparkSession, scratch_path(df.sparkSession, "alerts")
    zone = alerts.alerts(fx.processed(df))
    zone.withColumn("event_time", F.col("event_time").cast("timestamp")).write.partitionBy(
        "year", "month", "day"
    ).parquet(f"{root}/zone")
    for hours in (10, 20):  # the second run must add only what the first did not see
        sync.sync_alerts(spark, f"{root}/zone", f"{root}/table", NOW, hours)
    stored = tables.read_log(spark, f"{root}/table", "alerts")
    return stored.select("event_id", "truck_id", "risk_level", "spoilage_prob")


@register(
    "jb4_sync_fleet_history",
    f"SELECT event_id, truck_id, event_time, temperature FROM processed WHERE event_time >= {SQL_NOW} - INTERVAL 20 HOURS",
)
def _(df: DataFrame) -> DataFrame:
    spark, root = df.sparkSession, scratch_path(df.sparkSession, "fleet")
    zone = _zone(df, root)
    for hours in (10, 20):
        sync.sync_fleet(spark, zone, f"{root}/fleet", f"{root}/history", NOW, hours)
    stored = tables.read_history(spark, f"{root}/history", NOW, 48)
    return ntz(stored, "event_time").select("event_id", "truck_id", "event_time", "temperature")


@register(
    "jb4_sync_fleet_status",
    f"SELECT truck_id, food_name, event_time, risk_level, {SQL_NOW} AS updated_at FROM fleet",
)
def _(df: DataFrame) -> DataFrame:
    spark, root = df.sparkSession, scratch_path(df.sparkSession, "fleet")
    zone, later = _zone(df, root), NOW + timedelta(minutes=15)
    for moment in (NOW, later):  # unchanged rows must keep their first stamp
        sync.sync_fleet(spark, zone, f"{root}/fleet", f"{root}/history", moment, 37)
    stored = tables.read_snapshot(spark, f"{root}/fleet", "fleet_status")
    return ntz(stored, "event_time", "updated_at").select(
        "truck_id", "food_name", "event_time", "risk_level", "updated_at"
    )


@register("jb7_alert_view", _DISPLAY_SQL + "(SELECT * FROM alert_rows WHERE truck_id <> 'TRK-000' ORDER BY created_at DESC, event_id DESC LIMIT 40)")
def _(df: DataFrame) -> DataFrame:
    return alerts.alert_display(latest_alerts(_alert_table(df)))


_LAST_TEN_SQL = """SELECT truck_id, string_agg(event_id, ',' ORDER BY event_time, event_id) AS ids, sum(storage_risk_score) AS risk
FROM (SELECT *, row_number() OVER (PARTITION BY truck_id ORDER BY event_time DESC, event_id DESC) AS rn FROM {source})
WHERE rn <= 10 GROUP BY truck_id HAVING count(*) = 10"""


def _ten(df: DataFrame) -> DataFrame:
    risk = F.aggregate("readings.storage_risk_score", F.lit(0.0), lambda a, b: a + b)
    out = recent.full_rings(df).select(
        "truck_id", F.array_join("readings.event_id", ",").alias("ids"), risk.alias("risk")
    )
    return rounded(out, "risk")


@register_raw(
    "jb7_recent_stream",
    f"SELECT truck_id, ids, {rnd('risk', 6)} AS risk FROM ({_LAST_TEN_SQL.format(source='zone')})",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table that the stream keeps of each truck's last readings."""
    root = scratch_path(spark, "recent")
    rows = reading_plan.process_messages(_stream_of(spark, sf_dir), watermark="3 days")
    running = streams.start_recent(rows, f"{root}/table", f"{root}/ckpt", {"availableNow": True})
    running.awaitTermination()
    return _ten(tables.read_snapshot(spark, f"{root}/table", "recent_readings"))


def _recent(df: DataFrame) -> DataFrame:
    """The same table from two halves of the processed readings, the second overlapping the first."""
    rows = fx.processed(df)
    noon = moment(NOW - timedelta(hours=24), rows.schema["event_time"].dataType)
    early = recent.recent_readings(rows.filter(F.col("event_time") < noon))
    late = rows.filter(F.col("event_time") >= noon - F.expr("INTERVAL 1 HOUR"))
    return enrich.settled(recent.merge_recent(early, late))


@register(
    "jb7_last_ten",
    f"SELECT truck_id, ids, {rnd('risk', 6)} AS risk FROM ({_LAST_TEN_SQL.format(source='processed')})",
)
def _(df: DataFrame) -> DataFrame:
    return _ten(truck_views(_recent(df))["last_ten"])


_HOURS_SQL = f"SELECT truck_id, {rnd(_LEFT_SQL, 1)} AS hours FROM fleet"


@register(
    "jb7_shelf_life",
    f"SELECT truck_id, hours, 'rule' AS source, {rnd('hours / 24::DOUBLE', 6)} AS days_left, CASE WHEN hours < 12 THEN 'critical'"
    f" WHEN hours < 48 THEN 'low' ELSE 'ok' END AS urgency FROM ({_HOURS_SQL})",
)
def _(df: DataFrame) -> DataFrame:
    return rounded(truck_views(_recent(df))["shelf_life"], "days_left")


@register(
    "jb7_what_if",
    "SELECT truck_id, what_if_class, p_fresh, p_at_risk, p_spoiled FROM (SELECT event_id, truck_id FROM fleet) t"
    f" JOIN ({ORACLES['ru10_what_if']}) w USING (event_id)",
)
def _(df: DataFrame) -> DataFrame:
    view = truck_views(_recent(df))["what_if"]
    return view.select("truck_id", "what_if_class", "p_fresh", "p_at_risk", "p_spoiled")


@register(
    "jb7_contributions",
    "SELECT truck_id, factor, contribution, is_largest FROM (SELECT event_id, truck_id FROM fleet) t"
    f" JOIN ({ORACLES['ru13_contributions']}) w USING (event_id)",
)
def _(df: DataFrame) -> DataFrame:
    return truck_views(_recent(df))["contributions"]


@register(
    "jb7_severity_bands",
    f"SELECT truck_id, {', '.join(_BANDS)} FROM (SELECT event_id, truck_id FROM fleet) t"
    f" JOIN ({ORACLES['ru14_severity_bands']}) w USING (event_id)",
)
def _(df: DataFrame) -> DataFrame:
    return truck_views(_recent(df))["severity_bands"].select("truck_id", *_BANDS)


# The late delivery meets the watermark that the second one was read under: of the first.
_NOON = "TIMESTAMP '2024-01-31 12:00:00'"
_LATE = (
    f"num % 10 = 3 AND event_time < {_NOON} AND event_time <= (SELECT max(event_time) FROM zone"
    f" WHERE num % 10 <> 3 AND event_time < {_NOON}) - INTERVAL 5 MINUTE"
)


@register_raw(
    "st9_late_rows",
    "SELECT event_id, storage_risk_score, CASE WHEN late THEN 'recovered' ELSE 'kept' END AS state,"
    f" count(*) FILTER (late) OVER () AS late FROM (SELECT *, {_LATE} AS late FROM zone)",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three deliveries: the first day's half, the rest, and a tenth of the first half too late."""
    root = scratch_path(spark, "late")
    df = fx.dirty(fx.readings(spark, sf_dir))
    noon = moment(NOW - timedelta(hours=24), "timestamp_ntz")
    first, held = F.col("event_time") < noon, fx.number() % 10 == 3
    for rows in (df.filter(first & ~held), df.filter(~first), df.filter(first & held)):
        fx.envelopes(rows).coalesce(1).write.mode("append").parquet(f"{root}/in")
    source = kafka.read_envelope_files(spark, f"{root}/in", max_files=1)
    paths = {name: f"{root}/{name}" for name in ("raw", "processed", "alerts", "checkpoints")}
    started = streams.stream_pipeline(source, paths, watermark="5 minutes", trigger={"availableNow": True})
    for running in started.values():
        running.awaitTermination()
    late = late_rows(started["processed"])
    kept = file_sources.read_zone(spark, paths["processed"], PROCESSED).select("event_id")
    recover(spark, paths["raw"], paths["processed"], f"{root}/late")
    zone = read_processed(spark, paths["processed"], f"{root}/late")
    was = F.when(F.col("_kept"), "kept").otherwise("recovered")
    return (
        zone.join(kept.withColumn("_kept", F.lit(True)), "event_id", "left")
        .select("event_id", "storage_risk_score", was.alias("state"), F.lit(late).cast("long").alias("late"))
    )


def _two_deliveries(spark: SparkSession, sf_dir: str, root: str) -> tuple[DataFrame, dict[str, str]]:
    """Messages in two files; the second repeats a part of the first and itself."""
    df = fx.dirty(fx.readings(spark, sf_dir))
    again = (fx.number() % 3 == 0) | (fx.number() % 7 == 0)
    for rows in (df.filter(fx.number() % 3 != 0), fx.deliveries(df.filter(again))):
        fx.envelopes(rows).coalesce(1).write.mode("append").parquet(f"{root}/in")
    paths = {name: f"{root}/{name}" for name in ("raw", "processed", "alerts", "checkpoints")}
    return kafka.read_envelope_files(spark, f"{root}/in", max_files=1), paths


_DELIVERED = "CASE WHEN num % 3 <> 0 THEN 0 ELSE 1 END::BIGINT AS batch"


@register_raw("st6_one_read", f"SELECT {', '.join(_ZONE)}, {_DELIVERED} FROM zone")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All zones by one query over the source; ids are told apart across micro-batches."""
    source, paths = _two_deliveries(spark, sf_dir, scratch_path(spark, "one-read"))
    one_read.start_zones(source, paths, "3 days", {"availableNow": True}).awaitTermination()
    zone = one_read.read_batches(spark, paths["processed"], PROCESSED)
    return ntz(zone, "event_time").select(*_ZONE, "batch")


@register_raw(
    "st5_restart",
    f"SELECT event_id, event_time, risk_level, 'processed' AS zone, {_DELIVERED} FROM zone"
    f" UNION ALL SELECT event_id, event_time, risk_level, 'alerts', {_DELIVERED} FROM zone"
    " WHERE prob_spoiled >= 0.70 OR ml_predicted_class = 2 OR temp_breach_flag = 1",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream that stops with each batch written and not committed, and is started again."""
    source, paths = _two_deliveries(spark, sf_dir, scratch_path(spark, "restart"))
    stopped: set[int] = set()

    def stop_once(number: int) -> None:
        if number not in stopped:
            stopped.add(number)
            raise InterruptedError(f"batch {number} is written, not committed")

    for _attempt in range(3):  # each of the two batches stops its first attempt
        running = one_read.start_zones(source, paths, "3 days", {"availableNow": True}, written=stop_once)
        try:
            running.awaitTermination()
        except StreamingQueryException as error:
            if "not committed" not in str(error):
                raise
    columns = ["event_id", "event_time", "risk_level"]
    zones = [
        one_read.read_batches(spark, paths[name], PROCESSED).select(*columns, F.lit(name).alias("zone"), "batch")
        for name in ("processed", "alerts")
    ]
    return ntz(zones[0].union(zones[1]), "event_time")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings to hourly features to the risk of each food."""
    return rollup.food_risk(fx.features(fx.readings(spark, sf_dir)))
