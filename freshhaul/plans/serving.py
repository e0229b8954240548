"""All dashboard queries over the serving tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshhaul.models.shelf_life import latest_or_rule
from freshhaul.operators.alerts import alert_display
from freshhaul.operators.featurize import contributions, severity_bands, shelf_life, urgency, what_if
from freshhaul.operators.merge import prune
from freshhaul.operators.recent import full_rings, newest, unpacked
from freshhaul.operators.rollup import distribution
from freshhaul.operators.sampling import top_n
from freshhaul.operators.serving import (
    alert_counts,
    alerts_over_time,
    drop_seed_rows,
    filter_fleet,
    fleet_kpis,
    fleet_view,
    freshness,
    histogram,
    mean_risk_by_food,
    truck_history,
)
from freshhaul.operators.windows import latest_by


def latest_alerts(alerts: DataFrame, n: int = 40) -> DataFrame:
    """The newest ``n`` alerts, seed rows left out."""
    return top_n(drop_seed_rows(alerts), [F.desc("created_at"), F.desc("event_id")], n)


def shelf_life_view(
    recent: DataFrame, fitted: tuple[GBTRegressionModel, DataFrame] | None = None
) -> DataFrame:
    """Hours and days left per truck, by the model in production or the formula, and urgency."""
    return urgency(latest_or_rule(shelf_life(unpacked(recent)), fitted), "hours")


def truck_views(
    recent: DataFrame, fitted: tuple[GBTRegressionModel, DataFrame] | None = None
) -> dict[str, DataFrame]:
    """Views over the last readings of each truck."""
    now = newest(recent)
    return {
        "latest": now,
        "last_ten": full_rings(recent),
        "shelf_life": shelf_life_view(recent, fitted),
        "what_if": what_if(now),
        "contributions": contributions(now, "truck_id"),
        "severity_bands": severity_bands(now),
    }


def serving_views(
    fleet: DataFrame,
    history: DataFrame,
    alerts: DataFrame,
    model_metrics: DataFrame,
    now: datetime,
    truck_id: str,
    labels: list[str] | None = None,
    foods: list[str] | None = None,
    alert_rows: int = 40,
    alert_hours: float = 24,
    recent: DataFrame | None = None,
    fitted: tuple[GBTRegressionModel, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """Name to lazy frame; the caller runs the ones on screen.

    ``labels`` and ``foods`` choose trucks, None all, also those of an unknown food.
    The list of alerts is the newest ``alert_rows``; their counts are of all alerts of
    the last ``alert_hours``. With ``recent``, the table that the stream keeps, come the
    views of ``truck_views``; ``fitted`` is the shelf-life model in production.
    """
    view = fleet_view(fleet)
    counted = prune(drop_seed_rows(alerts), now, alert_hours, "created_at")
    return {
        "fleet": filter_fleet(view, labels, foods).orderBy(F.desc("spoiled_class"), "truck_id"),
        "kpis": fleet_kpis(view),
        "risk_distribution": distribution(view, "risk_label"),
        "risk_by_food": mean_risk_by_food(view),
        "temperature_histogram": histogram(view, "temperature", 20, "risk_label"),
        "truck_history": truck_history(history, truck_id, now),
        "alerts": alert_display(latest_alerts(alerts, alert_rows)),
        "alert_counts": alert_counts(counted),
        "alerts_over_time": alerts_over_time(counted),
        "fleet_freshness": freshness(fleet, "updated_at", now),
        "alert_freshness": freshness(drop_seed_rows(alerts), "created_at", now),
        "model_metrics": latest_by(model_metrics, "model_name", ["trained_at", "run_id"]),
        **(truck_views(recent, fitted) if recent is not None else {}),
    }


def write_views(views: dict[str, DataFrame], out: str) -> dict[str, str]:
    """Each view as a table below ``out``, replaced as a whole; name to path."""
    for name, view in views.items():
        view.write.mode("overwrite").parquet(f"{out}/{name}")
    return {name: f"{out}/{name}" for name in views}
