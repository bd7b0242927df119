"""Analysts' reports as parameterised SQL over the hourly marts. `as_of` stands for today, so that a report can be repeated."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_YESTERDAY = "hour >= :as_of - INTERVAL 1 DAY AND hour < :as_of"
_WEEK, _MONTH = "hour >= :as_of - INTERVAL 7 DAY", "hour >= :as_of - INTERVAL 30 DAY"
_RATE = "round(try_divide(CAST(sum({part}) AS DOUBLE), CAST(sum({whole}) AS DOUBLE)), 4)"
_ERRORS = _RATE.format(part="error_count", whole="total_count")
_SUCCESSES = _RATE.format(part="success_count", whole="event_count")

# Unique users and buyers are summed over hours, as dashboards show them: who comes in two hours counts twice;
# plans.gold.exact_users counts each once.
REPORTS = {
    "error_rate_by_version": f"""
        SELECT app_version, sum(total_count) AS total_events, sum(error_count) AS errors, {_ERRORS} AS error_rate
        FROM {{app_health}} WHERE {_YESTERDAY} GROUP BY app_version ORDER BY error_rate DESC, app_version""",
    "payment_failures_by_version": f"""
        SELECT app_version, sum(total_count) AS payment_attempts, sum(error_count) AS failures, {_ERRORS} AS failure_rate
        FROM {{app_health}} WHERE event_type = 'payment_callback' AND {_WEEK} GROUP BY app_version ORDER BY failure_rate DESC, app_version""",
    "error_spikes": f"""
        SELECT hour, app_version, event_type, total_count, error_count, round(try_divide(CAST(error_count AS DOUBLE), CAST(total_count AS DOUBLE)), 4) AS error_rate
        FROM {{app_health}} WHERE {_YESTERDAY} AND error_count > 0 ORDER BY error_rate DESC, hour, app_version, event_type LIMIT 20""",
    "funnel_overview": f"""
        SELECT event_type, sum(event_count) AS total_events, sum(success_count) AS successful, {_SUCCESSES} AS success_rate, sum(unique_users) AS unique_users
        FROM {{funnel}} WHERE {_YESTERDAY} GROUP BY event_type ORDER BY total_events DESC, event_type""",
    "funnel_by_version": f"""
        SELECT app_version, event_type, sum(event_count) AS total_events, sum(unique_users) AS unique_users
        FROM {{funnel}} WHERE {_YESTERDAY} GROUP BY app_version, event_type ORDER BY app_version, total_events DESC, event_type""",
    "funnel_by_system": f"""
        SELECT device_os, event_type, sum(event_count) AS total_events, sum(unique_users) AS unique_users
        FROM {{funnel}} WHERE {_WEEK} GROUP BY device_os, event_type ORDER BY device_os, total_events DESC, event_type""",
    "revenue_ranking": f"""
        SELECT item, sum(units_sold) AS total_units, sum(total_revenue) AS revenue, sum(unique_buyers) AS unique_buyers
        FROM {{revenue}} WHERE {_WEEK} GROUP BY item ORDER BY revenue DESC, item""",
    "revenue_by_hour_of_day": f"""
        SELECT hour(hour) AS hour_of_day, sum(units_sold) AS total_units, sum(total_revenue) AS revenue
        FROM {{revenue}} WHERE {_YESTERDAY} GROUP BY hour(hour) ORDER BY hour_of_day""",
    "revenue_trend": f"""
        SELECT CAST(hour AS DATE) AS day, sum(total_revenue) AS daily_revenue, sum(units_sold) AS daily_units
        FROM {{revenue}} WHERE {_MONTH} GROUP BY CAST(hour AS DATE) ORDER BY day""",
    "funnel_success": """
        SELECT event_type, sum(event_count) AS total, round(100 * try_divide(CAST(sum(success_count) AS DOUBLE), CAST(sum(event_count) AS DOUBLE)), 1) AS success_pct
        FROM {funnel} GROUP BY event_type ORDER BY total DESC, event_type""",
    "top_items": """
        SELECT item, sum(units_sold) AS units, sum(total_revenue) AS revenue
        FROM {revenue} GROUP BY item ORDER BY revenue DESC, item LIMIT 5""",
}


def run_report(spark: SparkSession, name: str, as_of: str, **marts: DataFrame) -> DataFrame:
    """A report of the given day (yyyy-MM-dd). marts: funnel, app_health or revenue, each a frame."""
    sql = REPORTS[name].replace(":as_of", f"TIMESTAMP_NTZ'{as_of} 00:00:00'")
    return spark.sql(sql, **marts)
