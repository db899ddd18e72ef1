"""Calendar dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dim_date(spans: DataFrame, first: str, last: str) -> DataFrame:
    """One row per date from the lowest ``first`` to the highest ``last`` of ``spans``. Weeks are ISO, Sunday is day 1."""
    reach = spans.agg(F.min(first).cast("date").alias("_a"), F.max(last).cast("date").alias("_b"))
    day = F.col("calendar_date")
    days = reach.select(F.explode(F.sequence("_a", "_b", F.expr("interval 1 day"))).alias("calendar_date"))
    return days.select(
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_key"), day,
        F.dayofweek(day).alias("day_of_week"), F.date_format(day, "EEEE").alias("day_name"),
        F.dayofmonth(day).alias("day_of_month"), F.dayofyear(day).alias("day_of_year"),
        F.weekofyear(day).alias("week_of_year"), F.month(day).alias("month_number"),
        F.date_format(day, "MMMM").alias("month_name"), F.quarter(day).alias("quarter"), F.year(day).alias("year"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"), (day == F.last_day(day)).alias("is_month_end"),
    )
