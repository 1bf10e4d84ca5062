"""Column expressions and tables of dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def date_spine(spark: SparkSession, start: str, end: str, step: str = "1 day") -> DataFrame:
    """A row per date from start to end, both included."""
    return spark.sql(f"SELECT explode(sequence(DATE '{start}', DATE '{end}', INTERVAL {step})) AS obs_date")


def spine_between(bounds: DataFrame, low: str, high: str, name: str = "obs_date") -> DataFrame:
    """A row per row of bounds and date between its columns low and high."""
    return bounds.withColumn(name, F.explode(F.sequence(F.col(low), F.col(high), F.expr("INTERVAL 1 DAY"))))


def week_spans(bounds: DataFrame, low: str, high: str) -> DataFrame:
    """Spans of seven days between two dates, the last cut off at the end."""
    d = bounds.withColumn("week_start", F.explode(F.sequence(F.col(low), F.col(high), F.expr("INTERVAL 7 DAYS"))))
    return d.withColumn("week_end", F.least(F.date_add("week_start", 6), F.col(high)))


def season(date: Column) -> Column:
    return F.element_at(F.array(*[F.lit(s) for s in ("DJF", "DJF", "MAM", "MAM", "MAM", "JJA", "JJA", "JJA", "SON", "SON", "SON", "DJF")]), F.month(date))


def posix_range(time_min: Column, time_max: Column, day: Column) -> tuple[Column, Column]:
    """Seconds of the first and last time; of the whole day where there is none."""
    return F.coalesce(F.unix_timestamp(time_min.cast("timestamp")), F.unix_timestamp(day.cast("timestamp"))), F.coalesce(F.unix_timestamp(time_max.cast("timestamp")), F.unix_timestamp(day.cast("timestamp")) + 86400)


def compact_date(text: Column) -> Column:
    """yyyyMMdd, yyyy-MM-dd or yyyy_MM_dd to a date."""
    return F.to_date(F.regexp_replace(text, "[-_]", ""), "yyyyMMdd")
