"""Generated calendar and clock dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.functions.calendar import date_key

# Default calendar range and open-end dates of the two star variants.
CALENDAR_START = "1990-01-01"
CALENDAR_END = "2023-01-01"
OPEN_END = "9999-12-31"
OPEN_END_SQL_TWIN = "2100-01-01"

SECONDS_PER_DAY = 86_400


def days_between(bounds: DataFrame, include_end: bool = True) -> DataFrame:
    """One row per day of a one-row relation with ``start`` and ``end`` dates."""
    last = F.col("end") if include_end else F.date_sub("end", 1)
    return bounds.select(F.explode(F.sequence("start", last)).alias("Date"))


def fixed_bounds(spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END):
    return spark.range(1).select(
        F.lit(start).cast("date").alias("start"), F.lit(end).cast("date").alias("end")
    )


def with_open_end(days: DataFrame, open_end: str = OPEN_END) -> DataFrame:
    return days.unionByName(
        days.sparkSession.range(1).select(F.lit(open_end).cast("date").alias("Date"))
    )


def calendar(days: DataFrame) -> DataFrame:
    """Calendar attributes of a ``Date`` column."""
    d = F.col("Date")
    return days.select(
        date_key(d).alias("Date_Key"),
        d,
        F.year(d).alias("Year"),
        F.month(d).alias("Month_Number"),
        F.date_format(d, "MMM").alias("Month_Name_Short"),
        F.date_format(d, "MMMM").alias("Month_Name_Long"),
        F.dayofweek(d).alias("Day_Of_Week_Number"),
        F.date_format(d, "EEEE").alias("Day_Of_Week"),
        F.date_format(d, "E").alias("Day_Of_Week_Short"),
        F.quarter(d).alias("quarter"),
        F.concat_ws("_Q", F.year(d).cast("string"), F.quarter(d).cast("string")).alias(
            "Year_Quarter"
        ),
        F.last_day(d).alias("End_Of_Month"),
    )


def calendar_sql_twin(days: DataFrame) -> DataFrame:
    """Attributes of the SQL-model twin: weekday from the same scale, other labels."""
    d = F.col("Date")
    return days.select(
        date_key(d).alias("Date_Key"),
        d,
        F.year(d).alias("Year"),
        F.month(d).alias("Month_Number"),
        F.left(F.date_format(d, "MMMM"), F.lit(3)).alias("Month_Name_Short"),
        F.date_format(d, "MMMM").alias("Month_Name_Long"),
        F.dayofweek(d).alias("Day_Of_Week_Number"),
        F.date_format(d, "EEEE").alias("Day_Of_Week"),
        F.date_format(d, "E").alias("Day_Of_Week_Short"),
        F.quarter(d).alias("quarter"),
        F.concat_ws("_", F.year(d).cast("string"), F.quarter(d).cast("string")).alias(
            "Year_Quarter"
        ),
        F.last_day(d).alias("last_date"),
    )


def date_dimension(
    spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END
) -> DataFrame:
    return calendar(with_open_end(days_between(fixed_bounds(spark, start, end))))


def time_dimension(spark: SparkSession, compat_key: bool = False) -> DataFrame:
    """Every second of the day.

    One range instead of three crossed ones. ``compat_key`` joins the unpadded parts, which
    repeats keys (1:11:01 and 11:1:01) and is kept only for comparison.
    """
    s = F.col("id")
    hour, minute, second = (
        (s / 3600).cast("int"),
        (F.pmod(s, F.lit(3600)) / 60).cast("int"),
        F.pmod(s, F.lit(60)).cast("int"),
    )
    key = (
        F.concat(hour.cast("string"), minute.cast("string"), second.cast("string")).cast("int")
        if compat_key
        else hour * 10000 + minute * 100 + second
    )
    padded = [F.lpad(p.cast("string"), 2, "0") for p in (hour, minute, second)]
    return spark.range(SECONDS_PER_DAY).select(
        key.alias("Time_Key"),
        F.concat_ws(":", *padded).alias("Time"),
        hour.alias("Hour"),
        minute.alias("Minute"),
        second.alias("Second"),
    )
