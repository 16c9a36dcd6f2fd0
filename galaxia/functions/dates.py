"""Date parts and the date dimension.

The dimension is one ``explode(sequence(start, end, 1 day))`` -- a row per
calendar day -- instead of a day-by-day insert loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import schemas
from ..sources.schemas import conform


def week_of_year(d: Column) -> Column:
    """Weeks start on Sunday and the week holding 1 January is week 1 (not ISO)."""
    return (F.floor((F.dayofyear(d) + F.dayofweek(F.trunc(d, "year")) - 2) / 7) + 1).cast("int")


def is_weekend(d: Column) -> Column:
    """Saturday or Sunday (Spark numbers Sunday = 1 ... Saturday = 7)."""
    return F.dayofweek(d).isin(1, 7)


def date_attributes(d: Column) -> dict[str, Column]:
    """T2-T7 for a date column."""
    return {
        "year": F.year(d), "quarter": F.quarter(d),
        "quarter_name": F.concat(F.lit("Q"), F.quarter(d).cast("string")),
        "month": F.month(d), "month_name": F.date_format(d, "MMMM"),
        "month_short": F.date_format(d, "MMM"), "month_year": F.date_format(d, "MMM yyyy"),
        "day": F.dayofmonth(d), "day_name": F.date_format(d, "EEEE"),
        "day_short": F.date_format(d, "EEE"), "is_weekend": is_weekend(d),
        "week_of_year": week_of_year(d),
    }


def dim_date_from_bounds(bounds: DataFrame, start_col: str = "start", end_col: str = "end") -> DataFrame:
    """T1 for every (start, end) row of ``bounds`` -- usually the one-row
    min/max of the fact dates, so the calendar follows the data."""
    days = bounds.select(F.explode(F.sequence(F.col(start_col).cast("date"), F.col(end_col).cast("date"),
                                              F.expr("INTERVAL 1 DAY"))).alias("date"))
    return conform(days.withColumns(date_attributes(F.col("date"))), schemas.GOLD["dim_date"])


def build_dim_date(spark: SparkSession, start: str = "2016-01-01", end: str = "2018-12-31") -> DataFrame:
    """T1 for a fixed range (the reference's calendar is 2016-01-01 .. 2018-12-31)."""
    bounds = spark.range(1).select(F.lit(start).cast("date").alias("start"),
                                   F.lit(end).cast("date").alias("end"))
    return dim_date_from_bounds(bounds)


def calendar_for(sources: list[tuple[DataFrame, str]]) -> DataFrame:
    """T1 spanning every date found in the given (table, column) pairs."""
    from functools import reduce
    dates = reduce(lambda a, b: a.unionAll(b),
                   [df.select(F.col(c).cast("date").alias("d")) for df, c in sources])
    return dim_date_from_bounds(dates.agg(F.min("d").alias("start"), F.max("d").alias("end")))
