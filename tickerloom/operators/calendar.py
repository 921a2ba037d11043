"""Trading weeks.

A calendar has one row per calendar week: the built-in one covers 1972 to 2099 in about
6,700 rows whatever the data volume, so broadcasting it is bounded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import is_session, week_start

# First and last day the holiday rules are stated for.
CALENDAR_SPAN = ("1972-01-01", "2099-12-31")


def sessions_between(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """Exchange sessions from ``first`` to ``last`` of a one-row frame."""
    days = bounds.select(F.explode(F.sequence(first, last)).alias("session_date"))
    return days.filter(is_session(F.col("session_date")))


def week_ends(sessions: DataFrame, date: str = "session_date") -> DataFrame:
    """Last session per week: the calendar table other operators take."""
    return sessions.groupBy(week_start(date).alias("week_start_date")).agg(
        F.max(date).alias("official_week_end_date")
    )


def trading_weeks(spark: SparkSession) -> DataFrame:
    """The built-in calendar: official last session of every week."""
    span = spark.range(1).select(*[F.lit(d).cast("date").alias(f"d{i}") for i, d in enumerate(CALENDAR_SPAN)])
    return week_ends(sessions_between(span, "d0", "d1"))


def calendar_or_default(df: DataFrame, calendar: DataFrame | None) -> DataFrame:
    """The given calendar, reduced to one row per week, or the built-in one; marked for
    broadcast, because a calendar has as many rows as there are weeks."""
    if calendar is None:
        return F.broadcast(trading_weeks(df.sparkSession))
    one = calendar.groupBy("week_start_date").agg(F.max("official_week_end_date").alias("official_week_end_date"))
    return F.broadcast(one)


def with_official_week_end(
    df: DataFrame, calendar: DataFrame | None = None, how: str = "left"
) -> DataFrame:
    """Add ``official_week_end_date`` by ``week_start_date``.

    The built-in calendar must hold every week of the data: a week that its rules do not reach
    is an error and never dropped.  A given calendar decides by itself which weeks there are.
    """
    if calendar is not None:
        return df.join(calendar_or_default(df, calendar), "week_start_date", how)
    rows = df.join(calendar_or_default(df, None), "week_start_date", "left")
    beyond = F.col("week_start_date").isNotNull() & F.col("official_week_end_date").isNull()
    message = F.concat(F.lit("no session rules for the week of "), F.col("week_start_date").cast("string"))
    checked = F.when(beyond, F.raise_error(message).cast("date")).otherwise(F.col("official_week_end_date"))
    rows = rows.withColumn("official_week_end_date", checked)
    return rows.filter("official_week_end_date IS NOT NULL") if how == "inner" else rows


def market_week_ends(df: DataFrame, date: str = "date") -> DataFrame:
    """Latest market date per week."""
    return df.groupBy(week_start(date).alias("week_start_date")).agg(
        F.max(date).alias("market_week_end_date")
    )


def completed_weeks(df: DataFrame, calendar: DataFrame | None = None, date: str = "date") -> DataFrame:
    """Weeks in which the market data reached the official last session."""
    weeks = with_official_week_end(market_week_ends(df, date), calendar, "inner")
    return weeks.filter("market_week_end_date = official_week_end_date").select(
        "week_start_date", F.col("official_week_end_date").alias("week_end_date")
    )


def mark_official_week_ends(df: DataFrame, date: str, calendar: DataFrame | None = None) -> DataFrame:
    """Add whether each date is the last session of its week."""
    weeks = df.withColumn("week_start_date", week_start(date))
    marked = with_official_week_end(weeks, calendar)
    return marked.withColumn(
        "is_official_week_end", F.col(date).eqNullSafe(F.col("official_week_end_date"))
    )
