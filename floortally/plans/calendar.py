"""Period bounds of as-of days and the weeks of their months."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from floortally.functions import periods as P


def report_periods(days: DataFrame) -> DataFrame:
    """First and last days of the periods the reports use, for each distinct `as_of`."""
    as_of = F.col("as_of")
    return days.select("as_of").distinct().select(
        "as_of",
        P.month_start(as_of).alias("month_start"),
        F.last_day(as_of).alias("month_end"),
        P.monday_of(as_of).alias("week_start"),
        F.date_add(P.monday_of(as_of), 6).alias("week_end"),
        P.sunday_of(as_of).alias("sunday_week_start"),
        F.date_add(P.sunday_of(as_of), 6).alias("sunday_week_end"),
        P.rolling_week_start(as_of).alias("rolling_start"),
        P.look_back_start(as_of).alias("look_back_start"),
        P.days_between(P.month_start(as_of), as_of).alias("month_days"),
        P.week_label(as_of).alias("week"),
        P.long_date(as_of).alias("title"),
    )


def week_calendar(months: DataFrame) -> DataFrame:
    """The weeks of each `as_of`'s month with range, range to date and days elapsed."""
    first, as_of, number = F.col("month_first"), F.col("as_of"), F.col("number")
    weeks = months.withColumn("month_first", P.month_start(as_of)).withColumn(
        "number", F.explode(F.sequence(F.lit(1), P.week_of_month(F.last_day(as_of))))
    )
    weeks = weeks.withColumns({"start_date": P.week_start(first, number), "end_date": P.week_end(first, number)})
    return weeks.select(
        "as_of",
        F.concat(F.lit("Week "), number).alias("week"),
        "start_date",
        "end_date",
        F.least("end_date", "as_of").alias("end_to_date"),
        P.days_elapsed(F.col("start_date"), F.col("end_date"), as_of).alias("working_days"),
        P.short_date(F.col("start_date")).alias("start_text"),
    )
