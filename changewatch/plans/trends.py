"""Activity over time: counts by date, weekday and hour in the chart window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from changewatch.config import Settings
from changewatch.functions.values import editor_name, stamp_literal, status_name, time_literal
from changewatch.operators.counts import counts_by


def in_window(settings: Settings) -> Column:
    """The last whole days before today. The bound on the text of the time says the same, and reaches
    the scan."""
    stamp = F.col("rc_timestamp")
    return (stamp >= stamp_literal(settings.window_start)) & (stamp < stamp_literal(settings.today)) \
        & (F.col("time") >= time_literal(settings.window_start)) \
        & (F.col("time") < time_literal(settings.today))


def time_key(name: str, settings: Settings) -> tuple[Column, float | None]:
    """Grouping key for a time unit and the divisor that turns counts into an average per day. A
    weekday occurs window / 7 times in the window, an hour once a day. Monday is 0."""
    time = F.col("time")
    return {
        "date": (F.to_date(time), None),
        "weekday": (F.weekday(time), settings.window_days / 7),
        "hour": (F.hour(time), float(settings.window_days)),
    }[name]


def edits(changes: DataFrame, unit: str, settings: Settings) -> DataFrame:
    """Changes by time unit and kind of editor."""
    key, per = time_key(unit, settings)
    return counts_by(changes.filter(in_window(settings)), key, unit,
                     editor_name(F.col("actor_user")), per=per)


def patrol_status(changes: DataFrame, unit: str, settings: Settings) -> DataFrame:
    """Changes by time unit and review status."""
    key, per = time_key(unit, settings)
    return counts_by(changes.filter(in_window(settings)), key, unit,
                     status_name(F.col("rc_patrolled")), per=per, total=False)


def editors(changes: DataFrame, unit: str, settings: Settings) -> DataFrame:
    """Distinct editors by time unit and kind. An editor counts once per unit over the whole window,
    also where the result is divided into an average."""
    key, per = time_key(unit, settings)
    return counts_by(changes.filter(in_window(settings)), key, unit,
                     editor_name(F.col("actor_user")), distinct=F.col("actor_name"), per=per)


def sources_by_date(changes: DataFrame, settings: Settings) -> DataFrame:
    return counts_by(changes.filter(in_window(settings)), F.to_date("time"), "date",
                     F.col("rc_source"))


def categories_by_date(changes: DataFrame, settings: Settings) -> DataFrame:
    return counts_by(changes.filter(in_window(settings)), F.to_date("time"), "date",
                     F.col("summary_category"), total=False)


def reverted_by_date(changes: DataFrame, settings: Settings) -> DataFrame:
    """Dates of the window with reverted changes: their number next to that of all changes. The window
    is made of whole days, so all changes of its dates lie in it."""
    return (
        changes.filter(in_window(settings)).groupBy(F.to_date("time").alias("date"))
        .agg(F.count_if("reverted").alias("reverted"),
             F.count(F.lit(1)).alias("changes"))
        .filter(F.col("reverted") > 0)
    )


def remaining_by_date(changes: DataFrame, settings: Settings) -> DataFrame:
    """Open changes: all, by registered editors, by others."""
    return (
        changes.filter(in_window(settings) & (F.col("rc_patrolled") == 0))
        .groupBy(F.to_date("time").alias("date"))
        .agg(F.count(F.lit(1)).alias("total"), F.count("actor_user").alias("registered"))
        .withColumn("anon", F.col("total") - F.col("registered"))
    )
