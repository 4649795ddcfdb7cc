"""Reports from sketches by day, next to the exact ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from changewatch.config import Settings
from changewatch.functions.actions import actions_of
from changewatch.functions.values import editor_name
from changewatch.operators import frequent, sketches
from changewatch.operators.quantiles import value_counts
from changewatch.plans.trends import in_window

SPANS = [1, 7, 14, 28]  # whole days before today


def editor_sketches(changes: DataFrame, settings: Settings) -> DataFrame:
    """(date, series, sketch) of the editors of each day of the window, by kind; what a day's run stores."""
    rows = changes.filter(in_window(settings)).withColumns({"date": F.to_date("time"), "series": editor_name(F.col("actor_user"))})
    return sketches.distinct_sketches(rows, ["date", "series"], F.col("actor_name"))


def spans_of(date: Column, settings: Settings) -> Column:
    """The spans that a date is in."""
    age = F.datediff(F.lit(settings.today.date()), date)
    return F.filter(F.array(*map(F.lit, SPANS)), lambda days: age <= days)


def editors_by_span(changes: DataFrame, by_day: DataFrame, settings: Settings) -> DataFrame:
    """(days, series, n, close): distinct editors of the last whole days by kind, exact, and whether the merged sketches of those
    days are within their bound of that."""
    rows = changes.filter(in_window(settings)).select(
        editor_name(F.col("actor_user")).alias("series"), "actor_name", F.explode(spans_of(F.to_date("time"), settings)).alias("days"))
    exact = rows.groupBy("days", "series").agg(F.count_distinct("actor_name").alias("n"))
    merged = sketches.merged_distinct(
        by_day.withColumn("days", F.explode(spans_of(F.col("date"), settings))), ["days", "series"])
    near = F.abs(F.col("estimate") - F.col("n")) <= F.lit(sketches.distinct_error()) * F.col("n") + 1
    return exact.join(merged, ["days", "series"]).select("days", "series", "n", near.alias("close"))


def delay_sketches(progress: DataFrame) -> DataFrame:
    """(language, date, sketch) of the review delays of each day's term edits."""
    rows = progress.filter(F.col("language").isNotNull()).withColumn("date", F.to_date("time"))
    return sketches.quantile_sketches(rows, ["language", "date"], F.col("delay_seconds"))


def delay_percentiles(by_day: DataFrame) -> DataFrame:
    """(language, pct, hours) of all days, from their sketches."""
    found = sketches.merged_quantiles(by_day, ["language"], list(range(101)))
    return found.select("language", "pct", (F.col("value") / 3600.0).alias("hours"))


def delay_percentiles_checked(progress: DataFrame, by_day: DataFrame, within: float = 0.01) -> DataFrame:
    """(language, pct, close): whether the percentile that the merged sketches give has a rank within 1 % of what was asked for."""
    found = sketches.merged_quantiles(by_day, ["language"], list(range(101)))
    errors = sketches.rank_errors(found, value_counts(progress, "language", "delay_seconds"), "language")
    return errors.select("language", "pct", (F.col("error") <= within).alias("close"))


def frequent_by_day(changes: DataFrame, value: str, tracked: int = frequent.TRACKED) -> DataFrame:
    """(date, rows, sketch) of the most frequent values of each day."""
    return frequent.frequent_sketches(changes.withColumn("date", F.to_date("time")), ["date"], F.col(value), tracked)


def frequent_lists(changes: DataFrame) -> dict[str, tuple[DataFrame, str]]:
    """The rows and the column of each list of most frequent values."""
    terms = changes.filter(F.col("summary_action").isin(actions_of("terms")))
    return {"language": (terms, "summary_param1"), "item": (changes, "rc_title"), "editor": (changes, "actor_name")}


def most_frequent(changes: DataFrame, by_day: dict[str, DataFrame], settings: Settings) -> DataFrame:
    """(what, value, n): the most frequent languages of term edits, items and editors, each list as long as that of the top languages, from the
    stored sketches of each day and one pass that counts the candidates."""
    lists = []
    for what, (rows, value) in frequent_lists(changes).items():
        top, _ = frequent.exact_top(rows, F.col(value), by_day[what], settings.top_languages)
        lists.append(top.select(F.lit(what).alias("what"), "value", "n"))
    return lists[0].unionByName(lists[1]).unionByName(lists[2])
