"""Worklists from kept day partials: a run recomputes the days that have changed and adds up the others.

A partial has one row for each day and editor. A span that begins in the middle of a day takes that day's own changes from the first moment on, and
the partials of all later days; so it equals what all changes give, whatever the time of the run.
"""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from changewatch.config import Settings
from changewatch.functions.values import percent, stamp_literal, time_literal

DAY = "day"
NO_DAY = "0"  # before all days
COUNTS = ["edits_patr", "edits_unpatr", "suggested_patr", "suggested_unpatr", "reverted", "created"]
SCHEMA = f"actor_name string, {', '.join(f'{c} bigint' for c in COUNTS)}, {DAY} string"


def day_of(time: Column) -> Column:
    """The day of a time as a name of a folder; changes without a time have one of their own."""
    return F.coalesce(F.date_format(time, "yyyyMMdd"), F.lit(NO_DAY))


def day_partials(changes: DataFrame) -> DataFrame:
    """Per day and editor: reviewed and open changes, those of suggested edits, reverted ones, and creations."""
    reviewed, is_open = F.col("rc_patrolled") == 1, F.col("rc_patrolled") == 0
    return changes.filter(F.col("actor_name").isNotNull()).groupBy(day_of(F.col("time")).alias(DAY), "actor_name").agg(
        F.count_if(reviewed).alias("edits_patr"), F.count_if(is_open).alias("edits_unpatr"),
        F.count_if(reviewed & F.col("suggested_edit")).alias("suggested_patr"),
        F.count_if(is_open & F.col("suggested_edit")).alias("suggested_unpatr"),
        F.count_if(F.col("reverted")).alias("reverted"), F.count_if(F.col("rc_source") == "mw.new").alias("created"))


class DayPartials:
    """Day partials in a folder that all machines see, a folder for each day."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def read(self) -> DataFrame:
        return self.spark.read.schema(SCHEMA).parquet(self.path)

    def refresh(self, changes: DataFrame, days: list[str] | None = None) -> None:
        """Compute the partials of ``days`` anew from all of their ``changes``, or of all days. Others are neither read nor written. A day
        without changes loses its partial. Doing it again changes nothing."""
        rows = day_partials(changes if days is None else changes.filter(day_of(F.col("time")).isin(days)))
        if days is None:
            rows.hint("rebalance", F.col(DAY)).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(DAY).parquet(self.path)
            return
        if not days:
            return
        rows.hint("rebalance", F.col(DAY)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(self.path)
        left = {row[0] for row in rows.select(DAY).distinct().collect()}  # as many as there are days to refresh
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        for day in set(days) - left:
            path = hadoop.Path(f"{self.path}/{DAY}={day}")
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def changed_days(self, before: DataFrame, now: DataFrame) -> list[str]:
        """Days on which two states of the changes differ, from a checksum of each day: (day, rows, sum of hashes) is compared, not rows."""
        def sums(changes: DataFrame, name: str) -> DataFrame:
            what = F.xxhash64("rc_id", "actor_name", "rc_patrolled", "suggested_edit", "reverted", "rc_source")
            return changes.groupBy(day_of(F.col("time")).alias(DAY)).agg(
                F.struct(F.count(F.lit(1)), F.sum(what.cast("decimal(38,0)"))).alias(name))

        both = sums(before, "old").join(sums(now, "new"), DAY, "full_outer")
        return sorted(row[0] for row in both.filter(~F.col("old").eqNullSafe(F.col("new"))).select(DAY).collect())


def span_starts(settings: Settings) -> dict[str, datetime]:
    return {"today": settings.today, "3d": settings.days_ago(3), "7d": settings.days_ago(7), "14d": settings.days_ago(14),
            "all": settings.days_ago(31)}


def worklists(partials: DataFrame, changes: DataFrame, settings: Settings) -> DataFrame:
    """(span, actor_name, edits_patr, ...) of all spans, as ``plans.worklists.worklists`` gives them from the changes alone. Of the changes, only
    the days in which spans begin are read; the bounds on the text of the time reach the scan."""
    starts = span_starts(settings)
    whole, edge = {}, {}
    for name, start in starts.items():
        midnight = start.replace(hour=0, minute=0, second=0, microsecond=0)
        day = F.lit(start.strftime("%Y%m%d"))
        whole[name] = F.col(DAY) >= day if start == midnight else F.col(DAY) > day
        if start != midnight:
            stamp = F.col("rc_timestamp")
            edge[name] = (stamp >= stamp_literal(midnight)) & (stamp < stamp_literal(midnight + timedelta(days=1))) \
                & (F.col("time") >= time_literal(start))

    def sums(sides: dict[str, tuple[Column, Column]], reverted: Column, created: Column) -> list[Column]:
        return [F.sum(reverted).alias("reverted"), F.sum(created).alias("created"), *[
            F.struct(F.lit(name).alias("span"), F.sum(patr).alias("edits_patr"), F.sum(unpatr).alias("edits_unpatr")).alias(f"span_{i}")
            for i, (name, (patr, unpatr)) in enumerate(sides.items())]]

    def one(condition: Column) -> Column:
        return F.when(condition, 1).otherwise(0).cast("bigint")

    def part(condition: Column, name: str) -> Column:
        return F.when(condition, F.col(name)).otherwise(0)

    zero, is_open, reviewed = F.lit(0).cast("bigint"), F.col("rc_patrolled") == 0, F.col("rc_patrolled") == 1
    suggested = "suggested-edit"
    from_days = partials.groupBy("actor_name").agg(*sums(
        {**{name: (part(own, "edits_patr"), part(own, "edits_unpatr")) for name, own in whole.items()},
         suggested: (F.col("suggested_patr"), F.col("suggested_unpatr"))}, F.col("reverted"), F.col("created")))
    none = (zero, zero)
    found = from_days
    if edge:
        rows = changes.filter(reduce(Column.__or__, edge.values()) & F.col("actor_name").isNotNull())
        found = found.unionByName(rows.groupBy("actor_name").agg(*sums(
            {**{name: (one(edge[name] & reviewed), one(edge[name] & is_open)) if name in edge else none for name in whole},
             suggested: none}, zero, zero)))
    # two rows an editor at most
    spans = F.array(*[f"span_{i}" for i in range(len(whole) + 1)])
    totals = found.groupBy("actor_name").agg(F.sum("reverted").alias("reverted"), F.sum("created").alias("created"),
                                             F.collect_list(spans).alias("parts"))
    laid_out = totals.select("actor_name", "reverted", "created", F.explode(F.flatten("parts")).alias("s"))
    edits = F.col("edits_patr") + F.col("edits_unpatr")
    return laid_out.groupBy("s.span", "actor_name", "reverted", "created").agg(
        F.sum("s.edits_patr").alias("edits_patr"), F.sum("s.edits_unpatr").alias("edits_unpatr")).withColumn("edits", edits).filter(
        F.col("edits") > 0).select("span", "actor_name", "edits_patr", "edits_unpatr", "reverted", "created", "edits",
                                   percent(F.col("edits_patr"), F.col("edits"), 2).alias("patrol_ratio"),
                                   percent(F.col("reverted"), F.col("edits"), 2).alias("reverted_ratio"))
