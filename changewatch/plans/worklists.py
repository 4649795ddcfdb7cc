"""Worklists by editor and item, reviewers, progress and tags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from changewatch.config import Settings
from changewatch.functions.actions import NO_CATEGORY
from changewatch.functions.values import percent, stamp_literal, time_literal

OPEN = "rc_patrolled = 0"
SPANS = ["today", "3d", "7d", "14d", "all", "suggested-edit"]


def spans(settings: Settings) -> dict[str, Column]:
    """Named parts of the changes that get a worklist of their own. None has an end."""
    time = F.col("time")
    return {
        "today": time >= time_literal(settings.today),
        "3d": time >= time_literal(settings.days_ago(3)),
        "7d": time >= time_literal(settings.days_ago(7)),
        "14d": time >= time_literal(settings.days_ago(14)),
        "all": time >= time_literal(settings.days_ago(31)),
        "suggested-edit": F.col("suggested_edit"),
    }


def worklists(changes: DataFrame, parts: dict[str, Column]) -> DataFrame:
    """Per part and editor: reviewed and open changes of the part, reverted changes and creations
    among all changes, and ratios. One pass over the changes serves all parts."""
    def count(name: str, status: int) -> Column:
        return F.count_if(parts[name] & (F.col("rc_patrolled") == status))

    by_editor = changes.groupBy("actor_name").agg(
        F.count_if(F.col("reverted")).alias("reverted"),
        F.count_if(F.col("rc_source") == "mw.new").alias("created"),
        F.array(*[
            F.struct(F.lit(name).alias("span"), count(name, 1).alias("edits_patr"),
                     count(name, 0).alias("edits_unpatr"))
            for name in parts]).alias("parts"))
    edits = F.col("edits_patr") + F.col("edits_unpatr")
    return (
        by_editor.filter(F.col("actor_name").isNotNull())
        .select("actor_name", "reverted", "created", F.inline("parts"))
        .withColumn("edits", edits).filter(F.col("edits") > 0)
        .select("span", "actor_name", "edits_patr", "edits_unpatr", "reverted", "created", "edits",
                percent(F.col("edits_patr"), F.col("edits"), 2).alias("patrol_ratio"),
                percent(F.col("reverted"), F.col("edits"), 2).alias("reverted_ratio"))
    )


def worklist(changes: DataFrame, part: Column) -> DataFrame:
    return worklists(changes, {"": part}).drop("span")


def score_worklist(changes: DataFrame, registered: bool, settings: Settings) -> DataFrame:
    """Editors with many open changes and a high mean damaging score. A missing score counts as 0.
    The sum is decimal, so it does not depend on the order of the rows."""
    if registered:
        of_kind = F.col("actor_user").isNotNull()
        min_score, min_edits = settings.min_score_registered, settings.min_edits_registered
    else:
        of_kind = F.col("actor_user").isNull()
        min_score, min_edits = settings.min_score_unregistered, settings.min_edits_unregistered
    score = F.coalesce(F.col("oresc_damaging"), F.lit(0.0)).cast("decimal(18,9)")
    return (
        changes.filter(F.expr(OPEN) & of_kind).groupBy("actor_name")
        .agg(F.count(F.lit(1)).alias("edits"), F.sum(score).cast("double").alias("score_sum"))
        .select("actor_name", "edits", (F.col("score_sum") / F.col("edits")).alias("damaging"))
        .filter((F.col("damaging") >= min_score) & (F.col("edits") >= min_edits))
    )


def items_many_revisions(changes: DataFrame, settings: Settings) -> DataFrame:
    """Open changes by item, of items below the number limit if there is one."""
    rows = changes.filter(OPEN)
    if settings.max_item_number is not None:
        rows = rows.filter(F.col("num_title") < settings.max_item_number)
    return rows.filter(F.col("rc_title").isNotNull()) \
        .groupBy("rc_title").agg(F.count(F.lit(1)).alias("edits"))


def users_many_creations(changes: DataFrame) -> DataFrame:
    """Open changes that are not plain edits, by editor. An unknown source is not a plain edit."""
    return changes.filter(F.expr(OPEN) & ~F.col("rc_source").eqNullSafe("mw.edit")) \
        .groupBy("actor_name").agg(F.count("rc_id").alias("creations"))


def highly_used_items(changes: DataFrame, usage: DataFrame, settings: Settings) -> DataFrame:
    """Open changes of items that are used a lot elsewhere. Changes are counted by title before the
    join, so a title with very many of them joins as one row."""
    counted = changes.filter(OPEN).groupBy("rc_title").agg(F.count(F.lit(1)).alias("edits"))
    used = usage.filter(F.col("entity_usage_count") >= settings.min_item_usage)
    return (
        counted.join(used, F.col("rc_title") == F.col("qid"))
        .groupBy("rc_title", "entity_usage_count").agg(F.sum("edits").alias("edits"))
    )


def uncategorized_summaries(changes: DataFrame) -> DataFrame:
    return changes.filter(F.col("summary_category") == NO_CATEGORY) \
        .select("rc_id", "rc_timestamp", "rc_title", "rc_this_oldid", "actor_name")


def entries_in_scope(log: DataFrame, scope: Column) -> DataFrame:
    """Patrol entries from the oldest revision in scope on. The bound is a scalar subquery."""
    return log.filter(F.col("rc_curid") >= scope.getField("oldest"))


def scope_of(changes: DataFrame) -> Column:
    """The oldest revision in scope, how many changes there are, and how many of them have a status that says reviewed: one scalar subquery."""
    return changes.agg(F.struct(
        F.min("rc_this_oldid").alias("oldest"), F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("rc_patrolled") == 1).alias("reviewed_status")).alias("scope")).scalar()


def top_patrollers(changes: DataFrame, log: DataFrame) -> DataFrame:
    """Patrol entries by reviewer and their share in percent. The total is taken over the counted reviewers."""
    counted = entries_in_scope(log, scope_of(changes)).filter(F.col("patroller").isNotNull()) \
        .groupBy("patroller").agg(F.count(F.lit(1)).alias("patrols"))
    total = F.sum("patrols").over(Window.partitionBy(F.lit(0)))  # a row for each reviewer
    return counted.withColumn("patrols_relative", percent(F.col("patrols"), total, 1))


def _progress(counts: DataFrame, template: str) -> DataFrame:
    counts = counts.withColumns({
        "remaining": F.col("total") - F.col("patrolled"),
        "percent": percent(F.col("patrolled"), F.col("total"), 1)})
    return counts.withColumn("sentence", F.format_string(
        template, "patrolled", "total", F.col("percent").cast("decimal(9,1)").cast("string"),
        "remaining"))


def progress_totals(changes: DataFrame, log: DataFrame) -> DataFrame:
    """One row: patrol entries against changes in scope, and the number of changes whose status says
    reviewed. Changes are read once for their own numbers and the bound."""
    scope = scope_of(changes)
    counts = entries_in_scope(log, scope).agg(F.count(F.lit(1)).alias("patrolled")).withColumns({
        "total": scope.getField("total"), "reviewed_status": scope.getField("reviewed_status")})
    # fixed values: this sentence and the next one
    return _progress(
        counts,
        "Currently %d out of %d revisions are patrolled (%s%%); %d revisions are not yet patrolled",
    ).select("patrolled", "total", "remaining", "percent", "reviewed_status", "sentence")


def progress_today(changes: DataFrame, settings: Settings) -> DataFrame:
    """One row: reviewed among today's changes. No percentage when there is none."""
    today = spans(settings)["today"] & (F.col("rc_timestamp") >= stamp_literal(settings.today))
    counts = changes.filter(today).agg(
        F.count_if(F.col("rc_patrolled") == 1).alias("patrolled"),
        F.count(F.lit(1)).alias("total"))
    return _progress(
        counts,
        "Today %d out of %d revisions are patrolled (%s%%); %d revisions are not yet patrolled",
    ).select("patrolled", "total", "remaining", "percent", "sentence")


def tag_counts(tags: DataFrame) -> DataFrame:
    return tags.filter(F.col("ctd_name").isNotNull()) \
        .groupBy("ctd_name").agg(F.count(F.lit(1)).alias("n"))
