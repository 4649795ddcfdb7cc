"""The enriched change table, from which nearly all reports are computed."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from changewatch.functions.summary import SUMMARY_COLUMNS, with_summary
from changewatch.functions.values import seconds_between
from changewatch.functions.actions import TERM_CATEGORIES
from changewatch.sources import queries
from changewatch.sources.readers import Tables

ENRICHED_COLUMNS = [
    *queries.CHANGE_COLUMNS, "actor_user", "actor_name", "comment_text", "time", "len_diff",
    "num_title", "reverted", "suggested_edit", *SUMMARY_COLUMNS, "oresc_damaging",
    "oresc_goodfaith",
]


def changes(tables: Tables) -> DataFrame:
    """Main-namespace changes with flags, scores, editor and parsed summary.

    Flags and scores are brought to one row per key before they are joined, so the joins keep the
    row count, and Catalyst drops a join whose columns a report does not read. The wide comment
    text comes last: the other joins shuffle narrow rows only.
    """
    df = queries.main_namespace_changes(tables)
    df = df.join(queries.change_flags(tables), "rc_id", "left")
    df = df.join(queries.revision_scores(tables),
                 queries.revision_key() == F.col("oresc_rev"), "left").drop("oresc_rev")
    return finished(queries.with_comment(queries.with_editor(df, tables), tables))


def finished(joined: DataFrame) -> DataFrame:
    """Joined changes with the summary parsed; a change without flags has neither."""
    return with_summary(joined).withColumns({
        "reverted": F.coalesce("reverted", F.lit(False)),
        "suggested_edit": F.coalesce("suggested_edit", F.lit(False)),
    }).select(*ENRICHED_COLUMNS)


def patrol_progress(changes: DataFrame, log: DataFrame) -> DataFrame:
    """Term edits with the patrol entries of their revision and the delay until each. A revision
    with several entries has a row for each, one without has a row with nulls."""
    terms = changes.filter(F.col("summary_category").isin(TERM_CATEGORIES)).select(
        "rc_id", "rc_this_oldid", F.col("summary_param1").alias("language"),
        F.col("summary_category").alias("category"), "actor_name", "time")
    delay = seconds_between(F.col("time"), F.col("log_time"))
    return (
        terms.join(log.filter(F.col("rc_curid").isNotNull()),
                   queries.revision_key() == F.col("rc_curid"), "left")
        .select(*terms.columns, "log_id", "patroller", "log_time",
                delay.alias("delay_seconds"), (delay / 3600.0).alias("delay_hours"))
    )
