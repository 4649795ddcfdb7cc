"""Reports from tables stored by day or bucketed by change. They equal those from plain tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from changewatch.config import Settings
from changewatch.functions.values import stamp_literal
from changewatch.operators import enrich
from changewatch.plans import incremental, sketched, trends
from changewatch.sources import layout, queries, reduced
from changewatch.sources.readers import Tables


def patrol_log_by_day(spark: SparkSession, tables: Tables) -> DataFrame:
    folder = layout.work_folder(spark)
    layout.store_by_day(tables, folder)
    return layout.patrol_log(spark, tables, folder)


def edits_by_day(spark: SparkSession, tables: Tables, settings: Settings) -> DataFrame:
    """Changes by date in the window, whose days alone are read."""
    folder = layout.work_folder(spark)
    layout.store_by_day(tables, folder, ["recentchanges"])
    window = stamp_literal(settings.window_start), stamp_literal(settings.today)
    return trends.edits(enrich.changes(layout.bounded(spark, tables, folder, {"recentchanges": window})), "date", settings)


def colocated_changes(spark: SparkSession, tables: Tables, buckets: int = 8) -> DataFrame:
    folder = layout.work_folder(spark)
    name = "colocated_" + folder.rsplit("/", 1)[1]
    return layout.Colocated(spark, folder, name, buckets).store(tables).changes()


def _kept(df: DataFrame, name: str, folder: str) -> DataFrame:
    df.write.parquet(f"{folder}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")


def editors_by_span(spark: SparkSession, changes: DataFrame, settings: Settings) -> DataFrame:
    by_day = _kept(sketched.editor_sketches(changes, settings), "editors", layout.work_folder(spark))
    return sketched.editors_by_span(changes, by_day, settings)


def delay_percentiles(spark: SparkSession, progress: DataFrame) -> DataFrame:
    by_day = _kept(sketched.delay_sketches(progress), "delays", layout.work_folder(spark))
    return sketched.delay_percentiles_checked(progress, by_day)


def most_frequent(spark: SparkSession, changes: DataFrame, settings: Settings) -> DataFrame:
    folder = layout.work_folder(spark)
    by_day = {what: _kept(sketched.frequent_by_day(rows, value), what, folder)
              for what, (rows, value) in sketched.frequent_lists(changes).items()}
    return sketched.most_frequent(changes, by_day, settings)


def worklists(spark: SparkSession, changes: DataFrame, settings: Settings) -> DataFrame:
    partials = incremental.DayPartials(spark, f"{layout.work_folder(spark)}/partials")
    partials.refresh(changes)
    return incremental.worklists(partials.read(), changes, settings)


def scores_in_scope(spark: SparkSession, tables: Tables) -> DataFrame:
    """Scores of revisions in scope, from stored tables of which a filter drops the rest at the scan."""
    folder = layout.work_folder(spark)
    kept = {name: _kept(tables[name], name, folder) for name in ("recentchanges", "score", "score_model")}
    stored = tables.replaced({name: lambda n=name: kept[n] for name in kept})
    with reduced.scope_filters(spark, reduced.keys_in_scope(stored), least_scan="0"):
        return _kept(queries.revision_scores(stored), "scores", folder)
