"""The scheduled batch run: enrich once, write the table, then write every report from it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from changewatch.config import Settings
from changewatch.operators import enrich
from changewatch.plans import blocks, breakdowns, items, keyed, progress, scores, trends, worklists
from changewatch.sinks import files
from changewatch.sources import queries, reduced
from changewatch.sources.readers import Tables


class Work:
    """Tables that reports start from, as files that outlive executors, in a folder of this run. It is below
    ``folder`` or else below the one the cluster names in ``spark.checkpoint.dir``, and goes when the run ends."""

    def __init__(self, spark: SparkSession, folder: str | None):
        base = folder or spark.conf.get("spark.checkpoint.dir", None)
        if base is None:
            raise ValueError("name a folder for intermediate tables, shared by all machines")
        self.spark, self.path = spark, f"{base.rstrip('/')}/run-{uuid.uuid4().hex}"

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.path}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")

    def __enter__(self) -> Work:
        return self

    def __exit__(self, *_: object) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def run(spark: SparkSession, tables: Tables, settings: Settings, out: str, work: str | None = None) -> None:
    """Write all reports to ``out``. ``work`` is a folder that all machines share."""
    with Work(spark, work) as folder:
        write_reports(spark, tables, settings, out, folder)


def write_reports(spark: SparkSession, tables: Tables, settings: Settings, out: str, work: Work) -> None:
    with reduced.scope_filters(spark, reduced.keys_in_scope(tables)):
        changes = work.stored(enrich.changes(tables), "changes")
    since = changes.agg(F.min("rc_timestamp")).scalar()
    log = work.stored(queries.patrol_log(tables, since), "patrol-log")
    delays = work.stored(enrich.patrol_progress(changes, log), "patrol-progress")
    history = work.stored(queries.block_history(tables), "block-history")
    current = work.stored(queries.current_blocks(tables), "current-blocks")
    addresses = work.stored(blocks.addresses_with_ranges(changes, history, current, settings), "addresses")
    triples, c = tables["triples"], F.col

    for unit in ("date", "weekday", "hour"):
        files.write_table(trends.edits(changes, unit, settings), f"{out}/edits-by-{unit}")
        files.write_table(trends.patrol_status(changes, unit, settings), f"{out}/status-by-{unit}")
        files.write_table(trends.editors(changes, unit, settings), f"{out}/editors-by-{unit}")
    for name, table in {
        "sources-by-date": trends.sources_by_date(changes, settings),
        "categories-by-date": trends.categories_by_date(changes, settings),
        "reverted-by-date": trends.reverted_by_date(changes, settings),
        "remaining-by-date": trends.remaining_by_date(changes, settings),
        "category-by-status": breakdowns.category_by_status(changes, settings),
        "language-by-status": breakdowns.language_by_status(changes, settings),
        "property-by-status": breakdowns.property_by_status(changes, settings),
        "sitelink-by-status": breakdowns.sitelink_by_status(changes, settings),
        "other-actions-by-status": breakdowns.other_actions_by_status(changes),
        "item-bins-by-revision": breakdowns.item_bins_by_revision(changes, settings),
        "item-bins-by-item": breakdowns.item_bins_by_item(changes, settings),
        "scores-by-editor": scores.by_editor(changes, settings),
        "scores-by-category": scores.by_category(changes, settings),
        "scores-by-reverted": scores.by_reverted(changes, settings),
        "scores-by-language": scores.by_language(changes, settings),
        "scores-by-term-type": scores.by_term_type(changes, settings),
        "score-heatmap": scores.heatmap(changes, settings),
        "language-totals": breakdowns.language_totals(changes).orderBy(
            c("total").desc(), c("open").desc(), "language"),
        "property-totals": breakdowns.property_totals(changes, triples).orderBy(
            c("total").desc(), c("open").desc(), "label", "property"),
        "sitelink-totals": breakdowns.sitelink_totals(changes).orderBy(
            c("total").desc(), c("open").desc(), "project"),
        "tags": worklists.tag_counts(queries.change_tags(tables)).orderBy(c("n").desc(), "ctd_name"),
        "deletion-request-items": items.deletion_request_items(
            changes, tables["request_links"], triples),
        "unpatrolled-by-language": progress.unpatrolled(delays),
        "delays-by-language": progress.describe(delays),
        "delay-histogram-by-language": progress.histogram(delays),
        "delay-percentiles-by-language": progress.percentiles(delays),
    }.items():
        files.write_table(table, f"{out}/{name}")

    files.write_keyed_report(
        worklists.worklists(changes, worklists.spans(settings)), f"{out}/worklist", "span",
        [c("edits_unpatr").desc(), c("edits_patr").desc(), c("actor_name")], settings.head_rows)
    for name, table, order in (
        ("worklist-scores-anon", worklists.score_worklist(changes, False, settings),
         [c("damaging").desc(), c("actor_name")]),
        ("worklist-scores-registered", worklists.score_worklist(changes, True, settings),
         [c("damaging").desc(), c("actor_name")]),
        ("worklist-items-many-revisions", worklists.items_many_revisions(changes, settings),
         [c("edits").desc(), c("rc_title")]),
        ("worklist-users-many-creations", worklists.users_many_creations(changes),
         [c("creations").desc(), c("actor_name")]),
        ("worklist-highly-used-items",
         worklists.highly_used_items(changes, tables["entity_usage"], settings),
         [c("entity_usage_count").desc(), c("rc_title").desc()]),
        ("worklist-uncategorized", worklists.uncategorized_summaries(changes), [c("rc_id")]),
    ):
        files.write_report(work.stored(table, name), f"{out}/{name}", order, settings.head_rows)
    for suffix, recent in (("all", False), ("1y", True)):
        files.write_report(
            work.stored(blocks.registered(changes, history, current, settings, recent), f"registered-{suffix}"),
            f"{out}/blocked-registered-{suffix}", [c("edits").desc(), c("actor_name")],
            settings.head_rows)
        files.write_report(
            work.stored(blocks.anonymous(changes, history, current, settings, recent, addresses=addresses),
                        f"anon-{suffix}"),
            f"{out}/blocked-anon-{suffix}", [c("edits").desc(), *blocks.address_order()],
            settings.head_rows)
    files.write_report(work.stored(worklists.top_patrollers(changes, log), "patrollers"), f"{out}/top-patrollers",
                       [c("patrols").desc(), c("patroller")], settings.head_rows_patrollers)

    for name, (report, key, order) in keyed.KEYED_REPORTS.items():
        files.write_keyed_report(work.stored(report(changes), name), f"{out}/{name}", key,
                                 [*map(c, order), c("rc_id")], settings.head_rows)
    files.write_keyed_report(
        keyed.side_namespace_worklist(queries.side_namespace_changes(tables),
                                      queries.translation_pages(tables)),
        f"{out}/side-namespaces", "namespace", [c("rc_id")], settings.head_rows)
    files.write_keyed_report(progress.patrollers(delays), f"{out}/patrollers-by-language", "language",
                             [c("patrols").desc(), c("patroller")], settings.head_rows)

    files.write_progress(worklists.progress_totals(changes, log), f"{out}/progress")
    files.write_progress(worklists.progress_today(changes, settings), f"{out}/progress-today")
    files.write_action_map(spark, f"{out}/actions")
    files.write_last_update(spark, settings.as_of, f"{out}/update")
