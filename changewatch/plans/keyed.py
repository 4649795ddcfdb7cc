"""Worklists of open changes for every language, project, property, action or namespace.

Each is one DataFrame with the key as a column, for one partitioned write. The number of keys does
not matter: no step runs once per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from changewatch.functions.actions import actions_of

ROW_COLUMNS = ["rc_id", "rc_timestamp", "rc_title", "rc_this_oldid", "actor_name",
               "oresc_damaging", "oresc_goodfaith", "summary_action"]
SIDE_COLUMNS = ["rc_id", "rc_timestamp", "rc_title", "rc_this_oldid", "actor_name", "namespace",
                "rc_source"]

# Namespaces that get no worklist.
SKIPPED_NAMESPACES = ["Topic", "Translations"]


def _keyed(changes: DataFrame, condition: Column, key: Column, name: str) -> DataFrame:
    return (
        changes.filter((F.col("rc_patrolled") == 0) & condition)
        .select(*ROW_COLUMNS, key.alias(name)).filter(F.col(name).isNotNull())
    )


def _has_action(*names: str) -> Column:
    return F.col("summary_action").isin(actions_of(*names))


def terms_by_language(changes: DataFrame) -> DataFrame:
    return _keyed(changes, _has_action("terms"), F.col("summary_param1"), "language")


def entity_terms_by_language(changes: DataFrame) -> DataFrame:
    """A row for each language that the change names; a language named twice counts once."""
    languages = F.array_distinct(F.split("summary_param2", ", "))
    return _keyed(changes, F.col("summary_category") == "editentity", F.explode(languages), "language")


def entity_create_by_language(changes: DataFrame) -> DataFrame:
    return _keyed(changes, F.col("summary_action") == "wbeditentity-create",
                  F.col("summary_param1"), "language")


def sitelinks_by_project(changes: DataFrame) -> DataFrame:
    return _keyed(changes, _has_action("sitelink"), F.col("summary_param1"), "project")


def page_moves_by_project(changes: DataFrame) -> DataFrame:
    return _keyed(changes, _has_action("sitelinkmove"), F.col("summary_param1"), "project")


def page_removals_by_project(changes: DataFrame) -> DataFrame:
    return _keyed(changes, _has_action("sitelinkmove") & F.col("summary_param1").isNull(),
                  F.col("summary_param2"), "project")


def entity_edits_by_action(changes: DataFrame) -> DataFrame:
    return _keyed(changes, _has_action("editentity"), F.col("summary_action"), "action")


def claims_by_property(changes: DataFrame) -> DataFrame:
    return _keyed(changes, _has_action("allclaims"), F.col("summary_property"), "property")


def side_namespace_worklist(side_changes: DataFrame, translation_pages: DataFrame) -> DataFrame:
    """Open changes of existing revisions outside the main namespace, without translation pages and
    the namespaces that are looked after elsewhere."""
    full_title = F.concat("namespace", F.lit(":"), "rc_title")
    return (
        side_changes.filter((F.col("rc_patrolled") == 0) & (F.col("rc_this_oldid") != 0)
                            & F.col("namespace").isNotNull()
                            & ~F.col("namespace").isin(SKIPPED_NAMESPACES))
        .withColumn("full_title", full_title)
        .join(translation_pages, F.col("full_title") == F.col("translation_page"), "left_anti")
        .select(*SIDE_COLUMNS)
    )


# name -> (report, key column, further sort columns within a key)
KEYED_REPORTS = {
    "terms_by_language": (terms_by_language, "language", ["actor_name"]),
    "entity_terms_by_language": (entity_terms_by_language, "language", ["actor_name"]),
    "entity_create_by_language": (entity_create_by_language, "language", ["actor_name"]),
    "sitelinks_by_project": (sitelinks_by_project, "project", []),
    "page_moves_by_project": (page_moves_by_project, "project", []),
    "page_removals_by_project": (page_removals_by_project, "project", []),
    "entity_edits_by_action": (entity_edits_by_action, "action", []),
    "claims_by_property": (claims_by_property, "property", []),
}
