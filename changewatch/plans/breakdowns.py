"""Review status by category, language, property and project; changes by item number."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from changewatch.config import Settings
from changewatch.functions.actions import OTHER_CATEGORIES, actions_of
from changewatch.operators.counts import status_breakdown, status_totals
from changewatch.plans.items import property_facts
from changewatch.plans.trends import in_window


def _with_action(changes: DataFrame, *names: str) -> DataFrame:
    return changes.filter(F.col("summary_action").isin(actions_of(*names)))


def category_by_status(changes: DataFrame, settings: Settings) -> DataFrame:
    return status_breakdown(changes.filter(in_window(settings)), "summary_category", "category",
                            settings.min_category_total)


def language_by_status(changes: DataFrame, settings: Settings) -> DataFrame:
    return status_breakdown(_with_action(changes, "terms"), "summary_param1", "language",
                            settings.min_language_total)


def language_totals(changes: DataFrame) -> DataFrame:
    return status_totals(_with_action(changes, "terms"), "summary_param1", "language")


def property_by_status(changes: DataFrame, settings: Settings) -> DataFrame:
    return status_breakdown(_with_action(changes, "allclaims"), "summary_property", "property",
                            settings.min_property_total)


def property_totals(changes: DataFrame, triples: DataFrame) -> DataFrame:
    """Totals of the properties that have facts, with label and data type."""
    totals = status_totals(_with_action(changes, "allclaims"), "summary_property", "property")
    return totals.join(property_facts(triples), "property")


def sitelink_by_status(changes: DataFrame, settings: Settings) -> DataFrame:
    return status_breakdown(_with_action(changes, "allsitelinks"), "summary_param1", "project",
                            settings.min_sitelink_total)


def sitelink_totals(changes: DataFrame) -> DataFrame:
    return status_totals(_with_action(changes, "allsitelinks"), "summary_param1", "project")


def other_actions_by_status(changes: DataFrame) -> DataFrame:
    return status_breakdown(_with_action(changes, *OTHER_CATEGORIES), "summary_category", "category") \
        .drop("total")


def item_bins_by_revision(changes: DataFrame, settings: Settings, compat: bool = False) -> DataFrame:
    """Changes by bin of the item number, in three classes that do not overlap: reverted, else open,
    else reviewed.

    ``compat`` gives the counts of older charts instead: open includes the reverted ones, reviewed
    takes in reverted open ones and leaves out reverted reviewed ones, bins without an open change
    are missing and a class without a change is null.
    """
    is_open, reverted = F.col("rc_patrolled") == 0, F.col("reverted")
    if compat:
        open_, reviewed = is_open, is_open == reverted
    else:
        open_, reviewed = is_open & ~reverted, ~is_open & ~reverted
    bins = (
        changes.filter(F.col("num_title").isNotNull())
        .groupBy(F.floor(F.col("num_title") / F.lit(settings.item_bin_size)).alias("bin"))
        .agg(F.count_if(open_).alias("open"), F.count_if(reviewed).alias("reviewed"),
             F.count_if(reverted).alias("reverted"))
    )
    if compat:
        bins = bins.filter(F.col("open") > 0).withColumns({
            name: F.nullif(F.col(name), F.lit(0)) for name in ("reviewed", "reverted")})
    return bins


def item_bins_by_item(changes: DataFrame, settings: Settings) -> DataFrame:
    """Distinct items with changes by bin of the item number."""
    return (
        changes.filter(F.col("num_title").isNotNull()).select("num_title").distinct()
        .groupBy(F.floor(F.col("num_title") / F.lit(settings.item_bin_size)).alias("bin"))
        .agg(F.count(F.lit(1)).alias("items"))
    )
