"""Facts about items and properties from a table of triples, and reports that use them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Predicates of the triples table.
PREDICATE_STATEMENTS = "statements"
PREDICATE_IDENTIFIERS = "identifiers"
PREDICATE_SITELINKS = "sitelinks"
PREDICATE_TYPE = "propertyType"
PREDICATE_LABEL = "label@"
NO_BACKLINK = ["about", "sameAs"]
#: Predicates whose objects are texts and numbers, as are those of labels.
LITERALS = [PREDICATE_STATEMENTS, PREDICATE_IDENTIFIERS, PREDICATE_SITELINKS, PREDICATE_TYPE]


def _is_link() -> Column:
    predicate = F.col("predicate")
    return ~predicate.isin(NO_BACKLINK + LITERALS) & ~predicate.startswith(PREDICATE_LABEL)


def _attributes(triples: DataFrame, names: dict[str, str]) -> DataFrame:
    """One row per subject with a column per predicate."""
    return triples.filter(F.col("predicate").isin(list(names))).groupBy("subject").agg(*[
        F.max(F.when(F.col("predicate") == predicate, F.col("object"))).alias(column)
        for predicate, column in names.items()])


def item_facts(triples: DataFrame, items: DataFrame, language: str = "en") -> DataFrame:
    """Label, sizes and number of distinct subjects that point to each of ``items`` (column
    ``item``). Items without one of the sizes are left out; the label falls back to the id.

    The triples are cut to the asked-for items before anything is grouped, and literals are no links. Backlinks are counted
    distinct by (item, subject) first, so an item with very many does not gather in one task.
    """
    items = items.select("item").distinct()
    label = f"{PREDICATE_LABEL}{language}"
    names = {PREDICATE_STATEMENTS: "statements", PREDICATE_IDENTIFIERS: "identifiers",
             PREDICATE_SITELINKS: "sitelinks", label: "label"}
    own = _attributes(
        triples.join(items, F.col("subject") == F.col("item"), "left_semi"), names)
    backlinks = (
        triples.filter(_is_link())
        .join(items, F.col("object") == F.col("item"), "left_semi")
        .groupBy(F.col("object").alias("subject")).agg(F.count_distinct("subject").alias("backlinks"))
    )
    sizes = ["statements", "identifiers", "sitelinks"]
    return (
        own.dropna(subset=sizes).join(backlinks, "subject", "left")
        .select(F.col("subject").alias("item"), F.coalesce("label", "subject").alias("label"),
                *[F.col(s).try_cast("bigint").alias(s) for s in sizes],
                F.coalesce("backlinks", F.lit(0)).alias("backlinks"))
    )


def property_facts(triples: DataFrame, language: str = "en") -> DataFrame:
    """Label and data type of every property that has a type."""
    label = f"{PREDICATE_LABEL}{language}"
    return (
        _attributes(triples, {PREDICATE_TYPE: "type", label: "label"})
        .filter(F.col("type").isNotNull())
        .select(F.col("subject").alias("property"), F.coalesce("label", "subject").alias("label"),
                F.substring_index("type", "#", -1).alias("data_type"))
    )


def deletion_request_items(changes: DataFrame, links: DataFrame, triples: DataFrame) -> DataFrame:
    """Changed items that a deletion request links: share of reviewed changes, number of changes and
    the item's facts."""
    counted = changes.groupBy("rc_title").agg(
        (F.sum("rc_patrolled") / F.count("rc_patrolled")).alias("reviewed_share"),
        F.count(F.lit(1)).alias("changes"))
    linked = counted.join(links, F.col("rc_title") == F.col("title"), "left_semi")
    facts = item_facts(triples, links.select(F.col("title").alias("item")))
    return linked.join(facts, F.col("rc_title") == F.col("item")).drop("item")
