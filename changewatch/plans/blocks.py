"""Open changes by editors who were blocked before, or whose address lies in a blocked range."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, functions as F

from changewatch.config import Settings
from changewatch.functions import ip
from changewatch.functions.values import time_literal
from changewatch.operators.ranges import match_ranges, range_pieces

ADDRESS_TYPES = ["ipv4", "ipv6"]
RANGE_TYPES = ["ipv4range", "ipv6range"]


def is_recent(settings: Settings) -> Column:
    return F.col("time") > time_literal(
        settings.as_of - timedelta(days=settings.block_age_days))


def _open_edits(changes: DataFrame) -> DataFrame:
    """Open changes by editor: one row per editor from here on, so later joins are not skewed."""
    return changes.filter("rc_patrolled = 0").groupBy("actor_name").agg(F.count(F.lit(1)).alias("edits"))


def _block_counts(history: DataFrame, types: list[str], settings: Settings,
                  recent: bool) -> DataFrame:
    """Number of blocks of all time by name, of names with a block (within the age limit)."""
    counted = (
        history.filter(F.col("user_type").isin(types)).groupBy("user_name")
        .agg(F.count("time").alias("block_cnt"), F.count_if(is_recent(settings)).alias("recent"),
             F.count(F.lit(1)).alias("entries"))
    )
    return counted.filter(F.col("recent" if recent else "entries") > 0) \
        .select("user_name", "block_cnt")


def registered(changes: DataFrame, history: DataFrame, current: DataFrame, settings: Settings,
               recent: bool = False) -> DataFrame:
    """Accounts with a block (in the last year if ``recent``): open changes, blocks of all time and
    the block in force."""
    blocks = _block_counts(history, ["registered"], settings, recent)
    return (
        _open_edits(changes).join(blocks, F.col("actor_name") == F.col("user_name"))
        .join(current.select("user_name", "is_blocked"), "user_name", "left")
        .select("actor_name", "edits", "block_cnt", "is_blocked")
    )


def _past_ranges(history: DataFrame, settings: Settings) -> DataFrame:
    """Ranges of past blocks, one row each. A range that was blocked twice counts twice."""
    past = history.filter(F.col("user_type").isin(RANGE_TYPES))
    return past.select("low", "high", F.lit(True).alias("past"), is_recent(settings).alias("recent"),
                       F.lit(None).cast("boolean").alias("infinite"))


def _ranges_in_force(current: DataFrame) -> DataFrame:
    """Ranges that are blocked now, and whether the block never ends."""
    return current.filter(F.col("range_start") < F.col("range_end")).select(
        ip.strip_mark(F.col("range_start")).alias("low"),
        ip.strip_mark(F.col("range_end")).alias("high"), F.lit(False).alias("past"),
        F.lit(False).alias("recent"), (F.col("is_blocked") == "infinity").alias("infinite"))


def with_range_blocks(editors: DataFrame, history: DataFrame, current: DataFrame,
                      settings: Settings) -> DataFrame:
    """Editors with an address, its columns ``digits`` exchanged for range_blocks_all, range_blocks_1y (past range blocks
    that contain the address) and is_range_blocked: infinity if any such range in force never ends,
    temporary if there is another. Past and present ranges are matched in one go."""
    ranges = _past_ranges(history, settings).union(_ranges_in_force(current))
    pieces = range_pieces(ranges, "low", "high", {
        "range_blocks_all": F.count_if("past"), "range_blocks_1y": F.count_if("recent"),
        "infinite": F.bool_or("infinite")})
    columns = [c for c in editors.columns if c != "digits"]
    matched = match_ranges(editors, columns, "digits", pieces, {
        "range_blocks_all": F.coalesce(F.sum("range_blocks_all"), F.lit(0)),
        "range_blocks_1y": F.coalesce(F.sum("range_blocks_1y"), F.lit(0)),
        "infinite": F.bool_or("infinite")}, keep=True)
    in_force = F.when(F.col("infinite"), "infinity").when(F.col("infinite").isNotNull(), "temporary")
    return matched.withColumn("is_range_blocked", in_force).drop("infinite")


def addresses_with_ranges(changes: DataFrame, history: DataFrame, current: DataFrame,
                          settings: Settings) -> DataFrame:
    """Addresses with open changes, all and those made without an account, and what ranges they lie in."""
    editors = changes.filter("rc_patrolled = 0").groupBy("actor_name").agg(
        F.count(F.lit(1)).alias("all_edits"), F.count_if(F.col("actor_user").isNull()).alias("anon_edits"))
    editors = ip.with_address_hex(editors, "actor_name").filter(F.col("digits").isNotNull())
    return with_range_blocks(editors, history, current, settings)


def anonymous(changes: DataFrame, history: DataFrame, current: DataFrame, settings: Settings,
              recent: bool = False, compat: bool = False,
              addresses: DataFrame | None = None) -> DataFrame:
    """Addresses that were blocked themselves or lie in a range that was (in the last year if
    ``recent``): open changes, own blocks of all time, range blocks and what is in force now.

    Changes are read once: one row per editor holds all its open changes and those made without an
    account; ranges count for the latter. ``addresses`` are those of ``addresses_with_ranges``, if they are
    stored already. ``compat``: an address that is listed for a range only gets no block of its own
    in force.
    """
    range_column = "range_blocks_1y" if recent else "range_blocks_all"
    if addresses is None:
        addresses = addresses_with_ranges(changes, history, current, settings)
    own = _block_counts(history, ADDRESS_TYPES, settings, recent)
    direct = current.filter(F.col("range_start") == F.col("range_end")) \
        .select(F.col("user_name").alias("direct_name"), "is_blocked")
    has_own = F.col("block_cnt").isNotNull()
    in_ranges = F.when(F.col("anon_edits") > 0, F.col(range_column)).otherwise(0)
    listed = (
        addresses.join(own, F.col("actor_name") == F.col("user_name"), "left")
        .withColumn(range_column, in_ranges).filter(has_own | (F.col(range_column) > 0))
    )
    match = F.col("actor_name") == F.col("direct_name")
    if compat:
        match = match & has_own
    return listed.join(direct, match, "left").select(
        "actor_name", F.when(has_own, F.col("all_edits")).otherwise(F.col("anon_edits")).alias("edits"),
        F.coalesce("block_cnt", F.lit(0)).alias("block_cnt"), range_column,
        (F.coalesce("block_cnt", F.lit(0)) + F.col(range_column)).alias("total_blocks"),
        "is_blocked", "is_range_blocked")


def address_order(name: str = "actor_name") -> list[Column]:
    """Sort columns for addresses by their number, IPv4 first."""
    digits = ip.address_hex(F.col(name))
    return [F.length(digits), digits]
