"""Histograms whose bins follow the range of the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from changewatch.functions.values import equal_width_bin


def _models(bins: int, suffixes: dict[str, str]) -> Column:
    return F.explode(F.array(*[
        F.struct(F.lit(model).alias("model"),
                 equal_width_bin(F.col(column), F.col(f"{model}_low"), F.col(f"{model}_high"), bins)
                 .alias("bin"))
        for model, column in suffixes.items()]))


def score_histogram(df: DataFrame, editor: Column, group: Column, scores: dict[str, str],
                    bins: int) -> DataFrame:
    """(editor, model, group_key, bin, n, revisions) over rows that have all scores.

    ``scores`` maps a model name to its column. Every (editor, group) has its own bins, from its
    smallest to its largest score. ``revisions`` counts the rows of the editor kind, also those
    without a group. Equal scores are counted before anything else, so a group that holds most of the
    rows is a small table; ranges and bins are taken from that one.
    """
    scored = df.withColumns({"editor": editor, "group_key": group})
    for column in scores.values():
        scored = scored.filter(F.col(column).isNotNull())
    counted = scored.groupBy("editor", "group_key", *scores.values()) \
        .agg(F.count(F.lit(1)).alias("rows"))
    group_rows = Window.partitionBy("editor", "group_key")
    ranged = counted.withColumns({
        "revisions": F.sum("rows").over(Window.partitionBy("editor")),
        **{f"{model}_{end}": f(F.col(column)).over(group_rows)
           for model, column in scores.items() for end, f in (("low", F.min), ("high", F.max))},
    }).filter(F.col("group_key").isNotNull())

    return (
        ranged.select("editor", "group_key", "revisions", "rows", _models(bins, scores).alias("cell"))
        .groupBy("editor", "cell.model", "group_key", "cell.bin", "revisions")
        .agg(F.sum("rows").alias("n"))
        .select("editor", "model", "group_key", "bin", "n", "revisions")
    )


def score_heatmap(df: DataFrame, editor: Column, x: str, y: str, bins: int) -> DataFrame:
    """(editor, x_bin, y_bin, n, revisions, max_cell): filled cells of a square grid from the
    smallest to the largest score, per editor kind."""
    scored = df.withColumn("editor", editor) \
        .filter(F.col(x).isNotNull() & F.col(y).isNotNull()).select("editor", x, y)
    whole = Window.partitionBy("editor")
    ranged = scored.groupBy("editor", x, y).agg(F.count(F.lit(1)).alias("rows")).withColumns({
        "revisions": F.sum("rows").over(whole),
        "x_low": F.min(x).over(whole), "x_high": F.max(x).over(whole),
        "y_low": F.min(y).over(whole), "y_high": F.max(y).over(whole)})
    x_bin = equal_width_bin(F.col(x), F.col("x_low"), F.col("x_high"), bins)
    y_bin = equal_width_bin(F.col(y), F.col("y_low"), F.col("y_high"), bins)
    cells = (
        ranged.groupBy("editor", x_bin.alias("x_bin"), y_bin.alias("y_bin"), "revisions")
        .agg(F.sum("rows").alias("n"))
    )
    # at most bins * bins rows per editor kind
    return cells.withColumn("max_cell", F.max("n").over(Window.partitionBy("editor"))) \
        .select("editor", "x_bin", "y_bin", "n", "revisions", "max_cell")


def bin_step(maximum: Column) -> Column:
    """Width in hours of a delay bin, from the longest delay. Fixed values."""
    return (
        F.when(maximum <= 24, 1).when(maximum <= 48, 2).when(maximum <= 96, 6)
        .when(maximum <= 168, 12).when(maximum <= 336, 24).otherwise(48)
    )


def delay_histogram(df: DataFrame, key: str, seconds: str, overflow: bool = False) -> DataFrame:
    """(key, bin_start, bin_end, n) with bins in whole hours from 0.

    The step follows the longest delay of the key, rounded up to an hour. The last edge is the last
    multiple of the step that is not above it; the last bin holds its upper edge, and longer or
    negative delays are left out, or with ``overflow`` counted in a row without bin ends. Every step is a multiple of one hour, so delays are first counted
    by hour; the rest works on that small table, whatever share of the rows one key has.
    """
    delay = F.col(seconds)
    hourly = (
        df.filter(F.col(key).isNotNull() & delay.isNotNull())
        .groupBy(key, F.floor(delay / 3600.0).alias("hour"),
                 (F.pmod(delay, F.lit(3600)) == 0).alias("on_edge"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    longest = F.max(F.when(F.col("on_edge"), F.col("hour")).otherwise(F.col("hour") + 1)) \
        .over(Window.partitionBy(key))
    last = F.floor(F.col("maximum") / F.col("step")) * F.col("step")
    start = F.floor(F.col("hour") / F.col("step")) * F.col("step")
    inside = (F.col("hour") >= 0) & (F.col("last") > 0) & (
        (F.col("hour") < F.col("last")) | ((F.col("hour") == F.col("last")) & F.col("on_edge")))
    return (
        hourly.withColumn("maximum", longest).withColumn("step", bin_step(F.col("maximum")))
        .withColumn("last", last)
        .filter(F.lit(overflow) | inside)
        .withColumn("bin_start", F.when(
            inside, F.least(start, F.col("last") - F.col("step")).cast("bigint")))
        .groupBy(key, "bin_start", (F.col("bin_start") + F.col("step")).cast("bigint")
                 .alias("bin_end"))
        .agg(F.sum("n").alias("n"))
    )
