"""Distribution of the quality scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from changewatch.config import Settings
from changewatch.functions.actions import TERM_CATEGORIES, actions_of
from changewatch.functions.values import editor_name, status_name
from changewatch.operators.histograms import score_heatmap, score_histogram

SCORES = {"damaging": "oresc_damaging", "goodfaith": "oresc_goodfaith"}


def _editor():
    return editor_name(F.col("actor_user"))


def by_status(changes: DataFrame, settings: Settings) -> DataFrame:
    return score_histogram(changes, F.lit("all"), status_name(F.col("rc_patrolled")), SCORES,
                           settings.histogram_bins)


def by_editor(changes: DataFrame, settings: Settings) -> DataFrame:
    return score_histogram(changes, F.lit("all"), _editor(), SCORES, settings.histogram_bins)


def by_category(changes: DataFrame, settings: Settings) -> DataFrame:
    return score_histogram(changes, _editor(), F.col("summary_category"), SCORES,
                           settings.histogram_bins)


def by_reverted(changes: DataFrame, settings: Settings) -> DataFrame:
    group = F.when(F.col("reverted"), "reverted").otherwise("not reverted")
    return score_histogram(changes, _editor(), group, SCORES, settings.histogram_bins)


def top_languages(changes: DataFrame, settings: Settings) -> DataFrame:
    """The languages with the most term edits; ties go by name."""
    return (
        changes.filter(F.col("summary_action").isin(actions_of("terms"))
                       & F.col("summary_param1").isNotNull())
        .groupBy("summary_param1").agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "summary_param1").limit(settings.top_languages)
    )


def by_language(changes: DataFrame, settings: Settings) -> DataFrame:
    """Term edits in the top languages."""
    terms = changes.filter(F.col("summary_action").isin(actions_of("terms")))
    # the list of top languages has at most ``settings.top_languages`` rows
    top = F.broadcast(top_languages(changes, settings).select("summary_param1"))
    return score_histogram(terms.join(top, "summary_param1", "left_semi"), _editor(),
                           F.col("summary_param1"), SCORES, settings.histogram_bins)


def by_term_type(changes: DataFrame, settings: Settings) -> DataFrame:
    terms = changes.filter(F.col("summary_category").isin(TERM_CATEGORIES))
    return score_histogram(terms, _editor(), F.col("summary_category"), SCORES,
                           settings.histogram_bins)


def heatmap(changes: DataFrame, settings: Settings) -> DataFrame:
    cells = score_heatmap(changes, _editor(), "oresc_damaging", "oresc_goodfaith",
                          settings.histogram_bins)
    return cells.withColumnsRenamed({"x_bin": "damaging_bin", "y_bin": "goodfaith_bin"})
