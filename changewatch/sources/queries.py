"""Source queries: the tables cut down to the rows and columns that reports use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from changewatch.functions import ip
from changewatch.functions.values import item_number, parse_time
from changewatch.sources.readers import Tables

CHANGE_COLUMNS = [
    "rc_id", "rc_timestamp", "rc_title", "rc_source", "rc_patrolled", "rc_new_len", "rc_old_len",
    "rc_this_oldid",
]

# Tags and score models that changes are enriched with, and log parameters.
TAG_REVERTED = "mw-reverted"
TAG_SUGGESTED = "apps-suggested-edits"
MODEL_DAMAGING = "damaging"
MODEL_GOODFAITH = "goodfaith"
REVISION_IN_PARAMS = r'"4::curid";(?:s:\d+:"|i:)(\d+)'
TRANSLATION_NAMESPACE = 1198


def in_review_scope() -> Column:
    """Changes that need, or have had, a review by hand."""
    return F.col("rc_patrolled").isin(0, 1)


def revision_key() -> Column:
    """The revision of a change to join on. Changes without one have 0 there, many of them; as null they
    are kept out of the joins instead of meeting in one task."""
    return F.nullif("rc_this_oldid", F.lit(0)).alias("revision")


def with_editor(changes: DataFrame, tables: Tables) -> DataFrame:
    return changes.join(tables["actor"], F.col("rc_actor") == F.col("actor_id")) \
        .drop("rc_actor", "actor_id")


def with_comment(changes: DataFrame, tables: Tables) -> DataFrame:
    return changes.join(tables["comment"], F.col("rc_comment_id") == F.col("comment_id")) \
        .drop("rc_comment_id", "comment_id")


def with_derived(changes: DataFrame) -> DataFrame:
    return changes.withColumns({
        "time": parse_time(F.col("rc_timestamp")),
        "len_diff": F.col("rc_new_len") - F.col("rc_old_len"),
    })


def main_namespace_changes(tables: Tables) -> DataFrame:
    """Changes in scope in the main namespace, before the editor and comment are joined."""
    scoped = tables["recentchanges"].filter(in_review_scope() & (F.col("rc_namespace") == 0))
    return with_derived(scoped.select(*CHANGE_COLUMNS, "rc_actor", "rc_comment_id")) \
        .withColumn("num_title", item_number(F.col("rc_title")))


def side_namespace_changes(tables: Tables) -> DataFrame:
    """Changes in scope outside the main namespace, with the namespace name."""
    scoped = tables["recentchanges"].filter(in_review_scope() & (F.col("rc_namespace") != 0))
    scoped = with_derived(
        scoped.select(*CHANGE_COLUMNS, "rc_namespace", "rc_actor", "rc_comment_id"))
    names = tables["namespaces"].select(
        F.col("id").alias("rc_namespace"), F.col("name").alias("namespace"))
    return with_comment(with_editor(scoped.join(names, "rc_namespace", "left"), tables), tables)


def main_namespace_ids(tables: Tables) -> DataFrame:
    """Distinct ids of changes in scope in the main namespace, to join with by merging. They grow with the changes, but ids in order
    compress so well that Spark, which goes by bytes, would broadcast them or gather them all in one task. So they are dealt to as many
    tasks as a shuffle has partitions; what is joined with them is dealt alike."""
    scoped = tables["recentchanges"].filter(in_review_scope() & (F.col("rc_namespace") == 0)).select("rc_id")
    parts = int(scoped.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return scoped.repartition(parts, "rc_id").distinct().hint("merge")


def change_tags(tables: Tables) -> DataFrame:
    """Tags of changes in scope in the main namespace; a tag without a name stays in."""
    scoped = tables["recentchanges"] \
        .filter(in_review_scope() & (F.col("rc_namespace") == 0)).select("rc_id")
    return (
        tables["change_tag"].filter(F.col("ct_id").isNotNull())
        .join(scoped, F.col("ct_rc_id") == F.col("rc_id"))
        .join(tables["change_tag_def"], F.col("ct_tag_id") == F.col("ctd_id"), "left")
        .select("rc_id", "ct_id", "ctd_name")
    )


def change_flags(tables: Tables) -> DataFrame:
    """One row per tagged change in scope in the main namespace: does it carry the revert tag, the
    suggested-edit tag. Tags of other changes are cut off before they are grouped."""
    scoped = main_namespace_ids(tables)
    wanted = tables["change_tag_def"].filter(F.col("ctd_name").isin(TAG_REVERTED, TAG_SUGGESTED))
    return (
        tables["change_tag"].join(wanted, F.col("ct_tag_id") == F.col("ctd_id"))
        .join(scoped, F.col("ct_rc_id") == F.col("rc_id")).drop("rc_id")
        .groupBy(F.col("ct_rc_id").alias("rc_id"))
        .agg(F.bool_or(F.col("ctd_name") == TAG_REVERTED).alias("reverted"),
             F.bool_or(F.col("ctd_name") == TAG_SUGGESTED).alias("suggested_edit"))
    )


def revision_scores(tables: Tables) -> DataFrame:
    """One row per scored revision in scope with a column per current model. Of several current models
    with one name the latest counts. Other revisions are cut off before scores are grouped."""
    models = tables["score_model"].filter(
        (F.col("oresm_is_current") == 1)
        & F.col("oresm_name").isin(MODEL_DAMAGING, MODEL_GOODFAITH))

    def latest(model: str) -> Column:
        is_model = F.col("oresm_name") == model
        probability = F.col("oresc_probability").cast("double")
        return F.max_by(probability, F.when(is_model, F.col("oresm_id")))

    return (
        scores_in_scope(tables).join(models, F.col("oresc_model") == F.col("oresm_id"))
        .groupBy("oresc_rev")
        .agg(latest(MODEL_DAMAGING).alias("oresc_damaging"),
             latest(MODEL_GOODFAITH).alias("oresc_goodfaith"))
    )


def scores_in_scope(tables: Tables) -> DataFrame:
    """Score rows of revisions in scope, in any namespace."""
    revisions = tables["recentchanges"].filter(in_review_scope()).select(revision_key())
    return tables["score"].join(
        revisions, F.col("oresc_rev") == F.col("revision"), "left_semi")


def patrol_log(tables: Tables, since: Column | None = None) -> DataFrame:
    """Patrol entries of the main namespace with the id of the reviewed revision. ``since`` is the
    smallest log timestamp (14 digits) to keep."""
    log = tables["logging"].filter(
        (F.col("log_type") == "patrol") & (F.col("log_action") == "patrol")
        & (F.col("log_namespace") == 0))
    if since is not None:
        log = log.filter(F.col("log_timestamp") >= since)
    revision = F.nullif(F.regexp_extract("log_params", REVISION_IN_PARAMS, 1), F.lit(""))
    return (
        log.join(tables["actor"], F.col("log_actor") == F.col("actor_id"))
        .select("log_id", "log_timestamp", parse_time(F.col("log_timestamp")).alias("log_time"),
                revision.try_cast("bigint").alias("rc_curid"),
                F.col("actor_name").alias("patroller"))
    )


def block_history(tables: Tables) -> DataFrame:
    """Past blocks: user name, time, what kind of user the name stands for, and the first and last
    address of those that are addresses or networks."""
    blocks = (
        tables["logging"]
        .filter((F.col("log_type") == "block") & (F.col("log_action") == "block"))
        .select(F.translate("log_title", "_", " ").alias("user_name"),
                parse_time(F.col("log_timestamp")).alias("time"))
    )
    return ip.with_user_kind(blocks, "user_name")


def current_blocks(tables: Tables) -> DataFrame:
    """Blocks in force, of addresses and of registered users; no automatic ones."""
    blocks = tables["block"].join(
        tables["block_target"].filter(F.col("bt_auto") == 0), F.col("bl_target") == F.col("bt_id"))

    def named(condition: Column, name: str) -> Column:
        return F.when(condition, F.struct(F.col(name).alias("user_name")))

    # a block of an address and one of an account are told apart in one pass
    names = F.array_compact(F.array(named(F.col("bt_user").isNull(), "bt_address"),
                                    named(F.col("bt_address").isNull(), "bt_user_text")))
    return blocks.select(
        F.inline(names),
        F.when(F.col("bl_expiry") == "infinity", "infinity").otherwise("temporary")
        .alias("is_blocked"),
        F.col("bt_range_start").alias("range_start"), F.col("bt_range_end").alias("range_end"))


def translation_pages(tables: Tables) -> DataFrame:
    """Distinct ``page/language`` of open changes to translation units ``page/section/language``.
    A title without a slash gives null."""
    parts = F.split("page_title", "/")
    page = F.array_join(F.slice(parts, 1, F.greatest(F.size(parts) - 2, F.lit(0))), "/")
    title = F.when(F.size(parts) >= 2, F.concat(page, F.lit("/"), F.try_element_at(parts, F.lit(-1))))
    pages = tables["page"].filter(F.col("page_namespace") == TRANSLATION_NAMESPACE)
    revisions = tables["recentchanges"].filter(F.col("rc_patrolled") == 0).select("rc_this_oldid")
    return (
        tables["revtag"]
        .join(pages, F.col("rt_page") == F.col("page_id"))
        .join(revisions, F.col("rt_revision") == F.col("rc_this_oldid"), "left_semi")
        .select(title.alias("translation_page")).distinct()
    )
