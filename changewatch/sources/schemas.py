"""Schemas of the source tables. Readers conform what they read to these, so a missing or
mistyped column shows at load and not in the middle of a report."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

TABLES: dict[str, str] = {
    "recentchanges": (
        "rc_id bigint, rc_timestamp string, rc_namespace int, rc_title string, rc_source string, "
        "rc_patrolled int, rc_new_len int, rc_old_len int, rc_this_oldid bigint, rc_actor bigint, "
        "rc_comment_id bigint"
    ),
    "actor": "actor_id bigint, actor_user bigint, actor_name string",
    "comment": "comment_id bigint, comment_text string",
    "change_tag": "ct_id bigint, ct_rc_id bigint, ct_tag_id int",
    "change_tag_def": "ctd_id int, ctd_name string",
    "score": (
        "oresc_rev bigint, oresc_model int, oresc_class int, oresc_probability decimal(4,3), "
        "oresc_is_predicted int"
    ),
    "score_model": "oresm_id int, oresm_name string, oresm_is_current int",
    "logging": (
        "log_id bigint, log_type string, log_action string, log_namespace int, "
        "log_timestamp string, log_title string, log_params string, log_actor bigint"
    ),
    "block": "bl_target bigint, bl_expiry string",
    "block_target": (
        "bt_id bigint, bt_address string, bt_user bigint, bt_user_text string, bt_auto int, "
        "bt_range_start string, bt_range_end string"
    ),
    "entity_usage": "qid string, entity_usage_count double",
    "namespaces": "id int, name string",
    "request_links": "title string",
    "revtag": "rt_page bigint, rt_revision bigint",
    "page": "page_id bigint, page_title string, page_namespace int",
    "triples": "subject string, predicate string, object string",
}


def schema_of(table: str) -> T.StructType:
    return T.StructType.fromDDL(TABLES[table])


def conform(df: DataFrame, table: str) -> DataFrame:
    """Select and cast the columns of ``table``. Text that a database hands over as binary is
    decoded as UTF-8."""
    columns = []
    for field in schema_of(table):
        column = F.col(field.name)
        if isinstance(df.schema[field.name].dataType, T.BinaryType) and isinstance(
                field.dataType, T.StringType):
            column = F.decode(column, "UTF-8")
        columns.append(column.cast(field.dataType).alias(field.name))
    return df.select(*columns)
