"""DuckDB SQL for every report.

``VIEWS`` are shared steps, ``REPORTS`` the checks. Each names what it reads, so that a check carries
only the ``WITH`` entries it needs. The texts are plain SQL with regular expressions, range
conditions and ``quantile_cont``: they share no method with the Spark side beyond the input tables.
"""

from __future__ import annotations

from changewatch.functions.actions import ACTIONS, OTHER_CATEGORIES, actions_of
from changewatch.sources.derived import DERIVED, with_clause

AS_OF = "TIMESTAMP '2024-01-30 12:00:00'"
TODAY = "TIMESTAMP '2024-01-30 00:00:00'"
IN_WINDOW = f"time >= {TODAY} - INTERVAL 28 DAY AND time < {TODAY}"


def _list(names: list[str]) -> str:
    return "(" + ", ".join(f"'{n}'" for n in names) + ")"


TERMS = _list(actions_of("terms"))
CLAIMS = _list(actions_of("allclaims"))
SITELINK = _list(actions_of("sitelink"))
SITELINK_MOVE = _list(actions_of("sitelinkmove"))
ALL_SITELINKS = _list(actions_of("allsitelinks"))
EDITENTITY = _list(actions_of("editentity"))
OTHER = _list(actions_of(*OTHER_CATEGORIES))
TERM_CATEGORIES = "('label', 'description', 'alias', 'anyterms')"
FAMILIES = " ".join(f"WHEN action IN {_list(names)} THEN '{category}'"
                    for category, names in ACTIONS.items())
# Patterns of the summary format.
MARKER = r"'^/\* (.+?) \*/ ?(.*)?'"
ACTION = r"'^([a-z\-]+):(.*)'"
PARAMS = r"'^([\d]+)\|([^\|]+)?[\|]?([^\|]+)?[\|]?([^\|]+)?'"
PROPERTY = r"'^\[\[Property:(P\d+)\]\]: (.*)$'"

_HEX4 = "list_aggregate(list_transform(string_split({0}, '.'), lambda x: printf('%02X', CAST(x AS INT))), 'string_agg', '')"
_GROUPS = "CASE WHEN {0} = '' THEN [] ELSE string_split({0}, ':') END"


def _address_hex(name: str) -> str:
    left, right = f"string_split({name}, '::')[1]", f"string_split({name}, '::')[2]"
    left_groups, right_groups = _GROUPS.format(left), _GROUPS.format(right)
    return f"""CASE
        WHEN regexp_matches({name}, '^[0-9]+(\\.[0-9]+){{3}}$') THEN {_HEX4.format(name)}
        WHEN {name} LIKE '%::%' THEN upper(
          coalesce(list_aggregate(list_transform({left_groups}, lambda x: lpad(x, 4, '0')), 'string_agg', ''), '')
          || repeat('0000', CAST(8 - len({left_groups}) - len({right_groups}) AS INT))
          || coalesce(list_aggregate(list_transform({right_groups}, lambda x: lpad(x, 4, '0')), 'string_agg', ''), ''))
        END"""


# 4 bits at a time: keep whole digits, cut the digit that the prefix ends in, fill the rest
def _network_end(address: str, length: str, ones: bool) -> str:
    fill = "F" if ones else "0"
    digit = f"CAST('0x' || substring({address}, {length} // 4 + 1, 1) AS INT)"
    block = f"(16 >> CAST({length} % 4 AS INT))"
    edge = f"({digit} // {block} * {block} + {f'{block} - 1' if ones else '0'})"
    return f"""rpad(substring({address}, 1, {length} // 4)
        || CASE WHEN {length} % 4 = 0 THEN '' ELSE printf('%X', {edge}) END, CAST(length({address}) AS INT), '{fill}')"""


VIEWS: dict[str, tuple[list[str], str]] = {
    "summaries": (["comment"], f"""
        SELECT comment_id, comment_text, magic, free, action, rest,
               nullif(CASE WHEN regexp_matches(rest, {PARAMS}) THEN regexp_extract(rest, {PARAMS}, 1) END, '') AS param0,
               nullif(CASE WHEN regexp_matches(rest, {PARAMS}) THEN regexp_extract(rest, {PARAMS}, 2) END, '') AS param1,
               nullif(CASE WHEN regexp_matches(rest, {PARAMS}) THEN regexp_extract(rest, {PARAMS}, 3) END, '') AS param2,
               nullif(CASE WHEN regexp_matches(rest, {PARAMS}) THEN regexp_extract(rest, {PARAMS}, 4) END, '') AS param3,
               CASE WHEN action IN {CLAIMS} AND regexp_matches(free, {PROPERTY})
                    THEN regexp_extract(free, {PROPERTY}, 1) END AS property,
               CASE WHEN action IN {CLAIMS} AND regexp_matches(free, {PROPERTY})
                    THEN regexp_extract(free, {PROPERTY}, 2) END AS value,
               CASE {FAMILIES} ELSE 'NO_CAT' END AS category
        FROM (SELECT *, CASE WHEN regexp_matches(magic, {ACTION}) THEN regexp_extract(magic, {ACTION}, 1) END AS action,
                        CASE WHEN regexp_matches(magic, {ACTION}) THEN regexp_extract(magic, {ACTION}, 2) END AS rest
              FROM (SELECT *, CASE WHEN regexp_matches(comment_text, {MARKER})
                                   THEN regexp_extract(comment_text, {MARKER}, 1) END AS magic,
                              CASE WHEN regexp_matches(comment_text, {MARKER})
                                   THEN regexp_extract(comment_text, {MARKER}, 2) END AS free
                    FROM comment) a) b"""),
    "scoped": (["recentchanges"], "SELECT * FROM recentchanges WHERE rc_patrolled IN (0, 1)"),
    "flags": (["change_tag", "change_tag_def", "scoped"], """
        SELECT ct_rc_id AS rc_id, bool_or(ctd_name = 'mw-reverted') AS reverted,
               bool_or(ctd_name = 'apps-suggested-edits') AS suggested_edit
        FROM change_tag JOIN change_tag_def ON ct_tag_id = ctd_id
        WHERE ctd_name IN ('mw-reverted', 'apps-suggested-edits')
          AND ct_rc_id IN (SELECT rc_id FROM scoped WHERE rc_namespace = 0) GROUP BY 1"""),
    "damaging": (["score", "score_model"], """
        SELECT oresc_rev, CAST(arg_max(oresc_probability, oresm_id) AS DOUBLE) AS p
        FROM score JOIN score_model ON oresc_model = oresm_id
        WHERE oresm_name = 'damaging' AND oresm_is_current = 1 GROUP BY 1"""),
    "goodfaith": (["score", "score_model"], """
        SELECT oresc_rev, CAST(arg_max(oresc_probability, oresm_id) AS DOUBLE) AS p
        FROM score JOIN score_model ON oresc_model = oresm_id
        WHERE oresm_name = 'goodfaith' AND oresm_is_current = 1 GROUP BY 1"""),
    "changes": (["scoped", "actor", "summaries", "flags", "damaging", "goodfaith"], """
        SELECT c.rc_id, rc_timestamp, rc_title, rc_source, rc_patrolled, rc_new_len, rc_old_len,
               rc_this_oldid, actor_user, actor_name, comment_text,
               try_strptime(rc_timestamp, '%Y%m%d%H%M%S') AS time,
               rc_new_len - rc_old_len AS len_diff,
               TRY_CAST(substring(rc_title, 2) AS BIGINT) AS num_title,
               coalesce(f.reverted, false) AS reverted,
               coalesce(f.suggested_edit, false) AS suggested_edit,
               magic AS summary_magic, free AS summary_free, action AS summary_action,
               rest AS summary_rest, param0 AS summary_param0, param1 AS summary_param1,
               param2 AS summary_param2, param3 AS summary_param3, property AS summary_property,
               value AS summary_value, category AS summary_category,
               d.p AS oresc_damaging, g.p AS oresc_goodfaith
        FROM scoped c JOIN actor ON rc_actor = actor_id JOIN summaries ON rc_comment_id = comment_id
        LEFT JOIN flags f ON f.rc_id = c.rc_id LEFT JOIN damaging d ON d.oresc_rev = rc_this_oldid
        LEFT JOIN goodfaith g ON g.oresc_rev = rc_this_oldid WHERE rc_namespace = 0"""),
    "tags": (["scoped", "change_tag", "change_tag_def"], """
        SELECT rc_id, ct_id, ctd_name FROM scoped JOIN change_tag ON rc_id = ct_rc_id
        LEFT JOIN change_tag_def ON ct_tag_id = ctd_id WHERE rc_namespace = 0"""),
    "patrols": (["logging", "actor", "changes"], """
        SELECT log_id, log_timestamp, strptime(log_timestamp, '%Y%m%d%H%M%S') AS log_time,
               TRY_CAST(nullif(regexp_extract(split_part(log_params, '"4::curid";', 2), '^[si]:([0-9]+:")?([0-9]+)', 2), '') AS BIGINT) AS rc_curid,
               actor_name AS patroller
        FROM logging JOIN actor ON log_actor = actor_id
        WHERE log_type = 'patrol' AND log_action = 'patrol' AND log_namespace = 0
          AND log_timestamp >= (SELECT min(rc_timestamp) FROM changes)"""),
    "progress": (["changes", "patrols"], f"""
        SELECT rc_id, rc_this_oldid, summary_param1 AS language, summary_category AS category,
               actor_name, time, log_id, patroller, log_time,
               CAST(floor(epoch(log_time - time)) AS BIGINT) AS delay_seconds,
               CAST(floor(epoch(log_time - time)) AS BIGINT) / 3600.0::DOUBLE AS delay_hours
        FROM changes LEFT JOIN patrols ON rc_this_oldid = rc_curid
        WHERE summary_category IN {TERM_CATEGORIES}"""),
    "past_blocks": (["logging"], f"""
        SELECT *, CASE WHEN digits IS NULL THEN 'registered'
                       WHEN length(digits) = 8 THEN CASE WHEN plen < 32 THEN 'ipv4range' ELSE 'ipv4' END
                       ELSE CASE WHEN plen < 128 THEN 'ipv6range' ELSE 'ipv6' END END AS user_type
        FROM (SELECT *, coalesce(TRY_CAST(nullif(regexp_extract(user_name, '/([0-9]+)$', 1), '') AS BIGINT),
                                 length(digits) * 4) AS plen
              FROM (SELECT *, {_address_hex("address")} AS digits
                    FROM (SELECT replace(log_title, '_', ' ') AS user_name,
                                 string_split(replace(log_title, '_', ' '), '/')[1] AS address,
                                 strptime(log_timestamp, '%Y%m%d%H%M%S') AS time
                          FROM logging WHERE log_type = 'block' AND log_action = 'block') a) b) c"""),
    "blocks_now": (["block", "block_target"], """
        SELECT bt_address AS user_name,
               CASE WHEN bl_expiry = 'infinity' THEN 'infinity' ELSE 'temporary' END AS is_blocked,
               bt_range_start AS range_start, bt_range_end AS range_end
        FROM block JOIN block_target ON bl_target = bt_id WHERE bt_user IS NULL AND bt_auto = 0
        UNION ALL
        SELECT bt_user_text, CASE WHEN bl_expiry = 'infinity' THEN 'infinity' ELSE 'temporary' END,
               bt_range_start, bt_range_end
        FROM block JOIN block_target ON bl_target = bt_id WHERE bt_address IS NULL AND bt_auto = 0"""),
    "side_changes": (["scoped", "actor", "comment", "namespaces"], """
        SELECT rc_id, rc_timestamp, rc_title, rc_source, rc_patrolled, rc_new_len, rc_old_len,
               rc_this_oldid, rc_namespace, strptime(rc_timestamp, '%Y%m%d%H%M%S') AS time,
               rc_new_len - rc_old_len AS len_diff, n.name AS namespace, actor_user, actor_name,
               comment_text
        FROM scoped JOIN actor ON rc_actor = actor_id JOIN comment ON rc_comment_id = comment_id
        LEFT JOIN namespaces n ON n.id = rc_namespace WHERE rc_namespace <> 0"""),
    "translated": (["revtag", "page", "recentchanges"], """
        SELECT DISTINCT CASE WHEN len(parts) >= 2
               THEN array_to_string(parts[1:len(parts) - 2], '/') || '/' || parts[len(parts)] END AS translation_page
        FROM (SELECT string_split(page_title, '/') AS parts FROM revtag JOIN page ON rt_page = page_id
              JOIN recentchanges ON rc_this_oldid = rt_revision
              WHERE rc_patrolled = 0 AND page_namespace = 1198) p"""),
    "property_info": (["triples"], """
        SELECT t.subject AS property, coalesce(l.object, t.subject) AS label,
               split_part(t.object, '#', 2) AS data_type
        FROM triples t LEFT JOIN triples l ON l.subject = t.subject AND l.predicate = 'label@en'
        WHERE t.predicate = 'propertyType'"""),
    "item_info": (["triples"], """
        SELECT s.subject AS item, coalesce(l.object, s.subject) AS label,
               CAST(s.object AS BIGINT) AS statements, CAST(i.object AS BIGINT) AS identifiers,
               CAST(k.object AS BIGINT) AS sitelinks,
               (SELECT count(DISTINCT b.subject) FROM triples b
                WHERE b.object = s.subject AND b.predicate NOT IN ('about', 'sameAs', 'statements', 'identifiers',
                                                                    'sitelinks', 'propertyType')
                  AND b.predicate NOT LIKE 'label@%') AS backlinks
        FROM triples s
        JOIN triples i ON i.subject = s.subject AND i.predicate = 'identifiers'
        JOIN triples k ON k.subject = s.subject AND k.predicate = 'sitelinks'
        LEFT JOIN triples l ON l.subject = s.subject AND l.predicate = 'label@en'
        WHERE s.predicate = 'statements'"""),
    "open_anon": (["changes"], f"""
        SELECT actor_name, edits, {_address_hex("actor_name")} AS digits
        FROM (SELECT actor_name, count(*) AS edits FROM changes
              WHERE rc_patrolled = 0 AND actor_user IS NULL GROUP BY 1) a"""),
    "past_ranges": (["past_blocks"], f"""
        SELECT time, length(digits) AS width, {_network_end("digits", "plen", False)} AS low,
               {_network_end("digits", "plen", True)} AS high
        FROM past_blocks WHERE user_type IN ('ipv4range', 'ipv6range')"""),
}

REPORTS: dict[str, tuple[list[str], str]] = {}


def _report(name: str, reads: list[str], sql: str) -> None:
    REPORTS[name] = (reads, sql)


# -- enrichment
_report("changes", ["changes"], "SELECT * FROM changes")
_report("change_tags", ["tags"], "SELECT * FROM tags")
_report("change_flags", ["flags"], "SELECT * FROM flags")
_report("change_scores", ["scoped", "damaging", "goodfaith"], """
    SELECT coalesce(d.oresc_rev, g.oresc_rev) AS oresc_rev, d.p AS oresc_damaging, g.p AS oresc_goodfaith
    FROM damaging d FULL OUTER JOIN goodfaith g ON d.oresc_rev = g.oresc_rev
    WHERE coalesce(d.oresc_rev, g.oresc_rev) IN (SELECT rc_this_oldid FROM scoped)""")
_report("edit_summaries", ["changes"], """
    SELECT rc_id, summary_magic, summary_free, summary_action, summary_rest, summary_param0,
           summary_param1, summary_param2, summary_param3, summary_property, summary_value,
           summary_category FROM changes""")
_report("patrol_log", ["patrols"], "SELECT * FROM patrols")
_report("patrol_progress", ["progress"], "SELECT * FROM progress")
_report("block_history", ["past_blocks"], "SELECT user_name, time, user_type FROM past_blocks")
_report("current_blocks", ["blocks_now"], "SELECT * FROM blocks_now")
_report("changes_side_namespaces", ["side_changes"], "SELECT * FROM side_changes")
_report("translation_pages", ["translated"], "SELECT * FROM translated")

# -- trends
_UNITS = {
    "date": ("CAST(time AS DATE)", ""),
    "weekday": ("CAST(isodow(time) - 1 AS INT)", " / 4.0::DOUBLE"),
    "hour": ("CAST(hour(time) AS INT)", " / 28.0::DOUBLE"),
}
_EDITOR = "CASE WHEN actor_user IS NULL THEN 'anon' ELSE 'registered' END"
_STATUS = "CASE rc_patrolled WHEN 0 THEN 'open' WHEN 1 THEN 'reviewed' END"
for _unit, (_key, _per) in _UNITS.items():
    _report(f"edits_by_{_unit}", ["changes"], f"""
        SELECT {_key} AS {_unit}, {_EDITOR} AS series, count(*){_per} AS n
        FROM changes WHERE {IN_WINDOW} GROUP BY 1, 2
        UNION ALL SELECT {_key}, 'total', count(*){_per} FROM changes WHERE {IN_WINDOW} GROUP BY 1""")
    _report(f"patrol_status_by_{_unit}", ["changes"], f"""
        SELECT {_key} AS {_unit}, {_STATUS} AS series, count(*){_per} AS n
        FROM changes WHERE {IN_WINDOW} GROUP BY 1, 2""")
    _report(f"editor_status_by_{_unit}", ["changes"], f"""
        SELECT {_key} AS {_unit}, {_EDITOR} AS series, count(DISTINCT actor_name){_per} AS n
        FROM changes WHERE {IN_WINDOW} GROUP BY 1, 2
        UNION ALL SELECT {_unit}, 'total', CAST(sum(m) AS BIGINT){_per} FROM (
          SELECT {_key} AS {_unit}, {_EDITOR} AS series, count(DISTINCT actor_name) AS m
          FROM changes WHERE {IN_WINDOW} GROUP BY 1, 2) p GROUP BY 1""")
_report("source_by_date", ["changes"], f"""
    SELECT CAST(time AS DATE) AS date, rc_source AS series, count(*) AS n
    FROM changes WHERE {IN_WINDOW} AND rc_source IS NOT NULL GROUP BY 1, 2
    UNION ALL SELECT CAST(time AS DATE), 'total', count(*)
    FROM changes WHERE {IN_WINDOW} AND rc_source IS NOT NULL GROUP BY 1""")
_report("category_by_date", ["changes"], f"""
    SELECT CAST(time AS DATE) AS date, summary_category AS series, count(*) AS n
    FROM changes WHERE {IN_WINDOW} GROUP BY 1, 2""")
_report("reverted_by_date", ["changes", "tags"], f"""
    SELECT r.date, r.reverted, a.changes
    FROM (SELECT CAST(c.time AS DATE) AS date, count(*) AS reverted
          FROM changes c JOIN tags t ON t.rc_id = c.rc_id AND ctd_name = 'mw-reverted'
          WHERE {IN_WINDOW} GROUP BY 1) r
    LEFT JOIN (SELECT CAST(time AS DATE) AS date, count(*) AS changes FROM changes GROUP BY 1) a
      ON a.date = r.date""")
_report("remaining_by_date", ["changes"], f"""
    SELECT CAST(time AS DATE) AS date, count(*) AS total, count(actor_user) AS registered,
           count(*) - count(actor_user) AS anon
    FROM changes WHERE {IN_WINDOW} AND rc_patrolled = 0 GROUP BY 1""")


# -- breakdowns
def _breakdown(key: str, name: str, where: str, more_than: int | None) -> str:
    having = "" if more_than is None else f"WHERE total > {more_than}"
    return f"""SELECT {name}, status, n, total FROM (
        SELECT {key} AS {name}, {_STATUS} AS status, count(*) AS n,
               CAST(sum(count(*)) OVER (PARTITION BY {key}) AS BIGINT) AS total
        FROM changes WHERE {where} AND {key} IS NOT NULL GROUP BY {key}, rc_patrolled) b {having}"""


def _totals(key: str, name: str, where: str) -> str:
    return f"""SELECT {key} AS {name}, count(*) FILTER (WHERE rc_patrolled = 0) AS open,
        count(*) FILTER (WHERE rc_patrolled = 1) AS reviewed, count(*) AS total
        FROM changes WHERE {where} AND {key} IS NOT NULL GROUP BY 1"""


_report("category_by_status", ["changes"], _breakdown("summary_category", "category", IN_WINDOW, 10))
_report("language_by_status", ["changes"],
        _breakdown("summary_param1", "language", f"summary_action IN {TERMS}", 300))
_report("language_totals", ["changes"], _totals("summary_param1", "language", f"summary_action IN {TERMS}"))
_report("property_by_status", ["changes"],
        _breakdown("summary_property", "property", f"summary_action IN {CLAIMS}", 500))
_report("property_totals", ["changes", "property_info"], f"""
    SELECT t.*, i.label, i.data_type FROM ({_totals("summary_property", "property", f"summary_action IN {CLAIMS}")}) t
    JOIN property_info i ON i.property = t.property""")
_report("sitelink_by_status", ["changes"],
        _breakdown("summary_param1", "project", f"summary_action IN {ALL_SITELINKS}", 300))
_report("sitelink_totals", ["changes"],
        _totals("summary_param1", "project", f"summary_action IN {ALL_SITELINKS}"))
_report("other_actions_by_status", ["changes"], f"""
    SELECT summary_category AS category, {_STATUS} AS status, count(*) AS n
    FROM changes WHERE summary_action IN {OTHER} GROUP BY 1, rc_patrolled""")
_report("qid_bins_by_revision", ["changes"], """
    SELECT num_title // 1000000 AS bin,
           count(*) FILTER (WHERE rc_patrolled = 0 AND NOT reverted) AS open,
           count(*) FILTER (WHERE rc_patrolled = 1 AND NOT reverted) AS reviewed,
           count(*) FILTER (WHERE reverted) AS reverted
    FROM changes WHERE num_title IS NOT NULL GROUP BY 1""")
_report("qid_bins_by_revision_compat", ["changes"], """
    SELECT o.bin, o.n AS open, r.n AS reviewed, v.n AS reverted FROM
    (SELECT num_title // 1000000 AS bin, count(*) AS n FROM changes
     WHERE num_title IS NOT NULL AND rc_patrolled = 0 GROUP BY 1) o
    LEFT JOIN (SELECT num_title // 1000000 AS bin, count(*) AS n FROM changes
     WHERE (rc_patrolled = 1 AND NOT reverted) OR (rc_patrolled = 0 AND reverted) GROUP BY 1) r ON r.bin = o.bin
    LEFT JOIN (SELECT num_title // 1000000 AS bin, count(*) AS n FROM changes
     WHERE reverted GROUP BY 1) v ON v.bin = o.bin""")
_report("qid_bins_by_item", ["changes"], """
    SELECT num_title // 1000000 AS bin, count(DISTINCT num_title) AS items
    FROM changes WHERE num_title IS NOT NULL GROUP BY 1""")


# -- score histograms
def _histogram(editor: str, group: str, where: str = "true") -> str:
    return f"""WITH base AS (
        SELECT {editor} AS editor, {group} AS group_key, model, score FROM (
            SELECT *, unnest(['damaging', 'goodfaith']) AS model, unnest([oresc_damaging, oresc_goodfaith]) AS score
            FROM changes WHERE oresc_damaging IS NOT NULL AND oresc_goodfaith IS NOT NULL AND {where}) u),
      span AS (
        SELECT editor, group_key, model,
               CASE WHEN min(score) = max(score) THEN min(score) - 0.5::DOUBLE ELSE min(score) END AS lo,
               CASE WHEN min(score) = max(score) THEN max(score) + 0.5::DOUBLE ELSE max(score) END AS hi
        FROM base WHERE group_key IS NOT NULL GROUP BY 1, 2, 3),
      revisions AS (SELECT editor, model, count(*) AS revisions FROM base GROUP BY 1, 2),
      guess AS (
        SELECT b.*, lo, hi, (hi - lo) / 101.0::DOUBLE AS step,
               least(CAST(floor((score - lo) / (hi - lo) * 101.0::DOUBLE) AS BIGINT), 100) AS g
        FROM base b JOIN span s ON s.editor = b.editor AND s.group_key = b.group_key AND s.model = b.model)
      SELECT g.editor, g.model, group_key,
             CAST(CASE WHEN score < lo + g * step THEN g - 1
                       WHEN g < 100 AND score >= lo + (g + 1) * step THEN g + 1 ELSE g END AS BIGINT) AS bin,
             count(*) AS n, any_value(revisions) AS revisions
      FROM guess g JOIN revisions r ON r.editor = g.editor AND r.model = g.model GROUP BY 1, 2, 3, 4"""


_report("score_hist", ["changes"], _histogram("'all'", _STATUS))
_report("score_hist_by_editor", ["changes"], _histogram("'all'", _EDITOR))
_report("score_hist_by_category", ["changes"], _histogram(_EDITOR, "summary_category"))
_report("score_hist_by_reverted", ["changes"],
        _histogram(_EDITOR, "CASE WHEN reverted THEN 'reverted' ELSE 'not reverted' END"))
_report("score_hist_by_language", ["changes"], _histogram(_EDITOR, "summary_param1", f"""
    summary_action IN {TERMS} AND summary_param1 IN (
        SELECT summary_param1 FROM changes WHERE summary_action IN {TERMS} AND summary_param1 IS NOT NULL
        GROUP BY 1 ORDER BY count(*) DESC, summary_param1 LIMIT 10)"""))
_report("score_hist_by_term_type", ["changes"],
        _histogram(_EDITOR, "summary_category", f"summary_category IN {TERM_CATEGORIES}"))


def _cell(x: str) -> str:
    guess = f"least(CAST(floor(({x} - {x}_lo) / ({x}_hi - {x}_lo) * 101.0::DOUBLE) AS BIGINT), 100)"
    edge = f"{x}_lo + {{0}} * (({x}_hi - {x}_lo) / 101.0::DOUBLE)"
    return f"""CAST(CASE WHEN {x} < {edge.format(guess)} THEN {guess} - 1
        WHEN {guess} < 100 AND {x} >= {edge.format(f"({guess} + 1)")} THEN {guess} + 1 ELSE {guess} END AS BIGINT)"""


_report("score_heatmap", ["changes"], f"""WITH base AS (
    SELECT {_EDITOR} AS editor, oresc_damaging AS d, oresc_goodfaith AS g FROM changes
    WHERE oresc_damaging IS NOT NULL AND oresc_goodfaith IS NOT NULL),
  span AS (SELECT editor, count(*) AS revisions, min(d) AS d_lo, max(d) AS d_hi, min(g) AS g_lo,
                  max(g) AS g_hi FROM base GROUP BY 1)
  SELECT editor, damaging_bin, goodfaith_bin, n, revisions, max(n) OVER (PARTITION BY editor) AS max_cell
  FROM (SELECT b.editor, {_cell("d")} AS damaging_bin, {_cell("g")} AS goodfaith_bin, count(*) AS n,
               any_value(revisions) AS revisions
        FROM base b JOIN span s ON s.editor = b.editor GROUP BY 1, 2, 3) c""")

# -- worklists
_SPANS = {
    "today": f"time >= {TODAY}",
    "3d": f"time >= {AS_OF} - INTERVAL 3 DAY",
    "7d": f"time >= {AS_OF} - INTERVAL 7 DAY",
    "14d": f"time >= {AS_OF} - INTERVAL 14 DAY",
    "all": f"time >= {AS_OF} - INTERVAL 31 DAY",
    "suggested": "suggested_edit",
}
for _name, _where in _SPANS.items():
    _report(f"worklist_{_name}", ["changes"], f"""
        SELECT s.actor_name, edits_patr, edits_unpatr, coalesce(reverted, 0) AS reverted,
               coalesce(created, 0) AS created, edits_patr + edits_unpatr AS edits,
               round_even(CAST(edits_patr AS DOUBLE) / (edits_patr + edits_unpatr) * 100, 2) AS patrol_ratio,
               round_even(CAST(coalesce(reverted, 0) AS DOUBLE) / (edits_patr + edits_unpatr) * 100, 2) AS reverted_ratio
        FROM (SELECT actor_name, count(*) FILTER (WHERE rc_patrolled = 1) AS edits_patr,
                     count(*) FILTER (WHERE rc_patrolled = 0) AS edits_unpatr
              FROM changes WHERE {_where} GROUP BY 1) s
        LEFT JOIN (SELECT actor_name, count(*) AS reverted FROM changes WHERE reverted GROUP BY 1) r
          ON r.actor_name = s.actor_name
        LEFT JOIN (SELECT actor_name, count(*) AS created FROM changes WHERE rc_source = 'mw.new' GROUP BY 1) c
          ON c.actor_name = s.actor_name""")
for _name, _test, _min in (("unregistered", "IS NULL", 0.9), ("registered", "IS NOT NULL", 0.7)):
    _report(f"score_worklist_{_name}", ["changes"], f"""
        SELECT actor_name, edits, damaging FROM (
            SELECT actor_name, count(*) AS edits,
                   CAST(sum(CAST(coalesce(oresc_damaging, 0) AS DECIMAL(18, 9))) AS DOUBLE) / count(*) AS damaging
            FROM changes WHERE rc_patrolled = 0 AND actor_user {_test} GROUP BY 1) a
        WHERE damaging >= {_min}::DOUBLE AND edits >= 10""")
_report("items_many_revisions", ["changes"], """
    SELECT rc_title, count(*) AS edits FROM changes
    WHERE rc_patrolled = 0 AND num_title < 150000000 GROUP BY 1""")
_report("users_many_creations", ["changes"], """
    SELECT actor_name, count(*) AS creations FROM changes
    WHERE rc_patrolled = 0 AND (rc_source <> 'mw.edit' OR rc_source IS NULL) GROUP BY 1""")
_report("highly_used_items", ["changes", "entity_usage"], """
    SELECT rc_title, entity_usage_count, count(*) AS edits
    FROM changes JOIN entity_usage ON rc_title = qid
    WHERE rc_patrolled = 0 AND entity_usage_count >= 500 GROUP BY 1, 2""")
_report("uncategorized_summaries", ["changes"], """
    SELECT rc_id, rc_timestamp, rc_title, rc_this_oldid, actor_name FROM changes
    WHERE summary_category = 'NO_CAT'""")
_report("top_patrollers", ["changes", "patrols"], """
    SELECT patroller, patrols, round_even(CAST(patrols AS DOUBLE) / sum(patrols) OVER () * 100, 1) AS patrols_relative
    FROM (SELECT patroller, count(*) AS patrols FROM patrols
          WHERE rc_curid >= (SELECT min(rc_this_oldid) FROM changes) GROUP BY 1) p""")
_SENTENCE = """{0} ' || patrolled || ' out of ' || total || ' revisions are patrolled ('
    || CAST(percent AS DECIMAL(9, 1)) || '%); ' || (total - patrolled) || ' revisions are not yet patrolled'"""
_report("progress_totals", ["changes", "patrols"], f"""
    SELECT patrolled, total, total - patrolled AS remaining, percent, reviewed_status,
           '{_SENTENCE.format("Currently")} AS sentence
    FROM (SELECT *, round_even(CAST(patrolled AS DOUBLE) / total * 100, 1) AS percent
          FROM (SELECT (SELECT count(*) FROM patrols
                        WHERE rc_curid >= (SELECT min(rc_this_oldid) FROM changes)) AS patrolled,
                       count(*) AS total, count(*) FILTER (WHERE rc_patrolled = 1) AS reviewed_status
                FROM changes) a) b""")
_report("progress_today", ["changes"], f"""
    SELECT patrolled, total, total - patrolled AS remaining, percent,
           '{_SENTENCE.format("Today")} AS sentence
    FROM (SELECT *, round_even(CAST(patrolled AS DOUBLE) / total * 100, 1) AS percent
          FROM (SELECT count(*) FILTER (WHERE rc_patrolled = 1) AS patrolled, count(*) AS total
                FROM changes WHERE time >= {TODAY}) a) b""")
_report("tag_counts", ["tags"], """
    SELECT ctd_name, count(*) AS n FROM tags WHERE ctd_name IS NOT NULL GROUP BY 1""")
_report("item_facts", ["changes", "item_info"], """
    SELECT * FROM item_info WHERE item IN (SELECT rc_title FROM changes)""")
_report("property_facts", ["changes", "property_info"], """
    SELECT * FROM property_info WHERE property IN (SELECT summary_property FROM changes)""")
_report("deletion_request_items", ["changes", "item_info", "request_links"], """
    SELECT rc_title, reviewed_share, changes, label, statements, identifiers, sitelinks, backlinks
    FROM (SELECT rc_title, avg(rc_patrolled) AS reviewed_share, count(*) AS changes FROM changes
          WHERE rc_title IN (SELECT title FROM request_links) GROUP BY 1) c
    JOIN item_info ON item = rc_title""")

# -- blocks
_RECENT = f"time > {AS_OF} - INTERVAL 365 DAY"
for _suffix, _age in (("all", "true"), ("1y", _RECENT)):
    _report(f"block_registered_{_suffix}", ["changes", "past_blocks", "blocks_now"], f"""
        SELECT actor_name, edits, block_cnt, is_blocked
        FROM (SELECT actor_name, count(*) AS edits FROM changes
              WHERE rc_patrolled = 0 AND actor_name IN (
                  SELECT user_name FROM past_blocks WHERE user_type = 'registered' AND {_age}) GROUP BY 1) e
        JOIN (SELECT user_name, count(*) AS block_cnt FROM past_blocks
              WHERE user_type = 'registered' GROUP BY 1) b ON b.user_name = actor_name
        LEFT JOIN blocks_now n ON n.user_name = actor_name""")
    for _compat in (False, True):
        _name = f"block_anon_{_suffix}" + ("_compat" if _compat else "")
        _also = "AND own_cnt IS NOT NULL" if _compat else ""
        _report(_name, ["changes", "open_anon", "past_blocks", "past_ranges", "blocks_now"], f"""
            WITH ranged AS (
              SELECT actor_name, any_value(edits) AS edits, count(*) AS cnt FROM open_anon
              JOIN past_ranges ON width = length(digits) AND digits BETWEEN low AND high
              WHERE {_age} GROUP BY 1),
            own AS (
              SELECT actor_name, edits, own_cnt FROM
              (SELECT actor_name, count(*) AS edits FROM changes WHERE rc_patrolled = 0 AND actor_name IN (
                  SELECT user_name FROM past_blocks WHERE user_type IN ('ipv4', 'ipv6') AND {_age}) GROUP BY 1) e
              JOIN (SELECT user_name, count(*) AS own_cnt FROM past_blocks
                    WHERE user_type IN ('ipv4', 'ipv6') GROUP BY 1) b ON user_name = actor_name),
            listed AS (
              SELECT coalesce(o.actor_name, r.actor_name) AS actor_name,
                     greatest(coalesce(o.edits, 0), coalesce(r.edits, 0)) AS edits, own_cnt,
                     coalesce(own_cnt, 0) AS block_cnt, coalesce(cnt, 0) AS range_cnt
              FROM own o FULL OUTER JOIN ranged r ON r.actor_name = o.actor_name),
            hexed AS (SELECT *, {_address_hex("actor_name")} AS digits FROM listed),
            stored AS (SELECT *, replace(range_start, 'v6-', '') AS low, replace(range_end, 'v6-', '') AS high
                       FROM blocks_now)
            SELECT l.actor_name, edits, block_cnt, range_cnt AS range_blocks_{_suffix},
                   block_cnt + range_cnt AS total_blocks, n.is_blocked,
                   (SELECT CASE WHEN count(*) = 0 THEN NULL WHEN bool_or(s.is_blocked = 'infinity')
                                THEN 'infinity' ELSE 'temporary' END
                    FROM stored s WHERE s.range_start < s.range_end AND length(s.low) = length(l.digits)
                      AND l.digits BETWEEN s.low AND s.high) AS is_range_blocked
            FROM hexed l LEFT JOIN blocks_now n
              ON n.user_name = l.actor_name AND n.range_start = n.range_end {_also}""")

# -- keyed worklists
_ROW = "rc_id, rc_timestamp, rc_title, rc_this_oldid, actor_name, oresc_damaging, oresc_goodfaith, summary_action"


def _keyed(name: str, where: str, key: str, column: str) -> None:
    _report(name, ["changes"], f"""
        SELECT {_ROW}, {key} AS {column} FROM changes
        WHERE rc_patrolled = 0 AND {where} AND {key} IS NOT NULL""")


_keyed("terms_by_language", f"summary_action IN {TERMS}", "summary_param1", "language")
_report("entity_terms_by_language", ["changes"], f"""
    SELECT {_ROW}, unnest(list_distinct(string_split(summary_param2, ', '))) AS language FROM changes
    WHERE rc_patrolled = 0 AND summary_category = 'editentity' AND summary_param2 IS NOT NULL""")
_keyed("entity_create_by_language", "summary_action = 'wbeditentity-create'", "summary_param1", "language")
_keyed("sitelinks_by_project", f"summary_action IN {SITELINK}", "summary_param1", "project")
_keyed("page_moves_by_project", f"summary_action IN {SITELINK_MOVE}", "summary_param1", "project")
_keyed("page_removals_by_project", f"summary_action IN {SITELINK_MOVE} AND summary_param1 IS NULL",
       "summary_param2", "project")
_keyed("entity_edits_by_action", f"summary_action IN {EDITENTITY}", "summary_action", "action")
_keyed("claims_by_property", f"summary_action IN {CLAIMS}", "summary_property", "property")
_report("side_namespace_worklist", ["side_changes", "translated"], """
    SELECT rc_id, rc_timestamp, rc_title, rc_this_oldid, actor_name, namespace, rc_source
    FROM side_changes WHERE rc_patrolled = 0 AND rc_this_oldid <> 0
      AND namespace NOT IN ('Topic', 'Translations')
      AND namespace || ':' || rc_title NOT IN (
          SELECT translation_page FROM translated WHERE translation_page IS NOT NULL)""")
_report("terms_by_language_head", ["changes"], f"""
    SELECT * FROM (SELECT {_ROW}, summary_param1 AS language,
        CAST(row_number() OVER (PARTITION BY summary_param1 ORDER BY actor_name, rc_id) AS INT) AS position
    FROM changes WHERE rc_patrolled = 0 AND summary_action IN {TERMS} AND summary_param1 IS NOT NULL) h
    WHERE position <= 50""")

# -- progress by language
_report("patrollers_by_language", ["progress"], """
    SELECT language, patroller, count(*) AS patrols FROM progress
    WHERE language IS NOT NULL AND patroller IS NOT NULL GROUP BY 1, 2""")
_report("unpatrolled_by_language", ["progress"], """
    SELECT language, count(*) FILTER (WHERE delay_seconds IS NULL) AS unpatrolled FROM progress
    WHERE language IS NOT NULL GROUP BY 1""")
_report("delay_describe_by_language", ["progress"], """
    SELECT language, count(delay_seconds) AS count, avg(delay_seconds) AS mean,
           round(stddev_samp(delay_seconds), 3) AS std,
           CAST(min(delay_seconds) AS DOUBLE) AS min, quantile_cont(delay_seconds, 0.25) AS p25,
           quantile_cont(delay_seconds, 0.5) AS p50, quantile_cont(delay_seconds, 0.75) AS p75,
           CAST(max(delay_seconds) AS DOUBLE) AS max
    FROM progress WHERE language IS NOT NULL GROUP BY 1""")
_report("delay_histogram_by_language", ["progress"], """
    WITH longest AS (
      SELECT *, CASE WHEN hours <= 24 THEN 1 WHEN hours <= 48 THEN 2 WHEN hours <= 96 THEN 6
                     WHEN hours <= 168 THEN 12 WHEN hours <= 336 THEN 24 ELSE 48 END AS step
      FROM (SELECT language, CAST(ceil(max(delay_seconds) / 3600.0) AS BIGINT) AS hours FROM progress
            WHERE language IS NOT NULL AND delay_seconds IS NOT NULL GROUP BY 1) m),
    edges AS (
      SELECT language, CAST(unnest(range(0, hours + 1, step)) AS BIGINT) AS bin_start, step,
             hours // step * step AS last FROM longest)
    SELECT e.language, bin_start, CAST(bin_start + step AS BIGINT) AS bin_end, count(*) AS n
    FROM edges e JOIN progress p ON p.language = e.language AND bin_start < last
      AND delay_seconds >= bin_start * 3600 AND (delay_seconds < (bin_start + step) * 3600
        OR (bin_start + step = last AND delay_seconds = last * 3600)) GROUP BY 1, 2, 3""")
_report("delay_percentiles_by_language", ["progress"], """
    SELECT language, CAST(unnest(range(0, 101)) AS INT) AS pct, round(unnest(q) / 3600.0::DOUBLE, 6) AS hours
    FROM (SELECT language, quantile_cont(delay_seconds, list_transform(range(0, 101), lambda x: x / 100.0::DOUBLE)) AS q
          FROM progress WHERE language IS NOT NULL AND delay_seconds IS NOT NULL GROUP BY 1) p""")


# -- the same from tables stored otherwise
for _name, _same in {"patrol_log_stored_by_day": "patrol_log", "edits_by_date_stored_by_day": "edits_by_date",
                     "changes_colocated": "changes", "change_scores_filtered": "change_scores"}.items():
    _report(_name, *REPORTS[_same])

_report("worklists_from_day_partials", ["changes"], " UNION ALL ".join(
    f"SELECT '{'suggested-edit' if span == 'suggested' else span}' AS span, * FROM ({REPORTS[f'worklist_{span}'][1]}) list_{span}"
    for span in ("today", "3d", "7d", "14d", "suggested")) + f" UNION ALL SELECT 'all' AS span, * FROM ({REPORTS['worklist_all'][1]}) list_all")
_report("editors_by_span_sketched", ["changes"], f"""
    SELECT days, series, count(DISTINCT actor_name) AS n, true AS close
    FROM (SELECT *, unnest([1, 7, 14, 28]) AS days, {_EDITOR} AS series FROM changes WHERE {IN_WINDOW}) s
    WHERE date_diff('day', CAST(time AS DATE), CAST({TODAY} AS DATE)) <= days GROUP BY 1, 2""")
_report("delay_percentiles_sketched", ["progress"], """
    SELECT language, CAST(unnest(range(0, 101)) AS INT) AS pct, true AS close
    FROM (SELECT DISTINCT language FROM progress WHERE language IS NOT NULL AND delay_seconds IS NOT NULL) l""")
_report("most_frequent_values", ["changes"], " UNION ALL ".join(f"""
    SELECT * FROM (SELECT '{what}' AS what, {column} AS value, count(*) AS n FROM changes
    WHERE {column} IS NOT NULL AND {where} GROUP BY 2 ORDER BY n DESC, value LIMIT 10) {what}s""" for what, column, where in (
    ("language", "summary_param1", f"summary_action IN {TERMS}"), ("item", "rc_title", "true"), ("editor", "actor_name", "true"))))


def _steps(names: list[str]) -> list[str]:
    """Views that ``names`` need, each after the ones it reads; derived tables are left out."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in VIEWS and name not in order:
            for parent in VIEWS[name][0]:
                visit(parent)
            order.append(name)

    for name in names:
        visit(name)
    return order


def sql_of(name: str) -> str:
    """The whole SQL text of a check, on the test tables."""
    reads, body = REPORTS[name]
    views = _steps(reads)
    tables = [t for v in [*views] for t in VIEWS[v][0] if t in DERIVED]
    tables += [t for t in reads if t in DERIVED]
    entries = [with_clause(tables, duckdb=True)]
    entries += [f"{view} AS ({VIEWS[view][1]})" for view in views]
    return "WITH " + ",\n".join(entries) + f"\nSELECT * FROM ({body}) report"
