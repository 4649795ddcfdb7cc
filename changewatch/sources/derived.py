"""Source tables derived from the ``events`` test table.

Each table is one SQL text that Spark and DuckDB both run after a few function names are filled in,
so a report and its SQL check start from the same rows. Tables of changes, editors, entries, blocks and items grow with ``events``:
397 items more for every 4,096 events, one of them hot among changes and links throughout; there are eight languages and nine reviewers.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from changewatch.sources.readers import Tables

# name -> (tables it reads, SQL). ``{..}`` marks what differs between the two engines.
DERIVED: dict[str, tuple[list[str], str]] = {
    # k is 0..99; a third of the rows has one hot language, one a hot editor, one a hot item; revisions
    # have 9, 10 and 11 digits
    "ev": ([], """
        SELECT event_id, ts, user_id, event_type, value, k,
               CASE WHEN k % 3 = 0 THEN 'en'
                    ELSE substring('deenfresitrunlpt', CAST(1 + 2 * (user_id % 8) AS INT), 2) END AS lang,
               CASE WHEN k % 3 = 1 THEN 4 ELSE user_id END AS editor,
               CASE WHEN k % 3 = 2 THEN 78 ELSE (event_id * 7919) % 397 + 397 * {div(event_id, 4096)} END AS n,
               CASE k % 10 WHEN 3 THEN 100000000 + event_id WHEN 7 THEN 20000000000 + event_id
                    ELSE 2000000000 + event_id END AS rev
        FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM {events}) e"""),

    # k % 12 = 11 goes to five side namespaces; status 0, 1, 2
    "recentchanges": (["ev"], """
        SELECT event_id + 1 AS rc_id, {stamp(ts)} AS rc_timestamp,
               CAST(CASE WHEN k % 12 = 11 THEN CASE k % 5 WHEN 0 THEN 1198 WHEN 1 THEN 120
                         WHEN 2 THEN 4 WHEN 3 THEN 146 ELSE 2600 END ELSE 0 END AS INT)
                   AS rc_namespace,
               CASE WHEN k = 47 THEN CASE WHEN event_id % 2 = 0 THEN 'Intro' ELSE 'Guide' END
                         || CAST(event_id % 3 AS STRING) || '/' || lang
                    ELSE 'Q' || CAST((n % 397) * 400009 + {div(n, 397)} + 1 AS STRING) END
                   AS rc_title,
               CASE WHEN event_type = 'signup' THEN 'mw.new' WHEN k = 61 THEN NULL
                    ELSE 'mw.edit' END AS rc_source,
               CAST(CASE WHEN k >= 96 THEN 2 WHEN event_id % 3 = 0 THEN 1 ELSE 0 END AS INT)
                   AS rc_patrolled,
               CAST(1000 + k + CAST(floor(value) AS INT) - 100 AS INT) AS rc_new_len,
               CAST(CASE WHEN event_type = 'signup' THEN NULL ELSE 1000 + k END AS INT)
                   AS rc_old_len,
               CASE WHEN k = 25 THEN 0 ELSE rev END AS rc_this_oldid,
               editor + 1 AS rc_actor, event_id + 1 AS rc_comment_id
        FROM ev"""),

    # user ids: two fifths are addresses, one IPv4, one IPv6; nine reviewers on top
    "named": (["ev"], """
        SELECT user_id + 1 AS actor_id,
               CASE WHEN user_id % 5 < 2 THEN NULL ELSE user_id + 1000 END AS actor_user,
               CASE WHEN user_id % 5 = 0 THEN '10.' || CAST(user_id % 4 AS STRING) || '.'
                         || CAST(user_id % 256 AS STRING) || '.'
                         || CAST(7 + {div(user_id, 256)} % 248 AS STRING)
                    WHEN user_id % 5 = 1 THEN '2001:db8:' || CAST(user_id % 10000 AS STRING) || ':'
                         || CAST({div(user_id, 10000)} % 10000 AS STRING) || '::1'
                    ELSE 'User ' || CAST(user_id AS STRING) END AS actor_name
        FROM (SELECT DISTINCT user_id FROM ev) u"""),
    "actor": (["named", "ev"], """
        SELECT actor_id, actor_user, actor_name FROM named
        UNION ALL
        SELECT DISTINCT 9000000000 + k % 9, CAST(5000 + k % 9 AS BIGINT),
               'Patroller ' || CAST(k % 9 AS STRING)
        FROM ev WHERE k <= 95"""),

    # one summary shape per action family, plus broken and free ones
    "comment": (["ev"], """
        SELECT event_id + 1 AS comment_id, CASE event_id % 16
            WHEN 0 THEN '/* wbsetlabel-add:1|' || lang || ' */ some label'
            WHEN 1 THEN '/* wbsetdescription-set:1|' || lang || ' */ some text'
            WHEN 2 THEN '/* wbsetaliases-add:2|' || lang || ' */ a, b'
            WHEN 3 THEN '/* wbsetlabeldescriptionaliases:0|' || lang || ' */'
            WHEN 4 THEN '/* wbsetclaim-create:2||1 */ [[Property:P' || CAST(31 + k % 7 AS STRING)
                        || ']]: [[Q5]]'
            WHEN 5 THEN '/* wbsetqualifier-add:1| */ [[Property:P' || CAST(580 + k % 3 AS STRING)
                        || ']]: 1999'
            WHEN 6 THEN '/* wbsetreference-add:2| */ [[Property:P143]]: [[Q328]]'
            WHEN 7 THEN '/* wbsetsitelink-add:1|' || lang || 'wiki */ Page'
            WHEN 8 THEN '/* clientsitelink-update:0|' || lang || 'wiki|' || lang || 'wiki:A|'
                        || lang || 'wiki:B */'
            WHEN 9 THEN '/* clientsitelink-remove:1||' || lang || 'wiki */ Page'
            WHEN 10 THEN '/* wbeditentity-create:2|' || lang || ' */ label'
            WHEN 11 THEN '/* wbeditentity-update-languages-short:0||' || lang || ', en */'
            WHEN 12 THEN '/* undo:0||123|Bob */'
            WHEN 13 THEN '/* wbmergeitems-from:0||Q' || CAST(event_id AS STRING) || ' */'
            WHEN 14 THEN CASE WHEN k % 3 = 0 THEN NULL ELSE 'free text without a marker' END
            ELSE '/* special-unknown:1|x */ y' END AS comment_text
        FROM ev"""),

    "change_tag": (["ev"], """
        SELECT event_id * 4 + 1 AS ct_id, event_id + 1 AS ct_rc_id, CAST(11 AS INT) AS ct_tag_id
        FROM ev WHERE event_id % 7 = 0
        UNION ALL SELECT event_id * 4 + 2, event_id + 1, CAST(12 AS INT) FROM ev WHERE event_id % 11 = 0
        UNION ALL SELECT event_id * 4 + 3, event_id + 1, CAST(13 AS INT) FROM ev WHERE event_id % 4 = 1
        UNION ALL SELECT event_id * 4 + 4, event_id + 1, CAST(99 AS INT) FROM ev WHERE event_id % 50 = 2"""),
    "change_tag_def": ([], """
        SELECT * FROM (VALUES (CAST(11 AS INT), 'mw-reverted'), (12, 'apps-suggested-edits'),
                              (13, 'visualeditor')) v(ctd_id, ctd_name)"""),

    # models 1 = damaging and 2 = goodfaith are current, 3 is an old one; some scores are missing
    "score_base": (["ev"], """
        SELECT rev AS oresc_rev, k,
               {div((user_id * 37) % 100 * 1000, 110)} + (k % 10) * 10 AS p
        FROM ev WHERE NOT (user_id % 10 = 2 AND event_id % 6 = 5)"""),
    "score": (["score_base"], """
        SELECT oresc_rev, CAST(m AS INT) AS oresc_model, CAST(1 AS INT) AS oresc_class,
               CAST(CAST(s AS DOUBLE) / 1000 AS DECIMAL(4, 3)) AS oresc_probability,
               CAST(CASE WHEN s >= 500 THEN 1 ELSE 0 END AS INT) AS oresc_is_predicted
        FROM (SELECT oresc_rev, 1 AS m, p AS s FROM score_base
              UNION ALL SELECT oresc_rev, 2, 1000 - p FROM score_base WHERE k <> 17
              UNION ALL SELECT oresc_rev, 3, 500 FROM score_base) x"""),
    "score_model": ([], """
        SELECT * FROM (VALUES (CAST(1 AS INT), 'damaging', CAST(1 AS INT)), (2, 'goodfaith', 1),
                              (3, 'damaging', 0)) v(oresm_id, oresm_name, oresm_is_current)"""),

    # patrol entries with a delay of k * k minutes, some without a revision; blocks; other entries
    "logging": (["ev", "named"], """
        SELECT event_id AS log_id, 'patrol' AS log_type, 'patrol' AS log_action,
               CAST(CASE WHEN k % 12 = 11 THEN 4 ELSE 0 END AS INT) AS log_namespace,
               {stamp_after(ts, k)} AS log_timestamp,
               CAST(NULL AS STRING) AS log_title,
               CASE WHEN k % 50 = 49 THEN 'a:0:' ELSE
                    'a:3:{s:8:"4::curid";' || CASE WHEN k % 4 = 1 THEN 'i:' || CAST(rev AS STRING)
                    ELSE 's:' || CAST(length(CAST(rev AS STRING)) AS STRING) || ':"'
                    || CAST(rev AS STRING) || '"' END || ';s:9:"5::previd";i:0;}' END AS log_params,
               9000000000 + k % 9 AS log_actor
        FROM ev WHERE event_id % 3 = 0
        UNION ALL
        SELECT 3000000000 + actor_id, 'block', 'block', CAST(2 AS INT),
               CAST(20220601000000 + ((actor_id - 1) % 28) * 1000000 AS STRING),
               replace(actor_name, ' ', '_'), '', 9000000000
        FROM named WHERE (actor_id - 1) % 3 = 0
        UNION ALL
        SELECT 4000000000 + actor_id, 'block',
               CASE WHEN actor_id % 2 = 1 THEN 'block' ELSE 'unblock' END, CAST(2 AS INT),
               CAST(20231101000000 + ((actor_id - 1) % 28) * 1000000 AS STRING),
               replace(actor_name, ' ', '_'), '', 9000000001
        FROM named WHERE (actor_id - 1) % 6 = 0
        UNION ALL
        SELECT 5000000000 + actor_id, 'block', 'block', CAST(2 AS INT),
               CAST(20221101000000 + ((actor_id - 1) % 28) * 1000000 + ((actor_id - 1) % 3) * 10000000000 AS STRING),
               actor_name || CASE WHEN (actor_id - 1) % 5 = 0 THEN '/24'
                                  WHEN (actor_id - 1) % 4 = 1 THEN '/51' ELSE '/64' END,
               '', 9000000002
        FROM named WHERE (actor_id - 1) % 15 IN (0, 6)
        UNION ALL
        SELECT * FROM (VALUES
            (5900000001, 'block', 'block', CAST(2 AS INT), '20230701000000', '10.1.0.0/16', '', 9000000003),
            (5900000002, 'block', 'block', 2, '20200101000000', '10.0.0.0/9', '', 9000000003),
            (5900000003, 'block', 'block', 2, '20230815000000', '2001:db8::/32', '', 9000000003),
            (5900000004, 'block', 'block', 2, '20211231000000', '2001:db8:100::/40', '', 9000000003),
            (5900000005, 'block', 'block', 2, '20230901000000', '10.1.0.0/16', '', 9000000003),
            (5900000006, 'delete', 'delete', 0, '20230901000000', 'Q7', '', 9000000003))
            v(log_id, log_type, log_action, log_namespace, log_timestamp, log_title, log_params, log_actor)"""),

    "block_target": (["named"], """
        SELECT actor_id AS bt_id,
               CASE WHEN actor_user IS NULL THEN actor_name END AS bt_address,
               actor_user AS bt_user,
               CASE WHEN actor_user IS NOT NULL THEN actor_name END AS bt_user_text,
               CAST(CASE WHEN actor_id % 16 = 1 THEN 1 ELSE 0 END AS INT) AS bt_auto,
               CASE WHEN u % 5 = 0 THEN '0A' || lpad(hex(u % 4), 2, '0') || lpad(hex(u % 256), 2, '0')
                         || lpad(hex(7 + {div(u, 256)} % 248), 2, '0')
                    WHEN u % 5 = 1 THEN 'v6-20010DB8' || lpad(CAST(u % 10000 AS STRING), 4, '0')
                         || lpad(CAST({div(u, 10000)} % 10000 AS STRING), 4, '0')
                         || repeat('0', 15) || '1' END AS bt_range_start,
               CASE WHEN u % 5 = 0 THEN '0A' || lpad(hex(u % 4), 2, '0') || lpad(hex(u % 256), 2, '0')
                         || lpad(hex(7 + {div(u, 256)} % 248), 2, '0')
                    WHEN u % 5 = 1 THEN 'v6-20010DB8' || lpad(CAST(u % 10000 AS STRING), 4, '0')
                         || lpad(CAST({div(u, 10000)} % 10000 AS STRING), 4, '0')
                         || repeat('0', 15) || '1' END AS bt_range_end
        FROM (SELECT *, actor_id - 1 AS u FROM named) a WHERE u % 4 = 0
        UNION ALL
        SELECT * FROM (VALUES
            (9100000001, '10.1.0.0/16', CAST(NULL AS BIGINT), CAST(NULL AS STRING), CAST(0 AS INT),
             '0A010000', '0A01FFFF'),
            (9100000002, '10.2.0.0/17', NULL, NULL, 0, '0A020000', '0A027FFF'),
            (9100000003, '2001:db8:100::/40', NULL, NULL, 0,
             'v6-20010DB8010000000000000000000000', 'v6-20010DB801FFFFFFFFFFFFFFFFFFFFFF'),
            (9100000004, '10.1.64.0/18', NULL, NULL, 0, '0A014000', '0A017FFF'))
            v(bt_id, bt_address, bt_user, bt_user_text, bt_auto, bt_range_start, bt_range_end)"""),
    "block": (["block_target"], """
        SELECT bt_id AS bl_target,
               CASE WHEN bt_id IN (9100000001, 9100000004) OR (bt_id < 9000000000 AND (bt_id - 1) % 8 = 0)
                    THEN 'infinity' ELSE '20250101000000' END AS bl_expiry
        FROM block_target"""),

    # the items: number, title and how often events touch them
    "it": (["ev"], """
        SELECT n, 'Q' || CAST((n % 397) * 400009 + {div(n, 397)} + 1 AS STRING) AS qid
        FROM (SELECT DISTINCT n FROM ev) d"""),
    "entity_usage": (["it"], """
        SELECT qid, CAST(100 + 7 * (n % 397) AS DOUBLE) AS entity_usage_count FROM it"""),
    "request_links": (["it"], "SELECT qid AS title FROM it WHERE n % 13 = 0"),
    "triples": (["it", "ev"], """
        SELECT qid AS subject, 'statements' AS predicate, CAST(n % 9 AS STRING) AS object FROM it
        UNION ALL SELECT qid, 'identifiers', CAST(n % 4 AS STRING) FROM it
        UNION ALL SELECT qid, 'sitelinks', CAST(n % 6 AS STRING) FROM it WHERE n % 52 <> 0
        UNION ALL SELECT qid, 'label@en', 'Label ' || CAST(n AS STRING) FROM it WHERE n % 3 <> 0
        UNION ALL SELECT qid, 'label@de', 'Name ' || CAST(n AS STRING) FROM it
        UNION ALL SELECT qid, 'label@fr', 'Q' || CAST(((n * 5) % 397) * 400009 + 1 AS STRING)
                  FROM it WHERE n % 4 = 0
        UNION ALL SELECT DISTINCT 'Q' || CAST(((event_id * 31) % 397) * 400009 + {div(event_id, 4096)} + 1 AS STRING),
                         CASE WHEN k % 2 = 0 THEN 'P31' ELSE 'P279' END,
                         'Q' || CAST(CASE WHEN k % 4 = 0 THEN 78 * 400009
                                          ELSE ((event_id * 13) % 397) * 400009 + {div(event_id, 4096)} END + 1 AS STRING)
                  FROM ev WHERE k % 6 = 0
        UNION ALL SELECT 'page/' || qid, 'about', qid FROM it WHERE n % 2 = 0
        UNION ALL SELECT 'old/' || qid, 'sameAs', qid FROM it WHERE n % 5 = 0
        UNION ALL SELECT DISTINCT 'P' || CAST(31 + k % 7 AS STRING), 'propertyType',
                         'ontology#' || CASE WHEN k % 2 = 0 THEN 'Item' ELSE 'String' END
                  FROM ev WHERE k < 7
        UNION ALL SELECT DISTINCT 'P' || CAST(580 + k % 3 AS STRING), 'propertyType', 'ontology#Time'
                  FROM ev WHERE k < 3
        UNION ALL SELECT DISTINCT 'P' || CAST(31 + k % 7 AS STRING), 'label@en',
                         'property ' || CAST(k % 7 AS STRING) FROM ev WHERE k < 5"""),

    "namespaces": ([], """
        SELECT * FROM (VALUES (CAST(0 AS INT), ''), (4, 'Project'), (120, 'Property'),
                              (146, 'Lexeme'), (1198, 'Translations'), (2600, 'Topic')) v(id, name)"""),
    "page": (["ev"], """
        SELECT event_id + 1 AS page_id,
               CASE WHEN k = 95 THEN 'NoSlash' ELSE 'Project:Intro' || CAST(event_id % 3 AS STRING)
                    || '/Section_' || CAST(k % 4 AS STRING) || '/' || lang END AS page_title,
               CAST(CASE WHEN event_id % 9 = 8 THEN 4 ELSE 1198 END AS INT) AS page_namespace
        FROM ev WHERE k % 12 = 11 AND k % 5 = 0"""),
    "revtag": (["ev"], """
        SELECT event_id + 1 AS rt_page, rev AS rt_revision
        FROM ev WHERE k % 12 = 11 AND k % 5 = 0"""),
}

_SPARK = {
    "{stamp(ts)}": "date_format(ts, 'yyyyMMddHHmmss')",
    "{stamp_after(ts, k)}": "date_format(ts + k * k * INTERVAL '1' MINUTE, 'yyyyMMddHHmmss')",
    "{div(event_id, 4096)}": "(event_id div 4096)",
    "{div(n, 397)}": "(n div 397)",
    "{div(user_id, 256)}": "(user_id div 256)",
    "{div(user_id, 10000)}": "(user_id div 10000)",
    "{div(u, 256)}": "(u div 256)",
    "{div(u, 10000)}": "(u div 10000)",
    "{div((user_id * 37) % 100 * 1000, 110)}": "((user_id * 37) % 100 * 1000 div 110)",
}
_DUCKDB = {
    "{stamp(ts)}": "strftime(ts, '%Y%m%d%H%M%S')",
    "{stamp_after(ts, k)}": "strftime(ts + to_minutes(CAST(k * k AS BIGINT)), '%Y%m%d%H%M%S')",
    "{div(event_id, 4096)}": "(event_id // 4096)",
    "{div(n, 397)}": "(n // 397)",
    "{div(user_id, 256)}": "(user_id // 256)",
    "{div(user_id, 10000)}": "(user_id // 10000)",
    "{div(u, 256)}": "(u // 256)",
    "{div(u, 10000)}": "(u // 10000)",
    "{div((user_id * 37) % 100 * 1000, 110)}": "((user_id * 37) % 100 * 1000 // 110)",
}


def closure(names: list[str]) -> list[str]:
    """The derived tables that ``names`` need, each after the ones it reads."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name not in order:
            for parent in DERIVED[name][0]:
                visit(parent)
            order.append(name)

    for name in names:
        visit(name)
    return order


def with_clause(names: list[str], duckdb: bool = False, events: str = "events") -> str:
    """``name AS (..)`` entries for the derived tables that ``names`` need."""
    entries = []
    for name in closure(names):
        sql = DERIVED[name][1]
        for mark, text in (_DUCKDB if duckdb else _SPARK).items():
            sql = sql.replace(mark, text)
        entries.append(f"{name} AS ({sql.replace('{events}', events)})")
    return ",\n".join(entries)


def from_events(spark: SparkSession, folder: str) -> Tables:
    """Source tables derived from ``folder/events.parquet``."""
    events = f"parquet.`{folder.rstrip('/')}/events.parquet`"
    return Tables(lambda name: spark.sql(
        f"WITH {with_clause([name], events=events)} SELECT * FROM {name}"))
