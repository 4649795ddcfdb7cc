"""Preference data from conversations (operator 2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from changewatch.llm.common import with_next

HEAD = "<|{}|>\n"
END = "<|end|>\n"
TRAINED = "assistant"


def _turns(turns: DataFrame, key: str) -> DataFrame:
    """One row per conversation: its turns in order, as (turn, role, text)."""
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    turn = F.struct(F.col("turn").cast("long").alias("turn"), text("role").alias("role"), text("text").alias("text"))
    return (turns.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key"))
            .agg(F.sort_array(F.collect_list(turn)).alias("turns")))


def _head(turn: Column) -> Column:
    before, after = HEAD.split("{}")
    return F.concat(F.lit(before), turn["role"], F.lit(after))


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), t["text"], F.lit(END))), "")


def _mask(turns: Column) -> Column:
    """Spans of characters of the rendered turns that are trained on: text and end mark of assistant turns."""
    span = "struct<start:bigint,end:bigint>"
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{span}>").alias("spans"))

    def add(state: Column, turn: Column) -> Column:
        begin = state["at"] + F.length(_head(turn))
        end = begin + F.length(turn["text"]) + len(END)
        own = F.struct(begin.alias("start"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(turn["role"] == TRAINED, F.concat(state["spans"], F.array(own)))
                        .otherwise(state["spans"]).alias("spans"))

    return F.aggregate(turns, start, add, lambda state: state["spans"])


def format_pairs(pairs: DataFrame) -> DataFrame:
    """key, n_turns, common_turns, prompt, chosen, rejected and the trained spans of either completion, from key and two
    arrays of turns. The longest common prefix of turns (role and text) is rendered once, as the prompt."""
    chosen, rejected = F.col("chosen_turns"), F.col("rejected_turns")
    shorter = F.least(F.size(chosen), F.size(rejected))
    apart = F.filter(F.sequence(F.lit(1), F.greatest(shorter, F.lit(1))), lambda i: (i <= shorter) & (
        (F.get(chosen, i - 1)["role"] != F.get(rejected, i - 1)["role"])
        | (F.get(chosen, i - 1)["text"] != F.get(rejected, i - 1)["text"])))
    common = F.coalesce(F.array_min(apart) - 1, shorter)
    rest = lambda turns: F.slice(turns, F.col("common_turns") + 1, F.size(turns))
    return pairs.withColumn("common_turns", common).select(
        "key", F.size(chosen).alias("n_turns"), "common_turns",
        _rendered(F.slice(chosen, F.lit(1), F.col("common_turns"))).alias("prompt"),
        _rendered(rest(chosen)).alias("chosen"), _rendered(rest(rejected)).alias("rejected"),
        _mask(rest(chosen)).alias("chosen_spans"), _mask(rest(rejected)).alias("rejected_spans"))


def format_preferences(chosen: DataFrame, rejected: DataFrame, key: str = "conv_id") -> DataFrame:
    """One row per key that both tables of turns (key, turn, role, text) have.

    Turns are ordered by (turn, role, text), null turn numbers first; repeated rows are turns of their own. Null roles and
    texts are empty. Rows with a null key belong to no conversation. Equal conversations give empty completions. Other
    columns are not looked at. A conversation is one row of the result and is put together in one task."""
    pairs = _turns(chosen, key).withColumnRenamed("turns", "chosen_turns").join(
        _turns(rejected, key).withColumnRenamed("turns", "rejected_turns"), "key")
    return format_pairs(pairs).withColumnRenamed("key", key)


def with_foreign_reply(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """Preferences from conversations alone: chosen is the conversation, rejected has in the place of its last assistant turn
    that of the next conversation with one (ascending key, after the last the first). Conversations without
    an assistant turn give no row."""
    own = _turns(turns.withColumn(key, F.col(key).cast("long")), key)
    place = F.array_max(F.filter(F.transform("turns", lambda t, i: F.when(t["role"] == TRAINED, i)), F.isnotnull))
    own = own.withColumn("place", place).where(F.col("place").isNotNull())
    replies = own.select(F.col("key").alias("next"), F.get("turns", F.col("place"))["text"].alias("reply"))
    swapped = F.transform("turns", lambda t, i: F.when(i == F.col("place"), F.struct(
        t["turn"].alias("turn"), t["role"].alias("role"), F.col("reply").alias("text"))).otherwise(t))
    pairs = own.join(with_next(own, "key", "next"), "key").join(replies, "next").select(
        "key", F.col("turns").alias("chosen_turns"), swapped.alias("rejected_turns"))
    return format_pairs(pairs).withColumnRenamed("key", key)


def spans_text(spans: str) -> Column:
    """Spans as one string, start-end, comma between."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws("-", s["start"], s["end"])), ",")


SQL = """
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
last AS (SELECT conv_id, max(i) FILTER (role = 'assistant') AS place, count(*) AS n_turns FROM turns GROUP BY conv_id),
replies AS (
  SELECT l.conv_id, l.place, l.n_turns, t.text AS reply,
         coalesce(lead(l.conv_id) OVER (ORDER BY l.conv_id), min(l.conv_id) OVER ()) AS following
  FROM last l JOIN turns t ON t.conv_id = l.conv_id AND t.i = l.place),
pairs AS (
  SELECT a.conv_id, a.place, a.n_turns, b.reply AS foreign_reply,
         CASE WHEN a.reply = b.reply THEN a.n_turns ELSE a.place - 1 END AS common_turns
  FROM replies a JOIN replies b ON b.conv_id = a.following),
sides AS (
  SELECT p.*, t.i, t.role, s.side, CASE WHEN s.side = 'r' AND t.i = p.place THEN p.foreign_reply ELSE t.text END AS text
  FROM pairs p JOIN turns t USING (conv_id) CROSS JOIN (VALUES ('c'), ('r')) s(side)),
parts AS (
  SELECT *, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS shown, length(role) + 5 AS head FROM sides),
placed AS (
  SELECT *, coalesce(sum(CASE WHEN i > common_turns THEN length(shown) END) OVER (
      PARTITION BY conv_id, side ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS offs FROM parts)
SELECT conv_id, CAST(n_turns AS INTEGER) AS n_turns, CAST(common_turns AS INTEGER) AS common_turns,
  coalesce(string_agg(shown, '' ORDER BY i) FILTER (side = 'c' AND i <= common_turns), '') AS prompt,
  coalesce(string_agg(shown, '' ORDER BY i) FILTER (side = 'c' AND i > common_turns), '') AS chosen,
  coalesce(string_agg(shown, '' ORDER BY i) FILTER (side = 'r' AND i > common_turns), '') AS rejected,
  coalesce(string_agg(CAST(offs + head AS BIGINT) || '-' || CAST(offs + length(shown) AS BIGINT), ',' ORDER BY i)
    FILTER (side = 'c' AND i > common_turns AND role = 'assistant'), '') AS chosen_mask,
  coalesce(string_agg(CAST(offs + head AS BIGINT) || '-' || CAST(offs + length(shown) AS BIGINT), ',' ORDER BY i)
    FILTER (side = 'r' AND i > common_turns AND role = 'assistant'), '') AS rejected_mask
FROM placed GROUP BY conv_id, n_turns, common_turns
"""
