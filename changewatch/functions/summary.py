r"""Edit-summary parsing.

A machine-written summary looks like ``/* action:param0|param1|param2 */ free text``.

Every column is one pattern over the summary, or over the part it nests in, and refers to its input
once. Filters on the action or a parameter are pushed through the parsing down to the comment scan;
with several references per step the pushed-down expression would grow with every level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from changewatch.functions.actions import actions_of, category_of

SUMMARY_COLUMNS = [
    "summary_magic", "summary_free", "summary_action", "summary_rest",
    "summary_param0", "summary_param1", "summary_param2", "summary_param3",
    "summary_property", "summary_value", "summary_category",
]

# Fixed values. ``(?d)``: only a line feed ends a line.
MAGIC = r"(?d)^/\* (.+?) \*/"
FREE = r"(?d)^/\* .+? \*/ ?(.*)"
ACTION = r"(?d)^/\* ([a-z\-]+):.*? \*/"
REST = r"(?d)^/\* [a-z\-]+:(.*?) \*/"
# parameter 0 is a number; an empty parameter is missing and moves nothing
PARAMS = [r"^(\d+)\|", r"^\d+\|([^|]+)", r"^\d+\|[^|]*\|([^|]+)", r"^\d+\|[^|]*\|[^|]*\|([^|]+)"]
PROPERTY = r"(?d)^\[\[Property:(P\d+)]]: "
VALUE = r"(?d)^\[\[Property:P\d+]]: (.*)$"


def _match(text: Column, pattern: str) -> Column:
    """Group 1 of the match; null without a match, empty where the group is."""
    return F.try_element_at(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), F.lit(1))


def action(text: Column) -> Column:
    return _match(text, ACTION)


def param(text: Column, index: int) -> Column:
    return _match(_match(text, REST), PARAMS[index])


def _claim_part(text: Column, pattern: str) -> Column:
    is_claim = action(text).isin(actions_of("allclaims"))
    return F.when(is_claim, _match(_match(text, FREE), pattern))


def with_summary(df: DataFrame, text: str = "comment_text") -> DataFrame:
    """Add the summary columns to ``df``."""
    summary = F.col(text)
    return df.withColumns({
        "summary_magic": _match(summary, MAGIC),
        "summary_free": _match(summary, FREE),
        "summary_action": action(summary),
        "summary_rest": _match(summary, REST),
        **{f"summary_param{i}": param(summary, i) for i in range(len(PARAMS))},
        "summary_property": _claim_part(summary, PROPERTY),
        "summary_value": _claim_part(summary, VALUE),
        "summary_category": category_of(action(summary)),
    })
