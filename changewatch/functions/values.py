"""Small shared expressions: tolerant parsing, rounding, time keys, bins."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, functions as F


def parse_time(text: Column) -> Column:
    """14-digit text to a zone-free timestamp; anything else is null.

    The ISO form is put together and cast, so neither the session zone nor a formatter is involved.
    """
    def part(start: int, length: int) -> Column:
        return F.substring(text, start, length)

    iso = F.concat(part(1, 4), F.lit("-"), part(5, 2), F.lit("-"), part(7, 2), F.lit(" "),
                   part(9, 2), F.lit(":"), part(11, 2), F.lit(":"), part(13, 2))
    digits_only = F.translate(text, "0123456789", "") == ""
    return F.when((F.length(text) == 14) & digits_only, iso.try_cast("timestamp_ntz"))


def time_literal(value: datetime) -> Column:
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def stamp_literal(value: datetime) -> Column:
    return F.lit(value.strftime("%Y%m%d%H%M%S"))


def item_number(title: Column) -> Column:
    """``Q42`` to 42; null when the rest is not a number."""
    return F.substring(title, F.lit(2), F.length(title)).try_cast("bigint")


def epoch_seconds(time: Column) -> Column:
    """Seconds from 1970 of a zone-free timestamp, from its parts: the session zone has no say."""
    days = F.unix_date(F.to_date(time)).cast("bigint")
    return days * 86400 + F.hour(time) * 3600 + F.minute(time) * 60 + F.second(time)


def seconds_between(start: Column, end: Column) -> Column:
    return epoch_seconds(end) - epoch_seconds(start)


def round_half_even(value: Column, digits: int) -> Column:
    """Round a double half to even on the scaled value."""
    scale = float(10 ** digits)
    return F.rint(value * scale) / scale


def percent(part: Column, whole: Column, digits: int) -> Column:
    """``100 * part / whole`` rounded half to even; null when the whole is 0."""
    ratio = F.try_divide(part.cast("double"), whole.cast("double")) * 100.0
    return round_half_even(ratio, digits)


def status_name(patrolled: Column) -> Column:
    return F.when(patrolled == 0, "open").when(patrolled == 1, "reviewed")


def editor_name(actor_user: Column) -> Column:
    return F.when(actor_user.isNull(), "anon").otherwise("registered")


def equal_width_bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Index 0..bins-1 of ``value`` among equal-width bins from ``low`` to ``high``.

    A bin holds its lower edge, the last one also its upper edge. Where ``low = high`` the range is
    widened by 0.5 on each side. The floor is checked against the edges, so a value that sits on an
    edge does not slip into the neighbour by a rounding error.
    """
    lo = F.when(low == high, low - 0.5).otherwise(low)
    hi = F.when(low == high, high + 0.5).otherwise(high)
    step = (hi - lo) / float(bins)
    guess = F.least(F.floor((value - lo) / (hi - lo) * float(bins)), F.lit(bins - 1))
    return (
        F.when(value < lo + guess * step, guess - 1)
        .when((guess < bins - 1) & (value >= lo + (guess + 1) * step), guess + 1)
        .otherwise(guess)
        .cast("bigint")
    )
