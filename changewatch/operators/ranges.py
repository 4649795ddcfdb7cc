"""Which ranges contain an address: an interval join done as an equality join.

Every range of fixed-width hex text is cut into the few prefixes that cover it exactly, without
overlap (an aligned network gives 1 to 8). An address is in the range if and only if one of its own
leading parts is one of those prefixes. Both sides then meet on equality, for any range, with
neither a nested loop nor a limit on the number of ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from changewatch.functions.ip import let


def _digits() -> Column:
    return F.array(*[F.lit(d) for d in "0123456789ABCDEF"])


def _digit(text: Column, position: Column) -> Column:
    return F.substring(text, position, F.lit(1))


def _extend(text: Column, position: Column, keep) -> Column:
    """``text`` up to before ``position``, continued by each digit that ``keep`` accepts."""
    head = F.substring(text, F.lit(1), position - 1)
    return F.transform(F.filter(_digits(), keep), lambda d: F.concat(head, d))


def covering_prefixes(low: Column, high: Column) -> Column:
    """Array of prefixes that cover ``low..high``; both of one width and in this order."""
    def trim(ends: Column) -> Column:
        # past the last place where low has no 0 or high no F, both ends are full
        kept = F.greatest(F.length(F.rtrim(ends["lo"], F.lit("0"))),
                          F.length(F.rtrim(ends["hi"], F.lit("F"))))
        return let(kept, lambda n: F.struct(
            F.left(ends["lo"], n).alias("lo"), F.left(ends["hi"], n).alias("hi"),
            F.sequence(F.lit(1), F.greatest(n, F.lit(1))).alias("places")))

    def split(ends: Column) -> Column:
        lo, hi = ends["lo"], ends["hi"]
        first = F.try_element_at(
            F.filter(ends["places"], lambda i: _digit(lo, i) != _digit(hi, i)), F.lit(1))
        return let(first, lambda at: F.when(at.isNull(), F.array(lo)).otherwise(pieces(ends, at)))

    def pieces(ends: Column, at: Column) -> Column:
        lo, hi = ends["lo"], ends["hi"]
        deeper = F.filter(ends["places"], lambda i: i > at)
        middle = _extend(lo, at, lambda d: (d > _digit(lo, at)) & (d < _digit(hi, at)))
        after_low = F.transform(deeper, lambda i: _extend(lo, i, lambda d: d > _digit(lo, i)))
        before_high = F.transform(deeper, lambda i: _extend(hi, i, lambda d: d < _digit(hi, i)))
        return F.concat(F.array(lo, hi), middle, F.flatten(after_low), F.flatten(before_high))

    ends = F.struct(low.alias("lo"), high.alias("hi"))
    return let(ends, lambda e: let(trim(e), split))


def range_pieces(ranges: DataFrame, low: str, high: str, measures: dict[str, Column]) -> DataFrame:
    """(width, piece, measures): ranges as prefixes, equal prefixes of several ranges merged.
    ``measures`` are aggregates over the ranges. Ranges with a null or reversed end are left out."""
    usable = ranges.filter(
        (F.length(low) == F.length(high)) & (F.col(low) <= F.col(high)))
    pieces = usable.withColumns({
        "width": F.length(low),
        # outer, as an inner one makes Spark repeat the expression in a filter; none is empty
        "piece": F.explode_outer(covering_prefixes(F.col(low), F.col(high)))})
    return pieces.groupBy("width", "piece").agg(
        *[column.alias(name) for name, column in measures.items()])


def match_ranges(addresses: DataFrame, key: str | list[str], hex_column: str, pieces: DataFrame,
                 measures: dict[str, Column], keep: bool = False) -> DataFrame:
    """(key columns, measures) for the addresses that some piece contains, or with ``keep`` for all of them,
    with measures of no rows where none does. ``measures`` are aggregates over the pieces that contain
    the address.

    An address is repeated once for each length that a prefix can have, 9 for IPv4 and 33 for IPv6, so
    the pieces are read once. Key columns travel with it, so that nothing is joined back.
    """
    keys = [key] if isinstance(key, str) else key
    width = F.length(hex_column)
    parts = (
        addresses.filter(F.col(hex_column).isNotNull())
        .select(*keys, F.col(hex_column).alias("digits"), width.alias("width"),
                F.explode(F.sequence(F.lit(0), width)).alias("length"))
        .select(*keys, "width", F.left("digits", F.col("length")).alias("piece"))
    )
    return parts.join(pieces, ["width", "piece"], "left" if keep else "inner").groupBy(*keys).agg(
        *[column.alias(name) for name, column in measures.items()])
