r"""Addresses and networks as fixed-width upper-case hex text: 8 digits for IPv4, 32 for IPv6.

A 128-bit value fits no numeric type, while hex text of one width sorts like the number, and a
leading part of it is a network. The version is the width, so the two never mix.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

_OCTET = r"(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_IPV4 = rf"^{_OCTET}(\.{_OCTET}){{3}}$"
_GROUP = "[0-9A-Fa-f]{1,4}"
_IPV6_FULL = f"^({_GROUP}:){{7}}{_GROUP}$"
_IPV6_SHORT = f"^({_GROUP}(:{_GROUP})*)?::({_GROUP}(:{_GROUP})*)?$"

V6_MARK = "v6-"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once. Without it every use of an intermediate result
    repeats its expression, and nested steps multiply."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _ipv4_hex(address: Column) -> Column:
    """Hex of a dotted address that is known to be valid."""
    return F.array_join(F.transform(
        F.split(address, r"\."), lambda octet: F.lpad(F.hex(octet.try_cast("bigint")), 2, "0")), "")


def _without_dotted_tail(address: Column) -> Column:
    """``::ffff:1.2.3.4`` as ``::ffff:0102:0304``."""
    def replace(tail: Column) -> Column:
        head = F.substring(address, F.lit(1), F.length(address) - F.length(tail))
        return F.when(tail.rlike(_IPV4), let(_ipv4_hex(tail), lambda digits: F.concat(
            head, F.substring(digits, 1, 4), F.lit(":"), F.substring(digits, 5, 4))))

    return F.coalesce(let(F.substring_index(address, ":", -1), replace), address)


def _ipv6_hex(address: Column) -> Column:
    """Hex of a colon form with valid groups; null when there are too many or too few of them."""
    # a side of "::" as its groups; the side may be empty
    sides = F.transform(F.split(address, "::"), lambda side: F.filter(
        F.split(side, ":"), lambda group: group != ""))

    def join(groups: Column) -> Column:
        short = F.size(groups) == 2
        left, right = F.get(groups, F.lit(0)), F.when(short, F.get(groups, F.lit(1))) \
            .otherwise(F.array().cast("array<string>"))
        missing = F.lit(8) - F.size(left) - F.size(right)
        full = F.concat(left, F.array_repeat(F.lit("0"), F.greatest(missing, F.lit(0))), right)
        return F.when(F.when(short, missing >= 1).otherwise(missing == 0), F.upper(
            F.array_join(F.transform(full, lambda group: F.lpad(group, 4, "0")), "")))

    return let(sides, join)


def address_hex(address: Column) -> Column:
    """Hex form of an address; null for anything that is not one."""
    def colon_form(text: Column) -> Column:
        return F.when(text.rlike(_IPV6_FULL) | text.rlike(_IPV6_SHORT), _ipv6_hex(text))

    return let(address, lambda text: F.when(text.rlike(_IPV4), _ipv4_hex(text)).when(
        text.contains(":"), let(_without_dotted_tail(text), colon_form)))


def _mask_length(mask: Column) -> Column:
    """Prefix length of a dotted mask, either as net mask or as host mask."""
    def length(bits: Column) -> Column:
        ones = F.length(F.translate(bits, "0", ""))
        return F.when(bits.rlike("^1*0*$"), ones).when(bits.rlike("^0*1*$"), F.lit(32) - ones)

    return F.when(mask.rlike(_IPV4), let(F.lpad(F.conv(_ipv4_hex(mask), 16, 2), 32, "0"), length))


def network(name: Column) -> Column:
    """Struct (digits, length): hex of the address part and prefix length of an address or network;
    null for others. Bits past the prefix may be set."""
    def parse(text: Column) -> Column:
        suffix = F.when(text.contains("/"),
                        F.substring(text, F.locate("/", text) + 1, F.length(text)))
        return let(F.struct(address_hex(F.substring_index(text, "/", 1)).alias("digits"),
                            suffix.alias("suffix")), with_length)

    def with_length(part: Column) -> Column:
        suffix, width = part["suffix"], F.length(part["digits"]) * 4
        length = (
            F.when(suffix.isNull(), width)
            .when(suffix.rlike("^[0-9]+$"), suffix.try_cast("int"))
            .when(width == 32, _mask_length(suffix))
        )
        return let(F.struct(part["digits"].alias("digits"), length.alias("length")),
                   lambda net: F.when(net["length"].between(
                       F.lit(0), F.length(net["digits"]) * 4), net))

    return let(name, parse)


def _type_of(net: Column) -> Column:
    width = F.length(net["digits"]) * 4
    version = F.when(width == 32, "ipv4").otherwise("ipv6")
    return F.when(net.isNull(), F.lit("registered")).otherwise(
        F.concat(version, F.when(net["length"] == width, "").otherwise("range")))


def _fill(net: Column, ones: bool) -> Column:
    """The digits with all bits past the prefix set to 0 or 1."""
    digits, length = net["digits"], net["length"]
    whole = F.floor(length / 4).cast("int")
    digit = F.conv(F.substring(digits, whole + 1, F.lit(1)), 16, 10).cast("int")
    block = F.lit(16) / F.pow(F.lit(2), length % 4)
    low = F.floor(digit / block) * block
    edge = F.hex((low + block - 1 if ones else low).cast("bigint"))
    kept = F.concat(F.substring(digits, F.lit(1), whole),
                    F.when(length % 4 > 0, edge).otherwise(F.lit("")))
    return F.rpad(kept, F.length(digits), "F" if ones else "0")


def with_user_kind(df: DataFrame, name: str) -> DataFrame:
    """Add what a user name stands for (``user_type``: an address, a network of several addresses or
    an account) and, for the first two, the hex of its first and last address (``low``, ``high``)."""
    kind = let(network(F.col(name)), lambda net: F.struct(
        _type_of(net).alias("user_type"), _fill(net, ones=False).alias("low"),
        _fill(net, ones=True).alias("high")))
    # a generated row is parsed once; as a plain column every filter on it would repeat the parsing
    return df.select("*", F.explode(F.array(kind)).alias("kind")).select(*df.columns, "kind.*")


def with_address_hex(df: DataFrame, name: str, column: str = "digits") -> DataFrame:
    """Add the hex form of an address, computed once per row as above."""
    return df.select("*", F.explode(F.array(address_hex(F.col(name)))).alias(column))


def strip_mark(key: Column) -> Column:
    """Hex of a stored range end, which has a mark in front when it is IPv6."""
    return F.when(key.startswith(V6_MARK), F.substring(key, F.lit(len(V6_MARK) + 1), F.length(key))) \
        .otherwise(key)
