"""IP addresses of both families as 128-bit numbers, and their prefixes.

An IPv4 address is the number of its mapped form ::ffff:a.b.c.d, so a table of prefixes may hold both families. A number is two
BIGINTs, the high and the low half.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# What an IPv4 prefix is longer by in the mapped form.
MAPPED = 96

_GROUP = r"^[0-9a-f]{1,4}$"
_IPV4 = r"^\d{1,3}(\.\d{1,3}){3}$"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once: written out wherever it occurs, the expression would grow without measure."""
    return F.get(F.transform(F.array(value), use), 0)


def _ipv4_hex(text: Column) -> Column:
    """Eight hex digits of a dotted IPv4 address; NULL for anything else."""

    def digits(parts: Column) -> Column:
        fits = text.rlike(_IPV4) & F.forall(parts, lambda p: F.coalesce(p <= 255, F.lit(False)))
        return F.when(fits, F.array_join(F.transform(parts, lambda p: F.lpad(F.lower(F.hex(p)), 2, "0")), ""))

    return _let(F.transform(F.split(text, r"\."), lambda p: p.try_cast("int")), digits)


def _groups(text: Column) -> Column:
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, ":"))


def _filled(sides: Column, left: Column, right: Column) -> Column:
    """The digits of eight groups, from those on either side of the `::` (or of all, where there is none)."""
    known = F.size(left) + F.size(right)
    zeros = F.array_repeat(F.lit("0"), F.greatest(8 - known, F.lit(0)))
    groups = F.when(sides == 1, left).when(sides == 2, F.concat(left, zeros, right))

    def digits(groups: Column) -> Column:
        whole = (F.size(groups) == 8) & ((sides == 1) | (known < 8)) & F.forall(groups, lambda g: g.rlike(_GROUP))
        return F.when(whole, F.array_join(F.transform(groups, lambda g: F.lpad(g, 4, "0")), ""))

    return _let(groups, digits)


def _ipv6_hex(text: Column) -> Column:
    def without_dots(tail: Column) -> Column:
        """A dotted tail becomes two groups."""
        head = F.substring(text, F.lit(1), F.length(text) - F.length(tail))
        six = _let(_ipv4_hex(tail), lambda d: F.concat(head, d.substr(1, 4), F.lit(":"), d.substr(5, 4)))
        return F.when(tail == "", text).otherwise(six)

    six = _let(F.regexp_extract(text, r":(\d+\.\d+\.\d+\.\d+)$", 1), without_dots)

    def by_sides(sides: Column) -> Column:
        return _let(
            _groups(F.get(sides, 0)),
            lambda left: _let(
                _groups(F.coalesce(F.get(sides, 1), F.lit(""))), lambda right: _filled(F.size(sides), left, right)
            ),
        )

    return _let(F.split(six, "::", 3), by_sides)


def address_hex(ip: Column) -> Column:
    """The 32 hex digits of an address; NULL for what is none.

    IPv6 may leave out one run of zero groups (`::`), and end in a dotted IPv4 address. White space around it, upper case
    and leading zeros of a group change nothing; zones (`%eth0`) and brackets are no part of an address.
    """
    mapped = "0" * 20 + "ffff"
    return _let(
        F.lower(F.trim(ip)),
        lambda text: F.when(text.contains(":"), _ipv6_hex(text)).otherwise(F.concat(F.lit(mapped), _ipv4_hex(text))),
    )


def _half(digits: Column) -> Column:
    return F.conv(digits, 16, -10).cast("bigint")


def address_number(ip: Column) -> Column:
    """An address as struct<high bigint, low bigint> (two's complement); NULL for what is none."""
    return _let(
        address_hex(ip),
        lambda digits: F.when(
            digits.isNotNull(), F.struct(_half(digits.substr(1, 16)).alias("high"), _half(digits.substr(17, 16)).alias("low"))
        ),
    )


def is_ipv4(ip: Column) -> Column:
    return F.trim(ip).rlike(_IPV4)


def _mask(half: Column, bits: Column) -> Column:
    """The first `bits` (0 to 64) bits of a half."""
    shift = F.least(F.lit(63), 64 - bits).cast("int")
    kept = half.bitwiseAND(F.call_function("shiftleft", F.lit(-1).cast("bigint"), shift))
    return F.when(bits <= 0, F.lit(0).cast("bigint")).when(bits >= 64, half).otherwise(kept)


def prefix_of(number: Column, length: Column) -> Column:
    """The first `length` bits of an address number, as a number with zeros behind them."""
    high = F.least(length, F.lit(64))
    return _let(
        number,
        lambda n: F.struct(_mask(n["high"], high).alias("high"), _mask(n["low"], length - high).alias("low")),
    )
