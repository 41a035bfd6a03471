"""Packet-level expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Flag letters in the order of their bits, lowest first.
FLAG_LETTERS = "FSRPAUECN"


def protocol_class(protocol: Column, fragment_offset: Column | None = None) -> Column:
    """``tcp``, ``udp``, ``icmp`` or ``other``; a later fragment carries no transport header."""
    known = (F.when(protocol == 6, "tcp").when(protocol == 17, "udp")
             .when(protocol == 1, "icmp").otherwise("other"))
    if fragment_offset is None:
        return known
    return F.when(fragment_offset > 0, "other").otherwise(known)


def flag_letters(bits: Column) -> Column:
    """TCP flag bits as letters."""
    return F.concat(*[
        F.when(bits.bitwiseAND(1 << i) != 0, letter).otherwise("")
        for i, letter in enumerate(FLAG_LETTERS)])


def has_flag(flags: Column, letter: str) -> Column:
    return F.contains(flags, F.lit(letter))


def flow_key(*parts: Column) -> Column:
    """Text key of a flow. A missing part is spelt ``None``, so no part is ever skipped."""
    return F.concat_ws("_", *[F.coalesce(p.cast("string"), F.lit("None")) for p in parts])


def rate(amount: Column, seconds: Column) -> Column:
    """Amount per second; the amount itself when no time has passed."""
    return F.when(seconds > 0, amount / seconds).otherwise(amount.cast("double"))


def dotted(address: Column) -> Column:
    """A 32-bit IPv4 address held in a BIGINT as dotted text."""
    return F.concat_ws(".", *[
        F.shiftrightunsigned(address, s).bitwiseAND(255).cast("string") for s in (24, 16, 8, 0)])
