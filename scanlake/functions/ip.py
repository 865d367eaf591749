"""Address column expressions: order keys of IPv4 and IPv6 (P9), subnet (P10)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scanlake.functions import as_col, let

_IPV4 = r"^[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}$"


def ip_num(ip) -> Column:
    """IPv4 text to a ``bigint`` that sorts like ``inet_aton``; null if not IPv4."""
    c = as_col(ip)
    parts = F.split(c, r"\.")
    octs = [F.try_element_at(parts, F.lit(i)).try_cast("bigint") for i in range(1, 5)]
    ok = c.rlike(_IPV4)
    for o in octs:
        ok = ok & (o <= 255)
    num = octs[0] * 16777216 + octs[1] * 65536 + octs[2] * 256 + octs[3]
    return F.when(ok, num)


def subnet(ip) -> Column:
    """Text before the last dot (P10); without a dot, the text minus its last char."""
    c = as_col(ip)
    return F.when(c.contains("."), F.regexp_replace(c, r"\.[^.]*$", "")).otherwise(
        F.regexp_replace(c, r"(?s).$", ""))


def ip6_key(ip) -> Column:
    """IPv6 text to its 16 bytes as 32 hex digits, which sort like the address; null if not IPv6.

    Groups left out by ``::``, a dotted IPv4 tail and a zone (``%eth0``) are understood.
    """
    c = as_col(ip)

    def hextets(text):
        """The eight groups, from text without a dotted tail; too few or too many where it is no address."""
        return let(F.split(text, "::", -1), lambda halves: let(
            F.transform(halves, lambda half: F.when(half == "", F.array().cast("array<string>")).otherwise(F.split(half, ":", -1))),
            lambda parts: F.when(F.size(parts) == 1, F.get(parts, F.lit(0))).when(
                (F.size(parts) == 2) & (F.size(F.flatten(parts)) < 8),
                F.concat(F.get(parts, F.lit(0)), F.array_repeat(F.lit("0"), 8 - F.size(F.flatten(parts))), F.get(parts, F.lit(1))))))

    def without_tail(text):
        quad = let(F.regexp_extract(text, r"([0-9.]+)$", 1), lambda q: F.lpad(F.lower(F.hex(ip_num(q))), 8, "0"))
        return F.when(text.contains("."), let(quad, lambda q: F.concat(
            F.regexp_extract(text, r"^(.*:)[0-9.]+$", 1), F.substring(q, 1, 4), F.lit(":"), F.substring(q, 5, 4)))).otherwise(text)

    key = let(F.regexp_replace(F.lower(c), "%.*$", ""), lambda raw: let(without_tail(raw), lambda text: let(
        hextets(text), lambda g: F.when(
            (F.size(g) == 8) & F.forall(g, lambda x: x.rlike("^[0-9a-f]{1,4}$")),
            F.array_join(F.transform(g, lambda x: F.lpad(x, 4, "0")), "")))))
    return F.when(c.contains(":"), key)


def address_order(ip="ip", num="ip_num") -> list[Column]:
    """Sort keys of an address: IPv4 by number, then IPv6 by its bytes, then other names as text."""
    return [as_col(num).asc_nulls_last(), ip6_key(ip).asc_nulls_last(), as_col(ip).asc_nulls_last()]
