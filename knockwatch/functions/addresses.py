"""IPv4 text helpers: subnet keys, private ranges, dotted prefixes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _parts(ip: Column) -> Column:
    return F.split(ip, "[.]")


def subnet_key(ip: Column) -> Column:
    """First three octets; text without exactly four parts is its own key."""
    return F.when(F.size(_parts(ip)) == 4, F.substring_index(ip, ".", 3)).otherwise(ip)


def has_four_parts(ip: Column) -> Column:
    return F.size(_parts(ip)) == 4


def is_private(ip: Column) -> Column:
    """10.0.0.0/8, 172.16.0.0/12 or 192.168.0.0/16; parts that are no numbers are not private."""
    first = F.get(_parts(ip), F.lit(0)).try_cast("int")
    second = F.get(_parts(ip), F.lit(1))
    return F.coalesce(
        (first == 10)
        | ((first == 172) & second.try_cast("int").between(16, 31))
        | ((first == 192) & (second == "168")),
        F.lit(False),
    )


def is_subnet(ip: Column) -> Column:
    return ip.contains("/")


def covered_prefix(subnet: Column) -> Column:
    """``a.b.c.0/24`` → ``a.b.c``: the dotted prefix an address must have to be covered."""
    return F.regexp_replace(F.substring_index(subnet, "/", 1), r"[.]0\z", "")


def dotted_prefixes(ip: Column) -> Column:
    """Every proper prefix of ``ip`` that ends before a dot: ``a``, ``a.b``, ``a.b.c``.

    ``ip`` starts with ``p + '.'`` exactly when ``p`` is in this array, which turns
    a prefix comparison into an equi-join.
    """
    dots = F.size(_parts(ip)) - 1
    return F.when(
        dots > 0,
        F.transform(
            F.sequence(F.lit(1), dots),
            lambda i: F.call_function("substring_index", ip, F.lit("."), i),
        ),
    ).otherwise(F.array().cast("array<string>"))
