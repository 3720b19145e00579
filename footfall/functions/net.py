"""Address text to number, or to a key of either family."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ip_number(ip: str) -> Column:
    """Column ``ip`` (dotted IPv4 text) as a bigint; null for anything else, IPv6 included."""
    parts = f"split({ip}, r'\\.')"
    octets = [f"try_cast(get({parts}, {i}) AS BIGINT)" for i in range(4)]
    valid = " AND ".join([f"size({parts}) = 4", *[f"{octet} BETWEEN 0 AND 255" for octet in octets]])
    number = " + ".join(f"{octet} * {256 ** (3 - i)}" for i, octet in enumerate(octets))
    return F.expr(f"CASE WHEN {valid} THEN {number} END")


# Fixed value: where IPv6 has the IPv4 addresses (::ffff:0:0/96), as hexadecimal digits.
V4_PREFIX = "0" * 20 + "ffff"


def _octets(text: str) -> str:
    """Eight hexadecimal digits of dotted IPv4 text; null for anything else."""
    parts = f"transform(split({text}, '[.]'), p -> CAST(p AS INT))"
    dotted = f"{text} RLIKE '^[0-9]{{1,3}}([.][0-9]{{1,3}}){{3}}$'"
    digits = f"lower(array_join(transform({parts}, n -> lpad(hex(n), 2, '0')), ''))"
    return f"CASE WHEN {dotted} THEN CASE WHEN forall({parts}, n -> n <= 255) THEN {digits} END END"


def ip_key(ip: str) -> Column:
    """Column ``ip`` (IPv4 or IPv6 text) as 32 hexadecimal digits, IPv4 as the mapped IPv6 address; null for anything else.

    An IPv6 address may leave out one run of groups by ``::`` and end in a dotted IPv4 address; it may not name a zone.
    """
    tail = "substring_index(t, ':', -1)"
    # A dotted tail stands for two groups.
    low = f"get(transform(array({_octets(tail)}), v -> concat(substr(v, 1, 4), ':', substr(v, 5, 4))), 0)"
    in_groups = f"CASE WHEN contains({tail}, '.') THEN concat(left(t, length(t) - length({tail})), {low}) ELSE t END"
    # What stands before and after the left-out run, each as a list of groups.
    sides = "transform(split(h, '::', -1), s -> filter(split(s, ':', -1), g -> s != ''))"
    padded = lambda i: f"array_join(transform(get(s, {i}), g -> lpad(g, 4, '0')), '')"
    sound = "forall(flatten(s), g -> g RLIKE '^[0-9a-f]{1,4}$')"
    whole = f"CASE WHEN size(s) = 1 AND size(get(s, 0)) = 8 AND {sound} THEN {padded(0)}"
    gap = "repeat('0', 32 - 4 * (size(get(s, 0)) + size(get(s, 1))))"
    short = f"WHEN size(s) = 2 AND size(flatten(s)) < 8 AND {sound} THEN concat({padded(0)}, {gap}, {padded(1)}) END"
    v6 = f"get(transform(array({in_groups}), h -> get(transform(array({sides}), s -> {whole} {short}), 0)), 0)"
    key = f"CASE WHEN contains(t, ':') THEN {v6} ELSE concat('{V4_PREFIX}', {_octets('t')}) END"
    return F.expr(f"get(transform(array(lower(trim({ip}))), t -> {key}), 0)")
