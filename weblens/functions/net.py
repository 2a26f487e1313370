"""IPv4 addresses as numbers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from weblens.functions.text import as_col

_IPV4 = r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}\z"


def ipv4_to_long(column: Column | str) -> Column:
    """BIGINT of a dotted IPv4 address, NULL when it is not one."""
    text = as_col(column)
    octets = F.split(text, r"\.")
    a, b, c, d = (F.get(octets, F.lit(i)).try_cast("int").cast("bigint") for i in range(4))
    valid = text.rlike(_IPV4) & (F.greatest(a, b, c, d) < 256)
    return F.when(valid, ((a * 256 + b) * 256 + c) * 256 + d)
