"""Keyed hash uniforms: repeatable random numbers that Spark and DuckDB both compute.

``u(tag, seed, parts...)`` is the first 32 bits of ``md5('tag|seed|part|...')``
read as an unsigned integer and divided by 2**32, so it lies in [0, 1).  Every
draw names its purpose (a tag such as ``row``, ``col`` or ``split``) and a
seed, so independent draws never share a hash.  Only hash integers and
strings: the text of a double differs between engines.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_32 = 4294967296.0


def _as_col(part) -> Column:
    if isinstance(part, Column):
        return part.cast("string")
    return F.lit(str(part))


def hash_key(tag: str, seed, *parts) -> Column:
    """The string that is hashed: ``tag|seed|part|...``."""
    return F.concat_ws("|", F.lit(tag), F.lit(str(seed)), *[_as_col(p) for p in parts])


def uniform(tag: str, seed, *parts) -> Column:
    """Hash uniform in [0, 1) keyed by the given parts."""
    return uniform_of(hash_key(tag, seed, *parts))


def uniform_of(key: Column) -> Column:
    hex8 = F.substring(F.md5(key), 1, 8)
    return F.conv(hex8, 16, 10).cast("double") / F.lit(TWO_POW_32)


def uniform_value(tag: str, seed, *parts) -> float:
    """:func:`uniform` of plain values, on the driver."""
    key = "|".join(str(p) for p in (tag, seed, *parts))
    return int(hashlib.md5(key.encode()).hexdigest()[:8], 16) / TWO_POW_32


def sql_uniform(tag: str, seed, *parts: str) -> str:
    """DuckDB form of :func:`uniform`; ``parts`` are SQL expressions."""
    items = [f"'{tag}'", f"'{seed}'"] + [f"CAST({p} AS VARCHAR)" for p in parts]
    key = f"concat_ws('|', {', '.join(items)})"
    return f"(CAST(('0x' || substr(md5({key}), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE)"
