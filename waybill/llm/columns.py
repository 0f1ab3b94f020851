"""Column expressions that several operators share. All run in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names for helper columns that no column of the table has, whatever its letters' case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name in taken:
            name += "_"
        taken.add(name)
        out.append(name)
    return out


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else. A text of ASCII only takes the faster ``lower``, which then does the same."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def fold(doc_id: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``. A null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % parts


def md5_number(text: Column) -> Column:
    """The first 52 bits of the MD5 of a text, as a long: the same number in any engine that has MD5."""
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def unit(text: Column) -> Column:
    """A number inside (0, 1) that the text decides."""
    return (md5_number(text) + F.lit(0.5)) / F.lit(float(2**52))
