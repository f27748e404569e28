"""Names that do not clash, and shares of rows by hash."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def unused(name: str, columns: list[str]) -> str:
    """The name, with as many underscores as it takes not to be among the columns."""
    taken = {column.lower() for column in columns}
    while name.lower() in taken:
        name += "_"
    return name


def sampled_by(hashed: Column, rows: int, total: int) -> Column:
    """Whether a row is among about `rows` of `total`, by its 64-bit hash; exact at any size."""
    limit = (2**63 - 1) * min(rows, total) // max(total, 1)
    return F.shiftrightunsigned(hashed, 1) <= F.lit(limit).cast("long")
