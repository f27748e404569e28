"""Names for helper columns."""

from __future__ import annotations


def unused(name: str, *columns: list[str]) -> str:
    """The name, with as many underscores as it takes not to be among the columns."""
    taken = {column.lower() for names in columns for column in names}
    while name.lower() in taken:
        name += "_"
    return name
