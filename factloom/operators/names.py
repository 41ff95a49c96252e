"""Names of helper columns."""

from __future__ import annotations


def unused(columns: list[str], *names: str) -> list[str]:
    """Names for helper columns that no column of ``columns`` has, whatever its case."""
    taken, out = {c.lower() for c in columns}, []
    for n in names:
        while n in taken:
            n += "_"
        out.append(n)
    return out
