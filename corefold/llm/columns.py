"""Names for columns that an operator adds for its own use, beside whatever columns a table has."""

from __future__ import annotations

from collections.abc import Iterable


def fresh(taken: Iterable[str], *wanted: str) -> list[str]:
    """The wanted names; underscores are put after those that are taken (Spark's names differ by more than case)."""
    used = {c.lower() for c in taken}
    out = []
    for name in wanted:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out
