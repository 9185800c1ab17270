"""Header names: normalising, telling repeats apart, finding the last repeat."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

UNNAMED = "unnamed_column"


def snake_name(name: str) -> str:
    """``Credit Source(w/o Payer)`` as ``credit_source_w_o_payer``."""
    return re.sub(r"[\W_]+", "_", name).lower().strip("_") or UNNAMED


def snake_column(c: Column) -> Column:
    """The same rule for names held as data."""
    joined = F.btrim(F.lower(F.regexp_replace(c, r"[^\p{L}\p{N}]+", "_")), F.lit("_"))
    return F.when(joined == "", UNNAMED).otherwise(joined)


def distinct_names(names: Sequence[str], joiner: str = ".") -> list[str]:
    """Repeats get a running number: ``X, X`` as ``X, X.1``."""
    taken: set[str] = set(names)
    seen: dict[str, int] = {}
    out = []
    for name in names:
        number = seen.get(name, 0)
        seen[name] = number + 1
        if number:
            while f"{name}{joiner}{number}" in taken:
                number += 1
            seen[name] = number + 1
            name = f"{name}{joiner}{number}"
            taken.add(name)
        out.append(name)
    return out


def column_names(header: Sequence[str]) -> list[str]:
    """Table column names for a delivered header, always unique.

    A blank header cell is known by its position, counted from zero.
    """
    filled = [h.strip() or f"Unnamed: {i}" for i, h in enumerate(header)]
    return distinct_names([snake_name(n) for n in distinct_names(filled)], joiner="_")


def last_positions(header: Sequence[str]) -> list[int]:
    """For each header cell the position of the last cell of that name."""
    last = {name: i for i, name in enumerate(header)}
    return [last[name] for name in header]
