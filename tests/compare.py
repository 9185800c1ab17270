"""Comparison of a query with its SQL on the same tables."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def spark_rows(df):
    names = sorted(df.columns)
    rows = df.select(*[f"`{n}`" for n in names]).collect()
    return names, Counter(tuple(_plain(v) for v in r) for r in rows)


def duck_rows(sql: str, folder: str):
    con = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = Counter(tuple(_plain(r[i]) for i in order) for r in result.fetchall())
    return [names[i] for i in order], rows, types


DUCK_OF = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


def difference(df, sql: str, folder: str) -> str | None:
    """What differs, or None."""
    names, got = spark_rows(df)
    wanted_names, wanted, types = duck_rows(sql, folder)
    if names != wanted_names:
        return f"columns {set(names) ^ set(wanted_names)}"
    kinds = dict(df.dtypes)
    off = [(n, kinds[n], types[n]) for n in names if DUCK_OF.get(kinds[n]) != types[n]]
    if got != wanted:
        more, less = got - wanted, wanted - got
        return (
            f"rows {sum(got.values())} / {sum(wanted.values())}, names {names}\n"
            f"only spark {sum(more.values())}: {list(more)[:2]}\n"
            f"only sql {sum(less.values())}: {list(less)[:2]}"
        )
    if off:
        return f"types {off}"
    return None
