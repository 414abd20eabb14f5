"""Compare a registered query with its SQL on the same parquet files."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


KINDS = {
    "bigint": "long", "long": "long", "int": "int", "integer": "int", "double": "double",
    "string": "string", "varchar": "string", "boolean": "boolean",
}


def difference(spark_df, con, sql: str) -> str | None:
    """None if columns, types and the bag of rows agree."""
    relation = con.sql(sql)
    ours = {c: KINDS.get(t, t) for c, t in spark_df.dtypes}
    theirs = {c: KINDS.get(str(t).lower(), str(t)) for c, t in zip(relation.columns, relation.types)}
    if ours != theirs:
        return f"schema: spark {ours}, sql {theirs}"
    names = sorted(ours)
    left = Counter(tuple(_plain(row[n]) for n in names) for row in spark_df.collect())
    places = [relation.columns.index(n) for n in names]
    right = Counter(tuple(_plain(row[p]) for p in places) for row in relation.fetchall())
    if left == right:
        return None
    return (
        f"rows: spark {sum(left.values())}, sql {sum(right.values())}; "
        f"only spark {list((left - right).items())[:3]}, only sql {list((right - left).items())[:3]}"
    )
