"""Compare a query with its SQL twin, ignoring row order."""

from __future__ import annotations

import glob
import math
import os

import duckdb

TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "double": "DOUBLE",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _key(row):
    return tuple((v is not None, v if not isinstance(v, float) else round(v, 5)) for v in row)


def mismatch(df, con, sql: str) -> str | None:
    """None when the frames agree, else what differs."""
    cursor = con.execute(sql)
    described = {d[0]: str(d[1]) for d in cursor.description}
    theirs = cursor.fetchall()
    names = sorted(df.columns)
    if names != sorted(described):
        return f"columns {names} != {sorted(described)}"
    for field in df.schema.fields:
        kind = field.dataType.simpleString()
        if TYPES.get(kind) != described[field.name]:
            return f"type of {field.name}: {kind} != {described[field.name]}"
    ours = sorted((tuple(r[n] for n in names) for r in df.collect()), key=_key)
    order = [list(described).index(n) for n in names]
    theirs = sorted((tuple(r[i] for i in order) for r in theirs), key=_key)
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)} rows"
    exact = 0
    for a, b in zip(ours, theirs):
        if a == b and all(math.copysign(1, x) == math.copysign(1, y) for x, y in zip(a, b) if isinstance(x, float)):
            exact += 1
            continue
        for x, y in zip(a, b):
            if x != y and not (isinstance(x, float) and isinstance(y, float) and math.isclose(x, y, abs_tol=2e-6)):
                return f"{dict(zip(names, a))} != {dict(zip(names, b))}"
    if exact != len(ours):
        return f"{len(ours) - exact} of {len(ours)} rows differ in the last place or the sign of zero"
    return None if ours else "empty result"
