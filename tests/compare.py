"""Compare queries with their SQL: python tests/compare.py SF [NAME ...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from obs_engine.queries import ORACLES, QUERIES  # noqa: E402
from obs_engine.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


def ordered(rows: list[tuple], names: list[str]) -> list[tuple]:
    places = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(row[i] for i in places) for row in rows), key=repr)


def differences(spark, connection, name: str, sf_dir: str) -> str | None:
    """None if the rows of a query equal those of its SQL, else what differs."""
    df = QUERIES[name](spark, sf_dir)
    got = ordered([tuple(r) for r in df.collect()], df.columns)
    cursor = connection.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    want = ordered(cursor.fetchall(), names)
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows and {len(want)}"
    for mine, theirs in zip(got, want):
        if mine != theirs or [type(v) for v in mine] != [type(v) for v in theirs]:
            return f"{sorted(names)}\n  {mine}\n  {theirs}"
    return None if got else "no rows"


if __name__ == "__main__":
    folder = f"/root/testdata/sf{sys.argv[1]}"
    session, base = local_session(), duck(folder)
    for key in sys.argv[2:] or list(QUERIES):
        start = time.time()
        try:
            found = differences(session, base, key, folder)
        except Exception as error:
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{'ok  ' if not found else 'FAIL'} {time.time() - start:6.1f}s {key} {found or ''}", flush=True)
