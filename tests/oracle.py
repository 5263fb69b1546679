"""Compare a registered query with its SQL twin; also a small command line."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=lambda r: tuple(map(str, r)))


def differences(df, con, sql: str) -> list[str]:
    """Texts describing what differs; empty if columns, types and rows agree."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    found = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    want = _rows(names, expected)
    if len(got) != len(want):
        found.append(f"rows {len(got)} != {len(want)}")
    for g, w in zip(got, want):
        if g != w or [type(x) for x in g] != [type(x) for x in w]:
            found.append(f"{g} != {w}")
            if len(found) > 4:
                break
    return found


def main(argv: list[str]) -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as entry

    from tests.conftest import new_session

    sf_dir = f"/root/testdata/sf{argv[0]}"
    spark, con = new_session(), connect(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in argv[1:] or oracle:
        start = time.time()
        try:
            found = differences(queries[name](spark, sf_dir), con, oracle[name])
        except Exception as error:  # noqa: BLE001
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {time.time() - start:6.1f}s {name}", *found, sep="\n       " if found else " ", flush=True)
    print("failed:", failed, "missing oracle:", sorted(set(queries) - set(oracle)))
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
