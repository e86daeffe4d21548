"""Run registered queries and their checking SQL side by side.

    python tests/check_oracles.py [scale] [query ...]
"""

from __future__ import annotations

import pathlib
import sys
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def normalise(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple("" if row[i] is None else f"{row[i]}" for i in order) for row in rows]
    return [columns[i] for i in order], sorted(out)


def compare(spark, con, name: str, query, sql: str, sf_dir: str) -> tuple[bool, str]:
    start = time.time()
    df = query(spark, sf_dir)
    got_columns, got = normalise(df.columns, [tuple(r) for r in df.collect()])
    spark_seconds = time.time() - start
    start = time.time()
    result = con.execute(sql)
    want_columns, want = normalise([d[0] for d in result.description], result.fetchall())
    took = f"spark {spark_seconds:.1f}s duckdb {time.time() - start:.1f}s"
    if got_columns != want_columns:
        return False, f"columns {got_columns} != {want_columns}"
    if got != want:
        only_got = sorted(set(got) - set(want))[:2]
        only_want = sorted(set(want) - set(got))[:2]
        return False, f"{took} rows {len(got)} vs {len(want)}\n   spark  {only_got}\n   duckdb {only_want}"
    return True, f"{took} rows {len(got)}"


def main() -> int:
    import __spark_entry__ as entry_points
    from conftest import make_session

    scale, wanted = (sys.argv[1:2] or ["0.001"])[0], sys.argv[2:]
    sf_dir = f"/root/testdata/sf{scale}"
    spark, con = make_session(), connect(sf_dir)
    failed = 0
    oracles = entry_points.oracle_sql()
    for name, query in entry_points.queries().items():
        if wanted and name not in wanted:
            continue
        if name not in oracles:
            print(f"{name:28s} no SQL", flush=True)
            continue
        try:
            ok, note = compare(spark, con, name, query, oracles[name], sf_dir)
        except Exception as error:  # report and go on with the next query
            ok, note = False, f"{type(error).__name__}: {str(error)[:900]}"
        failed += not ok
        print(f"{name:28s} {'ok  ' if ok else 'FAIL'} {note}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
