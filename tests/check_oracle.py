"""Run registered queries against their SQL form: ``python tests/check_oracle.py [sf_dir] [name …]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name: str, run, sql: str, sf_dir: str) -> str:
    """Empty when both engines agree, else what differs."""
    found = run(spark, sf_dir)
    mine = rows_of(found.columns, [tuple(r) for r in found.collect()])
    relation = con.sql(sql)
    theirs = rows_of(relation.columns, relation.fetchall())
    if sorted(found.columns) != sorted(relation.columns):
        return f"columns {sorted(found.columns)} != {sorted(relation.columns)}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows != {len(theirs)}"
    for a, b in zip(mine, theirs, strict=True):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{a} != {b}"
    return "" if mine else "no rows"


def main() -> int:
    from tests.sessions import local_session

    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark, con, bad = local_session(), connect(sf_dir), 0
    sqls = entry.oracle_sql()
    for name, run in entry.queries().items():
        if wanted and name not in wanted:
            continue
        began = time.time()
        try:
            problem = compare(spark, con, name, run, sqls[name], sf_dir) if name in sqls else "no SQL"
        except Exception as error:  # report every query, whatever fails
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem) and problem != "no SQL"
        print(f"{'ok  ' if not problem else 'FAIL'} {name} {time.time() - began:.2f}s {problem}", flush=True)
    print(f"{bad} failed")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
