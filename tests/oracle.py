"""Run registered queries beside their SQL in DuckDB and compare the rows."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as contract  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=repr)


def close(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return abs(a - b) <= 2e-6
    return a == b


def compare(spark, con, name: str, sf_dir: str) -> list[str]:
    df = contract.queries()[name](spark, sf_dir)
    got_columns, got = _sorted(df.columns, df.collect())
    sql = contract.oracle_sql().get(name)
    if sql is None:
        return [] if got else [f"{name}: no rows"]
    result = con.execute(sql)
    want_columns, want = _sorted([d[0] for d in result.description], result.fetchall())
    problems = []
    if got_columns != want_columns:
        return [f"{name}: columns {got_columns} want {want_columns}"]
    if len(got) != len(want):
        return [f"{name}: {len(got)} rows want {len(want)}"]
    if not got:
        problems.append(f"{name}: empty")
    if got != want:
        exact = sum(a != b for a, b in zip(got, want))
        loose = [(a, b) for a, b in zip(got, want) if not all(map(close, a, b))]
        problems.append(f"{name}: {exact} rows differ, {len(loose)} beyond rounding")
        for a, b in (loose or [(a, b) for a, b in zip(got, want) if a != b])[:2]:
            problems.append(f"  got  {dict(zip(got_columns, a))}\n  want {dict(zip(want_columns, b))}")
    types = [type(v).__name__ for v in want[0]] if want else []
    mine = [type(v).__name__ for v in got[0]] if got else []
    if types != mine and not any("None" in t for t in types + mine):
        problems.append(f"{name}: types {mine} want {types}")
    return problems


if __name__ == "__main__":
    from gridmotion.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(contract.queries())
    session = build_session("oracle", master="local[8]", **{"spark.sql.shuffle.partitions": "8"})
    session.sparkContext.setLogLevel("OFF")
    con, bad = connect(sf), 0
    for query_name in chosen:
        start = time.time()
        try:
            found = compare(session, con, query_name, sf)
        except Exception as error:  # report every query
            found = [f"{query_name}: {type(error).__name__} {str(error)[:600]}"]
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {query_name} {time.time() - start:.1f}s", flush=True)
        for line in found:
            print("   ", line)
    print(f"{len(chosen) - bad} of {len(chosen)} agree")
