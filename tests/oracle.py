"""Run queries against their SQL in DuckDB and compare whole results."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb


def duck(sf_dir: str):
    """A DuckDB connection with the test tables as views."""
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


# Spark type names and what DuckDB calls them.
TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return repr(v)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(spark_df, con, sql: str) -> list[str]:
    """What differs between a query result and its SQL; empty when nothing does."""
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    types = {c[0]: str(c[1]) for c in result.description}
    expected = _rows(names, result.fetchall())
    got = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    found = []
    if sorted(names) != sorted(spark_df.columns):
        found.append(f"columns {sorted(spark_df.columns)} != {sorted(names)}")
    wrong = [
        f"{name}: {dtype} != {types[name]}"
        for name, dtype in spark_df.dtypes
        if name in types and TYPES.get(dtype) != types[name]
    ]
    if wrong:
        found.append("types " + ", ".join(wrong))
    if len(got) != len(expected):
        found.append(f"{len(got)} rows != {len(expected)}")
    if got != expected and not found:
        pairs = [(g, e) for g, e in zip(got, expected) if g != e]
        found.append(f"{len(pairs)} rows differ, e.g. {pairs[0][0]} != {pairs[0][1]}")
    return found


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from tidemark.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = local_session()
    con = duck(sf)
    oracles = entry.oracle_sql()
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        begin = time.time()
        try:
            df = query(spark, sf)
            if name in oracles:
                found = differences(df, con, oracles[name])
                n = df.count() if not found else "?"
            else:
                n, found = df.count(), []
            status = "ok  " if not found else "DIFF"
        except Exception as e:  # report and go on
            status, found, n = "FAIL", [str(e)[:1500]], "?"
        kind = "sql" if name in oracles else "rows only"
        print(f"{status} {name} [{kind}] rows={n} {time.time() - begin:.1f}s", *found, flush=True)
