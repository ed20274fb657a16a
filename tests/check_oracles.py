"""Runs named queries in Spark and their SQL in DuckDB and compares whole results.

    python tests/check_oracles.py [sf] [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def normal(rows, names):
    """Rows as comparable tuples, columns by name."""
    order = sorted(range(len(names)), key=lambda i: names[i])

    def cell(value):
        if isinstance(value, float):
            return repr(value + 0.0)
        return repr(value)

    return sorted(tuple(cell(row[i]) for i in order) for row in rows), sorted(names)


SPARK_TO_DUCK = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "int": "INTEGER"}


def compare(spark, con, name, build, sql, sf_dir):
    """'' when Spark and DuckDB agree on names, types, rows and values."""
    df = build(spark, sf_dir)
    mine = [tuple(r) for r in df.collect()]
    result = con.execute(sql)
    theirs, columns = result.fetchall(), [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    a, names_a = normal(mine, df.columns)
    b, names_b = normal(theirs, columns)
    if names_a != names_b:
        return f"columns {names_a} vs {names_b}"
    if len(a) != len(b):
        return f"{len(a)} rows vs {len(b)}"
    if a != b:
        different = [(x, y) for x, y in zip(a, b) if x != y]
        return f"{len(different)} rows differ, first {different[0]}"
    types = {c: (SPARK_TO_DUCK.get(t, t), kinds[c]) for c, t in df.dtypes
             if SPARK_TO_DUCK.get(t, t) != kinds[c]}
    return f"types {types}" if types else ""


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from credence.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    folder = f"/root/testdata/sf{sf}"
    session, connection, bad = local_session(8), connect(folder), 0
    for query_name, build_query in queries().items():
        if sys.argv[2:] and query_name not in sys.argv[2:]:
            continue
        text = oracle_sql().get(query_name)
        if text is None:
            continue
        start = time.time()
        try:
            problem = compare(session, connection, query_name, build_query, text, folder)
        except Exception as error:  # report and go on to the next query
            problem = repr(error)[:600]
        bad += bool(problem)
        print(f"{'ok ' if not problem else 'BAD'} {query_name} {time.time() - start:.1f}s "
              f"{problem[:900]}", flush=True)
    print("mismatches:", bad)
