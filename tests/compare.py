"""Run registered queries next to their SQL in DuckDB: python tests/compare.py SF_DIR [name ...]"""

from __future__ import annotations

import datetime
import decimal
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(folder):
    import duckdb

    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from read_parquet('{folder}/{table}.parquet')")
    return connection


def plain(value):
    if isinstance(value, float):
        return ("f", 0.0 if value == 0 else value)
    if isinstance(value, bool):
        return ("b", value)
    if isinstance(value, int):
        return ("i", value)
    if isinstance(value, decimal.Decimal):
        return ("d", str(value))
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, datetime.datetime):
        return ("t", value.replace(tzinfo=None).isoformat())
    if isinstance(value, datetime.date):
        return ("D", value.isoformat())
    return ("s", value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def check(spark, connection, name, function, sql, folder):
    """None if equal, else a description of the first difference."""
    df = function(spark, folder)
    names, rows = rows_of(df.columns, df.collect())
    if sql is None:
        return None if rows else "no rows"
    cursor = connection.execute(sql)
    wanted_names, wanted = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if names != wanted_names:
        return f"columns {names} != {wanted_names}"
    if len(rows) != len(wanted):
        return f"{len(rows)} rows, SQL has {len(wanted)}"
    for a, b in zip(rows, wanted):
        if a != b:
            return f"{a}\n   !=  {b}"
    return None if rows else "no rows"


if __name__ == "__main__":
    import __spark_entry__ as entry
    from conftest import make_session

    folder, wanted = sys.argv[1], sys.argv[2:]
    spark, connection = make_session(), duck(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, function in queries.items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            problem = check(spark, connection, name, function, oracles.get(name), folder)
        except Exception as error:  # report and go on with the other queries
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        kind = "sql" if name in oracles else "rows"
        print(f"{'ok ' if problem is None else 'BAD'} {kind:4} {time.time() - start:6.1f}s {name} {problem or ''}", flush=True)
    print("failures:", bad)
