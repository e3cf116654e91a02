"""Compare registered queries with their DuckDB SQL, value by value."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


def duck(data_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(data_dir).glob("*.parquet")):
        connection.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def rows_of(columns, table):
    order = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(row[i] for i in order) for row in table), key=repr)


def spark_result(df):
    """Rows and schema kinds, columns sorted by name."""
    return rows_of(df.columns, [tuple(r) for r in df.collect()]), sorted(df.columns)


def duck_result(connection, sql):
    relation = connection.sql(sql)
    return rows_of(relation.columns, relation.fetchall()), sorted(relation.columns)


def type_names(df, relation):
    """Column types of both sides in DuckDB's names."""
    names = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE"}
    ours = {c: names.get(t, t) for c, t in df.dtypes}
    theirs = {c: str(t) for c, t in zip(relation.columns, relation.types)}
    return ours, theirs


if __name__ == "__main__":
    import __spark_entry__ as entry_points
    from tidemark.session import local_session

    data_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = local_session(8)
    connection = duck(data_dir)
    oracle = entry_points.oracle_sql()
    bad = []
    for name, run in entry_points.queries().items():
        if wanted and name not in wanted:
            continue
        began = time.time()
        try:
            df = run(spark, data_dir)
            mine = spark_result(df)
        except Exception as error:  # report and go on with the next query
            print(f"{name:28} FAILED {str(error)[:600]}")
            bad.append(name)
            continue
        took = time.time() - began
        if name not in oracle:
            print(f"{name:28} {len(mine[0])} rows, no oracle {took:.2f}s")
            continue
        same = mine == duck_result(connection, oracle[name])
        ours, theirs = type_names(df, connection.sql(oracle[name]))
        if not same or ours != theirs:
            bad.append(name)
        print(f"{name:28} {len(mine[0])} rows same={same} types={ours == theirs or (ours, theirs)} {took:.2f}s")
    print("BAD", bad)
