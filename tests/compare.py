"""Runs registered queries beside their SQL and compares names, types of value and rows."""

from __future__ import annotations

import datetime
import decimal
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone='UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return int(value) if value == value.to_integral_value() else float(value)
    return value


def _kind(value):
    value = _plain(value)
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, (int, float, str)):
        return type(value).__name__
    if isinstance(value, datetime.datetime):
        return "time" if value.tzinfo is None else "zoned time"
    return type(value).__name__


SAME_TYPE = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
             "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


def type_differences(connection, sql, df) -> dict[str, tuple]:
    """Columns whose declared types differ between a frame and its SQL."""
    described = connection.execute(f"DESCRIBE {sql}").fetchall()
    theirs = {row[0]: row[1] for row in described}
    return {name: (kind, theirs.get(name)) for name, kind in df.dtypes
            if SAME_TYPE.get(kind) != theirs.get(name)}


def spark_rows(df):
    names = sorted(df.columns)
    return names, [tuple(_plain(row[name]) for name in names) for row in df.collect()]


def sql_rows(connection, sql):
    cursor = connection.execute(sql)
    columns = [column[0] for column in cursor.description]
    names = sorted(columns)
    places = [columns.index(name) for name in names]
    return names, [tuple(_plain(row[place]) for place in places) for row in cursor.fetchall()]


def kinds(rows):
    if not rows:
        return []
    found = [set() for _ in rows[0]]
    for row in rows:
        for place, value in enumerate(row):
            if value is not None:
                found[place].add(_kind(value))
    return found


def difference(ours, theirs) -> str | None:
    """None if the two (names, rows) results agree in any order of rows."""
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} / {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"rows {len(ours[1])} / {len(theirs[1])}"
    if kinds(ours[1]) != kinds(theirs[1]):
        return f"kinds {kinds(ours[1])} / {kinds(theirs[1])}"
    key = lambda row: tuple((value is None, str(value)) for value in row)
    for one, other in zip(sorted(ours[1], key=key), sorted(theirs[1], key=key)):
        if one != other:
            return f"{str(one)[:600]} / {str(other)[:600]}"
    return None


def main(folder: str, wanted: list[str]) -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as contract
    from tidewire.session import local_session

    spark = local_session(8)
    connection = connect(folder)
    sql = contract.oracle_sql()
    bad = 0
    for name, query in contract.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = query(spark, folder)
            ours = spark_rows(df)
            took = time.time() - start
            verdict = None
            if name in sql:
                types = type_differences(connection, sql[name], df)
                verdict = f"types {types}" if types else difference(
                    ours, sql_rows(connection, sql[name]))
        except Exception as error:  # report all, stop at none
            took, verdict, ours = time.time() - start, f"{type(error).__name__} {error}"[:900], ([], [])
        bad += verdict is not None
        print(f"{name:26} {took:6.2f}s {len(ours[1]):7} rows "
              f"{'ok' if verdict is None else 'DIFFERS ' + verdict}{'' if name in sql else ' (rows only)'}",
              flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
