"""Run registered queries in Spark and their SQL in DuckDB, and compare the results."""

from __future__ import annotations

import datetime as dt
import sys
import time

TABLES = "region nation customer supplier part orders lineitem events".split()


def _key(row):
    return tuple((v is not None, str(type(v)), v) for v in row)


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def differences(spark_df, con, sql: str, show: int = 3) -> list[str]:
    names = sorted(spark_df.columns)
    got = sorted((tuple(r) for r in spark_df.select(*names).collect()), key=_key)
    cursor = con.execute(f"SELECT {', '.join(names)} FROM ({sql})")
    want = sorted(cursor.fetchall(), key=_key)
    if len(got) != len(want):
        return [f"{len(got)} rows, expected {len(want)}"]
    found = []
    for g, w in zip(got, want):
        for name, a, b in zip(names, g, w):
            if a != b:
                found.append(f"{name}: {a!r} expected {b!r} in {g}")
        if len(found) >= show:
            break
    return found


def main(folder: str, only: list[str]) -> None:
    from ledgerloom.plans import oracle, queries
    from ledgerloom.session import local_session

    spark, con = local_session("8"), duck(folder)
    for name in only or list(queries.BUILDERS):
        start = time.time()
        try:
            found = differences(queries.run(name, spark, folder), con, oracle.statement(name))
        except Exception as error:  # report and go on with the next query
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        print(f"{'ok  ' if not found else 'FAIL'} {name} {time.time() - start:.1f}s", flush=True)
        for line in found:
            print("     ", line[:700], flush=True)


if __name__ == "__main__":
    sys.path.insert(0, ".")
    main(sys.argv[1], sys.argv[2:])
