"""Run registered queries and their SQL side by side.

    python tests/compare.py [sf] [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = """region nation customer supplier part orders lineitem events documents embeddings
pages benchmark labels conversations""".split()


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


KINDS = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string",
         "BOOLEAN": "boolean"}


def _normal(rows: list[tuple], columns: list[str]) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    # adding 0.0 turns a negative zero into zero
    return sorted(
        tuple(repr(row[i] + 0.0 if isinstance(row[i], float) else row[i]) for i in order)
        for row in rows
    )


def difference(got: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if a Spark result equals the SQL's in columns, types and rows, else
    what differs first."""
    result = con.execute(sql)
    want_types = {name: KINDS.get(str(kind), str(kind)) for name, kind, *_ in result.description}
    got_types = dict(got.dtypes)
    if got_types != want_types:
        odd = {c: (got_types.get(c), want_types.get(c)) for c in {*got_types, *want_types}
               if got_types.get(c) != want_types.get(c)}
        return f"types {odd}"
    b = _normal(result.fetchall(), list(want_types))
    a = _normal([tuple(r) for r in got.collect()], got.columns)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} rows differ, first {sorted(got.columns)}:\n   {bad[0][0]}\n   {bad[0][1]}"
    return None


def main() -> int:
    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    queries, oracles = entry.queries(), entry.oracle_sql()
    names = sys.argv[2:] or list(queries)
    spark, con = session(), duck(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            problem = difference(queries[name](spark, sf_dir), con, oracles[name])
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        failed += problem is not None
        label = "ok  " if problem is None else "FAIL"
        print(f"{label} {name} {time.time() - start:.2f}s"
              + (f"\n   {problem}" if problem else ""), flush=True)
    print("missing oracles:", sorted(set(queries) - set(oracles)), "failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(min(main(), 1))
