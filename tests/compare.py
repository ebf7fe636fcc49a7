"""Run registered queries beside their SQL and report differences by value.

    python -m tests.compare [--sf DIR] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float)):
        return float(value)
    return str(value)


def rows_by_name(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(([plain(row[i]) for i in order] for row in rows), key=repr)


def kind(type_name: str) -> str:
    """One name for the types that print alike in both engines."""
    name = str(type_name).lower()
    if name in ("tinyint", "smallint", "int", "integer", "bigint", "long"):
        return "integer"
    return {"varchar": "string", "float": "double"}.get(name, name)


def compare(spark, con, name: str, query, sql: str, sf_dir: str) -> list[str]:
    """Differences in names, number of rows or values; none means equal."""
    result = query(spark, sf_dir)
    ours = rows_by_name(result.columns, result.collect())
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = rows_by_name(names, cursor.fetchall())
    problems = []
    if sorted(result.columns) != sorted(names):
        problems.append(f"{name}: columns {sorted(result.columns)} != {sorted(names)}")
    our_kinds = {n: kind(t) for n, t in result.dtypes}
    their_kinds = {d[0]: kind(d[1]) for d in cursor.description}
    unlike = {n: (k, their_kinds[n]) for n, k in our_kinds.items() if n in their_kinds and k != their_kinds[n]}
    if unlike:
        problems.append(f"{name}: types {unlike}")
    if len(ours) != len(theirs):
        problems.append(f"{name}: {len(ours)} rows, SQL has {len(theirs)}")
    different = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if different:
        problems.append(f"{name}: {len(different)} different rows, first {different[0]}")
    return problems


def main(arguments: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries

    from ebbline.session import get_session

    sf_dir = "/root/testdata/sf0.01"
    if arguments[:1] == ["--sf"]:
        sf_dir, arguments = arguments[1], arguments[2:]
    spark = get_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, failures = connect(sf_dir), oracle_sql(), 0
    for name, query in queries().items():
        if arguments and name not in arguments:
            continue
        began = time.time()
        try:
            if name in sql:
                problems = compare(spark, con, name, query, sql[name], sf_dir)
            else:
                problems = [] if query(spark, sf_dir).count() else [f"{name}: no rows"]
        except Exception as error:  # noqa: BLE001 - reported with the query's name
            problems = [f"{name}: {type(error).__name__}: {str(error)[:1500]}"]
        failures += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - began:.2f}s", *[p[:1800] for p in problems], flush=True)
    print(f"{failures} failures")
    return failures


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
