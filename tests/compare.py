"""Run queries and their SQL counterparts and compare the rows as bags.

    python tests/compare.py [folder of tables] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from datetime import datetime
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


KINDS = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def plain(value: object) -> object:
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, datetime):
        return value.replace(tzinfo=None)
    return value


def bag(columns: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return (
        sorted(columns),
        Counter(tuple(plain(row[i]) for i in order) for row in rows),
    )


def differences(spark, connection, query, sql: str, sf_dir: str) -> str | None:
    frame = query(spark, sf_dir)
    mine = bag(frame.columns, frame.collect())
    # Two statements read the files themselves, in the folder the driver compares.
    result = connection.execute(sql.replace("/root/testdata/sf0.01/", f"{sf_dir}/"))
    theirs = bag([d[0] for d in result.description], result.fetchall())
    kinds = {d[0]: str(d[1]) for d in result.description}
    for name, kind in frame.dtypes:
        if KINDS.get(kind, kind) != kinds.get(name, "absent"):
            return f"column {name} is {kind} and {kinds.get(name)}"
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} and {theirs[0]}"
    if mine[1] != theirs[1]:
        extra, lacking = mine[1] - theirs[1], theirs[1] - mine[1]
        return (
            f"{sum(mine[1].values())} and {sum(theirs[1].values())} rows; "
            f"only here {str(list(extra.items())[:2])[:400]}; "
            f"only there {str(list(lacking.items())[:2])[:400]}"
        )
    return None


def main() -> None:
    from lavra.bindings import ORACLES, QUERIES
    from lavra.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(QUERIES)
    spark = build_session("compare", "local[8]", 8, "8g")
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failed = 0
    for name in chosen:
        start = time.time()
        try:
            if name in ORACLES:
                problem = differences(spark, connection, QUERIES[name], ORACLES[name], sf_dir)
            else:
                problem = None if QUERIES[name](spark, sf_dir).count() else "no rows"
        except Exception as error:
            problem = str(error)[:700]
        failed += problem is not None
        print(f"{time.time() - start:6.2f}s {name}: {problem or 'ok'}", flush=True)
    print(f"{len(chosen)} queries, {failed} failed, {len(ORACLES)} with SQL")
    spark.stop()


if __name__ == "__main__":
    main()
