"""Compare registered queries with their SQL oracles.

    python tests/compare.py [sf_dir] [name-prefix ...]
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value: object) -> object:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, dt.datetime):
        return value.isoformat(" ")
    return value


def canonical(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(out, key=repr)


def differences(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    relation = con.execute(sql)
    names = [d[0] for d in relation.description]
    kinds = {d[0]: str(d[1]) for d in relation.description}
    expected = relation.fetchall()
    got = [tuple(row) for row in spark_df.collect()]
    problems = []
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} against {sorted(names)}"]
    same = {
        "string": "VARCHAR", "double": "DOUBLE", "int": "INTEGER", "bigint": "BIGINT",
        "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
    }
    for name, kind in spark_df.dtypes:
        if same.get(kind) != kinds[name]:
            problems.append(f"type of {name}: {kind} against {kinds[name]}")
    left, right = canonical(spark_df.columns, got), canonical(names, expected)
    if len(left) != len(right):
        problems.append(f"rows {len(left)} against {len(right)}")
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    if wrong:
        problems.append(f"{len(wrong)} rows differ, first {wrong[0]}")
    return problems


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from freshhaul.session import build_session

    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    prefixes = tuple(args[1:]) or ("",)
    spark = build_session(
        "compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                  "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = connect(sf_dir), oracle_sql(), 0
    for name, run in queries().items():
        if not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            frame = run(spark, sf_dir)
            problems = (
                differences(frame, con, oracles[name])
                if name in oracles
                else ([] if frame.count() else ["no rows"])
            )
        except Exception as error:  # report and go on with the next query
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(problems)
        note = "; ".join(problems) if problems else ("ok" if name in oracles else "ok (rows only)")
        print(f"{name}: {note} [{time.time() - start:.1f}s]", flush=True)
    print(f"{bad} with problems")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
