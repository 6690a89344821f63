"""Run registered queries next to their oracles and compare rows, names and types."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

# Type names the engines use for the same type.
SAME_TYPE = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE", "float": "FLOAT",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark, con, query, sql, sf_dir):
    """(problem or None, number of rows)."""
    df = query(spark, sf_dir)
    got = df.collect()
    rel = con.sql(sql)
    want = rel.fetchall()
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {sorted(df.columns)} != {sorted(rel.columns)}", len(got)
    wanted_types = dict(zip(rel.columns, map(str, rel.types)))
    for name, kind in df.dtypes:
        if SAME_TYPE.get(kind) != wanted_types[name]:
            return f"type of {name}: {kind} != {wanted_types[name]}", len(got)
    left, right = _rows(df.columns, got), _rows(rel.columns, want)
    if left != right:
        only_left = [r for r in left if r not in set(right)][:3]
        only_right = [r for r in right if r not in set(left)][:3]
        return f"{len(left)} rows vs {len(right)}; only here {only_left}; only oracle {only_right}", len(got)
    return None, len(got)


if __name__ == "__main__":
    import __spark_entry__ as entry
    from fixtrail.session import build_session

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    spark = build_session(master="local[8]", shuffle_partitions=8, **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles = entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        began = time.perf_counter()
        try:
            if name in oracles:
                problem, count = compare(spark, con, query, oracles[name], sf_dir)
            else:
                problem, count = None, query(spark, sf_dir).count()
        except Exception as error:  # noqa: BLE001  (report and go on)
            problem, count = f"{type(error).__name__}: {str(error)[:600]}", -1
        bad += problem is not None
        state = "ok" if problem is None else "FAIL"
        print(f"{state:5}{name:34}{count:8} rows {time.perf_counter() - began:6.2f}s {'' if name in oracles else '(no oracle) '}"
              f"{problem or ''}", flush=True)
    print("failed:", bad)
