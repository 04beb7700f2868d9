"""Runs queries on Spark and their SQL on DuckDB and compares names, types and values.

Also a script: ``python tests/oracle.py [sf_dir] [query ...]``.
"""

from __future__ import annotations

import math
import os
import sys
import tempfile
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations").split()
TYPES = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(v):
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float) and math.isnan(v):
        return None
    return v


def _rows(rows, order):
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: [(v is None, str(type(v)), v if v is not None else 0) for v in r])


def compare(spark_df, con, sql: str) -> list[str]:
    """Differences between a Spark result and the SQL result; empty when they agree."""
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    types = dict(zip(names, [str(d[1]) for d in rel.description]))
    expected = rel.fetchall()
    problems = []
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} != {sorted(names)}"]
    for f in spark_df.schema.fields:
        want = TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
        if types[f.name] != want:
            problems.append(f"type of {f.name}: {want} != {types[f.name]}")
    got = [tuple(r) for r in spark_df.collect()]
    cols = sorted(names)
    a = _rows(got, [spark_df.columns.index(c) for c in cols])
    b = _rows(expected, [names.index(c) for c in cols])
    if len(a) != len(b):
        problems.append(f"rows {len(a)} != {len(b)}")
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        problems.append(f"{len(bad)} rows differ, first: {cols} {bad[0][0]} != {bad[0][1]}")
    return problems


def main() -> int:
    from pyspark.sql import SparkSession

    from starloom.queries import ORACLES, QUERIES

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(QUERIES)
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "12g")
             .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="oracle-")).getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    failed = 0
    for name in wanted:
        t0 = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in ORACLES:
                problems = compare(df, con, ORACLES[name])
            else:
                problems = [] if df.count() else ["no rows"]
        except Exception as e:  # report and go on with the next query
            problems = [f"{type(e).__name__}: {str(e)[:1500]}"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - t0:.1f}s", *problems, flush=True)
    print(f"{len(wanted) - failed}/{len(wanted)} agree")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
