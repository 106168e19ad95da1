"""Compare queries with their SQL on the shared test tables.

Run as ``python tests/oracle.py [sf] [name ...]`` for a report.
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb
import numpy as np

DATA = os.environ.get("TESTDATA_DIR", "/root/testdata")


def duck(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{DATA}/sf{sf}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(value):
    if isinstance(value, (float, np.floating)):
        return None if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, (list, tuple, np.ndarray)):
        return tuple(canonical(v) for v in value)
    if isinstance(value, np.generic):
        return value.item()
    return value


def rows(columns, tuples):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    made = [tuple(canonical(t[i]) for i in order) for t in tuples]
    return sorted(columns), sorted(made, key=repr)


def difference(spark, name: str, query, sql: str, sf: str, con=None) -> str | None:
    """None when both results hold the same rows, else what differs."""
    df = query(spark, f"{DATA}/sf{sf}")
    got_columns, got = rows(df.columns, [tuple(r) for r in df.collect()])
    relation = (con or duck(sf)).sql(sql)
    want_columns, want = rows(relation.columns, relation.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    kinds = {c: t for c, t in df.dtypes}
    duck_kinds = dict(zip(relation.columns, map(str, relation.types)))
    alike = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
    for c, t in kinds.items():
        if alike.get(t, duck_kinds[c]) != duck_kinds[c]:
            return f"type of {c}: {t} != {duck_kinds[c]}"
    for g, w in zip(got, want):
        if g != w:
            return f"first difference: {str(g)[:300]} != {str(w)[:300]}"
    return None


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from papyra.session import get_spark
    from papyra.suite import ORACLES, QUERIES

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = get_spark("oracle", "local[8]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8",
                                               "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf)
    bad = 0
    for name in names:
        start = time.time()
        try:
            found = difference(spark, name, QUERIES[name], ORACLES[name], sf, con)
        except Exception as error:  # noqa: BLE001 - report and go on
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += found is not None
        print(f"{'ok  ' if found is None else 'FAIL'} {name} {time.time() - start:.2f}s {found or ''}", flush=True)
    print(f"{len(names) - bad}/{len(names)} equal")
