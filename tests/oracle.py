"""Run registered queries in both engines and compare whole results.

    python tests/oracle.py [sf] [name-substring ...]
"""

from __future__ import annotations

import os
import re
import sys
import time

import duckdb

ROOT = os.environ.get("FOLDWISE_TESTDATA", "/root/testdata")
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def session(cpus: int = 8):
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master(f"local[{cpus}]")
             .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC")
             .config("spark.sql.execution.arrow.pyspark.enabled", "true").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in sorted(os.listdir(sf_dir)):
        name = f.removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{f}'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if v != v else repr(v)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_cell(x) for x in v) + "]"
    return repr(v)


def table_rows(table):
    names = sorted(table.column_names)
    cols = [table.column(n).to_pylist() for n in names]
    return names, sorted(tuple(_cell(v) for v in row) for row in zip(*cols))


def _kind(t):
    t = str(t)
    return re.sub(r"^(large_)?(string|utf8).*", "string", t)


def compare(spark, con, sf_dir, name, fn, sql):
    """None when equal, else what differs."""
    got = fn(spark, sf_dir).toArrow()
    if sql is None:
        return f"rows-only {got.num_rows}" if got.num_rows else "EMPTY"
    want = con.sql(sql).to_arrow_table()
    gn, gr = table_rows(got)
    wn, wr = table_rows(want)
    if gn != wn:
        return f"columns {gn} != {wn}"
    if len(gr) != len(wr):
        return f"rows {len(gr)} != {len(wr)}"
    kinds = [(n, _kind(got.schema.field(n).type), _kind(want.schema.field(n).type)) for n in gn]
    odd = [k for k in kinds if k[1] != k[2]]
    if odd:
        return f"types {odd}"
    bad = [(a, b) for a, b in zip(gr, wr) if a != b]
    if bad:
        cells = [(n, x, y) for a, b in bad[:3] for n, x, y in zip(gn, a, b) if x != y]
        return f"{len(bad)} of {len(gr)} rows differ: {cells[:12]}"
    if not gr:
        return "EMPTY"
    return None


def main():
    import __spark_entry__ as entry
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.001"
    parts = sys.argv[2:]
    sf_dir = f"{ROOT}/sf{sf}"
    spark, con = session(), connect(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if parts and not any(p in name for p in parts):
            continue
        t0 = time.time()
        try:
            diff = compare(spark, con, sf_dir, name, fn, sqls.get(name))
        except Exception as e:  # noqa: BLE001
            diff = f"ERROR {type(e).__name__}: {str(e)[:1500]}"
        ok = diff is None or diff.startswith("rows-only")
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - t0:.1f}s {diff or ''}", flush=True)
    print("failures:", bad)
    spark.stop()


if __name__ == "__main__":
    main()
