"""Compare queries with their independent SQL: ``python tests/oracle_check.py [sf] [name ...]``."""

import datetime
import decimal
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages"
          " benchmark labels conversations").split()


def normal(x):
    if isinstance(x, bool) or x is None:
        return str(x)
    if isinstance(x, decimal.Decimal):
        return str(int(x)) if x == x.to_integral_value() else str(x.normalize())
    if isinstance(x, float):
        return str(int(x)) if math.isfinite(x) and x == int(x) else repr(x)
    if isinstance(x, datetime.datetime):
        return x.isoformat()
    if isinstance(x, (bytes, bytearray)):
        return bytes(x).hex()
    return str(x)


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(normal(r[i]) for i in order) for r in rows)


def compare(spark, sf_dir, name, queries, oracles):
    import duckdb

    started = time.time()
    df = queries[name](spark, sf_dir)
    got = table_of(df.columns, df.collect())
    took = time.time() - started
    if name not in oracles:
        return f"rows-only {len(got[1])}", took, True
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    rel = con.sql(oracles[name])
    want = table_of(rel.columns, rel.fetchall())
    if got == want:
        return f"ok {len(got[1])}", took, True
    have, expected = set(got[1]), set(want[1])
    only_got = [r for r in got[1] if r not in expected][:3]
    only_want = [r for r in want[1] if r not in have][:3]
    return (f"DIFFERENT {got[0]} / {want[0]} rows {len(got[1])}/{len(want[1])}\n   spark {only_got}\n"
            f"   duck  {only_want}", took, False)


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[2:] or list(entry.queries())
    bad = []
    for name in names:
        try:
            text, took, fine = compare(spark, f"/root/testdata/sf{sf}", name, entry.queries(), entry.oracle_sql())
        except Exception as problem:  # noqa: BLE001
            text, took, fine = f"FAILED {str(problem)[:600]}", 0, False
        if not fine:
            bad.append(name)
        print(f"{name:24s} {took:6.1f}s {text}", flush=True)
    print("bad:", bad)
    spark.stop()


if __name__ == "__main__":
    main()
