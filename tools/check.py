"""Compare queries with their oracles: python tools/check.py SF_DIR [name-prefix ...]

Stricter than a hash of strings: column names, Python types and values must agree.
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def session(cpus: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("corpusloom-check")
        .config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def normal(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple((type(r[i]).__name__, r[i]) for i in order) for r in rows), key=repr)


def main() -> int:
    sf, wanted = sys.argv[1], sys.argv[2:]
    from corpusloom.catalog import ORACLES, QUERIES

    spark = session()
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    bad = 0
    for name, fn in QUERIES.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        try:
            t0 = time.time()
            df = fn(spark, sf)
            rows = [tuple(r) for r in df.collect()]
            t1 = time.time()
            if name not in ORACLES:
                print(f"ROWS {name} {len(rows)} rows {t1 - t0:.1f}s", flush=True)
                continue
            cur = con.execute(ORACLES[name])
            ocols = [d[0] for d in cur.description]
            want = cur.fetchall()
            t2 = time.time()
            if sorted(df.columns) != sorted(ocols):
                print(f"FAIL {name}: columns {sorted(df.columns)} vs {sorted(ocols)}", flush=True)
                bad += 1
                continue
            a, b = normal(rows, df.columns), normal(want, ocols)
            if a != b:
                bad += 1
                diff = [(x, y) for x, y in zip(a, b, strict=False) if x != y][:2]
                print(f"FAIL {name}: {len(a)} vs {len(b)} rows; first differences:", flush=True)
                for x, y in diff:
                    print("   spark ", str(x)[:600])
                    print("   oracle", str(y)[:600], flush=True)
            else:
                print(f"ok   {name} {len(a)} rows spark {t1 - t0:.1f}s oracle {t2 - t1:.1f}s", flush=True)
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"ERR  {name}: {str(e)[:1500]}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
