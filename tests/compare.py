"""Run registered queries beside their oracle and compare rows.

python tests/compare.py [folder] [name ...]
"""

import datetime
import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(folder):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _plain(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else float(f"{v:.10g}")
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return int(v)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(repr(_plain(r[i])) for i in order) for r in rows)


def oracle_rows(con, sql):
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    return sorted(columns), rows_of(columns, cur.fetchall())


def spark_rows(df):
    return sorted(df.columns), rows_of(df.columns, [tuple(r) for r in df.collect()])


def differences(spark, con, folder, name, query, sql):
    """None when both sides agree, else a short report."""
    got_cols, got = spark_rows(query(spark, folder))
    if sql is None:
        return None if got else "no rows"
    want_cols, want = oracle_rows(con, sql)
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if got != want:
        extra, missing = list((got - want).elements()), list((want - got).elements())
        return (
            f"{sum(got.values())} rows, expected {sum(want.values())}\n  columns {got_cols}\n"
            f"  only Spark {len(extra)}: {extra[:2]}\n  only oracle {len(missing)}: {missing[:2]}"
        )
    return None if want else "both sides are empty"


def main(argv):
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(folder), 0
    queries, oracles = entry.queries(), entry.oracle_sql()
    for name in sorted(set(oracles) - set(queries)):
        print("ORACLE WITHOUT QUERY", name)
    for name in argv[1:] or queries:
        start = time.time()
        try:
            why = differences(spark, con, folder, name, queries[name], oracles.get(name))
        except Exception as e:  # report and go on with the next query
            why = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += why is not None
        kind = "" if name in oracles else " (rows only)"
        print(f"{'ok ' if why is None else 'BAD'} {name}{kind} {time.time() - start:.1f}s {why or ''}", flush=True)
    print("bad:", bad, "of", len(argv[1:] or queries))


if __name__ == "__main__":
    main(sys.argv[1:])
