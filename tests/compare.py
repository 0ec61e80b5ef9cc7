"""Run a registered query beside its SQL and compare the rows as multisets."""

import sys
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def compare(con, spark_df, sql):
    """None when both agree, otherwise a short account of the difference."""
    theirs = con.execute(sql)
    names = [d[0] for d in theirs.description]
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} against {sorted(names)}"
    order = sorted(names)
    want = Counter(tuple(row[names.index(c)] for c in order) for row in theirs.fetchall())
    got = Counter(tuple(row[c] for c in order) for row in spark_df.collect())
    if got == want:
        return None
    extra, missing = list((got - want).items())[:2], list((want - got).items())[:2]
    return f"{sum(got.values())} rows against {sum(want.values())}; only ours {extra}; only theirs {missing}"


if __name__ == "__main__":
    import os
    import time

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from __spark_entry__ import oracle_sql, queries
    from voxseries import get_session

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    spark = get_session("compare", "local[8]", spark__sql__shuffle__partitions=8,
                        spark__ui__enabled="false", spark__driver__memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls = connect(sf_dir), oracle_sql()
    for name, fn in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in sqls:
                result = compare(con, df, sqls[name]) or "ok"
            else:
                result = f"rows only: {len(df.collect())}"
        except Exception as e:  # noqa: BLE001
            result = "ERROR " + str(e)[:1500]
        print(f"{name:28s} {time.time() - start:6.2f}s {result[:2500]}", flush=True)
