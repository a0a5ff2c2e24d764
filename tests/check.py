"""Run queries against their SQL twins: python tests/check.py <sf> [name ...]"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(folder):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (int, decimal.Decimal)) and not isinstance(v, float):
        return int(v) if int(v) == v else float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return v


TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN"}


def type_differences(df, description):
    """Columns whose type is not the same on both sides."""
    sql = {d[0]: str(d[1]) for d in description}
    return [f"{c}: {t} != {sql[c]}" for c, t in df.dtypes if TYPES.get(t, t) != sql[c]]


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


def compare(spark, con, entry, folder):
    """None when equal, else a short description."""
    df = entry.run(spark, folder)
    got = rows(df.columns, df.collect())
    plan = df._jdf.queryExecution().executedPlan().toString()
    if "CartesianProduct" in plan or "NestedLoopJoin" in plan:
        return "cross join in the plan"
    if entry.sql is None:
        return None if got else "no rows"
    con.execute(entry.sql)
    names = [d[0] for d in con.description]
    want = rows(names, con.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    types = type_differences(df, con.description)
    if types:
        return f"types {types}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}: only spark {list(set(got) - set(want))[:2]} only sql {list(set(want) - set(got))[:2]}"
    if got != want:
        a, b = [r for r in got if r not in set(want)], [r for r in want if r not in set(got)]
        return f"{len(a)} rows differ, columns {sorted(names)}: {a[:2]} vs {b[:2]}"
    return None


def main(sf, names):
    import tempfile

    from catalog import load
    from meterflow.session import build_session

    spark = build_session(
        master="local[8]",
        **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g",
           "spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-", dir="/tmp")},
    )
    spark.sparkContext.setLogLevel("ERROR")
    folder = f"/root/testdata/sf{sf}"
    con = duck(folder)
    bad = 0
    for name, entry in load().items():
        if names and not names & {name, entry.group}:
            continue
        start = time.time()
        try:
            problem = compare(spark, con, entry, folder)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {time.time() - start:6.2f}s {name} {'' if entry.sql else '(rows only)'} {problem or ''}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main(sys.argv[1], set(sys.argv[2:]))
