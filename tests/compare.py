"""Run registered queries and their SQL side by side: python tests/compare.py [sf_dir] [name ...]"""

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _value(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    return repr(v)


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_value(row[i]) for i in order) for row in rows)


def compare(spark, con, sf_dir, query, sql):
    """None where both give the same rows, else a short text of what differs."""
    result = query(spark, sf_dir)
    got = _sorted_rows(result.columns, [tuple(r) for r in result.collect()])
    if sql is None:
        return None if got else "no rows"
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    want = _sorted_rows(columns, cursor.fetchall())
    if sorted(columns) != sorted(result.columns):
        return f"columns {sorted(result.columns)} != {sorted(columns)}"
    if got != want:
        only_got, only_want = set(got) - set(want), set(want) - set(got)
        return (
            f"{len(got)} rows != {len(want)}; "
            f"e.g. {[str(x)[:300] for x in list(only_got)[:2]]} "
            f"vs {[str(x)[:300] for x in list(only_want)[:2]]}"
        )
    return None


def main():
    from feedstream.session import build_session
    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = build_session("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sql = entry.oracle_sql()
    failed = []
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            problem = compare(spark, con, sf_dir, query, sql.get(name))
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:900]}"
        print(f"{name:28s} {time.time() - started:6.2f}s {problem or 'ok'}", flush=True)
        if problem:
            failed.append(name)
    print("failed:", failed)


if __name__ == "__main__":
    main()
