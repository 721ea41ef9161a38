"""Run queries next to their SQL and compare the rows. Usage: python tests/compare.py [sf_dir] [name ...]"""

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool) or isinstance(value, str):
        return value
    if isinstance(value, (list, dict)):
        return str(value)
    try:
        return round(float(value), 9) + 0.0
    except (TypeError, ValueError):
        return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    found = [tuple(cell(r[k]) for k in order) for r in rows]
    return [columns[k] for k in order], sorted(found, key=lambda r: [(v is None, str(v)) for v in r])


def difference(df, con, sql):
    """None if equal, else a short description."""
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    other = con.execute(sql)
    theirs = rows_of([d[0] for d in other.description], other.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} / {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        return f"rows {len(mine[1])} / {len(theirs[1])}"
    wrong = [(a, b) for a, b in zip(mine[1], theirs[1]) if a != b]
    return f"{len(wrong)} of {len(mine[1])} rows differ: {wrong[:2]}" if wrong else None


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle = connect(sf_dir), entry.oracle_sql()
    for name in names:
        start = time.time()
        try:
            df = entry.queries()[name](spark, sf_dir)
            if name in oracle:
                result = difference(df, con, oracle[name]) or "equal"
            else:
                result = f"no SQL, {df.count()} rows"
        except Exception as failure:
            result = f"FAILED {type(failure).__name__}: {str(failure)[:600]}"
        print(f"{name:32s} {time.time() - start:6.1f}s  {result}", flush=True)


if __name__ == "__main__":
    main()
