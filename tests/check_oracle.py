"""Compare every query with its DuckDB twin: ``python tests/check_oracle.py [folder] [query ...]``."""

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry  # noqa: E402
from admesh.session import local_session  # noqa: E402


def connect(folder):
    con = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(value):
        if value is None or (isinstance(value, float) and math.isnan(value)):
            return ""
        return repr(value)
    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


def compare(spark, con, folder, name):
    """Rows of both engines: ``(columns, rows)`` of Spark, then of DuckDB."""
    df = entry.queries()[name](spark, folder)
    ours = sorted(df.columns), canonical(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    return ours, (sorted(columns), canonical(columns, result.fetchall()))


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    for name in sys.argv[2:] or entry.queries():
        start = time.time()
        ours, theirs = compare(spark, con, folder, name)
        verdict = "ok" if ours == theirs else "DIFFERS"
        print(f"{name:24} {verdict:8} {len(ours[1]):8} {len(theirs[1]):8} {time.time() - start:6.1f}s", flush=True)
        if ours != theirs:
            print("  only spark ", ours[0], sorted(set(ours[1]) - set(theirs[1]))[:3])
            print("  only duckdb", theirs[0], sorted(set(theirs[1]) - set(ours[1]))[:3])
