"""Run queries against their SQL: ``python tests/compare.py sf_dir [name ...]``."""

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from checks.oracles import ORACLES  # noqa: E402
from checks.queries import QUERIES  # noqa: E402


def connect(sf_dir):
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    return con


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def differences(spark, con, sf_dir, name, limit=5):
    """Empty if equal, else what differs; and the number of rows."""
    started = time.time()
    ours = QUERIES[name](spark, sf_dir)
    rows = [tuple(row) for row in ours.collect()]
    seconds = time.time() - started
    theirs = con.execute(ORACLES[name])
    columns = [d[0] for d in theirs.description]
    expected = theirs.fetchall()
    if sorted(columns) != sorted(ours.columns):
        return f"columns {ours.columns} <> {columns}", len(rows), seconds
    kinds = {d[0]: str(d[1]) for d in theirs.description}
    types = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    wrong = [(c, t, kinds[c]) for c, t in ours.dtypes if types.get(t) != kinds[c]]
    if wrong:
        return f"types {wrong}", len(rows), seconds
    a, b = normal(rows, ours.columns), normal(expected, columns)
    if a == b:
        return "", len(rows), seconds
    only_a, only_b = sorted(set(a) - set(b), key=repr), sorted(set(b) - set(a), key=repr)
    return f"{len(a)} <> {len(b)} rows; ours {only_a[:limit]}; sql {only_b[:limit]}", len(a), seconds


def main():
    from pyspark.sql import SparkSession

    sf_dir, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    for name in names:
        try:
            problem, n_rows, seconds = differences(spark, con, sf_dir, name)
        except Exception as error:  # show every query's outcome
            problem, n_rows, seconds = f"{type(error).__name__}: {str(error)[:1500]}", 0, 0.0
        print(f"{name:22} {'ok' if not problem else 'DIFFERS'} {n_rows} rows {seconds:.2f}s {problem}", flush=True)


if __name__ == "__main__":
    main()
