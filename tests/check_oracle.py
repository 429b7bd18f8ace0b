"""Compare queries with their SQL: ``python tests/check_oracle.py [sf] [name …]``."""

import os
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as contract  # noqa: E402
from vigilog.session import build_session  # noqa: E402


def normal(value):
    if isinstance(value, Decimal):
        value = float(value)
    return round(value, 9) if isinstance(value, float) else value


def compare(spark, connection, name, sf_dir):
    started = time.time()
    df = contract.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    actual = Counter(tuple(normal(v) for v in row) for row in df.select(*columns).collect())
    took = time.time() - started
    relation = connection.sql(contract.oracle_sql()[name])
    wanted_columns = sorted(relation.columns)
    expected = Counter(tuple(normal(v) for v in row) for row in relation.select(*[f'"{c}"' for c in wanted_columns]).fetchall())
    same = columns == wanted_columns and actual == expected
    print(f"{'ok  ' if same else 'DIFF'} {name} rows={sum(actual.values())} spark={took:.1f}s", flush=True)
    if not same:
        print("  columns", columns, wanted_columns)
        print("  only spark", list((actual - expected).items())[:2])
        print("  only sql  ", list((expected - actual).items())[:2], sum((actual - expected).values()), sum((expected - actual).values()))
    return same


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.001"
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session(master="local[8]", spark_sql_shuffle_partitions="8", spark_driver_memory="8g", spark_ui_showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    connection = duckdb.connect()
    for file in os.listdir(sf_dir):
        connection.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{sf_dir}/{file}'")
    names = sys.argv[2:] or list(contract.oracle_sql())
    bad = []
    for name in names:
        try:
            if not compare(spark, connection, name, sf_dir):
                bad.append(name)
        except Exception as error:
            bad.append(name)
            print("FAIL", name, type(error).__name__, str(error)[:600], flush=True)
    print(f"{len(names) - len(bad)} of {len(names)} agree; not: {bad}")
