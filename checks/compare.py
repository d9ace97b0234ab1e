"""Run registered queries next to their SQL twins: ``python -m checks.compare [sf_dir] [name ...]``."""

import math
import sys
import time
from datetime import datetime
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from checks import registry


def session(cpus=8, **conf):
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName("checks")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false"))
    for name, value in conf.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(sf_dir):
    duck = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        duck.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return duck


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, datetime):
        return value.replace(tzinfo=None)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(_plain(row[i]) for i in order) for row in rows), key=lambda row: tuple(map(repr, row)))


def compare(spark, duck, sf_dir, name):
    """None when both sides agree on columns, types of values and rows; else what differs."""
    frame = registry.QUERIES[name](spark, sf_dir)
    got = _rows(frame.columns, frame.collect())
    if name not in registry.ORACLES:
        return None
    cursor = duck.execute(registry.ORACLES[name])
    columns = [column[0] for column in cursor.description]
    want = _rows(columns, cursor.fetchall())
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} against {sorted(columns)}"
    if not got:
        return "no rows"
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    for mine, other in zip(got, want):
        if mine != other or [type(v) for v in mine] != [type(v) for v in other]:
            return f"{mine}\n  against {other}"
    return None


def main(sf_dir="/root/testdata/sf0.01", *names):
    spark, duck, bad = session(), connect(sf_dir), []
    for name in names or registry.QUERIES:
        started = time.time()
        try:
            problem = compare(spark, duck, sf_dir, name)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{'ok  ' if problem is None else 'FAIL'} {time.time() - started:6.2f}s {name}", flush=True)
        if problem:
            bad.append(name)
            print("  " + problem[:1500], flush=True)
    print(f"{len(bad)} failed: {bad}")
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(*sys.argv[1:])))
