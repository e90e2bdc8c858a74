"""Compare registered queries with their oracle SQL, value by value.

``python -m tests.oracle [sf_dir] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

import __spark_entry__ as registered

TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return db


def differences(spark, db, name: str, sf_dir: str) -> list[str]:
    """What differs between the Spark result and the oracle result; empty when nothing does."""
    frame = registered.queries()[name](spark, sf_dir)
    names = sorted(frame.columns)
    mine = [tuple(row) for row in frame.select(*[f"`{n}`" for n in names]).collect()]
    result = db.execute(registered.oracle_sql()[name])
    types = {column[0]: str(column[1]) for column in result.description}
    rows = result.fetchall()
    order = [list(types).index(n) if n in types else None for n in names]
    found = []
    if sorted(types) != names:
        return [f"columns {names} against {sorted(types)}"]
    for field in frame.schema.fields:
        if TYPES.get(field.dataType.simpleString()) != types[field.name]:
            found.append(f"type of {field.name}: {field.dataType.simpleString()} against {types[field.name]}")
    theirs = [tuple(row[i] for i in order) for row in rows]
    if len(mine) != len(theirs):
        found.append(f"rows {len(mine)} against {len(theirs)}")
    if not mine:
        found.append("no rows")
    only_mine, only_theirs = Counter(mine) - Counter(theirs), Counter(theirs) - Counter(mine)
    if only_mine or only_theirs:
        found.append(f"{sum(only_mine.values())} rows differ, {names}: {next(iter(only_mine), None)} against {next(iter(only_theirs), None)}")
    return found


def main() -> int:
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(registered.oracle_sql())
    db = connect(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            found = differences(spark, db, name, sf_dir)
        except Exception as error:  # report and go on with the other queries
            found = [str(error)[:600]]
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok':4} {name} {time.time() - start:.1f}s {'; '.join(found)}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return failed


if __name__ == "__main__":
    sys.exit(main())
