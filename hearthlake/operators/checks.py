"""Checks on tables: schemas before a merge, row counts after a publish."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DIFF_SCHEMA = "column string, existing_type string, new_type string, status string"


def schema_diff(existing: DataFrame, new: DataFrame) -> list[tuple]:
    """Per column name: type on each side and whether it is same, changed, added or removed."""
    before = {f.name: f.dataType.simpleString() for f in existing.schema.fields}
    after = {f.name: f.dataType.simpleString() for f in new.schema.fields}
    rows = []
    for name in sorted(before.keys() | after.keys()):
        old, now = before.get(name), after.get(name)
        status = "added" if old is None else "removed" if now is None else "same" if old == now else "changed"
        rows.append((name, old, now, status))
    return rows


#: Number types from narrow to wide; a value of one fits every later one of its row.
WIDENING = [["tinyint", "smallint", "int", "bigint"], ["float", "double"]]


def widened(df: DataFrame, other: DataFrame) -> DataFrame:
    """The frame with its numbers as wide as the other frame's columns of the same name."""
    theirs = {f.name: f.dataType.simpleString() for f in other.schema.fields}
    casts = {}
    for field in df.schema.fields:
        mine, wanted = field.dataType.simpleString(), theirs.get(field.name)
        for row in WIDENING:
            if mine in row and wanted in row and row.index(wanted) > row.index(mine):
                casts[field.name] = F.col(f"`{field.name}`").cast(wanted)
    return df.withColumns(casts) if casts else df


def schema_diff_frame(spark: SparkSession, existing: DataFrame, new: DataFrame) -> DataFrame:
    return spark.createDataFrame(schema_diff(existing, new), DIFF_SCHEMA)


def is_compatible(existing: DataFrame, new: DataFrame) -> bool:
    """Whether the new rows fit the existing table without a schema change."""
    return all(status == "same" for *_, status in schema_diff(existing, new))


def verify_counts(expected: DataFrame, published: DataFrame) -> DataFrame:
    """One row: expected rows, published rows and whether they agree.

    Both sides are tagged and counted in one aggregate, so no join is needed.
    """
    tagged = expected.select(F.lit(1).alias("e"), F.lit(0).alias("p")).unionAll(
        published.select(F.lit(0).alias("e"), F.lit(1).alias("p"))
    )
    return tagged.agg(
        F.coalesce(F.sum("e"), F.lit(0)).alias("expected_count"),
        F.coalesce(F.sum("p"), F.lit(0)).alias("actual_count"),
    ).withColumn("matches", F.col("expected_count") == F.col("actual_count"))
