"""Upsert of new rows into the stored table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthlake.functions.keys import MERGE_KEY


def upsert_by_key(target: DataFrame, source: DataFrame, key: str = MERGE_KEY) -> DataFrame:
    """Target rows without a source row of the same key, and all source rows.

    ``source`` must hold one row per key (see ``dedup_keep_last``). Only the keys of
    the source take part in the join; when they are small enough Spark broadcasts
    them and the target is not shuffled at all. The source is read twice, so write it out
    first when it is costly to compute. A column one side lacks is NULL there.
    """
    kept = target.join(source.select(key), key, "left_anti")
    return kept.select(*target.columns).unionByName(source, allowMissingColumns=True)


def merge_into(table: str, source: DataFrame, key: str = MERGE_KEY) -> None:
    """The same upsert inside a catalog table whose format supports MERGE (Delta, Iceberg)."""
    on = F.expr(f"{table}.`{key}` = source.`{key}`")
    (
        source.alias("source")
        .mergeInto(table, on)
        .whenMatched()
        .updateAll()
        .whenNotMatched()
        .insertAll()
        .merge()
    )
