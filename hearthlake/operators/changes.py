"""New or changed candidates against the stored table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthlake.functions.keys import MERGE_KEY, NORMALIZED_PRICE, fingerprint

# Fixed values.
CANDIDATE_COLUMNS = [
    "id",
    "fingerprint",
    "is_prefix",
    "rentOrBuy",
    "city",
    "propertyType",
    "radius",
    "last_normalized_price",
]


def existing_semi(existing: DataFrame, candidates: DataFrame) -> DataFrame:
    """Stored rows whose key is among the candidate ids.

    The ids are made distinct before the shuffle: the side a semi join looks up cannot
    be split, so a frequent id must not arrive there row by row.
    """
    ids = candidates.select(F.col("id").cast("string").alias("_id")).distinct()
    return existing.join(ids, F.col(MERGE_KEY) == F.col("_id"), "left_semi")


def changed_or_new(candidates: DataFrame, existing: DataFrame) -> DataFrame:
    """Candidates that are not stored, or are stored with another fingerprint.

    A stored row without price has no fingerprint and its candidate always counts as
    changed; a candidate without fingerprint only counts when that holds or it is new.

    Put the other way round, a candidate is left out when its stored row has a
    fingerprint and this does not differ. That is one anti join: unchanged candidates
    are never paired with stored rows, only key and price of the stored table are read,
    and a frequent candidate id is split by adaptive execution. ``existing`` must hold
    one row per key, as the upsert leaves it; with few candidates, cut it by
    ``existing_semi`` first, which then needs no shuffle of the stored table.
    """
    stored = existing.select(
        F.col(MERGE_KEY).cast("string").alias("_id"),
        fingerprint(F.col(MERGE_KEY), F.col(NORMALIZED_PRICE)).alias("_fingerprint"),
    ).filter(F.col("_fingerprint").isNotNull())
    unchanged = F.coalesce(F.col("fingerprint") == F.col("_fingerprint"), F.lit(True))
    return candidates.join(
        stored, (F.col("id").cast("string") == F.col("_id")) & unchanged, "left_anti"
    ).select(*CANDIDATE_COLUMNS)
