"""Keys and fingerprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values.
MERGE_KEY = "propertyDetails_propertyId"
NORMALIZED_PRICE = "propertyDetails_normalizedPrice"
KEY_LENGTH = 16
MISSING_URL = "None"


def url_key(url: Column) -> Column:
    """First 16 hex characters of the md5 of the url; a missing url hashes as ``None``."""
    return F.substring(F.md5(F.coalesce(url, F.lit(MISSING_URL))), 1, KEY_LENGTH)


def with_merge_key(df: DataFrame) -> DataFrame:
    """Add the merge key unless present: ``id`` as text, else the hashed url."""
    if MERGE_KEY in df.columns:
        return df
    source = F.col("id").cast("string") if "id" in df.columns else url_key(F.col("url"))
    return df.withColumn(MERGE_KEY, source)


def fingerprint(key: Column, price: Column) -> Column:
    """``key-price``; NULL when either is NULL. Price should be integral or decimal."""
    return F.concat(key.cast("string"), F.lit("-"), price.cast("string"))


def criterion_key(city: Column, rent_or_buy: Column, property_type: Column, radius: Column) -> Column:
    """City, action, type and radius joined by ``_``, dashes replaced, lower case."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in (city, rent_or_buy, property_type)]
    parts.append(F.coalesce(radius.cast("string"), F.lit("0")))
    return F.lower(F.replace(F.concat_ws("_", *parts), F.lit("-"), F.lit("_")))
