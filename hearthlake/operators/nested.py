"""Nested JSON records to flat columns."""

from __future__ import annotations

from collections.abc import Iterator

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthlake.functions.keys import NORMALIZED_PRICE
from hearthlake.operators.columns import parquet_safe_columns

# Fixed values.
SEPARATOR = "_"
FACT_ID = "FactId"
BULKY_COLUMNS = [
    "propertyDetails_images",
    "propertyDetails_pdfs",
    "propertyDetails_commuteTimes_defaultPois_transportations",
    "viewData_viewDataWeb_webView_structuredData",
]
PRICE_COLUMNS = ["listing_prices_buy_price", "listing_prices_rent_price"]


def _leaves(schema: T.StructType, path: tuple[str, ...] = ()) -> Iterator[tuple[str, ...]]:
    for field in schema.fields:
        here = (*path, field.name)
        if isinstance(field.dataType, T.StructType):
            yield from _leaves(field.dataType, here)
        else:
            yield here


def flatten(df: DataFrame) -> DataFrame:
    """One column per leaf of the nested structs, names joined by ``_``.

    A projection, so only the leaves a later step uses are read.
    """
    return df.select(
        *[
            F.col(".".join(f"`{part}`" for part in leaf)).alias(SEPARATOR.join(leaf))
            for leaf in _leaves(df.schema)
        ]
    )


def arrays_to_json(df: DataFrame) -> DataFrame:
    """Array columns as JSON text, the others untouched. A NULL field of a struct is written as null."""
    return df.select(
        *[
            F.to_json(f"`{f.name}`", {"ignoreNullFields": "false"}).alias(f.name)
            if isinstance(f.dataType, T.ArrayType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def unify_price(df: DataFrame) -> DataFrame:
    """The buy price column, or else the rent price column, under one name."""
    found = next((c for c in PRICE_COLUMNS if c in df.columns), None)
    return df.withColumnRenamed(found, NORMALIZED_PRICE) if found else df


def drop_bulky(df: DataFrame, names: Sequence[str] = BULKY_COLUMNS) -> DataFrame:
    return df.drop(*names)


def flatten_records(df: DataFrame) -> DataFrame:
    """Flat table of nested property records, ready for Parquet."""
    flat = parquet_safe_columns(flatten(df).drop(FACT_ID))
    return arrays_to_json(unify_price(flat))


def is_json(text: Column) -> Column:
    """Whether the text is one valid JSON value, scalars included, of any length; NULL text is not.

    The parser ignores what follows the first value. A text that is the only element
    of an array and the only member of an object has nothing after it. The parser
    also takes strings in single quotes, which JSON doesn't have: these are found by
    what is left without escapes and without strings in double quotes.
    """
    bare = F.regexp_replace(F.regexp_replace(text, r"(?s)\\.", ""), '"[^"]*+"', "")
    elements = F.json_array_length(F.concat(F.lit("["), text, F.lit("]")))
    members = F.size(F.json_object_keys(F.concat(F.lit('{"v":'), text, F.lit("}"))))
    return F.coalesce((elements == 1) & (members == 1) & ~bare.contains("'"), F.lit(False))
