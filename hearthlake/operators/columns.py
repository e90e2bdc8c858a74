"""Column names, fixed schemas, lineage columns and row filters."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values.
PARQUET_SPECIAL = r"[ ,;{}()\n\t=]"
EMPTY_NAME = "column"
LISTING_SCHEMA = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("Diện tích", T.StringType()),
        T.StructField("Mức giá", T.StringType()),
        T.StructField("Địa chỉ", T.StringType()),
        T.StructField("Ngày đăng", T.StringType()),
        T.StructField("Tiêu đề", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
    ]
)


def rename_columns(df: DataFrame, rule: Callable[[str], str]) -> DataFrame:
    """Rename every column by ``rule``; two columns with one new name are an error."""
    names = [rule(name) for name in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"columns share a name after renaming: {', '.join(clashes)}")
    return df.toDF(*names)


def sanitize_name(name: str) -> str:
    """ASCII letters and digits in runs joined by ``_``, lower case."""
    ascii_only = unicodedata.normalize("NFD", name).encode("ascii", "ignore").decode("ascii")
    return "_".join(re.findall("[A-Za-z0-9]+", ascii_only)).lower() or EMPTY_NAME


def parquet_safe_name(name: str) -> str:
    return re.sub(PARQUET_SPECIAL, "", name).replace(".", "_")


def sanitize_columns(df: DataFrame) -> DataFrame:
    return rename_columns(df, sanitize_name)


def parquet_safe_columns(df: DataFrame) -> DataFrame:
    return rename_columns(df, parquet_safe_name)


def prefix_columns(df: DataFrame, prefix: str) -> DataFrame:
    return rename_columns(df, lambda name: prefix + name)


def canonicalize_columns(df: DataFrame) -> DataFrame:
    return rename_columns(df, str.lower)


def replace_values(df: DataFrame, old, new) -> DataFrame:
    """Replace a value wherever it occurs in a column of its type."""
    return df.na.replace(old, new)


def conform(df: DataFrame, schema: T.StructType = LISTING_SCHEMA) -> DataFrame:
    """Exactly the columns of ``schema`` in its order; missing ones are NULL."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def empty_listings(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LISTING_SCHEMA)


def attach_lineage(
    df: DataFrame,
    city: Column | str = "",
    property_type: Column | str = "",
    rent_or_buy: Column | str = "",
    radius: Column | int = 0,
) -> DataFrame:
    """Add the search criterion a listing was found with, as constants or columns."""

    def value(v):
        return v if isinstance(v, Column) else F.lit(v)

    return df.withColumns(
        {
            "search_city": value(city),
            "search_property_type": value(property_type),
            "search_rent_or_buy": value(rent_or_buy),
            "search_radius": value(radius).cast("int"),
        }
    )


def filter_city(df: DataFrame, cities: str | Sequence[str] | None, column: str = "search_city") -> DataFrame:
    """Rows of the given cities; all rows when no city is given or the column is absent."""
    wanted = [cities] if isinstance(cities, str) else list(cities or [])
    wanted = [c for c in wanted if c]
    if not wanted or column not in df.columns:
        return df
    return df.filter(F.col(column).isin(wanted))


def lookup(df: DataFrame, key: str, value, columns: Sequence[str]) -> DataFrame:
    """The given columns of the rows with one key value."""
    return df.filter(F.col(key) == value).select(*[F.col(f"`{c}`") for c in columns])


def sample_one(df: DataFrame, column: str, seed: int) -> DataFrame:
    """One value of a column drawn at random; a top-1 over a random number, not a sort."""
    return df.select(column).orderBy(F.rand(seed)).limit(1)


def emit_if(df: DataFrame, condition: bool) -> DataFrame:
    """The frame when the condition holds, else no rows of the same schema."""
    return df.filter(F.lit(condition))
