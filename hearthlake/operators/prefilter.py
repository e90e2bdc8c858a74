"""A filter of fixed size that leaves out rows whose key no other table holds, before anything costly is done with them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Two to this power bits: 4 MB, whatever the number of keys. More keys than bits let more rows pass, never fewer.
FILTER_BITS = 25
#: Bits of one bitmap of Spark's bitmap functions.
BITMAP_BITS = 32_768


def _place(key: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(1 << bits))


def key_bitmap(keys: DataFrame, column: str, bits: int = FILTER_BITS) -> DataFrame:
    """(bucket, bitmap): the hashed keys as bitmaps, at most 2 to the ``bits`` of them; NULL keys are left out."""
    place = keys.where(F.col(column).isNotNull()).select(_place(F.col(column), bits).alias("_place"))
    # Spark counts bucket and position from 1 on; what is handed to it only has to be the same on both sides.
    return place.groupBy(F.bitmap_bucket_number("_place").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_place")).alias("_bitmap")
    )


def with_possible_key(rows: DataFrame, key: Column, bitmap: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """The rows whose key may be among those of ``bitmap``: all that are, and a share of the others that grows with the filled bits.

    The bitmaps are broadcast, since their size is fixed, so the rows are never shuffled:
    they may be as wide as whole pages. A join on the key itself must follow.
    """
    named = rows.withColumn("_key_place", _place(key, bits)).withColumn("_bucket", F.bitmap_bucket_number("_key_place"))
    bit = F.bitmap_bit_position("_key_place").cast("int")
    byte = F.conv(F.hex(F.substr(F.col("_bitmap"), F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.call_function("getbit", byte, F.pmod(bit, F.lit(8))) == 1
    return named.join(F.broadcast(bitmap), "_bucket").where(key.isNotNull() & hit).select(*[f"`{c}`" for c in rows.columns])
