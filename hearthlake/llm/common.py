"""What the operators share: words, ASCII lower case, checkpoints, ranks and running sums without a hot window."""

from __future__ import annotations

import math
import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hearthlake.session import shared_folder

#: A word is a run of characters that are none of these six white space characters.
WHITE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

#: Rows a window of ranks holds on average; its largest is a little above, whatever the keys are.
ROWS_PER_BUCKET = 20_000


def given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def whole_text(name: str = "text") -> Column:
    """The text, empty where it is NULL."""
    return F.coalesce(F.col(name), F.lit(""))


def apart(docs: DataFrame, *used: str) -> DataFrame:
    """The frame with all columns but the used ones renamed, so that none clashes with a helper column; ``toDF(*docs.columns)`` turns it back."""
    return docs.toDF(*[c if c in used else f"_extra_{i}" for i, c in enumerate(docs.columns)])


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD + "+"), F.lit(0))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; all other letters stay as they are."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, also where the body names it often."""
    return F.element_at(F.transform(F.array(value), body), 1)


def checkpointed(frame: DataFrame) -> DataFrame:
    """The frame written to the shared checkpoint folder, where a lost executor doesn't take it along."""
    spark = frame.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or shared_folder(spark))
    return frame.checkpoint(eager=True)


def stored(frame: DataFrame, codec: str = "snappy") -> DataFrame:
    """The frame written to the shared folder as Parquet, for what is wide or read by columns."""
    folder = shared_folder(frame.sparkSession)
    frame.write.parquet(folder, compression=codec)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


def seeded(seed: int, *names: str) -> Column:
    """A reproducible shuffle key: 32 hexadecimal digits that depend on the seed and the named columns."""
    parts = [F.coalesce(F.col(n).cast("string"), F.lit("")) for n in names]
    return F.md5(F.concat_ws("/", F.lit(str(seed)), *parts))


def leading(key: Column, bits: int) -> Column:
    """The first bits of a hexadecimal key, as a number that sorts as the key does."""
    return F.shiftright(F.conv(F.substring(key, 1, 8), 16, 10).cast("long"), 32 - bits)


def bucket_bits(rows: int, rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    return min(31, max(0, math.ceil(math.log2(max(1, rows) / rows_per_bucket))))


def ranked(
    frame: DataFrame, group: list[str], bucket: str, order: list[Column], rank: str, sums: dict[str, str] | None = None, sizes: str | None = None
) -> DataFrame:
    """Add each row's rank in its group, from 0, and running sums of what stands before it.

    ``bucket`` must rise with ``order`` and cut every group, a hot one too, into parts
    of bounded size: a window sees one bucket of one group, and what stands before the
    bucket comes from a sum for each bucket. ``sums`` names the running sums by the
    columns they add up; ``sizes`` names a column for the rows of the group.
    """
    sums = sums or {}
    totals = frame.groupBy(*group, bucket).agg(F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_sum_{c}") for c in sums])
    # One row per bucket: 5 million rows at 10^11 documents.
    whole = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    earlier = whole.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        *group,
        bucket,
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_rows_before"),
        F.sum("_n").over(whole).alias("_rows"),
        *[F.coalesce(F.sum(f"_sum_{c}").over(earlier), F.lit(0)).alias(f"_before_{c}") for c in sums],
    )
    inside = Window.partitionBy(*group, bucket).orderBy(*order)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    return (
        frame.join(totals, [*group, bucket])
        .withColumn(rank, F.col("_rows_before") + F.row_number().over(inside) - 1)
        .withColumns({name: F.col(f"_before_{c}") + F.coalesce(F.sum(c).over(before), F.lit(0)) for c, name in sums.items()})
        .withColumns({sizes: F.col("_rows")} if sizes else {})
        .drop("_rows_before", "_rows", *[f"_before_{c}" for c in sums])
    )
