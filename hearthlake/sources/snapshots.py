"""Table snapshots as plain Parquet folders with a history.

Each write makes a folder ``version=N`` of its own and then adds one line to the history.
A version exists once its line does, so a write that dies half-way is invisible and its
folder is overwritten by the next attempt. One writer at a time is assumed. Where the
catalog has a table format with transactions, use that and ``upsert.merge_into``.

A table that is merged into lies in buckets of its key's hash. A version of it holds the
buckets it changed, and lines that name them; all other buckets stay where an earlier
version wrote them. Readers take each bucket from the last version that has it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthlake.operators.nested import BULKY_COLUMNS, drop_bulky

HISTORY_SCHEMA = "version int, timestamp timestamp, operation string"
#: Which buckets a version wrote, of how many, and whether it wrote the table anew.
BUCKETS_SCHEMA = "version int, bucket int, buckets int, anew boolean"
BUCKET = "_bucket"
#: Buckets of a new table, unless its first merge says otherwise; a bucket is what a merge reads and writes at least.
BUCKETS = 16


def _lines(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).json(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def history(spark: SparkSession, root: str) -> DataFrame:
    """Version, time and operation of every completed write; no rows for a new table."""
    return _lines(spark, f"{root}/history", HISTORY_SCHEMA)


def latest_version(spark: SparkSession, root: str) -> int | None:
    return history(spark, root).agg(F.max("version")).first()[0]


def write_snapshot(df: DataFrame, root: str, operation: str = "WRITE") -> int:
    """Write the next version and return its number."""
    version = next_version(df.sparkSession, root)
    df.write.mode("overwrite").parquet(f"{root}/version={version}")
    return complete(df.sparkSession, root, version, operation)


def next_version(spark: SparkSession, root: str) -> int:
    latest = latest_version(spark, root)
    return 0 if latest is None else latest + 1


def complete(spark: SparkSession, root: str, version: int, operation: str) -> int:
    entry = spark.range(1).select(
        F.lit(version).alias("version"),
        F.current_timestamp().alias("timestamp"),
        F.lit(operation).alias("operation"),
    )
    entry.write.mode("append").json(f"{root}/history")
    return version


def bucket_of(key: str, buckets: int) -> Column:
    """The bucket of a key; a NULL key has one too."""
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


def buckets_of(df: DataFrame, key: str, buckets: int) -> list[int]:
    """The buckets that have rows, ``buckets`` numbers at most."""
    return sorted(row[0] for row in df.select(bucket_of(key, buckets)).distinct().collect())


def write_buckets(df: DataFrame, root: str, key: str, operation: str, anew: bool, buckets: int = BUCKETS) -> int:
    """Write the next version in buckets: of a table written ``anew`` all that there are, else only those changed.

    The rows of a bucket must be all of it, and there must be some. Lines of a version that
    never got its history line aren't read, and the next attempt overwrites them.
    """
    spark = df.sparkSession
    version = next_version(spark, root)
    folder = f"{root}/version={version}"
    # Small buckets share a task, large ones are split over several. Sorted keys and bloom filters let a lookup skip row groups.
    dealt = df.withColumn(BUCKET, bucket_of(key, buckets)).hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, key)
    writer = dealt.write.mode("overwrite").partitionBy(BUCKET)
    writer.option(f"parquet.bloom.filter.enabled#{key}", "true").option("parquet.bloom.filter.adaptive.enabled", "true").parquet(folder)
    written = spark.read.parquet(folder).select(F.col(BUCKET).cast("int").alias("bucket")).distinct()
    lines = written.select(F.lit(version).alias("version"), "bucket", F.lit(buckets).alias("buckets"), F.lit(anew).alias("anew"))
    lines.write.mode("overwrite").json(f"{root}/buckets/{version}")
    return complete(spark, root, version, operation)


def live_buckets(spark: SparkSession, root: str, version: int) -> tuple[dict[int, int], int]:
    """(bucket -> the version that holds it, number of buckets) at the given version; none for a version without buckets."""
    lines = _lines(spark, f"{root}/buckets/*", BUCKETS_SCHEMA).where(F.col("version") <= version).collect()
    if not any(line.version == version for line in lines):
        return {}, 0
    first = max(line.version for line in lines if line.anew)
    live: dict[int, int] = {}
    for line in lines:
        if line.version >= first:
            live[line.bucket] = max(line.version, live.get(line.bucket, first))
    return live, max(line.buckets for line in lines if line.version == version)


def read_buckets(spark: SparkSession, root: str, live: dict[int, int], buckets: Sequence[int] | None = None) -> DataFrame:
    """The rows of the live buckets, or of some of them only; the files of the others aren't read."""
    paths = {b: f"{root}/version={v}/{BUCKET}={b}" for b, v in sorted(live.items())}
    schema = spark.read.parquet(next(iter(paths.values()))).schema
    wanted = [path for b, path in paths.items() if buckets is None or b in buckets]
    return spark.read.schema(schema).parquet(*wanted) if wanted else spark.createDataFrame([], schema)


def read_key(spark: SparkSession, root: str, key: str, value) -> DataFrame | None:
    """The current rows of one key, from the files of its bucket only; None when there is no table yet.

    ``key`` is the column the table lies in buckets of, and ``value`` of its type. A version without buckets is read with
    the filter pushed down.
    """
    version = latest_version(spark, root)
    if version is None:
        return None
    live, buckets = live_buckets(spark, root, version)
    if not live:
        return read_version(spark, root, version).where(F.col(f"`{key}`") == value)
    bucket = spark.range(1).select(F.lit(value).alias(key)).select(bucket_of(key, buckets)).first()[0]
    return read_buckets(spark, root, live, [bucket]).where(F.col(f"`{key}`") == value)


def read_version(spark: SparkSession, root: str, version: int) -> DataFrame:
    live, _ = live_buckets(spark, root, version)
    return read_buckets(spark, root, live) if live else spark.read.parquet(f"{root}/version={version}")


def read_current(spark: SparkSession, root: str, without: Sequence[str] = BULKY_COLUMNS) -> DataFrame | None:
    """The latest version without the named columns, by default the bulky nested ones; None when there is no table yet."""
    version = latest_version(spark, root)
    return None if version is None else drop_bulky(read_version(spark, root, version), without)
