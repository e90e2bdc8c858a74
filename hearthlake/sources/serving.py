"""Publishing the serving table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthlake.functions.numbers import clean_number
from hearthlake.operators.columns import filter_city, sanitize_columns
from hearthlake.operators.dedup import dedup_keep_last
from hearthlake.sources import snapshots

# Fixed values.
SERVING_TABLE = "real_estate_properties"
JDBC_BATCH = 1000
JDBC_DRIVER = "org.postgresql.Driver"

#: Folders of the stored serving table: the city and the month of the date. NULL and empty cities share one, as do unreadable dates.
CITY, MONTH = "_served_city", "_served_month"
#: Price, area and date as numbers and a date, beside the text they were read from.
PRICE, AREA, POSTED = "_served_price", "_served_area", "_served_on"


def serving_rows(
    current: DataFrame,
    order: Sequence[Column | str] | None = None,
    cities: str | Sequence[str] | None = None,
    key: str | None = None,
) -> DataFrame:
    """What the serving table holds: last row per key, the wanted cities, sanitized names.

    Without ``order`` the rows are taken to be unique by key already.
    """
    unique = current if order is None else dedup_keep_last(current, order, key)
    return sanitize_columns(filter_city(unique, cities))


def write_served(rows: DataFrame, root: str) -> int:
    """Write the next version of the serving table and return how many rows went into it, counted by the write itself.

    Rows lie in folders of their city and month, sorted by date, with typed columns beside the
    text. A large city's month is split over several files; small ones share a task. Of
    the columns read here any may be absent.
    """
    spark = rows.sparkSession
    text = {name: F.col(name) if name in rows.columns else F.lit(None).cast("string") for name in ("muc_gia", "dien_tich", "ngay_ang", "search_city")}
    laid = rows.withColumns(
        {
            PRICE: clean_number(text["muc_gia"]),
            AREA: clean_number(text["dien_tich"]),
            POSTED: text["ngay_ang"].cast("string").try_cast("date"),
            CITY: F.nullif(text["search_city"].cast("string"), F.lit("")),
        }
    ).withColumn(MONTH, F.date_format(POSTED, "yyyy-MM"))
    version = snapshots.next_version(spark, root)
    folder = f"{root}/version={version}"
    # Counted after the exchange, in the tasks that write: each of them counts once, however often it is tried.
    counted = Observation()
    dealt = laid.hint("rebalance", CITY, MONTH).observe(counted, F.count(F.lit(1)).alias("rows"))
    dealt.sortWithinPartitions(CITY, MONTH, POSTED).write.mode("overwrite").partitionBy(CITY, MONTH).parquet(folder)
    # Without rows there are no folders, and no metrics where the plan is known to be empty; a file keeps the columns.
    written = counted.get.get("rows", 0)
    if not written:
        laid.limit(0).write.mode("overwrite").parquet(folder)
    snapshots.complete(spark, root, version, "PUBLISH")
    return written


def read_served(
    spark: SparkSession, root: str, cities: str | Sequence[str] | None = None, since: str | None = None, typed: bool = False
) -> DataFrame | None:
    """The serving table as published, or of some cities or from the month ``since`` (``yyyy-MM``) on; other folders aren't read.

    ``typed`` adds the typed columns and the folders' columns. Rows without a readable date
    are in no month. None when nothing was published yet.
    """
    version = snapshots.latest_version(spark, root)
    if version is None:
        return None
    folder = f"{root}/version={version}"
    found = spark.read.parquet(folder).schema
    # Folder names are text, also where they look like numbers.
    schema = T.StructType([T.StructField(f.name, T.StringType()) if f.name in (CITY, MONTH) else f for f in found.fields])
    table = spark.read.schema(schema).parquet(folder)
    if "search_city" in table.columns:
        table = filter_city(filter_city(table, cities, CITY), cities)
    if since is not None:
        table = table.where(F.col(MONTH) >= since)
    return table if typed else table.drop(PRICE, AREA, POSTED, CITY, MONTH)


def month_of_latest_dates(spark: SparkSession, root: str, days: int, cities: str | Sequence[str] | None = None) -> str | None:
    """The month from which on there are ``days`` dates with a price and an area, or the first month there is.

    Months are tried from the newest on, twice as many each time, so at most about twice
    the months that are needed are read, of three narrow columns. None without dates.
    """
    table = read_served(spark, root, cities, typed=True)
    # A number of rows that the calendar bounds, from folder names.
    months = [] if table is None else [row[0] for row in table.select(MONTH).where(f"{MONTH} IS NOT NULL").distinct().orderBy(F.desc(MONTH)).collect()]
    take = 2
    while take < len(months):
        recent = table.where(F.col(MONTH) >= months[take - 1]).where(f"{PRICE} IS NOT NULL AND {AREA} IS NOT NULL")
        if recent.select(POSTED).distinct().limit(days).count() == days:
            return months[take - 1]
        take *= 2
    return months[-1] if months else None


def publish_table(df: DataFrame, table: str = SERVING_TABLE) -> None:
    """Replace a catalog table. It must not be the table ``df`` reads."""
    df.write.mode("overwrite").saveAsTable(table)


def jdbc_url(host: str, port: int, database: str) -> str:
    return f"jdbc:postgresql://{host}:{port}/{database}"


def publish_jdbc(
    df: DataFrame, url: str, user: str, password: str, table: str = SERVING_TABLE, connections: int = 8
) -> None:
    """Replace a database table over at most ``connections`` parallel connections."""
    df.write.option("batchsize", JDBC_BATCH).option("numPartitions", connections).jdbc(
        url,
        table,
        mode="overwrite",
        properties={"user": user, "password": password, "driver": JDBC_DRIVER},
    )
