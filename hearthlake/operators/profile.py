"""Column profile of a table: one row per column."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values.
QUARTILES = [0.25, 0.5, 0.75]
SKETCH_ACCURACY = 100_000
#: Rows a quantile's bracket may hold before they are counted by value; wider brackets are narrowed first.
BRACKET_ROWS = 1_000_000
#: Parts a bracket is cut into to narrow it.
GRID = 100
BRACKETS = "column string, rows long, quantile double, lo double, hi double"


def _text_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, distinct values and the most frequent value per text column.

    Values are counted first, so a value that fills a third of a column is one row per
    map task. Of equally frequent values the smallest is named.
    """
    values = df.unpivot([], columns, "column", "value").groupBy("column", "value").agg(F.count("*").alias("n"))
    present = F.col("value").isNotNull()
    rank = F.when(present, F.struct((-F.col("n")).alias("n"), "value"))
    return values.groupBy("column").agg(
        F.coalesce(F.sum(F.when(present, F.col("n"))), F.lit(0)).alias("count"),
        F.count("value").alias("unique"),
        F.min_by("value", rank).alias("top"),
        F.max(F.when(present, F.col("n"))).alias("freq"),
    )


def exact_quantiles(
    values: DataFrame, quantiles: list[float], accuracy: int = SKETCH_ACCURACY
) -> DataFrame:
    """Exact linear-interpolated quantiles of ``column, value``: column, quantile, result.

    A sketch brackets each quantile: its rank error is at most 1/accuracy of the rows,
    so bounds two such steps to either side enclose the wanted rank, or miss it by one
    where a step is less than a row. The second pass counts equal values inside the
    bracket and lumps the rest into one cell below and one above, which still know the
    value next to the bracket. Each window sees about four steps of the rows at most
    and no group of raw rows is ever gathered.
    """
    step = 2.0 / accuracy
    asked = [min(max(q + s, 0.0), 1.0) for q in quantiles for s in (-step, step)]
    sketch = values.groupBy("column").agg(
        F.count("*").alias("rows"), F.percentile_approx("value", asked, accuracy).alias("bounds")
    )
    brackets = sketch.select(
        "column",
        "rows",
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(q).alias("quantile"),
                        F.col("bounds")[2 * i].alias("lo"),
                        F.col("bounds")[2 * i + 1].alias("hi"),
                    )
                    for i, q in enumerate(quantiles)
                ]
            )
        ),
    )
    return quantiles_between(values, brackets)


def quantiles_between(values: DataFrame, brackets: DataFrame) -> DataFrame:
    """The quantiles of ``column, value`` whose brackets (column, rows, quantile, lo, hi) are known, in one pass."""
    # One row per column and quantile: bounded by the schema, safe to broadcast.
    placed = values.join(F.broadcast(brackets), "column")
    value = F.col("value")
    cells = (
        placed.withColumn("_zone", F.when(value < F.col("lo"), -1).when(value > F.col("hi"), 1).otherwise(0))
        .withColumn("_cell", F.when(F.col("_zone") == 0, value))
        .groupBy("column", "quantile", "rows", "_zone", "_cell")
        .agg(F.count("*").alias("n"), F.min("value").alias("v"), F.max("value").alias("top"))
    )
    upto = Window.partitionBy("column", "quantile").orderBy("_zone", "_cell")
    rank = F.col("quantile") * (F.col("rows") - 1)
    ranked = cells.withColumn("end", F.sum("n").over(upto)).withColumn("start", F.col("end") - F.col("n"))

    def at(position):
        inside = (F.col("_zone") == 0) & position.between(F.col("start"), F.col("end") - 1)
        last_below = (F.col("_zone") == -1) & (position == F.col("end") - 1)
        first_above = (F.col("_zone") == 1) & (position == F.col("start"))
        return F.max(F.when(inside | first_above, F.col("v")).when(last_below, F.col("top")))

    found = ranked.groupBy("column", "quantile").agg(
        at(F.floor(rank)).alias("below"),
        at(F.ceil(rank)).alias("above"),
        F.max(rank - F.floor(rank)).alias("part"),
    )
    return found.select(
        "column",
        "quantile",
        (F.col("below") + (F.col("above") - F.col("below")) * F.col("part")).alias("result"),
    )


def _valued(column: str) -> Column:
    """The number as double, NULL for NaN."""
    value = F.col(f"`{column}`").cast("double")
    return F.when(~F.isnan(value), value)


def narrowed(df: DataFrame, brackets: list[tuple], accuracy: int, most: int = BRACKET_ROWS) -> list[tuple]:
    """The brackets (column, rows, quantile, lo, hi) cut down until each holds ``most`` rows or stays as it is.

    A pass over all wide brackets counts the rows below and inside each and takes a grid
    of the inside's quantiles, between two of which the wanted rank lies; it leaves about
    four hundredths. Only the grids reach the driver, GRID numbers for each bracket.
    """
    # The sketch is off by 1 / accuracy on both sides, and its bounds are two of these steps apart from the quantile.
    wide = {i: b for i, b in enumerate(brackets) if b[3] is not None and b[3] < b[4] and 6 * b[1] / accuracy > most}
    brackets = list(brackets)
    while wide:
        parts = []
        for i, (column, _, _, lo, hi) in wide.items():
            value = _valued(column)
            inside = F.when(value.between(lo, hi), value)
            grid = F.percentile_approx(inside, [g / GRID for g in range(GRID + 1)], max(accuracy, 10 * GRID))
            parts.append(F.struct(F.count(F.when(value < lo, 1)), F.count(inside), grid).alias(f"b{i}"))
        row = df.agg(*parts).first()
        left = {}
        for i, (column, rows, quantile, lo, hi) in wide.items():
            below, inside, grid = row[f"b{i}"]
            at = (quantile * (rows - 1) - below) / max(1, inside) * GRID
            first, last = math.floor(at) - 1, math.ceil(at) + 1
            brackets[i] = (column, rows, quantile, grid[first] if first > 0 else lo, grid[last] if last < GRID else hi)
            _, _, _, low, high = brackets[i]
            if low < high and (low, high) != (lo, hi) and 4 * inside / GRID > most:
                left[i] = brackets[i]
        wide = left
    return brackets


def _number_profile(df: DataFrame, columns: list[str], accuracy: int = SKETCH_ACCURACY, most: int = BRACKET_ROWS) -> DataFrame:
    """Moments and sketches of all columns in one aggregate, then one pass that counts inside the brackets.

    The aggregate's single row, bounded by the schema, goes to the driver.
    """
    step = 2.0 / accuracy
    asked = [min(max(q + s, 0.0), 1.0) for q in QUARTILES for s in (-step, step)]
    parts = []
    for i, c in enumerate(columns):
        v = _valued(c)
        figures = F.count(v), F.avg(v), F.stddev_samp(v), F.min(v), F.max(v), F.percentile_approx(v, asked, accuracy)
        parts.append(F.struct(*figures).alias(f"c{i}"))
    found = dict(zip(columns, df.agg(*parts).first()))
    brackets = [
        (c, figures[0], q, figures[5][2 * i], figures[5][2 * i + 1]) for c, figures in found.items() if figures[0] for i, q in enumerate(QUARTILES)
    ]
    spark = df.sparkSession
    brackets = spark.createDataFrame(narrowed(df, brackets, accuracy, most), BRACKETS)
    moments = spark.createDataFrame(
        [(c, *figures[:5]) for c, figures in found.items()], "column string, count long, mean double, std double, min double, max double"
    )
    values = df.select([_valued(c).alias(c) for c in columns]).unpivot([], columns, "column", "value").filter("value IS NOT NULL")
    quartiles = quantiles_between(values, brackets).groupBy("column").agg(
        *[F.max(F.when(F.col("quantile") == q, F.col("result"))).alias(f"p{int(q * 100)}") for q in QUARTILES]
    )
    return moments.join(quartiles, "column", "left")


def describe(df: DataFrame) -> DataFrame:
    """Profile of all text and number columns.

    Text columns have count, unique, top and freq; number columns have count, mean, std,
    min, quartiles and max. The figures of the other kind are NULL. The table is scanned
    three times: for the numbers' moments and sketches (at once), for their quartiles and
    for the texts; tables beyond some 10^10 rows once more for each narrowing of brackets.
    """
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    number = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    parts = [_text_profile(df, text)] if text else []
    parts += [_number_profile(df, number)] if number else []
    if not parts:
        raise ValueError("no text or number column to describe")
    profile = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
    return profile
