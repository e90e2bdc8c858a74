"""Mixing sources to target weights along a time-varying curriculum (operator 7). DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hearthlake.llm.common import ROWS_PER_BUCKET, apart, bucket_bits, checkpointed, given, leading, ranked, seeded, stored, whole_text, words

SEED = 11
#: Sources by code point, NULL last, take these weights in turn.
WEIGHTS = (5, 2, 1)
#: All targets together, in halves of all sizes: three halves are 150 %.
BUDGET_HALVES = 3
MOST_EPOCHS = 2
#: For each weight its schedule over the training time 0 to 1: (time, relative weight), straight between the knots.
#: Heavy sources are frequent early, light ones late.
SCHEDULES = (
    ((0.0, 1.5), (1.0, 0.5)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.25), (0.5, 1.0), (1.0, 1.75)),
)


def training_time(demand: Column, schedule: tuple[tuple[float, float], ...]) -> Column:
    """The time at which a source has had this share of its demand: the inverse of its schedule's integral."""
    pieces, total = [], 0.0
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]):
        pieces.append((total, t0, w0, (w1 - w0) / (t1 - t0)))
        total += (w0 + w1) / 2 * (t1 - t0)
    time = None
    for begun, t0, w0, slope in pieces:
        rest = demand * total - begun
        # Solve w0 x + slope x^2 / 2 = rest for x from 0.
        x = rest / w0 if slope == 0 else (F.sqrt(F.greatest(F.lit(0.0), F.lit(w0 * w0) + F.lit(2 * slope) * rest)) - w0) / slope
        here = F.lit(t0) + x
        time = here if time is None else F.when(demand * total >= begun, here).otherwise(time)
    return F.least(F.lit(1.0), time)


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """_source, _kind, source_size, target: the words to take of each source (_source, _null, source_size).

    The budget is shared by weight. A source stops at MOST_EPOCHS times its size, and
    what it leaves is shared again among the others: with sources sorted by the level
    at which they fill up, the first k are full when the level of the rest exceeds
    theirs, so one ordered sum replaces the rounds. One row per source.
    """
    everything = Window.partitionBy(F.lit(0))
    by_name = everything.orderBy("_null", "_source")
    kind = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_kind") + 1).cast("int"))
    cap = F.col("source_size").cast("double") * MOST_EPOCHS
    fills = everything.orderBy(F.col("_cap") / F.col("_weight"), "_null", "_source")
    earlier = fills.rowsBetween(Window.unboundedPreceding, -1)
    rest = F.col("_budget") - F.coalesce(F.sum("_cap").over(earlier), F.lit(0.0))
    open_weight = F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(earlier), F.lit(0.0))
    return (
        sources.withColumn("_kind", kind)
        .withColumn("_weight", weight)
        .withColumn("_cap", cap)
        .withColumn("_budget", F.sum("source_size").over(everything).cast("double") * BUDGET_HALVES / 2)
        .withColumns({"_rest": rest, "_open": open_weight})
        .withColumn("_full", F.col("_rest") * F.col("_weight") >= F.col("_cap") * F.col("_open"))
        # The first source that doesn't fill up sets the level for itself and all after it.
        .withColumn("_level_rest", F.first(F.when(~F.col("_full"), F.col("_rest")), ignorenulls=True).over(fills))
        .withColumn("_level_open", F.first(F.when(~F.col("_full"), F.col("_open")), ignorenulls=True).over(fills))
        .withColumn("target", F.when(F.col("_full"), F.col("_cap")).otherwise(F.col("_weight") * F.col("_level_rest") / F.col("_level_open")))
        .select("_source", "_null", "_kind", "source_size", "target")
    )


def mixed(docs: DataFrame, seed: int = SEED, rows_per_bucket: int = ROWS_PER_BUCKET, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text, source): sizes, target, what is taken and when.

    Columns: doc_id, size, source_size, target, taken, first_position, second_position.
    A source's documents lie in a seeded order, pass after pass, and a copy of a document
    is taken while the middle of its words lies before the target; so a document is taken
    whole, at most MOST_EPOCHS times, and a source's taken words miss the target by half
    a document at most. A copy's position is the time in [0, 1] at which the integral of
    the source's schedule demands its middle word; NULL if it isn't taken.

    size counts words, NULL text has none. NULL source is a source of its own, after all
    others. A document without words is taken as its place asks, with 0 words; where a
    whole source has none, each document is taken once at its place. Ties of the seeded
    key (a doc_id that repeats) are ordered by size, then by the columns in ``keep``, which
    are returned too; rows alike are interchangeable. An empty table gives an empty result.
    """
    rows = checkpointed(
        docs.select(
            "doc_id",
            F.size(words(whole_text())).cast("long").alias("size"),
            F.coalesce(F.col("source"), F.lit("")).alias("_source"),
            F.col("source").isNull().alias("_null"),
            seeded(seed, "doc_id").alias("_key"),
            *keep,
        )
    )
    bits = bucket_bits(rows.count(), rows_per_bucket)
    group = ["_source", "_null"]
    shares = targets(rows.groupBy(*group).agg(F.sum("size").alias("source_size")))
    placed = ranked(rows.withColumn("_bucket", leading(F.col("_key"), bits)), group, "_bucket", [F.col(c) for c in ("_key", "size", *keep)], "_rank", {"size": "_start"}, "_rows_of_source")
    placed = placed.join(shares, group)
    # In halves of a word, so that middles are whole numbers.
    empty = F.col("source_size") == 0

    def position(epoch: int) -> Column:
        middle = (F.col("_start") + F.col("source_size") * epoch) * 2 + F.col("size")
        share = F.when(empty, (F.col("_rank") + 0.5) / F.col("_rows_of_source")).otherwise(middle / (F.col("target") * 2))
        taken = (empty & F.lit(epoch == 0)) | (~empty & (middle <= F.col("target") * 2))
        time = F.lit(None).cast("double")
        for kind, schedule in enumerate(SCHEDULES):
            time = F.when(F.col("_kind") == kind, training_time(share, schedule)).otherwise(time)
        return F.when(taken, time)

    return (
        placed.withColumns({"first_position": position(0), "second_position": position(1)})
        .withColumn("taken", F.col("size") * (F.col("first_position").isNotNull().cast("long") + F.col("second_position").isNotNull().cast("long")))
        .select("doc_id", "size", "source_size", "target", "taken", "first_position", "second_position", *keep)
    )


def sequence(found: DataFrame, *keep: str, seed: int = SEED) -> DataFrame:
    """The mix in training order without its texts: a row of ``found`` (see ``mixed``) for each time it is taken, range-sorted by position.

    Columns: epoch (0 or 1), position, doc_id, size and those to ``keep``. Partitions and the rows in them ascend by position.
    """
    copies = F.filter(
        F.array(*[F.struct(F.lit(e).alias("epoch"), F.col(p).alias("position")) for e, p in enumerate(("first_position", "second_position"))]),
        lambda c: c["position"].isNotNull(),
    )
    return _by_position(found.select(F.inline(copies), "doc_id", "size", *keep), "position", seed)


def _by_position(copies: DataFrame, position: str, seed: int) -> DataFrame:
    return copies.repartitionByRange(position, "doc_id").sortWithinPartitions(position, seeded(seed, "doc_id"))


def curriculum(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The mix itself: rows of ``docs``, all columns, once for each time they are taken, range-sorted by position.

    Rows are stored with a number of their own, by which they find their positions, so a
    doc_id may repeat or be NULL. Ties of doc_id and size go by a hash of the text. Other
    columns may have any names.
    """
    named = apart(docs, "doc_id", "text", "source")
    rows = stored(named.withColumn("_row", F.monotonically_increasing_id()))
    found = mixed(rows.withColumn("_hash", F.xxhash64(whole_text())), seed, keep=("_hash", "_row"))
    times = F.filter(F.array("first_position", "second_position"), lambda p: p.isNotNull())
    taken = found.select("_row", times.alias("_times")).where(F.size("_times") > 0)
    copies = rows.join(taken, "_row").select(*named.columns, F.explode("_times").alias("_position"))
    return _by_position(copies, "_position", seed).select(*named.columns).toDF(*docs.columns)


def per_document(found: DataFrame, order: DataFrame) -> DataFrame:
    """The rows of ``mixed`` (with a ``_row`` each), what is taken of them and when read from the mix in training order."""
    place = lambda epoch: F.min(F.when(F.col("epoch") == epoch, F.col("position")))
    mix = order.groupBy("_row").agg(F.sum("size").alias("taken"), place(0).alias("first_position"), place(1).alias("second_position"))
    taken = F.coalesce("taken", F.lit(0).cast("long")).alias("taken")
    return (
        found.select("_row", "doc_id", "size", "source_size", "target")
        .join(mix, "_row", "left")
        .select("doc_id", "size", "source_size", "target", taken, "first_position", "second_position")
    )


def op7_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix is written in training order, without its texts, and what it takes of each document is read back from there."""
    found = checkpointed(mixed(given(spark, sf_dir, "documents")).withColumn("_row", F.monotonically_increasing_id()))
    return per_document(found, stored(sequence(found, "_row")))


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size, coalesce(source, '') AS s, source IS NULL AS n,
    md5('11/' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k
  FROM documents
), sums AS (
  SELECT s, n, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY n, s) - 1 AS i FROM sized GROUP BY s, n
), weighed AS (
  SELECT *, CASE i % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w, source_size * 2.0::DOUBLE AS cap,
    CAST(sum(source_size) OVER () AS DOUBLE) * 3 / 2 AS budget
  FROM sums
), ordered AS (
  SELECT *, budget - coalesce(sum(cap) OVER before, 0) AS rest, sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS open_weight,
    row_number() OVER (ORDER BY cap / w, n, s) AS pos
  FROM weighed WINDOW before AS (ORDER BY cap / w, n, s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT rest, open_weight FROM ordered WHERE rest * w < cap * open_weight ORDER BY pos LIMIT 1
), shares AS (
  SELECT s, n, source_size, i % 3 AS kind, CASE WHEN rest * w >= cap * open_weight THEN cap ELSE w * (SELECT rest FROM level) / (SELECT open_weight FROM level) END AS target
  FROM ordered
), placed AS (
  SELECT z.doc_id, z.size, h.source_size, h.target, h.kind,
    2 * coalesce(sum(z.size) OVER (PARTITION BY z.s, z.n ORDER BY z.k, z.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + z.size AS middle
  FROM sized z JOIN shares h ON z.s = h.s AND z.n = h.n
), epoch AS (
  SELECT *, middle AS m0, middle + 2 * source_size AS m1, CAST(middle AS DOUBLE) / (target * 2) AS d0, CAST(middle + 2 * source_size AS DOUBLE) / (target * 2) AS d1
  FROM placed
)
SELECT doc_id, size, source_size, target,
  CAST(size * (CAST(m0 <= target * 2 AS INT) + CAST(m1 <= target * 2 AS INT)) AS BIGINT) AS taken,
  CASE WHEN m0 <= target * 2 THEN least(1.0::DOUBLE, CASE WHEN kind = 0 THEN (sqrt(greatest(0.0::DOUBLE, 2.25::DOUBLE + (-2.0::DOUBLE) * d0)) - 1.5::DOUBLE) / (-1.0::DOUBLE)
    WHEN kind = 1 THEN d0 WHEN d0 >= 0.3125 THEN 0.5::DOUBLE + (sqrt(1.0::DOUBLE + 3.0::DOUBLE * (d0 - 0.3125::DOUBLE)) - 1.0::DOUBLE) / 1.5::DOUBLE
    ELSE (sqrt(0.0625::DOUBLE + 3.0::DOUBLE * d0) - 0.25::DOUBLE) / 1.5::DOUBLE END) END AS first_position,
  CASE WHEN m1 <= target * 2 THEN least(1.0::DOUBLE, CASE WHEN kind = 0 THEN (sqrt(greatest(0.0::DOUBLE, 2.25::DOUBLE + (-2.0::DOUBLE) * d1)) - 1.5::DOUBLE) / (-1.0::DOUBLE)
    WHEN kind = 1 THEN d1 WHEN d1 >= 0.3125 THEN 0.5::DOUBLE + (sqrt(1.0::DOUBLE + 3.0::DOUBLE * (d1 - 0.3125::DOUBLE)) - 1.0::DOUBLE) / 1.5::DOUBLE
    ELSE (sqrt(0.0625::DOUBLE + 3.0::DOUBLE * d1) - 0.25::DOUBLE) / 1.5::DOUBLE END) END AS second_position
FROM epoch
"""
