"""SimHash near-deduplication with pigeonhole blocks (operator 9)."""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthlake.llm.common import apart, checkpointed, given, whole_text
from hearthlake.llm.components import components
from hearthlake.llm.exact_dedup import sha256_digest

SHINGLE = 3
MOST_BITS = 3
SEED = 42
#: Pieces a fingerprint is split into. Close pairs differ in MOST_BITS pieces at most, so they agree in the others.
PIECES = 6
#: A block with more fingerprints is joined through near fingerprints instead of pairwise.
BLOCK_PAIRS = 256

_WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint: a bit is 1 where over half of the shingles' hashes have it; 0 without words."""
    found = _WORDS.findall((text or "").encode("utf-8", "surrogatepass").lower())
    if not found:
        return 0
    parts = found if shingle == 1 or len(found) < shingle else map(b" ".join, zip(*(found[i:] for i in range(shingle))))
    if 1 < shingle and len(found) < shingle:
        parts = [b" ".join(found)]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(p, SEED) for p in parts), dtype=np.uint64)
    counts = np.zeros(64, dtype=np.int64)
    # 255 ones fit a byte, so bytes are added up 255 at a time.
    for start in range(0, len(hashes), 255 * 64):
        block = np.unpackbits(hashes[start : start + 255 * 64].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        for at in range(0, len(block), 255):
            counts += np.add.reduce(block[at : at + 255], axis=0, dtype=np.uint8)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, digest: bool = False) -> DataFrame:
    """doc_id and fp (the fingerprint's 64 bits as a long), one row for each row of ``docs`` (doc_id, text); with ``digest`` also _sha of the text."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            fps = np.fromiter((simhash(t.as_py(), shingle) for t in batch.column(1)), dtype=np.uint64, count=batch.num_rows)
            names = ["doc_id", "fp", *batch.schema.names[2:]]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64)), *batch.columns[2:]], names=names)

    rows = docs.select("doc_id", "text", *[sha256_digest(whole_text()).alias("_sha")] * digest)
    return rows.mapInArrow(batches, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp long" + ", _sha string" * digest)


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def block_masks(pieces: int = PIECES, most_bits: int = MOST_BITS) -> list[int]:
    """A mask for every choice of pieces that a close pair may agree in."""
    cuts = [round(64 * i / pieces) for i in range(pieces + 1)]
    parts = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    return [sum(chosen) for chosen in itertools.combinations(parts, pieces - most_bits)]


def flip_masks(most: int) -> list[int]:
    """All masks of up to so many bits."""
    return [sum(1 << b for b in bits) for n in range(most + 1) for bits in itertools.combinations(range(64), n)]


def close_pairs(fps: DataFrame, most_bits: int = MOST_BITS, pieces: int = PIECES, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """Links (a, b) between the different fingerprints ``fp`` that differ in ``most_bits`` bits or fewer.

    Every fingerprint is dealt to one block for each choice of pieces; a close pair
    shares a block, and pairs inside a block are verified by their distance. A block of
    up to ``block_pairs`` fingerprints is joined with itself: at most that many pairs
    for each fingerprint. Fingerprints of larger blocks, among which true links may be
    nearly all pairs, are linked through near ones: two at a distance of up to
    r + s bits have a value within r bits of the one and s of the other, so for every
    value all fingerprints within s of it are linked to the smallest within r. Each of
    these links is a true one, and they connect whatever is linked: the components are
    those of all links, at a number of rows that grows with the fingerprints only.
    """
    masks = [_signed(m) for m in block_masks(pieces, most_bits)]
    blocks = fps.select(
        "fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("block", "key")
    )
    # Short rows: the number of the block, its key and the fingerprint.
    sizes = blocks.groupBy("block", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = checkpointed(blocks.join(sizes, ["block", "key"]))
    few = shared.where(F.col("n") <= block_pairs)
    a = few.select("block", "key", F.col("fp").alias("a"))
    b = few.select("block", "key", F.col("fp").alias("b"))
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= most_bits
    pairs = a.join(b, ["block", "key"]).where((F.col("a") < F.col("b")) & close).select("a", "b")
    many = shared.where(F.col("n") > block_pairs).select("fp").distinct()
    if many.isEmpty():
        return pairs.distinct()
    many = checkpointed(many)
    small, large = most_bits // 2, most_bits - most_bits // 2

    def around(bits: int) -> DataFrame:
        flips = F.array(*[F.lit(_signed(m)) for m in flip_masks(bits)])
        return many.select("fp", F.explode(flips).alias("_flip")).select("fp", F.col("fp").bitwiseXOR(F.col("_flip")).alias("_near"))

    stars = around(small).groupBy("_near").agg(F.min("fp").alias("a"))
    through = around(large).join(stars, "_near").where("fp <> a").select(F.least("a", "fp").alias("a"), F.greatest("a", "fp").alias("b"))
    return pairs.unionByName(through).distinct()


def with_roots(fps: DataFrame, most_bits: int = MOST_BITS, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """Different fingerprints ``fp`` with the smallest of their component, ``root``."""
    linked = components(close_pairs(fps.select("fp"), most_bits, PIECES, block_pairs))
    # Only linked fingerprints have a root; all others are their own component.
    return fps.join(linked.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, most_bits: int = MOST_BITS, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id, one row for each row of ``docs`` (doc_id, text).

    component_id is the smallest doc_id reachable over links of ``most_bits`` differing
    bits or fewer, the row's own included. NULL text counts as empty; texts without
    words have fingerprint 0 and are linked like any others. NULL doc_ids aren't the
    smallest unless a component has no other. Rows that repeat stand in one component.
    An empty table gives an empty result. Documents with one fingerprint are one row
    before anything is paired.
    """
    rows = checkpointed(fingerprints(docs, shingle))
    rooted = with_roots(rows.groupBy("fp").agg(F.min("doc_id").alias("_first")), most_bits, block_pairs)
    least = rooted.groupBy("root").agg(F.min("_first").alias("component_id"))
    ids = rooted.select("fp", "root").join(least, "root").select("fp", "component_id")
    return rows.join(ids, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def without_near_copies(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each component, all columns: that with the smallest doc_id, NULL last, and of these the smallest digest of the text.

    Rows that share a doc_id, or have none, are different documents where their texts differ.
    Other columns may have any names.
    """
    names, docs = docs.columns, apart(docs, "doc_id", "text")
    rows = checkpointed(fingerprints(docs, digest=True))
    each = rows.groupBy("fp", "doc_id", "_sha").agg(F.count(F.lit(1)).alias("_rows"))
    rooted = with_roots(rows.select("fp").distinct()).select("fp", "root")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("_null"), F.col("doc_id").alias("_id"), "_sha", "_rows"))
    chosen = each.join(rooted, "fp").groupBy("root").agg(first.alias("_first")).select("_first._id", "_first._sha", "_first._rows")
    match = F.col("doc_id").eqNullSafe(F.col("_id")) & (sha256_digest(whole_text()) == F.col("_sha"))
    found = docs.join(chosen, match)
    once = found.where("_rows = 1").select(*docs.columns)
    return once.unionByName(found.where("_rows > 1").dropDuplicates(["_id", "_sha"]).select(*docs.columns)).toDF(*names)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(given(spark, sf_dir, "documents"))
