"""Token ids in files of independently coded, checksummed blocks (operator 1).

A file is Parquet, so that Spark commits it whole on any store: one row per segment,
with the segment's place (part, seq), its doc_ids, their numbers of ids and the blocks
of ``range_coder``, in which the documents' ids follow one another. The blocks are coded
and decoded in the executors' JVM (``jvm_coder``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthlake.llm import jvm_coder
from hearthlake.llm.byte_bpe import chunks
from hearthlake.llm.common import given, ranked
from hearthlake.llm.pieces import pieces
from hearthlake.session import shared_folder

END = 2
#: Ids in a block, and in a segment, whose blocks are coded side by side. Short segments have shorter blocks.
BLOCK, LEAST_BLOCK, SEGMENT, LANES = 1024, 128, 1 << 21, 512
#: Text that is tokenized at a time, in bytes.
TEXT_BYTES = 2_000_000


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def block_size(ids: int) -> int:
    return min(BLOCK, max(LEAST_BLOCK, ids // LANES))


def write(docs: DataFrame, folder: str, path: str | None = None, end: int = END) -> None:
    """Tokenize whole texts of ``docs`` (doc_id, text) and write their ids in ascending doc_id order.

    Every document gets ``end`` appended; NULL text counts as empty, so it is ``end``
    alone. Rows are range-partitioned by doc_id (NULL first) and sorted; rows that repeat
    a doc_id follow one another. A task holds one segment of ids, or the longest
    document's; a lost task is run again by itself, and Spark commits what succeeded.
    An empty table gives an empty folder of files.
    """
    rows = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def segments(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        docs_, ids, total, type_ = [], [], 0, pa.int64()
        names = ["part", "seq", "doc_ids", "lengths", "ids", "block"]

        def segment() -> pa.RecordBatch:
            lengths = [len(i) for i in ids]
            columns = [
                pa.array([part], pa.int32()),
                pa.array([seq], pa.int32()),
                pa.array([docs_], pa.list_(type_)),
                pa.array([lengths], pa.list_(pa.int64())),
                pa.array([np.concatenate(ids).astype("<u4").tobytes()], pa.binary()),
                pa.array([block_size(total)], pa.int32()),
            ]
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in found:
            type_ = batch.schema.field(0).type
            for some in chunks(batch, 1, TEXT_BYTES):
                texts = [t or "" for t in some.column(1).to_pylist()]
                for doc, code in zip(some.column(0).to_pylist(), pieces(path or default_path()).encode(texts, end)):
                    docs_.append(doc)
                    ids.append(code)
                    total += len(code)
                    if total >= SEGMENT:
                        yield segment()
                        docs_, ids, total, seq = [], [], 0, seq + 1
        if ids:
            yield segment()

    coded = rows.mapInArrow(segments, f"part int, seq int, doc_ids array<{kind}>, lengths array<long>, ids binary, block int")
    blocks = jvm_coder.encoded(docs.sparkSession, F.col("ids"), F.col("block")).alias("blocks")
    coded.select("part", "seq", "doc_ids", "lengths", blocks).write.parquet(folder)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every stored document, from the decoded blocks.

    start is the number of ids of all documents before it in the files' order; ids_crc32
    is the unsigned CRC-32 of the ids as little-endian 32-bit integers. A block whose
    checksum doesn't hold ends the job with an error.
    """
    stored = spark.read.parquet(folder)
    places = jvm_coder.documents(spark, F.col("blocks"), F.col("lengths"))
    docs = stored.select("part", "seq", F.inline(F.arrays_zip(F.col("doc_ids").alias("doc_id"), F.col("lengths").alias("n_tokens"), places.alias("place"))))
    docs = docs.withColumns({"offset": F.shiftright("place", 32), "ids_crc32": F.col("place").bitwiseAND(F.lit(0xFFFFFFFF))})
    sizes = stored.select("part", "seq", F.aggregate("lengths", F.lit(0).cast("long"), lambda a, b: a + b).alias("_n"))
    before = ranked(sizes, [], "part", [F.col("seq")], "_rank", {"_n": "_before"}).select("part", "seq", "_before")
    return docs.join(before, ["part", "seq"]).select("doc_id", (F.col("_before") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark)
    write(given(spark, sf_dir, "documents"), folder)
    return read(spark, folder)
