"""Fill-in-the-middle transformation over a Roaring-style set of character boundaries (operator 12).

A text's boundaries are the byte offsets at which its code points start. They are kept as
a compressed set: containers of 65,536 offsets each, held as an array, a bitmap or runs,
whichever is smallest, beside the cumulative cardinalities. The k-th boundary is found by
a search over these and a select inside one container, so both cuts of a text cost no
more than two searches, and a text is sliced as bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthlake.llm.byte_bpe import chunks
from hearthlake.llm.common import given, whole_text

SEED = 1
#: The markers of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Texts whose third number modulo 100 is this or more stay plain; of the others, those below SUFFIX_FIRST begin with the suffix.
PLAIN_FROM, SUFFIX_FIRST = 90, 20

CONTAINER = 1 << 16
#: An array container takes 2 bytes a value, a bitmap 8,192 at once, a run 4.
ARRAY, BITMAP, RUNS = "array", "bitmap", "runs"
_BITS = np.array([[i for i in range(8) if b >> i & 1] + [0] * (8 - bin(b).count("1")) for b in range(256)], dtype=np.uint8)
_ONES = np.array([bin(b).count("1") for b in range(256)], dtype=np.int64)


class BoundarySet:
    """A sorted set of offsets below ``size`` in array, bitmap and run containers.

    ``member`` is a boolean for each offset. ``select(k)`` is the k-th offset from 0, and
    ``size`` for k equal to the cardinality: the end of the text is a boundary as well.
    """

    def __init__(self, member: np.ndarray):
        self.size = len(member)
        self.containers = [self._container(member[at : at + CONTAINER]) for at in range(0, self.size, CONTAINER)]
        self.before = np.concatenate([[0], np.cumsum([c[1] for c in self.containers], dtype=np.int64)]).astype(np.int64)

    @classmethod
    def of_utf8(cls, text: bytes) -> BoundarySet:
        return cls((np.frombuffer(text, dtype=np.uint8) & 0xC0) != 0x80)

    @staticmethod
    def _container(member: np.ndarray) -> tuple[str, int, tuple]:
        """(kind, cardinality, what select needs)."""
        count = int(np.count_nonzero(member))
        if count == len(member):
            return RUNS, count, (np.zeros(1, np.int64), np.zeros(1, np.int64))
        edges = np.flatnonzero(np.diff(member.view(np.int8), prepend=0, append=0))
        starts, ends = edges[::2], edges[1::2]
        if 4 * len(starts) <= min(2 * count, CONTAINER // 8):
            return RUNS, count, (starts, np.concatenate([[0], np.cumsum(ends - starts)[:-1]]) if count else starts)
        if 2 * count <= CONTAINER // 8:
            return ARRAY, count, (np.flatnonzero(member).astype(np.uint16),)
        packed = np.packbits(member, bitorder="little")
        return BITMAP, count, (packed, np.concatenate([[0], np.cumsum(_ONES[packed])]))

    @property
    def cardinality(self) -> int:
        return int(self.before[-1])

    def select(self, k: int) -> int:
        if not 0 <= k <= self.cardinality:
            raise IndexError(k)
        if k == self.cardinality:
            return self.size
        at = int(np.searchsorted(self.before, k, side="right")) - 1
        kind, _, held = self.containers[at]
        k -= int(self.before[at])
        if kind == ARRAY:
            low = int(held[0][k])
        elif kind == RUNS:
            starts, earlier = held
            run = int(np.searchsorted(earlier, k, side="right")) - 1
            low = int(starts[run]) + k - int(earlier[run])
        else:
            packed, earlier = held
            byte = int(np.searchsorted(earlier, k, side="right")) - 1
            low = byte * 8 + int(_BITS[packed[byte], k - int(earlier[byte])])
        return at * CONTAINER + low


def numbers(doc_id: str = "doc_id", seed: int = SEED) -> list[Column]:
    """Four unsigned 32-bit numbers of a document: the first groups of eight digits of a digest of seed and id (NULL: no digits)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def transformed_text(text: str, first: int, second: int, third: int, fourth: int) -> tuple[int, str, int | None, int | None, str]:
    """(code points, form, code points of prefix and middle, output) of one text."""
    data = text.encode()
    boundaries = BoundarySet.of_utf8(data)
    n = boundaries.cardinality
    if n == 0 or third % 100 >= PLAIN_FROM or PREFIX in text or SUFFIX in text or MIDDLE in text:
        return n, "plain", None, None, text
    low, high = sorted((first % (n + 1), second % (n + 1)))
    a, b = boundaries.select(low), boundaries.select(high)
    prefix, middle, suffix = data[:a].decode(), data[a:b].decode(), data[b:].decode()
    if fourth % 100 < SUFFIX_FIRST:
        return n, "spm", low, high - low, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", low, high - low, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def fill_in_middle(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and output, one row for each row of ``docs`` (doc_id, text).

    NULL text counts as empty; an empty text, one that holds a marker and a tenth of all
    texts stay plain. The cuts depend on the seed and doc_id alone, so rows that repeat
    a doc_id with an equal text give equal rows, and a NULL doc_id counts as no digits.
    An empty table gives an empty result; columns beside doc_id and text are ignored.
    No shuffle; a task holds a few megabytes of text, or one longer document.
    """
    rows = docs.select("doc_id", whole_text().alias("text"), *[h.alias(f"h{i}") for i, h in enumerate(numbers(seed=seed))])
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for part in chunks(batch, 1):
                given_ = [part.column(i).to_pylist() for i in range(1, 6)]
                made = list(zip(*(transformed_text(*row) for row in zip(*given_)))) or [()] * 5
                yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(v, t) for v, t in zip(made, types)]], names=names)

    return rows.mapInArrow(batches, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of, from the output and its form alone."""

    def between(first: str, second: str) -> Column:
        return F.substring_index(F.substr(output, F.lit(len(first) + 1)), second, 1)

    middle = F.substr(output, F.locate(MIDDLE, output) + len(MIDDLE))
    psm_rest = F.substring_index(F.substr(output, F.locate(SUFFIX, output) + len(SUFFIX)), MIDDLE, 1)
    spm_rest = F.substring_index(F.substr(output, F.locate(PREFIX, output) + len(PREFIX)), MIDDLE, 1)
    return (
        F.when(form == "psm", F.concat(between(PREFIX, SUFFIX), middle, psm_rest))
        .when(form == "spm", F.concat(spm_rest, middle, between(SUFFIX, PREFIX)))
        .otherwise(output)
    )


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(given(spark, sf_dir, "documents"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


ORACLE = """
WITH digest AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
number AS (
  SELECT doc_id, t, length(t) AS n, ('0x' || h[1:8])::UBIGINT AS h1, ('0x' || h[9:16])::UBIGINT AS h2,
    ('0x' || h[17:24])::UBIGINT % 100 AS h3, ('0x' || h[25:32])::UBIGINT % 100 AS h4
  FROM digest
),
cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1))::BIGINT AS a, greatest(h1 % (n + 1), h2 % (n + 1))::BIGINT AS b,
    CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 >= 90 THEN 'plain' WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM number
),
part AS (SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS s FROM cut)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM part
"""
