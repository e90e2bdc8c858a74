"""Phrase collocation mining by SON partitioning (operator 13).

A phrase found often enough in the whole corpus is found often enough in one shard at
least, its support lowered to the shard's share of the words. Shards are dealt by a hash
of the document, and each is mined completely: every occurrence of every phrase of one to
five words is counted, in hash slots that a shuffle deals to the executors. The slots
frequent in some shard, joined over all shards, are the candidates; a second pass counts
their occurrences in the whole corpus by the words themselves, so the counts are exact
whatever slots they share.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hearthlake.llm.common import ascii_lower, given, stored, whole_text

MOST_WORDS, SUPPORT, TOP, COVER = 5, 100, 2000, 100
UNKNOWN = "und"
#: Shards of the corpus; at most so many as leave a lowered support well above 1.
SHARDS = 8
#: The candidates of all shards are one bit a slot: 16 MB, at any size of the corpus. More bits tell more slots apart.
SLOT_BITS = 27
HASH_BITS = 32
#: Words in one part of the slots, on average; and text that a task works on at a time, in bytes.
WORDS_PER_PART = 2_000_000
BLOCK_BYTES = 4_000_000
#: Entries a part holds before it adds them up, and rows that a task hands on at a time.
COMPACT_ENTRIES, ROWS_OUT = 4_000_000, 500
#: Words longer than this are hashed one by one.
LONG_WORD = 256

_SEPARATOR = re.compile(rb"[.,;:!?\n-\r]")
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[list(b".,;:!?") + [0x0A, 0x0B, 0x0C, 0x0D]] = 2
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xBF58476D1CE4E5B9)
_MASKS = np.array([(1 << 8 * i) - 1 for i in range(8)], dtype=np.uint64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _B
    return h ^ (h >> np.uint64(29))


class Block:
    """Texts cut into words: each word's hash and place, and how many words of its piece follow it."""

    def __init__(self, texts: list[bytes]):
        # Eight bytes at the end, so that words can be read eight at a time.
        self.data = b"\n".join(texts) + b"\n" * 9
        data = np.frombuffer(self.data, dtype=np.uint8)
        kind = _KIND[data]
        word = kind == 0
        edges = np.flatnonzero(np.diff(word.view(np.int8), prepend=0))
        self.starts, self.ends = edges[::2], edges[1::2]
        lengths = np.array([len(t) + 1 for t in texts], dtype=np.int64)
        self.text = np.searchsorted(np.cumsum(lengths), self.starts, side="right")
        self.hashes = self._hashes(data)
        piece = np.cumsum(kind == 2, dtype=np.int32)[self.starts] if len(self.starts) else np.zeros(0, np.int32)
        last = np.flatnonzero(np.diff(piece, append=-1)) if len(piece) else np.zeros(0, np.int64)
        self.following = (last[np.searchsorted(last, np.arange(len(piece)))] - np.arange(len(piece))) if len(piece) else piece

    def _hashes(self, data: np.ndarray) -> np.ndarray:
        lanes = np.ndarray((len(data) - 7,), dtype="<u8", buffer=self.data, strides=(1,))
        size = self.ends - self.starts
        found = _mix(size.astype(np.uint64) * _A + _C)
        short = np.flatnonzero(size <= LONG_WORD)
        at = 0
        while len(short):
            rest = np.minimum(size[short] - at, 8)
            lane = lanes[self.starts[short] + at]
            part = rest < 8
            lane = np.where(part, lane & _MASKS[np.where(part, rest, 0)], lane)
            found[short] = _mix((found[short] ^ lane) * _A)
            at += 8
            short = short[size[short] > at]
        for i in np.flatnonzero(size > LONG_WORD):
            found[i] = xxhash.xxh3_64_intdigest(self.data[self.starts[i] : self.ends[i]])
        return found

    def phrases(self, seeds: np.ndarray, most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(words, places of the first words, hashes) of all phrases of 1 to ``most`` words; ``seeds`` is of each text."""
        h = seeds[self.text]
        at = np.arange(len(h))
        for k in range(1, most + 1):
            inside = self.following[at] >= k - 1
            at, h = at[inside], h[inside]
            h = _mix((h ^ self.hashes[at + k - 1]) * _A + _C)
            yield k, at, h

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """Each word's number, and a place of each number; equal numbers are equal words, byte for byte."""
        _, first, number = np.unique(self.hashes, return_index=True, return_inverse=True)
        size = self.ends - self.starts
        same = first[number]
        lanes = np.ndarray((len(self.data) - 7,), dtype="<u8", buffer=self.data, strides=(1,))
        left = np.flatnonzero(same != np.arange(len(same)))
        differ = (size != size[same])[left].any()
        at = 0
        while len(left) and not differ:
            rest = np.minimum(size[left] - at, 8)
            part = rest < 8
            both = lanes[self.starts[left] + at] ^ lanes[self.starts[same[left]] + at]
            differ = bool(np.where(part, both & _MASKS[np.where(part, rest, 0)], both).any())
            at += 8
            left = left[size[left] > at]
        if differ:  # two words share a hash
            known: dict[bytes, int] = {}
            number = np.array([known.setdefault(self.data[a:b], len(known)) for a, b in zip(self.starts, self.ends)], dtype=np.int64)
            first = np.unique(number, return_index=True)[1]
        return number, first


def _cut(text: bytes, most: int) -> Iterator[bytes]:
    """The text in blocks that end with a separator, so that no piece is cut; a piece without one stays whole."""
    at = 0
    while len(text) - at > most:
        found = _SEPARATOR.search(text, at + most)
        if not found:
            break
        yield text[at : found.end()]
        at = found.end()
    yield text[at:]


def _blocks(batches: Iterator[pa.RecordBatch], most: int = BLOCK_BYTES) -> Iterator[tuple[Block, list[tuple]]]:
    """Blocks of about so many bytes, and the columns before the text for each text of the block."""
    texts: list[bytes] = []
    rows: list[tuple] = []
    total = 0
    for batch in batches:
        given_ = list(zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns - 1))))
        column = batch.column(batch.num_columns - 1).cast(pa.binary())
        for row, text in zip(given_, column):
            for part in _cut(text.as_py(), most):
                texts.append(part)
                rows.append(row)
                total += len(part)
                if total >= most:
                    yield Block(texts), rows
                    texts, rows, total = [], [], 0
    if texts:
        yield Block(texts), rows


def _seeds(langs: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(lang.encode()) for lang in langs], dtype=np.uint64)


def _numbered(rows: list[tuple]) -> tuple[list[tuple], np.ndarray]:
    """The different rows, and each row's number among them."""
    known: dict[tuple, int] = {}
    numbers = np.array([known.setdefault(row, len(known)) for row in rows], dtype=np.int64)
    return list(known), numbers


def shard_sizes(rows: DataFrame) -> DataFrame:
    """(lang, shard, words) of all texts."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, of_text in _blocks(batches):
            groups, number = _numbered(of_text)
            words = np.bincount(number[block.text], minlength=len(groups))
            langs, shards = zip(*groups)
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(shards, pa.int32()), pa.array(words, pa.int64())], names=["lang", "shard", "words"])

    return rows.mapInArrow(counted, "lang string, shard int, words long").groupBy("lang", "shard").agg(F.sum("words").alias("words"))


def _packed(values: np.ndarray) -> bytes:
    """The byte planes of the numbers, as many as the largest needs, and how many these are."""
    width = max(1, (int(values.max()).bit_length() + 7) // 8)
    return bytes([width]) + values.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width].T.tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    width = data[0]
    out = np.zeros(((len(data) - 1) // width, 4), dtype=np.uint8)
    out[:, :width] = np.frombuffer(data, dtype=np.uint8, offset=1).reshape(width, -1).T
    return out.view("<u4").ravel()


def _slot_counts(rows: DataFrame, part_bits: int, most_words: int) -> DataFrame:
    """(part, lang, shard, least, slots, counts): how often each block has the slots of each part, all phrases of it."""
    low_bits = HASH_BITS - part_bits

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, of_text in _blocks(batches):
            groups, number = _numbered(of_text)
            seeds = _seeds([lang for lang, _ in of_text])
            # One number for part, group and slot, so that one sort does all.
            group_bits = max(1, math.ceil(math.log2(len(groups) + 1)))
            keys = []
            for _, at, h in block.phrases(seeds, most_words):
                slot = h >> np.uint64(64 - HASH_BITS)
                part, low = slot >> np.uint64(low_bits), slot & np.uint64((1 << low_bits) - 1)
                keys.append((((part << np.uint64(group_bits)) | number[block.text[at]].astype(np.uint64)) << np.uint64(low_bits)) | low)
            values, counts = np.unique(np.concatenate(keys), return_counts=True)
            head, slots = values >> np.uint64(low_bits), (values & np.uint64((1 << low_bits) - 1)).astype(np.uint32)
            begins = np.flatnonzero(np.diff(head, prepend=~np.uint64(0)) != 0)
            ends = np.append(begins[1:], len(head))
            del keys, values
            types = [pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
            for at in range(0, len(begins), ROWS_OUT):
                out = []
                for a, b in zip(begins[at : at + ROWS_OUT], ends[at : at + ROWS_OUT]):
                    lang, shard = groups[int(head[a]) & ((1 << group_bits) - 1)]
                    # Rising slots as the steps between them.
                    steps = np.diff(slots[a:b], prepend=np.uint32(0))
                    out.append((int(head[a]) >> group_bits, lang, shard, None, _packed(steps), _packed(counts[a:b])))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=_SLOT_NAMES)

    return rows.mapInArrow(counted, _SLOTS)


_SLOT_NAMES = ["part", "lang", "shard", "least", "slots", "counts"]
_SLOTS = "part int, lang string, shard int, least long, slots binary, counts binary"


def _added(slots: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    values, place = np.unique(np.concatenate(slots), return_inverse=True)
    return values, np.bincount(place, weights=np.concatenate(counts), minlength=len(values))


def _frequent_slots(part_bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows sorted by part, lang, shard, the least support first -> a part's bits of slots frequent in some shard of some lang."""
    dropped = HASH_BITS - SLOT_BITS
    size = 1 << max(0, SLOT_BITS - part_bits)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, group, least = None, None, 0
        bits = np.zeros(size, dtype=bool)
        slots: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        held = 0

        def close() -> None:
            if slots:
                values, sums = _added(slots, counts)
                bits[values[sums >= least] >> np.uint32(dropped)] = True
                slots.clear(), counts.clear()

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())], names=["part", "bits"])

        for batch in batches:
            for p, lang, shard, low, packed, planes in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if (p, lang, shard) != group:
                    close()
                    held = 0
                    if p != part:
                        if part is not None:
                            yield row()
                        part, bits[:] = p, False
                    group = (p, lang, shard)
                if packed is None:
                    least = low
                    continue
                slots.append(np.cumsum(_unpacked(packed), dtype=np.uint32))
                counts.append(_unpacked(planes))
                held += len(slots[-1])
                if held > COMPACT_ENTRIES:
                    values, sums = _added(slots, counts)
                    slots, counts, held = [values], [sums], 0
        close()
        if part is not None:
            yield row()

    return found


def candidate_slots(rows: DataFrame, sizes: DataFrame, support: int = SUPPORT, most_words: int = MOST_WORDS) -> bytes:
    """One bit for each slot: whether a phrase of it may be frequent. ``SLOT_BITS`` fix its size.

    Each shard is mined with the support times its share of the lang's words, rounded up.
    """
    total = sizes.agg(F.sum("words")).first()[0] or 0
    part_bits = min(12, max(2, math.ceil(math.log2(max(1, total) / WORDS_PER_PART))))
    of_lang = sizes.groupBy("lang").agg(F.sum("words").alias("_all"))
    # ceil(support * words / all) in whole numbers; as rows of every part, ahead of the part's counts.
    least = (
        sizes.join(of_lang, "lang")
        .where("words > 0")
        .select(
            F.explode(F.sequence(F.lit(0), F.lit((1 << part_bits) - 1))).alias("part"),
            "lang",
            "shard",
            F.expr(f"(cast({support} as decimal(20,0)) * words + _all - 1) div _all").alias("least"),
            F.lit(None).cast("binary").alias("slots"),
            F.lit(None).cast("binary").alias("counts"),
        )
    )
    counted = least.unionByName(_slot_counts(rows, part_bits, most_words))
    dealt = counted.repartition(1 << part_bits, "part").sortWithinPartitions("part", "lang", "shard", F.col("least").asc_nulls_last())
    parts = dealt.mapInArrow(_frequent_slots(part_bits), "part int, bits binary").collect()
    each = (1 << SLOT_BITS) // 8 >> part_bits
    bits = bytearray((1 << SLOT_BITS) // 8)
    for part, found in parts:
        bits[part * each : part * each + len(found)] = found
    return bytes(bits)


def exact_counts(rows: DataFrame, bits: bytes, most_words: int = MOST_WORDS) -> DataFrame:
    """(lang, phrase, f): occurrences in the whole corpus of every phrase whose slot is a candidate, by its words."""
    shared = rows.sparkSession.sparkContext.broadcast(bits)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.frombuffer(shared.value, dtype=np.uint8)
        for block, of_text in _blocks(batches):
            groups, number = _numbered([row[:1] for row in of_text])
            seeds = _seeds([lang for lang, _ in of_text])
            word, place = block.words()
            spelled: dict[int, str] = {}

            def spell(w: int) -> str:
                if w not in spelled:
                    at = place[w]
                    spelled[w] = block.data[block.starts[at] : block.ends[at]].decode()
                return spelled[w]

            for k, at, h in block.phrases(seeds, most_words):
                slot = (h >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
                hit = wanted[slot >> 3] >> (slot & 7).astype(np.uint8) & 1 > 0
                at, h = at[hit], h[hit]
                if not len(at):
                    continue
                _, first, same, times = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
                columns = [word[at + i] for i in range(k)] + [number[block.text[at]]]
                if all((c == c[first][same]).all() for c in columns):
                    found = zip(zip(*(c[first].tolist() for c in columns)), times.tolist())
                else:  # two phrases share a hash
                    rows_, times = np.unique(np.stack(columns), axis=1, return_counts=True)
                    found = zip(map(tuple, rows_.T.tolist()), times.tolist())
                made = [(groups[phrase[-1]][0], " ".join(map(spell, phrase[:-1])), n) for phrase, n in found]
                langs, phrases, times = zip(*made)
                yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(phrases, pa.string()), pa.array(times, pa.int64())], names=["lang", "phrase", "f"])

    return rows.mapInArrow(counted, "lang string, phrase string, f long").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def _joined(words: Column, start: Column | int, size: Column) -> Column:
    return F.array_join(F.slice(words, start, size), " ")


def collocations(
    docs: DataFrame, support: int = SUPPORT, most_words: int = MOST_WORDS, top: int = TOP, shards: int = SHARDS
) -> DataFrame:
    """Each lang's best phrases: lang, rank, phrase, a, l, r, n and score, from ``docs`` (doc_id, text, lang).

    NULL text counts as empty, NULL lang as ``und``. Repeated rows count each time; a
    NULL doc_id is like any other. Ties of score and count go to the smaller phrase in
    UTF-8 byte order, ties of cuts to the shorter first part. An empty table gives an
    empty result; other columns are ignored. Texts are worked on in blocks that end with
    a separator; a run of words without one is worked on whole.

    What grows with the corpus is shuffled: slot counts, one entry for each different
    slot of a block, and candidates' counts. The driver and each task see the slots'
    bits, whose size is fixed. Where the corpus has more frequent phrases than slots, the
    second pass counts more phrases than it needs, and the counts stay exact.
    """
    text = ascii_lower(whole_text())
    rows = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).cast("int").alias("shard"), text.alias("text"))
    sizes = stored(shard_sizes(rows))
    bits = candidate_slots(rows, sizes, support, most_words)
    frequent = stored(exact_counts(rows, bits, most_words).where(F.col("f") >= support))
    words = F.split("phrase", " ")
    candidates = frequent.withColumn("words", words).where(F.size("words") > 1)
    n = sizes.groupBy("lang").agg(F.sum("words").alias("n"))

    cuts = candidates.select("lang", "phrase", "f", "words", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cuts = cuts.withColumns({"left": _joined(F.col("words"), 1, F.col("k")), "right": _joined(F.col("words"), F.col("k") + 1, F.size("words"))})
    left = frequent.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = frequent.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    # Whole numbers of up to 38 digits, so nothing is rounded before the floor.
    score = F.expr("(cast(1000 as decimal(38,0)) * f * n) div (cast(l as decimal(38,0)) * r)")
    scored = (
        cuts.join(left, ["lang", "left"])
        .join(right, ["lang", "right"])
        .join(n, "lang")
        .groupBy("lang", "phrase", F.col("f").alias("a"), "n")
        .agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    )

    size = F.size("words")
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), size - 1),
            lambda k: F.transform(F.sequence(F.lit(1), size - k + 1), lambda at: _joined(F.col("words"), at, k)),
        )
    )
    longer = candidates.where(size > 2).select("lang", F.explode(inner).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("_longer"))
    kept = scored.join(longer, ["lang", "phrase"], "left").where(F.col("_longer").isNull() | (100 * F.col("_longer") < COVER * F.col("a")))
    best = Window.partitionBy("lang").orderBy(F.col("cut.score").desc(), F.col("a").desc(), "phrase")
    return (
        kept.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= top)
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    )


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(given(spark, sf_dir, "documents"))


ORACLE = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p
  FROM documents
),
word AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM piece),
total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM word GROUP BY lang),
size AS (SELECT unnest([1, 2, 3, 4, 5]) AS k),
place AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM word, size WHERE len(w) >= k),
f AS (SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, k, count(*) AS a FROM place GROUP BY ALL HAVING count(*) >= 100),
cut AS (SELECT *, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS c FROM f WHERE k > 1),
scored AS (
  SELECT cut.lang, cut.phrase, cut.k, cut.a, n, l.a AS l, r.a AS r, c, ((1000::HUGEINT * cut.a * n) // (l.a::HUGEINT * r.a))::BIGINT AS score
  FROM cut JOIN f l ON l.lang = cut.lang AND l.phrase = array_to_string(w[1:c], ' ') JOIN f r ON r.lang = cut.lang AND r.phrase = array_to_string(w[c + 1:], ' ')
  JOIN total ON total.lang = cut.lang
),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
kept AS (
  SELECT * FROM best b
  WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.lang = b.lang AND f.k > b.k AND 100 * f.a >= 100 * b.a AND contains(' ' || f.phrase || ' ', ' ' || b.phrase || ' '))
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score
FROM kept QUALIFY rank <= 2000
"""
