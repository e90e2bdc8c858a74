"""Substrings that occur more than once, by blockwise suffix sorting with a difference cover (operator 11).

Texts are sequences of UTF-8 bytes. A difference cover modulo 91 has ten residues, such
that for any two positions of any two texts both reach the cover after the same step of
less than 91 bytes. So of two equal strings of 200 bytes at least one pair of cover
suffixes lies at the same step in both, and these share their first 110 bytes.

1. The cover suffixes, 11 % of all, are ranked by their first 110 bytes: their
   fingerprints are dealt to buckets, and each bucket is sorted by itself. A suffix that
   shares its rank gets a link to the least suffix of that rank.
2. Long ties are resolved by these ranks: cover suffixes in a row that are linked to the
   same place of the same text show, without any byte, that the whole stretch is equal.
   Its 200-byte suffixes are settled: they repeat, and an earlier text stands for them.
3. The suffixes that are left near a shared rank, and only these, are dealt to suffix
   buckets by a fingerprint of their 200 bytes and sorted there, one bucket at a time.
   Those with an equal neighbour repeat.

A settled suffix has the same string as a smaller one, so the smallest suffix of each
string always goes through step 3; the stretch it stands for is reported to it as well.
"""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthlake.llm.common import given, whole_text

LENGTH = 200
#: The modulus and a perfect difference cover of it: every difference but 0 occurs exactly once.
PERIOD = 91
COVER = (0, 1, 3, 9, 27, 49, 56, 61, 77, 81)
#: Text that a task works on at a time, in bytes, or one longer text.
BLOCK_BYTES = 4_000_000
#: Suffixes of a bucket, on average, and how many of them a task unpacks and sorts at a time, by their fingerprint.
BUCKET_ROWS, SLICE_ROWS = 4_000_000, 800_000
#: Bytes of a text's digest that tell texts apart; bytes of a fingerprint beside its bucket, of a cover suffix and of a
#: whole suffix. A stretch gets wrong only if the one suffix that would lengthen it shares a bucket and 40 bits with another
#: string: less than once in a million corpora of any size, since buckets grow in number with the corpus.
DIGEST_BYTES, RANK_BYTES, SUFFIX_BYTES = 12, 5, 9
#: Bytes of a text's key: its digest and zeros, two numbers of 64 bits.
KEY_BYTES = 16

#: Rows that a task hands back at a time.
ROWS_OUT = 2_000

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xBF58476D1CE4E5B9)
RANKS, SUFFIXES, PASSING = 0, 1, 2


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _B
    return h ^ (h >> np.uint64(29))


def fingerprints(data: bytes, at: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """64 bits for each string of so many bytes (8 at least) that starts at the given places."""
    lanes = np.ndarray((max(0, len(data) - 7),), dtype="<u8", buffer=data, strides=(1,))
    h = np.full(len(at), (length + (seed << 32)) * int(_A) % (1 << 64), dtype=np.uint64)
    for step in [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]:
        h = _mix((h ^ lanes[at + step]) * _A + _C)
    return h


class Cover:
    """Places of the cover in a text, by their index."""

    def __init__(self, length: int, period: int, cover: tuple[int, ...]):
        self.length, self.period, self.residues = length, period, np.array(cover, dtype=np.int64)
        #: Bytes that a rank stands for.
        self.depth = length - period + 1
        if self.depth < max(8, period):
            raise ValueError("ranks must be at least as long as the period")

    def place(self, index: np.ndarray) -> np.ndarray:
        return index // len(self.residues) * self.period + self.residues[index % len(self.residues)]

    def count(self, size: int) -> int:
        """Cover places of a text of so many bytes that have a whole rank."""
        whole = size - self.depth + 1
        if whole <= 0:
            return 0
        return whole // self.period * len(self.residues) + int(np.searchsorted(self.residues, whole % self.period))


def _planes(values: np.ndarray, width: int) -> bytes:
    """The lower bytes of the numbers, all lowest bytes first: planes of high bytes compress well."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _of_planes(data: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), dtype=np.uint8)
    out[:, :width] = np.frombuffer(data, dtype=np.uint8).reshape(width, -1).T
    return out.view("<u8").ravel()


def _lists(values: np.ndarray, counts: np.ndarray) -> bytes:
    """Rising numbers in lists of so many, as planes of their steps."""
    steps = np.diff(values, prepend=0)
    if len(counts):
        begins = np.concatenate([[0], np.cumsum(counts)[:-1]])
        steps[begins] = values[begins]
    return _planes(steps.astype(np.uint64), 5)


def _of_lists(data: bytes, counts: np.ndarray) -> np.ndarray:
    steps = _of_planes(data, 5).astype(np.int64)
    total = np.cumsum(steps)
    begins = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
    return total - np.repeat(total[begins] - steps[begins], counts) if len(steps) else total


def _key_of(text: str) -> str:
    return f"unhex(rpad(substring(sha2({text}, 256), 1, {2 * DIGEST_BYTES}), {2 * KEY_BYTES}, '0'))"


def _blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[list[tuple]]:
    """Rows whose last column is bytes, some megabytes at a time."""
    rows, total = [], 0
    for batch in batches:
        columns = [batch.column(i) for i in range(batch.num_columns)]
        for i in range(batch.num_rows):
            row = tuple(c[i].as_py() for c in columns)
            rows.append(row)
            total += len(row[-1])
            if total >= most:
                yield rows
                rows, total = [], 0
    if rows:
        yield rows


#: What goes to a bucket and what comes back to a text. A bucket row holds, for each of some texts: its key, how many
#: numbers it has, the rising numbers (places, or indexes of cover places), and a fingerprint and a mark for each of them.
_BUCKET = "bucket int, kind int, keys binary, counts binary, numbers binary, prints binary, marks binary"
_BUCKET_NAMES = ["bucket", "kind", "keys", "counts", "numbers", "prints", "marks"]
_BUCKET_TYPES = [pa.int32(), pa.int32(), *[pa.binary()] * 5]
#: links: to which place of which text a cover place is linked; intervals: stretches of the text that repeat.
_TEXT = "key binary, blob binary, links binary, intervals binary"
_TEXT_NAMES = ["key", "blob", "links", "intervals"]
_TEXT_TYPES = [pa.binary()] * 4


def _batch(rows: list[tuple], names: list[str], types: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * len(types), types)], names=names)


def _bucket_rows(
    kind: int, keys: np.ndarray, doc: np.ndarray, number: np.ndarray, prints: np.ndarray, proof: np.ndarray | None, marks: np.ndarray, bits: int
) -> list[tuple]:
    """Rows by bucket, the leading bits of the fingerprints; ``doc`` and ``number`` rise."""
    width, rest = (RANK_BYTES, prints << np.uint64(bits)) if proof is None else (8, prints << np.uint64(bits) | proof >> np.uint64(64 - bits))
    bucket = (prints >> np.uint64(64 - bits)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    out = []
    edges = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    for a, b in zip(edges, np.append(edges[1:], len(order))):
        mine = order[a:b]
        docs, counts = np.unique(doc[mine], return_counts=True)
        out.append(
            (
                int(bucket[mine[0]]),
                kind,
                keys[docs, :DIGEST_BYTES].tobytes(),
                _planes(counts.astype(np.uint64), 5),
                _lists(number[mine], counts),
                _planes(rest[mine] >> np.uint64(64 - 8 * width), width) + (b"" if proof is None else _planes(proof[mine], SUFFIX_BYTES - 8)),
                np.packbits(marks[mine]).tobytes(),
            )
        )
    return out


def _own_bucket(key: bytes, bits: int) -> int:
    """The bucket in which rows that only pass through to a text meet."""
    return int.from_bytes(key[:4], "big") >> (32 - bits)


def _links_row(index: np.ndarray, partner: np.ndarray, place: np.ndarray) -> bytes:
    """Links of one text: 5 bytes index, 16 bytes key and 5 bytes place of the partner each."""
    out = np.zeros((len(index), 26), dtype=np.uint8)
    out[:, :5] = index.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
    out[:, 5:21] = partner
    out[:, 21:] = place.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
    return out.tobytes()


def _of_links(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    out = np.frombuffer(b"".join(rows), dtype=np.uint8).reshape(-1, 26)

    def number(columns: np.ndarray) -> np.ndarray:
        wide = np.zeros((len(columns), 8), dtype=np.uint8)
        wide[:, :5] = columns
        return wide.view("<i8").ravel()

    return number(out[:, :5]), np.ascontiguousarray(out[:, 5:21]).view(f"V{KEY_BYTES}").ravel(), number(out[:, 21:])


def _distinct_links(rows: list[bytes]) -> bytes:
    if len(rows) == 1:
        return rows[0]
    return np.unique(np.frombuffer(b"".join(rows), dtype="V26").view("u1").reshape(-1, 26), axis=0).tobytes()


def _merged(intervals: np.ndarray) -> np.ndarray:
    """Intervals (start, end) as sorted ones that neither overlap nor touch."""
    if not len(intervals):
        return intervals.reshape(-1, 2)
    intervals = intervals[np.argsort(intervals[:, 0], kind="stable")]
    ends = np.maximum.accumulate(intervals[:, 1])
    new = np.concatenate([[True], intervals[1:, 0] > ends[:-1]])
    return np.stack([intervals[new, 0], ends[np.append(np.flatnonzero(new)[1:] - 1, len(ends) - 1)]], axis=1)


def _of_intervals(rows: list[bytes]) -> np.ndarray:
    return _merged(np.frombuffer(b"".join(rows), dtype="<i8").reshape(-1, 2))


def _groups(prints: np.ndarray, proof: np.ndarray | None, *ties: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, group, first): rows sorted by fingerprint, then by the ties, the first of which counts most, then as given;
    each sorted row's group of an equal fingerprint; the first row of each group."""
    order = np.argsort(prints, kind="stable")
    tied = np.diff(prints[order]) == 0
    touched = np.flatnonzero(np.append(tied, False) | np.concatenate([[False], tied])) if len(order) else order
    if len(touched) and (ties or proof is not None):
        mine = order[touched]
        keys = [*reversed(ties), *([] if proof is None else [proof]), prints]
        order[touched] = mine[np.lexsort([k[mine] for k in keys])]
    new = np.diff(prints[order], prepend=~prints[order[:1]]) != 0
    if proof is not None:
        new |= np.diff(proof[order], prepend=proof[order[:1]]) != 0
    return order, np.cumsum(new) - 1, np.flatnonzero(new)


def _least(prints: np.ndarray, proof: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(least, many, partner) of a block's suffixes in rising order: which are the first of their fingerprint, whether others
    share it, and which is the first."""
    order, group, first = _groups(prints, proof)
    least, many = np.zeros(len(prints), dtype=bool), np.zeros(len(prints), dtype=bool)
    partner = np.empty(len(prints), dtype=np.int64)
    least[order[first]] = True
    many[order[first]] = np.diff(np.append(first, len(order))) > 1
    partner[order] = order[first][group]
    return least, many, partner


def _ranked(cover: Cover, bits: int, most: int):
    """Texts -> their cover suffixes by bucket. Of equal suffixes of one block the least goes to the bucket, the others get their link."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _blocks(batches, most):
            texts = dict(rows)
            known = sorted(k for k, t in texts.items() if len(t) >= cover.depth)
            if not known:
                continue
            data = b"".join(texts[k] for k in known)
            keys = np.frombuffer(b"".join(known), dtype=np.uint8).reshape(-1, KEY_BYTES)
            sizes = np.array([len(texts[k]) for k in known])
            counts = np.array([cover.count(s) for s in sizes])
            doc = np.repeat(np.arange(len(known)), counts)
            index = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
            prints = fingerprints(data, (np.cumsum(sizes) - sizes)[doc] + cover.place(index), cover.depth)
            least, many, partner = _least(prints)
            mine = np.flatnonzero(least)
            out = _bucket_rows(RANKS, keys, doc[mine], index[mine], prints[mine], None, many[mine], bits)
            others = np.flatnonzero(~least)
            edges = np.flatnonzero(np.diff(doc[others], prepend=-1))
            for a, b in zip(edges, np.append(edges[1:], len(others))):
                some = others[a:b]
                p, key = partner[some], known[doc[some[0]]]
                out.append((_own_bucket(key, bits), PASSING, key, None, None, _links_row(index[some], keys[doc[p]], cover.place(index[p])), None))
            yield _batch(out, _BUCKET_NAMES, _BUCKET_TYPES)

    return made


def _sorted_buckets(answer):
    """Rows sorted by bucket -> what ``answer`` makes of each bucket; rows that only pass through go to their text at once."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, []
        texts: dict[bytes, tuple[list[bytes], list[bytes]]] = {}

        def close() -> Iterator[pa.RecordBatch]:
            """Answers of the bucket that is held and what passed meanwhile, a row for each text."""
            for key, *found in _answers(answer, held) if held else ():
                _gathered(texts, key, found)
            held.clear()
            yield from _rows_of(texts)

        for batch in batches:
            passing: dict[bytes, tuple[list, list]] = {}
            for at, kind, *packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), *(batch.column(i) for i in range(2, 7))):
                if kind == PASSING:
                    _gathered(passing, packed[0].as_py(), [p.as_py() for p in packed[3:]])
                    continue
                if at != bucket:
                    yield from close()
                    bucket = at
                # The batch's own memory, not a copy.
                held.append((at, kind, *(p.as_buffer() for p in packed)))
            for key, (links, intervals) in passing.items():
                # What many blocks report of one text is combined here.
                _gathered(texts, key, [_distinct_links(links) if links else None, _of_intervals(intervals).tobytes() if intervals else None])
        yield from close()

    return made


def _gathered(texts: dict[bytes, tuple[list[bytes], list[bytes]]], key: bytes, found: list[bytes | None]) -> None:
    """Put links and intervals to those of their text."""
    for rows, one in zip(texts.setdefault(key, ([], [])), found):
        if one is not None:
            rows.append(one)


def _rows_of(texts: dict[bytes, tuple[list[bytes], list[bytes]]]) -> Iterator[pa.RecordBatch]:
    rows = [(key, None, b"".join(links) if links else None, b"".join(intervals) if intervals else None) for key, (links, intervals) in texts.items()]
    texts.clear()
    for a in range(0, len(rows), ROWS_OUT):
        yield _batch(rows[a : a + ROWS_OUT], _TEXT_NAMES, _TEXT_TYPES)


def _answers(answer, held: list[tuple]) -> Iterator[tuple]:
    """A bucket's answers, a slice of its fingerprints at a time: its rows stay packed."""
    width = RANK_BYTES if held[0][1] == RANKS else SUFFIX_BYTES
    slices = max(1, sum(len(row[5]) for row in held) // width // SLICE_ROWS)
    for at in range(slices):
        yield from _slice_answers(answer, held, at, slices)


def _slice_answers(answer, held: list[tuple], at: int, slices: int) -> Iterator[tuple]:
    keys, sizes, numbers, prints, proof, marks = [], [], [], [], [], []
    for _, kind, key, counts, number, found, mark in held:
        counts = _of_planes(counts, 5).astype(np.int64)
        whole = int(counts.sum())
        # The highest byte tells the slices apart.
        width = RANK_BYTES if kind == RANKS else 8
        wanted = np.frombuffer(found, dtype=np.uint8, count=whole, offset=whole * (width - 1)).astype(np.int32) * slices >> 8 == at
        ends = np.cumsum(counts)
        whole_keys = np.zeros((len(counts), KEY_BYTES), dtype=np.uint8)
        whole_keys[:, :DIGEST_BYTES] = np.frombuffer(key, dtype=np.uint8).reshape(-1, DIGEST_BYTES)
        keys.append(whole_keys.view(f"V{KEY_BYTES}").ravel())
        sizes.append(np.diff(np.concatenate([[0], np.cumsum(wanted)])[ends], prepend=0))
        numbers.append(_of_lists(number, counts)[wanted])
        prints.append(_of_planes(found[: width * whole], width)[wanted])
        if kind == SUFFIXES:
            proof.append(_of_planes(found[width * whole :], SUFFIX_BYTES - width)[wanted].astype(np.uint32))
        marks.append(np.unpackbits(np.frombuffer(mark, dtype=np.uint8))[:whole][wanted].astype(bool))
    if not sum(map(len, numbers)):
        return
    # Texts by their rank: the key's bytes as two big-endian numbers sort as the bytes do.
    entries = np.concatenate(keys).view(">u8").reshape(-1, 2)
    texts, rank = np.unique(entries[:, 0].astype(np.uint64), return_inverse=True)
    if len(texts) == len(entries) or (entries[:, 1] == entries[np.unique(rank, return_index=True)[1], 1][rank]).all():
        first_of = np.unique(rank, return_index=True)[1]
    else:  # two texts share eight bytes
        rank = np.unique(entries.astype(np.uint64), axis=0, return_inverse=True)[1].ravel()
        first_of = np.unique(rank, return_index=True)[1]
    names = np.concatenate(keys)[first_of]
    text = np.repeat(rank.astype(np.int32), np.concatenate(sizes))
    number, prints, marks = np.concatenate(numbers), np.concatenate(prints), np.concatenate(marks)
    del keys, sizes, numbers, entries
    order, group, first = _groups(prints, np.concatenate(proof) if proof else None, text, number)
    del prints, proof
    text, number, marks = text[order], number[order], marks[order]
    last = np.append(first[1:], len(order)) - 1
    # The first and the last of a group differ unless all its rows are one suffix.
    shared = (number[first] != number[last]) | (text[first] != text[last])
    shared |= np.logical_or.reduceat(marks, first)
    # A suffix that several blocks sent counts once.
    again = np.concatenate([[False], (np.diff(group) == 0) & (np.diff(number) == 0) & (np.diff(text) == 0)])
    mine = np.flatnonzero(shared[group] & ~again)
    partner = first[group[mine]]
    by_text = np.lexsort((number[mine], text[mine]))
    mine, partner = mine[by_text], partner[by_text]
    edges = np.flatnonzero(np.diff(text[mine], prepend=-1))
    for a, b in zip(edges, np.append(edges[1:], len(mine))):
        p = partner[a:b]
        yield names[text[mine[a]]].tobytes(), *answer(number[mine[a:b]], names[text[p]].view(np.uint8).reshape(-1, KEY_BYTES), number[p])


def _stretches(cover: Cover, key: bytes, links: list[bytes]) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]:
    """(places of shared ranks, partners' keys, (start, end) of settled stretches, starts of these in the partner).

    Linked cover places in a row, linked to places of one text at one distance, no
    further apart than a rank is long, are one stretch of equal bytes.
    """
    index, partner, place = _of_links(links)
    mine = cover.place(index)
    shared = np.unique(mine)
    linked = ~((partner == np.frombuffer(key, dtype=partner.dtype)[0]) & (place == mine))
    mine, partner, place = mine[linked], partner[linked], place[linked]
    if not len(mine):
        return shared, [], np.zeros((0, 2), np.int64), np.zeros(0, np.int64)
    halves = partner.view(">u8").reshape(-1, 2)
    order = np.lexsort((mine, mine - place, halves[:, 1], halves[:, 0]))
    mine, partner, place = mine[order], partner[order], place[order]
    new = np.concatenate([[True], (partner[1:] != partner[:-1]) | (np.diff(mine - place) != 0) | (np.diff(mine) > cover.depth)])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(mine)) - 1
    start, end = mine[first], mine[last] + cover.depth
    long = np.flatnonzero(end - start >= cover.length)
    return shared, [partner[first[i]].tobytes() for i in long], np.stack([start[long], end[long]], axis=1), place[first[long]]


def _left(cover: Cover, size: int, shared: np.ndarray, settled: np.ndarray) -> np.ndarray:
    """Places of the suffixes near a shared rank that no stretch settles."""
    whole = size - cover.length + 1
    if whole <= 0:
        return np.zeros(0, np.int64)
    near = np.zeros(whole + 1, dtype=np.int32)
    np.add.at(near, np.clip(shared - cover.period + 1, 0, whole), 1)
    np.add.at(near, np.clip(shared + 1, 0, whole), -1)
    wanted = np.cumsum(near[:-1]) > 0
    for a, b in settled:
        wanted[a : b - cover.length + 1] = False
    return np.flatnonzero(wanted)


def _unsettled(cover: Cover, bits: int, most: int):
    """Texts with links -> the suffixes that are left, by bucket, and the stretches that are settled, for both texts."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress

        def flush(texts: list[tuple[bytes, bytes, np.ndarray]], reported: dict[bytes, list[np.ndarray]]) -> pa.RecordBatch:
            texts.sort(key=lambda t: t[0])
            data = b"".join(t for _, t, _ in texts)
            sizes = np.array([len(t) for _, t, _ in texts])
            keys = np.frombuffer(b"".join(k for k, _, _ in texts), dtype=np.uint8).reshape(-1, KEY_BYTES)
            counts = np.array([len(p) for _, _, p in texts])
            doc = np.repeat(np.arange(len(texts)), counts)
            place = np.concatenate([p for _, _, p in texts]).astype(np.int64)
            prints = fingerprints(data, (np.cumsum(sizes) - sizes)[doc] + place, cover.length)
            proof = fingerprints(data, (np.cumsum(sizes) - sizes)[doc] + place, cover.length, seed=1)
            # As for the ranks: equal suffixes of one block are settled here, the least stands for them.
            least, many, _ = _least(prints, proof)
            mine = np.flatnonzero(least)
            out = _bucket_rows(SUFFIXES, keys, doc[mine], place[mine], prints[mine], proof[mine], many[mine], bits)
            others = np.flatnonzero(~least)
            for d in np.unique(doc[others]):
                p = place[others[doc[others] == d]]
                reported[texts[d][0]].append(np.stack([p, p + cover.length], axis=1))
            for key, found in reported.items():
                out.append((_own_bucket(key, bits), PASSING, key, None, None, None, _merged(np.concatenate(found)).astype("<i8").tobytes()))
            return _batch(out, _BUCKET_NAMES, _BUCKET_TYPES)

        texts, reported, total = [], defaultdict(list), 0
        for batch in batches:
            for key, blob, links in zip(*(batch.column(i).to_pylist() for i in range(3))):
                text = unpack(blob)
                shared, partners, settled, other = _stretches(cover, key, links)
                for partner, (a, b), at in zip(partners, settled, other):
                    reported[partner].append(np.array([[at, at + b - a]]))
                if len(settled):
                    reported[key].append(settled)
                texts.append((key, text, _left(cover, len(text), shared, settled)))
                total += len(text)
                if total >= most:
                    yield flush(texts, reported)
                    texts, reported, total = [], defaultdict(list), 0
        if texts:
            yield flush(texts, reported)

    return made


def _remaining(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, blob, intervals) -> what is removed, in how many runs, and the digest and bytes of what remains."""
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        out = []
        for key, blob, rows in zip(*(batch.column(i).to_pylist() for i in range(3))):
            text = unpack(blob)
            intervals = _of_intervals(rows)
            cuts = [0, *intervals.ravel().tolist(), len(text)]
            rest = b"".join(text[a:b] for a, b in zip(cuts[::2], cuts[1::2]))
            out.append((key, len(text) - len(rest), len(intervals), hashlib.sha256(rest).hexdigest(), [tuple(i) for i in intervals.tolist()]))
        types = [pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
        columns = list(zip(*out)) or [[]] * 5
        columns[4] = [[{"start": a, "end": b} for a, b in row] for row in columns[4]]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["key", "n_removed", "n_spans", "kept_sha256", "spans"])


def _packed_texts(cover: Cover, most: int):
    """Texts long enough to hold a repeat, once for each block of a task, compressed."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for rows in _blocks(batches, most):
            texts = {key: text for key, text in rows if len(text) >= cover.length}
            yield _batch([(key, pack(text), None, None) for key, text in texts.items()], _TEXT_NAMES, _TEXT_TYPES)

    return made


def _bits(rows: int) -> int:
    """Bits of a bucket's number: 32 buckets at least, and as many more as keep them to ``BUCKET_ROWS``."""
    return min(30, max(5, math.ceil(math.log2(max(1, rows) / BUCKET_ROWS))))


def repeated_spans(docs: DataFrame, length: int = LENGTH, period: int = PERIOD, residues: tuple[int, ...] = COVER, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(key, n_removed, n_spans, kept_sha256, spans) of each different text in which a string of ``length`` bytes repeats.

    ``docs`` has text. key is the first 12 bytes of the text's SHA-256, and zeros; spans are the
    maximal runs of bytes covered by a repeating string. Rows with an equal text are one
    text here, see ``without_repeats``.
    """
    cover = Cover(length, period, residues)
    text = whole_text()
    long = docs.select(text.alias("text")).where(F.octet_length("text") >= length)
    rows = long.select(F.expr(_key_of("text")).alias("key"), F.encode("text", "UTF-8").alias("bytes"))
    size = long.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = _bits(size * len(residues) // period)

    def by_bucket(frame: DataFrame, answer) -> DataFrame:
        # One bucket after the other: a task holds one.
        dealt = frame.repartition(F.col("bucket")).sortWithinPartitions("bucket", "kind", "keys")
        return dealt.mapInArrow(_sorted_buckets(answer), _TEXT)

    links = by_bucket(rows.mapInArrow(_ranked(cover, bits, block_bytes), _BUCKET), lambda number, key, other: (_links_row(number, key, cover.place(other)), None))
    texts = rows.mapInArrow(_packed_texts(cover, block_bytes), _TEXT)
    # A text and its links meet once; both later steps read this one exchange.
    met = (
        texts.unionByName(links)
        .where("key IS NOT NULL")
        .groupBy("key")
        .agg(F.max("blob").alias("blob"), F.collect_list("links").alias("links"))
        .where(F.size("links") > 0)
    )
    found = by_bucket(
        met.mapInArrow(_unsettled(cover, bits, block_bytes), _BUCKET),
        lambda number, key, other: (None, _merged(np.stack([number, number + length], axis=1)).astype("<i8").tobytes()),
    )
    intervals = found.groupBy("key").agg(F.collect_list("intervals").alias("intervals")).where(F.size("intervals") > 0)
    kept = met.select("key", "blob").join(intervals, "key")
    spans = "array<struct<start:bigint,end:bigint>>"
    return kept.mapInArrow(_remaining, f"key binary, n_removed long, n_spans long, kept_sha256 string, spans {spans}")


def without_repeats(docs: DataFrame, length: int = LENGTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and spans, one row for each row of ``docs`` (doc_id, text).

    A byte is removed if a string of ``length`` bytes that covers it also starts at
    another place, of the same or another row; strings are judged on the input. NULL
    text counts as empty. Rows with an equal text are other places for each other,
    whatever their doc_ids: such a text of at least ``length`` bytes is removed wholly.
    Texts below that length are kept. An empty table gives an empty result; columns
    beside doc_id and text are ignored. Spans may begin and end inside a character.
    """
    text = whole_text()
    rows = docs.select(
        "doc_id", F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("sha256"), F.expr(_key_of("coalesce(text, '')")).alias("key")
    )
    long = rows.where(F.col("n_bytes") >= length)
    copies = long.groupBy("key").agg(F.count(F.lit(1)).alias("copies"))
    found = copies.join(repeated_spans(docs, length, block_bytes=block_bytes), "key", "left").where((F.col("copies") > 1) | F.col("n_spans").isNotNull())
    judged = rows.join(found, "key", "left")
    all_gone, some = F.col("copies") > 1, F.col("n_spans").isNotNull()
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))

    def chosen(gone, part, none):
        return F.when(all_gone, gone).when(some, part).otherwise(none)

    return judged.select(
        "doc_id",
        "n_bytes",
        chosen(F.col("n_bytes"), F.col("n_removed"), F.lit(0)).cast("long").alias("n_removed"),
        chosen(F.lit(1), F.col("n_spans"), F.lit(0)).cast("long").alias("n_spans"),
        chosen(F.sha2(F.lit(""), 256), F.col("kept_sha256"), F.col("sha256")).alias("kept_sha256"),
        chosen(whole, F.col("spans"), F.array().cast("array<struct<start:bigint,end:bigint>>")).alias("spans"),
    )


def op11_cover_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(given(spark, sf_dir, "documents")).drop("spans")
