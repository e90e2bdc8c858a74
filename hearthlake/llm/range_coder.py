"""An adaptive context-mixing range coder for token ids, run on many blocks at once.

Every block is coded from a fresh model, so blocks are independent and a step codes one
id of every block with array operations. An id is predicted by what last followed the
two ids before it (order 2), the one before it (order 1) and by the block's most frequent
id (order 0). "Is it this prediction?" is a binary decision, its probability a logistic
mix of what the three orders know of the predicted id; an id that no order predicts is
coded nibble by nibble from adaptive order-0 distributions. All arithmetic is on integers.

A block is: the bytes ``CMB1``, the bits of an id (1 byte), the number of ids and the
CRC-32 of the ids as little-endian 32-bit integers (4 bytes each), then the code bytes.
"""

from __future__ import annotations

import decimal
import functools
import struct
import zlib

import numpy as np

MAGIC = b"CMB1"
HEADER = struct.Struct("<4sBII")
SLOTS = 1 << 11
ORDERS = 3
STATES = 16
#: Rates: probabilities move by 1/2^RATE of their error, weights by error * input >> LEARN.
RATE, LEARN = 4, 11
#: Frequencies add up to 2^TOTAL; the coder's range never falls below 2^16.
TOTAL = 15
TOP, BOTTOM, FULL, BYTE = np.uint64(1 << 24), np.uint64(1 << 16), np.uint64((1 << 32) - 1), np.uint64(8)
#: The least frequency of a nibble that a distribution moves towards; above 2^RATE, so none reaches 0.
LEAST = 32
#: Contexts of the order-0 nibbles: the first two by what stands before them, the others by its last 8 bits.
CONTEXTS = 1 + 16 + 256 + 256


@functools.lru_cache(maxsize=1)
def _logistic() -> tuple[np.ndarray, np.ndarray]:
    """squash: -2047..2047 (in 1/256) to probabilities of 12 bits; stretch: its inverse. Exact decimal arithmetic, the same everywhere."""
    context = decimal.Context(prec=30)
    squash = np.array(
        [int(4096 / (1 + context.exp(decimal.Decimal(-x) / 256))) for x in range(-2047, 2048)], dtype=np.int32
    ).clip(1, 4095)
    stretch = np.searchsorted(squash, np.arange(4096), side="left").clip(0, 4094).astype(np.int32) - 2047
    return squash, stretch


def _aims() -> np.ndarray:
    """For each nibble the cumulative frequencies that its distribution moves towards."""
    i = np.arange(16)
    return np.where(i[None, :] <= i[:, None], i * LEAST, (1 << TOTAL) - (16 - i) * LEAST).astype(np.int16)


AIMS = _aims()


class _Lanes:
    """The models and coders of many blocks, one array element for each."""

    def __init__(self, lanes: int, bits: int, codes: list[np.ndarray] | None, room: int):
        self.nibbles = -(-bits // 4)
        self.lanes = lanes
        self.low = np.zeros(lanes, dtype=np.uint64)
        self.range = np.full(lanes, FULL, dtype=np.uint64)
        self.previous = np.zeros((2, lanes), dtype=np.int64)
        self.predicted = [np.full(lanes * SLOTS, -1, dtype=np.int64 if bits > 31 else np.int32) for _ in range(2)]
        self.surety = [np.zeros(lanes * SLOTS, dtype=np.uint8) for _ in range(2)]
        self.counts = np.zeros(lanes * SLOTS, dtype=np.uint16)
        self.frequent = np.full(lanes, -1, dtype=np.int64)
        self.most = np.zeros(lanes, dtype=np.int64)
        self.hits = np.full(ORDERS * ORDERS * STATES * lanes, 1 << 15, dtype=np.int32)
        self.weights = np.full((ORDERS, ORDERS, lanes), 1 << 15, dtype=np.int32)
        self.spread = np.tile((np.arange(16) << (TOTAL - 4)).astype(np.int16), (lanes * CONTEXTS, 1))
        self.decoding = codes is not None
        self.at = np.zeros(lanes, dtype=np.int64)
        if codes is None:
            self.room = room
            self.out = np.zeros(lanes * room, dtype=np.uint8)
        else:
            self.room = max(len(c) for c in codes) + 8
            self.out = np.zeros(lanes * self.room, dtype=np.uint8)
            for lane, code in enumerate(codes):
                self.out[lane * self.room : lane * self.room + len(code)] = code
            self.code = np.zeros(lanes, dtype=np.uint64)
            for _ in range(4):
                self.code = (self.code << BYTE) | self._next(np.arange(lanes))

    def _next(self, who: np.ndarray) -> np.ndarray:
        found = self.out[who * self.room + np.minimum(self.at[who], self.room - 1)]
        self.at[who] += 1
        return found.astype(np.uint64)

    def _narrow(self, who: np.ndarray, low: np.ndarray, unit: np.ndarray, begin: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The part [begin, begin + width) of each range, with whole bytes moved out or in."""
        low = (low + unit * begin.astype(np.uint64)) & FULL
        size = unit * width.astype(np.uint64)
        while True:
            settled = (low ^ ((low + size) & FULL)) < TOP
            short = (settled | (size < BOTTOM)).nonzero()[0]
            if not len(short):
                return low, size
            # A range that is too short across a byte's border ends at the border.
            cut = short[~settled[short]]
            size[cut] = (-low[cut].astype(np.int64)).astype(np.uint64) & (BOTTOM - np.uint64(1))
            lanes = who[short]
            if self.decoding:
                self.code[lanes] = ((self.code[lanes] << BYTE) & FULL) | self._next(lanes)
            else:
                self.out[lanes * self.room + self.at[lanes]] = (low[short] >> np.uint64(24)).astype(np.uint8)
                self.at[lanes] += 1
            low[short] = (low[short] << BYTE) & FULL
            size[short] = (size[short] << BYTE) & FULL

    def _aimed(self, who: np.ndarray, low: np.ndarray, unit: np.ndarray) -> np.ndarray:
        """Where in the frequencies the code to decode points."""
        return np.minimum(((self.code[who] - low) & FULL) // unit, np.uint64((1 << TOTAL) - 1)).astype(np.int32)

    def hit(self, order: int, who: np.ndarray, guess: np.ndarray, known: list[np.ndarray], y: np.ndarray | None) -> np.ndarray:
        """Code whether the id is the guess of this order; ``known`` is each order's state for the guess."""
        squash, stretch = _logistic()
        places = [((order * ORDERS + j) * STATES + known[j].astype(np.int64)) * self.lanes + who for j in range(ORDERS)]
        hits = [self.hits.take(p) for p in places]
        inputs = [stretch.take(h >> 4) for h in hits]
        weights = [self.weights[order, j][who] for j in range(ORDERS)]
        total = (weights[0] * inputs[0] + weights[1] * inputs[1] + weights[2] * inputs[2]) >> 16
        chance = squash.take(np.minimum(np.maximum(total, -2047), 2047) + 2047)
        one = chance << (TOTAL - 12)
        low, unit = self.low[who], self.range[who] >> np.uint64(TOTAL)
        if y is None:
            y = self._aimed(who, low, unit) < one
        self.low[who], self.range[who] = self._narrow(who, low, unit, np.where(y, 0, one), np.where(y, one, (1 << TOTAL) - one))
        error = np.where(y, 4095, 0) - chance
        aim = np.where(y, 65535, 0)
        for j in range(ORDERS):
            self.weights[order, j][who] = np.minimum(np.maximum(weights[j] + ((inputs[j] * error) >> LEARN), -(1 << 18)), 1 << 18)
            self.hits[places[j]] = hits[j] + ((aim - hits[j]) >> RATE)
        return y

    def spelled(self, who: np.ndarray, ids: np.ndarray | None) -> np.ndarray:
        """Code an id by its nibbles, each from a distribution that follows what the block had in its place."""
        found = np.zeros(len(who), dtype=np.int64)
        low, size = self.low[who], self.range[who]
        flat = self.spread.reshape(-1)
        for place in range(self.nibbles):
            context = 0 if place == 0 else 1 + found if place == 1 else (17 if place == 2 else 273) + (found & 255)
            context = who * CONTEXTS + context
            first = context * 16
            unit = size >> np.uint64(TOTAL)
            if ids is None:
                aimed = self._aimed(who, low, unit)
                nibble = np.zeros(len(who), dtype=np.int64)
                for half in (8, 4, 2, 1):
                    nibble += half * (flat.take(first + nibble + half) <= aimed)
            else:
                nibble = (ids >> (4 * (self.nibbles - 1 - place))) & 15
            begin = flat.take(first + nibble).astype(np.int32)
            end = np.where(nibble == 15, 1 << TOTAL, flat.take(first + np.minimum(nibble + 1, 15)).astype(np.int32))
            low, size = self._narrow(who, low, unit, begin, end - begin)
            spread = self.spread.take(context, axis=0)
            self.spread[context] = spread + ((AIMS.take(nibble, axis=0) - spread) >> RATE)
            found = found * 16 + nibble
        self.low[who], self.range[who] = low, size
        return found

    def step(self, live: int, ids: np.ndarray | None) -> np.ndarray:
        """Code the next id of the first ``live`` lanes."""
        all_ = np.arange(live)
        one, two = self.previous[0, :live], self.previous[1, :live]
        slots = [
            all_ * SLOTS + ((one * 2654435761 + two * 40503 * 65599) >> 7) % SLOTS,
            all_ * SLOTS + (one * 2654435761 >> 7) % SLOTS,
        ]
        guesses = [self.predicted[0][slots[0]].astype(np.int64), self.predicted[1][slots[1]].astype(np.int64), self.frequent[:live].copy()]
        sure = [self.surety[0][slots[0]], self.surety[1][slots[1]]]
        result = np.full(live, -1, dtype=np.int64)
        open_ = np.ones(live, dtype=bool)
        for order, guess in enumerate(guesses):
            fits = open_ & (guess >= 0)
            for earlier in guesses[:order]:
                fits &= guess != earlier
            who = np.flatnonzero(fits)
            if not len(who):
                continue
            mine = guess[who]
            known = [np.where(guesses[j][who] == mine, sure[j][who] + 1, 0) for j in range(2)]
            known.append(np.minimum(self.counts[who * SLOTS + mine % SLOTS], STATES - 1))
            y = self.hit(order, who, mine, known, None if ids is None else ids[who] == mine)
            right = who[y]
            result[right] = mine[y]
            open_[right] = False
        who = np.flatnonzero(open_)
        if len(who):
            result[who] = self.spelled(who, None if ids is None else ids[who])
        for j in range(2):
            right = guesses[j] == result
            self.surety[j][slots[j]] = np.where(right, np.minimum(sure[j] + 1, STATES - 2), np.where(sure[j] > 2, sure[j] >> 1, 0))
            self.predicted[j][slots[j]] = np.where(right | (sure[j] <= 2), result, guesses[j])
        place = all_ * SLOTS + result % SLOTS
        count = np.minimum(self.counts[place].astype(np.int64) + 1, 65535)
        self.counts[place] = count
        more = count >= self.most[:live]
        self.most[:live] = np.where(more, count, self.most[:live])
        self.frequent[:live] = np.where(more, result, self.frequent[:live])
        self.previous[1, :live] = one
        self.previous[0, :live] = result
        return result


def _blocks(ids: np.ndarray, block: int) -> tuple[np.ndarray, int]:
    """The ids as a matrix with a column for each block, and the ids of the last."""
    lanes = -(-len(ids) // block)
    padded = np.zeros(lanes * block, dtype=np.int64)
    padded[: len(ids)] = ids
    return np.ascontiguousarray(padded.reshape(lanes, block).T), len(ids) - (lanes - 1) * block


def encode(ids: np.ndarray, block: int) -> list[bytes]:
    """The blocks of the ids (0 to 2^32 - 1), ``block`` ids in each but the last; none without ids."""
    if not len(ids):
        return []
    ids = np.asarray(ids, dtype=np.int64)
    bits = max(1, int(ids.max()).bit_length())
    columns, last = _blocks(ids, block)
    lanes = columns.shape[1]
    coder = _Lanes(lanes, bits, None, block * 12 + 16)
    for t in range(min(block, len(ids))):
        live = lanes if t < last else lanes - 1
        coder.step(live, columns[t, :live])
    found = []
    for lane in range(lanes):
        own = ids[lane * block : (lane + 1) * block]
        start = lane * coder.room
        code = coder.out[start : start + coder.at[lane]].tobytes() + struct.pack(">I", int(coder.low[lane]))
        found.append(HEADER.pack(MAGIC, bits, len(own), zlib.crc32(own.astype("<u4").tobytes())) + code)
    return found


def decode(blocks: list[bytes]) -> np.ndarray:
    """The ids of blocks that were coded together; raises ValueError where a checksum doesn't hold."""
    if not blocks:
        return np.zeros(0, dtype=np.int64)
    heads = [HEADER.unpack_from(b) for b in blocks]
    if any(h[0] != MAGIC or h[1] != heads[0][1] for h in heads):
        raise ValueError("not blocks of one run of ids")
    sizes = [h[2] for h in heads]
    if any(a < b for a, b in zip(sizes, sizes[1:])):
        raise ValueError("blocks out of order")
    coder = _Lanes(len(blocks), heads[0][1], [np.frombuffer(b, dtype=np.uint8, offset=HEADER.size) for b in blocks], 0)
    found = np.zeros((sizes[0], len(blocks)), dtype=np.int64)
    left = np.array(sizes)
    for t in range(sizes[0]):
        live = int(np.searchsorted(-left, -t))
        found[t, :live] = coder.step(live, None)
    parts = [found[:n, lane] for lane, n in enumerate(sizes)]
    for part, head in zip(parts, heads):
        if zlib.crc32(part.astype("<u4").tobytes()) != head[3]:
            raise ValueError("a block's checksum does not hold")
    return np.concatenate(parts)
