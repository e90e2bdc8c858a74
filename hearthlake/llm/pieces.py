"""Token ids of whole texts, the same as the tokenizers library's, each different piece of a text coded once.

The library cuts a text into pieces (words, numbers, signs, white space) and codes each
by itself. Here the pieces of many texts are cut at once by array operations on their
characters, and those not met before are contracted side by side by the tokenizer's merges.
Long pieces are left to the library, and whole texts with a character whose class
may depend on the version of Unicode, or with one of its special tokens.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
import unicodedata

import numpy as np
import pyarrow as pa

SIGN, LETTER, NUMBER, SPACE, WHITE, END, UNSURE = range(7)
#: Stands behind every text; texts that hold it are left to the library.
MARK = "\U0010ffff"
#: Unicode's White_Space but the space; Python and other libraries differ in the four before the last three.
WHITES = [*range(9, 14), 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
DOUBTFUL = [0x1C, 0x1D, 0x1E, 0x1F, 0x85, 0x180E, 0x200B, 0xFEFF]
#: Pieces a worker remembers, and their ids, at most.
PIECES, IDS = 400_000, 4_000_000
#: Longer pieces, in bytes, are coded by the library.
LONG_PIECE = 256
#: A rank that no merge has; slots of the table of merges, as bits; a factor that spreads pairs over them.
NEVER, BITS, SPREAD = np.int32(2**31 - 1), 18, np.uint64(0x9E3779B97F4A7C15)


class Merges:
    """The merges of a byte-level tokenizer; contracts many pieces side by side."""

    def __init__(self, vocabulary: dict[str, int], merges: list):
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [b for b in range(256) if b not in plain]
        letters = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}
        self.bytes = np.array([vocabulary[letters[b]] for b in range(256)], dtype=np.int32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        left, right = (np.array([vocabulary[m[i]] for m in pairs], dtype=np.uint64) for i in (0, 1))
        self.made = np.array([vocabulary[a + b] for a, b in pairs], dtype=np.int32)
        # What a new token may join has a higher rank, so that equal pairs can be contracted together.
        born = dict(zip(self.made.tolist(), range(len(pairs))))
        ahead = all(born.get(a, -1) < r and born.get(b, -1) < r for r, (a, b) in enumerate(zip(left.tolist(), right.tolist())))
        if not ahead or len(born) < len(pairs) or 3 * len(pairs) > 1 << BITS:
            raise ValueError("merges that have to be taken one by one")
        self.keys = np.full(1 << BITS, -1, dtype=np.int64).view(np.uint64)
        self.ranks = np.full(1 << BITS, NEVER, dtype=np.int32)
        keys = left << np.uint64(32) | right
        for rank, (key, slot) in enumerate(zip(keys.tolist(), self._slots(keys).tolist())):
            while self.ranks[slot] != NEVER:
                slot = (slot + 1) & (1 << BITS) - 1
            self.keys[slot], self.ranks[slot] = key, rank

    @staticmethod
    def _slots(keys: np.ndarray) -> np.ndarray:
        return (keys * SPREAD >> np.uint64(64 - BITS)).astype(np.int64)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of ids, NEVER where there is no merge."""
        keys = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        slots = self._slots(keys)
        ranks = self.ranks[slots]
        todo = np.flatnonzero((self.keys[slots] != keys) & (ranks != NEVER))
        ranks[todo] = NEVER
        while len(todo):
            slots = (slots[todo] if len(slots) > len(todo) else slots) + 1 & (1 << BITS) - 1
            keys = keys[todo] if len(keys) > len(todo) else keys
            found = self.ranks[slots]
            ranks[todo] = np.where(self.keys[slots] == keys, found, NEVER)
            more = (self.keys[slots] != keys) & (found != NEVER)
            todo, slots, keys = todo[more], slots[more], keys[more]
        return ranks

    def contracted(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the pieces, one after the other, and how many each has; no piece is empty."""
        sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        ids = self.bytes[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        own = np.repeat(np.arange(len(pieces), dtype=np.int32), sizes)
        ranks = np.full(len(ids), NEVER, dtype=np.int32)
        pair = np.flatnonzero(own[1:] == own[:-1])
        ranks[pair] = self._ranks(ids[pair], ids[pair + 1])
        done = []
        while len(ids):
            starts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            best = np.repeat(np.minimum.reduceat(ranks, starts), np.diff(np.append(starts, len(ids))))
            open_ = best != NEVER
            if not open_.all():
                done.append((own[~open_], ids[~open_]))
                own, ids, ranks, best = own[open_], ids[open_], ranks[open_], best[open_]
            at = np.flatnonzero(ranks == best)
            if not len(at):
                break
            # Of pairs that overlap, which are equal, every second one, from the left.
            run = np.maximum.accumulate(np.where(np.concatenate([[True], np.diff(at) != 1]), np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - run) % 2 == 0]
            ids[at] = self.made[ranks[at]]
            kept = np.ones(len(ids), dtype=bool)
            kept[at + 1] = False
            own, ids, ranks = own[kept], ids[kept], ranks[kept]
            at = at - np.arange(len(at))
            at = np.concatenate([at, at[at > 0] - 1])
            ranks[at] = NEVER
            at = at[at + 1 < len(ids)]
            at = at[own[at] == own[at + 1]]
            ranks[at] = self._ranks(ids[at], ids[at + 1])
        own, ids = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(own, kind="stable")
        return ids[order], np.bincount(own, minlength=len(pieces))


@functools.lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """The class of each character; UNSURE where the oldest and the newest Unicode known here don't agree."""

    def of(category: str) -> int:
        return LETTER if category[0] == "L" else NUMBER if category[0] == "N" else SIGN

    found = np.full(0x110000, UNSURE, dtype=np.uint8)
    old = unicodedata.ucd_3_2_0
    for code in [*range(0xD800), *range(0xE000, 0x20000)]:
        now = unicodedata.category(chr(code))
        if now != "Cn" and of(now) == of(old.category(chr(code))):
            found[code] = of(now)
    found[0x20000:0x2A6D7] = LETTER
    found[32] = SPACE
    found[WHITES] = WHITE
    found[DOUBTFUL] = UNSURE
    found[ord(MARK)] = END
    return found


class Pieces:
    """A tokenizer and the ids of the pieces met so far."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        model, before = told["model"], told["pre_tokenizer"]
        odd = [told["normalizer"], told["truncation"], model["dropout"], model["unk_token"], model["continuing_subword_prefix"], model["end_of_word_suffix"]]
        odd += [model.get("ignore_merges"), model.get("byte_fallback"), before["type"] != "ByteLevel", before.get("add_prefix_space"), not before.get("use_regex", True)]
        if any(odd):
            raise ValueError("not a plain byte-level tokenizer")
        self.merges = Merges(model["vocab"], model["merges"])
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.starts = np.zeros(1, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.int32)

    def encode(self, texts: list[str], end: int) -> list[np.ndarray]:
        """The ids of each text, with ``end`` behind them."""
        table = classes()
        joined = MARK.join([*texts, ""])
        codes = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
        kinds = table[codes]
        ends = np.flatnonzero(kinds == END)
        odd = np.zeros(len(texts), dtype=bool)
        if len(ends) == len(texts):
            odd[np.searchsorted(ends, np.flatnonzero(kinds == UNSURE))] = True
        else:
            odd[:] = True
        odd |= [any(t in text for t in self.special) for text in texts]
        if odd.any():
            whole = [text for text, o in zip(texts, odd) if o]
            coded = iter(self.library.encode_batch_fast(whole, add_special_tokens=False))
            rest = iter(self.encode([text for text, o in zip(texts, odd) if not o], end)) if not odd.all() else iter(())
            return [np.array([*next(coded).ids, end], dtype=np.int32) if o else next(rest) for o in odd]
        return self._coded(joined, codes, kinds, ends, end) if texts else []

    def _coded(self, joined: str, codes: np.ndarray, kinds: np.ndarray, ends: np.ndarray, end: int) -> list[np.ndarray]:
        begins = cuts(codes, kinds)
        data = joined.encode()
        lengths = 1 + (codes >= 0x80).view(np.uint8) + (codes >= 0x800).view(np.uint8) + (codes >= 0x10000).view(np.uint8)
        at = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
        offsets = np.append(at[begins], at[-1]).astype(np.int32)
        column = pa.Array.from_buffers(pa.binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        coded = column.dictionary_encode()
        numbers = self._numbers(coded.dictionary.to_numpy(zero_copy_only=False).tolist(), end)[coded.indices.to_numpy()]
        starts, sizes = self.starts[numbers], self.starts[numbers + 1] - self.starts[numbers]
        behind = np.cumsum(sizes)
        ids = self.ids[np.arange(behind[-1]) + np.repeat(starts - behind + sizes, sizes)]
        # The mark behind a text is a piece, and end its only id.
        return np.split(ids, behind[np.searchsorted(begins, ends)])[:-1]

    def _numbers(self, pieces: list[bytes], end: int) -> np.ndarray:
        """The places of the pieces among those known; new ones are coded by the library."""
        if len(self.known) > PIECES or len(self.ids) > IDS:
            self._forget()
        mark = MARK.encode()
        self.known.pop(mark, None)
        found = np.fromiter(map(self.known.get, pieces, itertools.repeat(-1)), dtype=np.int64, count=len(pieces))
        new = [pieces[i] for i in np.flatnonzero(found < 0).tolist()]
        first = len(self.starts) - 1
        short = [p for p in new if len(p) <= LONG_PIECE and p != mark]
        long = [p for p in new if len(p) > LONG_PIECE]
        if short:
            self._add(short, *self.merges.contracted(short))
        if long:
            coded = [c.ids for c in self.library.encode_batch_fast([p.decode() for p in long], add_special_tokens=False)]
            self._add(long, np.array([i for c in coded for i in c], dtype=np.int32), np.array([len(c) for c in coded]))
        # The mark's id may change from call to call.
        self._add([mark], np.array([end], dtype=np.int32), np.array([1]))
        if len(new) > len(short):
            found[found < 0] = np.fromiter(map(self.known.__getitem__, new), dtype=np.int64, count=len(new))
        else:
            found[found < 0] = np.arange(first, first + len(new))
        return found

    def _add(self, pieces: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        first = len(self.starts) - 1
        self.known.update(zip(pieces, range(first, first + len(pieces))))
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        self.ids = np.concatenate([self.ids, ids])


def cuts(codes: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Where the pieces begin in texts with marks behind them, for the pattern
    ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``.
    """
    white = (kinds == SPACE) | (kinds == WHITE)
    same = np.where(kinds == WHITE, np.uint8(SPACE), kinds)
    begin = np.ones(len(codes), dtype=bool)
    begin[1:] = (same[1:] != same[:-1]) | (same[1:] == END)
    # The last white space ahead of something else stands by itself, or before it if it is a space.
    last = np.flatnonzero(white[:-1] & ~white[1:] & (kinds[1:] != END))
    begin[last] = True
    begin[last[kinds[last] == SPACE] + 1] = False
    # A single apostrophe that begins a piece takes s, t, re, ve, m, ll or d of the letters behind it.
    quote = np.flatnonzero((codes == ord("'")) & begin)
    quote = quote[(kinds[np.minimum(quote + 1, len(codes) - 1)] == LETTER)]
    one = codes[quote + 1]
    two = codes[np.minimum(quote + 2, len(codes) - 1)]
    short = np.isin(one, [ord(c) for c in "stmd"])
    long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    begin[quote[short | long] + 1] = False
    begin[quote[short] + 2] = True
    begin[quote[long] + 3] |= True
    # A space that follows them begins a piece as before.
    return np.flatnonzero(begin)


@functools.lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)
