"""Operators 11 to 13, long pieces of operator 6 and clashing columns, against brute force on small tables."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import pre_tokenizers

from hearthlake.llm import byte_bpe, collocations, cover_suffixes, exact_dedup, fill_middle, mixing, quality_rules, simhash
from tests.oracle import connect, differences

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, n long, score long, key string, words string"


def table(spark, rows):
    """Rows (doc_id, text, lang) with columns that clash with the operators' own names."""
    return spark.createDataFrame([(i, t, lang, 1, 2, "k", "w") for i, t, lang in rows], SCHEMA).repartition(4)


@pytest.mark.parametrize("name", ["op12_fill_in_middle", "op13_collocations"])
def test_agrees_with_oracle(spark, name):
    assert differences(spark, connect(SF_DIR), name, SF_DIR) == []


def test_empty_tables(spark):
    nothing = table(spark, [])
    assert cover_suffixes.without_repeats(nothing).count() == 0
    assert fill_middle.fill_in_middle(nothing).count() == 0
    assert collocations.collocations(nothing).count() == 0


# Repeated substrings


def test_cover_is_a_perfect_difference_cover():
    differences_ = Counter((a - b) % cover_suffixes.PERIOD for a in cover_suffixes.COVER for b in cover_suffixes.COVER if a != b)
    assert sorted(differences_) == list(range(1, cover_suffixes.PERIOD)) and set(differences_.values()) == {1}
    cover = cover_suffixes.Cover(200, cover_suffixes.PERIOD, cover_suffixes.COVER)
    for size in (0, 109, 110, 111, 200, 201, 500):
        assert cover.count(size) == sum(p % 91 in cover_suffixes.COVER for p in range(size - 109))


def removed(rows, length):
    data = [(i, (t or "").encode()) for i, t, _ in rows]
    seen = Counter(b[at : at + length] for _, b in data for at in range(len(b) - length + 1))
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for at in range(len(b) - length + 1):
            if seen[b[at : at + length]] > 1:
                gone[at : at + length] = b"\1" * length
        spans = sum(g and (at == 0 or not gone[at - 1]) for at, g in enumerate(gone))
        rest = bytes(c for c, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_repeated_substrings(spark, monkeypatch, seed):
    """Edited copies, shared passages, periodic texts, copies in many blocks, a hot text; small blocks, many buckets."""
    monkeypatch.setattr(cover_suffixes, "BUCKET_ROWS", 400)
    draw = random.Random(seed)
    vocabulary = ["".join(draw.choice("abcdeé漢") for _ in range(draw.randint(1, 9))) for _ in range(2000)]

    def text(n):
        return " ".join(draw.choice(vocabulary) for _ in range(n))

    passages = [text(draw.randint(20, 120)) for _ in range(12)]
    rows = [(None, None, None), (1, "", "en"), (1, "short", "en")] + [(i, "hot " + passages[0] + passages[1], "en") for i in range(30)]
    for i in range(100):
        kind = draw.random()
        if kind < 0.3:
            made = text(draw.randint(0, 300))
        elif kind < 0.6:
            made = text(draw.randint(0, 60)) + draw.choice(passages)[draw.randint(0, 60) :] + text(9) + draw.choice(passages)[: draw.randint(150, 700)]
        elif kind < 0.9:
            made = list(draw.choice(rows)[1] or "")
            for _ in range(draw.randint(0, 6)):
                if made:
                    at = draw.randrange(len(made))
                    made[at : at + draw.randint(0, 2)] = draw.choice(["x", "", "yy"])
            made = "".join(made)
        else:
            made = draw.choice(["a" * draw.randint(0, 900), "ab" * draw.randint(0, 500), (text(10) + " ") * 12])
        rows.append((draw.choice([i, i, 7, None]), made, "en"))
    found = cover_suffixes.without_repeats(table(spark, rows), block_bytes=7000).collect()
    assert sorted([tuple(r)[:5] for r in found], key=str) == removed(rows, 200)
    for row in found:
        assert sum(s.end - s.start for s in row.spans) == row.n_removed


def test_bucket_slices_answer_alike(monkeypatch):
    """A bucket sorted in slices of its fingerprints gives what it gives in one."""
    draw = np.random.default_rng(5)
    keys = np.zeros((40, 16), np.uint8)
    keys[:, :12] = np.arange(480).reshape(40, 12) % 251
    doc, number = np.repeat(np.arange(40), 25), np.tile(np.arange(25), 40)
    prints = draw.integers(0, 300, 1000).astype(np.uint64) * np.uint64(1 << 49)
    rows = cover_suffixes._bucket_rows(cover_suffixes.RANKS, keys, doc, number, prints, None, np.zeros(1000, bool), 0 + 3)
    bucket = [row[:2] + tuple(map(pa.py_buffer, row[2:])) for row in rows if row[0] == rows[0][0]]

    def answers():
        out = []
        for key, links, _ in cover_suffixes._answers(lambda n, k, o: (cover_suffixes._links_row(n, k, o), None), list(bucket)):
            out += [(key, links[at : at + 26]) for at in range(0, len(links), 26)]
        return sorted(out)

    whole = answers()
    monkeypatch.setattr(cover_suffixes, "SLICE_ROWS", 7)
    assert answers() == whole and whole


# Fill in the middle


@pytest.mark.parametrize("share", [0, 0.001, 0.05, 0.5, 0.999, 1])
def test_boundary_set_selects(share):
    draw = np.random.default_rng(3)
    for size in (0, 1, 65_535, 65_536, 200_000):
        member = draw.random(size) < share
        places = [*np.flatnonzero(member).tolist(), size]
        boundaries = fill_middle.BoundarySet(member)
        assert boundaries.cardinality == len(places) - 1
        for k in {0, len(places) - 1, *draw.integers(0, len(places), 200).tolist()}:
            assert boundaries.select(k) == places[k]


def test_containers_take_the_smallest_kind():
    mixed = np.concatenate([np.ones(65_536, bool), np.arange(65_536) % 2 == 0, np.arange(65_536) % 97 == 0])
    assert [c[0] for c in fill_middle.BoundarySet(mixed).containers] == [fill_middle.RUNS, fill_middle.BITMAP, fill_middle.ARRAY]


def test_fill_in_the_middle_restores(spark):
    texts = [None, "", "a", "é漢\U0001f600x", "a<P>b", "<<S", "<M", "x\n" * 70_000, "日本語" * 30_000] + [f"text {i} <S ü" for i in range(200)]
    rows = table(spark, [(i if i % 5 else None, t, "en") for i, t in enumerate(texts)])
    made = fill_middle.fill_in_middle(rows)
    got = made.withColumn("back", fill_middle.restored(made.output, made.form)).collect()
    assert Counter(r.back for r in got) == Counter(t or "" for t in texts)
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    for r in got:
        if r.form != "plain":
            digest = hashlib.sha256(f"1:{'' if r.doc_id is None else r.doc_id}".encode()).hexdigest()
            low, high = sorted(int(digest[8 * i : 8 * i + 8], 16) % (r.n + 1) for i in range(2))
            assert (r.n, r.prefix_chars, r.middle_chars) == (len(r.back), low, high - low)
            p, m, s = r.back[:low], r.back[low:high], r.back[high:]
            assert r.output == (f"<P>{p}<S>{s}<M>{m}" if r.form == "psm" else f"<S>{s}<P>{p}<M>{m}")


# Collocations


def best_phrases(rows, support, most, top):
    count, n = Counter(), Counter()
    for _, t, lang in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, most + 1):
                for at in range(len(w) - k + 1):
                    count[lang, tuple(w[at : at + k])] += 1
    frequent = {p: a for p, a in count.items() if a >= support and len(p[1]) > 1}
    out = []
    for (lang, phrase), a in frequent.items():
        score, k = min((1000 * a * n[lang] // (count[lang, phrase[:k]] * count[lang, phrase[k:]]), k) for k in range(1, len(phrase)))
        inside = any(
            other == lang and len(longer) > len(phrase) and b >= a and any(longer[at : at + len(phrase)] == phrase for at in range(len(longer)))
            for (other, longer), b in frequent.items()
        )
        if not inside:
            out.append((lang, score, a, " ".join(phrase), count[lang, phrase[:k]], count[lang, phrase[k:]], n[lang]))
    ranked = []
    for lang in n:
        mine = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[1], -r[2], r[3].encode()))
        ranked += [(r[0], i + 1, r[3], r[2], r[4], r[5], r[6], r[1]) for i, r in enumerate(mine[:top])]
    return sorted(ranked)


@pytest.mark.parametrize(("support", "shards", "top"), [(2, 1, 2000), (5, 3, 2000), (9, 8, 5)])
def test_collocations(spark, support, shards, top):
    draw = random.Random(support)
    words = ["new", "york", "New", "City", "of", "the", "é", "日本", "x" * 300, "x" * 301, "a b", "of the"]
    ends = [" ", " ", " ", "\t ", ". ", ",", "\n", "\x0b", "?"]
    rows = [(draw.choice([i, None]), "".join(draw.choice(words) + draw.choice(ends) for _ in range(draw.randint(0, 60))), draw.choice(["en", "de", None, "und"])) for i in range(90)]
    rows += [(i, "hot text of copies here " * 7, "en") for i in range(40)] + [(1, None, "en"), (2, "", None), (3, " \t.", "fr")]
    found = collocations.collocations(table(spark, rows), support=support, shards=shards, top=top)
    assert sorted(map(tuple, found.collect())) == [r for r in best_phrases(rows, support, 5, top)]


def test_words_that_share_a_hash_stay_apart():
    block = collocations.Block([b"one two three two"])
    block.hashes = np.zeros_like(block.hashes)
    number, place = block.words()
    assert [block.data[block.starts[place[w]] : block.ends[place[w]]] for w in number] == [b"one", b"two", b"three", b"two"]


def test_blocks_end_with_separators():
    text = b"one two, three four. " * 50 + b"no end " * 100
    parts = list(collocations._cut(text, 64))
    assert b"".join(parts) == text and all(p[-1:] in b",." for p in parts[:-1])


# Long pieces of operator 6


def test_long_pieces_equal_the_library():
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    draw = random.Random(8)
    texts = ["".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n)) for n in (36_000, 97, 96, 500, 1000)]
    texts += ["e" * 100_000, "".join(draw.choice("ab") for _ in range(5000)), "".join(chr(draw.randrange(0x4E00, 0x9FA5)) for _ in range(20_000)), "-" * 3000 + "=" * 777]
    texts += ["".join(draw.choice(["the", "and", "inter", "nation", "al", "ization", "q"]) for _ in range(700)) for _ in range(20)]
    coded = byte_bpe.coder(path).encode(pa.array(texts), "coalesce(string_agg(k.ids, ' ' ORDER BY p.i), '') AS ids, coalesce(string_agg(k.decoded, '' ORDER BY p.i), '') AS back")
    assert coded["ids"].to_pylist() == [" ".join(map(str, library.encode_ordinary(t))) for t in texts]
    assert coded["back"].to_pylist() == texts


# Columns of any name in the stages of the pipeline


def test_stages_keep_clashing_columns(spark):
    extra = ["_row", "_rows", "_id", "_sha", "_position", "_times", "_hash", "fp", "root", "size", "a.b"]
    filler = "the quick brown fox and a lazy dog went on to see what is near the river of the town "
    rows = [(i if i % 3 else None, filler + f"number {i % 7} ", "en", "s", 3, *[f"{c}{i}" for c in extra]) for i in range(30)]
    plain = spark.createDataFrame([r[:5] for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in extra)
    clashing = spark.createDataFrame(rows, schema)
    for stage in (quality_rules.passing, exact_dedup.without_copies, simhash.without_near_copies, mixing.curriculum):
        found, expected = stage(clashing), stage(plain)
        assert found.columns == clashing.columns
        assert Counter((r[0], r[1]) for r in found.collect()) == Counter((r[0], r[1]) for r in expected.collect())
        for row in found.collect():
            assert len({value.removeprefix(c) for c, value in zip(extra, row[5:])}) == 1


def test_pieces_equal_the_library(monkeypatch):
    """Pieces of every kind side by side, contractions, marks, special tokens, characters of unsure class, long pieces, forgotten pieces."""
    from hearthlake.llm import pieces, token_store

    coder = pieces.Pieces(token_store.default_path())
    whole, cut = coder.library.encode_batch_fast, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
    # Classes as the library has them: between a letter and a number, each kind is cut in its own way.
    wanted = {pieces.LETTER: [(0, 2), (2, 3)], pieces.NUMBER: [(0, 1), (1, 3)], pieces.SIGN: [(0, 1), (1, 2), (2, 3)], pieces.WHITE: [(0, 1), (1, 2), (2, 3)]}
    sure = [c for c in [*range(0x3000), 0xAC00, 0x1F600, 0x20000] if pieces.classes()[c] in wanted and c != 39]
    assert [c for c in sure if [at for _, at in cut(f"a{chr(c)}1")] != wanted[pieces.classes()[c]]] == [] and len(sure) > 8000
    draw = random.Random(7)
    parts = ["'", "'s", "'t", "'re", "'ve", "'ll", " ", "  ", "\n", "　", "a", "re", "S", "日本", "٣", "12", "!", "...", "\U0001f600", "\U0001f9ff", "<|endoftext|>", "\x1c", "\x85", pieces.MARK, "aaaa" * 90]
    monkeypatch.setattr(pieces, "PIECES", 300)
    for _ in range(400):
        texts = ["".join(draw.choices(parts, k=draw.randrange(14))) + "".join(draw.choices("abcdelnorst", k=draw.randrange(30))) for _ in range(draw.randrange(1, 6))]
        assert [x.tolist() for x in coder.encode(texts, 2)] == [[*c.ids, 2] for c in whole(texts, add_special_tokens=False)]
    # A piece that is known isn't coded again, whatever texts it stands in.
    monkeypatch.setattr(pieces, "PIECES", 10_000)
    coder.encode(["the same words"], 2)
    monkeypatch.setattr(coder.merges, "contracted", None)
    assert [len(x) for x in coder.encode(["the same", "the same words words"], 2)] == [3, 5]


@pytest.mark.parametrize("ids", [[5], [0] * 700, [2**32 - 1, 0, 7], [i * i % 50_257 for i in range(999)]])
def test_blocks_of_the_jvm_equal_those_of_python(spark, ids):
    from hearthlake.llm import jvm_coder, range_coder

    data = np.array(ids, dtype="<u4")
    coded = spark.createDataFrame([(bytearray(data.tobytes()),)], "ids binary").select(jvm_coder.encoded(spark, F.col("ids"), F.lit(128)).alias("blocks"))
    blocks = [bytes(b) for b in coded.first().blocks]
    assert blocks == range_coder.encode(data.astype(np.int64), 128)
    lengths = [1, 0, len(ids) - 1]
    read = lambda x: spark.createDataFrame([(x, lengths)], "b array<binary>, n array<long>").select(jvm_coder.documents(spark, F.col("b"), F.col("n")).alias("d")).first().d
    assert read(blocks) == [0 << 32 | zlib.crc32(data[:1].tobytes()), 1 << 32, 1 << 32 | zlib.crc32(data[1:].tobytes())]
    broken = bytearray(blocks[0])
    broken[9] ^= 0x40
    with pytest.raises(Exception, match="checksum"):
        read([bytes(broken), *blocks[1:]])
