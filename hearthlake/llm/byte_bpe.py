"""Byte-level BPE encoding and decoding with recursive queries (operator 6).

Spark deals the documents; in each task a DuckDB database inside the worker works on a
few megabytes of text at a time. The pieces that the pattern cuts are encoded once for
each different piece: token-position rows join the merge table, every piece contracts its
leftmost pair of minimum rank, and the query recurs until no piece has a pair left. The
query keeps the rows of every round, so the pieces of one call are bounded by the squares
of their lengths. Long pieces are contracted in segments, whose ends are then mended:
neighbouring tokens of an encoding are the encoding of their own bytes, and a sequence
whose neighbours all are is the encoding of the whole. So two parts are joined by
contracting what lies around their border, as far as a token that both have.
"""

from __future__ import annotations

import base64
import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from hearthlake.llm.common import given

#: Text that is worked on at a time, in bytes; a longer document is worked on alone.
CHUNK_BYTES = 4_000_000
#: Rows that one contraction makes in all its rounds, at most, and bytes of different pieces that a worker remembers.
CONTRACT_ROWS = 3_000_000
REMEMBERED_BYTES = 8_000_000
#: Longer pieces, in bytes, are contracted in segments; tokens on each side of a border that are contracted anew at first.
LONG_PIECE, SEGMENT, BORDER = 96, 32, 6
MEMORY = "400MB"

#: The pattern's white space is Unicode's White_Space property.
WHITE_SPACE = r"\x{9}-\x{D}\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
#: The tokenizer's pattern without its look-ahead, which matters only beside two white space characters in a row.
SINGLE_SPACED = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE_SPACE}\p{{L}}\p{{N}}]+|[{WHITE_SPACE}]+"
#: Texts with two white space characters in a row, or letters whose class may differ between versions of Unicode.
NEEDS_LOOKAHEAD = rf"[{WHITE_SPACE}][{WHITE_SPACE}]|[^\x{{0}}-\x{{24F}}]"

CONTRACT = """
WITH RECURSIVE t(word, pos, id, nxt, done) AS (
  SELECT word, pos, id, nxt, false FROM start
  UNION ALL (
    WITH open AS (SELECT word, pos, id, nxt FROM t WHERE NOT done),
    pair AS (
      SELECT a.word, a.pos, a.nxt, b.nxt AS nxt2, m.id, m.apart, (m.id::BIGINT << 32) | a.pos AS first
      FROM open a JOIN open b ON a.nxt = b.pos JOIN merges m ON m.pair = a.id::BIGINT * 16777216 + b.id
    ),
    best AS (SELECT word, min(first) AS first FROM pair GROUP BY word),
    chosen AS (
      SELECT pair.pos, pair.nxt, pair.nxt2, pair.id FROM pair JOIN best USING (word)
      WHERE pair.first = best.first OR (pair.apart AND pair.id = best.first >> 32)
    )
    SELECT open.word, open.pos, coalesce(c.id, open.id), coalesce(c.nxt2, open.nxt), best.word IS NULL
    FROM open LEFT JOIN chosen c ON c.pos = open.pos LEFT JOIN best ON best.word = open.word
    WHERE NOT EXISTS (SELECT 1 FROM chosen x WHERE x.nxt = open.pos)
  )
)
SELECT word, pos, id FROM t WHERE done
"""


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class Coder:
    """A vocabulary in a DuckDB database of the worker's process: merge table, token bytes, pieces met so far."""

    def __init__(self, path: str):
        import duckdb
        import regex

        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        left, right, merged = [], [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), merged.append(rank)
        # What a new token may join at once: if all of that has a higher rank, equal pairs of a
        # piece can be contracted together, since the leftmost would be followed by the others.
        soonest: dict[int, int] = {}
        for a, b, rank in zip(left, right, merged):
            for token in (a, b):
                soonest[token] = min(soonest.get(token, rank), rank)
        apart = [a != b and soonest.get(rank, rank + 1) > rank for a, b, rank in zip(left, right, merged)]
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.pattern = regex.compile(_pattern())
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": MEMORY, "temp_directory": ""})
        pairs = np.array(left, dtype=np.int64) * 16777216 + np.array(right, dtype=np.int64)
        table = pa.table({"pair": pairs, "id": pa.array(merged, pa.int32()), "apart": apart})
        tokens = pa.table({"bytes": pa.array(list(ranks), pa.binary()), "id": pa.array(list(ranks.values()), pa.int32())})
        self.db.register("given", table)
        self.db.execute("CREATE TABLE merges AS SELECT * FROM given")
        self.db.register("given", tokens)
        self.db.execute("CREATE TABLE vocabulary AS SELECT * FROM given")
        self._forget()

    def _forget(self) -> None:
        self.db.execute("CREATE OR REPLACE TABLE known (piece VARCHAR, n INTEGER, ids VARCHAR, decoded VARCHAR)")
        self.remembered = 0

    def cut(self, texts: pa.Array) -> None:
        """Table ``pieces`` (doc, i, piece): what the pattern cuts from every text, in order."""
        self.db.register("texts", pa.table({"doc": pa.array(range(len(texts)), pa.int32()), "text": texts}))
        self.db.execute(
            "CREATE OR REPLACE TABLE pieces AS SELECT doc, generate_subscripts(l, 1)::INT AS i, unnest(l) AS piece FROM"
            " (SELECT doc, regexp_extract_all(text, $single) AS l FROM texts WHERE NOT regexp_matches(text, $needs))",
            {"single": SINGLE_SPACED, "needs": NEEDS_LOOKAHEAD},
        )
        rest = self.db.execute("SELECT doc, text FROM texts WHERE regexp_matches(text, $needs)", {"needs": NEEDS_LOOKAHEAD}).fetchall()
        if rest:
            found = [self.pattern.findall(text) for _, text in rest]
            self.db.register("others", pa.table({"doc": pa.array([doc for doc, _ in rest], pa.int32()), "l": pa.array(found, pa.list_(pa.string()))}))
            self.db.execute("INSERT INTO pieces SELECT doc, generate_subscripts(l, 1)::INT, unnest(l) FROM others")

    def learn(self) -> None:
        """Encode the pieces that aren't in ``known`` yet."""
        if self.remembered > REMEMBERED_BYTES:
            self._forget()
        self.db.execute(
            "CREATE OR REPLACE TABLE fresh AS SELECT *, CASE WHEN octet_length(bytes) <= $long THEN"
            " sum(octet_length(bytes) * (octet_length(bytes) + 1) // 2) OVER (ORDER BY octet_length(bytes) > $long, word) // $rows END AS part FROM"
            " (SELECT piece, encode(piece) AS bytes, (row_number() OVER () - 1)::INT AS word FROM (SELECT DISTINCT piece FROM pieces ANTI JOIN known USING (piece)))",
            {"long": LONG_PIECE, "rows": CONTRACT_ROWS},
        )
        parts, size = self.db.execute("SELECT coalesce(max(part) + 1, 0)::INT, coalesce(sum(octet_length(bytes)), 0)::BIGINT FROM fresh").fetchall()[0]
        self.remembered += size
        for part in range(parts):
            self.db.execute(f"CREATE OR REPLACE TABLE batch AS SELECT word, piece, bytes FROM fresh WHERE part = {part}")
            # A piece that is a token is that token, as the library has it.
            self.db.execute("CREATE OR REPLACE TABLE done AS SELECT word, 0 AS pos, id FROM batch JOIN vocabulary USING (bytes)")
            open_ = self.db.sql("SELECT word, bytes FROM batch ANTI JOIN done USING (word)").to_arrow_table().combine_chunks()
            self.db.register("start", self._positions(open_))
            self.db.execute("INSERT INTO done " + CONTRACT)
            # Decode what was encoded: each id's bytes, put together in the order of positions; a piece's are whole characters.
            self.db.execute(
                "INSERT INTO known SELECT piece, count(*), string_agg(d.id::VARCHAR, ' ' ORDER BY pos), decode(unhex(string_agg(hex(v.bytes), '' ORDER BY pos)))"
                " FROM done d JOIN batch USING (word) JOIN vocabulary v ON v.id = d.id GROUP BY piece"
            )
        long = self.db.execute("SELECT piece, bytes FROM fresh WHERE part IS NULL").fetchall()
        if long:
            coded = self._long([data for _, data in long])
            columns = [
                [piece for piece, _ in long],
                pa.array([len(ids) for ids in coded], pa.int32()),
                [" ".join(map(str, ids)) for ids in coded],
                [b"".join(map(self.tokens.__getitem__, ids)).decode() for ids in coded],
            ]
            self.db.register("given", pa.table(columns, names=["piece", "n", "ids", "decoded"]))
            self.db.execute("INSERT INTO known SELECT * FROM given")

    def _contracted(self, pieces: list[bytes]) -> list[list[int]]:
        """The ids of each piece, by the recursive query, each different piece once."""
        known: dict[bytes, list[int]] = dict.fromkeys(pieces)
        todo = list(known)
        start = 0
        while start < len(todo):
            end, rows = start, 0
            while end < len(todo) and (end == start or rows < CONTRACT_ROWS):
                rows += len(todo[end]) * (len(todo[end]) + 1) // 2
                end += 1
            table = pa.table({"word": pa.array(range(end - start), pa.int32()), "bytes": pa.array(todo[start:end], pa.binary())})
            self.db.register("start", self._positions(table))
            found = self.db.execute(f"SELECT word, list(id ORDER BY pos) FROM ({CONTRACT}) GROUP BY word").fetchall()
            for word, ids in found:
                known[todo[start + word]] = ids
            start = end
        return [known[piece] for piece in pieces]

    def _long(self, pieces: list[bytes]) -> list[list[int]]:
        """The ids of each long piece: its segments', joined by twos until one part is left."""
        cut = [[piece[at : at + SEGMENT] for at in range(0, len(piece), SEGMENT)] for piece in pieces]
        coded = iter(self._contracted([segment for segments in cut for segment in segments]))
        parts = [list(itertools.islice(coded, len(segments))) for segments in cut]
        while any(len(p) > 1 for p in parts):
            joined = iter(self._joined([pair for p in parts for pair in zip(p[::2], p[1::2])]))
            parts = [[*itertools.islice(joined, len(p) // 2), *p[len(p) // 2 * 2 :]] for p in parts]
        return [p[0] for p in parts]

    def _joined(self, pairs: list[tuple[list[int], list[int]]]) -> list[list[int]]:
        """Each two parts as one: what lies around the border is contracted anew, wider until a token on each side is as before."""
        done: list[list[int]] = [[]] * len(pairs)
        todo, width = list(range(len(pairs))), BORDER
        while todo:
            windows = [(pairs[i][0][-width:], pairs[i][1][:width]) for i in todo]
            found = self._contracted([b"".join(self.tokens[t] for t in [*a, *b]) for a, b in windows])
            wider = []
            for i, (a, b), ids in zip(todo, windows, found):
                left, right = pairs[i]
                ends, before, after = self._ends(ids), self._ends(a), self._ends(b)
                border = before[-1]
                # Places in the window after which its tokens stay, and up to which they do: a token that both have, or the part's own end.
                first = (0, 0) if len(a) == len(left) else self._common(before, ends)
                turned = [ends[-1] - e for e in reversed(ends)], [after[-1] - e for e in reversed(after)]
                last = (0, 0) if len(b) == len(right) else self._common(turned[1], turned[0])
                if first is None or last is None or ends[first[1]] > border or ends[len(ids) - last[1]] < border:
                    wider.append(i)
                    continue
                done[i] = left[: len(left) - len(a) + first[0]] + ids[first[1] : len(ids) - last[1]] + right[len(b) - last[0] :]
            todo, width = wider, width * 2
        return done

    def _ends(self, ids: list[int]) -> list[int]:
        """Where the tokens begin, and where the last ends."""
        return [0, *itertools.accumulate(len(self.tokens[t]) for t in ids)]

    @staticmethod
    def _common(part: list[int], window: list[int]) -> tuple[int, int] | None:
        """Index in both of the first place at which both have a token of the same bytes."""
        at = {(a, b): i for i, (a, b) in enumerate(zip(window, window[1:]))}
        for i, token in enumerate(zip(part, part[1:])):
            if token in at:
                return i, at[token]
        return None

    def _positions(self, open_: pa.Table) -> pa.Table:
        """A row for each byte of each piece: its place, its token and the place of the next, -1 at the end."""
        rows = open_.num_rows
        column = open_["bytes"].combine_chunks().cast(pa.large_binary())
        chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
        column = chunks[0] if chunks else pa.array([], pa.large_binary())
        ends = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + rows + 1] if rows else np.zeros(1, dtype=np.int64)
        data = np.frombuffer(column.buffers()[2], dtype=np.uint8)[ends[0] : ends[-1]] if rows else np.zeros(0, dtype=np.uint8)
        ends = ends - ends[0]
        at = np.arange(len(data), dtype=np.int32)
        nxt = at + 1
        nxt[ends[1:] - 1] = -1
        return pa.table({"word": np.repeat(open_["word"].to_numpy(), np.diff(ends)), "pos": at, "id": self.bytes[data], "nxt": nxt})

    def encode(self, texts: pa.Array, columns: str) -> pa.Table:
        """One row for each text, in order; ``columns`` aggregates its pieces ``p`` and their codes ``k``."""
        self.cut(texts)
        self.learn()
        found = self.db.sql(
            f"SELECT {columns} FROM texts t LEFT JOIN pieces p ON p.doc = t.doc LEFT JOIN known k ON k.piece = p.piece GROUP BY t.doc ORDER BY t.doc"
        ).to_arrow_table()
        for table in ("pieces", "fresh"):
            self.db.execute(f"DROP TABLE IF EXISTS {table}")
        return found

    def decode(self, ids: pa.Array) -> pa.Array:
        """The bytes of each list of ids: token-position rows join the vocabulary, aggregated in order."""
        self.db.register("lists", pa.table({"doc": pa.array(range(len(ids)), pa.int32()), "ids": ids}))
        return (
            self.db.sql(
                "WITH rows AS (SELECT doc, unnest(ids) AS id, generate_subscripts(ids, 1) AS pos FROM lists)"
                " SELECT unhex(coalesce(string_agg(hex(v.bytes), '' ORDER BY pos), '')) AS b FROM lists LEFT JOIN rows USING (doc) LEFT JOIN vocabulary v ON v.id = rows.id"
                " GROUP BY lists.doc ORDER BY lists.doc"
            )
            .to_arrow_table()["b"]
            .combine_chunks()
        )


def _pattern() -> str:
    import public_tokenizers

    # Python's \s has four control characters that Unicode's White_Space hasn't.
    return public_tokenizers.PATTERN.replace(r"\S", r"\P{White_Space}").replace(r"\s", r"\p{White_Space}")


@functools.lru_cache(maxsize=2)
def coder(path: str) -> Coder:
    return Coder(path)


def chunks(batch: pa.RecordBatch, text: int, most_bytes: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about so many bytes of text."""
    sizes = pc.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for row, size in enumerate(sizes):
        if row > start and total + size > most_bytes:
            yield batch.slice(start, row - start)
            start, total = row, 0
        total += size
    if start < batch.num_rows:
        yield batch.slice(start)


def _mapped(docs: DataFrame, columns: str, schema: str, path: str | None) -> DataFrame:
    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for part in chunks(batch, 1):
                texts = pc.fill_null(part.column(1).cast(pa.string()), "")
                coded = coder(path or default_path()).encode(texts, columns)
                for out in pa.table([part.column(0), *[c.combine_chunks() for c in coded.columns]], names=["doc_id", *coded.column_names]).to_batches():
                    yield out

    return rows.mapInArrow(batches, f"doc_id {kind}, {schema}")


def encoded(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and ids, one row for each row of ``docs`` (doc_id, text): the ids of the whole text, none if empty or NULL."""
    return _mapped(docs, "coalesce(string_split(string_agg(k.ids, ' ' ORDER BY p.i), ' ')::INT[], []) AS ids", "ids array<int>", path)


def decoded(coded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and bytes, one row for each row of ``coded`` (doc_id, ids); an empty or NULL list gives no bytes."""
    rows = coded.select("doc_id", "ids")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                out = coder(path or default_path()).decode(part.column(1))
                yield pa.RecordBatch.from_arrays([part.column(0), out], names=["doc_id", "bytes"])

    return rows.mapInArrow(batches, f"doc_id {kind}, bytes binary")


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256, one row for each row of ``docs`` (doc_id, text).

    The ids are those of the whole text, each piece of the pattern encoded by itself,
    without special tokens; NULL counts as empty. ids_sha256 is of the decimal ids
    joined by one space, decoded_sha256 of the bytes that the ids decode to. Rows that
    repeat are encoded each for itself; an empty table gives an empty result. No
    shuffle; memory grows with the longest document, in a line, not with the partition.
    """
    return _mapped(
        docs,
        "coalesce(sum(k.n), 0)::BIGINT AS n_tokens, sha256(coalesce(string_agg(k.ids, ' ' ORDER BY p.i), '')) AS ids_sha256,"
        " sha256(coalesce(string_agg(k.decoded, '' ORDER BY p.i), '')) AS decoded_sha256",
        "n_tokens long, ids_sha256 string, decoded_sha256 string",
        path,
    )


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(given(spark, sf_dir, "documents"))
