"""Byte-level BPE in DuckDB: a recursive query encodes, an ordered aggregation decodes.

Spark cuts every text into the pieces of the pre-tokenizer pattern. Each task
numbers the distinct pieces of its rows, and DuckDB, inside the task, encodes
those it has not met before: one row per token and position, joined with the
merge table; in every step the leftmost pair of minimum rank of each piece is
contracted, until no piece has a pair left. The tokens of a text are those of
its pieces in order. Decoding joins token positions with the vocabulary and
aggregates the bytes in order of position; as the bytes of tokens in a row are
the bytes of each in a row, it, too, works on the tokens of every distinct piece
once and joins the results for each text.

Memory per task: the merge table, the pieces kept (at most ``KEPT``), and one
slice of rows at a time.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import text_of

# Distinct pieces a task remembers with their tokens; beyond that it keeps those it met most often.
KEPT = 300_000
# Token positions decoded by one query.
DECODED = 1_000_000
# Pieces of texts handled at a time.
PIECES = 500_000
# Distinct pieces encoded by one recursive query.
ENCODED = 20_000

# Stands for no next token.
_NONE = (1 << 32) - 1


# A pre-tokenizer's pattern and one of the same matches that Java finds in less time: what most
# pieces are comes first, what begins alike is tried once, and no run is given back.
_QUICKER = {
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+": (
        r" ?+\p{L}++|'(?:s|t|re|ve|m|ll|d)| ?+(?:\p{N}++|[^\s\p{L}\p{N}]++)|\s+(?!\S)|\s+"
    )
}


def pattern_for_spark(pattern: str) -> str:
    """The pattern with classes such as ``\\s`` taken from Unicode, as in the tokenizer."""
    return "(?U)" + _QUICKER.get(pattern, pattern)


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by rank from a file of lines ``base64 rank``, ranks from 0 on."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    tokens = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


def merge_table(tokens: list[bytes]) -> list[tuple[int, int, int]]:
    """Left, right and merged rank of every pair of tokens that makes a token."""
    rank = {t: i for i, t in enumerate(tokens)}
    return [
        (rank[t[:cut]], rank[t[cut:]], i)
        for i, t in enumerate(tokens)
        for cut in range(1, len(t))
        if t[:cut] in rank and t[cut:] in rank
    ]


class DuckBpe:
    """The tables of one vocabulary in an in-memory DuckDB of this task."""

    def __init__(self, tokens: list[bytes]):
        import duckdb

        self.tokens = tokens
        self.rank = {t: i for i, t in enumerate(tokens)}
        self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
        left, right, merged = (np.array(c, np.uint64) for c in zip(*merge_table(tokens)))
        self._table("merges", {"k": pa.array(left << np.uint64(32) | right), "m": pa.array(merged)})
        # A byte as the character of that number, so that strings can be aggregated.
        names = pa.array([t.decode("latin-1") for t in tokens])
        self._table("vocabulary", {"id": pa.array(range(len(tokens)), pa.int32()), "name": names})

    def _table(self, name: str, columns: dict[str, pa.Array]) -> None:
        self.db.register("given", pa.table(columns))
        self.db.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM given")
        self.db.unregister("given")

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all pieces in a row, and their number per piece.

        A piece that is a token is that token.
        """
        whole = np.fromiter((self.rank.get(p, -1) for p in pieces), np.int64, len(pieces))
        length = np.fromiter(map(len, pieces), np.int64, len(pieces))
        # By length, so that a few long pieces do not keep many short ones waiting.
        todo = np.flatnonzero((whole < 0) & (length > 0))
        todo = todo[np.argsort(length[todo], kind="stable")]
        sizes = (whole >= 0).astype(np.int64)
        parts, done = [whole[whole >= 0]], [np.flatnonzero(whole >= 0)]
        for start in range(0, len(todo), ENCODED):
            some = todo[start : start + ENCODED]
            word, token = self._contract([pieces[i] for i in some])
            sizes[some] = np.bincount(word, minlength=len(some))
            parts.append(token)
            done.append(some)
        # From the order of work to the order of ``pieces``.
        order, flat = np.concatenate(done), np.concatenate(parts)
        starts = np.zeros(len(pieces), np.int64)
        starts[order] = np.cumsum(sizes[order]) - sizes[order]
        return flat[spread(starts, sizes)].astype(np.int32), sizes

    def _contract(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Number of the piece and token, in order."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        byte_rank = np.array([self.rank[bytes([b])] for b in range(256)], np.uint64)
        token = byte_rank[np.frombuffer(b"".join(pieces), np.uint8)]
        after = np.append(token[1:], token[:1])
        after[np.cumsum(sizes) - 1] = _NONE
        starts = np.cumsum(sizes) - sizes
        self._table(
            "letters",
            {
                "w": pa.array(np.repeat(np.arange(len(pieces), dtype=np.uint32), sizes)),
                "p": pa.array((np.arange(len(token)) - np.repeat(starts, sizes)).astype(np.uint32)),
                "k": pa.array(token << np.uint64(32) | after),
            },
        )
        result = self.db.sql(_CONTRACT).to_arrow_table()
        return result["w"].to_numpy(), result["t"].to_numpy()

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        """Bytes of each document; ``ids`` holds the documents one after another."""
        self.db.register(
            "given",
            pa.table(
                {
                    "d": pa.array(np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)),
                    "p": pa.array(np.arange(len(ids), dtype=np.int32)),
                    "id": pa.array(ids.astype(np.int32)),
                }
            ),
        )
        rows = self.db.sql(_DECODE).to_arrow_table()
        self.db.unregister("given")
        texts = [b""] * len(sizes)
        for d, name in zip(rows["d"].to_pylist(), rows["name"].to_pylist()):
            texts[d] = name.encode("latin-1")
        return texts


# One row per token that is left; ``k`` holds the token and the one after it, so
# a step needs no sorting and one hash table of merges by ``k``. Of each piece
# the pair with the least rank, and of those the leftmost, becomes one token: the
# row at its place takes the merged token, the row before sees it as next, the
# row after it goes. Pieces without a pair that may merge leave the recursion
# with ``done``.
_CONTRACT = """
WITH RECURSIVE steps(w, p, k, done) AS (
    SELECT w, p, k, false FROM letters
    UNION ALL (
        WITH live AS MATERIALIZED (
            SELECT w, p, k FROM steps WHERE NOT done
        ), least AS (
            SELECT w, min((m << 32) | p) AS pick FROM live JOIN merges USING (k) GROUP BY w
        ), best AS (
            SELECT least.w, (pick & 4294967295)::UINTEGER AS pick_p, pick >> 32 AS pick_t, k & 4294967295 AS pick_n
            FROM least JOIN live ON live.w = least.w AND live.p = (pick & 4294967295)::UINTEGER + 1
        )
        SELECT live.w,
               CASE WHEN p > pick_p THEN p - 1 ELSE p END,
               CASE WHEN p = pick_p THEN (pick_t << 32) | pick_n
                    WHEN p + 1 = pick_p THEN ((k >> 32) << 32) | pick_t
                    ELSE k END,
               pick_p IS NULL
        FROM live LEFT JOIN best ON live.w = best.w
        WHERE pick_p IS NULL OR p <> pick_p + 1
    )
)
SELECT w, (k >> 32)::INTEGER AS t FROM steps WHERE done ORDER BY w, p
"""

_DECODE = """
SELECT d, string_agg(name, '' ORDER BY p) AS name
FROM given JOIN vocabulary USING (id)
GROUP BY d
"""


def slices(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold up to ``most`` together, or one row."""
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > most:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``start, start + 1, ...`` of every range, one range after another."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


class PieceEncoder:
    """Tokens of texts given as pieces; every distinct piece is encoded once.

    ``encode``: tokens of a list of distinct pieces in a row, and their numbers. ``decode``, if given: the
    bytes of the tokens of each of them, from the tokens alone.
    """

    def __init__(
        self,
        encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]],
        decode: Callable[[np.ndarray, np.ndarray], list[bytes]] | None = None,
        kept: int = KEPT,
    ):
        self.encode, self.decode, self.kept = encode, decode, kept
        self.numbers: dict[str, int] = {}
        # In how many calls each piece occurred; those before pieces were forgotten count half.
        self.met = np.zeros(0, np.int32)
        self.flat = np.zeros(0, np.int32)
        self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.decoded = pa.array([], pa.binary())

    def _forget(self) -> None:
        """Leaves up to half of ``kept``: the pieces that occurred in most calls, at least two."""
        own = np.flatnonzero(self.met > 1)
        own = np.sort(own[np.argsort(-self.met[own], kind="stable")[: self.kept // 2]])
        names, sizes = list(self.numbers), self.sizes[own]
        self.numbers = {names[i]: number for number, i in enumerate(own.tolist())}
        self.flat = self.flat[spread(self.starts[own], sizes)]
        self.starts, self.sizes, self.met = np.cumsum(sizes) - sizes, sizes, self.met[own] // 2
        if self.decode is not None:
            self.decoded = self.decoded.take(pa.array(own))

    def _learn(self, new: list[str]) -> None:
        flat, sizes = self.encode([p.encode("utf-8") for p in new])
        self.numbers.update(zip(new, range(len(self.sizes), len(self.sizes) + len(new))))
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.met = np.concatenate([self.met, np.zeros(len(new), np.int32)])
        self.flat = np.concatenate([self.flat, flat])
        if self.decode is not None:
            bounds = np.concatenate([[0], np.cumsum(sizes)])
            texts: list[bytes] = []
            for a, b in slices(sizes, DECODED):
                texts += self.decode(flat[bounds[a] : bounds[b]], sizes[a:b])
            self.decoded = pa.concat_arrays([self.decoded, pa.array(texts, pa.binary())])

    def __call__(self, pieces: pa.ListArray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """All tokens of all rows in one, their number per row, and the bytes of each row."""
        bounds = pieces.offsets.to_numpy() - pieces.offsets[0].as_py()
        named = pieces.flatten().dictionary_encode()
        if len(self.numbers) > self.kept:
            self._forget()
        # Far quicker than ``to_pylist``.
        distinct = named.dictionary.to_numpy(zero_copy_only=False).tolist()
        number = np.fromiter(map(self.numbers.get, distinct, repeat(-1)), np.int64, len(distinct))
        new = np.flatnonzero(number < 0)
        if len(new):
            number[new] = np.arange(len(self.sizes), len(self.sizes) + len(new))
            self._learn([distinct[i] for i in new.tolist()])
        self.met[number] += 1
        at = number[named.indices.to_numpy()]
        sizes = self.sizes[at]
        reached = np.concatenate([[0], np.cumsum(sizes)])
        texts = None
        if self.decode is not None:
            own = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), self.decoded.take(pa.array(at)))
            texts = pc.binary_join(own, b"")
        return self.flat[spread(self.starts[at], sizes)], np.diff(reached[bounds]), texts


def pieces_of(pattern: str, text: str | Column = "text") -> Column:
    return F.regexp_extract_all(text_of(text), F.lit(pattern_for_spark(pattern)), F.lit(0))


def encode_decode(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, ids, decoded`` for every row of ``documents``: tokens, and the bytes they stand for.

    ``path`` names a file of ranks, ``pattern`` the pre-tokenizer. A null text is
    empty and has no tokens; repeated rows are encoded each; an empty table gives
    no rows; other columns are neither read nor returned. Special tokens are
    ordinary text.
    """
    return _per_document(documents, path, pattern, "doc_id bigint, ids array<int>, decoded binary", _whole)


def encode_decode_digests(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of what ``encode_decode`` gives."""
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return _per_document(documents, path, pattern, schema, _digests)


def _whole(ids: pa.ListArray, texts: pa.Array) -> list[pa.Array]:
    return [ids, texts]


def _digests(ids: pa.ListArray, texts: pa.Array) -> list[pa.Array]:
    def sha(values: pa.Array) -> pa.Array:
        return pa.array([hashlib.sha256(v).hexdigest() for v in values.cast(pa.binary()).to_pylist()], pa.string())

    decimal = pa.ListArray.from_arrays(ids.offsets, ids.values.cast(pa.string()))
    return [pc.list_value_length(ids).cast(pa.int64()), sha(pc.binary_join(decimal, " ")), sha(texts)]


def _per_document(documents: DataFrame, path: str, pattern: str, schema: str, result) -> DataFrame:
    tokens = documents.sparkSession.sparkContext.broadcast(read_ranks(path))
    names = [field.split()[0] for field in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        duck = DuckBpe(tokens.value)
        encoder = PieceEncoder(duck.encode, duck.decode)
        for batch in batches:
            pa.default_memory_pool().release_unused()
            n_pieces = np.diff(batch.column("pieces").offsets.to_numpy())
            for start, end in slices(n_pieces, PIECES):
                rows = batch.slice(start, end - start)
                ids, sizes, texts = encoder(rows.column("pieces"))
                bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                own = pa.ListArray.from_arrays(pa.array(bounds), pa.array(ids))
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), *result(own, texts)], names)

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), pieces_of(pattern).alias("pieces"))
    return rows.mapInArrow(run, schema)
