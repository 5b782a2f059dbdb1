"""Word-end BPE by an index of pair occurrences.

A task cuts its texts into pieces and encodes each distinct one once. The pieces
not met before are laid out in one row of tokens, and an index maps every pair of
neighbours that the merge list knows to all its positions, by the pair's rank. Ranks
are applied in ascending order: all positions of a pair become one token each, from
left to right, and only the pairs to the left and right of such a place change, so
only their lists are updated. A merge gives a token that only later merges use, so
no rank below the one applied becomes active, and this is the same as taking each
piece's lowest rank, leftmost first, until none is left.

Memory per task: the merge list, up to ``KEPT`` pieces with their tokens, one index
over ``ENCODED`` bytes, and ``SLICE`` code points of text at a time. A longer text
is cut at spaces, which no piece contains, and goes on where it was cut.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.bpe import slices, spread
from tripflow.llm.common import text_of

# Distinct pieces a task remembers; beyond that it starts anew.
KEPT = 200_000
# Bytes of new pieces under one index, and code points of text handled at a time.
ENCODED, SLICE = 1_000_000, 1_000_000

# Code points of which Python and the tokenizer's own code hold the same, whatever the
# version of Unicode: their classes, lower case and composition. Texts with others go through that code.
KNOWN = (
    (0x0, 0x52F), (0x2000, 0x206F), (0x20A0, 0x20C0), (0x2100, 0x23FF), (0x2500, 0x27FF), (0x3000, 0x30FF),
    (0x4E00, 0x9FFF), (0xAC00, 0xD7A3), (0xFF00, 0xFF60), (0x1F300, 0x1FAFF),
)


def byte_names() -> list[str]:
    """The character that stands for each byte in token names.

    Printable bytes of Latin-1 stand for themselves, all others for the characters from 256 on.
    """
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    names, following = {b: chr(b) for b in own}, 256
    for b in range(256):
        if b not in names:
            names[b] = chr(following)
            following += 1
    return [names[b] for b in range(256)]


class PairIndexBpe:
    """The vocabulary of a tokenizer file, and pieces to tokens.

    Reads byte-level files with word ends whose texts are composed, lower-cased and cut by one
    pattern; raises for any other kind.
    """

    def __init__(self, source: str):
        given = json.loads(source)
        model = given["model"]
        kinds = [n["type"] for n in given["normalizer"]["normalizers"]]
        cut, as_bytes = given["pre_tokenizer"]["pretokenizers"]
        if kinds != ["NFC", "Replace", "Lowercase"] or not cut["invert"] or as_bytes["use_regex"] or given["decoder"]:
            raise ValueError("the tokenizer file is of another kind")
        if model["type"] != "BPE" or model["ignore_merges"] or model["continuing_subword_prefix"]:
            raise ValueError("the model is of another kind")
        self.pattern = cut["pattern"]["Regex"]
        self.special = {t["content"]: t["id"] for t in given["added_tokens"]}
        ids = model["vocab"]
        end = model["end_of_word_suffix"]
        names = byte_names()
        self.inner = np.array([ids[n] for n in names], np.int64)
        self.final = np.array([ids[n + end] for n in names], np.int64)
        self.names = {i: n.encode("utf-8") for n, i in (ids | self.special).items()}
        # Pairs as one number: left id, then right id, of 20 bits each.
        self.ranks: dict[int, int] = {}
        self.made: list[int] = []
        made_by: dict[int, int] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            l, r, new = ids[left], ids[right], ids[left + right]
            if new in made_by:
                raise ValueError("merges must make a token once")
            made_by[new] = rank
            self.ranks[l << 20 | r] = rank
            self.made.append(new)
        for key, rank in self.ranks.items():
            if made_by.get(key >> 20, -1) > rank or made_by.get(key & 0xFFFFF, -1) > rank:
                raise ValueError("merges must make a token before they use it")
        keys = np.fromiter(self.ranks, np.int64, len(self.ranks))
        order = np.argsort(keys)
        self.keys, self.rank_of = keys[order], np.fromiter(self.ranks.values(), np.int64, len(keys))[order]

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all pieces in a row, and their number per piece; no piece is empty."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        flat, counts = [], []
        for a, b in slices(sizes, ENCODED):
            tokens, n = self._apply(b"".join(pieces[a:b]), sizes[a:b])
            flat.append(tokens)
            counts.append(n)
        if not flat:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(flat), np.concatenate(counts)

    def _apply(self, data: bytes, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        letters = np.frombuffer(data, np.uint8)
        ends = np.cumsum(sizes)
        start = self.inner[letters]
        start[ends - 1] = self.final[letters[ends - 1]]
        n = len(start)
        # The rank of the pair that begins at each position, or -1.
        key = start[:-1] << 20 | start[1:]
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        rank = np.append(np.where(self.keys[at] == key, self.rank_of[at], -1), -1)
        rank[ends - 1] = -1
        following = np.arange(1, n + 1)
        following[ends - 1] = -1
        before = np.arange(-1, n - 1)
        before[ends - sizes] = -1
        # The index: every rank's positions.
        order = np.argsort(rank, kind="stable")
        active, firsts = np.unique(rank[order], return_index=True)
        index = {r: p.tolist() for r, p in zip(active.tolist(), np.split(order, firsts[1:])) if r >= 0}
        waiting = sorted(index)
        token, rank = array("q", start.tobytes()), array("q", rank.tobytes())
        following, before = array("q", following.tobytes()), array("q", before.tobytes())
        ranks, made = self.ranks, self.made

        while waiting:
            now = heapq.heappop(waiting)
            new = made[now]
            for p in sorted(index.pop(now)):
                if rank[p] != now:
                    continue  # the pair has gone, or overlapped with one to its left
                gone = following[p]
                after, left = following[gone], before[p]
                token[p], token[gone], rank[gone], following[p] = new, -1, -1, after
                rank[p] = -1
                if after >= 0:
                    before[after] = p
                    r = ranks.get(new << 20 | token[after])
                    if r is not None:
                        rank[p] = r
                        if r in index:
                            index[r].append(p)
                        else:
                            index[r] = [p]
                            heapq.heappush(waiting, r)
                if left >= 0:
                    r = ranks.get(token[left] << 20 | new)
                    if r is None:
                        rank[left] = -1
                    else:
                        rank[left] = r
                        if r in index:
                            index[r].append(left)
                        else:
                            index[r] = [left]
                            heapq.heappush(waiting, r)
        left_over = np.frombuffer(token, np.int64)
        alive = left_over >= 0
        return left_over[alive], np.add.reduceat(alive.astype(np.int64), ends - sizes)


class _Numbers(dict):
    """A number per distinct piece, and the pieces that got theirs since the last look."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        value = self[piece] = len(self)
        self.new.append(piece)
        return value


class TextEncoder:
    """Texts to tokens and to the text they decode to, with the pieces of a task remembered."""

    def __init__(self, source: str):
        import regex
        import unicodedata
        from tokenizers import Regex, Tokenizer
        from tokenizers.pre_tokenizers import Split

        self.bpe = PairIndexBpe(source)
        self.find = regex.compile(self.bpe.pattern).findall
        self.compose = unicodedata.normalize
        known = "".join(rf"\U{a:08x}-\U{b:08x}" for a, b in KNOWN)
        self.strange = regex.compile(f"[^{known}]").search
        self.special = regex.compile("(" + "|".join(map(regex.escape, self.bpe.special)) + ")").split
        self.own = Tokenizer.from_str(source).normalizer
        self.cut = Split(Regex(self.bpe.pattern), "removed", invert=True)
        self._empty()

    def _empty(self) -> None:
        self.numbers = _Numbers()
        self.flat, self.starts, self.sizes = (np.zeros(0, np.int64) for _ in range(3))
        self.decoded: list[bytes] = []
        # Special tokens are pieces under a name that no piece has.
        for name, number in self.bpe.special.items():
            self.numbers[(name,)] = len(self.numbers)
            self._add(np.array([number]), np.array([1]))

    def _add(self, flat: np.ndarray, sizes: np.ndarray) -> None:
        ends = np.cumsum(sizes)
        self.starts = np.concatenate([self.starts, len(self.flat) + ends - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.flat = np.concatenate([self.flat, flat])
        names = [self.bpe.names[i] for i in flat.tolist()]
        self.decoded += [b" ".join(names[b - n : b]) for b, n in zip(ends.tolist(), sizes.tolist())]

    def pieces(self, text: str) -> list:
        """The pieces of a text in order; special tokens as tuples."""
        parts = self.special(text) if "<|" in text else [text]
        found: list = []
        for i, part in enumerate(parts):
            if i % 2:
                found.append((part,))
            elif part.isascii():
                found += self.find(part.lower())
            elif self.strange(part):
                found += [p for p, _ in self.cut.pre_tokenize_str(self.own.normalize_str(part))]
            else:
                found += self.find(self.compose("NFC", part).replace("Σ", "σ").lower())
        return found

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """All tokens in a row, their number per text, and what each text's tokens decode to."""
        if len(self.numbers) > KEPT:
            self._empty()
        by_text = [self.pieces(text) for text in texts]
        counts = np.fromiter(map(len, by_text), np.int64, len(by_text))
        number = np.fromiter((self.numbers[p] for own in by_text for p in own), np.int64, int(counts.sum()))
        if self.numbers.new:
            self._add(*self.bpe.encode([p.encode("utf-8") for p in self.numbers.new]))
            self.numbers.new = []
        sizes = self.sizes[number]
        reached = np.concatenate([[0], np.cumsum(sizes)])
        bounds = np.concatenate([[0], np.cumsum(counts)])
        names, listed = self.decoded, number.tolist()
        decoded = [b" ".join([names[i] for i in listed[a:b]]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        return self.flat[spread(self.starts[number], sizes)], np.diff(reached[bounds]), decoded


def _cut(text: str) -> Iterator[str]:
    """The text in parts of about ``SLICE`` code points, cut before spaces."""
    start = 0
    while len(text) - start > SLICE:
        end = text.find(" ", start + SLICE)
        if end < 0:
            break
        yield text[start:end]
        start = end
    yield text[start:]


def _encoded(encoder: TextEncoder, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, bytes]]:
    """``row, tokens, decoded`` in order; a long text's parts one after another under the same row."""
    rows: list[int] = []
    parts: list[str] = []
    held = 0

    def flush() -> Iterator[tuple[int, np.ndarray, bytes]]:
        flat, sizes, decoded = encoder(parts)
        at = 0
        for row, size, own in zip(rows, sizes.tolist(), decoded):
            yield row, flat[at : at + size], own
            at += size

    for row, text in enumerate(texts):
        for part in _cut(text.as_py()):
            rows.append(row)
            parts.append(part)
            held += len(part)
            if held >= SLICE:
                yield from flush()
                rows, parts, held = [], [], 0
    if rows:
        yield from flush()


def encode_decode(documents: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids, decoded`` for every row of ``documents``: tokens, and the text they decode to.

    ``path`` names a tokenizer file with word ends. A literal special token in a
    text is that token. A null text is empty and has no tokens; a null ``doc_id``
    stays null; repeated rows are encoded each; an empty table gives no rows; other
    columns are neither read nor returned. The decoded text has a space between
    tokens and shows the ends of words, as the file names no decoder.
    """

    def results(encoder: TextEncoder, texts: pa.Array) -> list[pa.Array]:
        ids: list[list[np.ndarray]] = [[] for _ in range(len(texts))]
        decoded: list[list[bytes]] = [[] for _ in range(len(texts))]
        for row, tokens, own in _encoded(encoder, texts):
            ids[row].append(tokens)
            if own:
                decoded[row].append(own)
        whole = [np.concatenate(parts) for parts in ids]
        ends = np.concatenate([[0], np.cumsum(list(map(len, whole)))])
        flat = np.concatenate([*whole, np.zeros(0, np.int64)])
        return [
            pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32())),
            pa.array([b" ".join(parts).decode("utf-8") for parts in decoded], pa.string()),
        ]

    return _per_document(documents, path, "doc_id bigint, ids array<int>, decoded string", results)


def encode_decode_digests(documents: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of what ``encode_decode`` gives, digested part by part."""

    def results(encoder: TextEncoder, texts: pa.Array) -> list[pa.Array]:
        totals = [0] * len(texts)
        of_ids, of_text = ([hashlib.sha256() for _ in range(len(texts))] for _ in range(2))
        for row, tokens, own in _encoded(encoder, texts):
            of_ids[row].update(tokens.astype("<u4").tobytes())
            if own:
                of_text[row].update(b" " + own if totals[row] else own)
            totals[row] += len(tokens)
        return [
            pa.array(totals, pa.int64()),
            *[pa.array([d.hexdigest() for d in digests], pa.string()) for digests in (of_ids, of_text)],
        ]

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return _per_document(documents, path, schema, results)


def _per_document(documents: DataFrame, path: str, schema: str, results) -> DataFrame:
    with open(path, encoding="utf-8") as file:
        sent = documents.sparkSession.sparkContext.broadcast(file.read())
    names = [field.split()[0] for field in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TextEncoder(sent.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), *results(encoder, batch.column(1))], names)

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(run, schema)
