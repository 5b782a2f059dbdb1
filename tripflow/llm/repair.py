"""Token ids as compressed files: Re-Pair grammars per shard.

Documents are encoded in ascending order of ``doc_id``; every so many ids make a
shard. Within a shard the most frequent pairs of neighbouring ids are replaced by
new symbols, round by round; the rules and the length each one expands to are
stored with the sequence, and the ids and starting symbols of the documents, so
a document is decoded from the middle of a shard without what stands before it.

The files are Parquet with one row per shard, so Spark's commit protocol makes
them appear complete or not at all, on any storage:

``first_id, number``  the smallest doc_id and the shard's place in its task
``doc_ids, sizes``    documents in order, and their ids (with the end id)
``left, right``       the pair each rule stands for; rule i is symbol ``base + i``
``lengths``           ids each rule expands to
``base``              the first symbol that is a rule
``starts``            position in ``symbols`` where each document begins
``symbols``           the sequence, little-endian unsigned 32-bit, Zstandard-packed
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripflow.llm.bpe import PieceEncoder, pieces_of, slices, spread
from tripflow.llm.common import text_of
from tripflow.sources.scratch import scratch_path

# Ids of a shard, at least (a document is never split).
SHARD_IDS = 2_000_000
# Pairs replaced in a round, and how often a pair must occur. Rounds go on until none does.
PAIRS, LEAST = 2048, 8
# Distinct pieces a worker remembers with their ids, over all its tasks; beyond that it keeps those it met most often.
KEPT = 600_000
# The id that ends every document.
END = 0

SCHEMA = (
    "first_id bigint, number int, doc_ids array<bigint>, sizes array<bigint>, left array<int>, right array<int>, "
    "lengths array<int>, base int, starts array<bigint>, symbols binary"
)
_NAMES = [field.split()[0] for field in SCHEMA.split(", ")]


def compress(ids: np.ndarray, starts: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rules (left, right, lengths), symbols and the documents' starts among them.

    ``base`` is above every id. No pair reaches from one document into the next.
    Within a round, of pairs that overlap the leftmost is replaced.

    A pair of symbols never becomes more frequent once both are there: what a round makes
    new holds one of its rules. So pairs are counted once, a round looks at the places of
    the pairs it replaces and at their neighbours, and rarer pairs are never seen again.
    """
    n = len(ids)
    small = np.int32 if n < 1 << 30 else np.int64
    symbols = np.append(ids.astype(small), small(0))
    # Neighbours within the document; place ``n`` stands for none.
    after, before = np.arange(1, n + 2, dtype=small), np.arange(-1, n, dtype=small)
    before[0] = n
    firsts = starts[(starts > 0) & (starts < n)]
    after[firsts - 1], before[firsts] = n, n
    after[n] = before[n] = n
    # Of every pair that is or was frequent: its key, how often it is there now, and the places
    # that began with it when it was counted. ``kind``: the pair that begins at a place.
    keys, counts, begins, sizes = (np.zeros(0, np.int64) for _ in range(4))
    places, taken = np.zeros(2 * n, small), 0
    kind = np.full(n + 1, -1, small)
    left, right = np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero(after[:n] < n).astype(small)
    while True:
        found, ordered, first, times = _frequent(symbols[at], symbols[after[at]])
        at = at[ordered]
        kind[at] = np.repeat(np.arange(len(keys), len(keys) + len(found), dtype=small), times)
        begins, sizes = np.append(begins, taken + first), np.append(sizes, times)
        if taken + len(at) > len(places):
            places = np.append(places, np.zeros(len(places) + len(at), small))
        places[taken : taken + len(at)] = at
        taken += len(at)
        keys, counts = np.append(keys, found), np.append(counts, times)
        often = _most(keys, counts)
        if not len(often):
            break
        often = often[np.argsort(keys[often])]
        first_rule = base + len(left)
        left, right = np.append(left, keys[often] >> 32), np.append(right, keys[often] & 0xFFFFFFFF)
        at = places[spread(begins[often], sizes[often])]
        rule = np.repeat(np.arange(len(often)), sizes[often])
        there = kind[at] == often[rule]
        bits = len(often).bit_length()
        both = at[there].astype(np.int64) << bits | rule[there]
        both.sort()
        at, rule = (both >> bits).astype(small), (both & ((1 << bits) - 1)).astype(small)
        # In a run of overlapping pairs every second one, from the leftmost on, is replaced.
        opens = np.append(True, after[at[:-1]] != at[1:])
        place = np.arange(len(at)) - np.maximum.accumulate(np.where(opens, np.arange(len(at)), 0))
        leads = np.flatnonzero((place & 1) == 0)
        at, rule = at[leads], rule[leads]
        gone = after[at]
        symbols[at] = first_rule + rule
        after[at] = after[gone]
        before[after[at]] = at
        before[n] = n
        symbols[gone] = -1
        # Pairs that are no longer there: the replaced ones, and those that began or ended at them.
        ahead = before[at]
        ahead = ahead[(ahead < n) & (symbols[ahead] < first_rule)]
        changed = np.concatenate([at, ahead])
        was = kind[np.concatenate([changed, gone])]
        counts -= np.bincount(was[was >= 0], minlength=len(counts))
        kind[gone] = kind[changed] = -1
        at = changed[after[changed] < n]
    stay = symbols[:n] >= 0
    lengths = _expanded(left, right, np.ones(base, np.int64))
    if len(left):
        starts = (np.cumsum(stay) - 1)[np.minimum(starts, n - 1)]
    return left.astype(np.uint32), right.astype(np.uint32), lengths, symbols[:n][stay].astype(np.uint32), starts


def _frequent(lefts: np.ndarray, rights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pairs that occur ``LEAST`` times; where, pair by pair; where in that each begins; and how often each occurs."""
    symbol_bits = int(max(lefts.max(initial=0), rights.max(initial=0))).bit_length()
    place_bits = len(lefts).bit_length()
    lefts = lefts.astype(np.int64)
    if 2 * symbol_bits + place_bits < 64:
        # Pair and place in one number: sorting numbers is far quicker than sorting places by them.
        lefts <<= symbol_bits
        lefts |= rights
        lefts <<= place_bits
        lefts |= np.arange(len(lefts))
        lefts.sort()
        order, pairs = lefts, lefts >> place_bits
    else:
        symbol_bits, place_bits = 32, 63
        pairs = lefts << 32 | rights
        order = np.argsort(pairs, kind="stable")
        pairs = pairs[order]
    cuts = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1])) if len(pairs) else np.zeros(0, np.int64)
    times = np.diff(np.append(cuts, len(pairs)))
    often = times >= LEAST
    cuts, times = cuts[often], times[often]
    found = (pairs[cuts] >> symbol_bits) << 32 | pairs[cuts] & ((1 << symbol_bits) - 1)
    places = order[spread(cuts, times)]
    places &= (1 << place_bits) - 1
    return found, places, np.cumsum(times) - times, times


def _most(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The up to ``PAIRS`` most frequent pairs that occur ``LEAST`` times; of equally frequent ones the least keys."""
    often = np.flatnonzero(counts >= LEAST)
    if len(often) <= PAIRS:
        return often
    least = np.partition(counts[often], len(often) - PAIRS)[len(often) - PAIRS]
    more, same = often[counts[often] > least], often[counts[often] == least]
    return np.concatenate([more, same[np.argsort(keys[same])[: PAIRS - len(more)]]])


def _expanded(left: np.ndarray, right: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Lengths of the rules; a rule refers to earlier ones only."""
    base = len(known)
    lengths = np.concatenate([known, np.zeros(len(left), np.int64)])
    for i, (a, b) in enumerate(zip(left.tolist(), right.tolist()), base):
        lengths[i] = lengths[a] + lengths[b]
    return lengths[base:]


def expand(symbols: np.ndarray, left: np.ndarray, right: np.ndarray, base: int, lengths: np.ndarray | None = None) -> np.ndarray:
    """The ids a sequence stands for; any part of a shard's symbols can be given.

    The rules that occur are expanded once, each after those it refers to, and looked up.
    ``lengths``: what each rule expands to, if known.
    """
    left, right = np.asarray(left, np.int64), np.asarray(right, np.int64)
    lengths = np.asarray(_expanded(left, right, np.ones(base, np.int64)) if lengths is None else lengths, np.int64)
    needed = np.zeros(len(left), bool)
    new = np.unique(symbols[symbols >= base].astype(np.int64)) - base
    while len(new):
        needed[new] = True
        parts = np.concatenate([left[new], right[new]])
        parts = np.unique(parts[parts >= base]) - base
        new = parts[~needed[parts]]
    # An id stands for itself, a rule for a part of ``flat`` behind the ids.
    sizes = np.concatenate([np.ones(base, np.int64), np.where(needed, lengths, 0)])
    begins = np.cumsum(sizes) - sizes
    flat = np.zeros(int(sizes.sum()), np.int64)
    flat[:base] = np.arange(base)
    known = np.append(np.ones(base, bool), ~needed)
    todo = np.flatnonzero(needed)
    while len(todo):
        ready = known[left[todo]] & known[right[todo]]
        now, todo = todo[ready], todo[~ready]
        for part, begin in ((left[now], begins[base + now]), (right[now], begins[base + now] + sizes[left[now]])):
            flat[spread(begin, sizes[part])] = flat[spread(begins[part], sizes[part])]
        known[base + now] = True
    symbols = symbols.astype(np.int64)
    return flat[spread(begins[symbols], sizes[symbols])]


def _letters(tokenizer_json: str) -> dict[int, str] | None:
    """The characters that stand for the bytes of ASCII, if all that comes before the model is to put them there."""
    from tokenizers.pre_tokenizers import ByteLevel

    whole = json.loads(tokenizer_json)
    first = whole.get("pre_tokenizer") or {}
    if whole.get("normalizer") or whole.get("post_processor") or first.get("type") != "ByteLevel" or first.get("add_prefix_space"):
        return None
    level = ByteLevel(add_prefix_space=False, use_regex=False)
    return {i: level.pre_tokenize_str(chr(i))[0][0] for i in range(128)}


@cache
def _encode(tokenizer_json: str) -> Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]:
    """The library's ids of a list of pieces in a row, and their number per piece; made once in a worker.

    Pieces go to the library many at a time, as words cut already: it encodes each by itself and
    gives back one sequence. A byte-level token stands for as many bytes as it has characters, so
    the ids of a piece are those that make up its bytes. Pieces of ASCII alone go to the library's
    BPE model straight away, as they are cut already: beyond ASCII the library's classes might cut
    what Spark's do not.
    """
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(tokenizer_json)
    held = np.zeros(tokenizer.get_vocab_size(), np.int64)
    for token, i in tokenizer.get_vocab().items():
        held[i] = len(token)
    for i, token in tokenizer.get_added_tokens_decoder().items():
        held[i] = len(token.content.encode())

    alone = _letters(tokenizer_json)
    added = {token.content.encode() for token in tokenizer.get_added_tokens_decoder().values()}

    def encode(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        plain = np.fromiter((alone is not None and p.isascii() and p not in added for p in pieces), bool, len(pieces))
        parts, done, sizes = [np.zeros(0, np.int32)], [], np.zeros(len(pieces), np.int64)
        own = np.flatnonzero(plain)
        if len(own):
            tokenize = tokenizer.model.tokenize
            found = [tokenize(pieces[i].decode().translate(alone)) for i in own.tolist()]
            sizes[own] = np.fromiter(map(len, found), np.int64, len(own))
            parts.append(np.fromiter((token.id for tokens in found for token in tokens), np.int32))
            done.append(own)
        own = np.flatnonzero(~plain)
        for start in range(0, len(own), 10_000):
            some = own[start : start + 10_000]
            words = [pieces[i] for i in some.tolist()]
            (found,) = tokenizer.encode_batch_fast([[w.decode() for w in words]], is_pretokenized=True, add_special_tokens=False)
            ids = np.array(found.ids, np.int32)
            ends, reached = np.cumsum(np.fromiter(map(len, words), np.int64, len(words))), np.cumsum(held[ids])
            upto = np.searchsorted(reached, ends, "right")
            if not np.array_equal(np.append(0, reached)[upto], ends):
                raise ValueError("the tokenizer's ids do not make up the bytes of the pieces")
            sizes[some] = np.diff(upto, prepend=0)
            parts.append(ids)
            done.append(some)
        if not done:
            return parts[0], sizes
        # From the order of work to the order of ``pieces``.
        order, flat = np.concatenate(done), np.concatenate(parts)
        starts = np.zeros(len(pieces), np.int64)
        starts[order] = np.cumsum(sizes[order]) - sizes[order]
        return flat[spread(starts, sizes)], sizes

    return encode


@cache
def _encoder(tokenizer_json: str) -> PieceEncoder:
    """Lives as long as the worker: the pieces of one task are mostly those of the next."""
    return PieceEncoder(_encode(tokenizer_json), kept=KEPT)


def _shards(tokenizer_json: str, base: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        encoder = _encoder(tokenizer_json)
        pack = zstandard.ZstdCompressor(level=1).compress
        doc_ids: list = []
        parts: list[np.ndarray] = []
        sizes: list[int] = []
        held = number = 0

        def shard() -> pa.RecordBatch:
            n = np.array(sizes, np.int64)
            left, right, lengths, symbols, starts = compress(np.concatenate(parts), np.cumsum(n) - n, base)
            row = [
                doc_ids[0], number, doc_ids, n, left.astype(np.int32), right.astype(np.int32),
                lengths.astype(np.int32), base, starts.astype(np.int64), pack(symbols.astype("<u4").tobytes()),
            ]
            kinds = [pa.int64(), pa.int32(), *(pa.list_(t) for t in (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()))]
            kinds += [pa.int32(), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)], _NAMES)

        for batch in batches:
            n_pieces = np.diff(batch.column("pieces").offsets.to_numpy())
            for start, end in slices(n_pieces, SHARD_IDS // 2):
                rows = batch.slice(start, end - start)
                ids, own, _ = encoder(rows.column("pieces"))
                for doc_id, tokens in zip(rows.column("doc_id").to_pylist(), np.split(ids, np.cumsum(own)[:-1])):
                    doc_ids.append(doc_id)
                    parts.append(np.append(tokens, np.int32(END)))
                    sizes.append(len(tokens) + 1)
                    held += len(tokens) + 1
                    if held >= SHARD_IDS:
                        yield shard()
                        doc_ids, parts, sizes, held, number = [], [], [], 0, number + 1
        if doc_ids:
            yield shard()

    return run


def _segments(added: list[str], pattern: str) -> Column:
    """``pieces_of`` the text, after the tokenizer's added tokens are cut out of it as pieces of their own."""
    if not added:
        return pieces_of(pattern)
    # Java reads what stands between \Q and \E as it is.
    literal = "|".join(rf"\Q{token}\E" for token in sorted(added, key=len, reverse=True))
    parts = F.split(text_of(), f"(?={literal})|(?<={literal})")
    own = F.transform(parts, lambda part: F.when(part.isin(added), F.array(part)).otherwise(pieces_of(pattern, part)))
    return F.when(text_of().rlike(literal), F.flatten(own)).otherwise(pieces_of(pattern))


def write_shards(documents: DataFrame, path: str, tokenizer_path: str, pattern: str) -> None:
    """Encode every whole text, end each document with id 0, and write shards below ``path``.

    Documents are dealt out by ranges of ``doc_id`` and sorted within each; nulls
    come first, and rows of the same ``doc_id`` go by text. The tokenizer encodes
    every distinct piece of its pre-tokenizer ``pattern`` once per worker, up to ``KEPT``: pieces
    are encoded independently of each other, so the ids are those of the text. The
    tokenizer's added tokens are cut out first, as the library does it: where a text
    holds one literally, it is that token's id.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        tokenizer_json = file.read()
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(tokenizer_json)
    base = tokenizer.get_vocab_size()
    added = list(tokenizer.get_added_tokens_decoder().values())
    if any(token.lstrip or token.rstrip or token.single_word for token in added):
        raise ValueError("added tokens that take in or depend on what stands beside them are not supported")
    sent = documents.sparkSession.sparkContext.broadcast(tokenizer_json)
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    pieces = ordered.select("doc_id", _segments([token.content for token in added], pattern).alias("pieces"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _shards(sent.value, base)(batches)

    pieces.mapInArrow(run, SCHEMA).write.parquet(path)


def _read(batches: Iterator[pa.RecordBatch], with_ids: bool = True) -> Iterator[pa.RecordBatch]:
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i] for name in batch.schema.names}
            symbols = np.frombuffer(unpack(row["symbols"].as_py()), "<u4")
            left, right, lengths = (row[name].values.to_numpy() for name in ("left", "right", "lengths"))
            ids = expand(symbols, left, right, row["base"].as_py(), lengths).astype("<u4")
            sizes = row["sizes"].values.to_numpy()
            bounds = np.concatenate([[0], np.cumsum(sizes)])
            if len(ids) != bounds[-1]:
                raise ValueError("a shard's symbols do not make up its documents")
            raw, n = memoryview(ids.tobytes()), len(sizes)
            columns = {
                "first_id": pa.array([row["first_id"].as_py()] * n, pa.int64()),
                "number": pa.array([row["number"].as_py()] * n, pa.int32()),
                "place": pa.array(np.arange(n, dtype=np.int32)),
                "doc_id": row["doc_ids"].values,
                "n_tokens": pa.array(sizes, pa.int64()),
                "ids_crc32": pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())], pa.int64()),
            }
            if with_ids:
                columns["ids"] = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_pydict(columns)


_READ = "first_id bigint, number int, place int, doc_id bigint, n_tokens bigint, ids_crc32 bigint"


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """``first_id, number, place, doc_id, n_tokens, ids_crc32, ids`` of every document in the files."""
    return spark.read.schema(SCHEMA).parquet(path).mapInArrow(_read, f"{_READ}, ids array<int>")


def read_sums(spark: SparkSession, path: str) -> DataFrame:
    """``read_shards`` without the ids themselves, which stay in the tasks that read them."""
    return spark.read.schema(SCHEMA).parquet(path).mapInArrow(partial(_read, with_ids=False), _READ)


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[int]:
    """The ids of one document, expanding nothing but its own symbols."""
    import zstandard

    # Shards are in order of their documents, so files that begin after it are skipped by their statistics.
    shards = spark.read.schema(SCHEMA).parquet(path).filter(F.col("first_id").isNull() | (F.col("first_id") <= doc_id))
    row = shards.filter(F.array_contains("doc_ids", doc_id)).first()
    i = row.doc_ids.index(doc_id)
    end = row.starts[i + 1] if i + 1 < len(row.starts) else None
    symbols = np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(row.symbols)), "<u4")
    return expand(symbols[row.starts[i] : end], row.left, row.right, row.base, row.lengths).tolist()


def index(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, read back from the files.

    ``start`` counts the ids of all documents before it: the shards' sizes are
    summed in order, one row per shard, and each document adds those before it
    in its shard.
    """
    shards = spark.read.schema(SCHEMA).parquet(path).select(
        "first_id", "number", F.aggregate("sizes", F.lit(0).cast("bigint"), lambda t, x: t + x).alias("total")
    )
    in_order = Window.orderBy(F.asc_nulls_first("first_id"), "number").rowsBetween(Window.unboundedPreceding, -1)
    begins = shards.select(
        F.col("first_id").alias("its_first"), F.col("number").alias("its_number"), F.coalesce(F.sum("total").over(in_order), F.lit(0)).alias("begin")
    )
    within = Window.partitionBy("first_id", "number").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return (
        read_sums(spark, path)
        .withColumn("before", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
        .join(begins, F.col("first_id").eqNullSafe(F.col("its_first")) & (F.col("number") == F.col("its_number")))
        .select("doc_id", (F.col("begin") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
    )


def write_and_index(documents: DataFrame, tokenizer_path: str, pattern: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every row of ``documents``, from files just written.

    A null or empty text is the end id alone. Rows that repeat a ``doc_id`` are
    written each. An empty table writes no shard and gives no rows. Other columns
    are neither read nor returned.
    """
    path = scratch_path(documents.sparkSession, "token-shards")
    write_shards(documents, path, tokenizer_path, pattern)
    return index(documents.sparkSession, path)
