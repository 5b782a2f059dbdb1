"""Masked pseudo-likelihood with a bidirectional window network.

A token is predicted from the ``WINDOW`` tokens before it and as many after it,
never from itself: their embeddings, weighted by place, make a hidden layer, and
a two-level softmax (class, then word within the class) gives its probability. The
768 most frequent words have a place of their own in it; all others share 256
places, and of such a place's probability each word gets its share of the place's
tokens in the corpus. So every word has a probability of its own. A document's
score is the sum of its tokens' log-probabilities.

Training covers every token of every document once, half of them in each of two
rounds. In a round every task starts from the same
weights, goes through its rows with numpy, and sends its weights and the tokens
it saw; Spark averages them by tokens, index by index. What is sent grows with
the number of tasks, and so with the corpus; the network is of fixed size. The
counts of all words of the corpus are a Spark table that grows with it: a fixed
number of its most frequent words goes to the workers, all others are joined to the
documents' words and never collected.

Texts are cut into words and numbered once; training and scoring read the numbers.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.llm.bpe import spread
from tripflow.llm.common import by_bytes, stored, text_of

# Classes, and words per class. The most frequent words have a place of their
# own; all others share the last ``RARE`` places by a hash.
CLASSES, PER_CLASS, RARE = 32, 32, 256
VOCABULARY = CLASSES * PER_CLASS
WINDOW, EMBEDDED, HIDDEN = 3, 16, 32
# Rounds of training, and every how many tokens of a document one is a training
# case in a round; round i starts at token i % STRIDE. As STRIDE is no more than
# ROUNDS, every token is a training case.
ROUNDS, STRIDE = 2, 2
RATE, BATCH = 0.1, 4096
# Tokens scored at a time: what is made of them stays in a core's cache.
SCORED = 8192
# Bytes of text whose words a task holds at a time, unless one text is longer; and where they are only counted.
HELD, COUNTED = 2_000_000, 8_000_000
# Words that share a place and whose part of it the workers know, at most; the others are joined.
KNOWN = 60_000
# Up to here, and down to minus it, ``exp`` of 32-bit floats can be added up over a row.
LARGEST = 80.0
# Stands before the beginning and after the end of a document.
PAD = VOCABULARY


@dataclass
class Network:
    embedding: np.ndarray  # (VOCABULARY + 1, EMBEDDED)
    places: np.ndarray  # (2 * WINDOW, EMBEDDED, HIDDEN)
    bias: np.ndarray  # (HIDDEN,)
    classes: np.ndarray  # (HIDDEN + 1, CLASSES)
    words: np.ndarray  # (CLASSES, HIDDEN + 1, PER_CLASS)

    def flat(self) -> np.ndarray:
        return np.concatenate([a.ravel() for a in vars(self).values()])

    @staticmethod
    def of(flat: np.ndarray) -> Network:
        shapes = [
            (VOCABULARY + 1, EMBEDDED),
            (2 * WINDOW, EMBEDDED, HIDDEN),
            (HIDDEN,),
            (HIDDEN + 1, CLASSES),
            (CLASSES, HIDDEN + 1, PER_CLASS),
        ]
        ends = np.cumsum([int(np.prod(s)) for s in shapes])
        parts = np.split(np.asarray(flat, np.float32), ends[:-1])
        return Network(*[p.reshape(s).copy() for p, s in zip(parts, shapes)])

    @staticmethod
    def start(seed: int = 0) -> Network:
        draw = np.random.default_rng(seed).normal
        size = VOCABULARY * EMBEDDED + EMBEDDED + 2 * WINDOW * EMBEDDED * HIDDEN + HIDDEN
        rest = (HIDDEN + 1) * CLASSES + CLASSES * (HIDDEN + 1) * PER_CLASS
        return Network.of(np.concatenate([draw(0, 0.1, size), np.zeros(rest)]))

    def tables(self) -> np.ndarray:
        """What each token adds to the hidden layer at each place: (2 * WINDOW, VOCABULARY + 1, HIDDEN)."""
        return np.matmul(self.embedding, self.places)

    def log_probabilities(self, context: np.ndarray, target: np.ndarray, tables: np.ndarray | None = None) -> np.ndarray:
        tables = self.tables() if tables is None else tables
        order, slices = _by_class(target // PER_CLASS)
        context, target = context.take(order, axis=0), target[order]
        h = np.repeat(self.bias[None], len(target), axis=0)
        for place, table in enumerate(tables):
            h += table.take(context[:, place], axis=0)
        h = _with_one(np.tanh(h, out=h))
        inner = np.empty((len(h), PER_CLASS), np.float32)
        for c, a, b in slices:
            np.matmul(h[a:b], self.words[c], out=inner[a:b])
        total = np.empty(len(h), np.float32)
        total[order] = _log_softmax_at(h @ self.classes, target // PER_CLASS, self.classes)
        total[order] += _log_softmax_at(inner, target % PER_CLASS, self.words)
        return total

    def learn(self, flat: np.ndarray, at: np.ndarray, stride: int, squares: list[np.ndarray]) -> None:
        """One step of AdaGrad on the tokens ``at``, ``stride`` or a multiple of it apart, of ``flat``: see ``laid_out``.

        ``squares``: sums of squared gradients per array.
        """
        order, slices = _by_class(flat[at] // PER_CLASS)
        target, step = flat[at][order], ((at - at[0]) // stride)[order]
        # Every token around is looked up, and its gradient added up, once for all cases it is near. A
        # block: ``stride`` tokens in a row; the tokens around a case begin with one and end in the
        # ``reach - 1`` blocks behind it. The token itself and those after them have weights of zero.
        steps, reach = (at[-1] - at[0]) // stride + 1, 2 * WINDOW // stride + 1
        near = flat[at[0] - WINDOW : at[0] - WINDOW + (steps + reach - 1) * stride]
        block = stride * EMBEDDED
        places = np.zeros((reach * stride, EMBEDDED, HIDDEN), np.float32)
        places[:WINDOW], places[WINDOW + 1 : 2 * WINDOW + 1] = self.places[:WINDOW], self.places[WINDOW:]
        places = places.reshape(-1, HIDDEN)
        windows = _windows(self.embedding.take(near, axis=0), reach * block, block)
        seen = windows[step]
        h = seen @ places
        h += self.bias
        h = _with_one(np.tanh(h, out=h))
        n, rows = np.float32(len(target)), np.arange(len(target))
        d_class = _softmax(h @ self.classes, self.classes)
        d_class[rows, target // PER_CLASS] -= 1
        d_inner = np.empty((len(h), PER_CLASS), np.float32)
        for c, a, b in slices:
            np.matmul(h[a:b], self.words[c], out=d_inner[a:b])
        d_inner = _softmax(d_inner, self.words)
        d_inner[rows, target % PER_CLASS] -= 1
        d_h = np.empty((len(h), HIDDEN), np.float32)
        g_words = np.zeros_like(self.words)
        for c, a, b in slices:
            np.matmul(d_inner[a:b], self.words[c, :HIDDEN].T, out=d_h[a:b])
            np.matmul(h[a:b].T, d_inner[a:b], out=g_words[c])
        d_h += d_class @ self.classes[:HIDDEN].T
        g_words /= n
        slope = h[:, :HIDDEN] ** 2
        d_in = d_h * np.subtract(1, slope, out=slope)
        spaced = np.zeros((steps + 2 * (reach - 1), HIDDEN), np.float32)
        spaced[step + reach - 1] = d_in
        back = places.reshape(reach, block, HIDDEN)[::-1].transpose(0, 2, 1).reshape(-1, block)
        d_near = (_windows(spaced, reach * HIDDEN, HIDDEN).copy() @ back).reshape(-1, EMBEDDED)
        met = np.argsort(near.astype(np.uint16), kind="stable")
        numbers = near[met]
        firsts = np.flatnonzero(np.append(True, numbers[1:] != numbers[:-1]))
        g_embedding = np.zeros_like(self.embedding)
        g_embedding[numbers[firsts]] = np.add.reduceat(d_near.take(met, axis=0), firsts, axis=0) / n
        g_places = (seen.T @ d_in / n).reshape(-1, EMBEDDED, HIDDEN)
        gradients = [
            g_embedding,
            np.delete(g_places, WINDOW, axis=0)[: 2 * WINDOW],
            np.ones(len(target), np.float32) @ d_in / n,
            h.T @ d_class / n,
            g_words,
        ]
        for weight, gradient, square in zip(vars(self).values(), gradients, squares):
            square += gradient**2
            weight -= RATE * gradient / (np.sqrt(square) + 1e-8)


def _windows(rows: np.ndarray, width: int, step: int) -> np.ndarray:
    """A view of all values in a row: ``width`` of them from every ``step``-th on."""
    return np.lib.stride_tricks.sliding_window_view(rows.ravel(), width)[::step]


def _with_one(h: np.ndarray) -> np.ndarray:
    """The hidden layer with a one for the bias."""
    return np.concatenate([h, np.ones((len(h), 1), np.float32)], axis=1)


def _by_class(own: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """An order by class, and where in it each class that occurs begins and ends."""
    order = np.argsort(own.astype(np.uint8), kind="stable")
    ends = np.cumsum(np.bincount(own, minlength=CLASSES)).tolist()
    return order, [(c, a, b) for c, (a, b) in enumerate(zip([0, *ends], ends)) if b > a]


def _bounded(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """``x``, what ``weights`` make of hidden layers, in place; less each row's largest if ``exp`` might not hold it.

    Hidden values are at most 1 either way, so no value is beyond its weights' sum, and a
    softmax stays as it is when a row is shifted.
    """
    if not np.abs(weights).sum(axis=-2).max() < LARGEST:
        x -= x.max(axis=1, keepdims=True)
    return x


def _softmax(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """In place of ``x``."""
    np.exp(_bounded(x, weights), out=x)
    x *= (1 / (x @ np.ones(x.shape[1], np.float32)))[:, None]
    return x


def _log_softmax_at(x: np.ndarray, at: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Of each row the value at ``at``; overwrites ``x``."""
    own = _bounded(x, weights)[np.arange(len(x)), at]
    return own - np.log(np.exp(x, out=x) @ np.ones(x.shape[1], np.float32))


class Numbers(dict):
    """Token number per word; words without a place of their own share one by a hash."""

    def __init__(self, frequent: list[str]):
        super().__init__((w.encode(), i) for i, w in enumerate(frequent))
        self.frequent, self.own = frequent, len(self)

    def __missing__(self, word: bytes) -> int:
        if len(self) > self.own + 200_000:
            self.clear()
            self.update((w.encode(), i) for i, w in enumerate(self.frequent))
        value = self[word] = _shared_place(word)
        return value


def _shared_place(word: bytes) -> int:
    return VOCABULARY - RARE + zlib.crc32(word) % RARE


def tokens_of(text: str, numbers: Numbers) -> np.ndarray:
    """Numbers of the lower-cased words between ASCII white space."""
    return numbered(text.lower().encode().split(), numbers)


def numbered(words: list[bytes], numbers: Numbers) -> np.ndarray:
    return np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))


def laid_out(documents: list[np.ndarray], first: int = 0, stride: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All tokens with ``PAD`` around each document, where the cases are among them, and their documents' numbers.

    Cases: of each document every ``stride``-th token from ``first`` on; of one too short for
    that, from its first token on. Enough of ``PAD`` stands between documents that any two
    cases are a multiple of ``stride`` apart.
    """
    sizes = np.fromiter(map(len, documents), np.int64, len(documents))
    if not sizes.sum():
        return np.full(WINDOW, PAD), np.zeros(0, np.int64), np.zeros(0, np.int64)
    skipped = np.where(first < sizes, first, 0)
    apart = sizes - skipped + WINDOW + np.append(skipped[1:], 0)
    apart = -(-apart // stride) * stride
    firsts = WINDOW + first + np.cumsum(apart) - apart
    flat = np.full(firsts[-1] + apart[-1] + 2 * WINDOW + stride, PAD)
    flat[spread(firsts - skipped, sizes)] = np.concatenate(documents)
    times = -(-(sizes - skipped) // stride)
    owner = np.repeat(np.arange(len(documents)), times)
    return flat, np.repeat(firsts, times) + stride * spread(np.zeros_like(times), times), owner


def cases(documents: list[np.ndarray], first: int = 0, stride: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Context, target and document number of the cases: see ``laid_out``."""
    flat, at, owner = laid_out(documents, first, stride)
    around = np.array([i for i in range(-WINDOW, WINDOW + 1) if i])
    return flat[at[:, None] + around], flat[at], owner


def score_documents(network: Network, documents: list[np.ndarray]) -> np.ndarray:
    """Sum of the log-probabilities of each document's tokens, each from both sides."""
    total = np.zeros(len(documents))
    tables = network.tables()
    for start, end in _slices(documents):
        context, target, owner = cases(documents[start:end])
        found = np.empty(len(target))
        for a in range(0, len(target), SCORED):
            b = a + SCORED
            found[a:b] = network.log_probabilities(context[a:b], target[a:b], tables)
        total[start:end] = np.bincount(owner, found, minlength=end - start)
    return total


def _slices(documents: list[np.ndarray], most: int = 500_000) -> Iterator[tuple[int, int]]:
    start, held = 0, 0
    for i, own in enumerate(documents):
        if i > start and held + len(own) > most:
            yield start, i
            start, held = i, 0
        held += len(own)
    if documents:
        yield start, len(documents)


def lowered() -> Column:
    """The text as its words are counted and looked up: lower-cased by Spark in both cases."""
    return F.lower(text_of())


def _words(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words between ASCII white space of all texts in a row, and how many are each text's."""
    cut = pc.ascii_split_whitespace(texts)
    words = cut.flatten().dictionary_encode()
    sizes = np.diff(cut.offsets.to_numpy())
    # White space at either end of a text leaves an empty string there.
    empty = words.dictionary.index("").as_py()
    if empty >= 0:
        there = words.indices.to_numpy() != empty
        reached = np.concatenate([[0], np.cumsum(there)])
        sizes = np.diff(reached[np.concatenate([[0], np.cumsum(sizes)])])
        words = words.filter(pa.array(there))
    return words, sizes


def word_counts(documents: DataFrame) -> DataFrame:
    """``word, count`` over the whole corpus, stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_bytes(batches, "text", COUNTED):
            words, _ = _words(part.column("text"))
            times = np.bincount(words.indices.to_numpy(), minlength=len(words.dictionary))
            there = times > 0
            yield pa.RecordBatch.from_arrays([words.dictionary.filter(pa.array(there)), pa.array(times[there])], ["word", "times"])

    counted = documents.select(lowered().alias("text")).mapInArrow(run, "word string, times bigint")
    return stored(counted.groupBy("word").agg(F.sum("times").alias("count")), "lm-words")


def most_frequent(counts: DataFrame) -> list[str]:
    """The words with a place of their own: the most frequent ones, ties by name."""
    top = counts.orderBy(F.desc("count"), "word").limit(VOCABULARY - RARE)
    # A fixed number of rows, however large the corpus.
    return [row.word for row in top.collect()]


def frequent_words(documents: DataFrame) -> list[str]:
    return most_frequent(word_counts(documents))


def log_shares(counts: DataFrame, frequent: list[str]) -> DataFrame:
    """``word, count, log_share`` of every word that shares a place: log of its part of the place's tokens."""
    rare = counts.filter(~F.col("word").isin(frequent)).withColumn(
        "place", F.pmod(F.crc32(F.encode("word", "UTF-8")), F.lit(RARE)).cast("int")
    )
    # One row per place.
    totals = {row.place: row.total for row in rare.groupBy("place").agg(F.sum("count").alias("total")).collect()}
    total = F.get(F.array(*[F.lit(totals.get(i, 0)).cast("double") for i in range(RARE)]), F.col("place"))
    return rare.select("word", "count", F.log(F.col("count") / total).alias("log_share"))


def known_shares(shares: DataFrame) -> tuple[dict[str, float], DataFrame]:
    """The log shares of the up to ``KNOWN`` most frequent words that share a place, and the rows of all others.

    Words of about the same count are all known or all left, so the counts' steps alone are collected to find where.
    """
    step = F.floor(F.log2("count") * 16)
    steps = shares.groupBy(step.alias("step")).count().collect()  # at most 16 * 64 rows
    least, held = 16 * 64, 0
    for row in sorted(steps, key=lambda r: -r.step):
        held += row["count"]
        if held > KNOWN:
            break
        least = row.step
    known = shares.filter(step >= least).select("word", "log_share").collect()  # at most KNOWN
    return {row.word: row.log_share for row in known}, shares.filter(step < least)


def numbered_documents(documents: DataFrame, frequent: list[str], known: dict[str, float]) -> DataFrame:
    """``row, doc_id, tokens, known, words, times`` of every row of ``documents``, stored.

    ``row``: a number of its own, as rows may repeat; ``doc_id``: as a string; ``tokens``: the words'
    numbers in order, 16 bits each; ``known``: the sum of the log shares of words in ``known``;
    ``words, times``: the words that share a place and are not in it, and how often each is there.
    """
    sent = documents.sparkSession.sparkContext.broadcast((frequent, known))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, known = sent.value
        met = pa.array([*frequent, *known], pa.string())
        # By word met; the last row is for all others.
        places = np.array([*range(len(frequent)), *[_shared_place(w.encode()) for w in known], 0], np.uint16)
        share = np.concatenate([np.zeros(len(frequent)), list(known.values()), [0.0]])
        for part in by_bytes(batches, "text", HELD):
            words, sizes = _words(part.column("text"))
            named, code = words.dictionary, words.indices.to_numpy()
            at = pc.fill_null(pc.index_in(named, value_set=met), len(met)).to_numpy()
            place, other = places[at], np.flatnonzero(at == len(met))
            names = named.take(pa.array(other))
            place[other] = [_shared_place(w) for w in names.cast(pa.binary()).to_pylist()]
            owner = np.repeat(np.arange(len(sizes)), sizes)
            # Each other word of a document once: number of the document, then of the word among the others.
            number = np.full(len(named), -1)
            number[other] = np.arange(len(other))
            own = number[code]
            pairs, times = np.unique((owner * (len(other) + 1) + own)[own >= 0], return_counts=True)
            whose, which = np.divmod(pairs, len(other) + 1)
            ends = pa.array(np.searchsorted(whose, np.arange(len(sizes) + 1)), pa.int32())
            bounds = pa.array(np.concatenate([[0], 2 * np.cumsum(sizes)]), pa.int32())
            tokens = place[code]
            columns = [
                part.column("doc_id"),
                pa.Array.from_buffers(pa.binary(), len(sizes), [None, bounds.buffers()[1], pa.py_buffer(tokens.tobytes())]),
                pa.array(np.bincount(owner, share[at][code], minlength=len(sizes)), pa.float64()),
                pa.ListArray.from_arrays(ends, names.take(pa.array(which))),
                pa.ListArray.from_arrays(ends, pa.array(times, pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "tokens", "known", "words", "times"])

    rows = documents.select(F.col("doc_id").cast("string").alias("doc_id"), lowered().alias("text"))
    schema = "doc_id string, tokens binary, known double, words array<string>, times array<bigint>"
    numbered = rows.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id())
    return stored(numbered, "lm-tokens")


def _tokens(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(tokens.as_buffer() or b"", np.uint16) for tokens in column]


def train(documents: DataFrame, frequent: list[str], rounds: int = ROUNDS, stride: int = STRIDE) -> Network:
    """The network after ``rounds`` rounds over every document; over every token if ``stride <= rounds``."""
    return train_on(numbered_documents(documents, frequent, {}), rounds, stride)


def train_on(numbered: DataFrame, rounds: int = ROUNDS, stride: int = STRIDE) -> Network:
    """``train`` on rows of ``numbered_documents``."""
    network = Network.start()
    context = numbered.sparkSession.sparkContext
    for number in range(rounds):
        sent = context.broadcast(network.flat())

        def run(batches: Iterator[pa.RecordBatch], sent=sent, first=number % stride) -> Iterator[pa.RecordBatch]:
            flat = sent.value
            own = Network.of(flat)
            squares = [np.full_like(a, 1e-6) for a in vars(own).values()]
            seen = 0
            for part in by_bytes(batches, "tokens", HELD):
                documents = _tokens(part.column("tokens"))
                for start, end in _slices(documents):
                    tokens, at, _ = laid_out(documents[start:end], first, stride)
                    for a in range(0, len(at), BATCH):
                        own.learn(tokens, at[a : a + BATCH], stride, squares)
                    seen += len(at)
            if seen:
                total = own.flat().astype(np.float64) * seen
                columns = [np.arange(len(flat), dtype=np.int32), total, np.full(len(flat), float(seen))]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["at", "total", "seen"])

        sums = numbered.select("tokens").mapInArrow(run, "at int, total double, seen double").groupBy("at")
        averaged = stored(sums.agg((F.sum("total") / F.sum("seen")).alias("weight")), "lm-weights")
        rows = averaged.orderBy("at").toPandas()  # one row per weight
        if len(rows):
            network = Network.of(rows["weight"].to_numpy())
    return network


def scores(numbered: DataFrame, network: Network, shares: DataFrame) -> DataFrame:
    """``doc_id`` (as a string), ``n_tokens, log_likelihood, mean_log_probability`` for every row of ``numbered``.

    ``shares``: see ``log_shares``, of at least all ``words`` of ``numbered``.
    """
    sent = numbered.sparkSession.sparkContext.broadcast(network.flat())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Network.of(sent.value)
        for part in by_bytes(batches, "tokens", HELD):
            documents = _tokens(part.column("tokens"))
            columns = [
                part.column("row"),
                part.column("doc_id"),
                part.column("known"),
                pa.array(list(map(len, documents)), pa.int64()),
                pa.array(score_documents(own, documents), pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "known", "n_tokens", "by_place"])

    schema = "row bigint, doc_id string, known double, n_tokens bigint, by_place double"
    scored = numbered.select("row", "doc_id", "known", "tokens").mapInArrow(run, schema)
    others = numbered.select("row", F.explode(F.arrays_zip("words", "times")).alias("own")).select(
        "row", F.col("own.words").alias("word"), F.col("own.times").alias("times")
    )
    share = shares.select("word", "log_share")
    within = others.join(share, "word").groupBy("row").agg(F.sum(F.col("times") * F.col("log_share")).alias("within"))
    log_likelihood = F.col("by_place") + F.col("known") + F.coalesce("within", F.lit(0.0))
    return scored.join(within, "row", "left").select(
        "doc_id",
        "n_tokens",
        log_likelihood.alias("log_likelihood"),
        F.when(F.col("n_tokens") > 0, log_likelihood / F.col("n_tokens")).alias("mean_log_probability"),
    )


def pseudo_likelihood(documents: DataFrame) -> DataFrame:
    """Trains on all of ``documents`` and scores every row: see ``scores``.

    A null or empty text has no tokens, log-likelihood 0 and a null mean. A null
    ``doc_id`` stays null; repeated rows are learned from and scored each; an
    empty table gives no rows; other columns are neither read nor returned.
    Averages are sums of doubles, so reruns agree up to their rounding.
    """
    counts = word_counts(documents)
    frequent = most_frequent(counts)
    known, others = known_shares(log_shares(counts, frequent))
    numbered = numbered_documents(documents, frequent, known)
    found = scores(numbered, train_on(numbered), others)
    return found.withColumn("doc_id", F.col("doc_id").cast(documents.schema["doc_id"].dataType))
