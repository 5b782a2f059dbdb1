"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams.

Features of a text are its words and their stems, pairs of neighbouring words and
skip-grams (pairs with one word between them), each hashed to one of 2**20
coordinates and counted once. FTRL-proximal gives each coordinate its own rate and, through its
L1 term, leaves most weights at exactly zero, so the model that is broadcast is
a few thousand numbers.

The model is fitted in one task on a sample of at most ``sample`` labelled
documents, taken by a hash of ``doc_id`` from all of them; every text is scored,
as a whole.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import free_name, stored, text_of

# The most labelled documents the model is fitted on.
SAMPLE = 8_000
# From this score on a document is predicted toxic.
THRESHOLD = 0.3
# Rows with this remainder of crc32(doc_id) by FOLDS are held out.
FOLDS, HELD_OUT = 4, 2

_BITS = 20
_WORD = re.compile(r"\w+")
# Lengths of the stems by which a word counts besides itself: endings vary.
_STEMS = (4, 5)
# Odd multipliers that tell the three kinds of feature apart.
_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


@dataclass(frozen=True)
class Settings:
    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 4.0
    l2: float = 1.0
    passes: int = 2


class WordHashes:
    """Per word a number, and per number the hashes of the word and its stems.

    Each word is hashed once; the table starts anew when it gets large.
    """

    def __init__(self, most: int = 400_000):
        self.most = most
        self._empty()

    def _empty(self) -> None:
        self.numbers: dict[str, int] = {}
        self.hashes = np.zeros((len(_STEMS) + 1, 1024), np.uint64)

    def of(self, words: list[str]) -> np.ndarray:
        """One column per word, one row per kind of hash."""
        if len(self.numbers) > self.most:
            self._empty()
        numbers = self.numbers
        for word in set(words).difference(numbers):
            at = numbers[word] = len(numbers)
            if at == self.hashes.shape[1]:
                self.hashes = np.concatenate([self.hashes, np.zeros_like(self.hashes)], axis=1)
            self.hashes[0, at] = zlib.crc32(word.encode())
            for row, length in enumerate(_STEMS, 1):
                self.hashes[row, at] = zlib.crc32(word[:length].encode()) + (row << 32)
        return self.hashes[:, np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))]


def features(
    texts: list[str], hashes: WordHashes, wanted: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Document number and coordinate of every n-gram of ``texts``, repeats included.

    ``wanted``: a flag per coordinate; others are left out.
    """
    words = [_WORD.findall(text.lower()) for text in texts]
    document = np.repeat(np.arange(len(texts)), np.fromiter(map(len, words), np.int64, len(words)))
    rows = hashes.of(list(chain.from_iterable(words)))
    found = []

    def add(owner: np.ndarray, value: np.ndarray) -> None:
        at = (value >> np.uint64(64 - _BITS)).astype(np.int64)
        if wanted is not None:
            keep = np.flatnonzero(wanted[at])
            owner, at = owner[keep], at[keep]
        found.append((owner, at))

    for row in rows:
        add(document, row * np.uint64(_MIX[0]))
    flat = rows[0]
    for gap, mix in ((1, _MIX[1]), (2, _MIX[2])):
        if len(flat) > gap:
            together = document[gap:] == document[:-gap]
            pair = (flat[:-gap] * np.uint64(_MIX[0]) ^ (flat[gap:] + np.uint64(gap))) * np.uint64(mix)
            add(document[gap:][together], pair[together])
    return np.concatenate([d for d, _ in found]), np.concatenate([c for _, c in found])


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


def fit(texts: list[str], labels: list[int], settings: Settings = Settings()) -> tuple[np.ndarray, np.ndarray, float]:
    """Coordinates with a weight, their weights, and the bias.

    Without examples the bias is so low that every score is 0.
    """
    if not texts:
        return np.zeros(0, np.int64), np.zeros(0), -35.0
    hashes = WordHashes()
    examples = []
    for start in range(0, len(texts), 500):
        document, coordinate = features(texts[start : start + 500], hashes)
        order = np.unique(document << _BITS | coordinate)
        owner = order >> _BITS
        cuts = np.searchsorted(owner, np.arange(1, len(texts[start : start + 500])))
        examples += np.split((order & ((1 << _BITS) - 1)).astype(np.int32), cuts)
    z, n = np.zeros(1 << _BITS), np.zeros(1 << _BITS)
    bias_z = bias_n = 0.0

    def weights(z, n, l1):
        w = -(z - np.sign(z) * l1) / ((settings.beta + np.sqrt(n)) / settings.alpha + settings.l2)
        return np.where(np.abs(z) > l1, w, 0.0)

    # One order of the examples per pass, the same in every run.
    for number in range(settings.passes):
        for i in np.random.default_rng(number).permutation(len(examples)):
            at = examples[i]
            w, bias = weights(z[at], n[at], settings.l1), float(weights(np.float64(bias_z), np.float64(bias_n), 0.0))
            g = float(_sigmoid(w.sum() + bias)) - labels[i]
            for_z = g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / settings.alpha * w
            z[at] += for_z
            n[at] += g * g
            bias_z += g - (np.sqrt(bias_n + g * g) - np.sqrt(bias_n)) / settings.alpha * bias
            bias_n += g * g
    w = weights(z, n, settings.l1)
    kept = np.flatnonzero(w)
    return kept, w[kept], float(weights(np.float64(bias_z), np.float64(bias_n), 0.0))


def scores(texts: list[str], dense: np.ndarray, bias: float, hashes: WordHashes) -> np.ndarray:
    """Probability per text; a text without words has that of the bias alone."""
    total = np.full(len(texts), bias)
    document, coordinate = features(texts, hashes, dense != 0)
    each = np.unique(document << _BITS | coordinate)
    np.add.at(total, each >> _BITS, dense[each & ((1 << _BITS) - 1)])
    return _sigmoid(total)


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Whether the label of this document must not be learned from; a null id is not held out."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    crc = F.crc32(column.cast("string").cast("binary"))
    return F.coalesce(F.pmod(crc, F.lit(FOLDS)) == HELD_OUT, F.lit(False))


def train(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE, settings: Settings = Settings()) -> DataFrame:
    """``coordinate, weight`` rows of the model, with the bias as coordinate -1.

    Labels that are null or belong to no document are left out, as are held out
    ones; a document with several labels counts as toxic if one says so. Of the
    rest the ``sample`` smallest hashes of ``doc_id`` are learned from.
    """
    usable = (
        labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy(F.col("doc_id").alias("labelled"))
        .agg(F.max("toxic").cast("int").alias("label"))
    )
    chosen = usable.orderBy(F.xxhash64("labelled"), "labelled").limit(sample)
    texts = (
        documents.select("doc_id", text_of().alias("text"))
        .join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled"))
        .select("doc_id", "text", "label")
    )

    def fit_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = list(batches)
        rows = pd.concat(parts) if parts else pd.DataFrame({"doc_id": [], "text": [], "label": []})
        rows = rows.drop_duplicates().sort_values(["doc_id", "text", "label"])
        at, w, bias = fit(rows["text"].tolist(), rows["label"].tolist(), settings)
        yield pd.DataFrame({"coordinate": np.append(at, -1), "weight": np.append(w, bias)})

    return texts.repartition(1).mapInPandas(fit_all, "coordinate bigint, weight double")


def score_column(model: DataFrame):
    """A function from a text column to its score column; the model goes along as a broadcast.

    The model has at most one row per coordinate, 2**20 in all.
    """
    rows = stored(model, "toxicity-model").toPandas()
    # Without any example there is not even a bias: see ``fit``.
    bias = float(rows.loc[rows["coordinate"] < 0, "weight"].sum()) if len(rows) else -35.0
    rows = rows[rows["coordinate"] >= 0]
    sent = model.sparkSession.sparkContext.broadcast((rows["coordinate"].to_numpy(), rows["weight"].to_numpy(), bias))

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        at, weight, bias = sent.value
        dense = np.zeros(1 << _BITS)
        dense[at] = weight
        hashes = WordHashes()
        for batch in batches:
            texts, parts, start = batch.tolist(), [], 0
            while start < len(texts):  # a few million characters at a time
                end, room = start, 4_000_000
                while end < len(texts) and (end == start or room > 0):
                    room -= len(texts[end])
                    end += 1
                parts.append(scores(texts[start:end], dense, bias, hashes))
                start = end
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    # As an annotation could not be resolved in a task, the kind of UDF is stated.
    return F.pandas_udf(score, "double", F.PandasUDFType.SCALAR_ITER)


def toxicity(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``documents``.

    Only the text enters a score. Null and empty texts get the score of the bias;
    equal texts get equal scores; an empty table gives no rows. Without usable
    labels every score is 0. Other columns are neither read nor returned.
    """
    score = score_column(train(documents, labels, sample))
    scored = documents.select("doc_id", held_out().alias("held_out"), score(text_of()).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def drop_toxic(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``documents`` whose score is below the threshold, all columns unchanged."""
    name = free_name("toxicity", documents)
    score = score_column(train(documents, labels, sample))
    return documents.withColumn(name, score(text_of())).filter(F.col(name) < THRESHOLD).drop(name)
