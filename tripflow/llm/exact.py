"""Exact duplicates with a heavy-hitter split.

A text that a third of all rows share would put a third of all rows into one
task of an ordinary grouping. So frequent digests are found first, by
Misra-Gries summaries: each task keeps at most ``capacity`` counters, and the
summed summaries, cut to ``capacity`` again, contain every digest that more than
1 / (capacity + 1) of all rows have. Their exact counts and winners are then
counted (partial sums per task) and broadcast: at most ``capacity`` rows, so the
broadcast has a proven bound. Rows of those digests are decided without moving;
all others go through an ordinary shuffle, in which no group is larger than the
bound above.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripflow.llm.common import free_name, stored, text_of

# Counters per summary, and so the most rows that are ever broadcast.
CAPACITY = 1024


def sha256(text: str | Column = "text") -> Column:
    """Lowercase hex SHA-256 of the text's UTF-8 bytes; null counts as empty."""
    return F.sha2(F.encode(text_of(text), "UTF-8"), 256)


def frequent_digests(digests: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """At most ``capacity`` values of ``digest``, every one above 1/(capacity+1) among them.

    A value that occurs once may be among them, too; see ``exact_groups``.
    """
    summaries = digests.select("digest").mapInPandas(_summaries(capacity), "digest string, n bigint")
    merged = summaries.groupBy("digest").agg(F.sum("n").alias("n"))
    return merged.orderBy(F.desc("n"), "digest").limit(capacity).select("digest")


def _summaries(capacity: int):
    def summarise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counters: dict[str, int] = {}
        for batch in batches:
            for digest, n in batch["digest"].value_counts().items():
                counters[digest] = counters.get(digest, 0) + n
            # A weighted Misra-Gries step: take the (capacity + 1)-th largest
            # count from all counters and keep what is above zero.
            if len(counters) > capacity:
                cut = sorted(counters.values(), reverse=True)[capacity]
                counters = {d: n - cut for d, n in counters.items() if n > cut}
        if counters:
            yield pd.DataFrame({"digest": list(counters), "n": list(counters.values())})

    return summarise


def exact_groups(documents: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row of ``documents``.

    Texts are equal when identical without any change; a null text is an empty
    one. Of equal texts the row with the largest ``doc_id`` stays.

    Empty table: no rows. A null ``doc_id`` is smaller than any other and stays
    only among nulls. Rows that repeat a ``doc_id`` with the same text are one
    document listed twice: all count in ``group_size`` and all get the same
    ``kept``. Other columns are neither read nor returned, whatever their names.
    """
    digests, winners = _winners(documents, capacity)
    marked = digests.join(
        F.broadcast(winners.withColumn("heavy", F.lit(True))),
        "digest",
        "left",
    )
    heavy = marked.filter("heavy").select("doc_id", "digest", "keep_id", "group_size")
    equal = Window.partitionBy("digest")
    light = marked.filter("heavy IS NULL").select(
        "doc_id",
        "digest",
        F.max("doc_id").over(equal).alias("keep_id"),
        F.count(F.lit(1)).over(equal).alias("group_size"),
    )
    return heavy.unionByName(light).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def _winners(documents: DataFrame, capacity: int) -> tuple[DataFrame, DataFrame]:
    """``doc_id, digest`` of every row, and ``digest, keep_id, group_size`` of frequent ones: at most ``capacity`` rows."""
    digests = stored(documents.select("doc_id", sha256().alias("digest")), "exact-digests")
    winners = stored(
        digests.join(F.broadcast(frequent_digests(digests, capacity)), "digest")
        .groupBy("digest")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .filter("group_size > 1"),
        "exact-winners",
    )
    return digests, winners


def drop_exact_copies(documents: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The rows of ``documents`` that ``exact_groups`` keeps, with all their columns.

    Copies of frequent texts go where they are read, and their winners stay there;
    only rows of other digests are shuffled.
    """
    key, digest, own = (free_name(n, documents) for n in ("keep_key", "keep_digest", "own_digest"))
    digests, winners = _winners(documents, capacity)
    heavy = winners.select(F.col("digest").alias(digest), F.col("keep_id").alias(key))
    marked = documents.withColumn(own, sha256()).join(F.broadcast(heavy), F.col(own) == F.col(digest), "left")
    stays = F.col(digest).isNotNull() & F.col("doc_id").eqNullSafe(F.col(key))
    light = (
        digests.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
        .groupBy("digest")
        .agg(F.max("doc_id").alias(key))
        .withColumnRenamed("digest", digest)
    )
    others = marked.filter(F.col(digest).isNull()).drop(key, digest)
    same = (F.col(own) == F.col(digest)) & others["doc_id"].eqNullSafe(F.col(key))
    return marked.filter(stays).drop(key, digest, own).unionByName(others.join(light, same, "left_semi").drop(own))
