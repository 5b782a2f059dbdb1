"""Mixing sources to target weights by systematic sampling.

Every document of a source is expected as often as the source's target holds its
size. These expectations are summed along the source, one random offset is
added, and a document is emitted once for each whole number its stretch of the
sum crosses. Sums are whole multiples of 1 / 2**24, so no rounding depends on
where a sum was cut.

A source may hold a third of all rows: it is cut into cells by a hash of
``doc_id``, each cell is summed by itself, and cells start where the ones before
them ended. Within a cell documents go by size, up in even cells and down in odd
ones, which keeps the words taken close to the target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripflow.llm.common import WORD, free_name, stored, text_of

# No document is taken more often, and so no target is above this many times its source.
MOST = 3
# Weights of the sources in order of their names, repeating.
WEIGHTS = (1, 2, 3)
# Rows of a cell: what one task sorts at a time.
CELL_ROWS = 4096
# Expectations are whole numbers of this unit.
_BITS = 24
_UNIT = 1 << _BITS


def word_count(text: str | Column = "text") -> Column:
    return F.regexp_count(text_of(text), F.lit(WORD)).cast("bigint")


def source_targets(
    sizes: DataFrame,
    source: str = "source",
    size: str = "size",
    weights: tuple[int, ...] = WEIGHTS,
) -> DataFrame:
    """``source, source_size, documents, target, expected`` per source.

    Sources by code point, null last, take ``weights`` in turn and share the sum
    of all sizes. A target stops at ``MOST`` times its source; the excess is
    shared by weight among the rest until none is above. That is one level for
    all: with sources in order of size per weight, the largest that the rest would
    get once those before are capped.

    ``expected`` is the number of copies of each document in units of 2**-24.
    """
    totals = sizes.groupBy(F.col(source).alias("source")).agg(
        F.sum(size).alias("source_size"), F.count(F.lit(1)).alias("documents")
    )
    # One row per source from here on, so windows over all of them are small.
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weighted = totals.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn + 1)).withColumn(
        "cap", F.lit(MOST) * F.col("source_size")
    )
    by_cap = Window.orderBy(
        F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()
    )
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_cap.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    levels = weighted.withColumn(
        "level",
        (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        / F.sum("weight").over(rest),
    )
    # Rises as long as the next source is capped and falls from then on.
    settled = levels.withColumn("level", F.max("level").over(everything))
    target = F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight"))
    return settled.withColumn("target", target).select(
        "source",
        "source_size",
        "documents",
        "target",
        F.when(
            F.col("source_size") > 0,
            F.least(F.floor(F.col("target") / F.col("source_size") * _UNIT), F.lit(MOST * _UNIT)),
        )
        .otherwise(0)
        .cast("bigint")
        .alias("expected"),
    )


def with_copies(
    rows: DataFrame,
    size: str,
    seed: int = 0,
    weights: tuple[int, ...] = WEIGHTS,
    cell_rows: int = CELL_ROWS,
) -> tuple[DataFrame, dict[str, str]]:
    """``rows`` (with ``doc_id``, ``source`` and a size column) and how often to take each.

    Returns the rows with the columns ``source_size``, ``target`` and ``copies``
    added, and the names these got where ``rows`` has such columns itself.
    """
    names = {n: free_name(n, rows) for n in ("source_size", "target", "copies", "expected", "cells", "cell", "start", "at")}
    plan = stored(source_targets(rows, size=size, weights=weights), "mix-sources").select(
        F.col("source").alias("plan_source"),
        F.col("source_size").alias(names["source_size"]),
        F.col("target").alias(names["target"]),
        F.col("expected").alias(names["expected"]),
        F.ceil(F.col("documents") / cell_rows).cast("bigint").alias(names["cells"]),
    )
    right = free_name("plan_source", rows)
    plan = plan.withColumnRenamed("plan_source", right)
    cell = F.pmod(_hex_number(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 8), F.col(names["cells"]))
    dealt = (
        rows.join(plan, rows["source"].eqNullSafe(F.col(right)), "inner")
        .withColumn(names["cell"], cell)
        .drop(right, names["cells"])
    )
    in_order = Window.partitionBy("source").orderBy(names["cell"]).rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(
        dealt.groupBy("source", names["cell"])
        .agg(F.sum(names["expected"]).alias("cell_sum"))
        .select(
            F.col("source").alias(right),
            F.col(names["cell"]).alias("its_cell"),
            F.coalesce(F.sum("cell_sum").over(in_order), F.lit(0)).alias("its_start"),
        ),
        "mix-cells",
    )
    its_cell = free_name("its_cell", dealt)
    starts = starts.withColumnRenamed("its_cell", its_cell).withColumnRenamed("its_start", names["start"])
    same_cell = dealt["source"].eqNullSafe(F.col(right)) & (F.col(names["cell"]) == F.col(its_cell))
    up_or_down = F.when(F.col(names["cell"]) % 2 == 0, F.col(size)).otherwise(-F.col(size))
    along = (
        Window.partitionBy("source", names["cell"])
        .orderBy(up_or_down, "doc_id")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    offset = _hex_number(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce("source", F.lit("")))), 6)
    taken = (
        dealt.withColumn(names["at"], F.sum(names["expected"]).over(along))
        .join(starts, same_cell, "inner")
        .withColumn(names["at"], F.col(names["at"]) + F.col(names["start"]) + offset)
        .withColumn(
            names["copies"],
            F.shiftright(names["at"], _BITS) - F.shiftright(F.col(names["at"]) - F.col(names["expected"]), _BITS),
        )
        .drop(right, its_cell, *(names[n] for n in ("expected", "cell", "start", "at")))
    )
    return taken, names


def mixture(documents: DataFrame, seed: int = 0, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for every row of ``documents``.

    A null text has size 0; a null source is a source, the last one; a null
    ``doc_id`` counts as the empty string. An empty source gets target 0. Rows
    that repeat are documents of their own. The same rows and seed give the same
    mix, however they are stored. No rows give no rows; other columns are
    neither read nor returned.
    """
    sizes = stored(documents.select("doc_id", "source", word_count().alias("size")), "mix-sizes")
    taken, names = with_copies(sizes, "size", seed, weights)
    return taken.select(
        "doc_id",
        "size",
        F.col(names["source_size"]).alias("source_size"),
        F.col(names["target"]).alias("target"),
        (F.col(names["copies"]) * F.col("size")).alias("taken"),
        F.col(names["copies"]).alias("copies"),
    )


def mix(documents: DataFrame, seed: int = 0, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``documents`` as mixed: each row as often as it is taken, all columns unchanged.

    Rows are numbered and their words counted once, in a stored table. How often to
    take each is decided on numbers, sources and sizes alone and joined to the
    texts at the end.
    """
    number, size, copy = (free_name(n, documents) for n in ("mix_number", "mix_size", "mix_copy"))
    numbered = stored(
        documents.withColumn(number, F.monotonically_increasing_id()).withColumn(size, word_count()), "mix-documents"
    )
    narrow = numbered.select(F.col(number).alias("number"), "doc_id", "source", F.col(size).alias("size"))
    taken, names = with_copies(narrow, "size", seed, weights)
    kept = taken.filter(F.col(names["copies"]) > 0).select(
        F.col("number").alias(copy), F.sequence(F.lit(1).cast("bigint"), names["copies"]).alias(size)
    )
    repeated = numbered.drop(size).join(kept, F.col(number) == F.col(copy)).withColumn(copy, F.explode(size))
    return repeated.select(*(F.col(f"`{c}`") for c in documents.columns))


def _hex_number(digest: Column, digits: int) -> Column:
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("bigint")


# ``mixture`` for the production seed and weights as SQL.
SQL = f"""
WITH d AS (
    SELECT doc_id, source,
           len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size
    FROM documents
), s AS (
    SELECT source, sum(size)::BIGINT AS source_size, count(*) AS documents,
           (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
    FROM d GROUP BY source
), l AS (
    SELECT *, {MOST} * source_size AS cap,
           ((sum(source_size) OVER () - coalesce(sum({MOST} * source_size) OVER (
                ORDER BY {MOST} * source_size / weight, source NULLS LAST
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT)::DOUBLE
           / (sum(weight) OVER (
                ORDER BY {MOST} * source_size / weight, source NULLS LAST
                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
    FROM s
), t AS (
    SELECT *, least(cap::DOUBLE, weight * max(level) OVER ()) AS target
    FROM l
), p AS (
    SELECT source, source_size, target, ceil(documents / {CELL_ROWS}.0)::BIGINT AS cells,
           CASE WHEN source_size > 0
                THEN least(floor(target / source_size * {_UNIT}), {MOST * _UNIT})::BIGINT ELSE 0 END AS expected,
           ('0x' || substr(md5('0:' || coalesce(source, '')), 1, 6))::BIGINT AS shift
    FROM t
), c AS (
    SELECT doc_id, size, p.*,
           ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT % cells AS cell
    FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source
), a AS (
    SELECT *, shift + sum(expected) OVER (
        PARTITION BY source
        ORDER BY cell, CASE WHEN cell % 2 = 0 THEN size ELSE -size END, doc_id NULLS FIRST
        ROWS UNBOUNDED PRECEDING)::BIGINT AS upto
    FROM c
)
SELECT doc_id, size, source_size, target,
       ((upto >> {_BITS}) - ((upto - expected) >> {_BITS})) * size AS taken,
       (upto >> {_BITS}) - ((upto - expected) >> {_BITS}) AS copies
FROM a
"""
