"""Document fingerprints by winnowing, in DataFrame functions only.

A text is read as units of up to ``UNIT`` characters between white space, each
word starting a new unit. Every run of ``GRAM`` units gets a polynomial hash; of
every ``SPAN`` neighbouring hashes the smallest is selected, of equal ones the
rightmost, and kept with its position. Two texts that share a run of
GRAM + SPAN - 1 units share a selected hash; short texts keep all their hashes.
Where one of two texts that are compared is short, all hashes of both are compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripflow.llm.common import stored, text_of

UNIT, GRAM, SPAN = 4, 3, 8
# Texts of fewer hashes than this keep them all: a few picks would say little.
SHORT = 4 * SPAN
# The polynomial's modulus, a prime below 2**31, and its base.
_PRIME, _BASE = 2147483647, 1000003
_LOW = (1 << 32) - 1
_UNITS = r"[^\x20\x09-\x0D]{1,%d}" % UNIT


def with_selected(rows: DataFrame, text: str, name: str) -> DataFrame:
    """``rows`` with ``name``: the selected hashes and positions, as ``hash << 32 | (2**32 - 1 - position)``.

    In this form the least value of a span is the least hash and the rightmost of
    equal ones. A text of fewer than ``GRAM`` units is hashed as a whole; one
    without units has none.
    """
    h, v = f"{name}_h", f"{name}_v"
    placed = rows.withColumn(h, _unit_hashes(text)).withColumn(v, _grams(F.col(h))).drop(h)

    # The least of 2, then 4, then 8 neighbours; of the last ones in a text some are missing, and cut off.
    spans, least_of = F.col(v), 1
    while least_of < SPAN:
        step = min(least_of, SPAN - least_of)
        placed = placed.withColumn(f"{v}{least_of + step}", F.zip_with(spans, _from(spans, step), lambda x, y: F.least(x, y)))
        least_of += step
        spans = F.col(f"{v}{least_of}")
    whole = F.slice(spans, 1, F.greatest(F.size(v) - SPAN + 1, F.lit(0)))
    picked = F.when(F.size(v) < SHORT, F.col(v)).otherwise(F.array_distinct(whole))
    return placed.withColumn(name, picked).select(*rows.columns, name)


def _from(values: Column, i: int) -> Column:
    """What stands from place ``i`` on, or nothing."""
    return F.slice(values, i + 1, F.greatest(F.size(values) - i, F.lit(0)))


def _unit_hashes(text: str) -> Column:
    return F.transform(F.regexp_extract_all(F.col(text), F.lit(_UNITS), F.lit(0)), lambda u: F.pmod(F.xxhash64(u), F.lit(_PRIME)))


def _grams(h: Column) -> Column:
    """All hashes with their positions, from those of the units."""

    # The polynomial of all GRAM units fits 63 bits, factors reduced, so it is reduced once.
    factors = [pow(_BASE, GRAM - 1 - j, _PRIME) for j in range(GRAM)]

    def units(j: int) -> Column:
        return F.slice(h, j + 1, F.greatest(F.size(h) - GRAM + 1, F.lit(0)))

    def added(factor: int):
        return lambda total, x: total + x * factor

    total = F.transform(units(0), lambda x: x * factors[0])
    for j in range(1, GRAM):
        total = F.zip_with(total, units(j), added(factors[j]))
    grams = F.transform(total, lambda total, i: _placed(F.pmod(total, F.lit(_PRIME)), i))
    n = F.size(h)
    whole = F.when(
        n > 0,
        F.array(_placed(F.aggregate(h, n.cast("bigint"), lambda t, x: F.pmod(t * _BASE + x, F.lit(_PRIME))), F.lit(0))),
    ).otherwise(F.array().cast("array<bigint>"))
    return F.when(n >= GRAM, grams).otherwise(whole)


def is_short(text: str) -> Column:
    """Whether a text has fewer than ``SHORT`` hashes, so that it keeps them all."""
    # The beginning of a text has no more units than the text, and mostly enough to tell.
    def few(part: Column) -> Column:
        return F.regexp_count(part, F.lit(_UNITS)) - GRAM + 1 < SHORT

    beginning = F.substring(F.col(text), 1, 4 * UNIT * SHORT)
    return F.when(few(beginning), few(F.col(text))).otherwise(F.lit(False))


def all_hashes(text: str) -> Column:
    """All distinct hashes of a text, selected or not, as integers."""
    # An array of one gives the units' hashes a name.
    return hashes_of(F.get(F.transform(F.array(_unit_hashes(text)), _grams), F.lit(0)))


def _placed(value: Column, position: Column) -> Column:
    return F.shiftleft(value, 32).bitwiseOR(F.lit(_LOW) - position)


def hashes_of(selected: str | Column) -> Column:
    """The distinct hashes, as integers."""
    return F.array_distinct(F.transform(selected, lambda x: F.shiftright(x, 32).cast("int")))


def positions_of(selected: str | Column) -> Column:
    """``hash`` and ``position`` (in units, from 0) of every selected hash."""
    return F.transform(
        selected,
        lambda x: F.struct(
            F.shiftright(x, 32).alias("hash"), (F.lit(_LOW) - x.bitwiseAND(F.lit(_LOW))).alias("position")
        ),
    )


def likeness(one: str | Column, other: str | Column) -> Column:
    """Shared distinct hashes over all distinct hashes; 1 if neither text has any."""
    shared = F.size(F.array_intersect(one, other))
    union = F.size(one) + F.size(other) - shared
    return F.when(union == 0, F.lit(1.0)).otherwise(shared / union)


def fingerprint(documents: DataFrame) -> DataFrame:
    """``doc_id, fingerprint`` (array of ``hash``, ``position``) for every row of ``documents``."""
    rows = with_selected(documents.select("doc_id", text_of().alias("text")), "text", "selected")
    return rows.select("doc_id", positions_of("selected").alias("fingerprint"))


def _text(hashes: str) -> Column:
    return F.array_join(F.transform(hashes, lambda x: F.hex(x)), " ")


def _places(selected: str) -> Column:
    """Every selected hash with its position, ``hash@unit``, in order of position."""
    return F.array_join(
        F.transform(
            selected,
            lambda x: F.concat(
                F.hex(F.shiftright(x, 32)), F.lit("@"), (F.lit(_LOW) - x.bitwiseAND(F.lit(_LOW))).cast("string")
            ),
        ),
        " ",
    )


def _next_documents(ids: DataFrame) -> DataFrame:
    """``doc_id, key, cut, short, times`` of every document with ``next_id, next_key``: its next by descending id.

    Only ids move here. They are dealt out by ranges; each range looks ahead
    within itself, and its last one to the first of the next range.
    """
    order = [F.desc_nulls_last("doc_id"), F.asc("key")]
    ranged = stored(ids.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "winnow-order")
    within = Window.partitionBy("part").orderBy(*order)
    this = F.struct(F.col("doc_id").alias("id"), F.col("key").alias("k"))
    seen = ranged.select(
        "doc_id", "key", "cut", "short", "times", "part", F.lead(this).over(within).alias("ahead"), F.row_number().over(within).alias("place")
    )
    # One row per range from here on.
    firsts = seen.filter("place = 1").select("part", this.alias("first"))
    by_part = Window.orderBy("part")
    following = firsts.select(
        F.col("part").alias("its_part"),
        F.coalesce(
            F.lead("first").over(by_part),
            F.first("first").over(by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
        ).alias("following"),
    )
    ahead = F.coalesce("ahead", "following")
    return seen.join(following, F.col("part") == F.col("its_part")).select(
        "doc_id", "key", "cut", "short", "times", ahead["id"].alias("next_id"), ahead["k"].alias("next_key")
    )


def edited_fingerprints(documents: DataFrame) -> DataFrame:
    """Every document's fingerprint next to those of its edited text and of the next document.

    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, selected, edited_selected``. The edited text has its last floor(n_chars / 3) code
    points replaced by the first as many (or all) of the next document by
    descending ``doc_id``; after the last comes the first. The two fingerprints
    are the distinct selected hashes in hexadecimal, in order of position; ``selected``
    and ``edited_selected`` have every selected hash with its position, counted in units. The
    likeness of two texts is that of their selected hashes or, if one of them is
    short, of all their hashes.

    A null text is empty; an empty text has an empty fingerprint and is like
    another empty one. A null ``doc_id`` comes last. Rows that repeat a
    ``doc_id`` with the same text are one document, with a row for each; different
    texts of one ``doc_id`` follow each other in an order fixed by a hash. A
    single document is its own next one. An empty table gives no rows; other
    columns are neither read nor returned.
    """
    rows = documents.select("doc_id", text_of().alias("text")).withColumn("key", F.xxhash64("text"))
    cut = F.floor(F.length("text") / 3).cast("int")
    named = rows.groupBy("doc_id", "key", cut.alias("cut"), is_short("text").alias("short"))
    ids = stored(named.agg(F.count(F.lit(1)).alias("times")), "winnow-ids")
    repeated = not ids.filter("times > 1").isEmpty()
    if repeated:
        rows = rows.dropDuplicates(["doc_id", "key"])
    order = stored(_next_documents(ids), "winnow-next")
    # Only texts move; what is selected of them is found where they arrive. Both uses of this
    # have the same columns under the same names: only so they share one shuffle.
    marked = rows.select("doc_id", "key", "text")
    # What each document hands to the one it follows: the piece it needs, and the
    # hashes, all of them if either is short.
    taker = order.select(
        *[F.col(own).alias(f"to_{to}") for own, to in (("doc_id", "id"), ("key", "key"), ("cut", "cut"), ("short", "short"))],
        "times",
        "next_id",
        "next_key",
    )
    handed = (
        marked.alias("owner")
        .join(taker, F.col("owner.doc_id").eqNullSafe(F.col("next_id")) & (F.col("owner.key") == F.col("next_key")))
        .select(
            "to_id",
            "to_key",
            "times",
            F.expr("substring(text, 1, to_cut)").alias("piece"),
            (F.col("to_short") | is_short("text")).alias("next_whole"),
            F.col("text").alias("handing"),
        )
    )
    handed = with_selected(handed, "handing", "handed").select(
        "to_id",
        "to_key",
        "times",
        "piece",
        "next_whole",
        F.when(F.col("next_whole"), all_hashes("handing")).otherwise(hashes_of("handed")).alias("next_hashes"),
    )
    both = marked.join(handed, marked["doc_id"].eqNullSafe(F.col("to_id")) & (marked["key"] == F.col("to_key")))
    edited = both.withColumn(
        "edited", F.concat(F.expr("substring(text, 1, length(text) - int(floor(length(text) / 3)))"), "piece")
    )
    picked = with_selected(with_selected(edited, "text", "own"), "edited", "other")
    picked = picked.withColumn("hashes", hashes_of("own")).withColumn("edited_hashes", hashes_of("other"))
    result = picked.select(
        "doc_id",
        F.length("text").cast("bigint").alias("n_chars"),
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        _text("hashes").alias("fingerprint"),
        _text("edited_hashes").alias("edited_fingerprint"),
        F.when(is_short("text") | is_short("edited"), likeness(all_hashes("text"), all_hashes("edited")))
        .otherwise(likeness("hashes", "edited_hashes"))
        .alias("near_edited"),
        F.when(F.col("next_whole"), likeness(all_hashes("text"), "next_hashes"))
        .otherwise(likeness("hashes", "next_hashes"))
        .alias("near_next"),
        _places("own").alias("selected"),
        _places("other").alias("edited_selected"),
        "times",
    )
    if repeated:
        result = result.withColumn("times", F.explode(F.array_repeat("times", F.col("times").cast("int"))))
    return result.drop("times")
