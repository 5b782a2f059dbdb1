"""Spelling variants: words one edit apart, found by asymmetric chunks.

Of two words one edit apart, the shorter one (of equal ones: the lesser) is cut
into two disjoint chunks, its halves. The edit touches one of them at most, so the
other one is a positional gram of the longer word, at the same place or shifted by
one: the first half without a shift, the second one shifted by the difference in
length. As many words share a half, the same holds once more for what is left: one
of its two halves is untouched, too. So a word gives four pairs of chunks, and of
its positional grams those pairs that could be the chunks of a word of its own
length or one less. Equal pairs meet in an ordinary join; what meets is verified.

All of it is Spark's own functions. Words are counted per task before they are
shuffled, so a frequent word is no hot key; a join key fixes three quarters of a
word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import drop_stored, stored, text_of

# Which code points make a run, and which are lower-cased.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUN = r"[a-zÀ-ÿ]+"
# Every so many runs, by checksum, lose a code point.
SLIPS = 199
# Least length and occurrences of a word; how much more frequent its form is.
LENGTH, TIMES, RATIO = 6, 5, 5


def words(documents: DataFrame) -> DataFrame:
    """``word, n``: the words of all texts, some with a slip, and how often they occur."""
    text = F.translate(text_of(), UPPER, LOWER)
    runs = documents.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"),
        F.explode(F.regexp_extract_all(text, F.lit(RUN), F.lit(0))).alias("run"),
    ).filter(F.char_length("run") >= LENGTH)
    checked = runs.withColumn("h", F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.char_length("run")).cast("int")
    slipped = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    word = F.when(F.col("h") % SLIPS == 0, slipped).otherwise(F.col("run"))
    counted = checked.groupBy(word.alias("word")).agg(F.count(F.lit(1)).alias("n"))
    return counted.filter((F.col("n") >= TIMES) & (F.char_length("word") >= LENGTH))


def _chunk_pairs(word: Column, length: Column, own: Column) -> Column:
    """What a word of ``own`` code points shows where a word of ``length`` code points has its chunks.

    Four hashes, each of a half and a quarter of the word of ``length``: taken from
    the front as they stand there, from the end as they stand before the end.
    """
    first = F.floor(length / 2).cast("int")
    last = length - first

    def piece(start: Column, size: Column) -> Column:
        return F.substring(word, start + 1, size)

    def quarters(case: int, half: Column, start: Column, end: Column, size: Column) -> list[Column]:
        """The two halves of what is left between ``start`` and ``end``, which are ``size`` long in the word of ``length``."""
        front = F.floor(size / 2).cast("int")
        back = size - front
        return [
            F.xxhash64(F.lit(case), length, half, piece(start, front)),
            F.xxhash64(F.lit(case + 1), length, half, piece(end - back, back)),
        ]

    zero = F.lit(0)
    return F.array(
        *quarters(0, piece(zero, first), first, own, last),
        *quarters(2, piece(own - last, last), zero, own - last, first),
    )


def near_pairs(counted: DataFrame) -> DataFrame:
    """``a, a_n, b, b_n`` for words of ``counted`` (``word, n``) that are one edit apart, once each."""
    sized = counted.withColumn("size", F.char_length("word"))
    size = F.col("size")
    chunks = sized.select(
        F.explode(_chunk_pairs(F.col("word"), size, size)).alias("key"),
        F.col("word").alias("a"),
        F.col("n").alias("a_n"),
        size.alias("a_size"),
    )
    either = F.concat(_chunk_pairs(F.col("word"), size, size), _chunk_pairs(F.col("word"), size - 1, size))
    grams = sized.select(
        F.explode(either).alias("of"), F.col("word").alias("b"), F.col("n").alias("b_n"), size.alias("b_size")
    )
    order = (F.col("a_size") < F.col("b_size")) | (F.col("a") < F.col("b"))
    may = (F.col("key") == F.col("of")) & F.col("b_size").between(F.col("a_size"), F.col("a_size") + 1) & order
    return (
        chunks.join(grams, may)
        .filter(F.levenshtein("a", "b", 1) == 1)
        .select("a", "a_n", "b", "b_n")
        .distinct()
    )


def variants(documents: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every frequent word of ``documents``.

    ``form``: of the words one edit away the most frequent one (ties: the smallest),
    if it is ``RATIO`` times as frequent as the word; ``root``: where forms lead to in
    the end, the word itself if it has none.

    A null text has no words; a null ``doc_id`` is checked as an empty one; repeated
    rows count each; an empty table gives no rows; a run of any length is one word.
    Other columns are neither read nor returned.
    """
    counted = stored(words(documents), "variants-words")
    pairs = stored(near_pairs(counted), "variants-pairs")
    either = pairs.union(pairs.select("b", "b_n", "a", "a_n")).toDF("word", "n", "other", "other_n")
    best = (
        either.groupBy("word", "n")
        .agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("n"), "other")).alias("best"))
        .select("word", "n", "n_near", (-F.col("best.n")).alias("form_n"), F.col("best.other").alias("form"))
    )
    far = F.col("form_n") < F.col("n") * RATIO
    found = stored(
        best.select(
            "word",
            "n_near",
            *[F.when(~far, F.col(c)).alias(c) for c in ("form", "form_n")],
        ),
        "variants-forms",
    )
    drop_stored(pairs)
    ends = roots(found.filter("form IS NOT NULL").select("word", "form"))
    return (
        counted.join(found, "word", "left")
        .join(ends, "word", "left")
        .select(
            "word",
            "form",
            F.coalesce("root", "word").alias("root"),
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            "form_n",
        )
    )


def roots(forms: DataFrame) -> DataFrame:
    """``word, root``: where the links ``word, form`` lead in the end.

    Each round doubles the steps taken. A form is more frequent than its word by
    ``RATIO``, so there are no circles, and 27 steps, five rounds, reach any end.
    """
    reached = stored(forms.toDF("word", "root"), "variants-roots")
    while True:
        onward = reached.toDF("via", "further")
        moved = stored(
            reached.join(onward, F.col("root") == F.col("via"), "left").select(
                "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
            ),
            "variants-roots",
        )
        drop_stored(reached)
        reached = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return reached


# Checksums bit by bit: 256 stands for a shift by one bit.
SQL = f"""
    WITH RECURSIVE runs AS (
        SELECT doc, run, count(*) AS times FROM (
            SELECT coalesce(doc_id::VARCHAR, '') AS doc,
                   unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[a-zÀ-ÿ]+')) AS run
            FROM documents
        ) WHERE length(run) >= {LENGTH} GROUP BY doc, run
    ), checked AS (
        SELECT run, times, xor(4294967295, list_reduce(
            list_prepend(4294967295::UBIGINT, flatten(list_transform(
                string_split(doc || ':' || run, ''),
                lambda x: CASE WHEN unicode(x) < 128
                    THEN [unicode(x)::UBIGINT, 256, 256, 256, 256, 256, 256, 256, 256]
                    ELSE [(192 + (unicode(x) >> 6))::UBIGINT, 256, 256, 256, 256, 256, 256, 256, 256,
                          (128 + (unicode(x) & 63))::UBIGINT, 256, 256, 256, 256, 256, 256, 256, 256] END
            ))),
            lambda c, e: CASE WHEN e = 256 THEN xor(c >> 1, 3988292384::UBIGINT * (c & 1)) ELSE xor(c, e) END
        )) AS h
        FROM runs
    ), slipped AS (
        SELECT times, CASE WHEN h % {SLIPS} = 0
            THEN substring(run, 1, (h % length(run))::BIGINT) || substring(run, (h % length(run))::BIGINT + 2)
            ELSE run END AS word
        FROM checked
    ), counted AS (
        SELECT word, sum(times)::BIGINT AS n FROM slipped WHERE length(word) >= {LENGTH}
        GROUP BY word HAVING sum(times) >= {TIMES}
    ), places AS (
        SELECT word, unnest(range(1, length(word) + 1)) AS i FROM counted
    ), shorter AS (
        SELECT word, i, substring(word, 1, i - 1) || substring(word, i + 1) AS rest FROM places
    ), near AS (
        SELECT x.word, y.word AS other FROM shorter x JOIN shorter y USING (i, rest) WHERE x.word <> y.word
        UNION SELECT word, rest FROM shorter SEMI JOIN counted c ON rest = c.word
        UNION SELECT rest, word FROM shorter SEMI JOIN counted c ON rest = c.word
    ), ranked AS (
        SELECT near.word, other, c.n AS other_n, count(*) OVER (PARTITION BY near.word) AS n_near,
               row_number() OVER (PARTITION BY near.word ORDER BY c.n DESC, other) AS place
        FROM near JOIN counted c ON c.word = other
    ), best AS (
        SELECT c.word, c.n, coalesce(n_near, 0) AS n_near,
               CASE WHEN other_n >= {RATIO} * n THEN other END AS form,
               CASE WHEN other_n >= {RATIO} * n THEN other_n END AS form_n
        FROM counted c LEFT JOIN ranked r ON r.word = c.word AND place = 1
    ), chain AS (
        SELECT word, word AS root FROM best
        UNION ALL
        SELECT chain.word, best.form FROM chain JOIN best ON best.word = chain.root WHERE best.form IS NOT NULL
    ), ends AS (
        SELECT chain.word, chain.root FROM chain JOIN best ON best.word = chain.root WHERE best.form IS NULL
    )
    SELECT word, form, root, n, n_near, form_n FROM best JOIN ends USING (word)
"""
