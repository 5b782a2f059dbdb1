"""Near duplicates by an LSH forest over MinHash signatures, confirmed on the full sets.

Every distinct set of word shingles is one from the start. A tree of the forest is
one order of the sets, sorted by values of their signature, so sets that share a
long prefix stand next to each other.

1. In every tree the neighbours in the sorted order are candidates, the longer
   their common prefix the sooner. A few of each set are confirmed and joined to
   components: large groups of copies become one component by a few links per member.
2. A region of a tree is what shares a prefix. Sets of different components that share
   a region are compared if sizes and sketches leave a link possible, and confirmed.
   A component of a region is never compared with itself, so a region costs its size
   times the sets outside its largest component. Where those are more than ``CROWD``,
   the region is too shallow: its sets go on to a deeper forest, with longer prefixes
   of values of their own and more trees, see ``LEVELS``. What is crowded even in the
   deepest one, sets that are much alike and yet not linked, is dealt into blocks that
   all meet. So every depth is that of its region, and no number of partners is capped.

A pair of similarity J shares no region of a level with probability (1 - J**depth)**trees,
at 0.8 some 4e-8 in each; no two trees use the same value. It is lost only if so in one of
the levels it comes to, or by its sketches, see ``AGREE``. Confirmed links are exact, in integers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm.common import by_bytes, drop_stored, free_name, stored, text_of
from tripflow.llm.components import components

# Words per shingle and similarity in percent, unless told otherwise.
WORDS, SIMILAR = 5, 80
# Prefix length and trees of each level; a deeper one is for the sets of crowded regions.
LEVELS = ((3, 24), (6, 56))
# Sets outside the largest component of a region from which on it is crowded; and the
# sets of a block, where a region of the last level is.
CROWD, BLOCK = 256, 4096
DEPTH, TREES = LEVELS[0]
VALUES = TREES * DEPTH
# A sketch keeps two bits of each of 64 values. At a similarity of 0.8 some 54
# agree, with a deviation of 2.9; fewer than this many do with probability 2e-7.
AGREE = 38
# Neighbours looked at in each direction; and kept per set: drawn ones, and those with
# the longest common prefix.
AHEAD, DRAWN, ALIKE = 2, 8, 4
# Values of a neighbour's prefix that are compared beyond the region's.
BEYOND = 4
# Bits of the parity sketch, in 64s.
PARITY = 16
# Shingles that a task remembers while it confirms pairs; rows of an Arrow batch of whole
# texts, and bytes of them that are handled at a time.
REMEMBERED, BATCH_ROWS, HELD = 1_000_000, 1_000, 4_000_000

_PAIRS = 0x5555555555555555


def hash_functions(level: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers and masks of a level's values; all levels have values of their own."""
    depth, trees = LEVELS[level]
    odd = np.random.default_rng(20 + 2 * level).integers(1 << 62, size=depth * trees, dtype=np.uint64)
    xor = np.random.default_rng(21 + 2 * level).integers(1 << 63, size=depth * trees, dtype=np.uint64)
    return (odd << np.uint64(1)) | np.uint64(1), xor


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 100_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def shingles(words: list[bytes], k: int, hashes: _WordHashes) -> np.ndarray:
    """Distinct 64-bit hashes of all runs of ``k`` words, sorted; of fewer words, one of them all."""
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    run = min(k, len(h))
    total = np.full(len(h) - run + 1, run, np.uint64)
    for i in range(run):
        total = _mixed(total * np.uint64(0x9E3779B97F4A7C15) + h[i : len(h) - run + 1 + i])
    return np.unique(total)


def words_of(text: str) -> list[bytes]:
    """A-Z lower-cased, then the runs of anything but ASCII white space."""
    return text.encode("utf-8").lower().split()


def signature(own: np.ndarray, odd: np.ndarray, xor: np.ndarray) -> np.ndarray:
    """The upper halves of the least value of each hash function; in pieces, so that memory is bounded."""
    least = np.full(len(odd), np.iinfo(np.uint64).max, np.uint64)
    step = max(1, 300_000 // len(odd))
    for start in range(0, len(own), step):
        some = own[start : start + step]
        np.minimum(least, ((some[None, :] ^ xor[:, None]) * odd[:, None]).min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def sketch(values: np.ndarray) -> tuple[int, int]:
    """Two bits of each of the first 64 values, as two signed 64-bit numbers."""
    bits = ((values[:64].astype(np.uint64) * np.uint64(0x9E3779B1)) >> np.uint64(9)) & np.uint64(3)
    halves = (bits.reshape(2, 32) << (np.arange(32, dtype=np.uint64) * np.uint64(2))).sum(axis=1, dtype=np.uint64)
    return tuple(halves.view(np.int64).tolist())


def parity(own: np.ndarray) -> np.ndarray:
    """Per bit, whether an odd number of shingles falls on it.

    Of two sets, each shingle that only one of them has flips one bit, so the
    bits that differ are never more than the shingles that differ: where they are
    more than a link allows, there is no link.
    """
    counts = np.bincount((own >> np.uint64(20)).astype(np.int64) % (64 * PARITY), minlength=64 * PARITY)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def _sets(k: int):
    import hashlib

    names = ["doc_id", "n_shingles", "set_key", "packed", "signature", "s0", "s1", "odd"]
    functions = hash_functions(0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=1).compress
        hashes = _WordHashes()
        for part in by_bytes(batches, "text", HELD):
            n, keys, packed, signatures, s0, s1, odd = [], [], [], [], [], [], []
            for text in part.column("text"):
                words = words_of(text.as_py())
                own = shingles(words, k, hashes)
                values = signature(own, *functions)
                a, b = sketch(values)
                n.append(len(own))
                keys.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
                packed.append(pack(b" ".join(words)))
                signatures.append(values.view(np.int32))
                s0.append(a)
                s1.append(b)
                odd.append(parity(own))
            columns = [
                part.column("doc_id"),
                pa.array(n, pa.int64()),
                pa.array(keys, pa.binary()),
                pa.array(packed, pa.binary()),
                pa.array(signatures, pa.list_(pa.int32())),
                pa.array(s0, pa.int64()),
                pa.array(s1, pa.int64()),
                pa.array(odd, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _deeper(k: int, level: int):
    """The values of a deeper level, from packed words."""
    functions = hash_functions(level)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        hashes = _WordHashes()
        for part in by_bytes(batches, "packed", HELD // 8):
            values = [
                signature(shingles(unpack(p.as_py()).split(), k, hashes), *functions).view(np.int32)
                for p in part.column("packed")
            ]
            arrays = [part.column("id"), pa.array(values, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "signature"])

    return run


def _value(tree: Column, depth: int, values: int, i: int) -> Column:
    """The ``i``-th value of a tree's order; beyond its own values it goes on with those of the next trees."""
    return F.element_at("signature", ((tree * depth + i) % values + 1).cast("int"))


def _region(tree: Column, depth: int, values: int) -> Column:
    """Hash of the tree and the first ``depth`` values of its order."""
    return F.xxhash64(tree, *[_value(tree, depth, values, i) for i in range(depth)])


def _entries(sets: DataFrame) -> DataFrame:
    """One row per set and tree: its region, how it goes on from there, and its sketch."""
    tree = F.col("tree")
    rows = sets.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))))
    on = [_value(tree, DEPTH, VALUES, DEPTH + i).alias(f"v{i}") for i in range(BEYOND)]
    return rows.select(_region(tree, DEPTH, VALUES).alias("region"), *on, "rep", "s0", "s1")


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of rows at most ``AHEAD`` apart in one region, and the values they share beyond it.

    Pairs whose sketches rule out a link are left out.
    """
    names = ["region", "rep", "s0", "s1", *[f"v{i}" for i in range(BEYOND)]]
    held = [np.zeros(0, np.int64) for _ in names]
    for batch in batches:
        here = [np.concatenate([old, batch.column(n).to_numpy()]) for old, n in zip(held, names)]
        region, rep, s0, s1, *on = here
        found = []
        for gap in range(1, AHEAD + 1):
            # Rows held from the batch before were already compared with each other.
            first = max(0, len(held[0]) - gap)
            left, right = slice(first, len(rep) - gap), slice(first + gap, len(rep))
            if len(rep) <= first + gap:
                continue
            agree = _agreeing(s0[left], s0[right]) + _agreeing(s1[left], s1[right])
            good = (region[left] == region[right]) & (agree >= AGREE)
            same = np.cumprod([v[left] == v[right] for v in on], axis=0).sum(axis=0)
            found.append((rep[left][good], rep[right][good], same[good]))
        held = [column[-AHEAD:] for column in here]
        if found:
            columns = [pa.array(np.concatenate(c), pa.int64()) for c in zip(*found)]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b", "prefix"])


def _agreeing(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    odd = x ^ y
    return 32 - np.bitwise_count((odd | (odd >> 1)) & _PAIRS).astype(np.int64)


def _agreement(left: str, right: str) -> Column:
    """The same as a column: how many of a pair of sketches' 64 values agree."""
    total = F.lit(64)
    for s in ("s0", "s1"):
        odd = F.col(f"{left}.{s}").bitwiseXOR(F.col(f"{right}.{s}"))
        total = total - F.bit_count(odd.bitwiseOR(F.shiftrightunsigned(odd, 1)).bitwiseAND(F.lit(_PAIRS)))
    return total


def _neighbour_pairs(sets: DataFrame) -> DataFrame:
    """Some neighbours of each set over all trees, as pairs ``a < b``.

    Those with the longest common prefix, and some drawn by a hash: the longest
    prefixes alone would tie a large group together in many small knots and leave
    the pairs between the knots to the second step.
    """
    from pyspark.sql import Window

    entries = _entries(sets)
    order = ["region", *[f"v{i}" for i in range(BEYOND)], "rep"]
    partitions = max(
        int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions")), sets.rdd.getNumPartitions() * 4
    )
    found = (
        entries.repartitionByRange(partitions, *order)
        .sortWithinPartitions(*order)
        .mapInArrow(_neighbours, "a bigint, b bigint, prefix bigint")
        .filter("a <> b")
        .groupBy("a", "b")
        .agg(F.max("prefix").alias("prefix"))
    )
    # A set has at most 2 * AHEAD neighbours per tree, so these groups are small.
    either = found.union(found.select("b", "a", "prefix"))
    own = Window.partitionBy("a")
    ranked = either.select(
        "a",
        "b",
        F.row_number().over(own.orderBy(F.xxhash64("a", "b"), "b")).alias("draw"),
        F.row_number().over(own.orderBy(F.desc("prefix"), "b")).alias("place"),
    ).filter((F.col("draw") <= DRAWN) | (F.col("place") <= ALIKE))
    return ranked.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _possible_pairs(sets: DataFrame, similar: int, values: Callable[[DataFrame, int], DataFrame]) -> DataFrame:
    """Pairs ``a < b`` of different components that share a region and may be similar enough.

    ``sets``: ``rep, n_shingles, s0, s1, odd, component, signature``. ``values`` gives
    ``id, signature`` of the sets ``rep`` for a deeper level. Regions are found and
    dealt with as rows of three numbers; sketches join those that are left.
    """
    bits = [F.get("odd", F.lit(i)).alias(f"o{i}") for i in range(PARITY)]
    judged = sets.select("rep", "n_shingles", "s0", "s1", "component", *bits)
    here = sets.select("rep", "component", "signature")
    found = []
    for level, (depth, trees) in enumerate(LEVELS):
        tree = F.col("tree")
        rows = here.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))).select(
            _region(tree, depth, depth * trees).alias("region"), "rep", "component"
        )
        several = (
            rows.groupBy("region")
            .agg(F.count(F.lit(1)).alias("n"), F.min("component").alias("least"), F.max("component").alias("most"))
            .filter("least < most")
            .select("region", "n")
        )
        members = stored(rows.join(several, "region"), "neardup-members")
        crowded, main = _crowded(members)
        last = level == len(LEVELS) - 1
        pairs = _matching(members.join(crowded, "region", "left_anti"), main, judged, similar)
        if last:
            pairs = pairs.union(_in_blocks(members.join(crowded, "region", "left_semi"), judged, similar))
        found.append(stored(pairs.distinct(), "neardup-possible"))
        onward = stored(members.join(crowded, "region", "left_semi").select("rep").distinct(), "neardup-onward")
        for used in (members, crowded, main):
            drop_stored(used)
        if last or onward.isEmpty():
            break
        deeper = values(onward, level + 1)
        here = stored(
            deeper.join(here.select("rep", "component"), F.col("id") == F.col("rep")).select("rep", "component", "signature"),
            "neardup-deeper",
        )
    every = found[0]
    for more in found[1:]:
        every = every.union(more)
    return every.distinct()


def _crowded(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``region`` of regions with too many sets outside their largest component; ``region, main`` of the other large ones."""
    sizes = members.filter(F.col("n") > CROWD).groupBy("region", "component").agg(F.count(F.lit(1)).alias("size"))
    # Components of a region, counted; large regions are few.
    largest = sizes.groupBy("region").agg(
        F.sum("size").alias("n"), F.max(F.struct("size", "component")).alias("largest")
    )
    largest = stored(
        largest.select("region", "n", F.col("largest.component").alias("main"), F.col("largest.size").alias("size")),
        "neardup-large",
    )
    outside = F.col("n") - F.col("size")
    crowded = stored(largest.filter(outside > CROWD).select("region"), "neardup-crowded")
    main = stored(largest.filter(outside <= CROWD).select("region", "main"), "neardup-main")
    drop_stored(largest)
    return crowded, main


def _matching(members: DataFrame, main: DataFrame, judged: DataFrame, similar: int) -> DataFrame:
    """Possible pairs of regions: everything against what lies outside the region's largest component."""
    placed = members.join(main, "region", "left").select(
        "region", "rep", F.col("component").eqNullSafe(F.col("main")).alias("inside")
    )
    sketched = placed.join(_shared(members), "rep").join(judged, "rep")
    once = F.col("x.inside") | (F.col("x.rep") < F.col("y.rep"))
    return _judged(sketched, sketched.filter("NOT inside"), (F.col("x.region") == F.col("y.region")) & once, similar)


def _in_blocks(members: DataFrame, judged: DataFrame, similar: int) -> DataFrame:
    """Possible pairs of crowded regions: dealt into blocks of ``BLOCK`` sets, every block meets every other."""
    dealt = members.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    met = dealt.select(
        "region",
        "rep",
        F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"),
    )
    met = met.select(
        "region", "rep", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    )
    met = met.join(_shared(members), "rep").join(judged, "rep")
    same = [F.col(f"x.{c}") == F.col(f"y.{c}") for c in ("region", "low", "high")]
    # Sets of one block meet where it stands alone.
    once = (F.col("x.block") != F.col("y.block")) | (F.col("x.low") == F.col("x.high"))
    return _judged(met, met, same[0] & same[1] & same[2] & once & (F.col("x.rep") < F.col("y.rep")), similar)


def _shared(members: DataFrame) -> DataFrame:
    """``rep, shared``: the regions each set is compared in, one per tree at most.

    A pair that shares several is told in the least of them only.
    """
    return members.groupBy("rep").agg(F.collect_set("region").alias("shared"))


def _judged(left: DataFrame, right: DataFrame, together: Column, similar: int) -> DataFrame:
    """Pairs of rows that components, sizes, sketches and parity leave possible."""
    smaller, larger = (f("x.n_shingles", "y.n_shingles") for f in (F.least, F.greatest))
    differ = sum((F.bit_count(F.col(f"x.o{i}").bitwiseXOR(F.col(f"y.o{i}"))) for i in range(PARITY)), F.lit(0))
    may = (
        together
        & (F.col("x.component") != F.col("y.component"))
        & (smaller * 100 >= larger * similar)
        & (_agreement("x", "y") >= AGREE)
        & (differ * (100 + similar) <= (smaller + larger) * (100 - similar))
        & (F.col("x.region") == F.array_min(F.array_intersect("x.shared", "y.shared")))
    )
    return left.alias("x").join(right.alias("y"), may).select(
        F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b")
    )


def _confirmed(k: int, similar: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        hashes = _WordHashes()
        # The sets met so far, by their packed words: members of a group come again and again.
        known: dict[bytes, np.ndarray] = {}
        held = 0

        def set_of(packed: bytes) -> np.ndarray:
            nonlocal held
            found = known.get(packed)
            if found is None:
                if held > REMEMBERED:
                    known.clear()
                    held = 0
                found = known[packed] = shingles(unpack(packed).split(), k, hashes)
                held += len(found) + len(packed) // 8
            return found

        for part in by_bytes(batches, "text_b", HELD):
            good = []
            for one, other in zip(part.column("text_a"), part.column("text_b")):
                x, y = sorted((set_of(one.as_py()), set_of(other.as_py())), key=len)
                at = np.searchsorted(y, x)
                common = int((y[np.minimum(at, len(y) - 1)] == x).sum()) if len(y) else 0
                good.append(100 * common >= similar * (len(x) + len(y) - common))
            kept = part.select(["a", "b"]).filter(pa.array(good, pa.bool_()))
            yield kept

    return run


def confirm(pairs: DataFrame, texts: DataFrame, k: int, similar: int) -> DataFrame:
    """The ``pairs`` (``a, b``) whose full shingle sets are similar enough.

    ``texts``: ``row`` and ``packed`` words; both of its uses share one shuffle.
    """
    left = texts.select(F.col("row").alias("id"), F.col("packed").alias("text_a"))
    right = texts.select(F.col("row").alias("id"), F.col("packed").alias("text_b"))
    both = (
        pairs.join(left, F.col("a") == F.col("id"))
        .select("a", "b", "text_a")
        .join(right, F.col("b") == F.col("id"))
        .select("a", "b", "text_a", "text_b")
    )
    return both.mapInArrow(_confirmed(k, similar), "a bigint, b bigint")


@contextmanager
def _small_batches(spark: SparkSession):
    """Arrow batches of few rows, for jobs whose rows are whole texts; they are cut by rows only."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def near_duplicates(documents: DataFrame, words: int = WORDS, similar: int = SIMILAR) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``documents``.

    Two documents are linked if 100 * |A and B| >= ``similar`` * |A or B| for
    their sets of ``words``-word shingles; ``component_id`` is the smallest
    ``doc_id`` that links lead to.

    A null or blank text has the empty set, is linked with nothing and is kept.
    With fewer words than a shingle has, all words are one shingle. Equal sets
    are linked. Rows with the same ``doc_id`` are one document and share its
    component. A row with a null ``doc_id`` is a document without a number: it is linked
    like any other, and its component is null if no other of it has one. An empty table
    gives no rows; other columns are neither read nor returned.
    """
    spark = documents.sparkSession
    source = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    schema = (
        "doc_id bigint, n_shingles bigint, set_key binary, packed binary, signature array<int>, "
        "s0 bigint, s1 bigint, odd array<bigint>"
    )
    with _small_batches(spark):
        sets_of_rows = source.mapInArrow(_sets(words), schema).withColumn("row", F.monotonically_increasing_id())
        all_sets = stored(sets_of_rows, "neardup-sets")
    # Equal sets are one from here on, named by the first of their rows, whose number is
    # written down with it. What else stands for the set is the same in all of them.
    of_set = ("n_shingles", "signature", "s0", "s1", "odd")
    reps = stored(
        all_sets.filter("n_shingles > 0")
        .groupBy("set_key")
        .agg(F.min("row").alias("rep"), *[F.first(c).alias(c) for c in of_set]),
        "neardup-reps",
    )
    classes = reps.select(F.col("set_key").alias("class_key"), "rep")
    named = stored(
        all_sets.select("doc_id", "n_shingles", "set_key")
        .join(classes, F.col("set_key") == F.col("class_key"), "left")
        .select("doc_id", "n_shingles", "rep"),
        "neardup-named",
    )
    sets = reps.drop("set_key")
    texts = all_sets.select("row", "packed")

    def values(onward: DataFrame, level: int) -> DataFrame:
        rows = texts.join(onward, F.col("row") == F.col("rep"), "left_semi")
        return rows.withColumnRenamed("row", "id").mapInArrow(_deeper(words, level), "id bigint, signature array<int>")

    with _small_batches(spark):
        near = stored(_neighbour_pairs(sets), "neardup-neighbours")
        links = stored(confirm(near, texts, words, similar).union(_same_document(named)), "neardup-links")
        first = components(links)
        labelled = stored(
            sets.join(first, F.col("rep") == F.col("node"), "left").select(
                *sets.columns, F.coalesce("component", "rep").alias("component")
            ),
            "neardup-labelled",
        )
        pairs = stored(_possible_pairs(labelled, similar, values), "neardup-pairs")
        more = stored(confirm(pairs, texts, words, similar), "neardup-links")
    found = components(links.union(more))
    for used in (near, links, first, labelled, pairs, more):
        drop_stored(used)

    joined = named.join(found, F.col("rep") == F.col("node"), "left").withColumn(
        "linked", F.coalesce("component", "rep")
    )
    smallest = joined.groupBy("linked").agg(F.min("doc_id").alias("smallest")).filter("linked IS NOT NULL")
    result = joined.select("doc_id", "n_shingles", F.col("linked").alias("own")).join(
        smallest, F.col("own") == F.col("linked"), "left"
    )
    # An empty set is linked with nothing.
    component = F.when(F.col("own").isNull(), F.col("doc_id")).otherwise(F.col("smallest"))
    return result.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def _same_document(named: DataFrame) -> DataFrame:
    """Links between the sets of documents that are listed with several texts."""
    listed = named.filter("doc_id IS NOT NULL AND rep IS NOT NULL").groupBy("doc_id")
    several = listed.agg(F.min("rep").alias("a"), F.max("rep").alias("last")).filter("a < last").select("doc_id", "a")
    others = named.select(F.col("doc_id").alias("listed"), F.col("rep").alias("b"))
    pairs = several.join(others, F.col("doc_id") == F.col("listed")).filter("a < b")
    return pairs.select("a", "b").distinct()


def drop_near_duplicates(documents: DataFrame, words: int = WORDS, similar: int = SIMILAR) -> DataFrame:
    """The rows of ``documents`` that ``near_duplicates`` keeps, all columns unchanged."""
    key = free_name("kept_id", documents)
    kept = near_duplicates(documents, words, similar).filter("kept").select(F.col("doc_id").alias(key)).distinct()
    return documents.join(kept, documents["doc_id"].eqNullSafe(F.col(key)), "left_semi")
