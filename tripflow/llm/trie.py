"""The prefix trie of rebuilt conversations, by a depth-band rollup.

A node is a distinct sequence of first turns; its members are the conversations
that start with it, so the smallest member and the depth name it. Bands of
``BAND`` depths bound the work in three places:

- Keys. The key of a prefix is a digest of the key of its last full band and the
  turns after it. Bands of turns make a shorter sequence of digests, whose keys
  are found the same way; a conversation of any length takes some log_BAND steps.
- Explosion. For totals over subtrees a node is repeated only for its ancestors
  within its own band, ``BAND`` at most.
- Rounds. The tops of bands make a tree that is ``BAND`` times less deep; the same
  rollup gives their complete totals, which then reach the nodes of the band above
  them in one step.

No step gathers the members of a node: counts and sums are formed per task
first, and a conversation with very many turns is numbered over many tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripflow.llm.common import stored, text_of

# Depths of a band.
BAND = 8
# Conversations come in families of this many, whose first one lends its first
# turns to all; fewer than HEADS of them.
FAMILY, HEADS = 5, 9
# Ids of a node that are joined to one string before they are shuffled.
CHUNK = 500
ROOT = ""


def trie_nodes(conversations: DataFrame, band: int = BAND) -> DataFrame:
    """One row per node of the trie of all rebuilt conversations.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``.

    Turns are ordered by ``turn``, null first; equal turns by a digest of role and
    text, so that reruns agree, and a repeated row is a turn of its own. A null
    role or text is empty. Rows without ``conv_id`` belong to no conversation and
    are left out. A conversation whose rebuilt form has no turn is a member of the
    root only. An empty table has no members, so no root: no rows. Other columns
    are neither read nor returned.
    """
    turns, convs = _rebuilt(conversations)
    deepest = convs.agg(F.max("length").alias("d")).first().d
    if deepest is None:
        return _empty(conversations.sparkSession)
    blocks = stored(_keyed(turns, deepest, band), "trie-blocks")
    members = _members(blocks, band)
    named = members.groupBy("key").agg(
        F.min("conv").alias("conv"),
        F.first("depth").alias("depth"),
        F.first("parent").alias("parent"),
        F.count(F.lit(1)).alias("n_convs"),
        F.first("bytes").alias("bytes"),
    )
    top = convs.agg(
        F.min("conv").alias("conv"),
        F.lit(0).cast("bigint").alias("depth"),
        F.lit(None).cast("string").alias("parent"),
        F.count(F.lit(1)).alias("n_convs"),
        F.lit(0).cast("bigint").alias("bytes"),
    )
    nodes = stored(top.select(F.lit(ROOT).alias("key"), *top.columns).union(named), "trie-nodes")
    children = nodes.filter("parent IS NOT NULL").groupBy("parent").agg(F.count(F.lit(1)).alias("n_children"))
    weighed = stored(
        nodes.join(children.withColumnRenamed("parent", "key"), "key", "left").select(
            "key",
            "conv",
            "depth",
            "parent",
            "n_convs",
            F.coalesce("n_children", F.lit(0)).alias("n_children"),
            ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
            F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("bigint").alias("leaves"),
        ),
        "trie-weighed",
    )
    paths = blocks.select("conv", "block", "keys")
    below = weighed.filter("depth > 0").select("key", "conv", F.col("depth").alias("pos"), "saved", "leaves")
    totals = _subtree_totals(paths, below, deepest, band)
    # The root stands above all bands; its total is that of all nodes.
    whole = weighed.agg(F.lit(ROOT).alias("key"), F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))
    ends = _ends_digests(
        members.join(convs, "conv").filter(F.col("depth") == F.col("length")).select("key", "conv")
        .union(convs.filter("length = 0").select(F.lit(ROOT), "conv"))
    )
    result = (
        _with_parent(weighed)
        .join(totals.union(whole).toDF("key", "saved_tokens", "n_leaves"), "key")
        .join(ends, "key", "left")
    )
    return result.select(
        F.col("conv").alias("conv_id"),
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def rebuilt_turns(conversations: DataFrame) -> DataFrame:
    """``conv, pos, digest, bytes`` of every turn of the rebuilt conversations, positions from 1 on."""
    return _rebuilt(conversations)[0]


def _empty(spark) -> DataFrame:
    longs = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
    return spark.range(0).select(*[F.lit(0).cast("bigint").alias(c) for c in longs], F.lit("").alias("ends_sha256"))


def _digest(value: Column) -> Column:
    """128 bits of SHA-256, as hexadecimal digits."""
    return F.substring(F.sha2(value, 256), 1, 32)


def _parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _numbered(conversations: DataFrame) -> DataFrame:
    """``conv, pos, digest, bytes`` of the turns as given.

    Sorted over all conversations and cut into slices, so that one that holds a
    third of all turns is numbered by many tasks. At most one conversation goes on
    from a slice to the next one, so fewer than twice as many rows as slices say how
    many turns of it came before.
    """
    role, text = text_of("role"), text_of("text")
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv"),
        "turn",
        _digest(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("digest"),
        F.octet_length(text).cast("bigint").alias("bytes"),
    )
    ordered = stored(
        rows.repartitionByRange(_parts(rows), "conv", "turn", "digest").withColumn("slice", F.spark_partition_id()),
        "trie-turns",
    )
    sizes = ordered.groupBy("conv", "slice").agg(F.count(F.lit(1)).alias("n"))
    slices = Window.partitionBy("conv")
    earlier = slices.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    crossing = (
        sizes.withColumn("slices", F.count(F.lit(1)).over(slices))
        .withColumn("before", F.sum("n").over(earlier))
        .filter("slices > 1")
        .select("conv", "slice", "before")
    )
    number = F.row_number().over(Window.partitionBy("conv", "slice").orderBy("turn", "digest"))
    return (
        ordered.withColumn("number", number)
        .join(F.broadcast(crossing), ["conv", "slice"], "left")
        .select("conv", (F.col("number") + F.coalesce("before", F.lit(0))).alias("pos"), "digest", "bytes")
    )


def _rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns, and ``conv, length`` of every conversation, both stored."""
    turns = stored(_numbered(conversations), "trie-numbered")
    sizes = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n"))
    head = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(HEADS))
    counted = sizes.select("conv", "n", head.alias("head"), (F.col("conv") - F.col("conv") % FAMILY).alias("first"))
    lenders = sizes.select(F.col("conv").alias("lender"), F.col("n").alias("lent"))
    # The first of a family lends to itself what it has.
    cut = F.least("head", F.coalesce("lent", F.lit(0)))
    convs = stored(
        counted.join(lenders, F.col("first") == F.col("lender"), "left")
        .withColumn("cut", cut)
        .select(
            "conv", "first", "head", "cut", (F.col("cut") + F.greatest(F.col("n") - F.col("head"), F.lit(0))).alias("length")
        ),
        "trie-conversations",
    )
    own = (
        turns.join(convs.select("conv", "head", "cut"), "conv")
        .filter("pos > head")
        .select("conv", (F.col("pos") - F.col("head") + F.col("cut")).alias("pos"), "digest", "bytes")
    )
    lent = turns.filter(F.col("pos") < HEADS).withColumnRenamed("conv", "lender")
    borrowed = (
        convs.filter("cut > 0")
        .select("conv", "first", "cut")
        .join(lent, (F.col("first") == F.col("lender")) & (F.col("pos") <= F.col("cut")))
        .select("conv", "pos", "digest", "bytes")
    )
    return stored(own.union(borrowed), "trie-rebuilt"), convs.select("conv", "length")


def _in_bands(steps: DataFrame, band: int, *columns: str) -> DataFrame:
    """``conv, block`` and the ``steps`` of that band in order: at most ``band`` of them."""
    block = F.floor((F.col("pos") - 1) / band).cast("bigint")
    return steps.groupBy("conv", block.alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("pos", *columns))).alias("steps")
    )


def _keyed(turns: DataFrame, deepest: int, band: int, level: int = 0) -> DataFrame:
    """``conv, block, above, keys, bytes``: the keys of a band's prefixes, and of the prefix before it.

    ``above`` is null in the first band. Keys of different lengths differ, as they
    name their level, the key before the band and the steps since.
    """
    blocks = _in_bands(turns, band, "digest", "bytes")
    if deepest > band:
        blocks = stored(blocks, "trie-steps")
        full = blocks.filter(F.size("steps") == band).select(
            "conv",
            (F.col("block") + 1).alias("pos"),
            _digest(F.array_join("steps.digest", "")).alias("digest"),
            F.lit(0).cast("bigint").alias("bytes"),
        )
        known = stored(_members(_keyed(full, deepest // band, band, level + 1), band), "trie-prefixes")
        known = known.select(F.col("conv").alias("own"), F.col("depth").alias("full"), "key")
        blocks = (
            blocks.join(known, (F.col("conv") == F.col("own")) & (F.col("block") == F.col("full")), "left")
            .select("conv", "block", "steps", F.col("key").alias("above"))
            .join(known, (F.col("conv") == F.col("own")) & (F.col("block") + 1 == F.col("full")), "left")
            .select("conv", "block", "steps", "above", F.col("key").alias("last"))
        )
    else:
        blocks = blocks.select("*", *[F.lit(None).cast("string").alias(c) for c in ("above", "last")])

    def key(n: Column) -> Column:
        since = F.array_join(F.slice(F.col("steps.digest"), 1, n), "")
        own = _digest(F.concat(F.lit(f"{level}:"), F.coalesce("above", F.lit("")), F.lit(":"), since))
        return F.when((n == band) & F.col("last").isNotNull(), F.col("last")).otherwise(own)

    return blocks.select(
        "conv",
        "block",
        "above",
        F.transform(F.sequence(F.lit(1), F.size("steps")), key).alias("keys"),
        F.col("steps.bytes").alias("bytes"),
    )


def _members(blocks: DataFrame, band: int) -> DataFrame:
    """``conv, depth, key, parent, bytes``: a row for every prefix of every conversation."""
    return blocks.select("conv", "block", "above", "keys", "bytes", F.posexplode("keys").alias("at", "key")).select(
        "conv",
        (F.col("block") * band + F.col("at") + 1).alias("depth"),
        "key",
        F.when(F.col("at") > 0, F.get("keys", F.col("at") - 1))
        .otherwise(F.coalesce("above", F.lit(ROOT)))
        .alias("parent"),
        F.get("bytes", F.col("at")).alias("bytes"),
    )


def _subtree_totals(paths: DataFrame, nodes: DataFrame, deepest: int, band: int) -> DataFrame:
    """``key, saved, leaves`` summed over the subtree of every node of ``nodes``.

    ``nodes``: ``key, conv, pos, saved, leaves``, where ``pos`` is the depth and
    ``conv`` any member; ``paths``: ``conv, block, keys``, the keys of each
    conversation's prefixes by bands.
    """
    placed = nodes.withColumn("block", F.floor((F.col("pos") - 1) / band).cast("bigint")).withColumn(
        "place", ((F.col("pos") - 1) % band + 1).cast("int")
    )
    within = _sums(
        placed.join(paths, ["conv", "block"]).select(
            F.explode(F.slice("keys", 1, F.col("place"))).alias("key"), "saved", "leaves"
        )
    )
    if deepest <= band:
        return within
    within = stored(within, "trie-within")
    tops = stored(
        placed.filter("place = 1")
        .select("key", "conv", (F.col("block") + 1).alias("pos"))
        .join(within, "key"),
        "trie-tops",
    )
    steps = paths.select("conv", (F.col("block") + 1).alias("pos"), F.get("keys", F.lit(0)).alias("key"))
    shorter = _in_bands(steps, band, "key").select("conv", "block", F.col("steps.key").alias("keys"))
    complete = stored(_subtree_totals(stored(shorter, "trie-paths"), tops, -(-deepest // band), band), "trie-complete")
    arriving = (
        complete.join(tops.filter("pos > 1").select("key", "conv", (F.col("pos") - 2).alias("block")), "key")
        .join(paths, ["conv", "block"])
        .select(F.explode("keys").alias("key"), "saved", "leaves")
    )
    return _sums(within.union(arriving))


def _sums(rows: DataFrame) -> DataFrame:
    return rows.groupBy("key").agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))


def _with_parent(nodes: DataFrame) -> DataFrame:
    """``nodes`` with ``parent_conv_id``; below the root, which may have any number of children, without a join."""
    columns = ["key", "conv", "depth", "n_convs", "n_children"]
    root = nodes.filter("depth = 0").select("conv").scalar()
    top = nodes.filter("depth <= 1").select(*columns, F.when(F.col("depth") == 1, root).alias("parent_conv_id"))
    parents = nodes.select(F.col("key").alias("parent"), F.col("conv").alias("parent_conv_id"))
    deep = nodes.filter("depth > 1").join(parents, "parent").select(*columns, "parent_conv_id")
    return top.union(deep)


def _ends_digests(ends: DataFrame) -> DataFrame:
    """``key, ends_sha256`` of ``key, conv``: the ids of each key in ascending order, joined by commas.

    Sorted over all tasks; each joins up to ``CHUNK`` ids of a key to one string, and
    only these strings go to the task that digests the key, one after another.
    """
    chunks = (
        ends.repartitionByRange(_parts(ends), "key", "conv")
        .sortWithinPartitions("key", "conv")
        .mapInArrow(_chunked, "key string, first bigint, ids string")
    )
    return (
        stored(chunks, "trie-ends")
        .repartition("key")
        .sortWithinPartitions("key", "first")
        .mapInArrow(_digested, "key string, ends_sha256 string")
    )


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["key", "first", "ids"]
    key, ids = None, []
    for batch in batches:
        done = []
        for k, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if ids and (k != key or len(ids) == CHUNK):
                done.append((key, ids[0], ",".join(map(str, ids))))
                ids = []
            key = k
            ids.append(conv)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names)
    if ids:
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (key, ids[0], ",".join(map(str, ids)))], names)


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["key", "ends_sha256"]
    key, state = None, None
    for batch in batches:
        done = []
        for k, ids in zip(batch.column(0).to_pylist(), batch.column(2)):
            if state is not None and k == key:
                state.update(b",")
            else:
                if state is not None:
                    done.append((key, state.hexdigest()))
                key, state = k, hashlib.sha256()
            state.update(ids.as_py().encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names)
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([state.hexdigest()])], names)


# The checksum of the decimal id, bit by bit: 256 stands for a shift by one bit.
_CRC = """
    xor(4294967295, list_reduce(
        list_prepend(4294967295::UBIGINT, flatten(list_transform(
            string_split(conv::VARCHAR, ''),
            lambda x: list_concat([ascii(x)::UBIGINT], list_transform(range(8), lambda i: 256::UBIGINT))
        ))),
        lambda c, e: CASE WHEN e = 256 THEN xor(c >> 1, 3988292384::UBIGINT * (c & 1)) ELSE xor(c, e) END
    ))
"""

SQL = f"""
    WITH given AS (
        SELECT conv_id AS conv, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
               sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest
        FROM conversations WHERE conv_id IS NOT NULL
    ), turns AS (
        SELECT conv, digest, strlen(text) AS bytes,
               row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, digest) AS pos
        FROM given
    ), sizes AS (
        SELECT conv, count(*) AS n, conv - conv % {FAMILY} AS first FROM turns GROUP BY conv
    ), convs AS (
        SELECT s.conv, s.first, s.n, ({_CRC.replace("conv", "s.conv")} % {HEADS})::BIGINT AS head, coalesce(l.n, 0) AS lent
        FROM sizes s LEFT JOIN sizes l ON s.first = l.conv
    ), rebuilt AS (
        SELECT conv, digest, bytes, pos + least(head, lent) - head AS pos FROM turns JOIN convs USING (conv) WHERE pos > head
        UNION ALL
        SELECT c.conv, digest, bytes, pos FROM convs c JOIN turns t ON t.conv = c.first AND pos <= head
    ), paths AS (
        SELECT conv, pos AS depth, bytes,
               string_agg(digest, '') OVER (PARTITION BY conv ORDER BY pos) AS path
        FROM rebuilt
        UNION ALL
        SELECT conv, 0, 0, '' FROM convs
    ), nodes AS (
        SELECT path, depth, min(conv) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes
        FROM paths GROUP BY path, depth
    ), families AS (
        SELECT n.*, p.path AS parent
        FROM nodes n LEFT JOIN paths p ON p.conv = n.conv_id AND p.depth = n.depth - 1
    ), children AS (
        SELECT parent, count(*) AS n_children FROM families WHERE parent IS NOT NULL GROUP BY parent
    ), totals AS (
        SELECT p.path, sum((n_convs - 1) * n.bytes)::BIGINT AS saved_tokens,
               count(*) FILTER (c.parent IS NULL) AS n_leaves
        FROM nodes n JOIN paths p ON p.conv = n.conv_id AND p.depth <= n.depth
        LEFT JOIN children c ON c.parent = n.path
        GROUP BY p.path
    ), lengths AS (
        SELECT conv, max(depth) AS depth FROM paths GROUP BY conv
    ), ends AS (
        SELECT path, sha256(string_agg(conv::VARCHAR, ',' ORDER BY conv)) AS ends_sha256
        FROM paths JOIN lengths USING (conv, depth) GROUP BY path
    )
    SELECT f.conv_id, f.depth, p.conv_id AS parent_conv_id, f.n_convs, coalesce(n_children, 0) AS n_children,
           n_leaves, saved_tokens, coalesce(ends_sha256, sha256('')) AS ends_sha256
    FROM families f
    JOIN totals USING (path)
    LEFT JOIN nodes p ON p.path = f.parent
    LEFT JOIN children c ON c.parent = f.path
    LEFT JOIN ends e ON e.path = f.path
"""
