"""The text operators against brute force, and on awkward rows."""

from __future__ import annotations

import base64
import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from tripflow.llm import (
    bpe,
    common,
    components,
    exact,
    html_text,
    lm,
    mixing,
    neardup,
    queries,
    repair,
    toxicity,
    urls,
    winnow,
)

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept boolean, score double, cell int"

LONG = "lorem ipsum dolor " * 20_000
# Nulls in every column, empty and long texts, ties, a repeated row, clashing extra columns.
ROWS = [
    (1, "the same text here again", "en", "a", 24, True, 0.5, 1),
    (2, "the same text here again", "en", None, 24, None, None, None),
    (2, "the same text here again", "en", None, 24, None, None, None),
    (3, None, None, None, None, False, 1.0, 2),
    (4, "", "fr", "b", 0, True, 0.0, 3),
    (5, "  \n\t ", "fr", "b", 5, True, 0.0, 3),
    (6, LONG, "la", "a", len(LONG), True, 0.0, 3),
    (7, "Émile's 日本語 🎉🎉  x\n\n y ", "fr", "b", 20, True, 0.0, 3),
    (None, "no id at all", None, "c", 12, True, 0.0, 3),
    (9, "word", "en", "b", 4, True, 0.0, 3),
    (10, "one two three four five six seven eight nine ten eleven twelve", "en", "a", 60, True, 0.0, 3),
    (11, "One two three four five six seven eight nine ten eleven TWELVE", "en", "a", 60, True, 0.0, 3),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, COLUMNS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], COLUMNS)


def text(row) -> str:
    return row[1] or ""


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, sf_dir, name):
    db = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    cursor = db.execute(queries.oracle_sql()[name])
    columns = sorted(d[0] for d in cursor.description)
    at = [[d[0] for d in cursor.description].index(c) for c in columns]
    close = lambda v: round(v, 6) if isinstance(v, float) else v
    expected = sorted((tuple(close(r[i]) for i in at) for r in cursor.fetchall()), key=repr)
    found = queries.queries()[name](spark, sf_dir)
    assert sorted(found.columns) == columns
    assert sorted((tuple(close(r[c]) for c in columns) for r in found.collect()), key=repr) == expected


# --- exact duplicates


def test_exact_groups(odd):
    found = exact.exact_groups(odd, capacity=2).collect()
    sizes = Counter(map(text, ROWS))
    assert len(found) == len(ROWS)
    for r in found:
        assert r.kept == (r.doc_id == r.keep_id)
    same = {r.doc_id: r for r in found}
    assert (same[1].keep_id, same[1].group_size) == (2, sizes[ROWS[0][1]])
    assert (same[3].keep_id, same[3].group_size, same[4].kept) == (4, 2, True)
    assert same[4].text_sha256 == hashlib.sha256(b"").hexdigest()


def test_drop_exact_copies_keeps_rows_as_they_are(odd, none):
    kept = exact.drop_exact_copies(odd)
    assert kept.columns == odd.columns
    assert {r.doc_id for r in kept.collect()} == {2, 4, 5, 6, 7, None, 9, 10, 11}
    assert exact.drop_exact_copies(none).count() == 0 and exact.exact_groups(none).count() == 0


def test_frequent_digests_are_never_missed(spark):
    rows = [("hot",)] * 400 + [(f"d{i}",) for i in range(800)]
    random.Random(1).shuffle(rows)
    found = exact.frequent_digests(spark.createDataFrame(rows, "digest string").repartition(7), 3)
    assert "hot" in {r.digest for r in found.collect()} and found.count() <= 3


# --- mixing


def test_mixture(odd, none):
    found = mixing.mixture(odd).collect()
    assert len(found) == len(ROWS) and mixing.mixture(none).count() == 0
    assert all(r.taken <= 3 * r.size for r in found)
    assert sorted(map(repr, found)) == sorted(map(repr, mixing.mixture(odd.repartition(5)).collect()))
    assert mixing.mix(odd).columns == odd.columns


def test_mix_meets_its_targets(spark):
    rng = random.Random(2)
    sizes = [int(rng.paretovariate(1.1) * 5) % 3000 + 1 for _ in range(6000)]
    sources = [None if i % 11 == 0 else "hot" if i % 3 == 0 else f"s{i % 5}" for i in range(6000)]
    rows = [(i, "w " * n, s) for i, (n, s) in enumerate(zip(sizes, sources))]
    found = mixing.mixture(spark.createDataFrame(rows, "doc_id bigint, text string, source string"))
    totals = found.groupBy("source_size", "target").agg(F.sum("taken").alias("taken")).collect()
    assert sum(r.target for r in totals) == pytest.approx(sum(sizes), rel=1e-6)
    for r in totals:
        assert r.target <= 3 * r.source_size * (1 + 1e-9)
        assert abs(r.taken - r.target) < max(0.05 * r.target, max(sizes))


# --- fingerprints


def test_winnowing_looks_up_no_neighbours(spark):
    df = spark.createDataFrame([("a b c",)], "text string")
    plan = winnow.with_selected(df, "text", "selected")._jdf.queryExecution().optimizedPlan().toString()
    # Neighbouring hashes meet as shifted arrays; looking them up one by one cost half of the query.
    assert "zip_with(" in plan and "get(" not in plan


def test_short_texts_are_told_by_their_beginning(spark):
    few = winnow.SHORT + winnow.GRAM - 2
    texts = ["", " " * 5000, " " * 5000 + "x " * few, " " * 5000 + "x " * (few + 1), "y" * few * winnow.UNIT, "y" * (few * winnow.UNIT + 1)]
    texts += ["é " * few, "é " * (few + 1), "x" * 600, "\n\t".join("abcde" * 3 for _ in range(9)), "z " * 300 + " " * 900]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    found = {r.i: r.short for r in df.select("i", winnow.is_short("text").alias("short")).collect()}
    for i, own in enumerate(texts):
        n = sum(-(-len(w) // winnow.UNIT) for w in own.split())
        assert found[i] == (n - winnow.GRAM + 1 < winnow.SHORT)


def test_winnowing_equals_brute_force(spark):
    rng = random.Random(3)
    words = [rng.choice("ab abc hello winnowing längere x".split()) for _ in range(120)]
    own = " ".join(words)
    df = spark.createDataFrame([(1, own)], "doc_id bigint, text string")
    row = winnow.with_selected(df, "text", "selected").select(winnow.positions_of("selected").alias("p")).first()
    units = [w[i : i + winnow.UNIT] for w in words for i in range(0, len(w), winnow.UNIT)]
    unit = {u: spark.createDataFrame([(u,)], "u string").select(F.xxhash64("u")).first()[0] for u in set(units)}
    grams = []
    for i in range(len(units) - winnow.GRAM + 1):
        total = unit[units[i]] % winnow._PRIME
        for u in units[i + 1 : i + winnow.GRAM]:
            total = (total * winnow._BASE + unit[u] % winnow._PRIME) % winnow._PRIME
        grams.append(total)
    picked = []
    for i in range(len(grams) - winnow.SPAN + 1):
        span = grams[i : i + winnow.SPAN]
        best = max(j for j, g in enumerate(span) if g == min(span))
        if (min(span), i + best) not in picked:
            picked.append((min(span), i + best))
    assert [(x.hash, x.position) for x in row.p] == picked


def test_edited_fingerprints(odd, none):
    found = winnow.edited_fingerprints(odd).collect()
    order = sorted({(r[0] if r[0] is not None else -1, text(r)) for r in ROWS}, key=lambda r: -r[0])
    expected = {}
    for i, (doc_id, own) in enumerate(order):
        cut, following = len(own) // 3, order[(i + 1) % len(order)][1]
        expected[doc_id] = hashlib.sha256((own[: len(own) - cut] + following[:cut]).encode()).hexdigest()
    assert {(-1 if r.doc_id is None else r.doc_id): r.edited_sha256 for r in found} == expected
    assert len(found) == len(ROWS)  # a repeated row is returned each time
    by_id = {r.doc_id: r for r in found}
    for r in found:
        own = [part.split("@") for part in r.selected.split()]
        assert list(dict.fromkeys(h for h, _ in own)) == r.fingerprint.split()
        places = [int(p) for _, p in own]
        assert places == sorted(set(places))
    assert by_id[1].fingerprint == by_id[2].fingerprint and by_id[4].fingerprint == ""
    assert by_id[4].near_next == 1.0 and by_id[2].near_next == 1.0
    assert winnow.edited_fingerprints(none).count() == 0


def test_likeness_across_the_short_limit(spark):
    # 33 and 31 hashes: one text is winnowed, the other is not, and one holds the other.
    longer = " ".join(f"w{i:02d}" for i in range(winnow.SHORT + winnow.GRAM))
    shorter = longer.rsplit(" ", 2)[0]
    df = spark.createDataFrame([(2, longer), (1, shorter)], "doc_id bigint, text string")
    found = {r.doc_id: r for r in winnow.edited_fingerprints(df).collect()}
    assert found[2].near_next == found[1].near_next == pytest.approx((winnow.SHORT - 1) / (winnow.SHORT + 1))
    # The edited text of the shorter one: its first part, then the beginning of the longer one.
    n = len(shorter)
    edited = shorter[: n - n // 3] + longer[: n // 3]
    one, two = ({tuple(w[i : i + winnow.GRAM]) for i in range(len(w) - winnow.GRAM + 1)} for w in (units(shorter), units(edited)))
    assert found[1].near_edited == pytest.approx(len(one & two) / len(one | two))


def units(own):
    return [w[i : i + winnow.UNIT] for w in own.split() for i in range(0, len(w), winnow.UNIT)]


# --- byte-level BPE and token shards


@pytest.fixture(scope="module")
def reference_ids():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda t: encoding.encode_ordinary(t)


def test_bpe_equals_reference(odd, none, reference_ids):
    found = bpe.encode_decode(odd, RANKS, public_tokenizers.PATTERN).collect()
    expected = sorted(((r[0] or 0, reference_ids(text(r)), text(r).encode()) for r in ROWS))
    assert sorted((r.doc_id or 0, list(r.ids), bytes(r.decoded)) for r in found) == expected
    assert bpe.encode_decode_digests(none, RANKS, public_tokenizers.PATTERN).count() == 0


def test_bpe_of_single_pieces(reference_ids):
    duck = bpe.DuckBpe(bpe.read_ranks(RANKS))
    pieces = ["a" * 700, "zzzqqq", " naïve", "日本語テキスト", "\x00\x01", "aaab" * 9]
    ids, sizes = duck.encode([p.encode() for p in pieces])
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == [reference_ids(p) for p in pieces]
    assert duck.decode(ids, sizes) == [p.encode() for p in pieces]


def test_token_shards(spark, odd, none, reference_ids, tmp_path):
    found = {}
    for r in repair.write_and_index(odd, JSON, public_tokenizers.PATTERN).collect():
        found.setdefault(r.doc_id, []).append((r.start, r.n_tokens, r.ids_crc32))
    at, expected = 0, {}
    for row in sorted(ROWS, key=lambda r: -1 if r[0] is None else r[0]):
        ids = reference_ids(text(row)) + [repair.END]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        expected.setdefault(row[0], []).append((at, len(ids), crc))
        at += len(ids)
    assert {k: sorted(v) for k, v in found.items()} == expected
    path = str(tmp_path / "shards")
    repair.write_shards(odd, path, JSON, public_tokenizers.PATTERN)
    assert repair.read_document(spark, path, 7) == reference_ids(text(ROWS[7])) + [repair.END]
    assert repair.write_and_index(none, JSON, public_tokenizers.PATTERN).count() == 0


def test_token_shards_read_special_tokens_as_the_library_does(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(JSON)
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x  <|endoftext|><|endoftext|>\n\n y", "<|endoftext| > no", "plain  text "]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: (r.n_tokens, r.ids_crc32) for r in repair.write_and_index(df, JSON, public_tokenizers.PATTERN).collect()}
    for i, own in enumerate(texts):
        ids = tokenizer.encode(own, add_special_tokens=False).ids + [repair.END]
        assert found[i] == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))


def test_grammar_round_trip():
    rng = np.random.default_rng(4)
    ids = np.concatenate([np.tile([5, 5, 5, 7], 300), rng.integers(0, 9, 5000), np.full(99, 3)]).astype(np.int32)
    starts = np.array([0, 1, 1203, 5000, len(ids) - 1])
    left, right, lengths, symbols, at = repair.compress(ids, starts, 10)
    assert len(symbols) < len(ids) and (repair.expand(symbols, left, right, 10) == ids).all()
    for i, (a, b) in enumerate(zip(starts, np.append(starts[1:], len(ids)))):
        end = at[i + 1] if i + 1 < len(at) else None
        assert (repair.expand(symbols[at[i] : end], left, right, 10) == ids[a:b]).all()
    assert all(lengths[i] == len(repair.expand(np.array([10 + i]), left, right, 10)) for i in range(len(left)))


def test_grammar_counts_each_pair_once(monkeypatch):
    rng = np.random.default_rng(5)
    words = [rng.integers(0, 40, rng.integers(3, 9)) for _ in range(60)]
    ids = np.concatenate([words[i] for i in rng.zipf(1.3, 8000) % 60]).astype(np.int32)
    starts = np.arange(0, len(ids), 700)
    counted, rounds = [], []
    frequent, most = repair._frequent, repair._most
    monkeypatch.setattr(repair, "_frequent", lambda a, b: counted.append(len(a)) or frequent(a, b))
    monkeypatch.setattr(repair, "_most", lambda keys, counts: rounds.append(1) or most(keys, counts))
    monkeypatch.setattr(repair, "PAIRS", 4)
    left, right, _, symbols, _ = repair.compress(ids, starts, 40)
    # A replacement makes two new pairs at most, however many rounds there are.
    assert len(rounds) > 20 and sum(counted) <= len(ids) + 2 * (len(ids) - len(symbols))
    # The rules are those of counting everything anew in every round.
    sequences = [x.tolist() for x in np.split(ids, starts[1:])]
    rules = []
    while True:
        counts = Counter(p for x in sequences for p in zip(x, x[1:]))
        often = sorted((p for p in counts if counts[p] >= repair.LEAST), key=lambda p: (-counts[p], p))[:4]
        if not often:
            break
        new = {p: 40 + len(rules) + i for i, p in enumerate(sorted(often))}
        rules += sorted(often)
        for x in sequences:
            i = 0
            while i < len(x) - 1:
                if (x[i], x[i + 1]) in new:
                    x[i : i + 2] = [new[x[i], x[i + 1]]]
                i += 1
    assert rules == list(zip(left.tolist(), right.tolist()))
    assert [i for x in sequences for i in x] == symbols.tolist()


def test_distinct_pieces_go_to_the_library_together(reference_ids):
    pieces = ["a" * 700, "zzzqqq", " naïve", "日本語テキスト", "\x00\x01", "<|endoftext|>", " ", "aaab" * 9, "I", "'s"] * 3
    with open(JSON, encoding="utf-8") as file:
        encode = repair._encode(file.read())
    ids, sizes = encode([p.encode() for p in pieces])
    own = [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]
    assert [x for x, p in zip(own, pieces) if p[0] != "<"] == [reference_ids(p) for p in pieces if p[0] != "<"]
    assert [x for x, p in zip(own, pieces) if p[0] == "<"] == [[50256]] * 3 and encode([])[0].size == 0


def test_pieces_stay_known_from_task_to_task(reference_ids):
    pa = pytest.importorskip("pyarrow")
    with open(JSON, encoding="utf-8") as file:
        tokenizer_json = file.read()
    texts = ["one two three", "four two one"]
    rows = [pa.RecordBatch.from_arrays([pa.array([i]), pa.array([re.findall(r" ?\w+", own)])], ["doc_id", "pieces"]) for i, own in enumerate(texts)]
    repair._encoder.cache_clear()
    shards, known = [], []
    for batch in rows:  # a task each
        shards += repair._shards(tokenizer_json, 60_000)(iter([batch]))
        known.append(set(repair._encoder(tokenizer_json).numbers))
    assert known == [{"one", " two", " three"}, {"one", " two", " three", "four", " one"}]
    found = [x for shard in repair._read(iter(shards)) for x in shard.column("ids").to_pylist()]
    assert found == [reference_ids(own) + [repair.END] for own in texts]


def test_the_quicker_pattern_cuts_alike(spark):
    pattern = public_tokenizers.PATTERN
    assert bpe.pattern_for_spark(pattern) != "(?U)" + pattern
    rng = random.Random(8)
    marks = ["'", "s", "t", "re", "ve", "ll", "d", " ", "  ", "\n", "\t", "\x0b", "\x1c", "\x85", "\xa0", "\u3000", "\u200b"]
    marks += ["1", "٣", "½", "Ⅷ", "é", "e\u0301", "日", "🎉", "_", "-", "!", "\x00", "ſ", "ª"]
    texts = ["".join(rng.choices(marks, k=rng.randrange(1, 14))) for _ in range(5_000)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    slow = F.regexp_extract_all("text", F.lit("(?U)" + pattern), F.lit(0))
    assert df.filter(~slow.eqNullSafe(bpe.pieces_of(pattern))).collect() == []


def test_every_ascii_piece_is_encoded_as_the_library_does(reference_ids):
    rng = random.Random(9)
    pieces = [chr(i) * k for i in range(128) for k in (1, 2, 7)]
    pieces += [" " + "".join(rng.choices("abcdefghinorstuTHE", k=rng.randrange(1, 12))) for _ in range(500)] + [" ¿", "ÿ", "<|endoftext|>"]
    with open(JSON, encoding="utf-8") as file:
        ids, sizes = repair._encode(file.read())([p.encode() for p in pieces])
    own = [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]
    assert own[:-1] == [reference_ids(p) for p in pieces[:-1]] and own[-1] == [50256]


def test_a_full_encoder_keeps_the_pieces_it_met_most_often():
    pa = pytest.importorskip("pyarrow")
    asked = []

    def encode(pieces):
        asked.append([p.decode() for p in pieces])
        return np.array([b for p in pieces for b in p], np.int32), np.array([len(p) for p in pieces])

    def decode(ids, sizes):
        return [bytes(x.tolist()) for x in np.split(ids, np.cumsum(sizes)[:-1])]

    calls = [["a", "bb", "a"], ["bb", "ccc"], ["a", "bb", "dddd"], ["bb", "e", "a"], ["ccc", "bb"], ["f", "g", "h", "bb"], ["bb", "a", "é"]]
    encoder = bpe.PieceEncoder(encode, decode, kept=3)
    for own in calls:
        ids, sizes, texts = encoder(pa.array([own[:1], [], own[1:]]))
        whole = "".join(own).encode()
        assert bytes(ids.tolist()) == whole and sizes.tolist() == [len(own[0].encode()), 0, len(whole) - len(own[0].encode())]
        assert texts.to_pylist() == [own[0].encode(), b"", "".join(own[1:]).encode()]
        assert len(encoder.numbers) == len(encoder.sizes) == len(encoder.decoded) == len(encoder.met) <= 3 + len(own)
    # With "a", "bb", "ccc" and "dddd" it was full; "bb" alone is half of what it keeps.
    assert asked == [["a", "bb"], ["ccc"], ["dddd"], ["e", "a"], ["ccc"], ["f", "g", "h"], ["a", "é"]]


def test_sums_of_documents_are_read_without_their_ids(spark, odd, tmp_path):
    path = str(tmp_path / "shards")
    repair.write_shards(odd, path, JSON, public_tokenizers.PATTERN)
    whole, sums = repair.read_shards(spark, path), repair.read_sums(spark, path)
    assert "ids" not in sums.columns and sorted(sums.collect()) == sorted(whole.drop("ids").collect())
    for row in whole.collect():
        assert row.n_tokens == len(row.ids) and row.ids_crc32 == zlib.crc32(np.array(row.ids, "<u4").tobytes())
    assert whole.count() == len(ROWS)


# --- near duplicates


def brute_components(rows, k):
    sets = {}
    for doc_id, own in rows:
        words = neardup.words_of(own or "")
        sets[doc_id] = set(zip(*[words[i:] for i in range(k)])) if len(words) >= k else {tuple(words)} - {()}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 80 * len(sets[a] | sets[b]):
                one, two = root(a), root(b)
                parent[max(one, two)] = min(one, two)
    return {i: (len(sets[i]), root(i)) for i in ids}


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates_equal_brute_force(spark, k):
    rng = random.Random(k)
    rows, vocabulary = [], [f"w{i}" for i in range(300)]
    for group in range(40):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(1, 120))]
        for _ in range(rng.choice([1, 1, 2, 5, 30])):
            copy = [rng.choice(vocabulary) if rng.random() < 0.03 else w for w in base]
            rows.append((len(rows), " ".join(copy)))
    rows += [(len(rows), ""), (len(rows) + 1, None), (len(rows) + 2, "ONE"), (len(rows) + 3, "one")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(df, words=k).collect()}
    assert found == brute_components(rows, k)


def test_near_duplicates_on_awkward_rows(odd, none):
    found = neardup.near_duplicates(odd, words=2).collect()
    by_id = {r.doc_id: r for r in found}
    assert len(found) == len(ROWS)
    assert by_id[2].component_id == 1 and by_id[11].component_id == 10
    assert by_id[3].kept and by_id[4].kept and by_id[5].kept and by_id[3].n_shingles == 0
    kept = neardup.drop_near_duplicates(odd)
    assert kept.columns == odd.columns and {1, 3, 4, 5, 10} <= {r.doc_id for r in kept.collect()}
    assert neardup.near_duplicates(none).count() == 0


@pytest.mark.parametrize("depth", [1, 2])
def test_crowded_regions_keep_every_pair(spark, monkeypatch, depth):
    """Sets that share the regions of the first levels only, and then those of the last one, dealt into blocks."""
    for name in ("CROWD", "BLOCK"):
        monkeypatch.setattr(neardup, name, 8)
    asked = []

    def signature(level: int, i: int) -> list[int]:
        size = neardup.LEVELS[level][0] * neardup.LEVELS[level][1]
        # Of all values only those of the first tree are shared, so it alone brings these sets together.
        shared = neardup.LEVELS[level][0] if level < depth else 0
        return [7] * shared + [1000 * i + j for j in range(size - shared)]

    def values(onward, level):
        asked.append(level)
        rows = [(r.rep, signature(level, r.rep)) for r in onward.collect()]
        return spark.createDataFrame(rows, "id bigint, signature array<int>")

    rows = [(i, 100, signature(0, i), 5, 6, [3] * 16, i % 50) for i in range(60)]
    schema = "rep bigint, n_shingles bigint, signature array<int>, s0 bigint, s1 bigint, odd array<bigint>, component bigint"
    found = neardup._possible_pairs(spark.createDataFrame(rows, schema), 80, values).collect()
    different = [(a, b) for a in range(60) for b in range(a + 1, 60) if a % 50 != b % 50]
    assert asked == [1] and len(neardup.LEVELS) == 2
    assert sorted((r.a, r.b) for r in found) == (different if depth == 2 else [])


def test_a_large_component_is_only_met_by_what_lies_outside(spark, monkeypatch):
    monkeypatch.setattr(neardup, "CROWD", 5)
    size = neardup.VALUES
    rows = [(i, 100, [7] * size, 5, 6, [3] * 16, 0 if i < 40 else i) for i in range(44)]
    schema = "rep bigint, n_shingles bigint, signature array<int>, s0 bigint, s1 bigint, odd array<bigint>, component bigint"
    found = neardup._possible_pairs(spark.createDataFrame(rows, schema), 80, lambda *_: 1 / 0).collect()
    assert sorted((r.a, r.b) for r in found) == [(a, b) for a in range(44) for b in range(max(40, a + 1), 44)]


def test_neighbours_with_the_longest_prefix_come_first(spark, monkeypatch):
    monkeypatch.setattr(neardup, "DRAWN", 0)
    monkeypatch.setattr(neardup, "ALIKE", 1)
    # All in one region of every tree; beyond it 1 and 2 go on alike, 3 and 4 do so, too.
    base = list(range(neardup.VALUES))
    rows = []
    for rep, kind in ((1, 0), (2, 0), (3, 1), (4, 1)):
        own = [v if j < neardup.DEPTH or kind == 0 else v + 10_000 for j, v in enumerate(base)]
        rows.append((rep, own, 5, 6))
    found = neardup._neighbour_pairs(spark.createDataFrame(rows, "rep bigint, signature array<int>, s0 bigint, s1 bigint"))
    assert {(r.a, r.b) for r in found.collect()} == {(1, 2), (3, 4)}


@pytest.mark.parametrize("crowd", [256, 4])
def test_near_duplicates_of_the_given_table(spark, sf_dir, monkeypatch, crowd):
    """Every link of brute force is found, also where nearly every region is crowded."""
    monkeypatch.setattr(neardup, "CROWD", crowd)
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in documents.collect()]
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(documents, words=2).collect()}
    assert found == brute_components(rows, 2)


def test_large_ids_and_documents_listed_again(spark):
    rng = random.Random(8)
    base = [f"w{rng.randrange(1000)}" for _ in range(60)]
    rows = []
    for i in range(6):
        own = [*base[:-2], f"x{i}", f"y{i}"]
        rows += [(2**62 + i, " ".join(own))] * (150 if i < 2 else 1)
    rows += [(2**63 - 1, "another text of its own"), (-(2**63), "and one more")]
    found = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), words=2).collect()
    assert len(found) == len(rows)
    assert {r.component_id for r in found if 0 < r.doc_id < 2**63 - 1} == {2**62}
    assert {r.component_id for r in found if not 0 < r.doc_id < 2**63 - 1} == {2**63 - 1, -(2**63)}


def test_one_document_with_two_texts_is_linked_by_either(spark):
    rng = random.Random(9)
    one, two = ([f"w{rng.randrange(1000)}" for _ in range(50)] for _ in range(2))
    rows = [(5, " ".join(one)), (5, " ".join(two)), (7, " ".join(one[:-1])), (8, " ".join(two[:-1])), (None, " ".join(one))]
    found = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), words=2).collect()
    assert {(r.doc_id, r.component_id) for r in found} == {(5, 5), (7, 5), (8, 5), (None, 5)}


def test_parity_never_rules_out_a_link():
    rng = np.random.default_rng(5)
    for _ in range(50):
        x = np.unique(rng.integers(0, 1 << 63, 400, dtype=np.uint64))
        y = np.unique(np.concatenate([x[rng.random(len(x)) < 0.9], rng.integers(0, 1 << 63, 30, dtype=np.uint64)]))
        differ = len(np.setxor1d(x, y))
        flipped = (neardup.parity(x) ^ neardup.parity(y)).view(np.uint64)
        assert np.bitwise_count(flipped).sum() <= differ


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (200, 200)]
    found = components.components(spark.createDataFrame(chain, "a bigint, b bigint"))
    assert {r.node: r.component for r in found.collect()} == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def test_components_of_large_ids(spark):
    ids = [2**62 + 3 * i for i in range(8)]
    links = list(zip(ids, ids[1:])) + [(-(2**63), 2**63 - 1)]
    found = components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    expected = {i: ids[0] for i in ids} | {-(2**63): -(2**63), 2**63 - 1: -(2**63)}
    assert {r.node: r.component for r in found} == expected


# --- toxicity, pseudo-likelihood


def test_toxicity_on_held_out_rows(spark, sf_dir):
    documents, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    found = toxicity.toxicity(documents, labels).join(labels, "doc_id").filter("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in found)
    bad, good = ([r.score for r in found if r.toxic == t] for t in (1, 0))
    assert np.mean([b > g for b in bad for g in good]) > 0.8  # 225 labels to learn from


def test_ftrl_step_by_step():
    """The fitted weights against the update rule written out for one coordinate at a time."""
    texts = ["bad bad word here", "a good word", "", "bad things", "good good things here", "no words that count"] * 3
    labels = [1, 0, 0, 1, 0, 1] * 3
    settings = toxicity.Settings(alpha=0.5, beta=0.7, l1=0.2, l2=0.3, passes=3)
    hashes = toxicity.WordHashes()
    sets = [sorted(set(toxicity.features([t], hashes)[1].tolist())) for t in texts]
    z, n, bias = {}, {}, [0.0, 0.0]

    def weight(zi, ni, l1):
        if abs(zi) <= l1:
            return 0.0
        return -(zi - np.sign(zi) * l1) / ((settings.beta + ni**0.5) / settings.alpha + settings.l2)

    for number in range(settings.passes):
        for i in np.random.default_rng(number).permutation(len(texts)):
            w = {c: weight(z.get(c, 0.0), n.get(c, 0.0), settings.l1) for c in sets[i]}
            b = weight(*bias, 0.0)
            g = 1 / (1 + np.exp(-(sum(w.values()) + b))) - labels[i]
            for c in sets[i]:
                old = n.get(c, 0.0)
                z[c] = z.get(c, 0.0) + g - ((old + g * g) ** 0.5 - old**0.5) / settings.alpha * w[c]
                n[c] = old + g * g
            bias[0] += g - ((bias[1] + g * g) ** 0.5 - bias[1] ** 0.5) / settings.alpha * b
            bias[1] += g * g
    expected = {c: w for c in z if (w := weight(z[c], n[c], settings.l1))}
    at, w, b = toxicity.fit(texts, labels, settings)
    assert expected and dict(zip(at.tolist(), w)) == pytest.approx(expected)
    assert b == pytest.approx(weight(*bias, 0.0))


def test_toxicity_on_awkward_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1, None), (None, 1, 1), (10, 1, 0), (999, 0, 1)], "doc_id bigint, quality int, toxic int")
    found = toxicity.toxicity(odd, labels).collect()
    assert len(found) == len(ROWS) and all(0 <= r.score <= 1 for r in found)
    no_labels = toxicity.toxicity(odd, labels.limit(0)).collect()
    assert all(r.score < 1e-9 and r.predicted == 0 for r in no_labels)
    assert toxicity.drop_toxic(odd, labels.limit(0)).columns == odd.columns
    assert toxicity.toxicity(none, labels).count() == 0


def test_pseudo_likelihood(spark, sf_dir, odd, none):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    frequent = lm.frequent_words(documents)
    network = lm.train(documents, frequent, rounds=1, stride=16)
    numbers = lm.Numbers(frequent)
    rng = np.random.default_rng(6)
    texts = [r.text for r in documents.filter("doc_id % 20 = 0").collect()]
    real = [lm.tokens_of(t, numbers) for t in texts]
    shuffled = [rng.permutation(x) for x in real]
    assert lm.score_documents(network, real).sum() > lm.score_documents(network, shuffled).sum()
    # By hand: each token from both sides, one at a time.
    own = real[0][:9]
    padded = np.concatenate([np.full(lm.WINDOW, lm.PAD), own, np.full(lm.WINDOW, lm.PAD)])
    total = 0.0
    for i, target in enumerate(own):
        around = np.delete(padded[i : i + 2 * lm.WINDOW + 1], lm.WINDOW)
        h = np.append(np.tanh(network.embedding[around].ravel() @ network.places.reshape(-1, lm.HIDDEN) + network.bias), 1)
        first, second = h @ network.classes, h @ network.words[target // lm.PER_CLASS]
        total += first[target // lm.PER_CLASS] - np.log(np.exp(first).sum())
        total += second[target % lm.PER_CLASS] - np.log(np.exp(second).sum())
    assert lm.score_documents(network, [own])[0] == pytest.approx(total, rel=1e-4)
    found = {r.doc_id: r for r in lm.pseudo_likelihood(odd).collect()}
    assert found[3].n_tokens == 0 and found[3].log_likelihood == 0 and found[3].mean_log_probability is None
    assert lm.pseudo_likelihood(none).count() == 0


def test_every_token_is_a_training_case():
    documents = [np.arange(n) + 100 * n for n in (0, 1, 2, 3, 7, 8, 9, 50)]
    found = [lm.cases(documents, i % lm.STRIDE, lm.STRIDE)[1] for i in range(lm.ROUNDS)]
    assert set(np.concatenate(found).tolist()) == set(np.concatenate(documents).tolist())


def test_words_that_share_a_place_have_their_own_probability(spark):
    frequent = [f"f{i:03d}" for i in range(lm.VOCABULARY - lm.RARE)]
    place = lambda w: zlib.crc32(w.encode()) % lm.RARE
    one = "rare"
    other = next(w for w in (f"nonsense{i}" for i in range(10_000)) if place(w) == place(one))
    many = " ".join(frequent * 6)
    rows = [(0, many), (1, f"f000 {one} f001"), (2, f"f000 {other} f001"), (2, f"f000 {other} f001"), (3, " ".join([one.upper()] * 3))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = lm.pseudo_likelihood(df).collect()
    assert sorted(r.doc_id for r in found) == [0, 1, 2, 2, 3]
    by_id = {r.doc_id: r.log_likelihood for r in found}
    # Four tokens of the place are the one word, two the other.
    assert by_id[1] - by_id[2] == pytest.approx(np.log(4 / 2), rel=1e-6)
    shares = {r.word: r.log_share for r in lm.log_shares(lm.word_counts(df), frequent).collect()}
    assert shares == {one: pytest.approx(np.log(4 / 6)), other: pytest.approx(np.log(2 / 6))}


def test_words_known_to_the_workers_or_joined_give_the_same_scores(spark, odd, monkeypatch):
    many = " ".join(f"f{i}" for i in range(lm.VOCABULARY - lm.RARE)) + " "
    rows = [(100 + i, many * 3 + " ".join(f"w{j}" for j in range(i, 40, i)) + " \x0b w39\x0cw39\x85\x1cw38 ") for i in range(1, 9)]
    df = odd.select("doc_id", "text").union(spark.createDataFrame(rows, "doc_id bigint, text string"))
    shares = lm.log_shares(lm.word_counts(df), lm.frequent_words(df))
    found = {}
    for most in (0, 20, 1_000):
        monkeypatch.setattr(lm, "KNOWN", most)
        known, others = lm.known_shares(shares)
        assert len(known) <= most and len(known) + others.count() == shares.count()
        numbered = lm.numbered_documents(df, lm.frequent_words(df), known).collect()
        assert {w for r in numbered for w in r.words} == {r.word for r in others.collect()}
        found[most] = sorted(lm.pseudo_likelihood(df).collect(), key=str)
    assert 0 < others.count() + len(known) <= 1_000 and not others.count()
    sizes = {r.doc_id: len(re.findall(common.WORD, r.text or "")) for r in df.collect()}
    assert all(r.n_tokens == sizes[r.doc_id] for r in found[0])
    for most in (20, 1_000):
        assert [r.doc_id for r in found[most]] == [r.doc_id for r in found[0]]
        ours, theirs = ([r.log_likelihood for r in found[k]] for k in (most, 0))
        assert ours == pytest.approx(theirs, rel=1e-4)


@pytest.mark.parametrize("stride", [1, 2, 3, 16])
def test_a_training_step_is_that_of_every_case_by_itself(stride):
    rng = np.random.default_rng(stride)
    documents = [rng.integers(0, lm.VOCABULARY, n) % rng.integers(1, lm.VOCABULARY) for n in (0, 1, 2, 3, 40, 0, 17, 33, 0)]
    network = lm.Network.of(rng.normal(0, 0.3, len(lm.Network.start().flat())))
    weights = [a.astype(float) for a in vars(network).values()]
    gradients = [np.zeros_like(a) for a in weights]
    embedding, places, bias, classes, words = weights
    contexts, targets, _ = lm.cases(documents, stride - 1, stride)
    for around, target in zip(contexts, targets):
        own, within = divmod(target, lm.PER_CLASS)
        h = np.append(np.tanh(sum(embedding[t] @ p for t, p in zip(around, places)) + bias), 1)
        d_h = np.zeros(len(h))
        for matrix, gradient, at in ((classes, gradients[3], own), (words[own], gradients[4][own], within)):
            d = np.exp(h @ matrix) / np.exp(h @ matrix).sum()
            d[at] -= 1
            gradient += np.outer(h, d)
            d_h += matrix @ d
        d_in = (d_h * (1 - h**2))[:-1]
        gradients[2] += d_in
        for i, (t, p) in enumerate(zip(around, places)):
            gradients[0][t] += p @ d_in
            gradients[1][i] += np.outer(embedding[t], d_in)
    gradients = [g / len(targets) for g in gradients]
    flat, at, _ = lm.laid_out(documents, stride - 1, stride)
    assert np.array_equal(flat[at], targets)
    network.learn(flat, at, stride, [np.ones_like(a) for a in vars(network).values()])
    for before, gradient, after in zip(weights, gradients, vars(network).values()):
        assert np.allclose(after, before - lm.RATE * gradient / np.sqrt(1 + gradient**2), rtol=1e-5, atol=1e-6)


def test_large_weights_do_not_overflow():
    rng = np.random.default_rng(5)
    network = lm.Network.of(rng.normal(0, 0.3, len(lm.Network.start().flat())))
    network.classes *= 200
    network.words *= 200
    document = rng.integers(0, lm.VOCABULARY, 50)
    total = 0.0
    for around, target in zip(*lm.cases([document])[:2]):
        own, within = divmod(target, lm.PER_CLASS)
        h = np.append(np.tanh(sum(network.embedding[t] @ p for t, p in zip(around, network.places)) + network.bias), 1)
        for x, i in ((h @ network.classes, own), (h @ network.words[own], within)):
            total += x[i] - x.max() - np.log(np.exp(x - x.max()).sum())
    assert lm.score_documents(network, [document])[0] == pytest.approx(total, rel=1e-4)
    flat, at, _ = lm.laid_out([document])
    network.learn(flat, at, 1, [np.ones_like(a) for a in vars(network).values()])
    assert np.isfinite(network.flat()).all()


# --- pages and URLs

ARTICLE = "<article><h1>Title &amp; more</h1><p>{}<p>Short.</p></article>".format("A long   sentence\nof text. " * 9)


@pytest.mark.parametrize(
    "page, expected",
    [
        (None, ""),
        ("", ""),
        ("<script>var a = '<p>no</p>';</script><style>p{}</style>", ""),
        ("<p>a &lt; b &copy; c", "a < b © c"),
        ("<nav><ul><li><a href=x>Menu</a></ul></nav><p>One<br>Two</p><footer>end</footer>", "One\nTwo"),
        (
            "<header>Site</header><div class='ad'>Buy</div>" + ARTICLE + "<div id=comments><p>" + "I agree. " * 40,
            "Title & more\n" + " ".join(("A long sentence of text. " * 9).split()) + "\nShort.",
        ),
    ],
)
def test_main_text(page, expected):
    assert html_text.main_text(page) == expected


def test_short_bodies_beside_long_ones_are_kept():
    long = "A long sentence of text. " * 9
    marked = f"<h1>Title</h1><div class=byline>By me</div><p>{long}</p><div class=ad>Buy</div><p>Short ending.</p>"
    expected = f"Title\n{long.strip()}\nShort ending."
    assert html_text.main_text(marked) == expected
    assert html_text.main_text(f"<div id=top>Elsewhere</div><br><br><br><div class=ad>Buy</div><div>{marked}</div>") == expected
    two = f"<article><p>{long}</article><article><p>Short one.</article>"
    assert html_text.main_text(two) == f"{long.strip()}\nShort one."


LONG_TEXT = "A long sentence of text. " * 9


@pytest.mark.parametrize(
    "page, expected",
    [
        # a class that only contains the word of a page part marks nothing
        (
            f"<article><div class=article-header><h1>Title</h1></div><p>{LONG_TEXT}</article>",
            f"Title\n{LONG_TEXT.strip()}",
        ),
        (
            f"<div class='page with-sidebar'><nav>Menu</nav><div><p>{LONG_TEXT}</div></div>",
            LONG_TEXT.strip(),
        ),
        (
            f"<article><p>{LONG_TEXT}<div class=related-work><h2>Others</h2><p>Said it.</div></article>",
            f"{LONG_TEXT.strip()}\nOthers\nSaid it.",
        ),
        # a headline in a container of its own, cut off by a notice
        (
            f"<div class=top><h1>Title</h1></div><div class=ad>Buy</div><div class=text><p>{LONG_TEXT}</div>",
            f"Title\n{LONG_TEXT.strip()}",
        ),
        # parts of the page by the beginning or the end of their class
        (
            f"<div class=site-header>Site</div><div>{LONG_TEXT}</div><div class=comment-list><p>{LONG_TEXT}</div>",
            LONG_TEXT.strip(),
        ),
        # a mark alone neither keeps nor drops: the text stands beside the article
        (
            f"<article><a href=x>Teaser</a></article><div><p>{LONG_TEXT * 9}</div>",
            (LONG_TEXT * 9).strip(),
        ),
        (
            f"<div><p>Some words beside it, more than enough to surge on a page without any mark at all.</div>"
            f"<br><br><br><article><p>{LONG_TEXT}</article>",
            LONG_TEXT.strip(),
        ),
    ],
)
def test_surge_and_dive_decide(page, expected):
    assert html_text.main_text(page) == expected


def test_the_window_changes_the_result():
    """Three short lines surge together; two links between lines are a dive for a window of two only."""
    short = "<p>" + "<p>".join(["Thirty characters of text here"] * 3)
    lines = html_text.lines_of(f"<div>{short}</div><div><a href=x>one</a></div><div><a href=y>two</a></div><b>End.</b>")
    wide, narrow = (html_text.main_lines(lines, window=w) for w in (3, 1))
    assert wide[-1] == "End." and len(wide) == 6
    assert narrow != wide
    article = f"<article><p>{'Word ' * 4}</p><a href=x>x</a><p>{'Word ' * 400}</p></article>"
    marked = html_text.lines_of(article + f"<hr><hr><div>{'Beside ' * 12}</div>")
    assert html_text.main_lines(marked, window=2)[:2] == html_text.main_lines(marked, window=2, surge=10**6)[:2]
    assert html_text.main_lines(marked, marked=1) != html_text.main_lines(marked)


def test_an_empty_table_of_pages(spark):
    none = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert html_text.extract(none).count() == 0


def test_pages_on_awkward_rows(spark):
    rows = [(None, None, None, "x"), (1 << 60, "u", "<p>text", "x"), (1, "u", "<p>" + LONG, "x"), (1, "u", "<p", "x")]
    found = html_text.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string, text string"))
    assert sorted((r.page_id or 0, r.n_chars) for r in found.collect()) == [
        (0, 0), (1, 0), (1, len(LONG.strip())), (1 << 60, 4)
    ]


def test_url_rules(spark):
    cases = {
        None: ("", "", None, "allow"),
        "no scheme": ("", "", None, "allow"),
        "http://A.Example.com/en/1?x#y": ("a.example.com", "/en/1", "example.com/en/", "block"),
        "http://www.example.com/en/": ("www.example.com", "/en/", "www.example.com/en/", "allow"),
        "http://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
        "http://x.com": ("x.com", "", None, "allow"),
        "http://x.net/ES/": ("x.net", "/ES/", None, "allow"),
        "http://x.net/es/a://b": ("x.net", "/es/a://b", "net/es/", "block"),
        "https://www.casino-win.example.org/": ("www.casino-win.example.org", "/", None, "block"),
        "https://casino-win.example.com/": ("casino-win.example.com", "/", "com/", "allow"),
    }
    pages = spark.createDataFrame([(i, u, "r") for i, u in enumerate(cases)] * 2, "page_id int, url string, rule string")
    found = urls.judge_urls(pages).collect()
    assert len(found) == 2 * len(cases)
    for r in found:
        assert (r.host, r.path, r.rule, r.verdict) == list(cases.values())[r.page_id]
    assert urls.judge_urls(pages.limit(0)).count() == 0


# --- the pipeline


def test_stages_keep_the_columns_of_documents(spark, odd, sf_dir):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    docs = odd
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == odd.columns
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert last.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert last.count() == docs.count()
