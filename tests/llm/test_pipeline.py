"""The pipeline as a whole against plain Python, on awkward rows and on empty tables."""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections import Counter

import duckdb
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from tripflow.llm import mixing, toxicity

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint, copy int"
LABELS = "doc_id bigint, quality int, toxic int"


def encoding():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def brute(documents: list[dict], labels: list[dict]) -> Counter:
    # toxicity: fitted on every usable label, as there are fewer than the sample holds
    toxic = {}
    for row in labels:
        if row["doc_id"] is not None and row["toxic"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 4 != 2:
            toxic[row["doc_id"]] = max(toxic.get(row["doc_id"], 0), row["toxic"])
    learned = sorted({(d["doc_id"], d["text"] or "", toxic[d["doc_id"]]) for d in documents if d["doc_id"] in toxic})
    at, weights, bias = toxicity.fit([t for _, t, _ in learned], [y for _, _, y in learned])
    dense = toxicity.np.zeros(1 << toxicity._BITS)
    dense[at] = weights
    hashes = toxicity.WordHashes()
    docs = [d for d in documents if toxicity.scores([d["text"] or ""], dense, bias, hashes)[0] < toxicity.THRESHOLD]

    # exact copies: the largest id of each text stays
    keep = {}
    for d in docs:
        keep[d["text"] or ""] = max(keep.get(d["text"] or "", d["doc_id"]), d["doc_id"])
    docs = [d for d in docs if keep[d["text"] or ""] == d["doc_id"]]

    # near copies: five words, 80 %, the smallest id of each component stays
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = {}
    for d in docs:
        words = (d["text"] or "").translate(lower).encode().split()
        sets[d["doc_id"]] = {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}
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
    docs = [d for d in docs if root(d["doc_id"]) == d["doc_id"]]

    # the mix, by its SQL
    db = duckdb.connect()
    db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    if docs:
        db.executemany("INSERT INTO documents VALUES (?, ?, ?)", [(d["doc_id"], d["text"], d["source"]) for d in docs])
    copies = dict(db.execute(f"SELECT doc_id, copies FROM ({mixing.SQL})").fetchall())

    encode = encoding()
    result = Counter()
    for d in docs:
        found = encode.encode_ordinary(d["text"] or "")
        row = (
            d["doc_id"],
            len(found),
            hashlib.sha256(" ".join(map(str, found)).encode()).hexdigest(),
            hashlib.sha256((d["text"] or "").encode()).hexdigest(),
        )
        if copies[d["doc_id"]]:
            result[row] += copies[d["doc_id"]]
    return result


def ran(spark, folder: str) -> Counter:
    return Counter(tuple(r) for r in corpus_pipeline.run(spark, folder).collect())


def test_equals_brute_force_on_the_given_tables(spark, sf_dir):
    folder = sf_dir.replace("sf0.01", "sf0.001")
    documents, labels = ([r.asDict() for r in spark.read.parquet(f"{folder}/{t}.parquet").collect()] for t in ("documents", "labels"))
    expected = brute(documents, labels)
    assert 0 < len(expected) < len(documents)
    assert ran(spark, folder) == expected


def test_awkward_rows(spark, tmp_path):
    words = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen".split()
    texts = [None, "", " \n ", "word", " ".join(words), " ".join(words) + " more", "Ein " + " ".join(words), "日本 🎉", "x " * 9000]
    rows = [(i, t, "en", [None, "a", "b"][i % 3], 5, 1) for i, t in enumerate(texts * 3)]
    spark.createDataFrame(rows, DOCUMENTS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(99, 1, 1), (None, None, None)], LABELS).write.parquet(str(tmp_path / "labels.parquet"))
    names = [c.split()[0] for c in DOCUMENTS.split(", ")]
    expected = brute([dict(zip(names, r)) for r in rows], [])
    assert ran(spark, str(tmp_path)) == expected and expected


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], DOCUMENTS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], LABELS).write.parquet(str(tmp_path / "labels.parquet"))
    assert ran(spark, str(tmp_path)) == Counter()


def test_the_stages_are_those_that_run(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "exact dedup", "MinHash near-dedup", "mixing sources to target weights",
        "byte-level BPE encoding and decoding",
    ]
    with pytest.raises(Exception):
        corpus_pipeline.run(spark, "/nowhere").count()
