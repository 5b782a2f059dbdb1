"""Word-end BPE against the tokenizers library."""

from __future__ import annotations

import hashlib
import random

import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tripflow.llm import pair_index, queries

PATH = public_tokenizers.path("word_bpe_49k.json")
COLUMNS = "doc_id bigint, text string, ids string, decoded int"
PARTS = (
    "a aa Σ ΑΣ İ ß ́ é é   \n \x1c \x85   1 ٣ ½ 's 'LL <|endoftext|> <|ENDOFTEXT|> <|startoftext|> <| 日本 🎉"
    " ՘ Ᲊ 한 ᄒ ᅡ ᆫ !! ﬁ Ω Ω _ \x00 ꟊ ǅ don't"
).split(" ")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


def strange_texts() -> list[str]:
    rng = random.Random(3)
    return ["".join(rng.choice([*PARTS, " ", "x" * 40]) for _ in range(rng.randint(0, 14))) for _ in range(400)]


def test_equals_the_library(spark, library):
    texts = [None, "", " \n\t", "the quick brown fox " * 9000, "z" * 30_000, *strange_texts()]
    rows = [(i if i else None, t, "clash", 1) for i, t in enumerate(texts)] + [(3, "repeated row", None, None)] * 2
    found = pair_index.encode_decode(spark.createDataFrame(rows, COLUMNS).repartition(3), PATH).collect()
    assert len(found) == len(rows)
    by_text = sorted((r.doc_id or 0, r.ids, r.decoded) for r in found)
    expected = []
    for doc_id, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        expected.append((doc_id or 0, ids, library.decode(ids, skip_special_tokens=False)))
    assert by_text == sorted(expected)


def test_digests_are_those_of_the_library(spark, library, sf_dir):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = queries.queries()["op11_word_bpe"](spark, sf_dir).collect()
    assert len(found) == len(texts)
    for r in found:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_long_texts_go_part_by_part(library, monkeypatch):
    monkeypatch.setattr(pair_index, "SLICE", 20)
    with open(PATH, encoding="utf-8") as file:
        encoder = pair_index.TextEncoder(file.read())
    texts = ["don't cut a piece in two, 's or é " * 30, *strange_texts()]
    ids = [[] for _ in texts]
    parts = list(pair_index._encoded(encoder, pa.array(texts)))
    for row, tokens, _ in parts:
        ids[row] += tokens.tolist()
    assert len(parts) > len(texts) + 25
    assert ids == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_pieces_are_forgotten_beyond_a_number(library, monkeypatch):
    monkeypatch.setattr(pair_index, "KEPT", 10)
    with open(PATH, encoding="utf-8") as file:
        encoder = pair_index.TextEncoder(file.read())
    for text in strange_texts()[:50]:
        flat, _, _ = encoder([text])
        assert flat.tolist() == library.encode(text, add_special_tokens=False).ids


def test_empty_table(spark):
    none = spark.createDataFrame([], COLUMNS)
    assert pair_index.encode_decode(none, PATH).count() == 0
    assert pair_index.encode_decode_digests(none, PATH).count() == 0


def test_other_kinds_of_files_are_refused():
    with open(PATH, encoding="utf-8") as file:
        source = file.read().replace('"ignore_merges": false', '"ignore_merges": true').replace(
            '"ignore_merges":false', '"ignore_merges":true'
        )
    with pytest.raises(ValueError):
        pair_index.PairIndexBpe(source)
