"""Encoding and decoding against the library that the vocabulary belongs to."""

from __future__ import annotations

import random
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from delaylake.llm import word_bpe
from delaylake.llm.word_bpe import Encoder, decode_documents, decoder, default_vocabulary, encode_documents, vocabulary

from edge_cases import odd_documents

tokenizers = pytest.importorskip("tokenizers")
pytest.importorskip("public_tokenizers")

ODD = (
    "a B ' s T _ - ! ... \n \t <|endoftext|> <|startoftext|> <|endof é é Σ ΑΣ İ ß ² ª º ¼ ٣ ५ 中 ​ \x85   　 ǅ ﬁ ͅ 😀 🇦 ֏ Ⅷ № \x1c"
    " ﻿ 한 하 'LL 's don't 123 ˦ ‐ ′ ₨ 𐀀"
).split(" ") + [" ", "  "]


@pytest.fixture(scope="module")
def path():
    return default_vocabulary()


@pytest.fixture(scope="module")
def library(path):
    return tokenizers.Tokenizer.from_file(path)


def expected(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_every_character_of_the_plain_route(path, library):
    encoder = Encoder(vocabulary(path))
    characters = [*range(0x530), *range(0x2000, 0x2070)]
    texts = [before + chr(c) + "b" for c in characters for before in ("", "a", "_", "1")]
    for text, got in zip(texts, encoder.encode(texts).to_pylist()):
        assert got == expected(library, text), hex(ord(text[-2]))


def test_random_texts(path, library):
    rng = random.Random(4)
    texts = ["".join(rng.choice(ODD) for _ in range(rng.randrange(30))) for _ in range(3000)]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 0x3000), rng.randrange(0xE000, 0x20000)])) for _ in range(12)) for _ in range(1500)]
    encoder = Encoder(vocabulary(path))
    got = encoder.encode(texts)
    back = decoder(vocabulary(path), got).to_pylist()
    for text, ids, decoded in zip(texts, got.to_pylist(), back):
        assert ids == expected(library, text), repr(text)
        assert decoded == library.decode(ids, skip_special_tokens=False), repr(text)


@pytest.mark.parametrize("stock", ["a", "ab", "abcdefghijklmnopqrstuvwxyz", "!?", "é"])
def test_long_words(path, library, stock):
    rng = random.Random(5)
    text = "".join(rng.choice(stock) for _ in range(20_000))
    assert Encoder(vocabulary(path)).encode([text]).to_pylist() == [expected(library, text)]


def test_pieces_of_long_texts_and_a_forgetful_encoder(path, library, monkeypatch):
    rng = random.Random(6)
    texts = [" ".join(rng.choice(ODD) * rng.randrange(1, 4) for _ in range(400)) for _ in range(12)]
    want = [expected(library, t) for t in texts]
    monkeypatch.setattr(word_bpe, "PIECE_CHARS", 50)
    monkeypatch.setattr(word_bpe, "PENDING_WORDS", 20)
    monkeypatch.setattr(word_bpe, "KNOWN_SYMBOLS", 100)
    encoder = Encoder(vocabulary(path))
    assert [encoder.encode([t]).to_pylist()[0] for t in texts] == want
    assert encoder.encode(texts).to_pylist() == want


def test_merges_that_do_not_build_on_one_another(path):
    """Single merges a round give what merging every occurrence gives, where merges are orderly."""
    plain = vocabulary(path)
    assert plain.orderly
    other = word_bpe.Vocabulary(path)
    other.orderly = False
    words = ["banana", "aaaaaaa", "mississippi", "zzzz", "x"]
    lengths = np.array([len(w) for w in words])

    def merged(v):
        octets = np.frombuffer("".join(words).encode(), np.uint8)
        symbols, ends = v.inner[octets], np.cumsum(lengths) - 1
        symbols[ends] = v.last[octets[ends]]
        return [x.tolist() for x in v.merge(symbols, lengths)]

    assert merged(plain) == merged(other)


def test_odd_documents(spark, path, library):
    docs = odd_documents(spark).withColumn("ids", F.lit("replaced"))
    done = decode_documents(encode_documents(docs, path), path)
    rows = done.collect()
    assert len(rows) == docs.count() and set(docs.columns) | {"decoded"} == set(done.columns)
    for row in rows:
        ids = expected(library, row["text"])
        assert row["ids"] == ids
        assert row["decoded"] == library.decode(ids, skip_special_tokens=False)


def test_empty_table_and_unknown_ids(spark, path):
    docs = odd_documents(spark, [])
    assert decode_documents(encode_documents(docs, path), path).collect() == []
    ids = pa.array([None, [], [0, 10**6, 1]], pa.list_(pa.int32()))
    assert decoder(vocabulary(path), ids).to_pylist() == ["", "", '! "']


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").exists(), reason="test tables not present")
def test_query_equals_the_library(spark, library):
    import hashlib

    sf = "/root/testdata/sf0.001"
    texts = {r[0]: r[1] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    df = word_bpe.op12_bpe_round_trip(spark, sf)
    rows = df.collect()
    assert len(rows) == len(texts)
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    for row in rows:
        ids = expected(library, texts[row.doc_id])
        decoded = library.decode(ids, skip_special_tokens=False)
        assert tuple(row)[1:] == (len(ids), sha(" ".join(map(str, ids))), sha(decoded))
    # Each text is encoded once, although three columns need the ids.
    assert df._jdf.queryExecution().executedPlan().toString().count("encode(") <= 1
