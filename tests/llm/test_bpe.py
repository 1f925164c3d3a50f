import hashlib
import random
import struct

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidelog.llm import bpe
from tests.llm.helpers import DOCS

ALPHABET = "aaabbcde é  \n\t'sS’ 's'll 12٣!?#ñ中文😀\x1c\x85\xa0"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(bpe.DEFAULT_VOCABULARY))


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(bpe._load(None))


def reference(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


def some_texts():
    seeded = random.Random(5)
    texts = ["".join(seeded.choice(ALPHABET) for _ in range(seeded.randint(0, 80))) for _ in range(400)]
    return texts + ["", "a" * 20_000, "ab" * 9_000, " " * 300, "<|endoftext|>", "x<|endoftext|> <|endoftext|>y"]


def test_equals_the_library(library, vocabulary):
    encoder = bpe.Encoder(vocabulary)
    texts = some_texts()
    for text, ids in zip(texts, encoder.encode(texts)):
        expected, decoded = reference(library, text)
        assert ids == struct.pack(f"<{len(expected)}I", *expected)
        assert encoder.decode(ids) == decoded


def test_small_cache_changes_nothing(library, vocabulary, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 20)
    monkeypatch.setattr(bpe, "BLOCK", 3)
    encoder = bpe.Encoder(vocabulary)
    for text in some_texts()[:60]:
        expected, _ = reference(library, text)
        assert encoder.encode([text])[0] == struct.pack(f"<{len(expected)}I", *expected)


def test_digests_of_rows(spark, library):
    texts = [*some_texts()[:50], None, "", "same", "same"]
    docs = spark.createDataFrame([(k, t, None, None, None) for k, t in enumerate(texts)], DOCS)
    got = {r["doc_id"]: r for r in bpe.digest_texts(docs, ["doc_id"]).collect()}
    assert len(got) == len(texts)
    for k, text in enumerate(texts):
        ids, decoded = reference(library, text)
        assert got[k]["n_tokens"] == len(ids)
        assert got[k]["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert got[k]["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_round_trip_column_and_edges(spark):
    docs = spark.createDataFrame(
        [(None, "a b", "x"), (1, None, None), (1, None, None)], "doc_id long, text string, n_tokens string"
    )
    rows = bpe.encode_texts(docs.select("doc_id", "text", "n_tokens"), ["doc_id"]).collect()
    assert sorted(len(r["ids"]) for r in rows) == [0, 0, 2]
    assert all(r["round_trip"] for r in rows)
    assert bpe.digest_texts(docs.filter("false"), ["doc_id"]).count() == 0
