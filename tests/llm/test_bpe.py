"""Byte pairs against the public library that reads the same vocabulary."""

import hashlib

import numpy as np
import pytest
from adpulse.llm import bpe, queries
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

ODD = [
    "", " ", "  a", "a  ", "\n\n\tx \r\n", "'LL 'll it's", "x" * 3000, " " * 300 + "a", "\x00",
    "<|endoftext|>", "a<|endoftext|> b  <|endoftext|>\n", "<|endoftext|><|endoftext|>", "<|endof",
    "日本語 テスト 🙂 ▁ ünï 1234567890", "՘a \U0003d000b", "� 　x", "ab" * 40,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.VOCABULARY)


@pytest.fixture(scope="module")
def coder():
    return bpe.Coder(bpe.load())


def ids(coder, text):
    return np.frombuffer(coder.encode(text), np.int32).tolist()


def test_odd_texts(library, coder):
    for text in ODD:
        assert ids(coder, text) == library.encode(text, add_special_tokens=False).ids
        assert coder.decode(ids(coder, text)) == text


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=60))
def test_any_text(library, coder, text):
    assert ids(coder, text) == library.encode(text, add_special_tokens=False).ids


def test_every_code_point(library, coder):
    points = (chr(k) for k in range(0x110000) if not 0xD800 <= k < 0xE000)
    texts = [f"a{c}1{c} {c}{c}! {c}b" for c in points]
    wrong = [
        text
        for text, found in zip(texts, library.encode_batch(texts, add_special_tokens=False))
        if found.ids != ids(coder, text)
    ]
    assert not wrong


def test_special_tokens_as_text(library):
    plain = bpe.Coder(bpe.load(), plain=True)
    own = Tokenizer.from_file(bpe.VOCABULARY)
    own.encode_special_tokens = True
    for text in ODD:
        assert ids(plain, text) == own.encode(text, add_special_tokens=False).ids


def test_decoding_as_the_library_does(library, coder):
    for found in ([220, 50256, 0], [128, 255], [13, 222, 255, 40], list(range(256)), []):
        assert coder.decode(found) == library.decode(found, skip_special_tokens=False)
    assert coder.decode([-1, 10**7]) == ""


def test_forgetting_changes_nothing(monkeypatch, coder):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    other = bpe.Coder(bpe.load())
    text = "the cat sat on the mat and the dog sat on the log " * 3
    assert other.encode(text) == coder.encode(text)
    assert len(other.known) <= 3 and len(other.known.older) <= 3


def test_a_unit_of_a_million_letters(coder):
    text = "abcdefg" * 150_000
    assert coder.decode(ids(coder, text)) == text


def test_messy_rows(cluttered, library):
    rows = cluttered.withColumn("ids", F.lit("clash"))
    out = bpe.encoded(rows, decoded_as="back")
    assert out.columns == [c for c in rows.columns if c != "ids"] + ["ids", "back"]
    found = out.collect()
    assert len(found) == rows.count()
    for row in found:
        text = row["text"] or ""
        assert row["ids"] == library.encode(text, add_special_tokens=False).ids
        assert row["back"] == text
    again = bpe.decoded(bpe.encoded(rows).select("doc_id", "ids", F.lit("x").alias("text")))
    texts = sorted((row["text"] or "") for row in rows.collect())
    assert sorted(row["text"] for row in again.collect()) == texts


def test_no_rows(empty):
    assert bpe.encoded(empty).collect() == []
    assert bpe.decoded(bpe.encoded(empty)).collect() == []


def test_query(spark, library):
    folder = "/root/testdata/sf0.001"
    texts = {
        row["doc_id"]: row["text"] or ""
        for row in spark.read.parquet(f"{folder}/documents.parquet").collect()
    }
    found = queries.op12_bpe(spark, folder).collect()
    assert len(found) == len(texts)
    for row in found:
        own = library.encode(texts[row["doc_id"]], add_special_tokens=False).ids
        back = library.decode(own, skip_special_tokens=False)
        assert row["n_tokens"] == len(own)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, own)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(back.encode()).hexdigest()
