import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from adpulse.llm import pieces, queries

TEXTS = [
    None, "", " ", "  two  spaces ", "a b", "tab\tnew\nline\r\n", "\n", "▁ mark▁inside ▁",
    "日本語 テスト 🙂", "x" * 400, "The cat sat on the mat. " * 50, "ünïcödé \x00 \x7f",
]


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load()


def _none():
    return pieces.Lookup(np.zeros(0, np.uint64), np.zeros(1, np.int64), np.zeros(0, np.int32))


def _cheapest(word, vocabulary):
    """Lowest cost of all ways through a word, by recursion over its ends."""
    best = {0: 0}
    for end in range(1, len(word) + 1):
        costs = []
        for start in range(end):
            piece = word[start:end]
            if piece in vocabulary.costs and not (start and piece.startswith(pieces.MARK)):
                costs.append(best[start] + vocabulary.costs[piece])
            elif end - start == 1:
                costs.append(best[start] + len(piece.encode()) * vocabulary.byte_cost)
        best[end] = min(costs)
    return best[len(word)]


def _cost(ids, vocabulary):
    by_id = {k: vocabulary.costs[piece] for piece, k in vocabulary.ids.items()}
    return sum(by_id.get(k, vocabulary.byte_cost) for k in ids)


def test_lattice_gives_the_cheapest_way_and_the_task_the_same(spark, vocabulary):
    draw = random.Random(1)
    words = {"▁the", "the", "▁", "▁日本", "a▁b", "▁a▁b", "xxxx", "🙂", "▁ünïcödé", "\x00z"}
    words |= {
        draw.choice(["", "▁"]) + "".join(draw.choice("theandoring") for _ in range(draw.randint(1, 14)))
        for _ in range(150)
    }
    frame = spark.createDataFrame([(word,) for word in sorted(words)], "word string")
    rows = pieces.encode_words(frame, vocabulary).collect()
    assert {row["word"] for row in rows} == words
    own = pieces.Encoder(vocabulary, _none())
    for row in rows:
        word, ids = row["word"], row["ids"]
        marked = word.startswith("▁")
        assert own.word((word[1:] if marked else word).encode(), marked) == ids
        assert _cost(ids, vocabulary) == _cheapest(word, vocabulary)
        assert b"".join(vocabulary.decoded[k] for k in ids).decode() == (
            (" " if marked else "") + word[marked:]
        )


@pytest.mark.parametrize("most", [0, 3, 1 << 19])
def test_round_trip_whatever_is_looked_up(spark, vocabulary, most):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    rows = pieces.encoded(docs, most=most).select(
        "doc_id", "pieces.*", pieces.decoded("pieces.ids", vocabulary).alias("back")
    )
    rows = sorted(rows.collect())
    assert [row["back"] for row in rows] == [text or "" for text in TEXTS]
    assert all(row["round_trip"] for row in rows)
    own = pieces.Encoder(vocabulary, _none())
    one = own.word(b"cat", True)
    assert [k for k in rows[10]["ids"]].count(one[0]) >= 50


def test_documents(spark, vocabulary):
    folder = "/root/testdata/sf0.001"
    rows = queries.op5_sentencepiece(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    got = rows.withColumn("back", pieces.decoded("ids", vocabulary)).join(docs, "doc_id").collect()
    assert len(got) == docs.count()
    assert all(row["back"] == (row["text"] or "") and row["round_trip"] for row in got)
    assert all(row["n_pieces"] == len(row["ids"]) for row in got)


def test_frequent_words_keep_to_the_bound(spark):
    texts = ["a a a a b b b c c", "b a c d d", "once"]
    docs = spark.createDataFrame([(text,) for text in texts], "text string")

    def words(most):
        return {row["word"] for row in pieces.frequent_words(docs, most).collect()}

    assert words(1) == {"▁a"}
    assert words(2) == {"▁a", "▁b"}
    assert words(3) == {"▁a", "▁b", "▁c"}
    assert words(9) == {"▁a", "▁b", "▁c", "▁d"}
    assert words(0) == set()


def test_messy_rows(messy, cluttered, empty):
    rows = pieces.encoded(cluttered).select("doc_id", F.col("pieces.*")).collect()
    assert len(rows) == messy.count() and all(row["round_trip"] for row in rows)
    assert pieces.encoded(empty).collect() == []
