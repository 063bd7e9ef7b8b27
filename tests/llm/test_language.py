import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from adpulse.llm import language, queries


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    rows = queries.op8_language_id(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    got = rows.join(docs, "doc_id").collect()
    held_out = [row for row in got if row["held_out"]]
    assert len(held_out) > 150
    assert np.mean([row["lang"] == row["lang_pred"] for row in held_out]) > 0.98
    assert all(0 <= row["score"] <= 1 for row in got)


def test_held_out_languages_are_not_learned(spark, monkeypatch, documents):
    """Changing the language of held-out rows changes nothing."""
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    results = []
    for lang in (F.col("lang"), F.when(held_out, "xx").otherwise(F.col("lang"))):
        docs = documents.withColumn("lang", lang)
        monkeypatch.setattr(queries, "table", lambda *_, d=docs: d)
        results.append(sorted(queries.op8_language_id(spark, "").collect()))
    assert results[0] == results[1]
    assert not any(row["lang_pred"] == "xx" for row in results[0])


def _grams(text):
    letters = "".join(c.lower() if c.isalpha() else " " for c in text)
    letters = f" {' '.join(letters.split())} "
    return {
        letters[k : k + n]
        for n in (1, 2, 3)
        for k in range(len(letters) - n + 1)
        if " " not in letters[k + 1 : k + n - 1]
    }


def test_presence_matches_sets_and_folded_weights_the_kernel():
    texts = ["the cat sat", "der Hund, der saß", "le chat", "the dog", "x"]
    model = language.train(texts, ["en", "de", "fr", "en", "de"])
    raw, cuts = language.utf8(pa.array(texts))
    rows = language._presence(raw, cuts, model.symbols, model.features)
    known = set().union(*map(_grams, texts))
    assert rows.shape[1] == len(known)
    for k, text in enumerate(texts):
        assert (rows[k] > 0).sum() == len(_grams(text))
    # One text's kernel with another is the grams in both over the root of both sizes.
    a, b = _grams(texts[0]), _grams(texts[3])
    assert rows[0] @ rows[3] == pytest.approx(len(a & b) / (len(a) * len(b)) ** 0.5, rel=1e-5)
    best, _ = language.score(model, raw, cuts)
    assert [model.languages[k] for k in best] == ["en", "de", "fr", "en", "de"]


def test_batches_do_not_change_a_score():
    texts = ["the cat sat", "der Hund", "", "x y z", "le chat noir"]
    model = language.train(texts, ["en", "de", "fr", "en", "fr"])
    raw, cuts = language.utf8(pa.array(texts))
    together = language.score(model, raw, cuts)[1]
    alone = [language.score(model, *language.utf8(pa.array([t])))[1][0] for t in texts]
    assert together == pytest.approx(alone, abs=1e-6)


def test_messy_rows(spark, monkeypatch, messy, cluttered, empty):
    monkeypatch.setattr(queries, "table", lambda *_: cluttered)
    rows = {row["doc_id"]: row for row in queries.op8_language_id(spark, "").collect()}
    assert queries.op8_language_id(spark, "").count() == messy.count()
    for doc_id in (2, 3, 4):
        assert (rows[doc_id]["lang_pred"], rows[doc_id]["score"]) == ("und", 0.0)
    monkeypatch.setattr(queries, "table", lambda *_: empty)
    assert queries.op8_language_id(spark, "").collect() == []
    unlabelled = messy.withColumn("lang", F.lit(None).cast("string"))
    monkeypatch.setattr(queries, "table", lambda *_: unlabelled)
    assert {row["lang_pred"] for row in queries.op8_language_id(spark, "").collect()} == {"und"}


def _texts_of(alphabets, n, seed):
    """``n`` texts of each language, the languages in turn, from letters of its own."""
    draw = np.random.default_rng(seed)
    texts, labels = [], []
    for _ in range(n):
        for k, letters in enumerate(alphabets):
            words = ["".join(draw.choice(list(letters), 4)) for _ in range(8)]
            texts.append(" ".join(words))
            labels.append(f"l{k:03}")
    return texts, labels


def _accuracy(alphabets):
    model = language.train(*_texts_of(alphabets, language.PER_LANGUAGE, 1))
    texts, labels = _texts_of(alphabets, 10, 2)
    best, _ = language.score(model, *language.utf8(pa.array(texts)))
    return np.mean([model.languages[k] == label for k, label in zip(best, labels)])


@pytest.mark.parametrize("n", [2, 3, 8, 12])
def test_every_language_has_landmarks(n):
    letters = "abcdefghijklmnopqrstuvwxyzßäöüéèêñçøåæ"
    assert _accuracy([letters[3 * k : 3 * k + 3] for k in range(n)]) == 1
    labels = [f"l{k % n}" for k in range(n * language.PER_LANGUAGE)]
    counts = np.unique(np.array(labels)[language._landmarks(labels)], return_counts=True)[1]
    assert len(counts) == n and len(set(counts)) == 1


def test_every_letter_is_learned():
    """Scripts with more letters together than any small alphabet, two beyond the first plane."""
    firsts = (0x61, 0x430, 0x3B1, 0x627, 0x4E00, 0x4F00, 0xAC00, 0xB000, 0x20000, 0x20100)
    widths = (26, 32, 17, 20, 200, 200, 200, 200, 32, 32)
    scripts = ["".join(map(chr, range(at, at + n))) for at, n in zip(firsts, widths)]
    assert _accuracy(scripts) == 1


def test_every_language_is_learned(spark):
    rows = [(k, f"{chr(0x4E00 + k % 250) * 3} x", f"l{k % 250:03}") for k in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got, model = language.identified(docs, F.lit(True))
    assert len(model.languages) == 250
    assert all(row["lang"] == row["language"]["lang"] for row in got.collect())
