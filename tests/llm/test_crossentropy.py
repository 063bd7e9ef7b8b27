import math
import re
from collections import Counter

import pytest

from adpulse.llm import crossentropy

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def _targets(spark, ids):
    return spark.createDataFrame([(k,) for k in ids], "doc_id long")


def _brute(rows, chosen):
    """The same models with exact words and pairs for keys."""
    split = {k: WORD.findall((text or "").encode().lower()) for k, text in rows}
    counts = []
    for own in (chosen, set(split)):
        words, contexts, pairs = Counter(), Counter(), Counter()
        for doc_id in own:
            found = split[doc_id]
            words.update(found)
            contexts.update([None, *found[:-1]] if found else [])
            pairs.update(zip([None, *found[:-1]], found))
        counts.append((words, contexts, pairs))
    total = sum(counts[0][0].values())
    scale = (1.0, total / sum(counts[1][0].values()))
    size = 1 << crossentropy.WORD_BITS
    losses = {}
    for doc_id, found in split.items():
        means = []
        for (words, contexts, pairs), by in zip(counts, scale):
            loss = 0.0
            for before, word in zip([None, *found[:-1]], found):
                single = (by * words[word] + 1) / (total + size)
                double = by * pairs[before, word] + crossentropy.BACKOFF * single
                loss -= math.log(min(1, double / (by * contexts[before] + crossentropy.BACKOFF)))
            means.append(loss / len(found) if found else None)
        losses[doc_id] = (len(found), *means)
    return losses


def test_matches_exact_models(spark):
    rows = [(k, f"the cat{k % 3} sat on mat{k % 5} and Sat again") for k in range(40)]
    rows += [(100, None), (101, ""), (102, " \n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    chosen = set(range(0, 40, 3))
    expected = _brute(rows, chosen)
    got = crossentropy.differences(docs, _targets(spark, chosen)).collect()
    assert len(got) == len(rows)
    for row in got:
        n, target, background = expected[row["doc_id"]]
        assert row["n_tokens"] == n
        if n:
            # A slot that two words share moves a loss a little.
            assert row["target_loss"] == pytest.approx(target, abs=1e-3)
            assert row["background_loss"] == pytest.approx(background, abs=1e-3)
            assert row["difference"] == pytest.approx(target - background, abs=2e-3)
        else:
            assert row["difference"] is None


def test_target_like_documents_score_lower(spark):
    plain = [(k, "alpha beta gamma delta " * 5) for k in range(20)]
    other = [(k, "one two three four five " * 5) for k in range(20, 40)]
    docs = spark.createDataFrame(plain + other, "doc_id long, text string")
    scores = {
        row["doc_id"]: row["difference"]
        for row in crossentropy.differences(docs, _targets(spark, range(10))).collect()
    }
    assert max(scores[k] for k in range(20)) < min(scores[k] for k in range(20, 40))


def test_messy_rows(spark, messy, cluttered):
    rows = crossentropy.differences(cluttered, _targets(spark, [1, 5])).collect()
    # A row whose id occurs twice is scored twice, alike.
    assert len(rows) == messy.count()
    assert len({tuple(row) for row in rows if row["doc_id"] == 6}) == 1
    assert {row["n_tokens"] for row in rows if row["doc_id"] in (2, 3, 4)} == {0}


def test_no_targets_and_empty_table(spark, messy, empty):
    assert crossentropy.differences(empty, _targets(spark, [])).collect() == []
    rows = crossentropy.differences(messy, _targets(spark, [])).collect()
    uniform = math.log(1 << crossentropy.WORD_BITS)
    assert all(
        row["target_loss"] == pytest.approx(uniform, rel=1e-5) for row in rows if row["n_tokens"]
    )


def _exact(rows, chosen, size):
    """Losses under models over a vocabulary of ``size`` words."""
    split = {k: text.split() for k, text in rows}
    words, contexts, pairs = [[Counter(), Counter()] for _ in range(3)]
    for k, found in split.items():
        for model in (0, 1) if k in chosen else (1,):
            words[model].update(found)
            contexts[model].update([None, *found[:-1]])
            pairs[model].update(zip([None, *found[:-1]], found))
    total = sum(words[0].values())
    scales = (1.0, total / sum(words[1].values()))
    losses = {}
    for k, found in split.items():
        sums = [0.0, 0.0]
        for before, word in zip([None, *found[:-1]], found):
            for m, by in enumerate(scales):
                single = (by * words[m][word] + 1) / (total + size)
                double = by * pairs[m][before, word] + crossentropy.BACKOFF * single
                sums[m] -= math.log(double / (by * contexts[m][before] + crossentropy.BACKOFF))
        losses[k] = [loss / len(found) for loss in sums]
    return losses


def test_more_words_and_bigrams_than_slots(spark):
    """Every word and bigram has a count of its own, however many there are."""
    rows = [
        (k, " ".join(f"the w{(k * 999 + j * 17) % 300_007} v{k}x{j}" for j in range(1500)))
        for k in range(300)
    ]
    n_words = len({word for _, text in rows for word in text.split()})
    assert n_words > 1 << crossentropy.WORD_BITS
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    chosen = set(range(0, 300, 3))
    expected = _exact(rows, chosen, n_words)
    got = crossentropy.differences(docs, _targets(spark, chosen)).collect()
    assert len(got) == len(rows)
    for row in got:
        target, background = expected[row["doc_id"]]
        assert row["target_loss"] == pytest.approx(target, rel=1e-9)
        assert row["background_loss"] == pytest.approx(background, rel=1e-9)
