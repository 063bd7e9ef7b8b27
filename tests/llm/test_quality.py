import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from adpulse.llm import quality, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _measured(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for k in range(len(words) - 2):
        if windows[tuple(words[k : k + 3])] > 1:
            covered |= {k, k + 1, k + 2}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }


def _check(rows, texts):
    for row in rows:
        expected = _measured(texts[row["doc_id"]])
        assert {name: row[name] for name in expected} == expected
        n, repeats = expected["n_words"], expected["n_repeat_words"]
        assert row["base_failed"] == (n < 50 or 100 * repeats > 50 * n)
        if row["base_failed"]:
            assert not row["kept"]
        else:
            assert row["kept"] == (row["posterior"] >= 0.5)


def test_query_matches_brute_force(spark, monkeypatch, documents):
    monkeypatch.setattr(queries, "table", lambda *_: documents)
    rows = queries.op4_quality_rules(spark, "").collect()
    texts = {row["doc_id"]: row["text"] for row in documents.collect()}
    assert len(rows) == len(texts)
    _check(rows, texts)


def test_agrees_with_labels(spark):
    folder = "/root/testdata/sf0.01"
    rows = queries.op4_quality_rules(spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    judged = rows.where("not base_failed").join(labels, "doc_id").select("kept", "quality")
    counts = Counter((row["kept"], row["quality"]) for row in judged.collect())
    assert counts[True, 1] >= 0.99 * (counts[True, 1] + counts[False, 1])
    assert counts[False, 0] >= 0.9 * (counts[True, 0] + counts[False, 0])


def test_messy_rows_and_clashing_columns(messy, cluttered, empty):
    rows, name = quality.judged(cluttered)
    assert name == "quality_"
    assert rows.columns[:-1] == cluttered.columns
    got = rows.select("doc_id", F.col(name)["n_words"].alias("n"), F.col(name)["kept"].alias("k"))
    got = got.collect()
    assert len(got) == messy.count()
    assert {(row["n"], row["k"]) for row in got if row["doc_id"] in (2, 3, 4)} == {(0, False)}
    assert quality.kept_rows(empty).collect() == []
    assert quality.kept_rows(empty).columns == empty.columns


def _brute_fit(counts, n_rules, rounds):
    """The same expectation-maximisation, row by row and in probabilities."""
    rows = [votes for votes, n in counts.items() for _ in range(n)]
    p = [(0.95, 0.25, 0.05)[min(votes.count("b"), 2)] for votes in rows]
    for _ in range(rounds):
        prior = min(max(sum(p) / len(p), 0.02), 0.98)
        right = []
        for k in range(n_rules):
            pairs = []
            for vote, sure in (("g", p), ("b", [1 - x for x in p])):
                hits = sum(x for v, x in zip(rows, sure) if v[k] == vote)
                cast = sum(x for v, x in zip(rows, sure) if v[k] != "-")
                pairs.append(min(max((hits + 1) / (cast + 2), 0.001), 0.999))
            right.append(pairs if sum(pairs) >= 1 else [0.5, 0.5])
        for i, votes in enumerate(rows):
            good, bad = prior, 1 - prior
            for k, vote in enumerate(votes):
                if vote == "g":
                    good, bad = good * right[k][0], bad * (1 - right[k][1])
                elif vote == "b":
                    good, bad = good * (1 - right[k][0]), bad * right[k][1]
            p[i] = good / (good + bad)
    return dict(zip(rows, p))


def test_fit_matches_row_by_row():
    counts = {"ggg": 40, "gg-": 10, "bbg": 6, "bb-": 4, "gbb": 3, "--b": 2, "---": 1}
    model = quality.fit(counts, 3, rounds=25)
    for votes, expected in _brute_fit(counts, 3, 25).items():
        assert quality.posterior(model, votes) == pytest.approx(expected, abs=1e-6)


def test_rules_that_agree_are_trusted_and_good_votes_never_hurt():
    counts = {"ggg": 900, "bbg": 50, "bbb": 30, "ggb": 20}
    model = quality.fit(counts, 3)
    assert quality.posterior(model, "bbg") < 0.5 < quality.posterior(model, "ggg")
    for k in range(3):
        votes = ["-"] * 3
        votes[k] = "g"
        assert quality.posterior(model, "".join(votes)) >= model.prior - 1e-12
    assert quality.posterior(quality.fit({}, 3), "---") == 0.5
