import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from adpulse.llm import pii, registry

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """The input and result of every stage."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = []
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, FOLDER)
        rows = result.collect()
        found.append((name, docs.collect(), rows))
        docs = spark.createDataFrame(rows, result.schema)
    return found


def test_stages(steps):
    assert [name for name, _, _ in steps] == [
        "quality_rules", "near_dedup", "redact_pii", "mix_sources", "encode_pieces"
    ]
    for _, _, rows in steps[:-1]:
        assert rows and rows[0].asDict().keys() == set(corpus_pipeline.COLUMNS)


def test_quality_keeps_rows_as_they_are(steps):
    _, before, after = steps[0]
    assert 0 < len(after) < len(before)
    assert {tuple(row) for row in after} <= {tuple(row) for row in before}


def _set(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


def test_near_dedup_keeps_one_of_each_group(steps):
    _, before, after = steps[1]
    sets = {row["doc_id"]: _set(row["text"]) for row in before}
    top = {k: k for k in sets}

    def find(k):
        while top[k] != k:
            k = top[k]
        return k

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                low, high = sorted((find(a), find(b)))
                top[high] = low
    assert sorted(row["doc_id"] for row in after) == sorted({find(k) for k in ids})


def test_redaction_leaves_no_base_span(spark, steps):
    _, before, after = steps[2]
    assert len(before) == len(after)
    rows = spark.createDataFrame([(row["doc_id"], row["text"]) for row in after],
                                 "doc_id long, text string")
    left = pii.found_spans(rows, None).where(F.size("pii.base") > 0)
    assert left.count() == 0
    texts = {row["doc_id"]: row["text"] for row in before}
    for row in after:
        assert row["n_chars"] == len(row["text"])
        if "[PII]" not in row["text"]:
            assert row["text"] == texts[row["doc_id"]]


def test_mix_repeats_at_most_twice(steps):
    _, before, after = steps[3]
    rows = {row["doc_id"]: tuple(row) for row in before}
    counts: dict = {}
    for row in after:
        assert tuple(row) == rows[row["doc_id"]]
        counts[row["doc_id"]] = counts.get(row["doc_id"], 0) + 1
    assert set(counts.values()) <= {1, 2}
    words = {k: len(re.findall(r"[^\x20\x09-\x0D]+", row[1])) for k, row in rows.items()}
    taken = sum(words[k] * n for k, n in counts.items())
    assert taken == pytest.approx(1.5 * sum(words.values()), rel=0.15)


def test_pieces_of_every_document(steps):
    _, before, after = steps[4]
    assert len(before) == len(after) and all(row["round_trip"] for row in after)


def test_run_is_the_stages(spark, steps):
    got = registry.QUERIES["pipeline"](spark, FOLDER).collect()
    assert sorted(map(str, got)) == sorted(map(str, steps[-1][2]))


def test_messy_rows_and_empty_table(spark, messy, cluttered, empty):
    for start in (cluttered, empty):
        docs = start
        for _, stage in corpus_pipeline.STAGES:
            result = stage(spark, docs, FOLDER)
            docs = spark.createDataFrame(result.collect(), result.schema)
    # Each stage by itself on rows no other stage has cleaned.
    counts = {name: stage(spark, messy, FOLDER).count() for name, stage in corpus_pipeline.STAGES}
    assert counts["near_dedup"] == messy.count() - 2
    assert counts["redact_pii"] == counts["encode_pieces"] == messy.count()


def test_near_dedup_loses_no_text(spark):
    """One id on unlike texts, rows without an id, copies among them."""
    texts = [" ".join(f"{name}{k}" for k in range(60)) for name in ("ant", "bee", "cat", "dog")]
    near = texts[1].replace("bee59", "end")
    rows = [
        (1, texts[0]), (1, texts[1]), (1, texts[2]), (2, texts[0]), (None, texts[3]),
        (None, texts[3]), (None, near), (None, texts[2]), (5, texts[3]), (5, texts[3]),
    ]
    docs = spark.createDataFrame([(k, t, "en", "a", len(t)) for k, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    expected = sorted([(1, texts[0]), (1, texts[1]), (1, texts[2]), (5, texts[3])])
    for parts in (1, 4):
        found = corpus_pipeline.near_dedup(spark, docs.repartition(parts), FOLDER)
        assert sorted((row["doc_id"], row["text"]) for row in found.collect()) == expected


def test_registry(spark):
    names = list(registry.QUERIES)
    assert names == [name for name in names if re.fullmatch(r"op\d+_\w+|pipeline", name)]
    assert len(names) == 14 and set(registry.ORACLES) <= set(names)
