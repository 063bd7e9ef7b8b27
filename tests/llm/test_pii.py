import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from adpulse.llm import pii, queries

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits):
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (2 if place % 2 else 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _passes(kind, found):
    digits = re.sub("[^0-9]", "", found)
    return {
        "email": lambda: True,
        "ip": lambda: all(int(part) <= 255 for part in found.split(".")),
        "card": lambda: 12 <= len(digits) <= 19 and _luhn(digits),
        "phone": lambda: 9 <= len(digits) <= 15,
    }[kind]()


def _base(text):
    spans = [
        (m.start(), number, m.end())
        for number, (kind, pattern) in enumerate(PATTERNS.items())
        for m in re.finditer(pattern, text or "")
        if _passes(kind, m.group())
    ]
    return sorted(spans)


def _listed(spans):
    kinds = list(PATTERNS)
    return ",".join(f"{kinds[k]}:{start}:{end}" for start, k, end in spans)


def _found(spark, texts, trees=None):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = pii.found_spans(docs, trees).select(
        "doc_id", pii.listed(F.col("pii.base")).alias("base"),
        pii.listed(F.col("pii.spans")).alias("spans"),
        pii.redacted(F.col("text"), F.col("pii.spans")).alias("clean"),
    )
    return [row for row in sorted(rows.collect())]


TRICKY = [
    "a@b.c", "a@b.com_x@y.z", "..%+@a-.b-..", "a@b", "x@@y.z", "@a.b", "a@b.c@d.e.f",
    "1.2.3.4.5.6.7.8", "256.1.1.1 255.255.255.255", "0001.02.003.4", "1.2.3", "9999.1.1.1.1",
    "4111 1111 1111 1111", "4111-1111-1111-1111-", "4111  1111", "411111111111111", "12",
    "00000000000000000000", "+1 (017) 555-7713", "+12345678", "++1 234 567 89", "+1...2", "+1",
    "é🙂 a@b.c 🙂 1.2.3.4 ñ", "", None, "1" * 3000, "a." * 500 + "@b.c",
    "+49 30 1234567, 10.0.0.1 and joe@x.org; 4111111111111111.",
]


def test_base_matches_python(spark):
    for row, text in zip(_found(spark, TRICKY), TRICKY):
        assert row["base"] == row["spans"] == _listed(_base(text)), text


@given(st.lists(st.text(alphabet="a1 2.@+-()é\n", max_size=50), min_size=1, max_size=20))
@settings(max_examples=15, deadline=None)
def test_base_matches_python_on_anything(spark, texts):
    for row, text in zip(_found(spark, texts), texts):
        assert row["base"] == _listed(_base(text)), text


def test_many_matches_are_placed_right(spark):
    text = " ".join(f"a{k}@b.c" for k in range(2000))
    assert _found(spark, [text])[0]["base"] == _listed(_base(text))


def test_query_on_documents(spark):
    folder = "/root/testdata/sf0.001"
    rows = queries.op7_pii(spark, folder).collect()
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    texts = {row["doc_id"]: row["text"] for row in docs}
    assert len(rows) == len(texts)
    for row in rows:
        spans = _base(texts[row["doc_id"]])
        counts = [sum(k == n for _, n, _ in spans) for k in range(4)]
        assert [row[f"n_{kind}"] for kind in PATTERNS] == counts
        assert row["base_sha256"] == hashlib.sha256(_listed(spans).encode()).hexdigest()
        assert set(_listed(spans).split(",")) - {""} <= set(row["spans"].split(","))


@pytest.fixture(scope="module")
def trees(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    return pii.fit(docs)


def test_disguised_data_is_found_and_clean_text_left_alone(spark, trees):
    texts = [
        "write to john.doe (at) example (dot) com today",
        "the host 10[.]20[.]30[.]40 answers",
        "the cat sat at the mat in 1999, item 12 of 300",
        "chapter 1.2.3 on 2024-01-02 at 12:30",
    ]
    rows = _found(spark, texts, trees)
    assert "email:" in rows[0]["spans"] and "ip:" in rows[1]["spans"]
    assert rows[0]["clean"] == "write to [PII] today"
    assert [row["spans"] for row in rows[2:]] == ["", ""]
    assert [row["clean"] for row in rows[2:]] == texts[2:]


def test_expression_is_the_model(spark, trees):
    """The printed trees as an expression give what a walk along them gives."""
    values = [float(k % 3) for k in range(18)]
    row = spark.createDataFrame([(values,)], "v array<double>")
    got = row.select(pii.probability(trees.text, F.col("v")).alias("p")).first()["p"]
    total, lines = 0.0, [line for line in trees.text.splitlines() if line.strip()]
    weight, open_until = 0.0, None
    for line in lines:
        depth = len(line) - len(line.lstrip())
        if match := re.search(r"Tree \d+ \(weight ([-+.0-9Ee]+)\)", line):
            weight, open_until = float(match[1]), None
        elif open_until is not None and depth > open_until:
            continue
        elif match := re.search(r"\(feature (\d+) (<=|>) ([-+.0-9Ee]+)\)", line):
            value, limit = values[int(match[1])], float(match[3])
            holds = value <= limit if match[2] == "<=" else value > limit
            open_until = None if holds else depth
        elif match := re.search(r"Predict: ([-+.0-9Ee]+)", line):
            total += weight * float(match[1])
    assert got == pytest.approx(1 / (1 + 2.718281828459045 ** (-2 * total)))


def test_redaction_merges_overlaps(spark):
    rows = spark.createDataFrame([("0123456789",)], "t string").select(
        pii.redacted(
            F.col("t"),
            F.expr("array(struct(1 as start, 0 as kind_no, 4 as end),"
                   " struct(2 as start, 1 as kind_no, 6 as end),"
                   " struct(8 as start, 0 as kind_no, 9 as end))"),
        ).alias("r")
    )
    assert rows.first()["r"] == "0[PII]67[PII]9"


def test_messy_rows(spark, messy, cluttered, empty, trees):
    rows = pii.found_spans(cluttered, trees)
    assert rows.count() == messy.count()
    assert pii.found_spans(empty, trees).collect() == []
    assert pii.fit(empty.select("doc_id", "text")) is None
    assert pii.found_spans(empty, None).collect() == []


def test_no_python_in_the_plan(spark, monkeypatch, documents):
    monkeypatch.setattr(queries, "table", lambda *_: documents)
    plan = queries.op7_pii(spark, "")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_trees_do_not_fill_the_plan(spark, trees, documents):
    """The model is of its full size, and the plan as large as that of one tree."""
    parts = re.split(r"(?=Tree \d+ \()", trees.text)
    assert len(parts) == 1 + 12
    assert max(len(line) - len(line.lstrip()) for line in trees.text.splitlines()) > 4 + 3
    one = trees._replace(text="".join(parts[:2]))
    sizes = []
    for model in (one, trees):
        plan = pii.found_spans(documents, model)._jdf.queryExecution().optimizedPlan().toString()
        sizes.append(plan.count("CASE WHEN"))
    assert sizes[0] == sizes[1]


def test_every_document_is_learned_from(spark):
    """Of 60,000 texts the only ones with examples are those that a draw of 20,000 leaves out."""
    place = F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(1 << 30))
    shown = F.concat(
        F.lit("mail joe"), "id", F.lit("@example.org or 10.0."), F.col("id") % 250, F.lit(".7, not 123-4567-"),
        F.col("id") % 10,
    )
    held = (place > 1 << 29) & (F.col("id") % 50 == 0)
    docs = spark.range(60_000).select(
        F.col("id").alias("doc_id"), F.when(held, shown).otherwise(F.lit("none")).alias("text")
    )
    trees = pii.fit(docs)
    assert trees and trees.thresholds.keys() == {"email", "ip"}
    rows = _found(spark, ["write to ann.lee (at) example (dot) com", "call 123-4567-5 now"], trees)
    assert "email:" in rows[0]["spans"] and rows[1]["spans"] == ""


def test_many_different_examples(spark, monkeypatch):
    """More different examples than a task takes, and than the learner itself looks at by default:
    ten flags, each of one example that is frequent, are all found, whatever the tasks."""
    many, copies = 24_000, 500

    def made(docs):
        flag = F.when(F.col("id") >= many, F.floor((F.col("id") - many) / copies))
        flags = [F.coalesce((flag == k).cast("double"), F.lit(0.0)) for k in range(10)]
        place = F.coalesce(flag * 1_900 + 11, F.col("id")).cast("double")
        return docs.select(
            F.lit("email").alias("kind"),
            F.array(F.lit(0.0), place, *[F.lit(0.0)] * 6, *flags).alias("values"),
            flag.isNull().cast("double").alias("label"),
        )

    docs = spark.range(many + 10 * copies)
    fold = F.pmod(F.xxhash64("values", "label"), F.lit(4))
    learned = made(docs).where((F.col("label") == 0) & (fold > 0)).select("values").distinct()
    expected = {row["values"].index(1.0) for row in learned.collect()}
    assert len(expected) > 4
    monkeypatch.setattr(pii, "examples", made)
    for size in (pii.EXAMPLES_PER_TASK, 5_000):
        monkeypatch.setattr(pii, "EXAMPLES_PER_TASK", size)
        used = {int(k) for k in re.findall(r"feature (\d+) <=", pii.fit(docs).text)}
        assert expected <= used


def test_thresholds_match_a_walk_over_all_rows(spark):
    draw = random.Random(5)
    rows = []
    for kind, share in (("email", 0.99), ("ip", 0.97), ("card", 0.5), ("phone", 0.985)):
        for _ in range(3000):
            p = draw.choice([draw.random(), round(draw.random(), 2)])
            good = draw.random() < (share if p > 0.5 else 0.3)
            rows.append((kind, float(good), float(draw.randint(1, 9)), p))
    expected = {}
    for kind in PATTERNS:
        own = [(p, label, weight) for k, label, weight, p in rows if k == kind and p >= 0.5]
        for p in {p for p, _, _ in own}:
            above = [(label * weight, weight) for q, label, weight in own if q >= p]
            if sum(g for g, _ in above) >= 0.98 * sum(w for _, w in above):
                expected[kind] = min(p, expected.get(kind, 1.0))
    judged = spark.createDataFrame(rows, "kind string, label double, weight double, p double")
    assert pii._thresholds(judged) == expected
    assert pii._thresholds(judged, cells=2) == expected
    assert expected.keys() >= {"email"} and "card" not in expected
