"""Personal data: candidates, boosted trees and calibrated thresholds.

Spans come from two places. Base patterns with their checks (parts of an address, check digits,
numbers of digits) are certain and always stay. Generators of high recall propose further spans,
which may overlap: written-out addresses, numbers without their prefix or with other separators.
Gradient-boosted trees judge the format and the context of a proposal, and a threshold per kind,
calibrated for precision on rows the trees have not seen, selects what is added.

Nothing is annotated, so the trees learn from the base: a base span is a positive example, and so
is each way of disguising it (sign left out, separators replaced, written out) in the same context;
a proposal that fails the checks is a negative one. Examples come from every document. Equal ones
become one row with their count, and what is learned from these rows is spread over tasks by their
number; nothing but sums, the trees and the thresholds reaches the driver.

The trees become literal arrays of nodes and one SQL expression that walks them, so all spans of a
text are found within its row: no shuffle, no join, no code outside the JVM, and a plan as large for
many trees as for one. Offsets are code points, the end is exclusive.

Defined results: null counts as empty, which has no span. Matches of one kind do not overlap; those
of different kinds may. With no positive or no negative example nothing is added to the base.
Repeated rows get equal results. Other columns pass through; those named like the result or its
steps (``pii``, ``pii_text``, ``pii_proposed``) are replaced.
"""

from __future__ import annotations

import re
from math import isqrt
from typing import NamedTuple

import numpy as np
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
CONTEXT = 24
TREES, DEPTH = 12, 4
PRECISION = 0.98
EXAMPLES_PER_TASK = 50_000
BINS = 32

# The base patterns. Each match starts where a search from left to right finds it;
# the look-behinds only spare starts within a run that has failed as a whole.
_LOCAL = r"[A-Za-z0-9._%+-]"
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

# Generators of proposals. Each has a kind; numbers are proposed as both.
_AT, _DOT = r"(?:@| ?[(\[]at[)\]] ?)", r"(?:\.| ?[(\[]dot[)\]] ?)"
_NUMBER = r"(?<![0-9])\+?\(?[0-9](?:[\x20().\x2F-]{0,2}[0-9]){6,24}+(?![0-9])"
PROPOSALS = {
    "email": rf"(?<!{_LOCAL}){_LOCAL}++{_AT}[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9.])[0-9]{1,3}+(?:(?:\.| ?[(\[](?:\.|dot)[)\]] ?)[0-9]{1,3}+){3}(?![0-9.])",
    "card": _NUMBER,
    "phone": _NUMBER,
}
#: What a text must have for a pattern to be tried at all.
_NEEDS = {"email": r"@|[(\[]at[)\]]", "ip": "[0-9]", "card": "[0-9]", "phone": "[0-9]"}
_CUES = {
    "email": "mail|contact|kontakt|correo|courriel",
    "ip": "ip|host|server|address|adresse",
    "card": "card|karte|carte|tarjeta|visa|credit",
    "phone": "tel|phone|fon|call|mobil|móvil|fax",
}


# --- matches with offsets --------------------------------------------------------------


def _running(lengths: Column, block: int = 512) -> Column:
    """Sum of the numbers before each one. In blocks, as appending to an array copies it."""

    def before(numbers: Column) -> Column:
        start = F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(
            numbers,
            start,
            lambda acc, x: F.struct(
                (acc["sum"] + x).alias("sum"),
                F.concat(acc["out"], F.array(acc["sum"])).alias("out"),
            ),
            lambda acc: acc["out"],
        )

    count = F.floor((F.size(lengths) + (block - 1)) / block).cast("int")
    blocks = F.transform(
        F.sequence(F.lit(1), F.greatest(count, F.lit(1))),
        lambda k: F.slice(lengths, (k - 1) * block + 1, block),
    )
    sums = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda acc, x: acc + x))
    within = F.transform(blocks, before)
    return F.flatten(
        F.zip_with(within, before(sums), lambda w, offset: F.transform(w, lambda x: x + offset))
    )


def _spans(gaps: Column, found: Column, at: Column) -> Column:
    def span(x: Column, k: Column) -> Column:
        start = at[k] + F.length(gaps[k])
        return F.struct(
            start.alias("start"),
            (start + F.length(x)).alias("end"),
            x.alias("found"),
            F.substring(gaps[k], -CONTEXT, CONTEXT).alias("before"),
            F.substring(gaps[k + 1], 1, CONTEXT).alias("after"),
        )

    return F.transform(found, span)


def _located(rows: DataFrame, name: str, text: str, patterns: dict[str, str]) -> DataFrame:
    """A column ``name``: per kind an array of ``start, end, found, before, after``. In steps, so
    that each pattern is searched once for gaps and once for matches."""
    steps = []
    for kind, pattern in patterns.items():
        worth = F.col(text).rlike(_NEEDS[kind])
        none = F.array().cast("array<string>")
        steps.append(F.when(worth, F.split(text, pattern, -1)).otherwise(none).alias(f"{kind}_gaps"))
        found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        steps.append(F.when(worth, found).otherwise(none).alias(f"{kind}_found"))
    rows = rows.withColumn(name, F.struct(*steps))
    steps = []
    for kind in patterns:
        gaps, found = F.col(name)[f"{kind}_gaps"], F.col(name)[f"{kind}_found"]
        lengths = F.zip_with(
            found, F.slice(gaps, 1, F.size(found)), lambda x, gap: F.length(x) + F.length(gap)
        )
        empty = F.array().cast("array<int>")
        steps += [
            gaps.alias(f"{kind}_gaps"),
            found.alias(f"{kind}_found"),
            F.when(F.size(found) > 0, _running(lengths)).otherwise(empty).alias(f"{kind}_at"),
        ]
    rows = rows.withColumn(name, F.struct(*steps))
    steps = []
    for kind in patterns:
        gaps, found, at = (F.col(name)[f"{kind}_{part}"] for part in ("gaps", "found", "at"))

        steps.append(_spans(gaps, found, at).alias(kind))
    return rows.withColumn(name, F.struct(*steps))


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _passes(kind: str, found: Column) -> Column:
    """The check a base match of the kind must pass."""
    count = F.length(_digits(found))
    return {
        "email": F.lit(True),
        "ip": found.rlike(rf"\A{_BYTE}(?:\.{_BYTE}){{3}}\z"),
        "card": F.when(count.between(12, 19), F.call_function("luhn_check", _digits(found))).otherwise(False),
        "phone": count.between(9, 15),
    }[kind]


def _checked(kind: str, spans: Column) -> Column:
    return F.filter(spans, lambda s: _passes(kind, s["found"]))


def with_base(docs: DataFrame, name: str, text: str = "text") -> DataFrame:
    """``docs`` with a column ``name``: per kind the base spans."""
    rows = docs.withColumn(name, F.coalesce(F.col(text).cast("string"), F.lit("")))
    rows = rows.withColumn(f"{name}_text", F.col(name))
    rows = _located(rows, name, f"{name}_text", BASE)
    checked = [_checked(kind, F.col(name)[kind]).alias(kind) for kind in KINDS]
    return rows.withColumn(name, F.struct(*checked))


# --- features and trees ----------------------------------------------------------------


def _has(found: Column, pattern: str) -> Column:
    return found.rlike(pattern).cast("double")


def features(kind: str, span: Column) -> Column:
    """Format and context of a proposal as an array of numbers."""
    found, before, after = span["found"], span["before"], span["after"]
    digits = _digits(found)
    groups = F.filter(F.split(found, "[^0-9]+"), lambda g: g != "")
    longest = F.aggregate(groups, F.lit(0), lambda acc, g: F.greatest(acc, F.length(g)))
    last_label = F.regexp_extract(found, r"([A-Za-z]*)\z", 1)
    plain_ip = F.regexp_replace(found, r" ?[(\[](?:\.|dot)[)\]] ?", ".")
    return F.array(
        F.lit(float(KINDS.index(kind))),
        F.length(digits).cast("double"),
        F.size(groups).cast("double"),
        longest.cast("double"),
        F.length(found).cast("double"),
        _has(found, r"^\+"),
        _has(found, r"\("),
        _has(found, r"[0-9]\.[0-9]"),
        _has(found, r"[0-9][ ][0-9]"),
        _has(found, r"[0-9]-[0-9]"),
        _has(found, r"/"),
        F.when(F.length(digits).between(12, 19), F.call_function("luhn_check", digits))
        .otherwise(False)
        .cast("double"),
        _has(plain_ip, rf"\A{_BYTE}(?:\.{_BYTE}){{3}}\z"),
        _has(found, r"[(\[](?:at|dot|\.)[)\]]"),
        F.length(last_label).cast("double"),
        _has(before, r"[\p{L}\p{N}_=\x22'/#]\z"),
        _has(after, r"\A[\p{L}\p{N}_/@]"),
        _has(F.lower(before), rf"\b(?:{_CUES[kind]})"),
    )


def _disguises(kind: str, found: Column) -> list[Column]:
    """Ways of writing a base span that the base patterns do not find."""
    written = {
        "email": [
            F.regexp_replace(F.regexp_replace(found, "@", " (at) "), r"\.(?=[A-Za-z0-9-]+\z)", " (dot) "),
            F.regexp_replace(F.regexp_replace(found, "@", "[at]"), r"\.(?=[A-Za-z0-9-]+\z)", "[dot]"),
        ],
        "ip": [F.regexp_replace(found, r"\.", "[.]"), F.regexp_replace(found, r"\.", " [dot] ")],
        "card": [
            F.regexp_replace(_digits(found), "([0-9]{4})(?=[0-9])", "$1."),
            F.regexp_replace(_digits(found), "([0-9]{4})(?=[0-9])", "$1/"),
        ],
        "phone": [
            F.regexp_replace(found, r"\A\+", ""),
            F.regexp_replace(found, r"\A\+[0-9]{1,2}[\x20().-]+(?=[0-9(])", ""),
        ],
    }
    return written[kind]


def _apart(span: Column, others: Column) -> Column:
    """Whether a span overlaps none of the others."""
    return ~F.exists(others, lambda o: (o["start"] < span["end"]) & (span["start"] < o["end"]))


class Trees(NamedTuple):
    """Boosted trees as text, and the probability from which a proposal of a kind is taken; a
    kind without a threshold is never added to."""

    text: str
    thresholds: dict[str, float]


_SPLIT = re.compile(r"(If|Else) \(feature (\d+) (<=|>) ([-+.0-9Ee]+)\)")
_LEAF = re.compile(r"Predict: ([-+.0-9Ee]+)")
_TREE = re.compile(r"Tree \d+ \(weight ([-+.0-9Ee]+)\)")


class Nodes(NamedTuple):
    """The nodes of all trees. A leaf leads to itself, and has its weighted prediction."""

    feature: list[int]
    limit: list[float]
    below: list[int]
    above: list[int]
    value: list[float]


def _add_tree(lines: list[str], weight: float, nodes: Nodes) -> int:
    """Add one printed tree, take its lines off the list; the number of nodes below its root."""
    line = lines.pop(0)
    at = len(nodes.feature)
    if leaf := _LEAF.search(line):
        for column, x in zip(nodes, (0, 0.0, at, at, weight * float(leaf[1])), strict=True):
            column.append(x)
        return 0
    split = _SPLIT.search(line)
    for column, x in zip(nodes, (int(split[2]), float(split[4]), at + 1, 0, 0.0), strict=True):
        column.append(x)
    depth = _add_tree(lines, weight, nodes)
    lines.pop(0)  # Else
    nodes.above[at] = len(nodes.feature)
    return 1 + max(depth, _add_tree(lines, weight, nodes))


def probability(text: str, values: Column) -> Column:
    """What the printed model gives for an array of features."""
    nodes, roots, depth = Nodes([], [], [], [], []), [], 0
    for part in re.split(r"(?=Tree \d+ \()", text)[1:]:
        lines = [line for line in part.splitlines() if line.strip()]
        weight = float(_TREE.search(lines.pop(0))[1])
        roots.append(len(nodes.feature))
        depth = max(depth, _add_tree(lines, weight, nodes))
    feature, limit, below, above, value = (
        F.lit(np.array(column, kind))
        for column, kind in zip(nodes, (np.int32, float, np.int32, np.int32, float), strict=True)
    )

    def step(at: Column, _: Column) -> Column:
        return F.when(values[feature[at]] <= limit[at], below[at]).otherwise(above[at])

    def walked(total: Column, root: Column) -> Column:
        return total + value[F.aggregate(F.lit(np.arange(depth, dtype=np.int32)), root, step)]

    total = F.aggregate(F.lit(np.array(roots, np.int32)), F.lit(0.0), walked)
    return 1 / (1 + F.exp(-2 * total))


def _labelled(kind: str, base: Column, proposed: Column) -> Column:
    """Positive and negative examples of a kind."""

    def example(label: float):
        return lambda s: F.struct(
            F.lit(kind).alias("kind"), features(kind, s).alias("values"), F.lit(label).alias("label")
        )

    def disguised(span: Column) -> Column:
        written = _disguises(kind, span["found"])
        return F.array(span, *[span.withField("found", other) for other in written])

    good = F.transform(F.flatten(F.transform(base, disguised)), example(1.0))
    bad = F.transform(F.filter(proposed, lambda s: _apart(s, base)), example(0.0))
    return F.concat(good, bad)


def examples(docs: DataFrame, text: str = "text") -> DataFrame:
    """``kind, values, label`` of all base spans, their disguises and all other proposals."""
    rows = with_base(docs.select(F.col(text).alias("text")), "base")
    rows = _located(rows, "proposed", "base_text", PROPOSALS)
    parts = [_labelled(k, F.col("base")[k], F.col("proposed")[k]) for k in KINDS]
    return rows.select(F.inline(F.concat(*parts)))


def fit(docs: DataFrame) -> Trees | None:
    """Trees and thresholds from the examples of all ``docs`` (text)."""
    rows = examples(docs).withColumn("fold", F.pmod(F.xxhash64("values", "label"), F.lit(4)))
    rows = rows.groupBy("kind", "values", "label", "fold").agg(
        F.count("*").cast("double").alias("weight")
    )
    rows = rows.withColumn("features", array_to_vector("values")).persist()
    try:
        learned = rows.where("fold > 0")
        counts = [row["count"] for row in learned.groupBy("label").count().collect()]
        if len(counts) < 2:
            return None
        learner = GBTClassifier(
            featuresCol="features", labelCol="label", weightCol="weight", maxIter=TREES,
            maxDepth=DEPTH, maxBins=_bins(sum(counts)), stepSize=0.3, seed=7,
        )
        tasks = -(-sum(counts) // EXAMPLES_PER_TASK)
        dealt = learned.repartition(tasks, "values", "label").sortWithinPartitions("values", "label")
        text = learner.fit(dealt).toDebugString
        judged = rows.where("fold = 0").select(
            "kind", "label", "weight", probability(text, F.col("values")).alias("p")
        )
        return Trees(text, _thresholds(judged))
    finally:
        rows.unpersist()


def _bins(examples: int) -> int:
    """Bins of a feature. The learner takes its limits from a sample of as many rows as the square
    of the bins, 10,000 at least; so many that this is all of them, up to 2^31 different examples."""
    return min(max(BINS, isqrt(max(examples - 1, 0)) + 1), isqrt((1 << 31) - 1))


def _thresholds(judged: DataFrame, cells: int = 1024) -> dict[str, float]:
    """Per kind the lowest probability, 0.5 at least, from which enough are positive. Sums over all
    higher ones are those of whole cells, a few numbers per kind, and those within the own cell."""

    def sums(rows: DataFrame, *keys: str | Column) -> DataFrame:
        return rows.groupBy(*keys).agg(F.sum("good").alias("good"), F.sum("total").alias("total"))

    def running(window) -> list[Column]:
        return [F.sum(c).over(window).alias(f"{c}_above") for c in ("good", "total")]

    rows = judged.where("p >= 0.5").select(
        "kind", "p", F.floor(F.col("p") * cells).alias("cell"),
        (F.col("label") * F.col("weight")).alias("good"), F.col("weight").alias("total"),
    )
    rows = sums(rows, "kind", "cell", "p")
    higher = Window.partitionBy("kind").orderBy(F.desc("cell")).rowsBetween(Window.unboundedPreceding, -1)
    whole = sums(rows, "kind", "cell").select("kind", "cell", *running(higher)).na.fill(0.0)
    own = Window.partitionBy("kind", "cell").orderBy(F.desc("p"))
    rows = rows.select("kind", "cell", "p", F.sum("good").over(own).alias("good"),
                       F.sum("total").over(own).alias("total"))
    good, total = (F.col(c) + F.col(f"{c}_above") for c in ("good", "total"))
    enough = rows.join(whole, ["kind", "cell"]).where(good >= PRECISION * total)
    found = {r["kind"]: r["p"] for r in enough.groupBy("kind").agg(F.min("p").alias("p")).collect()}
    return {kind: found[kind] for kind in KINDS if kind in found}


# --- spans and redaction ---------------------------------------------------------------


def _taken(trees: Trees, kind: str, proposed: Column, base: Column) -> Column:
    apart = F.filter(proposed, lambda s: _apart(s, base))
    # The features beside the span, so that the trees' expression does not repeat theirs.
    described = F.transform(
        apart, lambda s: F.struct(s.alias("span"), features(kind, s).alias("values"))
    )
    threshold = trees.thresholds[kind]
    taken = F.filter(described, lambda x: probability(trees.text, x["values"]) >= threshold)
    return F.transform(taken, lambda x: x["span"])


def found_spans(docs: DataFrame, trees: Trees | None, name: str = "pii") -> DataFrame:
    """``docs`` with a struct column ``name``: ``base`` and ``spans``, arrays of ``start, kind_no,
    end`` in order."""
    rows = with_base(docs, name)
    if trees:
        rows = _located(rows, f"{name}_proposed", f"{name}_text", PROPOSALS)

    def plain(spans: Column, kind: str) -> Column:
        return F.transform(
            spans,
            lambda s: F.struct(
                s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind_no"),
                s["end"].alias("end"),
            ),
        )

    base = F.concat(*[plain(F.col(name)[kind], kind) for kind in KINDS])
    rows = rows.withColumn(name, F.struct(F.sort_array(base).alias("base")))
    added = [
        plain(_taken(trees, kind, F.col(f"{name}_proposed")[kind], F.col(name)["base"]), kind)
        for kind in (trees.thresholds if trees else ())
    ]
    every = F.sort_array(F.concat(F.col(name)["base"], *added))
    rows = rows.withColumn(name, F.col(name).withField("spans", every))
    return rows.drop(f"{name}_text", f"{name}_proposed")


def listed(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", kinds[s["kind_no"]], s["start"], s["end"])),
        ",",
    )


def count_of(spans: Column, kind: str) -> Column:
    number = KINDS.index(kind)
    return F.size(F.filter(spans, lambda s: s["kind_no"] == number)).cast("long")


def redacted(text: Column, spans: Column, mark: str = "[PII]") -> Column:
    """The text with every run of overlapping spans replaced by the mark."""
    last = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        piece = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(fresh, F.concat(acc["out"], F.array(piece, F.lit(mark))))
            .otherwise(acc["out"])
            .alias("out"),
        )

    kept = F.aggregate(
        spans,
        last,
        step,
        lambda acc: F.concat(
            F.array_join(acc["out"], ""), F.substring(text, acc["at"] + 1, F.length(text))
        ),
    )
    return F.when(F.size(spans) > 0, kept).otherwise(text)
