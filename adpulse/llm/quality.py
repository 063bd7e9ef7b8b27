"""Quality rules by weak supervision: rules vote or abstain, expectation-maximisation estimates
how accurate each of them is, and the posterior probability of good quality decides.

A rule names a measure of the text, when it votes good and when it votes bad; between the two it
abstains. The votes of a text form a pattern. Only the counts of the patterns (at most three to
the power of the number of rules) reach the driver, where the model is fitted on all texts; each
pattern's posterior then goes back to the rows. Measures are taken from whole texts.

Defined results: a null or empty text has zeros for all measures and fails the base rules, so it
is not kept. A share of nothing is 0. With no text at all the prior decides (0.5: kept). Repeated
rows are judged alike, each on its own. All other columns pass through.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from adpulse.llm.words import (
    WORD_CHARACTERS,
    blocks,
    byte_set,
    count_bytes,
    lines,
    repeated,
    windows,
)

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW_WORDS = 3
KEEP_FROM = 0.5

MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_lines",
    "n_dup_lines",
    "n_repeat_words",
    "n_distinct_words",
    "n_upper",
    "n_lower",
    "n_digits",
    "n_letters",
)
_SYMBOL_BYTES = byte_set(SYMBOLS.encode())
_UPPER, _LOWER = byte_set(bytes(range(65, 91))), byte_set(bytes(range(97, 123)))
_DIGITS = byte_set(b"0123456789")
#: Characters beyond ASCII count as letters; each has one first byte.
_LETTERS = _UPPER | _LOWER | byte_set(bytes(range(0xC0, 0x100)))


@F.arrow_udf(StructType([StructField(name, LongType()) for name in MEASURES]))
def measures(texts: pa.Array) -> pa.Array:
    """All measures of whole texts."""
    columns: dict[str, list[np.ndarray]] = {name: [] for name in MEASURES}
    for block in blocks(texts):
        n = len(block.cuts) - 1
        line, line_owner = lines(block)
        window, at = windows(block, WINDOW_WORDS)
        often, _ = repeated(window, block.owner[at])
        covered = np.zeros(len(block.hashes), bool)
        for k in range(WINDOW_WORDS):
            covered[at[often] + k] = True
        found = {
            "n_words": block.counts,
            "word_chars": count_bytes(block, WORD_CHARACTERS),
            "n_symbols": count_bytes(block, _SYMBOL_BYTES),
            "n_lines": np.bincount(line_owner, minlength=n),
            "n_dup_lines": np.bincount(line_owner[repeated(line, line_owner)[1]], minlength=n),
            "n_repeat_words": np.bincount(block.owner[covered], minlength=n),
            "n_distinct_words": np.bincount(
                block.owner[~repeated(block.hashes, block.owner)[1]], minlength=n
            ),
            "n_upper": count_bytes(block, _UPPER),
            "n_lower": count_bytes(block, _LOWER),
            "n_digits": count_bytes(block, _DIGITS),
            "n_letters": count_bytes(block, _LETTERS),
        }
        for name, values in found.items():
            columns[name].append(values.astype(np.int64))
    arrays = [
        pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64), pa.int64())
        for parts in columns.values()
    ]
    return pa.StructArray.from_arrays(arrays, list(columns))


class Rule(NamedTuple):
    """Votes good where ``good`` holds and else bad where ``bad`` holds, of a struct of measures."""

    name: str
    good: str
    bad: str


#: {m} stands for the struct of measures.
RULES = (
    Rule("length", "{m}.n_words >= 100", "{m}.n_words < 50"),
    Rule(
        "repeated_windows",
        "{m}.n_repeat_words * 100 < 15 * {m}.n_words",
        "{m}.n_repeat_words * 100 > 35 * {m}.n_words",
    ),
    Rule(
        "repeated_lines",
        "{m}.n_dup_lines = 0",
        "{m}.n_dup_lines * 100 > 50 * {m}.n_lines",
    ),
    Rule(
        "symbols",
        "{m}.n_symbols * 100 < 3 * {m}.n_words",
        "{m}.n_symbols * 100 > 25 * {m}.n_words",
    ),
    Rule(
        "word_length",
        "{m}.word_chars between 3 * {m}.n_words and 9 * {m}.n_words",
        "{m}.word_chars < 2 * {m}.n_words or {m}.word_chars > 14 * {m}.n_words",
    ),
    Rule(
        "upper_case",
        "{m}.n_upper * 4 < {m}.n_lower",
        "{m}.n_upper > {m}.n_lower",
    ),
    Rule(
        "vocabulary",
        "{m}.n_distinct_words * 100 > 35 * {m}.n_words",
        "{m}.n_distinct_words * 100 < 15 * {m}.n_words",
    ),
    Rule(
        "letters",
        "{m}.n_letters * 100 > 92 * {m}.word_chars",
        "{m}.n_letters * 100 < 88 * {m}.word_chars",
    ),
    Rule(
        "digits",
        "{m}.n_digits * 100 < 8 * {m}.word_chars",
        "{m}.n_digits * 100 > 30 * {m}.word_chars",
    ),
)


def pattern(measured: str, rules: tuple[Rule, ...] = RULES) -> Column:
    """The votes as text: a letter per rule, g for good, b for bad, - for none."""
    votes = [
        F.when(F.expr(rule.good.format(m=measured)), "g")
        .when(F.expr(rule.bad.format(m=measured)), "b")
        .otherwise("-")
        for rule in rules
    ]
    return F.concat(*votes)


class Model(NamedTuple):
    """``prior`` of good quality; of each rule that votes, how often it is right about good texts
    (``on_good``) and about bad ones (``on_bad``)."""

    prior: float
    on_good: tuple[float, ...]
    on_bad: tuple[float, ...]


#: No rule is beyond doubt.
ACCURACY_RANGE = (0.001, 0.999)
PRIOR_RANGE = (0.02, 0.98)
#: Votes that each accuracy starts with, so that few votes prove little.
PRIOR_VOTES = 2.0


def posterior(model: Model, votes: str) -> float:
    """Probability of good quality given the votes, which are independent given the quality.
    A rule that abstains says nothing."""
    good, bad = model.prior, 1 - model.prior
    for vote, right_on_good, right_on_bad in zip(votes, model.on_good, model.on_bad, strict=True):
        if vote == "g":
            good, bad = good * right_on_good, bad * (1 - right_on_bad)
        elif vote == "b":
            good, bad = good * (1 - right_on_good), bad * right_on_bad
    return good / (good + bad)


def _first_guess(votes: str) -> float:
    """Before anything is known of the rules: bad votes are rare, so they count for more."""
    return (0.95, 0.25, 0.05)[min(votes.count("b"), 2)]


def fit(counts: dict[str, int], n_rules: int, rounds: int = 200) -> Model:
    """Expectation-maximisation over the counted patterns, until nothing changes or for so many
    rounds. No rule is taken to be worse than chance: a good vote never lowers the probability.
    The order of the patterns does not matter."""
    ordered = sorted(counts.items())
    total = sum(counts.values())
    weights = [(votes, n, _first_guess(votes)) for votes, n in ordered]
    model = Model(0.5, (0.8,) * n_rules, (0.8,) * n_rules)
    if not total:
        return model
    low, high = ACCURACY_RANGE
    for _ in range(rounds):
        prior = sum(n * p for _, n, p in weights) / total
        on_good, on_bad = [], []
        for k in range(n_rules):
            of_good = {v: sum(n * p for votes, n, p in weights if votes[k] == v) for v in "gb"}
            of_bad = {v: sum(n * (1 - p) for votes, n, p in weights if votes[k] == v) for v in "gb"}
            good = (of_good["g"] + PRIOR_VOTES / 2) / (sum(of_good.values()) + PRIOR_VOTES)
            bad = (of_bad["b"] + PRIOR_VOTES / 2) / (sum(of_bad.values()) + PRIOR_VOTES)
            good, bad = (min(max(x, low), high) for x in (good, bad))
            if good + bad < 1:
                good = bad = 0.5
            on_good.append(good)
            on_bad.append(bad)
        step = Model(
            min(max(prior, PRIOR_RANGE[0]), PRIOR_RANGE[1]), tuple(on_good), tuple(on_bad)
        )
        moved = abs(step.prior - model.prior) + sum(
            abs(a - b)
            for a, b in zip(step.on_good + step.on_bad, model.on_good + model.on_bad, strict=True)
        )
        model = step
        weights = [(votes, n, posterior(model, votes)) for votes, n in ordered]
        if moved < 1e-9:
            break
    return model


def base_failed(measured: str) -> Column:
    return F.expr(
        f"{measured}.n_words < {MIN_WORDS} or "
        f"100 * {measured}.n_repeat_words > {MAX_REPEAT_PERCENT} * {measured}.n_words"
    )


def fit_on(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> tuple[Model, dict[str, float]]:
    """The model of all texts, and the posterior of every pattern of votes that occurs."""
    votes = docs.select(measures("text").alias("m")).select(pattern("m", rules).alias("votes"))
    counts = {row["votes"]: row["n"] for row in votes.groupBy("votes").agg(
        F.count("*").alias("n")
    ).collect()}
    model = fit(counts, len(rules))
    return model, {found: posterior(model, found) for found in counts}


def fresh(frame: DataFrame, name: str) -> str:
    """A column name the frame does not have yet, in any case."""
    taken = {column.lower() for column in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, str]:
    """The rows of ``docs`` with one more column, a struct of the measures, ``base_failed``,
    ``votes``, ``posterior`` and ``kept``; and that column's name."""
    _, probability = fit_on(docs, rules)
    name = fresh(docs, "quality")
    # At most three to the power of the number of rules entries, whatever the input.
    known = F.create_map(*[F.lit(x) for pair in sorted(probability.items()) for x in pair]) if (
        probability
    ) else F.create_map().cast("map<string,double>")
    rows = docs.withColumn(name, measures("text"))
    struct = F.col(name)
    rows = rows.withColumn(
        name,
        F.struct(
            *[struct[m].alias(m) for m in MEASURES],
            base_failed(f"`{name}`").alias("base_failed"),
            pattern(f"`{name}`", rules).alias("votes"),
        ),
    )
    rows = rows.withColumn(
        name, F.col(name).withField("posterior", known[F.col(name)["votes"]])
    )
    kept = ~F.col(name)["base_failed"] & (F.col(name)["posterior"] >= KEEP_FROM)
    return rows.withColumn(name, F.col(name).withField("kept", kept)), name


def kept_rows(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that are kept, with the columns they had."""
    rows, name = judged(docs, rules)
    return rows.where(F.col(name)["kept"]).drop(name)
