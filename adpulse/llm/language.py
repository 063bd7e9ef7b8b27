"""Language identification with a string kernel.

Two texts are as alike as the blended spectrum of character n-grams they both have: the kernel is
the number of n-grams (n = 1 to 3, each counted once) in both, over the root of the product of
their numbers. Landmarks, some training texts of each language, turn kernel values into features
(Nyström); one ridge regression per language (one versus the rest) is fitted on them. Since every
kernel value is a product with a row of landmark presences, all landmarks and regressions fold into
one matrix of n-grams by languages, and a text is scored by the sum of its n-grams' rows.

Letters are lower-cased; everything else is a gap, and a run of gaps is one. Every letter of the
training texts, of whatever script, has a symbol of its own; letters that they do not have share
one. Whole texts are read.

The training sample is bounded: for each language the ``PER_LANGUAGE`` labelled texts with the
smallest hashed ids, or as many fewer as keep all languages together at ``SAMPLE`` texts, texts of
at most ``TRAIN_CHARS`` characters. Every language that has one is learned. All texts are scored.

Defined results: null text or text without a letter is ``und`` with score 0, and so is all if
there is nothing to learn from. Equal scores go to the language first in code-point order. Repeated
rows get equal results. Other columns pass through; one named ``language`` is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from adpulse.llm.words import PIECE, utf8

PER_LANGUAGE = 300
SAMPLE = 60_000
#: Landmarks of all languages together, and the least number of each.
LANDMARKS, LEAST_LANDMARKS = 400, 8
TRAIN_CHARS = 200_000
RIDGE = 0.1
UNKNOWN = "und"

_ORDERS = (1, 2, 3)
_GAP = 0
_POINTS = 0x110000
#: Codes of n-grams up to here are looked up in a table, larger ones by bisection.
_TABLE = 1 << 20
#: Texts by n-grams that are flagged at once.
_FLAGS = 1 << 24


class Lookup(NamedTuple):
    """The n-grams of one order: their sorted codes, and the feature of the first one."""

    codes: np.ndarray
    first: int
    #: Feature of every code, if there are few.
    table: np.ndarray | None

    def find(self, codes: np.ndarray, none: int) -> np.ndarray:
        if self.table is not None:
            return self.table[codes]
        if not len(self.codes):
            return np.full(len(codes), none)
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[at] == codes, at + self.first, none)


class Model(NamedTuple):
    languages: tuple[str, ...]
    #: Symbol of every code point. The largest is of letters that were not learned.
    symbols: np.ndarray
    #: Per order, the features of n-grams; the number of features stands for unknown ones.
    features: tuple[Lookup, ...]
    #: Row of weights of every feature; the last row is zero.
    rows: np.ndarray
    #: n-grams by languages.
    weights: np.ndarray
    constants: np.ndarray


def _lower_table() -> np.ndarray:
    """Lower case of every code point; 0 for what is no letter."""
    table = np.zeros(_POINTS, np.uint32)
    for point in range(_POINTS):
        letter = chr(point)
        if letter.isalpha():
            low = letter.lower()
            table[point] = ord(low) if len(low) == 1 else point
    return table


def _points(raw: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes, and the cuts counted in code points."""
    points = np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    leads = np.append(0, np.cumsum((raw & 0xC0) != 0x80))
    return points, leads[cuts]


def _symbol_runs(
    points: np.ndarray, cuts: np.ndarray, symbols: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of all texts, each text after a gap of its own and without repeated gaps, and
    the text of each symbol."""
    found = np.insert(symbols[points], cuts[:-1], _GAP)
    owner = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts) + 1)
    found, owner = np.append(found, _GAP), np.append(owner, len(cuts) - 2)
    keep = np.ones(len(found), bool)
    keep[1:] = (found[1:] != _GAP) | (found[:-1] != _GAP) | (owner[1:] != owner[:-1])
    return found[keep], owner[keep]


def _grams(
    found: np.ndarray, owner: np.ndarray, order: int, base: int
) -> tuple[np.ndarray, np.ndarray]:
    """Number of every n-gram and its text. A gap is only the first or the last symbol of one; the
    gap before the next text closes a text."""
    if len(found) < order:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    n = len(found) - order + 1
    code = np.zeros(n, np.int64)
    inside = np.ones(n, bool)
    for k in range(order):
        code = code * base + found[k : k + n]
        if 0 < k < order - 1:
            inside &= found[k : k + n] != _GAP
    if order == 2:
        inside &= code > 0
    return code[inside], owner[:n][inside]


def _blocks(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Index of the first text, bytes and cuts, about PIECE bytes of whole texts at a time."""
    raw, starts = utf8(texts)
    first = 0
    while first < len(starts) - 1:
        last = int(np.searchsorted(starts, starts[first] + PIECE, "right")) - 1
        last = min(max(last, first + 1), len(starts) - 1)
        yield first, raw[starts[first] : starts[last]], starts[first : last + 1] - starts[first]
        first = last


def _size(features: tuple[Lookup, ...]) -> int:
    return sum(len(lookup.codes) for lookup in features)


def _entries(
    raw: np.ndarray, cuts: np.ndarray, symbols: np.ndarray, features: tuple[Lookup, ...]
) -> tuple[np.ndarray, np.ndarray]:
    """Text and feature of every known n-gram, each once in a text, in order."""
    size, base = _size(features), int(symbols.max()) + 1
    found, owner = _symbol_runs(*_points(raw, cuts), symbols)
    places = []
    for order, lookup in zip(_ORDERS, features, strict=True):
        code, of = _grams(found, owner, order, base)
        places.append(of * (size + 1) + lookup.find(code, size))
    place = np.concatenate(places)
    n = (len(cuts) - 1) * (size + 1)
    if n <= _FLAGS:
        flags = np.zeros(n, bool)
        flags[place] = True
        place = np.flatnonzero(flags)
    else:
        place = np.unique(place)
    text, feature = np.divmod(place, size + 1)
    known = feature < size
    return text[known], feature[known]


def _scales(text: np.ndarray, n: int) -> np.ndarray:
    """What makes each row of presences one of length 1."""
    return 1 / np.sqrt(np.maximum(np.bincount(text, minlength=n), 1))


def _presence(
    raw: np.ndarray, cuts: np.ndarray, symbols: np.ndarray, features: tuple[Lookup, ...]
) -> np.ndarray:
    """Texts by known n-grams, each row scaled to length 1."""
    text, feature = _entries(raw, cuts, symbols, features)
    present = np.zeros((len(cuts) - 1, _size(features)), np.float32)
    present[text, feature] = _scales(text, len(present))[text]
    return present


def _sums(text: np.ndarray, values: np.ndarray, places: np.ndarray, n: int) -> np.ndarray:
    """Per text the sum of the rows of ``values`` at ``places``, some texts at a time."""
    sums = np.zeros((n, values.shape[1]))
    cuts = np.searchsorted(text, np.arange(n + 1))
    step = max(1, _FLAGS // (4 * values.shape[1]))
    low = 0
    while low < n:
        high = min(max(int(np.searchsorted(cuts, cuts[low] + step, "right")) - 1, low + 1), n)
        worded = np.flatnonzero(np.diff(cuts[low : high + 1])) + low
        if len(worded):
            chosen = values[places[cuts[low] : cuts[high]]]
            sums[worded] = np.add.reduceat(chosen, cuts[worded] - cuts[low], axis=0, dtype=np.float64)
        low = high
    return sums


def train(texts: list[str], labels: list[str]) -> Model | None:
    """Fit on labelled texts, in the order given. None if there is none."""
    languages, language = np.unique(np.array(labels, object), return_inverse=True)
    if not len(languages):
        return None
    lower = _lower_table()
    raw, cuts = utf8(pa.array(texts, pa.string()))
    parts = [(raw[cuts[low] : cuts[high]], cuts[low : high + 1] - cuts[low])
             for low, high in _ranges(cuts)]
    seen = np.zeros(_POINTS, bool)
    for part in parts:
        seen[lower[_points(*part)[0]]] = True
    letters = np.flatnonzero(seen[1:]) + 1
    base = len(letters) + 2
    of_letter = np.full(_POINTS, base - 1, np.int32)
    of_letter[letters] = np.arange(1, base - 1)
    symbols = np.where(lower > 0, of_letter[lower], np.int32(_GAP))

    known = [np.zeros(0, np.int64) for _ in _ORDERS]
    for part in parts:
        runs = _symbol_runs(*_points(*part), symbols)
        known = [
            np.union1d(codes, _grams(*runs, order, base)[0])
            for order, codes in zip(_ORDERS, known, strict=True)
        ]
    size = sum(map(len, known))
    features, at = [], 0
    for order, codes in zip(_ORDERS, known, strict=True):
        table = None
        if base**order <= _TABLE:
            table = np.full(base**order, size, np.int64)
            table[codes] = np.arange(at, at + len(codes))
        features.append(Lookup(codes, at, table))
        at += len(codes)
    found, n = [], 0
    for part in parts:
        text, feature = _entries(*part, symbols, tuple(features))
        found.append((text.astype(np.int32) + n, feature.astype(np.int32)))
        n += len(part[1]) - 1
    text, feature = (np.concatenate(column) for column in zip(*found, strict=True))
    scales = _scales(text, n)

    # Only n-grams of landmarks have a weight. Their rows: n-grams by landmarks.
    chosen = _landmarks(labels)
    landmark = np.full(n, -1)
    landmark[chosen] = np.arange(len(chosen))
    mine = landmark[text] >= 0
    held = np.unique(feature[mine])
    rows = np.full(size, len(held), np.int32)
    rows[held] = np.arange(len(held))
    held_by = np.zeros((len(held) + 1, len(chosen)), np.float32)
    held_by[rows[feature[mine]], landmark[text[mine]]] = scales[text[mine]]
    kernel = _sums(text, held_by, rows[feature], n) * scales[:, None]
    values, vectors = np.linalg.eigh(kernel[chosen])
    solid = values > 1e-8 * max(values.max(initial=0), 1e-300)
    whiten = vectors[:, solid] / np.sqrt(values[solid])
    mapped = np.column_stack([kernel @ whiten, np.ones(n)])
    gram = mapped.T @ mapped + RIDGE * np.eye(mapped.shape[1])
    # 1 for a text's own language, -1 for the others.
    order = np.argsort(language, kind="stable")
    firsts = np.searchsorted(language[order], np.arange(len(languages)))
    truth = 2 * np.add.reduceat(mapped[order], firsts, axis=0).T - mapped.sum(0)[:, None]
    solved = np.linalg.solve(gram, truth)
    weights = held_by @ (whiten @ solved[:-1]).astype(np.float32)
    return Model(tuple(languages), symbols, tuple(features), rows, weights, solved[-1])


def _landmarks(labels: list[str]) -> np.ndarray:
    """Places of the first texts of each language, as many of each."""
    names, language = np.unique(np.array(labels), return_inverse=True)
    per = max(LEAST_LANDMARKS, -(-LANDMARKS // len(names)))
    order = np.argsort(language, kind="stable")
    firsts = np.searchsorted(language[order], np.arange(len(names)))
    rank = np.arange(len(order)) - firsts[language[order]]
    return np.sort(order[rank < per])


def _ranges(cuts: np.ndarray) -> Iterator[tuple[int, int]]:
    low = 0
    while low < len(cuts) - 1:
        high = min(max(int(np.searchsorted(cuts, cuts[low] + PIECE)), low + 1), len(cuts) - 1)
        yield low, high
        low = high


def score(model: Model, raw: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the language and score of each text of a batch."""
    text, feature = _entries(raw, cuts, model.symbols, model.features)
    n = len(cuts) - 1
    sums = _sums(text, model.weights, model.rows[feature], n)
    values = sums * _scales(text, n)[:, None] + model.constants
    best = values.argmax(1)
    return best, np.clip((values[np.arange(len(best)), best] + 1) / 2, 0, 1)


def predictor(docs: DataFrame, model: Model | None):
    """A function of a text column that gives a struct of ``lang`` and ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(
        StructType([StructField("lang", StringType()), StructField("score", DoubleType())])
    )
    def predict(texts: pa.Array) -> pa.Array:
        model = shared.value
        names, scores = [], []
        for _, raw, cuts in _blocks(texts):
            best, value = score(model, raw, cuts)
            names.extend(model.languages[k] for k in best)
            scores.append(value.astype(np.float64))
        values = np.concatenate(scores) if scores else np.zeros(0)
        return pa.StructArray.from_arrays(
            [pa.array(names, pa.string()), pa.array(values, pa.float64())], ["lang", "score"]
        )

    return predict


def training_sample(docs: DataFrame, eligible: Column) -> tuple[list[str], list[str]]:
    """Texts and languages of the bounded training sample, the languages in turn."""
    labelled = docs.where(
        eligible & F.col("lang").isNotNull() & (F.length("text") <= TRAIN_CHARS)
    ).select("lang", "doc_id", "text")
    counts = (
        labelled.groupBy("lang")
        .agg(F.count("*").alias("n"))
        .collect()
    )
    if not counts:
        return [], []
    per_language = max(1, min(PER_LANGUAGE, SAMPLE // len(counts)))
    # Below this bound lie about twice as many hashes as are wanted, whatever the size.
    rank = F.xxhash64(F.col("doc_id").cast("string"), "lang")
    shares = pa.table(
        {
            "lang": pa.array([row["lang"] for row in counts], pa.string()),
            "share": [min(1.0, 2 * per_language / row["n"]) for row in counts],
        }
    )
    share = F.broadcast(docs.sparkSession.createDataFrame(shares))
    draw = F.pmod(rank, F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = labelled.withColumn("draw", draw).join(share, "lang")
    picked = drawn.where(F.col("draw") < F.col("share"))
    by_language: dict[str, list] = {row["lang"]: [] for row in counts}
    for row in picked.limit(8 * per_language * len(counts)).collect():
        by_language[row["lang"]].append(row)
    turns = []
    for rows in by_language.values():
        rows.sort(key=lambda row: (row["draw"], row["doc_id"], row["text"]))
        turns += [(turn, row) for turn, row in enumerate(rows[:per_language])]
    turns.sort(key=lambda pair: (pair[0], pair[1]["lang"]))
    return [row["text"] for _, row in turns], [row["lang"] for _, row in turns]


def identified(docs: DataFrame, eligible: Column) -> tuple[DataFrame, Model | None]:
    """``docs`` with a column ``language``, a struct of ``lang`` and ``score``; the model is
    learned from the rows that are eligible. The text is all that a prediction depends on."""
    model = train(*training_sample(docs, eligible))
    unknown = F.struct(F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"))
    if model is None:
        return docs.withColumn("language", unknown), None
    predict = predictor(docs, model)
    worded = F.col("text").rlike(r"\p{L}")
    return docs.withColumn("language", predict("text")).withColumn(
        "language", F.when(worded, F.col("language")).otherwise(unknown)
    ), model
