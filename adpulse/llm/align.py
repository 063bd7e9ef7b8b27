"""Alignment of two tokenizers over a corpus, each distinct text once.

Documents are grouped by their full text, so a text is tokenised and aligned once however often it
occurs; its pairs of tokens then count as often as it does, and its measures are joined back to all
documents that have it.

Tokenizer A is a byte-level vocabulary (``adpulse.llm.bpe``) given a space and the text, tokenizer B
a piece model that puts the space before the text itself. Where tokens of both end at the same byte
a group ends; every A token of a group is linked with every B token of it. The count of a pair of
ids is the number of documents that hold it linked.

Texts are taken in blocks of about ``BLOCK_CHARS`` characters. A text keeps its pairs as places in
the block's list of distinct pairs. Only that list is shuffled, a row per block and pair: it is
summed to the counts, joined with them, and goes back to the block, where the measures of its texts
are added up. A pair that every document has costs a row per block. The best count per A id is a row
per id of the vocabulary, the one table that is broadcast.

Defined results: a text that is null or empty, or whose tokens' bytes joined differ from the space
and the text in either tokenizer, has no tokens and all its measures are zero. Special tokens are
ordinary text. Repeated rows count as documents of their own. A group in which many different ids
meet is expanded by distinct ids. Other columns pass through if kept; one named as a measure is
replaced. Of memory a task holds a block, or one text if that is longer, and its links.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adpulse.llm import bpe
from adpulse.llm.store import setting, stored

BYTE_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BLOCK_CHARS = 1 << 21
#: Links of a group above which its distinct ids are counted before they are paired.
WIDE_GROUP = 1 << 12

MARK = "▁"
MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def load(byte_vocabulary: str = BYTE_VOCABULARY, piece_model: str = PIECE_MODEL) -> dict:
    """Both tokenizers as plain values, which can be sent to tasks."""
    pieces = sentencepiece.SentencePieceProcessor(model_file=piece_model)
    values = {**bpe.load(byte_vocabulary), "model": pieces.serialized_model_proto()}
    values["pieces"] = pieces.get_piece_size()
    return values


class Tokenizers:
    """Both tokenizers inside a task."""

    def __init__(self, values: dict):
        self.coder = bpe.Coder(values, plain=True)
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=values["model"])
        self.b_bytes = [
            bytes([int(piece[3:5], 16)]) if self.pieces.is_byte(k) else
            piece.replace(MARK, " ").encode()
            for k in range(values["pieces"])
            for piece in [self.pieces.id_to_piece(k)]
        ]
        self.a_sizes = np.array([len(b) for b in values["bytes_of"]], np.int64)
        self.b_sizes = np.array([len(b) for b in self.b_bytes], np.int64)

    def of(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """The ids of both for each text; none where either does not give back the text."""
        none = np.zeros(0, np.int32)
        a, b = [], []
        for text, second in zip(texts, self.pieces.encode(texts, num_threads=1), strict=True):
            whole = b" " + text.encode("utf-8", "surrogatepass")
            first = np.frombuffer(self.coder.encode(" " + text), np.int32)
            # A byte-level vocabulary has every byte, so only lengths could tell.
            same = int(self.a_sizes[first].sum()) == len(whole)
            same = same and b"".join([self.b_bytes[k] for k in second]) == whole
            a.append(first if same else none)
            b.append(np.array(second, np.int32) if same else none)
        return a, b


class Side(NamedTuple):
    """One tokenizer's tokens of a block: ids, the group of each, whether it ends one, and the
    bounds of each text's tokens."""

    ids: np.ndarray
    group: np.ndarray
    last: np.ndarray
    bounds: np.ndarray


def sides(
    a: list[np.ndarray], b: list[np.ndarray], a_sizes: np.ndarray, b_sizes: np.ndarray
) -> tuple[Side, Side]:
    """Groups end where tokens of both end; texts lie one after another, so no group spans two."""
    ids = [np.concatenate([np.zeros(0, np.int32), *part]) for part in (a, b)]
    ends = [np.cumsum(sizes[own]) for own, sizes in zip(ids, (a_sizes, b_sizes), strict=True)]
    total = int(ends[0][-1]) if len(ends[0]) else 0
    marks = [np.zeros(total + 1, bool) for _ in ends]
    for mark, own in zip(marks, ends, strict=True):
        mark[own] = True
    found = []
    for part, own, end, other in zip((a, b), ids, ends, marks[::-1], strict=True):
        last = other[end]
        bounds = np.append(0, np.cumsum([len(text) for text in part], dtype=np.int64))
        found.append(Side(own, np.cumsum(last) - last, last, bounds))
    return found[0], found[1]


class Links(NamedTuple):
    """Distinct pairs of each text in order of text and pair: the bounds of each text's, the pair as
    a * width + b, and how many links of the text it is."""

    bounds: np.ndarray
    codes: np.ndarray
    times: np.ndarray


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of runs of equal values."""
    starts = np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else values
    return starts, np.diff(np.append(starts, len(values)))


def links(a: Side, b: Side, width: int, wide: int = WIDE_GROUP) -> tuple[Links, np.ndarray]:
    """The links of a block, and the number of links of every group."""
    groups = int(a.last.sum())
    in_a, in_b = np.bincount(a.group, minlength=groups), np.bincount(b.group, minlength=groups)
    per_group = in_a * in_b
    b_start = np.append(0, np.cumsum(in_b))[:-1]
    text_of = np.repeat(np.arange(len(a.bounds) - 1), np.diff(a.bounds))
    narrow = np.flatnonzero(per_group[a.group] <= wide)
    # Every A token of a group beside each B token of it.
    many = in_b[a.group[narrow]]
    left = np.repeat(narrow, many)
    right = np.arange(len(left)) - np.repeat(np.cumsum(many) - many, many)
    right += b_start[a.group[left]]
    texts = [text_of[left]]
    codes = [a.ids[left].astype(np.int64) * width + b.ids[right]]
    times = [np.ones(len(left), np.int64)]
    a_start = np.append(0, np.cumsum(in_a))
    for group in np.flatnonzero(per_group > wide).tolist():
        low, high = a_start[group], a_start[group + 1]
        own, own_n = np.unique(a.ids[low:high], return_counts=True)
        at = b_start[group]
        other, other_n = np.unique(b.ids[at : at + in_b[group]], return_counts=True)
        codes.append((own.astype(np.int64)[:, None] * width + other).ravel())
        times.append((own_n[:, None] * other_n).ravel())
        texts.append(np.full(len(codes[-1]), text_of[low]))
    text, code, time = (np.concatenate(part) for part in (texts, codes, times))
    order = np.lexsort((code, text))
    text, code, time = text[order], code[order], time[order]
    change = np.append(True, (text[1:] != text[:-1]) | (code[1:] != code[:-1]))[: len(text)]
    starts = np.flatnonzero(change)
    summed = np.add.reduceat(time, starts) if len(starts) else time
    bounds = np.searchsorted(text[starts], np.arange(len(a.bounds)))
    return Links(bounds, code[starts], summed), per_group


def printed(a: Side, b: Side) -> tuple[np.ndarray, np.ndarray]:
    """``a1,a2|b1;a3|b2,b3`` of every text of a block, as bytes in a row, and where each starts."""
    groups = int(a.last.sum())
    a_start = np.append(0, np.cumsum(np.bincount(a.group, minlength=groups)))
    b_start = np.append(0, np.cumsum(np.bincount(b.group, minlength=groups)))
    size = len(a.ids) + len(b.ids)
    ids, marks = np.zeros(size, np.int64), np.zeros(size, np.uint8)
    at = np.arange(len(a.ids)) + b_start[a.group]
    ids[at], marks[at] = a.ids, np.where(a.last, ord("|"), ord(","))
    at = np.arange(len(b.ids)) + a_start[b.group + 1]
    ids[at], marks[at] = b.ids, np.where(b.last, ord(";"), ord(","))
    bounds = a.bounds + b.bounds
    top = int(ids.max(initial=0))
    digits = np.zeros((top + 1, len(str(top)) + 1), np.uint8)
    lengths = np.zeros(top + 1, np.int64)
    numbers = np.arange(top + 1)
    for many in range(1, len(str(top)) + 1):
        own = numbers[(numbers >= 10 ** (many - 1) if many > 1 else numbers >= 0) & (numbers < 10**many)]
        lengths[own] = many
        for place in range(many):
            digits[own, place] = 48 + own // 10 ** (many - 1 - place) % 10
    rows, filled = digits[ids], lengths[ids]
    rows[np.arange(size), filled] = marks
    filled = filled + 1
    # No mark after a text's last group.
    filled[bounds[1:][bounds[1:] > bounds[:-1]] - 1] -= 1
    flat = rows[np.arange(digits.shape[1]) < filled[:, None]]
    return flat, np.append(0, np.cumsum(filled))[bounds]


TEXTS = (
    "block long, key binary, copies long, n_a long, n_b long, n_groups long, n_links long, "
    "groups string, pairs binary, times binary, codes binary, weights binary"
)
NAMES = [part.split()[0] for part in TEXTS.split(", ")]


def _binaries(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Slices of an array as binary values (or text)."""
    cuts = pa.py_buffer((bounds * values.itemsize).astype(np.int64))
    large = pa.large_binary() if kind == pa.binary() else pa.large_string()
    data = pa.py_buffer(np.ascontiguousarray(values))
    return pa.Array.from_buffers(large, len(bounds) - 1, [None, cuts, data]).cast(kind)


def block_rows(
    own: Tokenizers, block: int, keys: list[bytes], copies: list[int], texts: list[str]
) -> Iterator[pa.RecordBatch]:
    """A row per text, and one with the block's distinct pairs and the documents that hold each."""
    a, b = sides(*own.of(texts), own.a_sizes, own.b_sizes)
    width = len(own.b_bytes)
    found, per_group = links(a, b, width)
    codes, place = np.unique(found.codes, return_inverse=True)
    per_text = np.repeat(np.arange(len(texts)), np.diff(found.bounds))
    weights = np.bincount(place, np.array(copies, np.float64)[per_text], len(codes))
    group_bounds = np.append(0, np.cumsum(a.last))[a.bounds]
    link_sums = np.append(0, np.cumsum(per_group))[group_bounds]
    # Places ascend within a text; steps are small numbers.
    steps = np.diff(place, prepend=0)
    firsts = found.bounds[:-1][found.bounds[:-1] < found.bounds[1:]]
    steps[firsts] = place[firsts]
    flat, cuts = printed(a, b)
    n = len(texts)
    nothing = pa.nulls(n, pa.binary())
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(n, block)), pa.array(keys, pa.binary()), pa.array(copies, pa.int64()),
            *[pa.array(np.diff(part)) for part in (a.bounds, b.bounds, group_bounds, link_sums)],
            _binaries(flat, cuts, pa.string()),
            _binaries(steps.astype(np.int32), found.bounds, pa.binary()),
            _binaries(found.times.astype(np.int32), found.bounds, pa.binary()), nothing, nothing,
        ],
        NAMES,
    )
    if len(codes):
        row = {
            "block": block, "codes": codes.astype(np.int64).tobytes(),
            "weights": weights.astype(np.int64).tobytes(),
        }
        kinds = [pa.int64(), pa.binary(), *[pa.int64()] * 5, pa.string(), *[pa.binary()] * 4]
        arrays = [pa.array([row.get(name)], kind) for name, kind in zip(NAMES, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, NAMES)


def aligned(
    docs: DataFrame, tokenizers: dict, text: str = "text", chars: int = BLOCK_CHARS
) -> DataFrame:
    """Each distinct text of ``docs`` once: ``key`` (its SHA-256), ``copies``, the numbers of tokens,
    groups and links, the ``groups`` themselves as text, and its pairs by place in its block. A row
    without a key lists the distinct pairs of a block."""
    shared = docs.sparkSession.sparkContext.broadcast(tokenizers)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = shared.value
        own = values.setdefault("tokenizers", None) or Tokenizers(values)
        values["tokenizers"] = own
        number = TaskContext.get().partitionId() << 32
        held: tuple[list, list, list] = ([], [], [])
        size = 0
        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("key", "copies", "text")), strict=True):
                value = row[2].as_py()
                if held[0] and size + len(value) > chars:
                    yield from block_rows(own, number, *held)
                    number, held, size = number + 1, ([], [], []), 0
                for column, item in zip(held, (row[0].as_py(), row[1].as_py(), value)):
                    column.append(item)
                size += len(value)
        if held[0]:
            yield from block_rows(own, number, *held)

    rows = docs.select(F.col(text).cast("string").alias("text")).where("text <> ''")
    distinct = rows.groupBy("text").agg(F.count("*").alias("copies"))
    keyed = distinct.select(F.unhex(F.sha2("text", 256)).alias("key"), "copies", "text")
    return keyed.mapInArrow(task, TEXTS)


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks' lists of pairs as rows."""
    for batch in batches:
        columns = [batch.column(name) for name in ("block", "codes", "weights")]
        for block, codes, weights in zip(*columns, strict=True):
            code = np.frombuffer(codes.as_buffer(), np.int64)
            values = [
                np.full(len(code), block.as_py()), np.arange(len(code)), code,
                np.frombuffer(weights.as_buffer(), np.int64),
            ]
            names = ["block", "place", "code", "documents"]
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in values], names)


def listed(texts: DataFrame) -> DataFrame:
    """``block, place, code, documents`` of every block's distinct pairs."""
    rows = texts.where("codes is not null").select("block", "codes", "weights")
    return rows.mapInArrow(_listed, "block long, place long, code long, documents long")


def pair_counts(texts: DataFrame, width: int) -> DataFrame:
    """``code, a, b, n, best``: how many documents hold the pair, and whether no other pair of the
    same A id is held by more."""
    counts = listed(texts).groupBy("code").agg(F.sum("documents").alias("n"))
    a = F.floor(F.col("code") / width)
    counts = stored(counts.select("code", a.alias("a"), (F.col("code") % width).alias("b"), "n"), "pairs")
    most = counts.groupBy("a").agg(F.max("n").alias("most"))  # at most a row per id of A
    return counts.join(F.broadcast(most), "a").select(
        "code", "a", "b", "n", (F.col("n") == F.col("most")).alias("best")
    )


SUMS = "key binary, n_best long, count_sum long"


def _summed(texts: pa.Table, replies: pa.Table) -> pa.Table:
    """The measures of a block's texts that depend on the counts."""
    place = replies["place"].to_numpy()
    n, best = np.zeros(len(place) + 1, np.int64), np.zeros(len(place) + 1, np.int64)
    n[place] = replies["n"].to_numpy()
    best[place] = replies["best"].to_numpy().astype(np.int64)
    sums, bests = [], []
    for pairs, times in zip(texts["pairs"], texts["times"], strict=True):
        at = np.cumsum(np.frombuffer(pairs.as_buffer(), np.int32))
        many = np.frombuffer(times.as_buffer(), np.int32)
        sums.append(int(n[at] @ many))
        bests.append(int(best[at] @ many))
    return pa.table(
        [texts["key"], pa.array(bests, pa.int64()), pa.array(sums, pa.int64())],
        ["key", "n_best", "count_sum"],
    )


def measured(
    docs: DataFrame,
    keep: Sequence[str],
    shown: Mapping[str, Column] | None = None,
    tokenizers: dict | None = None,
    text: str = "text",
    chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The columns ``keep`` of ``docs`` and the measures of their texts. ``shown`` adds columns made
    of those of ``aligned``, its ``groups`` for one, null for texts that are null or empty."""
    spark = docs.sparkSession
    shown = dict(shown or {})
    tokenizers = tokenizers or load()
    texts = aligned(docs, tokenizers, text, chars).withColumns(
        {f"shown_{name}": column for name, column in shown.items()}
    )
    with setting(spark, "spark.sql.parquet.compression.codec", "zstd"):
        texts = stored(texts.drop("groups"), "aligned")
    counts = pair_counts(texts, tokenizers["pieces"])
    replies = listed(texts).join(counts, "code").select("block", "place", "n", "best")
    pairs = texts.where("key is not null").select("block", "key", "pairs", "times")
    sums = pairs.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(_summed, SUMS)
    sums = stored(sums, "sums")
    plain = texts.where("key is not null").select(
        "key", "n_a", "n_b", "n_groups", "n_links", *[f"shown_{name}" for name in shown]
    )
    own = plain.join(sums, "key").withColumnRenamed("key", "text_key")
    kept = [name for name in keep if name not in (*MEASURES, *shown)]
    # A text that very many documents share is split by adaptive execution.
    given = docs.select(
        F.struct(*kept).alias("kept"), F.unhex(F.sha2(F.col(text).cast("string"), 256)).alias("own_key")
    )
    rows = given.join(own, given["own_key"] == own["text_key"], "left")
    return rows.select(
        "kept.*",
        *[F.coalesce(name, F.lit(0).cast("long")).alias(name) for name in MEASURES],
        *[F.col(f"shown_{name}").alias(name) for name in shown],
    )
