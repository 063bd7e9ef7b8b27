"""SentencePiece encoding and decoding over a relational lattice.

A word is encoded by the cheapest way through its lattice: every substring that is a piece of the
vocabulary is an edge, a character that is no piece is an edge of its byte pieces. For a table of
words the lattice is relational: substrings up to the longest piece are exploded, joined with the
piece table, grouped by word, and folded in order of their ends (Viterbi) by a higher-order
aggregate. Costs are integers, so all engines agree; of equally cheap ways the one whose last piece
is longest is taken, and so on backwards.

For whole texts, the words that occur most often, ``FREQUENT`` at most, are encoded that way and
their pieces are broadcast as a table of bounded size. Each text then looks up its words; a word
that is not in the table (rare or longer than ``LOOKUP_CHARS``) goes through the same lattice, with
the same costs and the same order, inside the task that holds the text. So texts are not shuffled,
and every word of every text is encoded.

Normalisation: a space becomes the mark U+2581 at the start of the word after it, and a space is put
before every text. White space that precedes no word stands by itself; pieces do not cross the end
of a word. U+2581 in a text is encoded by its bytes. Nothing is dropped, so decoding gives back
exactly the text.

A vocabulary ranked by merges (its scores are negative ranks) gets costs by rank as in Zipf's law,
one of log-probabilities the negated scores.

Defined results: null and empty text have no pieces, and no pieces decode to the empty text.
Repeated rows get equal results. Other columns pass through; one named ``pieces`` is replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import cached_property
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

from adpulse.llm.store import drop, stored
from adpulse.llm.words import SPACES, Block, blocks, mix

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
FREQUENT = 1 << 19
LOOKUP_CHARS = 40
#: Rare words that a Python worker remembers.
KNOWN_WORDS = 20_000
#: Cost units per nat.
UNITS = 1000
MAX_PIECES = 1 << 20

_FAR = 1 << 60
_UNIT = r"\x20?[^\x20\x09-\x0D]+"
_MARKED = np.uint64(0xA0761D6478BD642F)


class Vocabulary(NamedTuple):
    """Pieces with their ids and costs, the ids of the 256 byte pieces and the cost of each, and
    the bytes that every id decodes to."""

    ids: dict[str, int]
    costs: dict[str, int]
    byte_ids: tuple[int, ...]
    byte_cost: int
    decoded: tuple[bytes, ...]
    longest: int


def load(path: str = MODEL) -> Vocabulary:
    """Read a model file. It must have all byte pieces."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    if size > MAX_PIECES:
        raise ValueError(f"more than {MAX_PIECES} pieces")
    ids, scores, byte_ids, decoded = {}, {}, {}, []
    for k in range(size):
        piece = model.id_to_piece(k)
        if model.is_byte(k):
            byte_ids[int(piece[3:5], 16)] = k
            decoded.append(bytes([int(piece[3:5], 16)]))
        elif model.is_control(k) or model.is_unknown(k) or model.is_unused(k):
            decoded.append(b"")
        else:
            decoded.append(piece.replace(MARK, " ").encode())
            # The mark stands for a space, and only at the start of a word.
            if MARK not in piece[1:]:
                ids[piece], scores[piece] = k, model.get_score(k)
    if len(byte_ids) < 256:
        raise ValueError("the vocabulary has no byte pieces")
    ranked = all(score == int(score) for score in scores.values())
    costs = {
        piece: round(UNITS * (math.log(2 - score) if ranked else -score))
        for piece, score in scores.items()
    }
    return Vocabulary(
        ids,
        costs,
        tuple(byte_ids[k] for k in range(256)),
        2 * max(costs.values()),
        tuple(decoded),
        max(map(len, ids)),
    )


# --- a table of words ------------------------------------------------------------------


def piece_table(spark: SparkSession, vocabulary: Vocabulary) -> DataFrame:
    rows = [(piece, k, vocabulary.costs[piece]) for piece, k in vocabulary.ids.items()]
    return spark.createDataFrame(rows, "piece string, id int, cost long")


def lattice(words: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``word, start, end, ids, cost``: all edges of the distinct ``words`` (word). A word starts
    with the mark if a space is before it."""
    spark = words.sparkSession
    size = F.length("word")
    starts = words.where(size > 0).select("word", F.explode(F.sequence(F.lit(0), size - 1)).alias("start"))
    reach = F.least(F.length("word") - F.col("start"), F.lit(vocabulary.longest))
    parts = starts.select("word", "start", F.explode(F.sequence(F.lit(1), reach)).alias("n"))
    parts = parts.withColumn("piece", F.substring("word", F.col("start") + 1, F.col("n")))
    # The mark within a word is a character of the text and no piece.
    known = F.broadcast(piece_table(spark, vocabulary))
    found = parts.join(known, "piece", "left").withColumn(
        "id", F.when((F.col("start") == 0) | ~F.col("piece").startswith(MARK), F.col("id"))
    )
    edges = found.where("id is not null or n = 1")
    as_bytes = F.transform(
        F.regexp_extract_all(F.hex(F.encode("piece", "utf-8")), F.lit(".."), 0),
        lambda pair: F.array(*map(F.lit, vocabulary.byte_ids))[F.conv(pair, 16, 10).cast("int")],
    )
    known_edge = F.col("id").isNotNull()
    return edges.select(
        "word",
        "start",
        (F.col("start") + F.col("n")).alias("end"),
        F.when(known_edge, F.array("id")).otherwise(as_bytes).alias("ids"),
        F.when(known_edge, F.col("cost"))
        .otherwise(F.size(as_bytes) * F.lit(vocabulary.byte_cost))
        .alias("cost"),
    )


def cheapest(edges: Column) -> Column:
    """The ids on the cheapest way, of edges in order of end and start. The state holds the best
    way to every place so far."""
    place = "array<struct<cost:bigint,ids:array<int>>>"
    start = F.array(F.struct(F.lit(0).alias("cost"), F.array().alias("ids"))).cast(place)

    def step(best: Column, edge: Column) -> Column:
        before = best[edge["start"]]
        way = F.struct(
            (before["cost"] + edge["cost"]).alias("cost"),
            F.concat(before["ids"], edge["ids"]).alias("ids"),
        )
        closed = F.slice(best, F.lit(1), edge["end"])
        first = F.size(best) == edge["end"]
        better = first | (way["cost"] < F.element_at(best, -1)["cost"])
        return F.when(better, F.concat(closed, F.array(way))).otherwise(best)

    return F.aggregate(edges, start, step, lambda best: F.element_at(best, -1)["ids"])


def encode_words(words: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``word, ids`` of the distinct, non-empty ``words`` (word)."""
    edges = lattice(words, vocabulary)
    grouped = edges.groupBy("word").agg(
        F.sort_array(F.collect_list(F.struct("end", "start", "cost", "ids"))).alias("edges")
    )
    return grouped.select("word", cheapest(F.col("edges")).alias("ids"))


# --- whole texts -----------------------------------------------------------------------


def frequent_words(docs: DataFrame, most: int = FREQUENT) -> DataFrame:
    """The words of all texts that occur most often, at most ``most`` and all down to a certain
    number of occurrences; marked, and none longer than ``LOOKUP_CHARS``."""
    spaced = F.concat(F.lit(" "), F.coalesce(F.col("text").cast("string"), F.lit("")))
    units = docs.select(F.explode(F.regexp_extract_all(spaced, F.lit(_UNIT), F.lit(0))).alias("unit"))
    counts = units.groupBy("unit").agg(F.count("*").alias("n"))
    counts = counts.where((F.col("n") > 1) & (F.length("unit") <= LOOKUP_CHARS))
    counts = stored(counts, "word-counts")
    # As many rows as there are different numbers of occurrences.
    steps = counts.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.desc("n"))
    total, least = 0, 1 << 62
    for row in steps.toLocalIterator():
        total += row["words"]
        if total > most:
            break
        least = row["n"]
    chosen = counts.where(F.col("n") >= least)
    words = chosen.select(F.regexp_replace("unit", r"\A\x20", MARK).alias("word"))
    words.stored_at = counts.stored_at
    return words


class Lookup(NamedTuple):
    """Hashes of words in ascending order; the pieces of each."""

    hashes: np.ndarray
    bounds: np.ndarray
    ids: np.ndarray


def _unit_hashes(hashes: np.ndarray, marked: np.ndarray) -> np.ndarray:
    return np.where(marked, mix(hashes + _MARKED), hashes)


def lookup_of(encoded: DataFrame) -> Lookup:
    """Collect encoded words (word, ids): at most ``FREQUENT`` rows of ``LOOKUP_CHARS``."""
    table = encoded.select("word", "ids").toArrow().combine_chunks()
    if not table.num_rows:
        return Lookup(np.zeros(0, np.uint64), np.zeros(1, np.int64), np.zeros(0, np.int32))
    words, lists = (table[name].chunk(0) for name in ("word", "ids"))
    marked = pc.starts_with(words, MARK)
    bare = pc.if_else(marked, pc.utf8_slice_codeunits(words, len(MARK)), words)
    hashes = np.concatenate([block.hashes for block in blocks(bare)])
    hashes = _unit_hashes(hashes, marked.to_numpy(zero_copy_only=False))
    order = np.argsort(hashes, kind="stable")
    starts = lists.offsets.to_numpy()
    counts = np.diff(starts)[order]
    bounds = np.append(0, np.cumsum(counts, dtype=np.int64))
    index = np.arange(bounds[-1]) + np.repeat(starts[:-1][order] - bounds[:-1], counts)
    return Lookup(hashes[order], bounds, lists.values.to_numpy()[index])


class Encoder:
    """Texts to pieces inside a task."""

    def __init__(self, vocabulary: Vocabulary, lookup: Lookup):
        self.vocabulary, self.lookup = vocabulary, lookup
        self.spaces = {
            byte: vocabulary.ids.get(MARK) if byte == 0x20 else vocabulary.byte_ids[byte]
            for byte in SPACES
        }
        if self.spaces[0x20] is None:
            self.spaces[0x20] = vocabulary.byte_ids[0x20]
        sizes = np.array([len(piece) for piece in vocabulary.decoded], np.int64)
        self.piece_bounds = np.append(0, np.cumsum(sizes))
        self.piece_bytes = np.frombuffer(b"".join(vocabulary.decoded), np.uint8)
        self.known: dict[tuple[bytes, bool], list[int]] = {}

    @cached_property
    def reach(self) -> dict[str, int]:
        """Cost of every piece, and of whatever some piece begins with. Built where it is first
        needed, which is a task and not the driver."""
        found = {
            piece[:end]: _FAR for piece in self.vocabulary.ids for end in range(1, len(piece))
        }
        found.update(self.vocabulary.costs)
        return found

    def word(self, raw: bytes, marked: bool) -> list[int]:
        """The cheapest way through the lattice of one word."""
        if (raw, marked) in self.known:
            return self.known[raw, marked]
        vocabulary, reach = self.vocabulary, self.reach
        text = (MARK if marked else "") + raw.decode("utf-8", "surrogateescape")
        size = len(text)
        best, back = [0] + [_FAR] * size, [0] * (size + 1)
        for start in range(size):
            so_far = best[start]
            single = False
            if start == 0 or text[start] != MARK:
                for end in range(start + 1, size + 1):
                    # None: no piece goes on like this; _FAR: a longer one may.
                    cost = reach.get(text[start:end])
                    if cost is None:
                        break
                    if cost < _FAR:
                        single = single or end == start + 1
                        if so_far + cost < best[end]:
                            best[end], back[end] = so_far + cost, start
            if not single:
                cost = len(text[start].encode("utf-8", "surrogateescape")) * vocabulary.byte_cost
                if so_far + cost < best[start + 1]:
                    best[start + 1], back[start + 1] = so_far + cost, start
        way, end = [], size
        while end:
            start = back[end]
            piece = text[start:end]
            known = vocabulary.ids.get(piece) if start == 0 or text[start] != MARK else None
            if known is None:
                own = piece.encode("utf-8", "surrogateescape")
                way.extend(vocabulary.byte_ids[byte] for byte in reversed(own))
            else:
                way.append(known)
            end = start
        result = way[::-1]
        if len(self.known) >= KNOWN_WORDS:
            self.known.clear()
        self.known[raw, marked] = result
        return result

    def block(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of a block, and the bounds of each text."""
        raw, cuts, starts = block.raw, block.cuts, block.starts
        filled = cuts[:-1] < cuts[1:]
        heads = cuts[:-1][filled]
        at_head = np.isin(starts, heads)
        before = np.where(starts > 0, raw[np.maximum(starts - 1, 0)], 0)
        marked = at_head | (before == 0x20)
        # White space that no word takes up, and the space put before a text that starts with some.
        space = np.isin(raw, SPACES)
        taken = starts[marked & ~at_head] - 1
        alone = space.copy()
        alone[taken] = False
        alone = np.flatnonzero(alone)
        leading = heads[space[heads]]

        hashes = _unit_hashes(block.hashes, marked)
        if len(self.lookup.hashes):
            slot = np.searchsorted(self.lookup.hashes, hashes)
            slot = np.minimum(slot, len(self.lookup.hashes) - 1)
            hit = self.lookup.hashes[slot] == hashes
            low = np.where(hit, self.lookup.bounds[slot], 0)
            counts = np.where(hit, self.lookup.bounds[slot + 1] - low, 0)
        else:
            hit = np.zeros(len(hashes), bool)
            low, counts = (np.zeros(len(hashes), np.int64) for _ in range(2))
        pool = [self.lookup.ids]
        size = len(self.lookup.ids)
        missing = np.flatnonzero(~hit)
        if len(missing):
            data = raw.tobytes()
            ends = self._ends(block, space)
            rare: list[int] = []
            for k, start, end, mark in zip(
                missing.tolist(), starts[missing].tolist(), ends[missing].tolist(),
                marked[missing].tolist(), strict=True,
            ):
                ids = self.word(data[start:end], mark)
                low[k], counts[k] = size + len(rare), len(ids)
                rare += ids
            pool.append(np.array(rare, np.int32))
            size += len(rare)
        single = np.arange(256)
        table = np.zeros(256, np.int32)
        for byte, k in self.spaces.items():
            table[byte] = k
        pool.append(table)

        place = np.concatenate([starts * 2 + 1, alone * 2 + 1, leading * 2])
        all_low = np.concatenate([low, size + single[raw[alone]], np.full(len(leading), size + 32)])
        all_counts = np.concatenate([counts, np.ones(len(alone) + len(leading), np.int64)])
        order = np.argsort(place, kind="stable")
        place, all_low, all_counts = place[order], all_low[order], all_counts[order]
        sums = np.append(0, np.cumsum(all_counts))
        index = np.arange(sums[-1]) + np.repeat(all_low - sums[:-1], all_counts)
        ids = np.concatenate(pool)[index]
        return ids, sums[np.searchsorted(place, cuts * 2)]

    @staticmethod
    def _ends(block: Block, space: np.ndarray) -> np.ndarray:
        """Where each word ends: at the next white space or the end of its text."""
        stops = np.flatnonzero(space)
        following = np.searchsorted(stops, block.starts)
        stop = np.append(stops, len(block.raw))[following]
        text_end = block.cuts[np.searchsorted(block.cuts, block.starts, "right")]
        return np.minimum(stop, text_end)

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all texts, and where each begins; without the space put before each."""
        sizes = self.piece_bounds[ids + 1] - self.piece_bounds[ids]
        sums = np.append(0, np.cumsum(sizes))
        index = np.arange(sums[-1]) + np.repeat(self.piece_bounds[ids] - sums[:-1], sizes)
        keep = np.ones(len(index), bool)
        cuts = sums[bounds]
        keep[cuts[:-1][cuts[:-1] < cuts[1:]]] = False
        return self.piece_bytes[index[keep]], cuts - np.append(0, np.cumsum(np.diff(cuts) > 0))


RESULT = StructType(
    [StructField("ids", ArrayType(IntegerType())), StructField("round_trip", BooleanType())]
)


def encoder_for(docs: DataFrame, vocabulary: Vocabulary, most: int = FREQUENT) -> Encoder:
    """An encoder that looks up the words most frequent in ``docs`` (text)."""
    words = frequent_words(docs, most)
    table = stored(encode_words(words, vocabulary), "lookup")
    lookup = lookup_of(table)
    drop(words, table)
    return Encoder(vocabulary, lookup)


def encoded(
    docs: DataFrame,
    path: str = MODEL,
    most: int = FREQUENT,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all of them if left out) and ``pieces``, a struct of
    ``ids`` and ``round_trip``: whether decoding the ids gives back the text."""
    kept = [name for name in (docs.columns if keep is None else keep) if name != "pieces"]
    # A Python worker builds its encoder once and keeps it over its tasks.
    shared = docs.sparkSession.sparkContext.broadcast(encoder_for(docs, load(path), most))
    text = next(fresh for k in range(1 << 30) if (fresh := f"text{k}") not in docs.columns)
    schema = StructType([*docs.select(*kept).schema, StructField("pieces", RESULT)])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            # A batch out for every block, so that no large one is held.
            for block in blocks(batch.column(text)):
                ids, bounds = own.block(block)
                back, cuts = own.decode(ids, bounds)
                same = np.diff(cuts) == np.diff(block.cuts)
                if len(back) == len(block.raw):
                    wrong = np.append(0, np.cumsum(back != block.raw))
                    same &= wrong[block.cuts[1:]] == wrong[block.cuts[:-1]]
                else:
                    same &= False
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids))
                found = pa.StructArray.from_arrays([lists, pa.array(same)], RESULT.names)
                rows = batch.slice(block.first, len(same))
                columns = [rows.column(name) for name in kept]
                yield pa.RecordBatch.from_arrays([*columns, found], [*kept, "pieces"])

    given = docs.select(*kept, F.col("text").cast("string").alias(text))
    return given.mapInArrow(task, schema)


def decoded(ids: str, vocabulary: Vocabulary):
    """A text column from a column of ids."""

    @F.arrow_udf(StringType())
    def decode(lists: pa.Array) -> pa.Array:
        own = Encoder(vocabulary, Lookup(np.zeros(0, np.uint64), np.zeros(1, np.int64), np.zeros(0, np.int32)))
        lists = lists.fill_null([]) if lists.null_count else lists
        bounds = np.append(0, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)))
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        raw, cuts = own.decode(flat, bounds)
        data = raw.tobytes()
        texts = [data[a:b].decode("utf-8", "replace") for a, b in zip(cuts, cuts[1:], strict=False)]
        return pa.array(texts, pa.string())

    return decode(ids)
