"""Documents scored by the cross-entropy difference of two matched n-gram models.

The target model is counted on the documents marked as target, the background model on all
documents. Both are bigram models with the same smoothing over one shared vocabulary. Words and
bigrams are told apart by 64-bit hashes, and each has a count of its own: the models grow with the
input and are never in one place. Background counts are scaled to the number of target tokens, so
the smoothing weighs the same in both. The score of a document is the mean over its tokens of the
loss under the target model minus the loss under the background model: the lower, the more it is
like the target.

The loss of a word ``w`` after ``c`` is ``log(n(c) + BACKOFF) - log(n(c, w) + BACKOFF * p(w))``, so
the sum over a document falls into terms that each need the counts of one word and its bigrams
alone. Every batch of documents sends its bigrams, packed, to buckets by their word; a bucket counts
both models, and sends back what it adds to the sums of each document; a batch puts its sums
together. Words of more than one in ``FREQUENT`` tokens, at most that many, are counted beforehand
and broadcast, and their bigrams are dealt by bigram. Counts are of all documents and whole texts.

The vocabulary has ``2^WORD_BITS`` words, or as many as there are if these are more.

Defined results: null or empty text, or text without words, has 0 tokens and null losses. Without
any target document the target model is the uniform one. Repeated rows count as often as they
occur and are scored alike. Columns other than those named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from adpulse.llm.store import CLEANUP, setting, stored
from adpulse.llm.words import Block, blocks, mix

WORD_BITS = 18
#: Weight of the unigram model in every bigram's context, in tokens.
BACKOFF = 8.0
FREQUENT = 1024
#: Tokens that a task counts at once, that a batch sends together, and of a bucket.
COUNT_TOKENS, BATCH_TOKENS, BUCKET_TOKENS = 1 << 22, 1 << 20, 1 << 22

_START = np.uint64(0x5354415254)
_COUNTS = ("target", "background", "target_ends", "background_ends")
COUNT_SCHEMA = "word long, " + ", ".join(f"{name} long" for name in _COUNTS)


def _pairs(block: Block) -> np.ndarray:
    """Hash of each word with the one before it, a start mark at the first word of a text."""
    before = np.empty_like(block.hashes)
    before[1:] = block.hashes[:-1]
    before[block.bounds[:-1][block.counts > 0]] = _START
    return mix(before * np.uint64(0x9E3779B97F4A7C15) + block.hashes)


def _ends(block: Block) -> np.ndarray:
    """Whether a word is the last one of its text."""
    last = np.zeros(len(block.hashes), bool)
    last[block.bounds[1:][block.counts > 0] - 1] = True
    return last


# --- counts of words -------------------------------------------------------------------


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def summed() -> pa.RecordBatch:
        hashes, wanted, last = (np.concatenate(column) for column in zip(*parts, strict=True))
        word, place = np.unique(hashes, return_inverse=True)
        kinds = (wanted, None, wanted & last, last)
        counts = [np.bincount(place, kind, len(word)).astype(np.int64) for kind in kinds]
        parts.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(word.view(np.int64)), *map(pa.array, counts)], ["word", *_COUNTS]
        )

    tokens = 0
    for batch in batches:
        chosen = batch.column("is_target").to_numpy(zero_copy_only=False).astype(bool)
        for block in blocks(batch.column("text"), lower=True):
            wanted = chosen[block.first : block.first + len(block.counts)][block.owner]
            parts.append((block.hashes, wanted, _ends(block)))
            tokens += len(block.hashes)
            if tokens >= COUNT_TOKENS:
                yield summed()
                tokens = 0
    if parts:
        yield summed()


def _foremost(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The most frequent words of a task, and a row without a word: the sums over all of them, and
    how many there are."""
    total, n_words = np.zeros(len(_COUNTS), np.int64), 0
    top = np.zeros((0, 1 + len(_COUNTS)), np.int64)
    for batch in batches:
        table = np.column_stack([column.to_numpy() for column in batch.columns])
        total += table[:, 1:].sum(0)
        n_words += len(table)
        top = np.concatenate([top, table])
        top = top[np.lexsort((top[:, 0], -top[:, 2]))][:FREQUENT]
    columns = np.concatenate([top, [[0, *total]]]).T
    alone = np.append(np.zeros(len(top), bool), True)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(columns[0], mask=alone),
            *[pa.array(np.ascontiguousarray(column)) for column in columns[1:]],
            pa.array(np.where(alone, n_words, 0)),
        ],
        ["word", *_COUNTS, "n_words"],
    )


class Totals(NamedTuple):
    """Sums of both models, and the counts of the words that are frequent, by hash."""

    tokens: tuple[int, int]
    documents: tuple[int, int]
    vocabulary: int
    words: np.ndarray
    #: As many rows as words: target, background and the same at the ends of texts.
    counts: np.ndarray

    @property
    def scales(self) -> tuple[float, float]:
        return 1.0, self.tokens[0] / self.tokens[1] if self.tokens[1] else 0.0


def totals(docs: DataFrame) -> Totals:
    """``docs``: text, is_target."""
    counted = (
        docs.select("text", "is_target")
        .mapInArrow(_count, COUNT_SCHEMA)
        .groupBy("word")
        .agg(*[F.sum(name).alias(name) for name in _COUNTS])
    )
    with setting(docs.sparkSession, CLEANUP, "true"):
        rows = counted.mapInArrow(_foremost, f"{COUNT_SCHEMA}, n_words long").toArrow()
    alone = rows["word"].is_null().to_numpy()
    table = np.column_stack([rows[name].to_numpy() for name in _COUNTS]).reshape(-1, len(_COUNTS))
    sums = table[alone].sum(0)
    n_words = int(rows["n_words"].to_numpy().sum())
    frequent = ~alone & (table[:, 1] * FREQUENT > sums[1])
    words = rows["word"].fill_null(0).to_numpy()[frequent].view(np.uint64)
    order = np.argsort(words)
    return Totals(
        (int(sums[0]), int(sums[1])), (int(sums[2]), int(sums[3])),
        max(1 << WORD_BITS, n_words), words[order], table[frequent][order],
    )


# --- bigrams, to the buckets and back --------------------------------------------------


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays one after the other, the bytes of numbers by place, so that zeros lie together."""
    parts = [np.array([len(a) for a in arrays], np.int64).tobytes()]
    parts += [a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() for a in arrays]
    raw = b"".join(parts)
    packed = pa.compress(raw, "zstd", asbytes=True)
    return len(raw).to_bytes(8, "little") + packed


def _unpack(packed: bytes, *kinds: type) -> list[np.ndarray]:
    size = int.from_bytes(packed[:8], "little")
    raw = np.frombuffer(pa.decompress(packed[8:], size, "zstd", asbytes=True), np.uint8)
    at = 8 * len(kinds)
    found = []
    for n, kind in zip(raw[:at].view(np.int64), map(np.dtype, kinds), strict=True):
        part = raw[at : at + n * kind.itemsize].reshape(kind.itemsize, n)
        found.append(np.ascontiguousarray(part.T).view(kind).ravel())
        at += n * kind.itemsize
    return found


#: Words of a batch in a bucket, bigrams of each, their hashes, documents of each, the documents,
#: how often, words that end a text, the texts; whether each document of the batch is a target.
_SENT = (np.uint64, np.uint32, np.uint64, *[np.uint32] * 5, np.bool_)
#: Documents and their sums under both models.
_RETURNED = (np.uint32, np.float64, np.float64)


def _is_frequent(words: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flags, and the places among the frequent words."""
    if not len(frequent):
        return np.zeros(len(words), bool), np.zeros(len(words), np.int64)
    at = np.minimum(np.searchsorted(frequent, words), len(frequent) - 1)
    return frequent[at] == words, at


def _runs(fresh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs start, and how long they are."""
    starts = np.flatnonzero(fresh)
    return starts, np.diff(np.append(starts, len(fresh)))


def _changes(values: np.ndarray) -> np.ndarray:
    fresh = np.ones(len(values), bool)
    fresh[1:] = values[1:] != values[:-1]
    return fresh


def _packed(
    word: np.ndarray, pair: np.ndarray, doc: np.ndarray, last: np.ndarray, chosen: np.ndarray,
    frequent: np.ndarray, n_buckets: int,
) -> Iterator[tuple[int, bytes]]:
    """Buckets and what they get of a batch; the first one always gets something."""
    by = np.where(_is_frequent(word, frequent)[0], pair, word)
    bucket = (mix(by) % np.uint64(n_buckets)).astype(np.int32)
    order = np.lexsort((doc, pair, word))
    order = order[np.argsort(bucket[order], kind="stable")]
    word, pair, doc, last, bucket = (a[order] for a in (word, pair, doc, last, bucket))
    cuts = np.searchsorted(bucket, np.arange(n_buckets + 1))
    for k in range(n_buckets):
        low, high = cuts[k], cuts[k + 1]
        if low == high and k:
            continue
        w, p, d, e = (a[low:high] for a in (word, pair, doc, last))
        new_word = _changes(w)
        new_pair = new_word | _changes(p)
        new_entry = new_pair | _changes(d)
        starts, times = _runs(new_entry)
        place = np.cumsum(new_word) - 1
        pair_of_entry = (np.cumsum(new_pair) - 1)[starts]
        n_pairs = int(new_pair.sum())
        yield k, _pack(
            w[new_word],
            np.bincount(place[new_pair], minlength=int(new_word.sum())).astype(np.uint32),
            p[new_pair],
            np.bincount(pair_of_entry, minlength=n_pairs).astype(np.uint32),
            d[starts].astype(np.uint32),
            times.astype(np.uint32),
            place[e].astype(np.uint32),
            d[e].astype(np.uint32),
            chosen,
        )


def sender(shared, n_buckets: int):
    """To every bucket a row per batch; the row of the first one has the batch's documents."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = shared.value.words
        number = TaskContext.get().partitionId() << 32
        for whole in batches:
            chosen = whole.column("is_target").to_numpy(zero_copy_only=False).astype(bool)
            ids = whole.column("doc_id")
            held: list[Block] = []
            found = blocks(whole.column("text"), lower=True)
            done = False
            while not done:
                block = next(found, None)
                done = block is None
                if block is not None:
                    held.append(block)
                docs = sum(len(b.counts) for b in held)
                full = sum(len(b.hashes) for b in held) >= BATCH_TOKENS
                if not held or not (done or full):
                    continue
                first = held[0].first
                parts = [(b.hashes, _pairs(b), b.owner + (b.first - first), _ends(b)) for b in held]
                arrays = [np.concatenate(column) for column in zip(*parts, strict=True)]
                counts = np.concatenate([b.counts for b in held])
                held = []
                own = ids.slice(first, docs)
                sent = list(_packed(*arrays, chosen[first : first + docs], frequent, n_buckets))
                # The lists of the first row; null in the others.
                cuts = pa.array([0] + [docs] * len(sent), pa.int32())
                absent = pa.array([k > 0 for k, _ in sent])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([k for k, _ in sent], pa.int32()),
                        pa.array([number] * len(sent), pa.int64()),
                        pa.array([data for _, data in sent], pa.binary()),
                        pa.ListArray.from_arrays(cuts, own, mask=absent),
                        pa.ListArray.from_arrays(cuts, pa.array(counts, pa.int64()), mask=absent),
                    ],
                    ["bucket", "batch", "data", "ids", "counts"],
                )
                number += 1

    return send


def judge(sent: list[bytes], known: Totals) -> list[bytes]:
    """What a bucket adds to the sums of the documents of each batch."""
    batches = [_unpack(data, *_SENT) for data in sent]
    sizes = [len(batch[-1]) for batch in batches]
    n_words = [len(batch[0]) for batch in batches]
    docs_at, words_at = np.append(0, np.cumsum(sizes)), np.append(0, np.cumsum(n_words))
    columns = list(zip(*batches, strict=True))

    def shifted(column: int, by: np.ndarray) -> np.ndarray:
        return np.concatenate(
            [part.astype(np.int64) + start for part, start in zip(columns[column], by)]
        )

    words, word_of = np.unique(np.concatenate(columns[0]), return_inverse=True)
    pairs, pair_of = np.unique(np.concatenate(columns[2]), return_inverse=True)
    word_of_pair = np.repeat(word_of, np.concatenate(columns[1]))
    runs = np.concatenate(columns[3])
    pair, word = np.repeat(pair_of, runs), np.repeat(word_of_pair, runs)
    doc, times = shifted(4, docs_at), np.concatenate(columns[5]).astype(np.float64)
    end_word, end_doc = word_of[shifted(6, words_at)], shifted(7, docs_at)
    chosen = np.concatenate(columns[8])

    of_pair = np.zeros(len(pairs), np.int64)
    of_pair[pair_of] = word_of_pair
    often, at = _is_frequent(words, known.words)
    sums = []
    for k, (total, scale) in enumerate(zip(known.tokens[:1] * 2, known.scales, strict=True)):
        counts, ended = (times, None) if k else (times * chosen[doc], chosen[end_doc])
        n_word = np.bincount(word, counts, len(words))
        n_end = np.bincount(end_word, ended, len(words)).astype(np.float64)
        n_word[often], n_end[often] = known.counts[at[often], k], known.counts[at[often], 2 + k]
        n_pair = np.bincount(pair, counts, len(pairs))
        single = (scale * n_word + 1.0) / (total + known.vocabulary)
        # As the context of the next word; none follows the last one.
        context = np.log(scale * (n_word - n_end) + BACKOFF)
        double = np.log(scale * n_pair + BACKOFF * single[of_pair])
        sums.append(
            np.bincount(doc, times * (context[word] - double[pair]), len(chosen))
            - np.bincount(end_doc, context[end_word], len(chosen))
        )
    present = np.zeros(len(chosen), bool)
    present[doc] = True
    found = []
    for low, high in zip(docs_at[:-1], docs_at[1:]):
        own = np.flatnonzero(present[low:high])
        found.append(_pack(own.astype(np.uint32), *[part[low:high][own] for part in sums]))
    return found


def judger(shared):
    def judged(table: pa.Table) -> pa.Table:
        # In an order of its own, so that sums don't depend on how rows arrive.
        table = table.sort_by("batch")
        data = judge(table["data"].to_pylist(), shared.value)
        return table.set_column(table.schema.get_field_index("data"), "data", pa.array(data, pa.binary()))

    return judged


def summer(shared):
    def summed(table: pa.Table) -> pa.Table:
        table = table.sort_by("bucket")
        known: Totals = shared.value
        # The first bucket has a row of every batch.
        ids, n = table["ids"].chunk(0)[0].values, table["counts"][0].values.to_numpy()
        sums = np.zeros((2, len(n)))
        for data in table["data"].to_pylist():
            doc, *values = _unpack(data, *_RETURNED)
            for total, value in zip(sums, values, strict=True):
                total[doc] += value
        worded = n > 0
        means = []
        for total, scale, documents in zip(sums, known.scales, known.documents, strict=True):
            start = np.log(scale * documents + BACKOFF)
            means.append((total + start) / np.maximum(n, 1))
        columns = [pa.array(x, pa.float64(), mask=~worded) for x in (*means, means[0] - means[1])]
        return pa.table([ids, pa.array(n), *columns], names=["doc_id", *RESULT])

    return summed


RESULT = ("n_tokens", "target_loss", "background_loss", "difference")


def _schema(kind: DataType) -> str:
    return f"doc_id {kind.simpleString()}, n_tokens long, " + ", ".join(
        f"{name} double" for name in RESULT[1:]
    )


def differences(docs: DataFrame, targets: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, target_loss, background_loss, difference`` of every row of ``docs``.
    ``targets``: the doc_id of target documents, each once."""
    spark = docs.sparkSession
    chosen = targets.select(F.col("doc_id"), F.lit(True).alias("is_target"))
    # A merge join at every size: the targets grow with the documents.
    marked = docs.select("doc_id", "text").join(chosen.hint("merge"), "doc_id", "left")
    # Stored, as it is read twice, and so that a batch is the same rows whenever it is made.
    marked = stored(
        marked.withColumn("is_target", F.coalesce("is_target", F.lit(False))), "marked"
    )
    known = totals(marked)
    shared = spark.sparkContext.broadcast(known)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_buckets = max(least, -(-known.tokens[1] // BUCKET_TOKENS))
    kind = marked.schema["doc_id"].dataType
    schema = (
        f"bucket int, batch long, data binary, ids array<{kind.simpleString()}>, counts array<long>"
    )
    return (
        marked.mapInArrow(sender(shared, n_buckets), schema)
        .groupBy("bucket")
        .applyInArrow(judger(shared), schema)
        .groupBy("batch")
        .applyInArrow(summer(shared), _schema(kind))
    )
