"""Near-duplicate documents: one-permutation MinHash with optimal densification, banded
buckets and star-shaped candidate edges.

1. Every document becomes the set of its distinct word shingles (64-bit hashes). Documents with
   equal sets form one class; only classes are compared.
2. One hash of each shingle serves all bins of the signature: its top bits choose the bin, the
   smallest hash of a bin is its sample. An empty bin borrows from the first filled bin of a fixed
   random order of its own, so borrowed samples agree with the probability of the likeness too.
3. Bands of samples are buckets. Within a bucket every class is a candidate partner of the
   smallest one: a star, so pairs grow with the members and not with their square.
4. Candidates are confirmed on the full sets. Members of a bucket that the stars leave in
   different components are compared too: by bitmaps of their sets, inside the join, which gives
   out only the pairs that can be alike; these are confirmed on the full sets. So no pair that
   shares a bucket is missed, whatever the centre.
5. Components by smallest-label propagation with pointer jumping, as joins.

Two documents at the threshold share no bucket with probability (1 - 0.8^6)^42 = 3e-6.

Defined results: null or empty text, or text without words, has an empty set, is linked with
nothing and is its own component. A text with fewer words than a shingle has its whole word
sequence as its one shingle. Rows of one doc_id are one document for links, whatever their texts.
A row without a doc_id belongs to the component of the rows with an equal set, and is a component
of its own (null) if there are none. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adpulse.llm.store import drop, stored
from adpulse.llm.words import Block, blocks, mix, sequence, windows

SHINGLE_WORDS = 5
THRESHOLD_PERCENT = 80
BIN_BITS = 8
BAND_ROWS = 6

_BINS = 1 << BIN_BITS
_BANDS = _BINS // BAND_ROWS
#: For each empty bin the order in which it looks for a filled one.
_DETOURS = np.argsort(sequence(_BINS * _BINS, seed=9).reshape(_BINS, _BINS), axis=1)

SIGNATURE_SCHEMA = "doc_id long, n_shingles long, class binary, bands array<long>"
SET_SCHEMA = "class binary, shingles array<long>, bitmap array<long>"
#: Bits of a set's bitmap; each shingle sets one.
BITMAP_WORDS = 64


# --- sets and signatures, in Arrow tasks -----------------------------------------------


def shingle_block(block: Block, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts of a block, ascending within each text, and the
    bounds of each text's set."""
    hashed, at = windows(block, size)
    owner = block.owner[at]
    counts = block.counts
    for text in np.flatnonzero((counts > 0) & (counts < size)):
        whole = np.uint64(counts[text])
        for word in block.hashes[block.bounds[text] : block.bounds[text + 1]]:
            whole = mix(np.array([whole ^ word]))[0]
        hashed, owner = np.append(hashed, whole), np.append(owner, text)
    order = np.lexsort((hashed, owner))
    hashed, owner = hashed[order], owner[order]
    new = np.ones(len(hashed), bool)
    new[1:] = (hashed[1:] != hashed[:-1]) | (owner[1:] != owner[:-1])
    hashed, owner = hashed[new], owner[new]
    return hashed, np.searchsorted(owner, np.arange(len(counts) + 1))


def class_keys(hashed: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """128 bits that two sets share only if they are equal, as rows of two numbers."""
    size = np.diff(bounds).astype(np.uint64)
    halves = []
    for salt in sequence(2, seed=16):
        sums = np.append(np.uint64(0), np.cumsum(mix(hashed ^ salt)))
        halves.append(mix(sums[bounds[1:]] - sums[bounds[:-1]] + size * salt))
    return np.stack(halves, axis=1)


def signature_block(hashed: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The samples of every non-empty set; rows of empty sets are zero."""
    n = len(bounds) - 1
    samples = np.zeros((n, _BINS), np.uint64)
    filled = np.zeros((n, _BINS), bool)
    owner = np.repeat(np.arange(n), np.diff(bounds))
    bins = (hashed >> np.uint64(64 - BIN_BITS)).astype(np.int64)
    first = np.ones(len(hashed), bool)
    first[1:] = (owner[1:] != owner[:-1]) | (bins[1:] != bins[:-1])
    samples[owner[first], bins[first]] = hashed[first]
    filled[owner[first], bins[first]] = True
    text, gap = np.nonzero(~filled & (np.diff(bounds) > 0)[:, None])
    for step in range(_BINS):
        if not len(text):
            break
        lender = _DETOURS[gap, step]
        found = filled[text, lender]
        samples[text[found], gap[found]] = samples[text[found], lender[found]]
        text, gap = text[~found], gap[~found]
    return samples


def band_block(samples: np.ndarray) -> np.ndarray:
    rows = samples[:, : _BANDS * BAND_ROWS].reshape(len(samples), _BANDS, BAND_ROWS)
    hashed = np.broadcast_to(sequence(_BANDS, seed=5), rows.shape[:2]).copy()
    for k in range(BAND_ROWS):
        hashed = mix(hashed + rows[:, :, k])
    return hashed


def bitmap_block(hashed: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A bitmap of every set. Two sets differ in at least as many shingles as their bitmaps
    differ in bits."""
    maps = np.zeros((len(bounds) - 1, BITMAP_WORDS), np.uint64)
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    place = hashed & np.uint64(64 * BITMAP_WORDS - 1)
    bit = np.uint64(1) << (place & np.uint64(63))
    np.bitwise_or.at(maps, (owner, (place >> np.uint64(6)).astype(np.int64)), bit)
    return maps


def _lists(rows: np.ndarray) -> pa.Array:
    bounds = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(
        pa.array(bounds), pa.array(rows.reshape(-1).view(np.int64), pa.int64())
    )


def _binary(rows: np.ndarray) -> pa.Array:
    width = rows.shape[1] * 8
    return pa.Array.from_buffers(
        pa.binary(width), len(rows), [None, pa.py_buffer(np.ascontiguousarray(rows))]
    ).cast(pa.binary())


def _signatures(size: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("text"), lower=True):
                hashed, bounds = shingle_block(block, size)
                n = len(bounds) - 1
                counts = np.diff(bounds)
                bands = band_block(signature_block(hashed, bounds))[counts > 0]
                lists = np.concatenate([[0], np.cumsum(np.where(counts > 0, _BANDS, 0))])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(block.first, n),
                        pa.array(counts, pa.int64()),
                        _binary(class_keys(hashed, bounds)),
                        pa.ListArray.from_arrays(
                            pa.array(lists, pa.int32()),
                            pa.array(bands.reshape(-1).view(np.int64), pa.int64()),
                        ),
                    ],
                    ["doc_id", "n_shingles", "class", "bands"],
                )

    return task


def _sets(size: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("text"), lower=True):
                hashed, bounds = shingle_block(block, size)
                yield pa.RecordBatch.from_arrays(
                    [
                        _binary(class_keys(hashed, bounds)),
                        pa.ListArray.from_arrays(
                            pa.array(bounds, pa.int32()),
                            pa.array(hashed.view(np.int64), pa.int64()),
                        ),
                        _lists(bitmap_block(hashed, bounds)),
                    ],
                    ["class", "shingles", "bitmap"],
                )

    return task


def _plain(docs: DataFrame, text: str = "text") -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))


def signatures(docs: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    return _plain(docs).mapInArrow(_signatures(size), SIGNATURE_SCHEMA)


# --- candidates, links and components --------------------------------------------------


def bucket_members(classes: DataFrame) -> DataFrame:
    """``hash, node, centre``: the members of every bucket that holds more than one class and
    the smallest of them. ``classes``: node, bands."""
    members = classes.select("node", F.explode("bands").alias("hash"))
    centres = (
        members.groupBy("hash")
        .agg(F.min("node").alias("centre"), F.max("node").alias("last"))
        .where("centre < last")
        .drop("last")
    )
    return members.join(centres, "hash")


def likeness_reaches(a: str, b: str, percent: int = THRESHOLD_PERCENT):
    """Whether two sets (arrays without repeats) are that alike, by full intersection. The
    sizes are looked at first, which spares most unequal pairs the intersection."""
    size_a, size_b = F.size(a), F.size(b)
    shared = F.size(F.array_intersect(a, b))
    near = (size_a * 100 >= size_b * percent) & (size_b * 100 >= size_a * percent)
    return F.when(near, shared * 100 >= (size_a + size_b - shared) * percent).otherwise(False)


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` that reach the threshold on their full sets (``node, shingles``)."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))
    both = pairs.join(left, "a").join(right, "b")
    return both.where(likeness_reaches("set_a", "set_b")).select("a", "b")


def may_reach(a: str, b: str, percent: int = THRESHOLD_PERCENT):
    """Whether two sets, given as structs of ``n`` and ``bitmap``, can be that alike at all: no
    pair that is alike enough is turned away. They differ in d shingles or more, so at most
    (n_a + n_b - d) / 2 are in both and at least (n_a + n_b + d) / 2 in either."""
    differ = F.bit_count(F.col(a)["bitmap"][0].bitwiseXOR(F.col(b)["bitmap"][0]))
    for k in range(1, BITMAP_WORDS):
        differ += F.bit_count(F.col(a)["bitmap"][k].bitwiseXOR(F.col(b)["bitmap"][k]))
    total = F.col(a)["n"] + F.col(b)["n"]
    near = (F.col(a)["n"] * 100 >= F.col(b)["n"] * percent) & (
        F.col(b)["n"] * 100 >= F.col(a)["n"] * percent
    )
    return F.when(near, (total - differ) * 100 >= (total + differ) * percent).otherwise(False)


def crossing_pairs(shared: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs of members of one bucket that are still in different components and can be alike.
    The bitmaps are compared as part of the join, so it gives out few pairs beyond the links."""
    placed = shared.join(labels, "node", "left").select(
        "hash", "node", F.coalesce("label", "node").alias("part")
    )
    open_buckets = (
        placed.groupBy("hash")
        .agg(F.min("part").alias("low"), F.max("part").alias("high"))
        .where("low < high")
        .select("hash")
    )
    drawn = sets.select("node", F.struct(F.size("shingles").alias("n"), "bitmap").alias("map"))
    loose = placed.join(open_buckets, "hash", "left_semi").join(drawn, "node")
    left, right = (
        loose.select(
            F.col("hash").alias(f"hash_{side}"),
            F.col("node").alias(side),
            F.col("part").alias(f"part_{side}"),
            F.col("map").alias(f"map_{side}"),
        )
        for side in "ab"
    )
    pairs = left.join(
        right,
        (F.col("hash_a") == F.col("hash_b"))
        & (F.col("a") < F.col("b"))
        & (F.col("part_a") != F.col("part_b"))
        & may_reach("map_a", "map_b"),
    )
    return pairs.select("a", "b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` of every node of the edges ``a, b``: label is the smallest node that can
    be reached. Each round takes the smallest label among the neighbours, then the label of that
    label, so that long chains shorten by more than half."""
    both = stored(
        edges.select("a", "b").union(edges.select("b", "a")).toDF("node", "other").distinct(),
        "edges",
    )
    labels = stored(
        both.groupBy("node")
        .agg(F.min("other").alias("other"))
        .select("node", F.least("node", "other").alias("label")),
        "labels",
    )
    while True:
        nearby = (
            both.join(labels.toDF("other", "near"), "other")
            .groupBy("node")
            .agg(F.min("near").alias("near"))
        )
        closer = labels.join(nearby, "node").select(
            "node", "label", F.least("label", "near").alias("near")
        )
        jumped = stored(
            closer.join(labels.toDF("near", "far"), "near").select(
                "node", "label", F.least("near", "far").alias("next")
            ),
            "labels",
        )
        drop(labels)
        labels = jumped.select("node", F.col("next").alias("label"))
        labels.stored_at = jumped.stored_at
        if jumped.where("label != next").isEmpty():
            drop(both)
            return labels


def near_duplicates(docs: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs`` (doc_id, text)."""
    plain = _plain(docs)
    signed = stored(signatures(plain, size), "signatures")
    classes = stored(
        signed.where("n_shingles > 0")
        .groupBy("class")
        .agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands")),
        "classes",
    )
    shared = stored(bucket_members(classes.where("node is not null")), "buckets")
    pairs = shared.where("node != centre").select(
        F.col("centre").alias("a"), F.col("node").alias("b")
    )
    pairs = stored(pairs.distinct(), "stars")

    # Only classes with a candidate bring their set; one document stands for its class.
    wanted = classes.select("class", "node").join(
        shared.select("node").distinct(), "node", "left_semi"
    )
    holders = wanted.select(F.col("node").alias("doc_id")).distinct()
    texts = plain.join(holders, "doc_id", "left_semi")
    sets = texts.mapInArrow(_sets(size), SET_SCHEMA).join(wanted, "class")
    sets = stored(sets.dropDuplicates(["class"]).drop("class"), "sets")

    starred = stored(confirmed(pairs, sets), "links")
    first_labels = components(starred)
    crossing = stored(crossing_pairs(shared, first_labels, sets), "crossing")
    crossed = stored(confirmed(crossing, sets), "links")
    drop(shared, pairs, crossing, sets, first_labels)
    labels = components(starred.union(crossed))
    drop(starred, crossed)

    named = (
        classes.select("class", "node")
        .join(labels, "node", "left")
        .select("class", F.coalesce("label", "node").alias("component_id"))
    )
    result = signed.select("doc_id", "n_shingles", "class").join(named, "class", "left")
    component = F.coalesce("component_id", "doc_id")
    return result.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )
