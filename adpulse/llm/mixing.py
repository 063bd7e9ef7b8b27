"""Mixing overlapping sources to target sizes by minimum-cost flow.

A document belongs to a set of sources, its membership pattern. Documents are summed up by
pattern; the words of a pattern can be used once at a low cost and again at higher ones (convex, so
nothing repeats while something unused would do). A flow routes them to the sources' quotas: from
the start to each pattern once per use, from a pattern to each of its sources, from a source to the
end with its target as capacity. What flows through a pattern is then taken from its documents in a
seeded order: whole rounds first, then documents up to a cut, the last one if more than half of it
fits. So a source's words differ from its target by less than a document per pattern, and from the
flow's optimum by nothing else.

Only sums per pattern reach the driver; patterns are as many as the combinations of sources that
occur, and more than ``MAX_PATTERNS`` of them raise an error. A cut is one position in the seeded
order, so documents meet it without being moved. It is found from the sums of buckets of about
``BUCKET_ROWS`` documents and then within one bucket, so neither a hot source nor a large pattern
comes together in one task.

The order is that of a hash of doc_id and text. Rows without an id, or that share one, have places of
their own if their texts differ. Rows equal in both stand at one place and are summed there; if the
cut goes through them, as many as fit are taken, found from the counts of the chunks they were read in
and then within one chunk.

Defined results: null or empty text has size 0 and no word taken; it is taken as often as its place
says. A null source is a source of its own, last in order. A document without any source is not
taken. Without any words every target is 0. Other columns pass through; those named like the
result's are replaced.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Sequence
from fractions import Fraction
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from adpulse.llm.store import stored
from adpulse.llm.words import word_counts

MAX_PATTERNS = 100_000
BUCKET_ROWS = 4096
SEED = 20240229
#: Cost of each use of a word; as many uses as entries are possible.
USE_COSTS = (1, 3)


@F.arrow_udf(LongType())
def count_words(texts: pa.Array) -> pa.Array:
    return word_counts(texts)


# --- targets ---------------------------------------------------------------------------


def source_order(sources: Sequence[str | None]) -> list[str | None]:
    """By code point, null last."""
    return sorted(sources, key=lambda source: (source is None, source or ""))


def shared_targets(
    sizes: dict[str | None, int],
    weights: Sequence[int] = (3, 1, 2),
    share: Fraction = Fraction(3, 2),
    most: int = len(USE_COSTS),
) -> dict[str | None, Fraction]:
    """``share`` of all words divided by weight (the weights repeat along the sources in order).
    No target is above ``most`` times its source's size: the excess is divided again among the
    others by weight until none is above."""
    weight = {name: weights[k % len(weights)] for k, name in enumerate(source_order(list(sizes)))}
    left = share * sum(sizes.values())
    targets: dict[str | None, Fraction] = {}
    open_sources = set(sizes)
    while open_sources:
        whole = sum(weight[name] for name in open_sources)
        full = [n for n in open_sources if left * weight[n] >= most * sizes[n] * whole]
        if not full:
            targets |= {name: left * weight[name] / whole for name in open_sources}
            break
        for name in full:
            targets[name] = Fraction(most * sizes[name])
            left -= targets[name]
            open_sources.discard(name)
    return targets


# --- flow ------------------------------------------------------------------------------


class _Network:
    """Minimum-cost maximum flow by successive cheapest paths."""

    def __init__(self, nodes: int):
        self.edges: list[list[int]] = []  # to, capacity left, cost
        self.leaving: list[list[int]] = [[] for _ in range(nodes)]

    def add(self, start: int, end: int, capacity: int, cost: int) -> int:
        self.leaving[start].append(len(self.edges))
        self.edges.append([end, capacity, cost])
        self.leaving[end].append(len(self.edges))
        self.edges.append([start, 0, -cost])
        return len(self.edges) - 2

    def _cheapest(self, start: int, end: int) -> list[int] | None:
        cost: dict[int, int] = {start: 0}
        way: dict[int, int] = {}
        queue, queued = deque([start]), {start}
        while queue:
            node = queue.popleft()
            queued.discard(node)
            for edge in self.leaving[node]:
                to, capacity, price = self.edges[edge]
                if capacity and cost[node] + price < cost.get(to, 1 << 62):
                    cost[to], way[to] = cost[node] + price, edge
                    if to not in queued:
                        queue.append(to)
                        queued.add(to)
        if end not in way:
            return None
        path = []
        while end != start:
            path.append(way[end])
            end = self.edges[way[end] ^ 1][0]
        return path

    def run(self, start: int, end: int) -> None:
        while path := self._cheapest(start, end):
            amount = min(self.edges[edge][1] for edge in path)
            for edge in path:
                self.edges[edge][1] -= amount
                self.edges[edge ^ 1][1] += amount


def route(
    patterns: dict[str, int], targets: dict[str | None, int], costs: Sequence[int] = USE_COSTS
) -> dict[tuple[str, str | None], int]:
    """Words from each pattern (a JSON list of sources, with its words) to each source."""
    names = sorted(patterns)
    sources = source_order(list(targets))
    place = {source: 2 + len(names) + k for k, source in enumerate(sources)}
    network = _Network(2 + len(names) + len(sources))
    routed = {}
    for k, name in enumerate(names):
        for cost in costs:
            network.add(0, 2 + k, patterns[name], cost)
        for source in json.loads(name):
            edge = network.add(2 + k, place[source], len(costs) * patterns[name], 0)
            routed[name, source] = edge
    for source in sources:
        network.add(place[source], 1, targets[source], 0)
    network.run(0, 1)
    return {key: network.edges[edge ^ 1][1] for key, edge in routed.items()}


# --- documents -------------------------------------------------------------------------


def pattern_key(sources: str | Column) -> Column:
    """A membership pattern, given as an array of sources, as text that equal sets share."""
    return F.to_json(F.sort_array(F.array_distinct(sources)), {"ignoreNullFields": "false"})


def source_pattern(source: str | None) -> str:
    """The key of the pattern of one source alone."""
    return json.dumps([source], ensure_ascii=False, separators=(",", ":"))


class Mix(NamedTuple):
    #: Words of each source, a document counting for all its sources.
    sizes: dict[str | None, int]
    targets: dict[str | None, Fraction]
    #: Words of each pattern and its flow to each of its sources.
    patterns: dict[str, int]
    flows: dict[tuple[str, str | None], int]


def tie_breakers(text: str) -> list[Column]:
    """Columns that ``mixed`` wants of a stored table: ``tie``, a hash of the text, and ``row``, which
    tells equal rows apart."""
    return [F.xxhash64(text).alias("tie"), F.monotonically_increasing_id().alias("row")]


#: Rows of one chunk have these bits of ``row`` in common.
CHUNK_BITS = 33


def _place(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), "doc_id", "tie")


def _id() -> Column:
    return F.coalesce("doc_id", F.lit(-(2**63)))


def planned(sized: DataFrame, targets=shared_targets) -> tuple[Mix, dict[str, int]]:
    """The flow for ``sized`` (doc_id, size, pattern), and the number of documents per pattern.
    ``targets``: from the sources' sizes to their targets."""
    sums = sized.groupBy("pattern").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    rows = sums.limit(MAX_PATTERNS + 1).collect()
    if len(rows) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} combinations of sources")
    patterns = {row["pattern"]: row["size"] for row in rows}
    sizes: dict[str | None, int] = {}
    for name, size in sorted(patterns.items()):
        for source in json.loads(name):
            sizes[source] = sizes.get(source, 0) + size
    wanted = targets(sizes)
    flows = route(patterns, {source: round(target) for source, target in wanted.items()})
    return Mix(sizes, wanted, patterns, flows), {row["pattern"]: row["n"] for row in rows}


def cuts(sized: DataFrame, mix: Mix, counts: dict[str, int], seed: int = SEED) -> DataFrame:
    """``pattern, rounds, cut``: a document is taken ``rounds`` times, and once more if its position
    (place, id, size, row) in the seeded order is not beyond the cut."""
    spark = sized.sparkSession
    rows = []
    for name, size in sorted(mix.patterns.items()):
        flow = sum(mix.flows.get((name, source), 0) for source in json.loads(name))
        rounds = flow // size if size else 0
        buckets = max(1, -(-counts[name] // BUCKET_ROWS))
        rows.append((name, int(rounds), int(flow - rounds * size), buckets))
    schema = "pattern string, rounds long, rest long, buckets long"
    wanted = spark.createDataFrame(rows, schema)

    # Broadcasts here have a row per pattern, at most MAX_PATTERNS.
    partial = F.broadcast(wanted.where("rest > 0"))
    placed = sized.withColumn("place", _place(seed)).withColumn("id", _id())
    placed = placed.join(partial, "pattern")
    along = (F.col("place").cast("double") / F.lit(2.0**64) + 0.5) * F.col("buckets")
    bucket = F.least(F.greatest(F.floor(along), F.lit(0)), F.col("buckets") - 1)
    placed = placed.withColumn("bucket", bucket)
    sums = placed.groupBy("pattern", "bucket", "rest").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("pattern").orderBy("bucket")
    sums = sums.withColumn("until", F.sum("words").over(before)).withColumn(
        "since", F.col("until") - F.col("words")
    )
    cut_in = sums.where("since < rest and rest <= until").select("pattern", "bucket", "since")
    at = ["place", "id", "size"]
    inside = placed.join(F.broadcast(cut_in), ["pattern", "bucket"])
    # Equal rows in one: a third of a pattern's rows may stand at one place.
    groups = inside.groupBy("pattern", "bucket", "since", "rest", *at).agg(F.count("*").alias("n"))
    within = Window.partitionBy("pattern", "bucket").orderBy(*at).rowsBetween(
        Window.unboundedPreceding, -1
    )
    start = F.col("since") + F.coalesce(F.sum(F.col("size") * F.col("n")).over(within), F.lit(0))
    groups = groups.withColumn("room", F.col("rest") - start)
    # As many as fit by at least half; none in this bucket: the bucket's lower end.
    fitting = F.when(F.col("size") > 0, F.floor(F.col("room") / F.col("size") + 0.5)).otherwise(
        F.when(F.col("room") >= 0, F.col("n")).otherwise(0)
    )
    groups = groups.withColumn("taken", F.least(F.col("n"), F.greatest(fitting, F.lit(0))))
    last = groups.groupBy("pattern").agg(
        F.max(F.when(F.col("taken") > 0, F.struct(*at, "taken", "n"))).alias("last"),
        F.min("place").alias("least"),
    )
    last = last.select(
        "pattern",
        F.coalesce("last.place", F.col("least") - 1).alias("place"),
        F.coalesce("last.id", F.lit(2**63 - 1)).alias("id"),
        F.coalesce("last.size", F.lit(2**63 - 1)).alias("size"),
        F.when(F.col("last.taken") < F.col("last.n"), F.col("last.taken")).alias("taken"),
    )
    last = stored(last, "places")
    # A row per pattern again, and a row per chunk.
    tied = placed.join(F.broadcast(last.where("taken is not null")), ["pattern", *at])
    tied = tied.withColumn("chunk", F.shiftright("row", CHUNK_BITS))
    sums = tied.groupBy("pattern", "taken", "chunk").agg(F.count("*").alias("n"))
    before = Window.partitionBy("pattern").orderBy("chunk")
    sums = sums.withColumn("until", F.sum("n").over(before))
    chunk = sums.where("until >= taken and until - n < taken").select(
        "pattern", "chunk", (F.col("taken") - F.col("until") + F.col("n")).alias("rank")
    )
    numbered = tied.join(F.broadcast(chunk), ["pattern", "chunk"]).withColumn(
        "number", F.row_number().over(Window.partitionBy("pattern", "chunk").orderBy("row"))
    )
    rows = numbered.where("number = rank").select("pattern", F.col("row").alias("cut_row"))
    cut = F.struct(*at, F.coalesce("cut_row", F.lit(2**63 - 1)).alias("row"))
    last = last.join(rows, "pattern", "left").select("pattern", cut.alias("cut"))
    found = wanted.select("pattern", "rounds").join(last, "pattern", "left")
    return found.select("pattern", "rounds", "cut")


def copies(seed: int = SEED) -> Column:
    """How often a document joined with its pattern's cut is taken."""
    own = F.struct(
        _place(seed).alias("place"), _id().alias("id"),
        F.col("size").cast("long").alias("size"), F.col("row").alias("row"),
    )
    return F.col("rounds") + F.when(own <= F.col("cut"), 1).otherwise(0)


def mixed(docs: DataFrame, seed: int = SEED) -> tuple[DataFrame, Mix]:
    """``docs`` (a stored table of doc_id, size, pattern, ``tie_breakers`` and whatever else) with
    ``rounds``, ``cut`` and ``copies``, and the flow behind them. No row of ``docs`` is shuffled for
    it."""
    docs = docs.drop("rounds", "cut", "copies")
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("size").cast("long").alias("size"),
        "pattern", "tie", "row",
    )
    mix, counts = planned(sized)
    # One row per pattern, at most MAX_PATTERNS; a pattern's key is as long as its sources' names.
    found = stored(cuts(sized, mix, counts, seed), "cuts")
    joined = docs.join(F.broadcast(found), "pattern", "left")
    return joined.withColumn("copies", copies(seed)), mix
