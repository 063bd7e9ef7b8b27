"""Document fingerprints by consistent weighted sampling.

A text is its words with their numbers of occurrences as weights. For each of ``SAMPLES`` sample
numbers every word draws, from a hash of word and number alone, r and c from Gamma(2, 1) and b
uniformly. With weight w it stands at t = floor(ln w / r + b), y = exp(r (t - b)), and
a = c / (y exp(r)). The word with the smallest a is the sample, together with its t. Two texts have
the same sample with the probability of their generalised Jaccard likeness: the sum of the smaller
weights over the sum of the larger ones. The share of equal samples estimates it.

A sample is kept as one number: the logarithm of a in the upper bits, an identifier of word and t
in the lower ones, so that the smallest number is the sample and a fingerprint is a set of minima
in one hash aggregation, computed where the text is. The fingerprint prints the identifiers.

Defined results: null or empty text, or text without words, has the empty fingerprint, which is
like itself (1) and unlike all others (0). Equal texts have equal fingerprints, in any row, run or
partition. Columns other than those named are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLES = 32
#: At most this many buckets of neighbouring ids, of about so many documents while that holds.
BUCKETS, BUCKET_ROWS = 100_000, 1024

_WORD = r"[^\x20\x09-\x0D]+"
#: Bits after the point of the logarithm, and what makes it positive.
_SCALE, _SHIFT = float(1 << 22), 128.0


def weighted_terms(text: str) -> Column:
    """``term, weight``: the distinct words, hashed, and how often they occur."""
    hashes = F.sort_array(
        F.transform(F.regexp_extract_all(text, F.lit(_WORD), F.lit(0)), lambda w: F.xxhash64(w))
    )
    return hashes


def _starts(hashes: str) -> Column:
    """Where each run of equal numbers begins in a sorted array."""
    column = F.col(hashes)
    return F.filter(
        F.sequence(F.lit(0), F.size(column) - 1),
        lambda i: (i == 0) | (column[i] != column[F.greatest(i - 1, F.lit(0))]),
    )


def sample(k: int, term: Column, log_weight: Column) -> Column:
    """Sample number ``k`` of one word, as one number."""
    one = F.xxhash64(term, F.lit(k))
    two = F.xxhash64(one, F.lit(k))

    def uniform(bits: Column, width: int) -> Column:
        return (bits.cast("double") + 0.5) / float(1 << width)

    u1 = uniform(F.shiftrightunsigned(one, 33), 31)
    u2 = uniform(one.bitwiseAND(F.lit((1 << 32) - 1)), 32)
    u3 = uniform(F.shiftrightunsigned(two, 43), 21)
    u4 = uniform(F.shiftrightunsigned(two, 21).bitwiseAND(F.lit((1 << 22) - 1)), 22)
    b = uniform(two.bitwiseAND(F.lit((1 << 21) - 1)), 21)
    r = -F.log(u1 * u2)
    t = F.floor(log_weight / r + b)
    log_a = F.log(-F.log(u3 * u4)) - r * (t - b) - r
    order = F.floor((log_a + _SHIFT) * _SCALE)
    name = one.bitwiseXOR(F.shiftleft(t, 7)).bitwiseAND(F.lit((1 << 32) - 1))
    return F.shiftleft(order, 32).bitwiseOR(name)


def fingerprints(texts: DataFrame, keys: list[str], carried: list[str]) -> DataFrame:
    """``keys``, ``carried`` (numbers) and ``samples``, an array of numbers or nulls, for every
    row of ``texts``, whose ``keys`` are unique and which has the column ``text``. Without a
    shuffle if the rows are partitioned by some of the keys."""
    hashed = texts.withColumn("hashes", weighted_terms("text")).drop("text")
    runs = F.when(F.size("hashes") > 0, _starts("hashes"))
    rows = hashed.withColumn("starts", runs)
    ends = F.concat(F.slice("starts", F.lit(2), F.size("starts")), F.array(F.size("hashes")))
    terms = F.zip_with(
        "starts",
        F.when(F.col("starts").isNotNull(), ends),
        lambda low, high: F.struct(
            F.col("hashes")[low].alias("term"), (high - low).alias("weight")
        ),
    )
    rows = rows.select(*keys, *carried, F.explode_outer(terms).alias("of"))
    rows = rows.select(
        *keys,
        *carried,
        F.col("of.term").alias("term"),
        F.log(F.col("of.weight").cast("double")).alias("log_weight"),
    )
    samples = [
        F.min(sample(k, F.col("term"), F.col("log_weight"))).alias(f"s{k}") for k in range(SAMPLES)
    ]
    # A carried number is the same in all rows of a key.
    kept = [F.min(name).alias(name) for name in carried]
    grouped = rows.groupBy(*keys).agg(*kept, *samples)
    names = [f"s{k}" for k in range(SAMPLES)]
    return grouped.withColumn("samples", F.array(*names)).drop(*names)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples."""
    both_empty = a[0].isNull() & b[0].isNull()
    equal = reduce(
        Column.__add__,
        [F.when(a[k] == b[k], 1).otherwise(0) for k in range(SAMPLES)],
    )
    return F.when(both_empty, 1.0).otherwise(equal / float(SAMPLES))


def printed(samples: Column) -> Column:
    """The identifiers of all samples, eight hex digits each; empty for no words."""
    low = (1 << 32) - 1
    return F.concat_ws(
        "", *[F.lpad(F.lower(F.hex(samples[k].bitwiseAND(F.lit(low)))), 8, "0") for k in range(SAMPLES)]
    )


# --- each document beside the next one -------------------------------------------------


def beside_next(docs: DataFrame) -> DataFrame:
    """``bucket, place, doc_id, text, next_text, extra`` of ``docs`` (doc_id, text): the next
    document in descending doc_id, after the last one the first. ``bucket`` and ``place`` order
    the rows; every bucket ends with an extra row for the document that follows it.

    Ids are cut into equal ranges, at most ``BUCKETS`` of them, whose first ids are broadcast;
    dense or evenly spread ids make even buckets. Rows of one id follow by text, null ids come
    last. One shuffle of the texts."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    found = rows.agg(
        F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("n")
    ).first()
    low, high = found["low"] or 0, found["high"] or 0
    buckets = min(BUCKETS, max(1, found["n"] // BUCKET_ROWS))
    width = (high - low) // buckets + 1
    # Counted from the largest id; null ids in a bucket after all others.
    bucket = F.when(
        F.col("doc_id").isNotNull(),
        F.floor((F.lit(high).cast("decimal(20,0)") - F.col("doc_id")) / F.lit(width)).cast("long"),
    ).otherwise(F.lit(buckets + 1))
    rows = rows.withColumn("bucket", bucket)
    heads = rows.groupBy("bucket").agg(F.max("doc_id").alias("head"))
    order = Window.orderBy("bucket")
    around = Window.orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    # One row per bucket.
    following = heads.select(
        "head", F.coalesce(F.lag("bucket").over(order), F.last("bucket").over(around)).alias("into")
    )
    extra = rows.join(F.broadcast(following), F.col("doc_id").eqNullSafe(F.col("head"))).select(
        F.col("into").alias("bucket"), F.lit(1).alias("extra"), "doc_id", "text"
    )
    both = rows.select("bucket", F.lit(0).alias("extra"), "doc_id", "text").union(extra)
    ordered = Window.partitionBy("bucket").orderBy("extra", F.desc_nulls_last("doc_id"), "text")
    return both.withColumn("place", F.row_number().over(ordered)).withColumn(
        "next_text", F.lead("text").over(ordered)
    )
