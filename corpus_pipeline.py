"""From raw documents to pieces: judge, deduplicate, redact, mix, encode.

Every stage takes ``(spark, docs, sf_dir)`` with the columns of ``documents`` and returns them, but
for the last one, which returns pieces. A stage works on all that the one before has kept; its
result is written to the shared folder and read again as the next one's input. Columns beyond those
of ``documents`` are dropped at the first stage; null texts, repeated rows and empty tables are
handled as the operators define.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adpulse.llm import mixing, neardup, pieces, pii, quality
from adpulse.llm.store import drop, stored
from adpulse.llm.tables import small_batches, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or that the votes judge bad go."""
    small_batches(spark)
    return quality.kept_rows(docs.select(*COLUMNS))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest id (null last),
    of several texts under it the one with the smallest hash. Every row takes part, whatever its id;
    rows without words are no one's duplicate and stay."""
    small_batches(spark)
    # The operator's ids are the rows' own numbers, which a stored table keeps.
    rows = stored(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("row")), "rows")
    found = neardup.near_duplicates(rows.select(F.col("row").alias("doc_id"), "text"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64("text"), "row")
    named = rows.select("row", order.alias("order")).join(
        found.select(F.col("doc_id").alias("row"), "component_id"), "row"
    )
    kept = named.groupBy("component_id").agg(F.min("order")["row"].alias("row")).select("row")
    # A merge join at every size: what is kept grows with the corpus.
    return rows.join(kept.hint("merge"), "row", "left_semi").select(*COLUMNS)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes a mark; the number of characters follows."""
    docs = docs.select(*COLUMNS)
    rows = pii.found_spans(docs, pii.fit(docs))
    text = pii.redacted(F.col("text"), F.col("pii")["spans"])
    rows = rows.withColumn("text", text).withColumn(
        "n_chars", F.when(F.size(F.col("pii")["spans"]) > 0, F.length("text").cast("long"))
        .otherwise(F.col("n_chars"))
    )
    return rows.select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once or twice."""
    small_batches(spark)
    sized = docs.select(
        *COLUMNS,
        F.coalesce(mixing.count_words("text"), F.lit(0)).alias("size"),
        mixing.pattern_key(F.array("source")).alias("pattern"),
        *mixing.tie_breakers("text"),
    )
    rows, _ = mixing.mixed(stored(sized, "sizes"))
    repeated = F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))
    return rows.select(*COLUMNS, repeated.alias("copy")).select(*COLUMNS)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document, and whether they decode to its text."""
    small_batches(spark)
    rows = pieces.encoded(docs, keep=["doc_id", "source"])
    return rows.select(
        "doc_id",
        "source",
        F.size("pieces.ids").cast("long").alias("n_pieces"),
        F.col("pieces.ids").alias("ids"),
        F.col("pieces.round_trip").alias("round_trip"),
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("redact_pii", redact_pii),
    ("mix_sources", mix_sources),
    ("encode_pieces", encode_pieces),
]

#: EM, boosted trees and a Viterbi fold are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        result = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            result = stored(result, name)
        if number and number + 1 < len(STAGES):
            drop(docs)
        docs = result
    return docs
