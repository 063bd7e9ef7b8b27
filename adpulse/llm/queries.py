"""Each operator applied to its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adpulse.llm import (
    align,
    bpe,
    crossentropy,
    fingerprint,
    language,
    mixing,
    neardup,
    pieces,
    pii,
    quality,
    trie,
    urlfilter,
    warc,
)
from adpulse.llm.store import CLEANUP, setting, stored
from adpulse.llm.tables import small_batches, table
from adpulse.scratch import scratch_dir


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), size=2)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    rows, name = quality.judged(table(spark, sf_dir, "documents"))
    returned = (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "votes", "posterior",
    )
    return rows.select("doc_id", *[F.col(name)[column].alias(column) for column in returned])


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    rows, _ = language.identified(docs, ~held_out)
    return rows.select(
        "doc_id",
        held_out.alias("held_out"),
        F.col("language.lang").alias("lang_pred"),
        F.col("language.score").alias("score"),
    )


def op2_cross_entropy_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    good = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    targets = good.where("quality = 1").select("doc_id")
    return crossentropy.differences(table(spark, sf_dir, "documents"), targets)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    path = scratch_dir(spark, "warc")
    with setting(spark, CLEANUP, "true"):
        warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path)


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.coalesce(mixing.count_words("text"), F.lit(0)).alias("size"),
        mixing.pattern_key(F.array("source")).alias("pattern"),
        *mixing.tie_breakers("text"),
    )
    docs = stored(docs, "sizes")
    rows, mix = mixing.mixed(docs)
    sources = [
        (mixing.source_pattern(source), mix.sizes[source], float(target))
        for source, target in mix.targets.items()
    ]
    named = spark.createDataFrame(sources, "pattern string, source_size long, target double")
    return rows.join(F.broadcast(named), "pattern").select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
        "copies",
    )


def _number(text: Column) -> Column:
    """A number below 2^32 that depends on the text alone."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def _day(number: Column) -> Column:
    return F.date_add(F.lit("2024-01-01").cast("date"), number.cast("int"))


def page_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages with a day of fetching each, drawn from the page's id."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return pages.withColumn("day", _day(_number(F.col("page_id").cast("string")) % 366))


def host_list(captures: DataFrame) -> DataFrame:
    """A filter list over the hosts of the captures and the domains above them: a third of the
    domains has entries, added once or twice and removed in between."""
    hosts = captures.select(urlfilter.host_of("url").alias("host")).where("host is not null")
    domains = hosts.distinct().select(
        F.explode(urlfilter.domains_above("host")).alias("domain")
    ).distinct()
    drawn = domains.withColumn("n", _number(F.col("domain"))).where("n % 3 = 0")
    n = F.col("n")
    category = F.element_at(
        F.array(*map(F.lit, ("adult", "malware", "spam"))), (F.floor(n / 3) % 3 + 1).cast("int")
    )
    entries = F.array(
        F.struct((F.floor(n / 9) % 200).alias("at"), F.lit(urlfilter.ADDED).alias("action")),
        F.struct((200 + F.floor(n / 9) % 70).alias("at"), F.lit(urlfilter.REMOVED).alias("action")),
        F.struct((270 + F.floor(n / 9) % 90).alias("at"), F.lit(urlfilter.ADDED).alias("action")),
    )
    rows = drawn.select("domain", category.alias("category"), F.inline(entries))
    return rows.select("domain", "category", _day(F.col("at")).alias("day"), "action")


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = page_captures(spark, sf_dir)
    return urlfilter.filtered(captures, host_list(captures)).select(
        "page_id",
        "host",
        F.col("day").cast("string").alias("fetched_on"),
        "blocked",
        "matched",
        "categories",
        F.col("listed_on").cast("string").alias("listed_on"),
    )


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = pii.found_spans(docs, pii.fit(docs))
    base, spans = F.col("pii")["base"], F.col("pii")["spans"]
    return rows.select(
        "doc_id",
        *[pii.count_of(base, kind).alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(pii.listed(base), 256).alias("base_sha256"),
        pii.listed(spans).alias("spans"),
    )


def op1_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fingerprint.beside_next(table(spark, sf_dir, "documents"))
    size = F.length("text")
    cut = F.floor(size / 3).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), size - cut),
        F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), cut),
    )
    rows = rows.withColumn("edited", edited)
    digest = F.sha2("edited", 256)
    # Numbers pass through a hash aggregation, text does not.
    quarters = [
        F.conv(F.substring(digest, 16 * k + 1, 16), 16, -10).cast("long").alias(f"q{k}")
        for k in range(4)
    ]
    own = F.struct(F.lit(0).alias("which"), F.col("text").alias("text"))
    other = F.struct(F.lit(1).alias("which"), F.col("edited").alias("text"))
    both, own = F.array(own, other), F.array(own)
    versions = F.when(F.col("extra") == 0, both).otherwise(own)
    carried = ["extra", "doc_id", "n_chars", *[f"q{k}" for k in range(4)]]
    rows = rows.select(
        "bucket", "place", "extra", "doc_id", size.cast("long").alias("n_chars"), *quarters,
        F.inline(versions),
    )
    prints = fingerprint.fingerprints(rows, ["bucket", "place", "which"], carried)
    return _pair_up(prints, carried)


def _pair_up(prints: DataFrame, carried: list[str]) -> DataFrame:
    ordered = Window.partitionBy("bucket").orderBy("place", "which")
    # In order: a document, its edited text, the next document.
    rows = prints.withColumn("edited", F.lead("samples", 1).over(ordered)).withColumn(
        "following", F.lead("samples", 2).over(ordered)
    )
    rows = rows.where("extra = 0 and which = 0")
    digest = F.concat(*[F.lpad(F.lower(F.hex(f"q{k}")), 16, "0") for k in range(4)])
    own, edited, following = (F.col(name) for name in ("samples", "edited", "following"))
    return rows.select(
        "doc_id",
        "n_chars",
        digest.alias("edited_sha256"),
        fingerprint.printed(own).alias("fingerprint"),
        fingerprint.printed(edited).alias("edited_fingerprint"),
        fingerprint.likeness(own, edited).alias("near_edited"),
        fingerprint.likeness(own, following).alias("near_next"),
    )


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    rows = pieces.encoded(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return rows.select(
        "doc_id",
        F.size("pieces.ids").cast("long").alias("n_pieces"),
        F.col("pieces.ids").alias("ids"),
        F.col("pieces.round_trip").alias("round_trip"),
    )


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    rows = align.measured(docs, ["doc_id"], {"groups_sha256": digest})
    return rows.withColumn("groups_sha256", F.coalesce("groups_sha256", F.lit("")))


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = bpe.encoded(docs, keep=["doc_id"], decoded_as="decoded")
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return trie.conversation_trie(table(spark, sf_dir, "conversations"))
