"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tastebud.llm import audit, chat, decontam, jaccard, langid, mixing, packing, periods, shards, tokens, toxicity, urls, vectors

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


OLD_SHARDS, SHARDS = 16, 24


@query
def op1_min_cost_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents from 16 shards by source into 24 of equal bytes, fewest bytes moved."""
    placed = shards.reshard(shards.document_rows(table(spark, sf_dir, "documents"), OLD_SHARDS), SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "old_shard"
    )


@query
def op3_low_discrepancy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.mix(table(spark, sf_dir, "documents"))["documents"].select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")


URL_RULES = [
    urls.Rule("allow", "org", "/"),
    urls.Rule("block", "example.org", "/es/"),
    urls.Rule("block", "example.org", "/en/1"),
    urls.Rule("allow", "com", "/fr/"),
    urls.Rule("block", "com", "/de/"),
]
#: Sites whose pages make up the list: fixed values.
LISTED_SITES = r"(^|\.)(spam-farm|cheap-pills|ththan|therha)\."


def listed_urls(pages: DataFrame) -> DataFrame:
    """The list: canonical URLs of the pages of listed sites."""
    host, _ = urls.host_and_path(F.col("url"))
    return pages.filter(host.rlike(LISTED_SITES)).select(urls.canonical_url(F.col("url")).alias("canonical"))


@query
def op4_url_bloom_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL: rules first, then the list behind the Bloom filter."""
    pages = table(spark, sf_dir, "pages")
    return urls.judge_urls(pages, listed_urls(pages), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


PROBE = "\\### Assistant: </turn> ok"


@query
def op7_reply_tree_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations formatted, then read back from the formatted text."""
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").unionByName(extra)
    read = chat.digests(chat.format_branches(chat.conversation_trees(rows)))
    return read.select(F.col("tree").alias("conv_id"), "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


@query
def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 4-word shingle sets are 85% alike."""
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"), width=4, num=85)


@query
def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that ten-word windows of benchmark items cover."""
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def id_hash(mod: int) -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(mod))


@query
def op5_string_kernel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents")
    machine = toxicity.train(docs, table(spark, sf_dir, "labels"), id_hash(4) != 2)
    held_out = F.coalesce(id_hash(4) == 2, F.lit(False))
    return toxicity.score_documents(docs, machine).select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query
def op8_kneser_ney_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the languages that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.filter(id_hash(5) != 0))
    held_out = F.coalesce(id_hash(5) == 0, F.lit(False))
    return langid.identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


@query
def op10_pq_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors of cosine 0.95 or more."""
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"), 0.95)


@query
def op6_section_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of the first line, the last line and the body of every document."""
    docs = table(spark, sf_dir, "documents")
    found = tokens.count_tokens(docs, tokens.line_sections(F.col("text")), "majority")
    return found.withColumn("n_tokens", F.col("n_tokens").cast("long"))


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op11_deficit_round_robin_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2,048 tokens, every sequence mixed as the whole table is."""
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "source_queue")


def planted_repeats(docs: DataFrame) -> DataFrame:
    """The documents, a tenth of them (by crc32 of the id) from some word on repeating a stretch of their own words."""
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    h = F.crc32(F.col("doc_id").cast("string"))
    n, g = F.size("w"), F.floor(h / 10)
    a = F.pmod(g, n).cast("int")
    p = (F.floor((n - a) / (g % 8 + 3)) + 1).cast("int")
    rest = F.flatten(F.array_repeat(F.slice("w", a + 1, p), F.ceil((n - a) / p).cast("int")))
    repeated = F.concat_ws(" ", F.slice(F.concat(F.slice("w", F.lit(1), a), rest), F.lit(1), n))
    # only a chosen document's words are looked at
    listed = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("w"))
    return listed.select("doc_id", F.when(n > 0, repeated).otherwise(F.col("text")).alias("text"))


@query
def op12_recompressed_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of all documents after planting, the strongest one, and digests of all runs and of the collapsed text."""
    found = periods.find_runs(planted_repeats(table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    ended = F.concat_ws("", F.transform(lines, lambda x: F.concat(x, F.lit("\n"))))

    def better(best: Column, r: Column) -> Column:
        # by exact length / period; runs come by start and period, so the first of equals stays
        return F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best)

    kind = "struct<start:bigint,length:bigint,period:bigint>"
    best = F.aggregate("runs", F.lit(None).cast(kind), better)
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(ended, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period", F.floor(F.col("best.length") * 1000 / F.col("best.period")).alias("exponent_milli"), "runs_sha256", "collapsed_sha256"
    )


@query
def op13_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters on every document, in all 120 orders, per source."""
    return audit.audit_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
