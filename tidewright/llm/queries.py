"""Registered queries of the operators: thin digests over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.llm import ann, bpe, conversations, lang_id, line_dedup, mixing, packing, pii, secrets, sharding, simhash, syncmers, vector_codes
from tidewright.llm.common import stored, table

Query = Callable[[SparkSession, str], DataFrame]


def line_dedup_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents"), min_words=50).select("doc_id", "lines_removed", "text")


def nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    index = ann.build(vectors, "vec_id", "embedding", keep=6)
    if index is None:
        return spark.sql("select 0L query_id, 0 rank, 0L vec_id, 0d score where false")
    return ann.search(index, vectors.where("vec_id % 50 = 0"), "vec_id", "embedding", k=5)


def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), weights=(1.0, 2.0, 3.0), cap=3.0)
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), capacity=2048)


def syncmer_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = syncmers.edited(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), syncmers.shown(F.col("sketch")).alias("fingerprint"),
        syncmers.shown(F.col("edited_sketch")).alias("edited_fingerprint"), syncmers.likeness("sketch", "edited_sketch").alias("near_edited"),
        syncmers.likeness("sketch", "next_sketch").alias("near_next"))


def extendible_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = sharding.shard(table(spark, sf_dir, "documents"), limit=sharding.LIMIT)
    return sharded.select("doc_id", "bytes", "shard", "page", F.length("shard").cast("long").alias("depth"))


def pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.with_surrogates(table(spark, sf_dir, "documents"), key="surrogate key of the query").select("doc_id", "n_entities", "text")


def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"), repo_col="doc_id", owner_col="source")
    kinds = F.array(*[F.lit(k) for k in secrets.KINDS])
    base = F.filter("secrets", lambda s: s.kind < secrets.BASE)
    said = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", F.get(kinds, s.kind), s.start, s.end)), ",")
    count = lambda k: F.size(F.filter("secrets", lambda s: s.kind == k)).cast("long")
    live = F.size(F.filter("secrets", lambda s: s.live)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{secrets.KINDS[k]}") for k in range(secrets.BASE)], F.sha2(said(base), 256).alias("base_sha256"),
        said(F.col("secrets")).alias("spans"), live.alias("n_live"), (F.size("secrets") - live).alias("n_example"))


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = lang_id.identify(docs, lang_id.train(docs), declared_col="lang", host_col="source")
    return found.select("doc_id", "language", F.round("posterior", 6).alias("posterior"), "text_language", "accepted")


def page_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same of raw pages: declared by the markup, host and suffix from the address."""
    tag = F.regexp_extract("html", r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z-]+)", 1)
    shown = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    pages = table(spark, sf_dir, "pages").select("page_id", "url", tag.alias("declared"), shown.alias("text"))
    model = lang_id.train(table(spark, sf_dir, "documents"))
    found = lang_id.identify(pages, model, "page_id", declared_col="declared", host_col=None, url_col="url")
    return found.select("page_id", "language", F.round("posterior", 6).alias("posterior"), "text_language", "accepted")


def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return near.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged conversations, repaired: counts of faults, cost, audit and a hash of what is left."""
    talks = table(spark, sf_dir, "conversations")
    got = conversations.repair(conversations.damage(talks))
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    empty = [F.lit(0).cast("long").alias(c) for c in numbers]
    told = talks.select(F.col("conv_id").alias("conv"), *empty, F.lit("").alias("audit"), F.lit("").alias("sha256")).unionByName(
        got.summary.withColumn("sha256", F.lit(""))).unionByName(conversations.repaired_hashes(got.rows).select(
            "conv", *empty, F.lit("").alias("audit"), "sha256"))
    full = told.groupBy(F.col("conv").alias("conv_id")).agg(*[F.max(c).alias(c) for c in [*numbers, "audit", "sha256"]])
    return full.select("*", F.when(F.col("sha256") == "", F.sha2(F.lit(""), 256)).otherwise(F.col("sha256")).alias("repaired_sha256")).drop("sha256")


def vector_code_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all vectors by 16 codebooks of 64 entries, their errors, and a hash of the codebooks."""
    coded = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    if coded is None:
        return spark.sql("select 0L vec_id, '' code, 0L error, 0L label_error, '' codebooks_sha256 where false")
    error = F.aggregate("part_error", F.lit(0).cast("long"), lambda a, b: a + b)
    rows = stored(coded.codes.select("vec_id", "label", F.lower(F.hex("codes")).alias("code"), error.alias("error")), "errors")
    told = vector_codes.label_errors(rows).withColumn("codebooks_sha256", F.lit(vector_codes.books_sha256(coded.books)))
    return told.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text and what they decode to, as hashes."""
    docs = table(spark, sf_dir, "documents")
    both = bpe.decode(bpe.encode(docs, bpe.build_lexicon(docs)))
    count = F.floor(F.length("ids") / 4).cast("long")
    return both.select("doc_id", count.alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))


QUERIES: dict[str, Query] = {
    "op1_line_dedup": line_dedup_,
    "op2_multi_index": nearest_neighbours,
    "op3_source_mix": source_mix,
    "op4_best_fit_packing": best_fit_packing,
    "op5_syncmer_fingerprints": syncmer_fingerprints,
    "op6_extendible_shards": extendible_shards,
    "op7_pii_surrogates": pii_surrogates,
    "op8_secret_scan": secret_scan,
    "op9_language_id": language_id,
    "page_language": page_language,
    "op10_simhash_near_dedup": simhash_near_dedup,
    "op11_conversation_repair": conversation_repair,
    "op12_vector_codes": vector_code_compression,
    "op13_bpe_round_trip": bpe_round_trip,
}
