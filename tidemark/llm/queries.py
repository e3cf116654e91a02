"""The registered queries of the text operators, on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    collocations,
    decontaminate,
    host_rules,
    html_render,
    licenses,
    neighbours,
    pieces,
    pii,
    prefix_trie,
    sharding,
    simhash,
    suffix_dedup,
    toxicity,
)
from tidemark.llm.common import stored

N_SHARDS = 40
# The key of the queries on the synthetic tables, unless the session has one. No secret.
SAMPLE_KEY = "key of the synthetic tables"
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def _documents(spark: SparkSession, data_dir: str) -> DataFrame:
    return spark.read.parquet(f"{data_dir}/documents.parquet")


def pseudonym_key(spark: SparkSession) -> str:
    return spark.conf.get(pii.KEY_SETTING, None) or SAMPLE_KEY


def op1_toxicity(spark: SparkSession, data_dir: str) -> DataFrame:
    """A toxicity score for every document, from the labels of three quarters of the ids."""
    docs = _documents(spark, data_dir).select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    labels = spark.read.parquet(f"{data_dir}/labels.parquet").select(
        "doc_id", F.col("toxic").alias("label")
    )
    taught = docs.join(labels.filter(F.col("label").isNotNull() & ~held_out), "doc_id")
    weights = toxicity.train(taught)
    scored = docs.select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        toxicity.score(F.col("text"), weights, docs).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op2_sharding(spark: SparkSession, data_dir: str) -> DataFrame:
    """Rendezvous hashing of doc_id over 40 shards of equal weight, and over 41."""
    text = F.coalesce("text", F.lit(""))
    records = _documents(spark, data_dir).select(
        "doc_id",
        (F.octet_length(text).cast("bigint") + 16).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    sharded = sharding.shard_records(records, "doc_id", [1.0] * N_SHARDS, [1.0] * (N_SHARDS + 1))
    # numbered from a stored copy, so texts are read once
    rows = stored(sharded, "op2-shards")
    return sharding.number_slots(rows, ["doc_id", "text_crc32", "size"]).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )


def op3_pii_pseudonyms(spark: SparkSession, data_dir: str) -> DataFrame:
    """Every text with its personal data replaced by keyed pseudonyms."""
    docs = _documents(spark, data_dir).select("doc_id", "text")
    return pii.pseudonymize(docs, key=pseudonym_key(spark))


def op4_sentencepiece(spark: SparkSession, data_dir: str) -> DataFrame:
    """The ids of every text, their number, and whether they decode to the text."""
    model = pieces.read_model(PIECE_MODEL)
    encoded = pieces.encode_documents(_documents(spark, data_dir), model)
    return encoded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_pieces"), "ids", "round_trip"
    )


def op5_suffix_dedup(spark: SparkSession, data_dir: str) -> DataFrame:
    """What is left of every text without byte strings that smaller ids have."""
    cut = suffix_dedup.remove_repeats(_documents(spark, data_dir))
    return cut.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op6_license_scan(spark: SparkSession, data_dir: str) -> DataFrame:
    """Every line, paragraph and text that matches a licence template."""
    return licenses.scan_licenses(_documents(spark, data_dir))


def op7_html_text(spark: SparkSession, data_dir: str) -> DataFrame:
    """The visible text of every page, laid out."""
    pages = spark.read.parquet(f"{data_dir}/pages.parquet").select("page_id", "html")
    return html_render.extract_text(pages).select(
        "page_id", "text", F.length("text").cast("bigint").alias("n_chars")
    )


def op8_simhash_dedup(spark: SparkSession, data_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(_documents(spark, data_dir))


def op9_host_rules(spark: SparkSession, data_dir: str) -> DataFrame:
    """Measures and verdict of every document; the host is its source."""
    measured = host_rules.document_measures(
        _documents(spark, data_dir), "doc_id", "text", "source"
    )
    judged = host_rules.judge_measured(stored(measured, "op9-measures"))
    return judged.select("doc_id", *host_rules.MEASURES, "base_failed", "kept")


def op10_decontaminate(spark: SparkSession, data_dir: str) -> DataFrame:
    """Benchmark items found in documents, with the place and the edits."""
    benchmark = spark.read.parquet(f"{data_dir}/benchmark.parquet")
    return decontaminate.contaminated_items(_documents(spark, data_dir), benchmark)


def op11_prefix_trie(spark: SparkSession, data_dir: str) -> DataFrame:
    """Every distinct prefix of the rebuilt conversations."""
    return prefix_trie.prefix_nodes(spark.read.parquet(f"{data_dir}/conversations.parquet"))


def op12_collocations(spark: SparkSession, data_dir: str) -> DataFrame:
    """The 2,000 best phrases of two to five words of each language."""
    return collocations.collocations(_documents(spark, data_dir))


def op13_adaptive_ann(spark: SparkSession, data_dir: str) -> DataFrame:
    """The 20 nearest rows found for every row whose id is divisible by 20."""
    table = spark.read.parquet(f"{data_dir}/embeddings.parquet")
    return neighbours.nearest(table, F.col("vec_id") % 20 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_sharding": op2_sharding,
    "op3_pii_pseudonyms": op3_pii_pseudonyms,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_license_scan": op6_license_scan,
    "op7_html_text": op7_html_text,
    "op8_simhash_dedup": op8_simhash_dedup,
    "op9_host_rules": op9_host_rules,
    "op10_decontaminate": op10_decontaminate,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_collocations": op12_collocations,
    "op13_adaptive_ann": op13_adaptive_ann,
}
