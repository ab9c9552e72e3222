"""The operators as registered queries over whole tables, and SQL for those SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headrace.llm.common import table
from headrace.llm.decontaminate import decontaminate
from headrace.llm.jaccard_join import groups
from headrace.llm.labelled import fold
from headrace.llm.merkle import verify
from headrace.llm.packing import pack
from headrace.llm.page_text import extract
from headrace.llm.prefix_trie import trie
from headrace.llm.quality import quality
from headrace.llm.sharding import shard
from headrace.llm.substring_dedup import deduplicate_words
from headrace.llm.suffix_dedup import deduplicate
from headrace.llm.token_counts import count_tokens
from headrace.llm.topk import top_k
from headrace.llm.toxicity import toxicity
from headrace.session import scratch

PACKING_TOKENIZER = "word_bpe_49k.json"
QUALITY_FOLDS, QUALITY_FOLD = 5, 0  # this fold of the labels is held out
TOXIC_FOLDS, TOXIC_FOLD = 4, 2
COUNTING_TOKENIZER = "piece_bpe_32k.model"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_decontamination(spark, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def _classified(spark, sf_dir: str, classify, folds: int, held_out: int) -> DataFrame:
    """Fit on the labels outside one fold, score every document; a null doc_id is in no fold (null)."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    known = labels.where(fold(F.col("doc_id"), folds) != held_out)
    narrow = docs.select("doc_id", "text")
    return classify(narrow, narrow, known).select(
        "doc_id", (fold(F.col("doc_id"), folds) == held_out).alias("held_out"), "score", "predicted"
    )


def op2_quality(spark, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir, quality, QUALITY_FOLDS, QUALITY_FOLD)


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir, toxicity, TOXIC_FOLDS, TOXIC_FOLD)


def op3_packing(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_path(PACKING_TOKENIZER))


def op4_token_counts(spark, sf_dir: str) -> DataFrame:
    cache = scratch(spark, "token-cache")
    return count_tokens(table(spark, sf_dir, "documents"), tokenizer_path(COUNTING_TOKENIZER), cache)


def op6_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return deduplicate(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op7_topk(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    found = top_k(rows, rows.where(F.col("vec_id") % 20 == 0), "vec_id", "embedding")
    each = found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "asked")))  # equal rows ask one by one
    return each.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op8_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return groups(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op9_sharding(spark, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"))


def op10_page_text(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op11_substring_dedup(spark, sf_dir: str) -> DataFrame:
    cut = deduplicate_words(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op12_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    return verify(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark, sf_dir: str) -> DataFrame:
    return trie(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_quality": op2_quality,
    "op3_packing": op3_packing,
    "op4_token_counts": op4_token_counts,
    "op5_toxicity": op5_toxicity,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_topk": op7_topk,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_sharding": op9_sharding,
    "op10_page_text": op10_page_text,
    "op11_substring_dedup": op11_substring_dedup,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_prefix_trie": op13_prefix_trie,
}
