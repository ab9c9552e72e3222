"""A training corpus from ``documents``: five stages, each written as Parquet and read by the next.

Good documents stay, then one of each group of near copies, then what is left after strings that
repeat are cut out, then what no benchmark passage occurs in; the rest is packed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headrace.llm.common import modest_batches, small_side, stored, table, text_key
from headrace.llm.decontaminate import decontaminate
from headrace.llm.jaccard_join import groups
from headrace.llm.labelled import fold
from headrace.llm.packing import pack
from headrace.llm.quality import quality
from headrace.llm.queries import PACKING_TOKENIZER, QUALITY_FOLD, QUALITY_FOLDS, tokenizer_path
from headrace.llm.suffix_dedup import deduplicate, row_print

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# SQL has no training, tokenizers or byte strings cut out of texts: tested against brute force instead.
ORACLE_SQL = None


def keep_quality(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it is fitted as in its own query."""
    labels = table(spark, sf_dir, "labels").where(fold(F.col("doc_id"), QUALITY_FOLDS) != QUALITY_FOLD)
    judged = quality(docs.select(COLUMNS), table(spark, sf_dir, "documents"), labels)
    return judged.where("predicted = 1").select(COLUMNS)


def _among(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """Rows of ``docs`` that are, or are not, among the (doc_id, key) given."""
    keys = small_side(stored(keys.withColumnsRenamed({"doc_id": "_id", "key": "_key"}), "keys"), 32)
    found = F.col("doc_id").eqNullSafe(F.col("_id")) & text_key(F.col("text")).eqNullSafe(F.col("_key"))
    return docs.join(keys, found, how).select(COLUMNS)


def drop_near_copies(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar rows the one with the smallest id; those without words all stay.

    A null id is the largest, and of rows with one id the text's fingerprint decides, then the other
    columns. Rows are dropped for their group alone: different texts under one id, or none, all stay.
    """
    modest_batches(spark)
    docs = docs.select(COLUMNS)
    rows = groups(docs).where("group_id is not null").groupBy("group_id", "doc_id", "key").agg(F.count("*").alias("n"))
    rows = stored(rows, "group-rows")
    first = rows.groupBy("group_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("first"))
    stays = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("key") == F.col("first.key"))
    judged = rows.join(first, "group_id").where(~stays | (F.col("n") > 1)).select("doc_id", "key", stays.alias("stays"))
    judged = stored(judged, "copies")
    kept = _among(docs, judged.select("doc_id", "key"), "left_anti")
    repeated = _among(docs, judged.where("stays").select("doc_id", "key"), "left_semi")
    one_each = repeated.groupBy("doc_id", text_key(F.col("text"))).agg(F.min(F.struct(COLUMNS)).alias("row"))
    return kept.unionByName(one_each.select("row.*"))


def cut_repeats(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings that smaller documents hold; documents of which nothing is left go.

    Bytes of characters that a cut went through are left out.
    """
    modest_batches(spark)
    rest = docs.select(row_print().alias("rid"), "lang", "source").dropDuplicates(["rid"])
    cut = deduplicate(docs.select("doc_id", "text"))
    return (
        cut.where("n_removed < n_bytes or n_bytes = 0")
        .select("rid", "doc_id", "text")
        .join(rest, "rid")
        .withColumn("n_chars", F.char_length("text").cast("long"))
        .select(COLUMNS)
    )


def drop_contaminated(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    docs = docs.select(COLUMNS)
    hit = decontaminate(docs, table(spark, sf_dir, "benchmark")).where("contaminated").select("doc_id", "key").distinct()
    return _among(docs, hit, "left_anti")


def pack_sequences(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    modest_batches(spark)
    return pack(docs, tokenizer_path(PACKING_TOKENIZER))


STAGES = [
    ("quality", keep_quality),
    ("near_copies", drop_near_copies),
    ("repeats", cut_repeats),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]


def run(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
