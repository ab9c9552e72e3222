"""Token counts behind a digest cache.

The cache is a Parquet table of (digest, tokenizer, n_tokens): the SHA-256 of a normalised text, the
SHA-256 of the tokenizer's file, and the count. Texts whose pair is stored are only looked up. Of
each missing text one row is encoded, however many copies there are, and appended. Normalising
turns null into the empty text and nothing else, so equal digests mean equal counts.

Copies meet as digests, merged on the map side first. Missing digests are stored by themselves: are they few,
texts are filtered by them where they are read, and if not, each task sends one row of a text it holds, so a hot
text does not gather in one task. Either way a text is shuffled at most once. The last join is by digest
alone over narrow rows; nothing stands between it and its exchanges, so skewed ones are split.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headrace.llm.common import small_side, stored
from headrace.llm.word_ids import WordIds

LIMIT = 4096
TEXTS_AT_ONCE = 256
CACHE = "digest string, tokenizer string, n_tokens bigint"
SPACE = "▁"


def file_digest(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


class PieceCounter:
    """Counts of a sentencepiece model, exact for every text.

    Spaces are marked in front of words. If no piece has such a mark after another character, nothing
    merges across a single space, and a text's count is its words' sum. Texts with other spacing than
    single spaces between words, or with the mark itself, are encoded whole.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self._model = SentencePieceProcessor(model_file=path)
        pieces = (self._model.id_to_piece(i) for i in range(self._model.get_piece_size()))
        self._apart = not any(SPACE in p.lstrip(SPACE) for p in pieces)
        self._words = WordIds(lambda words: self._model.encode(words, num_threads=1))

    def _parted(self, text: str) -> list[str] | None:
        words = text.split(" ")
        return words if self._apart and SPACE not in text and all(words) else None

    def counts(self, texts: list[str]) -> list[int]:
        parted = [self._parted(t) for t in texts]
        self._words.learn([w for w in parted if w])
        whole = [t for t, w in zip(texts, parted, strict=True) if w is None]
        rest = iter(map(len, self._model.encode(whole, num_threads=1)) if whole else [])
        return [next(rest) if w is None else self._words.count(w) for w in parted]


def count_tokens(docs: DataFrame, model_path: str, cache_path: str, limit: int = LIMIT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit.

    Null and empty texts have no bytes and no tokens. Repeated rows are each returned. A null id is
    an id like any other. An empty table gives no rows; other columns are ignored. ``cache_path`` is
    created where it is missing; one writer at a time is assumed.
    """
    spark = docs.sparkSession
    version = file_digest(model_path)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.select("doc_id", text.alias("text")).withColumn("digest", F.sha2("text", 256))

    spark.createDataFrame([], CACHE).write.mode("append").parquet(cache_path)
    cache = spark.read.schema(CACHE).parquet(cache_path).where(F.col("tokenizer") == version)
    missing = stored(
        keyed.select("digest").distinct().join(cache.select("digest"), "digest", "left_anti"), "missing-digests"
    )

    def encoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = PieceCounter(model_path)
        for batch in batches:
            for at in range(0, len(batch), TEXTS_AT_ONCE):
                part = batch.iloc[at : at + TEXTS_AT_ONCE]
                yield pd.DataFrame({"digest": part["digest"], "n_tokens": counter.counts(list(part["text"]))})

    # equal digests are equal texts; min() is deterministic, so a filter by few digests goes below the grouping
    chosen = keyed.groupBy("digest").agg(F.min("text").alias("text")).join(small_side(missing, 128), "digest", "left_semi")
    counted = chosen.mapInPandas(encoded, "digest string, n_tokens bigint")
    counted.select("digest", F.lit(version).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache_path)

    known = spark.read.schema(CACHE).parquet(cache_path).where(F.col("tokenizer") == version)
    return (
        keyed.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "digest")
        .join(known.select("digest", "n_tokens"), "digest")
        .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
    )
