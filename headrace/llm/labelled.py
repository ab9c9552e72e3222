"""Bounded, reproducible samples of labelled documents, and scoring of whole tables by a fitted model."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TEXTS_AT_ONCE = 256


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's text, modulo ``folds``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> tuple[list[str], np.ndarray]:
    """Texts and labels of at most ``per_class`` labelled documents of each class.

    The ids are those with the smallest hashes, so the same rows give the same sample. Labels other
    than 0 and 1 and null ids are passed over; a document labelled both ways counts once, as the
    larger label.
    """
    known = (
        labels.select("doc_id", F.col(label).cast("int").alias("y"))
        .where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.max("y").alias("y"))
    )
    picked = [
        known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for y in (0, 1)
    ]
    chosen = picked[0].unionByName(picked[1])  # at most 2 * per_class ids
    rows = (
        docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
        .join(F.broadcast(chosen), "doc_id")
        .dropDuplicates(["doc_id"])
        .toPandas()
        .sort_values("doc_id")
    )
    return list(rows["text"]), rows["y"].to_numpy(np.int64)


def scored(docs: DataFrame, scorer: Callable[[], Callable[[list[str]], np.ndarray]]) -> DataFrame:
    """``docs`` with a column ``score``: ``scorer()`` is called once per task and gives scores of texts.

    All other columns stay as they are; a null text is scored as the empty one.
    """

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = scorer()
        for batch in texts:
            values = [t or "" for t in batch]
            parts = [model(values[i : i + TEXTS_AT_ONCE]) for i in range(0, len(values), TEXTS_AT_ONCE)]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0), dtype="float64")

    return docs.withColumn("score", score(F.coalesce(F.col("text").cast("string"), F.lit(""))))
