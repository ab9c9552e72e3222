"""Benchmark decontamination by winnowed fingerprints, in DataFrame operations only.

A document word is hit if it lies inside a window of consecutive benchmark words that occurs in the
document. Windows have ``WINDOW`` words; a shorter item is one window of its own length.

1. *Winnow.* Both sides keep the smallest k-gram hash of each run of ``WINDOW - K + 1`` k-grams. Any
   window both sides hold has the same smallest hash, so each shared window shares a fingerprint.
   Items shorter than a window give the hash of the whole item, and documents then also give all
   grams of the lengths that occur (at most ``WINDOW - 1`` of them).
2. *Join* the fingerprints; only documents with a match go on.
3. *Extend* each matching gram of such a document to the windows around it and compare these word
   for word with the benchmark's.

Only fingerprints and windows are joined, never documents with documents; a document's matches come
together in one row, which its own length bounds. A benchmark passage that most documents hold is a
hot key of small rows only on the probing side of the joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headrace.llm.common import bind, small_side, stored, text_key

WINDOW = 10
K = 5
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BREAKS_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text with A-Z in lower case; a null text has none."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())
    return F.array_remove(F.split(lowered, BREAKS), "")


def folded_words(text: Column) -> Column:
    """Words in full lower case, word by word: equal wherever ``words`` are equal, and cheaper."""
    split = F.split(F.coalesce(text, F.lit("")), BREAKS_ANY_CASE)
    return F.transform(F.array_remove(split, ""), F.lower)


def _starts(n: Column, length: int) -> Column:
    """1-based starts of all runs of ``length`` in ``n`` elements."""
    some = F.sequence(F.lit(1), F.greatest(n - (length - 1), F.lit(1)))
    return F.when(n >= length, some).otherwise(F.array().cast("array<int>"))


def _grams(w: Column, length: int) -> Column:
    return F.transform(_starts(F.size(w), length), lambda i: F.xxhash64(F.slice(w, i, length)))


def _winnowed(w: Column, window: int, k: int) -> Column:
    """Distinct smallest hashes of all windows; empty if there is no whole window."""
    span = window - k + 1
    return bind(
        _grams(w, k),
        lambda g: F.array_distinct(
            F.transform(_starts(F.size(g), span), lambda i: F.array_min(F.slice(g, i, span)))
        ),
    )


def _fingerprints(w: Column, window: int, k: int, short: list[int]) -> Column:
    """Winnowed hashes and, for every length of a short item, the hashes of all such grams."""
    return F.array_distinct(
        F.concat(_winnowed(w, window, k), *[F.array_distinct(_grams(w, m)) for m in short])
    )


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct (item_id, span, size): every window of every item, words joined by one space."""
    w = F.col("w")
    items = benchmark.select("item_id", words(F.col("text")).alias("w")).where(F.size(w) > 0)
    size = F.least(F.size(w), F.lit(window))
    spans = F.transform(
        F.sequence(F.lit(1), F.size(w) - size + 1), lambda i: F.array_join(F.slice(w, i, size), " ")
    )
    return items.select("item_id", size.alias("size"), F.explode(spans).alias("span")).distinct()


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, k: int = K
) -> DataFrame:
    """One row per document: doc_id, key, n_words, n_hit, items (sorted distinct ids as text), contaminated.

    Null and empty texts have no words and are clean. Rows that repeat an id and a text each get the
    same result; rows that share an id but not a text are told apart by ``key``. A null id is an id like any
    other. Items without words match nothing; an item with a null id is hit but not listed. Empty
    tables are fine on either side, and other columns are ignored.
    """
    docs = docs.select("doc_id", "text", text_key(F.col("text")).alias("_key"))
    windows = stored(item_windows(benchmark, window), "item-windows")
    short = sorted(r[0] for r in windows.where(F.col("size") < window).select("size").distinct().collect())

    # the same folding as on the documents' side; the window's own words are its whole content
    span_words = folded_words(F.col("span"))
    prints = stored(
        windows.select("span", "size")
        .distinct()
        .select(
            F.explode(
                F.when(
                    F.col("size") < window,
                    bind(span_words, lambda w: F.array(F.xxhash64(w))),
                ).otherwise(bind(span_words, lambda w: _winnowed(w, window, k)))
            ).alias("print")
        )
        .distinct(),
        "prints",
    )
    found = stored(
        docs.select(
            "doc_id",
            "_key",
            F.explode(
                bind(folded_words(F.col("text")), lambda w: _fingerprints(w, window, k, short))
            ).alias("print"),
        )
        .join(small_side(prints, 8), "print", "left_semi")
        .groupBy("doc_id", "_key")
        .agg(F.collect_set("print").alias("prints")),
        "matches",
    )
    hits = stored(_extended(docs, found, windows, window, k, short), "windows-hit")

    same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["_key"] == b["_key"])
    covered = F.array_distinct(
        F.flatten(
            F.transform("spans", lambda s: F.sequence(s["start"], s["start"] + s["size"] - 1))
        )
    )
    counts = (
        hits.groupBy("doc_id", "_key")
        .agg(F.collect_set(F.struct("start", "size")).alias("spans"))
        .select("doc_id", "_key", F.size(covered).cast("long").alias("n_hit"))
    )
    listed = (
        hits.select("doc_id", "_key", "span")
        .distinct()
        .join(windows.select("span", "item_id"), "span")
        .groupBy("doc_id", "_key")
        .agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    )
    per_doc = stored(
        counts.alias("a").join(listed.alias("b"), same(counts, listed), "left").select("a.*", "b.items"),
        "hit-documents",
    )
    item_bytes = F.aggregate("items", F.lit(0), lambda n, item: n + F.octet_length(item) + 24)
    small = small_side(per_doc, F.lit(128) + F.coalesce(item_bytes, F.lit(0)))
    n_words = F.size(F.array_remove(F.split(F.coalesce("text", F.lit("")), BREAKS_ANY_CASE), ""))
    return docs.join(small, same(docs, small), "left").select(
        docs["doc_id"],
        docs["_key"].alias("key"),
        n_words.cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def _extended(docs, found, windows, window: int, k: int, short: list[int]) -> DataFrame:
    """(doc_id, _key, start, size, span) of benchmark windows that occur, starts counted from 1."""
    side = small_side(found, F.lit(128) + 8 * F.size("prints"))
    matching = (
        docs.join(side, docs["doc_id"].eqNullSafe(side["doc_id"]) & (docs["_key"] == side["_key"]))
        .select(docs["doc_id"], docs["_key"], "text", "prints")
        .dropDuplicates(["doc_id", "_key"])
        .select("doc_id", "_key", "prints", words(F.col("text")).alias("w"), folded_words(F.col("text")).alias("f"))
    )
    w, f, n = F.col("w"), F.col("f"), F.size("w")

    def matched(length: int) -> Column:
        starts = _starts(n, length)
        return F.filter(starts, lambda i: F.array_contains("prints", F.xxhash64(F.slice(f, i, length))))

    around = F.flatten(
        F.transform(matched(k), lambda i: F.sequence(i - (window - k), i))
    )
    whole = F.filter(F.array_distinct(around), lambda i: (i >= 1) & (i <= n - (window - 1)))

    def spans_at(starts: Column, m: int) -> Column:
        return F.transform(
            starts,
            lambda i: F.struct(
                i.alias("start"), F.lit(m).alias("size"), F.array_join(F.slice(w, i, m), " ").alias("span")
            ),
        )

    spans = F.concat(spans_at(whole, window), *[spans_at(matched(m), m) for m in short])
    candidates = matching.select("doc_id", "_key", F.explode(spans).alias("s")).select("doc_id", "_key", "s.*")
    known = stored(windows.select("span", "size").distinct(), "known-windows")
    return candidates.join(small_side(known, F.lit(64) + F.octet_length("span")), ["span", "size"], "left_semi")
