"""Removal of repeated word windows against plain Python, and its automaton against all substrings."""

import random
from collections import Counter

import pytest

from headrace.llm.substring_dedup import deduplicate_words
from headrace.llm.suffix_automaton import SuffixAutomaton

COLUMNS = "doc_id long, text string, kept string, rid string, key string"


def _plain(rows, window):
    words = [(t or "").encode().split() for _, t in rows]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (doc_id, _), w in zip(rows, words, strict=True):
        gone = {i + j for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for j in range(window)}
        out.append((doc_id, len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return sorted(out, key=repr)


def _texts(seed):
    """Texts of few words with shared passages, at edges and inside, in third of all rows too."""
    draw = random.Random(seed)
    some = lambda n, of=400: " ".join(f"w{draw.randrange(of)}" for _ in range(n))
    passages = [some(n) for n in (34, 35, 36, 60, 120)]
    rows = [(i, some(draw.randrange(60)) + " " + draw.choice([*passages, ""]) + "\t" + some(draw.randrange(90))) for i in range(150)]
    rows += [(200 + i, f"{some(20)} {passages[4]} {some(20)}") for i in range(80)]
    rows += [(300, None), (301, ""), (302, " \n\x0b"), (303, "same " * 80), (304, "a b " * 60), (305, "Ünï códe " * 35)]
    rows += [(306, "x" * 50_000 + " " + passages[3]), (306, "other text"), (None, passages[3]), (None, passages[3])]
    return rows + [(400, some(30_000, 10**9)), (401, passages[2] + " " + passages[2])]


@pytest.mark.parametrize("kinds, shard_words", [(256, 1 << 15), (3, 500)])
def test_windows_match_plain_python(spark, kinds, shard_words):
    rows = _texts(kinds)
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], COLUMNS).repartition(5)
    got = deduplicate_words(df, kinds=kinds, shard_words=shard_words)
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got.collect()), key=repr) == _plain(rows, 35)


def test_spans_and_other_windows(spark):
    rows = [(1, "p a b c d q"), (2, "a b c d"), (3, "r s a b c"), (4, "z z z z")]
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], COLUMNS)
    got = {r["doc_id"]: r for r in deduplicate_words(df, window=3, gram=2, kinds=1).collect()}
    assert [(r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in sorted(got.values())] == _plain(rows, 3)
    assert [tuple(s) for s in got[1]["spans"]] == [(1, 5)] and [tuple(s) for s in got[3]["spans"]] == [(2, 5)]
    assert deduplicate_words(df.limit(0)).count() == 0


def test_automaton_counts_every_substring():
    draw = random.Random(1)
    for _ in range(40):
        texts = [("".join(draw.choice("ab") for _ in range(draw.randrange(12))), draw.randrange(1, 3)) for _ in range(5)]
        automaton = SuffixAutomaton()
        for text, n in texts:
            automaton.add(text, n)
        automaton.count(3)
        times = Counter()
        for text, n in texts:
            for a in range(len(text)):
                for b in range(a + 1, len(text) + 1):
                    times[text[a:b]] += n
        probe = "".join(draw.choice("abc") for _ in range(30))
        wanted = [max((k for k in range(i + 2) if k == 0 or times[probe[i + 1 - k : i + 1]] >= 3), default=0) for i in range(30)]
        assert automaton.matching(probe) == wanted
