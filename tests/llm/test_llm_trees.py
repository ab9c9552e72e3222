"""The Merkle manifest and the prefix trie against plain Python, and both against their SQL."""

import hashlib
import random
import zlib
from collections import defaultdict
from pathlib import Path

import duckdb
import pytest

from headrace.llm.merkle import verify
from headrace.llm.oracle import ORACLE
from headrace.llm.places import placed
from headrace.llm.prefix_trie import trie
from headrace.llm.queries import QUERIES

SMALL = Path("/root/testdata/sf0.001")
DOCS = "doc_id long, source string, lang string, n_chars long, text string, place string, leaf string"
TURNS = "conv_id long, turn long, role string, text string, depth string, n string"


def _h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _crc(number):
    return zlib.crc32(str(number).encode())


def _part(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def _lower(text):
    return text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def _tree(digests):
    """The last digest, and each first node's runs and slots, lowest level first."""
    ways = [[] for _ in digests]
    at = list(range(len(digests)))
    while len(digests) > 1:
        runs = [digests[i : i + 16] for i in range(0, len(digests), 16)]
        for way, i in zip(ways, at, strict=True):
            way.append((runs[i // 16], i % 16))
        at = [i // 16 for i in at]
        digests = [_h("".join(run)) for run in runs]
    return digests[0], ways


def _manifest(rows):
    by_source = defaultdict(list)
    for doc_id, source, lang, n_chars, text in rows:
        leaf = _h("".join(map(_part, (doc_id, source, lang, n_chars, text))))
        tampered = doc_id is not None and _crc(doc_id) % 5 == 0
        changed = _h("".join(map(_part, (doc_id, source, lang, n_chars, _lower(text))))) if tampered else leaf
        by_source[source].append((doc_id is not None, doc_id or 0, leaf, doc_id, changed))
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = [(sorted(by_source[s]), *_tree([x[2] for x in sorted(by_source[s])])) for s in sources]
    root, tops = _tree([t[1] for t in trees])
    out = []
    for (leaves, subroot, ways), top in zip(trees, tops, strict=True):
        for (_, _, leaf, doc_id, changed), way in zip(leaves, ways, strict=True):
            proof, folded = "", changed
            for run, slot in [*way, *top]:
                proof += "".join(run[:slot] + run[slot + 1 :])
                folded = _h("".join([*run[:slot], folded, *run[slot + 1 :]]))
            out.append((doc_id, leaf, subroot, root, _h(proof), folded, folded == root))
    return sorted(out, key=repr)


def _got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _documents():
    draw = random.Random(3)
    rows = [(i, draw.choice(["hot", "hot", "a"]), "en", i % 9, f"Text {i % 40}" if i % 5 else "lower") for i in range(700)]
    rows += [(700, None, None, None, None), (701, "", "x", 0, ""), (702, "ünï", "x", 3, "LONG " * 50_000)]
    rows += [(None, "a", "en", 1, "No Id"), (None, "a", "en", 1, "no id"), (3, "a", "en", 3, "Same id")]
    rows += [(800 + i, f"s{i}", None, 1, "One") for i in range(40)]  # sources of one row, more than one run of them
    return rows + [(900, "hot", "en", 1, "REPEATED")] * 40


@pytest.mark.parametrize("some", [slice(None), slice(1), slice(2), slice(16), slice(17)])
def test_manifest_matches_plain_python(spark, some):
    rows = _documents()[some]
    df = spark.createDataFrame([(*r, "clash", None) for r in rows], DOCS).repartition(5)
    assert _got(verify(df)) == _manifest(rows)


def test_manifest_of_one_row_and_of_none(spark):
    lone = spark.createDataFrame([(5, None, None, None, None, "", "")], DOCS)
    got = verify(lone).first()
    assert got["leaf"] == got["subroot"] == got["root"] and got["proof_sha256"] == _h("")
    assert verify(lone.limit(0)).count() == 0
    before = spark.conf.get("spark.sql.cteRecursionRowLimit")
    verify(lone).count()
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == before


def test_places_of_one_group_over_many_ranges(spark):
    df = spark.range(5000).selectExpr("IF(id % 3 = 0, NULL, 'k') AS k", "id % 100 AS v").repartition(7)
    got = defaultdict(list)
    for r in placed(df, ["k"], [df["v"]], "places").collect():
        got[r["k"]].append((r["place"], r["v"]))
    for key, n in ((None, 1667), ("k", 3333)):
        by_place = sorted(got[key])
        assert [p for p, _ in by_place] == list(range(n))
        assert [v for _, v in by_place] == sorted(v for _, v in by_place)


def _rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    return {c: own.get(c - c % 20, [])[: _crc(c) % 4] + ts[_crc(c) % 4 :] for c, ts in own.items()}


def _trie(rows):
    members = defaultdict(list)
    seqs = {c: tuple(ts) for c, ts in _rebuilt(rows).items()}
    for c in sorted(seqs):
        for d in range(len(seqs[c]) + 1):
            members[seqs[c][:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    sums = {}
    for node in sorted(members, key=len, reverse=True):
        below = [sums[k] for k in children[node]]
        words = len(node[-1][1].encode().split()) if node else 0
        sums[node] = (sum(b[0] for b in below) or 1, sum(b[1] for b in below) + (len(members[node]) - 1) * words)
    return sorted(
        (
            (
                convs[0],
                len(node),
                members[node[:-1]][0] if node else None,
                len(convs),
                len(children[node]),
                *sums[node],
                _h(",".join(str(c) for c in convs if seqs[c] == node)),
            )
            for node, convs in members.items()
        ),
        key=repr,
    )


def _conversations():
    draw, rows = random.Random(5), []
    for conv in range(400):
        if conv % 40 != 20:  # some bases are absent
            same = conv % 3 == 0  # a third of them say the same for long
            for turn in range(draw.choice([1, 2, 3, 5, 8, 18 if same else 17])):
                rows.append((conv, turn, "user" if turn % 2 else None, f"same {turn} words" if same else draw.choice(["a b", "a  b c", "", None])))
    rows += [(1001, None, "x", "null\tturn first"), (1001, 0, "x", "null\x0bturn second"), (None, 1, "x", "nobody")]
    rows += [(-7, 0, "x", "negative"), (2000, 0, "", "a"), (2000, 1, "a", ""), (2020, 0, "x", "same turn"), (2020, 0, "x", "same turn")]
    rows += [(2021, t, "u", "very long " * 20_000) for t in range(3)]
    return rows


@pytest.mark.parametrize("block, held", [(16, 100_000), (5, 60)])
def test_trie_matches_plain_python(spark, block, held):
    rows = _conversations()
    df = spark.createDataFrame([(*r, "clash", None) for r in rows], TURNS).repartition(5)
    assert _got(trie(df, block, held)) == _trie(rows)


def test_trie_of_few_or_no_turns(spark):
    turnless = next(c for c in range(1, 20) if _crc(c) % 4)
    rows = [(turnless, 0, "x", "gives way to a base that is absent")]
    df = spark.createDataFrame([(*r, "", "") for r in rows], TURNS)
    assert _got(trie(df)) == _trie(rows) == [(turnless, 0, None, 1, 0, 1, 0, _h(str(turnless)))]
    assert trie(df.limit(0)).count() == 0
    assert trie(spark.createDataFrame([(None, 0, "x", "y", "", "")], TURNS)).count() == 0


@pytest.mark.skipif(not SMALL.exists(), reason="test tables are not here")
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_match_their_sql(spark, name):
    database = duckdb.connect()
    for file in SMALL.glob("*.parquet"):
        database.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    expected = database.execute(ORACLE[name])
    names = sorted(c[0] for c in expected.description)
    wanted = [dict(zip([c[0] for c in expected.description], row, strict=True)) for row in expected.fetchall()]
    df = QUERIES[name](spark, str(SMALL))
    assert sorted(df.columns) == names and wanted
    assert _got(df.select(names)) == sorted((tuple(row[c] for c in names) for row in wanted), key=repr)
