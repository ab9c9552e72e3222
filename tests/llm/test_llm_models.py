import tracemalloc

import numpy as np
import pytest

from headrace.llm import page_text, quality, toxicity
from headrace.llm.html_blocks import blocks
from headrace.llm.labelled import fold, sample
from headrace.llm.queries import QUERIES

DATA = "/root/testdata/sf0.01"
GOOD = ["The quiet river ran past %d old mills and into the sea.", "She wrote %d letters to the captain, and he kept them."]
BAD = ["BUY!! NOW!! %d CHEAP!! PILLS!! BUY!! NOW!!", "a%%%%%% b### c$$$ %d d&&& e*** f%%%%%% g###"]


@pytest.mark.parametrize(("name", "label", "least"), [("op2_quality", "quality", 0.95), ("op5_toxicity", "toxic", 0.85)])
def test_held_out_labels_are_met(spark, name, label, least):
    scores = QUERIES[name](spark, DATA)
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    rows = scores.where("held_out").join(labels, "doc_id").collect()
    assert scores.count() == spark.read.parquet(f"{DATA}/documents.parquet").count()
    assert len(rows) > 50 and np.mean([r["predicted"] == r[label] for r in rows]) > least
    assert all((r["score"] >= 0.3) == r["predicted"] for r in rows)


def test_one_class_or_no_labels_give_a_constant():
    for module in (quality, toxicity):
        assert (module.fit(["a"], np.array([1]))(["b", ""]) >= 0.3).all()
        assert (module.fit(["a"], np.array([0]))(["b", ""]) < 0.3).all()
    assert (quality.fit([], np.zeros(0, int))(["b"]) >= 0.3).all()
    assert (toxicity.fit([], np.zeros(0, int))(["b"]) < 0.3).all()


def test_toxicity_knows_unseen_spellings():
    rng = np.random.default_rng(1)
    plain = "river mill letter captain sea old quiet paper window garden stone bread".split()
    rude = ["idiotic", "idiots", "idiotism", "morons", "moronic"]
    clean = [" ".join(rng.choice(plain, 40)) for _ in range(150)]
    toxic = [" ".join([*rng.choice(plain, 38), *rng.choice(rude, 2)]) for _ in range(150)]
    model = toxicity.fit(clean + toxic, np.array([0] * 150 + [1] * 150))
    unseen = [" ".join([*rng.choice(plain, 38), "idiotes", "moronity"]) for _ in range(50)]
    assert (model(unseen) >= toxicity.CUT).mean() > 0.9
    assert (model([" ".join(rng.choice(plain, 40)) for _ in range(50)]) < toxicity.CUT).mean() > 0.9


def test_fitting_toxicity_takes_little_beyond_the_sample(monkeypatch):
    """The n-grams of 1,500 texts of 200 words: 145 MB at most, 170 MB with four bytes a bucket and lists that are copied."""
    monkeypatch.setattr(toxicity, "EPOCHS", 1)
    rng = np.random.default_rng(5)
    words = np.array([f"{a:x}w{b:x}" for a, b in rng.integers(0, 2**31, (3000, 2))])
    texts = [" ".join(words[rng.integers(0, 3000, 200)]) for _ in range(1500)]
    tracemalloc.start()
    toxicity.fit(texts, np.arange(1500) % 2)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 157e6


def test_samples_keep_to_their_fold_and_bound(spark):
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(100)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)] + [(None, 1), (5, None)], "doc_id long, quality int")
    texts, y = sample(docs, labels.where(fold(labels["doc_id"], 5) != 0), "quality", 10)
    assert len(texts) == 20 and y.sum() == 10
    assert sample(docs, labels.limit(0), "quality", 10)[0] == []


def test_scores_of_nulls_repeats_and_empty_tables(spark):
    docs = spark.createDataFrame(
        [(1, None, "x"), (2, "", "y"), (3, GOOD[0] % 1, "z"), (3, GOOD[0] % 1, "z"), (None, BAD[0] % 2, "w")],
        "doc_id long, text string, extra string",
    )
    labels = spark.createDataFrame([(3, 1), (2, 0)], "doc_id long, quality int")
    out = quality.quality(docs, docs, labels)
    rows = out.collect()
    assert out.columns == ["doc_id", "text", "extra", "score", "predicted"] and len(rows) == 5
    scores = {r["text"]: r["score"] for r in rows}
    assert scores[None] == scores[""] and all(0 <= s <= 1 for s in scores.values())
    assert quality.quality(docs.limit(0), docs, labels).count() == 0


PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body>"
    "<nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>News</a></li></ul></nav><!-- ad %d --><div class=\"ad\">Buy %d.</div>"
    "<article><h1>Title %d</h1><p>First &amp; foremost,\n a  sentence of text.</p><p><b>Bold words, too.<br><p>Last one.</p></article>"
    "<footer>&copy; site</footer></body></html>"
)


def test_blocks_of_broken_markup():
    assert [b.text for b in blocks("<p>a &lt; b<p>c <b>d</b>\n e<br>f<div>g</div>h<im")] == ["a < b", "c d e f", "g", "h"]
    assert blocks("") == [] and blocks("<script>x</scr") == [] and blocks("<!-- x") == []


def test_main_text_leaves_out_what_surrounds_it(spark):
    pages = [(i, f"u{i}", PAGE % (i, i, i)) for i in range(80)] + [(100, "u", None), (101, "u", ""), (102, None, PAGE % (1, 1, 1))]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    texts = {r["page_id"]: r["text"] for r in page_text.extract(df).collect()}
    want = "Title {}\n\nFirst & foremost, a sentence of text.\n\nBold words, too.\n\nLast one."
    assert [texts[i] for i in range(80)] == [want.format(i) for i in range(80)]
    assert texts[100] == texts[101] == "" and texts[102] == want.format(1)
    assert page_text.extract(df.limit(0)).count() == 0


def test_gradients_of_the_labeller():
    model = page_text.Labeller.new(3)
    rng = np.random.default_rng(0)
    x, mask = rng.normal(0, 1, (2, 4, page_text.WIDTH)), np.array([[1, 1, 1, 1], [1, 1, 0, 0]], float)
    target, weight = rng.integers(0, 2, (2, 4)).astype(float), mask

    def loss():
        z = model.logits(x, mask).astype(float)
        return float((weight * (np.logaddexp(0, z) - target * z)).sum() / weight.sum())

    model = page_text.Labeller(*[
        page_text.Direction(*[a.astype(float) for a in d.parameters()]) for d in (model.ahead, model.back)
    ], model.layer.astype(float), model.bias.astype(float))
    grads = model.gradients(x, mask, target, weight)
    for p, g in zip(model.parameters(), grads, strict=True):
        at = tuple(rng.integers(0, n) for n in p.shape)
        kept, step = p[at], 1e-3
        p[at] = kept + step
        up = loss()
        p[at] = kept - step
        down = loss()
        p[at] = kept
        assert abs((up - down) / (2 * step) - g[at]) < 2e-4


@pytest.mark.parametrize(
    ("page", "texts"),
    [
        ("<html><head><title>t</title><meta charset=x><body><p>one<p>two", ["one", "two"]),
        ("<head><style>a{}</style><link href=x><div>one</div></html>", ["one"]),
        ("<head><meta charset=x>one<p>two", ["one", "two"]),
        ("<head><noscript><img src=x>none</noscript></head><p>one", ["one"]),
        ("<p>one</p><svg viewBox='0 0 1 1' /><p>two</p><svg><text>none</text></svg><p>three", ["one", "two", "three"]),
        ("<svg><path d=x/><svg><g></g></svg><text>none</text></svg><p>one", ["one"]),
        ("<div><svg><path d=x></div>one<svg><g><p>two</p>", ["one", "two"]),
        ("<svg><title/><style/><desc>none</desc></svg><p>one</p>", ["one"]),
        ("<div><object data=x/>none</div><p>one</p>", ["one"]),
        ("<div>one<video src=x>none</div><p>two</p><audio src='x'/><p>three</p>", ["one", "two", "three"]),
        ("<canvas><p>none</p></canvas><p>one <math><mi>x</mi><mo>=</mo><mn>2</mn></math> two</p>", ["one x=2 two"]),
        ("<div><template><p>none</div></template>one</div>", ["one"]),
        ("<p>one<!--><p>two<script>if (a</b) '</p>'</script ><p>three<iframe><p>none", ["one", "two", "three"]),
    ],
)
def test_unread_markup_ends_where_it_should(page, texts):
    assert [b.text for b in blocks(page)] == texts
