"""Models, pages, conversations, vectors and the pipeline: held-out quality, round trips, odd rows."""

import collections
import hashlib
import html
import random
import re

import corpus_pipeline
import numpy as np
import pytest

import __spark_entry__ as entry
from pyspark.sql import functions as F

from safetylake.llm import boosting, chat, common, extraction, labelled, nearest, quality, toxicity

MIDDLE = "/root/testdata/sf0.01"


def ranked(y, p):
    """Area under the curve."""
    order = sum((p[y == 1][:, None] > p[y == 0][None, :]).sum(axis=1)) + 0.5 * (p[y == 1][:, None] == p[y == 0][None, :]).sum()
    return order / ((y == 1).sum() * (y == 0).sum())


@pytest.mark.parametrize(("query", "label"), [("op7_toxicity", "toxic"), ("op10_quality", "quality")])
def test_scores_of_held_out_rows(spark, query, label):
    found = entry.queries()[query](spark, MIDDLE).toPandas()
    known = found.merge(spark.read.parquet(f"{MIDDLE}/labels.parquet").toPandas(), on="doc_id")
    known = known[known.held_out]
    assert found.score.between(0, 1).all() and len(known) > 20
    assert ranked(known[label].to_numpy(), known.score.to_numpy()) > 0.9
    assert (known.predicted == known[label]).mean() > 0.9


@pytest.mark.parametrize("op", [toxicity.op7_toxicity, quality.op10_quality])
def test_classifiers_on_odd_rows(spark, op, odd, none, labels):
    rows = op(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out for r in rows if r.doc_id is None)
    assert op(none, labels).count() == 0
    unknown = op(odd, labels.where("false")).collect()
    assert {r.score for r in unknown} == {0.5}
    assert op(odd, spark.createDataFrame([(7, 1, 0), (8, 1, 0), (None, None, None)], "doc_id long, quality int, toxic int")).count() == odd.count()


def test_accepted_keeps_the_columns(odd, labels):
    assert quality.accepted(odd, labels).columns == odd.columns


def test_chain_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    good, moves = rng.normal(size=6), rng.normal(size=(2, 2))
    weights = collections.Counter()
    total = 0.0
    for code in range(64):
        labels = [(code >> i) & 1 for i in range(6)]
        w = np.exp(sum(g * x for g, x in zip(good, labels)) + sum(moves[a, b] for a, b in zip(labels, labels[1:])))
        total += w
        for i, x in enumerate(labels):
            weights[i] += w * x
    p, _ = quality.marginals(good, moves)
    assert p == pytest.approx([weights[i] / total for i in range(6)])
    batched, expected = quality._batched([np.eye(6) * good[:, None]], np.ones(6), moves)
    assert batched == pytest.approx(p) and expected.sum() == pytest.approx(5)


def test_boosting_and_isotonic():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    model = boosting.fit_trees(x[:400], y[:400])
    assert ((model.probability(x[400:]) > 0.5) == y[400:]).mean() > 0.9
    curve = boosting.fit_isotonic(np.array([1.0, 2, 3, 4, 4]), np.array([0.0, 1, 0, 1, 1]))
    assert curve(np.array([0.0, 1, 2.5, 4, 9])).tolist() == [0, 0, 0.5, 1, 1]
    assert boosting.fit_trees(np.zeros((0, 3)), np.zeros(0)).probability(np.zeros((2, 3))).tolist() == [0.5, 0.5]


def test_disguised_words():
    plain = toxicity.features("you are an idiot", frozenset())
    disguised = toxicity.features("you are an 1d10t, st*upid", frozenset())
    at = toxicity.NAMES.index
    assert plain[at("hits")] == 1 and plain[at("near_second")] == 1
    assert disguised[at("hits")] == 0 and disguised[at("disguised_hits")] >= 1


# --- pages -----------------------------------------------------------------------------------------


def article_of(page):
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = re.sub(r"<[^>]*>", " ", re.sub(r"</?(?:p|h1)>", "\n", inner)).split("\n")
    return "\n".join(x for x in (" ".join(html.unescape(b).split()) for b in blocks) if x)


def test_extraction_of_test_pages(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{MIDDLE}/pages.parquet").collect()}
    found = entry.queries()["op2_extraction"](spark, MIDDLE).collect()
    assert len(found) == len(pages)
    assert sum(r.text == article_of(pages[r.page_id]) for r in found) >= 0.99 * len(found)
    assert all(r.n_chars == len(r.text) for r in found)


def test_extraction_of_unseen_layouts_and_odd_pages(spark):
    page = (
        "<html><head><title>T</title></head><body><div class='topbar'><a href='/'>Home</a></div><div id='main-content'>"
        "<h1>A Title &amp; more</h1><p>First&nbsp;paragraph of the\n article, with words.</p><div class='ad'>Buy this now</div>"
        "<p>Be.</p><ul><li>One item<li>Another item</ul></div><div class='comments'><h3>Comments</h3><p>I liked this text, "
        "thanks for writing it.</p></div><div class='cookie-notice'>We use cookies</div><script>x = '<p>no</p>'</script></body>"
    )
    rows = [(1, "u", page, "x"), (2, None, None, None), (3, "u", "", "x"), (None, "u", "no tags at all", "x"), (4, "u", "<p>" * 3000 + "deep", "x"), (5, "u", "<a href='open", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    draw = random.Random(1)
    texts = [" ".join(draw.choices("the of word text line some more here there again".split(), k=draw.randint(2, 60))) for _ in range(200)]
    found = {r["row"]["page_id"]: r["text"] for r in extraction.extracted(pages, extraction.learn(texts)).collect()}
    assert len(found) == 6 and found[2] == found[3] == ""
    assert found[1] == "A Title & more\nFirst paragraph of the article, with words.\nBe.\nOne item\nAnother item"
    assert extraction.op2_extraction(pages).count() == 6
    assert extraction.op2_extraction(pages.where("false")).count() == 0


def test_decoding_is_the_best_consistent_choice():
    draw = random.Random(8)
    for _ in range(50):
        root = extraction.Node("#root", None)
        nodes = [root]
        for _ in range(7):
            extraction.Node(draw.choice(["#text", "div"]), draw.choice([n for n in nodes if n.tag != "#text"]))
            nodes = extraction.walk(root)
        p = np.array([draw.uniform(0.05, 0.95) for _ in nodes])
        best = None
        for code in range(1 << len(nodes)):
            kept = [bool(code >> i & 1) for i in range(len(nodes))]
            if all(not kept[i] or n.parent is None or kept[nodes.index(n.parent)] for i, n in enumerate(nodes)):
                value = sum(np.log(q if k else 1 - q) for k, q in zip(kept, p, strict=True))
                if best is None or value > best[0] + 1e-12:
                    best = (value, [n for n, k in zip(nodes, kept, strict=True) if k and n.tag == "#text"])
        assert extraction.decode(nodes, p) == best[1]


# --- conversations ---------------------------------------------------------------------------------


def digests(turns):
    said = "".join(f"{r}\n{t}\n" for r, t in turns)
    learned = "".join(t for r, t in turns if r == "assistant")
    return len(turns), hashlib.sha256(said.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest()


def test_conversations_read_back(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{MIDDLE}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    odd = [(9_000_001, 0, None, None), (9_000_001, None, "user", "<s>[INST]\\</s>"), (9_000_001, 0, "assistant", "\\<|end|><|turn|>"), (None, 1, "assistant", ""), (9_000_002, 0, "user", "x" * 300_000), (9_000_002, 0, "user", "x" * 300_000)]
    turns = spark.createDataFrame(rows + odd, "conv_id long, turn long, role string, text string").selectExpr("*", "'x' AS formatted", "'y' AS mask")
    plain = collections.defaultdict(list)
    for conv, turn, role, text in rows + odd:
        plain[conv].append((turn is not None, turn or 0, role or "", text or ""))
    plain[-7] = [(True, 0, "user", chat.PROBE), (True, 1, "assistant", chat.PROBE)]
    found = {r.conv_id: r for r in chat.op6_chat(turns).collect()}
    assert set(found) == set(plain)
    for conv, said in plain.items():
        r = found[conv]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == digests([x[2:] for x in sorted(said)])
    assert chat.op6_chat(turns.where("false")).count() == 1
    parts = chat.format_conversations(turns).collect()
    assert sum(len(p.formatted) for p in parts if p.conv_id == 9_000_001) == found[9_000_001].formatted_chars


def test_escape_is_reversible():
    rng = random.Random(1)
    for _ in range(5000):
        text = "".join(rng.choices(["\\", "<", ">", "s", "/", "[", *chat.CONTROL], k=9))
        escaped = chat.escape(text)
        assert chat.unescape(escaped) == text and not any(c in escaped for c in chat.CONTROL)


def test_template_language():
    tree = chat.fold(chat.parse("a{% if 'x' == 'x' and not false %}b{{ 'c' + 'd' | upper }}{% else %}z{% endif %}"))
    assert tree == [("text", ("const", "abcD"))]
    head, turn, tail = chat.compiled("{{ 'h' }}{% for m in messages %}{% if loop.first %}<{% elif loop.last %}>{% else %}-{% endif %}{{ m.text | trim }}{% endfor %}t")
    out = chat.Output()
    head({}, out)
    for i in range(3):
        turn({"m": {"role": "user", "text": f" {i} "}, "loop": {"first": i == 0, "last": i == 2, "index0": i}}, out)
    tail({}, out)
    assert "".join(out.parts) == "h<0-1>2t"
    for bad in ["{{ m.__class__ }}", "{{ open('x') }}", "{% for m in messages %}", "{% import os %}", "{{ m.text | eval }}", "no loop", "{{ 'a' ~ 'b' }}"]:
        with pytest.raises(chat.TemplateError):
            chat.compiled(bad)


# --- vectors ---------------------------------------------------------------------------------------


def test_nearest_against_all_rows(spark):
    data = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    found = collections.defaultdict(list)
    for r in nearest.op8_nearest(data).collect():
        found[r.query_id].append((r.rank, r.vec_id, r.score))
    frame = data.toPandas()
    ids, x = frame.vec_id.to_numpy(), np.stack(frame.embedding.to_numpy()).astype(float)
    unit = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
    hits = total = 0
    for at in np.flatnonzero(ids % 50 == 0):
        score = unit @ unit[at]
        score[at] = -2
        best = ids[np.lexsort((ids, -score))[:5]]
        got = sorted(found[ids[at]])
        assert [g[0] for g in got] == [1, 2, 3, 4, 5]
        assert all(abs(score[np.flatnonzero(ids == g[1])[0]] - g[2]) < 1e-12 for g in got)
        hits, total = hits + len(set(best) & {g[1] for g in got}), total + 5
    assert hits / total >= 0.95


def test_nearest_on_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], "x"), (50, [1.0, 0.0], "x"), (50, [1.0, 0.0], "x"), (3, [2.0, 0.0], "x"), (2, [4.0, 0.0], "x"), (100, None, None), (150, [0.0, 0.0], "x"), (4, [nan, 1.0], "x"), (5, [inf, 1.0], "x"), (6, [None, 1.0], "x"), (7, [1.0], "x"), (None, [1.0, 1.0], "x")]
    data = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank string")
    found = {(r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in nearest.op8_nearest(data).collect()}
    # the rows that repeat an id are candidates each, and queries each
    assert found == {(q, r, i, 1.0) for q, best in ((0, (2, 3, 50, 50)), (50, (0, 2, 3, 50))) for r, i in enumerate(best, 1)}
    twice = spark.createDataFrame([(0, [1.0, 0.0]), (3, [1.0, 0.0]), (3, [0.0, 1.0])], "vec_id long, embedding array<float>")
    assert [tuple(r)[1:] for r in nearest.op8_nearest(twice).orderBy("rank").collect()] == [(1, 3, 1.0), (2, 3, 0.0)]
    assert nearest.op8_nearest(data.where("false")).count() == 0
    many = spark.createDataFrame([(i, [float(i % 3), 1.0]) for i in range(300)], "vec_id long, embedding array<float>")
    split = nearest.nearest(many, nearest.F.col("vec_id") % 50 == 0, chunk=40, block=2)
    whole = nearest.nearest(many, nearest.F.col("vec_id") % 50 == 0)
    assert sorted(split.collect()) == sorted(whole.collect())


# --- samples ---------------------------------------------------------------------------------------


def test_samples_are_bounded_and_not_empty(spark):
    many = spark.range(1000).withColumn("text", F.lit("t"))
    assert many.count() > common.hash_sample(many, "id", 100, 1000).count() > 50
    assert common.hash_sample(many, "id", 999, 1000).count() > 900
    # a table of 2 ** 40 rows still keeps a hash range that is not empty
    kept = common.hash_sample(many, "id", 200, 1 << 40)._jdf.queryExecution().logical().toString()
    assert str((200 << 62) // (1 << 40)) in kept
    docs = spark.range(3000).select(F.lit(1).cast("long").alias("doc_id"), F.col("id").cast("string").alias("text"))
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, 1, 1)], "doc_id long, quality int, toxic int")
    docs = docs.unionByName(spark.createDataFrame([(3, "b"), (3, "a")], docs.schema))
    found = sorted(tuple(r) for r in labelled.training_rows(docs, labels, "quality", 10).collect())
    assert found == [("0", 1), ("a", 1)]


# --- pipeline --------------------------------------------------------------------------------------


def test_pipeline(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, frames[-1], folder)
        assert out.columns == docs.columns, name
        frames.append(corpus_pipeline.stage_table(out, name))
    counts = [f.count() for f in frames]
    assert counts[0] > counts[1] > counts[2] == counts[3]
    pieces = corpus_pipeline.run(spark, folder).collect()
    assert len({p.sequence_id for p in pieces}) > 10


def test_pipeline_stages_on_odd_rows(spark, odd, none):
    for frame in (odd, none):
        docs = frame
        for _, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.stage_table(stage(spark, docs, "/root/testdata/sf0.001"), "odd")
        assert (docs.count() > 0) == (frame is odd)


def test_sampled_lines_are_a_run_of_the_whole_text():
    starts = set()
    for n in range(40):
        text = "\n".join(f"line {n} {i}" for i in range(1000))
        own, length = quality.line_features(text)
        some, sizes = quality.sampled_lines(text, np.arange(1000)[:, None], length)
        assert len(some) == len(sizes) == quality.SAMPLE_LINES and (np.diff(some.ravel()) == 1).all()
        starts.add(int(some[0, 0]))
    assert min(starts) < 200 and max(starts) > 500
    assert len(quality.sampled_lines("a", *quality.line_features("a"))[0]) == 1
