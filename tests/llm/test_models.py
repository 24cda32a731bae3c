"""Pages, quality and class bigrams: learned models and what they say."""

import math
import random
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import classes as classes_module, pages as web
from tidemark.llm.blocks import blocks_of
from tidemark.llm.classes import UNKNOWN, Model, class_bigram_scores
from tidemark.llm.quality import ByteNetwork, Laid, judged, learned, scored
from tidemark.llm.ship import ship
from tidemark.llm.words import pack_sorted

DATA = "/root/testdata/sf0.01"


def texts_of(html):
    return [b.text for b in blocks_of(html)]


def test_blocks_of_broken_and_odd_markup():
    assert texts_of(None) == texts_of("") == texts_of("<p></p> <!-- x -->") == []
    assert texts_of("plain &lt;b&gt; &amp;&nbsp;text") == ["plain <b> & text"]
    assert texts_of("<p>one<p>two<br>more <b>bold\n<i>x</b></p>three") == ["one", "two more bold x", "three"]
    assert texts_of("<script>var a='</p>';</script>a<style>p{}</style>b<!-- <p>c --><textarea>t</textarea>") == ["a b"]
    assert texts_of("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>") == ["a", "b", "c", "d"]
    assert texts_of('<a href="x>y">link</a> 2 < 3 <p title=\'>\'>z') == ["link 2 < 3", "z"]
    assert texts_of("<p>open <script>never closed") == ["open"]
    assert texts_of("<div>" * 3000 + "deep" + "</div>" * 3000) == ["deep"]


@pytest.mark.parametrize(
    "before",
    [
        '<svg class="icon"/>', "<svg/>", "<SVG />", "<math/>", "<math display='block' />", "<svg-icon></svg-icon>", '<svg-icon name="x"/>',
        "<video-player>", "<button-group></button-group>", "<select-menu>", "<object-view>", "<canvas>", "<button>", "<svg><path d='M0'>",
        "<svg><text>drawn</text></svg>", "<button>press</button >", "<video><p>none</p></VIDEO x>", "<script>a</script\n>", "<!-->", "<!-- c --!>",
    ],
)
def test_an_article_after_any_element_is_kept(before):
    html = f"<body><div>{before}</div><article><h1>T</h1><p>u.</p></article></body>"
    assert texts_of(html) == ["T", "u."]
    # Nor does it end with a later element of the kind.
    later = "<p><svg><svg><text>x</text></svg>y</svg>v<button>w</button><canvas></canvas></p></body>"
    assert texts_of(html.replace("</body>", later)) == ["T", "u.", "v"]


def test_text_of_formulas_and_custom_elements_is_kept():
    assert texts_of("<p>if <math><mi>x</mi><mo>=</mo><mn>2</mn></math> then</p>") == ["if x=2 then"]
    assert texts_of("<article-body><p>a <svg-label>b</svg-label> c</p></article-body>") == ["a b c"]


@pytest.mark.parametrize("part", ["<p b ", "<p \"", "<a", "<!x", "<svg b ", "<p '\"", "</script", "<script></script", "<p b=\"", "<"])
@pytest.mark.parametrize("tail", ["", ">", "\"", "'>"])
def test_a_megabyte_of_unclosed_markup(part, tail):
    """Neither tags nor quotes without an end are looked through again from every start."""
    start = time.process_time()
    blocks_of(part * ((1 << 20) // len(part)) + tail)
    assert time.process_time() - start < 20


def test_tags_end_at_the_first_bracket_outside_quotes():
    assert texts_of("<p title='a>b' class=\"x>\">one</p><p b=\">two") == ["one", "<p b=\">two"]
    assert texts_of("<p a=\"1>x</p><p a='2'>y") == ["<p a=\"1>x", "y"]
    assert texts_of("1 < 2 <p>x</p> <b") == ["1 < 2", "x", "<b"]
    assert texts_of("x <!doctype a=\"> y <!-- z") == ["x y"]


def test_blocks_know_their_path():
    block = blocks_of('<body><div class="post-body Main" id=x1><article><header><h1>T</h1></header><p>u</p></article></div>')[0]
    assert [t for t, _ in block.path] == ["body", "div", "article", "header", "h1"]
    assert block.path[1][1] == ("post", "body", "main", "x")
    assert web.taught(block) == 1


def page(extra=""):
    return (
        '<html><body><nav><ul><li><a href="/">Home</a></li></ul></nav><div class="ad">Buy now.</div>'
        f"<article><h1>Title &amp; more</h1><p>First  line\nof text.</p>{extra}<p>Second.</p></article>"
        "<footer>&copy; somebody</footer></body></html>"
    )


def test_paths_are_whole_at_any_depth():
    deep = '<body><article class="post">' + '<div class="row"><div>' * 30 + "<p>a" + "<font><b><i>" * 100 + "<p>b</article><p>c"
    blocks = blocks_of(deep)
    assert [b.text for b in blocks] == ["a", "b", "c"]
    assert [web.taught(b) for b in blocks] == [1, 1, 0]
    near, far = (blocks_of(f"<{tag}>" + "<div>" * 40 + "<p>x")[0] for tag in ("article", "nav"))
    paths, words = web.PathBuckets(), web.WordBuckets()
    assert web.Described([near], paths, words).paths[0].tolist() != web.Described([far], paths, words).paths[0].tolist()
    assert len(blocks_of("<div>x<b>y</u>" * 100_000)) == 100_000


@pytest.fixture(scope="module")
def labeller(spark):
    return web.learned(ship(spark).read.parquet(f"{DATA}/pages.parquet"))


def test_article_text_of_pages(spark, labeller):
    sidebar = '<aside class="sidebar"><h3>Related</h3><p>Other story here.</p></aside>'
    comments = '<section class="comments"><div class="comment"><p>I liked this.</p></div></section>'
    form = "<form><label>Mail</label> Sign up for news</form>"
    rows = [
        (1, page()), (2, page(sidebar)), (3, page().replace("</article>", "</article>" + sidebar + form)),
        (4, page().replace("</article>", "</article>" + comments)), (5, None), (6, ""), (7, "<nav>only a menu</nav>"), (1, page()),
        (8, page("<p>" + "long words " * 30000 + "</p>")),
    ]
    df = spark.createDataFrame(rows, "page_id long, html string").withColumns({"text": F.lit("old"), "n_chars": F.lit(-1)})
    got = web.main_texts(df, labeller).collect()
    want = "Title & more\nFirst line of text.\nSecond."
    assert Counter(r["page_id"] for r in got) == Counter(i for i, _ in rows)
    for r in got:
        if r["page_id"] <= 4:
            assert r["text"] == want
        elif r["page_id"] < 8:
            assert r["text"] == ""
        else:
            assert r["text"] == want.replace("\nSecond", "\n" + ("long words " * 30000).strip() + "\nSecond")
        assert r["n_chars"] == len(r["text"])
    assert web.main_texts(df.limit(0), labeller).count() == 0


def test_articles_in_deep_pages(spark, labeller):
    html = page().replace("<p>First", "<div>" * 30 + "<p>First").replace("Second.</p>", "Second.</p>" + "</div>" * 30)
    html = html.replace("<li>", "<li>" + "<div>" * 30).replace('<div class="ad">', '<div class="ad">' + "<div>" * 30 + "<p>")
    html = html.replace("Buy now.</div>", "Buy now.</p>" + "</div>" * 31).replace("</li>", "</div>" * 30 + "</li>")
    df = spark.createDataFrame([(1, html)], "page_id long, html string")
    assert web.main_texts(df, labeller).first()["text"] == "Title & more\nFirst line of text.\nSecond."


def test_articles_of_the_given_pages_and_of_other_templates(spark, labeller):
    rows = [r["html"] for r in spark.read.parquet(f"{DATA}/pages.parquet").select("html").collect()]
    draw = np.random.default_rng(123)
    paths, words = web.PathBuckets(), web.WordBuckets()
    for change, least in ((False, 1.0), (True, 0.98)):
        right = total = 0
        for i, html in enumerate(rows):
            donor = [b.text for b in blocks_of(rows[i - 1]) if len(b.text) < 400] or ["x"]
            blocks = blocks_of(web.restyled(html, donor, draw) if change else html)
            found = labeller.labels([web.Described(blocks, paths, words)])[0]
            want = np.array([web.taught(b) for b in blocks])
            right, total = right + (found == want).sum(), total + len(want)
        assert right >= least * total


def test_articles_without_any_telling_name(spark, labeller):
    """Class names and sectioning elements hidden, on the given pages and in templates not learned from."""
    rows = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.1/pages.parquet").orderBy("page_id").select("html").tail(200)]
    draw = np.random.default_rng(321)
    paths, words = web.PathBuckets(), web.WordBuckets()
    for change in (False, True):
        found = articles = right = total = 0
        for i, html in enumerate(rows):
            donor = [b.text for b in blocks_of(rows[i - 1]) if len(b.text) < 400] or ["x"]
            blocks = blocks_of(web.restyled(html, donor, draw) if change else html)
            if not blocks:
                continue
            want = np.array([web.taught(b) for b in blocks])
            bare = web.hidden(blocks)
            assert not any(names or tag in web.SECTIONS for b in bare for tag, names in b.path)
            got = labeller.labels([web.Described(bare, paths, words)])[0]
            found, articles = found + (got & (want == 1)).sum(), articles + want.sum()
            right, total = right + (got == want).sum(), total + len(want)
        assert found >= 0.95 * articles and right >= 0.95 * total


@pytest.mark.parametrize("words", [1, 300])  # 300: pages of more than 60,000 characters
def test_long_pages_are_learned_from(spark, words):
    says = lambda i, n: " ".join(f"w{(i * 7 + j) % 50}" for j in range(n)) + "."
    pages = [
        '<html><body><nav><ul>' + "".join(f'<li><a href="#">{says(i + j, 2)}</a></li>' for j in range(40)) + "</ul></nav><article>"
        + "".join(f"<p>{says(i * 3 + j, words * 4 + 4)}</p>" for j in range(70)) + '</article><div class="comments">'
        + "".join(f"<p>{says(i + j, 9)}</p>" for j in range(30)) + "</div></body></html>"
        for i in range(40)
    ]
    assert (min(map(len, pages)) > web.MOST_CHARS) == (words > 1) and min(len(blocks_of(x)) for x in pages) > web.MOST_BLOCKS
    df = ship(spark).createDataFrame(list(enumerate(pages)), "page_id long, html string")
    labeller = web.learned(df)
    paths, known = web.PathBuckets(), web.WordBuckets()
    blocks = [blocks_of(x) for x in pages]
    found = np.concatenate(labeller.labels([web.Described(b, paths, known) for b in blocks]))
    assert (found == [web.taught(b) for bs in blocks for b in bs]).mean() > 0.98


def test_copies_and_pages_without_blocks_do_not_fill_the_sample(spark, monkeypatch):
    texts = ["<p>" + "word " * (i + 1) + "</p>" for i in range(40)]
    df = ship(spark).createDataFrame([(x,) for x in texts], "html string")
    lowest = df.orderBy(F.xxhash64("html")).first()["html"]
    many = df.union(spark.createDataFrame([(lowest,)] * 200 + [(f"<script>{i}</script>",) for i in range(200)], "html string"))
    fits = []
    monkeypatch.setattr(web.BlockLabeller, "fit", lambda self, pages, labels: fits.append(pages) or self)
    web.learned(many.repartition(3), sample=20)
    assert len({p.numbers.tobytes() for p in fits[0]}) == 20


def test_the_teacher_labels_where_nothing_was_learned(spark):
    df = ship(spark).createDataFrame([(1, page())], "page_id long, html string")
    nothing = web.learned(spark.createDataFrame([("<script>x</script>",), (None,), ("",)], "html string"))
    assert web.main_texts(df, nothing).first()["text"] == "Title & more\nFirst line of text.\nSecond."


def test_a_labeller_without_pages(spark):
    empty = ship(spark).createDataFrame([], "page_id long, html string")
    assert web.main_texts(empty, web.learned(empty)).count() == 0


def test_lstm_gradients_match_differences():
    draw = np.random.default_rng(1)
    paths, words = web.PathBuckets(), web.WordBuckets()
    described = [web.Described(blocks_of(page(x)), paths, words) for x in ("", "<p>a b</p><p>c</p>")]
    labels = [draw.integers(0, 2, len(d.paths)).astype(np.float32) for d in described]
    model = web.BlockLabeller()
    grads = model._gradients(described, labels)

    def loss():
        x, mask, (t, i, _, _) = model._inputs(described)
        z = model._run(x, mask)[3][t, i].astype(np.float64)
        y = np.concatenate(labels)
        return np.mean(np.log1p(np.exp(-np.where(y == 1, z, -z))))

    for name, value in model._params().items():
        flat, want = value.reshape(-1), grads[name].reshape(-1)
        for at in np.argsort(-np.abs(want))[:3]:
            old = flat[at]
            flat[at] = old + 1e-2
            up = loss()
            flat[at] = old - 1e-2
            down = loss()
            flat[at] = old
            assert abs((up - down) / 2e-2 - want[at]) < 1e-3 + 0.05 * abs(want[at]), name


def test_byte_network_gradients_match_differences():
    texts = ["Some ordinary text of a few words, more than one chunk of it at least.", "ha ha ha ha ha ha ha", ""]
    labels, weights = np.array([1, 0, 1], np.float32), np.array([1, 0.5, 2], np.float32) / 3
    network = ByteNetwork()
    laid = Laid(texts)
    grads = network._gradients(laid, labels, weights)

    def loss():
        z = network._forward(laid)["z"].astype(np.float64)
        return (weights * np.log1p(np.exp(-np.where(labels == 1, z, -z)))).sum()

    for name, value in network.params.items():
        flat, want = value.reshape(-1), grads[name].reshape(-1)
        for at in np.argsort(-np.abs(want))[:3]:
            old = flat[at]
            flat[at] = old + 2e-3
            up = loss()
            flat[at] = old - 2e-3
            down = loss()
            flat[at] = old
            assert abs((up - down) / 4e-3 - want[at]) < 2e-3 + 0.06 * abs(want[at]), name


def test_scores_do_not_depend_on_neighbours():
    network = ByteNetwork()
    texts = ["a first text", "", None, "x" * 1000, "é 漢", "a first text"]
    together = network.scores(texts)
    assert np.allclose(together, [network.scores([t])[0] for t in texts], atol=1e-5)
    assert together[1] == together[2] and abs(together[0] - together[5]) < 1e-5


def test_quality_of_held_out_documents(spark):
    docs, labels = (ship(spark).read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = judged(docs, labels).join(labels, "doc_id").where("held_out").collect()
    good = [r["score"] for r in rows if r["quality"] == 1]
    bad = [r["score"] for r in rows if r["quality"] == 0]
    assert np.mean([s >= 0.3 for s in good]) > 0.99 and np.mean([s < 0.3 for s in bad]) > 0.9
    assert np.mean([g > b for g in good for b in bad]) > 0.99
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)


def test_quality_with_odd_rows_and_few_labels(spark):
    docs = ship(spark).createDataFrame(
        [(1, "some text"), (2, ""), (3, None), (None, "no id"), (1, "some text"), (4, "z" * 200000)], "doc_id long, text string"
    )
    labels = [(1, 1, 0), (1, 1, None), (2, 0, 1), (None, 0, 0), (3, None, 0)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    for some in (labels, labels.limit(0)):
        got = judged(docs.withColumn("score", F.lit("x")), some).collect()
        assert Counter(r["doc_id"] for r in got) == {1: 2, 2: 1, 3: 1, None: 1, 4: 1}
        assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    assert judged(docs.limit(0), labels).count() == 0
    network = learned(docs, labels)
    assert scored(docs.withColumn("score", F.lit(1)), network).columns == ["doc_id", "text", "score"]


def plain_base(rows):
    tokens = [(key, (t or "").encode().lower().split() + [None]) for key, t in rows]
    out = lambda key: key is None or zlib.crc32(str(key).encode()) % 7 == 2
    count = Counter(w for key, ws in tokens if not out(key) for w in ws)
    n, v = sum(count.values()), len(count)
    return Counter(
        (key, out(key), len(ws), sum(count[w] > 0 for w in ws), n, round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ws), 5))
        for key, ws in tokens
    )


def some_texts(n=150):
    draw = random.Random(4)
    kinds = [[f"{k}{i}" for i in range(60)] for k in ("North", "south", "east")]
    rows = []
    for i in range(n):
        words = draw.choice(kinds)
        rows.append((i, " ".join(draw.choice(words[: draw.choice([8, 60])]) for _ in range(draw.randrange(1, 60)))))
    return rows


def test_counts_above_32_bits_come_back_whole():
    words = pack_sorted(np.array([7, 9], np.uint64))
    counts = classes_module.planes(np.array([3_000_000_000, 1]))
    sent = classes_module._sent([(0, group, words, None, None, counts) for group in (0, 1)])
    said = classes_module._total(8)((pa.scalar(0),), sent).to_pylist()
    answers = [classes_module.unplanes(r["data"]).tolist() for r in said if r["kind"] == "count"]
    assert answers == [[6_000_000_000, 2]] * 2
    for values in ([], [0], [2**32 - 1, 0], [2**32, 5], [2**53]):
        assert classes_module.unplanes(classes_module.planes(np.array(values, np.int64))).tolist() == values


def test_base_scores_equal_brute_force_and_classes_do_better(spark, monkeypatch):
    monkeypatch.setattr(classes_module, "GROUP_BYTES", 3000)
    rows = some_texts() + [(900, None), (901, ""), (None, "North1 new"), (3, "North1\x1cnew É é"), (900, None)]
    docs = ship(spark).createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = class_bigram_scores(docs.withColumn("held", F.lit(1)), classes=8).collect()
    have = Counter(
        (r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in got
    )
    assert have == plain_base(rows)
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held) + 0.2 * sum(r["n_tokens"] for r in held)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(3, "a b")], [(None, "a b")]])
def test_scores_of_almost_nothing(spark, rows):
    docs = ship(spark).createDataFrame(rows, "doc_id long, text string")
    got = class_bigram_scores(docs).collect()
    assert len(got) == len(rows) and all(np.isfinite(r["score"]) for r in got)
    assert Counter((r["doc_id"], r["n_tokens"], r["n_known"]) for r in got) == Counter(x[0:1] + x[2:4] for x in plain_base(rows).elements())


def test_probabilities_add_up():
    draw = np.random.default_rng(0)
    counts = [[7], [5, 3, 1, 1], [9, 2]]  # per class; class 0 is the end
    tokens = np.array([sum(c) for c in counts], float)
    model = Model(int(tokens.sum()), 7, 0.6, draw.integers(0, 9, (3, 3)).astype(float), tokens, np.array([1.0, 4, 2]))
    for past in (0, 1, 2, UNKNOWN):
        own = np.array([c for c, cs in enumerate(counts) for _ in cs] + [UNKNOWN])
        each = model.logs(own, np.full(len(own), past), np.array([n for cs in counts for n in cs] + [0]))
        assert abs((10**each).sum() - 1) < 1e-9
