"""Top-k search and HTML extraction against brute force."""

import itertools
import math
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from stationflow.llm import html_extraction as h
from stationflow.llm.queries import QUERIES
from stationflow.llm.topk_search import max_score, top_k

VECTORS = "vec_id long, embedding array<float>"


def brute(rows, k, every):
    fine = [(i, np.floor(256 * np.array(v, float))) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max((len(v) for _, v in fine), default=0)
    fine = [(i, np.pad(v, (0, width - len(v)))) for i, v in fine]
    out = []
    for q, v in {(i, tuple(v)) for i, v in fine if i % every == 0}:
        best = sorted((-int(np.dot(v, w)), i) for i, w in fine if i != q)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(0, 1, 12).astype(np.float32).tolist()) for i in range(700)]
    rows += [(1000 + i, rows[i % 3][1]) for i in range(20)]  # ties
    rows += [(50, None), (2001, [None] * 12), (2002, [float("nan")] * 12), (2003, [float("inf")] + [0.0] * 11), (None, rows[0][1]), (2004, []), (2005, [5.0, 5.0])]
    rows += [rows[4], rows[100]]  # repeated rows, one of them a query
    docs = spark.createDataFrame(rows, VECTORS)
    got = top_k(docs, F.col("vec_id"), F.col("embedding"), F.col("vec_id") % 50 == 0, k=5, tile=200, asked_tile=4)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 5, 50)


def test_fewer_than_k_and_nothing(spark):
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [-1.0])], VECTORS)
    got = top_k(few, F.col("vec_id"), F.col("embedding"), F.col("vec_id") == 0, k=5)
    assert sorted(tuple(r) for r in got.collect()) == [(0, 1, 1, 131072), (0, 2, 2, -65536)]
    for rows in ([], [(1, [1.0])]):
        docs = spark.createDataFrame(rows, VECTORS)
        assert top_k(docs, F.col("vec_id"), F.col("embedding"), F.col("vec_id") % 50 == 0).count() == 0


def test_large_components_stay_exact(spark):
    big = spark.createDataFrame([(0, [2.0**20, 1.0]), (1, [2.0**20, 1.0]), (2, [2.0**20, 2.0])], "vec_id long, embedding array<double>")
    got = top_k(big, F.col("vec_id"), F.col("embedding"), F.col("vec_id") == 0, k=1).collect()
    assert [tuple(r) for r in got] == [(0, 1, 2, 2**56 + 2 * 256 * 256)]


def test_pruning_keeps_the_best():
    rng = np.random.default_rng(6)
    for _ in range(30):
        rows = np.floor(256 * rng.normal(0, rng.random(20), (2000, 20)))
        query, ids = np.floor(256 * rng.normal(0, 1, 20)), rng.permutation(2000)
        places, scores = max_score(query, rows, ids, rows.min(axis=0), rows.max(axis=0), 5)
        want = sorted(zip(-(rows @ query), ids))[:5]
        assert [(-s, i) for s, i in zip(scores, ids[places])] == want


@pytest.fixture(scope="module")
def model():
    return h.fit(h.labelled_pages())


def test_marginals_equal_enumeration(model):
    page = h.PageTree("<body><nav class=menu><a href=x>a b</a></nav><div class=content><p>Some words here.<div class=ad>buy</div></div></body>")
    parent, n = page.parent, len(page.parent)
    own = [model.bias + sum(model.weights.get(f, 0.0) for f in node) for node in page.features]
    total, content = 0.0, np.zeros(n)
    for labels in itertools.product((0, 1), repeat=n):
        logs = sum(own[i] for i in range(n) if labels[i])
        logs += sum(model.edges[page.runs[i] is not None][labels[parent[i]]][labels[i]] for i in range(1, n))
        total += math.exp(logs)
        content += np.array(labels) * math.exp(logs)
    assert model.marginals(parent, page.features, page.runs) == pytest.approx((content / total).tolist())


def test_labelled_pages_held_out(model):
    wrong = runs = 0
    for html in h.labelled_pages(150, seed=77):
        truth = h.PageTree(html)
        labels = [0] * len(truth.parent)
        for i in range(1, len(labels)):
            labels[i] = int(truth.marks[i]) if truth.marks[i] is not None else labels[truth.parent[i]]
        page = h.PageTree(re.sub(r' data-main="."', "", html))
        for run, chance, label in zip(page.runs, model.marginals(page.parent, page.features, page.runs), labels):
            if run:
                runs, wrong = runs + 1, wrong + ((chance >= 0.5) != label)
    assert wrong / runs < 0.02


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header class="site-header"><a href="/">Home of it</a></header><nav><ul><li><a href="/a">one</a></li><li><a href="/b">two</a></li></ul></nav>
<div class="cookie-notice"><p>We use cookies on this site.</p><button>Accept</button></div><!-- note -->
%s
<aside class="sidebar"><h3>More</h3><ul><li><a href="/c">other story</a></li></ul></aside>
<div class="ad">Buy this now, it is good.</div><form class="search"><label>Search</label><input><button>Go</button></form>
<section id="comments"><h2>Comments</h2><div class="comment"><p>I liked this very much.</p></div></section>
<footer>&copy; 2024 somebody. All rights.</footer></body></html>"""
ARTICLE = "<h1>A  title &amp; more</h1><p><b>First words,\n and\tmore&nbsp;here.<br><p>Second&#33; with a <a href='/x'>link</a> in it.</p><ul><li>An item.</li></ul>"
TEXT = "A title & more\n\nFirst words, and more here.\n\nSecond! with a link in it.\n\nAn item."


@pytest.mark.parametrize("main", ["<article>%s</article>", "<main>%s</main>", '<div class="content">%s</div>', '<main><article class="post">%s</article></main>'])
def test_main_text_of_a_page(model, main):
    assert h.main_text(PAGE % (main % ARTICLE), model) == TEXT


def test_cut_off_page(model):
    page = PAGE % f"<article>{ARTICLE}</article>"
    assert h.main_text(page[: page.index("</ul></article>")], model) == TEXT
    assert h.main_text(page[: page.index("</ul></article>")] + "<!-- cut > off", model) == TEXT
    assert h.main_text("<body><article><p>Some words that end here &am", model) == "Some words that end here &am"
    assert h.main_text("<body><article><p>Some words that end here.</p><div cla", model) == "Some words that end here."


@pytest.mark.parametrize(
    "before",
    [
        "<script><!-- track(); </script>",
        "<script>var s = '<!--';</script>",
        "<script><!-- document.write('<script>x()</script>'); --></script>",
        "<style><!-- p {} </style>",
        "<textarea><!-- </textarea>",
        "<title>a <!-- b</title>",
        '<div title="<!-- x"></div>',
        "<div title='a <b'></div>",
        "<!-- closed by --!>",
        "<!-->",
        "<!--->",
        "<!-- a > b -- c -->",
    ],
)
def test_what_only_looks_like_an_open_comment(model, before):
    assert h.main_text(PAGE % f"{before}<article>{ARTICLE}</article>", model) == TEXT


@pytest.mark.parametrize("cut", ["<!-- a > b", "<!-- <p>a</p>", "<p class='a > b", '<p class="a', "<p", "</p", "<!doc", "<script>a <p>b</p>", "<script><!-- a </scr"])
def test_what_the_end_cuts_off(model, cut):
    page = PAGE % f"<article>{ARTICLE}</article>"
    assert h.main_text(page[: page.index("</ul></article>")] + cut, model) == TEXT


@pytest.mark.parametrize("name", ["iframe", "noframes", "noembed"])
def test_fallbacks_are_no_text(model, name):
    fallback = f"<{name} src=x><p>Your browser has no frames at all.</p></{name}>"
    page = "<body><article><p>First words of the story.</p>%s<p>Last words of the story.</p></article></body>"
    assert h.main_text(page % fallback, model) == "First words of the story.\n\nLast words of the story."


def test_raw_text_that_is_shown():
    page = h.PageTree("<div>a<xmp>b &amp; <p>c</xmp>d</div><template><xmp>e</xmp></template>")
    assert [r for r in page.runs if r] == ["a", "b &amp; <p>c", "d"]


def test_slashes_close_nothing_but_in_svg():
    page = h.PageTree("<div/>a<p>b<br/>c</p><script/>var x</script><svg><title/><g/></svg>d")
    assert [r for r in page.runs if r] == ["a", "b c", "d"]
    root = page.parent.index(0)
    assert page.features[root][0] == "tag=div" and page.parent[page.runs.index("a")] == root
    assert page.parent[page.runs.index("d")] == root


def test_open_places_equal_a_walk():
    """What a start tag closes, found by places, equals a walk through all open tags."""

    class Walked(h.PageTree):
        def shut(self, tags):
            for at in range(len(self.tags) - 1, 0, -1):
                if self.tags[at] in tags:
                    return self.close(at)
                if self.tags[at] in h.SCOPES:
                    return None

    rng = random.Random(4)
    names = "p div li ul dt dd dl tr td th table option select figure h2 a b section html body blockquote details".split()
    for _ in range(400):
        html = "".join(rng.choice(["<{}>", "<{}>", "</{}>", "<{}>x ", "y "]).format(rng.choice(names)) for _ in range(60))
        one, other = h.PageTree(html), Walked(html)
        assert (one.parent, one.features, one.runs) == (other.parent, other.features, other.runs)


@pytest.mark.parametrize("piece", ["<div>", "<p><figure>", "<details><li></li>", "<dl><dt>", "<ul><li>"])
def test_very_deep_pages_take_linear_time(model, piece):
    html = "<article>" + piece * 50_000 + "<p>The words at the end.</p>"
    begin = time.process_time()
    assert sum(text == "The words at the end." for text in h.PageTree(html).runs) == 1
    h.main_text(html, model)
    assert time.process_time() - begin < 15


def test_pages_of_the_tables(spark, tmp_path):
    def truth(html):
        inside = re.sub(r"<[^>]*$", "", html.split("<article>")[1].split("</article>")[0])
        blocks = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>|<br>", " ", inside))
        import html as entities

        return "\n\n".join(x for x in (" ".join(entities.unescape(b).split()) for b in blocks) if x)

    folder = "/root/testdata/sf0.001"
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    for r in QUERIES["op10_html_extraction"](spark, folder).collect():
        assert r["text"] == truth(pages[r["page_id"]]) and r["n_chars"] == len(r["text"])


def test_odd_pages(spark, tmp_path):
    rows = [(1, "u", None), (None, None, ""), (2, "u", "<p>"), (3, "u", "<div>" * 3000 + "x"), (4, "u", PAGE % f"<article>{ARTICLE}</article>")]
    spark.createDataFrame([(*r, 1, 2) for r in rows + rows[-1:]], "page_id long, url string, html string, text int, n_chars int").write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted((str(r["page_id"]), r["text"], r["n_chars"]) for r in QUERIES["op10_html_extraction"](spark, str(tmp_path)).collect())
    assert [g for g in got if g[0] == "4"] == [("4", TEXT, len(TEXT))] * 2
    assert [g for g in got if g[0] in ("1", "None", "2")] == [("1", "", 0), ("2", "", 0), ("None", "", 0)]
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{tmp_path}/none/pages.parquet")
    assert QUERIES["op10_html_extraction"](spark, f"{tmp_path}/none").count() == 0
