import re

import pytest

from riskspark.llm.blocks import split_blocks
from riskspark.llm.labeller import Labeller, extract, features, train_labeller


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet("/root/testdata/sf0.01/pages.parquet")


@pytest.fixture(scope="module")
def model(pages):
    return train_labeller(pages)


def article(page):
    found = re.search(r"<article>(.*?)</article>", page, re.S)
    return "\n".join(b.text for b in split_blocks(found[1])) if found else ""


def test_pages_against_their_articles(pages, model):
    rows = {r.page_id: r.html for r in pages.collect()}
    got = extract(pages, model).collect()
    assert len(got) == len(rows)
    right = [r.text == article(rows[r.page_id]) for r in got]
    assert sum(right) >= 0.98 * len(right)
    assert all(r.n_chars == len(r.text) for r in got)


@pytest.mark.parametrize("head, tail", [("<article>", "</article>"), ("<main>", "</main>"),
                                        ('<div class="post-content">', "</div>"), ('<div id="content">', "</div>")])
def test_other_layouts(spark, model, head, tail):
    body = "".join(f"<p>Sentence number {i} of the story goes on for a while, and then it ends.</p>" for i in range(5))
    page = (f'<html><body><header><nav><ul><li><a href="/">Home</a></li><li><a href="/a">About us</a></li></ul></nav>'
            f'</header><div class="cookie-notice">We use cookies. Accept them all?</div>{head}<h1>A story</h1>{body}{tail}'
            '<aside class="sidebar"><a href="/x">Read this</a><a href="/y">And that</a></aside>'
            '<form><label>Your mail</label><input name="m"><button>Subscribe</button></form>'
            '<div class="comments"><p>I did not like this story.</p><p>Me too, says another reader.</p></div>'
            '<footer>&copy; somebody</footer></body></html>')
    df = spark.createDataFrame([(1, "u", page)], "page_id bigint, url string, html string")
    lines = extract(df, model).first().text.split("\n")
    assert lines == ["A story", *(f"Sentence number {i} of the story goes on for a while, and then it ends." for i in range(5))]


def test_blocks():
    page = ("<head><title>T</title></head><body><p>a&amp;b <b>bold\n </b>c<br>d<p>two &#233;&nbsp;<script>x('<p>')</script>"
            "<!-- no <p> --><div>three<span> 3</span></div><a title='>'>link</a><textarea>t</textarea><ul><li>x<li>y</ul>")
    blocks = split_blocks(page)
    assert [b.text for b in blocks] == ["a&b bold c d", "two é", "three 3", "link", "x", "y"]
    assert blocks[3].linked == 1.0 and blocks[0].path == ("body", "p")
    assert split_blocks("") == [] and [b.text for b in split_blocks("1 < 2 <b")] == ["1 < 2 <b"]


def test_odd_rows(spark, model):
    rows = [(1, None, None), (2, "u", ""), (None, "u", "<p>" + "long text " * 20_000), (4, "u", "<nav>a</nav>" * 3000),
            (4, "u", "<nav>a</nav>" * 3000), (5, "u", "plain text"), (6, "u", "</p></div><p")]
    df = spark.createDataFrame([(*r, "t") for r in rows], "page_id bigint, url string, html string, text string")
    got = extract(df, model).collect()
    assert len(got) == len(rows)
    assert all(r.text == "" and r.n_chars == 0 for r in got if r.page_id in (1, 2))
    assert extract(df.limit(0)).collect() == []
    assert not train_labeller(df).trained


def test_gradients():
    import numpy as np

    from riskspark.llm.labeller import _pad

    blocks = split_blocks("<nav>a b</nav><article><p>Some words here.</p><p>More.</p></article><footer>c</footer>")
    padded = _pad([features(blocks), features(blocks[:2])])
    target = np.zeros(padded[0], np.float32)
    target[1:3, 0] = 1
    model = Labeller()
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}

    def loss():
        logit, mask = model.logits(padded)[0], padded[3]
        return float(((np.logaddexp(0, logit) - target * logit) * mask).sum() / mask.sum())

    grads = model.gradients(padded, target)
    rng = np.random.default_rng(0)
    for name, grad in grads.items():
        flat, g = model.p[name].reshape(-1), np.asarray(grad).reshape(-1)
        for at in {int(np.abs(g).argmax()), int(rng.integers(len(flat)))}:
            old = flat[at]
            flat[at] = old + 1e-4
            up = loss()
            flat[at] = old - 1e-4
            down = loss()
            flat[at] = old
            assert abs((up - down) / 2e-4 - g[at]) < 2e-4 + 0.02 * abs(g[at]), name


def test_unclosed_hidden_elements():
    def split(page):
        return [(b.text, b.path) for b in split_blocks(page)]

    story = [("Hello there", ("html", "body", "article", "p"))]
    rest = "<body><article><p>Hello there</p></article></body></html>"
    assert split(f"<html><head><title>t</title>{rest}") == story
    assert split(f"<html><head><meta charset=x><noscript><link href=x>{rest}") == story
    assert split("<head><title>t</title><p>Hello there") == [("Hello there", ("p",))]
    assert split(f"<html><head><title>t</title><noscript>no</noscript></head>{rest}") == story
    for tag in ("noscript", "select", "svg", "object", "audio", "video", "canvas"):
        for gap in (f"<div>a<{tag} class=x>b<i>c</i></div>", f"<ul><li>a<{tag}>b<li>d</ul>",
                    f"<div>a<{tag}>b</div><{tag}>c</{tag}>"):
            page = f"<html><body>{gap}<article><p>Hello <{tag}><p>x</p></{tag}>there</p></article></body></html>"
            texts = [b.text for b in split_blocks(page)]
            assert texts == ["a", *(["d"] if "<li>" in gap else []), "Hello there"], (tag, gap)
            assert split_blocks(page)[-1].path == story[0][1]
    assert split("<p>a</p><script>b <p>c</p>") == [("a", ("p",))]


def test_features_of_deep_paths():
    inner = '<div class="col-md-8 col-sm-12">' * 8 + "<p>Words.</p>" + "</div>" * 8
    paths = [features(split_blocks(f"<{tag}>{inner}</{tag}>"))[0][0] for tag in ("article", "footer")]
    assert len(paths[0]) > 24 and paths[0][0] != paths[1][0] and paths[0][1:] == paths[1][1:]


STORY = "".join(f"<p>Sentence number {i} of the story goes on for a while, and then it ends.</p>" for i in range(5))
LINES = [f"Sentence number {i} of the story goes on for a while, and then it ends." for i in range(5)]


@pytest.mark.parametrize("body, inner", [
    ('<body class="single has-sidebar">', "<article>"), ('<body class="logged-in header-fixed">', "<article>"),
    ("<body>", '<article class="post comments-open">'), ("<body>", '<article class="comment-free">'),
    ("<body>", '<main class="no-sidebar">'), ('<body><div class="layout with-ads">', '<article class="post">')])
def test_names_of_a_page_state_lose_no_text(spark, model, body, inner):
    page = (f'<html class="js no-menu">{body}<header><nav><a href="/">Home</a> <a href="/a">About</a></nav></header>{inner}'
            f'<h1>A story</h1>{STORY}</{inner[1:].split()[0].rstrip(">")}><aside class="sidebar"><a href="/x">Read this</a></aside>'
            '<footer>Somebody, some rights</footer></body></html>')
    df = spark.createDataFrame([(1, "u", page)], "page_id bigint, url string, html string")
    assert extract(df, model).first().text.split("\n") == ["A story", *LINES]


def test_a_title_in_the_articles_own_header(spark, model):
    page = ('<html><body><header><nav><a href="/">Home</a></nav></header><article><header><h1>A story</h1></header>'
            f'{STORY}</article><footer>Somebody</footer></body></html>')
    df = spark.createDataFrame([(1, "u", page)], "page_id bigint, url string, html string")
    assert extract(df, model).first().text.split("\n")[-5:] == LINES
    from riskspark.llm.labeller import own_label
    assert [own_label(b) for b in split_blocks(page)] == [0, *[1] * 6, 0]


@pytest.mark.parametrize("page, want", [
    ("<p>See <a href=/it's>this</a> and more.</p><p>End</p>", ["See this and more.", "End"]),
    ('<p>A <img alt="6" pipe"> wide</p><p>b</p>', ["A wide", "b"]),
    ('<p>A <a href="x>b</a> c</p><p>d</p>', ["A b c", "d"]),
    ("<p>A <a title='x>b</a> c</p><p>d</p>", ["A b c", "d"]),
    ("<p>A <a title=x'>b</a> c</p><p>it's</p>", ["A b c", "it's"]),
    ('<p>A <a title="1 > 0">b</a></p>', ["A b"]), ('<p class="a"id="b">c</p>', ["c"]),
    ("<p>1 < 2 and <3</p>", ["1 < 2 and <3"]), ("<p>a</ p>b<!x>c<?y>d</p>", ["abcd"]),
    ("<p =x>a</p><p x=>b</p><p/ y>c</p>", ["a", "b", "c"]), ("<p>a<!-->b<!--->c<!-- d -->e", ["abce"]),
    ("<script src=it's>x</script><p>a</p>", ["a"]), ("<title>x</titles></title><p>a", ["a"]),
    ('<p>a <a title="b', ['a <a title="b'])])
def test_tags_as_the_standard_reads_them(page, want):
    assert [b.text for b in split_blocks(page)] == want


@pytest.mark.parametrize("piece", ['<a title="', "<a title='", "<div>x", "</p>", "<!x", "<p", "<script>", "<!--", "</",
                                   '<a b="c" ', "<svg>", "<ul><li>", "<b>", "</x y='"])
def test_broken_pages_take_linear_time(piece):
    import time

    started = time.process_time()
    split_blocks("<div>" * 20_000 + "x" + "</p>" * 20_000)
    split_blocks(piece * (1_000_000 // len(piece)))
    assert time.process_time() - started < 20
