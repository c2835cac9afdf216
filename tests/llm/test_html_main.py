"""Main text on the whole table against the marked article, and on pages of other shapes."""
import re
from html import unescape

from finmesh.llm import html_main as H
from finmesh.llm.common import table
from tests.conftest import SF01

PATTERNS = H.compiled()


def test_best_run_is_the_best():
    import random
    rng = random.Random(1)
    for _ in range(200):
        scores = [rng.randrange(-5, 5) for _ in range(rng.randrange(0, 15))]
        start, end = H.best_run(scores)
        best = max([0] + [sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)])
        assert sum(scores[start:end]) == best


def test_marked_articles(spark):
    pages = table(spark, SF01, "pages")
    got = {r.page_id: r for r in H.extract(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        blocks = [" ".join(unescape(re.sub(r"</?b>", "", x).replace("<br>", " ")).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        want = "\n".join(b for b in blocks if b)
        assert (got[r.page_id].text, got[r.page_id].n_chars, got[r.page_id].url) == (want, len(want), r.url)


def test_other_shapes(spark):
    weights = H.learn(table(spark, SF01, "pages"))
    page = """<html><head><title>t</title></head><body class="has-sidebar"><div id="top-menu"><ul><li><a href=1>Home</a><li><a href=2>News</a></ul></div>
      <div id=content><h1>Title here</h1><div class='ad-box'>Buy now cheap pills!</div><p>This is the first paragraph, with&nbsp;words &lt;and&gt; signs.
      <p>Second <a href="x>y">link text</a> here &amp; there.<!-- <p>no</p> --><script>var a = "</p><p>no";</script><form><p>Your mail</p></form>
      <table><tr><td>a</td><td>b</td></tr></table><section class="comments"><p>Nice post, I agree with all of this very much.</p></section></div>
      <aside><p>Related things to read right now.</p></aside><footer>Copyright us</footer></body></html>"""
    assert H.main_text(page, weights, PATTERNS) == "Title here\nThis is the first paragraph, with words <and> signs.\nSecond link text here & there.\na b"


def test_odd_pages(spark):
    html = [None, "", "  ", "just text &amp; more", "<p>a<script>cut off", "<p>a <b", "<nav>menu only</nav>", "</div></p>x", "<p>" * 3000 + "deep" + "</p>" * 10, "<div>" * 3000 + "deep",
            "<!-- open", "word " * 200_000, "<a title='" + "x" * 100_000]
    rows = [(i, None, h) for i, h in enumerate(html)] + [(None, "u", "null id"), (3, None, html[3])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted(((-1 if r.page_id is None else r.page_id), r.text, r.n_chars) for r in H.extract(df).collect())
    texts = {i: t for i, t, _ in got}
    assert len(got) == len(rows) and all(len(t) == n for _, t, n in got)
    assert [texts[i] for i in (0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, -1)] == ["", "", "", "just text & more", "a", "a", "", "x", "deep", "deep", "", "null id"]
    assert len(texts[11]) == 200_000 * 5 - 1
    assert H.extract(df.limit(0)).collect() == []


def test_raw_tags_end_at_their_name():
    for inner, want in (('<svg class="i"/>', "one two\nthree four"), ("<svg/>", "one two\nthree four"), ('<svg-icon name="x"></svg-icon>', "one two\nthree four"),
                        ("<title-bar>bar</title-bar>", "one two\nbar\nthree four"), ("<template-card>card</template-card>", "one two\ncard\nthree four"),
                        ('<svg viewBox="0 0 1 1"><title>no</title></svg>', "one two\nthree four"), ("<SCRIPT>no</SCRIPT >", "one two\nthree four")):
        for page in (f"<article><p>one two</p>{inner}<p>three four</p></article>", f"{inner}<article><p>one two</p><p>three four</p></article>"):
            assert H.main_text(page, H.DEFAULT, PATTERNS) == (want if page.startswith("<article>") else "one two\nthree four"), page
    assert H.main_text('<article><p>one <svg class="i"/> two</p></article>', H.DEFAULT, PATTERNS) == "one two"


def test_one_word_of_an_id_or_class_removes_nothing():
    def text(tag, marks, around=("<article><p>one two three</p>", "</article>")):
        return H.main_text(f"{around[0]}<{tag} {marks}>Four five six.</{tag}>{around[1]}", H.DEFAULT, PATTERNS)

    bare = ("<div><p>one two three</p>", "</div>")
    for name in ("sharing-data", "related-work", "social-history", "advertising-law", "search-methods", "legal-basis", "comment-on-smith-2001", "how-to-share"):
        for tag, mark in (("h2", "id"), ("section", "id"), ("div", "id"), ("section", "class")):
            assert text(tag, f'{mark}="{name}"') == "one two three\nFour five six.", (tag, mark, name)
    for name in ("sharing-data", "related-work", "social-history", "advertising-law", "search-methods", "legal-basis"):
        assert text("section", f'id="{name}"', bare) == "one two three\nFour five six.", name
    for marks in ('id="comments"', 'id="menu"', 'id="sharing"'):
        assert text("h2", marks) == text("h3", marks, bare) == "one two three\nFour five six.", marks
    for marks in ('data-id="share"', 'class="has-sidebar"', 'class="post-header"'):
        assert text("div", marks) == text("div", marks, bare) == "one two three\nFour five six.", marks
    for name in ("ad", "ads", "related-posts", "share-buttons", "relatedPosts", "js-share", "comments", "entry comments-list", "top-menu", "ad-300x250",
                 "cookie-notice", "newsletter-signup-form", "share__buttons--large", "search-box", "sidebar"):
        for mark in ("id", "class"):
            assert text("div", f'{mark}="{name}"') == text("div", f'{mark}="{name}"', bare) == "one two three", name
    for name in ("cookie-law-info-bar", "menu-home", "footer-address"):
        assert text("div", f'class="{name}"', bare) == "one two three", name


def test_many_open_and_stray_tags_take_linear_time():
    n = 60_000
    page = "<div>" * n + "deep words here" + "</span></section></nav>" * n + "</div>" * n + "<p>end"
    assert H.main_text(page, H.DEFAULT, PATTERNS) == "deep words here"
    stray = "<div>one two three four five</b></section>" * n
    assert H.main_text(stray, H.DEFAULT, PATTERNS).count("\n") in (n - 1, 0)


def test_the_run_decides_and_its_element_completes_it():
    teaser, story = "<div><p>read this other thing now</p></div>", "<div><h1>Head</h1><p>one two three four five six seven eight</p></div>"
    for page in (teaser + story, story + teaser):      # neither is marked: the run says which of the two it is
        assert H.main_text(page, H.DEFAULT, PATTERNS) == "Head\none two three four five six seven eight"
    ad = "<div class='ad'><p>" + "buy cheap pills " * 30 + "</p></div>"
    page = f"<div><p>one two three four five six seven</p>{ad}<p>eight nine ten eleven twelve</p></div>{teaser}"
    tokens, holders = H.tokens_of(page, PATTERNS)
    start, end = H.best_run(H.scores_of(tokens, H.DEFAULT))
    assert [t for k, t, _ in tokens[start:end] if k == "plain"] == ["one two three four five six seven"]      # the scan alone stops at the advert
    assert H.main_text(page, H.DEFAULT, PATTERNS) == "one two three four five six seven\neight nine ten eleven twelve"


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "u", "<p>some words here</p>", "x", 3)], "page_id long, url string, html string, text string, n_chars int")
    (r,) = H.extract(df).collect()
    assert r.asDict() == {"page_id": 1, "url": "u", "text": "some words here", "n_chars": 15}


def test_sparse_labels_are_all_used(spark):
    plain, marked = "<p>some words</p>", "<nav>menu</nav><article><p>one two three</p></article>"
    df = spark.createDataFrame([(i, marked if i % 250 == 0 else plain) for i in range(1000)], "page_id long, html string")
    assert H.learn(df, pages=4) == H.learn(df.where("page_id % 250 = 0")) != H.DEFAULT
