import html as entities
import random
import re
from collections import defaultdict

import plain
import pytest

from dimspark.llm import html

SCHEMA = "page_id long, url string, html string"


def text_of(page):
    return html.main_text(page)


@pytest.mark.parametrize(
    "page, text",
    [
        ("<article><h1>T</h1><p>a <b>b<br>c<p>d &amp e&nbsp;f &#x41;&am</article>", "T\na b c\nd & e f A&am"),
        ("<header>Top</header><main><header><h1>T</h1></header><p>x</p></main><footer>f</footer>", "T\nx"),
        ("<article>a<script>var t='</p>';</script> b<style>p{}</style><!-- <p> --> c</article>", "a b c"),
        ("<article>x<div class='comments'><p>bad</p></div><aside>s</aside><form>f</form><p>y", "x\ny"),
        ("<article><ul><li>a<li>b</ul><table><tr><td>1<td>2</table><pre> k\n l</pre></article>", "a\nb\n1\n2\nk l"),
        ("<article>a<div class='ad'>buy</div><div hidden>h</div><div style='display:none'>n</div>b</article>", "a\nb"),
        ("<article class=comment>c</article><article>d</article>", "d"),
        ("<article><p title='a>b'>q</p><p data=it's>r</p>1 < 2</article>", "q\nr\n1 < 2"),
        ("<article>t &lt;p&gt; &copy;<svg><title>no</title></svg><noscript>no</noscript></article>", "t <p> ©"),
        ("<div id=comments><article>c</article></div><main>m</main>", "m"),
        ("<div class=header>no</div><article><div class='article-header'><h1>T</h1></div><p>x</p><div class=footer>f</div>", "T\nx"),
        ("<article></article>", None),
        ("", None),
        ("<p>no main</p>", None),
    ],
)
def test_blocks_of_the_main_part(page, text):
    assert text_of(page) == text


def test_query_table_against_a_plain_reading(spark):
    """In the given pages the main text is the article's headings and paragraphs."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = {r["page_id"]: r for r in html.extract(pages).collect()}
    rows = pages.collect()
    assert len(found) == len(rows)
    for r in rows:
        article = re.search(r"(?s)<article>(.*?)(</article>|$)", r["html"])[1].replace("<br>", " ")
        parts = re.split(r"</?(?:p|h1)>", article)
        clean = [" ".join(entities.unescape(re.sub("<[^>]*>", "", p)).split()) for p in parts]
        got = found[r["page_id"]]
        assert got["text"] == "\n".join(c for c in clean if c)
        assert got["n_chars"] == len(got["text"]) and got["url"] == r["url"]


def expected_open(pages, run):
    """Open text less the runs that another page of the host, with other text outside its main part, has too."""
    read = [(host, html._streams(page or "")) for host, page in pages]
    holders = defaultdict(set)
    for host, (_, tokens, _, digest) in read:
        for at in range(len(tokens) - run + 1):
            holders[host, tuple(tokens[at : at + run])].add(digest)
    texts = []
    for (host, (has_main, tokens, places, _)), (_, page) in zip(read, pages):
        if has_main:
            texts.append(html.main_text(page))
            continue
        covered = {
            at + k for at in range(len(tokens) - run + 1) if len(holders[host, tuple(tokens[at : at + run])]) > 1 for k in range(run)
        }
        blocks = {}
        for i, (token, place) in enumerate(zip(tokens, places)):
            if place >= 0 and i not in covered:
                blocks.setdefault(place, []).append(token)
        texts.append("\n".join(" ".join(b) for b in blocks.values()))
    return texts


def test_repeated_runs_of_a_host_go_and_unique_runs_stay(spark):
    rng = random.Random(3)
    notice = "we use small files to keep this site running for everyone who reads it"
    pages = []
    for i in range(60):
        words = " ".join(f"u{rng.randrange(10_000)}" for _ in range(30))
        middle = f"{words} {notice} t{i}" if i % 3 == 0 else words
        body = f"<div>{notice}</div><p>{middle}</p><div>contact us at the old mill on the river road {i}</div>"
        body = f"<article>{body}</article><div>{notice} m</div>" if i % 10 == 9 else body
        pages.append(("hot.example" if i % 3 else f"h{i % 2}.example", body))
    pages += [("one.example", f"<p>{notice}</p>"), ("copy.example", "<p>a b c d e f g h i</p>"), ("copy.example", "<p>a b c d e f g h i</p>")]
    pages += [("copy.example", None), ("copy.example", ""), ("copy.example", f"<p>{plain.LONG}</p>")]
    df = spark.createDataFrame([(i, f"http://{h}/x", p) for i, (h, p) in enumerate(pages)], SCHEMA).repartition(5)
    found = {r["page_id"]: r["text"] for r in html.extract(df).collect()}
    assert [found[i] for i in range(len(pages))] == expected_open(pages, html.RUN)
    assert notice not in found[0] and found[len(pages) - 5] == "a b c d e f g h i" == found[len(pages) - 4]


def test_nulls_repeats_and_empty_tables(spark):
    rows = [(1, None, None), (1, None, None), (None, "x", "<p>t</p>"), (2, "http://a/b", "<article>z</article>")]
    df = spark.createDataFrame([(*r, "x", "x") for r in rows], SCHEMA + ", text string, host string")
    found = sorted((str(r["page_id"]), r["text"], r["n_chars"]) for r in html.extract(df).collect())
    assert found == [("1", "", 0), ("1", "", 0), ("2", "z", 1), ("None", "t", 1)]
    assert html.extract(df.limit(0)).count() == 0


def texts_of(spark, pages):
    """The texts of (url, html) rows."""
    df = spark.createDataFrame([(i, u, p) for i, (u, p) in enumerate(pages)], SCHEMA).repartition(3)
    found = {r["page_id"]: r["text"] for r in html.extract(df).collect()}
    return [found[i] for i in range(len(pages))]


def test_versions_quotes_and_pages_without_a_host_keep_their_text(spark):
    story = " ".join(f"w{i}" for i in range(100))
    versions = [("http://v.example/a", f"<p>{story}</p>"), ("http://v.example/b", f"<p>{story} updated</p>")]
    versions += [("http://v.example/c", f"<p>{story.replace(f'w{i}', 'other')}</p>") for i in (20, 50, 80)]
    rng = random.Random(4)
    bodies = [" ".join(f"u{rng.randrange(10_000)}" for _ in range(30)) for _ in range(12)]
    notice = "this site is run by the people of the old mill"
    news = [("http://q.example/", f"<p>{b}</p><p>{notice}</p><p>all rights are reserved by us</p>") for b in bodies]
    quote = " ".join(bodies[0].split()[5:20])
    news.append(("http://q.example/", f"<p>he wrote {quote} yesterday</p><p>{notice}</p>"))
    unnamed = [(u, f"<p>{b} {story}</p>") for b, u in zip(bodies, [None, "a/b", None, "c", "://x"])]
    found = texts_of(spark, versions + news + unnamed)
    assert found[:5] == [p[3:-4] for _, p in versions]
    assert found[5:18] == [*bodies, f"he wrote {quote} yesterday"]
    assert found[18:] == [p[3:-4] for _, p in unnamed]


def test_repeats_judge_main_blocks_and_open_bodies_stay(spark):
    rng = random.Random(6)
    bodies = [" ".join(f"u{rng.randrange(10_000)}" for _ in range(40)) for _ in range(30)]
    notice = "<div>this site is run by the people of the old mill</div>"
    inside = [("http://in.example/", f"<article>{notice}<p>{b}</p></article>") for b in bodies[:10]]
    cards = [("http://cards.example/", f"{notice}<main><h1>t{i}</h1></main><div>{b}</div>") for i, b in enumerate(bodies[10:20])]
    shared = f"<article><p>{bodies[29]}</p><p>{{}}</p></article>"
    few = [("http://few.example/", shared.format(b) if i < 3 else f"<article><p>{b}</p></article>") for i, b in enumerate(bodies[20:29])]
    found = texts_of(spark, inside + cards + few)
    assert found[:10] == bodies[:10]
    assert found[10:20] == [f"t{i}\n{b}" for i, b in enumerate(bodies[10:20])]
    assert found[20:] == [f"{bodies[29]}\n{b}" if i < 3 else b for i, b in enumerate(bodies[20:29])]


BODY = "the old mill on the river was sold to the people who had run it for years"


@pytest.mark.parametrize(
    "page, text",
    [
        ('<div class="layout has-sidebar"><article><p>{}</p></article></div>', "{}"),
        ('<div id="page" class="content-sidebar"><article><p>{}</p></article></div>', "{}"),
        ('<div class="with-fixed-header"><main><p>{}</p></main></div>', "{}"),
        ("<form action=/x><div><article><p>{}</p></article></div><input name=q></form>", "{}"),
        ('<div class="sidebar"><main><p>{}</p></main></div><footer>f</footer>', "{}"),
        ('<article><p class="share-price">{}</p><div class="related-to-topic">x y</div></article>', "{}\nx y"),
        ('<article><p>{}</p><div class="related-posts">other</div><form><p>search</p></form></article>', "{}"),
        ('<div class="site-header">top</div><div class="cookie-banner">c</div><main>{}</main>', "{}"),
        ("<main><p>{}</p></main><div class=related><article>a card</article><article>another</article></div>", "{}"),
        ("<main><p>m</p></main><div id=comments>" + "<article>a long answer of a reader</article>" * 9 + "</div>", "m"),
    ],
)
def test_names_cut_no_article_and_no_frame(page, text):
    assert text_of(page.format(BODY)) == text.format(BODY)


def test_a_form_around_a_page_without_a_main_element_is_a_frame(spark):
    page = f"<form><div>{BODY}</div></form><div class=footer>f</div>"
    assert texts_of(spark, [("http://a.example/", page)]) == [BODY]
    assert html.blocks("<div>x y z a b c</div><form>search here</form>") == [("open", "x y z a b c"), ("cut", "search here")]


@pytest.mark.parametrize("page", ["<b>" * 150_000 + "</i>" * 150_000, "<p><b>" * 100_000, "<div>" * 150_000 + "x", "<p><button>" + "<b>" * 50_000 + "<div></div>" * 50_000, "<nav>" * 100_000 + "</p>" * 50_000, "<article>" * 60_000 + "x"])
def test_long_pages_of_open_elements_take_linear_time(page):
    import time

    began = time.perf_counter()
    html.blocks(page)
    assert time.perf_counter() - began < 5
