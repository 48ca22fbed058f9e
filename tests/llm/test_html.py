"""Main text: structure, references, and repeated substrings against a plain search."""

import random

import pytest

from churnlens.llm import html as H
from churnlens.llm.html import extract


def texts(spark, rows, ddl="page_id long, url string, html string"):
    return {r.page_id: r.text for r in extract(spark.createDataFrame(rows, ddl)).collect()}


def test_structure(spark):
    page = (
        "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a='</p><article>';</script></head><body>"
        "<nav><ul><li>Menu</li></ul></nav><header><h1>Site</h1></header><aside>side</aside><div class='cookie-notice'>we use</div>"
        "<article class='post'><h1>Head &amp; more</h1><p>One\n  two<br>three &lt;b&gt; &#x41;&eacute;<p><b>Four</b><em>five</em> 1 < 2"
        "<!-- gone <p> --><div class=\"ad box\">buy<p>now</div><form><p>mail</form><ul><li>a<li>b</ul>"
        "<section id=comments><p>nice</section><pre>x   y</pre></article><footer>foot</footer></body></html>"
    )
    got = texts(spark, [(1, "http://h/", page)])
    assert got[1] == "Head & more\n\nOne two three <b> Aé\n\nFourfive 1 < 2\n\na\n\nb\n\nx y"


@pytest.mark.parametrize("page, want", [
    (None, ""), ("", ""), ("<nav>only</nav>", ""), ("<article></article>", ""), ("<article>a<!-- never ends", "a"),
    ("<article><p>a<script>b</article>", "a"), ("<main><p>m</p></main><p>x</p>", "m"), ("<article>a</div></b> c</article>", "a c"),
    ("<article><p title=\"a>b\">q</p></article>", "q"), ("plain words", "plain words"), ("<ARTICLE>A<P>B</ARTICLE>", "A\n\nB"),
    ("<article>" + "<p>" * 3000 + "deep</article>", "deep"),
])
def test_edges(spark, page, want):
    whole, main, body = H.blocks(page or "")
    assert "\n\n".join(whole or main or body) == want


@pytest.mark.parametrize("tag", ["article", "main", "p"])
@pytest.mark.parametrize("attributes", [
    'style="overflow:hidden"', 'title="the hidden valley"', 'data-hidden="false"', 'data-id="share-12"', "data-role='menu'",
    'title="class=ad id=menu"', "title='role=\"navigation\" hidden'", 'aria-hidden="false"', "data-class=comment", "x-id = comments",
    'title = "a hidden b" lang=en', "href=/a?id=share&amp;role=menu", 'class="post" class="comment"', '"hidden"',
])
def test_words_in_other_attributes_stay(tag, attributes):
    """Only whole attribute names count, not what stands in other names and values."""
    whole, main, body = H.blocks(f"<{tag} {attributes}>stays</{tag}>")
    assert (whole or main or body) == ["stays"]


@pytest.mark.parametrize("attributes", [
    "hidden", "HIDDEN=''", 'title="a b" hidden', "role=Navigation", "role = 'menu' lang=en", "aria-hidden=true", 'class="big Comment"',
    "title='x'id=comments", "data-x class=reply",
])
def test_unwanted_attributes(attributes):
    for tag in ("article", "main", "p"):
        assert H.blocks(f"<{tag} {attributes}>goes</{tag}>") == ([], [], [])


def plain(pages, long):
    """Coverage by all repeats of ``long`` tokens in two pages, by search."""
    words = [[w for b in p for w in b.split()] for p in pages]
    seen = {}
    for i, ws in enumerate(words):
        for k in range(len(ws) - long + 1):
            seen.setdefault(tuple(ws[k : k + long]), set()).add(i)
    out = []
    for ws in words:
        stays = [True] * len(ws)
        for k in range(len(ws) - long + 1):
            if len(seen[tuple(ws[k : k + long])]) > 1:
                stays[k : k + long] = [False] * long
        out.append([w for w, s in zip(ws, stays) if s])
    return out


def test_host_suffix_array(spark, monkeypatch):
    """Pages without an article: what a host repeats goes, in whichever shard it stands."""
    monkeypatch.setattr(H, "SHARD_PAGES", 4)
    rnd = random.Random(3)
    word = lambda: rnd.choice("abcdefghij") * rnd.randint(1, 3)
    line = lambda n: " ".join(word() for _ in range(n))
    menu, foot = [line(8), line(9)], [line(15)]
    pages = [[*menu, line(30), *( [line(25)] if i % 3 else []), *foot] for i in range(20)]
    pages[7] = list(pages[3])
    rows = [(i, f"https://H{i % 2}.org/x", "".join(f"<div>{b}</div>" for b in p)) for i, p in enumerate(pages)]
    got = texts(spark, rows)
    for host in (0, 1):
        own = list(range(host, 20, 2))
        want = plain([pages[i] for i in own], H.LONG)
        for i, ws in zip(own, want):
            assert got[i].split() == ws
    assert got[3] == "" == got[7]


def test_the_array_reads_what_stands_around_articles(spark, monkeypatch):
    """Menus that most pages of a host carry outside of their articles go from its page
    without an article; an article stays whole, and so does what few pages quote."""
    monkeypatch.setattr(H, "SHARD_PAGES", 2)
    menu, quoted = " ".join(f"m{i}" for i in range(14)), " ".join(f"q{i}" for i in range(14))
    around = [f"<nav><p>{menu}</p></nav>", f"<div class='masthead'>{menu}</div>", f"<p>{menu}</p>", f"<aside>{quoted}</aside><footer>{menu}</footer>"]
    rows = [(i, "http://a/x", f"{x}<article><p>own {i}</p><p>{menu}</p></article>") for i, x in enumerate(around)]
    rows += [(9, "http://A/y", f"<div>{menu}</div><div>{quoted}</div>"), (10, "http://b/", f"<div>{menu}</div>"), (11, "http://c/", f"<nav>{menu}</nav><div>{menu}</div>")]
    seen = []
    monkeypatch.setattr(H, "staged", lambda df, name, f=H.staged: seen.append((name, f(df, name))) or seen[-1][1])
    got = texts(spark, rows)
    assert got == {i: f"own {i}\n\n{menu}" for i in range(4)} | {9: quoted, 10: menu, 11: menu}
    counts = dict(seen)["substrings"].where("host = 'a'").groupBy("h").agg({"own": "sum", "named": "sum"}).collect()
    assert max(r["sum(named)"] for r in counts) == 4 and max(r["sum(own)"] for r in counts) == 1


@pytest.mark.parametrize("page, want", [
    ("<nav>a <b>b</b></nav><article>x</article><p>c</p>", ["a", "b", "c"]), ("<main>x</main>y<footer>&amp; z</footer>", ["& z", "y"]),
    ("<nav>a</nav><p>x</p>", ["a"]), ("<div hidden>a</div><div class=comments>b</div><script>c</script><article>x</article>", []),
    ("<div class='share-buttons'><a href=x>Tweet</a></div><article>x</article>", ["Tweet"]), ("", []),
])
def test_text_around(page, want):
    gone = []
    kept = H.blocks(page, gone)
    assert gone == want and kept == H.blocks(page)


def test_long_tokens_dont_widen_the_others():
    tokens = ["x" * 1_000_000, *[f"t{i % 7}" for i in range(20_000)]]
    import numpy as np

    assert H.suffix_ranks(tokens, np.zeros(len(tokens), dtype=np.int64)).max() > 0


def test_suffix_ranks_are_the_suffix_order():
    rnd = random.Random(1)
    import numpy as np

    tokens = [rnd.choice("ab") for _ in range(200)]
    page = np.repeat(np.arange(4), 50)
    rank = H.suffix_ranks(tokens, page)
    at = [i for i in range(200) if rank[i] >= 0]
    assert at == [i for i in range(200) if i % 50 <= 50 - H.LONG]
    assert sorted(at, key=lambda i: (rank[i], i)) == sorted(at, key=lambda i: (tokens[i : i + H.LONG], i))


def test_tables(spark):
    rows = [(1, "http://a/", "<article>x</article>", 1), (1, "http://a/", "<article>x</article>", 1), (None, None, None, 2)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    assert sorted((r.page_id or 0, r.url, r.text or "") for r in extract(df).collect()) == [(0, None, ""), (1, "http://a/", "x"), (1, "http://a/", "x")]
    assert extract(df.limit(0)).count() == 0


PROSE = "The harbour was quiet in the morning and the boats came in one after another. " * 2


def text_of(page):
    article, main, body = H.blocks(page)
    return " | ".join(article or main or body)


@pytest.mark.parametrize("page, want", [
    ('<div class="content with-sidebar"><article><p>one</p></article><div class="sidebar">x</div></div>', "one"),
    ("<form id=aspnetForm><div><article><p>one</p><p>two</p></article></div></form>", "one | two"),
    ('<article><p>one</p><section class="share-price"><p>The price rose.</p></section></article>', "one | The price rose."),
    ('<article><h2>one</h2><section id="related-work"><p>Others found this too.</p></section></article>', "one | Others found this too."),
    ("<header>Site</header><article><header><h1>Title</h1><nav>a b</nav></header><p>one</p></article>", "Title | one"),
    ('<article><p>one</p><div style="color:red; display : none">x</div><p style="visibility:hidden">y</p></article>', "one"),
    ("<article><p>one</p><article><p>Great post!</p></article></article>", "one"),
    ("<article><article><p>one</p></article></article>", "one"),
    ('<div id="comments"><article><p>Great post!</p></article></div><main><p>one</p></main>', "one"),
    ('<aside><article><p>teaser</p></article></aside><article><p>one</p></article>', "one"),
    ('<article><p>one</p><div class="share-buttons"><a href=x>Tweet</a> <a href=y>Post</a></div></article>', "one"),
    ('<article><p>one</p><div class="newsletter-signup">Get our news.</div><div class="comment-list"><p>%s</p></div></article>' % PROSE, "one"),
    ('<article><p>one</p><section id="discussion"><p>We see that.</p></section></article>', "one | We see that."),
    ('<article class="has-sidebar"><p title="the hidden valley" style="overflow:hidden" data-hidden="false">one</p></article>', "one"),
    ('<div class="layout has-ads"><p>%s</p></div>' % (PROSE * 4), (PROSE * 4).strip()),
    ("<div hidden><article><p>x</p></article></div><p>one</p>", "one"),
    ("<article><p>one<section class=related-links><a>x</a>", "one"),
])
def test_articles_survive(page, want):
    """What holds the article, or is only named like boilerplate, stays; what is hidden,
    said by readers or made of links goes."""
    assert text_of(page) == want


def test_long_page():
    page = "<nav>menu</nav><article>" + "<p>word &amp; word</p>" * 100_000 + "</article>"
    article, _, _ = H.blocks(page)
    assert len(article) == 100_000 and set(article) == {"word & word"}
