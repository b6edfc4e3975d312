from __future__ import annotations

import random

import pytest

from changecapture.llm.html_text import KEPT, codes, extract, hints, host_of, names, read

SCHEMA = "page_id long, url string, html string, text int, host string"


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, u, h, 1, "x") for i, u, h in rows], SCHEMA)
    got = extract(df, **options)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    got = got.collect()
    assert all(r.n_chars == len(r.text) for r in got)
    return {(r.page_id, r.url): r.text for r in got}


PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{{}}</style>
<script>var t="</p><article>x</article>";</script></head><body class="no-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav><!-- ad <p>x</p> -->
<div class="ad-box">Buy</div><div class=cookie-notice><p>We use cookies</div>
<article><h1>Title&#33;</h1><p>One <b>bo</b>ld&nbsp;&amp; two<br>three
  four<p hidden>no</p><p>five &lt;tag&gt;<form><input value="a>b">Search</form>
<aside>Related</aside><div class="comments"><p>First!</p></div>{}</article>
<section id="sidebar">Side</section><footer>&copy; us</footer></body></html>"""


def test_structure(spark):
    got = run(spark, [(1, "http://a.b/c", PAGE.format("<p>end")), (2, "u", PAGE.format("")[:-40])])
    assert got[1, "http://a.b/c"] == "Title! One bold & two three four five <tag> end"
    assert got[2, "u"] == "Title! One bold & two three four five <tag>"


@pytest.mark.parametrize(
    "source, text",
    [
        (None, ""), ("", ""), ("plain text", "plain text"), ("<article></article>", ""),
        ("<main>a<p>b</main><p>c", "a b"), ("<article>a < b > c", "a < b > c"),
        ("<article><p title='x>y\"z'>q</p><!-- open", "q"), ("<p>one<p>two <i>in</i>side", "one two inside"),
        ("<article>a&#x1F600;&eacute;&nbsp; &bogus; b</article>", "a😀é &bogus; b"),
        ("<ARTICLE>Big<SCRIPT>x</SCRIPT>ger</ARTICLE>", "Bigger"), ("<article><p class='x>y", "y"),
        ("<div role='main'>m</div><div>n</div>", "m"), ("<article>a<svg><text>b</text></svg>c</article>", "ac"),
        ("<article>x<textarea><p>no</textarea><span class='ad'>ad <span>in</span></span> y</article>", "x y"),
    ],
)
def test_sources(spark, source, text):
    assert run(spark, [(1, "http://h/", source)]) == {(1, "http://h/"): text}


@pytest.mark.parametrize(
    "source, text",
    [
        ("<main class='content has-sidebar'><p>a</main>", "a"), ("<main class='sidebar'><p>a</main>", "a"),
        ("<div class='container no-sidebar'><article>a</article></div>b", "a"),
        ("<div class='sidebar'><article>a</article></div>b", "a"),
        ("<article class='post related-topic-2'>a</article>", "a"), ("<article class='promo'>a</article>b", "a"),
        ("<article><p class='notice-of-motion'>a</p><div class='share-price-table'>b</div></article>", "a b"),
        ("<article>a<article class='comment'>no</article></article>", "a"),
        ("<article>a<ol class='comment-list'><li><article>no</article></ol></article>", "a"),
        ("<article>a<ul><li class=ad><p>no</p><p>no</p></li><li>b</ul></article>", "a b"),
        ("<article>a<p class=ad>no<p>b<h2 id=related-posts>no</h2><div id=comment-12>no</div></article>", "a b"),
        ("<div class=related><article>no</article></div><main>a</main>", "a"),
        ("<div class='ad-box'>no</div><p>a</p>", "a"), ("<div class='promo'><p>a</p></div><nav>no</nav>", "a"),
        ("<div class='promo'><p hidden>no</p><form>no</form></div>", ""), ("<nav><article>no</article></nav>", ""),
        ("<article><span class='sub-ad'>a</span> <span id='ads'>no</span></article>", "a"),
    ],
)
def test_hints(spark, source, text):
    assert run(spark, [(1, "http://h/", source)]) == {(1, "http://h/"): text}


def test_names_of_hints():
    assert all(map(hints, "ad ad-box site-footer comment-list comment-12 cookie_notice left-sidebar".split()))
    assert not any(map(hints, "has-sidebar top-bar post notice-of-motion share-price-table shadow 12".split()))


def test_built_pages_against_brute_force(spark):
    """Pages whose parts are known as they are built; hosts repeat their unmarked frames."""
    rng = random.Random(5)
    words = lambda n: " ".join(rng.choice("abcdefghij") * rng.randint(1, 3) for _ in range(n))
    gone = ["<nav>{}</nav>", "<aside>{}</aside>", "<div class='x ad-box'>{}</div>", "<footer>{}</footer>",
            "<script>{}</script>", "<!-- {} -->", "<section id=comments><article>{}</article></section>"]
    rows, wanted, opened = [], {}, {}
    for host in range(4):
        frames = [words(12) for _ in range(3)]
        for i in range(12):
            key, url = host * 100 + i, f"http://h{host}.org/{i}"
            source, streams = "", []
            if rng.random() < 0.5:
                own = [words(rng.randint(1, 30)) for _ in range(rng.randint(1, 5))]
                inside = "".join(f"<p>{w}</p>" + rng.choice(gone).format(words(4)) for w in own)
                box = rng.choice(["article", "main", "div role=main", "main class='has-sidebar'"])
                source = f"<div class=no-sidebar><{box}>{inside}</{box.split()[0]}></div>"
                wanted[key] = " ".join(own)
            for part in rng.sample(frames, 2) + [words(rng.randint(1, 20))]:
                source += f"<p>{part}</p>"
                streams += ["\0", *part.split()]
            rows.append((key, url, source))
            opened[key] = host, streams
    for key, (host, tokens) in opened.items():
        if key in wanted:
            continue
        others = {
            tuple(t[i : i + 5]) for k, (h, t) in opened.items() if h == host and k != key for i in range(len(t) - 4)
        }
        hit = [i for i in range(len(tokens) - 4) if tuple(tokens[i : i + 5]) in others]
        covered = {j for i in hit for j in range(i, i + 5)}
        wanted[key] = " ".join(t for i, t in enumerate(tokens) if t != "\0" and i not in covered)
    assert {k: v for (k, _), v in run(spark, rows, min_tokens=5).items()} == wanted


def brute(pages, length):
    """Open pages by host: words covered by a string of tokens on two distinct pages go."""
    streams = {}
    for key, url, source in pages:
        tokens, owner = [], []
        for i, (zone, path, words) in enumerate(read(source).blocks):
            if zone != KEPT:
                tokens += ["\0" + path, *words]
                owner += [None, *[i] * len(words)]
        streams[key] = host_of(url), tokens, owner
    out = {}
    for key, (host, tokens, owner) in streams.items():
        others = {
            tuple(t[i : i + length])
            for k, (h, t, _) in streams.items()
            if h == host and k != key
            for i in range(len(t) - length + 1)
        }
        gone = set()
        for i in range(len(tokens) - length + 1):
            if tuple(tokens[i : i + length]) in others:
                gone.update(range(i, i + length))
        out[key] = " ".join(t for i, t in enumerate(tokens) if owner[i] is not None and i not in gone)
    return out


def test_repetitions_of_a_host(spark):
    menu = "<div>Home News Sport Weather Contact us now</div>"
    foot = "<div>All rights reserved by the owners of this site since long ago</div>"
    pages = []
    for i in range(6):
        body = f"<p>own words number {i} that no other page of this host has at all {i}</p>"
        pages.append((i, f"https://www.site{i % 2}.org/{i}", f"{menu}{body}{foot}<p>tail {i}</p>"))
    pages.append((10, "https://alone.org/", menu + foot))
    got = run(spark, pages, min_tokens=5)
    assert {k: v for (k, _), v in got.items()} == brute(pages, 5)
    assert got[10, "https://alone.org/"].startswith("Home News") and "Home" not in got[0, pages[0][1]]


def test_nulls_repeated_rows_and_hot_hosts(spark):
    rows = [(None, None, "<p>one two three</p>"), (1, None, None), (2, "http://h/", "<p>same row</p>")]
    rows += [(2, "http://h/", "<p>same row</p>")]
    rows += [(100 + i, "http://hot/", f"<div>the very same menu on all pages</div><p>page {i}</p>") for i in range(300)]
    got = run(spark, rows, min_tokens=4)
    assert got[None, None] == "one two three" and got[1, None] == "" and got[2, "http://h/"] == "same row"
    assert {got[100 + i, "http://hot/"] for i in range(300)} == {str(i) for i in range(300)}


def test_empty_table(spark):
    assert run(spark, []) == {}


def test_hosts_and_names():
    assert host_of("https://www.A.org:80/x") == "a.org" and host_of("//u@b.c?q") == "b.c"
    assert host_of("nonsense") == "" and host_of(None) == ""
    tokens = codes("a b c a b c a".split())
    assert names(tokens, 3)[0] == names(tokens, 3)[3] != names(tokens, 3)[1]
    assert len(names(tokens, 8)) == 0 and len(set(names(tokens, 5).tolist())) == 3
