"""Template deduction against plain occurrence vectors, extraction against expected texts."""

import random
from collections import Counter, defaultdict

import pytest

from millrace.llm import html_text as ht

COLUMNS = "page_id long, url string, html string, host string, text string, class string"


def page(rng, n, broken=False, extra=""):
    items = "".join(f'<li><a href="/{rng.random()}">{rng.choice("xyz")}</a></li>' for _ in range(rng.randint(1, 4)))
    body = "".join(f"<p>Part {rng.randint(0, 10**9)} &amp; more<br>of   it" for _ in range(rng.randint(1, 5)))
    ad = '<div class="box ad">Buy %d' % n + ("" if broken else "</div>")
    return (f"<!DOCTYPE html><html><head><title>T {n}</title><style>p{{}}</style></head><body><nav><ul>{items}</ul></nav>{ad}"
            f"<div class=story><h1>Head {n}</h1>{extra}{body}</div><footer>&copy; Site {n}</footer>")


def wanted(html):
    story = html.split("<div class=story>")[1].split("</div>")[0]
    blocks = story.replace("<h1>", "<p>").replace("</h1>", "").replace("<br>", " ").replace("&amp;", "&").split("<p>")
    return "\n\n".join(" ".join(b.split()) for b in blocks if b.strip())


def frame(spark, rows):
    return spark.createDataFrame([(i, u, h, "other", "t", "c") for i, u, h in rows], COLUMNS)


def site(seed, n, host="a.example"):
    rng = random.Random(seed)
    return [(i, f"https://{host}/{i}?x", page(rng, i)) for i in range(n)]


def brute_classes(rows, min_share, min_tokens):
    """Classes by whole occurrence vectors."""
    counts = [Counter(ht.page_tokens(h or "")) for _, _, h in rows]
    vectors = defaultdict(list)
    for token in set().union(*counts):
        vector = tuple(c[token] for c in counts)
        if sum(v > 0 for v in vector) >= max(ht.MIN_PAGES, min_share * len(rows)):
            vectors[vector].append(token)
    return sorted(sorted(v) for v in vectors.values() if len(v) >= min_tokens)


def test_classes_equal_whole_vectors(spark):
    rows = site(1, 40) + site(1, 40)[:7]
    got = ht.equivalence_classes(frame(spark, rows).repartition(6)).collect()
    assert sorted(sorted(r["tokens"]) for r in got) == brute_classes(rows, ht.MIN_SHARE, ht.MIN_TOKENS)
    assert {(r["host"], r["n_pages"]) for r in got} == {("a.example", 47)}


def test_template_is_nested(spark):
    rows = site(2, 30)
    found = {tuple(r["tokens"]): r for r in ht.deduce_templates(frame(spark, rows)).collect()}
    outer = next(t for t in found if "html/body<nav" in t)
    inner = next(t for t in found if "html/body/nav/ul<li" in t)
    assert inner == ("html/body/nav/ul<li", "html/body/nav/ul/li<a", "html/body/nav/ul/li/a", "html/body/nav/ul/li")
    assert found[inner]["parent"] == found[outer]["class"] and found[outer]["parent"] is None
    assert outer[found[inner]["gap"] - 1] == "html/body/nav<ul" and outer[found[inner]["gap"]] == "html/body/nav/ul"


def test_invalid_classes_go(spark):
    """Tokens that come equally often, but in changing order or across each other, are no template."""
    rows = [(i, "http://h/", f"<div><x{'' if i % 2 else '1'}></div><y></y><z></z><w></w>"
             + 2 * ("<k></k><l></l><m></m>" if i % 2 else "<m></m><l></l><k></k>")) for i in range(8)]
    tokens = {t for r in ht.deduce_templates(frame(spark, rows)).collect() for t in r["tokens"]}
    assert {"<div", "/div", "<y", "/w"} <= tokens and not tokens & {f"{k}{t}" for t in "klm" for k in "</"}
    assert list(ht.page_signatures("<a1></a1><b1></b1><a1></a1>", [["<a1", "<b1"], ["/a1"]])) == [(0, -1, "!"), (1, -1, "0")]
    crossed = dict(((c, d), g) for c, d, g in ht.page_signatures(
        "<ra><rb><rc><rd>", [["<ra", "ra/rb<rc"], ["ra/rb/rc<rd", "ra<rb"]]))
    assert crossed[0, -1] == "0,1" and crossed[1, -1] == "1,0" and crossed[0, 1] == crossed[1, 0] == "!"


def test_texts_on_and_off_templates(spark):
    rng = random.Random(4)
    rows = site(3, 40) + site(5, 2, "two.example")  # two pages make no template
    rows += [(200 + i, "https://a.example/b", page(rng, i, broken=True)) for i in range(5)]
    rows += [rows[0], (300, None, "<p>a<p>b"), (301, "x", None), (302, "https://a.example/", ""), (None, "http://n/", "text"),
             (303, "https://long.example/", "<article>" + "<p>word &amp; word" * 50_000 + "</article><p>no")]
    got = {(r["page_id"], r["url"]): r for r in ht.main_texts(frame(spark, rows)).collect()}
    assert ht.main_texts(frame(spark, rows)).count() == len(rows)
    for i, u, h in rows:
        r = got[i, u]
        if h and "story" in h:
            assert r["text"] == wanted(h), (i, u)
        assert r["n_chars"] == len(r["text"])
    assert got[300, None]["text"] == "a\n\nb" and got[301, "x"]["text"] == got[302, "https://a.example/"]["text"] == ""
    assert got[None, "http://n/"]["text"] == "text"
    assert got[303, "https://long.example/"]["text"] == "\n\n".join(["word & word"] * 50_000)
    assert ht.main_texts(frame(spark, rows).limit(0)).collect() == []


@pytest.mark.parametrize("n,kept", [(9, True), (30, False)])
def test_template_text(spark, n, kept):
    """A line on every page of a large host is template; on a small host, or on some pages, it is text."""
    rng = random.Random(6)
    rows = [(i, "http://h.example/", page(rng, i, extra="<p>Share this page" + ("<p>Often" if i % 2 else ""))) for i in range(n)]
    texts = [r["text"] for r in ht.main_texts(frame(spark, rows)).sort("page_id").collect()]
    assert [("Share this page" in t, "Often" in t) for t in texts] == [(kept, i % 2 == 1) for i in range(n)]


@pytest.mark.parametrize("html,text", [
    ("<article><h1>A</h1><p>b <b>c<br>d</b><script>var x='<p>no';</script> e</p><aside>no</aside><p>&lt;f&gt;&nbsp;g&am", "A\n\nb c d e\n\n<f> g&am"),
    ("<body class=has-sidebar><header>no</header><main><header><h1>T</h1></header><p>x</main><div id=comments><article>no", "T\n\nx"),
    ("<div class='cookie-notice'>no<p>no</p></div>yes<form>no<p>no</form><ul><li>one<li>two</ul>", "yes\n\none\n\ntwo"),
    ("<div class=ad>no<article><p>yes</article>", "yes"),
    ("a < b & c <!-- <p>no --> d <![CDATA[no]]> e<p title=\"x>y\" data-z='<'>f</p", "a < b & c d e\n\nf"),
    ("<nav>no", ""), ("<title>no</title>", ""), ("<p>  \n </p>", ""), ("<head><title>no</title><p>yes", "yes"),
    ("<table><tr><td>1<td>2<tr><td>3</table>\t4", "1\n\n2\n\n3\n\n4"),
    ("<p class=x\"y>q</p><a href=\"unclosed>r</a>s", "q\n\nrs"),
])
def test_single_pages(html, text):
    assert ht.extract(html) == text
