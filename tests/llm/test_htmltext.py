import itertools
import math
import random

import pytest

from helixframe.llm import htmltext
from helixframe.llm.common import read_table

NEWS = """<html><head><title>The river | Daily</title><script>if (a<b) document.write("<p>no</p>")</script></head><body><div id="cookie-consent"><p>We use cookies. By continuing you agree.</p>
<button>Accept</button></div><header class="site-header"><a href="/">Daily</a><nav class="main-nav"><ul><li><a href="/w">World</a><li><a href="/s">Sport</a></ul></nav></header>
<div class="wrapper"><div class="post"><h1>The river rose</h1><p>The river &amp; the\n  lake rose four <b>metres</b> in a night.<p>Nobody was hurt.</p><div class="ad-slot">Buy our shoes now!</div>
<ul><li>First point</li><li>Second point</li></ul></div><aside class="sidebar"><h3>Most read</h3><ul><li><a href="/1">A long headline about something else</a></li></ul></aside>
<section id="comments"><h2>3 comments</h2><div class="comment"><p>I live there and it was a terrible night for everyone, really.</p></div></section></div>
<form class="newsletter"><label>Email</label><input><p>Sign up for our weekly letter, it is free.</p></form><footer><p>&copy; 2024 Daily. All rights reserved.</p></footer></body></html>"""


def plain_best(field, rows):
    """The best labels of all sequences of labels."""
    weight = [math.fsum(field.weights.get(x, 0.0) for x in r) for r in rows]

    def score(labels):
        total = field.ends[0][labels[0]] + field.ends[1][labels[-1]] + sum(w for w, y in zip(weight, labels) if y)
        return total + sum(field.pairs[a][b] for a, b in zip(labels, labels[1:]))

    return max(itertools.product((0, 1), repeat=len(rows)), key=score)


def test_viterbi_finds_the_best_sequence():
    rng = random.Random(1)
    names = [f"f{i}" for i in range(6)]
    for _ in range(100):
        draw = lambda: rng.uniform(-2, 2)
        field = htmltext.Field({n: draw() for n in names}, [[draw(), draw()], [draw(), draw()]], [[draw(), draw()], [draw(), draw()]])
        rows = [rng.sample([*names, "unknown"], 3) for _ in range(rng.randint(1, 8))]
        assert tuple(field.decode(rows)) == plain_best(field, rows)
    assert field.decode([]) == []


def test_training_climbs_the_likelihood():
    """Likelihood over all sequences of labels by enumeration: the fitted field beats each of its neighbours."""
    rng = random.Random(2)
    pages = [([[rng.choice("abc"), rng.choice("xy")] for _ in range(n)], [rng.randint(0, 1) for _ in range(n)]) for n in (1, 2, 3, 4, 4, 5)]

    def value(field):
        total = 0.0
        for rows, labels in pages:
            weight = [sum(field.weights.get(x, 0.0) for x in r) for r in rows]
            of = lambda y: field.ends[0][y[0]] + field.ends[1][y[-1]] + sum(w for w, a in zip(weight, y) if a) + sum(field.pairs[a][b] for a, b in zip(y, y[1:]))  # noqa: B023, E731
            total += of(labels) - math.log(sum(math.exp(of(y)) for y in itertools.product((0, 1), repeat=len(rows))))
        numbers = [*field.weights.values(), *itertools.chain(*field.pairs, *field.ends)]
        return total / len(pages) - htmltext.DECAY / 2 * sum(x * x for x in numbers)

    field = htmltext.fit(pages, steps=4000)
    best = value(field)
    for name in field.weights:
        for step in (-0.05, 0.05):
            assert value(htmltext.Field(field.weights | {name: field.weights[name] + step}, field.pairs, field.ends)) < best + 1e-5
    for i, j in itertools.product((0, 1), repeat=2):
        pairs = [row[:] for row in field.pairs]
        pairs[i][j] += 0.05
        assert value(htmltext.Field(field.weights, pairs, field.ends)) < best + 1e-5


def test_held_out_pages():
    field, right, whole, blocks = htmltext.trained(), 0, 0, 0
    for i in range(200):
        rows, labels = htmltext.labelled_blocks(htmltext.labelled_page(77_000_000 + i))
        found = field.decode(rows)
        right, blocks, whole = right + sum(a == b for a, b in zip(labels, found)), blocks + len(labels), whole + (labels == found)
    assert right / blocks > 0.98 and whole / 200 > 0.85


def test_pages_of_hand():
    text = lambda page: htmltext.main_text(page, htmltext.trained())
    assert text(NEWS) == "The river rose\nThe river & the lake rose four metres in a night.\nNobody was hurt.\nFirst point\nSecond point"
    assert text('<main><h1>Title</h1><p>Para one.<section><h2>Sub</h2><p>Para two has more words in it than one.</section></main><aside>Other</aside>') == "Title\nPara one.\nSub\nPara two has more words in it than one."
    assert text('<div class="header">Site</div><div class="menu"><a href=1>One</a> | <a href=2>Two</a></div><div class="content"><p>Kept text.</p><p>More kept text, with a <a href=3>link</a>.</p></div><div class="comments"><p>Thanks!</p></div>') == "Kept text.\nMore kept text, with a link."
    assert text(None) == text("") == text("<nav><a href=x>a</a></nav>") == text("<script>var a = '<p>b</p>'") == ""


@pytest.mark.parametrize(
    ("page", "blocks"),
    [
        ("<p>a<p>b<div>c</p>d</div>e", ["a", "b", "c", "d", "e"]),
        ("<ul><li>a<ul><li>b</ul><li>c</ul>", ["a", "b", "c"]),
        ("a<b>b</b>c<!-- <p> -->d<br>e", ["abcd e"]),
        ("<p title='<p>x</p>'>a</p>b", ["a", "b"]),
        ("a &lt;p&gt; &nbsp;\t b &am; &copy", ["a <p> b &am; ©"]),
        ("1 < 2<p>x<", ["1 < 2", "x<"]),
        ("<style>p{}</style>a<textarea><p>x</textarea>b<SCRIPT>y</SCRIPT >c", ["abc"]),
        ("<p>x<a href='", ["x"]),
        ("<table><tr><td>a<td>b<tr><td>c</table>d", ["a", "b", "c", "d"]),
        ("", []),
    ],
)
def test_leaf_blocks(page, blocks):
    assert [b.text for b in htmltext.leaf_blocks(page)[0]] == blocks


def test_links_and_paths():
    blocks, title = htmltext.leaf_blocks("<title>T &amp; U</title><div class='sideBar x'><p>a <a href=#>bcd</a></p></div><section hidden><p>z")
    assert title == "T & U" and blocks[0].linked == 3 and [e.tag for e in blocks[0].element.path()] == ["p", "div", "html"]
    assert set(blocks[0].element.parent.names) == {"side", "bar", "x"} and blocks[1].element.parent.names == ("hidden",)


def test_table_of_pages(spark):
    long = "<article>" + "<p>Rain fell all night, and nobody slept.</p>" * 30_000 + "</article><footer>x</footer>"
    rows = [(1, NEWS), (1, NEWS), (2, None), (3, ""), (4, long), (5, "<" * 5000), (6, "<div>" * 3000 + "deep")]
    pages = spark.createDataFrame([(i, x, "old", "u") for i, x in rows], "page_id long, html string, text string, url string").repartition(3)
    got = sorted((r["page_id"], r["text"]) for r in htmltext.extract_main_text(pages).collect())
    field = htmltext.trained()
    assert got == sorted((i, htmltext.main_text(x, field)) for i, x in rows)
    assert dict(got)[4].count("\n") == 29_999 and dict(got)[2] == dict(got)[3] == ""
    assert htmltext.extract_main_text(pages.limit(0)).count() == 0


def test_query_takes_the_articles_of_the_given_pages(spark):
    folder = "/root/testdata/sf0.01"
    pages = {r["page_id"]: r["html"] for r in read_table(spark, folder, "pages").collect()}
    got = {r["page_id"]: r for r in htmltext.QUERIES["op12_html"](spark, folder).collect()}
    assert got.keys() == pages.keys()
    for key, page in pages.items():
        inner = page[page.index("<article>") : page.index("</article>")]
        assert got[key]["text"] == "\n".join(b.text for b in htmltext.leaf_blocks(inner)[0]) and got[key]["n_chars"] == len(got[key]["text"])
