"""Main text of web pages: a linear-chain conditional random field over the leaf blocks of the DOM.

A page is read tag by tag, with the end tags that HTML lets authors leave out, into leaf blocks: runs of text between the
starts and ends of block elements. Scripts, styles, titles, comments and controls never give blocks. A block's features are its ancestors' tags and
the words of their classes, ids and roles, and shape of its text and of its neighbours' text; none is a word of the text. The field has two labels, main text
or not, a weight for each feature, and one for each pair of neighbouring labels. It is trained on labelled pages by the gradient of its
likelihood, and Viterbi's algorithm decodes the best sequence of labels of a page. The labelled pages are made here: TRAINING_PAGES pages of
invented words in many layouts, from a seed, so that the model is the same in every run. Tasks get it by broadcast; it has as many weights as
the training pages have features.

Pages are read whole, whatever their length. Null html is an empty page, and a page without blocks has an empty text. Every row is
read by itself: repeated rows give repeated results, an empty table none. Further columns stay; one that has the result's name is replaced.
"""

from __future__ import annotations

import html
import math
import random
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from helixframe.llm.common import read_table, small_batches

#: Labelled pages, seed and steps of the training; a smaller weight decay would fit the pages more closely.
TRAINING_PAGES, SEED, STEPS, RATE, DECAY = 900, 12, 220, 0.15, 2e-4

# Fixed values of HTML: elements that end a line of text, elements without content, elements whose content is not text of the page.
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("hr".split())
RAW = frozenset("audio canvas datalist iframe math noembed noframes noscript object script select style svg template textarea title video xmp".split())
#: An opening tag ends the nearest element of the first set, unless one of the second lies between.
_LIST, _TABLE = frozenset(("ul", "ol", "menu", "dir")), frozenset(("table",))
ENDS = {"li": ({"li"}, _LIST), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "td": ({"td", "th"}, _TABLE), "th": ({"td", "th"}, _TABLE), "tr": ({"tr"}, _TABLE)}
_P_STAYS_OPEN = frozenset(("body", "button", "caption", "dd", "dt", "head", "html", "label", "legend", "tbody", "td", "tfoot", "th", "thead", "tr"))
_P_SCOPE = frozenset(("button", "table", "td", "th", "caption"))

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z][-\w:]*)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:$|[\s=/])|display\s*:\s*none", re.I)


class Block:
    """A leaf block: its text, the characters of it in links, and its element."""

    __slots__ = ("text", "linked", "element")

    def __init__(self, text: str, linked: int, element: Element):
        self.text, self.linked, self.element = text, linked, element


class Element:
    __slots__ = ("tag", "parent", "names", "words", "linked")

    def __init__(self, tag: str, parent: Element | None, attributes: str):
        self.tag, self.parent, self.words, self.linked, self.names = tag, parent, 0, 0, ()
        if attributes and "=" in attributes or _HIDDEN.search(attributes):
            values = [" ".join(m.groups("")[1:]) for m in _ATTRIBUTE.finditer(attributes) if m[1].lower() in ("class", "id", "role", "itemprop")]
            self.names = tuple({x.lower() for value in values for x in _NAME.findall(value)}) + (("hidden",) if _HIDDEN.search(attributes) else ())

    def path(self) -> Iterator[Element]:
        at = self
        while at is not None:
            yield at
            at = at.parent


def leaf_blocks(page: str) -> tuple[list[Block], str]:
    """The page's leaf blocks that have text, in order, and its title."""
    blocks: list[Block] = []
    at, top, link, title, held, linked = 0, Element("html", None, ""), None, "", [], 0

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(held).split())
        if text:
            blocks.append(Block(text, linked, top))
            for element in top.path():
                element.words += text.count(" ") + 1
                element.linked += min(linked, len(text))
        held.clear()
        linked = 0

    def close(tags: frozenset | set, barriers: frozenset | set) -> None:
        """Ends the nearest element of these tags, and what is open inside it."""
        nonlocal top
        for element in top.path():
            if element.parent is None or element.tag in barriers:
                return
            if element.tag in tags:
                top = element.parent
                return

    def add(piece: str) -> None:
        nonlocal linked
        text = html.unescape(piece) if "&" in piece else piece
        held.append(text)
        if link is not None:
            linked += len(text.strip())

    length = len(page)
    while at < length:
        token = _TOKEN.search(page, at)
        if token is None:
            add(page[at:])
            break
        if token.start() > at:
            add(page[at : token.start()])
        at = token.end()
        ends, tag, attributes = token.group(1, 2, 3) if token[2] else token.group(4, 5, 6)
        if not tag:
            continue
        tag = tag.lower()
        if tag in RAW and not ends:
            close_tag = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I).search(page, at)
            if tag == "title" and not title:
                title = " ".join(html.unescape(page[at : close_tag.start() if close_tag else length]).split())
            at = close_tag.start() if close_tag else length
        elif tag == "a":
            link = None if ends else top
        elif tag == "br":
            held.append(" ")
        elif tag in BLOCKS:
            flush()
            if ends:
                close({tag}, _TABLE if tag not in _TABLE else frozenset())
            else:
                if tag not in _P_STAYS_OPEN:
                    close({"p"}, _P_SCOPE)
                if tag in ENDS:
                    close(*ENDS[tag])
                if tag not in VOID and tag not in ("html", "head", "body"):
                    top = Element(tag, top, attributes or "")
                elif tag == "body":
                    top.names = Element(tag, None, attributes or "").names
            if link is not None and link not in top.path():
                link = None
    flush()
    return blocks, title


def _level(share: float) -> int:
    return int(share * 4.999)


def _shape(block: Block) -> list[str]:
    """Features of a block's text that its neighbours also get."""
    text = block.text
    return [f"n{(text.count(' ') + 1).bit_length()}", f"l{_level(min(1.0, block.linked / len(text)))}", "stop" if text[-1] in ".!?…:;\"»”。！？" else "open"]


def block_features(blocks: list[Block], title: str) -> list[list[str]]:
    """Names of the features of each block."""
    shapes = [_shape(b) for b in blocks]
    paths: dict[int, list[str]] = {}
    total = max(1, sum(b.text.count(" ") + 1 for b in blocks))
    out = []
    for i, (block, shape) in enumerate(zip(blocks, shapes)):
        element = block.element
        if id(element) not in paths:
            line = list(element.path())
            names = {f"in {e.tag}" for e in line} | {f"is {x}" for e in line for x in e.names}
            around = line[1] if len(line) > 1 else element
            names |= {f"own {element.tag}", f"pair {element.tag} {around.tag}", f"share {_level(around.words / total)}", f"links {_level(around.linked / max(1, around.linked + 6 * around.words))}"}
            paths[id(element)] = [*names]
        text = block.text
        commas, digits = min(3, text.count(", ")), sum(map(str.isdigit, text[:200])) * 5 // max(1, len(text[:200]))
        found = ["all", *paths[id(element)], *shape, f"commas {commas}", f"digits {digits}", f"place {'first' if i == 0 else 'last' if i == len(blocks) - 1 else 'inner'}"]
        found += [f"before {x}" for x in (shapes[i - 1] if i else ("none",))] + [f"after {x}" for x in (shapes[i + 1] if i + 1 < len(blocks) else ("none",))]
        if text[0] == "©" or "©" in text[:80]:
            found.append("sign")
        if title and (text == title or len(title) > 8 and text.startswith(title)):
            found.append("title")
        out.append(found)
    return out


class Field:
    """A linear-chain conditional random field of two labels."""

    def __init__(self, weights: dict[str, float], pairs: list[list[float]], ends: list[list[float]]):
        self.weights, self.pairs, self.ends = weights, pairs, ends

    def decode(self, rows: list[list[str]]) -> list[int]:
        """The most probable labels of a sequence, by Viterbi's algorithm; label 1 is main text."""
        if not rows:
            return []
        get, pairs = self.weights.get, self.pairs
        best, back = None, []
        for row in rows:
            score = math.fsum(get(x, 0.0) for x in row)
            if best is None:
                best = [self.ends[0][0], self.ends[0][1] + score]
                continue
            come = [0 if best[0] + pairs[0][y] >= best[1] + pairs[1][y] else 1 for y in (0, 1)]
            best = [best[come[0]] + pairs[come[0]][0], best[come[1]] + pairs[come[1]][1] + score]
            back.append(come)
        label = 0 if best[0] + self.ends[1][0] >= best[1] + self.ends[1][1] else 1
        labels = [label]
        for come in reversed(back):
            label = come[label]
            labels.append(label)
        return labels[::-1]


def fit(pages: list[tuple[list[list[str]], list[int]]], steps: int = STEPS) -> Field:
    """Trains the field on pages (feature names and labels of their blocks) by the gradient of its log likelihood."""
    pages = sorted((p for p in pages if p[0]), key=lambda p: -len(p[0]))
    names = sorted({x for rows, _ in pages for row in rows for x in row})
    number = {x: i for i, x in enumerate(names)}
    # Blocks lie in columns by place, longest pages first, so that the pages that reach a place are the first ones.
    reach = [sum(len(p[0]) > t for p in pages) for t in range(len(pages[0][0]))]
    blocks = [(p, t) for t, n in enumerate(reach) for p in range(n)]
    cells = [(i, number[x]) for i, (p, t) in enumerate(blocks) for x in pages[p][0][t]]
    row, column = np.array(cells).T
    truth = np.array([pages[p][1][t] for p, t in blocks])
    begins = np.cumsum([0, *reach])
    n = len(names)
    theta = np.zeros(n + 8)  # weights, pairs of labels, first label, last label
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    seen = np.zeros(n + 8)
    seen[:n] = np.bincount(column, weights=truth[row], minlength=n)
    span = lambda t: slice(begins[t], begins[t + 1])
    for t in range(1, len(reach)):
        np.add.at(seen, n + 2 * truth[span(t - 1)][: reach[t]] + truth[span(t)], 1)
    lasts = np.array([begins[len(p[0]) - 1] + i for i, p in enumerate(pages)])
    seen[n + 4 : n + 6], seen[n + 6 :] = np.bincount(truth[span(0)], minlength=2), np.bincount(truth[lasts], minlength=2)

    for step in range(1, steps + 1):
        emit = np.zeros((len(blocks), 2))
        emit[:, 1] = np.bincount(row, weights=theta[column], minlength=len(blocks))
        emit[lasts] += theta[n + 6 :]
        pairs = theta[n : n + 4].reshape(2, 2)
        alpha, beta = np.zeros_like(emit), np.zeros_like(emit)
        alpha[span(0)] = emit[span(0)] + theta[n + 4 : n + 6]
        for t in range(1, len(reach)):
            alpha[span(t)] = np.logaddexp.reduce(alpha[span(t - 1)][: reach[t], :, None] + pairs, axis=1) + emit[span(t)]
        for t in range(len(reach) - 1, 0, -1):
            beta[span(t - 1)][: reach[t]] = np.logaddexp.reduce(pairs + (emit[span(t)] + beta[span(t)])[:, None, :], axis=2)
        whole = np.logaddexp.reduce(alpha[lasts], axis=1)
        page = np.concatenate([np.arange(k) for k in reach])
        share = np.exp(alpha + beta - whole[page, None])
        expected = np.zeros_like(theta)
        expected[:n] = np.bincount(column, weights=share[row, 1], minlength=n)
        for t in range(1, len(reach)):
            joint = np.exp(alpha[span(t - 1)][: reach[t], :, None] + pairs + (emit[span(t)] + beta[span(t)])[:, None, :] - whole[: reach[t], None, None])
            expected[n : n + 4] += joint.sum(0).ravel()
        expected[n + 4 : n + 6], expected[n + 6 :] = share[span(0)].sum(0), share[lasts].sum(0)
        slope = (seen - expected) / len(pages) - DECAY * theta
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        theta += RATE * (1 - step / (steps + 1)) * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    theta = np.round(theta, 6)
    return Field(dict(zip(names, theta[:n].tolist())), theta[n : n + 4].reshape(2, 2).tolist(), theta[n + 4 :].reshape(2, 2).tolist())


# Fixed values of the labelled pages: tags and names that layouts give to main text and to what stands around it.
MAIN_PLACES = "article|main|main article|section|div.content|div.post-content|div.entry-content|div.article-body|div.story|div#content|div#main|div#article|div.main-content|div.text|section.article|div.page-body|div.post|div.hentry|div.articleBody|table tr td.content|table tr td.main|div[role=main]|div.prose|div.markdown"
OTHER_PLACES = {
    "menu": "nav|ul.menu|div.nav|div#nav|div.navigation|ul#menu|div.breadcrumb|nav.breadcrumbs|div.navbar|div[role=navigation]|div.pagination|ul.tabs|div.toc|table tr td.menu|div.topbar",
    "header": "header|div.header|div#header|div.masthead|div.site-header|div.topbar|div[role=banner]|div.logo",
    "footer": "footer|div.footer|div#footer|div.site-footer|div.bottom|div.copyright|div[role=contentinfo]|div.legal|div.colophon",
    "side": "aside|div.sidebar|div#sidebar|aside.widget|div.related|div.recommended|div.widget|table tr td.sidebar|section.related|div.trending|div[role=complementary]|div.popular|div.more-stories",
    "notice": "div.cookie-banner|div.notice|div.alert|div#cookie-consent|div.gdpr|div.message|div[role=alert]|div[role=dialog]|div.modal|div.popup|div.warning|div.paywall|div.banner|dialog|div.overlay|div.toast|div.disclaimer|section.notice",
    "ad": "div.ad|div.ads|div.advert|div.advertisement|div.sponsored|div#ad-top|aside.promo|div.promo|div.banner-ad|ins.adsbygoogle|div.sponsor|section.ad|div.ad-slot",
    "form": "form|form.search|form.newsletter|div.newsletter|div.subscribe|form.login|div.search|fieldset|div.signup|form.contact|div[role=search]|form.comment-form",
    "comments": "div.comments|section.comments|div#comments|ol.comment-list|div.comment|section#comments|div.responses|ul.commentlist|div.disqus|div.replies|div.discussion|article.comment|div.reader-comments",
    "share": "div.share|ul.social|div.social-share|div.tags|div.meta|div.sharing|div.toolbar|div.tools",
}
NEUTRAL_PLACES = "div|div.container|div.wrapper|div.row|div.inner|section|div#page|div.col|div.grid|div#wrap|div.layout"
#: Marks of main text and of other text in a labelled page, of the private use area.
_MAIN, _OTHER = chr(0xE000), chr(0xE001)


def labelled_page(seed: int) -> str:
    """A page of invented words in which each text begins with a mark of its label."""
    rng = random.Random(f"page {seed}")
    letters = rng.choice(("abcdefghilmnoprstuv", "аеиоунтсрвлкмдпгзб", "aeiouéèäöüñszrtnl", "あいうえおかきくけこ日本語文字"))
    stems = ["".join(rng.choices(letters, k=rng.randint(1, 8))) for _ in range(80)]
    style = rng.random()

    def words(n: int) -> str:
        chosen = rng.choices(stems, k=n)
        if style < 0.08:  # menus, symbols and capitals occur as main texts too
            return " | ".join(chosen)
        if style < 0.14:
            return " ".join(x + rng.choice(("%%%", "###", "&amp;&amp;", "***")) for x in chosen)
        if style < 0.18:
            return " ".join(chosen).upper()
        return " ".join(x + ("," if rng.random() < 0.08 else "") + ("." if rng.random() < 0.08 else "") for x in chosen)

    sentence = lambda n: words(n).capitalize() + rng.choice((".", ".", ".", "", "!", "?"))

    def place(spec: str, inner: str) -> str:
        for one in reversed(spec.split(" ")):
            tag, kind, name = re.match(r"(\w+)([.#]|\[role=)?([^\]]*)", one).groups()
            key = {".": "class", "#": "id", "[role=": "role", None: ""}[kind]
            if kind == "." and rng.random() < 0.3:
                name = f"{rng.choice(('site', 'js', 'block', 'c', 'theme'))}-{name}" if rng.random() < 0.5 else f"{name}{rng.choice(('__inner', '-wrap', ' clearfix', '-area', '2'))}"
            inner = f"<{tag}{f' {key}={chr(34)}{name}{chr(34)}' if key else ''}>{inner}</{tag}>"
        return inner

    some = lambda specs: rng.choice(specs.split("|"))
    close_p = "</p>" if rng.random() < 0.85 else ""

    def main_block() -> str:
        kind, n = rng.random(), rng.choice((1, 2, 3, 5, 8, 20, 40, 60, 120))
        text = _MAIN + sentence(n)
        if rng.random() < 0.2:
            text += f' <a href="/x">{words(2)}</a> {words(2)}'
        if rng.random() < 0.1:
            text = f"<b>{text}"
        if kind < 0.66:
            return f"<p>{text}{close_p}"
        if kind < 0.72:
            return f"<div>{text}</div>" if rng.random() < 0.6 else f"{text}<br>"
        if kind < 0.79:
            return f"<h{rng.randint(2, 4)}>{_MAIN}{words(4)}</h{0}>".replace("</h0>", "</h2>")
        if kind < 0.86:
            return "<ul>" + "".join(f"<li>{_MAIN}{sentence(rng.choice((2, 5, 12)))}</li>" for _ in range(rng.randint(1, 4))) + "</ul>"
        if kind < 0.9:
            return f"<blockquote><p>{text}</p></blockquote>"
        if kind < 0.93:
            return f"<pre>{text}</pre>"
        if kind < 0.96:
            return f"<figure><img src='x.png'><figcaption>{_MAIN}{sentence(6)}</figcaption></figure>"
        return f"<table><tr><td>{_MAIN}{words(2)}</td><td>{_MAIN}{words(3)}</td></tr></table>"

    def other(kind: str) -> str:
        linked = lambda n: f'<a href="/y">{_OTHER}{words(n)}</a>'
        items = rng.randint(2, 8)
        if kind in ("menu", "share"):
            inner = "<ul>" + "".join(f"<li>{linked(rng.randint(1, 2))}</li>" for _ in range(items)) + "</ul>" if rng.random() < 0.7 else f" {rng.choice('|·/›')} ".join(linked(1) for _ in range(items))
        elif kind == "form":
            inner = f"<label>{_OTHER}{words(2)}</label><input name=q><button>{_OTHER}{words(1)}</button>" + (f"<p>{_OTHER}{sentence(rng.choice((6, 15, 30)))}</p>" if rng.random() < 0.6 else "")
        elif kind == "comments":
            one = lambda: f"<div{rng.choice(('', ' class=comment', ' class=reply'))}><span>{_OTHER}{words(2)}</span><p>{_OTHER}{sentence(rng.choice((3, 10, 30, 70)))}{close_p}</div>"
            inner = (f"<h3>{_OTHER}{words(2)}</h3>" if rng.random() < 0.6 else "") + "".join(one() for _ in range(rng.randint(1, 4)))
        elif kind == "side":
            inner = f"<h3>{_OTHER}{words(2)}</h3>" + ("<ul>" + "".join(f"<li>{linked(rng.randint(2, 8))}</li>" for _ in range(items)) + "</ul>" if rng.random() < 0.5 else f"<p>{_OTHER}{sentence(rng.choice((8, 20, 40)))}</p>")
        elif kind == "footer":
            inner = rng.choice(("", "<p>")) + f"{_OTHER}{rng.choice(('&copy; ', '© ', '', ''))}{words(2)} &middot; {sentence(rng.choice((3, 8, 20, 40)))}" + (linked(2) if rng.random() < 0.4 else "")
        elif kind == "header":
            inner = rng.choice((f"<h1>{linked(2)}</h1>", f"<p>{_OTHER}{words(5)}</p>", f"{_OTHER}{words(3)}", f"<div>{_OTHER}{sentence(10)}</div>"))
        else:
            inner = rng.choice((f"<p>{_OTHER}{sentence(rng.choice((4, 12, 25, 50)))}</p>", f"{_OTHER}{sentence(rng.choice((4, 9, 18, 40)))}", f"<p>{_OTHER}{sentence(6)}</p><a href=/z>{_OTHER}{words(1)}</a>"))
        inner += "<script>var a='<p>x</p>';</script>" if rng.random() < 0.1 else ""
        return place(some(OTHER_PLACES[kind]), inner)

    heading = words(rng.randint(3, 10))
    body = [f"<h1>{_MAIN}{heading}</h1>"] * (rng.random() < 0.8)
    if body and rng.random() < 0.15:
        body = [f"<header>{body[0]}</header>"]
    for _ in range(rng.choice((1, 1, 2, 3, 5, 8, 12))):
        body.append(main_block())
        if rng.random() < 0.1:
            body.append(other(rng.choice(("ad", "side", "notice", "form", "share"))))
    if rng.random() < 0.12:
        body.append(other("comments"))
    bare = rng.random() < 0.15  # nothing but text is in the page's body, or nothing but main text in the page
    main = "".join(body) if bare and rng.random() < 0.7 else place(some(MAIN_PLACES), "".join(body))
    for _ in range(rng.choice((0, 0, 1, 2))):
        main = place(some(NEUTRAL_PLACES), main)
    alone = bare and rng.random() < 0.5
    chance = lambda kind, p: [other(kind)] if not alone and rng.random() < p else []
    before = chance("notice", 0.35) + chance("header", 0.5) + chance("menu", 0.75) + chance("ad", 0.4) + chance("side", 0.2) + chance("form", 0.2)
    after = chance("share", 0.25) + chance("comments", 0.4) + chance("side", 0.35) + chance("form", 0.25) + chance("ad", 0.25) + chance("footer", 0.8) + chance("notice", 0.2)
    whole = "".join(before) + main + "".join(after)
    if rng.random() < 0.4:
        whole = place(some(NEUTRAL_PLACES), whole)
    return f"<!DOCTYPE html><html><head><title>{heading}</title><style>p{{}}</style></head><body>{whole}" + rng.choice(("</body></html>", ""))


def labelled_blocks(page: str) -> tuple[list[list[str]], list[int]]:
    """Features and labels of the blocks of a labelled page."""
    labels = [int(_MAIN in b.text) for b in leaf_blocks(page)[0]]
    blocks, title = leaf_blocks(page.replace(_MAIN, "").replace(_OTHER, ""))
    assert len(blocks) == len(labels)
    return block_features(blocks, title), labels


@lru_cache(maxsize=4)
def trained(pages: int = TRAINING_PAGES, seed: int = SEED) -> Field:
    """The field as fitted to so many labelled pages; fitted once a process."""
    return fit([labelled_blocks(labelled_page(seed * 1_000_000 + i)) for i in range(pages)])


def main_text(page: str | None, field: Field) -> str:
    """The blocks of main text, a line each."""
    blocks, title = leaf_blocks(page or "")
    return "\n".join(b.text for b, label in zip(blocks, field.decode(block_features(blocks, title))) if label)


def extracted(spark: SparkSession, page: Column, field: Field | None = None) -> Column:
    """The main text of a column of pages."""
    held = spark.sparkContext.broadcast(field or trained())

    @pandas_udf("string")
    def apply(pages: pd.Series) -> pd.Series:
        return pages.map(lambda x: main_text(x, held.value), na_action=None).astype(object)

    return apply(page)


def extract_main_text(pages: DataFrame, html_col: str = "html", out_col: str = "text", field: Field | None = None) -> DataFrame:
    """Adds the main text of each page."""
    small_batches(pages.sparkSession)
    return pages.withColumn(out_col, extracted(pages.sparkSession, F.coalesce(html_col, F.lit("")), field))


def op12_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_main_text(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


QUERIES = {"op12_html": op12_html}
ORACLES: dict[str, str] = {}
