"""Main text of web pages by a tree-structured graphical model.

A page becomes a tree of its block elements.  Every node has a hidden label
(content or boilerplate) and observed features of its own; parent-child
potentials connect the labels.  Sum-product messages, upward and then
downward, give each node's exact marginal.  The parameters are smoothed counts
from labelled pages.  Blocks whose node is content with a probability above
one half are the main text.
"""

from __future__ import annotations

import html as html_lib
import math
import random
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element classes of HTML.
RAW = {"script", "style", "noscript", "template", "iframe", "textarea", "title", "svg", "xmp", "noframes", "noembed"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {"html", "body", "div", "section", "article", "main", "header", "footer", "nav", "aside", "p", "h1", "h2", "h3",
         "h4", "h5", "h6", "ul", "ol", "li", "dl", "dt", "dd", "table", "thead", "tbody", "tfoot", "tr", "td", "th",
         "caption", "blockquote", "pre", "form", "fieldset", "figure", "figcaption", "address", "details", "summary",
         "dialog", "menu", "head", "hgroup", "legend", "center", "button", "select", "option", "label", "search"}
CLOSES_P = BLOCK - {"html", "body", "head", "button", "select", "option", "label", "tr", "td", "th", "thead", "tbody",
                    "tfoot", "caption", "legend"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: What a start tag closes, and the elements beyond which it looks no further.
IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
           "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
           "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
           "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
           "option": ({"option"}, {"select"}), "body": ({"head"}, {"html"})}
P_SCOPE = {"table", "td", "th", "button", "caption", "html"}

_TOKEN = re.compile(r"""<!--.*?(?:-->|$)|<![^>]*(?:>|$)|<\?[^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?>[^"'>]|"[^"]*"|'[^']*'|["'])*+)(>|$)""", re.S)
_ATTR = re.compile(r"""\b(class|id|role|aria-label|itemprop|style|aria-hidden|type)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)|\b(hidden)\b(?!\s*=)""", re.I)
_WORDS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>]|$)[^>]*(?:>|$)", re.I) for t in RAW}


class Node:
    __slots__ = ("tag", "parent", "names", "words", "link_words", "sentences")

    def __init__(self, tag: str, parent: int, names: tuple[str, ...]) -> None:
        self.tag, self.parent, self.names = tag, parent, names
        self.words = self.link_words = self.sentences = 0


HIDDEN = "!hidden"


def _names(attrs: str) -> tuple[str, ...]:
    """The distinct words of the class, id, role and label attributes, and
    ``HIDDEN`` for an element that is not shown."""
    found = set()
    for m in _ATTR.finditer(attrs):
        if m[3]:
            found.add(HIDDEN)
            continue
        name, value = m[1].lower(), m[2].strip("\"'")
        if name == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                found.add(HIDDEN)
        elif name == "aria-hidden":
            if value.lower() == "true":
                found.add(HIDDEN)
        elif name != "type":
            found.update(_WORDS.findall(_CAMEL.sub(" ", value).lower()))
    return tuple(sorted(found))


def parse(page: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """Block nodes in page order (parents first) and the text segments
    (node, text) between block boundaries, character references decoded.

    Tags that a page leaves open or cut off are closed as HTML closes them: a
    block start ends an open paragraph, a list item the item before, the end
    of the page everything."""
    nodes = [Node("html", -1, ())]
    stack: list[tuple[str, int]] = [("html", 0)]      # open elements: tag, block node
    segments: list[tuple[int, str]] = []
    pending: list[str] = []                           # text of the segment being read
    links = 0                                         # open <a> elements
    pending_links = 0

    def flush() -> None:
        nonlocal pending, pending_links
        if pending:
            text = " ".join("".join(pending).split())
            if text:
                node = stack[-1][1]
                n = nodes[node]
                segments.append((node, text))
                k = text.count(" ") + 1
                n.words += k
                n.link_words += min(k, pending_links)
                n.sentences += len(re.findall(r"[.!?](?:\s|$)", text))
            pending, pending_links = [], 0

    def close(at: int) -> None:
        nonlocal links
        flush()
        for t, _ in stack[at:]:
            links -= t == "a"
        del stack[at:]

    def add_text(raw: str) -> None:
        nonlocal pending_links
        text = html_lib.unescape(raw) if "&" in raw else raw
        pending.append(text)
        if links:
            pending_links += len(text.split())

    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        if m is None:
            add_text(page[at:])
            break
        if m.start() > at:
            add_text(page[at:m.start()])
        at = m.end()
        tag = m[2]
        if not tag or not m[4]:                       # comment, declaration, or a tag the page's end cut off
            continue
        tag = tag.lower()
        if tag == "html":                             # the root node stands for it
            continue
        if m[1]:
            if tag == "br" or tag == "p" and not any(t == "p" for t, _ in stack):
                pending.append(" ")
                continue
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag or tag in HEADINGS and stack[i][0] in HEADINGS:
                    if tag in BLOCK:
                        close(i)
                    else:                             # inline: only this element ends
                        if any(t in BLOCK for t, _ in stack[i + 1:]):
                            break
                        links -= tag == "a"
                        del stack[i]
                    break
            continue
        if tag in RAW:
            if tag not in ("svg",) or not m[3].rstrip().endswith("/"):
                stop = _RAW_END[tag].search(page, at)
                at = stop.end() if stop else end
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            elif tag in ("br", "img"):
                pending.append(" ")
            continue
        if tag in CLOSES_P:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == "p":
                    close(i)
                    break
                if stack[i][0] in P_SCOPE:
                    break
        if tag in IMPLIED:
            ends, scope = IMPLIED[tag]
            lowest = 0
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in scope:
                    break
                if stack[i][0] in ends:
                    lowest = i
            if lowest:
                close(lowest)
        if tag in BLOCK:
            flush()
            nodes.append(Node(tag, stack[-1][1], _names(m[3]) if m[3] else ()))
            stack.append((tag, len(nodes) - 1))
        else:
            links += tag == "a"
            stack.append((tag, stack[-1][1]))
    flush()
    return nodes, segments


#: Elements that hold the whole article; words in their attributes tell of the
#: article (its tags, whether comments are open), not of a part of the page.
HOLDERS = {"article", "main", "body", "html"}


def _places(nodes: list[Node], words: list[int]) -> list[str]:
    """Where each node is: inside the page's article or main element, in another
    one, outside of them, or on a page without any.  Of several such elements
    those with at least half of the longest one's words are the page's; one that
    is not shown is not.  If the longest holds less than a quarter of the page's
    words (teasers, comments), the page counts as one without."""
    top: list[int] = []                               # outermost article or main element, -1 for none
    for i, n in enumerate(nodes):
        above = top[n.parent] if n.parent >= 0 else -1
        top.append(above if above >= 0 else i if n.tag in ("article", "main") and HIDDEN not in n.names else -1)
    longest = max((words[i] for i, t in enumerate(top) if t == i), default=-1)
    if longest < 0 or 4 * longest < words[0]:
        return ["unknown"] * len(nodes)
    return ["outside" if t < 0 else "inside" if 2 * words[t] >= longest else "other" for t in top]


def features(nodes: list[Node]) -> list[tuple[tuple, ...]]:
    """Discrete features of each node: element with its share of link words,
    length with sentence ends, place, and every word of its attributes as a
    feature of its own."""
    words, link_words = [n.words for n in nodes], [n.link_words for n in nodes]
    for i in range(len(nodes) - 1, 0, -1):            # sums over the subtree
        words[nodes[i].parent] += words[i]
        link_words[nodes[i].parent] += link_words[i]
    out = []
    for n, place, w, links in zip(nodes, _places(nodes, words), words, link_words):
        density = "no text" if not w else ("low", "some", "high")[(links * 4 > w) + (links * 4 > 3 * w)]
        size = "none" if not n.words else "short" if n.words < 5 else "middle" if n.words < 25 else "long"
        tag = "h" if n.tag in HEADINGS else n.tag
        kind = "holder" if n.tag in HOLDERS else "element"
        out.append((("links", tag, density), ("size", size, n.sentences > 0), ("place", tag, place if place != "unknown" else density),
                    *[("word", kind, x) for x in n.names or ("",)]))
    return out


class Model:
    """Log potentials: root, parent-child, and each feature by label.  A word of
    an attribute that no labelled page holds says nothing."""

    def __init__(self, pages: list[tuple[list[Node], list[int]]], smooth: float = 0.2, smooth_word: float = 1.0) -> None:
        root, pair, feature, total, kinds = Counter(), Counter(), Counter(), Counter(), Counter()
        seen: dict[str, set] = {}
        for nodes, labels in pages:
            for n, y, fs in zip(nodes, labels, features(nodes)):
                if n.parent < 0:
                    root[y] += 1
                else:
                    pair[labels[n.parent], y] += 1
                total[y] += 1
                kinds[fs[-1][1], y] += 1
                for f in fs:
                    feature[f, y] += 1
                    seen.setdefault(f[0], set()).add(f)
        self.root = [math.log((root[y] + smooth) / (sum(root.values()) + 2 * smooth)) for y in (0, 1)]
        self.pair = [[math.log((pair[x, y] + smooth) / (pair[x, 0] + pair[x, 1] + 2 * smooth)) for y in (0, 1)] for x in (0, 1)]
        # one value each of the first features, any number of words of the last
        self.feature = {f: [math.log((feature[f, y] + smooth) / (total[y] + smooth * len(fs))) for y in (0, 1)]
                        for name, fs in seen.items() if name != "word" for f in fs}
        self.feature |= {f: [math.log((feature[f, y] + smooth_word) / (kinds[f[1], y] + 2 * smooth_word)) for y in (0, 1)]
                         for f in seen.get("word", ())}

    def marginals(self, nodes: list[Node]) -> list[float]:
        """Probability that each node is content: sum-product on the tree."""
        known, none = self.feature, [0.0, 0.0]
        belief = []                                   # local potential, then times the messages from below
        for fs in features(nodes):
            scores = [known.get(f, none) for f in fs]
            belief.append([sum(s[0] for s in scores), sum(s[1] for s in scores)])
        (p00, p01), (p10, p11) = self.pair
        up = [none] * len(nodes)
        for i in range(len(nodes) - 1, 0, -1):        # upward: children come after their parents
            b0, b1 = belief[i]
            up[i] = m = (_sum(p00 + b0, p01 + b1), _sum(p10 + b0, p11 + b1))
            parent = belief[nodes[i].parent]
            parent[0] += m[0]
            parent[1] += m[1]
        belief[0][0] += self.root[0]
        belief[0][1] += self.root[1]
        for i in range(1, len(nodes)):                # downward: belief of the parent without this child
            parent = belief[nodes[i].parent]
            r0, r1 = parent[0] - up[i][0], parent[1] - up[i][1]
            belief[i][0] += _sum(r0 + p00, r1 + p10)
            belief[i][1] += _sum(r0 + p01, r1 + p11)
            top = max(belief[i])                      # only the difference matters
            belief[i][0] -= top
            belief[i][1] -= top
        return [1 / (1 + math.exp(min(700.0, b[0] - b[1]))) for b in belief]


def _sum(a: float, b: float) -> float:
    return a + math.log1p(math.exp(b - a)) if a > b else b + math.log1p(math.exp(a - b))


# Labelled pages -------------------------------------------------------------

_SYLLABLES = "ka lo mi ren tu sal vor ent ing der la que ous ton bre fi sha nd or ist".split()


def _words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice(_SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n))


def _prose(rng: random.Random) -> str:
    return " ".join(_words(rng, rng.randint(4, 18)).capitalize() + rng.choice(".....!?") for _ in range(rng.randint(1, 6)))


def _short(rng: random.Random) -> str:
    """Content that is no sentence: headlines, tables, marks, cut ends."""
    return rng.choice([_words(rng, rng.randint(1, 8)), _words(rng, rng.randint(1, 60)),
                       _words(rng, 12).replace(" ", " | "), _words(rng, 9).replace(" ", "*** "), _words(rng, 2).upper() + "!!"])


#: Words of class and id attributes on the labelled pages.
PARTS = ("nav", "navbar", "menu", "header", "footer", "sidebar", "ad", "ads", "advert", "banner", "sponsored", "promo",
         "cookie", "consent", "notice", "alert", "popup", "modal", "newsletter", "subscribe", "signup", "login", "comment",
         "comments", "respond", "reply", "share", "social", "related", "recommended", "breadcrumb", "pagination", "search",
         "toolbar", "copyright", "form")
EITHER = ("message", "widget", "tags", "warning", "feedback", "legal", "topic", "toc", "page", "box", "panel", "block", "row",
          "col", "wrap", "inner", "container", "section", "item", "list", "text", "title", "summary", "body", "module", "card")
OF_ARTICLES = ("post", "entry", "article", "content", "main", "story", "hentry", "type", "status", "publish", "format",
               "standard", "category", "has", "thumbnail", "single", "full", "width", "articlebody", "prose")
OF_CONTENT = ("lead", "intro", "paragraph", "highlight", "quote", "caption", "figure", "entry", "content", "text", "story",
              "article", "dropcap", "code", "table", "note")


def _article_names(rng: random.Random) -> str:
    """Attributes of the element that holds an article, as content systems write
    them: what it is, its tags and categories, what is switched on."""
    words = [rng.choice(OF_ARTICLES) for _ in range(rng.randint(1, 4))]
    about = lambda: rng.choice(PARTS + EITHER)
    words += [f'{rng.choice(["tag", "tags", "category", "has", "no", "with"])}-{about()}' for _ in range(rng.randint(0, 3))]
    words += [f'{about()}-{rng.choice(["open", "closed", "on", "off", "enabled"])}'] * (rng.random() < 0.4)
    rng.shuffle(words)
    return f' class="{" ".join(words)}"' + (f' id="post-{rng.randint(1, 999)}"' if rng.random() < 0.3 else "")


def _block_names(rng: random.Random) -> str:
    """Attributes of a content block: mostly none."""
    if rng.random() < 0.7:
        return ""
    return f' class="{" ".join(rng.choice(OF_CONTENT + EITHER) for _ in range(rng.randint(1, 2)))}"'


def _other(rng: random.Random) -> str:
    """A part beside the article whose names may also stand on content."""
    names = " ".join([rng.choice(EITHER), *([rng.choice(PARTS)] if rng.random() < 0.5 else [])])
    inner = rng.choice([f"<p>{_prose(rng)}</p>", f"<h4>{_words(rng, 2)}</h4><ul><li><a href='/'>{_words(rng, 3)}</a></li></ul>",
                        f"<span>{_words(rng, 5)}</span>"])
    return f'<{(t := rng.choice(["div", "section", "aside"]))} class="{names}" y0>{inner}</{t}>'


def labelled_page(rng: random.Random) -> str:
    """One training page: layouts of article pages put together by rule.  An
    element with the attribute ``y1`` is content, one with ``y0`` boilerplate;
    others have the label of their parent."""
    def links(n):
        return "".join(f'<li><a href="/{i}">{_words(rng, rng.randint(1, 3))}</a></li>' for i in range(n))

    def some(*parts):
        return "".join(p for p in parts if rng.random() < 0.55)

    nav = rng.choice([f"<nav y0><ul>{links(rng.randint(2, 9))}</ul></nav>",
                      f'<div class="{rng.choice(["menu", "navbar", "top-nav", "breadcrumb"])}" y0><ul>{links(5)}</ul></div>',
                      f"<ul y0>{links(rng.randint(3, 8))}</ul>"])
    header = f'<header y0><{rng.choice(["p", "div", "h2"])}>{_words(rng, 4)}</{"p"}><p>{_words(rng, 6)}</p></header>'
    ad = f'<div class="{rng.choice(["ad", "ads banner", "advert", "promo", "sponsored"])}" y0>{rng.choice([_prose(rng), _words(rng, 5)])}</div>'
    notice = f'<div class="{rng.choice(["cookie-notice", "cookie banner", "notice", "alert", "newsletter"])}" y0><p>{_prose(rng)}</p><button>{_words(rng, 1)}</button></div>'
    aside = rng.choice([f"<aside y0><h3>{_words(rng, 2)}</h3><p>{_prose(rng)}</p><ul>{links(4)}</ul></aside>",
                        f'<div id="sidebar" y0><h4>{_words(rng, 2)}</h4><ul>{links(4)}</ul><p>{_prose(rng)}</p></div>'])
    form = f'<form y0><label>{_words(rng, 2)}</label><input type="text"><p>{_prose(rng)}</p><button>{_words(rng, 1)}</button></form>'
    comments = (f'<{rng.choice(["section", "div", "ol"])} class="comments" y0><h3>{_words(rng, 2)}</h3>'
                + "".join(f'<{rng.choice(["div", "p", "li"])}>{_prose(rng)}' for _ in range(rng.randint(1, 5))) + "</div></section></ol>")
    comments = rng.choice([comments, f'<section id="comments" y0><article class="comment"><p>{_prose(rng)}</p></article><p>{_prose(rng)}</p></section>'])
    footer = rng.choice([f"<footer y0>&copy; {_words(rng, 2)} {_prose(rng)}</footer>", f"<footer y0><p>{_prose(rng)}</p><ul>{links(3)}</ul></footer>",
                         f'<div class="footer" y0><p>{_words(rng, 6)}</p></div>'])
    body = [f"<h1>{_words(rng, rng.randint(1, 9))}</h1>"] if rng.random() < 0.8 else []
    for _ in range(rng.randint(1, 9)):
        x = rng.random()
        if x < 0.58:
            t = "p" if rng.random() < 0.85 else "div"
            body.append(f"<{t}{_block_names(rng)}>{_prose(rng)}</{t}>" if rng.random() < 0.85 else
                        f"<div{_block_names(rng)}><p>{_prose(rng)}</p><p>{_prose(rng)}</p></div>")
        elif x < 0.76:
            body.append(f"<p{_block_names(rng)}>{_short(rng)}</p>")
        elif x < 0.82:
            body.append(f"<h{rng.randint(2, 4)}>{_words(rng, 4)}</h2>")
        elif x < 0.88:
            body.append("<ul>" + "".join(f"<li>{rng.choice([_prose(rng), _words(rng, 4)])}</li>" for _ in range(3)) + "</ul>")
        elif x < 0.91:
            body.append(f"<blockquote><p>{_prose(rng)}</p></blockquote>")
        elif x < 0.93:
            body.append(f"<pre>{_words(rng, 12)}</pre>")
        elif x < 0.95:
            body.append("<table><tr>" + "".join(f"<td>{_words(rng, 2)}</td>" for _ in range(4)) + "</tr></table>")
        elif x < 0.965:
            body.append(f"<figure><figcaption>{_words(rng, 6)}</figcaption></figure>")
        elif x < 0.98:
            body.append(f"<div>{_prose(rng)}</div>")
        else:
            body.append(rng.choice([ad, form]))       # boilerplate inside the article
    named = _article_names(rng)
    tag = rng.choice(["<article>", f"<article{named}>", f"<article{named}>", "<main>", f"<main{named}>", "<main><article>",
                      f"<main><article{named}>", '<div class="content">', '<div id="main">',
                      '<div class="post-body">', "<section>", "<div>", ""])
    ends = "".join(f"</{t}>" for t in re.findall(r"<(\w+)", tag)[::-1])
    inner = some(ad, form, notice) if rng.random() < 0.2 else ""
    teasers = "".join(f'<article class="{rng.choice(["teaser", "related", "card", "item"])}" y0><h3><a href="/">{_words(rng, 4)}</a></h3>'
                      f"<p>{_words(rng, 8)}</p></article>" for _ in range(rng.randint(1, 3)))
    return (f"<html><head><title>x</title></head><body y1>{some(notice, header)}{nav if rng.random() < 0.9 else ''}{some(ad)}{_other(rng) if rng.random() < 0.3 else ''}"
            f"{tag}{''.join(body)}{inner}{ends}{some(aside, comments, ad, form, _other(rng))}{teasers if rng.random() < 0.2 else ''}{footer if rng.random() < 0.9 else ''}{some(notice)}</body></html>")


def _labels(page: str) -> tuple[list[Node], list[int]]:
    marked = re.findall(r"<([a-zA-Z][\w]*)([^>]*)>", page)
    marks = [(t.lower(), 1 if "y1" in a.split() else 0 if "y0" in a.split() else None)
             for t, a in marked if t.lower() in BLOCK and t.lower() != "html"]
    nodes, _ = parse(page)
    labels = [1]
    for n, (_, y) in zip(nodes[1:], marks):
        labels.append(labels[n.parent] if y is None else y)
    return nodes, labels


def train(n_pages: int = 900, seed: int = 5) -> Model:
    """A model fitted on ``n_pages`` labelled pages (a bounded, fixed set)."""
    rng = random.Random(seed)
    return Model([_labels(labelled_page(rng)) for _ in range(n_pages)])


# Extraction -----------------------------------------------------------------

def main_text(page: str | None, model: Model) -> str:
    """Content blocks in page order, joined by two newlines."""
    if not page:
        return ""
    nodes, segments = parse(page)
    p = model.marginals(nodes)
    return "\n\n".join(t for i, t in segments if p[i] > 0.5)


def _extract(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                texts = [main_text(h.as_py(), model) for h in part.column("html")]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("url"), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], names=["id", "url", "text", "n_chars"])
    return run


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", *,
            model: Model | None = None) -> DataFrame:
    """One row per input row: ``id``, ``url``, ``text`` (main text), ``n_chars``.

    A NULL or empty page has an empty text; NULL ids and URLs stay; repeated
    rows are extracted each; pages are read whole; other columns are not read;
    an empty table gives no rows.  Rows are independent: no shuffle.
    """
    src = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"),
                       F.col(html_col).cast("string").alias("html"))
    kind = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(_extract(model or train()), f"id {kind}, url string, text string, n_chars long")
