"""Plain-Python versions of the numbered operators, written from their
contracts."""

import base64
import hashlib
import math
import re
import unicodedata
from collections import Counter, defaultdict
from html.parser import HTMLParser

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower_ascii(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def shingles(text, width):
    words = WORD.findall(lower_ascii(text or ""))
    if not words:
        return set()
    if len(words) < width:
        return {tuple(words)}
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)}


def near_duplicates(rows, width, part, whole):
    """{id: (n_shingles, component)} by comparing all pairs that share a shingle."""
    sets = {i: shingles(t, width) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    common = Counter()
    for ids in holders.values():
        for k, a in enumerate(ids):
            for b in ids[k + 1:]:
                common[a, b] += 1
    for (a, b), n in common.items():
        if whole * n >= part * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


def warc(rows):
    """{page_id: (payload_bytes, digest, type, refers_to)}"""
    best = {}
    data = {i: (h or "").encode() for i, h in rows}
    for i, p in data.items():
        best[p] = max(best.get(p, i), i)
    return {i: (len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(),
                "response" if best[p] == i else "revisit", None if best[p] == i else best[p]) for i, p in data.items()}


class Article(HTMLParser):
    """Blocks inside <article>, by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth, self.blocks, self.cur = 0, [], ""

    def flush(self):
        text = " ".join(self.cur.split())
        if text:
            self.blocks.append(text)
        self.cur = ""

    def handle_starttag(self, tag, attrs):
        if tag == "article":
            self.depth += 1
        if tag in ("p", "h1", "article"):
            self.flush()
        if tag == "br":
            self.cur += " "

    def handle_endtag(self, tag):
        if tag in ("p", "h1", "article"):
            self.flush()
        if tag == "article":
            self.depth -= 1

    def handle_data(self, data):
        if self.depth:
            self.cur += data


def article(html):
    p = Article()
    p.feed(html)
    p.flush()
    return "\n\n".join(p.blocks)


ASSIGN = re.compile(r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def secrets(text):
    """Base spans (kind number, start, end) of a text."""
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found)


def spans(found):
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in found)


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words"""
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    twice = {w for w, n in Counter(windows).items() if n > 1}
    covered = {i + k for i, w in enumerate(windows) if w in twice for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def js_distance(p, q):
    m = [(a + b) / 2 for a, b in zip(p, q)]
    kl = lambda x: sum(a * math.log2(a / c) for a, c in zip(x, m) if a > 0)
    return math.sqrt(max(0.0, (kl(p) + kl(q)) / 2))


def histograms(text, common):
    """Shares of the character classes and of the common words."""
    counts, marks = [0] * 7, ".,;:!?'\"()-"
    for c in text:
        kind = unicodedata.category(c)
        counts[0 if kind == "Ll" else 2 if c in " \t\n\v\f\r" else 1 if kind == "Lu" else 3 if kind == "Nd" else 4 if c in marks
               else 5 if "!" <= c <= "~" else 6] += 1
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    places = Counter(common.index(w) if w in common else len(common) for w in words) if common else Counter()
    share = lambda v: [x / sum(v) if sum(v) else 0.0 for x in v]
    return share(counts), share([places[j] for j in range(13)]) if common else [0.0] * 13, len(words)


def passage_words(text):
    return re.sub(r"[!-/:-@\[-`{-~\x09-\x0D\x20]+", " ", (text or "").lower()).split(" ")


def contained(docs, items, width=5, part=80, whole=100):
    """{(doc_id, item_id): (n_item, n_shared)}"""
    def grams(text):
        w = [x for x in passage_words(text) if x]
        return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)}
    sets = {i: grams(t) for i, t in items}
    out = {}
    for d, text in docs:
        g = grams(text)
        for i, s in sets.items():
            if s and whole * len(s & g) >= part * len(s):
                out[d, i] = (len(s), len(s & g))
    return out


def chat(turns):
    """n_turns, turns_sha256, loss_chars, loss_sha256 of (role, text) rows."""
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    loss = "".join(t or "" for r, t in turns if r == "assistant")
    return (len(turns), sha("".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)), len(loss), sha(loss))
