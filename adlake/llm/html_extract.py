"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A page is cut into leaf blocks: runs of inline content inside the innermost block element.
Each block has features from its ancestors' tags and class, id and role tokens, from its text
and from where the page's running text lies (which wrapper holds it, and beside how much); a
two-label chain (other, main) is trained on labelled pages and decoded by Viterbi. The main
blocks, in page order, make the text.

Labelled pages carry ``data-main="1"`` on elements of the main text and ``data-main="0"`` on
elements inside them that are not; the attribute is used for labels only.
"""

from __future__ import annotations

import html
import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import slices, texts

#: Fixed values of the HTML standard.
BLOCK_TAGS = frozenset((
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th "
    "thead tr ul").split())
#: Elements that group blocks, and those of them that never hold the article.
WRAPPERS = frozenset("article aside body center dialog div details fieldset footer form header main menu nav section td".split())
SIDE_TAGS = frozenset("aside dialog footer form header menu nav".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = "script|style|title|textarea|template|noscript|iframe"
#: Inline elements that part the words around them.
EMBEDDED_TAGS = frozenset("svg object canvas audio video select".split())
#: A start tag on the left ends open elements on the right, up to the given parents.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr",)), "th": (("td", "th"), ("tr",)), "option": (("option",), ())}

#: Quotes count only where a value begins; an unquoted value ends at white space or >.
_ATTRS = r"""(?:=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+)?+|[^=>]++)*+"""
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW_TAGS})(?=[\s/>]){_ATTRS}>.*?(?:</\1(?=[\s/>])[^>]*+>|\Z)"
    rf"|<(/?)([a-zA-Z][^\s/>]*)({_ATTRS})>|<[!?/][^>]*+>|[^<]++|<", re.S | re.I)
_ATTR = re.compile(r"""\b(class|id|role|data-main|hidden)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>][^\s>]*)))?""", re.I)
_NAME = re.compile(r"[a-z]+")


@dataclass
class Block:
    text: str
    tags: tuple[str, ...]
    names: tuple[str, ...]
    linked: int
    main: bool
    wrappers: tuple[int, ...]


def blocks(page: str) -> list[Block]:
    """Leaf blocks of a page in order; markup, scripts, styles and comments are gone, character references decoded."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...], str | None, int]] = []
    text: list[str] = []
    links: list[str] = []
    in_link = opened = 0

    def flush() -> None:
        if text:
            own = " ".join(html.unescape("".join(text)).split())
            if own:
                marks = [m for _, _, m, _ in stack if m is not None]
                out.append(Block(
                    own, tuple(t for t, *_ in stack), tuple(n for _, names, *_ in stack for n in names),
                    len(" ".join(html.unescape("".join(links)).split())), bool(marks) and marks[-1] == "1",
                    tuple(number for t, _, _, number in stack if t in WRAPPERS)))
            text.clear()
            links.clear()

    def close(at: int) -> None:
        nonlocal in_link
        for tag, *_ in stack[at:]:
            in_link -= tag == "a"
        del stack[at:]

    def last(tags: tuple[str, ...], until: tuple[str, ...]) -> int | None:
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in tags:
                return k
            if stack[k][0] in until:
                return None
        return None

    for m in _TOKEN.finditer(page):
        tag = m.group(3)
        if tag is None:
            own = m.group(0)
            if own[0] != "<" or own == "<":
                text.append(own)
                if in_link:
                    links.append(own)
            elif m.group(1):
                text.append(" ")
            continue
        tag = tag.lower()
        if tag in EMBEDDED_TAGS:
            text.append(" ")
        if m.group(2):
            at = last((tag,), ())
            if at is not None:
                if tag in BLOCK_TAGS:
                    flush()
                close(at)
            continue
        if tag in BLOCK_TAGS:
            flush()
            at = last(("p",), ("button", "td", "th", "table"))
            if at is not None:
                close(at)
            ends, until = CLOSES.get(tag, ((), ()))
            at = last(ends, until) if ends else None
            if at is not None:
                close(at)
        if tag in VOID_TAGS:
            if tag in ("br", "img", "wbr"):
                text.append(" " if tag != "wbr" else "")
            continue
        names, mark, raw = (), None, m.group(4)
        if raw and "=" in raw or "hidden" in raw:
            for a in _ATTR.finditer(raw):
                value = a.group(2) or a.group(3) or a.group(4) or ""
                if a.group(1).lower() == "data-main":
                    mark = value
                else:
                    names += tuple(_NAME.findall(value.lower())) if value else (a.group(1).lower(),)
        if not raw.rstrip().endswith("/") or tag in BLOCK_TAGS:
            opened += 1
            stack.append((tag, names, mark, opened))
            in_link += tag == "a"
    flush()
    return out


DIMENSION = 8192
_PUNCT = (".", "!", "?", ":", ";", "…", '"', "”", "»", ")")


def _f(name: str) -> int:
    return zlib.crc32(name.encode()) % DIMENSION


_NAMES: dict[str, int] = {}


def _id(name: str) -> int:
    found = _NAMES.get(name)
    if found is None:
        if len(_NAMES) > 50_000:
            _NAMES.clear()
        found = _NAMES[name] = _f(name)
    return found


def _places(page: list[Block]) -> list[tuple[str, int, int]]:
    """Of each block: its place to the page's running text, the share of that text in its wrapper (quarters), prose blocks beside it (3 at most).

    ``dense`` is the wrapper with most running text of its own, ``holder`` the innermost one that
    holds two thirds of it with all inside. Wrapper 0 stands for the page.
    """
    own: dict[int, int] = {}
    whole: dict[int, int] = {}
    beside: dict[int, int] = {}
    for b in page:
        if len(b.text) > 25 and b.linked < 0.3 * len(b.text) and SIDE_TAGS.isdisjoint(b.tags):
            for w in (0, *b.wrappers):
                whole[w] = whole.get(w, 0) + len(b.text)
            nearest = b.wrappers[-1] if b.wrappers else 0
            own[nearest] = own.get(nearest, 0) + len(b.text)
            beside[nearest] = beside.get(nearest, 0) + 1
    total = whole.get(0, 0)
    dense = max(own, key=lambda w: (own[w], -w), default=-1)
    holder = max((w for w, n in whole.items() if 3 * n >= 2 * total), default=-1)  # wrappers are numbered as they open
    out = []
    for b in page:
        nearest = b.wrappers[-1] if b.wrappers else 0
        inside = (0, *b.wrappers)
        out.append((f"{dense in inside} {holder in inside}", 4 * own.get(nearest, 0) // max(total, 1), min(beside.get(nearest, 0), 3)))
    return out


def features(page: list[Block]) -> list[list[int]]:
    """Hashed feature ids of each block of a page."""
    framed = any("article" in b.tags or "main" in b.tags for b in page)
    out = []
    for k, (b, (place, held, beside)) in enumerate(zip(page, _places(page))):
        inside = "article" in b.tags or "main" in b.tags
        n, words, share = len(b.text), b.text.count(" ") + 1, b.linked / max(len(b.text), 1)
        own = {"bias", f"page {framed} inside {inside}", f"last {b.tags[-1] if b.tags else ''}", f"links {round(share * 4)}"}
        own.update("in " + t for t in b.tags)
        own.update("named " + t for t in b.names)
        size = min(6, n.bit_length() // 2)
        own.update((f"size {size}", f"size {size} inside {inside} {framed}", f"words {min(words, 12) // 3}", f"end {b.text.endswith(_PUNCT)}"))
        own.update((f"place {place} {framed}", f"held {held} {framed}", f"beside {beside} {framed}", f"place {place} {framed} links {round(share * 4)}",
                    f"place {place} {framed} side {SIDE_TAGS.isdisjoint(b.tags)}"))
        if n > 40 and share < 0.3:
            own.add(f"prose {place} {framed}")
            own.add(f"prose inside {inside} {framed}")
        if b.text[0] in "©|•»" or "©" in b.text:
            own.add("sign")
        if k == 0 or k == len(page) - 1:
            own.add(f"edge {k == 0}")
        out.append([_id(x) for x in own])
    return out


@dataclass
class Crf:
    """Weights of features by label, of the first label, and of transitions."""

    w: np.ndarray
    start: np.ndarray
    move: np.ndarray

    def scores(self, ids: list[list[int]]) -> np.ndarray:
        at = np.repeat(np.arange(len(ids)), [len(i) for i in ids])
        flat = np.concatenate([np.asarray(i, dtype=np.int64) for i in ids])
        return np.stack([np.bincount(at, weights=self.w[flat, c], minlength=len(ids)) for c in (0, 1)], axis=1)

    def viterbi(self, ids: list[list[int]]) -> list[int]:
        """Most likely labels of a page's blocks."""
        if not ids:
            return []
        s = self.scores(ids).tolist()
        (m00, m01), (m10, m11) = self.move.tolist()
        a, b = s[0][0] + self.start[0], s[0][1] + self.start[1]
        back = []
        for x, y in s[1:]:
            from_a, from_b = a + m00 >= b + m10, a + m01 >= b + m11
            back.append((0 if from_a else 1, 0 if from_b else 1))
            a, b = x + (a + m00 if from_a else b + m10), y + (a + m01 if from_b else b + m11)
        label = [0 if a >= b else 1]
        for pair in reversed(back):
            label.append(pair[label[-1]])
        return label[::-1]


def _expected(s: np.ndarray, start: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Label and transition probabilities of one page (forward-backward)."""
    n = len(s)
    f, b = np.empty((n, 2)), np.zeros((n, 2))
    f[0] = s[0] + start
    for t in range(1, n):
        f[t] = s[t] + np.logaddexp(f[t - 1, 0] + move[0], f[t - 1, 1] + move[1])
    for t in range(n - 2, -1, -1):
        x = s[t + 1] + b[t + 1]
        b[t] = np.logaddexp(move[:, 0] + x[0], move[:, 1] + x[1])
    z = np.logaddexp(f[-1, 0], f[-1, 1])
    p = np.exp(f + b - z)
    pair = np.exp(f[:-1, :, None] + move[None] + (s[1:] + b[1:])[:, None, :] - z).sum(axis=0) if n > 1 else np.zeros((2, 2))
    return p, pair


def train(pages: list[str], steps: int = 60, l2: float = 1e-3, rate: float = 0.4) -> Crf:
    """Maximise the conditional likelihood of the labels of marked pages (full-batch Adagrad)."""
    data = []
    for page in pages:
        cut = blocks(page)
        if cut:
            data.append((features(cut), np.array([int(b.main) for b in cut])))
    crf = Crf(np.zeros((DIMENSION, 2)), np.zeros(2), np.zeros((2, 2)))
    seen = [np.full(x.shape, 1e-8) for x in (crf.w, crf.start, crf.move)]
    for _ in range(steps):
        g = [l2 * crf.w, l2 * crf.start, l2 * crf.move]
        for ids, y in data:
            p, pair = _expected(crf.scores(ids), crf.start, crf.move)
            e = p - np.eye(2)[y]
            at = np.repeat(np.arange(len(ids)), [len(i) for i in ids])
            np.add.at(g[0], np.concatenate([np.asarray(i) for i in ids]), e[at] / len(data))
            g[1] = g[1] + e[0] / len(data)
            true = np.zeros((2, 2))
            np.add.at(true, (y[:-1], y[1:]), 1)
            g[2] = g[2] + (pair - true) / len(data)
        for x, d, s in zip((crf.w, crf.start, crf.move), g, seen):
            s += d * d
            x -= rate * d / np.sqrt(s)
    return crf


_WORDS = (
    "the river town light over many people found small house water road garden winter letter market evening story open field der die und nicht "
    "eine haben wieder strasse les des une pour avec dans maison toujours los las una para donde siempre tiempo trabajo").split()


def labelled_pages(count: int = 180, seed: int = 11) -> list[str]:
    """Marked pages in common layouts, composed from a fixed seed: the default training set.

    In half of them the article's wrapper has a made-up class name, none at all, or is missing,
    so that the place of the running text counts beside the names.
    """
    rng = random.Random(seed)

    def made_up() -> str:
        name = "-".join("".join(rng.choice("bcdfglmnprstvwz") + rng.choice("aeiou") for _ in range(rng.randint(2, 4))) for _ in range(rng.randint(1, 2)))
        return rng.choice(["", f' class="{name}"', f' class="{name}"', f' id="{name}"'])

    def words(low: int, high: int) -> str:
        n = rng.randint(low, high)
        junk = rng.choice(["", "", "", "***", "%%%", "!!", "&amp;&amp;", " |"])
        own = [rng.choice(_WORDS) + (junk if rng.random() < 0.7 else "") for _ in range(n)]
        return " ".join(own).capitalize()

    def prose() -> str:
        return ". ".join(words(3, 14) for _ in range(rng.choice([1, 1, 2, 4, 7]))) + rng.choice([".", ".", ".", "", "!"])

    def links(n: int) -> str:
        return "".join(f'<li><a href="/{k}">{words(1, 2)}</a></li>' for k in range(n))

    def furniture(kind: str) -> str:
        short = words(2, 9) + rng.choice([".", ""])
        return {
            "nav": f'<nav><ul>{links(rng.randint(2, 7))}</ul></nav>',
            "menu": f'<div class="{rng.choice(["menu", "top-menu", "navbar", "breadcrumbs"])}"><ul>{links(rng.randint(2, 6))}</ul></div>',
            "header": f'<header><div class="logo">{words(1, 2)}</div><p>{short}</p></header>',
            "head": f'<div id="header"><a href="/">{words(1, 2)}</a> {short}</div>',
            "ad": f'<div class="{rng.choice(["ad", "ads", "advert", "banner-ad", "sponsored", "promo"])}">{prose()}</div>',
            "aside": f'<aside><h3>{words(1, 3)}</h3><p>{prose()}</p><ul>{links(rng.randint(1, 4))}</ul></aside>',
            "side": f'<div class="{rng.choice(["sidebar", "related", "widget", "side-bar"])}"><h4>{words(1, 3)}</h4><ul>{links(3)}</ul><p>{short}</p></div>',
            "notice": f'<div class="{rng.choice(["cookie-notice", "cookie-banner", "notice", "consent", "popup"])}" role="dialog">{prose()} <button>OK</button></div>',
            "form": f'<form action="/s"><label>{words(1, 3)}</label><input name="q"><p>{short}</p><button>{words(1, 1)}</button></form>',
            "share": f'<div class="{rng.choice(["share", "social", "share-buttons"])}"><a href="#">{words(1, 1)}</a> <a href="#">{words(1, 1)}</a></div>',
            "letter": f'<div class="{rng.choice(["newsletter", "subscribe", "signup"])}"><p>{prose()}</p></div>',
            "comments": f'<{(t := rng.choice(["section", "div", "div"]))} {rng.choice(["class", "id"])}="{rng.choice(["comments", "comment-list", "responses"])}"><h3>{words(1, 2)}</h3>'
                        + "".join(f'<div class="comment"><p>{prose()}</p></div>' for _ in range(rng.randint(1, 4))) + f"</{t}>",
            "footer": f'<footer>&copy; {words(1, 3)} &middot; {short}</footer>',
            "foot": f'<div id="footer"><p>&copy; 2020 {words(1, 3)}</p><a href="/x">{words(1, 2)}</a></div>',
        }[kind]

    def body() -> str:
        out = []
        for _ in range(rng.randint(1, 9)):
            out.append(rng.choice([
                f"<p>{prose()}</p>", f"<p>{prose()}</p>", f"<p>{prose()}</p>", f"<p><b>{words(2, 8)}.<br>", f"<h2>{words(1, 5)}</h2>",
                f"<ul>{''.join(f'<li>{words(2, 9)}</li>' for _ in range(3))}</ul>", f"<blockquote>{prose()}</blockquote>",
                f"<p>{words(4, 9)} <a href='/y'>{words(1, 3)}</a> {words(3, 9)}.</p>", f"<p>{words(1, 2)}.</p>", f"<pre>{words(3, 9)}</pre>",
                f"<table><tr><td>{words(1, 3)}</td><td>{words(1, 3)}</td></tr></table>"]))
            if rng.random() < 0.12:
                inner = furniture(rng.choice(["ad", "aside", "share", "form", "letter", "side"]))
                out.append(f'<div data-main="0">{inner}</div>')
        return "".join(out)

    pages = []
    for _ in range(count):
        before = "".join(furniture(k) for k in rng.sample(["nav", "menu", "header", "head", "ad", "notice", "form", "side"], rng.randint(1, 4)))
        after = "".join(furniture(k) for k in rng.sample(["aside", "side", "ad", "share", "letter", "comments", "form", "notice"], rng.randint(0, 3)))
        end = furniture(rng.choice(["footer", "footer", "foot"])) if rng.random() < 0.9 else ""
        open_tag, close_tag = rng.choice([
            ("<article {}>", "</article>"), ("<article {}>", "</article>"), ("<article {}>", "</article>"), ("<main {}>", "</main>"),
            ('<div class="content" {}>', "</div>"), ('<div id="article-body" {}>', "</div>"), ('<section class="post entry" {}>', "</section>"),
            ("<main><article {}>", "</article></main>"), ('<div class="main-text" {}>', "</div>")])
        layout = rng.random()
        if layout < 0.4:
            open_tag, close_tag = rng.choice([
                (f"<div{made_up()} {{}}>", "</div>"), (f"<div{made_up()} {{}}>", "</div>"), (f"<section{made_up()} {{}}>", "</section>"),
                (f"<div{made_up()}><div{made_up()} {{}}>", "</div></div>"), (f"<table><tr><td{made_up()} {{}}>", "</td></tr></table>")])
        title = f"<h1>{words(2, 9)}</h1>" if rng.random() < 0.8 else ""
        tail = f'<div data-main="0">{furniture("comments")}</div>' if rng.random() < 0.2 else ""
        mark, text = 'data-main="1"', body()
        if layout < 0.6 and rng.random() < 0.5:
            text = f"<div{made_up()}>{text}</div><div{made_up()}>{body()}</div>"
        page = f"{before}{open_tag.format(mark)}{title}{text}{tail}{close_tag}{after}{end}"
        outer = ""
        if 0.4 <= layout < 0.5:  # no wrapper: the article lies between the furniture
            outer, page = " " + mark, f'<div data-main="0">{before}</div>{title}{text}{tail}<div data-main="0">{after}{end}</div>'
        elif rng.random() < 0.4:
            page = f"<div{made_up()}>{page}</div>"
        pages.append(f"<!DOCTYPE html><html><head><title>{words(2, 6)}</title></head><body{outer}>{page}" + ("</body></html>" if rng.random() < 0.9 else ""))
    return pages


def main_text(page: str, crf: Crf) -> str:
    """Main blocks of a page joined by one space; text outside any element is all main where the page has no element."""
    cut = blocks(page)
    if not any(b.tags for b in cut):
        return " ".join(b.text for b in cut)
    return " ".join(b.text for b, label in zip(cut, crf.viterbi(features(cut))) if label)


def extract(pages: DataFrame, labelled: list[str] | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages``.

    ``labelled``: marked pages to train on (a short list; ``labelled_pages()`` by default). Null
    or empty html gives the empty text; a page without any element is returned whole.
    Repeated rows stay repeated; an empty table gives no rows; other columns are ignored.
    """
    kind = pages.schema[id_col].dataType.simpleString()
    shipped = pages.sparkSession.sparkContext.broadcast(train(labelled_pages() if labelled is None else labelled))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crf = shipped.value
        for part in slices(batches, "html"):
            own = [main_text(t, crf) for t in texts(part, "html")]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(own, pa.string()), pa.array(list(map(len, own)), pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html"))
    return rows.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
