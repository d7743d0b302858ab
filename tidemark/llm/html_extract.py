"""HTML extraction: a linear-chain conditional random field over a page's leaf blocks.

A page is parsed into blocks: runs of text between tags that start or end a block. Each block knows
its open tags with their classes and ids, and its text. Features of both feed a linear-chain CRF
with the labels boilerplate and content; Viterbi decoding picks the best sequence. The text of a
page is that of its content blocks, white space collapsed, joined by blank lines.

The CRF is trained by gradient descent on the log-likelihood (forward-backward), on labelled pages.
No table carries labels for blocks, so the pages are written here: `labelled_pages` builds them from
templates (article containers, menus, headers, footers, sidebars, notices, adverts, forms, comments,
each also without a telling tag or name) and knows the label of every block. Their classes and ids
are not the words of the features. The seed and the number of pages are parameters; training takes
a few seconds, on the driver, and the weights travel with the task.

No single name decides: the tags article and main stand for content whatever their classes say
(unless these speak of comments), a class that says content outweighs another one of the same
element, and text features and neighbours count too.

Cases: null and empty html give empty text; text outside of any tag is a block; unclosed and
misnested tags are closed by their parents; scripts, styles, templates and comments are no text;
repeated rows are extracted alike; an empty table gives an empty result; very long pages are taken
whole; other columns are not carried, and a carried one can't be called text or n_chars (ValueError).
"""

from __future__ import annotations

import functools
import random
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import OWN, read_table

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img"
    " math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle msub msup msubsup munder mover munderover mtable mtr mtd mfenced semantics"
    " picture svg g path text tspan circle ellipse rect line polyline polygon use defs symbol".split()
)
SILENT = frozenset("script style template head title select textarea desc metadata".split())
#: What may stand in a head; its end tag and <body> may be left out.
IN_HEAD = frozenset("html head base basefont bgsound link meta title style script noscript noframes template".split())
#: Open tags that a new block element closes.
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: A block element inside these does not close what is outside of them.
BARRIER = frozenset("article section div main aside nav header footer body html table td th ul ol dl blockquote form figure".split())
P_CLOSERS = BARRIER - {"td", "th", "body", "html"} | frozenset("p h1 h2 h3 h4 h5 h6 pre hr address fieldset details".split())

#: White space of HTML.
_SPACES = re.compile(r"[ \t\n\f\r]+")


class Blocks(HTMLParser):
    """(path, text, link characters, tag) of each block with text, in page order."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, str]] = []
        self.blocks: list[tuple[tuple[str, ...], str, int, str]] = []
        self.parts: list[str] = []
        self.linked = 0
        self.path: tuple[str, ...] = ()
        self.begun = False  # whether the block has text

    def flush(self) -> None:
        text = _SPACES.sub(" ", "".join(self.parts)).strip(" \t\n\f\r")
        if text:
            self.blocks.append((self.path, text, self.linked, self.path[-1].split(".")[0].split("#")[0] if self.path else ""))
        self.parts, self.linked, self.begun = [], 0, False

    def leave_head(self) -> None:
        if self.stack and self.stack[-1][0] == "head":
            self.stack.pop()

    def handle_starttag(self, tag, attrs):
        if tag not in IN_HEAD:
            self.leave_head()
        if tag == "br":
            self.parts.append(" ")
            return
        if tag not in INLINE:
            self.flush()
            if tag == "body":
                self.stack = [x for x in self.stack if x[0] == "html"]
            closes = CLOSES.get(tag, set()) | ({"p"} if tag in P_CLOSERS else set())
            for k in range(len(self.stack) - 1, -1, -1):
                if self.stack[k][0] in closes:
                    del self.stack[k:]
                    break
                if self.stack[k][0] in BARRIER and self.stack[k][0] not in closes:
                    break
        if tag in VOID:
            return
        named = {k: v or "" for k, v in attrs}
        marks = " ".join(named.get(k, "") for k in ("class", "id", "role")).lower()
        self.stack.append((tag, f"{tag}.{marks}" if marks.strip() else tag))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag not in INLINE and tag != "br":
            self.flush()
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] == tag:
                if tag in INLINE:
                    del self.stack[k]
                else:
                    del self.stack[k:]
                break
            if tag in INLINE and self.stack[k][0] not in INLINE:
                break

    def handle_data(self, data):
        if data.strip(" \t\n\f\r"):
            self.leave_head()
        if any(t in SILENT for t, _ in self.stack):
            return
        if not self.begun and data.strip(" \t\n\f\r"):
            self.path, self.begun = tuple(x for t, x in self.stack if t not in INLINE), True
        self.parts.append(data)
        if any(t == "a" for t, _ in self.stack):
            self.linked += len(data.strip())


def blocks_of(html: str | None) -> list[tuple[tuple[str, ...], str, int, str]]:
    parser = Blocks()
    parser.feed(html or "")
    parser.close()
    parser.flush()
    return parser.blocks


#: Words in tags, classes and ids of what is not content, and of what is.
HINTS = {
    "menu": "nav menu navbar breadcrumb breadcrumbs pagination pager tabs toolbar",
    "head": "header masthead banner topbar logo",
    "foot": "footer copyright colophon legal",
    "side": "aside sidebar related recommended widget promo newsletter subscribe share social tags author-box",
    "ad": "ad ads advert advertisement sponsored sponsor adsense",
    "notice": "cookie consent notice alert modal popup gdpr overlay disclaimer",
    "form": "form search login signup fieldset button",
    "comment": "comment comments reply replies respond discussion disqus",
    "main": "article main content entry post story body-text",
}
_HINT = {w: k for k, words in HINTS.items() for w in words.split()}
#: Longer words count within others too (sitenavigation, cookiebar).
_STEMS = tuple((w, k) for w, k in _HINT.items() if len(w) >= 6 and k != "main") + (("navig", "menu"), ("cookie", "notice"), ("foot", "foot"))
_SPLIT = re.compile(r"[^a-z0-9]+")


def _kinds(name: str) -> set[str]:
    """What a class or id says; a name that says content and something else says the latter (post-header)."""
    own = {_HINT[w] for w in (name, *_SPLIT.split(name)) if w in _HINT} or {k for w, k in _STEMS if w in name}
    return own - {"main"} or own


@functools.lru_cache(maxsize=20_000)
def _element(part: str) -> tuple[frozenset, bool]:
    """(what an open tag hints at, whether it holds content)."""
    tag, _, marks = part.partition(".")
    names = [_kinds(x) for x in marks.split()]
    said = set().union(*names)
    if tag in ("article", "main"):
        return (frozenset({"comment"}), False) if said == {"comment"} else (frozenset({"main"}), True)
    if tag in ("body", "html"):
        return frozenset(said & {"main"}), False
    if tag in _HINT:
        return frozenset({_HINT[tag]}), False
    return (frozenset({"main"}), True) if "main" in said else (frozenset(said), False)


@functools.lru_cache(maxsize=20_000)
def _path_features(path: tuple[str, ...]) -> tuple[tuple[str, ...], bool]:
    """(features of the open tags, whether they hold content)."""
    out, inside = {"leaf=" + (path[-1].split(".")[0] if path else "")}, False
    for part in path:
        hints, holds = _element(part)
        inside |= holds
        out.add("in=" + part.partition(".")[0])
        out |= {"hint=" + k for k in hints}
    return tuple(sorted(out)), inside


def features(blocks: list[tuple[tuple[str, ...], str, int, str]]) -> list[list[str]]:
    """The features of a page's blocks."""
    paths = [_path_features(path) for path, *_ in blocks]
    known = any(inside for _, inside in paths)
    out = []
    for (own, inside), (_, text, linked, _) in zip(paths, blocks, strict=True):
        words = text.count(" ") + 1
        share = linked / max(1, len(text))
        size = "1" if words < 2 else "4" if words < 5 else "10" if words < 11 else "25" if words < 26 else "more"
        place = "inside" if inside else "outside" if known else "unknown"
        links = "most" if share > 0.6 else "some" if share > 0.1 else "none"
        out.append(["base", *own, f"place={place}", f"place={place} words={size}", f"place={place} links={links}", "stop=" + str(text[-1] in ".!?…\"'”»"), "sign=" + str("©" in text or "·" in text)])
    return out


class Crf:
    """A linear-chain CRF with two labels (0 boilerplate, 1 content)."""

    def __init__(self, names: dict[str, int], weights: np.ndarray, moves: np.ndarray, start: np.ndarray):
        self.names, self.weights, self.moves, self.start = names, weights, moves, start

    def scores(self, rows: list[list[str]]) -> np.ndarray:
        out = np.zeros((len(rows), 2))
        for k, row in enumerate(rows):
            known = [self.names[x] for x in row if x in self.names]
            out[k] = self.weights[known].sum(axis=0)
        return out

    def decode(self, rows: list[list[str]]) -> list[int]:
        """Viterbi."""
        if not rows:
            return []
        s = self.scores(rows).tolist()
        (m00, m01), (m10, m11) = self.moves.tolist()
        a, b = s[0][0] + self.start[0], s[0][1] + self.start[1]
        back = []
        for x, y in s[1:]:
            back.append((int(b + m10 > a + m00), int(b + m11 > a + m01)))
            a, b = max(a + m00, b + m10) + x, max(a + m01, b + m11) + y
        last = int(b > a)
        out = [last]
        for pair in reversed(back):
            last = pair[last]
            out.append(last)
        return out[::-1]


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def train(pages: list[tuple[list[list[str]], list[int]]], rounds: int = 40, rate: float = 0.5, ridge: float = 1e-3) -> Crf:
    """Adagrad on the penalised log-likelihood of (features, labels) sequences, all pages at once, block by block."""
    pages = [(rows, labels) for rows, labels in pages if rows]
    names = {x: k for k, x in enumerate(sorted({x for rows, _ in pages for row in rows for x in row}))}
    crf = Crf(names, np.zeros((len(names), 2)), np.zeros((2, 2)), np.zeros(2))
    blocks = [row for rows, _ in pages for row in rows]
    ids = np.array([names[x] for row in blocks for x in row])
    sizes = np.array([len(row) for row in blocks])
    starts = np.cumsum(sizes) - sizes
    there = np.arange(max(len(rows) for rows, _ in pages))[None, :] < np.array([len(rows) for rows, _ in pages])[:, None]
    length = there.shape[1]
    truth = np.zeros((*there.shape, 2))
    truth[there] = np.eye(2)[[y for _, labels in pages for y in labels]]
    moved = np.einsum("pka,pkb->ab", truth[:, :-1], truth[:, 1:])
    s = np.zeros((*there.shape, 2))
    past = [np.full_like(x, 1e-6) for x in (crf.weights, crf.moves, crf.start)]
    for _ in range(rounds):
        s[there] = np.add.reduceat(crf.weights[ids], starts)
        up, down = np.zeros_like(s), np.zeros_like(s)
        up[:, 0] = s[:, 0] + crf.start
        for k in range(1, length):
            up[:, k] = np.where(there[:, k, None], s[:, k] + _logsum(up[:, k - 1, :, None] + crf.moves, 1), up[:, k - 1])
        for k in range(length - 2, -1, -1):
            down[:, k] = np.where(there[:, k + 1, None], _logsum(crf.moves + (s[:, k + 1] + down[:, k + 1])[:, None, :], 2), 0)
        total = _logsum(up[:, -1], 1)[:, None, None]
        off = truth - np.where(there[:, :, None], np.exp(np.minimum(up + down - total, 0)), 0)
        pairs = np.exp(np.minimum(up[:, :-1, :, None] + crf.moves + (s + down)[:, 1:, None, :] - total[..., None], 0)) * there[:, 1:, None, None]
        grads = [np.zeros_like(crf.weights), moved - pairs.sum(axis=(0, 1)), off[:, 0].sum(axis=0)]
        np.add.at(grads[0], ids, np.repeat(off[there], sizes, axis=0))
        for own, g, seen in zip((crf.weights, crf.moves, crf.start), grads, past, strict=True):
            g = g / len(pages) - ridge * own
            seen += g * g
            own += rate * g / np.sqrt(seen)
    return crf


CONTENT, OTHER = "\x02", "\x03"  # marks in labelled pages, before a block's text


def labelled_pages(n: int = 320, seed: int = 7) -> list[str]:
    """Pages from templates, where CONTENT or OTHER starts the text of every block."""
    rng = random.Random(seed)
    syllables = "ta re on mi lu ver den sch ci ment ou and the ra ko pel is qu en".split()
    plain = "x wrap box inner col-8 row grid layer unit page-1 holder t3 sec panel"
    names = {
        "menu": "site-menu-2 topnav mainnavigation menubar js-menu " + plain,
        "head": "pageheader site-header-wrap brand " + plain,
        "foot": "footnote-bar pagefoot site-footer__inner imprint " + plain,
        "side": "sidebar-2 relatedposts social-bar share-this widgetarea newsletterbox promo-2 rightcol",
        "ad": "advertising ad-slot-3 sponsoredlinks",
        "notice": "cookiebar consentbox js-notice popupbox",
        "comment": "commentlist usercomments reply-box discussionlist",
        "main": "story-text post-body entry_content articlebody maincontent text-wrap",
    }

    def words(a: int, b: int) -> str:
        return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(rng.randint(a, b)))

    def text(mark: str, a: int, b: int) -> str:
        end = rng.choice([".", ".", "", "!", "?", " |", "$$$", "&amp;"])
        return mark + words(a, b) + end

    def link(mark: str = OTHER) -> str:
        return f'<a href="/{words(1, 1)}">{text(mark, 1, 3)}</a>'

    def named(tag: str, kind: str, body: str) -> str:
        marks = rng.choice(names[kind].split())
        return rng.choice([f'<{tag} class="{marks}">', f'<{tag} id="{marks}">', f'<{tag} class="x {marks}">']) + body + f"</{tag}>"

    def paragraphs(k: int) -> str:
        out = ""
        for _ in range(k):
            kind = rng.random()
            size = rng.choice([(1, 3), (4, 12), (10, 40), (30, 120)])
            if kind < 0.7:
                out += f"<p>{text(CONTENT, *size)}</p>"
            elif kind < 0.78:
                out += f"<p><b>{text(CONTENT, *size)}<br>"
            elif kind < 0.84:
                out += f"<h{rng.randint(2, 4)}>{text(CONTENT, 1, 8)}</h3>"
            elif kind < 0.9:
                out += "<ul>" + "".join(f"<li>{text(CONTENT, 1, 20)}</li>" for _ in range(rng.randint(1, 5))) + "</ul>"
            elif kind < 0.94:
                out += f"<blockquote>{text(CONTENT, 5, 30)}</blockquote>"
            elif kind < 0.97:
                out += f"<table><tr><td>{text(CONTENT, 1, 5)}</td><td>{text(CONTENT, 1, 5)}</td></tr></table>"
            else:
                out += f"<pre>{text(CONTENT, 3, 20)}</pre>"
        return out

    def aside() -> str:
        return rng.choice(
            [
                lambda: named("div", "ad", rng.choice([text(OTHER, 1, 25), f"<p>{text(OTHER, 3, 25)}</p>"])),
                lambda: named("div", "notice", f"<p>{text(OTHER, 4, 30)}</p>"),
                lambda: named("div", "side", f"<h3>{text(OTHER, 1, 3)}</h3><p>{text(OTHER, 3, 30)}</p>"),
                lambda: "<aside>" + f"<p>{text(OTHER, 3, 40)}</p><ul><li>{link()}</li><li>{link()}</li></ul>" + "</aside>",
                lambda: f"<form><label>{text(OTHER, 1, 3)}</label><input name=q><button>{text(OTHER, 1, 1)}</button></form>",
                lambda: named("div", "menu", "".join(link() for _ in range(4))),
                lambda: named("section", "comment", f"<p>{text(OTHER, 3, 40)}</p><div>{text(OTHER, 2, 30)}</div>"),
            ]
        )()

    out = []
    for _ in range(n):
        menu = "<ul>" + "".join(f"<li>{link()}</li>" for _ in range(rng.randint(2, 7))) + "</ul>"
        head = rng.choice([f"<nav>{menu}</nav>", f"<header><h1>{text(OTHER, 1, 4)}</h1><nav>{menu}</nav></header>", named("div", "menu", menu), named("div", "head", text(OTHER, 1, 5) + menu)])
        body = f"<h1>{text(CONTENT, 1, 10)}</h1>" + paragraphs(rng.randint(1, 9))
        if rng.random() < 0.5:
            body += aside() + paragraphs(rng.randint(1, 3))
        plain_body = body
        held = rng.choice([f"<article>{body}</article>", f"<article><section>{body}</section></article>", f'<article class="post tag-{words(1, 1)}">{body}</article>', f"<main>{body}</main>", named("div", "main", body), f"<main><article>{body}</article></main>"])
        body = held
        if rng.random() < 0.3:  # nothing says where the content is
            body = plain_body
            body = rng.choice([f"<section>{body}</section><section><h2>{text(CONTENT, 1, 6)}</h2>{paragraphs(rng.randint(1, 4))}</section>", f'<div id=x><div>{body}</div></div>', f'<div class="{rng.choice(plain.split())}">{body}</div>', body])
        foot = rng.choice([f"<footer>{text(OTHER, 1, 12)}</footer>", f"<footer>&copy; {text(OTHER, 1, 2)} &middot; {words(3, 12)}</footer>", f"<footer><p>{text(OTHER, 3, 12)}</p>{link()}</footer>", named("div", "foot", f"&copy; {text(OTHER, 2, 10)}")])
        comments = named(rng.choice(["section", "div"]), "comment", "".join(f"<p>{text(OTHER, 3, 50)}</p>" for _ in range(rng.randint(1, 4)))) if rng.random() < 0.35 else ""
        out.append(f"<!DOCTYPE html><html><head><title>{words(2, 6)}</title></head><body>{head}{aside() if rng.random() < 0.8 else ''}{body}{comments}{aside() if rng.random() < 0.4 else ''}{foot}</body></html>")
    return out


def examples(pages: list[str]) -> list[tuple[list[list[str]], list[int]]]:
    out = []
    for page in pages:
        rows, labels = [], []
        for path, text, linked, leaf in blocks_of(page):
            labels.append(int(CONTENT in text))
            rows.append((path, text.replace(CONTENT, "").replace(OTHER, "") or "x", linked, leaf))
        out.append((features(rows), labels))
    return out


@functools.cache
def default_model() -> Crf:
    return train(examples(labelled_pages()))


def extract_text(html: str | None, crf: Crf) -> str:
    blocks = blocks_of(html)
    keep = crf.decode(features(blocks))
    return "\n\n".join(text for (_, text, _, _), k in zip(blocks, keep, strict=True) if k)


def _extract(crf: Crf):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract_text(x.as_py(), crf) for x in batch.column(batch.num_columns - 1)]
            yield pa.record_batch([*batch.columns[:-1], pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], names=[*batch.schema.names[:-1], "text", "n_chars"])

    return run


def extract(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url"), html: str = "html", crf: Crf | None = None) -> DataFrame:
    """(keep..., text, n_chars): one row for each row of pages."""
    taken = [c for c in keep if c in ("text", "n_chars")]
    if taken:
        raise ValueError(f"{taken} would stand twice in the result: rename them first")
    rows = pages.select(*keep, F.col(html).cast("string").alias(f"{OWN}html"))
    fields = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.mapInArrow(_extract(crf or default_model()), f"{fields}, text string, n_chars long")


def op9_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read_table(spark, sf_dir, "pages"))
