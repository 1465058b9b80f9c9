"""Main text of pages by a linear-chain conditional random field over leaf blocks.

Each block has features of its ancestors (tags, what their class, id and role say) and of its text
(length, share inside links, signs). Two labels, main and other, with weights for features and for
pairs of neighbouring labels, are trained by gradient ascent on the likelihood of labelled pages
(forward-backward, numpy) and decoded by Viterbi. Labelled pages come from ``labelled_pages``, a generator
of varied layouts with a fixed seed and a documented number; own labelled pages can be used instead.

Defined cases: a null or empty page has an empty text, as has a page without main blocks; equal rows
get a row each; ids and addresses pass through, null or not; further columns are ignored.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edispark.llm.html_blocks import Block, Node, blocks, named
from edispark.shipping import ship

#: What words in class, id and role attributes say about an element.
SAYS = {
    "menu": "nav navbar navigation menu menus breadcrumb breadcrumbs crumbs topbar toolbar tabs pagination pager paging toc skip subnav sitemap submenu dropdown offcanvas hamburger",
    "header": "header masthead banner logo branding topnav hero site-title sitename tagline top",
    "footer": "footer foot bottom colophon copyright contentinfo legal imprint credits",
    "side": "sidebar side aside complementary rail widget widgets related recommended recommendations trending popular recent teaser teasers more archive tags tagcloud categories bio author authorbox sidebox",
    "ad": "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promos promotion promoted adsense dfp banner-ad adbox adslot adunit affiliate outbrain taboola commercial",
    "notice": "cookie cookies consent gdpr notice notices alert alerts popup modal overlay disclaimer newsletter subscribe subscription signup paywall toast privacy optin warning message infobar",
    "form": "form search searchbox login register contact input field fields poll survey",
    "comment": "comment comments commentlist respond reply replies disqus discussion responses feedback reviews thread guestbook usercomments",
    "share": "share sharing social follow tweet buttons tools actions print meta",
    "main": "main content article post entry story body text articlebody maincontent primary page blog hentry single prose copy news document",
}
_WORD_SAYS = {w: k for k, words in SAYS.items() for w in words.split()}
_TOKEN = re.compile(r"[a-z]+")
_ANCESTORS = frozenset("nav header footer aside article main section form ul ol table blockquote figure details dialog menu address fieldset pre dl div".split())


@lru_cache(maxsize=8192)
def _said(attrs: str) -> tuple[str, ...]:
    if not attrs.strip():
        return ()
    out = set()
    for name, value in named(attrs):
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
            out.add("hidden")
        elif name in ("class", "id", "role", "itemprop"):
            for word in value.split():
                if word in _WORD_SAYS:
                    out.add(_WORD_SAYS[word])
                else:
                    out |= {_WORD_SAYS[t] for t in _TOKEN.findall(word) if t in _WORD_SAYS}
    return tuple(sorted(out))


#: What an element inherits: (features of it and all elements around it, what the innermost telling one says).
State = tuple[frozenset[str], str | None]
_NO_STATE: State = (frozenset(), None)
_NEXT: dict[tuple, State] = {}


def _inherited(up: State, tag: str, said: tuple[str, ...]) -> State:
    got = _NEXT.get((up, tag, said))
    if got is None:
        out, inner = set(up[0]), up[1]
        if tag in _ANCESTORS:
            out.add(f"in:{tag}")
        out |= {f"says:{s}" for s in said}
        for s in said:
            if s != "main" or inner is None:
                inner = s
        if tag in ("nav", "aside", "footer", "form", "article", "main"):
            inner = tag
        if len(_NEXT) > 100_000:
            _NEXT.clear()
        got = _NEXT[up, tag, said] = (frozenset(out), inner)
    return got


def state_of(node: Node | None) -> State:
    """An element's state from the next one around it whose state is known; each element is looked at once."""
    waiting = []
    while node is not None and node.state is None:
        waiting.append(node)
        node = node.up
    state = _NO_STATE if node is None else node.state
    for e in reversed(waiting):
        state = e.state = _inherited(state, e.tag, _said(e.attrs))
    return state


def path_key(node: Node | None) -> tuple:
    """What ``path_features`` depends on."""
    return (state_of(node), *((node.tag, _said(node.attrs)) if node is not None else (None, ())))


@lru_cache(maxsize=65536)
def path_features(key: tuple) -> tuple[str, ...]:
    (inherited, inner), tag, said = key
    out = {"bias", *inherited, f"inner:{inner}"}
    if tag is not None:
        out.add(f"leaf:{tag}")
        out |= {f"leafsays:{s}" for s in said}
    if not out & {f"says:{s}" for s in SAYS if s != "main"} and not out & {"in:nav", "in:aside", "in:footer", "in:form", "in:header", "in:dialog"}:
        out.add("plain")
    return tuple(sorted(out))


def text_features(b: Block, first: bool) -> list[str]:
    n = b.text.count(" ") + 1
    share = b.linked / max(len(b.text), 1)
    out = [f"words:{0 if n < 2 else 1 if n < 4 else 2 if n < 9 else 3 if n < 20 else 4 if n < 60 else 5}", f"links:{0 if share == 0 else 1 if share < 0.25 else 2 if share < 0.75 else 3}"]
    if b.text[-1] in ".!?:;…\"'”»)":
        out.append("ends")
    if "©" in b.text or "opyright" in b.text or "ights reserved" in b.text:
        out.append("rights")
    if b.buttons * 2 > len(b.text):
        out.append("button")
    if first:
        out.append("first")
    return out


@dataclass
class Crf:
    """Weights of the label main against other, and of label pairs."""

    weights: dict[str, float] = field(default_factory=dict)
    pairs: tuple[tuple[float, float], tuple[float, float]] = ((0.0, 0.0), (0.0, 0.0))
    _paths: dict = field(default_factory=dict, repr=False)

    def score(self, b: Block, first: bool) -> float:
        key = path_key(b.node)
        got = self._paths.get(key)
        if got is None:
            if len(self._paths) > 50_000:
                self._paths.clear()
            got = self._paths[key] = sum(self.weights.get(f, 0.0) for f in path_features(key))
        return got + sum(self.weights.get(f, 0.0) for f in text_features(b, first))

    def decode(self, page: list[Block]) -> list[bool]:
        """The most probable labels, by Viterbi."""
        if not page:
            return []
        (oo, om), (mo, mm) = self.pairs
        other, main, back = 0.0, self.score(page[0], True), []
        for b in page[1:]:
            s = self.score(b, False)
            from_other = (other + oo >= main + mo, other + om >= main + mm)
            back.append(from_other)
            other, main = (other + oo if from_other[0] else main + mo), (other + om if from_other[1] else main + mm) + s
        label = main > other
        out = [label]
        for from_other in reversed(back):
            label = not from_other[label]
            out.append(label)
        return out[::-1]


def train(pages: list[tuple[list[Block], list[bool]]], steps: int = 120, rate: float = 0.1, l2: float = 1e-3) -> Crf:
    """Gradient ascent (Adam) on the mean log-likelihood of label sequences."""
    pages = [p for p in pages if p[0]]
    names: dict[str, int] = {}
    rows, cols, place = [], [], 0
    for page, _ in pages:
        for k, b in enumerate(page):
            for f in (*path_features(path_key(b.node)), *text_features(b, k == 0)):
                rows.append(place)
                cols.append(names.setdefault(f, len(names)))
            place += 1
    r, c = np.array(rows), np.array(cols)
    length = np.array([len(p) for p, _ in pages])
    start = np.concatenate([[0], np.cumsum(length)[:-1]])
    gold = np.concatenate([np.array(y, float) for _, y in pages])
    longest = length.max()
    spot = np.where(np.arange(longest)[None, :] < length[:, None], start[:, None] + np.arange(longest)[None, :], -1)
    inside = np.ones(place, bool)
    inside[start] = False
    gold_pairs = np.zeros((2, 2))
    here = np.flatnonzero(inside)
    np.add.at(gold_pairs, (gold[here - 1].astype(int), gold[here].astype(int)), 1)
    w, t = np.zeros(len(names)), np.zeros((2, 2))
    state = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(t), np.zeros_like(t)]

    def lse(x: np.ndarray, axis: int) -> np.ndarray:
        m = x.max(axis=axis, keepdims=True)
        return np.squeeze(m + np.log(np.exp(x - m).sum(axis=axis, keepdims=True)), axis)

    for step in range(1, steps + 1):
        s = np.bincount(r, weights=w[c], minlength=place)
        e = np.zeros((len(pages), longest, 2))
        e[:, :, 1] = np.where(spot >= 0, s[spot], 0)
        fwd, bwd = np.zeros_like(e), np.zeros_like(e)
        fwd[:, 0] = e[:, 0]
        for k in range(1, longest):
            new = lse(fwd[:, k - 1, :, None] + t[None], 1) + e[:, k]
            fwd[:, k] = np.where((spot[:, k] >= 0)[:, None], new, fwd[:, k - 1])
        for k in range(longest - 2, -1, -1):
            new = lse(t[None] + (e[:, k + 1] + bwd[:, k + 1])[:, None, :], 2)
            bwd[:, k] = np.where((spot[:, k + 1] >= 0)[:, None], new, 0)
        z = lse(fwd[:, -1], 1)
        p_main = np.exp(fwd[:, :, 1] + bwd[:, :, 1] - z[:, None])
        p = np.zeros(place)
        p[spot[spot >= 0]] = p_main[spot >= 0]
        both = np.exp(fwd[:, :-1, :, None] + t[None, None] + (e[:, 1:] + bwd[:, 1:])[:, :, None, :] - z[:, None, None, None])
        expected = (both * (spot[:, 1:] >= 0)[:, :, None, None]).sum(axis=(0, 1))
        grads = [np.bincount(c, weights=(gold - p)[r], minlength=len(w)) / len(pages) - l2 * w, (gold_pairs - expected) / len(pages) - l2 * t]
        for k, (g, par) in enumerate(zip(grads, (w, t), strict=True)):
            m, v = state[2 * k], state[2 * k + 1]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            par += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Crf({n: float(w[k]) for n, k in names.items()}, tuple(tuple(map(float, x)) for x in t))


# ---- labelled pages ----

_SYLLABLES = "ka lo mi ter an de su ri von el pra no ti gue sha or len fi co rem ble nd st ing er ou".split()


class _Maker:
    """Random pages whose main blocks are known by construction: their text carries a mark."""

    MARK = "␂"

    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def words(self, low: int, high: int) -> str:
        n = self.r.randint(low, high)
        out = ["".join(self.r.choice(_SYLLABLES) for _ in range(self.r.randint(1, 4))) for _ in range(n)]
        return " ".join(out)

    def sentence(self, low: int = 1, high: int = 25) -> str:
        s = self.words(low, high)
        return s[0].upper() + s[1:] + self.r.choice(["."] * 8 + ["!", "?", ""])

    def link(self, low: int = 1, high: int = 4) -> str:
        return f'<a href="/{self.words(1, 1)}">{self.words(low, high)}</a>'

    def cls(self, kind: str, also: str = "") -> str:
        words = SAYS[kind].split()
        w = self.r.choice(words[:14])
        w = self.r.choice([w, w, f"{w}-{self.words(1, 1)}", f"site-{w}", f"{w}-wrap", f"{w} {self.words(1, 1)}"])
        return f' {self.r.choice(["class", "class", "class", "id"])}="{w}"{also}'

    def paragraphs(self, n: int) -> str:
        """Main blocks of many kinds."""
        out = []
        for _ in range(n):
            x = self.r.random()
            s = " ".join(self.sentence() for _ in range(self.r.choice([1, 1, 2, 3, 6])))
            if self.r.random() < 0.15:
                s += " " + self.link() + " " + self.sentence(1, 6)
            if self.r.random() < 0.1:
                s = f"<b>{s}" + self.r.choice(["</b>", "<br>"])
            s = self.MARK + s
            if x < 0.72:
                out.append(f"<p>{s}" + self.r.choice(["</p>", "</p>", "</p>\n", ""]))
            elif x < 0.80:
                out.append(self.r.choice(["<h2>{}</h2>", "<h3>{}</h3>", "<h4>{}</h4>"]).format(self.MARK + self.words(1, 8)))
            elif x < 0.87:
                out.append("<ul>" + "".join(f"<li>{self.MARK}{self.sentence(1, 12)}</li>" for _ in range(self.r.randint(1, 4))) + "</ul>")
            elif x < 0.92:
                out.append(f"<blockquote><p>{s}</p></blockquote>")
            elif x < 0.95:
                out.append("<table><tr>" + "".join(f"<td>{self.MARK}{self.words(1, 3)}</td>" for _ in range(3)) + "</tr></table>")
            elif x < 0.97:
                out.append(f"<figure><img src=x><figcaption>{s}</figcaption></figure>")
            else:
                out.append(f"<div>{s}</div>")
        return "".join(out)

    def linked_list(self) -> str:
        return "<ul>" + "".join(f"<li>{self.link()}</li>" for _ in range(self.r.randint(2, 7))) + "</ul>"

    def other(self, kind: str) -> str:
        """A block of page furniture of one kind, with text as long as an article's at times."""
        r, tag = self.r, self.r.choice
        said = self.cls(kind) if kind in SAYS else ""
        talk = "".join(f"<p>{self.sentence()}</p>" for _ in range(r.randint(1, 3))) if r.random() < 0.5 else " ".join(self.sentence() for _ in range(r.randint(1, 3)))
        if kind == "menu":
            return tag([f"<nav>{self.linked_list()}</nav>", f"<nav{said}>{self.linked_list()}</nav>", f"<div{said}>{self.linked_list()}</div>", f"<div{said}>{self.link()} &raquo; {self.link()}</div>", f'<div role="navigation">{self.linked_list()}</div>'])
        if kind == "header":
            return tag([f"<header><a href=/>{self.words(1, 3)}</a><p>{self.sentence(2, 8)}</p></header>", f"<header{said}><h2>{self.words(1, 4)}</h2></header>", f"<div{said}><span>{self.words(1, 4)}</span></div>", f"<header><div>{self.words(1, 3)}</div>{self.linked_list()}</header>"])
        if kind == "footer":
            own = f"&copy; {self.words(1, 2)} &middot; {self.sentence()}"
            return tag([f"<footer>{own}</footer>", f"<footer{said}><p>{own}</p>{self.linked_list()}</footer>", f"<div{said}><p>{self.sentence()}</p></div>", f"<footer>{talk}</footer>"])
        if kind == "side":
            return tag([f"<aside><h3>{self.words(1, 3)}</h3>{self.linked_list()}</aside>", f"<aside{said}>{talk}</aside>", f"<div{said}><h4>{self.words(1, 3)}</h4>{self.linked_list()}</div>", f"<aside>{talk}</aside>", f"<div{said}>{talk}</div>", f"<section{said}>{self.linked_list()}</section>"])
        if kind == "form":
            return tag([f"<form><label>{self.words(1, 3)}</label><input><button>{self.words(1, 2)}</button></form>", f"<form{said}><p>{self.sentence()}</p><input><button>{self.words(1, 1)}</button></form>", f"<div{said}><label>{self.words(1, 3)}</label><button>{self.words(1, 1)}</button></div>", f"<form><fieldset>{talk}<select><option>{self.words(1, 1)}</select></fieldset></form>"])
        if kind == "comment":
            said = self.cls("comment")
            one = "".join(tag([f'<div class="comment"><b>{self.words(1, 2)}</b><p>{self.sentence(3, 30)}</p></div>', f"<li><p>{self.sentence(3, 30)} {self.sentence()}</p></li>", f"<article class=comment><p>{self.sentence(3, 30)}</p></article>", f"<p>{self.sentence(3, 30)}</p>"]) for _ in range(r.randint(1, 5)))
            return tag([f"<section{said}><h3>{self.words(1, 3)}</h3>{one}</section>", f"<div{said}>{one}</div>", f"<ol{said}>{one}</ol>", f"<div{said}><h2>{self.words(1, 2)}</h2>{one}</div>"])
        if kind == "hidden":
            return tag([f"<div hidden>{talk}</div>", f'<div style="display:none">{talk}</div>', f'<p aria-hidden="true">{self.sentence()}</p>'])
        return tag([f"<div{said}>{talk}</div>", f"<div{said}>{self.sentence()}</div>", f"<section{said}>{talk}</section>", f"<p{said}>{self.sentence()}</p>", f"<aside{said}>{talk}</aside>", f"<div{said}><span>{self.sentence()}</span> {self.link()}</div>"])

    def page(self) -> str:
        r = self.r
        kinds = ["menu", "ad", "side", "notice", "share", "form", "hidden"]
        before = ["header"] * (r.random() < 0.5) + ["menu"] * (r.random() < 0.8) + [r.choice(kinds) for _ in range(r.choice([0, 1, 1, 2, 3]))]
        after = [r.choice(kinds) for _ in range(r.choice([0, 0, 1, 2, 3]))] + ["comment"] * (r.random() < 0.4) + ["side"] * (r.random() < 0.2) + ["footer"] * (r.random() < 0.8)
        title = f"<h1>{self.MARK}{self.words(1, 10)}</h1>" if r.random() < 0.85 else ""
        pieces = [self.paragraphs(r.choice([1, 1, 2, 3, 6, 12]))]
        for _ in range(r.choice([0, 0, 0, 1, 2])):
            pieces += [self.other(r.choice(["ad", "share", "form", "side", "notice", "ad", "menu", "comment"])), self.paragraphs(r.randint(1, 4))]
        if title and r.random() < 0.1:
            title = f"<header>{title}</header>"
        body = title + "".join(pieces)
        said = self.cls("main")
        wrap = r.random()
        body = (
            f"<article>{body}</article>" if wrap < 0.4 else f"<main>{body}</main>" if wrap < 0.5 else f"<main><article{said}>{body}</article></main>" if wrap < 0.6
            else f"<div{said}>{body}</div>" if wrap < 0.8 else f"<div><div{said}>{body}</div></div>" if wrap < 0.88 else f"<div>{body}</div>" if wrap < 0.96 else body
        )
        parts = "".join(self.other(k) for k in before) + body + "".join(self.other(k) for k in after)
        if r.random() < 0.3:
            parts = f"<div id=\"{r.choice(['wrapper', 'container', 'page', 'app', 'root'])}\">{parts}</div>"
        head = f"<!DOCTYPE html><html><head><title>{self.words(1, 5)}</title><script>var a='<p>';</script></head><body>"
        return head + parts + "</body></html>"


def labelled_pages(n: int = 1000, seed: int = 11) -> list[tuple[list[Block], list[bool]]]:
    """``n`` made-up pages as blocks with the label main or not."""
    maker, out = _Maker(seed), []
    for _ in range(n):
        page = blocks(maker.page())
        labels = [_Maker.MARK in b.text for b in page]
        for b in page:
            b.text = b.text.replace(_Maker.MARK, "") or "x"
        out.append((page, labels))
    return out


@lru_cache(maxsize=1)
def default_model() -> Crf:
    return train(labelled_pages())


def main_text(html: str | None, model: Crf) -> str:
    page = blocks(html or "")
    return "\n".join(b.text for b, keep in zip(page, model.decode(page), strict=True) if keep)


def extracted(pages: DataFrame, model: Crf | None = None, html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every row; trains on ``labelled_pages`` if no model is given."""
    spark = pages.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(model or default_model())

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crf = sent.value
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                texts = [main_text(h, crf) for h in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    src = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col(html_col).alias("html"))
    return src.mapInArrow(over, "page_id long, url string, text string, n_chars long")
