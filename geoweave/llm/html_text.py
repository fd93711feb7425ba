"""Main text of web pages by a recurrent block labeller.

A page becomes a sequence of leaf blocks: runs of text between block-level tags, each with its tag
path. A block's input is the hashed vector of its tag path (tags, class, id and role words of all
open elements, nearer ones apart), the hashed vector of its words, and a few shape numbers. A
bidirectional LSTM in numpy reads the whole sequence, so every block is labelled with the page
around it in view; blocks labelled main are joined in page order.

The network is trained here, on pages that ``layouts`` composes from a grammar of page parts with
invented words (seeded, so every process trains the same weights). It runs inside ``mapInArrow`` on
batches of pages of like length.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoweave.llm.arrays import words

PATH, WORDS, SHAPE = 160, 64, 10
INPUT = PATH + WORDS + SHAPE
HIDDEN = 24

# ---- blocks ----------------------------------------------------------------------------------

_TAG = re.compile(
    r"<!--(?:.*?-->|.*\Z)"  # comment, also one that never ends
    r"|<[!?][^>]*(?:>|\Z)"
    r"|</?[a-zA-Z](?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>"
    r"|</?[a-zA-Z][^>]*+(?:>|\Z)",  # a quote that never ends, or the page does
    re.S,
)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_MARKS = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_PIECE = re.compile(r"[a-z]+|[A-Z][a-z]*")
_SPACE = re.compile(r"\s+")

#: fixed values of HTML
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data dfn em font i ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr del img".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: elements whose content is no text of the page
UNREAD = frozenset("head title script style noscript template svg iframe object select textarea math canvas audio video".split())
RAW = frozenset("title script style noscript iframe textarea".split())
#: an opening tag of the key closes an open element of the value
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
#: elements that may stand in a head; any other opening tag ends it, closed or not
HEAD = frozenset("head title meta link base basefont bgsound script style noscript template".split())
_SCOPES = frozenset("div article section main aside nav header footer body table ul ol dl form blockquote td th li figure".split())


@dataclass
class Block:
    path: tuple[str, ...]
    text: str
    link: int  # characters inside links


def blocks(page: str) -> list[Block]:
    """Leaf blocks of a page in order, white space collapsed, without empty ones.

    Scripts, styles, the head and other unread elements give none. Tags that never close and pages
    that are cut off anywhere are read as far as they go.
    """
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    held: list[str] = []
    link = unread = links = 0

    def end_block() -> None:
        nonlocal held, link
        if held:
            text = "".join(held)
            if "&" in text:
                text = html.unescape(text)
            text = " ".join(text.split())
            if text:
                out.append(Block(tuple(m for name, marks in stack if name not in INLINE for m in marks), text, link))
            held = []
        link = 0

    def push(name: str, marks: tuple[str, ...]) -> None:
        nonlocal unread, links
        stack.append((name, marks))
        unread += name in UNREAD
        links += name == "a"

    def cut(k: int) -> None:
        nonlocal unread, links
        for name, _ in stack[k:]:
            unread -= name in UNREAD
            links -= name == "a"
        del stack[k:]

    def close(names) -> None:
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in names:
                cut(k)
                return
            if stack[k][0] in _SCOPES:
                return

    at = 0
    while True:
        m = _TAG.search(page, at)
        end = m.start() if m else len(page)
        if unread and stack[-1][0] == "head" and page[at:end].strip():  # words end a head, as other tags do
            close(("head",))
        if not unread:
            text = page[at:end]
            if text:
                held.append(text)
                if links:
                    link += len(text)
        if m is None:
            break
        at = m.end()
        tag = m.group()
        if tag[1] in "!?":
            continue
        name = _NAME.match(tag)[1].lower()
        inline = name in INLINE
        if tag[1] == "/":
            if not inline:
                end_block()
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    cut(k)
                    break
                if inline and stack[k][0] not in INLINE:
                    break
            continue
        if not inline:
            end_block()
            if name in CLOSES:
                close(CLOSES[name])
            elif name not in VOID:
                close(("p",))
            if name == "body":  # a head that never closed
                close(("head",))
        if unread and stack[-1][0] == "head" and name not in HEAD:
            close(("head",))
        if name in VOID or tag.endswith("/>") and name not in RAW:
            continue
        if name in RAW:
            found = re.compile(f"</{name}", re.I).search(page, at)
            end = found.start() if found else len(page)
            if not unread and name not in UNREAD:
                held.append(page[at:end])
            at = end
        marks = [name]
        if "=" in tag:
            for g in _MARKS.findall(tag):
                marks += ["." + w.lower() for w in _PIECE.findall("".join(g))[:6]]
        push(name, tuple(marks))
    end_block()
    return out


# ---- vectors ---------------------------------------------------------------------------------


@lru_cache(maxsize=20_000)
def _path_vector(path: tuple[str, ...]) -> np.ndarray:
    """Hashed signs of the path; the last three entries are also hashed by their place from the end."""
    v = np.zeros(PATH, np.float32)
    signs = [*dict.fromkeys(path), *(f"{k}^{x}" for k, x in enumerate(reversed(path[-3:])))]
    for s in signs:
        h = zlib.crc32(s.encode())
        v[h % PATH] += 1 if h >> 31 else -1
    return np.clip(v, -2, 2)


_STOP = frozenset(".!?…\"'”»")
_POINTS = np.zeros(256, np.int64)
_POINTS[list(b".,;")] = 1


def vectors(pages: list[list[Block]]) -> list[np.ndarray]:
    """``(blocks, INPUT)`` inputs of every page; no page is empty."""
    every = [b for page in pages for b in page]
    n = len(every)
    texts = [b.text for b in every]
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    data = np.frombuffer(b"".join(raw), np.uint8)
    h, row, _, _ = words(data, offsets)
    count = np.bincount(row, minlength=n)
    bag = np.bincount(row * WORDS + (h % np.uint64(WORDS)).astype(np.int64), minlength=n * WORDS).reshape(n, WORDS)
    size = np.array([len(t) for t in texts])
    lengths = np.array([len(p) for p in pages])
    place = np.arange(n) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    of = np.repeat(lengths, lengths)
    x = np.empty((n, INPUT), np.float32)
    x[:, :PATH] = [_path_vector(b.path) for b in every]
    x[:, PATH : PATH + WORDS] = bag / np.sqrt(np.maximum((bag * bag).sum(1, keepdims=True), 1))
    shape = x[:, PATH + WORDS :]
    shape[:, 0] = np.log1p(count) / 4
    shape[:, 1] = np.minimum(1.0, np.array([b.link for b in every]) / size)
    shape[:, 2] = [t[-1] in _STOP for t in texts]
    shape[:, 3] = np.add.reduceat(_POINTS[data], offsets[:-1]) * 8 / size
    shape[:, 4] = ["©" in t or "@" in t for t in texts]
    shape[:, 5] = place / of
    shape[:, 6] = (of - 1 - place) / of
    shape[:, 7] = count > 12
    shape[:, 8] = [t[0].isupper() for t in texts]
    shape[:, 9] = np.log1p(of) / 6
    return np.split(x, np.cumsum(lengths)[:-1])


# ---- network ---------------------------------------------------------------------------------


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _forward(x: np.ndarray, mask: np.ndarray, w: np.ndarray, u: np.ndarray, b: np.ndarray, keep: bool = False):
    """One direction over ``(steps, pages, INPUT)``; masked steps leave the state as it is."""
    steps, n, _ = x.shape
    h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
    pre = x.reshape(steps * n, -1) @ w + b
    pre = pre.reshape(steps, n, -1)
    out, tape = np.empty((steps, n, HIDDEN), np.float32), []
    for t in range(steps):
        z = pre[t] + h @ u
        i, f, o = (_sigmoid(z[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
        g = np.tanh(z[:, 3 * HIDDEN :])
        c2 = f * c + i * g
        th = np.tanh(c2)
        m = mask[t][:, None]
        if keep:
            tape.append((h, c, i, f, o, g, th, m))
        h, c = np.where(m, o * th, h), np.where(m, c2, c)
        out[t] = h
    return out, tape


def _backward(x, grad, tape, w, u):
    """Gradients of one direction from the gradient of its outputs."""
    steps, n, _ = x.shape
    dw, du, db = np.zeros_like(w), np.zeros_like(u), np.zeros(4 * HIDDEN, np.float32)
    dh, dc = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
    for t in range(steps - 1, -1, -1):
        h, c, i, f, o, g, th, m = tape[t]
        dh = dh + grad[t]
        dh_in, dc_in = dh * m, dc * m
        dc2 = dc_in + dh_in * o * (1 - th * th)
        dz = np.concatenate(
            [dc2 * g * i * (1 - i), dc2 * c * f * (1 - f), dh_in * th * o * (1 - o), dc2 * i * (1 - g * g)], axis=1
        )
        dw += x[t].T @ dz
        du += h.T @ dz
        db += dz.sum(0)
        dh = dz @ u.T + dh * (1 - m)
        dc = dc2 * f + dc * (1 - m)
    return dw, du, db


def _flip(x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Every page's steps in reverse order, padding kept at the end."""
    out = x.copy()
    for k, n in enumerate(lengths):
        out[:n, k] = x[:n, k][::-1]
    return out


class Labeller:
    """Bidirectional LSTM with a logistic output per block."""

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.p = []
        for _ in range(2):
            self.p += [
                (rng.standard_normal((INPUT, 4 * HIDDEN)) / np.sqrt(INPUT)).astype(np.float32),
                (rng.standard_normal((HIDDEN, 4 * HIDDEN)) / np.sqrt(HIDDEN)).astype(np.float32),
                np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)]).astype(np.float32),
            ]
        self.p += [(rng.standard_normal((2 * HIDDEN, 1)) * 0.1).astype(np.float32), np.zeros(1, np.float32)]

    def _pad(self, pages: list[np.ndarray]):
        lengths = np.array([len(p) for p in pages])
        x = np.zeros((lengths.max(), len(pages), INPUT), np.float32)
        for k, p in enumerate(pages):
            x[: len(p), k] = p
        return x, lengths, np.arange(lengths.max())[:, None] < lengths[None]

    def probabilities(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Probability of being main text for every block of every page (none of them empty)."""
        x, lengths, mask = self._pad(pages)
        a, _ = _forward(x, mask, *self.p[:3])
        b, _ = _forward(_flip(x, lengths), mask, *self.p[3:6])
        both = np.concatenate([a, _flip(b, lengths)], axis=2)
        y = _sigmoid(both @ self.p[6] + self.p[7])[:, :, 0]
        return [y[:n, k] for k, n in enumerate(lengths)]

    def train(self, pages: list[np.ndarray], labels: list[np.ndarray], epochs: int = 12, rate: float = 0.01, seed: int = 5) -> None:
        """Adam on the mean cross entropy of blocks, pages in batches of like length."""
        rng = np.random.default_rng(seed)
        m1, m2, step = [np.zeros_like(p) for p in self.p], [np.zeros_like(p) for p in self.p], 0
        order = np.argsort([len(p) for p in pages], kind="stable")
        batches = [order[a : a + 32] for a in range(0, len(order), 32)]
        for _ in range(epochs):
            for k in rng.permutation(len(batches)):
                part = batches[k]
                x, lengths, mask = self._pad([pages[i] for i in part])
                y = np.zeros(mask.shape, np.float32)
                for j, i in enumerate(part):
                    y[: lengths[j], j] = labels[i]
                xr = _flip(x, lengths)
                a, ta = _forward(x, mask, *self.p[:3], keep=True)
                b, tb = _forward(xr, mask, *self.p[3:6], keep=True)
                both = np.concatenate([a, _flip(b, lengths)], axis=2)
                p = _sigmoid(both @ self.p[6] + self.p[7])[:, :, 0]
                d = ((p - y) * mask / mask.sum())[:, :, None].astype(np.float32)
                flat = both.reshape(-1, 2 * HIDDEN)
                grads_out = [flat.T @ d.reshape(-1, 1), d.sum().reshape(1)]
                back = d @ self.p[6].T
                ga = _backward(x, back[:, :, :HIDDEN], ta, self.p[0], self.p[1])
                gb = _backward(xr, _flip(back[:, :, HIDDEN:], lengths), tb, self.p[3], self.p[4])
                step += 1
                for q, g in enumerate([*ga, *gb, *grads_out]):
                    g = np.clip(g, -1, 1)
                    m1[q] += 0.1 * (g - m1[q])
                    m2[q] += 0.01 * (g * g - m2[q])
                    self.p[q] -= (rate * (m1[q] / (1 - 0.9**step)) / (np.sqrt(m2[q] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
            rate *= 0.85


# ---- training pages --------------------------------------------------------------------------


def layouts(n: int, seed: int = 3) -> Iterator[tuple[str, str]]:
    """``n`` composed pages with their main text. Parts, wrappers, names and order vary; the words
    are invented, but for the few that mark furniture."""
    rng = np.random.default_rng(seed)
    pick = lambda *x: x[rng.integers(len(x))]
    chance = lambda p: rng.random() < p
    sounds = [a + b for a in "b d f g k l m n p r s t v th ch ñ é ü".split() for b in "a e i o u an er ión ou".split()]

    def word() -> str:
        return "".join(pick(*sounds) for _ in range(int(rng.integers(1, 4))))

    def prose(lo: int, hi: int) -> str:
        if hi > 12 and chance(0.12):  # odd texts: one word, signs between words, one word again and again, shouting
            lo, hi = pick((1, 1), (1, 3), (lo, hi))
            w, n = word(), int(rng.integers(lo, hi + 1))
            return pick(w.title() + ".", " | ".join(word() for _ in range(n)) + " |", " ".join([w] * n), "!! ".join(word().upper() for _ in range(n)) + "!!", " ".join(word() + pick("%%%", "***", "$$$") for _ in range(n)))
        out = []
        for _ in range(int(rng.integers(lo, hi + 1))):
            w = word()
            out.append(w.upper() + "!!" if chance(0.01) else w + pick("", "", "", "", ",", ".", ";"))
        text = " ".join(out)
        return (text[:1].upper() + text[1:]).rstrip(",;.") + pick(".", ".", ".", "")

    def links(k: int) -> list[str]:
        return [f'<a href="/{word()}">{prose(1, 3)}</a>' for _ in range(k)]

    def boiler(kind: str) -> str:
        name = {"sidebar": pick("sidebar", "side", "rail", "widget", "col-right"), "ad": pick("ad", "ads", "advert", "sponsored", "promo", "banner"),
                "notice": pick("notice", "cookie-notice", "alert", "consent", "gdpr", "warning"), "comments": pick("comments", "comment-list", "discussion", "replies", "responses"),
                "related": pick("related", "more", "recommended", "tags", "share", "social"), "form": pick("newsletter", "search", "subscribe", "signup", "login", "contact"),
                "menu": pick("nav", "menu", "navbar", "breadcrumb", "topnav"), "header": pick("header", "masthead", "site-header", "top", "branding"), "footer": pick("footer", "site-footer", "bottom", "copyright", "colophon")}[kind]
        attr = f' {pick("class", "class", "id")}="{name}{pick("", "", " box", "-wrap", " block")}"'
        if kind == "menu":
            tag = pick("nav", "nav", "div", "ul")
            items = links(int(rng.integers(2, 9)))
            body = "<ul>" + "".join(f"<li>{x}</li>" if chance(0.9) else f"<li>{x}" for x in items) + "</ul>" if chance(0.7) else pick(" | ", " ", "").join(items)
            return f"<{tag}{attr if tag != 'nav' or chance(0.4) else ''}>{body}</{tag}>"
        if kind == "header":
            tag = pick("header", "header", "div")
            body = pick(f"<h1>{prose(1, 4)}</h1>", f"<a href='/'>{prose(1, 3)}</a>", f"<p>{prose(2, 8)}</p>", f"<span>{prose(1, 4)}</span>")
            return f"<{tag}{attr if tag == 'div' or chance(0.5) else ''}>{body}{boiler('menu') if chance(0.4) else ''}</{tag}>"
        if kind == "footer":
            tag = pick("footer", "footer", "div")
            body = pick("&copy; ", "&copy; ", "", "Copyright ") + prose(1, 4) + pick(" &middot; ", " | ", ". ") + prose(1, 9)
            body = pick(body, f"<p>{body}</p>", body + "<ul>" + "".join(f"<li>{x}</li>" for x in links(3)) + "</ul>")
            return f"<{tag}{attr if tag == 'div' or chance(0.4) else ''}>{body}</{tag}>"
        if kind == "form":
            return f"<form{attr if chance(0.6) else ''}><label>{prose(1, 4)}</label><input type=text>{f'<p>{prose(3, 14)}</p>' if chance(0.5) else ''}<button>{prose(1, 2)}</button></form>"
        if kind == "comments":
            tag = pick("div", "section", "ol", "aside")
            item = lambda: f"<{pick('div', 'li', 'article')} class='{pick('comment', 'reply', 'comment-body')}'><b>{word()}</b> <p>{prose(4, 45)}</p></div>"
            head = f"<{pick('h2', 'h3')}>{pick('Comments', 'Discussion', prose(1, 3))}</{pick('h2', 'h3')}>" if chance(0.6) else ""
            return f"<{tag}{attr}>{head}{''.join(item() for _ in range(int(rng.integers(1, 5))))}</{tag}>"
        tag = {"sidebar": pick("aside", "aside", "div", "section"), "ad": pick("div", "div", "aside", "section", "p"), "notice": pick("div", "div", "p", "section"), "related": pick("div", "aside", "section")}[kind]
        body = pick(f"<p>{prose(3, 40)}</p>", prose(3, 30), "<ul>" + "".join(f"<li>{x}</li>" for x in links(4)) + "</ul>", f"<h3>{prose(1, 3)}</h3><p>{prose(5, 30)}</p>")
        return f"<{tag}{attr if tag != 'aside' or chance(0.5) else ''}>{body}</{tag}>"

    def main() -> tuple[str, list[str]]:
        body, said = [], []

        def say(markup: str, text: str) -> None:
            body.append(markup.format(text))
            said.append(re.sub(r"<[^>]*>", "", text))

        if chance(0.85):
            say(f"<{pick('h1', 'h1', 'h2')}>{{}}</h1>", prose(1, 14))
        for _ in range(int(rng.integers(20, 60)) if chance(0.06) else int(rng.integers(1, 9))):
            kind = pick("p", "p", "p", "p", "p", "p", "p", "p", "open", "br", "list", "quote", "head", "table", "pre", "inline", "plain")
            if kind == "p":
                say("<p>{}</p>", prose(1, 70))
            elif kind == "open":
                say("<p><b>{}<br>" if chance(0.5) else "<p>{}", prose(4, 60))
            elif kind == "br":
                say("<p>{}<br>", prose(3, 30))
                say("{}</p>", prose(3, 30))
            elif kind == "list":
                body.append(pick("<ul>", "<ol>"))
                for _ in range(int(rng.integers(1, 5))):
                    say("<li>{}</li>", prose(2, 20))
                body.append("</ul></ol>")
            elif kind == "quote":
                say("<blockquote>{}</blockquote>", prose(4, 40))
            elif kind == "head":
                say(f"<{pick('h2', 'h3', 'h4')}>{{}}</h2>", prose(1, 8))
            elif kind == "table":
                body.append("<table>")
                for _ in range(int(rng.integers(1, 4))):
                    body.append("<tr>")
                    say("<td>{}</td>", prose(1, 6))
                    say("<td>{}</td>", prose(1, 6))
                    body.append("</tr>")
                body.append("</table>")
            elif kind == "pre":
                say("<pre>{}</pre>", prose(3, 20))
            elif kind == "inline":
                say("<p>{}</p>", f"{prose(2, 20)} <a href='/{word()}'>{prose(1, 4)}</a> <em>{word()}</em> {prose(2, 20)}")
            else:
                say("<div>{}</div>", prose(5, 50))
            if chance(0.07):
                body.append(boiler(pick("ad", "notice", "related", "sidebar", "form")))
        return "".join(body), said

    for _ in range(n):
        body, said = main()
        tag, attr = pick(("article", ""), ("article", ""), ("article", ' class="post"'), ("main", ""), ("div", ' class="content"'), ("div", ' id="main"'),
                         ("div", ' class="article-body"'), ("section", ' class="entry"'), ("div", ' class="post-text"'), ("td", ""), ("div", ""))
        if chance(0.12):
            body += boiler("comments")
        middle = f"<{tag}{attr}>{body}</{tag}>"
        if tag == "article" and chance(0.3):
            middle = f"<main>{middle}</main>"
        before = [boiler(k) for k in ("header", "menu", "notice", "ad", "form", "sidebar") if chance(0.4)]
        after = [boiler(k) for k in ("comments", "related", "sidebar", "ad", "form", "notice") if chance(0.3)] + [boiler("footer")] * chance(0.85)
        rng.shuffle(before)
        page = f"<html><head><title>{prose(1, 8)}</title><style>p{{}}</style></head><body>" + "".join(before) + middle + "".join(after) + pick("</body></html>", "")
        yield page, " ".join(_SPACE.sub(" ", html.unescape(s)).strip() for s in said)


def _taught(page: str, main: str) -> tuple[np.ndarray, np.ndarray]:
    """Inputs and labels of a composed page: its main blocks follow the main text in order."""
    found, at, labels = blocks(page), 0, []
    for b in found:
        hit = main.startswith(b.text, at)
        labels.append(hit)
        if hit:
            at += len(b.text) + 1
    return (vectors([found])[0] if found else np.zeros((0, INPUT), np.float32)), np.array(labels, np.float32)


@lru_cache(maxsize=2)
def trained(pages: int = 1400, epochs: int = 14) -> Labeller:
    """The labeller, trained on first use (seeded: the same in every process)."""
    taught = [_taught(p, m) for p, m in layouts(pages)]
    taught = [t for t in taught if len(t[0])]
    model = Labeller()
    model.train([t[0] for t in taught], [t[1] for t in taught], epochs)
    return model


# ---- Spark -----------------------------------------------------------------------------------


def main_texts(pages: list[str], model: Labeller, batch_blocks: int = 4096) -> list[str]:
    """Main text of every page, pages of like length labelled together."""
    out = [""] * len(pages)
    read = [blocks(p) for p in pages]
    order = sorted((i for i, b in enumerate(read) if b), key=lambda i: len(read[i]))
    at = 0
    while at < len(order):
        end = at + 1
        while end < len(order) and end - at < 64 and len(read[order[end]]) * (end + 1 - at) <= batch_blocks:
            end += 1
        part = order[at:end]
        for i, p in zip(part, model.probabilities(vectors([read[i] for i in part])), strict=True):
            out[i] = " ".join(b.text for b, y in zip(read[i], p, strict=True) if y >= 0.5)
        at = end
    return out


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(id_col, url_col, text, n_chars)`` per row of ``pages``; the whole html is read.

    Null and empty html and pages without a main block give an empty text. Repeated rows and rows with
    a null id are read each; an empty table gives an empty result; other columns are ignored.
    """
    shared = pages.sparkSession.sparkContext.broadcast(trained().p)  # some 60,000 numbers
    source = pages.select(id_col, url_col, F.coalesce(F.col(html_col), F.lit("")).alias("_html"))
    schema = source.drop("_html").withColumn("text", F.lit("")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Labeller()
        model.p = shared.value
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                texts = main_texts(part.column("_html").to_pylist(), model)
                yield pa.RecordBatch.from_arrays(
                    [part.column(id_col), part.column(url_col), pa.array(texts, pa.string())], [id_col, url_col, "text"]
                )

    return source.mapInArrow(run, schema).withColumn("n_chars", F.char_length("text").cast("long"))
