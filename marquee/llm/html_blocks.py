"""HTML extraction by a recurrent block labeller.

A page is cut into leaf blocks: the text between two block-level tags, with
the path of open elements above it.  Each block becomes a vector of hashed path parts (tags, classes and
ids), hashed words and a few shape measures (length, share of link text,
punctuation, place).  A bidirectional LSTM in numpy reads the page's blocks in
order, so each is judged in the context of the whole page, and a logistic
output says whether it belongs to the article.

Training.  Pages carry no labels, so the labeller learns from pages that are
put together from the roles a page can have (menus, headers, footers, sidebars, notices, adverts, forms, comments, and
articles), each with the element names and class words usual for it, filled
with words from about ``SAMPLE_PAGES`` pages of the table.  Their labels are known as they are
built; seeds are fixed, so the same table gives the same model.

Text.  Scripts, styles, templates and comments are dropped; character
references are decoded; white space in a block (line breaks included) becomes one space; the
article's blocks are joined by one space, none capped.

Cases: null or empty html, or a page without article blocks: empty text;
unclosed and misnested elements: an element ends with its parent, a paragraph
or list item with the next one; stray quotes in a tag are part of a name or value; a last tag without its ``>`` is text; repeated rows are each answered; an empty
table gives no rows; other columns are kept, columns named as the outputs are replaced.
"""

from __future__ import annotations

import html
import random
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_column, text_chunks

SAMPLE_PAGES = 200
PATH_DIMS, WORD_DIMS, SHAPE_DIMS = 48, 16, 8
DIMS = PATH_DIMS + WORD_DIMS + SHAPE_DIMS
HIDDEN, EPOCHS, TRAINING_PAGES, GROUP = 16, 20, 1000, 32

# An attribute: a name, then perhaps a quoted or unquoted value.  Quotes in a name or inside an unquoted value
# are plain characters; a quote that nothing closes is one as well.  No part gives back what it took, and a tag or
# comment without an end reaches to the page's end, so a page is read in time linear in its length.
_ATTRIBUTES = (r"(?:[\s/]++|[^\s/>][^\s/>=]*+"
               r"(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+|(?=>)))?+)*+")
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|template|noscript)\b[^>]*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*(?:>|\Z)"
    rf"|<(/?)([a-zA-Z][^\s/>]*+)({_ATTRIBUTES})(>|\Z)", re.S | re.I)
_NAMES = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike "
                    "strong sub sup time tt u var wbr img".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An element of the key is ended by the start of one of the value.
_ENDED_BY = {"p": frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main "
                            "nav ol p pre section table ul".split()),
             "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
             "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]),
             "option": frozenset(["option"]), "head": frozenset(["body"])}


def blocks(page: str) -> list[tuple[tuple[str, ...], str, int]]:
    """Leaf blocks in page order: path parts, text, and the characters of it that stand in links."""
    out, stack, held, linked, links, at = [], [], [], 0, 0, 0

    def end() -> None:
        nonlocal held, linked
        if held:
            if text := " ".join(html.unescape("".join(held)).split()):
                out.append((tuple(part for _, parts in stack for part in parts), text, linked))
            held, linked = [], 0

    for m in _TOKEN.finditer(page):
        if m[5] == "":  # a tag that never ends is text
            break
        if m.start() > at:
            piece = page[at:m.start()]
            held.append(piece)
            if links:
                linked += len(piece)
        at = m.end()
        name = m[3]
        if name is None:
            continue
        name = name.lower()
        if name == "br":
            held.append("\n")
        elif name in _INLINE:
            if name == "a":
                links = 0 if m[2] else 1
        elif m[2]:
            end()
            if any(n == name for n, _ in stack):
                while stack.pop()[0] != name:
                    pass
        else:
            end()
            # The innermost element that this one ends, if no container stands between.
            for k in range(len(stack) - 1, -1, -1):
                if name in _ENDED_BY.get(stack[k][0], ()):
                    del stack[k:]
                    break
                if stack[k][0] in ("table", "ul", "ol", "div", "body", "article", "section"):
                    break
            if name not in _VOID and not m[4].endswith("/"):
                stack.append((name, _parts(name, m[4])))
    held.append(page[at:])
    end()
    return out


@lru_cache(maxsize=10_000)
def _parts(name: str, attributes: str) -> tuple[str, ...]:
    words = []
    for m in _NAMES.finditer(attributes):
        words += re.split(r"[\s_-]+", (m[1] or m[2] or m[3] or "").lower())
    return (name, *("." + w for w in words if w))


@lru_cache(maxsize=200_000)
def _hashed(word: str, dims: int) -> tuple[int, float]:
    h = xxhash.xxh3_64_intdigest(word)
    return (h >> 8) % dims, 1.0 if h & 1 else -1.0


@lru_cache(maxsize=20_000)
def _path_vector(path: tuple[str, ...]) -> np.ndarray:
    x = np.zeros(PATH_DIMS)
    for part in path:
        for seed in ("", "+"):  # two places each, so that chance meetings differ
            at, sign = _hashed(seed + part, PATH_DIMS)
            x[at] += sign
    return np.clip(x, -2, 2)


def vectors(page: list[tuple[tuple[str, ...], str, int]]) -> np.ndarray:
    x = np.zeros((len(page), DIMS))
    for k, (path, text, linked) in enumerate(page):
        x[k, :PATH_DIMS] = _path_vector(path)
        words = text.split(" ")
        for w in words:
            at, sign = _hashed(w, WORD_DIMS)
            x[k, PATH_DIMS + at] += sign
        n = len(text)
        own = x[k, PATH_DIMS:PATH_DIMS + WORD_DIMS]
        own /= max(1.0, np.sqrt((own * own).sum()))  # however often a word is repeated
        x[k, -SHAPE_DIMS:] = (min(1.4, np.log1p(n) / 5), min(1.3, np.log1p(len(words)) / 4), min(1.0, linked / n), text[-1] in ".!?",
                              text.count(",") / len(words), k / len(page), 1 / (1 + k), 1 / (len(page) - k))
    return x


class Lstm:
    """One direction; gates in the order input, forget, output, candidate."""

    def __init__(self, rng: np.random.Generator):
        scale = 1 / np.sqrt(DIMS + HIDDEN)
        self.w = rng.normal(0, scale, (DIMS + HIDDEN, 4 * HIDDEN))
        self.b = np.zeros(4 * HIDDEN)
        self.b[HIDDEN:2 * HIDDEN] = 1.0

    def forward(self, x: np.ndarray, there: np.ndarray, training: bool = True):
        """x: steps, pages, DIMS; there: steps, pages, 1 (zero past a page's end, where the state stands still).
        Only training keeps what each step's gradient needs."""
        steps, n, _ = x.shape
        h, c, out, kept = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN)), np.zeros((steps, n, HIDDEN)), []
        fixed = x @ self.w[:DIMS] + self.b
        for t in range(steps):
            z = fixed[t] + h @ self.w[DIMS:]
            gate = 1 / (1 + np.exp(-z[:, :3 * HIDDEN]))
            i, f, o = gate[:, :HIDDEN], gate[:, HIDDEN:2 * HIDDEN], gate[:, 2 * HIDDEN:]
            g = np.tanh(z[:, 3 * HIDDEN:])
            new_c = f * c + i * g
            tanh_c = np.tanh(new_c)
            if training:
                kept.append((h, c, i, f, o, g, tanh_c))
            m = there[t]
            c = m * new_c + (1 - m) * c
            h = m * (o * tanh_c) + (1 - m) * h
            out[t] = h
        return out, kept

    def backward(self, x, there, kept, slope):
        grad_w, grad_b = np.zeros_like(self.w), np.zeros_like(self.b)
        dh, dc = np.zeros_like(slope[0]), np.zeros_like(slope[0])
        for t in range(len(kept) - 1, -1, -1):
            h, c, i, f, o, g, tanh_c = kept[t]
            m = there[t]
            dh = dh + slope[t]
            own_h, own_c = dh * m, dc * m
            own_c = own_c + own_h * o * (1 - tanh_c ** 2)
            dz = np.concatenate([own_c * g * i * (1 - i), own_c * c * f * (1 - f), own_h * tanh_c * o * (1 - o),
                                 own_c * i * (1 - g ** 2)], axis=1)
            grad_w[:DIMS] += x[t].T @ dz
            grad_w[DIMS:] += h.T @ dz
            grad_b += dz.sum(axis=0)
            dh = dh * (1 - m) + dz @ self.w[DIMS:].T
            dc = dc * (1 - m) + own_c * f
        return grad_w, grad_b


class Labeller:
    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.ahead, self.back = Lstm(rng), Lstm(rng)
        self.out, self.bias = rng.normal(0, 0.1, 2 * HIDDEN + DIMS), np.zeros(1)

    @staticmethod
    def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        steps = max(map(len, pages))
        x, there = np.zeros((steps, len(pages), DIMS)), np.zeros((steps, len(pages), 1))
        for k, p in enumerate(pages):
            x[:len(p), k], there[:len(p), k] = p, 1
        return x, there

    def _run(self, x, there, training: bool = True):
        # Read from the last step to the first: a page's end is met before its blocks, where the state stands still.
        forward, kept = self.ahead.forward(x, there, training)
        backward, kept_back = self.back.forward(x[::-1], there[::-1], training)
        joined = np.concatenate([forward, backward[::-1], x], axis=2)
        return joined, kept, kept_back, 1 / (1 + np.exp(-(joined @ self.out + self.bias)))

    def predict(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Each page's blocks' probabilities of belonging to the article."""
        found: list[np.ndarray] = [np.zeros(0)] * len(pages)
        order = [k for k in sorted(range(len(pages)), key=lambda k: len(pages[k])) if len(pages[k])]
        at = 0
        while at < len(order):
            # Pages of like length together, and a bounded number of blocks.
            to = at + 1
            while to < len(order) and to - at < 256 and len(pages[order[to]]) * (to - at) < 20_000:
                to += 1
            own = order[at:to]
            share = self._run(*self._padded([pages[k] for k in own]), training=False)[3]
            for column, k in enumerate(own):
                found[k] = share[:len(pages[k]), column]
            at = to
        return found

    def fit(self, pages: list[np.ndarray], labels: list[np.ndarray], epochs: int = EPOCHS, seed: int = 7) -> Labeller:
        weights = [self.ahead.w, self.ahead.b, self.back.w, self.back.b, self.out, self.bias]
        first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
        rng, step = np.random.default_rng(seed), 0
        for _ in range(epochs):
            order = rng.permutation(len(pages))
            for at in range(0, len(order), GROUP):
                own = order[at:at + GROUP]
                x, there = self._padded([pages[k] for k in own])
                y = np.zeros(x.shape[:2])
                for column, k in enumerate(own):
                    y[:len(labels[k]), column] = labels[k]
                joined, kept, kept_back, share = self._run(x, there)
                wrong = (share - y) * there[:, :, 0] / there.sum()
                slope = wrong[:, :, None] * self.out
                aw, ab = self.ahead.backward(x, there, kept, slope[:, :, :HIDDEN])
                bw, bb = self.back.backward(x[::-1], there[::-1], kept_back, slope[::-1, :, HIDDEN:2 * HIDDEN])
                grads = [aw, ab, bw, bb, np.einsum("tnk,tn->k", joined, wrong), np.array([wrong.sum()])]
                step += 1
                for k, (w, g) in enumerate(zip(weights, grads, strict=True)):
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.99 * second[k] + 0.01 * g * g
                    w -= 0.02 * first[k] / (1 - 0.9 ** step) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)
        return self


# The element names and class words usual for each role of a page.
ROLES = {
    "menu": (["nav", "div", "ul"], ["menu", "nav", "navbar", "navigation", "topnav", "breadcrumb", "tabs"]),
    "header": (["header", "div"], ["header", "masthead", "site-header", "banner", "logo", "top"]),
    "footer": (["footer", "div"], ["footer", "site-footer", "copyright", "legal", "bottom"]),
    "sidebar": (["aside", "div", "section"], ["sidebar", "related", "widget", "recommended", "trending", "share", "social"]),
    "notice": (["div", "section", "p"], ["notice", "cookie", "consent", "alert", "gdpr", "popup", "newsletter", "paywall"]),
    "advert": (["div", "section", "aside"], ["ad", "ads", "advert", "advertisement", "sponsor", "sponsored", "promo"]),
    "form": (["form", "div"], ["form", "search", "login", "signup", "subscribe"]),
    "comments": (["section", "div", "ol"], ["comments", "comment", "replies", "discussion", "responses"]),
}
ARTICLE = (["article", "main", "div", "section"],
           ["article", "content", "post", "entry", "story", "body", "text", "main", "article-body", "post-content"])
FALLBACK_WORDS = ["some", "words", "that", "stand", "for", "a", "text"]


def _attributes(rng: random.Random, names: list[str], must: bool) -> str:
    if not must and rng.random() < 0.5:
        return ""
    word = rng.choice(names)
    word += rng.choice(["", "", "-" + rng.choice(["wrap", "box", "inner", "list", "1"])])
    return f' {rng.choice(["class", "class", "id"])}="{word}"'


def training_page(rng: random.Random, words: list[str]) -> tuple[str, list[int]]:
    """A page and its blocks' labels."""
    out, labels = [], []

    def text(low: int, high: int) -> str:
        own = rng.choices(words, k=rng.randint(low, high))
        # Every role also holds tables, repetition, capitals and signs: what a block says decides little.
        kind = rng.random()
        if kind < 0.07:
            own = own[:1] * len(own)
        elif kind < 0.14:
            return " | ".join(own)
        elif kind < 0.2:
            own = [w + rng.choice(["%%%", "***", "!!", "&amp;", ","]) for w in own]
        elif kind < 0.25:
            own = [w.upper() for w in own]
        elif kind < 0.3:
            own = [str(rng.randrange(10_000)) for _ in own]
        return " ".join(own)

    def leaf(tag: str, body: str, label: int) -> str:
        labels.append(label)
        return f"<{tag}>{body}" + (f"</{tag}>" if rng.random() < 0.9 or tag != "p" else "")

    def role(kind: str) -> str:
        tags, names = ROLES[kind]
        tag = rng.choice(tags)
        open_tag = f"<{tag}{_attributes(rng, names, tag in ('div', 'section', 'ul', 'ol', 'p'))}>"
        if kind == "menu":
            items = "".join(leaf("li", f'<a href="/x">{text(1, 3)}</a>', 0) for _ in range(rng.randint(2, 8)))
            return f"{open_tag}{items if tag == 'ul' else f'<ul>{items}</ul>'}</{tag}>"
        if kind == "form":
            inner = "".join(leaf(rng.choice(["p", "button", "div"]), text(1, 5), 0) for _ in range(rng.randint(1, 3)))
            return f"{open_tag}{inner}</{tag}>"
        if kind in ("comments", "sidebar") or rng.random() < 0.3:
            item = "li" if tag == "ol" else rng.choice(["p", "div"])
            high = 40 if kind == "comments" else 12
            inner = "".join(leaf(item, text(2, high), 0) for _ in range(rng.randint(1, 5)))
            return f"{open_tag}{inner}</{tag}>"
        labels.append(0)
        return f"{open_tag}{text(1, 25)}</{tag}>"

    def article() -> str:
        tag = rng.choice(ARTICLE[0])
        inner = [leaf("h1", text(2, 12), 1)] if rng.random() < 0.9 else []
        for _ in range(rng.choice([0, 1, 2, 3, 4, 6, 10, 18])):
            kind = rng.random()
            if kind < 0.7:
                body = text(2, rng.choice([10, 60, 150])) + rng.choice([".", "", "!"])
                inner.append(leaf("p", rng.choice([body, f"<b>{body}<br>", f'{body} <a href="/y">{text(1, 3)}</a>']), 1))
            elif kind < 0.78:
                inner.append(leaf(rng.choice(["h2", "h3"]), text(1, 8), 1))
            elif kind < 0.86:
                inner.append("<ul>" + "".join(leaf("li", text(1, 15), 1) for _ in range(rng.randint(1, 4))) + "</ul>")
            elif kind < 0.92:
                inner.append(leaf(rng.choice(["blockquote", "pre", "figcaption"]), text(3, 30), 1))
            else:
                inner.append(role(rng.choice(["advert", "sidebar", "form", "comments", "notice", "footer"])))
        if not inner:
            inner.append(leaf("p", text(1, 30), 1))
        return f"<{tag}{_attributes(rng, ARTICLE[1], tag in ('div', 'section'))}>{''.join(inner)}</{tag}>"

    out.append(f"<html><head>{leaf('title', text(2, 10), 0)}</head><body>")
    some = lambda kinds: [out.append(role(k)) for k in kinds if rng.random() < 0.5]
    some(["notice", "header", "menu", "menu", "advert", "form", "sidebar"])
    out.append(article())
    some(["advert", "sidebar", "comments", "form", "notice", "menu", "footer", "footer"])
    out.append(rng.choice(["</body></html>", ""]))
    return "".join(out), labels


def train(words: list[str], seed: int = 7, pages: int = TRAINING_PAGES) -> Labeller:
    rng = random.Random(seed)
    xs, ys = [], []
    while len(xs) < pages:
        page, labels = training_page(rng, words or FALLBACK_WORDS)
        if len(found := blocks(page)) == len(labels):
            xs.append(vectors(found))
            ys.append(np.array(labels, dtype=np.float64))
    return Labeller(seed).fit(xs, ys)


def fit(pages: DataFrame, column: str = "html", sample_pages: int = SAMPLE_PAGES) -> Labeller:
    """Train with the words of about ``sample_pages`` pages, those of small hashes."""
    rows = pages.filter(F.col(column).isNotNull()).select(F.col(column).alias("h"))
    near = F.pmod(F.xxhash64("h"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    share = sample_pages / max(1, rows.count())
    # Copies share a hash and count once: about ``sample_pages`` pages at most, the same ones in every run.
    rows = rows.filter(near <= share).distinct().collect()
    words = sorted({w for r in rows for _, t, _ in blocks(r["h"]) for w in t.split(" ") if not set(w) & set("<>&")})
    return train(words)


def extract_text(labeller: Labeller, pages: list[str]) -> list[str]:
    cut = [blocks(p) for p in pages]
    share = labeller.predict([vectors(b) for b in cut])
    return [" ".join(t for (_, t, _), s in zip(b, own, strict=True) if s >= 0.5) for b, own in zip(cut, share, strict=True)]


def extract(pages: DataFrame, column: str = "html", out: str = "text", sample_pages: int = SAMPLE_PAGES) -> DataFrame:
    """``pages`` with the main text of ``column`` in ``out``."""
    sent = pages.sparkSession.sparkContext.broadcast(fit(pages, column, sample_pages))  # a few thousand weights

    def kernel(batch: pa.Array) -> pa.Array:
        return pa.array([t for chunk in text_chunks(batch) for t in extract_text(sent.value, chunk)], pa.string())

    return pages.withColumn(out, arrow_column(kernel, "string")(F.col(column)))
