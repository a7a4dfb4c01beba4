r"""Main text of web pages: a recurrent labeller decides for each text block, in the context of the whole page.

A page is read into its leaf blocks: runs of text without a block-level tag between them. A block is described by the hashed
tokens of its tag path (tag names, words of class, id, role and the like), by its hashed words, and by a few measures
(length, share of links, punctuation, place). A bidirectional LSTM, in numpy, runs over a page's blocks; a block is main text if
its probability is over one half. The text of a page is its main blocks, one a line.

Training: layouts are composed at random with parts whose role is known (articles, menus, headers, footers, sidebars, notices,
adverts, forms, reader comments, in many kinds of markup, the boilerplate also within the article), filled with the text of
blocks of a bounded sample of the pages (SAMPLE different ones with the smallest hashes, SAMPLE_CHARS of each). So no label of the pages themselves is
used, and the driver's share doesn't grow with the table. With the same pages the model is the same.

Head, scripts, styles and other elements without shown text have no blocks. Null or empty html has the text ''. Unclosed
tags are closed as browsers do it in the simple cases (p, li, td and the like); a page cut off in the middle is read up to
there. Pages are never cut; a very long one is a slice of its own. Repeated rows give repeated results.
"""

from __future__ import annotations

import html as entities
import random
import re
import zlib
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import text_slices

#: Bounds of training: pages that lend their text, characters of each, composed layouts, passes over them.
SAMPLE, SAMPLE_CHARS, LAYOUTS, PASSES = 200, 20_000, 800, 5
#: Sizes of the model: buckets of path tokens and of words, their vectors, states in each direction.
PATHS, WORDS, VECTOR, STATES = 2048, 2048, 12, 16
MEASURES = 12

# ---- blocks ----------------------------------------------------------------------------------------------------------

_MARKUP = re.compile(r"<!--(?:.*?-->|.*)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|))*+)>|<[!?/][^>]*(?:>|$)|<[a-zA-Z/][^<]*$", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))|([^\s=/\"'>]+)")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
#: Attributes whose words say what an element is for.
TELLING = {"class", "id", "role", "itemprop", "itemtype", "aria-label", "name", "hidden", "aria-hidden"}
#: Fixed values of HTML: elements whose content is raw, elements without shown text, elements without content, block-level elements, and what a start tag closes.
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript", "template", "svg", "math", "select", "object", "head", "canvas", "datalist"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = set("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "option": {"option"}}
CLOSES_P = BLOCK - {"button", "body", "html", "caption", "td", "th", "tr", "tbody", "thead", "tfoot", "legend", "option", "optgroup"}
_LIMITS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "tbody": {"table"}, "option": {"select"}}
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _tokens(tag: str, attributes: str) -> tuple[int, ...]:
    found = [tag]
    if "=" in attributes or "hidden" in attributes:
        for m in _ATTRIBUTE.finditer(attributes):
            name = (m[1] or m[5] or "").lower()
            value = m[2] or m[3] or m[4] or ""
            if name in TELLING:
                found += [f".{w.lower()}" for w in _WORD.findall(value)] if value else [f".{name}"]
            elif name == "style" and _HIDDEN.search(value):
                found.append(".hidden")
    return tuple(dict.fromkeys(zlib.crc32(t.encode()) % PATHS for t in found))


class _Tokens(dict):
    """(tag, attributes) -> hashed tokens, for the markup that comes again and again."""

    def __missing__(self, key):
        if len(self) > 50_000:
            self.clear()
        self[key] = found = _tokens(*key)
        return found


_SEEN = _Tokens()


def blocks(page: str | None) -> list[tuple[str, list[int], str, int, int]]:
    """The leaf blocks of a page in order: text, path tokens, innermost block-level tag, characters within links, depth."""
    page = page or ""
    out: list = []
    stack: list[tuple[str, tuple[int, ...]]] = []
    text: list[str] = []
    linked, links, at, size = 0, 0, 0, len(page)

    def end_block() -> None:
        nonlocal linked
        if text:
            shown = " ".join(entities.unescape("".join(text)).split())
            text.clear()
            if shown:
                path = list(dict.fromkeys(chain.from_iterable(t for _, t in stack)))
                out.append((shown, path, next((t for t, _ in reversed(stack) if t in BLOCK), ""), min(linked, len(shown)), len(stack)))
        linked = 0

    def pop_to(k: int) -> None:
        nonlocal links
        links -= sum(t == "a" for t, _ in stack[k:])
        del stack[k:]

    while at < size:
        m = _MARKUP.search(page, at)
        start = m.start() if m else size
        if start > at:
            text.append(page[at:start])
            if links:
                linked += start - at
        if not m:
            break
        at = m.end()
        tag = m[2]
        if not tag:
            continue
        tag = tag.lower()
        if m[1]:
            if tag in BLOCK:
                end_block()
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    pop_to(k)
                    break
                if tag not in BLOCK and stack[k][0] in BLOCK:
                    break  # an inline end tag doesn't reach over a block
            continue
        if tag in RAW:
            if not m[3].endswith("/") or tag in ("script", "style", "head"):
                closing = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>|<body(?=[\s>])" if tag == "head" else rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(page, at)
                at = size if not closing else closing.start() if closing[0][1] != "/" else closing.end()
            text.append(" ")
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag in BLOCK:
            end_block()
            closed = CLOSED_BY.get(tag, ())
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == "p" and tag in CLOSES_P or stack[k][0] in closed:
                    pop_to(k)
                elif stack[k][0] in _LIMITS.get(tag, ()) or stack[k][0] in BLOCK and not closed:
                    break
        if tag not in VOID and not (m[3].endswith("/") and tag not in BLOCK):
            if len(stack) < 512:
                stack.append((tag, _SEEN[tag, m[3]]))
                links += tag == "a"
    end_block()
    return out


# ---- features --------------------------------------------------------------------------------------------------------


@dataclass
class Features:
    """Blocks of some pages, side by side: path tokens and words with their ends, measures, and blocks a page."""

    path: np.ndarray
    path_ends: np.ndarray
    word: np.ndarray
    word_ends: np.ndarray
    measures: np.ndarray
    sizes: np.ndarray


_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}


def features(pages: list[list]) -> Features:
    path, path_n, word, word_n, measures = [], [], [], [], []
    crc = zlib.crc32
    for page in pages:
        n = len(page)
        total = sum(len(b[0]) for b in page) or 1
        for k, (text, tokens, tag, linked, depth) in enumerate(page):
            path += tokens
            path_n.append(len(tokens))
            own = text.lower().encode().split()
            word += [crc(w) % WORDS for w in own]
            word_n.append(len(own))
            size = len(text)
            marks = sum(map(text.count, ".,;:!?"))
            measures.append(
                (np.log1p(size) / 5, np.log1p(len(own)) / 4, linked / size, 8 * marks / size, text[-1] in ".!?:", text[0].isupper(), tag in _HEADINGS, tag == "li", tag == "p", depth / 10, k / n, size / total)
            )
    ints = lambda x: np.array(x, np.int64)
    return Features(ints(path), np.cumsum(path_n, dtype=np.int64), ints(word), np.cumsum(word_n, dtype=np.int64), np.array(measures, np.float32).reshape(-1, MEASURES), ints([len(p) for p in pages]))


def _means(table: np.ndarray, at: np.ndarray, ends: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Sums of the table's rows for each stretch of `at`, by scale."""
    if not len(ends):
        return np.zeros((0, table.shape[1]), np.float32)
    out = np.zeros((len(ends), table.shape[1]), np.float32)
    starts = np.append(0, ends[:-1])
    full = (ends > starts).nonzero()[0]
    for x in range(0, len(full), 20_000):  # a bounded part of the gathered rows at a time
        some = full[x : x + 20_000]
        first, last = starts[some[0]], ends[some[-1]]
        out[some] = np.add.reduceat(table[at[first:last]], starts[some] - first, axis=0)
    return out * scale[:, None]


# ---- the recurrent labeller --------------------------------------------------------------------------------------------


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class Labeller:
    """Parameters and passes of the bidirectional LSTM over block vectors."""

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        width = 2 * VECTOR + MEASURES
        normal = lambda *s, by: rng.normal(0, by, s).astype(np.float32)
        self.p = {"path": normal(PATHS, VECTOR, by=0.1), "word": normal(WORDS, VECTOR, by=0.1), "out": normal(2 * STATES + width, by=0.1), "bias": np.zeros(1, np.float32)}
        for d in ("ahead", "back"):
            self.p[f"{d}_in"] = normal(width, 4 * STATES, by=width**-0.5)
            self.p[f"{d}_state"] = normal(STATES, 4 * STATES, by=STATES**-0.5)
            self.p[f"{d}_bias"] = np.repeat(np.array([0, 1, 0, 0], np.float32), STATES)

    def _vectors(self, f: Features) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        by_path = np.full(len(f.path_ends), 0.5, np.float32)
        by_word = 1 / np.maximum(1, np.diff(f.word_ends, prepend=0)).astype(np.float32)
        return np.hstack([_means(self.p["path"], f.path, f.path_ends, by_path), _means(self.p["word"], f.word, f.word_ends, by_word), f.measures]), by_path, by_word

    @staticmethod
    def _order(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pages from long to short; how many of them have a block at each step; where each begins."""
        order = np.argsort(-sizes, kind="stable")
        order = order[sizes[order] > 0]
        steps = np.searchsorted(-sizes[order], -np.arange(int(sizes.max(initial=0))), "left")
        return order, steps, (np.cumsum(sizes) - sizes)[order]

    def _run(self, d: str, x: np.ndarray, sizes: np.ndarray, keep: bool = False):
        order, steps, begin = self._order(sizes)
        last = begin + sizes[order] - 1
        h, c = np.zeros((len(order), STATES), np.float32), np.zeros((len(order), STATES), np.float32)
        state, tape = np.zeros((len(x), STATES), np.float32), []
        given, w = x @ self.p[f"{d}_in"] + self.p[f"{d}_bias"], self.p[f"{d}_state"]
        for t, n in enumerate(steps.tolist()):
            at = begin[:n] + t if d == "ahead" else last[:n] - t
            gates = given[at] + h[:n] @ w
            gates[:, : 3 * STATES] = _sigmoid(gates[:, : 3 * STATES])
            gates[:, 3 * STATES :] = np.tanh(gates[:, 3 * STATES :])
            i, f, o, g = (gates[:, k * STATES : (k + 1) * STATES] for k in range(4))
            before_h, before_c = h[:n].copy() if keep else None, c[:n].copy() if keep else None
            c[:n] = f * c[:n] + i * g
            squashed = np.tanh(c[:n])
            h[:n] = o * squashed
            state[at] = h[:n]
            if keep:
                tape.append((at, gates, before_h, before_c, squashed))
        return state, tape

    def _back(self, d: str, x: np.ndarray, tape: list, grad: np.ndarray, g: dict) -> np.ndarray:
        """Gradients of one direction by going back over its steps."""
        most = len(tape[0][0])
        dh, dc = np.zeros((most, STATES), np.float32), np.zeros((most, STATES), np.float32)
        given = np.zeros((len(x), 4 * STATES), np.float32)
        w = self.p[f"{d}_state"]
        for at, gates, before_h, before_c, squashed in reversed(tape):
            n = len(at)
            i, f, o, c = (gates[:, k * STATES : (k + 1) * STATES] for k in range(4))
            dh_n = dh[:n] + grad[at]
            dc_n = dc[:n] + dh_n * o * (1 - squashed**2)
            step = np.hstack([dc_n * c * i * (1 - i), dc_n * before_c * f * (1 - f), dh_n * squashed * o * (1 - o), dc_n * i * (1 - c**2)])
            given[at] = step
            g[f"{d}_state"] += before_h.T @ step
            dh[:n], dc[:n] = step @ w.T, dc_n * f
        g[f"{d}_in"] += x.T @ given
        g[f"{d}_bias"] += given.sum(0)
        return given @ self.p[f"{d}_in"].T

    def scores(self, f: Features) -> np.ndarray:
        """For each block the probability of being main text."""
        x, _, _ = self._vectors(f)
        states = [self._run(d, x, f.sizes)[0] for d in ("ahead", "back")]
        return _sigmoid(np.hstack([*states, x]) @ self.p["out"] + self.p["bias"])

    def gradients(self, f: Features, labels: np.ndarray) -> tuple[float, dict]:
        """Mean log loss of the blocks and its gradients."""
        x, by_path, by_word = self._vectors(f)
        passes = {d: self._run(d, x, f.sizes, keep=True) for d in ("ahead", "back")}
        seen = np.hstack([passes["ahead"][0], passes["back"][0], x])
        p = _sigmoid(seen @ self.p["out"] + self.p["bias"])
        loss = -np.mean(np.log(np.where(labels, p, 1 - p) + 1e-7))
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        d_out = ((p - labels) / len(labels)).astype(np.float32)
        g["out"], g["bias"] = seen.T @ d_out, d_out.sum(keepdims=True)
        d_seen = d_out[:, None] * self.p["out"]
        dx = d_seen[:, 2 * STATES :].copy()
        for k, d in enumerate(("ahead", "back")):
            dx += self._back(d, x, passes[d][1], d_seen[:, k * STATES : (k + 1) * STATES], g)
        for name, at, ends, by, first in (("path", f.path, f.path_ends, by_path, 0), ("word", f.word, f.word_ends, by_word, VECTOR)):
            np.add.at(g[name], at, np.repeat(dx[:, first : first + VECTOR] * by[:, None], np.diff(ends, prepend=0), axis=0))
        return float(loss), g

    def fit(self, pages: list[list], labels: list[list[int]], passes: int = PASSES, lot: int = 16, rate: float = 0.01, seed: int = 7) -> float:
        """Adam over lots of pages in a fixed order; gives the last pass' mean loss."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        steps, loss, total = 0, 0.0, passes * -(-len(pages) // lot)
        for _ in range(passes):
            order, losses = rng.permutation(len(pages)), []
            for at in range(0, len(order), lot):
                some = order[at : at + lot]
                one, g = self.gradients(features([pages[k] for k in some]), np.array([y for k in some for y in labels[k]], np.float32))
                losses.append(one)
                steps += 1
                now = rate * (1 - 0.9 * steps / total)
                for k, v in self.p.items():
                    grad = np.clip(g[k], -1, 1)
                    first[k] += 0.1 * (grad - first[k])
                    second[k] += 0.01 * (grad**2 - second[k])
                    v -= now * (first[k] / (1 - 0.9**steps)) / (np.sqrt(second[k] / (1 - 0.99**steps)) + 1e-6)
            loss = float(np.mean(losses))
        return loss


# ---- training layouts ----------------------------------------------------------------------------------------------------

#: Words by which sites name the parts of a page.
ARTICLES = ("content", "main-content", "post", "entry-content", "article-body", "story", "post-body", "text", "page-content", "article", "body-copy", "single", "story-text", "mainText", "blog-post")
PARTS = {
    "menu": ("nav", "menu", "navbar", "navigation", "topnav", "breadcrumb", "main-menu", "menubar", "site-nav", "pagination", "links", "toc"),
    "head": ("header", "masthead", "site-header", "topbar", "branding", "logo", "site-title", "banner-top", "page-header"),
    "foot": ("footer", "site-footer", "copyright", "legal", "colophon", "bottom", "foot", "footer-links"),
    "side": ("sidebar", "aside", "widget", "related", "rail", "secondary", "recommended", "trending", "popular", "more-stories", "side"),
    "notice": ("cookie", "notice", "consent", "alert", "gdpr", "cookie-banner", "announcement", "popup", "modal", "message", "warning", "banner"),
    "advert": ("ad", "ads", "advert", "sponsored", "promo", "advertisement", "ad-slot", "sponsor", "promotion", "adbox", "banner-ad"),
    "form": ("newsletter", "search", "login", "signup", "subscribe", "search-form", "contact-form", "subscription"),
    "comments": ("comments", "comment-list", "discussion", "replies", "responses", "comment", "disqus", "reader-comments", "comment-section"),
    "share": ("share", "social", "tags", "share-buttons", "meta-links", "sharing", "follow"),
}
TAGS = {"menu": "nav", "head": "header", "foot": "footer", "side": "aside", "form": "form"}
ROLES = {"menu": "navigation", "head": "banner", "foot": "contentinfo", "side": "complementary", "notice": "alert", "form": "search"}
SAYINGS = {
    "notice": ("We use cookies to improve your experience.", "This site uses cookies. Accept", "Wir verwenden Cookies.", "Nous utilisons des cookies.", "Usamos cookies.", "Please enable JavaScript", "Accept all", "Got it", "Subscribe to continue reading"),
    "foot": ("© 2024 All rights reserved", "Privacy policy", "Terms of use", "Impressum", "Mentions légales", "Aviso legal", "Contact us", "Powered by"),
    "share": ("Share on", "Tweet", "Follow us", "Teilen", "Partager", "Compartir", "Print", "Email this"),
    "form": ("Your email", "Subscribe", "Search", "Sign up", "Password", "Log in", "Name", "Send", "Suchen", "Rechercher", "Buscar"),
    "comments": ("Reply", "Leave a comment", "3 comments", "Kommentare", "Commentaires", "Comentarios", "Log in to comment", "says:"),
    "advert": ("Advertisement", "Sponsored", "Anzeige", "Publicité", "Publicidad", "Buy now", "50% off"),
    "menu": ("Home", "About", "Contact", "News", "Next", "Previous", "Startseite", "Accueil", "Inicio", "Blog"),
    "side": ("Related", "Most read", "Latest", "You may also like", "Recent posts", "Archive"),
    "head": ("Skip to content", "Daily News", "Log in", "My site", "Welcome"),
}


class _Composer:
    """Layouts at random; every shown piece of text carries a mark, 1 for main text and 0 for the rest, which reading a layout takes off."""

    def __init__(self, texts: list[str], seed: int):
        self.rng = random.Random(seed)
        own = [" ".join(f"{self.rng.choice('bdfglmnprst')}{self.rng.choice('aeiou')}" * self.rng.randrange(1, 4) for _ in range(self.rng.choice((2, 4, 12, 30, 60)))).capitalize() + "." for _ in range(60)]
        long, short = [t for t in texts if len(t) > 60], [t for t in texts if len(t) <= 60]
        self.long, self.short = long + [t for t in own if len(t) > 60], short + [t for t in own if len(t) <= 60]

    def said(self, main: int, text: str) -> str:
        return f"\ue000{main}" + entities.escape(text.replace("\ue000", ""))

    def any_text(self, short: float) -> str:
        text = self.rng.choice(self.short if self.rng.random() < short else self.long)
        words = text.split()
        if self.rng.random() < 0.3 and len(words) > 3:
            at = self.rng.randrange(len(words) - 2)
            text = " ".join(words[at : at + self.rng.randrange(2, 40)])
        if self.rng.random() < 0.2:  # text as odd in any part of a page, so that the path weighs more
            mark = self.rng.choice(("!!", "###", "%%%", "&&&", " |", " 7", "..", ""))
            text = " ".join((w.upper() if self.rng.random() < 0.5 else w) + mark for w in text.split())
        return text

    def inline(self, main: int, text: str) -> str:
        if self.rng.random() < 0.25 and " " in text:
            a, _, b = text.partition(" ")
            tag = self.rng.choice(("b", "i", "em", "strong", "span", 'a href="/x"'))
            return f"{self.said(main, a)} <{tag}>{entities.escape(b)}</{tag.split()[0]}>"
        return self.said(main, text)

    def element(self, role: str, inside: str) -> str:
        """An element that says its role by tag, role or name, or, seldom, not at all."""
        rng, way = self.rng, self.rng.random()
        name = rng.choice(PARTS[role])
        if rng.random() < 0.3:
            name = f"{rng.choice(('site', 'page', 'js', 'c', 'module', 'block', 'l'))}-{name}"
        if role in TAGS and way < 0.45:
            tag, attributes = TAGS[role], rng.choice(("", f' class="{name}"'))
        elif role in ROLES and way < 0.55:
            tag, attributes = "div", f' role="{ROLES[role]}"'
        elif way < 0.94:
            tag, attributes = rng.choice(("div", "div", "section", "ul" if role == "menu" else "aside" if role in ("side", "advert") else "div")), f' {rng.choice(("class", "class", "id"))}="{name}"'
        else:
            tag, attributes = "div", ""
        if tag == "ul":
            inside = inside if inside.startswith("<li") else f"<li>{inside}</li>"
        if rng.random() < 0.15:
            inside = f'<div class="inner">{inside}</div>'
        return f"<{tag}{attributes}>{inside}</{tag}>"

    def part(self, role: str) -> str:
        rng = self.rng
        saying = lambda: rng.choice(SAYINGS[role])
        if role == "menu":
            items = "".join(f'<li><a href="/x">{self.said(0, saying() if rng.random() < 0.3 else self.any_text(1).split()[0])}</a></li>' for _ in range(rng.randrange(2, 9)))
            return self.element(role, items if rng.random() < 0.3 else f"<ul>{items}</ul>")
        if role == "comments":
            tag = rng.choice(("li", "div", 'div class="comment"', 'article class="comment"'))
            each = [f"<{tag}>" + (f"<b>{self.said(0, self.any_text(1))}</b>" if rng.random() < 0.5 else "") + f"<p>{self.said(0, self.any_text(0.4))}</p></{tag.split()[0]}>" for _ in range(rng.randrange(1, 5))]
            inside = "".join(each)
            return self.element(role, (f"<h3>{self.said(0, saying())}</h3>" if rng.random() < 0.6 else "") + (f"<ol>{inside}</ol>" if tag == "li" else inside))
        if role == "form":
            inside = "".join(f'<label>{self.said(0, saying())}</label><input name="q">' for _ in range(rng.randrange(0, 3))) + f"<button>{self.said(0, saying())}</button>"
            inside = f"<p>{self.said(0, self.any_text(0.5))}</p>{inside}" if rng.random() < 0.4 else inside
            return self.element(role, inside if rng.random() < 0.3 else f"<form>{inside}</form>")
        pieces = [self.said(0, saying() if rng.random() < 0.5 else self.any_text(0.6)) for _ in range(rng.randrange(1, 5))]
        if role in ("side", "share", "foot") and rng.random() < 0.5:
            return self.element(role, "<ul>" + "".join(f'<li><a href="/x">{p}</a></li>' for p in pieces) + "</ul>")
        tag = rng.choice(("p", "p", "div", "span", ""))
        return self.element(role, "".join(f"<{tag}>{p}</{tag}>" for p in pieces) if tag else pieces[0])

    def article(self) -> str:
        rng, out = self.rng, []
        if rng.random() < 0.75:
            title = f"<h1>{self.said(1, self.any_text(0.5))}</h1>"
            out.append(f"<header>{title}</header>" if rng.random() < 0.1 else title)
        for _ in range(rng.choice((1, 1, 2, 3, 5, 8, 14))):
            way, text = rng.random(), self.any_text(0.3)
            if rng.random() < 0.08:  # what sounds like boilerplate, in the article
                text = rng.choice(SAYINGS[rng.choice(list(SAYINGS))])
            if way < 0.7:
                out.append(f"<p>{self.inline(1, text)}" + "</p>" * (rng.random() < 0.8))
            elif way < 0.76:
                out.append("<ul>" + "".join(f"<li>{self.inline(1, self.any_text(0.5))}</li>" for _ in range(rng.randrange(1, 5))) + "</ul>")
            elif way < 0.82:
                out.append(f"<h2>{self.said(1, self.any_text(0.9))}</h2>")
            elif way < 0.86:
                out.append(f"<blockquote>{self.said(1, text)}</blockquote>")
            elif way < 0.89:
                out.append(f"<pre>{self.said(1, text)}</pre>")
            elif way < 0.92:
                out.append("<table><tr>" + "".join(f"<td>{self.said(1, self.any_text(0.9))}" for _ in range(3)) + "</table>")
            elif way < 0.95:
                out.append(f"<figure><img src=x><figcaption>{self.said(1, text)}</figcaption></figure>")
            else:
                out.append(f"<div>{self.said(1, text)}</div>")
        if rng.random() < 0.15:  # lines that come again and again, or very many short ones
            line = self.any_text(0.8)
            out += [f"<p>{self.said(1, line if rng.random() < 0.8 else self.any_text(0.9))}</p>" for _ in range(rng.choice((10, 30, 80)))]
        for role in ("advert", "side", "share", "form", "notice"):
            if rng.random() < 0.1:
                out.insert(rng.randrange(len(out) + 1), self.part(role))
        if rng.random() < 0.1:
            out.append(self.part("comments"))
        if rng.random() < 0.05:
            out.append(self.part("foot"))
        inside, way = "".join(out), rng.random()
        if way < 0.4:
            return f"<article{rng.choice(('', '', ' class="post"', ' id="story"'))}>{inside}</article>"
        if way < 0.5:
            return f"<main>{inside}</main>"
        if way < 0.58:
            return f"<main><article>{inside}</article></main>"
        if way < 0.9:
            return f'<{(tag := rng.choice(("div", "div", "section")))} {rng.choice(("class", "id", "itemprop"))}="{rng.choice(ARTICLES)}">{inside}</{tag}>'
        return inside if way < 0.95 else f"<div>{inside}</div>"

    def page(self) -> str:
        rng = self.rng
        some = lambda roles, p: [self.part(r) for r in roles if rng.random() < p]
        before = some(rng.sample(["notice", "head", "menu", "advert", "menu", "form"], 6), 0.4)
        after = some(rng.sample(["side", "comments", "advert", "share", "form", "menu", "side"], 7), 0.3)
        if rng.random() < 0.8:
            after.append(self.part("foot"))
        before = before + ([self.part("side")] if rng.random() < 0.15 else [])
        body = "".join([*before, self.article(), *after])
        if rng.random() < 0.2:
            body = f'<div class="{rng.choice(("wrapper", "container", "page", "site"))}">{body}</div>'
        return f"<!DOCTYPE html><html><head><title>x</title></head><body>{body}</body></html>"


#: A private character and the label; composed layouts only.
_MARK = re.compile("\ue000[01]")


def layouts(texts: list[str], n: int = LAYOUTS, seed: int = 11) -> tuple[list[list], list[list[int]]]:
    """Blocks of n composed pages, and the label of each block."""
    composer, pages, labels = _Composer(texts, seed), [], []
    for _ in range(n):
        page, label = [], []
        for text, *rest in blocks(composer.page()):
            marks = _MARK.findall(text)
            shown = " ".join(_MARK.sub("", text).split())
            if marks and shown:
                page.append((shown, *rest))
                label.append(int(marks[0][1]))
        pages.append(page), labels.append(label)
    return pages, labels


def train(df: DataFrame, html_col: str = "html") -> Labeller:
    """The labeller, fitted on composed layouts with the text of a bounded sample of the pages. An empty df lends none, which is fine."""
    own = df.select(F.xxhash64(F.col(f"`{html_col}`")).alias("h"), F.substring(F.col(f"`{html_col}`"), 1, SAMPLE_CHARS).alias("t")).filter("t is not null")
    n = df.count()
    if n > 4 * SAMPLE:  # about four times as many as are taken come through, so that what tasks send to the driver doesn't grow with their number
        own = own.filter(F.col("h") < -(1 << 63) + (1 << 64) * 4 * SAMPLE // n)
    some = own.distinct().orderBy("h", "t").limit(SAMPLE).collect()
    texts = [b[0] for r in some for b in blocks(r["t"])]
    model = Labeller()
    model.fit(*layouts(texts))
    return model


def extract(df: DataFrame, model: Labeller, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", threshold: float = 0.5) -> DataFrame:
    """One row for each row of df: id_col, url_col, text, n_chars, n_blocks and n_main (how many blocks the page has, and how many are main text). Other columns are ignored."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # its size is fixed
    kinds = dict(df.dtypes)

    def run(batches):
        labeller = shared.value
        for batch in text_slices(batches, column=2, limit=2_000_000):
            pages = [blocks(p) for p in batch.column(2).to_pylist()]
            main = (labeller.scores(features(pages)) > threshold).tolist()
            texts, n_main, at = [], [], 0
            for page in pages:
                kept = [b[0] for b, k in zip(page, main[at : at + len(page)], strict=True) if k]
                at += len(page)
                texts.append("\n".join(kept))
                n_main.append(len(kept))
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64()), pa.array(map(len, pages), pa.int64()), pa.array(n_main, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "url", "text", "n_chars", "n_blocks", "n_main"])

    given = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").alias("url"), F.col(f"`{html_col}`").alias("html"))
    out = given.mapInArrow(run, f"id {kinds[id_col]}, url {kinds[url_col]}, text string, n_chars bigint, n_blocks bigint, n_main bigint")
    return out.withColumnsRenamed({"id": id_col, "url": url_col})
