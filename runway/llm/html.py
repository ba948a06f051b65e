"""HTML main-text extraction with a recurrent block labeller.

A page is cut into leaf blocks: runs of text between block-level tags, each with
the path of its open elements (names, classes, ids).  A bidirectional LSTM in
numpy reads the whole page's sequence of blocks - the hashed path, hashed words
and a few lengths of each - and labels every block main text or not from
both sides' context.

Elements are kept as a tree, each with its own words alone, and a path's input is its
parent's plus its own, so time and memory grow with the page and not with its depth.

There are no labelled pages, so the labeller is trained here: on ``TRAIN_PAGES``
pages of the table (a documented bound, chosen by a hash) and on
``MADE_PAGES`` made-up pages with furniture of many kinds around and
inside articles, labelled by ``is_main``, a rule on names.  The rule only
labels training blocks; extraction follows the network.  So that the network does not
merely learn the rule, it also sees the pages with their telling names taken away
(every such element a ``div`` without attributes), under the labels of the original:
there it has to go by links, lengths, words and the blocks around.
"""

from __future__ import annotations

import html as _html
import re
import zlib
from collections import Counter
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runway.llm.wordhash import word_hashes

TRAIN_PAGES = 300
TRAIN_BLOCKS = 120          # blocks of a page that training looks at (extraction reads all)
MADE_PAGES = 700            # and a third as many that are read without names
MADE_TEXT, MADE_TEXTS = 400, 1000   # characters of a text that made-up pages are filled with, and how many there are
PATHS, WORDS, NUMBERS = 1 << 15, 32, 4
HIDDEN = 16
CELLS = 40_000              # blocks, padding included, that are labelled at once

# fixed values: element names of HTML by role
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style".split())
_EMBEDDED = frozenset("noscript template iframe svg math object canvas".split())   # these may close themselves
_INLINE = frozenset(
    "mi mn mo ms mtext mrow mfrac msqrt mroot msup msub msubsup munder mover munderover mstyle mspace mpadded semantics "
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split())
_CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
# fixed values: words of element names, classes and ids that mark main text and page furniture
MAIN = ("article", "main", "content", "post", "entry", "story")
FURNITURE = (
    "head", "nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "select", "textarea", "fieldset",
    "ad", "ads", "advert", "adverts", "advertisement", "sponsor", "sponsored", "promo", "promotion", "banner", "sidebar", "side", "widget",
    "notice", "notices", "cookie", "cookies", "consent", "alert", "gdpr", "popup", "modal", "comment", "comments", "reply", "replies", "discussion",
    "responses", "menubar", "navigation", "navbar", "breadcrumb", "breadcrumbs", "masthead", "topbar", "related", "recommended", "share", "social",
    "newsletter", "subscribe", "login", "signup", "search", "pagination", "copyright", "toolbar", "disclaimer")
_MAIN, _FURNITURE = frozenset(MAIN), frozenset(FURNITURE)
_TELLING = (_MAIN | _FURNITURE | {"section"}) - {"head"}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(?=[a-zA-Z/])[^>]*>?|[^<]+|<", re.S)
_NAMED = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_END_RAW = {n: re.compile(rf"</{n}\s*>", re.I) for n in _RAW}


class Page(NamedTuple):
    """A page's elements, as a tree in page order, and its leaf blocks."""

    parents: list[int]                       # of each element; the first element is the page itself, its own parent
    words: list[tuple[str, ...]]             # of each element: name, classes, ids, role; those that an open element has are left out
    blocks: list[tuple[int, str, float]]     # element, text, share of the text in links

    def path(self, element: int) -> tuple[str, ...]:
        """The words of an element and those around it, outermost first."""
        parts = []
        while element:
            parts.append(self.words[element])
            element = self.parents[element]
        return tuple(w for x in reversed(parts) for w in x)


def read_page(html: str | None) -> Page:
    """Elements and leaf blocks of a whole page.

    Character references are decoded, white space is one space, blocks without
    text are left out.  Scripts, styles, comments and markup give no blocks.
    Broken markup is read as far as it goes: an unclosed element ends with its
    parent (a script or style with the page, as in browsers), an end tag without a
    start is ignored.  What svg, math, object, canvas, noscript, template and iframe
    hold are blocks like others.  A link goes on over the block-level tags inside it.
    """
    page = Page([0], [()], [])
    stack: list[tuple[str, int]] = []          # open elements
    names: Counter[str] = Counter()            # of the open elements
    held: Counter[str] = Counter()             # words of the open elements
    text: list[str] = []
    linked, in_link = 0, 0

    def flush() -> None:
        nonlocal linked
        if text:
            clean = " ".join(_html.unescape("".join(text)).split())
            if clean:
                page.blocks.append((stack[-1][1] if stack else 0, clean, min(1.0, linked / len(clean))))
            text.clear()
        linked = 0

    def close(name: str) -> None:
        """Close the innermost open element of that name and what is open in it."""
        while True:
            last, element = stack.pop()
            names[last] -= 1
            held.subtract(page.words[element])
            if last == name:
                return

    html, at = html or "", 0
    while at < len(html):
        m = _TOKEN.match(html, at)
        at = m.end()
        name = m[2]
        if name is None:
            if m[0][0] != "<" or m[0] == "<":
                text.append(m[0])
                linked += len(m[0]) if in_link else 0
            continue
        name = name.lower()
        if name in _VOID:
            if name in ("br", "hr", "img"):
                text.append(" ")
            continue
        if name in _INLINE:
            if name == "a":
                in_link = 0 if m[1] else 1
            continue
        if name in _EMBEDDED and not m[1] and m[3].endswith("/"):
            text.append(" ")
            continue
        if name in _RAW and not m[1]:
            end = _END_RAW[name].search(html, at)
            at = end.end() if end else len(html)
            continue
        flush()
        if m[1]:
            if names[name] > 0:
                close(name)
            continue
        if name in _CLOSES_P and names["p"] > 0:
            close("p")
        elif name in ("li", "tr", "td", "th", "dt", "dd", "option") and stack and stack[-1][0] == name:
            close(name)
        words = [name]
        for a, b, c in _NAMED.findall(m[3]):
            words += [w for w in re.split(r"[^a-z0-9]+", (a or b or c).lower()) if w]
        own = tuple(w for w in dict.fromkeys(words) if not held[w] > 0)
        page.parents.append(stack[-1][1] if stack else 0)
        page.words.append(own)
        stack.append((name, len(page.words) - 1))
        names[name] += 1
        held.update(own)
    flush()
    return page


def blocks(html: str | None) -> list[tuple[tuple[str, ...], str, float]]:
    """The leaf blocks of a page in order, with their whole paths: path words, text, share of the text in links."""
    page = read_page(html)
    return [(page.path(e), text, share) for e, text, share in page.blocks]


def _marked(page: Page, words: frozenset[str]) -> list[bool]:
    """Which elements have one of the words, or are in an element that has."""
    out = [False]
    for parent, own in zip(page.parents[1:], page.words[1:], strict=True):
        out.append(out[parent] or not words.isdisjoint(own))
    return out


def is_main(page: Page) -> list[bool]:
    """The training rule, for each block: inside main text, or anywhere on a page without any, and in no page furniture."""
    main, furniture = _marked(page, _MAIN), _marked(page, _FURNITURE)
    has = any(main[e] for e, _, _ in page.blocks)
    return [not furniture[e] and (main[e] or not has) for e, _, _ in page.blocks]


def without_names(page: Page) -> Page:
    """The page with every telling element a ``div``, and without classes, ids and roles."""
    plain = [("div",) if own and (own[0] in _TELLING or own[0] not in _KNOWN) else own[:1] for own in page.words]
    return Page(page.parents, plain, page.blocks)


#: fixed values: element names that say nothing about whether their text is main text, kept when names are taken away
_KNOWN = frozenset("html head title body div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tr td th blockquote pre figure figcaption text".split()) | _EMBEDDED


def _as_page(listed: list[tuple[tuple[str, ...], str, float]]) -> Page:
    """A page from whole paths; equal beginnings of paths are the same elements."""
    page, known = Page([0], [()], []), {}
    for path, text, share in listed:
        element = 0
        for w in path:
            if (element, w) not in known:
                known[element, w] = len(page.words)
                page.parents.append(element)
                page.words.append((w,))
            element = known[element, w]
        page.blocks.append((element, text, share))
    return page


def _made_page(rng: np.random.Generator, texts: list[str], plain: bool = False) -> Page:
    """A made-up page: furniture of many kinds around and inside an article.

    A ``plain`` one is to be read without names: its furniture stands around the article alone,
    as lists of links, short lines or boxes of a sentence.
    """
    pick = lambda options: options[int(rng.integers(len(options)))]
    some = lambda most: range(int(rng.integers(0, most + 1)))
    words = lambda n: " ".join(pick(texts).split()[: int(rng.integers(1, n + 1))]) or "word"
    page: list[tuple[tuple[str, ...], str, float]] = []

    def furniture(around: tuple[str, ...]) -> None:
        kind = pick(FURNITURE)
        box = (kind,) if rng.random() < 0.4 else (pick(["div", "section", "ul", "p"]), kind) if rng.random() < 0.7 else ("div", pick(["box", "block", "x1"]), kind)
        inner = pick([(), ("p",), ("ul", "li"), ("div",), ("h3",), ("article",) if not around else ("p",)])
        if plain:
            box, inner, links = (kind,), pick([(), (), ("ul", "li"), ("ul", "li"), ("p",)]), float(rng.random() < 0.6)
            for _ in range(1 if not inner else 1 + len(some(7))):
                page.append((around + box + inner, words(12 if not inner and not links else 4), max(links, float(inner != ()))))
            return
        for _ in range(1 + len(some(5))):
            page.append((around + box + inner, words(40 if rng.random() < 0.3 else 6), float(rng.random() < 0.4)))

    page.append((("html", "head", "title"), words(10), 0.0))
    top = ("html", "body") + pick([(), ("div", "page"), ("div", "wrap"), ("div",)])
    for _ in some(4):
        furniture(top)
    holder = () if rng.random() < 0.15 else pick([("article",), ("article",), ("article",), ("main",), ("main", "article"), ("div", pick(MAIN)), ("section", pick(MAIN))])
    if rng.random() < 0.9:
        page.append((top + holder + (pick(["h1", "h1", "h2"]),), words(12), 0.0))
    for _ in range(1 + len(some(14))):
        leaf = pick([("p",), ("p",), ("p",), ("p",), ("h2",), ("ul", "li"), ("blockquote",), ("blockquote", "p"), ("pre",), ("table", "tr", "td"), ("div",), ()])
        if rng.random() < 0.1:
            leaf = pick([leaf, ()]) + (pick(sorted(_EMBEDDED)),) + pick([(), (), ("p",), ("text",)])
        page.append((top + holder + leaf, pick(texts) if rng.random() < 0.8 else words(5), float(rng.random() < 0.05)))
        if rng.random() < 0.12 and not plain:
            furniture(top + holder)
    for _ in some(5):
        furniture(top)
    return _as_page(page)


def _row(word: str) -> int:
    return zlib.crc32(word.encode()) % PATHS


class Inputs:
    """Path elements and other inputs of the blocks of some pages, one after the other.

    Equal elements under equal elements are one kind, over all the pages.
    """

    def __init__(self, pages: list[Page]) -> None:
        flat = [b for p in pages for b in p.blocks]
        self.lengths = np.array([len(p.blocks) for p in pages], dtype=np.int64)
        kinds: dict[tuple[int, tuple[str, ...]], int] = {(0, ()): 0}
        of: list[int] = []
        self.parents = [0]
        for page in pages:
            kind = [0]
            for parent, own in zip(page.parents[1:], page.words[1:], strict=True):
                key = (kind[parent], own)
                if key not in kinds:
                    kinds[key] = len(kinds)
                    self.parents.append(kind[parent])
                kind.append(kinds[key])
            of += [kind[e] for e, _, _ in page.blocks]
        self.kind = np.array(of, dtype=np.int64)
        # rows of the path tables, one kind after the other, and the kinds by their depth
        self.rows = np.array([_row(w) for _, own in kinds for w in own], dtype=np.int64)
        self.row_kind = np.repeat(np.arange(len(kinds)), [len(own) for _, own in kinds])
        self.parents = np.array(self.parents, dtype=np.int64)
        depth = [0]
        for parent in self.parents[1:].tolist():
            depth.append(depth[parent] + 1)
        by_depth = np.argsort(depth, kind="stable")
        self.levels = np.split(by_depth, np.flatnonzero(np.diff(np.array(depth)[by_depth])) + 1)[1:]
        with np.errstate(over="ignore"):
            h, at = word_hashes([b[1] for b in flat], lower=True)
        n = np.diff(at)
        words = np.bincount(np.repeat(np.arange(len(flat)), n) * WORDS + (h % np.uint64(WORDS)).astype(np.int64), minlength=len(flat) * WORDS)
        size = np.array([len(b[1]) for b in flat], dtype=np.float64)
        numbers = np.stack([np.log1p(n) / 5, np.log1p(size) / 8, np.array([b[2] for b in flat], dtype=np.float64), np.ones(len(flat))], axis=1) if flat else np.zeros((0, NUMBERS))
        self.other = np.hstack([words.reshape(-1, WORDS) / np.maximum(1, n)[:, None], numbers]).astype(np.float32)

    def summed(self, table: np.ndarray) -> np.ndarray:
        """For each kind the sum of the table's rows of its path: its parent's sum and its own rows."""
        out = np.zeros((len(self.parents), table.shape[1]), dtype=np.float32)
        np.add.at(out, self.row_kind, table[self.rows])
        for level in self.levels:
            out[level] += out[self.parents[level]]
        return out

    def spread(self, by_kind: np.ndarray) -> np.ndarray:
        """Gradients of kinds with those of the kinds below them added, for each kind's own rows."""
        out = by_kind.copy()
        for level in reversed(self.levels):
            np.add.at(out, self.parents[level], out[level])
        return out

    def padded(self, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Blocks as [time, page, ...] and the mask of real blocks."""
        mask = np.arange(self.lengths.max(initial=0))[:, None] < self.lengths[None, :]
        out = np.zeros((*mask.shape, flat.shape[1]), dtype=flat.dtype)
        out.transpose(1, 0, 2)[mask.T] = flat
        return out, mask.astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _forward(x: np.ndarray, u: np.ndarray, mask: np.ndarray, steps, training: bool = True) -> tuple[np.ndarray, list]:
    """One direction of the LSTM: states [time, page, HIDDEN] and, in training, what the backward pass needs."""
    h = c = np.zeros((x.shape[1], HIDDEN), dtype=x.dtype)
    states, kept = np.zeros((x.shape[0], x.shape[1], HIDDEN), dtype=x.dtype), []
    for t in steps:
        gates = x[t] + h @ u
        i, f, o = (_sigmoid(gates[:, k * HIDDEN:(k + 1) * HIDDEN]) for k in range(3))
        g = np.tanh(gates[:, 3 * HIDDEN:])
        m = mask[t][:, None]
        new = f * c + i * g
        squash = np.tanh(new)
        if training:
            kept.append((t, h, c, i, f, o, g, squash, m))
        c = m * new + (1 - m) * c
        h = m * (o * squash) + (1 - m) * h
        states[t] = h
    return states, kept


def _backward(d_states: np.ndarray, u: np.ndarray, kept: list) -> tuple[np.ndarray, np.ndarray]:
    """Gradients with respect to the inputs and to the recurrent weights."""
    dx, du = np.zeros((*d_states.shape[:2], 4 * HIDDEN), dtype=d_states.dtype), np.zeros_like(u)
    dh = dc = np.zeros(d_states.shape[1:], dtype=d_states.dtype)
    for t, h, c, i, f, o, g, squash, m in reversed(kept):
        dh = dh + d_states[t]
        dh_new, dc_new = m * dh, m * dc
        dc_new = dc_new + dh_new * o * (1 - squash ** 2)
        d = np.hstack([dc_new * g * i * (1 - i), dc_new * c * f * (1 - f), dh_new * squash * o * (1 - o), dc_new * i * (1 - g ** 2)])
        dx[t] = d
        du += h.T @ d
        dh = (1 - m) * dh + d @ u.T
        dc = (1 - m) * dc + dc_new * f
    return dx, du


class Labeller:
    """The network: hashed-path table, input weights, two LSTM directions, output with a direct term for the path."""

    def __init__(self, seed: int = 3) -> None:
        rng = np.random.default_rng(seed)
        gates = 8 * HIDDEN
        self.w = {
            "paths": rng.normal(0, 0.1, (PATHS, gates)), "other": rng.normal(0, 0.1, (WORDS + NUMBERS, gates)),
            "ahead": rng.normal(0, 0.2, (HIDDEN, 4 * HIDDEN)), "back": rng.normal(0, 0.2, (HIDDEN, 4 * HIDDEN)),
            "out": rng.normal(0, 0.2, (2 * HIDDEN, 1)), "bias": np.zeros((1, 1)), "own": np.zeros((PATHS, 1)),
        }
        self.w["other"][-1, HIDDEN:2 * HIDDEN] = self.w["other"][-1, 5 * HIDDEN:6 * HIDDEN] = 1.0  # forget gates start open
        self.w = {k: v.astype(np.float32) for k, v in self.w.items()}

    def _run(self, x: Inputs, training: bool = False) -> tuple:
        gates, mask = x.padded(x.summed(self.w["paths"])[x.kind] + x.other @ self.w["other"])
        n = len(gates)
        a, kept_a = _forward(gates[:, :, :4 * HIDDEN], self.w["ahead"], mask, range(n), training)
        b, kept_b = _forward(gates[:, :, 4 * HIDDEN:], self.w["back"], mask, range(n - 1, -1, -1), training)
        states = np.concatenate([a, b], axis=2)
        own = x.summed(self.w["own"])  # a block's own path, past the recurrence
        logits = (states @ self.w["out"])[:, :, 0] + self.w["bias"][0, 0] + x.padded(own[x.kind])[0][:, :, 0]
        return states, mask, kept_a, kept_b, _sigmoid(logits)

    def probabilities(self, pages: list[Page]) -> list[np.ndarray]:
        """Per page the probability of main text of each block."""
        out: list = [np.empty(0)] * len(pages)
        order = sorted((i for i in range(len(pages)) if pages[i].blocks), key=lambda i: len(pages[i].blocks))
        while order:
            longest = len(pages[order[-1]].blocks)
            take, order = order[-max(1, CELLS // longest):], order[:-max(1, CELLS // longest)]
            p = self._run(Inputs([pages[i] for i in take]))[4]
            for j, i in enumerate(take):
                out[i] = p[:len(pages[i].blocks), j]
        return out

    def train(self, pages: list[Page], labels: list[list[bool]], rounds: int = 13, size: int = 64, rate: float = 0.02, seed: int = 4) -> None:
        """Adam on the blocks' cross-entropy."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.w.items()}
        second = {k: np.zeros_like(v) for k, v in self.w.items()}
        step = 0
        for turn in range(rounds):
            # pages of like length together, the groups in random order
            order = sorted(rng.permutation(len(pages)).tolist(), key=lambda i: len(pages[i].blocks))
            groups = [order[at:at + size] for at in range(0, len(order), size)]
            for take in (groups[i] for i in rng.permutation(len(groups))):
                x = Inputs([pages[i] for i in take])
                states, mask, kept_a, kept_b, p = self._run(x, training=True)
                want, _ = x.padded(np.array([v for i in take for v in labels[i]], dtype=np.float32)[:, None])
                d = ((p - want[:, :, 0]) * mask / max(1.0, mask.sum()))[:, :, None].astype(np.float32)
                grad = {"out": np.einsum("tph,tpo->ho", states, d), "bias": d.sum().reshape(1, 1)}
                ds = d @ self.w["out"].T
                dx_a, grad["ahead"] = _backward(ds[:, :, :HIDDEN], self.w["ahead"], kept_a)
                dx_b, grad["back"] = _backward(ds[:, :, HIDDEN:], self.w["back"], kept_b)
                dx = np.concatenate([dx_a, dx_b], axis=2).transpose(1, 0, 2)[mask.T.astype(bool)]
                grad["other"] = x.other.T @ dx
                by_kind = np.zeros((len(x.parents), dx.shape[1]), dtype=np.float32)
                np.add.at(by_kind, x.kind, dx)
                by_kind = x.spread(by_kind)
                own = x.spread(np.bincount(x.kind, weights=d[:, :, 0].T[mask.T.astype(bool)], minlength=len(x.parents)))
                # of the two path tables only the rows that the batch uses move
                used, flat = np.unique(x.rows, return_inverse=True)
                grad["paths"], grad["own"] = np.zeros((len(used), dx.shape[1]), np.float32), np.zeros((len(used), 1), np.float32)
                np.add.at(grad["paths"], flat, by_kind[x.row_kind])
                np.add.at(grad["own"][:, 0], flat, own[x.row_kind])
                step += 1
                pace = rate * (0.15 if turn >= rounds - 4 else 1.0) * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
                for k, g in grad.items():
                    at = used if k in ("paths", "own") else slice(None)
                    first[k][at] += 0.1 * (g - first[k][at])
                    second[k][at] += 0.001 * (g * g - second[k][at])
                    self.w[k][at] -= (pace * first[k][at] / (np.sqrt(second[k][at]) + 1e-8)).astype(np.float32)


def train_labeller(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> Labeller:
    """Fit the labeller on a bounded sample of ``pages`` and on made-up pages; works on an empty table too.

    The pages are chosen by a hash of id and html, and only the hashes are sorted; the
    html of the TRAIN_PAGES chosen ones alone reaches the driver.  Equal rows count once.
    """
    base = pages.select(F.col(id_col).alias("i"), F.col(html_col).alias("h")).where("h is not null").withColumn("k", F.xxhash64("i", "h"))
    keys = base.select("k").distinct().orderBy("k").limit(TRAIN_PAGES)
    chosen = base.join(F.broadcast(keys), "k", "left_semi").dropDuplicates(["k"]).select("k", "h").collect()
    chosen.sort(key=lambda r: r["k"])
    real = [Page(p.parents, p.words, p.blocks[:TRAIN_BLOCKS]) for p in (read_page(r["h"]) for r in chosen) if p.blocks]
    texts = [b[1][:MADE_TEXT] for p in real for b in p.blocks][:MADE_TEXTS] or ["some words of a page", "a longer line of words that stands for a paragraph of text"]
    rng = np.random.default_rng(9)
    made = [_made_page(rng, texts) for _ in range(MADE_PAGES)]
    bare = [*real, *[_made_page(rng, texts, plain=True) for _ in range(MADE_PAGES // 3)]]     # these are read without their names
    labeller = Labeller()
    labeller.train([*real, *made, *map(without_names, bare)], [is_main(p) for p in (*real, *made, *bare)])
    return labeller


def extract(pages: DataFrame, labeller: Labeller, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """``pages`` with ``out_col``: the main text of the whole page, its blocks joined by a line feed.

    NULL and empty pages, and pages without main text, give the empty string.  All
    rows and columns stay, repeated rows as many as they are; an existing ``out_col`` is
    replaced.  No rows give no rows.
    """
    @F.pandas_udf(T.StringType())
    def main_text(html: pd.Series) -> pd.Series:
        out = []
        for at in range(0, len(html), 500):
            cut = [read_page(h) for h in html.iloc[at:at + 500]]
            for page, p in zip(cut, labeller.probabilities(cut), strict=True):
                out.append("\n".join(b[1] for b, x in zip(page.blocks, p, strict=True) if x >= 0.5))
        return pd.Series(out)

    return pages.withColumn(out_col, main_text(F.col(html_col)))
