"""Main text of web pages: a linear-chain conditional random field over DOM leaf blocks.

A page is scanned into *leaf blocks*: runs of text between block-level tags, with the
stack of open elements above them. Comments, scripts, styles and other elements without
readable text are skipped; unclosed and stray tags are tolerated (an open ``p`` ends where
the next block starts, a closing tag closes what it can). Inline tags and ``br`` do not end
a block. Each block gets binary features: the tags above it, the words of the classes and ids
above it, its own tag, and facts about its text (length, share of link text, sentence marks,
copyright and date signs, first or last of the page). The field scores the labels *main* and
*other* of a block by its features and of neighbours by their labels; Viterbi gives the best
labelling of the page, and the blocks labelled main are joined.

Training (:func:`train`). Labelled pages come from a bounded sample of the table
(``max_pages``, by the hash of the id): each sampled page that has an ``article`` or ``main``
element is taken apart, and pages with known labels are put together from its paragraphs: main
text in one of many containers, and around it menus, headers, footers, sidebars, notices, adverts,
forms and reader comments in the usual markup, filled with text of other pages (so words do not
tell them apart), plus the sampled page itself labelled by its own elements. Weights maximise the
penalised log-likelihood, with gradients by the forward-backward recursion over all pages at once.

Scale: extraction is one pass over the pages without a shuffle; the model (a few thousand
weights) travels with the function. The size of a page bounds the memory of a row; the elements above a
block are shared, so a deep page costs no more than a flat one.

Cases: null and empty html give an empty text; a page without blocks gives an empty text; rows
with equal ids are extracted each; an empty table gives an empty result.
"""

from __future__ import annotations

import html as html_module
import random
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements whose content is no readable text.
_RAW = ("script", "style", "noscript", "template", "textarea", "svg", "math", "iframe", "object", "select", "title", "canvas", "audio", "video")
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?"
    r"|<(?P<raw>" + "|".join(_RAW) + r")\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S | re.I)
_ATTR = re.compile(r"(?<![\w-])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
#: The label that composed training pages carry; pages of a table are never searched for it.
_LABEL = re.compile(r'data-label="([01])"')
_WORDS = re.compile(r"[a-z]+")
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
                    "small span strike strong sub sup time tt u var wbr".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_P_STAYS = frozenset("option".split())


class Above:
    """The open elements above a block, shared by all blocks and elements below: tags and attribute words met so far."""

    __slots__ = ("tag", "tags", "near", "words", "label")

    def __init__(self, tag: str, tags: frozenset, near: tuple, words: frozenset, label: int | None):
        self.tag, self.tags, self.near, self.words, self.label = tag, tags, near, words, label

    def below(self, tag: str, words: tuple, label: int | None) -> "Above":
        return Above(tag, self.tags if tag in self.tags else self.tags | {tag}, words,
                     self.words if self.words.issuperset(words) else self.words.union(words), self.label if label is None else label)


_TOP = Above("none", frozenset(), (), frozenset(), None)


class Block:
    """One leaf block: its text, the elements above it, and the length of its link text."""

    __slots__ = ("text", "above", "linked")

    def __init__(self, text: str, above: Above, linked: int):
        self.text, self.above, self.linked = text, above, linked


def leaf_blocks(page: str, known: frozenset | None = None, composed: bool = False) -> list[Block]:
    """The leaf blocks of a page, in page order.

    ``known``: tags and attribute words that matter to the caller, others are not kept (None: all); with them the
    memory of a page does not grow with its depth. ``composed``: the page was put together for training and says its labels.
    """
    blocks: list[Block] = []
    stack: list[tuple[str, Above]] = []  # open elements; an inline element stands under the same elements as its parent
    opened: Counter = Counter()
    held: list[str] = []
    linked = 0

    def flush():
        nonlocal linked
        if held:
            text = " ".join(html_module.unescape("".join(held)).split())
            if text:
                blocks.append(Block(text, stack[-1][1] if stack else _TOP, linked))
            held.clear()
            linked = 0

    def push(tag: str, above: Above):
        stack.append((tag, above))
        opened[tag] += 1

    def drop(at: int, end: int | None = None):
        for t, _ in stack[at:end]:
            opened[t] -= 1
        del stack[at:end]

    def add(text: str):
        nonlocal linked
        if text:
            held.append(text)
            if any(t == "a" for t, _ in stack[-4:]):
                linked += len(text.strip())

    at = 0
    for m in _TOKEN.finditer(page):
        add(page[at:m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            if m["raw"]:
                flush()
            continue
        tag = tag.lower()
        if tag in _INLINE:
            if tag == "br":
                held.append(" ")
            elif m["close"]:
                if opened[tag]:
                    for k in range(len(stack) - 1, -1, -1):
                        if stack[k][0] == tag:
                            drop(k, k + 1)
                            break
                        if stack[k][0] not in _INLINE:
                            break
            else:
                push(tag, stack[-1][1] if stack else _TOP)
            continue
        flush()
        if m["close"]:
            if opened[tag]:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == tag:
                        drop(k)
                        break
            continue
        if tag not in _P_STAYS:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == "p" or (tag == "li" and stack[k][0] == "li"):
                    drop(k)
                    break
                if stack[k][0] not in _INLINE and stack[k][0] not in ("li",):
                    break
        if tag not in _VOID and not (m["attrs"] or "").rstrip().endswith("/"):
            words: tuple[str, ...] = ()
            label = None
            if m["attrs"]:
                for a in _ATTR.finditer(m["attrs"]):
                    words += tuple(_WORDS.findall((a[2] or a[3] or a[4] or "").lower()))
                if composed and (said := _LABEL.search(m["attrs"])):
                    label = int(said[1])
            above = stack[-1][1] if stack else _TOP
            if known is None or tag in known:
                push(tag, above.below(tag, words if known is None else tuple(w for w in words if w in known), label))
            else:  # no weight knows the tag: only what stands next to the block is its own
                kept = above.below("", tuple(w for w in words if w in known), label)
                kept.tags = above.tags
                push(tag, kept)
    add(page[at:])
    flush()
    return blocks


_SENTENCE = re.compile(r"[.!?…]")
_SIGNS = re.compile(r"©|\(c\)|copyright|all rights|cookie|subscribe|newsletter|sign up|log ?in|advert|sponsor|share|reply|comment|privacy", re.I)


def block_features(b: Block, place: str) -> list[str]:
    """The binary features of a block, as names."""
    out = ["bias", "at:" + place]
    out += ["in:" + t for t in b.above.tags]
    out += ["word:" + w for w in b.above.words]
    out += ["near:" + w for w in set(b.above.near)]
    out.append("own:" + b.above.tag)
    n = len(b.text)
    out.append(f"len:{min(10, n.bit_length())}")
    out.append(f"link:{min(4, 4 * b.linked // max(1, n))}")
    marks = len(_SENTENCE.findall(b.text))
    out.append(f"marks:{min(3, marks)}")
    if _SIGNS.search(b.text):
        out.append("sign")
    if "|" in b.text:
        out.append("bar")
    return out


def page_features(blocks: list[Block]) -> list[list[str]]:
    n = len(blocks)
    return [block_features(b, "first" if i == 0 else "last" if i == n - 1 else "inner") for i, b in enumerate(blocks)]


class Field:
    """Weights of a linear-chain field with the labels 0 (other) and 1 (main)."""

    def __init__(self, weights: dict[str, float], transition: np.ndarray, start: np.ndarray):
        self.weights, self.transition, self.start = weights, transition, start
        self.known = frozenset(x.partition(":")[2] for x in weights if x.startswith(("in:", "word:", "near:", "own:")))

    def decode(self, features: list[list[str]]) -> list[int]:
        """Viterbi: the best labelling of the blocks of one page."""
        if not features:
            return []
        w, t = self.weights, self.transition.tolist()
        s0, s1 = self.start.tolist()
        back = []
        for i, f in enumerate(features):
            e = sum(w.get(x, 0.0) for x in f)
            if i == 0:
                a0, a1 = s0, s1 + e
                continue
            from0 = (0, a0 + t[0][0]) if a0 + t[0][0] >= a1 + t[1][0] else (1, a1 + t[1][0])
            from1 = (0, a0 + t[0][1]) if a0 + t[0][1] > a1 + t[1][1] else (1, a1 + t[1][1])
            back.append((from0[0], from1[0]))
            a0, a1 = from0[1], from1[1] + e
        y = int(a1 >= a0)
        out = [y]
        for b in reversed(back):
            y = b[y]
            out.append(y)
        return out[::-1]


def fit(pages: list[tuple[list[list[str]], list[int]]], rounds: int = 200, penalty: float = 0.02, rate: float = 0.3) -> Field:
    """Weights by gradient ascent (Adam steps) on the penalised log-likelihood; forward-backward over all pages at once."""
    names: dict[str, int] = {}
    longest = max(len(f) for f, _ in pages)
    n = len(pages)
    cell, feat = [], []
    gold = np.zeros((n, longest), np.int64)
    mask = np.zeros((n, longest), bool)
    for p, (features, labels) in enumerate(pages):
        for i, f in enumerate(features):
            ids = [names.setdefault(x, len(names)) for x in f]
            cell += [p * longest + i] * len(ids)
            feat += ids
            gold[p, i], mask[p, i] = labels[i], True
    cell, feat = np.array(cell), np.array(feat)
    k = len(names)
    theta = np.zeros(k + 6)  # weights, transitions (4), start (2)
    m1, m2 = np.zeros_like(theta), np.zeros_like(theta)
    gold_pairs = np.zeros((2, 2))
    both = mask[:, 1:]
    np.add.at(gold_pairs, (gold[:, :-1][both], gold[:, 1:][both]), 1)
    gold_start = np.bincount(gold[:, 0], minlength=2)
    for step in range(1, rounds + 1):
        w, t, s = theta[:k], theta[k:k + 4].reshape(2, 2), theta[k + 4:]
        emit = np.zeros((n, longest, 2))
        emit[..., 1] = np.bincount(cell, weights=w[feat], minlength=n * longest).reshape(n, longest)
        alpha, beta = np.zeros_like(emit), np.zeros_like(emit)
        alpha[:, 0] = s + emit[:, 0]
        for i in range(1, longest):
            step_in = np.logaddexp.reduce(alpha[:, i - 1, :, None] + t, axis=1) + emit[:, i]
            alpha[:, i] = np.where(mask[:, i, None], step_in, alpha[:, i - 1])
        for i in range(longest - 2, -1, -1):
            step_out = np.logaddexp.reduce(t + (emit[:, i + 1] + beta[:, i + 1])[:, None, :], axis=2)
            beta[:, i] = np.where(mask[:, i + 1, None], step_out, 0.0)
        total = np.logaddexp.reduce(alpha[:, -1], axis=1)[:, None, None]
        one = np.exp(alpha + beta - total) * mask[..., None]
        pair = np.exp(alpha[:, :-1, :, None] + t + (emit + beta)[:, 1:, None, :] - total[..., None]) * both[..., None, None]
        gap = (gold * mask - one[..., 1]).ravel()
        grad = np.concatenate([np.bincount(feat, weights=gap[cell], minlength=k),
                               (gold_pairs - pair.sum((0, 1))).ravel(), gold_start - one[:, 0].sum(0)]) / n - penalty * theta / 10
        m1 = 0.9 * m1 + 0.1 * grad
        m2 = 0.999 * m2 + 0.001 * grad ** 2
        theta = theta + rate / (1 + step / 50) * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.999 ** step)) + 1e-8)
    return Field({x: float(theta[i]) for x, i in names.items()}, theta[k:k + 4].reshape(2, 2), theta[k + 4:])


# ---- labelled pages -----------------------------------------------------------------------

_MAIN = ['<article data-label="1">|</article>', '<main data-label="1">|</main>', '<div class="content" data-label="1">|</div>',
         '<div id="main-content" data-label="1">|</div>', '<div class="post-body entry" data-label="1">|</div>',
         '<main><article class="post" data-label="1">|</article></main>', '<section class="article-body" data-label="1">|</section>',
         '<div id="main" role="main" data-label="1">|</div>', '<div class="text story" data-label="1">|</div>', '<div data-label="1">|</div>']
_OTHER = {
    "menu": ['<nav data-label="0"><ul>|</ul></nav>', '<ul class="menu navbar" data-label="0">|</ul>', '<div id="navigation" data-label="0"><ul>|</ul></div>',
             '<div class="breadcrumb" data-label="0">|</div>'],
    "header": ['<header data-label="0">|</header>', '<div id="header" class="site-header masthead" data-label="0">|</div>', '<div class="top banner" data-label="0">|</div>'],
    "footer": ['<footer data-label="0">|</footer>', '<div id="footer" class="site-footer" data-label="0">|</div>', '<div class="copyright legal" data-label="0">|</div>'],
    "sidebar": ['<aside data-label="0">|</aside>', '<div class="sidebar widget" data-label="0">|</div>', '<div id="sidebar" class="related" data-label="0">|</div>',
                '<section class="recommended more" data-label="0">|</section>', '<aside class="share social" data-label="0">|</aside>'],
    "notice": ['<div class="cookie notice" data-label="0">|</div>', '<div id="cookie-banner" role="dialog" data-label="0">|</div>', '<div class="alert message popup" data-label="0">|</div>',
               '<div class="newsletter subscribe" data-label="0">|</div>', '<div class="consent gdpr modal" data-label="0">|</div>'],
    "advert": ['<div class="ad" data-label="0">|</div>', '<div class="ads" data-label="0">|</div>', '<aside class="advertisement" data-label="0">|</aside>', '<div class="ads advert advertisement" data-label="0">|</div>', '<div id="sponsor" class="promo" data-label="0">|</div>',
               '<ins class="adsbygoogle banner-ad" data-label="0">|</ins>'],
    "form": ['<form data-label="0">|</form>', '<form class="search" data-label="0">|</form>', '<div class="login signup" data-label="0"><form>|</form></div>'],
    "comments": ['<section id="comments" data-label="0">|</section>', '<div class="comments comment-list" data-label="0">|</div>', '<ol class="commentlist" data-label="0">|</ol>',
                 '<div class="comment reply" data-label="0">|</div>', '<div class="discussion responses" data-label="0">|</div>'],
}
_BEFORE, _AFTER = ("header", "menu", "notice", "advert", "form"), ("sidebar", "comments", "form", "advert", "notice", "menu", "footer")


def _fill_other(kind: str, frame: str, text, rng: random.Random) -> str:
    if kind == "menu":
        inner = "".join(f'<li><a href="#">{text(rng.randint(1, 3))}</a></li>' for _ in range(rng.randint(3, 8)))
    elif kind == "form":
        inner = f'<label>{text(rng.randint(1, 6))}</label><input name="q"><button>{text(1)}</button>'
    elif kind == "footer":
        inner = f"<p>{rng.choice(['&copy; ', ''])}{text(rng.randint(2, 20))}</p>"
    elif kind == "comments":
        inner = "".join(f'<div class="comment"><b>{text(1)}</b><p>{text(rng.randint(4, 50))}</p></div>' for _ in range(rng.randint(1, 4)))
    else:
        tag = rng.choice(["p", "div", "p", "span", "li", "h3"])
        inner = "".join(f"<{tag}>{text(rng.randint(2, 40))}</{tag}>" for _ in range(rng.randint(1, 3)))
        if rng.random() < 0.4:
            inner = text(rng.randint(2, 30))
    return frame.replace("|", inner)


def compose_page(paragraphs: list[str], text, rng: random.Random) -> str:
    """A labelled page: the paragraphs as main text, and other blocks around (and, adverts, inside)."""
    def other(kind):
        return _fill_other(kind, rng.choice(_OTHER[kind]), text, rng)
    parts = []
    for i, p in enumerate(paragraphs):
        tag = "h1" if i == 0 and rng.random() < 0.5 else rng.choice(["p"] * 6 + ["li", "blockquote", "div", "h2", "td"])
        if i and rng.random() < 0.2:
            p = " ".join(p.split()[:rng.randint(1, 4)])
        p = html_module.escape(p)
        parts.append(f"<ul><li>{p}</li></ul>" if tag == "li" else f"<table><tr><td>{p}</td></tr></table>" if tag == "td" else f"<{tag}>{p}</{tag}>")
        if rng.random() < 0.2:
            parts.append(other(rng.choice(["advert", "notice", "sidebar"])))
    before = [other(k) for k in _BEFORE if rng.random() < 0.4]
    after = [other(k) for k in _AFTER if rng.random() < 0.4]
    return "<html><body data-label=\"0\">" + "".join(before) + rng.choice(_MAIN).replace("|", "".join(parts)) + "".join(after) + "</body></html>"


_NOT_MAIN = frozenset("nav aside footer header form".split())


def labelled_pages(sample: list[str], variants: int = 3, seed: int = 11, paragraphs_each: int = 60,
                   chain: int = 200) -> list[tuple[list[list[str]], list[int]]]:
    """Pages with labels, from sampled pages that have an ``article`` or ``main`` element (see the module's text).

    A composed page takes up to ``paragraphs_each`` paragraphs, the next one goes on behind them; a page of more
    than ``chain`` blocks is learned as several chains.
    """
    rng = random.Random(seed)
    taken, pool = [], []
    for page in sample:
        blocks = leaf_blocks(page)
        y = []
        for b in blocks:
            tags = b.above.tags
            y.append(int(bool(tags & {"article", "main"}) and not tags & _NOT_MAIN))
        pool += [b.text for b in blocks]
        if any(y):
            taken.append((blocks, y))
    words = " ".join(pool).split() or ["text"]

    def text(n: int) -> str:
        at = rng.randrange(len(words))
        return html_module.escape(" ".join(words[at:at + n]) or "text")
    out = []
    for blocks, y in taken:
        out.append((page_features(blocks), y))
        paragraphs = [b.text for b, v in zip(blocks, y) if v]
        for n in range(variants):
            at = n * paragraphs_each % (-(-len(paragraphs) // paragraphs_each) * paragraphs_each)
            made = leaf_blocks(compose_page(paragraphs[at:at + paragraphs_each], text, rng), composed=True)
            out.append((page_features(made), [b.above.label or 0 for b in made]))
    for _ in range(20):  # also without any usable page
        made = leaf_blocks(compose_page([text(rng.randint(5, 60)).replace("&", "") for _ in range(rng.randint(1, 12))], text, rng), composed=True)
        out.append((page_features(made), [b.above.label or 0 for b in made]))
    return [(f[i:i + chain], y[i:i + chain]) for f, y in out for i in range(0, len(f), chain)]


def train(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", max_pages: int = 100,
          max_chars: int = 100_000) -> Field:
    """Fit the field on labelled pages made from at most ``max_pages`` pages (the smallest by md5 of the id).

    Pages of more than ``max_chars`` characters are not chosen for the sample.
    """
    key = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    chosen = pages.select(F.col(id_col).alias("_id"), key.alias("_k")).where(F.col("_id").isNotNull() & (F.length(html_col) <= max_chars)).distinct().orderBy("_k").limit(max_pages)
    rows = (pages.join(F.broadcast(chosen), F.col(id_col) == F.col("_id"), "left_semi")  # at most max_pages ids
            .where(F.length(html_col) <= max_chars)
            .select(F.coalesce(F.col(html_col), F.lit("")).alias("html")).limit(max_pages).collect())
    return fit(labelled_pages(sorted(r["html"] for r in rows)))


def extract_text(page: str, field: Field) -> str:
    blocks = leaf_blocks(page, field.known)
    return "\n".join(b.text for b, y in zip(blocks, field.decode(page_features(blocks))) if y)


def extract_pages(pages: DataFrame, field: Field, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per page ``page_id, url, text``."""
    @F.pandas_udf("string")
    def main_text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages_ in batches:
            yield pd.Series([extract_text(p, field) for p in pages_], dtype=object)
    return pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                        main_text(F.coalesce(F.col(html_col), F.lit(""))).alias("text"))
