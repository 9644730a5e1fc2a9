"""Plain second versions of toxicity features, entity detection and leaf blocks."""

import re
from html.parser import HTMLParser

import pytest
import regex

from sqlscore.llm import html_extract, pii, toxicity

from conftest import SF01


# ---- toxicity ----------------------------------------------------------------------------

def plain_features(text):
    """Features that need no position of a term: rates of the text, and counts of whole lexicon words."""
    words = re.findall(r"[^ \t\n\x0b\f\r]+", text)
    n, size = len(words), len(text.encode())
    if not n:
        return None
    upper = len(re.findall("[A-Z]", text))
    letters = len(re.findall("[A-Za-z]", text))
    low = text.lower()
    whole = [t for t in toxicity.LEXICON for _ in re.finditer(rf"(?<![^\W_]){re.escape(t)}(?:s|es|y|ed|ing)?(?![^\W_])", low)]
    return {"n": n, "upper": upper / (letters + 1), "caps": len(re.findall(r"\b[A-Z]{3,}\b", text)) / n, "exclaim": text.count("!") / size,
            "ask": text.count("?") / size, "signs": len(re.findall(r"[!-/:-@\[-`{-~]", text)) / size, "digits": len(re.findall("[0-9]", text)) / size,
            "bytes": size / n, "strong": sorted(t for t in whole if t not in toxicity.WEAK)}


def test_features_equal_a_plain_version(spark):
    texts = [r["text"] for r in spark.read.parquet(f"{SF01}/documents.parquet").collect() if r["text"]]
    texts += ["You stupid IDIOT!!", "idiots, idiotic and the idiot", "what? WHAT 123", "x", "Ünïcode ÄÖÜ Straße!"]
    checked = 0
    for t in texts:
        want, got = plain_features(t), toxicity.text_features(t)
        if want is None:
            assert not any(got)
            continue
        tail = {"upper": got[13], "caps": got[14], "exclaim": got[15], "ask": got[16], "signs": got[17], "digits": got[18], "bytes": got[20]}
        for name, value in tail.items():
            assert value == pytest.approx(want[name], rel=1e-12, abs=1e-15), (name, t[:80])
        # terms that lie inside one another count once in the automaton's leftmost reading
        assert (got[0] > 0) == bool(want["strong"]) and got[0] <= len(want["strong"]), t[:80]
        checked += bool(want["strong"])
    assert checked >= 3


# ---- surrogates --------------------------------------------------------------------------

def test_entities_equal_a_plain_scan(spark):
    """Every document: the same number of matches as the patterns give in another engine, and nothing else changes."""
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    got = {r["doc_id"]: r for r in pii.replace_entities(docs, "k").collect()}
    fixed = regex.compile(pii.PATTERN.replace("(?<=(?i:token", "(?<=(?i:token"), regex.V0)
    full = regex.compile(pii.FULL_NAME)
    title = regex.compile(rf"^{pii.TITLE}\\.?[ \\t]+")
    entities = 0
    for r in docs.collect():
        text = r["text"] or ""
        names = {title.sub("", m.group()) for m in full.finditer(text)}
        pattern = fixed
        if names:
            own = "|".join(regex.escape(x) for x in sorted(names, key=lambda x: (-len(x), x)))
            pattern = regex.compile(pii.PATTERN + rf"|(?<![\p{{L}}\p{{N}}])(?:{own})(?![\p{{L}}\p{{N}}])")
        spans = [m.span() for m in pattern.finditer(text)]
        assert got[r["doc_id"]]["n_entities"] == len(spans), r["doc_id"]
        entities += len(spans)
        between = [text[a:b] for a, b in zip([0, *(e for _, e in spans)], [*(s for s, _ in spans), len(text)])]
        out, at = got[r["doc_id"]]["text"] or "", 0
        for part in between:  # what stands between the entities is kept, in order
            at = out.index(part, at) + len(part)
    assert entities > 50


# ---- extraction --------------------------------------------------------------------------

class Plain(HTMLParser):
    """Leaf blocks by the standard parser: texts between block tags, without raw elements."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks, self.held, self.raw = [], [], []

    def end(self):
        text = " ".join("".join(self.held).split())
        if text:
            self.blocks.append(text)
        self.held = []

    def handle_starttag(self, tag, attrs):
        if tag in html_extract._RAW:
            self.end()
            self.raw.append(tag)
        elif tag == "br":
            self.held.append(" ")
        elif tag not in html_extract._INLINE:
            self.end()

    def handle_endtag(self, tag):
        if self.raw and tag == self.raw[-1]:
            self.raw.pop()
        elif tag not in html_extract._INLINE:
            self.end()

    def handle_data(self, data):
        if not self.raw:
            self.held.append(data)


def test_blocks_equal_those_of_the_standard_parser(spark):
    pages = [r["html"] for r in spark.read.parquet(f"{SF01}/pages.parquet").collect() if r["html"]]
    assert len(pages) > 100
    for page in pages:
        p = Plain()
        p.feed(page)
        p.close()
        p.end()
        assert [b.text for b in html_extract.leaf_blocks(page)] == p.blocks
