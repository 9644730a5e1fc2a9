"""Toxicity by gradient-boosted trees over dense features, calibrated isotonically.

The features of a text are rates, not words: density and spread of lexicon
terms, their closeness to second-person pronouns, terms that only appear after
undoing obfuscation (digits and signs for letters, letters held apart by dots
or blanks, masked letters), capitals, punctuation and repetition. They are
computed from the whole text in one pass per batch (:func:`text_features`).

The fixed lexicon is English with a few terms of three other languages. Word
stems that mark toxic texts in the training rows extend it
(:func:`learned_stems`): prefixes of words whose share among toxic texts is many
times that among the others, so terms of any language and inflection count.

Training joins the labels with the texts by id. Rows of the calibration fold
(a part of the training rows) are kept from the trees; the isotonic map from
tree probability to label rate is fitted on them. Trees and map are MLlib
models; scoring is one pass over the documents without a shuffle.

Scale: ``max_rows`` bounds the labelled rows used for fitting (a sample by the
hash of the id, its ids broadcast: at most ``max_rows`` longs). Everything else
covers all rows.

Cases: null and empty texts have all-zero features and get a score like any other
text; a null label is no label; an id labelled twice is toxic if one of its
labels says so; if the labels hold one class only, or none, every score is the
smoothed rate ``(toxic + 1) / (rows + 2)``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import MIN_ID, documents, restore_id, salted_crc

#: Abusive terms (lower case); inflected forms in -s, -es, -y, -ed and -ing count as well.
LEXICON = """
idiot moron stupid dumb dumbass imbecile retard cretin fool loser scum scumbag trash garbage filth vermin
pathetic worthless disgusting useless clown jerk bastard bitch asshole ass fuck fucker shit bullshit crap
whore slut freak creep pig swine rat parasite degenerate subhuman hate kill die ugly liar coward
idiota estúpido imbécil basura asqueroso mierda puta cabrón pendejo
idiote stupide imbécile connard salope merde ordure débile
idiotin dumm dummkopf arschloch scheiße abschaum schlampe trottel widerlich wertlos
""".split()
SECOND_PERSON = "you your yours yourself yourselves u ur du dich dir dein deine euch vous tu te ton votre usted tú ti".split()
#: Terms of other languages' everyday vocabulary, or of general use: they count apart, as weak.
WEAK = frozenset("ass die rat pig hate kill fool freak garbage useless trash clown jerk crap ugly liar dumm".split()) - {"trash", "clown"}

_LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "€": "e"})
_ENDING = r"(?:s|es|y|ed|ing)?"
_APART = re.compile(r"(?<![^\W_])[^\W\d_](?:(?:[.\-_*][^\W\d_]){2,}|(?: [^\W\d_]){3,})(?![^\W_])")
_MASKED = re.compile(r"(?<![^\W_])[^\W\d_]+[*#]+[^\W\d_]+(?![^\W_])")
#: A whole word from its start on; a term starts where no letter or digit stands before it, so each run is read once.
_RUN = re.compile(r"[^\W_]+")
_CAPS_WORD = re.compile(r"\b[A-Z]{3,}\b")
_YOU = re.compile(r"(?<![^\W_])(?:" + "|".join(sorted(SECOND_PERSON, key=len, reverse=True)) + r")(?![^\W_])")
#: Characters on either side of a term in which a second-person pronoun counts as near.
NEAR = 40

FEATURES = ["terms", "term_density", "distinct_terms", "learned_terms", "learned_density", "distinct_learned", "peak_density", "weak_density", "near_you", "near_you_density",
            "leet_terms", "apart_terms", "masked_rate", "upper_rate", "caps_words", "bang_rate", "question_rate",
            "sign_rate", "digit_rate", "log_words", "mean_word"]


_state: dict = {}


def _automaton(stems: tuple[str, ...]):
    """Matcher of the lexicon (whole words) and of the learned stems (word beginnings), one per worker and stem set."""
    if _state.get("stems") != stems:
        import ahocorasick
        a = ahocorasick.Automaton()
        for w in stems:
            a.add_word(w, (w, True))
        for w in LEXICON:
            a.add_word(w, (w, False))
        a.make_automaton()
        _state.update(stems=stems, automaton=a, ending=re.compile(_ENDING + r"(?![^\W_])"))
    return _state["automaton"], _state["ending"]


def _find_terms(text: str, stems: tuple[str, ...]) -> tuple[list[tuple[int, str]], list[tuple[int, str]]]:
    """(start, term) of the lexicon terms, the common endings allowed, and of words with a learned stem."""
    automaton, ending = _automaton(stems)
    whole, learned = [], {}
    for end, (term, is_stem) in automaton.iter(text):
        start = end + 1 - len(term)
        if start == 0 or not text[start - 1].isalnum():
            if is_stem:
                learned.setdefault(start, term)
            elif ending.match(text, end + 1):
                whole.append((start, term))
    return whole, list(learned.items())


def text_features(text: str, stems: tuple[str, ...] = ()) -> list[float]:
    """The feature vector of one text, in the order of :data:`FEATURES`."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    size = len(raw)
    low = text.lower()
    hits, learned = _find_terms(low, stems)
    strong = [h for h in hits if h[1] not in WEAK]
    plain = {s for s, _ in hits}
    leet = [h for h in _find_terms(low.translate(_LEET), stems)[0] if h[0] not in plain] if (count[48:58].any() or count[64] or count[36] or "€" in low) else []
    apart = 0
    for m in _APART.finditer(low):
        joined = re.sub(r"[.\-_* ]", "", m.group())
        apart += sum(not is_stem and len(term) > 3 for _, (term, is_stem) in _automaton(stems)[0].iter(joined))
    spots = sorted({s for s, _ in strong} | {s for s, _ in leet} | {s for s, _ in learned})
    near = sum(1 for s in spots if _YOU.search(low, max(0, s - NEAR), s + NEAR))
    peak = 0
    for i, s in enumerate(spots):  # most terms within 200 characters
        j = i
        while j < len(spots) and spots[j] < s + 200:
            j += 1
        peak = max(peak, j - i)
    masked = len(_MASKED.findall(low)) if count[42] or count[35] else 0
    upper = int(count[65:91].sum())
    letters = upper + int(count[97:123].sum()) + 1
    signs = int(count[33:48].sum() + count[58:65].sum() + count[91:97].sum() + count[123:127].sum())
    return [float(len(strong)), len(strong) / n, float(len({t for _, t in strong})),
            float(len(learned)), len(learned) / n, float(len({_RUN.match(low, s).group() for s, _ in learned})), float(peak), (len(hits) - len(strong)) / n,
            float(near), near / n, float(len(leet)), float(apart), masked / n, upper / letters,
            len(_CAPS_WORD.findall(text)) / n if upper else 0.0, count[33] / size, count[63] / size, signs / size,
            float(count[48:58].sum()) / size, math.log1p(n), size / n]


#: Tasks that fit the trees (at most ``max_rows`` rows).
FIT_TASKS = 6

_WORD_START = re.compile(r"[^\W\d_]{4,}")
#: Lengths of the word beginnings that may become learned stems.
STEM_LENGTHS = range(4, 9)


def _stems_of(text: str) -> set[str]:
    words = set(_WORD_START.findall(text.lower()))
    return words | {w[:k] for w in words for k in STEM_LENGTHS if k < len(w)}


def _stem_counts(rows: DataFrame, name: str, only: frozenset[str] | None = None) -> DataFrame:
    """Texts that hold each stem; counted per batch, then summed."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from collections import Counter
        for b in batches:
            c: Counter = Counter()
            for t in b["text"]:
                found = _stems_of(t)
                c.update(found if only is None else found & only)
            yield pd.DataFrame({"stem": list(c), name: list(c.values())})
    return rows.select("text").mapInPandas(count, f"stem string, {name} long").groupBy("stem").agg(F.sum(name).alias(name))


def learned_stems(rows: DataFrame, support: int = 5, ratio: float = 20.0, most: int = 500) -> tuple[str, ...]:
    """Word beginnings that mark toxic texts among ``rows`` (``text, label``; the bounded training sample).

    A stem needs ``support`` toxic texts and a smoothed share among them ``ratio`` times that
    among the others; the shortest stems win, at most ``most`` are kept, the most frequent first.
    """
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic, clean = sizes.get(1.0, 0), sizes.get(0.0, 0)
    if toxic < support or not clean:
        return ()
    # of at most max_rows texts; a stem in few toxic texts cannot qualify
    found = (_stem_counts(rows.where("label = 1"), "t").where(F.col("t") >= max(support, toxic // 400))
             .orderBy(F.desc("t"), "stem").limit(40 * most))
    t = {r["stem"]: r["t"] for r in found.collect()}
    c = {r["stem"]: r["c"] for r in _stem_counts(rows.where("label = 0"), "c", frozenset(t)).collect()}
    good = [s for s in t if t[s] / toxic >= ratio * (c.get(s, 0) + 0.5) / (clean + 0.5)]
    good.sort(key=lambda s: (len(s), -t[s], s))
    kept: dict[str, None] = {}
    for s in good:
        if s not in LEXICON and not any(s[:k] in kept for k in range(4, len(s))):
            kept[s] = None

    def specific(s: str) -> str:  # the longest beginning that nearly all of the stem's texts share
        longer = [x for x in t if x.startswith(s) and t[x] >= 0.95 * t[s]]
        return max(longer, key=lambda x: (len(x), x))
    return tuple(sorted({specific(s) for s in kept}, key=lambda s: (-t[s], s))[:most])


def with_features(docs: DataFrame, text_col: str = "text", out: str = "features", stems: tuple[str, ...] = ()) -> DataFrame:
    """Replace the text column by the array of its features (Arrow batches, no shuffle)."""
    @F.pandas_udf("array<double>")
    def features(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([text_features(t, stems) for t in texts])
    return docs.withColumn(out, features(F.col(text_col))).drop(text_col)


class ToxicityModel:
    """Boosted trees and the isotonic map; ``score`` gives a column of calibrated probabilities."""

    def __init__(self, trees=None, isotonic=None, constant: float = 0.5, stems: tuple[str, ...] = ()):
        self.trees, self.isotonic, self.constant, self.stems = trees, isotonic, constant, stems

    def score(self, featured: DataFrame, out: str = "score") -> DataFrame:
        """Add ``out`` to rows that have an array column ``features`` (which is dropped)."""
        from pyspark.ml.functions import array_to_vector, vector_to_array
        if self.trees is None:
            return featured.drop("features").withColumn(out, F.lit(float(self.constant)))
        v = featured.withColumn("features", array_to_vector("features"))
        v = self.trees.transform(v).withColumn("_p", vector_to_array("probability")[1])
        v = self.isotonic.transform(v.drop("features", "rawPrediction", "probability", "prediction"))
        # the tree probability keeps the order inside the flat steps of the isotonic map
        both = F.lit(0.999) * F.col("_calibrated") + F.lit(0.001) * F.col("_p")
        return v.withColumn(out, F.greatest(F.lit(0.0), F.least(F.lit(1.0), both))).drop("_p", "_calibrated")


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          folds: int = 5, held_out: int = 0, calibration: int = 1, max_rows: int = 40_000,
          rounds: int = 15, depth: int = 3) -> ToxicityModel:
    """Fit on the labelled documents whose crc32(id) modulo ``folds`` is not ``held_out``.

    The fold ``calibration`` fits the isotonic map, the others the trees. At most ``max_rows``
    labelled ids, the smallest by md5 of the id, take part.
    """
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.regression import IsotonicRegression
    known = (labels.select(F.coalesce(F.col(id_col).cast("long"), F.lit(MIN_ID)).alias("doc_id"),
                           F.col(label_col).cast("double").alias("label"))
             .where(F.col("label").isNotNull() & (salted_crc("doc_id", folds) != held_out))
             .groupBy("doc_id").agg(F.max("label").alias("label"))
             .withColumn("_k", F.md5(F.col("doc_id").cast("string").cast("binary")))
             .orderBy("_k").limit(max_rows).drop("_k"))
    texts = (documents(docs, id_col, text_col).join(F.broadcast(known), "doc_id")  # at most max_rows ids
             .withColumn("calibrate", salted_crc("doc_id", folds) == calibration))
    stems = learned_stems(texts.where("not calibrate"))
    # dealt and ordered by the id, so that reruns fit the same trees
    rows = (with_features(texts, stems=stems).repartition(FIT_TASKS, "doc_id").sortWithinPartitions("doc_id")
            .select("label", "features", "calibrate").persist())
    try:
        seen = {(r["calibrate"], r["label"]): r["n"] for r in rows.groupBy("calibrate", "label").agg(F.count("*").alias("n")).collect()}
        total, toxic = sum(seen.values()), sum(n for (_, y), n in seen.items() if y == 1.0)
        if not (seen.get((False, 0.0)) and seen.get((False, 1.0))):
            return ToxicityModel(constant=(toxic + 1) / (total + 2), stems=stems)
        vectors = rows.withColumn("features", array_to_vector("features"))
        trees = GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=0.2, maxBins=32, seed=7,
                              checkpointInterval=-1).fit(vectors.where("not calibrate"))
        both = seen.get((True, 0.0)) and seen.get((True, 1.0))
        held = trees.transform(vectors.where("calibrate") if both else vectors)
        isotonic = IsotonicRegression(featuresCol="_p", labelCol="label", predictionCol="_calibrated").fit(
            held.select("label", vector_to_array("probability")[1].alias("_p")))
        return ToxicityModel(trees, isotonic, stems=stems)
    finally:
        rows.unpersist()


def score_documents(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text",
                    folds: int = 5, held_out: int = 0) -> DataFrame:
    """Per document ``doc_id, held_out, score, predicted``."""
    scored = model.score(with_features(documents(docs, id_col, text_col), stems=model.stems))
    flag: Column = salted_crc("doc_id", folds) == held_out
    return restore_id(scored.select("doc_id", flag.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")))


def reject_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents that the model does not call toxic, all columns unchanged."""
    model = train(docs, labels, id_col, text_col, **options)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return model.score(with_features(rows, "text", "features", model.stems)).where("score < 0.5").select("row.*")
