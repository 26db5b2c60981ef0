"""Toxicity scores: gradient-boosted trees over dense text features, with isotonic calibration.

Features come from the whole text alone: densities of lexicon words (a fixed seed list, and words and word beginnings learnt from
the labelled training texts), second-person words and their nearness to lexicon words, capitals, punctuation, and
signs of obfuscation. Spark ML fits the trees and the calibration; every document is scored in one scan."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import staged, text_of

MAX_TRAIN = 40_000  # labelled documents used to fit, the first by a hash of their id
LEARNT = 200  # words and word beginnings learnt
MIN_Z = 4.0
THRESHOLD = 0.7

INSULTS = ("idiot idiots moron morons stupid dumb scum clown clowns trash worthless pathetic disgusting loser losers "
           "fool fools imbecile ugly jerk creep coward filthy vermin garbage retard freak liar lazy brainless").split()
PROFANITY = ("damn crap bastard bitch ass asshole shit bullshit fuck fucking fucker piss dick cunt whore slut "
             "merde connard salope putain arschloch scheisse wichser hurensohn mierda puta cabron pendejo").split()
THREATS = "kill die hate destroy hurt beat burn shoot stab hang rape murder attack threat punish".split()
SECOND_PERSON = frozenset("you your yours yourself yourselves u ur ye thou tu te toi vous votre du dich dir dein ihr "
                          "usted ustedes ti vos".split())
SEEDS = (frozenset(INSULTS), frozenset(PROFANITY), frozenset(THREATS))
NEAR = 5  # words on either side
#: digits and signs that stand for letters
LEET = str.maketrans("013457@$!", "oieastasi")

FEATURES = ["words", "insults", "profanity", "threats", "learnt", "stems", "evidence", "strongest", "hits", "second_person", "near_second_person",
            "capitals", "all_caps", "exclamations", "questions", "signs", "mixed", "masked", "stretched", "disguised"]

_TOKEN = re.compile(r"\w+")
_MIXED = re.compile(r"(?=\w*\d)(?=\w*[a-z])\w+")
_MASKED = re.compile(r"[a-z][*#$%@]+[a-z]|\b(?:[a-z][.\-_ ]){3,}[a-z]\b")
_STRETCHED = re.compile(r"([a-z])\1\1")
_SIGNS = re.compile(r"[^\w\s]")
_CAPS = re.compile(r"\b[A-Z]{2,}\b")
_LEETED = re.compile(r"[a-z0-9@$!]+")
_REPEATS = re.compile(r"(.)\1+")


def terms(text: str) -> set[str]:
    """What a lexicon can learn: the words, and their first 4 to 6 letters marked with ``*``."""
    words = set(_TOKEN.findall(text.lower()))
    return words | {w[:n] + "*" for w in words for n in (4, 5, 6) if len(w) > n}


def features(text: str, words_learnt: dict[str, float], stems_learnt: dict[int, dict[str, float]]) -> list[float]:
    """The values of ``FEATURES``; an empty text gives zeros. Learnt terms come with their log-odds."""
    low = text.lower()
    tokens = _TOKEN.findall(low)
    n = len(tokens)
    if not n:
        return [0.0] * len(FEATURES)
    kinds = set(tokens)
    seeds = [kinds & s for s in SEEDS]
    learnt = kinds & words_learnt.keys()
    stems, odds = set(), [words_learnt[w] for w in learnt]
    for k, known in stems_learnt.items():
        for w in kinds:
            if len(w) > k and w[:k] in known:
                stems.add(w)
                odds.append(known[w[:k]])
    bad = set().union(*seeds, learnt, stems)
    at = [i for i, t in enumerate(tokens) if t in bad] if bad else []
    second = kinds & SECOND_PERSON
    you = [i for i, t in enumerate(tokens) if t in second] if second else []
    near, j = 0, 0
    for i in at:
        while j < len(you) and you[j] < i - NEAR:
            j += 1
        near += j < len(you) and you[j] <= i + NEAR
    count = {}
    for i in at:
        count[tokens[i]] = count.get(tokens[i], 0) + 1
    total = lambda group: float(sum(count[w] for w in group))
    letters = max(1, len(text))
    hidden = 0
    if any(c in low for c in "013457@$!"):
        for w in _LEETED.findall(low):
            if not w.isalpha():
                plain = _REPEATS.sub(r"\1", w.rstrip("!").translate(LEET))
                hidden += any(plain in s for s in SEEDS) or plain in words_learnt
    stretched = 0
    for m in _STRETCHED.finditer(low):
        stretched += 1
    capitals = sum(map(str.isupper, text)) / letters if not text.islower() else 0.0
    return [math.log1p(n), *(total(s) / n for s in seeds), total(learnt) / n, total(stems) / n,
            sum(odds), max(odds, default=0.0), min(float(len(at)), 20.0),
            len(you) / n, near / max(1, len(at)), capitals, len(_CAPS.findall(text)) / n, low.count("!") / n,
            low.count("?") / n, len(_SIGNS.findall(low)) / letters, len(_MIXED.findall(low)) / n,
            len(_MASKED.findall(low)) / n, stretched / n, hidden / n]


@dataclass
class ToxicityModel:
    """A fitted scorer. Without usable labels ``trees`` is None and every score is ``base``."""

    base: float
    words: dict = field(default_factory=dict)
    stems: dict = field(default_factory=dict)
    trees: GBTClassificationModel | None = None
    calibration: IsotonicRegressionModel | None = None

    def _features(self, text: Column) -> Column:
        """The vector of ``FEATURES``. Only the text goes to Python; the other columns of its row wait in the JVM."""
        words, stems = self.words, self.stems

        def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for batch in batches:
                yield pa.array([features(t.as_py(), words, stems) for t in batch], pa.list_(pa.float64()))

        # said to be nondeterministic, so that no rule evaluates it again in a filter
        scan = F.arrow_udf(scan, "array<double>", F.ArrowUDFType.SCALAR_ITER).asNondeterministic()
        return array_to_vector(scan(F.coalesce(text.cast("string"), F.lit(""))))

    def score(self, docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
        """The columns ``keys`` of every row, and its ``score`` from 0 to 1. Null texts score as empty ones."""
        if self.trees is None:
            return docs.select(*keys, F.lit(float(self.base)).alias("score"))
        named = [f"k{i}" for i in range(len(keys))]
        rows = docs.select(*[F.col(k).alias(n) for k, n in zip(keys, named)], self._features(F.col(text)).alias("features"))
        out = _margin(self.trees, rows)
        if self.calibration is not None:
            out = self.calibration.transform(out)
        else:
            out = out.withColumn("calibrated", 1 / (1 + F.exp(-2 * F.col("margin"))))
        return out.select(*[F.col(n).alias(k) for k, n in zip(keys, named)],
                          F.greatest(F.lit(0.0), F.least(F.lit(1.0), "calibrated")).alias("score"))


def _margin(trees: GBTClassificationModel, rows: DataFrame) -> DataFrame:
    return trees.transform(rows).withColumn("margin", vector_to_array("rawPrediction")[1]) \
        .drop("rawPrediction", "probability", "prediction")


def learn_lexicon(train: DataFrame, text: str, label: str, n_toxic: int, n_clean: int, size: int = LEARNT,
                  min_z: float = MIN_Z) -> tuple[dict[str, float], dict[int, dict[str, float]]]:
    """Words and word beginnings whose document frequency tells toxic from clean texts: the ``size`` highest
    z values of the smoothed log-odds ratio, at least ``min_z``. Gives the log-odds of words, and of beginnings by length."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t, y in zip(batch.column("text"), batch.column("label")):
                found = list(terms(t.as_py()))
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array([y.as_py()] * len(found), pa.int64())],
                                                 names=["term", "toxic"])

    pairs = train.select(text_of(text).alias("text"), F.col(label).cast("long").alias("label")).mapInArrow(
        scan, "term string, toxic long")
    a, b = F.col("a") + 0.5, F.col("n") - F.col("a") + 0.5
    odds = F.log(a / (n_toxic - F.col("a") + 0.5)) - F.log(b / (n_clean - F.col("n") + F.col("a") + 0.5))
    spread = 1 / a + 1 / b + 1 / (n_toxic - F.col("a") + 0.5) + 1 / (n_clean - F.col("n") + F.col("a") + 0.5)
    top = pairs.groupBy("term").agg(F.sum("toxic").alias("a"), F.count("*").alias("n")) \
        .withColumn("odds", odds).withColumn("z", F.col("odds") / F.sqrt(spread)).where(F.col("z") >= min_z).orderBy(F.col("z").desc(), "term").limit(size)
    found = {r["term"]: r["odds"] for r in top.select("term", "odds").collect()}  # at most ``size`` rows
    stems = {k: {t[:-1]: w for t, w in found.items() if t.endswith("*") and len(t) == k + 1} for k in (4, 5, 6)}
    return {t: w for t, w in found.items() if not t.endswith("*")}, {k: s for k, s in stems.items() if s}


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "toxic",
        trainable=None, max_train: int = MAX_TRAIN, seed: int = 7) -> ToxicityModel:
    """Fit on at most ``max_train`` labelled documents (the only bounded step; scoring covers everything).

    ``trainable`` is a condition on ``id_column`` that training rows must meet. Null ids and null labels teach nothing; a
    document with several labels is toxic if one says so. A quarter of the rows calibrates. With no labels, or
    one class only, every score is the share of toxic labels (0 without any)."""
    known = labels.select(F.col(id_column).alias("id"), (F.col(label) > 0).cast("int").alias("y")).dropna()
    if trainable is not None:
        known = known.where(trainable("id"))
    known = known.groupBy("id").agg(F.max("y").alias("y")) \
        .orderBy(F.xxhash64(F.lit(seed), "id"), "id").limit(max_train)
    # at most ``max_train`` pairs of numbers
    train = staged(docs.select(F.col(id_column).alias("id"), text_of(text).alias("text"))
                   .join(F.broadcast(known), "id"), "toxicity-train")
    share = train.agg(F.count("*").alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("y")).first()
    n, y = share["n"], share["y"]
    model = ToxicityModel(y / n if n else 0.0)
    if not 0 < y < n:
        return model
    model.words, model.stems = learn_lexicon(train, "text", "y", y, n - y)
    rows = staged(train.select("id", "y", model._features(F.col("text")).alias("features")), "toxicity-features")
    held = F.pmod(F.xxhash64(F.lit(seed + 1), "id"), F.lit(4)) == 0
    rest = rows.where(~held).coalesce(2)
    if rest.select("y").distinct().count() < 2:
        rest = rows
    model.trees = GBTClassifier(labelCol="y", maxIter=20, maxDepth=4, stepSize=0.2, seed=seed).fit(rest)
    margins = _margin(model.trees, rows.where(held)).select(F.col("y").cast("double").alias("y"), "margin")
    if margins.select("y").distinct().count() == 2:
        model.calibration = IsotonicRegression(labelCol="y", featuresCol="margin", predictionCol="calibrated").fit(margins)
    return model
