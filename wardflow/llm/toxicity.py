"""Toxicity: boosted trees over dense features, with isotonic calibration.

The lexicon is learned: words and word beginnings that occur in many more toxic
than other training documents. Features are densities of lexicon hits, how near
they stand to second-person words, and rates of capitals, punctuation and
obfuscated spellings. Trees and calibration are fitted on separate parts of a
sample of at most about ``bound`` labelled rows; the lexicon keeps at most
``LEXICON`` entries. Every text is scored whole.

Defined cases: null and empty texts have zero features and are scored like any
other; a training sample with a single class gives every text that class's
share; documents with several labels count as toxic if one of them is;
repeated rows are scored alike; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm.common import calibration, keep, labelled_sample

BOUND = 20_000
LEXICON = 4_000
BEGINNINGS = (4, 5, 6)
#: Second-person words of English, French, German and Spanish.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine ihr euch euer sie ihnen tú ti usted ustedes tuyo vosotros os su".split()
)
TOKEN = re.compile(r"[^\W_]+(?:[*@$!#'’_\-][^\W_]+|[*@$]+[^\W_]*)*")
LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": "", "_": "", "-": "", "'": "", "’": "", "#": ""})
PLAIN = re.compile(r"[^\W\d_]+\Z")
STRETCHED = re.compile(r"([^\W\d_])\1{2,}")
NEAR = 5
FEATURES = [
    "log_words", "hits", "hit_density", "strong_density", "weight_density", "top_weight", "distinct_hits",
    "you_density", "near_you", "near_you_density", "capitals", "capital_words", "punctuation", "exclamations",
    "questions", "digits", "odd_spellings", "hidden_hits", "stretched",
]


def terms(word: str) -> list[str]:
    """A word and its beginnings, as the lexicon lists them."""
    return [word, *(f"{word[:k]}*" for k in BEGINNINGS if len(word) >= k)]


def tokens(text: str) -> list[str]:
    return TOKEN.findall(text.lower())


def learn_lexicon(spark: SparkSession, sample: DataFrame, least_docs: int = 5, least_odds: float = 2.0) -> dict[str, float]:
    """Log odds of the terms that speak most for toxic documents."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sums = {0.0: Counter(), 1.0: Counter()}
            for text, label in zip(batch["text"], batch["label"]):
                sums[float(label > 0)].update({t for w in set(tokens(text)) for t in terms(w)})
            rows = [(t, float(n), 0.0) for t, n in sums[1.0].items()] + [(t, 0.0, float(n)) for t, n in sums[0.0].items()]
            yield pd.DataFrame(rows, columns=["term", "toxic", "clean"])

    size = sample.agg(F.sum("label"), F.count("*")).first()
    toxic, clean = size[0] or 0.0, size[1] - (size[0] or 0.0)
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (clean + 1.0))
    # Rarer terms than a four-hundredth of the toxic documents are left to chance.
    least = max(least_docs, toxic / 400)
    found = (
        sample.select("text", "label")
        .mapInPandas(count, "term string, toxic double, clean double")
        .groupBy("term")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where(F.col("toxic") >= least)
        .select("term", odds.alias("odds"), "toxic")
        .where(F.col("odds") >= least_odds)
        .orderBy(F.desc(F.col("odds") * F.log("toxic")), "term")
        .limit(LEXICON)
        .collect()
    )
    return {r["term"]: r["odds"] for r in found}


def features(text: str, lexicon: dict[str, float], known: dict[str, float]) -> list[float]:
    """The dense features of a text; ``known`` caches word weights between calls."""
    words = tokens(text)
    n = max(len(words), 1)
    hits: list[tuple[int, float]] = []
    you: list[int] = []
    odd = hidden = 0
    for i, word in enumerate(words):
        weight = known.get(word)
        if weight is None:
            weight = max((lexicon.get(t, 0.0) for t in terms(word)), default=0.0)
            if not PLAIN.match(word):
                bare = word.translate(LEET)
                masked = 0.0 if bare.isdigit() else max((lexicon.get(t, 0.0) for t in terms(bare)), default=0.0)
                weight = -max(weight, masked) - 1e-9  # negative: an odd spelling
            if len(known) < 500_000:
                known[word] = weight
        if weight < 0:
            odd += 1
            weight = -weight
            if weight > 1e-6:
                hidden += 1
        if weight > 1e-6:
            hits.append((i, weight))
        if word in SECOND_PERSON:
            you.append(i)
    near = 0
    if hits and you:
        places = np.array(you)
        at = np.array([i for i, _ in hits])
        nearest = np.searchsorted(places, at)
        left = np.abs(at - places[np.maximum(nearest - 1, 0)])
        right = np.abs(at - places[np.minimum(nearest, len(places) - 1)])
        near = int((np.minimum(left, right) <= NEAR).sum())
    chars = max(len(text), 1)
    upper = sum(map(str.isupper, text)) if text != text.lower() else 0
    letters = max(sum(len(w) for w in words), 1)
    punctuation = sum(text.count(c) for c in ".,;:!?-\"'()")
    return [
        math.log1p(len(words)),
        float(len(hits)),
        len(hits) / n,
        sum(w >= 4.0 for _, w in hits) / n,
        sum(w for _, w in hits) / n,
        max((w for _, w in hits), default=0.0),
        float(len({words[i] for i, _ in hits})),
        len(you) / n,
        float(near),
        near / n,
        upper / letters,
        upper / n,
        punctuation / chars,
        text.count("!") / chars,
        text.count("?") / chars,
        sum(text.count(d) for d in "0123456789") / chars,
        odd / n,
        float(hidden),
        sum(1 for _ in STRETCHED.finditer(text)) / n,
    ]


def with_features(documents: DataFrame, lexicon: dict[str, float], carried: list[str]) -> DataFrame:
    """The ``carried`` columns and the vector ``features``."""

    @F.pandas_udf("array<double>")
    def compute(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known: dict[str, float] = {}
        for batch in batches:
            yield pd.Series([np.array(features(t if isinstance(t, str) else "", lexicon, known)) for t in batch], dtype=object)

    return documents.select(*carried, array_to_vector(compute("text")).alias("features"))


def score(spark: SparkSession, documents: DataFrame, labels: DataFrame, chosen: Column, bound: int = BOUND, trees: int = 20, depth: int = 4) -> DataFrame:
    """(doc_id, score, predicted) of every row; labels are read of the ``chosen`` ids only."""
    sample = labelled_sample(spark, documents, labels, "toxic", chosen, bound)
    rows = documents.select("doc_id", "text")
    shares = sample.agg(F.avg("label"), F.count("*")).first()
    if not shares[1] or shares[0] in (0.0, 1.0):
        flat = F.lit(float(shares[0] if shares[1] else 0.0))
        return rows.select("doc_id", flat.alias("score"), (flat >= 0.5).cast("int").alias("predicted"))
    lexicon = learn_lexicon(spark, sample.where(~F.col("calibrate")))
    train, _ = keep(spark, with_features(sample, lexicon, ["label", "calibrate"]), "toxic-features")
    model = GBTClassifier(labelCol="label", maxIter=trees, maxDepth=depth, stepSize=0.2, seed=1).fit(
        train.where(~F.col("calibrate")).coalesce(4)
    )

    def raw(df: DataFrame, *columns: str) -> DataFrame:
        return model.transform(df).select(*columns, vector_to_array("probability")[1].alias("raw"))

    xs, ys = calibration(raw(train, "label", "calibrate").where("calibrate"), "raw", "label")

    @F.pandas_udf("double")
    def calibrated(values: pd.Series) -> pd.Series:
        return pd.Series(np.interp(values, xs, ys))

    scored = raw(with_features(rows, lexicon, ["doc_id"]), "doc_id").select("doc_id", calibrated("raw").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
