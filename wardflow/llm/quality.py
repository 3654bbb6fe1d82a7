"""Quality: ridge regression on random Fourier features, with isotonic calibration.

Document statistics are standardised and mapped to cosines of random
projections, which approximate a Gaussian kernel. Every partition sums its part
of the normal equations, the sums are added by cell, and a system of
``FREQUENCIES + 1`` unknowns is solved. Calibration uses a part of the sample
that the fit did not see. The sample holds at most about ``bound`` labelled
rows; every text is scored whole.

Defined cases: null and empty texts have zero statistics and are scored like any
other; without training rows every score is 0.5; a document with several labels
counts as good if one says so; repeated rows are scored alike; extra columns are
ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm.common import calibration, keep, labelled_sample

BOUND = 20_000
FREQUENCIES = 256
#: Kernel width in standard deviations of the statistics.
WIDTH = 6.0
RIDGE = 1e-3
SYMBOLS = re.compile(r"[^\w\s.,;:!?'\"()\-’]")
STATISTICS = [
    "log_words", "mean_word", "spread_word", "distinct", "top_word", "top_pair", "capitals", "capital_words", "digits",
    "symbols", "symbol_words", "stops", "exclamations", "pipes", "log_lines", "mean_line", "repeated_lines", "ended_lines",
    "no_letter_words", "long_words", "compressed",
]


def statistics(text: str) -> list[float]:
    """The statistics of a whole text, in the order of ``STATISTICS``."""
    words = text.split()
    if not words:
        return [0.0] * len(STATISTICS)
    n, chars = len(words), len(text)
    counts = Counter(words)
    pairs = Counter(zip(words, words[1:]))
    lengths = np.fromiter(map(len, words), np.int64, n)
    kinds = list(counts.items())
    lines = [line for line in text.split("\n") if line.strip()]
    data = text.encode("utf-8", "ignore")
    symbols = len(SYMBOLS.findall(text))
    upper = sum(map(str.isupper, text))
    return [
        np.log1p(n),
        lengths.mean(),
        lengths.std(),
        np.log(len(counts)) / np.log(n + 1.0),
        max(counts.values()) / n,
        max(pairs.values(), default=0) / n,
        upper / chars,
        sum(k for w, k in kinds if len(w) > 1 and w.isupper()) / n,
        sum(text.count(d) for d in "0123456789") / chars,
        symbols / chars,
        sum(k for w, k in kinds if SYMBOLS.search(w)) / n,
        sum(k for w, k in kinds if w[-1] in ".?!") / n,
        text.count("!") / chars,
        counts.get("|", 0) / n,
        np.log1p(len(lines)),
        np.log1p(n / len(lines)),
        1.0 - len(set(lines)) / len(lines),
        sum(line.rstrip()[-1] in ".?!\"'" for line in lines) / len(lines),
        sum(k for w, k in kinds if not any(map(str.isalpha, w))) / n,
        float((lengths > 20).mean()),
        len(zlib.compress(data, 1)) / len(data),
    ]


def with_statistics(documents: DataFrame, carried: list[str]) -> DataFrame:
    """The ``carried`` columns and ``x``, the array of statistics."""

    @F.pandas_udf("array<double>")
    def compute(texts: pd.Series) -> pd.Series:
        return pd.Series([np.asarray(statistics(t if isinstance(t, str) else ""), float) for t in texts], dtype=object)

    return documents.select(*carried, compute("text").alias("x"))


class Model:
    """Standardisation, frequencies, weights and calibration curve."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, seed: int = 7):
        draw = np.random.Generator(np.random.PCG64(seed))
        self.mean, self.spread = mean, spread
        self.frequencies = draw.normal(0.0, 1.0 / WIDTH, (len(mean), FREQUENCIES))
        self.phases = draw.uniform(0.0, 2 * np.pi, FREQUENCIES)
        self.weights = np.zeros(FREQUENCIES + 1)
        self.curve = ([0.0], [0.5])

    def mapped(self, x: np.ndarray) -> np.ndarray:
        """Random Fourier features and a constant; statistics are cut at eight deviations."""
        scaled = np.clip((x - self.mean) / self.spread, -8.0, 8.0)
        waves = np.sqrt(2.0 / FREQUENCIES) * np.cos(scaled @ self.frequencies + self.phases)
        return np.hstack([waves, np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.mapped(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), *self.curve), 0.0, 1.0)


def normal_equations(train: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Sums of z z' and z y over all partitions; only the cells' totals reach the driver."""
    width = FREQUENCIES + 1

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((width, width + 1))
        for batch in batches:
            if len(batch):
                z = model.mapped(np.vstack(batch["x"].to_numpy()))
                total += z.T @ np.hstack([z, batch["label"].to_numpy()[:, None]])
        yield pd.DataFrame({"cell": np.arange(total.size), "value": total.ravel()})

    cells = (
        train.select("x", "label").mapInPandas(part, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value")).toPandas()
    )
    total = np.zeros(width * (width + 1))
    total[cells["cell"].to_numpy()] = cells["value"].to_numpy()
    total = total.reshape(width, width + 1)
    return total[:, :width], total[:, width]


def fit(spark: SparkSession, documents: DataFrame, labels: DataFrame, chosen: Column, bound: int = BOUND) -> Model | None:
    """The model of the sampled labelled rows, or None without any."""
    sample = labelled_sample(spark, documents, labels, "quality", chosen, bound)
    train, _ = keep(spark, with_statistics(sample, ["label", "calibrate"]), "quality-statistics")
    fitted = train.where(~F.col("calibrate")).coalesce(8)
    values = [F.col("x")[i] for i in range(len(STATISTICS))]
    moments = fitted.agg(F.count("*"), *[F.avg(v) for v in values], *[F.stddev_pop(v) for v in values]).first()
    if not moments[0]:
        return None
    k = len(STATISTICS)
    spread = np.array(moments[k + 1 :], float)
    model = Model(np.array(moments[1 : k + 1], float), np.where(spread > 1e-9, spread, 1.0))
    products, targets = normal_equations(fitted, model)
    penalty = RIDGE * moments[0] / FREQUENCIES * np.eye(FREQUENCIES + 1)
    penalty[-1, -1] = 1e-9
    model.weights = np.linalg.solve(products + penalty, targets)
    apart = train.where("calibrate")
    model.curve = calibration(scored(apart, model, ["label"], calibrated=False), "score", "label")
    return model


def scored(rows: DataFrame, model: Model, carried: list[str], calibrated: bool = True) -> DataFrame:
    """The ``carried`` columns and the score of rows that have statistics ``x``."""

    @F.pandas_udf("double")
    def compute(statistics_of: pd.Series) -> pd.Series:
        if not len(statistics_of):
            return pd.Series([], dtype=float)
        x = np.vstack(statistics_of.to_numpy())
        return pd.Series(model.score(x) if calibrated else model.raw(x))

    return rows.select(*carried, compute("x").alias("score"))


def score(spark: SparkSession, documents: DataFrame, labels: DataFrame, chosen: Column, bound: int = BOUND) -> DataFrame:
    """(doc_id, score, predicted) of every row; labels are read of the ``chosen`` ids only."""
    model = fit(spark, documents, labels, chosen, bound)
    if model is None:
        return documents.select("doc_id", F.lit(0.5).alias("score"), F.lit(1).alias("predicted"))
    rows = scored(with_statistics(documents.select("doc_id", "text"), ["doc_id"]), model, ["doc_id"])
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
