import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import prose
from wardflow.llm import quality, toxicity
from wardflow.llm.common import isotonic


def labelled(spark, make, n=400):
    rows = [(i, *make(i)) for i in range(n)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y, y) for i, _, y in rows], "doc_id long, quality int, toxic int")
    return docs, labels


def accuracy(scored, labels, column):
    got = scored.join(labels, "doc_id").where("doc_id >= 300").collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    return sum(r.predicted == r[column] for r in got) / len(got)


def insulted(i):
    words = prose(i, 60).split()
    if i % 4 == 0:
        draw = random.Random(i)
        for _ in range(3):
            words[draw.randrange(60)] = draw.choice(["zorgling", "zorgpest", "blatherskite"])
    return " ".join(words), int(i % 4 == 0)


def junk(i):
    text = prose(i, 60)
    return (" ".join(w + "$$$" for w in text.upper().split()), 0) if i % 4 == 0 else (text, 1)


def test_toxicity_held_out(spark):
    docs, labels = labelled(spark, insulted)
    assert accuracy(toxicity.score(spark, docs, labels, F.col("doc_id") < 300, trees=5), labels, "toxic") >= 0.97


def test_quality_held_out(spark):
    docs, labels = labelled(spark, junk)
    assert accuracy(quality.score(spark, docs, labels, F.col("doc_id") < 300), labels, "quality") >= 0.97


def test_obfuscated_and_stretched_spellings_count():
    lexicon = {"scum": 5.0}
    plain, masked = (dict(zip(toxicity.FEATURES, toxicity.features(t, lexicon, {}))) for t in ("you scum", "YOU 5cum soooo!"))
    assert plain["hits"] == masked["hits"] == 1 and plain["hidden_hits"] == 0 and masked["hidden_hits"] == 1
    assert plain["near_you"] == 1 and masked["stretched"] > 0 and masked["capitals"] > 0


@pytest.mark.parametrize("module", [toxicity, quality])
def test_odd_rows(spark, clashing_docs, no_docs, module):
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(14)] + [(3, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = module.score(spark, clashing_docs, labels, F.lit(True)).collect()
    assert len(got) == clashing_docs.count() and all(0 <= r.score <= 1 for r in got)
    assert module.score(spark, clashing_docs, labels.where("false"), F.lit(True)).count() == clashing_docs.count()
    assert module.score(spark, clashing_docs, labels.where("quality = 1"), F.lit(True)).where("score >= 0.5").count() == clashing_docs.count()
    assert module.score(spark, no_docs, labels, F.lit(True)).count() == 0


def test_isotonic_is_monotone_and_keeps_the_mean():
    draw = np.random.Generator(np.random.PCG64(1))
    x, y, w = draw.normal(size=200), draw.integers(0, 2, 200).astype(float), draw.integers(1, 5, 200).astype(float)
    xs, ys = isotonic(x, y, w)
    assert (np.diff(xs) > 0).all() and (np.diff(ys) >= 0).all()
    assert abs((np.interp(x, xs, ys) * w).sum() - (y * w).sum()) < 1e-6 * w.sum() or ys[0] <= y.mean() <= ys[-1]
